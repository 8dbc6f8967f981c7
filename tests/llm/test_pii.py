"""Personal data: rules against plain patterns, the model by enumeration and held-out windows."""

import itertools
import random
import re

import numpy as np
import pytest

from caselens.llm import pii
from caselens.llm.charcrf import CharCrf
from caselens.llm.queries import QUERIES
from samples import none, odd, rows_of, texts

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _good(kind, text):
    digits = re.sub("[^0-9]", "", text)
    if kind == "ip":
        return all(int(p) <= 255 for p in text.split("."))
    if kind == "phone":
        return 9 <= len(digits) <= 15
    if kind == "card":
        total = 0
        for i, d in enumerate(digits[::-1]):
            value = int(d) * (1 + i % 2)
            total += value // 10 + value % 10
        return 12 <= len(digits) <= 19 and total % 10 == 0
    return True


def plain(text):
    found = [
        (kind, m.start(), m.end()) for kind, pattern in PATTERNS.items()
        for m in re.finditer(pattern, text) if _good(kind, m.group())
    ]
    return sorted(found, key=lambda s: (s[1], list(PATTERNS).index(s[0])))


@pytest.mark.parametrize("seed", range(6))
def test_rules_equal_the_plain_patterns(seed):
    rnd = random.Random(seed)
    parts = ["a", "b.c", "@", "1", "25", "256", ".", "-", " ", "+", "(", ")", "\n", "é", "4111111111111111",
             "+1 (743) 555-3824", "x.y@m.example.com", "10.0.0.1", "%", "0004", "😀"]
    for _ in range(400):
        text = "".join(rnd.choice(parts) for _ in range(rnd.randrange(1, 30)))
        assert pii.base_spans(text) == plain(text), text


def test_long_runs_are_read_once():
    for sign in "a1@.+- 😀":
        assert isinstance(pii.base_spans(sign * 1_000_000 + "@1"), list)
    assert pii.base_spans("1." * 500_000) == [("ip", i, i + 7) for i in range(0, 999_993, 8)]
    assert pii.base_spans("9" * 5000 + ".1.1.1") == []


def test_every_span_lies_in_a_region():
    rnd = random.Random(3)
    for _ in range(300):
        text = "".join(rnd.choice("ab1 @.+") * rnd.randrange(1, 40) for _ in range(12))
        parts = pii.regions(text)
        assert all(text[start:].startswith(part) for start, part in parts)
        for _, start, end in pii.base_spans(text):
            signs = [i for i in range(start, end) if text[i] in "@0123456789"]
            assert any(a <= signs[0] and signs[-1] < a + len(p) for a, p in parts)


def test_windows_cover_a_region_and_overlap():
    for length in range(1, 400):
        starts = pii.windows_of(length)
        assert starts[0] == 0 and starts[-1] + pii.WINDOW >= length
        assert all(b - a == pii.STRIDE for a, b in zip(starts, starts[1:]))


def _loss(model, windows, tags):
    return model.gradient(windows, tags)[0]


def test_gradient_is_that_of_the_loss():
    rng = np.random.default_rng(0)
    model = CharCrf.fresh(5, 3, hidden=4, kind="f8")
    model.weights["moves"] = rng.normal(size=(3, 3))
    windows, tags = rng.integers(0, 5, (3, 6)), rng.integers(0, 3, (3, 6))
    gradient = model.gradient(windows, tags)[1]
    for name, value in model.weights.items():
        for place in rng.integers(0, value.size, 6):
            old = value.flat[place]
            value.flat[place] = old + 1e-5
            up = _loss(model, windows, tags)
            value.flat[place] = old - 1e-5
            down = _loss(model, windows, tags)
            value.flat[place] = old
            assert gradient[name].flat[place] == pytest.approx((up - down) / 2e-5, abs=1e-6)


def test_loss_and_best_tags_by_enumeration():
    rng = np.random.default_rng(1)
    model = CharCrf.fresh(5, 3, hidden=4, kind="f8")
    model.weights["moves"] = rng.normal(size=(3, 3))
    windows, tags = rng.integers(0, 5, (2, 5)), rng.integers(0, 3, (2, 5))
    scores = model._emissions(model._run(windows)[0])[1]
    w, losses = model.weights, []
    for row in range(2):
        def value(path):
            moves = sum(w["moves"][a, b] for a, b in zip(path, path[1:]))
            ends = w["first"][path[0]] + w["last"][path[-1]]
            return moves + ends + sum(scores[t, row, tag] for t, tag in enumerate(path))

        every = list(itertools.product(range(3), repeat=5))
        values = np.array([value(p) for p in every])
        losses.append(np.log(np.exp(values).sum()) - value(tags[row]))
        assert tuple(model.decode(windows)[0][row]) == every[int(values.argmax())]
    assert _loss(model, windows, tags) == pytest.approx(np.mean(losses))


@pytest.mark.parametrize("seed", range(5))
def test_reconciled_is_the_best_set_without_overlap(seed):
    rnd = random.Random(seed)
    spans = [(rnd.randrange(1, 9) + rnd.random(), rnd.choice(pii.KINDS), a, a + rnd.randrange(1, 8))
             for a in (rnd.randrange(20) for _ in range(9))]
    best = 0.0
    for size in range(len(spans) + 1):
        for some in itertools.combinations(spans, size):
            order = sorted(some, key=lambda s: s[2])
            if all(a[3] <= b[2] for a, b in zip(order, order[1:])):
                best = max(best, sum(s[0] for s in some))
    known = {s[1:]: s[0] for s in sorted(spans)}
    chosen = pii.reconciled(spans)
    assert all(a[2] <= b[1] for a, b in zip(chosen, chosen[1:]))
    assert sum(known[s] for s in chosen) == pytest.approx(best)


def _cases(seed, count):
    """Regions as they stand in prose: signs of each kind among words, numbers that mean nothing."""
    rnd = random.Random(seed)

    def number(size):
        return "".join(rnd.choice("0123456789") for _ in range(size))

    kinds = (
        lambda: f"{rnd.choice(['ana', 'bo.li', 'c_d'])}.{number(2)}@mail{number(1)}.example.com",
        lambda: ".".join(str(rnd.randrange(256)) for _ in range(4)),
        lambda: number(16),
        lambda: f"+1 ({number(3)}) 555-{number(4)}",
        lambda: number(rnd.randrange(1, 9)),
    )
    words = lambda: " ".join(rnd.choice(["the", "Onre,", "éa", "und.", "ti"]) for _ in range(9))
    return [f"{words()} {rnd.choice(kinds)()} {words()}" for _ in range(count)]


def test_model_learns_spans_and_parts_neighbours():
    model = pii.trained([p for t in _cases(1, 400) for _, p in pii.regions(t)])
    held_out = [p for t in _cases(2, 200) for _, p in pii.regions(t)]
    inputs, outputs = pii.training_windows(held_out)
    tags = model.decode(inputs)[0]
    assert ((tags == outputs) & (outputs > 0)).sum() > 0.95 * (outputs > 0).sum()
    assert ((tags > 0) & (outputs == 0)).sum() < 0.05 * (outputs > 0).sum()
    card = "4111111111111111"
    text = f"the onre éa ti {card} {card} und the onre"
    assert pii.base_spans(text) == []
    found = [s for _, some in pii.decoded(model, iter((0, a, p) for a, p in pii.regions(text)))
             for s in some]
    at = text.index(card)
    assert pii.added_spans([], pii.regions(text), found) == [
        ("card", at, at + 16), ("card", at + 17, at + 33)
    ]
    # What the rules have, and what fails its check, is never added.
    assert pii.added_spans([("card", at, at + 33)], pii.regions(text), found) == []
    assert pii.added_spans([], [(0, "4" * 16)], [(9.0, "card", 0, 16)]) == []


def test_all_odd_rows_get_a_row(spark):
    extra = [*_cases(3, 60), "4" + "1" * 15 + " ", "1" * 3000, "@" * 3000, "a@b.c" * 2000]
    docs = odd(spark, extra)
    found = rows_of(pii.found_spans(docs).select("doc_id", "spans"))
    wanted = [(r["doc_id"], plain(r["text"] or "")) for r in docs.collect()]
    got = [(i, [tuple(s) for s in spans]) for i, spans in found]
    assert sorted(got, key=repr) == sorted(wanted, key=repr)
    assert rows_of(pii.found_spans(none(spark))) == []
    assert len(texts()) < len(got)


def test_query_counts_and_digests(spark, data):
    docs = {r["doc_id"]: r["text"] or "" for r in
            spark.read.parquet(f"{data}/documents.parquet").collect()}
    rows = QUERIES["op11_pii"](spark, data).collect()
    assert len(rows) == len(docs)
    for row in rows:
        text, base = docs[row["doc_id"]], plain(docs[row["doc_id"]])
        assert [row[f"n_{k}"] for k in PATTERNS] == [
            sum(s[0] == k for s in base) for k in PATTERNS
        ]
        assert row["base_sha256"] == pii.digest(base)
        spans = [tuple(s.split(":")) for s in row["spans"].split(",") if s]
        spans = [(k, int(a), int(b)) for k, a, b in spans]
        assert row["spans"] == pii.printed(spans) and set(base) <= set(spans)
        assert len(spans) == len(base) + row["n_added"]
        for kind, start, end in set(spans) - set(base):
            assert re.fullmatch(PATTERNS[kind], text[start:end]) and _good(kind, text[start:end])
            assert not any(a < end and start < b for _, a, b in base)
