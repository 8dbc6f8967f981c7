"""Personal data in texts: pattern rules, and a character model for what they lose."""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from functools import partial
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caselens.llm.charcrf import CharCrf
from caselens.llm.common import in_arrow, landed, per_batch, text_or_empty

# The kinds in their order.
KINDS = ("email", "ip", "card", "phone")
# Characters of a window and from one window to the next, and around a sign that a span must have.
WINDOW, STRIDE, AROUND = 64, 32, 24
# Documents with personal data that the model learns from at most: those with the smallest hashes.
SAMPLE, SEED = 500, 5
# Windows decoded at once.
AT_ONCE = 1 << 10

Span = tuple[str, int, int]

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match always begins where a run of digits does, so no later start needs a try.
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_SIGN = re.compile("[0-9@]")
# Signs with less than two contexts between them.
_NEAR = re.compile(rf"[0-9@](?:[^0-9@]{{0,{2 * AROUND - 1}}}[0-9@])*+")
_NOT_DIGIT = re.compile("[^0-9]+")


# --- rules ---------------------------------------------------------------------------------------


def _digits(text: str) -> str:
    return _NOT_DIGIT.sub("", text)


def _luhn(digits: str) -> bool:
    values = [int(d) for d in reversed(digits)]
    doubled = (2 * v - 9 * (v > 4) for v in values[1::2])
    return (sum(values[::2]) + sum(doubled)) % 10 == 0


def _is_card_shaped(text: str) -> bool:
    return 12 <= len(_digits(text)) <= 19


def _is_ip(text: str) -> bool:
    parts = [p.lstrip("0") or "0" for p in text.split(".")]
    return all(len(p) <= 3 and int(p) <= 255 for p in parts)


def _is_phone(text: str) -> bool:
    return 9 <= len(_digits(text)) <= 15


def _emails(text: str) -> Iterator[Span]:
    """Found from each at sign outwards, so that long runs of letters are not tried again and
    again."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = done + len(text[done:at].rstrip(_LOCAL))
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield "email", start, domain.end()
        done = domain.end() if domain else at + 1
        at = text.find("@", done)


def base_spans(text: str) -> list[Span]:
    """Leftmost matches of each kind's pattern that pass its check, by start, then by kind."""
    if not _SIGN.search(text):
        return []
    found = list(_emails(text))
    found += [("ip", *m.span()) for m in _IP.finditer(text) if _is_ip(m[0])]
    found += [
        ("card", *m.span()) for m in _CARD.finditer(text)
        if _is_card_shaped(m[0]) and _luhn(_digits(m[0]))
    ]
    found += [("phone", *m.span()) for m in _PHONE.finditer(text) if _is_phone(m[0])]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def _passes(kind: str, text: str) -> bool:
    """Whether a text is, as a whole, what its kind's rule asks for."""
    if kind == "email":
        local, _, domain = text.partition("@")
        return bool(local) and not local.strip(_LOCAL) and bool(_DOMAIN.fullmatch(domain))
    if kind == "ip":
        return bool(_IP.fullmatch(text)) and _is_ip(text)
    if kind == "card":
        return bool(_CARD.fullmatch(text)) and _is_card_shaped(text) and _luhn(_digits(text))
    return bool(_PHONE.fullmatch(text)) and _is_phone(text)


def regions(text: str) -> list[tuple[int, str]]:
    """Every part of a text that can hold personal data: the surroundings of digits and at signs,
    one of which each kind must have. Parts that touch are one."""
    out = []
    for near in _NEAR.finditer(text):
        start, end = max(0, near.start() - AROUND), min(len(text), near.end() + AROUND)
        if out and start < out[-1][1]:
            out[-1][1] = end
        else:
            out.append([start, end])
    return [(start, text[start:end]) for start, end in out]


# --- the model -----------------------------------------------------------------------------------

# Classes of characters: those with a meaning in some pattern are alone.
_ALONE = "@.+-_%() \n=:/\"'#,"
_PAD, _DIGIT, _LOWER, _UPPER, _SPACE, _SIGNS, _OTHER = range(7)
CLASSES = 7 + len(_ALONE)
TAGS = 1 + 2 * len(KINDS)


def _ascii_classes() -> np.ndarray:
    out = np.full(128, _SIGNS)
    for code in range(128):
        c = chr(code)
        if c in _ALONE:
            out[code] = 7 + _ALONE.index(c)
        elif c.isalnum():
            out[code] = _DIGIT if c.isdigit() else _UPPER if c.isupper() else _LOWER
        elif c.isspace():
            out[code] = _SPACE
    return out


_ASCII = _ascii_classes()


def classes_of(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    return np.where(codes < 128, _ASCII[np.minimum(codes, 127)], _OTHER)


def windows_of(length: int) -> list[int]:
    """Starts of overlapping windows that cover a region."""
    return [0, *range(STRIDE, max(1, length - WINDOW + STRIDE), STRIDE)]


def _cut(values: np.ndarray, starts: list[int]) -> np.ndarray:
    padded = np.r_[values, np.zeros(WINDOW + STRIDE, values.dtype)]
    return padded[np.array(starts)[:, None] + np.arange(WINDOW)]


def tags_of(length: int, spans: list[Span]) -> np.ndarray:
    """Tag of each character: 0 outside, else the first or a further one of its kind. Where spans of
    two kinds overlap, the longer one counts."""
    tags = np.zeros(length, np.int64)
    for kind, start, end in sorted(spans, key=lambda s: s[2] - s[1]):
        place = 1 + 2 * KINDS.index(kind)
        tags[start:end] = place + 1
        tags[start] = place
    return tags


def labelled(text: str) -> list[Span]:
    """Spans that the model learns: those of the rules. Numbers of a card's length are labelled
    whether or not their check digit is right, which no look at single characters can tell."""
    cards = [("card", *m.span()) for m in _CARD.finditer(text) if _is_card_shaped(m[0])]
    return [s for s in base_spans(text) if s[0] != "card"] + cards


def training_windows(texts: list[str], seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """Windows and tags of regions. A labelled span of each region is shown again beside other ones of
    the sample, of any and of its own kind, with a short gap between: rules that take as much as
    they can run such neighbours together."""
    rng = np.random.default_rng(seed)
    cases = [(text, labelled(text)) for text in texts]
    pieces = [(kind, text[a:b]) for text, spans in cases for kind, a, b in spans]
    alike = {kind: [p for p in pieces if p[0] == kind] for kind in KINDS}
    for text, spans in list(cases):
        for any_kind in (True, False) if spans else ():
            kind, start, end = spans[int(rng.integers(len(spans)))]
            others = pieces if any_kind else alike[kind]
            other_kind, other = others[int(rng.integers(len(others)))]
            gap = (" ", ", ", " ", "\n", " ", "-", "  ")[int(rng.integers(7))]
            shift = max(0, start - AROUND)
            head, tail = text[shift:end], text[end : end + AROUND]
            at = len(head) + len(gap)
            cases.append((
                head + gap + other + tail,
                [(kind, start - shift, end - shift), (other_kind, at, at + len(other))],
            ))
    inputs, outputs = [np.zeros((0, WINDOW), np.int64)], [np.zeros((0, WINDOW), np.int64)]
    for text, spans in cases:
        starts = windows_of(len(text))
        inputs.append(_cut(classes_of(text), starts))
        outputs.append(_cut(tags_of(len(text), spans), starts))
    return np.concatenate(inputs), np.concatenate(outputs)


def trained(texts: list[str]) -> CharCrf:
    """A model of the regions of some documents; without regions it knows nothing."""
    model = CharCrf.fresh(CLASSES, TAGS)
    inputs, outputs = training_windows(texts)
    if len(inputs):
        model.fit(inputs, outputs)
    return model


# --- decoding ------------------------------------------------------------------------------------


def _spans_in(tags: np.ndarray, better: np.ndarray, begin: int) -> list[tuple[float, str, int, int]]:
    """``(score, kind, start, end)`` of each span of one window that begins at ``begin``."""
    out = []
    kinds = np.where(tags > 0, (tags - 1) // 2, -1)
    starts = np.flatnonzero(
        (kinds >= 0) & ((tags % 2 == 1) | np.r_[True, kinds[1:] != kinds[:-1]])
    )
    for start in starts.tolist():
        end = start + 1
        while end < len(tags) and kinds[end] == kinds[start] and tags[end] % 2 == 0:
            end += 1
        score = float(better[start:end].sum())
        out.append((score, KINDS[kinds[start]], begin + start, begin + end))
    return out


def reconciled(found: list[tuple[float, str, int, int]]) -> list[Span]:
    """The set of spans without overlap that scores highest in sum, over all windows of a document.

    A span that several windows show in the same way counts with its best score.
    """
    best: dict[Span, float] = {}
    for score, kind, start, end in found:
        span = (kind, start, end)
        best[span] = max(score, best.get(span, 0.0))
    spans = sorted((s for s, score in best.items() if score > 0), key=lambda s: (s[2], s[1], s[0]))
    ends = [s[2] for s in spans]
    totals, taken = [0.0], []
    for i, span in enumerate(spans):
        before = bisect_left(ends, span[1] + 1, 0, i)
        total = totals[before] + best[span]
        taken.append(before if total > totals[-1] else -1)
        totals.append(max(total, totals[-1]))
    out, i = [], len(spans)
    while i:
        if taken[i - 1] < 0:
            i -= 1
        else:
            out.append(spans[i - 1])
            i = taken[i - 1]
    return out[::-1]


def decoded(
    model: CharCrf, parts: Iterator[tuple[int, int, str]]
) -> Iterator[tuple[int, list[tuple[float, str, int, int]]]]:
    """Spans of every window, as ``(row, spans)``, of regions ``(row, start, text)``."""
    held: list[tuple[int, int, np.ndarray]] = []

    def flush():
        tags, better = model.decode(np.stack([x for _, _, x in held]))
        for (row, begin, _), some, scores in zip(held, tags, better):
            if some.any():
                yield row, _spans_in(some, scores, begin)

    for row, start, text in parts:
        starts, values = windows_of(len(text)), classes_of(text)
        for at in range(0, len(starts), AT_ONCE):
            some = starts[at : at + AT_ONCE]
            held += [(row, start + s, x) for s, x in zip(some, _cut(values, some))]
            if len(held) >= AT_ONCE:
                yield from flush()
                held = []
    if held:
        yield from flush()


def added_spans(
    base: list[Span], parts: list[tuple[int, str]], found: list[tuple[float, str, int, int]]
) -> list[Span]:
    """Of the decoded spans those that pass their kind's check and touch no base span, reconciled."""
    starts = [start for start, _ in parts]

    def text_of(start: int, end: int) -> str:
        at, text = parts[bisect_left(starts, start + 1) - 1]
        return text[start - at : end - at]

    taken = sorted((start, end) for _, start, end in base)
    limits = []  # ends of base spans so far, so that one look back is enough
    for _, end in taken:
        limits.append(max(end, limits[-1]) if limits else end)

    def is_free(start: int, end: int) -> bool:
        before = bisect_left(taken, (end, 0))
        return before == 0 or limits[before - 1] <= start

    checked: dict[Span, bool] = {}
    good = []
    for score, kind, start, end in found:
        span = (kind, start, end)
        if span not in checked:
            checked[span] = is_free(start, end) and _passes(kind, text_of(start, end))
        if checked[span]:
            good.append((score, kind, start, end))
    return reconciled(good)


# --- over all documents --------------------------------------------------------------------------

_SPANS = "array<struct<kind:string,start:long,stop:long>>"


def _based(batch: pa.RecordBatch) -> pa.RecordBatch:
    texts = batch.column("text").to_pylist()
    spans = [base_spans(t) for t in texts]
    parts = [regions(t) for t in texts]
    return pa.record_batch({
        "doc_id": batch.column("doc_id"),
        "spans": pa.array(
            [[{"kind": k, "start": a, "stop": b} for k, a, b in some] for some in spans],
            _arrow_spans(),
        ),
        "parts": pa.array(
            [[{"start": a, "text": t} for a, t in some] for some in parts],
            pa.list_(pa.struct([("start", pa.int64()), ("text", pa.string())])),
        ),
    })


def _arrow_spans() -> pa.DataType:
    return pa.list_(
        pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64())])
    )


def _with_added(model: CharCrf, batch: pa.RecordBatch) -> pa.RecordBatch:
    parts = [[(p["start"], p["text"]) for p in some] for some in batch.column("parts").to_pylist()]
    base = [[(s["kind"], s["start"], s["stop"]) for s in some]
            for some in batch.column("spans").to_pylist()]
    found: dict[int, list] = {}
    every = ((row, start, text) for row, some in enumerate(parts) for start, text in some)
    for row, spans in decoded(model, every):
        found.setdefault(row, []).extend(spans)
    added = [
        [{"kind": k, "start": a, "stop": b} for k, a, b in added_spans(base[i], p, found[i])]
        if i in found else []
        for i, p in enumerate(parts)
    ]
    return pa.record_batch({
        "doc_id": batch.column("doc_id"), "spans": batch.column("spans"),
        "added": pa.array(added, _arrow_spans()),
    })


def _sample(rows: DataFrame, size: int) -> list[str]:
    """Texts of the regions of at most ``size`` rows, those with the smallest hashes.

    A cut of the hash comes first, so that a task does not send a whole sample of its own.
    """
    able = rows.filter(F.size("parts") > 0)
    total = able.count()
    span = 1 << 32
    mark = F.pmod(F.xxhash64("doc_id", "parts"), F.lit(span))
    cut = span if total <= size else min(span, 2 * size * span // total)
    drawn = (
        able.select("parts", mark.alias("mark"), F.xxhash64("parts").alias("more"))
        .filter(F.col("mark") < cut).orderBy("mark", "more").limit(size)
    )
    # A region's share of a very long text counts as much as a document.
    return [part["text"][: WINDOW * WINDOW] for row in drawn.collect() for part in row["parts"][:16]]


def found_spans(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``(doc_id, spans, added)`` of each row of ``docs (doc_id, text, ...)``: what the rules find, and
    what the model adds, as arrays of ``(kind, start, stop)`` in code points, by start.

    The rules read every whole text. The model is trained on the surroundings of digits and at signs
    of at most ``sample`` documents, labelled by the rules, and decodes all such surroundings of all
    documents, in overlapping windows; text without these signs can hold no span of any kind. A span
    is added if it passes its kind's check and overlaps none of the rules': this finds what a rule
    loses when its match runs on into a neighbour.

    A NULL text counts as empty and has no spans, runs of millions of equal signs are read once.
    Repeated rows each get a row, a NULL doc_id stays NULL, other columns are not looked at, no rows
    give none. Without any personal data to learn from nothing is added.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = landed(
        docs.select("doc_id", text_or_empty().alias("text")).transform(
            in_arrow, per_batch(_based),
            f"doc_id {kind}, spans {_SPANS}, parts array<struct<start:long,text:string>>",
        )
    )
    model = trained(_sample(rows, sample))
    return rows.transform(
        in_arrow, per_batch(partial(_with_added, model)),
        f"doc_id {kind}, spans {_SPANS}, added {_SPANS}",
    )


def printed(spans) -> str:
    """``kind:start:end`` of spans, by start, then by kind, joined by commas."""
    order = sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in order)


def digest(spans) -> str:
    return sha256(printed(spans).encode()).hexdigest()
