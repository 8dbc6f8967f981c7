"""Ranked search against SQL over the tables and against plain Python on odd rows."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from caselens.llm import lexical
from caselens.llm.queries import ORACLE, QUERIES
from samples import none, odd, prose, rows_of
from oracle_compare import differences, oracle_connection

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ITEMS = "item_id long, text string, doc_id long, score string"


def words(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), " ".join(WORD.findall(text or ""))).split(" ")


def plain(docs, items, top):
    counts = [(i, Counter(w for w in words(t) if w)) for i, t in docs]
    sizes = [sum(c.values()) for _, c in counts]
    n_docs, length = sum(s > 0 for s in sizes), sum(sizes)
    df = Counter(t for _, c in counts for t in c)
    out = Counter()
    for item, text in items:
        asked = Counter(w for w in words(text) if w and df[w])
        scored = []
        for (doc_id, c), n in zip(counts, sizes):
            if n == 0:
                continue
            m = 25 + 75 * n * n_docs // length
            score = sum(
                times * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m))
                for t, times in asked.items() if c[t]
            )
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        for rank, (score, _, _, doc_id) in enumerate(sorted(scored, key=lambda r: r[:3])[:top], 1):
            out[item, rank, doc_id, -score] += 1
    return out


@pytest.mark.parametrize("top", [1, 10, 500])
def test_equals_plain_python_on_odd_rows(spark, top):
    extra = [prose(i, 20 + i, 60) for i in range(80)] + ["w1 w2"] * 30
    docs = odd(spark, extra)
    items = [(1, prose(500, 30, 60)), (2, "w1 W2 w1 nobody"), (2, "one TWO"), (None, "漢字 one"),
             (3, None), (4, ""), (5, "!? nobody"), (6, prose(501, 3000, 60))]
    frame = spark.createDataFrame([(i, t, 1, "x") for i, t in items], ITEMS)
    got = Counter(rows_of(lexical.search(docs, frame, top)))
    assert got == plain([(r["doc_id"], r["text"]) for r in docs.collect()], items, top)


def test_many_passes_give_the_same(spark, monkeypatch):
    docs = odd(spark, [prose(i, 40, 60) for i in range(40)])
    items = [(i, prose(900 + i, 12, 60)) for i in range(20)]
    frame = spark.createDataFrame([(i, t, 1, "x") for i, t in items], ITEMS)
    monkeypatch.setattr(lexical, "QUERY_TERMS", 60)
    got = Counter(rows_of(lexical.search(docs, frame)))
    assert got == plain([(r["doc_id"], r["text"]) for r in docs.collect()], items, 10)


def test_empty_tables(spark):
    items = spark.createDataFrame([(1, "one", 1, "x")], ITEMS)
    assert rows_of(lexical.search(none(spark), items)) == []
    assert rows_of(lexical.search(odd(spark), items.limit(0))) == []


def _query(terms, weights):
    empty = np.zeros(0, np.int64)
    return lexical.Query(0, np.array(terms), np.array(weights), empty, empty, empty.astype(bool))


@pytest.mark.parametrize("seed", range(8))
@pytest.mark.parametrize("width", [1, 7, 512])
def test_best_first_over_blocks(seed, width, monkeypatch):
    """Blocks after each other, ties and unknown ids; small steps and small areas of search."""
    monkeypatch.setattr(lexical, "AT_ONCE", width)
    monkeypatch.setattr(lexical, "AREA", 1 << (8 + seed))
    rng = np.random.default_rng(seed)
    query, scores = _query([0, 2, 3, 9], [5, 7, 1, 2]), []
    for _ in range(3):
        size = int(rng.integers(1, 200))
        ids = rng.permutation(10_000)[:size].astype(np.int64)
        known = rng.random(size) < 0.9
        norms = rng.integers(25, 30, size)
        held = rng.random((6, size)) < 0.4
        numbers, places = np.nonzero(held)
        times = rng.integers(1, 3, len(places))
        lexical.Block(np.where(known, ids, lexical._LAST), known, norms, places, numbers, times
                      ).search(query, 10)
        total = np.zeros(size, np.int64)
        for number, place, tf in zip(numbers, places, times):
            weight = {0: 5, 2: 7, 3: 1}.get(number, 0)
            total[place] += weight * (1_000_000_000 * tf // (1000 * tf + 8 * norms[place]))
        scores += [(-s, not k, i if k else 0) for s, k, i in zip(total, known, ids) if s > 0]
    got = [(-s, not k, i if k else 0) for s, k, i in zip(query.scores, query.known, query.ids)]
    assert got == sorted(scores)[:10]


def test_bounds_leave_out_most_documents(monkeypatch):
    """A few documents far above the rest are found without scoring many."""
    size = 20_000
    norms = np.full(size, 100)
    times = np.ones(size, np.int64)
    times[[5, 700, 19_000]] = 50
    block = lexical.Block(np.arange(size), np.ones(size, bool), norms, np.arange(size),
                          np.zeros(size, np.int64), times)
    looked = []
    scores = block._scores
    monkeypatch.setattr(block, "_scores", lambda q, p: looked.append(len(p)) or scores(q, p))
    query = _query([0], [3])
    block.search(query, 3)
    assert query.ids.tolist() == [5, 700, 19_000] and sum(looked) < 20


def test_oracle(spark, data):
    sql = ORACLE["op13_lexical_search"]
    frame = QUERIES["op13_lexical_search"](spark, data)
    assert differences(frame, oracle_connection(data), sql) == ""
