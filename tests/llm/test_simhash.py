"""SimHash: fingerprints, links and components against brute force."""

import random
import re

import numpy as np
import pytest
import xxhash
from caselens.llm import simhash
from caselens.llm.common import table
from caselens.llm.components import components
from caselens.llm.queries import QUERIES
from samples import none, odd, prose, words


def brute_print(text):
    found = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not found:
        return 0
    parts = [" ".join(found[i : i + 3]) for i in range(max(1, len(found) - 2))]
    hashes = [xxhash.xxh64_intdigest(p.encode(), seed=42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_roots(nodes, linked):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in linked:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {n: find(n) for n in nodes}


def signed(number):
    return number - (1 << 64) if number >> 63 else number


def near(prints):
    values = np.array(sorted(prints), np.int64)
    for i, one in enumerate(values):
        differ = (values[i + 1 :] ^ one).view(np.uint64)  # signed numbers count by absolute value
        for j in np.flatnonzero(np.bitwise_count(differ) <= simhash.RADIUS):
            yield int(one), int(values[i + 1 + j])


def check(rows):
    by_print = {}
    for doc_id, mark, _ in rows:
        by_print.setdefault(mark, set()).add(doc_id)
    roots = brute_roots(sorted(by_print), near(by_print))
    groups = {}
    for mark, ids in by_print.items():
        groups.setdefault(roots[mark], set()).update(i for i in ids if i is not None)
    for _, mark, component in rows:
        assert component == min(groups[roots[mark]], default=None)


def test_odd_rows(spark):
    docs = odd(spark)
    rows = [tuple(r) for r in simhash.near_duplicates(docs).collect()]
    wanted = [(r.doc_id, signed(brute_print(r.text))) for r in docs.collect()]
    assert sorted(map(str, ((a, b) for a, b, _ in rows))) == sorted(map(str, wanted))
    check(rows)
    assert simhash.near_duplicates(none(spark)).collect() == []


@pytest.mark.parametrize("limit", [simhash.PAIRS_PER_BUCKET, 40, 2])
def test_dense_prints_are_linked_as_by_brute_force(spark, monkeypatch, limit):
    """Crowds around a few centres, so that buckets are indexed again on every level."""
    monkeypatch.setattr(simhash, "PAIRS_PER_BUCKET", limit)
    rnd, prints = random.Random(limit), set()
    for centre in (0, (1 << 64) - 1, rnd.getrandbits(64), rnd.getrandbits(64)):
        for _ in range(250):
            value = centre
            for bit in rnd.sample(range(64), rnd.randrange(8)):
                value ^= 1 << bit
            prints.add(signed(value))
    prints |= {signed(rnd.getrandbits(64)) for _ in range(200)}
    frame = spark.createDataFrame([(p,) for p in prints], "print long")
    found = {r.node: r.root for r in components(simhash.links(frame)).collect()}
    wanted = brute_roots(prints, near(prints))
    assert {p: found.get(p, p) for p in prints} == wanted
    assert len(set(wanted.values())) > 4


def test_components_of_a_chain_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(100)] + [(1000, i) for i in range(2000, 2300)] + [(7, 7)]
    frame = spark.createDataFrame(edges, "a long, b long")
    found = {r.node: r.root for r in components(frame).collect()}
    assert found == {**{i: 0 for i in range(1, 101)}, **{i: 1000 for i in range(2000, 2300)}}
    assert components(frame.limit(0)).collect() == []


def test_query(spark, data):
    rows = QUERIES["op1_simhash"](spark, data).collect()
    texts = {r.doc_id: r.text for r in table(spark, data, "documents").collect()}
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows[::20]:
        assert r.fingerprint == f"{brute_print(texts[r.doc_id]):016x}"
    check([(r.doc_id, signed(int(r.fingerprint, 16)), r.component_id) for r in rows])


# --- the rows that stay --------------------------------------------------------------------------


def changed(text, seed, count):
    rnd, found = random.Random(seed), words(text)
    for place in rnd.sample(range(len(found)), count):
        found[place] = f"new{rnd.randrange(10**6)}"
    return " ".join(found)


def brute_kept(texts):
    """doc_ids that stay of ``{doc_id: text}``: the smallest one of each component."""
    by_print = {}
    for i, text in sorted(texts.items()):
        by_print.setdefault(signed(brute_print(text)), []).append(i)
    roots, first = brute_roots(sorted(by_print), near(by_print)), {}
    for mark, ids in by_print.items():
        first[roots[mark]] = min(first.get(roots[mark], ids[0]), ids[0])
    return set(first.values())


def test_one_document_of_each_component_stays(spark):
    rows = {}
    for group in range(30):
        base = prose(group, 400)
        for k in range(1 + group % 5):
            rows[len(rows)] = changed(base, group * 100 + k, 1) if k else base
    rows |= {10_000 + k: changed(prose(77, 900), k, 1) for k in range(150)}
    kept = simhash.kept_rows(spark.createDataFrame(list(rows.items()), "doc_id long, text string"))
    found = {r.doc_id for r in kept.collect()}
    assert found == brute_kept(rows) and len(found) < len(rows) - 100
    assert found >= {i for i, t in rows.items() if t in {prose(g, 400) for g in range(30)}}


def test_odd_rows_that_stay(spark):
    docs = odd(spark)
    kept = simhash.kept_rows(docs)
    assert kept.columns == docs.columns
    rows = [(r.doc_id, r.text) for r in kept.collect()]
    assert (0, None) in rows and (1, "") not in rows  # no words: one component
    assert [t for i, t in rows if i == -5] == ["one"] and (3, "one") not in rows
    assert sum(i == 6 for i, _ in rows) == 2  # equal rows stay together
    assert simhash.kept_rows(none(spark)).collect() == []


def test_a_text_without_an_id_stays_when_it_is_alone(spark):
    alone, shared = prose(5, 90), prose(6, 90)
    rows = [(None, alone), (None, shared), (3, shared), (None, None)]
    kept = simhash.kept_rows(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, kept), key=str) == sorted([(None, alone), (3, shared), (None, None)], key=str)
