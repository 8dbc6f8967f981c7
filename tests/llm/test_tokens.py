"""Token counts, packing and BPE round trips against the tokenizers library."""

import hashlib
import random
import time
import zlib
from collections import defaultdict
from functools import lru_cache

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from caselens.llm import bpe, packing, tokens
from caselens.llm.common import table
from caselens.llm.queries import QUERIES
from samples import none, odd, prose, texts

BYTES, WORDS = "byte_bpe_50k.json", "word_bpe_49k.json"


@lru_cache
def library(name):
    return Tokenizer.from_file(public_tokenizers.path(name))


def ids(name, text):
    return library(name).encode(text or "", add_special_tokens=False).ids


@lru_cache
def own(name):
    path = public_tokenizers.path(name)
    return tokens.ByteBpe(path) if name == BYTES else bpe.TextBpe(path)


def same_round_trip(some):
    for text, (found, decoded) in zip(some, own(WORDS).encode(some)):
        wanted = ids(WORDS, text)
        assert found.tolist() == wanted
        assert decoded == library(WORDS).decode(wanted, skip_special_tokens=False)


# --- encoders ------------------------------------------------------------------------------------


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text(text):
    assert own(BYTES).ids(text).tolist() == ids(BYTES, text)
    same_round_trip([text])


def test_every_character():
    some = [f"a{chr(c)}b {chr(c)} x{chr(c)}{chr(c)}1" for c in range(1, 0x3400)
            if not 0xD800 <= c < 0xE000]
    same_round_trip(some)
    for text in some:
        assert own(BYTES).ids(text).tolist() == ids(BYTES, text)


def test_mixes_of_vocabulary_entries():
    """Words glued from tokens, where greedy proposals often fail."""
    rnd, encoder = random.Random(5), own(WORDS).words
    names = [n.removesuffix(bpe.END) for n in encoder.names]
    words = [tokens.token_bytes("".join(rnd.choices(names, k=rnd.randint(1, 5))))
             for _ in range(5000)]
    proposed = [encoder.proposed(w) for w in words]
    exact = [encoder.exact(w) for w in words]
    assert encoder.encode(words) == exact
    assert any(p != e for p, e in zip(proposed, exact))
    assert any(p == e for p, e in zip(proposed, exact))


def test_neighbours_are_judged_as_merging_does():
    rnd, encoder = random.Random(6), own(WORDS).words
    inner, final = list(encoder.inner.items()), list(encoder.final.items())
    pairs = [(rnd.choice(inner), rnd.choice(final)) for _ in range(3000)]
    good = encoder.compatible(*(np.array([p[k][1] for p in pairs]) for k in (0, 1)))
    for (left, right), one in zip(pairs, good):
        assert (encoder.exact(left[0] + right[0]) == [left[1], right[1]]) == one


def test_long_texts_are_cut_where_no_token_spans():
    for text in (prose(1, 20_000), "a" * 100_000, "word " * 20_000, " " * 70_000 + "b",
                 "x\n" * 30_000, "<|endoftext|>" * 5000 + " a b" * 9000):
        parts = tokens.pieces(text, 1000)
        assert "".join(parts) == text
        assert [i for p in parts for i in ids(BYTES, p)] == ids(BYTES, text)


def test_a_file_with_other_ids_is_refused(tmp_path):
    import json

    content = json.load(open(public_tokenizers.path(BYTES), encoding="utf-8"))
    merges = content["model"]["merges"]
    merges[0], merges[1] = merges[1], merges[0]
    path = tmp_path / "other.json"
    path.write_text(json.dumps(content), encoding="utf-8")
    for make in (tokens.ByteBpe, bpe.WordBpe):
        with pytest.raises(ValueError):
            make(str(path))


def test_words_are_forgotten_without_harm(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 50)
    for k in range(5):
        same_round_trip([prose(k, 100), "<|endoftext|> again"])


# --- tables --------------------------------------------------------------------------------------


def test_counts_of_odd_rows(spark, monkeypatch):
    docs = odd(spark)
    rows = tokens.token_counts(docs, public_tokenizers.path(BYTES)).collect()
    wanted = [
        (r.doc_id, len((r.text or "").encode()), n := len(ids(BYTES, r.text)), n > 512)
        for r in docs.collect()
    ]
    assert sorted(map(str, map(tuple, rows))) == sorted(map(str, wanted))
    assert tokens.token_counts(none(spark), public_tokenizers.path(BYTES)).collect() == []


def test_round_trips_of_odd_rows(spark):
    docs = odd(spark)
    rows = bpe.round_trip(docs, public_tokenizers.path(WORDS)).collect()
    wanted = []
    for r in docs.collect():
        found = ids(WORDS, r.text)
        text = library(WORDS).decode(found, skip_special_tokens=False)
        wanted.append((r.doc_id, len(found), np.array(found, "<u4").tobytes(), text))
    got = [(r.doc_id, r.n_tokens, bytes(r.ids), r.decoded) for r in rows]
    assert sorted(map(str, got)) == sorted(map(str, wanted))
    assert bpe.round_trip(none(spark), public_tokenizers.path(WORDS)).collect() == []


def test_count_and_round_trip_queries(spark, data):
    documents = {r.doc_id: r.text for r in table(spark, data, "documents").collect()}
    counts = {r.doc_id: r for r in QUERIES["op5_token_counts"](spark, data).collect()}
    trips = {r.doc_id: r for r in QUERIES["op10_bpe"](spark, data).collect()}
    assert set(counts) == set(trips) == set(documents)
    for doc_id, text in documents.items():
        assert counts[doc_id].n_tokens == len(ids(BYTES, text))
        found = ids(WORDS, text)
        decoded = library(WORDS).decode(found, skip_special_tokens=False)
        one = trips[doc_id]
        assert one.n_tokens == len(found)
        assert one.ids_sha256 == hashlib.sha256(np.array(found, "<u4").tobytes()).hexdigest()
        assert one.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


# --- packing -------------------------------------------------------------------------------------


def check_pieces(rows, documents):
    """Pieces hold every id once; sequences are gapless and within the capacity."""
    by_document, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_document[r.doc_id].append(r)
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for doc_id, some in by_document.items():
        if doc_id not in documents:
            continue
        whole = [*ids(BYTES, documents[doc_id]), 2]
        some.sort(key=lambda r: r.piece)
        assert [r.piece for r in some] == list(range(len(some)))
        assert all(r.length == 1024 for r in some[1:])
        at = 0
        for r in some:
            own_ids = np.array(whole[at : at + r.length], "<u4").tobytes()
            assert (r.start, r.ids_crc32) == (at, zlib.crc32(own_ids))
            at += r.length
        assert at == len(whole)
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 1024


def plain_best_fit(lengths):
    gaps = []
    for length in sorted(lengths, reverse=True):
        fits = [i for i, gap in enumerate(gaps) if gap >= length]
        if fits:
            gaps[min(fits, key=lambda i: gaps[i])] -= length
        else:
            gaps.append(1024 - length)
    return len(gaps)


@pytest.mark.parametrize("seed", range(6))
def test_sweeps_open_as_many_sequences_as_plain_best_fit(seed):
    rnd = random.Random(seed)
    lengths = [rnd.choice([rnd.randint(1, 1024), rnd.randint(1, 60), 400, 1]) for _ in range(800)]
    counts = {n: lengths.count(n) for n in set(lengths)}
    plan = packing.sweep(counts)
    used, ranks = defaultdict(int), defaultdict(list)
    for length, low, high, first, each, offset in plan:
        for rank in range(low, high + 1):
            place = rank - low
            at = (first + place // each, offset + place % each * length)
            assert used[at[0]] <= at[1]
            used[at[0]] = max(used[at[0]], at[1] + length)
            ranks[length].append(rank)
    assert {n: sorted(r) for n, r in ranks.items()} == {n: list(range(c)) for n, c in counts.items()}
    assert max(used.values()) <= 1024 and len(used) == plain_best_fit(lengths)


def test_packing_of_odd_rows(spark):
    from pyspark.sql import functions as F

    docs = odd(spark)
    pieces = packing.token_pieces(docs, public_tokenizers.path(BYTES)).select(
        "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")
    )
    rows = packing.packed(pieces).collect()
    assert len(rows) == pieces.count()
    once = {i: t for i, t in enumerate(texts()) if i not in (3, 6)}
    check_pieces(rows, once)
    assert packing.packed(pieces.limit(0)).collect() == []
    with pytest.raises(ValueError):
        packing.packed(pieces.withColumn("length", F.lit(1025).cast("long")))


def test_packing_query(spark, data):
    documents = {r.doc_id: r.text for r in table(spark, data, "documents").collect()}
    rows = QUERIES["op8_packing"](spark, data).collect()
    assert {r.doc_id for r in rows} == set(documents)
    check_pieces(rows, documents)
    assert len({r.sequence_id for r in rows}) == plain_best_fit([r.length for r in rows])


def long_runs():
    """Runs of one sign beyond what the fast encoder takes, alone and between words, and a word of a
    million letters."""
    rnd = random.Random(5)
    runs = [sign * 2_000_000 for sign in (" ", "\n", "a", "%")]
    return [
        *runs, f"some words {runs[0]} and {runs[1]}more", " \t" * 700_000,
        "".join(rnd.choice("abcdefghij") for _ in range(1_000_000)),
    ]


def test_long_runs_as_the_library_has_them():
    some = long_runs()
    batch = pa.record_batch({
        "doc_id": list(range(len(some))), "text": some, "n_bytes": [len(t) for t in some],
    })
    path = public_tokenizers.path(BYTES)
    counts = tokens._lengths(path, batch).column("n_tokens").to_pylist()
    for text, count in zip(some[:-1], counts):
        wanted = ids(BYTES, text)
        assert own(BYTES).ids(text).tolist() == wanted and count == len(wanted)


@pytest.mark.parametrize("place", range(7))
def test_long_words_take_no_time(place):
    text = long_runs()[place]
    start = time.perf_counter()
    (found, decoded), = own(WORDS).encode([text])
    assert time.perf_counter() - start < 40
    if place < 6:
        wanted = ids(WORDS, text)
        assert found.tolist() == wanted
        assert decoded == library(WORDS).decode(wanted, skip_special_tokens=False)
