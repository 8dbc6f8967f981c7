"""The pipeline: each stage against plain Python on what the stage before kept."""

import random

import corpus_pipeline as pipeline
import pytest
from caselens.llm import classifier
from caselens.llm.common import landed, table
from samples import GAP, none, odd, prose, words
from test_quality import base
from test_simhash import brute_kept, changed
from test_tokens import check_pieces


@pytest.fixture(scope="module")
def steps(spark, data):
    """Every stage's rows, as doc_id to text, and the last one's pieces."""
    docs = table(spark, data, "documents")
    out = [{r.doc_id: r.text for r in docs.collect()}]
    for name, stage in pipeline.STAGES:
        columns = docs.columns
        docs = landed(stage(spark, docs, data))
        if name != "best_fit_packing":
            assert docs.columns == columns
            out.append({r.doc_id: r.text for r in docs.collect()})
    return [*out, docs.collect()]


def test_stages_are_named():
    names = [name for name, _ in pipeline.STAGES]
    assert names == ["quality_rules", "quality_classifier", "exact_dedup", "near_dedup",
                     "best_fit_packing"]


def test_rules_reject_just_the_base_failures(steps):
    assert steps[1] == {i: t for i, t in steps[0].items() if not base(t)[-1]}


def test_classifier_rejects_low_scores(spark, data, steps):
    docs = table(spark, data, "documents").filter(f"doc_id IN ({','.join(map(str, steps[1]))})")
    scores = classifier.scored(docs, table(spark, data, "labels")).collect()
    kept = {r.doc_id for r in scores if r.score >= pipeline.LEAST_QUALITY}
    assert set(steps[2]) == kept and set(kept) < set(steps[1])
    good = {r.doc_id for r in table(spark, data, "labels").filter("quality = 1").collect()}
    assert len(good & kept) >= 0.97 * len(good & set(steps[1]))


def test_one_of_each_equal_text_stays(steps):
    first = {}
    for i, text in sorted(steps[2].items()):
        first.setdefault(GAP.sub(" ", text or ""), i)
    assert set(steps[3]) == set(first.values())


def test_near_copies_go(steps):
    assert set(steps[4]) == brute_kept(steps[3])


def test_packing_holds_every_token(steps):
    assert {r.doc_id for r in steps[5]} == set(steps[4])
    check_pieces(steps[5], steps[4])


def test_run_is_the_stages(spark, data, steps):
    rows = pipeline.run(spark, data).collect()
    assert sorted((r.doc_id, r.piece, r.ids_crc32) for r in rows) == sorted(
        (r.doc_id, r.piece, r.ids_crc32) for r in steps[5]
    )


def test_planted_copies_go_and_clean_documents_stay(spark, data):
    """Groups of exact and near copies of clean prose: all bases stay, no exact copy does, and of the
    near copies only those whose fingerprints no links of three bits connect to another."""
    rnd, rows, bases = random.Random(4), [], set()
    for group in range(60):
        text = "\n".join(prose(7000 + group * 10 + k, 40) for k in range(4))
        bases.add(len(rows))
        rows.append((len(rows), text))
        for k in range(rnd.randrange(6)):
            copy = text if k % 2 else changed(text, group * 100 + k, 2)
            rows.append((len(rows), copy.replace(" ", "  ") if k == 3 else copy))
    docs = spark.createDataFrame(
        [(i, t, "en", f"s{i % 3}", len(t)) for i, t in rows],
        "doc_id long, text string, lang string, source string, n_chars long",
    )
    docs = pipeline.quality_rules(spark, docs, data)
    docs = pipeline.near_dedup(spark, pipeline.exact_dedup(spark, docs, data), data)
    kept = {r.doc_id for r in docs.collect()}
    first = {}
    for i, text in rows:
        first.setdefault(GAP.sub(" ", text), i)
    different = {i: text for text, i in first.items()}
    assert bases <= kept == brute_kept(different)


def test_odd_and_empty_tables(spark, data):
    for docs in (odd(spark), none(spark)):
        for name, stage in pipeline.STAGES[:-1]:
            columns = docs.columns
            docs = landed(stage(spark, docs, data))
            assert docs.columns == columns
        packed = pipeline.best_fit_packing(spark, docs, data)
        assert {r.doc_id for r in packed.collect()} == {r.doc_id for r in docs.collect()}
    assert words("a  b") == ["a", "b"]
