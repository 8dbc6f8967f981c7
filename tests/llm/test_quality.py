"""Quality rules: base counts, common lines and verdicts against plain Python."""

import re
import string
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from caselens.llm import quality
from caselens.llm.common import table
from caselens.llm.queries import QUERIES
from samples import none, odd, prose, words


def base(text):
    text = text or ""
    found = words(text)
    lines = [line for line in text.split("\n") if words(line)]
    windows = [tuple(found[i : i + 5]) for i in range(len(found) - 4)]
    twice = {w for w, n in Counter(windows).items() if n > 1}
    covered = {i + k for i, w in enumerate(windows) if w in twice for k in range(5)}
    failed = len(found) < 10 or 100 * len(covered) > 20 * len(found)
    return (
        len(found), sum(map(len, found)), len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)), len(covered), failed,
    )


COUNTS = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
          "base_failed")


def test_base_of_odd_rows(spark):
    docs = odd(spark, ["a b c d e f g h i j\n" * 3, "x y z p q r " * 2 + prose(9, 80)])
    found = [tuple(r[c] for c in COUNTS) for r in quality.judged(docs).collect()]
    wanted = [(r.doc_id, *base(r.text)) for r in docs.collect()]
    assert sorted(map(str, found)) == sorted(map(str, wanted))
    assert quality.judged(none(spark)).collect() == []
    assert quality.kept_rows(none(spark)).collect() == []


def corpus():
    """A line in 30 documents, a text made of little else, and 200 copies and near copies of one."""
    footer = "Subscribe to our letter and never miss a thing again"
    rows = [(i, prose(i, 60) + "\n" + footer + "\n" + prose(500 + i, 60), "h") for i in range(30)]
    rows += [(100, footer.upper() + " \n" + footer + "\nalso this bit here", "h"),
             (101, footer + "\n" + footer, "elsewhere")]
    lines = [prose(900 + k, 30) for k in range(4)]
    rows += [(200 + i, "\n".join(lines), "h") for i in range(60)]
    for i in range(140):
        found = words("\n".join(lines))
        found[i % 120] = f"changed{i}"
        text = "\n".join(" ".join(found[30 * k : 30 * k + 30]) for k in range(4))
        rows.append((300 + i, text, "h"))
    return rows, footer


def test_boilerplate_is_found_and_copies_are_not(spark):
    rows, footer = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    limits = quality.Limits(left_share=0.3)
    found = {r.doc_id: r for r in quality.judged(docs, limits).collect()}
    assert [i for i, r in found.items() if not r.kept and not r.base_failed] == [100]
    assert all(found[i].gone_chars == len(footer) for i in range(30))
    assert not any(found[i].gone_chars for i in (101, *range(200, 260), *range(300, 440)))
    kept = quality.kept_rows(docs, limits)
    assert {r.doc_id for r in kept.collect()} == {i for i, r in found.items() if r.kept}
    cleaned = {r.doc_id: r.text for r in quality.without_common_lines(docs, limits).collect()}
    assert cleaned[0] == rows[0][1].replace("\n" + footer, "")
    assert cleaned[100] == "also this bit here" and cleaned[101] == rows[31][1]


def _plain_common(rows, limits):
    """Common lines as ``(host, line)`` by the definition, in plain Python."""
    def clean(line):
        return " ".join(words(line.translate(str.maketrans(string.ascii_uppercase, string.ascii_lowercase))))

    def windows(line):
        w = line.split(" ")
        return {tuple(w[i : i + 3]) for i in range(len(w) - 2)}

    texts = {(host, tuple(words(text))): [clean(x) for x in text.split("\n") if words(x)]
             for _, text, host in rows}
    sizes = Counter(host for host, _ in texts)

    def above(documents):
        seen = defaultdict(set)
        for key, lines in texts.items():
            for line in lines:
                seen[key[0], line].add(documents[key])
        return {k for k, v in seen.items()
                if len(v) > limits.line_documents and len(v) > limits.line_share * sizes[k[0]]}

    frequent = above({key: key for key in texts})
    documents = {}
    for key, lines in texts.items():
        own, out = set(lines), set()
        for line in own:
            like = [f for h, f in frequent if h == key[0] and line not in {x for _, x in frequent}
                    and windows(line) and len(windows(line) & windows(f))
                    >= quality.ALIKE * len(windows(line) | windows(f))]
            out.add(like[0] if like and like[0] not in own else line)
        documents[key] = (key[0], frozenset(out))
    return above(documents)


def test_common_lines_and_verdicts_follow_their_definition(spark):
    """Texts, near copies, lines and hosts in plain Python."""
    rows, _ = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    limits = quality.Limits(line_documents=3, left_share=0.3)
    wanted = _plain_common(rows, limits)
    hashed = docs.sparkSession.createDataFrame(sorted(wanted), "host string, line string").select(
        "host", quality._line_hash(F.col("line")))
    got = quality.common_lines(quality.measured(docs), limits)
    assert {tuple(r) for r in got.collect()} == {tuple(r) for r in hashed.collect()}
    kept = {r.doc_id: (r.kept, r.gone_chars) for r in quality.judged(docs, limits).collect()}
    for i, text, host in rows:
        lines = [x for x in text.split("\n") if words(x)]
        gone = sum(len(x) for x in lines if (host, " ".join(words(x.lower()))) in wanted)
        whole = sum(map(len, lines))
        assert kept[i] == (not base(text)[-1] and whole - gone >= 0.3 * whole, gone)


@pytest.mark.parametrize("own", ["unrelated", "shares a window", "changes a word"])
def test_own_lines_tell_documents_apart(spark, own):
    """1,000 documents of thirteen footer lines and one line of their own, and copies of one."""
    footer = [prose(50 + k, 14, 10**6) for k in range(13)]

    def line(i):
        found = words(footer[i % 13])
        if own == "unrelated":
            return prose(9000 + i, 12, 10**6)
        if own == "shares a window":
            return " ".join(found[:3] + words(prose(9000 + i, 9, 10**6)))
        return " ".join([*found[:5], f"own{i}", *found[6:]])

    rows = [(i, "\n".join([*footer, line(i)]), "h") for i in range(1000)]
    rows += [(2000 + k, rows[0][1], "h") for k in range(50)]
    rows += [(5000 + i, prose(5000 + i, 100, 10**6), "h") for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = {r.doc_id: r.kept for r in quality.judged(docs).collect()}
    assert {i for i, kept in found.items() if not kept} == {*range(1000), *range(2000, 2050)}


def test_kept_rows_keep_columns_and_repeats(spark):
    docs = odd(spark)
    kept = quality.kept_rows(docs)
    assert kept.columns == docs.columns
    ids = sorted(r.doc_id for r in kept.collect())
    assert ids.count(6) == 2 and set(ids) >= {8, 9, 18} and 0 not in ids


def test_query(spark, data):
    texts = {r.doc_id: r.text for r in table(spark, data, "documents").collect()}
    rows = QUERIES["op3_quality_rules"](spark, data).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        assert tuple(r[c] for c in COUNTS[1:]) == base(texts[r.doc_id])
        assert not (r.kept and r.base_failed)


def test_pages_that_are_mostly_one_passage_are_different(spark):
    """1,000 different pages of 95 % the same footer, in one line or in nineteen."""
    for lines in (1, 19):
        found = words(prose(1, 190, 10**6))
        size = 190 // lines
        footer = [" ".join(found[i : i + size]) for i in range(0, 190, size)]
        rows = [(i, "\n".join([*footer, prose(100 + i, 10, 10**6)]), "h") for i in range(1000)]
        rows += [(5000 + i, prose(5000 + i, 100, 10**6), "h") for i in range(50)]
        docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
        found = {r.doc_id: r for r in quality.judged(docs).collect()}
        assert not any(r.base_failed for r in found.values())
        assert {i for i, r in found.items() if not r.kept} == set(range(1000))
        assert all(found[i].gone_chars == sum(map(len, footer)) for i in range(1000))


def test_copies_of_one_page_hide_no_line(spark):
    """A footer in 100 different documents and 900 copies and near copies of one page with it."""
    footer = "Subscribe to our letter and never miss a thing again"
    rows = [(i, prose(i, 60) + "\n" + footer, "h") for i in range(100)]
    lines = [prose(9000 + k, 30) for k in range(4)]
    for i in range(900):
        found = words("\n".join(lines))
        if i % 3 == 0:
            found[i % 120] = f"changed{i}"
        page = [" ".join(found[30 * k : 30 * k + 30]) for k in range(4)]
        rows.append((1000 + i, "\n".join([*page, footer]), "h"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = quality.judged(docs).collect()
    assert {r.gone_chars for r in found} == {len(footer)}
    assert all(r.kept for r in found)
