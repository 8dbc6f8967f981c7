"""Quality rules over whole texts and over the lines that documents of a host share."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caselens.llm.common import GAP, GAP_CHARS, landed, lower_ascii, text_or_empty, words

# The characters that count as symbols, and the words of a window.
SYMBOLS = "#*$%&|<>"
WINDOW = 5
# Of a line's variants: words of a window, windows of a sketch, and the share of their windows that a
# line and its variant have in common.
LINE_WINDOW, SKETCH, ALIKE = 3, 8, 0.3


@dataclass(frozen=True)
class Limits:
    """Base: fewest words, and highest percentage of words in repeated windows.

    Lines: a line is common in a host if more than ``line_documents`` different documents, and more
    than ``line_share`` of the host's different texts, have it. Copies count as one document, and so
    do near copies: those with the same lines once a line that is a variant of a frequent line, which
    the document lacks, stands for that line. How often a text was copied does not matter. A document
    is depleted if less than ``left_share`` of its line characters remain without common lines.
    """

    min_words: int = 10
    repeated_percent: int = 20
    line_documents: int = 20
    line_share: float = 0.001
    left_share: float = 0.1


def _let(value: str, name: str, body: str) -> str:
    """SQL that evaluates ``value`` once, however often ``body`` names it."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


# Hash of each window of an array of words ``w``; none with fewer words than a window has.
_WINDOWS = _let(
    "transform(w, x -> xxhash64(x))",
    "h",
    f"transform(slice(h, 1, greatest(size(h) - {WINDOW - 1}, 0)), (x, i) -> xxhash64("
    + ", ".join(["x", *(f"h[i + {k}]" for k in range(1, WINDOW))])
    + "))",
)
# Words inside windows that occur twice or more. Sorted (hash, position) pairs have equal windows
# side by side; the sorted positions of those add the words up to the next one, a window's at most.
_COVERED = _let(
    "array_sort(transform(g, (x, i) -> struct(x AS h, i AS i)))",
    "s",
    _let(
        "array_sort(transform(filter(s, (x, i) -> coalesce(get(s, i - 1).h = x.h, false)"
        " OR coalesce(get(s, i + 1).h = x.h, false)), x -> x.i))",
        "p",
        "aggregate(transform(p, (x, i) ->"
        f" CAST(least({WINDOW}, coalesce(get(p, i + 1) - x, {WINDOW})) AS BIGINT)),"
        " 0L, (a, b) -> a + b)",
    ),
)
# Only texts with a repeated window pay for the sorts.
_REPEATED = f"IF(size(array_distinct(g)) < size(g), {_COVERED}, 0L)"


def _length_without(text: Column, characters: str) -> Column:
    return F.length(F.translate(text, characters, "")).cast("long")


def _line_hash(line: Column) -> Column:
    return F.xxhash64(F.btrim(F.regexp_replace(lower_ascii(line), GAP, " ")))


def _windows_of(line: Column) -> Column:
    """Distinct hashes of the windows of a line; none with fewer words than a window has."""
    return F.element_at(
        F.transform(
            F.array(words(lower_ascii(line))),
            lambda w: F.array_distinct(
                F.transform(
                    F.slice(w, F.lit(1), F.greatest(F.size(w) - LINE_WINDOW + 1, F.lit(0))),
                    lambda x, i: F.hash(x, *(F.get(w, i + k) for k in range(1, LINE_WINDOW))),
                )
            ),
        ),
        1,
    )


def _has_word(line: Column) -> Column:
    return F.translate(line, GAP_CHARS, "") != ""


def _hosted(docs: DataFrame) -> DataFrame:
    return docs.select(
        "doc_id",
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("host"),
        text_or_empty().alias("text"),
    )


def measured(docs: DataFrame) -> DataFrame:
    """The base counts of each row, and ``lines``: hashes, length and sketch of every line with a word.

    One pass over the texts, landed as a narrow table. ``mark`` tells rows of one doc_id apart,
    ``body`` texts that differ in more than white space.
    """
    text = F.col("text")
    lines = F.filter(F.split(text, "\n"), _has_word)
    return landed(
        _hosted(docs)
        .withColumn("w", words(text))
        .withColumn("g", F.expr(_WINDOWS))
        .select(
            "doc_id",
            "host",
            F.xxhash64("text").alias("mark"),
            F.xxhash64("w").alias("body"),
            F.size("w").cast("long").alias("n_words"),
            _length_without(text, GAP_CHARS).alias("word_chars"),
            (F.length(text) - _length_without(text, SYMBOLS)).alias("n_symbols"),
            F.expr(_REPEATED).alias("n_repeat_words"),
            F.transform(
                lines,
                lambda line: F.struct(
                    _line_hash(line).alias("h"),
                    F.length(line).alias("n"),
                    F.xxhash64(line).alias("exact"),
                    F.slice(F.sort_array(_windows_of(line)), 1, SKETCH).alias("sketch"),
                ),
            ).alias("lines"),
        )
    )


def _above(seen: DataFrame, sizes: DataFrame, limits: Limits) -> DataFrame:
    """``(host, h)`` of the lines that enough of the distinct ``seen (host, h, document)`` have."""
    return (
        seen.groupBy("host", "h")
        .agg(F.count(F.lit(1)).alias("documents"))
        .filter(F.col("documents") > limits.line_documents)
        .join(sizes, "host")
        .filter(F.col("documents") > limits.line_share * F.col("texts"))
        .select("host", "h")
    )


def _variants(held: DataFrame, frequent: DataFrame) -> DataFrame:
    """``(host, h, frequent)``: the lines that are a variant of a frequent line.

    ``held (host, h, sketch)`` has one row a line; a sketch holds the smallest hashes of its windows.
    A line meets no more than one frequent line for each of these, and has to share ``ALIKE`` of the
    smallest windows of both with it, which are all of them in short lines.
    """
    lines = held.filter(F.size("sketch") > 0)
    known = landed(lines.join(frequent, ["host", "h"], "left_semi"))
    window = F.explode("sketch").alias("window")
    stands = known.select("host", "h", window).groupBy("host", "window").agg(
        F.min("h").alias("frequent")
    )
    met = (
        lines.join(frequent, ["host", "h"], "left_anti").select("host", "h", "sketch", window)
        .join(stands, ["host", "window"])
        .groupBy("host", "h", "frequent").agg(F.first("sketch").alias("sketch"))
    )
    theirs = known.select("host", F.col("h").alias("frequent"), F.col("sketch").alias("theirs"))
    least = F.slice(F.sort_array(F.array_union("sketch", "theirs")), 1, SKETCH)
    both = F.size(F.array_intersect(F.array_intersect("sketch", "theirs"), least))
    return (
        met.join(theirs, ["host", "frequent"]).filter(both >= ALIKE * F.size(least))
        .groupBy("host", "h").agg(F.min("frequent").alias("frequent"))
    )


def _documents(rows: DataFrame, seen: DataFrame, frequent: DataFrame) -> DataFrame:
    """``(host, body, document)`` of the texts with a frequent line; texts that have the same lines,
    up to variants of frequent lines that they lack, are one document."""
    holders = seen.select("host", "body").distinct()
    lines = landed(
        rows.select("host", "body", F.explode("lines").alias("line"))
        .select("host", "body", F.col("line.h").alias("h"), F.col("line.sketch").alias("sketch"))
        .join(holders, ["host", "body"], "left_semi")
        .groupBy("host", "body", "h").agg(F.first("sketch").alias("sketch"))
    )
    each = landed(lines.groupBy("host", "h").agg(F.first("sketch").alias("sketch")))
    variants = _variants(each, frequent)
    line = F.struct("h", "frequent")
    own = F.col("own.h")
    stands = F.transform(
        "own",
        lambda x: F.when(
            x["frequent"].isNotNull() & ~F.array_contains(own, x["frequent"]), x["frequent"]
        ).otherwise(x["h"]),
    )
    return (
        lines.select("host", "body", "h").join(variants, ["host", "h"], "left")
        .groupBy("host", "body").agg(F.collect_set(line).alias("own"))
        .select(
            "host", "body", F.xxhash64(F.sort_array(F.array_distinct(stands))).alias("document")
        )
    )


def common_lines(rows: DataFrame, limits: Limits) -> DataFrame:
    """``(host, h)`` of the lines above the limits; counts are combined before each shuffle.

    Lines that enough different texts have are few; only for their texts near copies are told.
    """
    sizes = rows.select("host", "body").distinct().groupBy("host").agg(
        F.count(F.lit(1)).alias("texts")
    )
    held = rows.select("host", "body", F.explode(F.array_distinct("lines.h")).alias("h")).distinct()
    frequent = landed(_above(held, sizes, limits))
    if frequent.isEmpty():
        return frequent
    seen = landed(held.join(frequent, ["host", "h"], "left_semi"))
    documents = _documents(rows, seen, frequent)
    told = seen.join(documents, ["host", "body"]).select("host", "h", "document").distinct()
    return _above(told, sizes, limits)


def _removed(rows: DataFrame, limits: Limits) -> DataFrame:
    """``(doc_id, mark, gone, hashes)``: characters and hashes of the common lines of each row."""
    placed = rows.select("doc_id", "mark", "host", F.posexplode("lines").alias("at", "line"))
    return (
        placed.select("doc_id", "mark", "host", "at", F.col("line.h").alias("h"), "line.n")
        .join(common_lines(rows, limits), ["host", "h"])
        .groupBy("doc_id", "mark", "at")
        .agg(F.min("h").alias("h"), F.min("n").alias("n"))
        .groupBy("doc_id", "mark")
        .agg(F.sum("n").alias("gone"), F.collect_set("h").alias("hashes"))
    )


def _same_row(a: str, b: str) -> Column:
    return F.col(f"{a}.doc_id").eqNullSafe(F.col(f"{b}.doc_id")) & (
        F.col(f"{a}.mark") == F.col(f"{b}.mark")
    )


def _judged(docs: DataFrame, limits: Limits) -> DataFrame:
    rows = measured(docs)
    gone = _removed(rows, limits).select("doc_id", "mark", "gone")
    failed = (F.col("n_words") < limits.min_words) | (
        100 * F.col("n_repeat_words") > limits.repeated_percent * F.col("n_words")
    )
    counted = rows.select(
        "doc_id", "mark", "n_words", "word_chars", "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines.exact"))).cast("long")
        .alias("n_dup_lines"),
        "n_repeat_words",
        failed.alias("base_failed"),
        F.aggregate("lines.n", F.lit(0).cast("long"), lambda a, n: a + n).alias("line_chars"),
    )
    return counted.alias("r").join(gone.alias("g"), _same_row("r", "g"), "left").select(
        "r.*", F.coalesce("gone", F.lit(0)).cast("long").alias("gone_chars")
    ).withColumn(
        "kept",
        ~F.col("base_failed")
        & (F.col("line_chars") - F.col("gone_chars") >= limits.left_share * F.col("line_chars")),
    )


def judged(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """The verdict of each row of ``docs (doc_id, text, source, ...)``, rejected ones too.

    Columns ``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    line_chars, gone_chars, kept``. A NULL text counts as empty and fails the base; rows without a
    source are one host; a NULL doc_id is a value like any other. Repeated rows each get a row,
    other columns are not looked at, no rows give none.
    """
    return _judged(docs, limits).drop("mark")


def _marked(docs: DataFrame) -> DataFrame:
    """Each whole row as one column, so that its column names clash with none."""
    row = F.struct(*(docs[c] for c in docs.columns)).alias("row")
    return docs.select(row, "doc_id", F.xxhash64(text_or_empty()).alias("mark"))


def kept_rows(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """The rows of ``docs`` that pass, with their columns and whole texts."""
    passed = _judged(docs, limits).filter("kept").select("doc_id", "mark")
    return _marked(docs).alias("r").join(passed.alias("p"), _same_row("r", "p"), "left_semi").select(
        "row.*"
    )


def without_common_lines(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """``docs`` with the common lines of its host taken out of each ``text``."""
    gone = _removed(measured(docs), limits).select("doc_id", "mark", "hashes")
    left = F.array_join(
        F.filter(
            F.split(F.col("row.text"), "\n"),
            lambda line: ~F.array_contains(F.col("hashes"), _line_hash(line)),
        ),
        "\n",
    )
    text = F.when(F.col("hashes").isNull(), F.col("row.text")).otherwise(left)
    joined = _marked(docs).alias("r").join(gone.alias("g"), _same_row("r", "g"), "left")
    return joined.select(F.col("row").withField("text", text).alias("row")).select("row.*")
