"""Ordering, top-k, shares and exact-size sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from caselens.functions import pct
from caselens.params import ACTIVITY
from caselens.sources import raw


def top(frame: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """First ``k`` rows of an order that must be total; runs as per-task top-k plus a merge."""
    return frame.orderBy(*order).limit(k)


def largest(frame: DataFrame, measure: str, k: int, *ties: str) -> DataFrame:
    """Top ``k`` by a measure, NULLs last, ties broken by the given columns."""
    return top(frame, [F.col(measure).desc_nulls_last(), *map(F.col, ties)], k)


def smallest(frame: DataFrame, measure: str, k: int, *ties: str) -> DataFrame:
    return top(frame, [F.col(measure).asc_nulls_last(), *map(F.col, ties)], k)


def whole() -> WindowSpec:
    """All rows as one window. Only for aggregated frames whose size is bounded by dimensions."""
    return Window.partitionBy()


def share_of_total(frame: DataFrame, measure: str, name: str, digits: int = 1) -> DataFrame:
    """Add ``100 * measure / sum(measure)`` over all rows of an aggregated frame."""
    total = F.sum(measure).over(whole())
    return frame.withColumn(name, pct(F.col(measure), total, digits))


def value_counts(frame: DataFrame, column: str, k: int | None = None) -> DataFrame:
    counts = frame.groupBy(column).agg(F.count(F.lit(1)).alias("requests"))
    return counts if k is None else largest(counts, "requests", k, column)


def preview(extract: DataFrame, rows: int = 2_000) -> DataFrame:
    """First unmodified rows of an extract that is ordered by unique_key, in one pass."""
    whole_row = F.to_json(F.struct(*extract.columns))
    return top(extract, [F.coalesce("unique_key", F.lit("")), whole_row], rows)


# Leading hex digits of the draw by which a sample's cut is found: at most 16 ** 4 counts.
_DIGITS = 4


def sample_exact(frame: DataFrame, key: str, rows: int, seed: int) -> DataFrame:
    """Exactly ``rows`` rows (all, if there are fewer) without replacement; same key, same draw.

    The rows with the smallest seeded hash of their key. A plain ``orderBy.limit`` would send up to
    ``rows`` rows of every task to one. The hash is uniform whatever the keys are, so one pass that
    counts its prefixes finds how far the draw reaches, and a second one sorts little more than
    ``rows`` rows.
    """
    if rows < 1:
        raise ValueError("row count must be positive")
    columns = frame.columns
    draw = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key), F.lit(""))))
    drawn = frame.withColumn("_draw", draw)
    prefix = F.substring("_draw", 1, _DIGITS)
    sizes = drawn.groupBy(prefix.alias("_prefix")).agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.orderBy("_prefix").rowsBetween(Window.unboundedPreceding, -1)
    seen = F.coalesce(F.sum("_n").over(earlier), F.lit(0))
    reach = (
        sizes.select("_prefix", seen.alias("_seen")).filter(F.col("_seen") < rows)
        .agg(F.max("_prefix"))
    )
    needed = drawn.filter(prefix <= reach.scalar())
    return top(needed, [F.col("_draw"), F.col(key)], rows).select(*columns)


def in_extract_order(drawn: DataFrame, scanned: DataFrame) -> DataFrame:
    """A sample of requests sorted as the extract has them: the activity slice first, each slice by
    the position of the first row with that key; rows without a position by key, before all others.

    ``scanned`` has the positions of :func:`caselens.sources.raw.read_extract`. Only rows of drawn
    keys are kept of it, so what is grouped and sorted grows with the sample.
    """
    keys = drawn.select(F.col("unique_key").alias("_key"), F.col("slice").alias("_slice"))
    same = F.col("unique_key").eqNullSafe(F.col("_key")) & (F.col("slice") == F.col("_slice"))
    found = scanned.select("unique_key", "slice", F.struct(*raw.POSITION).alias("_at"))
    first = (
        found.join(keys, same, "left_semi")
        .groupBy(F.col("unique_key").alias("_key"), F.col("slice").alias("_slice"))
        .agg(F.min("_at").alias("_at"))
    )
    order = (F.col("slice") != ACTIVITY, F.col("_at"), F.col("unique_key"))
    return drawn.join(first, same, "left").orderBy(*order).select(*drawn.columns)
