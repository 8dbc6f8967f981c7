"""Weighted request counts, from which every KPI is computed.

A measure is a weighted aggregate over rows that stand for ``n`` requests each. Without a median,
every request is such a row with n = 1: one hash aggregate with map-side combine gives all measures
of a report. Only the median needs a profile first, counts per dimension, state and closure_days,
so that no group of requests is ever collected.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caselens.functions import ratio, round_half
from caselens.params import AGED_BUCKETS, MISSED, OPEN_PAST, OPEN_WITHIN, UNSPECIFIED
from caselens.session import shared_folder

SUMS = ("n", "closure_n", "closure_sum", "age_n", "age_sum")
_STATE = ("is_closed", "sla_status", "aging_bucket")


def profile(
    enriched: DataFrame, dims: Sequence[str | Column], *, by_closure_days: bool = False
) -> DataFrame:
    """Counts ``n`` per dims x state, with the sums needed for averages.

    ``by_closure_days`` also keeps closure_days as a key, which the median needs.
    """
    keys = [*dims, *_STATE] + (["closure_days"] if by_closure_days else [])
    return enriched.groupBy(*keys).agg(*_sums())


def _sums() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("n"),
        F.count("closure_days").alias("closure_n"),
        F.sum("closure_days").alias("closure_sum"),
        F.count("age_days").alias("age_n"),
        F.sum("age_days").alias("age_sum"),
    ]


@dataclass(frozen=True)
class Grouping:
    """One of several profiles that are made together. ``labels`` maps a name to the column whose
    smallest value is reported under it."""

    dims: tuple[str, ...]
    by_closure_days: bool = False
    labels: Mapping[str, str] = field(default_factory=dict)

    def keys(self) -> list[str]:
        return [*self.dims, *_STATE, *(["closure_days"] if self.by_closure_days else [])]


def profiles(enriched: DataFrame, groupings: Mapping[str, Grouping]) -> dict[str, DataFrame]:
    """The profile of each grouping, all from one scan and one shuffle.

    The result is a table in the shared folder, from which each profile is a filter.
    """
    keys, ids, made = grouped(enriched, groupings)
    spark, path = enriched.sparkSession, shared_folder(enriched.sparkSession)
    made.write.parquet(path)
    stored = spark.read.schema(made.schema).parquet(path)
    held = _label_sets(groupings, keys)
    columns = [c for c in made.columns if c not in (*SUMS, "_set")]
    found = {}
    for name, g in groupings.items():
        rows = stored.filter(F.col("_set") == ids[name])
        labels = [F.col(column).alias(label) for label, column in g.labels.items()]
        if name in held:
            tell = stored.filter(F.col("_set") == _set_id(columns, held[name]))
            found[name] = _with_labels(rows.select(*keys[name], *SUMS), tell, g)
        else:
            found[name] = rows.select(*g.keys(), *SUMS, *labels)
    return found


def _with_labels(rows: DataFrame, tell: DataFrame, grouping: Grouping) -> DataFrame:
    """A profile with its labels, the smallest values per dims in the coarser profile ``tell``."""
    dims = {c: f"_of_{c}" for c in grouping.dims}
    values = tell.groupBy(*(F.col(c).alias(of) for c, of in dims.items())).agg(
        *(F.min(column).alias(f"_label_{label}") for label, column in grouping.labels.items())
    )
    same = reduce(and_, (F.col(c).eqNullSafe(F.col(of)) for c, of in dims.items()), F.lit(True))
    return rows.join(values, same, "left").select(
        *rows.columns, *(F.col(f"_label_{label}").alias(label) for label in grouping.labels)
    )


def _label_sets(
    groupings: Mapping[str, Grouping], keys: Mapping[str, list[str]]
) -> dict[str, list[str]]:
    """Columns of the set that tells the labels of a grouping by closure_days: one of the other
    groupings if it has them, else a set of their own."""
    others = [keys[name] for name, g in groupings.items() if not g.by_closure_days]
    wanted = {
        name: list(dict.fromkeys([*g.dims, *g.labels.values()]))
        for name, g in groupings.items() if g.by_closure_days and g.labels
    }
    return {
        name: next((k for k in others if set(some) <= set(k)), some) for name, some in wanted.items()
    }


def _set_id(columns: Sequence[str], some: Sequence[str]) -> int:
    """A bit of the grouping id is set where a column, the first one highest, is not in the set."""
    return sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in some)


def grouped(
    enriched: DataFrame, groupings: Mapping[str, Grouping]
) -> tuple[dict[str, list[str]], dict[str, int], DataFrame]:
    """Keys and number of each grouping, and one aggregation for all of them.

    The rows are expanded by grouping sets and combined before the shuffle, so what travels is no more
    than the sum of the groupings' domains. Labels are keys, of a set without closure_days, since the
    smallest of texts would have all expanded rows sorted, where sums of numbers are hashed.
    """
    if len({(frozenset(g.dims), g.by_closure_days) for g in groupings.values()}) < len(groupings):
        raise ValueError(f"two groupings have the same columns: {sorted(groupings)}")
    keys = {
        name: g.keys() if g.by_closure_days else list(dict.fromkeys([*g.keys(), *g.labels.values()]))
        for name, g in groupings.items()
    }
    sets = [*keys.values(), *_label_sets(groupings, keys).values()]
    columns = list(dict.fromkeys(c for some in sets for c in some))
    ids = {name: _set_id(columns, some) for name, some in keys.items()}
    distinct = {_set_id(columns, some): some for some in sets}
    made = enriched.groupingSets([[F.col(c) for c in some] for some in distinct.values()], *columns).agg(
        *_sums(), F.grouping_id().cast("long").alias("_set"),
    )
    return keys, ids, made


def rows_where(test: Column | None = None) -> Column:
    """Number of requests in a profile, optionally only those that pass ``test``."""
    weight = F.col("n") if test is None else F.when(test, F.col("n")).otherwise(F.lit(0))
    return F.coalesce(F.sum(weight), F.lit(0))


def is_open() -> Column:
    return ~F.col("is_closed")


def is_missed() -> Column:
    return F.col("sla_status").isin(MISSED, OPEN_PAST)


def is_known() -> Column:
    return F.col("sla_status") != OPEN_WITHIN


def is_aged() -> Column:
    return is_open() & F.col("aging_bucket").isin(*AGED_BUCKETS)


def is_placed() -> Column:
    return F.col("borough") != UNSPECIFIED


def miss_rate(digits: int | None = 4) -> Column:
    return ratio(rows_where(is_missed()), rows_where(is_known()), digits)


def aged_share(digits: int | None = 4) -> Column:
    return ratio(rows_where(is_aged()), rows_where(is_open()), digits)


def mean_closure(digits: int | None = 1) -> Column:
    return ratio(F.sum("closure_sum"), F.sum("closure_n"), digits)


def mean_age(digits: int | None = 1) -> Column:
    return ratio(F.sum("age_sum"), F.sum("age_n"), digits)


def median_closure(digits: int | None = 1) -> Column:
    """Exact interpolated median over a profile that was made ``by_closure_days``."""
    value = F.percentile("closure_days", F.lit(0.5), F.col("n"))
    return value if digits is None else round_half(value, digits)


def sketched_median(accuracy: int, digits: int | None = 1) -> Column:
    """Median of the enriched frame's requests from a mergeable digest of bounded size, in the one
    shuffle of the other measures: a value whose rank is off by at most 1 / accuracy of the group."""
    value = F.percentile_approx("closure_days", 0.5, accuracy).cast("double")
    return value if digits is None else round_half(value, digits)


def single(enriched: DataFrame) -> DataFrame:
    """Each request as a row of a profile, without a shuffle."""
    closed, age = F.col("closure_days"), F.col("age_days")
    return enriched.withColumns(
        {
            "n": F.lit(1).cast("long"),
            "closure_n": closed.isNotNull().cast("long"),
            "closure_sum": closed,
            "age_n": age.isNotNull().cast("long"),
            "age_sum": age,
        }
    )


def summarise(
    source: DataFrame, dims: Sequence[str], measures: Mapping[str, Column], *,
    median: bool = False, labels: Mapping[str, str] | None = None, counted: bool = False,
) -> DataFrame:
    """Evaluate named measures per dims combination.

    ``source`` is the enriched frame or, if ``counted``, a finer profile of it (made
    ``by_closure_days`` if a median is wanted). ``labels`` maps an output name to a column that is
    reported by its smallest value per group.
    """
    labels = labels or {}
    if counted:
        rows = source
    elif median:
        extra = [name for name in labels.values() if name not in dims]
        rows = profile(source, [*dims, *extra], by_closure_days=True)
    else:
        rows = single(source)
    named = [F.min(column).alias(name) for name, column in labels.items()]
    named += [column.alias(name) for name, column in measures.items()]
    return rows.groupBy(*dims).agg(*named)
