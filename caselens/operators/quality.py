"""The nine-check data-quality gate."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caselens.functions import pct
from caselens.params import UNSPECIFIED, Params

# Check names and notes are part of the published output.
CHECKS = {
    "duplicates": (
        "01 duplicate unique_key",
        "each service request should appear exactly once",
    ),
    "no_created": (
        "02 missing created_date",
        "created_date is required for every downstream metric",
    ),
    "closed_undated": (
        "03 closed status but no closed_date",
        "these rows are excluded from closure-time metrics",
    ),
    "dated_unclosed": (
        "04 closed_date but status not Closed",
        "status/closed_date disagreement — closure logic uses closed_date",
    ),
    "reversed": (
        "05 closed before created (invalid sequence)",
        "negative closure times are excluded from closure-time metrics",
    ),
    "future": (
        "06 closed in the future (after snapshot)",
        "closure timestamps later than the extract snapshot",
    ),
    "no_borough": (
        "07 borough missing/unspecified",
        'kept, reported as their own "Unspecified" borough',
    ),
    "no_type": (
        "08 missing complaint_type",
        "complaint_type drives SLA mapping and priority scoring",
    ),
    "bad_zip": (
        "09 zip not 5 digits (where present)",
        "zip is descriptive only and not used in KPI logic",
    ),
}


def row_flags(params: Params) -> dict:
    """The eight checks that can be decided on a single row."""
    created, closed, status = F.col("created_date"), F.col("closed_date"), F.col("status")
    borough, kind, zip_code = F.col("borough"), F.col("complaint_type"), F.col("incident_zip")
    return {
        "no_created": created.isNull(),
        "closed_undated": (status == "Closed") & closed.isNull(),
        "dated_unclosed": closed.isNotNull() & (status != "Closed"),
        "reversed": closed < created,
        "future": closed > F.lit(params.closed_before),
        "no_borough": borough.isNull() | (borough == UNSPECIFIED),
        "no_type": kind.isNull() | (kind == ""),
        "bad_zip": (zip_code != "") & ~zip_code.rlike("^[0-9]{5}$"),
    }


def dq_checks(requests: DataFrame, params: Params) -> DataFrame:
    """``check_name, records_flagged, pct_of_total, note``; order by check_name to present.

    One scan: the rows of a key are counted together with their flags, as nothing but numbers, and
    the counts of all keys are added up.
    """
    flags = row_flags(params)
    per_key = requests.groupBy("unique_key").agg(
        F.count(F.lit(1)).alias("copies"),
        *(F.count_if(test).alias(name) for name, test in flags.items()),
    )
    # COUNT(DISTINCT) ignores NULL, so every row without a key counts as a duplicate.
    spare = F.when(F.col("unique_key").isNull(), F.col("copies")).otherwise(F.col("copies") - 1)
    sums = {"rows": F.col("copies"), "duplicates": spare, **{name: F.col(name) for name in flags}}
    counted = per_key.agg(
        *(F.coalesce(F.sum(value), F.lit(0)).alias(name) for name, value in sums.items())
    ).select(
        "rows",
        F.explode(
            F.create_map(*(part for name in CHECKS for part in (F.lit(name), F.col(name))))
        ).alias("check", "records_flagged"),
    )
    labels = {key: (F.lit(name), F.lit(note)) for key, (name, note) in CHECKS.items()}

    def label(position: int):
        pairs = [part for key, texts in labels.items() for part in (F.lit(key), texts[position])]
        return F.element_at(F.create_map(*pairs), F.col("check"))

    return counted.select(
        label(0).alias("check_name"),
        "records_flagged",
        pct(F.col("records_flagged"), F.col("rows"), 3).alias("pct_of_total"),
        label(1).alias("note"),
    )


def reconcile_totals(rollups: dict[str, DataFrame], measure: str = "total_requests") -> DataFrame:
    """The same measure summed over several rollups must agree.

    Returns ``rollup, total, matches`` where ``matches`` compares with the largest total.
    """
    totals = [
        frame.agg(F.lit(name).alias("rollup"), F.sum(measure).alias("total"))
        for name, frame in rollups.items()
    ]
    return _compared(reduce(DataFrame.unionByName, totals))


def _compared(totals: DataFrame) -> DataFrame:
    return totals.withColumn(
        "matches", F.col("total") == F.max("total").over(Window.partitionBy())
    )


def reconcile_groupings(enriched: DataFrame, dims: Sequence[str]) -> DataFrame:
    """The same check over the requests themselves: counted per value of each dimension in one scan,
    the counts added up per dimension. ``rollup, total, matches`` as above, one row a dimension."""
    counted = enriched.groupingSets([[F.col(d)] for d in dims], *dims).agg(
        F.count(F.lit(1)).alias("total"), F.grouping_id().cast("int").alias("_set")
    )
    # All bits of the grouping id are set but that of the one dimension.
    every = (1 << len(dims)) - 1
    names = F.create_map(
        *(x for i, d in enumerate(dims) for x in (F.lit(every - (1 << (len(dims) - 1 - i))), F.lit(d)))
    )
    totals = counted.groupBy("_set").agg(F.sum("total").alias("total")).select(
        F.element_at(names, F.col("_set")).alias("rollup"), "total"
    )
    return _compared(totals)
