"""Light preparation of raw text rows: types, text normalisation, de-duplication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caselens.functions import strip_text, title_text
from caselens.params import ACTIVITY, UNSPECIFIED, Params
from caselens.sources import schemas

_PLAIN_TEXT = (
    "agency", "status", "complaint_type", "descriptor", "agency_name", "location_type",
    "open_data_channel_type",
)


def parse_time(text: Column) -> Column:
    """Zone-less timestamp; text that does not parse becomes NULL."""
    return text.try_cast("timestamp_ntz")


def clean_borough(stripped: Column) -> Column:
    """Blank and any casing of "unspecified" become Unspecified; the rest is title-cased."""
    blank = (stripped == "") | (F.upper(stripped) == UNSPECIFIED.upper())
    return F.when(blank, UNSPECIFIED).otherwise(title_text(stripped))


def clean(raw: DataFrame, *others: str) -> DataFrame:
    """Raw text rows (with their slice label) to the typed request layout, and ``others`` as they are."""
    stripped = raw.withColumns(
        {
            "created_date": parse_time(F.col("created_date")),
            "closed_date": parse_time(F.col("closed_date")),
            "incident_zip": F.substring(strip_text(F.col("incident_zip")), 1, 5),
            **{name: strip_text(F.col(name)) for name in ("borough", *_PLAIN_TEXT)},
        }
    )
    # A step of its own, because the stripped text is needed three times.
    titled = stripped.withColumn("borough", clean_borough(F.col("borough")))
    return titled.select(*schemas.REQUESTS.names, *others)


def deduplicate(requests: DataFrame) -> DataFrame:
    """One row per unique_key: the activity slice wins over the backlog, then a row whose
    created_date parsed, then the smallest row.

    Keys are counted first, which needs no more than a hash aggregate; rows whose key is alone pass
    unsorted, and only copies go through ``min(struct)``. That combines them before the shuffle, so
    a key with very many copies never has to be collected into one task.
    """
    rest = [name for name in requests.columns if name not in ("unique_key", "slice")]
    rank = F.when(F.col("slice") == ACTIVITY, 0).otherwise(1).alias("_rank")
    undated = F.col("created_date").isNull().alias("_undated")
    repeated = (
        requests.groupBy(F.col("unique_key").alias("_key")).count().filter("count > 1").select("_key")
    )
    same = F.col("unique_key").eqNullSafe(F.col("_key"))
    first = F.min(F.struct(rank, "slice", undated, *rest)).alias("_first")
    kept = requests.join(repeated, same, "left_semi").groupBy("unique_key").agg(first).select(
        *(
            F.col("unique_key") if name == "unique_key" else F.col(f"_first.{name}")
            for name in requests.columns
        )
    )
    return requests.join(repeated, same, "left_anti").unionByName(kept)


def extract_metadata(
    counts: DataFrame, requests: DataFrame, sample_rows: int, params: Params
) -> DataFrame:
    """``(item, value)`` of an extract, see :func:`metadata_of`; the requests are counted."""
    total = requests.agg(F.count(F.lit(1)).cast("double").alias("rows"))
    return metadata_of(counts, total, sample_rows, params)


def metadata_of(
    counts: DataFrame, total: DataFrame, sample_rows: int, params: Params
) -> DataFrame:
    """``(item, value)``: the snapshot as a yyyymmdd number, rows per slice before de-duplication
    (``slice, landed_rows``), the ``total (rows)`` after it, and the sample scaling factor."""
    per_slice = counts.select(
        F.col("slice").alias("item"), F.col("landed_rows").cast("double").alias("value")
    )
    rows = F.col("rows")
    drawn = F.least(rows, F.lit(float(sample_rows)))
    items = {
        "snapshot_date": F.lit(float(f"{params.snapshot_date:%Y%m%d}")),
        "total_after_dedup": rows,
        "sample_rows": drawn,
        "scaling_factor": F.try_divide(rows, drawn),
    }
    pairs = F.create_map(*(part for item in items.items() for part in (F.lit(item[0]), item[1])))
    return per_slice.unionByName(total.select(F.explode(pairs).alias("item", "value")))
