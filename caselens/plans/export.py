"""Batch run: raw extracts to clean table, fact, rollups and star-schema exports."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caselens.operators import cleaning, ranking, rollups
from caselens.operators.enrich import enrich
from caselens.params import Params
from caselens.session import shared_folder
from caselens.sources import raw, schemas, tables
from caselens.sources.calendar import dim_date
from caselens.sources.sla import SlaTargets

SAMPLE_ROWS = 100_000
SAMPLE_SEED = 42

# Export name -> (format, schema).
EXPORTS = {
    "fact_service_requests": ("parquet", schemas.ENRICHED),
    "kpi_by_agency": ("csv", schemas.KPI_BY_AGENCY),
    "kpi_by_complaint_type": ("csv", schemas.KPI_BY_COMPLAINT_TYPE),
    "kpi_by_borough": ("csv", schemas.KPI_BY_BOROUGH),
    "kpi_weekly": ("csv", schemas.KPI_WEEKLY),
    "backlog_aging": ("csv", schemas.BACKLOG_AGING),
    "priority_scores": ("csv", schemas.PRIORITY_SCORES),
    "dim_sla_targets": ("csv", schemas.SLA_TARGETS),
    "dim_date": ("csv", schemas.DIM_DATE),
}


@dataclass(frozen=True)
class Prepared:
    """Tables written by :func:`prepare`."""

    requests: DataFrame
    slice_counts: DataFrame
    metadata: DataFrame
    sample: DataFrame
    preview: DataFrame
    torn_lines: DataFrame


def prepare(
    activity: DataFrame, backlog: DataFrame, params: Params, folder: str, *,
    sample_rows: int = SAMPLE_ROWS, seed: int = SAMPLE_SEED,
) -> Prepared:
    """Raw slices to a clean request table, a sample in the order of the extracts, a raw preview,
    extract metadata and the torn lines, which are in none of the others.

    The text is parsed once into a scratch table; counts, positions, torn lines and de-duplication
    read that.
    """
    spark = activity.sparkSession
    scratch = shared_folder(spark)
    activity, backlog = raw.marked(activity), raw.marked(backlog)
    stacked = raw.stack_slices(activity, backlog)
    tables.write_parquet(cleaning.clean(stacked, *schemas.MARKS.names), f"{scratch}/scanned")
    scanned = tables.read_parquet(spark, f"{scratch}/scanned", schemas.SCANNED)
    landed = raw.sound(scanned)
    counts = raw.slice_counts(landed)
    rows = tables.Rows()
    tables.write_parquet(cleaning.deduplicate(landed), f"{folder}/service_requests", rows=rows)
    requests = tables.read_parquet(spark, f"{folder}/service_requests", schemas.REQUESTS)
    tables.write_parquet(
        ranking.sample_exact(requests, "unique_key", sample_rows, seed), f"{scratch}/drawn"
    )
    drawn = tables.read_parquet(spark, f"{scratch}/drawn", schemas.REQUESTS)
    sample = ranking.in_extract_order(drawn, scanned.filter(F.col(raw.TORN).isNull()))
    tables.write_csv(sample, f"{folder}/sample")
    tables.write_csv(ranking.preview(raw.sound(activity)), f"{folder}/raw_preview")
    total = spark.createDataFrame([(float(rows.number()),)], "rows double")
    metadata = cleaning.metadata_of(counts, total, sample_rows, params)
    tables.write_csv(metadata, f"{folder}/extract_metadata")
    return Prepared(
        requests,
        counts,
        tables.read_csv(spark, f"{folder}/extract_metadata", schemas.EXTRACT_METADATA),
        tables.read_csv(spark, f"{folder}/sample", schemas.REQUESTS),
        tables.read_csv(spark, f"{folder}/raw_preview", schemas.RAW),
        raw.torn_lines(scanned),
    )


def write_fact(
    requests: DataFrame, sla: SlaTargets, params: Params, folder: str,
    rows: tables.Rows | None = None,
) -> DataFrame:
    """Enrich and write the fact once, partitioned by month, and read it back typed."""
    path = f"{folder}/fact_service_requests"
    tables.write_parquet(enrich(requests, sla, params), path, "created_month", rows)
    return tables.read_parquet(requests.sparkSession, path, schemas.ENRICHED)


@dataclass(frozen=True)
class Exported:
    """The written fact, the rollups made from it, and how many rows each table has."""

    fact: DataFrame
    rollups: dict[str, DataFrame]
    manifest: DataFrame


def export_all(requests: DataFrame, sla: SlaTargets, params: Params, folder: str) -> Exported:
    """Write the fact, the rollups and the dimensions.

    The rollups come from one scan of the written fact; all rows are counted while they are written.
    """
    spark = requests.sparkSession
    rows = tables.Rows()
    fact = write_fact(requests, sla, params, folder, rows)
    made = rollups.from_one_scan(fact, params)
    small = {
        **made,
        "dim_sla_targets": sla.frame,
        "dim_date": dim_date(spark, params.backlog_start, params.window_end),
    }
    counts = {"fact_service_requests": rows.number(), **write_all(small, folder)}
    return Exported(fact, made, manifest(spark, counts))


def export(requests: DataFrame, sla: SlaTargets, params: Params, folder: str) -> DataFrame:
    """Write everything; return ``table_name, format, row_count``."""
    return export_all(requests, sla, params, folder).manifest


def write_all(frames: dict[str, DataFrame], folder: str) -> dict[str, int]:
    """Write each frame whole as CSV below ``folder``; the rows of each.

    Small independent jobs: submitted together they overlap instead of queueing.
    """
    spark = next(iter(frames.values())).sparkSession
    rows = {name: tables.Rows() for name in frames}
    with ThreadPoolExecutor(max_workers=4) as pool:
        write = inheritable_thread_target(spark)(tables.write_csv)
        jobs = [
            pool.submit(write, frame, f"{folder}/{name}", rows[name])
            for name, frame in frames.items()
        ]
    for job in jobs:
        job.result()
    return {name: taken.number() for name, taken in rows.items()}


def read_export(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Typed load of one exported table."""
    kind, schema = EXPORTS[name]
    reader = tables.read_parquet if kind == "parquet" else tables.read_csv
    return reader(spark, f"{folder}/{name}", schema)


def manifest(spark: SparkSession, counts: dict[str, int]) -> DataFrame:
    """Row counts of the exported tables as they were taken while writing."""
    return spark.createDataFrame(
        [(name, kind, counts[name]) for name, (kind, _) in EXPORTS.items()],
        "table_name string, format string, row_count long",
    )
