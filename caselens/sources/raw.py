"""Raw extracts: reading text slices, source-side filters and landed-row reconciliation."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caselens.params import ACTIVITY, BACKLOG, Params
from caselens.sources import schemas

# Unquoted field texts that the extract's reader takes as missing.
MISSING_TEXTS = (
    "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>",
    "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
# The text of a line that has too few or too many fields, and where a row lies in its extract.
TORN = "torn_line"
POSITION = ("source_file", "source_offset", "source_row")


def read_raw_csv(spark: SparkSession, path: str, *, multiline: bool = False) -> DataFrame:
    """Scan a raw extract with every column as text.

    ``multiline`` allows line breaks inside quoted fields, at the price of one task per file.
    """
    raw = spark.read.csv(
        path, schema=schemas.RAW, header=True, enforceSchema=False, escape='"',
        multiLine=multiline, mode="FAILFAST",
    )
    return raw.select(*_texts())


def _texts() -> list[Column]:
    columns = schemas.RAW_COLUMNS
    return [F.when(~F.col(c).isin(*MISSING_TEXTS), F.col(c)).alias(c) for c in columns]


def read_extract(spark: SparkSession, path: str, *, multiline: bool = False) -> DataFrame:
    """Scan a raw extract like :func:`read_raw_csv`, but a torn line does not end the job.

    ``torn_line`` is the text of a line with too few or too many fields and NULL in sound rows, see
    :func:`sound` and :func:`torn_lines`. ``source_file, source_offset, source_row`` order the rows as
    the extract has them, into however many tasks its files are split: the offset is where a split
    starts, and the row number grows within it.
    """
    reader = spark.read.option("columnPruning", False)  # else short lines would go unseen
    scanned = reader.csv(
        path, schema=schemas.RAW_OR_TORN, header=True, enforceSchema=False, escape='"',
        multiLine=multiline, mode="PERMISSIVE", columnNameOfCorruptRecord=TORN,
    )
    # Spark reads no file for this column alone, so it names a second one.
    torn = F.when(F.col(TORN).isNotNull() | F.col("unique_key").isNotNull(), F.col(TORN)).alias(TORN)
    place = (
        F.col("_metadata.file_path"), F.col("_metadata.file_block_start"),
        F.monotonically_increasing_id(),
    )
    return scanned.select(*_texts(), torn, *(c.alias(n) for c, n in zip(place, POSITION)))


def marked(extract: DataFrame) -> DataFrame:
    """Any raw rows with the columns ``read_extract`` adds, NULL where the rows have none."""
    kinds = {f.name: f.dataType for f in schemas.MARKS.fields}
    missing = {n: F.lit(None).cast(kinds[n]) for n in kinds if n not in extract.columns}
    return extract.withColumns(missing) if missing else extract


def sound(extract: DataFrame) -> DataFrame:
    """The rows of an extract whose lines are not torn."""
    return extract.filter(F.col(TORN).isNull()).drop(*schemas.MARKS.names)


def torn_lines(extract: DataFrame) -> DataFrame:
    """``(slice, source_file, torn_line)`` of the lines set apart."""
    return extract.filter(F.col(TORN).isNotNull()).select("slice", "source_file", TORN)


def prune(source: DataFrame) -> DataFrame:
    """Keep the 12 extract columns of a wider source."""
    return source.select(*schemas.RAW_COLUMNS)


def in_activity_window(created: Column, params: Params) -> Column:
    return (created >= F.lit(params.window_start)) & (created < F.lit(params.window_end))


def in_aged_backlog(created: Column, status: Column, params: Params) -> Column:
    """Older rows that are not Closed; a NULL status drops out."""
    older = (created >= F.lit(params.backlog_start)) & (created < F.lit(params.window_start))
    return older & (status != "Closed")


def _created() -> Column:
    """Creation time of a typed or a text source; no cast is left when it is a timestamp."""
    return F.col("created_date").try_cast("timestamp_ntz")


def activity_slice(source: DataFrame, params: Params) -> DataFrame:
    return prune(source.filter(in_activity_window(_created(), params)))


def backlog_slice(source: DataFrame, params: Params) -> DataFrame:
    return prune(source.filter(in_aged_backlog(_created(), F.col("status"), params)))


def label_slices(source: DataFrame, params: Params) -> DataFrame:
    """Both slices of one source in a single pass; rows in neither slice are dropped."""
    created, status = _created(), F.col("status")
    label = F.when(in_activity_window(created, params), ACTIVITY).when(
        in_aged_backlog(created, status, params), BACKLOG
    )
    labelled = source.withColumn("slice", label).filter(F.col("slice").isNotNull())
    return labelled.select(*schemas.RAW_COLUMNS, "slice")


def stack_slices(activity: DataFrame, backlog: DataFrame) -> DataFrame:
    """Concatenate both slices, each row tagged with its slice label."""
    return activity.withColumn("slice", F.lit(ACTIVITY)).unionByName(
        backlog.withColumn("slice", F.lit(BACKLOG))
    )


def slice_counts(landed: DataFrame) -> DataFrame:
    """``(slice, landed_rows)``."""
    return landed.groupBy("slice").agg(F.count(F.lit(1)).alias("landed_rows"))


def reconcile_counts(
    counts: DataFrame, expected: Mapping[str, int] | DataFrame, torn: DataFrame | None = None,
) -> DataFrame:
    """Compare the ``slice_counts`` of what landed with the counts that the source reported.

    ``expected`` is a mapping of slice to count, or a frame ``(slice, expected_rows)``. A slice that
    only one side knows counts 0 on the other; ``state`` is complete, short, over or unexpected.
    ``torn``, the :func:`torn_lines`, adds ``torn_rows``, and the state torn where they are all that
    is missing.
    """
    if not isinstance(expected, DataFrame):
        spark = counts.sparkSession
        expected = spark.createDataFrame(list(expected.items()), "slice string, expected_rows long")
    wanted, found = (F.coalesce(c, F.lit(0)) for c in ("expected_rows", "landed_rows"))
    gap = found - wanted
    state = (
        F.when(F.col("expected_rows").isNull(), "unexpected").when(gap == 0, "complete")
        .when(gap < 0, "short").otherwise("over")
    )
    both = expected.join(counts, "slice", "full")
    columns = [
        "slice", wanted.alias("expected_rows"), found.alias("landed_rows"), gap.alias("difference"),
    ]
    if torn is None:
        return both.select(*columns, state.alias("state"))
    lost = torn.groupBy("slice").agg(F.count(F.lit(1)).alias("torn_rows"))
    broken = F.coalesce("torn_rows", F.lit(0))
    only_torn = F.col("expected_rows").isNotNull() & (broken > 0) & (gap + broken == 0)
    return both.join(lost, "slice", "full").select(
        *columns, broken.alias("torn_rows"), F.when(only_torn, "torn").otherwise(state).alias("state")
    )
