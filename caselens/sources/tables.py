"""Table sinks and typed reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Stands for a quoted empty text while a CSV is read, where Spark would otherwise give NULL.
_EMPTY = "\x01"


class Rows:
    """Number of rows of a write, taken while it runs.

    The count is a metric of the tasks that write: it needs no scan of its own, and a task that is
    tried again counts once.
    """

    def __init__(self) -> None:
        self._seen = Observation()

    def of(self, frame: DataFrame) -> DataFrame:
        return frame.observe(self._seen, F.count(F.lit(1)).alias("rows"))

    def number(self) -> int:
        """Known once the write is done."""
        return self._seen.get.get("rows", 0)


def write_parquet(
    frame: DataFrame, path: str, partition_by: str | None = None, rows: Rows | None = None
) -> str:
    """ZSTD Parquet. A partitioned table is rebalanced by its key first: AQE splits a hot value
    over several tasks and merges small ones, which keeps file sizes even. ``rows`` gets the count."""
    if partition_by:
        frame = frame.hint("rebalance", partition_by)
    # Above the exchange, in the tasks that write.
    frame = rows.of(frame) if rows else frame
    writer = frame.write.mode("overwrite").option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return path


def write_csv(
    frame: DataFrame, path: str, rows: Rows | None = None, compression: str | None = None
) -> str:
    frame = rows.of(frame) if rows else frame
    writer = frame.write.mode("overwrite").option("header", True).option("escape", '"')
    if compression:
        writer = writer.option("compression", compression)
    writer.csv(path)
    return path


def read_parquet(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Typed CSV load. A quoted empty text stays '', an empty field is NULL."""
    frame = spark.read.csv(
        path, schema=schema, header=True, enforceSchema=False, escape='"', emptyValue=_EMPTY,
        mode="FAILFAST",
    )
    texts = {f.name for f in schema.fields if isinstance(f.dataType, T.StringType)}
    return frame.withColumns(
        {name: F.when(F.col(name) == _EMPTY, "").otherwise(F.col(name)) for name in texts}
    )
