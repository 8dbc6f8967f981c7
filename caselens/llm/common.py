"""What the operators share: table reads, scratch tables and the definition of a word."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caselens.session import shared_folder

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
# What separates words, as a regular expression and as characters.
GAP = r"[\x20\x09-\x0D]+"
GAP_CHARS = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# What becomes of each byte of a text of terms: A-Z are lowered, other ASCII signs are gaps.
_TERM_BYTES = bytes(
    b if b >= 128 or chr(b).isalnum() else 32 for b in bytes(range(256)).lower()
)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def landed(frame: DataFrame) -> DataFrame:
    """The frame written to a new folder that all executors share, and read again.

    This cuts the lineage with a durable table: a lost executor costs no earlier stage.
    """
    spark = frame.sparkSession
    path = shared_folder(spark)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def lower_ascii(text: Column) -> Column:
    """Only A-Z are lowered; other letters stay as they are."""
    return F.translate(text, UPPER, LOWER)


def words(text: Column) -> Column:
    """Array of the words of a text without NULLs, in order."""
    return F.filter(F.split(text, GAP), lambda word: word != "")


def terms(text: bytes) -> list[bytes]:
    """The terms of a UTF-8 text in order: runs of letters, digits and non-ASCII characters. Only
    A-Z are lowered."""
    return text.translate(_TERM_BYTES).split()


def share_package(spark: SparkSession) -> None:
    """Let Python workers find this package where the driver has it, if they share a disk.

    On a cluster the package is installed or shipped with the job, and the path does no harm.
    """
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if _ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([_ROOT, *filter(None, paths)])


def in_arrow(frame: DataFrame, function: Callable, schema) -> DataFrame:
    """``mapInArrow`` whose workers find this package."""
    share_package(frame.sparkSession)
    return frame.mapInArrow(function, schema)


def per_batch(
    function: Callable[[pa.RecordBatch], pa.RecordBatch | None],
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Lift a function of one Arrow batch to what ``mapInArrow`` takes; empty batches are skipped."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                out = function(batch)
                if out is not None and out.num_rows:
                    yield out

    return run
