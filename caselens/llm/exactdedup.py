"""Exact de-duplication by a stream whose state remembers every digest for good."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caselens.llm.common import GAP, landed, text_or_empty
from caselens.session import shared_folder

# Files that one micro-batch takes at most.
FILES_AT_ONCE = 4096
# A file that is dated so long before the newest one seen is still read.
FILE_AGE = "36500d"
# Rows of one group that are compared by one task at most, about.
ROWS_PER_SALT = 4096
# The state lives in RocksDB on the executors' disks, with bounded memory, and its changes in the
# checkpoint folder; without a watermark nothing in it expires. Space is not reserved ahead, which
# would cost megabytes for each partition of the state however little it holds.
_STATE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def normalised(text: Column) -> Column:
    return F.regexp_replace(text, GAP, " ")


def sha256(body: Column) -> Column:
    return F.unhex(F.sha2(F.encode(body, "UTF-8"), 256))


def _located(rows: DataFrame, digest: Callable[[Column], Column]) -> DataFrame:
    """Rows by digest, with where their text lies: the file and the row in it."""
    body = normalised(text_or_empty())
    return rows.select(
        "doc_id",
        digest(body).alias("digest"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.row_index").alias("row"),
        body.alias("body"),
    )


def _first() -> Column:
    """Smallest doc_id, NULL last; of equal ones the first in place."""
    return F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "file", "row"))


def _as_pattern(path: str) -> str:
    """A pattern that only this path fits. A stream takes a pattern for one file or for a folder of
    files, but a plain path for a folder only."""
    path = path.rstrip("/")
    return f"{path[:-1]}[{path[-1]}]"


def remember(
    spark: SparkSession, path: str, schema: T.StructType, checkpoint: str,
    digest: Callable[[Column], Column] = sha256, files_at_once: int = FILES_AT_ONCE,
) -> None:
    """Stream the Parquet files below ``path`` into the state at ``checkpoint``, once each.

    The state keeps, per digest, the identifier and locator of the row that stays and the number of
    rows. Copies are combined before the shuffle, so that a group of many rows is one state update
    per task. A second call with the same checkpoint only reads new files, whatever their date;
    a failed one goes on.
    """
    session = spark.newSession()
    for key, value in _STATE.items():
        session.conf.set(key, value)
    for key in ("spark.sql.shuffle.partitions", "spark.sql.session.timeZone"):
        session.conf.set(key, spark.conf.get(key))
    source = (
        session.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_at_once)
        .option("maxFileAge", FILE_AGE)
    )
    groups = (
        _located(source.parquet(_as_pattern(path)), digest)
        .groupBy("digest")
        .agg(_first().alias("first"), F.count(F.lit(1)).alias("size"))
    )
    query = (
        groups.writeStream.format("noop").outputMode("update")
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()


def remembered(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The state as a table ``(digest, first, size)``, one row per digest."""
    state = spark.read.format("statestore").load(checkpoint)
    return state.select(
        "key.digest", F.col("value.min").alias("first"), F.col("value.count").alias("size")
    )


def _stays() -> Column:
    return (F.col("file") == F.col("first.file")) & (F.col("row") == F.col("first.row"))


def _unequal(rows: DataFrame, known: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All rows of groups of two and more, and the digests among them that stand for several texts.

    Every hit's whole bytes are compared with those at the locator that the state keeps. A large
    group is dealt over salts, to each of which its one kept text is sent.
    """
    several = known.filter("size > 1")
    hits = landed(rows.join(several, "digest"))
    salts = F.floor(F.col("size") / ROWS_PER_SALT)
    kept = hits.filter(_stays()).select(
        "digest", F.explode(F.sequence(F.lit(0).cast("long"), salts)).alias("salt"),
        F.col("body").alias("kept_body"),
    )
    others = hits.filter(~_stays()).withColumn(
        "salt", F.pmod(F.xxhash64("file", "row"), salts + 1)
    )
    differ = others.join(kept, ["digest", "salt"]).filter("body <> kept_body")
    return hits, landed(differ.select("digest").distinct())


def _verified(
    spark: SparkSession, path: str, schema: T.StructType, digest: Callable[[Column], Column],
    files_at_once: int,
) -> DataFrame:
    """``(doc_id, digest, file, row, first, size)`` of every row: its group's kept row and size."""
    checkpoint = shared_folder(spark)
    remember(spark, path, schema, checkpoint, digest, files_at_once)
    known = landed(remembered(spark, checkpoint))
    rows = _located(spark.read.schema(schema).parquet(path), digest)
    hits, torn = _unequal(rows, known)
    found = rows.drop("body").join(known, "digest")
    if torn.isEmpty():
        return found
    # A digest that stands for several texts: group its rows by their whole texts instead.
    bodies = hits.drop("first", "size").join(torn, "digest", "left_semi")
    exact = bodies.groupBy("digest", "body").agg(
        _first().alias("first"), F.count(F.lit(1)).alias("size")
    )
    mended = bodies.join(exact, ["digest", "body"]).select(found.columns)
    return found.join(torn, "digest", "left_anti").unionByName(mended)


def exact_groups(
    spark: SparkSession, path: str, digest: Callable[[Column], Column] = sha256,
    files_at_once: int = FILES_AT_ONCE,
) -> DataFrame:
    """``(doc_id, keep_id, group_size, kept, text_sha256)`` for each row of the Parquet at ``path``.

    Texts are equal if they are identical after each run of white space became one space; NULL
    counts as empty. Of equal texts the row with the smallest doc_id stays; of rows that share it,
    and of those without a doc_id (they come last), the first in place. Repeated rows are copies.
    Other columns are not looked at. No rows give none. ``path`` must hold ``doc_id`` and ``text``.
    """
    schema = spark.read.parquet(path).select("doc_id", "text").schema
    found = _verified(spark, path, schema, digest, files_at_once)
    if digest is not sha256:
        return found.select(
            "doc_id", F.col("first.doc_id").alias("keep_id"), F.col("size").alias("group_size"),
            _stays().alias("kept"),
        )
    return found.select(
        "doc_id",
        F.col("first.doc_id").alias("keep_id"),
        F.col("size").alias("group_size"),
        _stays().alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def kept_rows(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns. The rows are landed to be streamed."""
    spark, path = docs.sparkSession, shared_folder(docs.sparkSession)
    docs.write.parquet(path)
    schema = docs.select("doc_id", "text").schema
    found = _verified(spark, path, schema, sha256, FILES_AT_ONCE)
    stay = found.filter(_stays()).select(
        F.col("file").alias("kept_file"), F.col("row").alias("kept_row")
    )
    rows = spark.read.schema(docs.schema).parquet(path)
    at = (rows["_metadata.file_path"] == stay["kept_file"]) & (
        rows["_metadata.row_index"] == stay["kept_row"]
    )
    return rows.join(stay, at, "left_semi")
