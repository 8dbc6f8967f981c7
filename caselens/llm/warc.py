"""WARC archives of pages and a Merkle audit of their replicas."""

from __future__ import annotations

import gzip
import re
from collections.abc import Iterator
from functools import reduce
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caselens.llm.common import in_arrow, landed

# Bytes of one volume before compression, and children of a node of the trees.
VOLUME_BYTES = 1 << 24
FANOUT = 32
DATE = "2026-01-01T00:00:00Z"
_BLANK = "\r\n\r\n"
_HEADER = re.compile(rb"WARC/1\.0\r\n(?:[^\r\n]+\r\n)*?Content-Length: (\d+)\r\n(?:[^\r\n]+\r\n)*\r\n")
_PAGE = re.compile(rb"\r\nX-Page-Id: (-?\d+)\r\n")
_SCHEMA = "volume long, ordinal long, page_id long, begin long, end long, digest binary"


# --- archives ------------------------------------------------------------------------------------


def records(pages: DataFrame) -> DataFrame:
    """``(page_id, url, record)``: each page as one WARC record without its closing lines.

    A NULL url or html counts as empty; line breaks in an url become spaces, as a header is a line.
    """
    body = F.coalesce(F.col("html").cast("string"), F.lit(""))
    url = F.regexp_replace(F.coalesce(F.col("url").cast("string"), F.lit("")), r"[\r\n]+", " ")
    page = F.coalesce(F.col("page_id").cast("string"), F.lit(""))
    name = F.md5(F.concat_ws("\n", page, url, body))
    uuid = F.concat_ws(
        "-", *(F.substring(name, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))
    )
    lines = (
        F.lit("WARC/1.0"), F.lit("WARC-Type: resource"), F.concat(F.lit("WARC-Target-URI: "), url),
        F.lit(f"WARC-Date: {DATE}"), F.concat(F.lit("WARC-Record-ID: <urn:uuid:"), uuid, F.lit(">")),
        F.when(page != "", F.concat(F.lit("X-Page-Id: "), page)),
        F.lit("Content-Type: text/html"),
        F.concat(F.lit("Content-Length: "), F.octet_length(body).cast("string")),
    )
    return pages.select(
        "page_id", url.alias("url"),
        F.concat(F.concat_ws("\r\n", *lines), F.lit(_BLANK), body).alias("record"),
    )


def _volume_of(path: Column) -> Column:
    return F.regexp_extract(path, r"/volume=(\d+)/", 1).cast("long")


def _written(rows: DataFrame, path: str) -> None:
    """One compressed file per volume and task, ``volume=N/part-*.txt.gz``, in the order of the rows.

    Spark's text writer ends each value with the two closing lines that the format asks for, so
    executors need nothing but the file system that Spark uses.
    """
    (
        rows.write.partitionBy("volume").option("lineSep", _BLANK).option("compression", "gzip")
        .text(path)
    )


def write_archive(pages: DataFrame, path: str, volume_bytes: int = VOLUME_BYTES) -> None:
    """Archive all ``pages (page_id, url, html)`` in volumes of about ``volume_bytes``, each in the
    order of page_id, url and record. Records are dealt by a hash of the whole of them."""
    total = pages.agg(F.sum(F.octet_length("html").cast("long"))).first()[0] or 0
    volumes = max(1, -(-total // volume_bytes))
    volume = F.pmod(F.xxhash64("page_id", "record"), F.lit(volumes)).alias("volume")
    _written(
        records(pages).select("*", volume).repartition("volume")
        .sortWithinPartitions("volume", "page_id", "url", "record")
        .select("volume", "record"),
        path,
    )


def copy_archive(
    spark: SparkSession, path: str, copy: str, body: Column | None = None
) -> None:
    """A replica of an archive, byte for byte and without a shuffle; an expression of ``body`` may
    change the bodies of records on the way, for drills. A volume that ends within a record gets the
    closing lines."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    parts = files.filter("length > 0").select(
        _volume_of(F.col("path")).alias("volume"), "content"
    ).transform(in_arrow, _values, "volume long, at long, head binary, body binary")
    texts = parts.select(
        "volume", "at", F.col("head").cast("string"), F.col("body").cast("string")
    )
    changed = F.col("body") if body is None else body
    _written(
        texts.select("volume", "at", F.concat("head", changed).alias("value"))
        .sortWithinPartitions("volume", "at").select("volume", "value"),
        copy,
    )


def _cut(content: bytes) -> Iterator[tuple[int, int, int | None]]:
    """Begin, end and page of each record; bytes that are no record are one without a page."""
    at = 0
    while at < len(content):
        head = _HEADER.match(content, at)
        if head is None:
            following = _HEADER.search(content, at)
            end, page = following.start() if following else len(content), None
        else:
            end = min(len(content), head.end() + int(head[1]) + len(_BLANK))
            page = _PAGE.search(content, at, head.end())
        yield at, end, int(page[1]) if page else None
        at = end


def _values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Head and body of each record, without the closing lines. What is no record, or goes on without
    these lines, belongs to the head of what follows."""
    blank = _BLANK.encode()
    for batch in batches:
        for volume, packed in zip(batch.column("volume"), batch.column("content")):
            content = gzip.decompress(packed.as_py())
            rows, start = [], 0
            for begin, end, _ in _cut(content):
                if content.endswith(blank, begin, end):
                    stop = end - len(blank)
                elif end == len(content):
                    stop = end
                else:
                    continue
                found = _HEADER.match(content, begin, stop)
                middle = found.end() if found else stop
                rows.append((content[start:middle], content[middle:stop]))
                start = end
            for at in range(0, len(rows), 1 << 10):
                heads, bodies = zip(*rows[at : at + (1 << 10)])
                yield pa.record_batch({
                    "volume": pa.array([volume.as_py()] * len(heads), pa.int64()),
                    "at": pa.array(range(at, at + len(heads)), pa.int64()),
                    "head": pa.array(heads, pa.binary()), "body": pa.array(bodies, pa.binary()),
                })


def _leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for volume, packed in zip(batch.column("volume"), batch.column("content")):
            content = gzip.decompress(packed.as_py())
            rows = [
                (volume.as_py(), i, page, begin, end, sha256(b"\0" + content[begin:end]).digest())
                for i, (begin, end, page) in enumerate(_cut(content))
            ]
            if rows:
                names = ("volume", "ordinal", "page_id", "begin", "end", "digest")
                types = (pa.int64(),) * 5 + (pa.binary(),)
                columns = [pa.array(c, t) for c, t in zip(zip(*rows), types)]
                yield pa.RecordBatch.from_arrays(columns, list(names))


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Each record's place in an archive and the hash of its bytes. Volumes are read whole."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    found = files.filter("length > 0").select(_volume_of(F.col("path")).alias("volume"), "content")
    return found.transform(in_arrow, _leaves, _SCHEMA)


# --- trees ---------------------------------------------------------------------------------------

_NODE = ("level", "volume", "node", "parent_volume", "parent", "begin", "end", "digest")
# Stands for the volume of the nodes above the volumes' roots.
_ABOVE = -1


def _parents(level: DataFrame) -> DataFrame:
    """The next level: each node hashes its children's hashes in order and spans their ranges."""
    children = F.array_sort(F.collect_list(F.struct("node", "volume", "digest")))
    joined = F.aggregate(
        children, F.unhex(F.lit("01")), lambda a, child: F.concat(a, child["digest"])
    )
    return level.groupBy("parent_volume", "parent").agg(
        F.min("begin").alias("begin"), F.max("end").alias("end"),
        F.unhex(F.sha2(joined, 256)).alias("digest"),
    ).select(F.col("parent_volume").alias("volume"), F.col("parent").alias("node"), "begin", "end",
             "digest")


def _with_parent(nodes: DataFrame, level: int, inner: int, fanout: int) -> DataFrame:
    """Levels up to ``inner`` stand inside a volume; above, volumes are the nodes."""
    inside = level < inner
    node = F.col("node") if level != inner else F.col("volume")
    volume = F.col("volume") if inside else F.lit(_ABOVE).cast("long")
    return nodes.withColumns(
        {
            "level": F.lit(level), "parent_volume": volume,
            "parent": F.floor(node / fanout).cast("long"),
        }
    ).select(*_NODE)


def _height(count: int, fanout: int) -> int:
    levels = 0
    while count > 1:
        count, levels = -(-count // fanout), levels + 1
    return levels


def tree(leaves: DataFrame, inner: int, outer: int, fanout: int = FANOUT) -> DataFrame:
    """All nodes over the records of an archive: ``inner`` levels in each volume up to its root, then
    ``outer`` levels over the volumes up to the one root. A node spans an ordered range of offsets,
    above the volumes' roots of volumes."""
    level = leaves.select("volume", F.col("ordinal").alias("node"), "begin", "end", "digest")
    levels = []
    for number in range(inner + outer + 1):
        levels.append(_with_parent(level, number, inner, fanout))
        level = _parents(levels[-1])
    return reduce(DataFrame.union, levels)


def _differing(a: DataFrame, b: DataFrame) -> DataFrame:
    """Nodes that are not the same in both trees, with what is wrong in the second."""
    left, right = (t.select("volume", "node", F.col("digest").alias(n))
                   for t, n in ((a, "ours"), (b, "theirs")))
    both = left.join(right, ["volume", "node"], "full")
    wrong = F.when(F.col("theirs").isNull(), "missing").when(F.col("ours").isNull(), "extra")
    return both.filter(~F.col("ours").eqNullSafe(F.col("theirs"))).select(
        "volume", "node", wrong.otherwise("corrupt").alias("status")
    )


def _below(nodes: DataFrame, wrong: DataFrame, level: int) -> DataFrame:
    parents = wrong.select(
        F.col("volume").alias("parent_volume"), F.col("node").alias("parent")
    )
    return nodes.filter(F.col("level") == level).join(
        parents, ["parent_volume", "parent"], "left_semi"
    )


def damaged(ours: DataFrame, theirs: DataFrame, top: int) -> DataFrame:
    """``(volume, node, status)`` of the records that differ between two trees.

    Roots are compared first; only the children of nodes that differ are compared on the next level,
    so equal replicas cost one comparison and few damages a path each.
    """
    wrong = landed(
        _differing(ours.filter(F.col("level") == top), theirs.filter(F.col("level") == top))
    )
    for level in range(top - 1, -1, -1):
        if wrong.isEmpty():
            break
        wrong = landed(_differing(_below(ours, wrong, level), _below(theirs, wrong, level)))
    return wrong


def audited(spark: SparkSession, path: str, replica: str, fanout: int = FANOUT) -> DataFrame:
    """Each record of the archive at ``path`` and whether the one at ``replica`` still has it.

    ``(volume, ordinal, page_id, begin, end, digest, status)``: offsets in the uncompressed volume,
    the hash of the record's bytes, and intact, corrupt, missing (not in the replica), or extra (only
    there; then the columns describe the replica's). Records are matched by their place in a volume,
    so one that is left out shifts the following ones of its volume. Empty archives give no rows.
    """
    a, b = landed(read_records(spark, path)), landed(read_records(spark, replica))
    sizes = a.union(b).agg(F.max("ordinal"), F.max("volume")).first()
    if sizes[0] is None:
        return a.withColumn("status", F.lit("intact"))
    inner, outer = (_height(size + 1, fanout) for size in sizes)
    trees = [landed(tree(leaves, inner, outer, fanout)) for leaves in (a, b)]
    wrong = damaged(*trees, inner + outer).select(
        "volume", F.col("node").alias("ordinal"), "status"
    )
    place = ["volume", "ordinal"]
    status = F.coalesce("status", F.lit("intact")).alias("status")
    kept = a.join(wrong, place, "left").select(*a.columns, status)
    extra = b.join(wrong.filter("status = 'extra'"), place).select(*a.columns, "status")
    return kept.union(extra)
