"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# Settings the jobs rely on. Shuffle partitions are left to the cluster: AQE coalesces a generous
# number, so it is only lowered for local runs.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A hot join key is split once its partition is this large (it must exceed the advisory size).
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128MB",
    # Call-site capture for error messages costs more than planning does here.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str, master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """A new folder, visible to every executor, for tables written to cut lineage.

    It lies in the shared folder that the cluster names in ``spark.checkpoint.dir``, or else below
    the warehouse, which every session has.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/caselens-{uuid.uuid4().hex}"
