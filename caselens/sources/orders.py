"""Service requests derived from an order schema.

Maps ``orders``, ``lineitem``, ``customer``, ``nation`` and ``region`` tables onto the request
layout, so the analysis can run on any dataset with that schema.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caselens.params import ACTIVITY, BACKLOG, UNSPECIFIED, Params
from caselens.sources.raw import in_activity_window
from caselens.sources.sla import SlaTargets, targets_from_rows

PARAMS = Params(
    snapshot_date=date(2001, 8, 5),
    window_start=date(2001, 5, 1),
    window_end=date(2001, 8, 1),
    backlog_start=date(1995, 1, 1),
    default_sla_days=700,
    min_cell=10,
    volume_floor=50,
)

PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
CHANNELS = ("PHONE", "ONLINE", "MOBILE", "UNKNOWN")
STATUSES = {"F": "Closed", "O": "Open", "P": "In Progress"}


def sla_rows() -> list[tuple[str, int, str]]:
    """Targets of 300 to 1440 days for 20 of the 25 types; one segment is left to the default."""
    listed = [s for s in SEGMENTS if s != "HOUSEHOLD"]
    rows = [
        (f"{priority} / {segment}", 300 + 60 * (i * len(listed) + j), "by priority and segment")
        for i, priority in enumerate(PRIORITIES)
        for j, segment in enumerate(listed)
    ]
    return rows + [("DEFAULT", PARAMS.default_sla_days, "fallback")]


def sla_targets(spark: SparkSession) -> SlaTargets:
    return targets_from_rows(spark, sla_rows(), PARAMS.default_sla_days)


# Only the columns that are used; a declared schema also spares a footer read per table.
TABLES = {
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp_ntz, "
    "o_orderpriority string",
    "lineitem": "l_orderkey long, l_linenumber int, l_shipdate timestamp_ntz",
    "customer": "c_custkey long, c_nationkey int, c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{folder}/{name}.parquet")


def _orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with customer, nation and region.

    Joined one table at a time so that the planner can size each of them: nation and region are
    broadcast, customer is broadcast or sort-merged (with AQE skew splitting) by its measured size.
    """
    orders, customer, nation, region = (
        table(spark, folder, name) for name in ("orders", "customer", "nation", "region")
    )
    return (
        orders.join(customer, F.col("o_custkey") == F.col("c_custkey"), "left")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
    )


def _pick(key: Column, options) -> Column:
    return F.element_at(F.array(*map(F.lit, options)), (key + 1).cast("int"))


def _status() -> Column:
    return F.expr(
        "CASE o_orderstatus " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in STATUSES.items())
        + " END"
    )


def _complaint_type() -> Column:
    return F.concat("o_orderpriority", F.lit(" / "), "c_mktsegment")


def requests(spark: SparkSession, folder: str, params: Params = PARAMS) -> DataFrame:
    """One clean request per order; it closes when its last line ships."""
    shipped = (
        table(spark, folder, "lineitem")
        .groupBy("l_orderkey")
        .agg(F.max("l_shipdate").alias("last_ship"))
    )
    rows = _orders(spark, folder).join(
        shipped, F.col("o_orderkey") == F.col("l_orderkey"), "left"
    )
    created = F.col("o_orderdate")
    unplaced = (F.col("c_nationkey") == 0) | F.col("r_name").isNull()
    zip_code = (
        F.when(F.col("o_orderkey") % 7 == 0, "")
        .when(F.col("o_orderkey") % 11 == 0, "ABC")
        .otherwise(F.lpad(F.col("o_custkey").cast("string"), 5, "0"))
    )
    return rows.select(
        F.col("o_orderkey").cast("string").alias("unique_key"),
        created.alias("created_date"),
        F.col("last_ship").alias("closed_date"),
        F.col("n_name").alias("agency"),
        F.concat(F.lit("Agency "), "n_name").alias("agency_name"),
        _complaint_type().alias("complaint_type"),
        F.col("o_orderpriority").alias("descriptor"),
        F.col("c_mktsegment").alias("location_type"),
        zip_code.alias("incident_zip"),
        F.when(unplaced, UNSPECIFIED).otherwise(F.col("r_name")).alias("borough"),
        _status().alias("status"),
        _pick(F.col("o_custkey") % 4, CHANNELS).alias("open_data_channel_type"),
        F.when(in_activity_window(created, params), ACTIVITY).otherwise(BACKLOG).alias("slice"),
    )


def raw_line_source(spark: SparkSession, folder: str) -> DataFrame:
    """Untidy text rows, one per order line, as an upstream system might hold them.

    Line numbers repeat inside an order, so keys are duplicated; text is padded, lower-cased or
    blank, zips carry suffixes and some dates do not parse.
    """
    rows = table(spark, folder, "lineitem").join(
        _orders(spark, folder), F.col("l_orderkey") == F.col("o_orderkey"), "left"
    )
    key = F.col("l_orderkey")
    tail = F.when(key % 9 == 0, "\t").otherwise(" ")
    iso = "yyyy-MM-dd'T'HH:mm:ss.SSS"
    closed = (
        F.when(key % 17 == 0, "not a date")
        .when(F.col("l_linenumber") == 7, F.lit(None))
        .otherwise(F.date_format("l_shipdate", iso))
    )
    borough = (
        F.when(F.col("c_nationkey") == 0, F.lit(None))
        .when(key % 13 == 0, "")
        .when(key % 19 == 0, " unspecified ")
        .otherwise(F.concat(F.lit("  "), F.upper("r_name"), tail))
    )
    return rows.select(
        F.concat(key.cast("string"), F.lit("-"), F.col("l_linenumber").cast("string")).alias(
            "unique_key"
        ),
        F.date_format("o_orderdate", iso).alias("created_date"),
        closed.alias("closed_date"),
        F.concat(F.lit(" "), "n_name").alias("agency"),
        F.concat(F.lit("Agency "), "n_name", F.lit("  ")).alias("agency_name"),
        F.concat(_complaint_type(), tail).alias("complaint_type"),
        F.when(key % 5 != 0, F.col("o_orderpriority")).alias("descriptor"),
        F.col("c_mktsegment").alias("location_type"),
        F.concat(F.lit(" "), F.lpad(F.col("o_custkey").cast("string"), 5, "0"), F.lit("-0001"))
        .alias("incident_zip"),
        borough.alias("borough"),
        _status().alias("status"),
        _pick(F.col("o_custkey") % 4, CHANNELS).alias("open_data_channel_type"),
        "o_custkey",
        "c_nationkey",
    )
