"""SLA targets: a small lookup of days per complaint type with a DEFAULT row."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caselens.sources import schemas

DEFAULT_KEY = "DEFAULT"

# The published assumption table (complaint type, days, rationale).
PUBLISHED_TARGETS = (
    ("Noise - Residential", 1, "Quality-of-life response expected same/next day"),
    ("Noise - Street/Sidewalk", 1, "Quality-of-life response expected same/next day"),
    ("Noise - Commercial", 1, "Quality-of-life response expected same/next day"),
    ("Noise - Vehicle", 1, "Quality-of-life response expected same/next day"),
    ("Noise", 3, "General noise reports allow brief triage window"),
    ("Illegal Parking", 1, "Time-sensitive; violation is transient"),
    ("Blocked Driveway", 1, "Time-sensitive; resident access blocked"),
    ("Abandoned Vehicle", 7, "Requires verification then tow scheduling"),
    ("Derelict Vehicles", 7, "Requires verification then tow scheduling"),
    ("Traffic Signal Condition", 2, "Safety-critical infrastructure"),
    ("Street Light Condition", 10, "Safety-relevant; crew dispatch cycle"),
    ("Missed Collection", 3, "Next scheduled collection cycle"),
    ("Dirty Condition", 7, "Cleaning crew dispatch cycle"),
    ("Rodent", 14, "Inspection scheduling window"),
    ("UNSANITARY CONDITION", 30, "Housing inspection process"),
    ("HEAT/HOT WATER", 14, "Habitability issue; inspection plus follow-up"),
    ("PLUMBING", 30, "Housing inspection process"),
    ("PAINT/PLASTER", 30, "Housing inspection process"),
    ("DOOR/WINDOW", 30, "Housing inspection process"),
    ("ELECTRIC", 30, "Housing inspection process"),
    ("GENERAL", 30, "Housing inspection process"),
    ("Water System", 7, "Utility issue; leak/quality response"),
    ("Sewer", 7, "Utility issue; overflow risk"),
    ("Street Condition", 30, "Roadway repair scheduling"),
    ("Sidewalk Condition", 90, "Long-cycle capital-adjacent repairs"),
    ("Graffiti", 60, "Non-urgent remediation program"),
    ("Food Establishment", 14, "Health inspection scheduling"),
    ("Consumer Complaint", 30, "Case-review process"),
    ("Taxi Complaint", 30, "Case-review process"),
    ("For Hire Vehicle Complaint", 30, "Case-review process"),
    ("DEFAULT", 14, "Fallback for all unlisted request types"),
)


@dataclass(frozen=True)
class SlaTargets:
    """A validated lookup: unique keys, known default. The planner joins it by its size."""

    frame: DataFrame
    default_days: int

    def attach(self, requests: DataFrame) -> DataFrame:
        """Add ``sla_days`` by complaint type; unlisted (or NULL) types get the default."""
        lookup = self.frame.select("complaint_type", F.col("sla_days").alias("_target"))
        target: Column = F.coalesce(F.col("_target"), F.lit(self.default_days))
        return (
            requests.join(lookup, "complaint_type", "left")
            .withColumn("sla_days", target.cast("int"))
            .drop("_target")
        )


def targets_from_rows(
    spark: SparkSession, rows: Iterable[tuple[str, int, str]], default_days: int
) -> SlaTargets:
    """Targets given in code; a DEFAULT row wins over ``default_days``."""
    rows = list(rows)
    days = {key: value for key, value, _ in rows}
    if len(days) != len(rows):
        raise ValueError("complaint types in the SLA targets must be unique")
    # An Arrow table becomes a local relation: no job is needed to read it.
    columns = dict(zip(schemas.SLA_TARGETS.names, zip(*rows)))
    frame = spark.createDataFrame(pa.table(columns), schemas.SLA_TARGETS)
    return SlaTargets(frame, days.get(DEFAULT_KEY, default_days))


def published_targets(spark: SparkSession, default_days: int) -> SlaTargets:
    return targets_from_rows(spark, PUBLISHED_TARGETS, default_days)


def read_targets(spark: SparkSession, path: str, default_days: int) -> SlaTargets:
    """Read an assumption CSV; one aggregate checks uniqueness and the DEFAULT row."""
    frame = spark.read.csv(
        path, schema=schemas.SLA_TARGETS, header=True, enforceSchema=False, escape='"',
        mode="FAILFAST",
    )
    key = F.col("complaint_type")
    facts = frame.agg(
        F.count(F.lit(1)).alias("rows"),
        F.countDistinct(key).alias("keys"),
        F.max(F.when(key == DEFAULT_KEY, F.col("sla_days"))).alias("default_days"),
    ).first()
    if facts["rows"] != facts["keys"]:
        raise ValueError(f"complaint types in {path} must be unique and present")
    default = facts["default_days"]
    return SlaTargets(frame, default_days if default is None else default)
