"""Exact quantiles of values that hardly repeat, without sorting or collecting a group."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caselens.session import shared_folder

# Into how many parts a range is cut in each round.
PARTS = 1024


def exact_quantiles(
    frame: DataFrame, dims: Sequence[str], value: str, shares: Mapping[str, float],
) -> DataFrame:
    """``dims`` and one column per share with the interpolated quantile of ``value``; 0.5 is the
    median. NULLs and NaNs don't count, and a group without other values has NULLs.

    Counts per value, as for whole days, are as many as the rows when values hardly repeat. Here each
    round counts the rows in parts of the ranges that hold a wanted rank, and goes on with the part it
    lies in, between that part's smallest and largest value, until they are one value. So a group is
    reduced to at most ``PARTS`` counts per wanted rank before the shuffle, however large it is. The
    first round has every row, the second one about a thousandth; two or three are enough unless the
    values are spread very unevenly. A round is one scan, and what it found is written to the shared
    folder, so a lost executor costs no earlier round.
    """
    if not dims or not shares:
        raise ValueError("at least one dimension and one share are needed")
    if not all(0 <= share <= 1 for share in shares.values()):
        raise ValueError(f"shares lie between 0 and 1: {dict(shares)}")
    spark = frame.sparkSession
    keys = [f"_d{i}" for i in range(len(dims))]
    named = [F.col(d).alias(k) for d, k in zip(dims, keys)]
    number = F.col(value).cast("double")
    rows = frame.select(*named, F.nanvl(number, F.lit(None).cast("double")).alias("_v"))
    ends = rows.groupBy(*keys).agg(
        F.count("_v").alias("_n"), F.min("_v").alias("_low"), F.max("_v").alias("_high")
    )
    # The two ranks around each quantile; they are the same where it is a value itself.
    wanted = F.explode(F.array(*(F.lit(float(s)) for s in sorted(set(shares.values())))))
    place = F.col("_share") * (F.col("_n") - 1)
    ranks = F.array_distinct(F.array(F.floor(place), F.ceil(place)))
    targets = (
        ends.select("*", wanted.alias("_share"))
        .select(*keys, "_share", "_low", "_high", F.explode(ranks).alias("_place"),
                (place - F.floor(place)).alias("_part_way"))
        .withColumn("_rank", F.col("_place"))
    )
    columns = targets.columns
    folder = shared_folder(spark)
    done = 0
    while True:
        path = f"{folder}/round={done}"
        targets.write.parquet(path)
        targets = spark.read.schema(targets.schema).parquet(path)
        wide = F.coalesce(F.col("_low") < F.col("_high"), F.lit(False))
        searched = targets.filter(wide)
        if searched.isEmpty():
            break
        targets = targets.filter(~wide).unionByName(_narrowed(rows, searched, keys).select(*columns))
        done += 1
    ordered = F.sort_array(F.collect_list(F.struct("_place", "_low")))
    low, high = ordered[0]["_low"], F.element_at(ordered, -1)["_low"]
    found = targets.groupBy(*keys, "_share").agg(
        (low + (high - low) * F.max("_part_way")).alias("_q")
    )
    return found.groupBy(*keys).agg(
        *(
            F.max(F.when(F.col("_share") == float(share), F.col("_q"))).alias(name)
            for name, share in shares.items()
        )
    ).select(*(F.col(k).alias(d) for k, d in zip(keys, dims)), *shares)


def _narrowed(rows: DataFrame, searched: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Each target with the part of its range that holds its rank, and its rank in that part."""
    # Targets are a few per group; whether that is little enough to broadcast, the planner sees.
    sought = searched.select(*(F.col(k).alias(f"{k}_") for k in keys), *searched.drop(*keys).columns)
    same = F.col("_v").between(F.col("_low"), F.col("_high"))
    for k in keys:
        same &= F.col(k).eqNullSafe(F.col(f"{k}_"))
    # Halves, because the width of a range may be more than the largest number. The lowest value
    # falls into the first part and the highest into the last one, so every round gets further.
    width = F.col("_high") / 2 - F.col("_low") / 2
    part = F.when(
        width > 0, F.floor((F.col("_v") / 2 - F.col("_low") / 2) / width * PARTS)
    ).otherwise(F.when(F.col("_v") > F.col("_low"), PARTS).otherwise(0))
    target = [*keys, "_share", "_place", "_part_way", "_rank"]
    counts = (
        rows.join(sought, same)
        .groupBy(*target, F.least(part, F.lit(PARTS - 1)).alias("_part"))
        .agg(F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_low"), F.max("_v").alias("_high"))
    )
    upto = F.sum("_n").over(Window.partitionBy(*target).orderBy("_part"))
    below = counts.withColumn("_below", upto - F.col("_n"))
    holds = (F.col("_below") <= F.col("_rank")) & (F.col("_rank") < F.col("_below") + F.col("_n"))
    return below.filter(holds).withColumn("_rank", F.col("_rank") - F.col("_below"))
