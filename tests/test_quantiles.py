"""Exact quantiles by refinement, and the sketched median within its bound."""

import random
from bisect import bisect_left, bisect_right

import numpy as np
import pytest
from pyspark.sql import functions as F

from caselens.operators import quantiles, rollups
from checks.queries import enriched

SHARES = {"least": 0.0, "median": 0.5, "p90": 0.9, "most": 1.0}


def groups():
    rng = random.Random(3)
    return {
        ("spread", 1): [rng.random() * 1e3 for _ in range(3001)],
        ("even", 1): [rng.random() for _ in range(400)],
        ("skewed", 2): [10.0 ** rng.randrange(-300, 300) * rng.random() for _ in range(500)],
        ("hot", 2): [5.0] * 2000 + [rng.gauss(0, 1) for _ in range(999)],
        ("one", 1): [-4.5], ("two", 1): [-1.0, 2.0], ("same", 1): [7.25] * 9,
        (None, 1): [1.5, 2.5, 4.0], ("one", None): [3.0, 3.0, 9.0],
        ("ends", 1): [-1.7e308, 1.7e308, 0.0], ("tiny", 1): [0.0, 5e-324, 1e-323],
    }


@pytest.mark.parametrize("parts", [1024, 4])
def test_exact_quantiles(spark, monkeypatch, parts):
    monkeypatch.setattr(quantiles, "PARTS", parts)
    held = groups()
    if parts == 4:
        del held["skewed", 2]
    rows = [(a, b, v) for (a, b), values in held.items() for v in values]
    rows += [("spread", 1, None), ("spread", 1, float("nan")), ("none", 1, None), ("none", 1, float("nan"))]
    random.Random(1).shuffle(rows)
    frame = spark.createDataFrame(rows, "a string, b int, v double").repartition(5)
    found = {(r.a, r.b): r for r in quantiles.exact_quantiles(frame, ["a", "b"], "v", SHARES).collect()}
    assert set(found) == {*held, ("none", 1)}
    for key, values in held.items():
        for name, share in SHARES.items():
            if key[0] == "ends" and name == "p90":
                continue  # the difference of both ends is no number
            wanted = float(np.quantile(np.array(values), share))
            assert found[key][name] == pytest.approx(wanted, rel=1e-12, abs=0), (key, name)
    assert [found["none", 1][name] for name in SHARES] == [None] * 4


def test_no_rows_and_wrong_arguments(spark):
    none = spark.createDataFrame([], "a string, v double")
    found = quantiles.exact_quantiles(none, ["a"], "v", {"median": 0.5})
    assert found.columns == ["a", "median"] and found.collect() == []
    for dims, shares in (([], {"m": 0.5}), (["a"], {}), (["a"], {"m": 1.5})):
        with pytest.raises(ValueError):
            quantiles.exact_quantiles(none, dims, "v", shares)


def test_sketched_median_is_within_its_bound(spark, data):
    fact = enriched(spark, data)
    days = {}
    for r in fact.filter(F.col("closure_days").isNotNull()).select("agency", "closure_days").collect():
        days.setdefault(r.agency, []).append(r.closure_days)
    exact = {r.agency: r for r in rollups.kpi_by_agency(fact).collect()}
    for accuracy in (20, 1000):
        for r in rollups.kpi_by_agency(fact, accuracy=accuracy).collect():
            values = sorted(days[r.agency])
            middle, slack = len(values) / 2, len(values) / accuracy + 1
            assert bisect_left(values, r.median_closure_days) <= middle + slack
            assert bisect_right(values, r.median_closure_days) >= middle - slack
            assert r.total_requests == exact[r.agency].total_requests
