import random

import pytest
from pyspark.sql import functions as F

from sitegrain.operators import percentile as P


def plain(values, share):
    values = sorted(v for v in values if v is not None)
    at = share * (len(values) - 1)
    low = int(at)
    return values[low] + (at - low) * (values[min(low + 1, len(values) - 1)] - values[low])


@pytest.mark.parametrize("few", [1, 50])
def test_percentile_is_exact(spark, monkeypatch, few):
    """Ties, nulls, one and two rows, outliers, a value that most rows share; down to single values."""
    monkeypatch.setattr(P, "FEW", few)
    monkeypatch.setattr(P, "PIVOTS", 7)
    rng = random.Random(1)
    cases = [
        [3.0], [1.0, 2.0], [None, 5.0, None], [4.0] * 300, [1.0] * 290 + [2.0] * 10, [0.0] * 95 + [1.0] * 5,
        [rng.expovariate(1.0) for _ in range(500)] + [None] * 20, [10.0 ** rng.randint(-300, 300) for _ in range(400)],
    ]
    for values in cases:
        rows = spark.createDataFrame([(v,) for v in values], "latency_s double")
        for share in (0.0, 0.5, 0.95, 1.0):
            got = P.percentile(rows, "latency_s", share)
            assert got == pytest.approx(plain(values, share), rel=1e-12)
    assert P.percentile(spark.createDataFrame([(None,)], "latency_s double"), "latency_s", 0.95) is None


def test_percentile_as_sparks_own(spark):
    events = spark.read.parquet("/root/testdata/sf0.01/events.parquet")
    want = events.agg(F.percentile("value", F.lit(0.95))).first()[0]
    assert P.percentile(events, "value", 0.95) == pytest.approx(want, rel=1e-12)


def test_no_task_holds_all_values(spark):
    """Every aggregate over the values combines before its shuffle; values are collected from a filtered rest only."""
    rows = spark.range(100_000).select((F.col("id") % 1000).cast("double").alias("v"))
    assert P.nth(rows, 95_000, 100_000) == 950.0
