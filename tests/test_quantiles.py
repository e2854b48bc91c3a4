"""Exact quantiles against numpy."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from deliverylens.operators.quantiles import _key_value, _order_key, box_stats, exact_quantile, exact_quantiles


@pytest.mark.parametrize("seed,spread", [(1, 10**9), (2, 40), (3, 3)])
def test_global_quantile(spark, seed, spread):
    rng = random.Random(seed)
    values = [float(rng.randrange(spread)) for _ in range(5000)] + [None] * 10
    df = spark.createDataFrame([(v,) for v in values], "x double")
    probs = [0.005, 0.25, 0.5, 0.9, 0.995]
    row = exact_quantiles(df, "x", probs).first()
    known = [v for v in values if v is not None]
    assert row.n == 5000
    assert row.quantiles == pytest.approx([np.quantile(known, p) for p in probs], abs=1e-9)


def test_one_group_with_most_rows(spark):
    rng = random.Random(7)
    rows = [("hot", rng.gauss(0, 100)) for _ in range(4000)] + [(f"g{i % 9}", rng.random()) for i in range(300)]
    rows += [(None, 5.0), (None, 7.0), ("single", 1.0)]
    df = spark.createDataFrame(rows, "g string, x double").repartition(8)
    got = {r.g: list(r.quantiles) for r in exact_quantiles(df, "x", [0.1, 0.5, 0.99], ["g"]).collect()}
    for group in {r[0] for r in rows}:
        values = [v for g, v in rows if g == group]
        assert got[group] == pytest.approx([np.quantile(values, p) for p in (0.1, 0.5, 0.99)], abs=1e-9)


def _window_rows(df) -> list[int]:
    """Rows that came out of each window of a plan that has run."""
    df.collect()
    found, plans = [], [df._jdf.queryExecution().executedPlan()]
    while plans:
        plan = plans.pop()
        if "AdaptiveSparkPlan" in plan.nodeName():
            plan = plan.executedPlan()
        if "QueryStage" in plan.nodeName():
            plans.append(plan.plan())
        if plan.nodeName() == "Sort" and plan.simpleString(100).find("_digit") > 0:
            below = plan.child()
            while not below.metrics().contains("numOutputRows") and not below.metrics().contains("shuffleRecordsWritten"):
                below = below.plan() if "QueryStage" in below.nodeName() else below.child()
            name = "numOutputRows" if below.metrics().contains("numOutputRows") else "shuffleRecordsWritten"
            found.append(below.metrics().apply(name).value())
        children = plan.children()
        plans += [children.apply(k) for k in range(children.size())]
    return found


def test_no_window_sees_more_than_the_digits(spark):
    """Ordered input with one hot group: the counts of digits are all that is ordered."""
    n = 300_000
    df = spark.range(0, n, 1, 8).select(
        F.when(F.col("id") % 100 == 0, F.col("id") % 7).otherwise(F.lit(-1)).alias("g"),
        (F.col("id") / 3).alias("x"),
    )
    plan = exact_quantiles(df, "x", [0.25, 0.5], ["g"])
    rows = _window_rows(plan)
    assert rows and max(rows) < 20_000
    got = {r.g: r.quantiles for r in plan.collect()}
    hot = np.array([k / 3 for k in range(n) if k % 100])
    assert got[-1] == [np.quantile(hot, 0.25), np.quantile(hot, 0.5)]


def test_every_kind_of_double(spark):
    values = [-1e300, -5.0, -0.0, 0.0, 5e-324, -5e-324, 1.5, 1e300, float("inf"), float("-inf"), 2.0**53]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    ranks = [k / (len(values) - 1) for k in range(len(values))]
    assert exact_quantiles(df, "x", [ranks[4], 0.0, 1.0]).first().quantiles == [0.0, float("-inf"), float("inf")]
    got = exact_quantiles(df.filter("abs(x) < 1e308"), "x", [k / 8 for k in range(9)]).first().quantiles
    assert got == pytest.approx(sorted(v for v in values if abs(v) < 1e308), abs=0)
    odd = [x for k in range(-1074, 1024, 7) for x in (2.0**k, -(2.0**k), 2.0**k * (1 + 2**-52), 2.0**k * (2 - 2**-52))]
    odd = sorted({*odd, 1.7976931348623157e308, 0.1, 1 / 3})
    back = spark.createDataFrame([(v,) for v in odd], "x double").select("x", _order_key(F.col("x")).alias("k"))
    rows = back.select("x", "k", _key_value(F.col("k")).alias("y")).collect()
    assert all(r.x == r.y for r in rows)
    assert [r.x for r in sorted(rows, key=lambda r: r.k % 2**64)] == odd
    nan = spark.createDataFrame([(1.0,), (float("nan"),)], "x double")
    assert np.isnan(exact_quantiles(nan, "x", [1.0]).first().quantiles[0])


def test_empty_and_all_null_columns(spark):
    empty = spark.createDataFrame([], "x double")
    nulls = spark.createDataFrame([(None,), (None,)], "x double")
    for df in (empty, nulls):
        assert exact_quantiles(df, "x", [0.5]).count() == 0
        out = spark.range(1).select(exact_quantile(df, "x", 0.5).alias("q")).first()
        assert out.q is None


def test_interpolates_between_neighbours(spark):
    df = spark.createDataFrame([(float(v),) for v in (1, 2, 3, 4, 10)], "x double")
    assert spark.range(1).select(exact_quantile(df, "x", 0.995).alias("q")).first().q == pytest.approx(9.88)


def test_box_stats(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("a", None), ("b", 5.0), ("c", None)], "g string, x double")
    rows = {r.g: r for r in box_stats(df, "x", ["g"]).collect()}
    assert set(rows) == {"a", "b"}
    assert (rows["a"].n, rows["a"].minimum, rows["a"].median, rows["a"].q3, rows["a"].maximum) == (2, 1, 2, 2.5, 3)
