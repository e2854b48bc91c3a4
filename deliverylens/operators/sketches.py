"""Approximate quantiles from mergeable rank sketches.

A sketch holds a bounded sample of its values with their weights. Sketches of parts (weeks,
regions, tasks) merge into one of the whole, so values are read once and kept sketches
answer for any union of their parts. Exact quantiles are in ``quantiles``; nothing here is
used unless asked for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

SIZE = 400  # items of a sketch's largest level, 8 to 65,535


def rank_error(size: int = SIZE) -> float:
    """How far the rank of an answer may be off, as a share of all values, at 99 % confidence
    (the published bound of the sketch). Below about ``size`` values answers are exact."""
    return 2.296 / size**0.9723


def rank_sketches(df: DataFrame, value: str, by: list[str] | None = None, size: int = SIZE) -> DataFrame:
    """``by`` + n + sketch of the values of each group. NULL and NaN are left out; a group of
    nothing else has no row. Each task sends one sketch a group, however many rows it has."""
    x = F.col(value).cast("double")
    known = df.filter(x.isNotNull() & ~F.isnan(x))
    return known.groupBy(*(by or [])).agg(
        F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double(x, F.lit(size)).alias("sketch")
    ).filter("n > 0")


def merged_sketches(sketches: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Sketches of larger groups from those of their parts: ``by`` + n + sketch."""
    return sketches.groupBy(*(by or [])).agg(
        F.sum("n").cast("bigint").alias("n"), F.kll_merge_agg_double("sketch").alias("sketch")
    ).filter("n > 0")


def sketch_quantile(sketch: Column, prob: float) -> Column:
    """The value at a share of all values: an actual value, not one between two."""
    return F.kll_sketch_get_quantile_double(sketch, F.lit(float(prob)))


def sketch_quantiles(sketches: DataFrame, probs: list[float]) -> DataFrame:
    """The rows of ``sketches`` with ``quantiles`` (array, ``probs`` order) in place of the sketch."""
    return sketches.withColumn("quantiles", F.array(*[sketch_quantile(F.col("sketch"), p) for p in probs])).drop("sketch")


def rank_misses(df: DataFrame, value: str, by: list[str], answers: DataFrame, probs: list[float], error: float) -> DataFrame:
    """Hold answers (``by``, n, quantiles) against the rows they stand for: ``by``, n and
    ``misses``, the answers whose exact rank is further than ``error`` from what was asked.

    An answer's ranks reach from the share of smaller values to that of values up to it.
    Rows meet the answers of their group, one row each, and are only counted.
    """
    named = answers.select(*[F.col(c).alias(f"_by_{c}") for c in by], F.col("n").alias("_n"), F.col("quantiles").alias("_q"))
    condition = F.lit(True)
    for c in by:
        condition = condition & F.col(c).eqNullSafe(F.col(f"_by_{c}"))
    x = F.col(value).cast("double")
    counts = [
        f(F.get("_q", F.lit(k))).alias(f"_{name}{k}")
        for k in range(len(probs))
        for name, f in (("below", lambda q: F.count_if(x < q)), ("upto", lambda q: F.count_if(x <= q)))
    ]
    met = df.join(named, condition).groupBy(*by).agg(F.first("_n").alias("n"), *counts)
    misses = F.lit(0)
    for k, p in enumerate(probs):
        off = (F.col(f"_below{k}") / F.col("n") > p + error) | (F.col(f"_upto{k}") / F.col("n") < p - error)
        misses = misses + off.cast("int")
    return met.select(*by, "n", misses.alias("misses"))
