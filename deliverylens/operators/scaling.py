"""Whole-column min-max scaling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

RANGES = "_ranges"


def with_ranges(df: DataFrame, exprs: dict[str, Column]) -> DataFrame:
    """Add the min and max of several expressions, from one scalar subquery."""
    found = df.select(
        F.struct(
            *[F.min(e).alias(f"{n}_min") for n, e in exprs.items()],
            *[F.max(e).alias(f"{n}_max") for n, e in exprs.items()],
        )
    ).scalar()
    return df.withColumn(RANGES, found)


def scaled(value: Column, name: str, scale: float = 1.0) -> Column:
    """``value`` in [0, scale] by the ranges of ``name``; a flat column gives 0, NULL stays NULL."""
    low, high = F.col(f"{RANGES}.{name}_min"), F.col(f"{RANGES}.{name}_max")
    return F.when(high > low, (value - low) / (high - low) * F.lit(float(scale))).otherwise(value * 0)


def minmax_scale(df: DataFrame, columns: list[str], scale: float = 1.0, suffix: str = "_scaled") -> DataFrame:
    """Add ``column + suffix`` for every column."""
    exprs = {c: F.col(c).cast("double") for c in columns}
    ranged = with_ranges(df, exprs)
    return ranged.select(*df.columns, *[scaled(exprs[c], c, scale).alias(c + suffix) for c in columns])
