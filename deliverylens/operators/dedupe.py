"""Ordered de-duplication and uniqueness."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def keep_first(df: DataFrame, keys: list[str], order_by: list) -> DataFrame:
    """One row per key: the first in ``order_by``.

    Spark plans ``row_number() = 1`` as a group limit on both sides of the
    shuffle, so each map task sends at most one row per key and a key holding
    a large share of the rows stays cheap.
    """
    arrival = Window.partitionBy(*keys).orderBy(*order_by)
    return df.withColumn("_nth", F.row_number().over(arrival)).filter(F.col("_nth") == 1).drop("_nth")


def top_per_group(df: DataFrame, keys: list[str], order_by: list, k: int) -> DataFrame:
    """The first ``k`` rows of every group, with their position in ``rn``."""
    ranked = Window.partitionBy(*keys).orderBy(*order_by)
    return df.withColumn("rn", F.row_number().over(ranked)).filter(F.col("rn") <= k)


def first_copies(df: DataFrame, keys: list[str], order_by: list, copies: str) -> DataFrame:
    """The rows of ``keep_first``, each with the number of rows its key had (column ``copies``).

    Each map task sums up a key's rows to its first one and their number, so a key with a
    large share of the rows is still one row a task, and what was left out is known behind
    the shuffle. NULL is a key like any other, and comes first in ``order_by``.
    """
    others = [c for c in df.columns if c not in keys]
    # an order that is never NULL itself, so that rows without one still count
    first = F.min_by(F.struct(*others), F.struct(*order_by))
    found = df.groupBy(*keys).agg(first.alias("_first"), F.count(F.lit(1)).alias(copies))
    return found.select(*[F.col(c) if c in keys else F.col(f"_first.`{c}`").alias(c) for c in df.columns], copies)
