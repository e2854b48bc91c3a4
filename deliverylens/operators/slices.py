"""A table in slices that are worked off one after the other, so that shuffle files are
those of a slice at a time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

SLICES = 4
ROWS_A_SLICE = 1_000_000  # smaller tables are cut into fewer


def slice_count(rows: int) -> int:
    return min(SLICES, 1 + rows // ROWS_A_SLICE)


def ordered_slices(df: DataFrame, order: Column, cuts: list[Column]) -> list[DataFrame]:
    """The rows of ``df`` in slices that follow each other by ``order``, cut before each of
    the values ``cuts``. Every row is in one slice; NULL comes first, NaN last."""
    number = sum((F.coalesce((order >= c).cast("int"), F.lit(0)) for c in cuts), F.lit(0))
    return [df.where(number == k) for k in range(len(cuts) + 1)] if cuts else [df]


def even_cuts(df: DataFrame, column: str, slices: int) -> list[Column]:
    """Values of a number, date or time that cut ``df`` into about even slices; fewer where
    one value has a large share of the rows."""
    if slices < 2:
        return []
    ranks = [k / slices for k in range(1, slices)]
    # as text, since times change on their way through Python
    cuts = df.agg(F.percentile_approx(column, ranks, 1000).cast("array<string>")).first()[0]
    return [F.lit(c).cast(df.schema[column].dataType) for c in dict.fromkeys(cuts or [])]


def key_slices(df: DataFrame, keys: list[str], slices: int) -> list[DataFrame]:
    """The rows of ``df`` in slices by a hash of their keys: all rows of a key are in one."""
    number = F.pmod(F.xxhash64(*keys), F.lit(slices))
    return [df.where(number == k) for k in range(slices)] if slices > 1 else [df]
