"""Aggregate-then-join rollups.

Facts are reduced to one row per key before any dimension is joined. Map-side
partial sums absorb hot keys, and the joins only ever move reduced rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F


def rollup_via(
    fact: DataFrame,
    key: str,
    dim: DataFrame,
    to: list[str],
    measures: dict[str, Column],
    how: str = "inner",
    keep: dict[str, tuple[Callable[[Column], Column], str]] | None = None,
) -> DataFrame:
    """Sum ``measures`` per ``key``, look the key up in ``dim``, sum again per ``to``.

    Measures must be additive (counts and sums); ratios are taken afterwards.
    ``keep`` carries other partials as (function, column); the function must combine its
    own results, as min and max do.
    """
    kept = keep or {}
    per_key = fact.groupBy(key).agg(
        *[m.alias(n) for n, m in measures.items()], *[f(F.col(c)).alias(n) for n, (f, c) in kept.items()]
    )
    joined = per_key.join(dim, key, how)
    return joined.groupBy(*to).agg(
        *[F.sum(n).alias(n) for n in measures],
        *[f(F.col(n)).alias(n) for n, (f, _) in kept.items()],
    )


def align_on_key(frames: list[DataFrame], key: str) -> DataFrame:
    """Full-outer alignment of frames that are unique by ``key``, in one shuffle."""
    merged = frames[0]
    for frame in frames[1:]:
        merged = merged.unionByName(frame, allowMissingColumns=True)
    return merged.groupBy(key).agg(*[F.max(c).alias(c) for c in merged.columns if c != key])


def left_star(base: DataFrame, frames: list[DataFrame], key: str) -> DataFrame:
    """Left-join several key-unique frames onto a base."""
    return base.join(align_on_key(frames, key), key, "left")
