"""Global ranks and running totals without one big sort."""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, Window, functions as F

from deliverylens.session import materialized

RANGE_ROWS = 1 << 22  # of a date, numbered in one task


def counts_with_standing(counts: DataFrame, column: str, descending: bool = True) -> DataFrame:
    """Per distinct count: how many rows share it and totals up to and including it.

    For counts over N fact rows there are at most sqrt(2N) distinct values
    (they are positive and sum to N), so the ordered pass stays small however
    many rows carry them.
    """
    per_value = counts.groupBy(column).agg(F.count(F.lit(1)).alias("holders"))
    order = F.col(column).desc() if descending else F.col(column).asc()
    upto = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return per_value.select(
        column,
        "holders",
        F.sum(F.col(column) * F.col("holders")).over(upto).alias("running_total"),
        F.sum("holders").over(upto).alias("running_holders"),
    )


def running_total_of_counts(counts: DataFrame, column: str, rows: DataFrame | None = None) -> DataFrame:
    """Add ``running_total``: the total of all counts from the largest down to a row's own.

    Equal counts share the total. ``rows`` limits which rows of ``counts`` are
    returned, not what is totalled.
    """
    standing = counts_with_standing(counts, column).select(column, "running_total")
    return (counts if rows is None else rows).join(standing, column)


def percent_rank_of_counts(counts: DataFrame, column: str, rows: DataFrame | None = None) -> DataFrame:
    """Add ``percent_rank``: the ascending PERCENT_RANK among all counts (``rows`` as above)."""
    standing = counts_with_standing(counts, column, descending=False)
    total = counts.agg(F.count(F.lit(1))).scalar()
    below = F.col("running_holders") - F.col("holders")
    ranked = standing.select(
        column,
        F.coalesce(below / F.nullif((total - 1).cast("double"), F.lit(0.0)), F.lit(0.0)).alias("percent_rank"),
    )
    return (counts if rows is None else rows).join(ranked, column)


def shuffle_key(key: str, seed: int) -> Column:
    """A repeatable pseudo-random sort key (hex digest of seed and key)."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")))


def hash_positions(df: DataFrame, key: str, by: list[str], seed: int) -> DataFrame:
    """A shuffled 1-based position per group (``position``) and group size (``group_rows``).

    The order is that of a seeded digest of the key. Rows are numbered inside
    digest buckets, which are even by construction, and shifted by the sizes of
    the buckets before theirs; no task sees a whole group. There are 4096 buckets,
    or 16 times as many as often as it takes to have the square root of the rows.
    """
    rows = F.greatest(df.agg(F.count(F.lit(1))).scalar(), F.lit(1))
    digits = F.greatest(F.lit(3), F.ceil(F.log(16.0, F.sqrt(rows)))).cast("int")
    hashed = df.withColumn("_h", shuffle_key(key, seed)).withColumn("_bucket", F.col("_h").substr(F.lit(1), digits))
    sizes = hashed.groupBy(*by, "_bucket").agg(F.count(F.lit(1)).alias("_size"))
    group = Window.partitionBy(*by)
    upto = group.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)
    offsets = sizes.select(
        *by,
        "_bucket",
        (F.sum("_size").over(upto) - F.col("_size")).alias("_before"),
        F.sum("_size").over(group).alias("group_rows"),
    )
    inside = Window.partitionBy(*by, "_bucket").orderBy("_h", key)
    return (
        hashed.withColumn("_nth", F.row_number().over(inside))
        .join(offsets, [*by, "_bucket"])
        .withColumn("position", F.col("_before") + F.col("_nth"))
        .drop("_h", "_bucket", "_nth", "_before")
    )


def hash_sample(df: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """A repeatable sample of at most ``n`` rows, ordered by a seeded digest."""
    return df.orderBy(shuffle_key(key, seed), key).limit(n)


def above_mean_plus_sigma(df: DataFrame, column: str, sigmas: float = 1.0) -> DataFrame:
    """Rows above mean + sigmas * population deviation, with ``mean`` and ``dev`` added."""
    stats = df.select(F.struct(F.avg(column).alias("mean"), F.stddev_pop(column).alias("dev"))).scalar()
    placed = df.withColumn("_stats", stats)
    bound = F.col("_stats.mean") + F.col("_stats.dev") * F.lit(float(sigmas))
    return placed.filter(F.col(column) > bound).select(*df.columns, "_stats.mean", "_stats.dev")


def ordered_positions(df: DataFrame, by: list[str], order: str, parts: int) -> DataFrame:
    """Add ``_position``, 1-based per group in ascending order, and ``_part``: rows are numbered
    inside ranges of the order and shifted by the sizes of the ranges before theirs."""
    # written, since another run might draw other ranges
    ranged = materialized(
        df.repartitionByRange(parts, *by, order).withColumn("_part", F.spark_partition_id()), "ranges"
    )
    sizes = ranged.groupBy(*by, "_part").agg(F.count(F.lit(1)).alias("_size"))
    upto = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, 0)
    keys = [*by, "_part"]
    offsets = sizes.select(
        *(F.col(c).alias(f"_at{k}") for k, c in enumerate(keys)), (F.sum("_size").over(upto) - F.col("_size")).alias("_before")
    )
    same = F.lit(True)
    for k, c in enumerate(keys):
        same = same & F.col(c).eqNullSafe(F.col(f"_at{k}"))
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(order))
    return (
        ranged.withColumn("_nth", nth)
        .join(offsets, same)
        .select(*ranged.columns, (F.col("_before") + F.col("_nth")).alias("_position"))
    )


def halves_by_date(
    df: DataFrame, group: str, date: str, tiebreak: str, value: str, range_rows: int = RANGE_ROWS
) -> DataFrame:
    """Mean of ``value`` in the earlier and later half of each group's rows.

    Rows without a date come first. Rows are first reduced per (group, date); only the date on which a group
    passes its midpoint is looked at row by row, in ranges of about ``range_rows`` by the tiebreak.
    """
    v = F.col(value).cast("double")
    daily = df.groupBy(group, date).agg(F.count(F.lit(1)).alias("_c"), F.count(v).alias("_n"), F.sum(v).alias("_s"))
    whole = Window.partitionBy(group)
    placed = daily.select(
        "*",
        (
            F.sum("_c").over(whole.orderBy(date).rowsBetween(Window.unboundedPreceding, 0)) - F.col("_c")
        ).alias("_before"),
        F.floor(F.sum("_c").over(whole) / 2).alias("_half"),
    )
    passes_midpoint = (F.col("_before") < F.col("_half")) & (F.col("_half") < F.col("_before") + F.col("_c"))
    settled = placed.filter(~passes_midpoint).select(
        group, (F.col("_before") + F.col("_c") <= F.col("_half")).alias("_early"), "_n", "_s"
    )
    split_days = materialized(
        placed.filter(passes_midpoint).select(
            F.col(group).alias("_group"), F.col(date).alias("_date"), (F.col("_half") - F.col("_before")).alias("_take"), "_c"
        ),
        "split-days",
    )
    parts = max(1, ceil((split_days.agg(F.sum("_c")).first()[0] or 0) / range_rows))
    on_split_day = F.col(group).eqNullSafe(F.col("_group")) & F.col(date).eqNullSafe(F.col("_date"))
    on_date = df.join(split_days, on_split_day).select("_group", "_date", F.col(tiebreak).alias("_tie"), "_take", v.alias("_v"))
    split = (
        ordered_positions(on_date, ["_group", "_date"], "_tie", parts)
        .select(F.col("_group").alias(group), (F.col("_position") <= F.col("_take")).alias("_early"), "_v")
        .groupBy(group, "_early")
        .agg(F.count("_v").alias("_n"), F.sum("_v").alias("_s"))
    )
    early = F.col("_early")
    return (
        settled.unionByName(split)
        .groupBy(group)
        .agg(
            F.sum(F.when(early, F.col("_s"))).alias("_s1"),
            F.sum(F.when(early, F.col("_n"))).alias("_n1"),
            F.sum(F.when(~early, F.col("_s"))).alias("_s2"),
            F.sum(F.when(~early, F.col("_n"))).alias("_n2"),
        )
    )
