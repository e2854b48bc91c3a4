"""Distributions, pivots, correlations and table profiles."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame, functions as F

from deliverylens.operators.quantiles import exact_quantiles


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Equal-width bins over the column's range, empty ones with n = 0; the last bin is closed.

    A column of one value has one bin of no width, a column of none has no bins.
    """
    values = df.select(F.col(column).cast("double").alias("_v")).filter(F.col("_v").isNotNull())
    span = values.agg(F.min("_v").alias("_low"), F.max("_v").alias("_high"))
    width = (F.col("_high") - F.col("_low")) / bins
    last = F.when(width > 0, bins - 1).otherwise(0)
    edges = span.filter(F.col("_low").isNotNull()).select(
        F.explode(F.sequence(F.lit(0), last)).alias("bin"), F.col("_low"), width.alias("_width")
    )
    scalar = span.select(F.struct("_low", width.alias("_width"))).scalar()
    v, low, step = F.col("_v"), F.col("_span._low"), F.col("_span._width")
    slot = F.when(step > 0, F.least(F.floor((v - low) / step), F.lit(bins - 1))).otherwise(F.lit(0))
    counted = values.withColumn("_span", scalar).groupBy(slot.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    edge = F.col("_low") + F.col("_width") * F.col("bin")
    return edges.join(counted, "bin", "left").select(
        "bin", edge.alias("bin_start"), (edge + F.col("_width")).alias("bin_end"), F.coalesce("n", F.lit(0)).alias("n")
    )


def pivot_counts(df: DataFrame, rows: str, columns: str, domain) -> DataFrame:
    """Row count per (rows, columns), 0 for empty cells: a column for each value of the
    domain, and ``other`` for values outside it. NULL counts nowhere."""
    return df.groupBy(rows).agg(
        *[F.count_if(F.col(columns) == value).alias(value.lower().replace(" ", "_")) for value in domain],
        F.count_if(~F.col(columns).isin(*domain)).alias("other"),
    )


def share_of_total(df: DataFrame, column: str) -> DataFrame:
    """Count and percentage of every value."""
    total = df.filter(F.col(column).isNotNull()).agg(F.count(F.lit(1))).scalar()
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("share_pct", F.col("n") * 100.0 / total.cast("double"))
    )


def correlation_pairs(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson r of every unordered pair, using rows where both are present."""
    # one aggregation for all pairs; the pair list is fixed by the column list
    pairs = list(combinations(columns, 2))
    row = df.agg(
        F.array(
            *[
                F.struct(
                    F.lit(a).alias("metric_a"),
                    F.lit(b).alias("metric_b"),
                    F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias("r"),
                )
                for a, b in pairs
            ]
        ).alias("pairs")
    )
    return row.select(F.inline("pairs"))


def correlation_matrix(df: DataFrame, columns: list[str]) -> DataFrame:
    """Square correlation table, one row per metric; the diagonal is 1 unless the metric is flat."""
    x = {c: F.col(c).cast("double") for c in columns}
    pairs = [F.corr(x[a], x[b]).alias(f"{a}|{b}") for a, b in combinations(columns, 2)]
    spread = [F.when(F.var_pop(x[c]) > 0, F.lit(1.0)).alias(f"{c}|{c}") for c in columns]
    row = df.agg(*pairs, *spread)

    def cell(a, b):
        name = f"{a}|{b}" if f"{a}|{b}" in row.columns else f"{b}|{a}"
        return F.col(f"`{name}`").alias(b)

    return row.select(
        F.inline(F.array(*[F.struct(F.lit(a).alias("metric"), *[cell(a, b) for b in columns]) for a in columns]))
    )


def notable_correlations(df: DataFrame, columns: list[str], threshold: float = 0.4) -> DataFrame:
    return correlation_pairs(df, columns).filter(F.abs("r") > threshold)


def linear_fit(df: DataFrame, x: str, y: str) -> DataFrame:
    """Least-squares line of y on x over all rows."""
    xs, ys = F.col(x).cast("double"), F.col(y).cast("double")
    return df.agg(
        F.regr_slope(ys, xs).alias("slope"),
        F.regr_intercept(ys, xs).alias("intercept"),
        F.regr_r2(ys, xs).alias("r2"),
        F.regr_count(ys, xs).alias("n"),
    )


def profile(df: DataFrame, numeric: list[str], categorical: list[str], keys: list[str] | None = None) -> DataFrame:
    """Column profile: count, unique, top, freq and numeric summary.

    Values of ``categorical`` columns are counted per (column, value), so distinct counts and
    modes are distributed; ties for the mode go to the smallest value. ``keys`` are columns
    known to be unique: all their values are modes, so none of them is counted or moved.
    """
    cells = df.select(
        F.inline(
            F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("v")) for c in categorical])
        )
    )
    per_value = cells.groupBy("column_name", "v").agg(F.count(F.lit(1)).alias("c"))
    known = F.col("v").isNotNull()
    # most frequent value, the smallest one on ties
    best = F.min(F.when(known, F.struct((-F.col("c")).alias("c"), F.col("v"))))
    labels = (
        per_value.groupBy("column_name")
        .agg(
            F.coalesce(F.sum(F.when(known, F.col("c"))), F.lit(0)).alias("n"),
            F.count_if(known).alias("unique_values"),
            best.alias("_best"),
        )
        .select("column_name", "n", "unique_values", F.col("_best.v").alias("top"), (-F.col("_best.c")).alias("freq"))
    )
    if keys:
        of_key = [
            F.struct(
                F.lit(c).alias("column_name"),
                F.count(c).alias("n"),
                F.count(c).alias("unique_values"),
                F.min(F.col(c).cast("string")).alias("top"),
                F.when(F.count(c) > 0, F.lit(1).cast("bigint")).alias("freq"),
            )
            for c in keys
        ]
        labels = labels.unionByName(df.agg(F.array(*of_key).alias("k")).select(F.inline("k")))
    if not numeric:
        return labels
    x = {c: F.col(c).cast("double") for c in numeric}
    moments = df.agg(
        F.array(
            *[
                F.struct(
                    F.lit(c).alias("column_name"),
                    F.count(x[c]).alias("n"),
                    F.avg(x[c]).alias("mean"),
                    F.stddev_samp(x[c]).alias("std"),
                    F.min(x[c]).alias("minimum"),
                    F.max(x[c]).alias("maximum"),
                )
                for c in numeric
            ]
        ).alias("m")
    ).select(F.inline("m"))
    numbers = df.select(
        F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), x[c].alias("x")) for c in numeric]))
    )
    quartiles = exact_quantiles(numbers, "x", [0.25, 0.5, 0.75], ["column_name"]).select(
        "column_name",
        F.element_at("quantiles", 1).alias("q1"),
        F.element_at("quantiles", 2).alias("median"),
        F.element_at("quantiles", 3).alias("q3"),
    )
    return labels.unionByName(moments.join(quartiles, "column_name", "left"), allowMissingColumns=True)


def unpivot_columns(df: DataFrame, keys: list[str], columns: list[str], name: str, value: str) -> DataFrame:
    return df.unpivot(keys, columns, name, value)
