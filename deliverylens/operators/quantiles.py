"""Exact interpolated quantiles by descending through the bits of the values.

Doubles are mapped to 64-bit keys that sort the same way. Rows are counted by the
first 16 bits of their keys; of those counts, at most 65,536 a group, the one that
holds a wanted rank is followed into the next 16 bits, four times in all. Every
wanted rank of every group goes down in the same passes. No values are ordered and
no step depends on how many there are or on how they lie in the input.

The input is read once: rows are counted by group and key, and all passes share the
exchange of that count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

DIGIT_BITS = 16
LEVELS = 64 // DIGIT_BITS
# Fixed values of IEEE 754 doubles
_SIGN = -(1 << 63)
_FRACTION_BITS = 52
_INFINITE = 0x7FF << _FRACTION_BITS
_SMALLEST_NORMAL = 2.0**-1022


def _two_to(power) -> Column:
    """Exact for whole powers in the range of doubles."""
    return F.pow(F.lit(2.0), power)


def _order_key(value: Column) -> Column:
    """A number whose bits sort unsigned as the doubles do: their IEEE 754 bits, negative
    ones inverted. Both zeros are one, NaN is last."""
    size = F.abs(value)
    # the logarithm may be off by one next to a power of two
    guess = F.floor(F.log2(size))
    scaled = size * _two_to(-guess)
    above, below = scaled >= 2, scaled < 1
    exponent = F.when(above, guess + 1).when(below, guess - 1).otherwise(guess)
    mantissa = F.when(above, scaled / 2).when(below, scaled * 2).otherwise(scaled)
    bits = (
        F.when(F.isnan(value), F.lit(_INFINITE + 1))
        .when(size == float("inf"), F.lit(_INFINITE))
        .when(size < _SMALLEST_NORMAL, (size * _two_to(F.lit(537)) * _two_to(F.lit(537))).cast("bigint"))
        .otherwise(
            F.shiftleft((exponent + 1023).cast("bigint"), _FRACTION_BITS)
            + ((mantissa - 1) * _two_to(F.lit(_FRACTION_BITS))).cast("bigint")
        )
    )
    return F.when(value < 0, F.bitwise_not(bits.bitwiseOR(F.lit(_SIGN)))).otherwise(bits.bitwiseXOR(F.lit(_SIGN)))


def _key_value(key: Column) -> Column:
    """The double of an ``_order_key``."""
    bits = F.when(key < 0, key).otherwise(F.bitwise_not(key)).bitwiseAND(F.lit(~_SIGN))
    exponent = F.shiftright(bits, _FRACTION_BITS)
    fraction = bits.bitwiseAND(F.lit((1 << _FRACTION_BITS) - 1))
    size = (
        F.when(bits > _INFINITE, F.lit(float("nan")))
        .when(bits == _INFINITE, F.lit(float("inf")))
        .when(exponent == 0, fraction * _two_to(F.lit(-537)) * _two_to(F.lit(-537)))
        .otherwise((1 + fraction / _two_to(F.lit(_FRACTION_BITS))) * _two_to(exponent - 1023))
    )
    return F.when(key < 0, size).otherwise(-size)


def _wanted_ranks(total: Column, probs) -> Column:
    """0-based ranks on both sides of every quantile position."""
    positions = [(total - 1).cast("double") * F.lit(float(p)) for p in probs]
    return F.array_distinct(
        F.array(*[F.floor(p).cast("bigint") for p in positions], *[F.ceil(p).cast("bigint") for p in positions])
    )


def _ranks_within(counted: DataFrame, by: list[str], wanted: Column) -> DataFrame:
    """Digits that hold wanted ranks: ``by``, n, prefix, want (rank, and rank among the digit's rows).

    One window row per digit, so a window never holds more than 65,536 rows.
    """
    upto = Window.partitionBy(*by, "_prefix").orderBy("_digit").rowsBetween(Window.unboundedPreceding, 0)
    end = F.col("_end")
    begin = end - F.col("_c")
    return (
        counted.withColumn("_end", F.sum("_c").over(upto))
        .withColumn(
            "_hits",
            F.transform(
                F.filter(wanted, lambda w: (w["at"] >= begin) & (w["at"] < end)),
                lambda w: F.struct(w["rank"].alias("rank"), (w["at"] - begin).alias("at")),
            ),
        )
        .filter(F.size("_hits") > 0)
        .select(
            *by,
            "n",
            F.shiftleft(F.col("_prefix"), DIGIT_BITS).bitwiseOR(F.col("_digit")).alias("_prefix"),
            F.col("_hits").alias("_want"),
        )
    )


def _group(by: list[str]) -> list[str]:
    return [f"_by_{c}" for c in by]


def _value_counts(df: DataFrame, value: str, by: list[str]) -> DataFrame:
    """How often each value occurs in each group: ``_by_`` columns, _key and _c. NULL is left out."""
    x = F.col(value).cast("double")
    rows = df.filter(F.col(value).isNotNull()).select(
        *[F.col(c).alias(g) for c, g in zip(by, _group(by))],
        # never NULL, which also tells the planner to leave the shared part alone
        F.coalesce(_order_key(x), F.lit(0).cast("bigint")).alias("_key"),
    )
    return rows.groupBy(*_group(by), "_key").agg(F.count(F.lit(1)).alias("_c"))


def exact_quantiles(df: DataFrame, value: str, probs: list[float], by: list[str] | None = None) -> DataFrame:
    """Linear-interpolation quantiles: ``by`` + ``n`` + ``quantiles`` (array, ``probs`` order).

    NULL values are left out, a group of nothing else has no row.
    """
    by = list(by or [])
    return _quantiles(_value_counts(df, value, by), probs, by)


def _quantiles(values: DataFrame, probs: list[float], by: list[str]) -> DataFrame:
    """Quantiles of counted values. Each level is joined to the few digits that are followed;
    the planner sees their size at run time."""
    group = _group(by)

    def digit(level: int) -> Column:
        shift = 64 - DIGIT_BITS * (level + 1)
        return F.shiftrightunsigned("_key", shift).bitwiseAND(F.lit((1 << DIGIT_BITS) - 1))

    first = values.groupBy(*group, digit(0).alias("_digit")).agg(F.sum("_c").alias("_c"))
    first = first.withColumn("n", F.sum("_c").over(Window.partitionBy(*group))).withColumn(
        "_prefix", F.lit(0).cast("bigint")
    )
    ranks = F.transform(_wanted_ranks(F.col("n"), probs), lambda k: F.struct(k.alias("rank"), k.alias("at")))
    hits = _ranks_within(first, group, ranks)
    for level in range(1, LEVELS):
        followed = hits.select(*[F.col(g).alias(f"{g}_") for g in group], "n", "_prefix", "_want")
        condition = F.shiftrightunsigned("_key", 64 - DIGIT_BITS * level) == F.col("_prefix")
        for g in group:
            condition = condition & F.col(g).eqNullSafe(F.col(f"{g}_"))
        counted = (
            values.join(followed, condition)
            .groupBy(*group, "_prefix", digit(level).alias("_digit"))
            .agg(F.sum("_c").alias("_c"), F.first("n").alias("n"), F.first("_want").alias("_want"))
        )
        hits = _ranks_within(counted, group, F.col("_want"))

    # at most two entries per wanted quantile
    found = (
        hits.select(*group, "n", _key_value(F.col("_prefix")).alias("_at"), F.explode("_want.rank").alias("_rank"))
        .groupBy(*group, "n")
        .agg(F.map_from_entries(F.collect_list(F.struct("_rank", "_at"))).alias("_by_rank"))
    )
    results = []
    for p in probs:
        position = (F.col("n") - 1).cast("double") * F.lit(float(p))
        low = F.element_at("_by_rank", F.floor(position).cast("bigint"))
        high = F.element_at("_by_rank", F.ceil(position).cast("bigint"))
        part = position - F.floor(position)
        results.append(F.when(part == 0, low).otherwise(low + (high - low) * part))
    return found.select(*[F.col(g).alias(c) for c, g in zip(by, group)], "n", F.array(*results).alias("quantiles"))


def exact_quantile(df: DataFrame, value: str, prob: float) -> Column:
    """One quantile of a whole column, as a scalar subquery."""
    return exact_quantiles(df, value, [prob]).select(F.element_at("quantiles", 1)).scalar()


def box_stats(df: DataFrame, value: str, by: list[str]) -> DataFrame:
    """Five-number summary, count and mean per group, from one look at ``df``."""
    values = _value_counts(df, value, by)
    x = _key_value(F.col("_key"))
    summary = values.groupBy(*_group(by)).agg(
        F.sum("_c").alias("n"),
        (F.sum(x * F.col("_c")) / F.sum("_c")).alias("mean"),
        F.min(x).alias("minimum"),
        F.max(x).alias("maximum"),
    )
    q = _quantiles(values, [0.25, 0.5, 0.75], by).select(
        *by,
        F.element_at("quantiles", 1).alias("q1"),
        F.element_at("quantiles", 2).alias("median"),
        F.element_at("quantiles", 3).alias("q3"),
    )
    condition = F.lit(True)
    for c, g in zip(by, _group(by)):
        condition = condition & F.col(c).eqNullSafe(F.col(g))
    return summary.join(q, condition).select(*by, "n", "mean", "minimum", "q1", "median", "q3", "maximum")
