"""Column expressions shared by the operators and plans."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tidy_label(c) -> Column:
    """Trim and title-case a category label (``"won't fix  "`` -> ``"Won't Fix"``)."""
    return F.initcap(F.trim(_col(c), F.lit(" \t\r\n")))


def flag(condition: Column) -> Column:
    """0/1 flag; an unknown condition is 0."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def cap_at(c, cap) -> Column:
    """Upper clip that keeps NULL (``least`` would return the cap)."""
    c = _col(c)
    return F.when(c > cap, cap).otherwise(c)


def as_double(c) -> Column:
    return _col(c).cast("double")


def safe_ratio(num, den) -> Column:
    """num / den as double, NULL when den is 0 or NULL."""
    den = as_double(den)
    return as_double(num) / F.nullif(den, F.lit(0.0))


def percent(num, den) -> Column:
    return F.lit(100.0) * as_double(num) / F.nullif(as_double(den), F.lit(0.0))


def score_round(c, digits: int = 1) -> Column:
    """Half-even rounding that ignores the last bits of a sum.

    Distributed sums differ in their last bits from run to run; dropping those
    first keeps exact ties from falling to either side.
    """
    return F.bround(F.round(_col(c), 9), digits)


def count_rows() -> Column:
    return F.count(F.lit(1))


def count_where(condition: Column) -> Column:
    return F.count_if(condition)


def mean_where(condition: Column, c) -> Column:
    return F.avg(F.when(condition, as_double(c)))


def seconds_between(start, end) -> Column:
    """Elapsed seconds of two zone-less timestamps, whatever the session time zone."""
    gap = _col(end) - _col(start)

    def part(unit):
        return F.extract(F.lit(unit), gap).cast("double")

    return part("DAY") * 86400 + part("HOUR") * 3600 + part("MINUTE") * 60 + part("SECOND")


def days_between(start, end) -> Column:
    return seconds_between(start, end) / F.lit(86400.0)


def month_of(c) -> Column:
    return F.date_format(_col(c).cast("date"), "yyyy-MM")


def week_of(c) -> Column:
    """Monday of the calendar week."""
    return F.trunc(_col(c).cast("date"), "week")


def first_midnight_from(c) -> Column:
    """The first midnight at or after ``c``, as a date.

    ``c <= midnight(d)`` holds exactly when ``first_midnight_from(c) <= d``, which
    lets events be summed per day before they meet any cutoff.
    """
    c = _col(c)
    day = c.cast("date")
    return F.when(c > day.cast("timestamp_ntz"), F.date_add(day, 1)).otherwise(day)


def in_order(c, domain) -> Column:
    """Sort key placing values in domain order, unknown values last."""
    c = _col(c)
    cases = reduce(
        lambda acc, item: acc.when(c == item[1], F.lit(item[0])),
        enumerate(domain),
        F,
    )
    return cases.otherwise(F.lit(len(domain)))


def risk_tier(score) -> Column:
    score = _col(score)
    return F.when(score >= 65, "High Risk").when(score >= 40, "Medium Risk").otherwise("Low Risk")


def phrases(*pairs, fallback: str) -> Column:
    """Join the texts whose condition holds with "; ", or give the fallback."""
    text = F.concat_ws("; ", *[F.when(condition, F.lit(label)) for condition, label in pairs])
    return F.when(text == "", F.lit(fallback)).otherwise(text)
