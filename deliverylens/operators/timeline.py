"""As-of totals on daily pre-aggregated events.

Events are summed per (key, day) before they are ordered, so the ordered pass
holds at most one row per calendar day and key, whatever the number of events
or the share of the busiest key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def dated_events(df: DataFrame, key: str, events: list[tuple[Column, dict[str, Column]]]) -> DataFrame:
    """One row per fact and event: key, day and the event's measures (0 where it has none).

    A fact may raise several events, such as being opened and closed; all come
    from one scan. Events without a key or day drop out.
    """
    names = list(dict.fromkeys(n for _, measures in events for n in measures))
    structs = [
        F.struct(day.alias("day"), *[measures.get(n, F.lit(0)).alias(n) for n in names])
        for day, measures in events
    ]
    rows = df.filter(F.col(key).isNotNull()).select(key, F.inline(F.array(*structs)))
    return rows.filter(F.col("day").isNotNull())


def totals_as_of(
    events: list[DataFrame],
    cutoffs: DataFrame,
    key: str,
    cutoff: str,
    trailing_days: dict[str, int] | None = None,
    strictly_before: bool = False,
) -> DataFrame:
    """Running totals of every measure at each distinct (key, cutoff).

    Measures named in ``trailing_days`` cover only the last so many days up to
    the cutoff, the others all of history. ``strictly_before`` leaves the
    cutoff day itself out.
    """
    trailing = trailing_days or {}
    marks = cutoffs.select(F.col(key), F.col(cutoff).alias("day"), F.lit(1).alias("_mark"))
    merged = marks
    for frame in events:
        merged = merged.unionByName(frame, allowMissingColumns=True)
    measures = [c for c in merged.columns if c not in (key, "day", "_mark")]
    daily = merged.groupBy(key, "day").agg(
        F.max("_mark").alias("_mark"), *[F.coalesce(F.sum(m), F.lit(0)).alias(m) for m in measures]
    )
    number = F.datediff("day", F.to_date(F.lit("1970-01-01")))
    line = Window.partitionBy(key).orderBy(number)
    last = -1 if strictly_before else 0
    everything = line.rangeBetween(Window.unboundedPreceding, last)
    totals = [
        F.coalesce(
            F.sum(m).over(line.rangeBetween(1 - trailing[m], last) if m in trailing else everything), F.lit(0)
        ).alias(m)
        for m in measures
    ]
    return (
        daily.select(key, F.col("day").alias(cutoff), "_mark", *totals)
        .filter(F.col("_mark") == 1)
        .drop("_mark")
    )
