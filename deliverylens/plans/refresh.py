"""Team KPIs kept up to date week by week.

Each week's facts are reduced to sums, counts and rank sketches per team, which are kept.
A refresh reads the facts of the weeks it is given and replaces what is kept of those weeks;
the KPIs of all weeks come from adding up what is kept. A refresh that is repeated, or
follows a failed one, leaves the same state.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from deliverylens.functions.scalars import as_double, count_rows, safe_ratio, week_of
from deliverylens.operators.sketches import SIZE, merged_sketches
from deliverylens.plans.kpi import with_team_scores

Tables = Mapping[str, DataFrame]

# the date by which a fact belongs to a week
DATES = {
    "sprints": "sprint_start_date",
    "issues": "created_date",
    "pull_requests": "opened_date",
    "deployments": "deployment_timestamp",
    "releases": "planned_release_date",
}


def weeks_of(t: Tables) -> list[date | None]:
    """The first days of all weeks with facts, None for facts without a date. The driver
    holds one value a week."""
    found = None
    for name, column in DATES.items():
        weeks = t[name].select(week_of(column).cast("date").alias("week")).distinct()
        found = weeks if found is None else found.unionAll(weeks)
    return sorted((r[0] for r in found.distinct().collect()), key=lambda w: (w is not None, w))


def _of_weeks(df: DataFrame, column: str, weeks: Sequence[date | None]) -> DataFrame:
    """The rows of the given weeks, with ``week``. The span of dates reaches the scan."""
    dated = [w for w in weeks if w is not None]
    c = F.col(column)
    inside = F.lit(False)
    if dated:
        kind = df.schema[column].dataType
        first, end = (F.lit(d).cast(kind) for d in (min(dated), max(dated) + timedelta(days=7)))
        inside = (c >= first) & (c < end) & week_of(column).cast("date").isin(*dated)
    if None in weeks:
        inside = inside | c.isNull()
    return df.filter(inside).withColumn("week", week_of(column).cast("date"))


def _measures(t: Tables, weeks: Sequence[date | None]) -> list[tuple[DataFrame, dict[str, Column]]]:
    """Facts of the weeks, and their sums per team. Teams of pull requests and deployments
    are those of their sprints, met after the facts are summed by sprint."""
    facts = {name: _of_weeks(t[name], column, weeks) for name, column in DATES.items()}
    bug, resolved = F.col("issue_type") == "Bug", F.col("resolved_date").isNotNull()
    cycle = F.when(resolved, as_double("cycle_time_days"))
    repair = F.when(bug & resolved, as_double("resolution_time_hours"))
    delay = F.when(F.coalesce("status", F.lit("")) != "Cancelled", as_double("release_delay_days"))
    sprint_teams = t["sprints"].select("sprint_id", "team_id")

    def by_sprint(name: str, sums: dict[str, Column]) -> DataFrame:
        own = facts[name].groupBy("week", "sprint_id").agg(*[c.alias(n) for n, c in sums.items()])
        return own.join(sprint_teams, "sprint_id", "left")

    reviews = {
        "review_hours": F.sum(as_double("review_time_hours")),
        "reviews": F.count("review_time_hours"),
        "merged": F.sum("is_merged"),
        "pull_requests": count_rows(),
    }
    deploys = {"failed": F.sum("is_failure"), "deployments": count_rows()}
    return [
        (
            facts["sprints"],
            {
                "rates": F.sum("sprint_completion_rate"),
                "rated": F.count("sprint_completion_rate"),
                "points": F.sum(as_double("completed_story_points")),
                "pointed": F.count("completed_story_points"),
                "sprints": F.count("sprint_id"),
            },
        ),
        (
            facts["issues"],
            {
                "cycle_days": F.sum(cycle),
                "cycles": F.count(cycle),
                "repair_hours": F.sum(repair),
                "repairs": F.count(repair),
                "bugs": F.count_if(bug),
                "reopened": F.sum(F.when(bug, F.col("reopened"))),
                "escaped": F.sum(F.when(bug, F.col("escaped_defect"))),
                "issues": count_rows(),
                "cycle_sketch": F.kll_sketch_agg_double(cycle, F.lit(SIZE)),
            },
        ),
        (by_sprint("pull_requests", reviews), {n: F.sum(n) for n in reviews}),
        (by_sprint("deployments", deploys), {n: F.sum(n) for n in deploys}),
        (
            facts["releases"],
            {
                "releases": count_rows(),
                "on_time": F.count_if(F.col("status") == "On Time"),
                "delayed": F.count_if(F.col("status") == "Delayed"),
                "delay_days": F.sum(delay),
                "delays": F.count(delay),
            },
        ),
    ]


def refresh(t: Tables, folder: str, weeks: Sequence[date | None]) -> None:
    """Replace what ``folder`` keeps of the given weeks (first days, None for facts without a
    date) by what ``t`` holds of them now: those with new rows and those whose rows changed."""
    spark = t["sprints"].sparkSession
    # an empty row for each week, so that a week that has lost all its facts is replaced as well
    parts = spark.createDataFrame([(w,) for w in weeks], "week date").withColumn("team_id", F.lit(None).cast("string"))
    for facts, sums in _measures(t, weeks):
        part = facts.groupBy("week", F.col("team_id").cast("string").alias("team_id")).agg(*[c.alias(n) for n, c in sums.items()])
        parts = parts.unionByName(part, allowMissingColumns=True)
    parts.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("week").parquet(folder)


def kept_weeks(spark: SparkSession, folder: str) -> DataFrame:
    """What is kept: per week and team (a few rows each), the sums of every fact table."""
    return spark.read.parquet(folder)


def team_kpis(kept: DataFrame, teams: DataFrame) -> DataFrame:
    """The team KPI table from kept sums: the same rows as from all facts at once."""
    totals = [f.name for f in kept.schema.fields if f.name not in ("week", "team_id", "cycle_sketch")]
    summed = kept.filter(F.col("team_id").isNotNull()).groupBy("team_id").agg(*[F.sum(c).alias(c) for c in totals])

    def percent_of(a: str, b: str) -> Column:
        return safe_ratio(a, b) * 100

    # a team without rows in a fact table has no figure of it, not a zero
    some = lambda c: F.when(F.col(c) > 0, F.col(c))
    figures = summed.select(
        F.col("team_id").alias("_team"),
        safe_ratio("rates", "rated").alias("avg_sprint_completion_rate"),
        safe_ratio("points", "pointed").alias("avg_sprint_velocity"),
        some("sprints").alias("sprints_count"),
        safe_ratio("cycle_days", "cycles").alias("avg_cycle_time_days"),
        safe_ratio("repair_hours", "repairs").alias("mttr_hours"),
        percent_of("reopened", "bugs").alias("bug_reopen_rate_pct"),
        percent_of("escaped", "bugs").alias("escaped_defect_rate_pct"),
        (safe_ratio(F.nullif("bugs", F.lit(0)), "issues") * 100).alias("defect_density_pct"),
        safe_ratio("review_hours", "reviews").alias("avg_pr_review_hours"),
        percent_of("merged", "pull_requests").alias("pr_merge_rate_pct"),
        percent_of("failed", "deployments").alias("change_failure_rate_pct"),
        some("deployments").alias("total_deployments"),
        some("releases").alias("total_releases"),
        percent_of("on_time", "releases").alias("release_success_rate_pct"),
        percent_of("delayed", "releases").alias("release_delay_rate_pct"),
        safe_ratio("delay_days", "delays").alias("avg_release_delay_days"),
    )
    named = teams.select("team_id", "team_name")
    joined = named.join(figures, named["team_id"].cast("string") == F.col("_team"), "left").drop("_team")
    return with_team_scores(joined)


def cycle_sketches(kept: DataFrame) -> DataFrame:
    """team_id (as text), n and the rank sketch of all kept cycle times."""
    parts = kept.filter("team_id IS NOT NULL AND cycle_sketch IS NOT NULL AND cycles > 0")
    return merged_sketches(parts.select("team_id", F.col("cycles").alias("n"), F.col("cycle_sketch").alias("sketch")), ["team_id"])
