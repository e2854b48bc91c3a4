"""Exploratory aggregates: trends, distributions and correlations."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window, functions as F

from deliverylens.functions.scalars import as_double, count_rows, in_order, month_of, percent, safe_ratio
from deliverylens.operators.profile import (
    correlation_matrix,
    histogram,
    linear_fit,
    notable_correlations,
    pivot_counts,
    profile,
)
from deliverylens.operators.quantiles import box_stats, exact_quantiles
from deliverylens.operators.ranking import hash_sample
from deliverylens.operators.rollup import align_on_key, rollup_via
from deliverylens.schema import CRITICALITIES, SEVERITIES

Tables = Mapping[str, DataFrame]

PROJECT_METRICS = (
    "completion_rate",
    "cycle_time",
    "defect_density",
    "review_time",
    "deploy_count",
    "change_failure_rate",
    "avg_release_delay",
)


def preview(df: DataFrame, key: str, n: int = 20) -> DataFrame:
    """The first ``n`` rows by a unique key. Each task sends ``n`` rows at most."""
    return df.orderBy(key).limit(n)


def completion_by_team(t: Tables) -> DataFrame:
    """Completion distribution per team name, best mean first."""
    named = t["sprints"].join(t["teams"].select("team_id", "team_name"), "team_id")
    return box_stats(named, "sprint_completion_rate", ["team_name"]).orderBy(F.desc("mean"), "team_name")


def rolling_velocity(t: Tables, window: int = 5) -> DataFrame:
    """Mean completed points per start date and their rolling mean."""
    known = t["sprints"].join(t["teams"].select("team_id"), "team_id", "left_semi")
    per_date = (
        known.filter(F.col("sprint_start_date").isNotNull())
        .groupBy("sprint_start_date")
        .agg(F.avg("completed_story_points").alias("velocity"))
    )
    # one row per calendar date, so the single ordered pass stays small
    recent = Window.orderBy("sprint_start_date").rowsBetween(1 - window, 0)
    return per_date.withColumn("rolling_velocity", F.avg("velocity").over(recent))


def bug_severity_by_month(t: Tables) -> DataFrame:
    bugs = t["issues"].filter((F.col("issue_type") == "Bug") & F.col("severity").isNotNull())
    return pivot_counts(bugs.withColumn("month", month_of("created_date")), "month", "severity", SEVERITIES).orderBy(
        "month"
    )


def reopen_rate_by_team(t: Tables) -> DataFrame:
    bugs = t["issues"].filter(F.col("issue_type") == "Bug")
    sums = rollup_via(
        bugs,
        "team_id",
        t["teams"].select("team_id", "team_name"),
        ["team_name"],
        {"reopened": F.sum("reopened"), "rated": F.count("reopened")},
    )
    return sums.select("team_name", percent("reopened", "rated").alias("reopen_rate_pct")).orderBy(
        F.desc("reopen_rate_pct"), "team_name"
    )


def review_time_fit(t: Tables) -> DataFrame:
    """Review hours against pull request size, fitted over all timed reviews."""
    return linear_fit(
        t["pull_requests"].filter(F.col("review_time_hours").isNotNull()), "pr_size_lines", "review_time_hours"
    )


def review_sample(t: Tables, n: int = 1000, seed: int = 1) -> DataFrame:
    """A repeatable scatter sample of size and review hours."""
    timed = t["pull_requests"].filter(F.col("review_time_hours").isNotNull())
    return hash_sample(
        timed.select("pull_request_id", "pr_size_lines", "review_time_hours"), "pull_request_id", n, seed
    )


def review_time_by_team(t: Tables) -> DataFrame:
    timed = t["pull_requests"].filter(F.col("review_time_hours").isNotNull())
    per_team = rollup_via(
        timed,
        "sprint_id",
        t["sprints"].select("sprint_id", "team_id"),
        ["team_id"],
        {"hours": F.sum(as_double("review_time_hours")), "n": count_rows()},
    )
    named = rollup_via(
        per_team,
        "team_id",
        t["teams"].select("team_id", "team_name"),
        ["team_name"],
        {"hours": F.sum("hours"), "n": F.sum("n")},
    )
    return named.select("team_name", safe_ratio("hours", "n").alias("avg_review_hours")).orderBy(
        F.desc("avg_review_hours"), "team_name"
    )


def monthly_deployments(t: Tables) -> DataFrame:
    return (
        t["deployments"]
        .filter(F.col("deployment_timestamp").isNotNull())
        .groupBy(month_of("deployment_timestamp").alias("month"))
        .agg(F.count("deployment_id").alias("deploys"), F.avg(as_double("is_failure")).alias("failure_rate"))
        .orderBy("month")
    )


def delay_by_criticality(t: Tables) -> DataFrame:
    """Box statistics by criticality; delays of projects with no or another one count nowhere."""
    held = t["releases"].filter(F.coalesce("status", F.lit("")) != "Cancelled")
    named = held.join(t["projects"].select("project_id", "criticality"), "project_id").filter(
        F.col("criticality").isin(*CRITICALITIES)
    )
    return box_stats(named, "release_delay_days", ["criticality"]).orderBy(
        in_order("criticality", CRITICALITIES)
    )


def issues_per_developer(t: Tables) -> DataFrame:
    return (
        t["issues"]
        .filter(F.col("assignee_id").isNotNull())
        .groupBy("assignee_id")
        .agg(count_rows().alias("issues_assigned"))
    )


def load_histogram(t: Tables, bins: int = 25) -> DataFrame:
    return histogram(issues_per_developer(t), "issues_assigned", bins)


def load_quantiles(t: Tables) -> DataFrame:
    q = exact_quantiles(issues_per_developer(t), "issues_assigned", [0.5, 0.9, 1.0])
    return q.select(
        F.col("n").alias("developers"),
        F.element_at("quantiles", 1).alias("median_issues"),
        F.element_at("quantiles", 2).alias("p90_issues"),
        F.element_at("quantiles", 3).cast("bigint").alias("max_issues"),
    )


def project_metrics(t: Tables, keep_unknown: bool = False) -> DataFrame:
    """Seven metrics per project. ``keep_unknown`` also keeps ids missing from projects."""
    bug = F.col("issue_type") == "Bug"

    def grouped(name):
        return t[name].filter(F.col("project_id").isNotNull()).groupBy("project_id")

    frames = [
        grouped("sprints").agg(F.avg("sprint_completion_rate").alias("completion_rate")),
        grouped("issues").agg(
            F.avg(F.when(F.col("resolved_date").isNotNull(), F.col("cycle_time_days"))).alias("cycle_time"),
            (as_double(F.nullif(F.count_if(bug), F.lit(0))) / count_rows()).alias("defect_density"),
        ),
        grouped("pull_requests").agg(F.avg(as_double("review_time_hours")).alias("review_time")),
        grouped("deployments").agg(
            count_rows().alias("deploy_count"), F.avg(as_double("is_failure")).alias("change_failure_rate")
        ),
        grouped("releases").agg(
            F.avg(F.when(F.coalesce("status", F.lit("")) != "Cancelled", F.col("release_delay_days"))).alias(
                "avg_release_delay"
            )
        ),
    ]
    metrics = align_on_key(frames, "project_id")
    if not keep_unknown:
        metrics = t["projects"].select("project_id").join(metrics, "project_id", "left")
    return metrics.select("project_id", *PROJECT_METRICS)


def metric_correlations(t: Tables) -> DataFrame:
    return correlation_matrix(project_metrics(t), list(PROJECT_METRICS))


def notable_metric_correlations(t: Tables, threshold: float = 0.4) -> DataFrame:
    return notable_correlations(project_metrics(t), list(PROJECT_METRICS), threshold)


def issue_profile(t: Tables) -> DataFrame:
    return profile(
        t["issues"],
        ["resolution_time_hours", "reopened", "escaped_defect", "cycle_time_days"],
        [
            "project_id",
            "sprint_id",
            "team_id",
            "assignee_id",
            "issue_type",
            "priority",
            "severity",
            "status",
            "created_date",
            "resolved_date",
        ],
        # cleaning leaves one row a key
        keys=["issue_id"],
    )
