"""Team, project and developer KPIs.

Rates are NULL where there is nothing to rate. Groups with a missing key are
left out, unlike in the question pack.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from deliverylens.functions.scalars import (
    as_double,
    count_rows,
    days_between,
    safe_ratio,
    score_round,
    week_of,
)
from deliverylens.operators.quantiles import exact_quantile
from deliverylens.operators.rollup import align_on_key, left_star, rollup_via
from deliverylens.operators.scaling import scaled, with_ranges
from deliverylens.session import materialized

Tables = Mapping[str, DataFrame]

# Weights of the composite scores.
HEALTH_WEIGHTS = {"quality": 0.35, "delivery": 0.35, "devops": 0.30}
WORKLOAD_WEIGHTS = {"commit_count": 1, "pr_count": 3, "issues_resolved": 2}
PRODUCTIVITY_WEIGHTS = {"delivery": 0.40, "quality": 0.25, "collaboration": 0.20, "balance": 0.15}


def _health(quality, delivery, devops):
    return (
        F.lit(HEALTH_WEIGHTS["quality"]) * quality
        + F.lit(HEALTH_WEIGHTS["delivery"]) * delivery
        + F.lit(HEALTH_WEIGHTS["devops"]) * devops
    )


def _keyed(df: DataFrame, key: str) -> DataFrame:
    return df.filter(F.col(key).isNotNull())


def sprint_kpis(sprints: DataFrame) -> DataFrame:
    return (
        _keyed(sprints, "team_id")
        .groupBy("team_id")
        .agg(
            F.avg("sprint_completion_rate").alias("avg_sprint_completion_rate"),
            F.avg("completed_story_points").alias("avg_sprint_velocity"),
            F.count("sprint_id").alias("sprints_count"),
        )
    )


def issue_kpis(issues: DataFrame) -> DataFrame:
    """Cycle time, MTTR and bug rates in one pass over the issues."""
    bug = F.col("issue_type") == "Bug"
    resolved = F.col("resolved_date").isNotNull()
    bugs = F.nullif(F.count_if(bug), F.lit(0))
    return (
        _keyed(issues, "team_id")
        .groupBy("team_id")
        .agg(
            F.avg(F.when(resolved, F.col("cycle_time_days"))).alias("avg_cycle_time_days"),
            F.avg(F.when(bug & resolved, F.col("resolution_time_hours"))).alias("mttr_hours"),
            (as_double(F.sum(F.when(bug, F.col("reopened")))) / bugs * 100).alias("bug_reopen_rate_pct"),
            (as_double(F.sum(F.when(bug, F.col("escaped_defect")))) / bugs * 100).alias("escaped_defect_rate_pct"),
            (as_double(bugs) / count_rows() * 100).alias("defect_density_pct"),
        )
    )


def review_kpis(pull_requests: DataFrame, sprints: DataFrame) -> DataFrame:
    sums = rollup_via(
        pull_requests,
        "sprint_id",
        sprints.select("sprint_id", "team_id"),
        ["team_id"],
        {
            "hours": F.sum(as_double("review_time_hours")),
            "reviewed": F.count("review_time_hours"),
            "merged": F.sum("is_merged"),
            "total": count_rows(),
        },
        how="left",
    )
    return _keyed(sums, "team_id").select(
        "team_id",
        safe_ratio("hours", "reviewed").alias("avg_pr_review_hours"),
        (safe_ratio("merged", "total") * 100).alias("pr_merge_rate_pct"),
    )


def deployment_kpis(deployments: DataFrame, sprints: DataFrame) -> DataFrame:
    sums = rollup_via(
        deployments,
        "sprint_id",
        sprints.select("sprint_id", "team_id"),
        ["team_id"],
        {"failed": F.sum("is_failure"), "total_deployments": count_rows()},
        how="left",
    )
    return _keyed(sums, "team_id").select(
        "team_id",
        (safe_ratio("failed", "total_deployments") * 100).alias("change_failure_rate_pct"),
        "total_deployments",
    )


def deploy_frequency(deployments: DataFrame, sprints: DataFrame) -> DataFrame:
    """Deployments per week by team: over the active span, and per week with any deployment."""
    per_week = (
        deployments.groupBy("sprint_id", week_of("deployment_timestamp").alias("week"))
        .agg(
            count_rows().alias("n"),
            F.min("deployment_timestamp").alias("first_ts"),
            F.max("deployment_timestamp").alias("last_ts"),
        )
        .join(sprints.select("sprint_id", "team_id"), "sprint_id")
        .groupBy("team_id", "week")
        .agg(F.sum("n").alias("n"), F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts"))
    )
    return (
        _keyed(per_week, "team_id")
        .groupBy("team_id")
        .agg(
            F.sum("n").alias("deployments"),
            F.count("week").alias("active_weeks"),
            F.min("first_ts").alias("first_ts"),
            F.max("last_ts").alias("last_ts"),
        )
        .select(
            "team_id",
            "deployments",
            "active_weeks",
            (F.col("deployments") / (days_between("first_ts", "last_ts") + 1) * 7).alias("deploys_per_week_span"),
            (F.col("deployments") / F.greatest(F.lit(1), F.col("active_weeks"))).alias("deploys_per_active_week"),
        )
    )


def release_kpis(releases: DataFrame) -> DataFrame:
    """Rates cover all releases, the mean delay leaves cancelled ones out."""
    status = F.col("status")
    return (
        _keyed(releases, "team_id")
        .groupBy("team_id")
        .agg(
            count_rows().alias("total_releases"),
            (as_double(F.count_if(status == "On Time")) / count_rows() * 100).alias("release_success_rate_pct"),
            (as_double(F.count_if(status == "Delayed")) / count_rows() * 100).alias("release_delay_rate_pct"),
            F.avg(F.when(F.coalesce(status, F.lit("")) != "Cancelled", F.col("release_delay_days"))).alias(
                "avg_release_delay_days"
            ),
        )
    )


def team_kpis(t: Tables) -> DataFrame:
    """The team KPI table: every team, its KPIs and composite scores."""
    base = t["teams"].select("team_id", "team_name")
    kpis = left_star(
        base,
        [
            sprint_kpis(t["sprints"]),
            issue_kpis(t["issues"]),
            review_kpis(t["pull_requests"], t["sprints"]),
            deployment_kpis(t["deployments"], t["sprints"]),
            release_kpis(t["releases"]),
        ],
        "team_id",
    )
    return with_team_scores(kpis)


def with_team_scores(kpis: DataFrame) -> DataFrame:
    """A missing defect or failure rate counts as 0, a missing completion rate stays missing."""
    scored = kpis.withColumns(
        {
            "quality_score": 100 - F.coalesce("escaped_defect_rate_pct", F.lit(0.0)),
            "delivery_score": F.col("avg_sprint_completion_rate") * 100,
            "devops_score": 100 - F.coalesce("change_failure_rate_pct", F.lit(0.0)),
        }
    )
    return scored.withColumn(
        "team_health_score",
        score_round(_health(F.col("quality_score"), F.col("delivery_score"), F.col("devops_score")), 1),
    )


def project_health(t: Tables) -> DataFrame:
    """Project scores; a project lacking one pillar keeps its row with a missing score."""
    quality = (
        _keyed(t["issues"], "project_id")
        .filter(F.col("issue_type") == "Bug")
        .groupBy("project_id")
        .agg((F.lit(100.0) * (1 - F.avg(as_double("escaped_defect")))).alias("quality_score"))
    )
    delivery = (
        _keyed(t["sprints"], "project_id")
        .groupBy("project_id")
        .agg((F.avg("sprint_completion_rate") * 100).alias("delivery_score"))
    )
    devops = (
        _keyed(t["deployments"], "project_id")
        .groupBy("project_id")
        .agg((F.lit(100.0) * (1 - F.avg(as_double("is_failure")))).alias("devops_score"))
    )
    aligned = align_on_key([quality, delivery, devops], "project_id")
    return (
        aligned.withColumn(
            "project_health_score",
            score_round(_health(F.col("quality_score"), F.col("delivery_score"), F.col("devops_score")), 1),
        )
        .join(t["projects"].select("project_id", "project_name", "criticality"), "project_id", "left")
        .orderBy(F.asc_nulls_last("project_health_score"), "project_id")
    )


def _per_developer(df: DataFrame, column: str, name: str) -> DataFrame:
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("developer_id"))
        .agg(count_rows().alias(name))
    )


def developer_workload(t: Tables) -> DataFrame:
    """Activity counts per developer and the weighted workload index."""
    counts = ["commit_count", "pr_count", "issues_resolved", "reviews_given"]
    finished = t["issues"].filter(F.col("status") == "Done")
    activity = align_on_key(
        [
            _per_developer(t["commits"], "developer_id", counts[0]),
            _per_developer(t["pull_requests"], "author_id", counts[1]),
            _per_developer(finished, "assignee_id", counts[2]),
            _per_developer(t["code_reviews"], "reviewer_id", counts[3]),
        ],
        "developer_id",
    )
    index = sum((F.col(c) * w for c, w in WORKLOAD_WEIGHTS.items()), F.lit(0))
    return (
        t["developers"]
        .select("developer_id", "full_name", "team_id", "seniority")
        .join(activity, "developer_id", "left")
        .fillna(0, counts)
        .withColumn("workload_index", index)
    )


def productivity(t: Tables, workload: DataFrame) -> DataFrame:
    """A balanced 0-100 score per developer: delivery, quality, collaboration, balance."""
    reopened = (
        t["issues"]
        .filter((F.col("issue_type") == "Bug") & F.col("assignee_id").isNotNull())
        .groupBy(F.col("assignee_id").alias("developer_id"))
        .agg(F.avg(as_double("reopened")).alias("reopen_rate"))
    )
    joined = workload.join(reopened, "developer_id", "left").fillna(0.0, ["reopen_rate"])
    return with_productivity_score(joined).orderBy(
        F.desc_nulls_last("engineering_productivity_score"), "developer_id"
    )


def with_productivity_score(developers: DataFrame) -> DataFrame:
    # a median and then whole-column ranges are needed, so both inputs are kept
    kept = materialized(developers, "developers")
    middle = exact_quantile(kept, "workload_index", 0.5)
    placed = materialized(kept.withColumn("_off_median", F.abs(F.col("workload_index") - middle)), "developers")
    parts = {
        "delivery": as_double(F.col("issues_resolved") + F.col("pr_count")),
        "quality": as_double("reopen_rate"),
        "collaboration": as_double("reviews_given"),
        "balance": F.col("_off_median"),
    }
    unit = {name: scaled(value, name) for name, value in parts.items()}
    weight = {name: F.lit(w) for name, w in PRODUCTIVITY_WEIGHTS.items()}
    score = F.lit(100) * (
        weight["delivery"] * unit["delivery"]
        + weight["quality"] * (1 - unit["quality"])
        + weight["collaboration"] * unit["collaboration"]
        + weight["balance"] * (1 - unit["balance"])
    )
    return with_ranges(placed, parts).select(
        *developers.columns, score_round(score, 1).alias("engineering_productivity_score")
    )
