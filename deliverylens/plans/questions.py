"""The delivery question pack: sprints, quality, review, DevOps and releases.

Every function takes a mapping of cleaned tables. Facts are reduced per key
before dimensions are joined, so no question shuffles fact rows by a skewed
key, and ORDER BY / LIMIT always ends in a unique tiebreak.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from deliverylens.functions.scalars import count_rows, days_between, month_of, percent, safe_ratio
from deliverylens.operators.dedupe import top_per_group
from deliverylens.operators.ranking import (
    above_mean_plus_sigma,
    halves_by_date,
    percent_rank_of_counts,
    running_total_of_counts,
)
from deliverylens.operators.rollup import rollup_via

Tables = Mapping[str, DataFrame]


def is_bug() -> Column:
    return F.col("issue_type") == "Bug"


def _sum(c: str) -> Column:
    return F.sum(F.col(c))


def _total(c: str) -> Column:
    return F.sum(F.col(c).cast("double"))


def _named(dim: DataFrame, key: str, name: str) -> DataFrame:
    return dim.select(key, name)


def _sprint_teams(t: Tables) -> DataFrame:
    return t["sprints"].select("sprint_id", "team_id")


def team_completion(t: Tables, min_sprints: int = 5) -> DataFrame:
    """Teams by average completion, given enough sprints."""
    sums = rollup_via(
        t["sprints"],
        "team_id",
        _named(t["teams"], "team_id", "team_name"),
        ["team_name"],
        {"rate": _total("sprint_completion_rate"), "rated": F.count("sprint_completion_rate"), "n": count_rows()},
    )
    return (
        sums.filter(F.col("n") >= min_sprints)
        .select(
            "team_name",
            F.round(safe_ratio("rate", "rated") * 100, 1).alias("avg_completion_pct"),
            F.col("n").alias("sprints_analyzed"),
        )
        .orderBy(F.desc_nulls_last("avg_completion_pct"), "team_name")
    )


def recent_velocity(t: Tables, sprints: int = 5) -> DataFrame:
    """Average completed points in each team's latest sprints, across its projects."""
    latest = top_per_group(
        t["sprints"], ["team_id"], [F.desc("sprint_start_date"), F.asc("sprint_id")], sprints
    ).join(t["teams"].select("team_id", "team_name"), "team_id")
    return (
        latest.groupBy("team_name")
        .agg(F.round(F.avg("completed_story_points"), 1).alias("avg_velocity_last5"))
        .orderBy(F.desc_nulls_last("avg_velocity_last5"), "team_name")
    )


def velocity_trend(t: Tables) -> DataFrame:
    """Earlier against later half of every team's sprints."""
    halves = halves_by_date(t["sprints"], "team_id", "sprint_start_date", "sprint_id", "completed_story_points")
    named = (
        halves.join(t["teams"].select("team_id", "team_name"), "team_id")
        .groupBy("team_name")
        .agg(*[F.sum(c).alias(c) for c in ("_s1", "_n1", "_s2", "_n2")])
    )
    first, second = safe_ratio("_s1", "_n1"), safe_ratio("_s2", "_n2")
    return (
        named.select(
            "team_name",
            F.round(first, 1).alias("first_half_avg_velocity"),
            F.round(second, 1).alias("second_half_avg_velocity"),
            F.when(second > first, "Improving").when(second < first, "Declining").otherwise("Stable").alias("trend"),
            (second - first).alias("_change"),
        )
        .orderBy(F.desc_nulls_last("_change"), "team_name")
        .drop("_change")
    )


def cycle_time_by_priority(t: Tables) -> DataFrame:
    mean = F.avg("cycle_time_days")
    return (
        t["issues"]
        .filter(F.col("resolved_date").isNotNull())
        .groupBy("priority")
        .agg(
            F.round(mean, 2).alias("avg_cycle_time_days"),
            F.when(mean <= 1, "Fast").when(mean <= 3, "Acceptable").otherwise("Slow").alias("speed_rating"),
        )
        .orderBy(F.desc_nulls_last("avg_cycle_time_days"))
    )


def _per_project(t: Tables, fact: DataFrame, measures: dict[str, Column], keep=None) -> DataFrame:
    return rollup_via(
        fact, "project_id", _named(t["projects"], "project_id", "project_name"), ["project_name"], measures, keep=keep
    )


def _per_team(t: Tables, fact: DataFrame, measures: dict[str, Column]) -> DataFrame:
    return rollup_via(fact, "team_id", _named(t["teams"], "team_id", "team_name"), ["team_name"], measures)


def _per_sprint_team(t: Tables, fact: DataFrame, measures: dict[str, Column]) -> DataFrame:
    """Sums per team name for facts that know only their sprint."""
    per_team = rollup_via(fact, "sprint_id", _sprint_teams(t), ["team_id"], measures)
    return rollup_via(
        per_team, "team_id", _named(t["teams"], "team_id", "team_name"), ["team_name"], {n: F.sum(n) for n in measures}
    )


def late_projects(t: Tables, threshold_pct: float = 30) -> DataFrame:
    rate = F.round(percent("delayed_releases", "total_releases"), 1)
    return (
        _per_project(t, t["releases"], {"total_releases": count_rows(), "delayed_releases": _sum("is_delayed")})
        .select("project_name", "total_releases", "delayed_releases", rate.alias("delay_rate_pct"))
        .filter(F.col("delay_rate_pct") > threshold_pct)
        .orderBy(F.desc("delay_rate_pct"), "project_name")
    )


def defect_rate(t: Tables) -> DataFrame:
    return (
        _per_project(t, t["issues"], {"bug_count": F.count_if(is_bug()), "total_issues": count_rows()})
        .withColumn("defect_rate_pct", F.round(percent("bug_count", "total_issues"), 1))
        .orderBy(F.desc_nulls_last("defect_rate_pct"), "project_name")
    )


def reopened_bugs_by_team(t: Tables) -> DataFrame:
    return (
        _per_team(t, t["issues"].filter(is_bug()), {"reopened_bugs": _sum("reopened"), "total_bugs": count_rows()})
        .withColumn("reopen_rate_pct", F.round(percent("reopened_bugs", "total_bugs"), 1))
        .orderBy(F.desc_nulls_last("reopen_rate_pct"), "team_name")
    )


def reopened_bugs_with_overall(t: Tables) -> DataFrame:
    """The by-team rates plus one row over all teams (``team_name`` NULL)."""
    sums = _per_team(t, t["issues"].filter(is_bug()), {"reopened_bugs": _sum("reopened"), "total_bugs": count_rows()})
    return (
        sums.rollup("team_name")
        .agg(F.sum("reopened_bugs").alias("reopened_bugs"), F.sum("total_bugs").alias("total_bugs"))
        .withColumn("reopen_rate_pct", F.round(percent("reopened_bugs", "total_bugs"), 1))
    )


def escaped_defects_top(t: Tables, k: int = 10) -> DataFrame:
    return (
        _per_project(
            t, t["issues"].filter(is_bug()), {"escaped_defects": _sum("escaped_defect"), "total_bugs": count_rows()}
        )
        .withColumn("escaped_rate_pct", F.round(percent("escaped_defects", "total_bugs"), 1))
        .orderBy(F.desc_nulls_last("escaped_rate_pct"), "project_name")
        .limit(k)
    )


def mttr_by_severity(t: Tables) -> DataFrame:
    place = F.when(F.col("severity") == "Blocker", 1)
    for rank, name in ((2, "Critical"), (3, "Major"), (4, "Minor")):
        place = place.when(F.col("severity") == name, rank)
    return (
        t["issues"]
        .filter(is_bug() & F.col("resolved_date").isNotNull())
        .groupBy("severity")
        .agg(F.round(F.avg("resolution_time_hours"), 1).alias("mttr_hours"), count_rows().alias("bug_count"))
        .orderBy(place.asc_nulls_first())
    )


def unusual_reopen_teams(t: Tables) -> DataFrame:
    """Teams above the mean reopen rate by more than one population deviation."""
    per_team = (
        t["issues"]
        .filter(is_bug())
        .groupBy("team_id")
        .agg(_sum("reopened").alias("reopened"), count_rows().alias("bugs"))
        .join(t["teams"].select("team_id", "team_name"), "team_id")
        .select("team_id", "team_name", percent("reopened", "bugs").alias("rate"))
    )
    return above_mean_plus_sigma(per_team, "rate").orderBy(F.desc("rate"), "team_id").select(
        "team_name",
        F.round("rate", 1).alias("reopen_rate_pct"),
        F.round("mean", 1).alias("org_avg_rate"),
        F.round("dev", 1).alias("org_stdev"),
    )


def review_time_by_team(t: Tables) -> DataFrame:
    reviewed = t["pull_requests"].filter(F.col("review_time_hours").isNotNull())
    return (
        _per_sprint_team(t, reviewed, {"hours": _total("review_time_hours"), "prs": count_rows()})
        .select("team_name", F.round(safe_ratio("hours", "prs"), 1).alias("avg_review_hours"), "prs")
        .orderBy(F.desc("avg_review_hours"), "team_name")
    )


def merge_rate(t: Tables) -> DataFrame:
    return (
        _per_project(t, t["pull_requests"], {"total_prs": count_rows(), "merged_prs": _sum("is_merged")})
        .withColumn("merge_rate_pct", F.round(percent("merged_prs", "total_prs"), 1))
        .orderBy(F.asc_nulls_last("merge_rate_pct"), "project_name")
    )


def review_time_by_size(t: Tables) -> DataFrame:
    """An unknown size falls into the last bucket."""
    size = F.col("pr_size_lines")
    bucket = (
        F.when(size < 50, "1. <50 lines")
        .when(size < 150, "2. 50-150 lines")
        .when(size < 400, "3. 150-400 lines")
        .otherwise("4. 400+ lines")
    )
    return (
        t["pull_requests"]
        .filter(F.col("review_time_hours").isNotNull())
        .groupBy(bucket.alias("pr_size_bucket"))
        .agg(F.round(F.avg("review_time_hours"), 1).alias("avg_review_hours"), count_rows().alias("pr_count"))
        .orderBy("pr_size_bucket")
    )


def reviewer_load(t: Tables, k: int = 15) -> DataFrame:
    """Busiest reviewers with a running total; equal loads share it."""
    counts = t["pull_requests"].groupBy("reviewer_id").agg(count_rows().alias("prs_reviewed"))
    order = [F.desc("prs_reviewed"), F.asc_nulls_last("reviewer_id")]
    return (
        running_total_of_counts(counts, "prs_reviewed", counts.orderBy(*order).limit(k))
        .select("reviewer_id", "prs_reviewed", F.col("running_total").alias("running_total_prs"))
        .orderBy(*order)
    )


def assignment_percentiles(t: Tables, k: int = 15) -> DataFrame:
    counts = t["issues"].groupBy(F.col("assignee_id").alias("developer_id")).agg(count_rows().alias("issues_assigned"))
    order = [F.desc("issues_assigned"), F.asc_nulls_last("developer_id")]
    return (
        percent_rank_of_counts(counts, "issues_assigned", counts.orderBy(*order).limit(k))
        .select("developer_id", "issues_assigned", F.round("percent_rank", 3).alias("workload_percentile"))
        .orderBy(*order)
    )


def deploys_per_week(t: Tables) -> DataFrame:
    """Deployments per week over the span from first to last deployment."""
    span = days_between("min_ts", "max_ts") + 1
    return (
        _per_project(
            t,
            t["deployments"],
            {"total_deployments": count_rows()},
            keep={"min_ts": (F.min, "deployment_timestamp"), "max_ts": (F.max, "deployment_timestamp")},
        )
        .select(
            "project_name",
            "total_deployments",
            F.round(F.col("total_deployments") / span * 7, 2).alias("deploys_per_week"),
        )
        .orderBy(F.desc_nulls_last("deploys_per_week"), "project_name")
    )


def change_failure_by_team(t: Tables) -> DataFrame:
    return (
        _per_sprint_team(
            t, t["deployments"], {"total_deployments": count_rows(), "failed_deployments": _sum("is_failure")}
        )
        .withColumn("change_failure_rate_pct", F.round(percent("failed_deployments", "total_deployments"), 1))
        .orderBy(F.desc_nulls_last("change_failure_rate_pct"), "team_name")
    )


def deploys_against_delay(t: Tables) -> DataFrame:
    deploys = t["deployments"].groupBy("project_id").agg(count_rows().alias("deploy_count"))
    delays = (
        t["releases"]
        .filter(F.col("status") != "Cancelled")
        .groupBy("project_id")
        .agg(F.round(F.avg("release_delay_days"), 1).alias("avg_delay_days"))
    )
    return (
        deploys.join(delays, "project_id")
        .join(t["projects"].select("project_id", "project_name"), "project_id")
        .orderBy(F.desc("deploy_count"), "project_id")
        .select("project_name", "deploy_count", "avg_delay_days")
    )


def rollback_by_environment(t: Tables) -> DataFrame:
    return (
        t["deployments"]
        .groupBy("environment")
        .agg(_sum("is_failure").alias("failed_deploys"), _sum("rollback").alias("rollbacks"))
        .withColumn("rollback_rate_pct", F.round(percent("rollbacks", "failed_deploys"), 1))
    )


def release_success(t: Tables) -> DataFrame:
    """Cancelled releases count in the on-time rate but not in the mean delay."""
    held = F.col("status") != "Cancelled"
    return (
        _per_project(
            t,
            t["releases"],
            {
                "total_releases": count_rows(),
                "on_time": F.count_if(F.col("status") == "On Time"),
                "delay": F.sum(F.when(held, F.col("release_delay_days"))),
                "delays": F.count(F.when(held, F.col("release_delay_days"))),
            },
        )
        .select(
            "project_name",
            "total_releases",
            F.round(percent("on_time", "total_releases"), 1).alias("on_time_rate_pct"),
            F.round(safe_ratio("delay", "delays"), 1).alias("avg_delay_days"),
        )
        .orderBy("on_time_rate_pct", "project_name")
    )


def monthly_delay(t: Tables) -> DataFrame:
    return (
        t["releases"]
        .groupBy(month_of("planned_release_date").alias("release_month"))
        .agg(count_rows().alias("releases"), _sum("is_delayed").alias("_delayed"))
        .select("release_month", "releases", F.round(percent("_delayed", "releases"), 1).alias("delay_rate_pct"))
        .orderBy("release_month")
    )


def project_health(t: Tables) -> DataFrame:
    """Weighted health of projects that have bugs, sprints and deployments."""
    hundred = F.lit(100.0)
    quality = (
        t["issues"]
        .filter(is_bug())
        .groupBy("project_id")
        .agg((hundred * (1 - safe_ratio(_sum("escaped_defect"), count_rows()))).alias("_q"))
    )
    delivery = t["sprints"].groupBy("project_id").agg((F.avg("sprint_completion_rate") * 100).alias("_d"))
    devops = t["deployments"].groupBy("project_id").agg(
        (hundred * (1 - safe_ratio(_sum("is_failure"), count_rows()))).alias("_o")
    )
    score = F.col("_q") * 0.35 + F.col("_d") * 0.35 + F.col("_o") * 0.30
    return (
        quality.join(delivery, "project_id")
        .join(devops, "project_id")
        .join(t["projects"].select("project_id", "project_name"), "project_id")
        .select(
            "project_id",
            "project_name",
            F.round("_q", 1).alias("quality_score"),
            F.round("_d", 1).alias("delivery_score"),
            F.round("_o", 1).alias("devops_score"),
            F.round(score, 1).alias("project_health_score"),
        )
        .orderBy(F.asc_nulls_last("project_health_score"), "project_id")
        .drop("project_id")
    )


def team_performance_summary(t: Tables) -> DataFrame:
    """One row per team that has sprints: completion, bug reopen rate, review hours."""
    completion = t["sprints"].groupBy("team_id").agg(
        F.round(F.avg("sprint_completion_rate") * 100, 1).alias("avg_sprint_completion_pct")
    )
    reopen = (
        t["issues"]
        .filter(is_bug())
        .groupBy("team_id")
        .agg(F.round(percent(_sum("reopened"), count_rows()), 1).alias("bug_reopen_rate_pct"))
    )
    review = rollup_via(
        t["pull_requests"],
        "sprint_id",
        _sprint_teams(t),
        ["team_id"],
        {"hours": _total("review_time_hours"), "reviewed": F.count("review_time_hours")},
    ).select("team_id", F.round(safe_ratio("hours", "reviewed"), 1).alias("avg_pr_review_hours"))
    return (
        t["teams"]
        .select("team_id", "team_name")
        .join(completion, "team_id")
        .join(reopen, "team_id", "left")
        .join(review, "team_id", "left")
    )


def register_team_view(spark: SparkSession, t: Tables, name: str = "team_performance_summary") -> None:
    """Replace the reusable team view for this session."""
    team_performance_summary(t).createOrReplaceTempView(name)


def blended_risk(t: Tables) -> DataFrame:
    """Teams by a simple risk blend; a missing term sends a team to the end."""
    blend = (
        (F.lit(100) - F.col("avg_sprint_completion_pct"))
        + F.col("bug_reopen_rate_pct")
        + F.col("avg_pr_review_hours")
    )
    return (
        team_performance_summary(t)
        .orderBy(blend.desc_nulls_last(), "team_id")
        .select("team_name", "avg_sprint_completion_pct", "bug_reopen_rate_pct", "avg_pr_review_hours")
    )


def busiest_developers(t: Tables, k: int = 15) -> DataFrame:
    """Commits + 3 x pull requests + 2 x finished issues."""
    commits = t["commits"].groupBy("developer_id").agg(count_rows().alias("commit_count"))
    prs = t["pull_requests"].groupBy(F.col("author_id").alias("developer_id")).agg(count_rows().alias("pr_count"))
    finished = (
        t["issues"]
        .filter(F.col("status") == "Done")
        .groupBy(F.col("assignee_id").alias("developer_id"))
        .agg(count_rows().alias("issues_resolved"))
    )
    counts = ["commit_count", "pr_count", "issues_resolved"]
    index = F.col("commit_count") + F.col("pr_count") * 3 + F.col("issues_resolved") * 2
    joined = t["developers"].join(t["teams"].select("team_id", "team_name"), "team_id")
    for frame in (commits, prs, finished):
        joined = joined.join(frame, "developer_id", "left")
    return (
        joined.fillna(0, counts)
        .select("developer_id", "full_name", "team_name", *counts, index.alias("workload_index"))
        .orderBy(F.desc("workload_index"), "developer_id")
        .limit(k)
    )
