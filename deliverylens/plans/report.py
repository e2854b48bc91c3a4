"""The weekly report: org KPIs, rankings and recommendations."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from deliverylens.functions.scalars import count_rows, phrases, score_round

Kpis = Mapping[str, DataFrame]

# Thresholds and texts of the recommendations.
DRIVER_THRESHOLD = 60
URGENT_THRESHOLD = 80
DRIVERS = (
    ("delivery_risk", "sprint completion rate is low"),
    ("quality_risk", "defect/escape rate is elevated"),
    ("review_bottleneck_risk", "PR review time is a bottleneck"),
    ("workload_risk", "team workload is disproportionately high"),
)
NO_DRIVER = "multiple risk factors trending negative"
URGENT_ACTION = (
    "Recommend immediate leadership review: reallocate reviewer capacity, triage critical-bug backlog, "
    "and reassess sprint scope."
)
WATCH_ACTION = "Recommend monitoring closely and addressing the top driver this sprint."


def recommendations(risk: DataFrame) -> DataFrame:
    """One row per high-risk project: what drives the risk and what to do."""
    drivers = phrases(*[(F.col(c) > DRIVER_THRESHOLD, text) for c, text in DRIVERS], fallback=NO_DRIVER)
    return risk.filter(F.col("risk_tier") == "High Risk").select(
        "project_name",
        F.col("release_risk_score").alias("risk_score"),
        drivers.alias("primary_drivers"),
        F.when(F.col("release_risk_score") > URGENT_THRESHOLD, URGENT_ACTION)
        .otherwise(WATCH_ACTION)
        .alias("recommended_action"),
    )


def kpi_summary(kpis: Kpis, report_date: str | None = None) -> DataFrame:
    """One org-wide row. Means are unweighted over teams and projects."""
    day = F.lit(report_date) if report_date else F.date_format(F.current_date(), "yyyy-MM-dd")
    health = kpis["kpi_project_health"].agg(score_round(F.avg("project_health_score"), 1)).scalar()
    risk = (
        kpis["release_risk_scores"]
        .select(
            F.struct(
                F.count_if(F.col("risk_tier") == "High Risk").alias("at_risk"),
                count_rows().alias("total"),
            )
        )
        .scalar()
    )
    teams = kpis["kpi_team_summary"].agg(
        score_round(F.avg("avg_sprint_completion_rate") * 100, 1).alias("avg_sprint_completion_rate_pct"),
        score_round(F.avg("bug_reopen_rate_pct"), 1).alias("avg_bug_reopen_rate_pct"),
        score_round(F.avg("avg_pr_review_hours"), 1).alias("avg_pr_review_hours"),
        score_round(F.avg("change_failure_rate_pct"), 1).alias("avg_change_failure_rate_pct"),
    )
    return teams.select(
        day.alias("report_date"),
        "*",
        health.alias("avg_project_health_score"),
        risk["at_risk"].alias("at_risk_project_count"),
        risk["total"].alias("total_projects"),
    )


def summary_as_rows(summary: DataFrame) -> DataFrame:
    """The one-row summary turned on its side: metric, value."""
    text = summary.select(*[F.col(c).cast("string").alias(c) for c in summary.columns])
    return text.unpivot([], text.columns, "metric", "value")


def at_risk_projects(risk: DataFrame) -> DataFrame:
    return risk.filter(F.col("risk_tier").isin("High Risk", "Medium Risk")).orderBy(
        F.desc("release_risk_score"), "project_id"
    )


def lowest_quality(project_health: DataFrame, k: int = 5) -> DataFrame:
    return (
        project_health.orderBy(F.asc_nulls_last("quality_score"), "project_id")
        .limit(k)
        .select("project_name", "criticality", "quality_score")
    )


def slowest_review_teams(team_kpis: DataFrame, k: int = 5) -> DataFrame:
    return (
        team_kpis.orderBy(F.desc_nulls_last("avg_pr_review_hours"), "team_id")
        .limit(k)
        .select("team_name", "avg_pr_review_hours", "bug_reopen_rate_pct", "change_failure_rate_pct")
    )


def top_developers(productivity: DataFrame, k: int = 10) -> DataFrame:
    return (
        productivity.orderBy(F.desc_nulls_last("engineering_productivity_score"), "developer_id")
        .limit(k)
        .select("full_name", "team_id", "seniority", "engineering_productivity_score")
    )


def weekly_report(kpis: Kpis, report_date: str | None = None) -> dict[str, DataFrame]:
    """All report sheets by name."""
    return {
        "kpi_summary": summary_as_rows(kpi_summary(kpis, report_date)),
        "at_risk_projects": at_risk_projects(kpis["release_risk_scores"]),
        "bottlenecks": slowest_review_teams(kpis["kpi_team_summary"]),
        "quality_issues": lowest_quality(kpis["kpi_project_health"]),
        "recommendations": recommendations(kpis["release_risk_scores"]),
        "top_performers": top_developers(kpis["kpi_developer_productivity"]),
        "team_kpis": kpis["kpi_team_summary"],
        "project_health": kpis["kpi_project_health"],
    }
