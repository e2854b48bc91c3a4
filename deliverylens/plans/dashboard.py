"""Cross-filtered data products behind the dashboard pages."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from deliverylens.functions.scalars import as_double, count_rows, in_order, month_of, score_round, week_of
from deliverylens.operators.profile import histogram, share_of_total, unpivot_columns
from deliverylens.operators.quantiles import box_stats
from deliverylens.plans.risk import COMPONENTS
from deliverylens.schema import PRIORITIES

Tables = Mapping[str, DataFrame]


def _any_of(df: DataFrame, column: str, values: Sequence[str] | None) -> DataFrame:
    """Keep rows with one of the values; no values means no filter."""
    return df.filter(F.col(column).isin(*values)) if values else df


def apply_filters(
    t: Tables,
    project_names: Sequence[str] | None = None,
    team_names: Sequence[str] | None = None,
    priorities: Sequence[str] | None = None,
    severities: Sequence[str] | None = None,
) -> dict[str, DataFrame]:
    """Every shared frame under the global filters.

    Project and team choices narrow facts through the projects they leave;
    team KPIs follow the team choice alone. A severity choice leaves only bugs.
    """
    teams = _any_of(t["teams"], "team_name", team_names).select("team_id")
    projects = _any_of(t["projects"], "project_name", project_names).join(teams, "team_id", "left_semi")
    kept = projects.select("project_id")

    def of_projects(df):
        return df.join(kept, "project_id", "left_semi")

    return {
        "projects": projects,
        "issues": _any_of(_any_of(of_projects(t["issues"]), "priority", priorities), "severity", severities),
        "sprints": of_projects(t["sprints"]),
        "pull_requests": of_projects(t["pull_requests"]),
        "deployments": of_projects(t["deployments"]),
        "releases": of_projects(t["releases"]),
        "kpi_team_summary": t["kpi_team_summary"].join(teams, "team_id", "left_semi"),
        "kpi_project_health": of_projects(t["kpi_project_health"]),
        "release_risk_scores": of_projects(t["release_risk_scores"]),
    }


def filter_options(t: Tables) -> DataFrame:
    """The values each filter offers: filter_name, value."""
    labelled = (
        (t["projects"], {"project": "project_name"}),
        (t["teams"], {"team": "team_name"}),
        (t["issues"], {"priority": "priority", "severity": "severity"}),
    )
    merged = None
    for df, filters in labelled:
        pairs = [F.struct(F.lit(n).alias("filter_name"), F.col(c).alias("value")) for n, c in filters.items()]
        values = df.select(F.inline(F.array(*pairs))).filter(F.col("value").isNotNull()).distinct()
        merged = values if merged is None else merged.unionAll(values)
    return merged


def executive_cards(f: Tables) -> DataFrame:
    """The seven headline figures as one row; empty inputs give 0 or NULL as noted per card."""
    issues = (
        f["issues"]
        .select(
            F.struct(
                score_round(F.avg(F.when(F.col("resolved_date").isNotNull(), F.col("cycle_time_days"))), 1).alias("cycle"),
                score_round(F.avg(F.coalesce(as_double(F.col("issue_type") == "Bug"), F.lit(0.0))) * 100, 1).alias("bugs"),
            )
        )
        .scalar()
    )
    weekly = f["deployments"].groupBy(week_of("deployment_timestamp").alias("week")).agg(count_rows().alias("n"))
    deploys = weekly.select(
        score_round(as_double(F.sum("n")) / F.greatest(F.lit(1), F.count("week")), 1)
    ).scalar()
    success = (
        f["releases"]
        .select(score_round(F.avg(F.coalesce(as_double(F.col("status") == "On Time"), F.lit(0.0))) * 100, 1))
        .scalar()
    )
    at_risk = f["release_risk_scores"].select(F.count_if(F.col("risk_tier") == "High Risk")).scalar()
    completion = f["kpi_team_summary"].select(
        F.struct(
            count_rows().alias("n"), score_round(F.avg("avg_sprint_completion_rate") * 100, 1).alias("rate")
        )
    ).scalar()
    health = f["kpi_project_health"].agg(score_round(F.avg("project_health_score"), 1).alias("project_health"))
    zero = F.lit(0.0)
    return health.select(
        "project_health",
        F.when(completion["n"] > 0, completion["rate"]).otherwise(zero).alias("sprint_completion_pct"),
        issues["cycle"].alias("avg_cycle_time_days"),
        F.coalesce(issues["bugs"], zero).alias("bug_rate_pct"),
        F.coalesce(deploys, zero).alias("deploys_per_week"),
        F.coalesce(success, zero).alias("release_success_pct"),
        at_risk.alias("at_risk_projects"),
    )


def completion_trend(f: Tables) -> DataFrame:
    return (
        f["sprints"]
        .filter(F.col("sprint_start_date").isNotNull())
        .groupBy("sprint_start_date")
        .agg(F.avg("sprint_completion_rate").alias("sprint_completion_rate"))
        .orderBy("sprint_start_date")
    )


def health_ranking(f: Tables) -> DataFrame:
    return (
        f["kpi_project_health"]
        .select("project_id", "project_name", "project_health_score")
        .orderBy(F.asc_nulls_last("project_health_score"), "project_id")
    )


def team_ranking(f: Tables, measure: str) -> DataFrame:
    """Teams by one KPI column, largest first, missing last."""
    return (
        f["kpi_team_summary"]
        .select("team_id", "team_name", measure)
        .orderBy(F.desc_nulls_last(measure), "team_id")
    )


def productivity_histogram(t: Tables, f: Tables, bins: int = 20) -> DataFrame:
    """Score distribution of the developers on teams of the remaining projects.

    With every project still in, all developers count, whatever their team.
    """
    scores = t["kpi_developer_productivity"]
    removed = (t["projects"].agg(count_rows()).scalar()) > (f["projects"].agg(count_rows()).scalar())
    on_team = f["projects"].select("team_id", F.lit(True).alias("_kept")).distinct()
    shown = scores.join(on_team, "team_id", "left").filter(~removed | F.coalesce("_kept", F.lit(False)))
    return histogram(shown, "engineering_productivity_score", bins)


def cycle_time_by_priority(f: Tables) -> DataFrame:
    """Box statistics by priority, known ones in their order, any others after them."""
    resolved = f["issues"].filter(F.col("resolved_date").isNotNull() & F.col("priority").isNotNull())
    return box_stats(resolved, "cycle_time_days", ["priority"]).orderBy(
        in_order("priority", PRIORITIES)
    )


def severity_share(f: Tables) -> DataFrame:
    return share_of_total(f["issues"].filter(F.col("issue_type") == "Bug"), "severity")


def bugs_by_project(t: Tables, f: Tables) -> DataFrame:
    per_project = f["issues"].filter(F.col("issue_type") == "Bug").groupBy("project_id").agg(count_rows().alias("n"))
    return (
        per_project.join(t["projects"].select("project_id", "project_name"), "project_id")
        .groupBy("project_name")
        .agg(F.sum("n").alias("bug_count"))
        .orderBy(F.desc("bug_count"), "project_name")
    )


def _per_month(df: DataFrame, column: str, name: str) -> DataFrame:
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(month_of(column).alias("month"))
        .agg(count_rows().alias(name))
        .orderBy("month")
    )


def defect_trend(f: Tables) -> DataFrame:
    return _per_month(f["issues"].filter(F.col("issue_type") == "Bug"), "created_date", "bugs")


def deployment_trend(f: Tables) -> DataFrame:
    return _per_month(f["deployments"], "deployment_timestamp", "deployments")


def release_outcomes(f: Tables) -> DataFrame:
    return share_of_total(f["releases"], "status")


def delay_by_project(t: Tables, f: Tables) -> DataFrame:
    held = f["releases"].filter(F.coalesce("status", F.lit("")) != "Cancelled")
    named = held.join(t["projects"].select("project_id", "project_name"), "project_id")
    return box_stats(named, "release_delay_days", ["project_name"])


def risk_ranking(f: Tables) -> DataFrame:
    return (
        f["release_risk_scores"]
        .select("project_id", "project_name", "risk_tier", "release_risk_score")
        .orderBy("release_risk_score", "project_id")
    )


def risk_breakdown(f: Tables) -> DataFrame:
    """One row per project and component."""
    return unpivot_columns(
        f["release_risk_scores"], ["project_id", "project_name"], list(COMPONENTS), "component", "risk"
    )


def risk_detail(f: Tables) -> DataFrame:
    return (
        f["release_risk_scores"]
        .orderBy(F.desc("release_risk_score"), "project_id")
        .select("project_name", "risk_tier", "release_risk_score")
    )

