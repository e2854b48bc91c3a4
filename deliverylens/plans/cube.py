"""Dashboard filters answered by adding cells, without another look at the facts.

Facts are summed once into cells, at four grains in one pass of grouping sets: by project
with all labels, by team with all labels, by labels alone, and over all. Each filter is
answered from the coarsest grain that still tells apart what it chooses. Every measure is a
sum or a count, so cells add up; averages and shares are taken at the end.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from deliverylens.functions.scalars import as_double, count_rows, month_of, score_round, week_of
from deliverylens.plans.dashboard import apply_filters

Tables = Mapping[str, DataFrame]

LABELS = ("priority", "severity")


def _cells(t: Tables, facts: DataFrame, labels: Sequence[str], dims: Mapping[str, Column], measures: Mapping[str, Column]):
    """Cells of one fact table: grain, project_id, team_id (the project's), ``labels``, ``dims``
    and ``measures``. Facts of projects without a known team are left out, as by the filters."""
    named = facts.select("*", *[c.alias(n) for n, c in dims.items()]) if dims else facts
    # facts shrink to their cells before they meet the projects
    own = named.groupBy("project_id", *labels, *dims).agg(*[m.alias(n) for n, m in measures.items()])
    projects = t["projects"].join(t["teams"].select("team_id"), "team_id", "left_semi").select("project_id", "team_id")
    rest = [*labels, *dims]
    sets = [["project_id", "team_id", *rest], ["team_id", *rest], rest, *([list(dims)] if labels else [])]
    keys = ["project_id", "team_id", *rest]
    grain = F.when(F.grouping("project_id") == 0, "project").when(F.grouping("team_id") == 0, "team")
    if labels:
        grain = grain.when(F.grouping(labels[0]) == 0, "labels")
    return (
        own.join(projects, "project_id")
        .groupingSets(sets, *keys)
        .agg(grain.otherwise("all").alias("grain"), *[F.sum(m).alias(m) for m in measures])
    )


def issue_cells(t: Tables) -> DataFrame:
    days = F.when(F.col("resolved_date").isNotNull(), as_double("cycle_time_days"))
    return _cells(
        t,
        t["issues"].select("project_id", *LABELS, "issue_type", "created_date", "resolved_date", "cycle_time_days"),
        LABELS,
        {"is_bug": F.coalesce(F.col("issue_type") == "Bug", F.lit(False)), "month": month_of("created_date")},
        {"n": count_rows(), "cycle_days": F.coalesce(F.sum(days), F.lit(0.0)), "cycles": F.count(days)},
    )


def deployment_cells(t: Tables) -> DataFrame:
    at = F.col("deployment_timestamp")
    dims = {"week": week_of(at), "month": month_of(at)}
    return _cells(t, t["deployments"].select("project_id", at), (), dims, {"n": count_rows()})


def release_cells(t: Tables) -> DataFrame:
    dims = {"outcome": F.col("status")}
    return _cells(t, t["releases"].select("project_id", "status"), (), dims, {"n": count_rows()})


def sprint_cells(t: Tables) -> DataFrame:
    rate = F.col("sprint_completion_rate")
    return _cells(
        t,
        t["sprints"].select("project_id", "sprint_start_date", rate),
        (),
        {"start": F.col("sprint_start_date")},
        {"n": count_rows(), "rates": F.coalesce(F.sum(rate), F.lit(0.0)), "rated": F.count(rate)},
    )


CELLS = {
    "cells_issues": issue_cells,
    "cells_deployments": deployment_cells,
    "cells_releases": release_cells,
    "cells_sprints": sprint_cells,
}


def chosen_cells(
    t: Tables,
    name: str,
    project_names: Sequence[str] | None = None,
    team_names: Sequence[str] | None = None,
    priorities: Sequence[str] | None = None,
    severities: Sequence[str] | None = None,
    per_project: bool = False,
) -> DataFrame:
    """The cells that a choice leaves, each fact in one of them. ``t`` also holds the cells."""
    cells = t[name]
    labelled = "priority" in cells.columns
    if project_names or per_project:
        grain = "project"
    elif team_names:
        grain = "team"
    else:
        grain = "labels" if labelled and (priorities or severities) else "all"
    left = cells.filter(F.col("grain") == grain)
    if project_names or team_names:
        f = apply_filters(t, project_names=project_names, team_names=team_names)
        key = "project_id" if grain == "project" else "team_id"
        left = left.join(f["projects"].select(key).distinct(), key, "left_semi")
    for column, values in (("priority", priorities), ("severity", severities)):
        if labelled and values:
            left = left.filter(F.col(column).isin(*values))
    return left


def _ratio(num: Column, den: Column) -> Column:
    return as_double(num) / F.nullif(as_double(den), F.lit(0.0))


def executive_cards(t: Tables, **choice) -> DataFrame:
    """The seven headline figures, facts from cells and scores from the filtered KPI tables."""
    f = apply_filters(t, **choice)
    bugs = F.sum(F.when(F.col("is_bug"), F.col("n")).otherwise(0))
    issues = chosen_cells(t, "cells_issues", **choice).select(
        F.struct(
            score_round(_ratio(F.sum("cycle_days"), F.sum("cycles")), 1).alias("cycle"),
            score_round(_ratio(bugs, F.sum("n")) * 100, 1).alias("bugs"),
        )
    ).scalar()
    weekly = chosen_cells(t, "cells_deployments", **choice).groupBy("week").agg(F.sum("n").alias("n"))
    deploys = weekly.select(score_round(as_double(F.sum("n")) / F.greatest(F.lit(1), F.count("week")), 1)).scalar()
    on_time = F.sum(F.when(F.col("outcome") == "On Time", F.col("n")).otherwise(0))
    success = chosen_cells(t, "cells_releases", **choice).select(score_round(_ratio(on_time, F.sum("n")) * 100, 1)).scalar()
    completion = f["kpi_team_summary"].select(
        F.struct(count_rows().alias("n"), score_round(F.avg("avg_sprint_completion_rate") * 100, 1).alias("rate"))
    ).scalar()
    at_risk = f["release_risk_scores"].select(F.count_if(F.col("risk_tier") == "High Risk")).scalar()
    zero = F.lit(0.0)
    return f["kpi_project_health"].agg(score_round(F.avg("project_health_score"), 1).alias("project_health")).select(
        "project_health",
        F.when(completion["n"] > 0, completion["rate"]).otherwise(zero).alias("sprint_completion_pct"),
        issues["cycle"].alias("avg_cycle_time_days"),
        F.coalesce(issues["bugs"], zero).alias("bug_rate_pct"),
        F.coalesce(deploys, zero).alias("deploys_per_week"),
        F.coalesce(success, zero).alias("release_success_pct"),
        at_risk.alias("at_risk_projects"),
    )


def completion_trend(t: Tables, **choice) -> DataFrame:
    return (
        chosen_cells(t, "cells_sprints", **choice)
        .filter(F.col("start").isNotNull())
        .groupBy(F.col("start").alias("sprint_start_date"))
        .agg(_ratio(F.sum("rates"), F.sum("rated")).alias("sprint_completion_rate"))
        .orderBy("sprint_start_date")
    )


def _shares(cells: DataFrame, column: str, name: str) -> DataFrame:
    known = cells.filter(F.col(column).isNotNull())
    total = known.agg(F.sum("n")).scalar()
    per_value = known.groupBy(F.col(column).alias(name)).agg(F.sum("n").alias("n"))
    return per_value.withColumn("share_pct", F.col("n") * 100.0 / total.cast("double"))


def severity_share(t: Tables, **choice) -> DataFrame:
    """Bugs by severity. Without a choice of labels the cells of all labels are still few."""
    cells = chosen_cells(t, "cells_issues", **choice) if any(choice.values()) else t["cells_issues"].filter("grain = 'labels'")
    return _shares(cells.filter("is_bug"), "severity", "severity")


def release_outcomes(t: Tables, **choice) -> DataFrame:
    return _shares(chosen_cells(t, "cells_releases", **choice), "outcome", "status")


def bugs_by_project(t: Tables, **choice) -> DataFrame:
    bugs = chosen_cells(t, "cells_issues", per_project=True, **choice).filter("is_bug")
    return (
        bugs.groupBy("project_id")
        .agg(F.sum("n").alias("n"))
        .join(t["projects"].select("project_id", "project_name"), "project_id")
        .groupBy("project_name")
        .agg(F.sum("n").alias("bug_count"))
        .orderBy(F.desc("bug_count"), "project_name")
    )


def _per_month(cells: DataFrame, name: str) -> DataFrame:
    known = cells.filter(F.col("month").isNotNull())
    return known.groupBy("month").agg(F.sum("n").alias(name)).orderBy("month")


def defect_trend(t: Tables, **choice) -> DataFrame:
    return _per_month(chosen_cells(t, "cells_issues", **choice).filter("is_bug"), "bugs")


def deployment_trend(t: Tables, **choice) -> DataFrame:
    return _per_month(chosen_cells(t, "cells_deployments", **choice), "deployments")


def row_counts(t: Tables, **choice) -> DataFrame:
    """table_name and row_count of the facts that a choice leaves."""
    counts = None
    for name in CELLS:
        row = chosen_cells(t, name, **choice).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"))
        row = row.select(F.lit(name.removeprefix("cells_")).alias("table_name"), "row_count")
        counts = row if counts is None else counts.unionAll(row)
    return counts
