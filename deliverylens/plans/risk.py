"""Project risk: four scaled components, their mean and a tier."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from deliverylens.functions.scalars import as_double, count_rows, risk_tier, score_round
from deliverylens.operators.rollup import align_on_key
from deliverylens.operators.scaling import scaled, with_ranges
from deliverylens.plans.features import team_sizes
from deliverylens.session import materialized

Tables = Mapping[str, DataFrame]

COMPONENTS = ("delivery_risk", "quality_risk", "review_bottleneck_risk", "workload_risk")
# Shares of review time and open pull requests in the review risk.
REVIEW_TIME_SHARE, PENDING_SHARE = 0.7, 0.3


def _per_project(df: DataFrame, **measures) -> DataFrame:
    return (
        df.filter(F.col("project_id").isNotNull())
        .groupBy("project_id")
        .agg(*[m.alias(n) for n, m in measures.items()])
    )


def undelivered_share(t: Tables) -> DataFrame:
    return _per_project(t["sprints"], undelivered=100 - F.avg("sprint_completion_rate") * 100)


def defect_burden(t: Tables) -> DataFrame:
    """Mean of the escaped and the reopened share of bugs."""

    def rate(c):
        return F.coalesce(F.avg(as_double(c)) * 100, F.lit(0.0))

    bugs = t["issues"].filter(F.col("issue_type") == "Bug")
    return _per_project(bugs, defects=(rate("escaped_defect") + rate("reopened")) / 2)


def review_load(t: Tables) -> DataFrame:
    """Mean review time and open pull requests of projects with any timed review."""
    return _per_project(
        t["pull_requests"],
        review_hours=F.avg(as_double("review_time_hours")),
        pending=as_double(F.count_if(F.col("status") == "Open")),
    ).filter(F.col("review_hours").isNotNull())


def crew_load(t: Tables) -> DataFrame:
    """Issues per developer of the project's team."""
    issues = _per_project(t["issues"], issues=count_rows())
    return (
        team_sizes(t)
        .join(issues, "project_id")
        .filter(F.col("team_size").isNotNull())
        .select("project_id", (as_double("issues") / F.col("team_size")).alias("crew_load"))
    )


def risk_components(t: Tables) -> DataFrame:
    """Unrounded components per project; a missing one counts as 0."""
    # one small row per project, kept because scaling needs the column ranges first
    raw = materialized(
        align_on_key([undelivered_share(t), defect_burden(t), review_load(t), crew_load(t)], "project_id"), "risk"
    )
    measures = {c: F.col(c) for c in ("undelivered", "defects", "review_hours", "pending", "crew_load")}
    part = {c: scaled(measures[c], c, 100.0) for c in measures}
    review = part["review_hours"] * REVIEW_TIME_SHARE + part["pending"] * PENDING_SHARE
    return with_ranges(raw, measures).select(
        "project_id",
        part["undelivered"].alias("delivery_risk"),
        part["defects"].alias("quality_risk"),
        review.alias("review_bottleneck_risk"),
        part["crew_load"].alias("workload_risk"),
    ).fillna(0.0, list(COMPONENTS))


def risk_scores(t: Tables) -> DataFrame:
    scored = with_composite(risk_components(t))
    return scored.join(t["projects"].select("project_id", "project_name", "criticality"), "project_id").select(
        "project_id", *COMPONENTS, "release_risk_score", "project_name", "criticality", "risk_tier"
    ).orderBy(F.desc("release_risk_score"), "project_id")


def with_composite(components: DataFrame) -> DataFrame:
    """Mean of the four components; the tier is read off the rounded score."""
    mean = sum((F.col(c) for c in COMPONENTS), F.lit(0.0)) / len(COMPONENTS)
    return (
        components.withColumn("release_risk_score", score_round(mean, 1))
        .withColumns({c: score_round(c, 1) for c in COMPONENTS})
        .withColumn("risk_tier", risk_tier("release_risk_score"))
    )
