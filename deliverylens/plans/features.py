"""Release-delay features, known at the end of the release's sprint.

The cutoff is midnight of the sprint's end date. All history is summed per
project and day first (see ``operators.timeline``), so the work grows with the
facts plus the releases, never with their product.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from deliverylens.functions.scalars import as_double, count_rows, first_midnight_from, safe_ratio
from deliverylens.operators.timeline import dated_events, totals_as_of

Tables = Mapping[str, DataFrame]

# Assumed delay rate without history, and the deployment window.
PRIOR_DELAY_RATE = 0.3
DEPLOY_WINDOW_DAYS = 14

FEATURES = (
    "open_bugs",
    "critical_bugs",
    "sprint_completion_pct",
    "avg_pr_review_time",
    "pending_prs",
    "developer_workload_proxy",
    "recent_deployment_frequency",
    "historical_delay_rate",
)


def held_releases(t: Tables) -> DataFrame:
    return t["releases"].filter(F.coalesce("status", F.lit("")) != "Cancelled")


def release_cutoffs(t: Tables) -> DataFrame:
    """Releases that were not cancelled, with their sprint's end and completion."""
    sprints = t["sprints"].select("sprint_id", "sprint_end_date", "sprint_completion_rate")
    return held_releases(t).join(sprints, "sprint_id").withColumnRenamed("sprint_end_date", "cutoff")


def issue_events(issues: DataFrame) -> DataFrame:
    """+1 when an issue (bug, urgent bug) opens and -1 when the bug is resolved."""
    created = first_midnight_from("created_date")
    resolved = first_midnight_from("resolved_date")
    closed = F.when(resolved.isNotNull(), F.greatest(created, resolved))
    bug = F.coalesce(F.col("issue_type") == "Bug", F.lit(False))
    urgent = bug & F.coalesce(F.col("priority").isin("Critical", "High"), F.lit(False))
    return dated_events(
        issues,
        "project_id",
        [
            (
                created,
                {"open_bugs": bug.cast("int"), "critical_bugs": urgent.cast("int"), "issues_to_date": F.lit(1)},
            ),
            (F.when(bug, closed), {"open_bugs": F.lit(-1), "critical_bugs": -urgent.cast("int")}),
        ],
    )


def pull_request_events(pull_requests: DataFrame) -> DataFrame:
    """+1 / -1 as a pull request opens and closes; review hours count once it closed."""
    opened = first_midnight_from("opened_date")
    ended = first_midnight_from("closed_date")
    closed = F.when(ended.isNotNull(), F.greatest(opened, ended))
    hours = as_double("review_time_hours")
    return dated_events(
        pull_requests,
        "project_id",
        [
            (opened, {"pending_prs": F.lit(1)}),
            (
                closed,
                {
                    "pending_prs": F.lit(-1),
                    "review_hours": F.coalesce(hours, F.lit(0.0)),
                    "reviews": hours.isNotNull().cast("int"),
                },
            ),
        ],
    )


def opened_pull_request_events(pull_requests: DataFrame) -> DataFrame:
    """Today's status and hours of pull requests opened up to the cutoff day's end."""
    hours = as_double("review_time_hours")
    measures = {
        "pending_prs": F.coalesce(F.col("status") == "Open", F.lit(False)).cast("int"),
        "review_hours": F.coalesce(hours, F.lit(0.0)),
        "reviews": hours.isNotNull().cast("int"),
    }
    return dated_events(pull_requests, "project_id", [(F.col("opened_date").cast("date"), measures)])


def deployment_events(deployments: DataFrame) -> DataFrame:
    day = first_midnight_from("deployment_timestamp")
    return dated_events(deployments, "project_id", [(day, {"recent_deployment_frequency": F.lit(1)})])


def release_events(t: Tables, day: str) -> DataFrame:
    measures = {"late": F.col("is_delayed"), "seen": F.lit(1)}
    return dated_events(held_releases(t), "project_id", [(F.col(day), measures)])


def at_cutoff(t: Tables, events: list[DataFrame], releases: DataFrame | None = None) -> DataFrame:
    """Running totals per (project, cutoff) for the given daily events."""
    releases = release_cutoffs(t) if releases is None else releases
    return totals_as_of(
        events,
        releases.filter(F.col("project_id").isNotNull() & F.col("cutoff").isNotNull()),
        "project_id",
        "cutoff",
        {"recent_deployment_frequency": DEPLOY_WINDOW_DAYS},
    )


def history_by_plan(t: Tables) -> DataFrame:
    """Delay rate of the project's earlier-planned releases."""
    releases = release_cutoffs(t)
    events = release_events(t, "planned_release_date")
    past = totals_as_of([events], releases, "project_id", "planned_release_date", strictly_before=True)
    return releases.join(past, ["project_id", "planned_release_date"], "left").select(
        "release_id",
        F.coalesce(safe_ratio("late", "seen"), F.lit(PRIOR_DELAY_RATE)).alias("historical_delay_rate"),
    )


def history_known(t: Tables) -> DataFrame:
    """Delay rate of the project's releases that had shipped by the cutoff."""
    releases = release_cutoffs(t)
    events = release_events(t, "actual_release_date")
    past = totals_as_of([events], releases, "project_id", "cutoff")
    itself = F.coalesce((F.col("actual_release_date") <= F.col("cutoff")).cast("int"), F.lit(0))
    seen = F.col("seen") - itself
    late = F.col("late") - itself * F.col("is_delayed")
    return releases.join(past, ["project_id", "cutoff"], "left").select(
        "release_id", F.coalesce(safe_ratio(late, seen), F.lit(PRIOR_DELAY_RATE)).alias("historical_delay_rate")
    )


def team_sizes(t: Tables) -> DataFrame:
    """Developers on each project's team."""
    size = t["developers"].groupBy("team_id").agg(count_rows().alias("team_size"))
    return t["projects"].select("project_id", "team_id").join(size, "team_id", "left").select("project_id", "team_size")


def release_features(t: Tables, as_of: bool = True, pr_history: str | None = None) -> DataFrame:
    """One row of features per release that was not cancelled.

    ``as_of`` uses only what could be seen at the cutoff. With ``as_of=False``
    earlier releases count by planned date and pull requests by their current
    state. ``pr_history`` picks the pull requests: "known" (state at the
    cutoff), "opened" (current state, opened by the cutoff day) or "all".
    """
    pr_history = pr_history or ("known" if as_of else "all")
    releases = release_cutoffs(t)
    events = [issue_events(t["issues"]), deployment_events(t["deployments"])]
    if pr_history == "known":
        events.append(pull_request_events(t["pull_requests"]))
    elif pr_history == "opened":
        events.append(opened_pull_request_events(t["pull_requests"]))
    totals = at_cutoff(t, events, releases)
    joined = releases.join(totals, ["project_id", "cutoff"], "left")
    if pr_history == "all":
        whole = (
            t["pull_requests"]
            .groupBy("project_id")
            .agg(
                F.count_if(F.col("status") == "Open").alias("pending_prs"),
                F.sum(as_double("review_time_hours")).alias("review_hours"),
                F.count("review_time_hours").alias("reviews"),
            )
        )
        joined = joined.join(whole, "project_id", "left")
    history = history_known(t) if as_of else history_by_plan(t)
    joined = joined.join(history, "release_id").join(team_sizes(t), "project_id", "left")

    def counted(c):
        return F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c)

    crew = F.greatest(F.lit(1), F.coalesce("team_size", F.lit(0)))
    return joined.select(
        "release_id",
        "project_id",
        counted("open_bugs"),
        counted("critical_bugs"),
        (F.col("sprint_completion_rate") * 100).alias("sprint_completion_pct"),
        F.coalesce(safe_ratio("review_hours", "reviews"), F.lit(0.0)).alias("avg_pr_review_time"),
        counted("pending_prs"),
        (as_double(F.coalesce("issues_to_date", F.lit(0))) / crew).alias("developer_workload_proxy"),
        counted("recent_deployment_frequency"),
        "historical_delay_rate",
        "is_delayed",
    )
