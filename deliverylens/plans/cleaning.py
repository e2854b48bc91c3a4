"""Cleaning rules for the ten tables, with their audit counters.

Every rule takes ``counters``, which the job that writes the table then fills.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from deliverylens.functions.scalars import cap_at, count_rows, days_between, flag, safe_ratio, tidy_label
from deliverylens.operators.dedupe import first_copies, keep_first
from deliverylens.operators.observed import Counters
from deliverylens.operators.quantiles import exact_quantile
from deliverylens.operators.sketches import rank_sketches, sketch_quantile
from deliverylens.operators.slices import key_slices
from deliverylens.schema import ISSUE_STATUSES
from deliverylens.session import materialized, materialized_in_turn

OUTLIER_QUANTILE = 0.995
COMPLETION_CAP = 1.2


# tables whose cleaning is counted
AUDITED = ("developers", "sprints", "issues", "commits", "pull_requests", "code_reviews", "deployments", "releases")


def _first_arrivals(
    df: DataFrame, key: str, arrival: str | None, counters: Counters | None = None, table: str = "", **metrics
) -> DataFrame:
    """Keep the first copy per key; without an arrival column, order by the whole row.

    With ``counters``, the job that writes the result also counts the rows that came in, those
    left, and ``metrics`` of these.
    """
    known = bool(arrival) and arrival in df.columns
    order = [arrival] if known else [F.struct(*[c for c in df.columns if c != key])]
    if counters is None:
        first = keep_first(df, [key], order)
    else:
        counted = first_copies(df, [key], order, "_copies")
        rows_in = F.coalesce(F.sum("_copies"), F.lit(0))
        first = counters.watch(counted, table, rows_in=rows_in, rows_out=count_rows(), **metrics).drop("_copies")
    return first.drop(arrival) if known else first


def _counted(df: DataFrame, counters: Counters | None, table: str, **metrics) -> DataFrame:
    return df if counters is None else counters.watch(df, table, rows_in=count_rows(), **metrics)


def _strict(df: DataFrame, **types: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast(t) for c, t in types.items()})


def _lenient(df: DataFrame, **types: str) -> DataFrame:
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items()})


def clean_teams(df: DataFrame, counters: Counters | None = None) -> DataFrame:
    return _strict(df, formed_date="date")


def clean_projects(df: DataFrame, counters: Counters | None = None) -> DataFrame:
    return _strict(df, start_date="date")


def clean_developers(df: DataFrame, arrival: str | None = "arrival", counters: Counters | None = None) -> DataFrame:
    return _strict(_first_arrivals(df, "developer_id", arrival, counters, "developers"), hire_date="date")


def clean_sprints(df: DataFrame, counters: Counters | None = None) -> DataFrame:
    """Completion rate = completed / planned, capped; NULL when nothing was planned."""
    rate = safe_ratio("completed_story_points", "planned_story_points")
    cleaned = _strict(df, sprint_start_date="date", sprint_end_date="date").withColumn(
        "sprint_completion_rate", cap_at(rate, F.lit(COMPLETION_CAP))
    )
    return _counted(cleaned, counters, "sprints")


def outlier_cap(issues: DataFrame, sketch_size: int | None = None):
    """The winsorizing cap of resolution hours, taken after de-duplication: the exact quantile,
    or with ``sketch_size`` one from a rank sketch, in one pass (``sketches.rank_error`` says
    how far its rank may be off)."""
    if sketch_size is None:
        return exact_quantile(issues, "resolution_time_hours", OUTLIER_QUANTILE)
    sketch = rank_sketches(issues, "resolution_time_hours", size=sketch_size)
    return sketch.select(sketch_quantile(F.col("sketch"), OUTLIER_QUANTILE)).scalar()


def clean_issues(
    df: DataFrame,
    arrival: str | None = "arrival",
    counters: Counters | None = None,
    sketch_size: int | None = None,
    slices: int = 1,
) -> DataFrame:
    """First copy per key, tidy status, winsorized hours, cycle time from the dates.

    With more than one of ``slices``, copies are looked for in one slice of the keys after
    the other: each reads ``df`` anew, and shuffle files are those of a slice at a time.

    Of the audit's counters, ``status_fixes`` counts labels that really change;
    ``status_fixes_naive`` also counts every clean "Won't Fix" and missing label, as a
    comparison with plain title case would. ``hours_cap`` is the largest value left.
    """
    status = F.col("status")
    plain_title = F.when(tidy_label(status) == "Won't Fix", "Won'T Fix").otherwise(tidy_label(status))
    # read again below, for the cap and for the rows, so the de-duplication runs once and is kept
    first_of = lambda rows: _first_arrivals(
        rows,
        "issue_id",
        arrival,
        counters,
        "issues",
        status_fixes=F.count_if(status != tidy_label(status)),
        status_fixes_naive=F.count_if(status.isNull() | (status != plain_title)),
        severity_missing=F.count_if(F.col("severity").isNull()),
    )
    if slices > 1:
        if counters is not None:
            raise ValueError("the audit counts rows that are cleaned in one go")
        first = materialized_in_turn(map(first_of, key_slices(df, ["issue_id"], slices)), "first-issues")
    else:
        first = materialized(first_of(df), "first-issues")
    typed = _lenient(_strict(first, created_date="timestamp_ntz"), resolved_date="timestamp_ntz")
    cap = outlier_cap(first, sketch_size)
    cleaned = typed.withColumns(
        {
            "status": tidy_label("status"),
            "_over": F.col("resolution_time_hours") > cap,
            "resolution_time_hours": cap_at("resolution_time_hours", cap),
            "reopened": F.col("reopened").cast("int"),
            "escaped_defect": F.col("escaped_defect").cast("int"),
            "cycle_time_days": days_between("created_date", "resolved_date"),
        }
    )
    if counters is not None:
        cleaned = counters.watch(
            cleaned, "issues", hours_capped=F.count_if("_over"), hours_cap=F.max("resolution_time_hours")
        )
    return cleaned.drop("_over")


def clean_commits(df: DataFrame, arrival: str | None = "arrival", counters: Counters | None = None) -> DataFrame:
    """Negative line counts become the median of the valid ones."""
    first = materialized(
        _first_arrivals(
            df, "commit_id", arrival, counters, "commits", negative_lines=F.count_if(F.col("lines_added") < 0)
        ),
        "first-commits",
    )
    valid = first.withColumn("lines_added", F.when(F.col("lines_added") >= 0, F.col("lines_added").cast("double")))
    middle = exact_quantile(valid, "lines_added", 0.5)
    return (
        _strict(valid, commit_timestamp="timestamp_ntz")
        .withColumn("lines_added", F.coalesce("lines_added", middle))
        .withColumn("total_churn", F.col("lines_added") + F.col("lines_deleted"))
    )


def clean_pull_requests(df: DataFrame, counters: Counters | None = None) -> DataFrame:
    typed = _lenient(_strict(df, opened_date="timestamp_ntz"), closed_date="timestamp_ntz")
    cleaned = typed.withColumn("is_merged", flag(F.col("status") == "Merged"))
    missing = F.count_if(F.col("review_time_hours").isNull())
    return _counted(cleaned, counters, "pull_requests", review_time_missing=missing)


def clean_code_reviews(df: DataFrame, counters: Counters | None = None) -> DataFrame:
    return _counted(_strict(df, review_timestamp="timestamp_ntz"), counters, "code_reviews")


def clean_deployments(df: DataFrame, counters: Counters | None = None) -> DataFrame:
    cleaned = _strict(df, deployment_timestamp="timestamp_ntz").withColumn(
        "is_failure", flag(F.col("status") == "Failed")
    )
    return _counted(cleaned, counters, "deployments")


def clean_releases(df: DataFrame, counters: Counters | None = None) -> DataFrame:
    """Cancelled releases stay; they count in rates but carry no delay."""
    typed = _lenient(_strict(df, planned_release_date="date"), actual_release_date="date")
    cleaned = typed.withColumn("is_delayed", flag(F.col("status") == "Delayed"))
    return _counted(cleaned, counters, "releases", cancelled=F.count_if(F.col("status") == "Cancelled"))


CLEANERS = {
    "teams": clean_teams,
    "developers": clean_developers,
    "projects": clean_projects,
    "sprints": clean_sprints,
    "issues": clean_issues,
    "commits": clean_commits,
    "pull_requests": clean_pull_requests,
    "code_reviews": clean_code_reviews,
    "deployments": clean_deployments,
    "releases": clean_releases,
}


def cleaning_audit(cleaned: Mapping[str, DataFrame], counters: Counters) -> DataFrame:
    """What a cleaning run changed: table_name, metric, value.

    The counters are those of the jobs that wrote the cleaned tables (written here, where
    they were not), so nothing is read or de-duplicated for the audit.
    """
    written = [cleaned[name] for name in AUDITED]
    return counters.frame(written[0].sparkSession, AUDITED)


def status_domain_rule():
    """Condition that marks a status outside its domain."""
    return ~F.col("status").isin(*ISSUE_STATUSES)
