"""Hand-written rows for every semantic trap."""

import datetime as dt
import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from deliverylens.functions import scalars as S
from deliverylens.operators import quality, ranking
from deliverylens.operators.dedupe import first_copies
from deliverylens.operators.profile import histogram, pivot_counts
from deliverylens.operators.ranking import halves_by_date
from deliverylens.operators.rollup import align_on_key, rollup_via
from deliverylens.operators.scaling import minmax_scale
from deliverylens.plans import cleaning, dashboard, features, kpi, questions, report, risk
from deliverylens.plans.stages import delivery_tables


def ts(text):
    return dt.datetime.fromisoformat(text)


def day(text):
    return dt.date.fromisoformat(text)


ISSUE = (
    "issue_id string, project_id string, sprint_id string, team_id string, assignee_id string, issue_type string,"
    " priority string, severity string, status string, created_date timestamp_ntz, resolved_date timestamp_ntz,"
    " resolution_time_hours double, reopened int, escaped_defect int, cycle_time_days double"
)


def issues(spark, rows):
    """Issues from partial dicts."""
    names = [c.split()[0] for c in ISSUE.split(", ")]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], ISSUE)


def test_lenient_and_strict_dates(spark):
    df = spark.createDataFrame([("oops",), ("",), ("2024-01-02 03:04:05",)], "d string")
    assert [r[0] for r in cleaning._lenient(df, d="timestamp_ntz").collect()] == [None, None, ts("2024-01-02 03:04:05")]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        cleaning._strict(df, d="timestamp_ntz").collect()


def test_cap_keeps_null_and_counts_strictly_above(spark):
    df = spark.createDataFrame([(None,), (1.0,), (5.0,), (9.0,)], "x double")
    assert [r[0] for r in df.select(S.cap_at("x", F.lit(5.0))).collect()] == [None, 1.0, 5.0, 5.0]


def test_nothing_planned_has_no_rate(spark):
    schema = "sprint_start_date string, sprint_end_date string, planned_story_points int, completed_story_points int"
    df = spark.createDataFrame(
        [("2024-01-01", "2024-01-14", p, c) for p, c in ((0, 0), (0, 5), (10, 5), (10, 20))], schema
    )
    assert [r.sprint_completion_rate for r in cleaning.clean_sprints(df).collect()] == [None, None, 0.5, 1.2]


def test_unknown_status_gives_zero_flag(spark):
    rel = spark.createDataFrame(
        [("2024-01-01", None, None), ("2024-01-01", "bad", "Delayed")],
        "planned_release_date string, actual_release_date string, status string",
    )
    assert [r.is_delayed for r in cleaning.clean_releases(rel).collect()] == [0, 1]


def test_status_labels(spark):
    df = spark.createDataFrame([("DONE  ",), ("won't fix",), ("WON'T FIX  ",), ("In progress",), (None,)], "s string")
    assert [r[0] for r in df.select(S.tidy_label("s")).collect()] == [
        "Done",
        "Won't Fix",
        "Won't Fix",
        "In Progress",
        None,
    ]


def test_first_copy_wins_even_when_a_key_is_hot(spark):
    rows = [("k", i) for i in range(500, 0, -1)] + [(f"u{i}", 1000 + i) for i in range(50)]
    df = spark.createDataFrame(rows, "issue_id string, arrival int").repartition(6)
    kept = {r.issue_id: r.arrival for r in cleaning.keep_first(df, ["issue_id"], ["arrival"]).collect()}
    assert kept["k"] == 1 and len(kept) == 51
    plan = cleaning.keep_first(df, ["issue_id"], ["arrival"])._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_dirty_duplicate_keeps_the_clean_first_row(spark):
    base = {"issue_id": "I1", "issue_type": "Bug", "created_date": ts("2024-01-01"), "reopened": 0, "escaped_defect": 0}
    df = issues(
        spark,
        [
            {**base, "status": "Done", "resolution_time_hours": 2.0, "resolved_date": ts("2024-01-02 12:00:00")},
            {**base, "status": "DONE  ", "resolution_time_hours": 80.0, "resolved_date": ts("2024-01-02")},
        ],
    ).withColumn("arrival", F.when(F.col("resolution_time_hours") == 2.0, 1).otherwise(2))
    row = cleaning.clean_issues(df).collect()
    assert len(row) == 1 and row[0].resolution_time_hours == 2.0 and row[0].cycle_time_days == 1.5


def test_negative_lines_become_the_median(spark):
    df = spark.createDataFrame(
        [("a", -1.0, 1, "2024-01-01"), ("b", 10.0, 1, "2024-01-01"), ("c", 20.0, 1, "2024-01-01"), ("d", None, 1, "2024-01-01")],
        "commit_id string, lines_added double, lines_deleted int, commit_timestamp string",
    )
    rows = {r.commit_id: (r.lines_added, r.total_churn) for r in cleaning.clean_commits(df).collect()}
    assert rows == {"a": (15.0, 16.0), "b": (10.0, 11.0), "c": (20.0, 21.0), "d": (15.0, 16.0)}


def test_audit_counts_what_the_writing_jobs_see(spark):
    """Labels, copies of a key, capped hours and tables without rows, through the stages."""
    base = {"created_date": ts("2024-01-01"), "reopened": 0, "escaped_defect": 0}
    labels = ["Done", "DONE  ", "Won't Fix", None]
    rows = [{**base, "issue_id": f"I{i}", "status": s, "resolution_time_hours": 1.0 + i} for i, s in enumerate(labels)]
    df = issues(spark, rows + [{**rows[1], "status": "done"}] * 3)
    empty = {
        "developers": "developer_id string, hire_date date, arrival int",
        "sprints": "sprint_id string, sprint_start_date date, sprint_end_date date, completed_story_points int, planned_story_points int",
        "commits": "commit_id string, lines_added double, lines_deleted int, commit_timestamp timestamp_ntz, arrival int",
        "pull_requests": "review_time_hours double, status string, opened_date timestamp_ntz, closed_date timestamp_ntz",
        "code_reviews": "review_id string, review_timestamp timestamp_ntz",
        "deployments": "deployment_id string, status string, deployment_timestamp timestamp_ntz",
        "releases": "status string, planned_release_date date, actual_release_date date",
    }
    raw = {n: spark.createDataFrame([], s) for n, s in empty.items()}
    raw["issues"] = df.withColumn("arrival", F.when(F.col("status") == "done", None).otherwise(1))
    t = delivery_tables(spark, raw, "audit-test")
    audit = {(r.table_name, r.metric): r.value for r in t["cleaning_audit"].collect()}
    assert {m: v for (n, m), v in audit.items() if n == "issues"} == {
        "rows_in": 7.0,
        "rows_out": 4.0,
        # the copies without an arrival come first, and their label is no clean one either
        "status_fixes": 1.0,
        "status_fixes_naive": 3.0,
        "severity_missing": 4.0,
        "hours_capped": 1.0,
        "hours_cap": pytest.approx(3.985),
    }
    assert audit["commits", "rows_in"] == audit["commits", "negative_lines"] == audit["releases", "cancelled"] == 0.0
    assert audit["pull_requests", "review_time_missing"] == 0.0


AUDIT_WITH_RETRIES = """
import sys; sys.path.insert(0, sys.argv[1])
from pyspark import TaskContext
from pyspark.sql import SparkSession, functions as F
from deliverylens.operators.observed import Counters
from deliverylens.operators.dedupe import first_copies
spark = (SparkSession.builder.master("local[2,3]").config("spark.ui.enabled", "false")
    .config("spark.sql.shuffle.partitions", "3").config("spark.sql.adaptive.enabled", "false").getOrCreate())
spark.sparkContext.setLogLevel("OFF")
def once(batches):
    for k, batch in enumerate(batches):
        yield batch
    if TaskContext.get().attemptNumber() == 0:
        raise RuntimeError("lost")
raw = spark.range(0, 90, 1, 3).select((F.col("id") % 30).alias("k"), F.col("id").alias("v")).mapInPandas(once, "k long, v long")
counters = Counters()
first = counters.watch(first_copies(raw, ["k"], ["v"], "n"), "t", rows_in=F.sum("n"), rows_out=F.count(F.lit(1)))
first.mapInPandas(once, "k long, v long, n long").write.format("noop").mode("overwrite").save()
print(sorted(counters.found(["t"])))
"""


def test_audit_is_right_after_failed_attempts(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    run = subprocess.run(
        [sys.executable, "-c", AUDIT_WITH_RETRIES, root], capture_output=True, text=True, cwd=tmp_path, timeout=300
    )
    assert run.stdout.strip().splitlines()[-1] == "[('t', 'rows_in', 90.0), ('t', 'rows_out', 30.0)]", run.stderr[-2000:]


def test_counted_first_copies_are_the_first_ones(spark):
    rows = [("k", i) for i in range(500, 0, -1)] + [(f"u{i}", 1000 + i) for i in range(50)] + [(None, 7), ("n", None), ("n", 1)]
    df = spark.createDataFrame(rows, "key string, arrival int").repartition(6)
    kept = {r.key: (r.arrival, r.n) for r in first_copies(df, ["key"], ["arrival"], "n").collect()}
    assert len(kept) == 53 and kept["k"] == (1, 500) and kept[None] == (7, 1) and kept["n"] == (None, 2)
    assert {(r.key, r.arrival) for r in cleaning.keep_first(df, ["key"], ["arrival"]).collect()} == {
        (k, a) for k, (a, _) in kept.items()
    }


def test_missing_group_keys(spark):
    df = issues(
        spark,
        [
            {"team_id": None, "issue_type": "Bug", "priority": None, "resolved_date": ts("2024-01-02"), "cycle_time_days": 1.0},
            {"team_id": "T1", "issue_type": "Story", "priority": "Low", "resolved_date": ts("2024-01-02"), "cycle_time_days": 5.0},
        ],
    )
    by_team = kpi.issue_kpis(df).collect()
    assert [r.team_id for r in by_team] == ["T1"]
    # issues but no bug: density is missing, not 0
    assert by_team[0].defect_density_pct is None and by_team[0].bug_reopen_rate_pct is None
    by_priority = {r.priority: r.speed_rating for r in questions.cycle_time_by_priority({"issues": df}).collect()}
    assert by_priority == {None: "Fast", "Low": "Slow"}


def test_rounding_modes(spark):
    df = spark.createDataFrame([(0.25,), (0.35,), (74.25,)], "x double")
    assert [r[0] for r in df.select(F.round("x", 1)).collect()] == [0.3, 0.4, 74.3]
    assert [r[0] for r in df.select(S.score_round("x", 1)).collect()] == [0.2, 0.4, 74.2]


def test_equal_reviewers_share_the_running_total(spark):
    prs = spark.createDataFrame([(r,) for r in "aaabbbc"], "reviewer_id string")
    rows = [tuple(r) for r in questions.reviewer_load({"pull_requests": prs}).collect()]
    assert rows == [("a", 3, 6), ("b", 3, 6), ("c", 1, 7)]


def test_percent_rank_matches_the_window_function(spark):
    counts = spark.createDataFrame([(i, i % 7) for i in range(40)], "k int, n int")
    got = {r.k: r.percent_rank for r in ranking.percent_rank_of_counts(counts, "n").collect()}
    from pyspark.sql import Window

    want = {r.k: r.p for r in counts.select("k", F.percent_rank().over(Window.orderBy("n")).alias("p")).collect()}
    assert got == pytest.approx(want)
    single = ranking.percent_rank_of_counts(counts.limit(1), "n").first()
    assert single.percent_rank == 0.0


@pytest.mark.parametrize("n", [1, 2, 5, 8, 11])
def test_halves_split_dates_shared_by_several_sprints(spark, n):
    rows = [("T", f"S{i:02d}", day("2024-01-01") + dt.timedelta(days=14 * (i // 3)), i * i) for i in range(n)]
    df = spark.createDataFrame(rows, "team_id string, sprint_id string, sprint_start_date date, completed_story_points int")
    teams = spark.createDataFrame([("T", "Team")], "team_id string, team_name string")
    row = questions.velocity_trend({"sprints": df, "teams": teams}).first()
    first, second = [r[3] for r in rows[: n // 2]], [r[3] for r in rows[n // 2 :]]
    assert row.first_half_avg_velocity == (round(sum(first) / len(first), 1) if first else None)
    assert row.second_half_avg_velocity == round(sum(second) / len(second), 1)


def test_team_without_facts_scores(spark):
    schema = "team_id string, escaped_defect_rate_pct double, avg_sprint_completion_rate double, change_failure_rate_pct double"
    df = spark.createDataFrame([("T1", None, None, None), ("T2", 10.0, 0.9, 20.0)], schema)
    rows = {r.team_id: r for r in kpi.with_team_scores(df).collect()}
    assert (rows["T1"].quality_score, rows["T1"].devops_score) == (100, 100)
    assert rows["T1"].delivery_score is None and rows["T1"].team_health_score is None
    assert rows["T2"].team_health_score == 87.0


def test_published_health_values(spark):
    # Project scores and the health index published for them.
    published = [
        (90.0990099009901, 56.27817941093196, 79.54545454545455, 75.1),
        (85.3211009174312, 59.038523039280676, 87.17948717948718, 76.7),
        (89.77272727272727, 57.62968660643079, 87.2340425531915, 77.8),
        (91.11111111111111, 94.54524590668946, 95.45454545454545, 93.6),
    ]
    df = spark.createDataFrame(published, "q double, d double, o double, want double")
    got = df.select(S.score_round(kpi._health(F.col("q"), F.col("d"), F.col("o")), 1).alias("h"), "want").collect()
    assert all(r.h == r.want for r in got)


def test_flat_columns_scale_to_zero(spark):
    df = spark.createDataFrame([(5.0, 1.0), (5.0, 3.0), (None, 2.0)], "flat double, x double")
    rows = [(r.flat_scaled, r.x_scaled) for r in minmax_scale(df, ["flat", "x"]).collect()]
    assert rows == [(0.0, 0.0), (0.0, 1.0), (None, 0.5)]


def test_identical_developers(spark):
    schema = "developer_id string, issues_resolved long, pr_count long, reopen_rate double, reviews_given long, workload_index long"
    df = spark.createDataFrame([(f"D{i}", 1, 1, 0.0, 1, 5) for i in range(3)], schema)
    # only the two inverted parts remain: 100 * (0.25 + 0.15)
    assert {r.engineering_productivity_score for r in kpi.with_productivity_score(df).collect()} == {40.0}


def test_orphans_include_missing_keys(spark):
    child = spark.createDataFrame([("P1",), ("PX",), ("PX",), (None,)], "project_id string")
    parent = spark.createDataFrame([("P1",)], "project_id string")
    assert quality.orphan_counts(child, {"project_id": (parent, "project_id")}).first().orphans == 3
    checks = quality.validate_references({"releases": child, "projects": parent}, [("releases", "project_id")])
    assert checks.first().status == "FAIL"
    with pytest.raises(ValueError, match="releases.project_id"):
        quality.require_references(checks)


def test_primary_key_checks(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "team_id string")
    row = quality.primary_key_checks({"teams": df}, ["teams"]).first()
    assert (row.duplicate_keys, row.null_keys) == (1, 1)
    found = {r.table_name: (r.present, r.row_count) for r in quality.output_presence({"a": df}, ["a", "b"], spark).collect()}
    assert found == {"a": (True, 4), "b": (False, 0)}


def test_unknown_values_break_the_rules_that_say_so(spark):
    df = spark.createDataFrame([(1.0,), (-1.0,), (None,)], "x double")
    rules = [quality.Rule("skips", df, F.col("x") < 0), quality.Rule("counts", df, F.col("x") < 0, null_breaks=True)]
    assert {r.rule: r.violations for r in quality.violations(rules).collect()} == {"skips": 1, "counts": 2}


def test_rows_without_a_date_come_first(spark):
    rows = [("T", None, f"s{k}", float(k)) for k in range(3)] + [("T", dt.date(2024, 1, 1), "s9", 9.0)]
    df = spark.createDataFrame(rows, "team string, day date, sprint string, points double")
    row = halves_by_date(df, "team", "day", "sprint", "points").first()
    assert (row._n1, row._s1, row._n2, row._s2) == (2, 1.0, 2, 11.0)


def test_a_date_of_many_rows_is_numbered_in_ranges(spark):
    rows = [(g, None, f"s{k * 7919 % 3000:05d}") for g in ("T", None) for k in range(3000)]
    df = spark.createDataFrame(rows, "team string, day date, sprint string")
    placed = ranking.ordered_positions(df, ["team", "day"], "sprint", 8)
    assert all(r._position == int(r.sprint[1:]) + 1 for r in placed.collect())
    assert placed.groupBy("team", "_part").count().agg(F.max("count")).first()[0] < 2000
    points = df.withColumn("points", F.substring("sprint", 2, 5).cast("double"))
    halves = ranking.halves_by_date(points, "team", "day", "sprint", "points", range_rows=500).collect()
    for r in halves:
        assert (r._n1, r._s1, r._n2, r._s2) == (1500, sum(range(1500)), 1500, sum(range(1500, 3000)))
    assert len(halves) == 2


def test_histogram_shows_empty_bins(spark):
    df = spark.createDataFrame([(0.0,), (0.5,), (10.0,), (None,)], "x double")
    assert [r.n for r in histogram(df, "x", 5).orderBy("bin").collect()] == [2, 0, 0, 0, 1]
    assert [r.n for r in histogram(df.filter("x = 0"), "x", 5).collect()] == [1]
    assert histogram(df.filter("x > 99"), "x", 5).count() == 0


def test_values_outside_the_domain_are_counted(spark):
    df = spark.createDataFrame([("m", "Minor"), ("m", "Odd"), ("m", None)], "month string, severity string")
    row = pivot_counts(df, "month", "severity", ["Minor", "Major"]).first()
    assert (row.minor, row.major, row.other) == (1, 0, 1)
    base = {"resolved_date": ts("2024-01-02"), "cycle_time_days": 2.0}
    f = {"issues": issues(spark, [{**base, "priority": p} for p in ("Odd", "Low", "Critical", None)])}
    assert [r.priority for r in dashboard.cycle_time_by_priority(f).collect()] == ["Low", "Critical", "Odd"]


def test_table_sets_do_not_share_stages(spark):
    empty = {n: spark.createDataFrame([], "x int") for n in ("developers",)}
    for n in (1, 5):
        raw = {**empty, "teams": spark.createDataFrame([(f"T{k}", "2024-01-01") for k in range(n)], "team_id string, formed_date string")}
        assert delivery_tables(spark, raw, "weekly")["teams"].count() == n


def test_tier_edges(spark):
    df = spark.createDataFrame([(64.95,), (65.0,), (39.95,), (40.0,), (64.94,)], "x double")
    rounded = df.select(risk.risk_tier(S.score_round("x", 1)).alias("t"))
    # 64.95 and 39.95 are ties to one digit and go to the even neighbour
    assert [r.t for r in rounded.collect()] == ["High Risk", "High Risk", "Medium Risk", "Medium Risk", "Medium Risk"]


def test_recommendation_texts(spark):
    schema = (
        "project_name string, delivery_risk double, quality_risk double, review_bottleneck_risk double,"
        " workload_risk double, release_risk_score double, risk_tier string"
    )
    df = spark.createDataFrame(
        [
            ("a", 61.0, 60.0, 61.0, 0.0, 80.1, "High Risk"),
            ("b", 60.0, 60.0, 60.0, 60.0, 80.0, "High Risk"),
            ("c", 99.0, 99.0, 99.0, 99.0, 50.0, "Medium Risk"),
        ],
        schema,
    )
    rows = {r.project_name: r for r in report.recommendations(df).collect()}
    assert set(rows) == {"a", "b"}
    assert rows["a"].primary_drivers == "sprint completion rate is low; PR review time is a bottleneck"
    assert rows["a"].recommended_action == report.URGENT_ACTION
    assert rows["b"].primary_drivers == report.NO_DRIVER and rows["b"].recommended_action == report.WATCH_ACTION


def test_full_alignment_and_rollups(spark):
    a = spark.createDataFrame([("x", 1), ("y", 2)], "k string, a int")
    b = spark.createDataFrame([("y", 3), ("z", 4)], "k string, b int")
    assert sorted(tuple(r) for r in align_on_key([a, b], "k").collect()) == [("x", 1, None), ("y", 2, 3), ("z", None, 4)]
    fact = spark.createDataFrame([("s1", 1), ("s1", 2), ("s9", 5)], "sprint_id string, v int")
    dim = spark.createDataFrame([("s1", "t")], "sprint_id string, team_id string")
    got = rollup_via(fact, "sprint_id", dim, ["team_id"], {"v": F.sum("v")}, how="left")
    assert sorted(((r.team_id or "", r.v) for r in got.collect())) == [("", 5), ("t", 3)]


def test_elapsed_seconds_ignore_the_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.sql("SELECT TIMESTAMP_NTZ'2024-03-09 12:00:00' a, TIMESTAMP_NTZ'2024-03-10 12:00:00.5' b")
        assert df.select(S.seconds_between("a", "b")).first()[0] == 86400.5
        assert df.select(S.month_of("a"), S.week_of("a")).first() == ("2024-03", day("2024-03-04"))
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


# ---- features ----


def feature_tables(spark):
    cutoff = "2024-01-14"
    bug = {"project_id": "P", "issue_type": "Bug", "priority": "High"}
    return {
        "issues": issues(
            spark,
            [
                {**bug, "created_date": ts(f"{cutoff} 00:00:00")},  # at the cutoff: open
                {**bug, "created_date": ts(f"{cutoff} 00:00:01")},  # after it: unseen
                {**bug, "created_date": ts("2024-01-02"), "resolved_date": ts(f"{cutoff} 00:00:00")},  # closed at it
                {**bug, "created_date": ts("2024-01-02"), "resolved_date": ts(f"{cutoff} 00:00:01")},  # still open
                {**bug, "created_date": ts("2024-01-05"), "resolved_date": ts("2024-01-03"), "priority": "Low"},
                {"project_id": "P", "issue_type": "Story", "created_date": ts("2024-01-01")},
            ],
        ),
        "pull_requests": spark.createDataFrame(
            [
                ("P", ts("2024-01-10 10:00:00"), None, None, "Open"),
                ("P", ts(f"{cutoff} 10:00:00"), ts(f"{cutoff} 12:00:00"), 2.0, "Merged"),  # mid-day on the cutoff
                ("P", ts("2024-01-10 10:00:00"), ts("2024-01-11 10:00:00"), 24.0, "Merged"),
                ("P", ts("2024-01-10 10:00:00"), ts("2024-01-20 10:00:00"), 240.0, "Closed"),  # open then
            ],
            "project_id string, opened_date timestamp_ntz, closed_date timestamp_ntz, review_time_hours double, status string",
        ),
        "deployments": spark.createDataFrame(
            [("P", ts(f"{cutoff} 00:00:00")), ("P", ts("2023-12-31 00:00:00")), ("P", ts("2023-12-31 00:00:01"))],
            "project_id string, deployment_timestamp timestamp_ntz",
        ),
        "sprints": spark.createDataFrame(
            [("S1", day(cutoff), 0.8)], "sprint_id string, sprint_end_date date, sprint_completion_rate double"
        ),
        "releases": spark.createDataFrame(
            [
                ("R1", "P", "S1", day("2024-01-16"), day("2024-01-20"), "Delayed", 1),
                ("R2", "P", "S1", day("2024-01-16"), day("2024-01-16"), "On Time", 0),
                ("R3", "P", "S1", day("2024-01-01"), day("2024-01-14"), "Delayed", 1),
                ("R4", "P", "S1", day("2024-01-01"), None, "Cancelled", 0),
                ("R5", "P", "none", day("2023-12-01"), day("2023-12-01"), "On Time", 0),
            ],
            "release_id string, project_id string, sprint_id string, planned_release_date date,"
            " actual_release_date date, status string, is_delayed int",
        ),
        "projects": spark.createDataFrame([("P", "T")], "project_id string, team_id string"),
        "developers": spark.createDataFrame([("D1", "T"), ("D2", "T")], "developer_id string, team_id string"),
    }


def test_features_at_the_cutoff(spark):
    t = feature_tables(spark)
    rows = {r.release_id: r for r in features.release_features(t).collect()}
    # cancelled releases and releases without a sprint have no row
    assert set(rows) == {"R1", "R2", "R3"}
    r = rows["R1"]
    assert (r.open_bugs, r.critical_bugs) == (2, 2)
    assert (r.pending_prs, r.avg_pr_review_time) == (2, 24.0)
    assert r.recent_deployment_frequency == 2
    assert r.developer_workload_proxy == 5 / 2
    assert r.sprint_completion_pct == 80.0
    # known by the cutoff: R3 (delayed) and R5 (on time); R3 does not see itself
    assert r.historical_delay_rate == 0.5 and rows["R3"].historical_delay_rate == 0.0


def test_features_with_current_state(spark):
    t = feature_tables(spark)
    rows = {r.release_id: r for r in features.release_features(t, as_of=False).collect()}
    # equal planned dates do not see each other; the first one falls back to the prior
    assert rows["R1"].historical_delay_rate == 0.5 == rows["R2"].historical_delay_rate
    assert rows["R3"].historical_delay_rate == 0.0
    assert rows["R1"].pending_prs == 1 and rows["R1"].avg_pr_review_time == pytest.approx(266 / 3)
    opened = features.release_features(t, as_of=False, pr_history="opened").filter("release_id = 'R1'").first()
    assert opened.pending_prs == 1 and opened.avg_pr_review_time == pytest.approx(266 / 3)
    first = dict(t, releases=t["releases"].filter("release_id = 'R3'"))
    assert features.release_features(first, as_of=False).first().historical_delay_rate == 0.3


# ---- filters ----


def filter_tables(spark):
    def frame(schema, *rows):
        return spark.createDataFrame(list(rows), schema)

    key = "project_id string"
    return {
        "teams": frame("team_id string, team_name string", ("T1", "One"), ("T2", "Two")),
        "projects": frame(
            "project_id string, project_name string, team_id string", ("P1", "Alpha", "T1"), ("P2", "Beta", "T2")
        ),
        "issues": frame(
            "project_id string, issue_type string, priority string, severity string",
            ("P1", "Bug", "High", "Major"),
            ("P1", "Story", "High", None),
            ("P2", "Bug", "Low", "Minor"),
        ),
        "sprints": frame(key, ("P1",), ("P2",)),
        "pull_requests": frame(key, ("P1",)),
        "deployments": frame(key, ("P2",)),
        "releases": frame(key, ("P1",), ("P9",)),
        "kpi_team_summary": frame("team_id string", ("T1",), ("T2",)),
        "kpi_project_health": frame(key, ("P1",), ("P2",)),
        "release_risk_scores": frame(key, ("P1",), ("P2",)),
    }


@pytest.mark.parametrize(
    "choice,projects,issues_left,teams",
    [
        ({}, 2, 3, 2),
        ({"project_names": [], "team_names": None}, 2, 3, 2),
        ({"project_names": ["Nobody"]}, 0, 0, 2),
        ({"team_names": ["One"]}, 1, 2, 1),
        ({"project_names": ["Beta"], "team_names": ["One"]}, 0, 0, 1),
        ({"priorities": ["High"]}, 2, 2, 2),
        ({"severities": ["Major", "Minor"]}, 2, 2, 2),
    ],
)
def test_filters(spark, choice, projects, issues_left, teams):
    f = dashboard.apply_filters(filter_tables(spark), **choice)
    assert f["projects"].count() == projects
    assert f["issues"].count() == issues_left
    assert f["kpi_team_summary"].count() == teams
    # facts of unknown projects never pass
    assert f["releases"].filter("project_id = 'P9'").count() == 0
