"""Filter cells, weekly refresh, rank sketches, and quantiles that read their input once."""

import datetime as dt
import os
import re

import pytest
from pyspark.sql import functions as F

from deliverylens.operators import sketches
from deliverylens.operators.profile import profile
from deliverylens.operators.quantiles import box_stats, exact_quantiles
from deliverylens.plans import cleaning, cube, dashboard, explore, kpi, refresh
from deliverylens.plans.stages import sample_tables

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
sampled = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="sample tables not present")


def final_plan(df):
    """The executed plan, as it was after its run."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


# --- input read once


@sampled
@pytest.mark.parametrize("build, tables", [(explore.completion_by_team, 2), (explore.delay_by_criticality, 2)])
def test_box_statistics_read_each_table_once(spark, build, tables):
    plan = final_plan(build(sample_tables(spark, SF_DIR)))
    assert plan.count("FileScan") == tables and plan.count("ReusedExchange") >= 4


def test_box_statistics_of_hot_odd_and_missing_values(spark):
    rows = [("a", 1.5)] * 500 + [("a", float(k)) for k in range(100)] + [(None, -0.0), (None, 3.0), ("b", None), ("c", float("inf")), ("c", -2.5)]
    found = {r.g: r for r in box_stats(spark.createDataFrame(rows, "g string, x double").repartition(5), "x", ["g"]).collect()}
    assert set(found) == {"a", None, "c"}
    assert (found["a"].n, found["a"].minimum, found["a"].median, found["a"].maximum) == (600, 0.0, 1.5, 99.0)
    assert found["a"].mean == pytest.approx((750 + 4950) / 600)
    assert (found[None].n, found[None].minimum, found[None].q1) == (2, 0.0, 0.75)
    assert (found["c"].minimum, found["c"].maximum) == (-2.5, float("inf"))


def test_profile_of_keys_moves_no_key(spark):
    df = spark.createDataFrame([("k2", "x", 1), ("k1", "y", 2), ("k3", "x", None)], "k string, c string, v int")
    found = {r.column_name: r for r in profile(df, ["v"], ["c"], keys=["k"]).collect()}
    assert (found["k"].n, found["k"].unique_values, found["k"].top, found["k"].freq) == (3, 3, "k1", 1)
    assert (found["c"].top, found["c"].freq, found["v"].n, found["v"].median) == ("x", 2, 2, 1.5)
    only = {r.column_name: r.freq for r in profile(df.limit(0), [], ["c"], keys=["k"]).collect()}
    assert only == {"k": None}


# --- rank sketches

SHAPES = {
    "ordered": lambda k: float(k),
    "falling": lambda k: float(-k),
    "skewed": lambda k: float(k) ** 4,
    "tied": lambda k: float(k % 3),
    "hot": lambda k: 7.0 if k % 3 else float(k),
}


@pytest.mark.parametrize("shape", SHAPES)
def test_sketches_stay_within_their_bound(spark, shape):
    rows = [("g" if k % 2 else None, SHAPES[shape](k)) for k in range(20_000)] + [("g", None), ("g", float("nan")), ("none", None)]
    df = spark.createDataFrame(rows, "g string, x double").repartition(6)
    probs = [0.0, 0.01, 0.25, 0.5, 0.9, 0.995, 1.0]
    parts = sketches.rank_sketches(df.withColumn("part", F.pmod(F.xxhash64("x"), F.lit(9))), "x", ["g", "part"])
    for made in (sketches.rank_sketches(df, "x", ["g"]), sketches.merged_sketches(parts, ["g"])):
        answers = sketches.sketch_quantiles(made, probs)
        assert {r.g: r.n for r in answers.collect()} == {"g": 10_000, None: 10_000}
        known = df.filter("x IS NOT NULL AND NOT isnan(x)")
        misses = sketches.rank_misses(known, "x", ["g"], answers, probs, 3 * sketches.rank_error())
        assert {(r.g, r.n, r.misses) for r in misses.collect()} == {("g", 10_000, 0), (None, 10_000, 0)}


def test_misses_are_seen(spark):
    df = spark.createDataFrame([(float(k),) for k in range(1000)], "x double").withColumn("g", F.lit("a"))
    wrong = spark.createDataFrame([("a", 1000, [0.0, 500.0, 900.0])], "g string, n long, quantiles array<double>")
    assert sketches.rank_misses(df, "x", ["g"], wrong, [0.5, 0.5, 0.5], 0.01).first().misses == 2


def test_small_sketches_are_exact_and_larger_ones_finer(spark):
    df = spark.createDataFrame([(float(k),) for k in range(101)], "x double")
    assert sketches.sketch_quantiles(sketches.rank_sketches(df, "x"), [0.0, 0.5, 1.0]).first().quantiles == [0.0, 50.0, 100.0]
    assert sketches.rank_error(4000) < sketches.rank_error(400) < 0.01
    assert sketches.rank_sketches(df.filter("x < 0"), "x").count() == 0


def test_cap_from_a_sketch_is_asked_for(spark):
    df = spark.createDataFrame(
        [(f"I{k}", "Done", float(k), "2024-01-01", None, 0, 0, None) for k in range(300)],
        "issue_id string, status string, resolution_time_hours double, created_date string, resolved_date string,"
        " reopened int, escaped_defect int, severity string",
    )
    exact = cleaning.clean_issues(df).agg(F.max("resolution_time_hours")).first()[0]
    sketched = cleaning.clean_issues(df, sketch_size=400).agg(F.max("resolution_time_hours")).first()[0]
    assert exact == pytest.approx(297.505) and sketched == 298.0


# --- filter cells


def cell_tables(spark):
    """Facts of unknown projects, of a project without a team, without labels or dates."""
    day = lambda d: dt.date.fromisoformat(d)
    at = lambda d: dt.datetime.fromisoformat(d)
    frame = spark.createDataFrame
    issue = "project_id string, issue_type string, priority string, severity string, created_date timestamp_ntz, resolved_date timestamp_ntz, cycle_time_days double"
    t = {
        "teams": frame([("T1", "Search"), ("T2", "Core"), (None, "None")], "team_id string, team_name string"),
        "projects": frame(
            [("P1", "One", "T1"), ("P2", "Two", "T2"), ("P3", "Lost", "T9"), ("P4", None, "T2")],
            "project_id string, project_name string, team_id string",
        ),
        "issues": frame(
            [
                ("P1", "Bug", "High", "Major", at("2024-01-02"), at("2024-01-05"), 3.0),
                ("P1", "Bug", None, None, at("2024-02-02"), None, None),
                ("P2", "Story", "Low", None, at("2024-01-03"), at("2024-01-04"), 1.0),
                ("P2", "Bug", "High", "Minor", None, at("2024-01-09"), None),
                ("P3", "Bug", "High", "Minor", at("2024-01-02"), None, None),
                ("P4", None, "High", None, at("2024-03-02"), None, None),
                (None, "Bug", "High", "Minor", at("2024-01-02"), None, None),
                ("P9", "Bug", "High", "Minor", at("2024-01-02"), None, None),
            ],
            issue,
        ),
        "deployments": frame(
            [("P1", at("2024-01-02")), ("P1", at("2024-01-03")), ("P2", at("2024-01-09")), ("P2", None), ("P3", at("2024-01-02"))],
            "project_id string, deployment_timestamp timestamp_ntz",
        ),
        "releases": frame([("P1", "On Time"), ("P2", "Delayed"), ("P2", None), ("P3", "On Time")], "project_id string, status string"),
        "sprints": frame(
            [("P1", day("2024-01-01"), 0.5), ("P2", day("2024-01-01"), 1.0), ("P2", day("2024-01-08"), None), ("P1", None, 1.0)],
            "project_id string, sprint_start_date date, sprint_completion_rate double",
        ),
        "pull_requests": frame([("P1",)], "project_id string"),
        "kpi_team_summary": frame([("T1", 0.5), ("T2", None)], "team_id string, avg_sprint_completion_rate double"),
        "kpi_project_health": frame([("P1", 50.0), ("P2", 70.0)], "project_id string, project_health_score double"),
        "release_risk_scores": frame([("P1", "High Risk"), ("P2", "Low Risk")], "project_id string, risk_tier string"),
    }
    return t | {name: build(t) for name, build in cube.CELLS.items()}


CHOICES = [
    {},
    {"team_names": ["Core"]},
    {"project_names": ["One", "Two", "Lost"]},
    {"project_names": ["One"], "team_names": ["Core"]},
    {"priorities": ["High"]},
    {"severities": ["Minor", "Major"], "team_names": ["Search", "Core"]},
    {"team_names": ["nobody"]},
]


@pytest.mark.parametrize("choice", CHOICES)
def test_cells_answer_as_the_facts_do(spark, choice):
    t = cell_tables(spark)
    f = dashboard.apply_filters(t, **choice)
    rows = lambda df: sorted(map(str, df.collect()))
    assert rows(cube.executive_cards(t, **choice)) == rows(dashboard.executive_cards(f))
    assert rows(cube.severity_share(t, **choice)) == rows(dashboard.severity_share(f))
    assert rows(cube.bugs_by_project(t, **choice)) == rows(dashboard.bugs_by_project(t, f))
    assert rows(cube.defect_trend(t, **choice)) == rows(dashboard.defect_trend(f))
    assert rows(cube.deployment_trend(t, **choice)) == rows(dashboard.deployment_trend(f))
    assert rows(cube.release_outcomes(t, **choice)) == rows(dashboard.release_outcomes(f))
    assert rows(cube.completion_trend(t, **choice)) == rows(dashboard.completion_trend(f))
    assert {r.table_name: r.row_count for r in cube.row_counts(t, **choice).collect()} == {
        n: f[n].count() for n in ("issues", "deployments", "releases", "sprints")
    }


@sampled
def test_cells_are_fewer_than_facts_and_answers_read_cells_only(spark):
    t = sample_tables(spark, SF_DIR)
    files = cube.defect_trend(t, team_names=["NATION_1"], priorities=["High"]).inputFiles()
    read = {os.path.basename(os.path.dirname(f)) for f in files}
    assert read == {"cells_issues", "projects", "teams"}
    assert t["cells_issues"].filter("grain = 'all'").count() < t["issues"].count() / 10


# --- weekly refresh


@sampled
def test_refreshes_add_up_in_any_order_and_replace_what_changed(spark, tmp_path):
    tables = sample_tables(spark, SF_DIR)
    t = {name: tables[name] for name in ("teams", *refresh.DATES)}
    weeks = refresh.weeks_of(t)
    folder = str(tmp_path / "kept")
    # another state of one week first: it has to go
    stale = {**t, "issues": t["issues"].withColumn("issue_type", F.lit("Bug"))}
    refresh.refresh(stale, folder, weeks[:3])
    for part in (weeks[40:], weeks[:20], weeks[20:40]):
        refresh.refresh(t, folder, part)
    kept = refresh.kept_weeks(spark, folder)
    places = lambda df: {
        r.team_id: {k: round(v, 6) if isinstance(v, float) else v for k, v in r.asDict().items()} for r in df.collect()
    }
    assert places(refresh.team_kpis(kept, t["teams"])) == places(kpi.team_kpis(t))
    # all facts of a week are gone
    gone = {**t, "issues": t["issues"].filter(F.trunc("created_date", "week") != F.lit(weeks[5]))}
    refresh.refresh({**gone, **{n: t[n].limit(0) for n in refresh.DATES if n != "issues"}, "sprints": t["sprints"]}, folder, [weeks[5]])
    left = refresh.kept_weeks(spark, folder).filter(F.col("week") == F.lit(weeks[5])).filter("issues > 0")
    assert left.count() == 0


@sampled
def test_a_refresh_reads_the_span_of_its_weeks(spark):
    t = sample_tables(spark, SF_DIR)
    found = refresh._of_weeks(t["issues"], "created_date", [dt.date(1996, 1, 1)])
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"created_date#\d+ >= 1996-01-01", plan) and re.search(r"created_date#\d+ < 1996-01-08", plan)
    assert found.filter(~F.col("created_date").between("1996-01-01", "1996-01-07")).count() == 0
