"""Repeatable loads, persisted views and bucketed tables."""

import os
import uuid

import pytest
from pyspark.sql import functions as F

from deliverylens.plans import explore
from deliverylens.plans.stages import sample_tables
from deliverylens.schema import TABLES
from deliverylens.sources import layout, loads


@pytest.fixture
def database(spark, tmp_path):
    name = f"lens_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path}/{name}'")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def teams(spark, *ids):
    return spark.createDataFrame([(i, f"team {i}") for i in ids], "team_id string, team_name string")


def projects(spark, *ids):
    return spark.createDataFrame([(i, "T1") for i in ids], "project_id string, team_id string")


def ids(spark, database, table):
    return sorted(r[0] for r in loads.loaded_table(spark, database, table).select(TABLES[table].primary_key).collect())


def test_parents_come_first():
    order = loads.parents_first(TABLES)
    assert sorted(order) == sorted(TABLES)
    for name in order:
        assert all(order.index(p) < order.index(name) for p in TABLES[name].references.values())


def test_a_repeated_load_adds_nothing(spark, database):
    first = {"projects": projects(spark, "P1"), "teams": teams(spark, "T1", "T2")}
    assert loads.load_tables(first, database, "week 1")
    assert not loads.load_tables(first, database, "week 1")
    assert ids(spark, database, "teams") == ["T1", "T2"]
    # columns bind by name, whatever their order
    assert loads.load_tables({"teams": teams(spark, "T3").select("team_name", "team_id")}, database, "week 2")
    assert ids(spark, database, "teams") == ["T1", "T2", "T3"]
    log = {(r.load_id, r.table_name): r.row_count for r in loads.complete_loads(spark, database).collect()}
    assert log == {("week 1", "projects"): 1, ("week 1", "teams"): 2, ("week 2", "teams"): 1}


def test_a_failed_load_is_not_seen_and_can_be_repeated(spark, database):
    loads.load_tables({"teams": teams(spark, "T1"), "projects": projects(spark, "P1")}, database, "a")
    broken = projects(spark, "P2").withColumn("project_id", F.raise_error(F.lit("gone")).cast("string"))
    with pytest.raises(Exception, match="gone"):
        loads.load_tables({"projects": broken, "teams": teams(spark, "T2", "T3")}, database, "it's b")
    # the parents had been written
    assert spark.table(f"{database}.teams").count() == 3
    assert ids(spark, database, "teams") == ["T1"] and ids(spark, database, "projects") == ["P1"]
    # the second try brings fewer teams and no projects: nothing of the first one is left
    none = projects(spark, "P2").limit(0)
    assert loads.load_tables({"projects": none, "teams": teams(spark, "T2")}, database, "it's b")
    assert ids(spark, database, "teams") == ["T1", "T2"] and ids(spark, database, "projects") == ["P1"]


def test_only_partitions_of_complete_loads_are_read(spark, database):
    for load in ("a", "b"):
        loads.load_tables({"teams": teams(spark, load)}, database, load)
    plan = loads.loaded_table(spark, database, "teams")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "load_id" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert loads.loaded_table(spark, database, "teams").columns == ["team_id", "team_name"]


def test_nothing_loaded_shows_nothing(spark, database):
    teams(spark, "T1").withColumn("load_id", F.lit("x")).write.partitionBy("load_id").saveAsTable(f"{database}.teams")
    assert ids(spark, database, "teams") == []


def test_a_view_outlives_its_session(spark, database):
    loads.load_tables({"teams": teams(spark, "T1", "T2")}, database, "a")
    loads.save_view(spark, f"{database}.named", f"SELECT team_name FROM {database}.teams WHERE team_id = 'T2'")
    other = spark.newSession()
    assert [r[0] for r in other.table(f"{database}.named").collect()] == ["team T2"]
    loads.save_view(other, f"{database}.named", f"SELECT team_id FROM {database}.teams")
    assert spark.table(f"{database}.named").count() == 2


SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def exchanges(df):
    """Shuffles of the plan before it runs, joins by sorting."""
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="sample tables not present")
def test_work_by_project_on_buckets_needs_fewer_shuffles(spark, database):
    t = sample_tables(spark, SF_DIR)
    names = [n for n in TABLES if n != "code_reviews"]
    layout.write_bucketed({n: t[n] for n in names}, database, 8)
    laid = layout.catalog_set(spark, database, names)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sums = laid["issues"].groupBy("project_id", "sprint_id").agg(F.count("*").alias("n"))
        joined = sums.join(laid["deployments"].groupBy("project_id").agg(F.count("*").alias("d")), "project_id")
        assert exchanges(joined) == 0
        # five sums by project go on as they lie; only their results are brought together
        in_buckets, as_written = (exchanges(explore.project_metrics(x, keep_unknown=True)) for x in (laid, t))
        assert in_buckets <= 1 and as_written >= 5
        # the layout changes no row
        assert laid["issues"].exceptAll(t["issues"]).count() == 0 == t["issues"].exceptAll(laid["issues"]).count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_bucket_counts_follow_the_rows():
    assert [layout.bucket_count(n, 10) for n in (0, 80, 81, 1000)] == [8, 8, 16, 128]
