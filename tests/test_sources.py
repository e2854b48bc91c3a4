"""Readers and writers."""

import datetime as dt
import gzip
import os
import random
import time

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
from deliverylens.operators import slices
from deliverylens.plans import cleaning, questions, report
from deliverylens.plans.stages import raw_tables, sample_tables
from deliverylens.schema import TABLES
from deliverylens.session import scratch_dir
from deliverylens.sources import tables as io


def write(path, text):
    path.write_text(text)
    return str(path)


def test_columns_bind_by_name(spark, tmp_path):
    p = write(tmp_path / "teams.csv", "department,formed_date,team_id,team_name\nEng,2023-02-01,T1,Search\n")
    row = io.read_csv_table(spark, p, "teams").first()
    assert tuple(row) == ("T1", "Search", "Eng", dt.date(2023, 2, 1))


def test_fractional_text_in_line_counts_survives(spark, tmp_path):
    head = "commit_id,project_id,sprint_id,developer_id,commit_timestamp,lines_added,lines_deleted,files_changed\n"
    p = write(tmp_path / "commits.csv", head + "C1,P,S,D,2024-01-01 10:00:00,50.0,3,1\n")
    assert io.read_csv_table(spark, p, "commits").first().lines_added == 50.0


def test_quotes_and_line_breaks(spark, tmp_path):
    text = 'team_id,team_name,department,formed_date\nT1,"Core ""A"", infra","a\nb",2023-02-01\n'
    p = write(tmp_path / "teams.csv", text)
    row = io.read_csv_table(spark, p, "teams", multi_line=True).first()
    assert (row.team_name, row.department) == ('Core "A", infra', "a\nb")
    df = spark.createDataFrame([("T1", 'x "y", z\\', "line\nbreak"), ("T2", "plain", "")], "team_id string, team_name string, department string")
    io.write_csv_table(df, str(tmp_path / "out.csv"))
    back = io.read_csv_text(spark, str(tmp_path / "out.csv"), multi_line=True)
    assert {r.team_id: (r.team_name, r.department or "") for r in back.collect()} == {
        "T1": ('x "y", z\\', "line\nbreak"),
        "T2": ("plain", ""),
    }


def test_whole_numbers_with_a_fraction_of_zero(spark, tmp_path):
    names = [f.name for f in TABLES["pull_requests"].columns(False)]
    values = {"pull_request_id": "P1", "opened_date": "2024-01-01 00:00:00", "pr_size_lines": "120.0"}
    p = write(tmp_path / "pull_requests.csv", ",".join(names) + "\n" + ",".join(values.get(n, "") for n in names) + "\n")
    assert io.read_csv_table(spark, p, "pull_requests").first().pr_size_lines == 120
    values["pr_size_lines"] = "120.5"
    bad = write(tmp_path / "bad.csv", ",".join(names) + "\n" + ",".join(values.get(n, "") for n in names) + "\n")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        io.read_csv_table(spark, bad, "pull_requests").collect()


def test_lenient_and_strict_columns(spark, tmp_path):
    head = (
        "release_id,project_id,team_id,sprint_id,planned_release_date,actual_release_date,"
        "release_delay_days,status,version\n"
    )
    ok = write(tmp_path / "a.csv", head + "R1,P,T,S,2024-01-02,oops,,Cancelled,v1\n")
    assert io.read_csv_table(spark, ok, "releases").first().actual_release_date is None
    bad = write(tmp_path / "b.csv", head + "R1,P,T,S,oops,,,Cancelled,v1\n")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        io.read_csv_table(spark, bad, "releases").collect()


def test_keep_first_follows_the_file_order(spark, tmp_path):
    head = "developer_id,full_name,team_id,role,seniority,hire_date,timezone\n"
    lines = [f"D{i % 40},name{i},T1,r,s,2024-01-01,UTC" for i in range(120)]
    p = write(tmp_path / "developers.csv", head + "\n".join(lines) + "\n")
    kept = cleaning.clean_developers(io.read_csv_table(spark, p, "developers", with_arrival=True)).collect()
    assert len(kept) == 40 and all(r.full_name == "name" + r.developer_id[1:] for r in kept)


def test_csv_and_parquet_round_trips(spark, tmp_path):
    t = sample_tables(spark, "/root/testdata/sf0.001")
    sprints = t["sprints"]
    io.write_csv_table(sprints, str(tmp_path / "sprints.csv"))
    back = io.read_csv_set(spark, str(tmp_path), ["sprints"], processed=True)["sprints"]
    assert back.columns == [f.name for f in TABLES["sprints"].columns()]
    total = F.sum("sprint_completion_rate")
    assert back.agg(total).first()[0] == pytest.approx(sprints.agg(total).first()[0])
    io.write_parquet_set({"sprints": sprints}, str(tmp_path / "set"))
    again = io.read_parquet_set(spark, str(tmp_path / "set"), ["sprints"])["sprints"]
    assert again.schema == sprints.schema and again.exceptAll(sprints).count() == 0


def test_report_sheets(spark, tmp_path):
    t = sample_tables(spark, "/root/testdata/sf0.001")
    sheets = report.weekly_report(t, "2024-07-01")
    io.write_report(sheets, str(tmp_path / "report"))
    summary = io.read_csv_text(spark, str(tmp_path / "report" / "kpi_summary"))
    assert {r.metric for r in summary.collect()} >= {"report_date", "total_projects"}
    assert len(sheets) == 8


def test_audit_log_sink(spark, tmp_path):
    audit = spark.createDataFrame([("issues", "rows_in", 5.0)], "table_name string, metric string, value double")
    io.write_report({"cleaning_audit": audit}, str(tmp_path), fmt="parquet")
    assert spark.read.parquet(str(tmp_path / "cleaning_audit")).first().value == 5.0


def test_team_view_is_queryable(spark):
    t = sample_tables(spark, "/root/testdata/sf0.001")
    questions.register_team_view(spark, t)
    rows = spark.sql("SELECT count(*) AS n FROM team_performance_summary WHERE avg_sprint_completion_pct > 0").first()
    assert rows.n > 0


def test_catalog_append_binds_by_name(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS lens LOCATION '{tmp_path}/lens'")
    a = spark.createDataFrame([("T1", "x")], "team_id string, team_name string")
    io.append_tables({"teams": a}, "lens")
    io.append_tables({"teams": a.select("team_name", "team_id")}, "lens")
    assert {tuple(r) for r in spark.table("lens.teams").collect()} == {("T1", "x")}
    assert spark.table("lens.teams").count() == 2
    io.register_views({"teams_now": a})
    assert spark.table("teams_now").count() == 1
    spark.sql("DROP DATABASE lens CASCADE")


class _Session:
    """Just enough of a session to ask for its scratch folder."""

    def __init__(self, configured, master):
        self.conf = {"spark.checkpoint.dir": configured} if configured else {}
        self.sparkContext = type("Context", (), {"master": master})()


def test_scratch_folder_is_the_configured_one():
    assert scratch_dir(_Session("hdfs:///shared/scratch/", "yarn")) == "hdfs:///shared/scratch"


def test_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_dir(_Session(None, "yarn"))


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {f for f in files.mkString("\n").splitlines() if "/shuffle_" in f}


def line_rows(rng, n):
    """Order lines with repeated keys, NULL dates and arrivals that all differ."""
    days = [None, *[dt.datetime(1996, 1, 1) + dt.timedelta(days=d) for d in range(40)]]
    return [
        (rng.randrange(60), rng.randrange(9), rng.choice([*range(5), 77]), rng.randrange(1, 4), float(rng.randrange(1, 51)), 100.0 + k, 0.05, 0.07,
         rng.choice("RAN"), rng.choice("OF"), rng.choice(days)) for k in range(n)
    ]


@pytest.mark.parametrize("rows", [0, 600])
def test_csv_round_trip_works_off_slices(spark, tmp_path, monkeypatch, rows):
    """Lines are packed and in order of arrival over all slices; each write drops its shuffle
    files; the rows are those of the table that was never exported."""
    rng = random.Random(3)
    lines = line_rows(rng, rows)
    types = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double,"
    types += " l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    orders = [(k, k % 7, "FOP"[k % 3], f"{k % 5 + 1}-X") for k in range(55)]
    spark.createDataFrame(lines, types).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_orderpriority string").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(k, k) for k in range(5)], "s_suppkey long, s_nationkey int").write.parquet(f"{tmp_path}/supplier.parquet")
    monkeypatch.setattr(slices, "ROWS_A_SLICE", 200)
    exported, left = [], []

    def watched(df, path, *args, write=io.write_csv_table, **options):
        before = shuffle_files(spark)
        write(df, path, *args, **options)
        for name in sorted(f for f in os.listdir(path.removeprefix("file:")) if f.startswith("part-")):
            assert name.endswith(".csv.gz")
            with gzip.open(f"{path.removeprefix('file:')}/{name}", "rt") as f:
                head, *body = f.read().splitlines()
            exported.extend(int(x.split(",")[head.split(",").index("issue_id")]) for x in body)
        until = time.time() + 20
        while shuffle_files(spark) - before and time.time() < until:
            time.sleep(0.1)
        left.append(shuffle_files(spark) - before)

    monkeypatch.setattr(io, "write_csv_table", watched)
    found = entry_point.queries()["io_csv_issues"](spark, str(tmp_path))
    assert left == [set()] * (1 + min(3, rows // 200))
    kept = sorted(
        (x for x in lines if x[0] < 55 and x[2] < 5), key=lambda x: (x[10] is not None, x[10] or 0, x[1], x[2], x[4], x[5])
    )
    assert exported == [x[0] * 10 + x[3] for x in kept]
    direct = entry_point._plain(cleaning.clean_issues(raw_tables(spark, str(tmp_path))["issues"]))
    text = lambda df: sorted(map(str, df.select(*[F.col(c).cast("string") for c in sorted(df.columns)]).collect()))
    assert text(found) == text(direct) and len(text(direct)) == len(set(exported))


def test_slices_hold_every_row_once(spark):
    rows = [(k % 50 / 7 if k % 11 else None, k) for k in range(300)] + [(float("nan"), 300), (float("-inf"), 301)]
    df = spark.createDataFrame(rows, "x double, k long")
    parts = slices.ordered_slices(df, F.col("x"), slices.even_cuts(df, "x", 4))
    rank = lambda x: (x is not None, x is not None and x != x, 0 if x is None or x != x else x)
    found = [sorted(((rank(r.x), r.k) for r in part.collect())) for part in parts]
    assert len(found) == 4 and sum(found, []) == sorted((rank(x), k) for x, k in rows)
    nothing = df.where("k < 0")
    assert len(slices.ordered_slices(nothing, F.col("x"), slices.even_cuts(nothing, "x", 4))) == 1
    by_key = [{r.x for r in part.collect()} for part in slices.key_slices(df.where("not isnan(x) or x is null"), ["x"], 3)]
    assert sum(map(len, by_key)) == len(set.union(*by_key))
