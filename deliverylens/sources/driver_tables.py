"""Delivery-shaped raw tables derived from the TPC-H-style sample tables.

Suppliers act as projects, customers as developers, nations as teams, line
items as issues, orders as pull requests and the event log as commits and
deployments. Repeated (order, line) keys and unclean values are kept, so the
cleaning operators have real work.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _quarter_number(c: Column) -> Column:
    return ((F.year(c) - 1995) * 4 + F.quarter(c)).cast("bigint")


def _quarter_start(number: Column) -> Column:
    index = number - 1
    return F.make_date(
        (F.lit(1995) + F.floor(index / 4)).cast("int"),
        (F.pmod(index, F.lit(4)) * 3 + 1).cast("int"),
        F.lit(1),
    )


def _cycle(key: Column, *values: str) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (F.pmod(key, F.lit(len(values))) + 1).cast("int"))


def _row_count(spark, sf_dir, name) -> Column:
    return _read(spark, sf_dir, name).agg(F.count(F.lit(1))).scalar()


def teams(spark, sf_dir):
    nation = _read(spark, sf_dir, "nation")
    region = _read(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_nationkey").cast("bigint").alias("team_id"),
        F.col("n_name").alias("team_name"),
        F.col("r_name").alias("department"),
        F.to_date(F.lit("1995-01-01")).alias("formed_date"),
    )


def developers(spark, sf_dir):
    balance = F.col("c_acctbal")
    return _read(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("developer_id"),
        F.col("c_name").alias("full_name"),
        F.col("c_nationkey").cast("bigint").alias("team_id"),
        F.col("c_mktsegment").alias("role"),
        F.when(balance < 0, "Junior")
        .when(balance < 3000, "Mid")
        .when(balance < 7000, "Senior")
        .otherwise("Staff")
        .alias("seniority"),
        F.date_add(F.to_date(F.lit("1995-01-01")), F.pmod("c_custkey", F.lit(1000)).cast("int")).alias("hire_date"),
        _cycle(F.col("c_custkey"), "UTC", "EST", "CET", "PST", "IST").alias("timezone"),
    )


def projects(spark, sf_dir):
    balance = F.col("s_acctbal")
    return _read(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("project_id"),
        F.col("s_name").alias("project_name"),
        F.col("s_nationkey").cast("bigint").alias("team_id"),
        F.date_add(F.to_date(F.lit("1995-01-01")), F.pmod("s_suppkey", F.lit(60)).cast("int")).alias("start_date"),
        F.when(balance < 2000, "Low").when(balance < 6000, "Medium").otherwise("High").alias("criticality"),
        _cycle(F.col("s_suppkey"), "Go", "Java", "Python", "Node").alias("tech_stack"),
    )


def sprints(spark, sf_dir):
    per_quarter = (
        _read(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_suppkey").alias("project_id"), _quarter_number(F.col("l_shipdate")).alias("qn"))
        .agg(
            F.count(F.lit(1)).cast("int").alias("planned_story_points"),
            (F.count_if(F.col("l_linestatus") == "F") * 2).cast("int").alias("completed_story_points"),
        )
    )
    supplier = _read(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("project_id"), F.col("s_nationkey").cast("bigint").alias("team_id")
    )
    start = _quarter_start(F.col("qn"))
    return per_quarter.join(supplier, "project_id").select(
        (F.col("project_id") * 1000 + F.col("qn")).alias("sprint_id"),
        "project_id",
        "team_id",
        F.col("qn").cast("int").alias("sprint_number"),
        start.alias("sprint_start_date"),
        F.date_add(start, 89).alias("sprint_end_date"),
        "planned_story_points",
        "completed_story_points",
    )


def issues(spark, sf_dir):
    line = _read(spark, sf_dir, "lineitem")
    orders = _read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    supplier = _read(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    joined = line.join(orders, line.l_orderkey == orders.o_orderkey).join(
        supplier, line.l_suppkey == supplier.s_suppkey
    )
    finished = F.col("l_linestatus") == "F"
    stage = (
        F.when(finished & (F.col("l_quantity") > 48), "DONE  ")
        .when(finished, "Done")
        .when(F.col("o_orderstatus") == "P", "Reopened")
        .otherwise("In Progress")
    )
    is_bug = F.col("l_returnflag") == "R"
    issue_key = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    resolved = finished | (F.col("o_orderstatus") == "P")
    hours = F.when(issue_key % 199 == 0, F.col("l_quantity") * 40).otherwise(F.col("l_quantity"))
    rank = F.substring("o_orderpriority", 1, 1)
    return joined.select(
        issue_key.alias("issue_id"),
        F.col("l_suppkey").alias("project_id"),
        (F.col("l_suppkey") * 1000 + _quarter_number(F.col("l_shipdate"))).alias("sprint_id"),
        F.col("s_nationkey").cast("bigint").alias("team_id"),
        F.col("o_custkey").alias("assignee_id"),
        F.when(is_bug, "Bug").when(F.col("l_returnflag") == "A", "Task").otherwise("Story").alias("issue_type"),
        F.when(rank == "1", "Critical")
        .when(rank == "2", "High")
        .when(rank == "3", "Medium")
        .otherwise("Low")
        .alias("priority"),
        F.when(is_bug, _cycle(F.col("l_linenumber"), "Minor", "Major", "Critical", "Blocker")).alias("severity"),
        stage.alias("status"),
        F.col("l_shipdate").alias("created_date"),
        F.when(
            resolved,
            F.col("l_shipdate") + F.make_dt_interval(F.lit(0), F.col("l_quantity").cast("int")),
        ).alias("resolved_date"),
        F.when(resolved, hours).alias("resolution_time_hours"),
        ((F.col("l_discount") >= 0.09) | (~finished & (F.col("o_orderstatus") == "P")))
        .cast("int")
        .alias("reopened"),
        (is_bug & (F.col("l_tax") >= 0.07)).cast("int").alias("escaped_defect"),
        F.struct(
            "l_shipdate",
            "l_partkey",
            "l_suppkey",
            "l_quantity",
            "l_extendedprice",
            "l_discount",
            "l_tax",
            "l_returnflag",
            "l_linestatus",
        ).alias("arrival"),
    )


def pull_requests(spark, sf_dir):
    projects_total = _row_count(spark, sf_dir, "supplier")
    developers_total = _row_count(spark, sf_dir, "customer")
    key = F.col("o_orderkey")
    half_hours = key % 97
    is_open = F.col("o_orderstatus") == "O"
    base = _read(spark, sf_dir, "orders").withColumn("project_id", key % projects_total)
    return base.select(
        key.alias("pull_request_id"),
        "project_id",
        (F.col("project_id") * 1000 + _quarter_number(F.col("o_orderdate"))).alias("sprint_id"),
        F.col("o_custkey").alias("author_id"),
        ((F.col("o_custkey") + 1) % developers_total).alias("reviewer_id"),
        F.col("o_orderdate").alias("opened_date"),
        F.when(
            ~is_open,
            F.col("o_orderdate") + F.make_dt_interval(F.lit(0), F.lit(0), (half_hours * 30).cast("int")),
        ).alias("closed_date"),
        F.when(~is_open & (key % 50 != 0), half_hours / 2).alias("review_time_hours"),
        F.floor(F.col("o_totalprice") / 1000).cast("int").alias("pr_size_lines"),
        F.when(F.col("o_orderstatus") == "F", "Merged")
        .when(F.col("o_orderstatus") == "P", "Closed")
        .otherwise("Open")
        .alias("status"),
    )


def code_reviews(spark, sf_dir):
    prs = pull_requests(spark, sf_dir).filter(F.col("status") != "Open")
    key = F.col("pull_request_id")
    return prs.select(
        key.alias("review_id"),
        "pull_request_id",
        "reviewer_id",
        (key % 3 + 1).cast("int").alias("review_round"),
        (key % 12).cast("int").alias("comments_count"),
        F.lit(1).alias("approved"),
        (F.col("opened_date") + F.make_dt_interval(F.lit(0), F.lit(1))).alias("review_timestamp"),
    )


def commits(spark, sf_dir):
    projects_total = _row_count(spark, sf_dir, "supplier")
    key = F.col("event_id")
    project = F.col("user_id") % projects_total
    return _read(spark, sf_dir, "events").select(
        key.alias("commit_id"),
        project.alias("project_id"),
        (project * 1000 + key % 27 + 1).alias("sprint_id"),
        F.col("user_id").alias("developer_id"),
        F.col("ts").alias("commit_timestamp"),
        F.when(key % 25 == 0, F.lit(-1.0)).otherwise(F.floor("value").cast("double")).alias("lines_added"),
        (key % 40).cast("int").alias("lines_deleted"),
        (key % 9 + 1).cast("int").alias("files_changed"),
    )


def deployments(spark, sf_dir):
    projects_total = _row_count(spark, sf_dir, "supplier")
    key = F.col("event_id")
    failed = F.col("event_type") == "error"
    project = key % projects_total
    qn = key % 27 + 1
    started = F.date_add(_quarter_start(qn), (key % 30 + 60).cast("int")).cast("timestamp_ntz")
    return (
        _read(spark, sf_dir, "events")
        .filter(F.col("event_type").isin("error", "purchase", "signup"))
        .select(
            key.alias("deployment_id"),
            project.alias("project_id"),
            (project * 1000 + qn).alias("sprint_id"),
            F.when(key % 5 < 2, "production").otherwise("staging").alias("environment"),
            (started + F.make_dt_interval(F.lit(0), (key % 24).cast("int"))).alias("deployment_timestamp"),
            F.when(failed, "Failed").otherwise("Success").alias("status"),
            (failed & (key % 2 == 0)).cast("int").alias("rollback"),
            F.col("value").alias("duration_minutes"),
        )
    )


def releases(spark, sf_dir):
    key = F.col("sprint_id")
    delay = F.greatest(F.lit(0), key * 7 % 11 - 4)
    cancelled = key % 37 == 0
    planned = F.date_add("sprint_end_date", 2)
    return (
        sprints(spark, sf_dir)
        .filter(key % 2 == 0)
        .select(
            key.alias("release_id"),
            "project_id",
            "team_id",
            "sprint_id",
            planned.alias("planned_release_date"),
            F.when(~cancelled, F.date_add(planned, delay.cast("int"))).alias("actual_release_date"),
            F.when(~cancelled, delay.cast("double")).alias("release_delay_days"),
            F.when(cancelled, "Cancelled").when(delay > 1, "Delayed").otherwise("On Time").alias("status"),
            F.concat_ws(
                ".",
                F.concat(F.lit("v"), (F.col("sprint_number") % 4 + 1).cast("string")),
                (F.col("project_id") % 20).cast("string"),
                (F.col("sprint_number") % 10).cast("string"),
            ).alias("version"),
        )
    )


# the sample table that a table with an arrival is made of, row by row, and the arrival's first column
ARRIVES_BY = {"issues": ("lineitem", "l_shipdate")}

RAW_LOADERS = {
    loader.__name__: loader
    for loader in (
        teams,
        developers,
        projects,
        sprints,
        issues,
        commits,
        pull_requests,
        code_reviews,
        deployments,
        releases,
    )
}
