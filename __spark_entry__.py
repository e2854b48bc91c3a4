"""Registered queries over the sample tables, and their SQL twins."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from deliverylens.operators import profile as P
from deliverylens.operators import quality, sketches
from deliverylens.operators.scaling import minmax_scale
from deliverylens.operators.slices import even_cuts, ordered_slices, slice_count
from deliverylens.plans import cleaning, cube, dashboard, explore, features, kpi, questions, refresh, report, risk
from deliverylens.plans.stages import raw_tables, sample_tables
from deliverylens.schema import ALL_REFERENCES, CORE_REFERENCES, KPI_TABLES, TABLES
from deliverylens.session import materialized, remove_folder, scratch_dir, shuffles_dropped
from deliverylens.sources import layout, loads
from deliverylens.sources import tables as tables_io
from deliverylens.sources.driver_tables import ARRIVES_BY

SMOKE_DIR = "/root/testdata/sf0.001"


def _plain(df: DataFrame) -> DataFrame:
    """Comparable output: whole numbers as bigint, fractions to six places."""
    columns = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.IntegerType, T.ShortType)):
            c = c.cast("bigint")
        elif isinstance(f.dataType, T.DoubleType):
            # the same arithmetic as the SQL twins, so ties fall the same way; values too
            # large for six places, NaN and infinities stay as they are
            c = F.when(F.abs(c) < 1e9, F.floor(c * 1e6 + 0.5) / 1e6).otherwise(c)
        columns.append(c.alias(f.name))
    return df.select(*columns)


def _on_tables(build) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: _plain(build(sample_tables(spark, sf_dir)))


def _on_raw(build) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: _plain(build(raw_tables(spark, sf_dir)))


def _cleaned(name: str):
    return _on_raw(lambda raw: cleaning.CLEANERS[name](raw[name]))


# a fixed choice for the dashboard's filters
CHOICE = {
    "team_names": ["NATION_1", "NATION_3", "NATION_7", "NATION_15", "NATION_16", "NATION_20"],
    "priorities": ["High", "Critical", "Low"],
}


def _filtered(build):
    """A dashboard product under the fixed choice of teams and priorities."""
    return _on_tables(lambda t: build(t, dashboard.apply_filters(t, **CHOICE)))


def _unfiltered(build):
    return _on_tables(lambda t: build(t, dashboard.apply_filters(t)))


def _range_checks(t) -> DataFrame:
    rate = F.col("sprint_completion_rate")
    score = F.col("project_health_score")
    return quality.violations(
        [
            quality.Rule("sprint completion rate within 0 and 1.21", t["sprints"], (rate < 0) | (rate > 1.21)),
            quality.Rule("no negative added lines", t["commits"], F.col("lines_added") < 0, null_breaks=True),
            quality.Rule("issue status in its domain", t["issues"], cleaning.status_domain_rule(), null_breaks=True),
            quality.Rule(
                "project health within 0 and 100", t["kpi_project_health"], (score < 0) | (score > 100), null_breaks=True
            ),
        ]
    )


def _scratch_copy(spark, name: str, write: Callable[[str], None], read: Callable[[str], DataFrame]) -> DataFrame:
    """What ``read`` finds in a folder that ``write`` has filled; the folder is gone afterwards."""
    folder = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
    try:
        write(folder)
        return materialized(read(folder), name)
    finally:
        remove_folder(spark, folder)


def _output_presence(spark, sf_dir) -> DataFrame:
    """Whether each expected output is in the folder that the KPI tables were written to,
    with one name that is never written, so that an absent one shows."""
    t = sample_tables(spark, sf_dir)
    expected = [*KPI_TABLES, "weekly_report"]
    return _plain(
        _scratch_copy(
            spark,
            "outputs",
            lambda folder: tables_io.write_parquet_set({name: t[name] for name in KPI_TABLES}, folder),
            lambda folder: quality.output_presence(tables_io.tables_in(spark, folder, expected), expected, spark),
        )
    )


def _processed_set(spark, sf_dir) -> DataFrame:
    """All cleaned tables written as a Parquet set, found again by name, and counted."""
    t = sample_tables(spark, sf_dir)
    return _plain(
        _scratch_copy(
            spark,
            "processed",
            lambda folder: tables_io.write_parquet_set({name: t[name] for name in TABLES}, folder),
            lambda folder: quality.row_counts(tables_io.tables_in(spark, folder, TABLES), TABLES),
        )
    )


def _report_sheets(spark, sf_dir) -> DataFrame:
    """The weekly report written as CSV sheets; the sheet of recommendations read back."""
    t = sample_tables(spark, sf_dir)

    def read(folder: str) -> DataFrame:
        sheet = tables_io.read_csv_text(spark, f"{folder}/recommendations")
        return sheet.withColumn("risk_score", F.col("risk_score").cast("double"))

    return _plain(
        _scratch_copy(spark, "report", lambda folder: tables_io.write_report(report.weekly_report(t, "2024-07-01"), folder), read)
    )


@contextmanager
def _database(spark) -> Iterator[str]:
    """A catalog database of its own below the shared folder, dropped with all it holds."""
    name = f"lens_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch_dir(spark)}/{name}'")
    try:
        yield name
    finally:
        spark.sql(f"DROP DATABASE {name} CASCADE")


def _repeated_load(spark, sf_dir) -> DataFrame:
    """All cleaned tables loaded in two loads, each of them twice, and counted once."""
    t = sample_tables(spark, sf_dir)
    with _database(spark) as database:
        for half in (0, 1):
            rows = {n: t[n].filter(F.pmod(F.xxhash64(TABLES[n].primary_key), F.lit(2)) == half) for n in TABLES}
            for _ in range(2):
                loads.load_tables(rows, database, f"half-{half}")
        counts = quality.row_counts({n: loads.loaded_table(spark, database, n) for n in TABLES}, TABLES)
        return _plain(materialized(counts, "loaded"))


def _catalog_view(spark, sf_dir) -> DataFrame:
    """A view that the catalog keeps over loaded tables, replaced once, as another session sees it."""
    t = sample_tables(spark, sf_dir)
    with _database(spark) as database:
        t["kpi_team_summary"].write.saveAsTable(f"{database}.team_kpis")
        columns = "team_name, avg_sprint_velocity, bug_reopen_rate_pct"
        loads.save_view(spark, f"{database}.fast_teams", f"SELECT {columns} FROM {database}.team_kpis")
        loads.save_view(
            spark,
            f"{database}.fast_teams",
            f"SELECT {columns} FROM {database}.team_kpis WHERE avg_sprint_velocity > 20",
        )
        return _plain(materialized(spark.newSession().table(f"{database}.fast_teams"), "view"))


def _bucketed_metrics(spark, sf_dir) -> DataFrame:
    """Project metrics from facts in buckets by project."""
    t = sample_tables(spark, sf_dir)
    with _database(spark) as database:
        names = ("projects", "sprints", "issues", "pull_requests", "deployments", "releases")
        layout.write_bucketed({n: t[n] for n in names}, database, layout.bucket_count(t["issues"].count()))
        return _plain(materialized(explore.project_metrics(layout.catalog_set(spark, database, names)), "bucketed"))


def _weekly_folder(spark, t, read: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """What ``read`` makes of the state that ten refreshes leave, each of a tenth of the weeks,
    one of them repeated."""

    def write(folder: str) -> None:
        weeks = refresh.weeks_of(t)
        size = max(1, -(-len(weeks) // 10))
        for first in [*range(0, len(weeks), size), 0]:
            refresh.refresh(t, folder, weeks[first : first + size])

    return _scratch_copy(spark, "weekly", write, lambda folder: read(refresh.kept_weeks(spark, folder)))


def _cycle_quantiles(t, spark) -> DataFrame:
    """Rank sketches of weeks merged into one a team, and how many of its quartiles miss their
    rank by more than three times the error bound."""
    probs = [0.25, 0.5, 0.75, 0.995]
    merged = _weekly_folder(spark, t, refresh.cycle_sketches)
    resolved = t["issues"].filter("resolved_date IS NOT NULL").select(F.col("team_id").cast("string"), "cycle_time_days")
    answers = sketches.sketch_quantiles(merged, probs)
    return sketches.rank_misses(resolved, "cycle_time_days", ["team_id"], answers, probs, 3 * sketches.rank_error())


def _sketched_cap(raw, spark) -> DataFrame:
    """Issues cleaned with a cap from a sketch: rows, and whether the share of rows at the
    cap is the one wanted, within three times the error bound."""
    cleaned = materialized(cleaning.clean_issues(raw["issues"], sketch_size=sketches.SIZE), "sketched")
    cap = cleaned.agg(F.max("resolution_time_hours")).scalar()
    hours = F.col("resolution_time_hours")
    below, upto = F.count_if(hours < F.col("cap")), F.count_if(hours <= F.col("cap"))
    error = 3 * sketches.rank_error()
    wanted = cleaning.OUTLIER_QUANTILE
    return cleaned.withColumn("cap", cap).agg(
        F.count(F.lit(1)).alias("issues"),
        F.count(hours).alias("timed"),
        ((below / F.count(hours) <= wanted + error) & (upto / F.count(hours) >= wanted - error)).alias("within"),
    )


def entry(spark: SparkSession) -> DataFrame:
    """The team KPI table on the smallest sample."""
    return queries()["kpi_team"](spark, SMOKE_DIR)


def _model_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from deliverylens.plans import models

    def coefficients(t):
        return models.train_delay_models(t["release_delay_features"], ("Logistic Regression",)).importance()

    return {
        "train_test_split": _on_tables(
            lambda t: models.stratified_split(t["release_delay_features"], "release_id", "is_delayed").select(
                "release_id", "is_delayed", "is_train"
            )
        ),
        "ml_class_weights": _on_tables(
            lambda t: models.balanced_weights(t["release_delay_features"], "is_delayed")
            .groupBy("is_delayed")
            .agg(F.count(F.lit(1)).alias("releases"), F.max("weight").alias("weight"))
        ),
        "ml_metrics_rule": _on_tables(
            lambda t: models.held_out_scores(
                t["release_delay_features"].select(
                    "is_delayed",
                    F.round("historical_delay_rate", 6).alias("score"),
                    (F.col("open_bugs") > 3).cast("int").alias("prediction"),
                )
            )
        ),
        "ml_model_comparison": _on_tables(lambda t: t["model_comparison"]),
        "ml_best_model": _on_tables(
            lambda t: t["model_comparison"].orderBy(F.desc("f1_score"), "model").limit(1)
        ),
        "ml_feature_importance": _on_tables(lambda t: t["feature_importance"]),
        "ml_coefficients": _on_tables(coefficients),
    }


def _csv_round_trip(table: str):
    """A table exported to CSV in the scratch folder, read back by name and cleaned."""

    def run(spark, sf_dir):
        raw = raw_tables(spark, sf_dir)[table]
        ordered = table in ARRIVES_BY
        # the exported column order differs from the table's, so only names can bind
        names = sorted(c for c in raw.columns if c != "arrival")
        slices, parts, order = 1, [raw], []
        if ordered:
            source, first = ARRIVES_BY[table]
            rows = spark.read.parquet(f"{sf_dir}/{source}.parquet")
            slices = slice_count(rows.count())
            parts = ordered_slices(raw, F.col(f"arrival.{first}"), even_cuts(rows, first, slices))
            # by its fields, the first of which is then compared without looking into rows
            order = [F.col(f"arrival.{f}") for f in raw.schema["arrival"].dataType.names]

        def write(folder: str) -> None:
            # lines in order of arrival, which the reader takes from their places: slice by
            # slice, in folders whose names follow each other
            for k, part in enumerate(parts):
                lines = (part.orderBy(*order) if ordered else part).select(*names)
                with shuffles_dropped(spark):
                    tables_io.write_csv_table(lines, f"{folder}/{table}.csv/slice={k:04d}", packed=True)

        def read(folder: str) -> DataFrame:
            return tables_io.read_csv_table(spark, f"{folder}/{table}.csv", table, with_arrival=ordered)

        # the lines are gone before the rows that were read from them are cleaned
        back = _scratch_copy(spark, "export", write, read)
        return _plain(cleaning.CLEANERS[table](back, **({"slices": slices} if ordered else {})))

    return run


def _team_view(spark, sf_dir):
    questions.register_team_view(spark, sample_tables(spark, sf_dir))
    return _plain(
        spark.sql(
            "SELECT team_name, avg_sprint_completion_pct, bug_reopen_rate_pct, avg_pr_review_hours"
            " FROM team_performance_summary WHERE avg_sprint_completion_pct > 95"
        )
    )


def _llm():
    """The queries of the training-data subpackage, or None where it cannot be imported: it
    may be left out, and so may the libraries that it needs."""
    try:
        from deliverylens.llm import queries as llm
    except ImportError:
        return None
    return llm


def _llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    llm = _llm()
    return llm.queries() if llm else {}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    table_names = list(TABLES)
    q = questions
    d = dashboard
    return {
        # cleaning and data quality
        **{f"clean_{name}": _cleaned(name) for name in table_names},
        "clean_audit": _on_tables(lambda t: t["cleaning_audit"]),
        "validate_fk": _on_tables(lambda t: quality.validate_references(t, CORE_REFERENCES)),
        "validate_fk_all": _on_tables(lambda t: quality.validate_references(t, ALL_REFERENCES)),
        "pk_check": _on_tables(lambda t: quality.primary_key_checks(t, table_names)),
        "pk_check_raw": _on_raw(lambda raw: quality.primary_key_checks(raw, table_names)),
        "range_checks": _on_tables(_range_checks),
        "output_presence": _output_presence,
        "table_counts": _on_tables(lambda t: quality.row_counts(t, table_names)),
        # question pack
        "q01_team_completion": _on_tables(q.team_completion),
        "q02_velocity_last5": _on_tables(q.recent_velocity),
        "q03_velocity_trend": _on_tables(q.velocity_trend),
        "q04_cycle_by_priority": _on_tables(q.cycle_time_by_priority),
        "q05_project_delay_rate": _on_tables(q.late_projects),
        "q06_defect_rate": _on_tables(q.defect_rate),
        "q07_reopen_by_team": _on_tables(q.reopened_bugs_by_team),
        "q07_reopen_overall": _on_tables(q.reopened_bugs_with_overall),
        "q08_escaped_top10": _on_tables(q.escaped_defects_top),
        "q09_mttr_severity": _on_tables(q.mttr_by_severity),
        "q10_reopen_outliers": _on_tables(q.unusual_reopen_teams),
        "q11_review_by_team": _on_tables(q.review_time_by_team),
        "q12_merge_rate": _on_tables(q.merge_rate),
        "q13_size_bucket": _on_tables(q.review_time_by_size),
        "q14_reviewer_running": _on_tables(q.reviewer_load),
        "q15_load_percentile": _on_tables(q.assignment_percentiles),
        "q16_deploys_per_week": _on_tables(q.deploys_per_week),
        "q17_cfr_team": _on_tables(q.change_failure_by_team),
        "q18_deploy_vs_delay": _on_tables(q.deploys_against_delay),
        "q19_rollback_env": _on_tables(q.rollback_by_environment),
        "q20_release_success": _on_tables(q.release_success),
        "q21_monthly_delay": _on_tables(q.monthly_delay),
        "q22_project_health": _on_tables(q.project_health),
        "q23_team_view": _on_tables(q.team_performance_summary),
        "q24_blended_risk": _on_tables(q.blended_risk),
        "q25_workload_top": _on_tables(q.busiest_developers),
        # KPI framework
        "kpi_sprint": _on_tables(lambda t: kpi.sprint_kpis(t["sprints"])),
        "kpi_issue": _on_tables(lambda t: kpi.issue_kpis(t["issues"])),
        "kpi_pr": _on_tables(lambda t: kpi.review_kpis(t["pull_requests"], t["sprints"])),
        "kpi_deployment": _on_tables(lambda t: kpi.deployment_kpis(t["deployments"], t["sprints"])),
        "kpi_release": _on_tables(lambda t: kpi.release_kpis(t["releases"])),
        "kpi_team": _on_tables(kpi.team_kpis),
        "kpi_project_health": _on_tables(kpi.project_health),
        "kpi_workload": _on_tables(kpi.developer_workload),
        "kpi_productivity": _on_tables(lambda t: kpi.productivity(t, t["kpi_developer_workload"])),
        "minmax_scale": _on_tables(
            lambda t: minmax_scale(
                t["kpi_developer_workload"].select("developer_id", "workload_index", "reviews_given"),
                ["workload_index", "reviews_given"],
            )
        ),
        "deploys_per_active_week": _on_tables(lambda t: kpi.deploy_frequency(t["deployments"], t["sprints"])),
        # as-of features
        "feat_open_bugs": _on_tables(
            lambda t: features.at_cutoff(t, [features.issue_events(t["issues"])])
        ),
        "feat_pr_asof": _on_tables(
            lambda t: features.at_cutoff(t, [features.pull_request_events(t["pull_requests"])])
        ),
        "feat_deploy_14d": _on_tables(
            lambda t: features.at_cutoff(t, [features.deployment_events(t["deployments"])])
        ),
        "feat_hist_delay": _on_tables(features.history_by_plan),
        "feat_hist_known": _on_tables(features.history_known),
        "feat_workload": _on_tables(
            lambda t: features.release_features(t).select("release_id", "developer_workload_proxy")
        ),
        "feat_release_all": _on_tables(features.release_features),
        "feat_release_parity": _on_tables(lambda t: features.release_features(t, as_of=False)),
        "feat_release_opened": _on_tables(
            lambda t: features.release_features(t, as_of=False, pr_history="opened")
        ),
        # risk
        "risk_components": _on_tables(risk.risk_components),
        "risk_scores": _on_tables(risk.risk_scores),
        "risk_tiers": _on_tables(
            lambda t: risk.risk_scores(t).groupBy("risk_tier").agg(F.count(F.lit(1)).alias("projects"))
        ),
        # exploration
        "eda_completion_box": _on_tables(explore.completion_by_team),
        "eda_velocity_rolling": _on_tables(explore.rolling_velocity),
        "eda_bug_pivot": _on_tables(explore.bug_severity_by_month),
        "eda_reopen_team": _on_tables(explore.reopen_rate_by_team),
        "eda_size_fit": _on_tables(explore.review_time_fit),
        "eda_review_team": _on_tables(explore.review_time_by_team),
        "eda_deploy_monthly": _on_tables(explore.monthly_deployments),
        "eda_delay_box": _on_tables(explore.delay_by_criticality),
        "eda_load_hist": _on_tables(explore.load_histogram),
        "eda_load_quantiles": _on_tables(explore.load_quantiles),
        "eda_project_metrics": _on_tables(explore.project_metrics),
        "eda_project_metrics_bucketed": _bucketed_metrics,
        "eda_project_metrics_outer": _on_tables(lambda t: explore.project_metrics(t, keep_unknown=True)),
        "eda_corr_matrix": _on_tables(explore.metric_correlations),
        "eda_corr_pairs": _on_tables(
            lambda t: P.correlation_pairs(explore.project_metrics(t), list(explore.PROJECT_METRICS))
        ),
        "eda_notable_corr": _on_tables(lambda t: explore.notable_metric_correlations(t, 0.1)),
        "eda_profile": _on_tables(explore.issue_profile),
        "sample_hash": _on_tables(explore.review_sample),
        # weekly report
        "rep_recommendations": _on_tables(lambda t: report.recommendations(t["release_risk_scores"])),
        "rep_kpi_summary": _on_tables(lambda t: report.kpi_summary(t, "2024-07-01")),
        "rep_kpi_rows": _on_tables(lambda t: report.summary_as_rows(report.kpi_summary(t, "2024-07-01"))),
        "rep_at_risk": _on_tables(lambda t: report.at_risk_projects(t["release_risk_scores"])),
        "rep_low_quality": _on_tables(lambda t: report.lowest_quality(t["kpi_project_health"])),
        "rep_bottlenecks": _on_tables(lambda t: report.slowest_review_teams(t["kpi_team_summary"])),
        "rep_top_devs": _on_tables(lambda t: report.top_developers(t["kpi_developer_productivity"])),
        # dashboard
        "ex_filter_options": _on_tables(d.filter_options),
        "ex_filter_issues": _filtered(lambda t, f: f["issues"]),
        "ex_filter_counts": _filtered(lambda t, f: quality.row_counts(f, list(f))),
        "ex_cards": _unfiltered(lambda t, f: d.executive_cards(f)),
        "ex_cards_filtered": _filtered(lambda t, f: d.executive_cards(f)),
        "ex_completion_trend": _unfiltered(lambda t, f: d.completion_trend(f)),
        "ex_health_ranking": _filtered(lambda t, f: d.health_ranking(f)),
        "ex_team_velocity": _unfiltered(lambda t, f: d.team_ranking(f, "avg_sprint_velocity")),
        "ex_team_review_time": _unfiltered(lambda t, f: d.team_ranking(f, "avg_pr_review_hours")),
        "ex_team_reopen": _unfiltered(lambda t, f: d.team_ranking(f, "bug_reopen_rate_pct")),
        "ex_team_cfr": _unfiltered(lambda t, f: d.team_ranking(f, "change_failure_rate_pct")),
        "ex_productivity_hist": _filtered(d.productivity_histogram),
        "ex_cycle_box": _unfiltered(lambda t, f: d.cycle_time_by_priority(f)),
        "ex_severity_share": _unfiltered(lambda t, f: d.severity_share(f)),
        "ex_bugs_by_project": _unfiltered(d.bugs_by_project),
        "ex_defect_trend": _filtered(lambda t, f: d.defect_trend(f)),
        "ex_deploy_trend": _unfiltered(lambda t, f: d.deployment_trend(f)),
        "ex_release_share": _unfiltered(lambda t, f: d.release_outcomes(f)),
        "ex_delay_by_project": _unfiltered(d.delay_by_project),
        "ex_risk_ranking": _unfiltered(lambda t, f: d.risk_ranking(f)),
        "ex_risk_long": _unfiltered(lambda t, f: d.risk_breakdown(f)),
        "ex_risk_detail": _filtered(lambda t, f: d.risk_detail(f)),
        # the same products from cells
        "cube_cards": _on_tables(cube.executive_cards),
        "cube_cards_filtered": _on_tables(lambda t: cube.executive_cards(t, **CHOICE)),
        "cube_completion_trend": _on_tables(cube.completion_trend),
        "cube_severity_share": _on_tables(cube.severity_share),
        "cube_bugs_by_project": _on_tables(cube.bugs_by_project),
        "cube_defect_trend": _on_tables(lambda t: cube.defect_trend(t, **CHOICE)),
        "cube_deploy_trend": _on_tables(cube.deployment_trend),
        "cube_release_share": _on_tables(cube.release_outcomes),
        "cube_filter_counts": _on_tables(lambda t: cube.row_counts(t, **CHOICE)),
        # kept up to date week by week, and approximate quantiles
        "kpi_team_weekly": lambda spark, sf_dir: _plain(
            (lambda t: _weekly_folder(spark, t, lambda kept: refresh.team_kpis(kept, t["teams"])))(sample_tables(spark, sf_dir))
        ),
        "sketch_cycle_quantiles": lambda spark, sf_dir: _plain(_cycle_quantiles(sample_tables(spark, sf_dir), spark)),
        "sketch_outlier_cap": lambda spark, sf_dir: _plain(_sketched_cap(raw_tables(spark, sf_dir), spark)),
        # sources, sinks and views
        **{f"io_csv_{name}": _csv_round_trip(name) for name in table_names},
        "io_team_view": _team_view,
        "io_catalog_view": _catalog_view,
        "io_repeated_load": _repeated_load,
        "io_processed_set": _processed_set,
        "io_report_sheets": _report_sheets,
        "io_preview": _on_tables(lambda t: explore.preview(t["issues"], "issue_id")),
        # models
        **_model_queries(),
        # training data
        **_llm_queries(),
    }


def oracle_sql() -> dict[str, str]:
    from oracle.statements import statements

    llm = _llm()
    return statements() | (llm.oracle_sql() if llm else {})
