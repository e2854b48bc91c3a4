"""One SQL statement per registered query, for an independent check of its result."""

from __future__ import annotations

from oracle.tables_sql import with_tables

# The tables with their keys and references, and the report's texts, written
# out here so that a wrong one in the package shows.
KEYS = {
    "teams": "team_id",
    "developers": "developer_id",
    "projects": "project_id",
    "sprints": "sprint_id",
    "issues": "issue_id",
    "commits": "commit_id",
    "pull_requests": "pull_request_id",
    "code_reviews": "review_id",
    "deployments": "deployment_id",
    "releases": "release_id",
}
REFERENCES = {
    "developers": {"team_id": "teams"},
    "projects": {"team_id": "teams"},
    "sprints": {"project_id": "projects", "team_id": "teams"},
    "issues": {"project_id": "projects", "sprint_id": "sprints", "team_id": "teams", "assignee_id": "developers"},
    "commits": {"project_id": "projects", "sprint_id": "sprints", "developer_id": "developers"},
    "pull_requests": {"project_id": "projects", "sprint_id": "sprints", "author_id": "developers", "reviewer_id": "developers"},
    "code_reviews": {"pull_request_id": "pull_requests", "reviewer_id": "developers"},
    "deployments": {"project_id": "projects", "sprint_id": "sprints"},
    "releases": {"project_id": "projects", "team_id": "teams", "sprint_id": "sprints"},
}
CORE = (
    ("issues", "project_id"),
    ("issues", "assignee_id"),
    ("sprints", "project_id"),
    ("pull_requests", "author_id"),
    ("deployments", "project_id"),
    ("releases", "project_id"),
)
DRIVERS = (
    ("delivery_risk", "sprint completion rate is low"),
    ("quality_risk", "defect/escape rate is elevated"),
    ("review_bottleneck_risk", "PR review time is a bottleneck"),
    ("workload_risk", "team workload is disproportionately high"),
)
NO_DRIVER = "multiple risk factors trending negative"
URGENT_ACTION = (
    "Recommend immediate leadership review: reallocate reviewer capacity, triage critical-bug backlog, "
    "and reassess sprint scope."
)
WATCH_ACTION = "Recommend monitoring closely and addressing the top driver this sprint."

METRICS = (
    "completion_rate",
    "cycle_time",
    "defect_density",
    "review_time",
    "deploy_count",
    "change_failure_rate",
    "avg_release_delay",
)


def _r(*columns: str) -> str:
    """Each column rounded to six places under its own name."""
    return ", ".join(f"CASE WHEN abs({c}::DOUBLE) < 1e9 THEN floor({c}::DOUBLE * 1e6::DOUBLE + 0.5::DOUBLE) / 1e6::DOUBLE ELSE {c}::DOUBLE END AS {c}" for c in columns)


def _box(source: str, value: str, key: str) -> str:
    return f"""
        SELECT {key}, count({value}) AS n, round(avg({value}), 6) AS mean, round(min({value}), 6) AS minimum,
               round(quantile_cont({value}, 0.25), 6) AS q1, round(median({value}), 6) AS median,
               round(quantile_cont({value}, 0.75), 6) AS q3, round(max({value}), 6) AS maximum
        FROM {source} GROUP BY {key} HAVING count({value}) > 0"""


def _histogram(source: str, value: str, bins: int) -> str:
    return f"""
        SELECT * FROM (
        WITH span AS (SELECT min({value})::DOUBLE AS lo, (max({value}) - min({value}))::DOUBLE / {bins} AS w FROM {source})
        SELECT bin::BIGINT AS bin, round(lo + w * bin, 6) AS bin_start, round(lo + w * (bin + 1), 6) AS bin_end,
               (SELECT count(*) FROM {source} x
                WHERE least(floor((x.{value} - lo) / w), {bins - 1}) = bin) AS n
        FROM span, range({bins}) b(bin))"""


def _orphans(references) -> str:
    parts = []
    for child, column in references:
        parent = REFERENCES[child][column]
        key = KEYS[parent]
        parts.append(
            f"SELECT '{child}.{column} -> {parent}' AS reference, count(*) AS orphans FROM {child} c"
            f" WHERE NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{key} = c.{column})"
        )
    union = " UNION ALL ".join(parts)
    return f"SELECT *, CASE WHEN orphans = 0 THEN 'OK' ELSE 'FAIL' END AS status FROM ({union})"


def _keys(source=lambda name: name) -> str:
    return " UNION ALL ".join(
        f"SELECT '{n}' AS table_name,"
        f" (SELECT count(*) FROM (SELECT {key} FROM {source(n)} WHERE {key} IS NOT NULL"
        f" GROUP BY 1 HAVING count(*) > 1)) AS duplicate_keys,"
        f" (SELECT count(*) FROM {source(n)} WHERE {key} IS NULL) AS null_keys"
        for n, key in KEYS.items()
    )


def _counts(names) -> str:
    return " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {n}" for n in names)


def _share(source: str, column: str) -> str:
    return f"""
        SELECT {column}, count(*) AS n, round(100.0 * count(*) / (SELECT count({column}) FROM {source}), 6) AS share_pct
        FROM {source} WHERE {column} IS NOT NULL GROUP BY {column}"""


def _cards(issues, deployments, releases, risk, team, health) -> str:
    return f"""
        SELECT (SELECT round_even(round(avg(project_health_score), 9), 1) FROM {health}) AS project_health,
               (SELECT coalesce(round_even(round(100 * avg(avg_sprint_completion_rate), 9), 1), 0) FROM {team})
                   AS sprint_completion_pct,
               (SELECT round_even(round(avg(cycle_time_days) FILTER (WHERE resolved_date IS NOT NULL), 9), 1) FROM {issues})
                   AS avg_cycle_time_days,
               (SELECT round_even(round(100 * avg((issue_type = 'Bug')::INT), 9), 1) FROM {issues}) AS bug_rate_pct,
               (SELECT round_even(round(count(*)::DOUBLE / count(DISTINCT date_trunc('week', deployment_timestamp)), 9), 1)
                FROM {deployments}) AS deploys_per_week,
               (SELECT round_even(round(100 * avg((status = 'On Time')::INT), 9), 1) FROM {releases}) AS release_success_pct,
               (SELECT count(*) FROM {risk} WHERE risk_tier = 'High Risk') AS at_risk_projects"""


def _picked(table: str) -> str:
    return f"(SELECT * FROM {table} WHERE project_id IN (SELECT project_id FROM picked_projects))"


def _features(pr_from: str, history: str) -> str:
    rounded = _r(
        "sprint_completion_pct", "avg_pr_review_time", "developer_workload_proxy", "historical_delay_rate"
    )
    return f"""
        SELECT release_id, project_id, open_bugs, critical_bugs, pending_prs, recent_deployment_frequency, is_delayed,
               {rounded}
        FROM (SELECT b.*, coalesce(pending_prs, 0) AS pending_prs, coalesce(avg_pr_review_time, 0)
                     AS avg_pr_review_time, historical_delay_rate
              FROM f_base b LEFT JOIN {pr_from} LEFT JOIN {history} USING (release_id))"""


def _team_measure(column: str) -> str:
    return f"SELECT team_id, team_name, {_r(column)} FROM kpi_team_summary"


def _cleaned(name: str) -> str:
    rounded = {
        "sprints": ["sprint_completion_rate"],
        "issues": ["resolution_time_hours", "cycle_time_days"],
        "commits": ["lines_added", "total_churn"],
        "pull_requests": ["review_time_hours"],
        "deployments": ["duration_minutes"],
        "releases": ["release_delay_days"],
    }.get(name)
    if not rounded:
        return f"SELECT * FROM {name}"
    return f"SELECT * REPLACE ({_r(*rounded)}) FROM {name}"


def _as_text(name: str) -> str:
    """The cleaned table with its identifiers as text, as they come from a CSV export."""
    ids = [KEYS[name], *REFERENCES.get(name, {})]
    casts = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in ids)
    return f"SELECT * REPLACE ({casts}) FROM ({_cleaned(name)})"


def statements() -> dict[str, str]:
    drivers = ", ".join(f"CASE WHEN {c} > 60 THEN '{text}' END" for c, text in DRIVERS)
    all_features = _features(
        "(SELECT release_id, pending_prs, review_hours / nullif(reviews, 0) AS avg_pr_review_time FROM f_prs)"
        " USING (release_id)",
        "f_hist_known",
    )
    pairs = [(a, b) for i, a in enumerate(METRICS) for b in METRICS[i + 1 :]]
    pair_rows = " UNION ALL ".join(
        f"SELECT '{a}' AS metric_a, '{b}' AS metric_b, round(corr({a}, {b}), 6) AS r FROM pm" for a, b in pairs
    )
    pm = "(SELECT m.* FROM projects JOIN project_metrics m USING (project_id)) AS pm"
    pair_sql = pair_rows.replace("FROM pm", f"FROM {pm}")
    matrix = " UNION ALL ".join(
        f"SELECT '{a}' AS metric, "
        + ", ".join(f"round({'1' if a == b else f'corr({a}, {b})'}, 6)::DOUBLE AS {b}" for b in METRICS)
        + f" FROM {pm}"
        for a in METRICS
    )
    text_columns = (
        "issue_id",
        "project_id",
        "sprint_id",
        "team_id",
        "assignee_id",
        "issue_type",
        "priority",
        "severity",
        "status",
        "created_date",
        "resolved_date",
    )
    number_columns = ("resolution_time_hours", "reopened", "escaped_defect", "cycle_time_days")
    profile = " UNION ALL ".join(
        [
            f"""SELECT '{c}' AS column_name, sum(k)::BIGINT AS n, count(*) AS unique_values,
                       first(v ORDER BY k DESC, v) AS top, max(k)::BIGINT AS freq, NULL::DOUBLE AS mean,
                       NULL::DOUBLE AS std, NULL::DOUBLE AS minimum, NULL::DOUBLE AS maximum, NULL::DOUBLE AS q1,
                       NULL::DOUBLE AS median, NULL::DOUBLE AS q3
                FROM (SELECT {c}::VARCHAR AS v, count(*) AS k FROM issues WHERE {c} IS NOT NULL GROUP BY 1)"""
            for c in text_columns
        ]
        + [
            f"""SELECT '{c}', count({c}), NULL, NULL, NULL, round(avg({c}), 6), round(stddev_samp({c}), 6),
                       round(min({c}), 6), round(max({c}), 6), round(quantile_cont({c}, 0.25), 6),
                       round(median({c}), 6), round(quantile_cont({c}, 0.75), 6) FROM issues"""
            for c in number_columns
        ]
    )
    plain_title = "CASE trim(status) WHEN 'DONE' THEN 'Done' ELSE trim(status) END"
    raw_name = {"issues": "issues_raw", "commits": "commits_raw"}

    sql = {
        **{f"clean_{name}": _cleaned(name) for name in KEYS},
        "clean_audit": f"""
            SELECT 'developers' AS table_name, 'rows_in' AS metric, count(*)::DOUBLE AS value FROM developers
            UNION ALL SELECT 'developers', 'rows_out', count(DISTINCT developer_id) FROM developers
            UNION ALL SELECT 'sprints', 'rows_in', count(*) FROM sprints
            UNION ALL SELECT 'issues', 'rows_in', count(*) FROM issues_raw
            UNION ALL SELECT 'issues', 'rows_out', count(*) FROM issues
            UNION ALL SELECT 'issues', 'status_fixes', count(*) FROM issues_raw
                      WHERE copy = 1 AND status <> {plain_title}
            UNION ALL SELECT 'issues', 'status_fixes_naive', count(*) FROM issues_raw
                      WHERE copy = 1 AND status <> {plain_title}
            UNION ALL SELECT 'issues', 'hours_capped', count(*) FROM issues_raw, hours_cap
                      WHERE copy = 1 AND resolution_time_hours > cap
            UNION ALL SELECT 'issues', 'hours_cap', round(cap, 6) FROM hours_cap
            UNION ALL SELECT 'issues', 'severity_missing', count(*) FROM issues WHERE severity IS NULL
            UNION ALL SELECT 'commits', 'rows_in', count(*) FROM commits_raw
            UNION ALL SELECT 'commits', 'rows_out', count(DISTINCT commit_id) FROM commits_raw
            UNION ALL SELECT 'commits', 'negative_lines', count(*) FROM commits_raw WHERE lines_added < 0
            UNION ALL SELECT 'pull_requests', 'rows_in', count(*) FROM pull_requests
            UNION ALL SELECT 'pull_requests', 'review_time_missing', count(*) FROM pull_requests
                      WHERE review_time_hours IS NULL
            UNION ALL SELECT 'code_reviews', 'rows_in', count(*) FROM code_reviews
            UNION ALL SELECT 'deployments', 'rows_in', count(*) FROM deployments
            UNION ALL SELECT 'releases', 'rows_in', count(*) FROM releases
            UNION ALL SELECT 'releases', 'cancelled', count(*) FROM releases WHERE status = 'Cancelled'""",
        "validate_fk": _orphans(CORE),
        "validate_fk_all": _orphans([(t, c) for t, columns in REFERENCES.items() for c in columns]),
        "pk_check": _keys(),
        "pk_check_raw": _keys(lambda n: raw_name.get(n, n)),
        "range_checks": """
            SELECT 'sprint completion rate within 0 and 1.21' AS rule, count(*) AS violations FROM sprints
            WHERE sprint_completion_rate < 0 OR sprint_completion_rate > 1.21
            UNION ALL SELECT 'no negative added lines', count(*) FROM commits WHERE lines_added < 0 OR lines_added IS NULL
            UNION ALL SELECT 'issue status in its domain', count(*) FROM issues
            WHERE status NOT IN ('Done', 'In Progress', 'Reopened', 'Won''t Fix') OR status IS NULL
            UNION ALL SELECT 'project health within 0 and 100', count(*) FROM kpi_project_health
            WHERE project_health_score < 0 OR project_health_score > 100 OR project_health_score IS NULL""",
        "output_presence": "SELECT *, true AS present FROM ("
        + _counts(["kpi_team_summary", "kpi_project_health", "kpi_developer_productivity", "release_risk_scores"])
        + ") UNION ALL SELECT 'weekly_report', 0, false",
        "table_counts": _counts(KEYS),
        "q01_team_completion": """
            SELECT team_name, round(100 * avg(sprint_completion_rate), 1) AS avg_completion_pct,
                   count(*) AS sprints_analyzed
            FROM teams JOIN sprints USING (team_id) GROUP BY 1 HAVING count(*) >= 5""",
        "q02_velocity_last5": """
            SELECT team_name, round(avg(completed_story_points), 1) AS avg_velocity_last5
            FROM (SELECT * FROM sprints
                  QUALIFY row_number() OVER (PARTITION BY team_id ORDER BY sprint_start_date DESC, sprint_id) <= 5)
            JOIN teams USING (team_id) GROUP BY 1""",
        "q03_velocity_trend": """
            SELECT team_name, round(a, 1) AS first_half_avg_velocity, round(b, 1) AS second_half_avg_velocity,
                   CASE WHEN b > a THEN 'Improving' WHEN b < a THEN 'Declining' ELSE 'Stable' END AS trend
            FROM (SELECT team_name, avg(completed_story_points) FILTER (WHERE early) AS a,
                         avg(completed_story_points) FILTER (WHERE NOT early) AS b
                  FROM (SELECT *, row_number() OVER (PARTITION BY team_id ORDER BY sprint_start_date NULLS FIRST, sprint_id)
                                  <= count(*) OVER (PARTITION BY team_id) // 2 AS early FROM sprints)
                  JOIN teams USING (team_id) GROUP BY 1)""",
        "q04_cycle_by_priority": """
            SELECT priority, round(m, 2) AS avg_cycle_time_days,
                   CASE WHEN m <= 1 THEN 'Fast' WHEN m <= 3 THEN 'Acceptable' ELSE 'Slow' END AS speed_rating
            FROM (SELECT priority, avg(cycle_time_days) AS m FROM issues WHERE resolved_date IS NOT NULL GROUP BY 1)""",
        "q05_project_delay_rate": """
            SELECT * FROM (SELECT project_name, count(*) AS total_releases, sum(is_delayed)::BIGINT AS delayed_releases,
                                  round(100 * avg(is_delayed), 1) AS delay_rate_pct
                           FROM projects JOIN releases USING (project_id) GROUP BY 1) WHERE delay_rate_pct > 30""",
        "q06_defect_rate": """
            SELECT project_name, count(*) FILTER (WHERE issue_type = 'Bug') AS bug_count, count(*) AS total_issues,
                   round(100 * avg((issue_type = 'Bug')::INT), 1) AS defect_rate_pct
            FROM projects JOIN issues USING (project_id) GROUP BY 1""",
        "q07_reopen_by_team": """
            SELECT team_name, sum(reopened)::BIGINT AS reopened_bugs, count(*) AS total_bugs,
                   round(100 * avg(reopened), 1) AS reopen_rate_pct
            FROM teams JOIN issues USING (team_id) WHERE issue_type = 'Bug' GROUP BY 1""",
        "q07_reopen_overall": """
            SELECT team_name, sum(reopened)::BIGINT AS reopened_bugs, count(*) AS total_bugs,
                   round(100 * avg(reopened), 1) AS reopen_rate_pct
            FROM teams JOIN issues USING (team_id) WHERE issue_type = 'Bug' GROUP BY ROLLUP (team_name)""",
        "q08_escaped_top10": """
            SELECT project_name, sum(escaped_defect)::BIGINT AS escaped_defects, count(*) AS total_bugs,
                   round(100 * avg(escaped_defect), 1) AS escaped_rate_pct
            FROM projects JOIN issues USING (project_id) WHERE issue_type = 'Bug' GROUP BY 1
            ORDER BY escaped_rate_pct DESC, project_name LIMIT 10""",
        "q09_mttr_severity": """
            SELECT severity, round(avg(resolution_time_hours), 1) AS mttr_hours, count(*) AS bug_count
            FROM issues WHERE resolved_date IS NOT NULL AND issue_type = 'Bug' GROUP BY 1""",
        "q10_reopen_outliers": """
            SELECT team_name, round(rate, 1) AS reopen_rate_pct, round(m, 1) AS org_avg_rate, round(d, 1) AS org_stdev
            FROM (SELECT team_name, rate, avg(rate) OVER () AS m, stddev_pop(rate) OVER () AS d
                  FROM (SELECT team_id, team_name, 100 * avg(reopened) AS rate
                        FROM teams JOIN issues USING (team_id) WHERE issue_type = 'Bug' GROUP BY 1, 2))
            WHERE rate > m + d""",
        "q11_review_by_team": """
            SELECT team_name, round(avg(review_time_hours), 1) AS avg_review_hours, count(review_time_hours) AS prs
            FROM teams JOIN sprints USING (team_id) JOIN pull_requests p USING (sprint_id)
            GROUP BY 1 HAVING prs > 0""",
        "q12_merge_rate": """
            SELECT project_name, count(*) AS total_prs, sum(is_merged)::BIGINT AS merged_prs,
                   round(100 * avg(is_merged), 1) AS merge_rate_pct
            FROM projects JOIN pull_requests USING (project_id) GROUP BY 1""",
        "q13_size_bucket": """
            SELECT bucket AS pr_size_bucket, round(avg(review_time_hours), 1) AS avg_review_hours, count(*) AS pr_count
            FROM (SELECT review_time_hours,
                         CASE WHEN pr_size_lines < 50 THEN '1. <50 lines' WHEN pr_size_lines < 150 THEN '2. 50-150 lines'
                              WHEN pr_size_lines < 400 THEN '3. 150-400 lines' ELSE '4. 400+ lines' END AS bucket
                  FROM pull_requests WHERE review_time_hours IS NOT NULL) GROUP BY 1""",
        "q14_reviewer_running": """
            SELECT reviewer_id, n AS prs_reviewed, sum(n) OVER (ORDER BY n DESC)::BIGINT AS running_total_prs
            FROM (SELECT reviewer_id, count(*) AS n FROM pull_requests GROUP BY 1)
            ORDER BY n DESC, reviewer_id LIMIT 15""",
        "q15_load_percentile": """
            SELECT assignee_id AS developer_id, n AS issues_assigned,
                   round(percent_rank() OVER (ORDER BY n), 3) AS workload_percentile
            FROM dev_load ORDER BY n DESC, assignee_id LIMIT 15""",
        "q16_deploys_per_week": """
            SELECT project_name, count(*) AS total_deployments,
                   round(7 * count(*) / (1 + date_diff('second', min(deployment_timestamp), max(deployment_timestamp))
                                             / 86400.0::DOUBLE), 2) AS deploys_per_week
            FROM projects JOIN deployments USING (project_id) GROUP BY 1""",
        "q17_cfr_team": """
            SELECT team_name, count(*) AS total_deployments, sum(is_failure)::BIGINT AS failed_deployments,
                   round(100 * avg(is_failure), 1) AS change_failure_rate_pct
            FROM teams JOIN sprints USING (team_id) JOIN deployments d USING (sprint_id) GROUP BY 1""",
        "q18_deploy_vs_delay": """
            SELECT project_name, deploy_count, round(avg_release_delay, 1) AS avg_delay_days
            FROM projects JOIN project_metrics USING (project_id)
            WHERE deploy_count > 0
                  AND project_id IN (SELECT project_id FROM releases WHERE status <> 'Cancelled')""",
        "q19_rollback_env": """
            SELECT environment, sum(is_failure)::BIGINT AS failed_deploys, sum(rollback)::BIGINT AS rollbacks,
                   round(100.0::DOUBLE * sum(rollback) / nullif(sum(is_failure), 0), 1) AS rollback_rate_pct
            FROM deployments GROUP BY 1""",
        "q20_release_success": """
            SELECT project_name, count(*) AS total_releases,
                   round(100 * avg((status = 'On Time')::INT), 1) AS on_time_rate_pct,
                   round(avg(release_delay_days) FILTER (WHERE status <> 'Cancelled'), 1) AS avg_delay_days
            FROM projects JOIN releases USING (project_id) GROUP BY 1""",
        "q21_monthly_delay": """
            SELECT strftime(planned_release_date, '%Y-%m') AS release_month, count(*) AS releases,
                   round(100 * avg(is_delayed), 1) AS delay_rate_pct FROM releases GROUP BY 1""",
        "q22_project_health": """
            SELECT project_name, round(quality_score, 1) AS quality_score, round(delivery_score, 1) AS delivery_score,
                   round(devops_score, 1) AS devops_score,
                   round(0.35::DOUBLE * quality_score + 0.35::DOUBLE * delivery_score + 0.3::DOUBLE * devops_score, 1)
                       AS project_health_score
            FROM kpi_project_health
            WHERE project_name IS NOT NULL AND quality_score + delivery_score + devops_score IS NOT NULL""",
        "q23_team_view": """
            SELECT team_id, team_name, round(100 * avg_sprint_completion_rate, 1) AS avg_sprint_completion_pct,
                   round(bug_reopen_rate_pct, 1) AS bug_reopen_rate_pct,
                   round(avg_pr_review_hours, 1) AS avg_pr_review_hours
            FROM kpi_team_summary WHERE sprints_count > 0""",
        "q24_blended_risk": """
            SELECT team_name, round(100 * avg_sprint_completion_rate, 1) AS avg_sprint_completion_pct,
                   round(bug_reopen_rate_pct, 1) AS bug_reopen_rate_pct,
                   round(avg_pr_review_hours, 1) AS avg_pr_review_hours
            FROM kpi_team_summary WHERE sprints_count > 0""",
        "q25_workload_top": """
            SELECT developer_id, full_name, team_name, commit_count, pr_count, issues_resolved, workload_index
            FROM workload JOIN teams USING (team_id) ORDER BY workload_index DESC, developer_id LIMIT 15""",
        "kpi_sprint": f"SELECT team_id, sprints_count, {_r('avg_sprint_completion_rate', 'avg_sprint_velocity')} FROM k_sprint",
        "kpi_issue": "SELECT team_id, "
        + _r(
            "avg_cycle_time_days", "mttr_hours", "bug_reopen_rate_pct", "escaped_defect_rate_pct", "defect_density_pct"
        )
        + " FROM k_issue",
        "kpi_pr": f"SELECT team_id, {_r('avg_pr_review_hours', 'pr_merge_rate_pct')} FROM k_pr",
        "kpi_deployment": f"SELECT team_id, total_deployments, {_r('change_failure_rate_pct')} FROM k_deploy",
        "kpi_release": "SELECT team_id, total_releases, "
        + _r("release_success_rate_pct", "release_delay_rate_pct", "avg_release_delay_days")
        + " FROM k_release",
        "kpi_team": "SELECT team_id, team_name, sprints_count, total_deployments, total_releases, "
        + _r(
            "avg_sprint_completion_rate",
            "avg_sprint_velocity",
            "avg_cycle_time_days",
            "mttr_hours",
            "bug_reopen_rate_pct",
            "escaped_defect_rate_pct",
            "defect_density_pct",
            "avg_pr_review_hours",
            "pr_merge_rate_pct",
            "change_failure_rate_pct",
            "release_success_rate_pct",
            "release_delay_rate_pct",
            "avg_release_delay_days",
            "quality_score",
            "delivery_score",
            "devops_score",
            "team_health_score",
        )
        + " FROM kpi_team_summary",
        "kpi_project_health": "SELECT project_id, project_name, criticality, "
        + _r("quality_score", "delivery_score", "devops_score", "project_health_score")
        + " FROM kpi_project_health",
        "kpi_workload": "SELECT * FROM workload",
        "kpi_productivity": f"""
            SELECT * REPLACE ({_r('reopen_rate', 'engineering_productivity_score')}) FROM kpi_developer_productivity""",
        "minmax_scale": """
            SELECT developer_id, workload_index, reviews_given,
                   round((workload_index - min(workload_index) OVER ())::DOUBLE
                         / (max(workload_index) OVER () - min(workload_index) OVER ()), 6) AS workload_index_scaled,
                   round((reviews_given - min(reviews_given) OVER ())::DOUBLE
                         / (max(reviews_given) OVER () - min(reviews_given) OVER ()), 6) AS reviews_given_scaled
            FROM workload""",
        "deploys_per_active_week": """
            SELECT team_id, n AS deployments, weeks AS active_weeks, round(7 * n / (1 + span), 6) AS deploys_per_week_span,
                   round(n::DOUBLE / weeks, 6) AS deploys_per_active_week
            FROM (SELECT s.team_id, count(*) AS n, count(DISTINCT date_trunc('week', deployment_timestamp)) AS weeks,
                         date_diff('second', min(deployment_timestamp), max(deployment_timestamp)) / 86400.0::DOUBLE AS span
                  FROM deployments d JOIN sprints s USING (sprint_id) GROUP BY 1)""",
        "feat_open_bugs": """
            SELECT project_id, cutoff, any_value(coalesce(open_bugs, 0)) AS open_bugs,
                   any_value(coalesce(critical_bugs, 0)) AS critical_bugs,
                   any_value(coalesce(issues_to_date, 0)) AS issues_to_date
            FROM cuts LEFT JOIN f_issues USING (release_id) GROUP BY 1, 2""",
        "feat_pr_asof": """
            SELECT project_id, cutoff, any_value(coalesce(pending_prs, 0)) AS pending_prs,
                   round(any_value(coalesce(review_hours, 0)), 6) AS review_hours,
                   any_value(coalesce(reviews, 0)) AS reviews
            FROM cuts LEFT JOIN f_prs USING (release_id) GROUP BY 1, 2""",
        "feat_deploy_14d": """
            SELECT project_id, cutoff,
                   any_value(coalesce(recent_deployment_frequency, 0)) AS recent_deployment_frequency
            FROM cuts LEFT JOIN f_deploys USING (release_id) GROUP BY 1, 2""",
        "feat_hist_delay": f"SELECT release_id, {_r('historical_delay_rate')} FROM f_hist_plan",
        "feat_hist_known": f"SELECT release_id, {_r('historical_delay_rate')} FROM f_hist_known",
        "feat_workload": f"SELECT release_id, {_r('developer_workload_proxy')} FROM f_base",
        "feat_release_all": all_features,
        "feat_release_parity": _features("f_prs_all USING (project_id)", "f_hist_plan"),
        "feat_release_opened": _features("f_prs_opened USING (release_id)", "f_hist_plan"),
        "risk_components": "SELECT project_id, "
        + _r("delivery_risk", "quality_risk", "review_bottleneck_risk", "workload_risk")
        + " FROM risk_components",
        "risk_scores": "SELECT project_id, project_name, criticality, risk_tier, "
        + _r("delivery_risk", "quality_risk", "review_bottleneck_risk", "workload_risk", "release_risk_score")
        + " FROM release_risk_scores",
        "risk_tiers": "SELECT risk_tier, count(*) AS projects FROM release_risk_scores GROUP BY 1",
        "eda_completion_box": _box(
            "(SELECT team_name, sprint_completion_rate FROM teams JOIN sprints USING (team_id))",
            "sprint_completion_rate",
            "team_name",
        ),
        "eda_velocity_rolling": """
            SELECT sprint_start_date, round(v, 6) AS velocity,
                   round(avg(v) OVER (ORDER BY sprint_start_date ROWS 4 PRECEDING), 6) AS rolling_velocity
            FROM (SELECT sprint_start_date, avg(completed_story_points) AS v
                  FROM sprints WHERE team_id IN (SELECT team_id FROM teams) GROUP BY 1)""",
        "eda_bug_pivot": """
            SELECT strftime(created_date, '%Y-%m') AS month, sum((severity = 'Minor')::INT)::BIGINT AS minor,
                   sum((severity = 'Major')::INT)::BIGINT AS major,
                   sum((severity = 'Critical')::INT)::BIGINT AS critical,
                   sum((severity = 'Blocker')::INT)::BIGINT AS blocker,
                   sum((severity NOT IN ('Minor', 'Major', 'Critical', 'Blocker'))::INT)::BIGINT AS other
            FROM issues WHERE issue_type = 'Bug' AND severity IS NOT NULL GROUP BY 1""",
        "eda_reopen_team": """
            SELECT team_name, round(100 * avg(reopened), 6) AS reopen_rate_pct
            FROM teams JOIN issues USING (team_id) WHERE issue_type = 'Bug' GROUP BY 1""",
        "eda_size_fit": """
            SELECT round(regr_slope(review_time_hours, pr_size_lines), 6) AS slope,
                   round(regr_intercept(review_time_hours, pr_size_lines), 6) AS intercept,
                   round(regr_r2(review_time_hours, pr_size_lines), 6) AS r2,
                   regr_count(review_time_hours, pr_size_lines)::BIGINT AS n FROM pull_requests""",
        "eda_review_team": """
            SELECT team_name, round(avg(review_time_hours), 6) AS avg_review_hours
            FROM teams JOIN sprints USING (team_id) JOIN pull_requests p USING (sprint_id)
            WHERE review_time_hours IS NOT NULL GROUP BY 1""",
        "eda_deploy_monthly": """
            SELECT strftime(deployment_timestamp, '%Y-%m') AS month, count(*) AS deploys,
                   round(avg(is_failure), 6) AS failure_rate FROM deployments GROUP BY 1""",
        "eda_delay_box": _box(
            "(SELECT criticality, release_delay_days FROM projects JOIN releases USING (project_id)"
            " WHERE status <> 'Cancelled')",
            "release_delay_days",
            "criticality",
        ),
        "eda_load_hist": _histogram("dev_load", "n", 25),
        "eda_load_quantiles": """
            SELECT count(*) AS developers, round(median(n), 6) AS median_issues,
                   round(quantile_cont(n, 0.9), 6) AS p90_issues, max(n) AS max_issues FROM dev_load""",
        "eda_project_metrics": f"""
            SELECT projects.project_id, deploy_count, {_r(*[m for m in METRICS if m != 'deploy_count'])}
            FROM projects LEFT JOIN project_metrics USING (project_id)""",
        "eda_project_metrics_outer": f"""
            SELECT project_id, deploy_count, {_r(*[m for m in METRICS if m != 'deploy_count'])} FROM project_metrics""",
        "eda_corr_matrix": matrix,
        "eda_corr_pairs": pair_sql,
        "eda_notable_corr": f"SELECT * FROM ({pair_sql}) WHERE abs(r) > 0.1",
        "eda_profile": profile,
        "rep_recommendations": f"""
            SELECT project_name, release_risk_score AS risk_score,
                   coalesce(nullif(concat_ws('; ', {drivers}), ''), '{NO_DRIVER}') AS primary_drivers,
                   CASE WHEN release_risk_score > 80 THEN '{URGENT_ACTION}' ELSE '{WATCH_ACTION}' END
                       AS recommended_action
            FROM release_risk_scores WHERE risk_tier = 'High Risk'""",
        "rep_at_risk": "SELECT * FROM release_risk_scores WHERE risk_tier <> 'Low Risk'",
        "rep_low_quality": f"""
            SELECT project_name, criticality, {_r('quality_score')} FROM kpi_project_health
            ORDER BY kpi_project_health.quality_score NULLS LAST, project_id LIMIT 5""",
        "rep_bottlenecks": f"""
            SELECT team_name, {_r('avg_pr_review_hours', 'bug_reopen_rate_pct', 'change_failure_rate_pct')}
            FROM kpi_team_summary ORDER BY kpi_team_summary.avg_pr_review_hours DESC NULLS LAST, team_id LIMIT 5""",
        "rep_top_devs": """
            SELECT full_name, team_id, seniority, engineering_productivity_score FROM kpi_developer_productivity
            ORDER BY engineering_productivity_score DESC, developer_id LIMIT 10""",
        "ex_filter_options": """
            SELECT DISTINCT 'project' AS filter_name, project_name AS value FROM projects
            UNION ALL SELECT DISTINCT 'team', team_name FROM teams
            UNION ALL SELECT DISTINCT 'priority', priority FROM issues
            UNION ALL SELECT DISTINCT 'severity', severity FROM issues WHERE severity IS NOT NULL""",
        "ex_filter_issues": f"SELECT * REPLACE ({_r('resolution_time_hours', 'cycle_time_days')}) FROM picked_issues",
        "ex_filter_counts": "SELECT 'projects' AS table_name, count(*) AS row_count FROM picked_projects"
        " UNION ALL SELECT 'issues', count(*) FROM picked_issues"
        + "".join(
            f" UNION ALL SELECT '{n}', count(*) FROM {_picked(n)}"
            for n in ("sprints", "pull_requests", "deployments", "releases", "kpi_project_health", "release_risk_scores")
        )
        + " UNION ALL SELECT 'kpi_team_summary', count(*) FROM kpi_team_summary"
        " WHERE team_id IN (SELECT team_id FROM picked_teams)",
        "ex_cards": _cards(
            "issues", "deployments", "releases", "release_risk_scores", "kpi_team_summary", "kpi_project_health"
        ),
        "ex_cards_filtered": _cards(
            "picked_issues",
            _picked("deployments"),
            _picked("releases"),
            _picked("release_risk_scores"),
            "(SELECT * FROM kpi_team_summary WHERE team_id IN (SELECT team_id FROM picked_teams))",
            _picked("kpi_project_health"),
        ),
        "ex_completion_trend": """
            SELECT sprint_start_date, round(avg(s.sprint_completion_rate), 6) AS sprint_completion_rate
            FROM sprints s GROUP BY 1""",
        "ex_health_ranking": f"SELECT project_id, project_name, project_health_score FROM {_picked('kpi_project_health')}",
        "ex_team_velocity": _team_measure("avg_sprint_velocity"),
        "ex_team_review_time": _team_measure("avg_pr_review_hours"),
        "ex_team_reopen": _team_measure("bug_reopen_rate_pct"),
        "ex_team_cfr": _team_measure("change_failure_rate_pct"),
        "ex_productivity_hist": _histogram(
            "(SELECT engineering_productivity_score AS score FROM kpi_developer_productivity"
            " WHERE team_id IN (SELECT team_id FROM picked_projects))",
            "score",
            20,
        ),
        "ex_cycle_box": _box(
            "(SELECT priority, cycle_time_days FROM issues WHERE resolved_date IS NOT NULL)",
            "cycle_time_days",
            "priority",
        ),
        "ex_severity_share": _share("(SELECT severity FROM issues WHERE issue_type = 'Bug')", "severity"),
        "ex_bugs_by_project": """
            SELECT project_name, count(*) AS bug_count FROM projects JOIN issues USING (project_id)
            WHERE issue_type = 'Bug' GROUP BY 1""",
        "ex_defect_trend": """
            SELECT strftime(created_date, '%Y-%m') AS month, count(*) AS bugs FROM picked_issues
            WHERE issue_type = 'Bug' GROUP BY 1""",
        "ex_deploy_trend": """
            SELECT strftime(deployment_timestamp, '%Y-%m') AS month, count(*) AS deployments
            FROM deployments GROUP BY 1""",
        "ex_release_share": _share("releases", "status"),
        "ex_delay_by_project": _box(
            "(SELECT project_name, release_delay_days FROM projects JOIN releases USING (project_id)"
            " WHERE status <> 'Cancelled')",
            "release_delay_days",
            "project_name",
        ),
        "ex_risk_ranking": "SELECT project_id, project_name, risk_tier, release_risk_score FROM release_risk_scores",
        "ex_risk_long": " UNION ALL ".join(
            f"SELECT project_id, project_name, '{c}' AS component, {c} AS risk FROM release_risk_scores"
            for c in ("delivery_risk", "quality_risk", "review_bottleneck_risk", "workload_risk")
        ),
        "ex_risk_detail": f"""
            SELECT project_name, risk_tier, release_risk_score FROM {_picked('release_risk_scores')}""",
        **{f"io_csv_{name}": _as_text(name) for name in KEYS},
        "io_team_view": """
            SELECT team_name, round(100 * avg_sprint_completion_rate, 1) AS avg_sprint_completion_pct,
                   round(bug_reopen_rate_pct, 1) AS bug_reopen_rate_pct,
                   round(avg_pr_review_hours, 1) AS avg_pr_review_hours
            FROM kpi_team_summary WHERE round(100 * avg_sprint_completion_rate, 1) > 95""",
        "ml_metrics_rule": f"""
            SELECT * FROM (
            WITH p AS (SELECT is_delayed = 1 AS y, open_bugs > 3 AS g, round(historical_delay_rate, 6) AS s
                       FROM ({all_features})),
                 c AS (SELECT count(*) FILTER (WHERE g AND y)::DOUBLE AS tp, count(*) FILTER (WHERE g AND NOT y)::DOUBLE AS fp,
                              count(*) FILTER (WHERE NOT g AND y)::DOUBLE AS fn,
                              count(*) FILTER (WHERE NOT g AND NOT y)::DOUBLE AS tn FROM p)
            SELECT round((tp + tn) / (tp + fp + fn + tn), 3) AS accuracy, round(tp / (tp + fp), 3) AS precision,
                   round(tp / (tp + fn), 3) AS recall, round(2 * tp / (2 * tp + fp + fn), 3) AS f1_score,
                   (SELECT round(avg(CASE WHEN a.s > b.s THEN 1.0::DOUBLE WHEN a.s = b.s THEN 0.5::DOUBLE ELSE 0.0::DOUBLE END), 3)
                    FROM p a JOIN p b ON a.y AND NOT b.y) AS roc_auc
            FROM c)""",
        "train_test_split": """
            SELECT release_id, is_delayed,
                   row_number() OVER (PARTITION BY is_delayed ORDER BY md5('42:' || release_id), release_id)
                       <= floor(0.75 * count(*) OVER (PARTITION BY is_delayed) + 0.5) AS is_train
            FROM release_features""",
        "sample_hash": """
            SELECT pull_request_id, pr_size_lines, round(review_time_hours, 6) AS review_time_hours
            FROM pull_requests WHERE review_time_hours IS NOT NULL
            ORDER BY md5('1:' || pull_request_id), pull_request_id LIMIT 1000""",
        "ml_class_weights": """
            SELECT is_delayed, count(*) AS releases,
                   round(sum(count(*)) OVER () / (2 * count(*))::DOUBLE, 6) AS weight
            FROM release_features GROUP BY 1""",
    }
    summary = """
        SELECT '2024-07-01' AS report_date,
               (SELECT round_even(round(100 * avg(avg_sprint_completion_rate), 9), 1) FROM kpi_team_summary)
                   AS avg_sprint_completion_rate_pct,
               (SELECT round_even(round(avg(bug_reopen_rate_pct), 9), 1) FROM kpi_team_summary) AS avg_bug_reopen_rate_pct,
               (SELECT round_even(round(avg(k.avg_pr_review_hours), 9), 1) FROM kpi_team_summary k) AS avg_pr_review_hours,
               (SELECT round_even(round(avg(change_failure_rate_pct), 9), 1) FROM kpi_team_summary) AS avg_change_failure_rate_pct,
               (SELECT round_even(round(avg(project_health_score), 9), 1) FROM kpi_project_health) AS avg_project_health_score,
               (SELECT count(*) FROM release_risk_scores WHERE risk_tier = 'High Risk') AS at_risk_project_count,
               (SELECT count(*) FROM release_risk_scores) AS total_projects"""
    sql["rep_kpi_summary"] = summary
    sql["rep_kpi_rows"] = f"""
        SELECT metric, value FROM (SELECT COLUMNS(*)::VARCHAR FROM ({summary}))
        UNPIVOT (value FOR metric IN (report_date, avg_sprint_completion_rate_pct, avg_bug_reopen_rate_pct,
                 avg_pr_review_hours, avg_change_failure_rate_pct, avg_project_health_score, at_risk_project_count,
                 total_projects))"""
    # the same results by other ways
    same = {
        "cube_cards": "ex_cards",
        "cube_cards_filtered": "ex_cards_filtered",
        "cube_completion_trend": "ex_completion_trend",
        "cube_severity_share": "ex_severity_share",
        "cube_bugs_by_project": "ex_bugs_by_project",
        "cube_defect_trend": "ex_defect_trend",
        "cube_deploy_trend": "ex_deploy_trend",
        "cube_release_share": "ex_release_share",
        "kpi_team_weekly": "kpi_team",
        "eda_project_metrics_bucketed": "eda_project_metrics",
        "io_repeated_load": "table_counts",
        "io_processed_set": "table_counts",
        "io_report_sheets": "rep_recommendations",
    }
    sql |= {name: sql[other] for name, other in same.items()}
    sql["cube_filter_counts"] = "SELECT 'issues' AS table_name, count(*) AS row_count FROM picked_issues" + "".join(
        f" UNION ALL SELECT '{n}', count(*) FROM {_picked(n)}" for n in ("sprints", "deployments", "releases")
    )
    sql["sketch_cycle_quantiles"] = """
        SELECT team_id::VARCHAR AS team_id, count(cycle_time_days) AS n, 0 AS misses FROM issues
        WHERE resolved_date IS NOT NULL AND team_id IS NOT NULL GROUP BY 1"""
    sql["sketch_outlier_cap"] = "SELECT count(*) AS issues, count(resolution_time_hours) AS timed, TRUE AS within FROM issues"
    sql["io_catalog_view"] = f"""
        SELECT team_name, {_r("avg_sprint_velocity", "bug_reopen_rate_pct")} FROM kpi_team_summary
        WHERE kpi_team_summary.avg_sprint_velocity > 20"""
    sql["io_preview"] = f"{_cleaned('issues')} ORDER BY issue_id LIMIT 20"
    return {name: with_tables(text) for name, text in sql.items()}
