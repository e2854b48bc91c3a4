"""The delivery-shaped tables as SQL, for checking the Spark results.

Each entry is one common table expression; ``with_tables`` puts those a query
needs in front of it.
"""

from __future__ import annotations

import re


def _qn(c: str) -> str:
    return f"((year({c}) - 1995) * 4 + quarter({c}))"


def _pick(key: str, *values: str) -> str:
    whens = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE {key} % {len(values)} {whens} END"


CTES: dict[str, str] = {
    "n_projects": "SELECT count(*) AS np FROM supplier",
    "n_developers": "SELECT count(*) AS nd FROM customer",
    "teams": """
        SELECT CAST(n_nationkey AS BIGINT) AS team_id, n_name AS team_name, r_name AS department,
               DATE '1995-01-01' AS formed_date
        FROM nation, region WHERE n_regionkey = r_regionkey""",
    "developers": f"""
        SELECT c_custkey AS developer_id, c_name AS full_name, CAST(c_nationkey AS BIGINT) AS team_id,
               c_mktsegment AS role,
               CASE WHEN c_acctbal < 0 THEN 'Junior' WHEN c_acctbal < 3000 THEN 'Mid'
                    WHEN c_acctbal < 7000 THEN 'Senior' ELSE 'Staff' END AS seniority,
               DATE '1995-01-01' + CAST(c_custkey % 1000 AS INTEGER) AS hire_date,
               {_pick("c_custkey", "UTC", "EST", "CET", "PST", "IST")} AS timezone
        FROM customer""",
    "projects": f"""
        SELECT s_suppkey AS project_id, s_name AS project_name, CAST(s_nationkey AS BIGINT) AS team_id,
               DATE '1995-01-01' + CAST(s_suppkey % 60 AS INTEGER) AS start_date,
               CASE WHEN s_acctbal < 2000 THEN 'Low' WHEN s_acctbal < 6000 THEN 'Medium' ELSE 'High' END
                   AS criticality,
               {_pick("s_suppkey", "Go", "Java", "Python", "Node")} AS tech_stack
        FROM supplier""",
    "sprints": f"""
        SELECT project_id * 1000 + qn AS sprint_id, project_id, team_id, qn AS sprint_number,
               sprint_start_date, sprint_start_date + 89 AS sprint_end_date,
               planned_story_points, completed_story_points,
               CASE WHEN completed_story_points > 1.2 * planned_story_points THEN CAST(1.2 AS DOUBLE)
                    ELSE CAST(completed_story_points AS DOUBLE) / planned_story_points END
                   AS sprint_completion_rate
        FROM (SELECT l_suppkey AS project_id, CAST(s_nationkey AS BIGINT) AS team_id,
                     {_qn("l_shipdate")} AS qn,
                     CAST(date_trunc('quarter', l_shipdate) AS DATE) AS sprint_start_date,
                     count(*) AS planned_story_points,
                     2 * count(*) FILTER (WHERE l_linestatus = 'F') AS completed_story_points
              FROM lineitem, supplier WHERE s_suppkey = l_suppkey GROUP BY ALL) g""",
    "issues_raw": f"""
        SELECT l_orderkey * 10 + l_linenumber AS issue_id, l_suppkey AS project_id,
               l_suppkey * 1000 + {_qn("l_shipdate")} AS sprint_id, CAST(s_nationkey AS BIGINT) AS team_id,
               o_custkey AS assignee_id,
               CASE l_returnflag WHEN 'R' THEN 'Bug' WHEN 'A' THEN 'Task' ELSE 'Story' END AS issue_type,
               CASE left(o_orderpriority, 1) WHEN '1' THEN 'Critical' WHEN '2' THEN 'High'
                    WHEN '3' THEN 'Medium' ELSE 'Low' END AS priority,
               CASE WHEN l_returnflag = 'R'
                    THEN {_pick("l_linenumber", "Minor", "Major", "Critical", "Blocker")} END AS severity,
               CASE WHEN l_linestatus = 'F' THEN CASE WHEN l_quantity > 48 THEN 'DONE  ' ELSE 'Done' END
                    WHEN o_orderstatus = 'P' THEN 'Reopened' ELSE 'In Progress' END AS status,
               l_shipdate AS created_date,
               CASE WHEN l_linestatus = 'F' OR o_orderstatus = 'P'
                    THEN l_shipdate + to_hours(CAST(l_quantity AS BIGINT)) END AS resolved_date,
               CASE WHEN l_linestatus = 'F' OR o_orderstatus = 'P'
                    THEN l_quantity * CASE WHEN (l_orderkey * 10 + l_linenumber) % 199 = 0 THEN 40 ELSE 1 END
               END AS resolution_time_hours,
               CAST(l_discount >= 0.09 OR (l_linestatus <> 'F' AND o_orderstatus = 'P') AS BIGINT) AS reopened,
               CAST(l_returnflag = 'R' AND l_tax >= 0.07 AS BIGINT) AS escaped_defect,
               row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                   ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
                            l_returnflag, l_linestatus) AS copy
        FROM lineitem, orders, supplier WHERE o_orderkey = l_orderkey AND s_suppkey = l_suppkey""",
    "hours_cap": "SELECT quantile_cont(resolution_time_hours, 0.995) AS cap FROM issues_raw WHERE copy = 1",
    "issues": """
        SELECT issue_id, project_id, sprint_id, team_id, assignee_id, issue_type, priority, severity,
               CASE WHEN status = 'DONE  ' THEN 'Done' ELSE status END AS status, created_date, resolved_date,
               CASE WHEN resolution_time_hours > cap THEN cap ELSE resolution_time_hours END
                   AS resolution_time_hours,
               reopened, escaped_defect,
               date_diff('second', created_date, resolved_date) / 86400.0 AS cycle_time_days
        FROM issues_raw, hours_cap WHERE copy = 1""",
    "commits_raw": """
        SELECT event_id AS commit_id, user_id % np AS project_id,
               (user_id % np) * 1000 + event_id % 27 + 1 AS sprint_id, user_id AS developer_id,
               ts AS commit_timestamp,
               CASE WHEN event_id % 25 = 0 THEN CAST(-1 AS DOUBLE) ELSE floor(value) END AS lines_added,
               event_id % 40 AS lines_deleted, 1 + event_id % 9 AS files_changed
        FROM events, n_projects""",
    "usual_lines": "SELECT median(lines_added) AS mid FROM commits_raw WHERE lines_added >= 0",
    "commits": """
        SELECT * EXCLUDE (mid) REPLACE (CASE WHEN lines_added >= 0 THEN lines_added ELSE mid END AS lines_added),
               CASE WHEN lines_added >= 0 THEN lines_added ELSE mid END + lines_deleted AS total_churn
        FROM commits_raw, usual_lines""",
    "pull_requests": f"""
        SELECT o_orderkey AS pull_request_id, o_orderkey % np AS project_id,
               (o_orderkey % np) * 1000 + {_qn("o_orderdate")} AS sprint_id, o_custkey AS author_id,
               (o_custkey + 1) % nd AS reviewer_id, o_orderdate AS opened_date,
               CASE WHEN o_orderstatus <> 'O' THEN o_orderdate + to_minutes((o_orderkey % 97) * 30) END
                   AS closed_date,
               CASE WHEN o_orderstatus <> 'O' AND o_orderkey % 50 <> 0
                    THEN CAST(o_orderkey % 97 AS DOUBLE) / 2 END AS review_time_hours,
               CAST(floor(o_totalprice / 1000) AS BIGINT) AS pr_size_lines,
               CASE o_orderstatus WHEN 'F' THEN 'Merged' WHEN 'P' THEN 'Closed' ELSE 'Open' END AS status,
               CAST(o_orderstatus = 'F' AS BIGINT) AS is_merged
        FROM orders, n_projects, n_developers""",
    "code_reviews": """
        SELECT pull_request_id AS review_id, pull_request_id, reviewer_id,
               1 + pull_request_id % 3 AS review_round, pull_request_id % 12 AS comments_count,
               CAST(1 AS BIGINT) AS approved, opened_date + INTERVAL 1 HOUR AS review_timestamp
        FROM pull_requests WHERE status <> 'Open'""",
    "deployments": """
        SELECT event_id AS deployment_id, event_id % np AS project_id,
               (event_id % np) * 1000 + event_id % 27 + 1 AS sprint_id,
               CASE WHEN event_id % 5 < 2 THEN 'production' ELSE 'staging' END AS environment,
               TIMESTAMP '1995-01-01' + to_months(3 * CAST(event_id % 27 AS INTEGER))
                   + to_days(CAST(60 + event_id % 30 AS INTEGER)) + to_hours(event_id % 24)
                   AS deployment_timestamp,
               CASE WHEN event_type = 'error' THEN 'Failed' ELSE 'Success' END AS status,
               CAST(event_type = 'error' AND event_id % 2 = 0 AS BIGINT) AS rollback, value AS duration_minutes,
               CAST(event_type = 'error' AS BIGINT) AS is_failure
        FROM events, n_projects WHERE event_type IN ('error', 'purchase', 'signup')""",
    "releases": """
        SELECT sprint_id AS release_id, project_id, team_id, sprint_id,
               sprint_end_date + 2 AS planned_release_date,
               CASE WHEN sprint_id % 37 <> 0 THEN sprint_end_date + 2 + CAST(late_by AS INTEGER) END
                   AS actual_release_date,
               CASE WHEN sprint_id % 37 <> 0 THEN CAST(late_by AS DOUBLE) END AS release_delay_days,
               CASE WHEN sprint_id % 37 = 0 THEN 'Cancelled' WHEN late_by > 1 THEN 'Delayed' ELSE 'On Time' END
                   AS status,
               format('v{}.{}.{}', 1 + sprint_number % 4, project_id % 20, sprint_number % 10) AS version,
               CAST(sprint_id % 37 <> 0 AND late_by > 1 AS BIGINT) AS is_delayed
        FROM (SELECT *, greatest(0, (sprint_id * 7) % 11 - 4) AS late_by FROM sprints WHERE sprint_id % 2 = 0) s""",
    # KPI tables
    "kpi_team_summary": """
        SELECT teams.team_id, team_name, avg_sprint_completion_rate, avg_sprint_velocity, sprints_count,
               avg_cycle_time_days, mttr_hours, bug_reopen_rate_pct, escaped_defect_rate_pct, defect_density_pct,
               avg_pr_review_hours, pr_merge_rate_pct, change_failure_rate_pct, total_deployments,
               total_releases, release_success_rate_pct, release_delay_rate_pct, avg_release_delay_days,
               100 - coalesce(escaped_defect_rate_pct, 0) AS quality_score,
               avg_sprint_completion_rate * 100 AS delivery_score,
               100 - coalesce(change_failure_rate_pct, 0) AS devops_score,
               round_even(round(0.35::DOUBLE * (100 - coalesce(escaped_defect_rate_pct, 0))
                          + 0.35::DOUBLE * (avg_sprint_completion_rate * 100)
                          + 0.30::DOUBLE * (100 - coalesce(change_failure_rate_pct, 0)), 9), 1) AS team_health_score
        FROM teams LEFT JOIN k_sprint USING (team_id) LEFT JOIN k_issue USING (team_id)
             LEFT JOIN k_pr USING (team_id) LEFT JOIN k_deploy USING (team_id)
             LEFT JOIN k_release USING (team_id)""",
    "k_sprint": """
        SELECT team_id, avg(sprint_completion_rate) AS avg_sprint_completion_rate,
               avg(completed_story_points) AS avg_sprint_velocity, count(*) AS sprints_count
        FROM sprints GROUP BY team_id""",
    "k_issue": """
        SELECT a.team_id, avg_cycle_time_days, mttr_hours, bug_reopen_rate_pct, escaped_defect_rate_pct,
               100 * bugs::DOUBLE / total AS defect_density_pct
        FROM (SELECT team_id, count(*) AS total FROM issues GROUP BY team_id) a
        LEFT JOIN (SELECT team_id, avg(cycle_time_days) AS avg_cycle_time_days FROM issues
                   WHERE resolved_date IS NOT NULL GROUP BY team_id) c USING (team_id)
        LEFT JOIN (SELECT team_id, count(*) AS bugs, 100 * avg(reopened) AS bug_reopen_rate_pct,
                          100 * avg(escaped_defect) AS escaped_defect_rate_pct,
                          avg(resolution_time_hours) FILTER (WHERE resolved_date IS NOT NULL) AS mttr_hours
                   FROM issues WHERE issue_type = 'Bug' GROUP BY team_id) b USING (team_id)""",
    "k_pr": """
        SELECT s.team_id, avg(review_time_hours) AS avg_pr_review_hours, 100 * avg(is_merged) AS pr_merge_rate_pct
        FROM pull_requests p JOIN sprints s USING (sprint_id) GROUP BY s.team_id""",
    "k_deploy": """
        SELECT s.team_id, 100 * avg(is_failure) AS change_failure_rate_pct, count(*) AS total_deployments
        FROM deployments d JOIN sprints s USING (sprint_id) GROUP BY s.team_id""",
    "k_release": """
        SELECT team_id, count(*) AS total_releases, 100 * avg((status = 'On Time')::INT) AS release_success_rate_pct,
               100 * avg((status = 'Delayed')::INT) AS release_delay_rate_pct,
               avg(release_delay_days) AS avg_release_delay_days
        FROM releases GROUP BY team_id""",
    "kpi_project_health": """
        SELECT project_id, quality_score, delivery_score, devops_score,
               round_even(round(0.35::DOUBLE * quality_score + 0.35::DOUBLE * delivery_score
                          + 0.30::DOUBLE * devops_score, 9), 1) AS project_health_score,
               project_name, criticality
        FROM (SELECT project_id, 100 * (1 - avg(escaped_defect)) AS quality_score FROM issues
              WHERE issue_type = 'Bug' GROUP BY project_id) q
        FULL JOIN (SELECT project_id, 100 * avg(sprint_completion_rate) AS delivery_score FROM sprints
                   GROUP BY project_id) d USING (project_id)
        FULL JOIN (SELECT project_id, 100 * (1 - avg(is_failure)) AS devops_score FROM deployments
                   GROUP BY project_id) o USING (project_id)
        LEFT JOIN projects USING (project_id)""",
    "workload": """
        SELECT developer_id, full_name, team_id, seniority, commit_count, pr_count, issues_resolved, reviews_given,
               commit_count + 3 * pr_count + 2 * issues_resolved AS workload_index
        FROM (SELECT d.*, coalesce(c.n, 0) AS commit_count, coalesce(p.n, 0) AS pr_count,
                     coalesce(i.n, 0) AS issues_resolved, coalesce(r.n, 0) AS reviews_given
              FROM developers d
              LEFT JOIN (SELECT developer_id AS k, count(*) AS n FROM commits GROUP BY 1) c ON c.k = developer_id
              LEFT JOIN (SELECT author_id AS k, count(*) AS n FROM pull_requests GROUP BY 1) p ON p.k = developer_id
              LEFT JOIN (SELECT assignee_id AS k, count(*) AS n FROM issues WHERE status = 'Done' GROUP BY 1) i
                     ON i.k = developer_id
              LEFT JOIN (SELECT reviewer_id AS k, count(*) AS n FROM code_reviews GROUP BY 1) r
                     ON r.k = developer_id) x""",
    "kpi_developer_productivity": """
        SELECT developer_id, full_name, team_id, seniority, commit_count, pr_count, issues_resolved, reviews_given,
               workload_index, reopen_rate,
               round_even(round(100 * (0.40::DOUBLE * (output - min(output) OVER ()) / nullif(max(output) OVER () - min(output) OVER (), 0)
                 + 0.25::DOUBLE * (1 - (reopen_rate - min(reopen_rate) OVER ())
                                       / nullif(max(reopen_rate) OVER () - min(reopen_rate) OVER (), 0))
                 + 0.20::DOUBLE * (reviews_given - min(reviews_given) OVER ())
                                / nullif(max(reviews_given) OVER () - min(reviews_given) OVER (), 0)
                 + 0.15::DOUBLE * (1 - (away - min(away) OVER ()) / nullif(max(away) OVER () - min(away) OVER (), 0))), 9),
               1) AS engineering_productivity_score
        FROM (SELECT w.*, coalesce(rate, 0) AS reopen_rate, issues_resolved + pr_count AS output,
                     abs(workload_index - (SELECT median(workload_index) FROM workload)) AS away
              FROM workload w
              LEFT JOIN (SELECT assignee_id, avg(reopened) AS rate FROM issues WHERE issue_type = 'Bug'
                         GROUP BY 1) b ON assignee_id = developer_id) y""",
    # features
    "cuts": """
        SELECT r.*, s.sprint_end_date AS cutoff, s.sprint_completion_rate
        FROM releases r JOIN sprints s USING (sprint_id) WHERE r.status <> 'Cancelled'""",
    "f_issues": """
        SELECT release_id,
               count(*) FILTER (WHERE issue_type = 'Bug' AND (resolved_date IS NULL OR resolved_date > cutoff))
                   AS open_bugs,
               count(*) FILTER (WHERE issue_type = 'Bug' AND (resolved_date IS NULL OR resolved_date > cutoff)
                                      AND priority IN ('High', 'Critical')) AS critical_bugs,
               count(*) AS issues_to_date
        FROM cuts c JOIN issues i ON i.project_id = c.project_id AND created_date <= cutoff GROUP BY release_id""",
    "f_prs": """
        SELECT release_id,
               count(*) FILTER (WHERE closed_date IS NULL OR closed_date > cutoff) AS pending_prs,
               coalesce(sum(review_time_hours) FILTER (WHERE closed_date <= cutoff), 0) AS review_hours,
               count(review_time_hours) FILTER (WHERE closed_date <= cutoff) AS reviews
        FROM cuts c JOIN pull_requests p ON p.project_id = c.project_id AND opened_date <= cutoff
        GROUP BY release_id""",
    "f_prs_opened": """
        SELECT release_id, count(*) FILTER (WHERE p.status = 'Open') AS pending_prs,
               avg(review_time_hours) AS avg_pr_review_time
        FROM cuts c JOIN pull_requests p ON p.project_id = c.project_id AND CAST(opened_date AS DATE) <= cutoff
        GROUP BY release_id""",
    "f_prs_all": """
        SELECT project_id, count(*) FILTER (WHERE status = 'Open') AS pending_prs,
               avg(review_time_hours) AS avg_pr_review_time
        FROM pull_requests GROUP BY project_id""",
    "f_deploys": """
        SELECT release_id, count(*) AS recent_deployment_frequency
        FROM cuts c JOIN deployments d ON d.project_id = c.project_id AND deployment_timestamp <= cutoff
             AND deployment_timestamp > cutoff - INTERVAL 14 DAYS
        GROUP BY release_id""",
    "f_hist_plan": """
        SELECT c.release_id, coalesce(avg(h.is_delayed), 0.3) AS historical_delay_rate
        FROM cuts c LEFT JOIN (SELECT * FROM releases WHERE status <> 'Cancelled') h
             ON h.project_id = c.project_id AND h.planned_release_date < c.planned_release_date
        GROUP BY c.release_id""",
    "f_hist_known": """
        SELECT c.release_id, coalesce(avg(h.is_delayed), 0.3) AS historical_delay_rate
        FROM cuts c LEFT JOIN (SELECT * FROM releases WHERE status <> 'Cancelled') h
             ON h.project_id = c.project_id AND h.actual_release_date <= c.cutoff
                AND h.release_id <> c.release_id
        GROUP BY c.release_id""",
    "crews": """
        SELECT project_id, count(developer_id) AS crew
        FROM projects p LEFT JOIN developers d USING (team_id) GROUP BY project_id""",
    "f_base": """
        SELECT c.release_id, c.project_id, coalesce(open_bugs, 0) AS open_bugs,
               coalesce(critical_bugs, 0) AS critical_bugs, 100 * sprint_completion_rate AS sprint_completion_pct,
               coalesce(issues_to_date, 0)::DOUBLE / greatest(1, coalesce(crew, 0)) AS developer_workload_proxy,
               coalesce(recent_deployment_frequency, 0) AS recent_deployment_frequency, is_delayed
        FROM cuts c LEFT JOIN f_issues USING (release_id) LEFT JOIN f_deploys USING (release_id)
             LEFT JOIN crews ON crews.project_id = c.project_id""",
    "release_features": """
        SELECT b.*, coalesce(review_hours / nullif(reviews, 0), 0) AS avg_pr_review_time,
               coalesce(pending_prs, 0) AS pending_prs, historical_delay_rate
        FROM f_base b LEFT JOIN f_prs USING (release_id) LEFT JOIN f_hist_known USING (release_id)""",
    # risk
    "risk_raw": """
        SELECT project_id, u, q, h, CASE WHEN h IS NOT NULL THEN p END AS p, w
        FROM (SELECT project_id, 100 - 100 * avg(sprint_completion_rate) AS u FROM sprints GROUP BY 1) a
        FULL JOIN (SELECT project_id, 100 * (0.5::DOUBLE * avg(escaped_defect) + 0.5::DOUBLE * avg(reopened)) AS q FROM issues
                   WHERE issue_type = 'Bug' GROUP BY 1) b USING (project_id)
        FULL JOIN (SELECT project_id, avg(review_time_hours) AS h,
                          count(*) FILTER (WHERE status = 'Open') AS p FROM pull_requests GROUP BY 1) c
                  USING (project_id)
        FULL JOIN (SELECT project_id, n::DOUBLE / crew AS w FROM crews
                   JOIN (SELECT project_id, count(*) AS n FROM issues GROUP BY 1) i USING (project_id)
                   WHERE crew > 0) d USING (project_id)""",
    "risk_components": """
        SELECT project_id, coalesce(100 * (u - min(u) OVER ()) / nullif(max(u) OVER () - min(u) OVER (), 0), 0) AS delivery_risk,
               coalesce(100 * (q - min(q) OVER ()) / nullif(max(q) OVER () - min(q) OVER (), 0), 0) AS quality_risk,
               0.7::DOUBLE * 100 * coalesce((h - min(h) OVER ()) / nullif(max(h) OVER () - min(h) OVER (), 0), 0)
                        + 0.3::DOUBLE * 100 * coalesce((p - min(p) OVER ())::DOUBLE / nullif(max(p) OVER () - min(p) OVER (), 0), 0)
                   AS review_bottleneck_risk,
               coalesce(100 * (w - min(w) OVER ()) / nullif(max(w) OVER () - min(w) OVER (), 0), 0) AS workload_risk
        FROM risk_raw""",
    "release_risk_scores": """
        SELECT project_id, round_even(round(delivery_risk, 9), 1) AS delivery_risk, round_even(round(quality_risk, 9), 1) AS quality_risk,
               round_even(round(review_bottleneck_risk, 9), 1) AS review_bottleneck_risk,
               round_even(round(workload_risk, 9), 1) AS workload_risk, release_risk_score, project_name, criticality,
               CASE WHEN release_risk_score >= 65 THEN 'High Risk' WHEN release_risk_score >= 40 THEN 'Medium Risk'
                    ELSE 'Low Risk' END AS risk_tier
        FROM (SELECT *, round_even(round((delivery_risk + quality_risk + review_bottleneck_risk + workload_risk) / 4, 9), 1)
                     AS release_risk_score FROM risk_components) r JOIN projects USING (project_id)""",
    # exploration
    "project_metrics": """
        SELECT project_id, completion_rate, cycle_time, defect_density, review_time, deploy_count,
               change_failure_rate, avg_release_delay
        FROM (SELECT project_id, avg(sprint_completion_rate) AS completion_rate FROM sprints GROUP BY 1) a
        FULL JOIN (SELECT project_id, avg(cycle_time_days) FILTER (WHERE resolved_date IS NOT NULL) AS cycle_time,
                          nullif(sum((issue_type = 'Bug')::INT), 0)::DOUBLE / count(*) AS defect_density
                   FROM issues GROUP BY 1) b USING (project_id)
        FULL JOIN (SELECT project_id, avg(review_time_hours) AS review_time FROM pull_requests GROUP BY 1) c
                  USING (project_id)
        FULL JOIN (SELECT project_id, count(*) AS deploy_count, avg(is_failure) AS change_failure_rate
                   FROM deployments GROUP BY 1) d USING (project_id)
        FULL JOIN (SELECT project_id, avg(release_delay_days) AS avg_release_delay
                   FROM releases WHERE status <> 'Cancelled' GROUP BY 1) e USING (project_id)""",
    "dev_load": "SELECT assignee_id, count(*) AS n FROM issues GROUP BY assignee_id",
    # dashboard: the fixed filter choice of the registered queries
    "picked_teams": """
        SELECT team_id FROM teams
        WHERE team_name IN ('NATION_1', 'NATION_3', 'NATION_7', 'NATION_15', 'NATION_16', 'NATION_20')""",
    "picked_projects": "SELECT * FROM projects WHERE team_id IN (SELECT team_id FROM picked_teams)",
    "picked_issues": """
        SELECT * FROM issues WHERE project_id IN (SELECT project_id FROM picked_projects)
               AND priority IN ('Low', 'High', 'Critical')""",
}

_WORD = re.compile(r"[a-z_]+[a-z_0-9]*")


def _needed(sql: str, found: dict[str, None]) -> None:
    for word in dict.fromkeys(_WORD.findall(sql)):
        if word in CTES and word not in found:
            _needed(CTES[word], found)
            found[word] = None


def with_tables(sql: str) -> str:
    found: dict[str, None] = {}
    _needed(sql, found)
    heads = ",\n".join(f"{name} AS ({CTES[name].strip()})" for name in found)
    return f"WITH {heads}\n{sql.strip()}" if heads else sql.strip()
