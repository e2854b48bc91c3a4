"""Known results worked out from the figures that they rest on, and the order of ranked outputs."""

from fractions import Fraction

import pytest

from deliverylens.operators.profile import correlation_pairs, notable_correlations
from deliverylens.plans import dashboard, explore, kpi, questions, report, risk
from deliverylens.plans.stages import sample_tables

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark):
    return sample_tables(spark, SF)


def in_order(rows, *keys):
    """Whether rows follow (column, descending, nulls last) keys."""
    marks = []
    for r in rows:
        mark = []
        for column, descending in keys:
            v = r[column]
            if isinstance(v, str):
                mark.append((v is None, v))
            else:
                mark.append((v is None, 0 if v is None else -v if descending else v))
        marks.append(tuple(mark))
    return marks == sorted(marks)


@pytest.mark.parametrize(
    ("build", "keys"),
    [
        (lambda t: questions.team_completion(t), [("avg_completion_pct", True), ("team_name", False)]),
        (lambda t: questions.recent_velocity(t), [("avg_velocity_last5", True), ("team_name", False)]),
        (lambda t: risk.risk_scores(t), [("release_risk_score", True)]),
        # lowest first, as bars are drawn from below
        (lambda t: dashboard.risk_ranking(t), [("release_risk_score", False)]),
        (lambda t: dashboard.risk_detail(t), [("release_risk_score", True)]),
        (lambda t: dashboard.team_ranking(t, "avg_pr_review_hours"), [("avg_pr_review_hours", True), ("team_id", False)]),
        (lambda t: dashboard.bugs_by_project(t, t), [("bug_count", True), ("project_name", False)]),
    ],
)
def test_ranked_outputs_come_in_order(tables, build, keys):
    df = build(tables)
    rows = df.collect()
    keys = [(c, d) for c, d in keys if c in df.columns]
    assert rows and keys and in_order(rows, *keys)


def test_blended_risk_comes_in_order(tables):
    rows = [r for r in questions.blended_risk(tables).collect() if None not in r]
    blend = [100 - r.avg_sprint_completion_pct + r.bug_reopen_rate_pct + r.avg_pr_review_hours for r in rows]
    assert all(a >= b - 0.3 for a, b in zip(blend, blend[1:]))


# Components, score and tier of twelve projects.
RISKS = [
    ("P009", 100.0, 95.3, 69.5, 100.0, 91.2, "High Risk"),
    ("P008", 93.1, 70.0, 89.1, 97.1, 87.3, "High Risk"),
    ("P011", 96.6, 54.2, 66.1, 81.4, 74.6, "High Risk"),
    ("P004", 4.0, 100.0, 30.0, 60.6, 48.6, "Medium Risk"),
    ("P005", 35.8, 29.4, 46.7, 68.5, 45.1, "Medium Risk"),
    ("P010", 4.8, 53.0, 32.3, 31.3, 30.4, "Low Risk"),
    ("P002", 3.9, 50.6, 19.1, 46.5, 30.0, "Low Risk"),
    ("P012", 18.3, 19.7, 28.2, 51.4, 29.4, "Low Risk"),
    ("P001", 0.0, 23.4, 20.0, 49.4, 23.2, "Low Risk"),
    ("P007", 6.4, 12.0, 33.8, 2.1, 13.6, "Low Risk"),
    ("P003", 8.4, 0.0, 36.2, 4.5, 12.3, "Low Risk"),
    ("P006", 2.2, 10.1, 26.2, 0.0, 9.6, "Low Risk"),
]
# Project, quality, delivery, devops and health of the same projects, worst first.
HEALTH = [
    ("P009", 90.0990099009901, 56.27817941093196, 79.54545454545455, 75.1),
    ("P008", 85.3211009174312, 59.038523039280676, 87.17948717948718, 76.7),
    ("P011", 89.77272727272727, 57.62968660643079, 87.2340425531915, 77.8),
    ("P005", 93.67088607594937, 81.85921424841854, 93.22033898305084, 89.4),
    ("P004", 88.23529411764706, 94.51986524387476, 92.40506329113924, 91.7),
    ("P012", 91.48936170212765, 88.83153019276826, 97.05882352941177, 92.2),
    ("P007", 91.35802469135803, 93.53878174287746, 94.02985074626866, 92.9),
    ("P002", 91.11111111111111, 94.54524590668946, 95.45454545454545, 93.6),
    ("P003", 95.28301886792453, 92.762184242791, 93.10344827586206, 93.7),
    ("P001", 90.80459770114942, 96.10424895114062, 96.0, 94.2),
    ("P010", 92.3076923076923, 94.19203747072599, 96.96969696969697, 94.4),
    ("P006", 95.65217391304348, 95.22311661506707, 93.05555555555556, 94.7),
]
# Team, completion rate, reopened and escaped bugs in per cent, review hours, failed
# deployments in per cent and health of eight teams, two of them without facts.
TEAMS = [
    ("T001", None, None, None, None, None, None),
    ("T002", None, None, None, None, None, None),
    ("T003", 0.9454524590668946, 18.88888888888889, 8.88888888888889, 13.242777777777777, 4.545454545454546, 93.6),
    ("T004", 0.9384136086691185, 14.336917562724013, 5.734767025089606, 14.116772823779193, 6.637168141592921, 93.8),
    ("T005", 0.5764879635221447, 20.13422818791946, 11.74496644295302, 23.87730061349693, 15.384615384615385, 76.5),
    ("T006", 0.9315188146259455, 17.293233082706767, 9.774436090225564, 14.050363636363636, 4.954954954954955, 92.7),
    ("T007", 0.8185921424841853, 17.72151898734177, 6.329113924050633, 18.431952662721894, 6.779661016949153, 89.4),
    ("T008", 0.9419203747072599, 20.51282051282051, 7.6923076923076925, 13.604117647058823, 3.0303030303030303, 94.4),
]
TEAM = (
    "team_id string, avg_sprint_completion_rate double, bug_reopen_rate_pct double, escaped_defect_rate_pct double,"
    " avg_pr_review_hours double, change_failure_rate_pct double, expected double"
)
# Project, completion rate, cycle time, defect density, review time, deployments,
# change failure rate and release delay of the same projects.
METRICS = [
    ("P001", 0.9610424895114061, 1.1737520128824477, 0.3493975903614458, 14.235869565217392, 75, 0.04, 0.3),
    ("P002", 0.9454524590668946, 1.044680420711974, 0.32727272727272727, 13.242777777777777, 66, 0.045454545454545456, 1.66),
    ("P003", 0.9276218424279099, 1.0571915064102564, 0.39552238805970147, 14.64551724137931, 87, 0.06896551724137931, 1.5),
    ("P004", 0.9451986524387477, 1.0802641369047619, 0.30141843971631205, 14.525683060109289, 79, 0.0759493670886076, 0.5),
    ("P005", 0.8185921424841855, 1.315171568627451, 0.3623853211009174, 18.431952662721894, 59, 0.06779661016949153, 0.04),
    ("P006", 0.9522311661506707, 1.056193078324226, 0.3865546218487395, 13.924390243902439, 72, 0.06944444444444445, 2.48),
    ("P007", 0.9353878174287746, 1.0504464285714286, 0.32142857142857145, 13.838271604938273, 67, 0.05970149253731343, 1.34),
    ("P008", 0.5903852303928068, 1.8046705426356588, 0.3920863309352518, 24.233532934131738, 39, 0.1282051282051282, 4.64),
    ("P009", 0.5627817941093196, 1.8011381172839507, 0.35563380281690143, 24.150898203592813, 44, 0.20454545454545456, 3.14),
    ("P010", 0.9419203747072599, 1.0971491228070176, 0.3482142857142857, 13.604117647058823, 66, 0.030303030303030304, 1.1),
    ("P011", 0.5762968660643079, 1.7153659611992944, 0.35918367346938773, 23.198709677419355, 47, 0.1276595744680851, 1.78),
    ("P012", 0.8883153019276826, 1.2173109965635738, 0.3686274509803922, 13.388524590163934, 68, 0.029411764705882353, 1.075),
]


def test_known_risk_scores(spark):
    schema = "project_id string, delivery_risk double, quality_risk double, review_bottleneck_risk double, workload_risk double"
    got = {r.project_id: r for r in risk.with_composite(spark.createDataFrame([r[:5] for r in RISKS], schema)).collect()}
    for project, *_, score, tier in RISKS:
        # the components are given to one place
        assert got[project].release_risk_score == pytest.approx(score, abs=0.11)
        assert got[project].risk_tier == tier


def test_known_recommendations(spark):
    names = "project_name string, delivery_risk double, quality_risk double, review_bottleneck_risk double, workload_risk double, release_risk_score double, risk_tier string"
    rows = {r.project_name: r for r in report.recommendations(spark.createDataFrame(RISKS, names)).collect()}
    drivers = [text for _, text in report.DRIVERS]
    assert {name: (r.primary_drivers, r.recommended_action) for name, r in rows.items()} == {
        "P009": ("; ".join(drivers), report.URGENT_ACTION),
        "P008": ("; ".join(drivers), report.URGENT_ACTION),
        # escaped defects are not what drives this one
        "P011": ("; ".join([drivers[0], *drivers[2:]]), report.WATCH_ACTION),
    }


def test_known_team_health(spark):
    scored = kpi.with_team_scores(spark.createDataFrame(TEAMS, TEAM))
    assert all(r.team_health_score == r.expected for r in scored.collect())
    empty = scored.filter("team_id = 'T001'").first()
    assert (empty.quality_score, empty.delivery_score, empty.devops_score) == (100.0, None, 100.0)


def test_known_project_health(spark):
    """Facts that have the known rates: a sprint, and bugs and deployments in the smallest
    numbers that give a rate."""

    def flags(percent):
        part = Fraction(1 - percent / 100).limit_denominator(400)
        return [int(k < part.numerator) for k in range(part.denominator)]

    bugs, deploys = [], []
    for project, quality, _, devops, _ in HEALTH:
        bugs += [(project, "Bug", flag) for flag in flags(quality)]
        deploys += [(project, flag) for flag in flags(devops)]
    frame = spark.createDataFrame
    t = {
        "issues": frame(bugs, "project_id string, issue_type string, escaped_defect int"),
        "sprints": frame([(p, d / 100) for p, _, d, _, _ in HEALTH], "project_id string, sprint_completion_rate double"),
        "deployments": frame(deploys, "project_id string, is_failure int"),
        "projects": frame([(p, p, "Low") for p, *_ in HEALTH], "project_id string, project_name string, criticality string"),
    }
    got = [(r.project_id, r.project_health_score) for r in kpi.project_health(t).collect()]
    assert got == [(p, score) for p, *_, score in HEALTH]


def test_known_summary(spark):
    tables = {
        "kpi_team_summary": spark.createDataFrame(TEAMS, TEAM),
        "kpi_project_health": spark.createDataFrame([(h[-1],) for h in HEALTH], "project_health_score double"),
        "release_risk_scores": spark.createDataFrame([(r[-1],) for r in RISKS], "risk_tier string"),
    }
    row = report.kpi_summary(tables, "2024-07-01").first()
    assert (row.avg_sprint_completion_rate_pct, row.avg_bug_reopen_rate_pct, row.avg_pr_review_hours) == (85.9, 18.1, 16.2)
    assert (row.avg_change_failure_rate_pct, row.avg_project_health_score) == (6.9, 88.9)
    assert (row.at_risk_project_count, row.total_projects) == (3, 12)


def test_known_correlations(spark):
    columns = list(explore.PROJECT_METRICS)
    df = spark.createDataFrame(METRICS, ["project_id", *columns])
    r = {(x.metric_a, x.metric_b): x.r for x in correlation_pairs(df, columns).collect()}
    assert round(r["completion_rate", "review_time"], 2) == -0.98
    assert round(r["completion_rate", "cycle_time"], 2) == -0.99
    assert round(r["review_time", "change_failure_rate"], 2) == 0.89
    assert notable_correlations(df, columns, 0.4).count() == 16


# How many rows of each kind make up known rates.
REOPENED = {"Data-Platform": (16, 78, 20.5), "Platform-Infra": (60, 298, 20.1), "Search": (17, 90, 18.9), "Notifications": (14, 79, 17.7), "Mobile": (46, 266, 17.3)}
DEFECTS = {"Search-Service": (106, 268, 39.6), "Data-Pipeline": (109, 278, 39.2), "Mobile-App-Android": (92, 238, 38.7), "Analytics-Dashboard": (94, 255, 36.9)}
ESCAPED = {"Data-Pipeline": (16, 109, 14.7), "Auth-Gateway": (10, 85, 11.8), "Inventory-Service": (9, 88, 10.2), "Fraud-Detection": (10, 101, 9.9), "Checkout-Web": (8, 87, 9.2)}
DELAYED = {"Mobile-App-Android": (4, 5, 80.0), "Data-Pipeline": (4, 5, 80.0), "Search-Service": (3, 5, 60.0), "Inventory-Service": (3, 5, 60.0)}


@pytest.mark.parametrize(
    ("known", "build", "table", "row", "columns"),
    [
        (REOPENED, questions.reopened_bugs_by_team, "issues", lambda hit: ("Bug", int(hit), 0, 0), ("reopened_bugs", "total_bugs", "reopen_rate_pct")),
        (DEFECTS, questions.defect_rate, "issues", lambda hit: ("Bug" if hit else "Task", 0, 0, 0), ("bug_count", "total_issues", "defect_rate_pct")),
        (ESCAPED, questions.escaped_defects_top, "issues", lambda hit: ("Bug", 0, int(hit), 0), ("escaped_defects", "total_bugs", "escaped_rate_pct")),
        (DELAYED, questions.late_projects, "releases", lambda hit: (None, 0, 0, int(hit)), ("delayed_releases", "total_releases", "delay_rate_pct")),
    ],
)
def test_known_rates(spark, known, build, table, row, columns):
    """Rows in the known numbers, under the names that the rates are known for."""
    facts = [(name, name, *row(k < hits)) for name, (hits, total, _) in known.items() for k in range(total)]
    schema = "project_id string, team_id string, issue_type string, reopened int, escaped_defect int, is_delayed int"
    t = {
        table: spark.createDataFrame(facts, schema),
        "projects": spark.createDataFrame([(n, n) for n in known], "project_id string, project_name string"),
        "teams": spark.createDataFrame([(n, n) for n in known], "team_id string, team_name string"),
    }
    found = build(t).collect()
    name = "team_name" if "team_name" in found[0].asDict() else "project_name"
    assert {r[name]: tuple(r[c] for c in columns) for r in found} == known
    rates = [r[columns[-1]] for r in found]
    assert rates == sorted(rates, reverse=True)
