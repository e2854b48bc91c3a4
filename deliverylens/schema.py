"""Table registry: typed columns, keys, references and category domains."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Field:
    name: str
    type: str
    # a lenient field turns unreadable text into NULL, a strict one fails the job
    lenient: bool = False
    # added by cleaning, so absent from raw exports
    derived: bool = False


@dataclass(frozen=True)
class TableSpec:
    name: str
    primary_key: str
    fields: tuple[Field, ...]
    references: dict[str, str] = field(default_factory=dict)

    def columns(self, processed: bool = True) -> list[Field]:
        return [f for f in self.fields if processed or not f.derived]


# The tables, their columns and types, keys and references.
TABLES: dict[str, TableSpec] = {
    "teams": TableSpec(
        "teams",
        "team_id",
        (
            Field("team_id", "string"),
            Field("team_name", "string"),
            Field("department", "string"),
            Field("formed_date", "date"),
        ),
    ),
    "developers": TableSpec(
        "developers",
        "developer_id",
        (
            Field("developer_id", "string"),
            Field("full_name", "string"),
            Field("team_id", "string"),
            Field("role", "string"),
            Field("seniority", "string"),
            Field("hire_date", "date"),
            Field("timezone", "string"),
        ),
        {
            "team_id": "teams",
        },
    ),
    "projects": TableSpec(
        "projects",
        "project_id",
        (
            Field("project_id", "string"),
            Field("project_name", "string"),
            Field("team_id", "string"),
            Field("start_date", "date"),
            Field("criticality", "string"),
            Field("tech_stack", "string"),
        ),
        {
            "team_id": "teams",
        },
    ),
    "sprints": TableSpec(
        "sprints",
        "sprint_id",
        (
            Field("sprint_id", "string"),
            Field("project_id", "string"),
            Field("team_id", "string"),
            Field("sprint_number", "int"),
            Field("sprint_start_date", "date"),
            Field("sprint_end_date", "date"),
            Field("planned_story_points", "int"),
            Field("completed_story_points", "int"),
            Field("sprint_completion_rate", "double", derived=True),
        ),
        {
            "project_id": "projects",
            "team_id": "teams",
        },
    ),
    "issues": TableSpec(
        "issues",
        "issue_id",
        (
            Field("issue_id", "string"),
            Field("project_id", "string"),
            Field("sprint_id", "string"),
            Field("team_id", "string"),
            Field("assignee_id", "string"),
            Field("issue_type", "string"),
            Field("priority", "string"),
            Field("severity", "string"),
            Field("status", "string"),
            Field("created_date", "timestamp_ntz"),
            Field("resolved_date", "timestamp_ntz", lenient=True),
            Field("resolution_time_hours", "double"),
            Field("reopened", "int"),
            Field("escaped_defect", "int"),
            Field("cycle_time_days", "double", derived=True),
        ),
        {
            "project_id": "projects",
            "sprint_id": "sprints",
            "team_id": "teams",
            "assignee_id": "developers",
        },
    ),
    "commits": TableSpec(
        "commits",
        "commit_id",
        (
            Field("commit_id", "string"),
            Field("project_id", "string"),
            Field("sprint_id", "string"),
            Field("developer_id", "string"),
            Field("commit_timestamp", "timestamp_ntz"),
            # imputation makes lines_added fractional, so it is a double here
            Field("lines_added", "double"),
            Field("lines_deleted", "int"),
            Field("files_changed", "int"),
            Field("total_churn", "double", derived=True),
        ),
        {
            "project_id": "projects",
            "sprint_id": "sprints",
            "developer_id": "developers",
        },
    ),
    "pull_requests": TableSpec(
        "pull_requests",
        "pull_request_id",
        (
            Field("pull_request_id", "string"),
            Field("project_id", "string"),
            Field("sprint_id", "string"),
            Field("author_id", "string"),
            Field("reviewer_id", "string"),
            Field("opened_date", "timestamp_ntz"),
            Field("closed_date", "timestamp_ntz", lenient=True),
            Field("review_time_hours", "double"),
            Field("pr_size_lines", "int"),
            Field("status", "string"),
            Field("is_merged", "int", derived=True),
        ),
        {
            "project_id": "projects",
            "sprint_id": "sprints",
            "author_id": "developers",
            "reviewer_id": "developers",
        },
    ),
    "code_reviews": TableSpec(
        "code_reviews",
        "review_id",
        (
            Field("review_id", "string"),
            Field("pull_request_id", "string"),
            Field("reviewer_id", "string"),
            Field("review_round", "int"),
            Field("comments_count", "int"),
            Field("approved", "int"),
            Field("review_timestamp", "timestamp_ntz"),
        ),
        {
            "pull_request_id": "pull_requests",
            "reviewer_id": "developers",
        },
    ),
    "deployments": TableSpec(
        "deployments",
        "deployment_id",
        (
            Field("deployment_id", "string"),
            Field("project_id", "string"),
            Field("sprint_id", "string"),
            Field("environment", "string"),
            Field("deployment_timestamp", "timestamp_ntz"),
            Field("status", "string"),
            Field("rollback", "int"),
            Field("duration_minutes", "double"),
            Field("is_failure", "int", derived=True),
        ),
        {
            "project_id": "projects",
            "sprint_id": "sprints",
        },
    ),
    "releases": TableSpec(
        "releases",
        "release_id",
        (
            Field("release_id", "string"),
            Field("project_id", "string"),
            Field("team_id", "string"),
            Field("sprint_id", "string"),
            Field("planned_release_date", "date"),
            Field("actual_release_date", "date", lenient=True),
            Field("release_delay_days", "double"),
            Field("status", "string"),
            Field("version", "string"),
            Field("is_delayed", "int", derived=True),
        ),
        {
            "project_id": "projects",
            "team_id": "teams",
            "sprint_id": "sprints",
        },
    ),
}

# the six references checked after every cleaning run
CORE_REFERENCES = (
    ("issues", "project_id"),
    ("issues", "assignee_id"),
    ("sprints", "project_id"),
    ("pull_requests", "author_id"),
    ("deployments", "project_id"),
    ("releases", "project_id"),
)
ALL_REFERENCES = tuple((t.name, column) for t in TABLES.values() for column in t.references)

# Category domains, in their natural order.
ISSUE_TYPES = ("Bug", "Story", "Task", "Sub-task")
PRIORITIES = ("Low", "Medium", "High", "Critical")
SEVERITIES = ("Minor", "Major", "Critical", "Blocker")
ISSUE_STATUSES = ("Done", "In Progress", "Reopened", "Won't Fix")
PR_STATUSES = ("Merged", "Closed", "Open")
ENVIRONMENTS = ("staging", "production")
RELEASE_STATUSES = ("On Time", "Delayed", "Cancelled")
CRITICALITIES = ("Low", "Medium", "High")
RISK_TIERS = ("High Risk", "Medium Risk", "Low Risk")

KPI_TABLES = ("kpi_team_summary", "kpi_project_health", "kpi_developer_productivity", "release_risk_scores")
