"""Metrics for SQL users: the facts as views, each metric as a table function over a range of days.

    register(spark, "/facts")
    spark.sql("SELECT * FROM repos_gt1(DATE'2024-01-01', DATE'2024-01-31') ORDER BY repos_total DESC LIMIT 100")
    spark.sql("SELECT * FROM commits_gt1()")  -- all days

The functions are SQL text that Spark puts in place of the call, so days prune
partitions and a limit behind an order becomes a top-k, as with the DataFrame form.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from eventloom.schemas import FACTS
from eventloom.sources.facts import read_fact


@dataclass(frozen=True)
class TableFunction:
    """``body`` selects ``returns`` from ``{fact}``: the rows of a fact on the days asked for. ``order`` is total."""

    fact: str
    returns: str
    body: str
    order: str


FUNCTIONS = {
    "repos_gt1": TableFunction(
        "repos", "repo_author STRING, repos_total BIGINT",
        "SELECT repo_author, count(DISTINCT repo_name) AS repos_total FROM {fact} GROUP BY repo_author HAVING repos_total > 1",
        "repos_total DESC, repo_author",
    ),
    "commits_gt1": TableFunction(
        "commits", "date DATE, author_name STRING, total_commits BIGINT",
        "SELECT date, author_name, count(*) AS total_commits FROM {fact} GROUP BY date, author_name HAVING total_commits >= 2",
        "author_name, total_commits DESC, date",
    ),
    "commits_lt1": TableFunction(
        "commits", "author_name STRING, interval_start_dt DATE",
        """
        WITH active AS (SELECT DISTINCT author_name, date FROM {fact} WHERE date IS NOT NULL),
        span AS (SELECT min(date) AS first_day, max(date) AS last_day, count(*) AS author_days FROM active),
        near AS (
          SELECT author_name, date,
                 lag(date) OVER (PARTITION BY author_name ORDER BY date) AS previous,
                 lead(date) OVER (PARTITION BY author_name ORDER BY date) AS next
          FROM active
        ),
        idle AS (
          SELECT author_name,
                 coalesce(date_add(previous, 1), (SELECT first_day FROM span WHERE author_days > 0)) AS low, date_sub(date, 1) AS high
          FROM near
          UNION ALL
          SELECT author_name, date_add(date, 1), (SELECT last_day FROM span WHERE author_days > 0) FROM near WHERE next IS NULL
        )
        SELECT author_name, explode(sequence(low, high)) AS interval_start_dt
        FROM idle WHERE author_name IS NOT NULL AND low <= high
        """,
        "author_name, interval_start_dt",
    ),
    "members_gt10": TableFunction(
        "members", "repo_name STRING, repo_name_full STRING, total_members BIGINT",
        "SELECT repo_name, repo_name_full, count(DISTINCT member_login) AS total_members FROM {fact} "
        "GROUP BY repo_name, repo_name_full HAVING total_members > 10",
        "total_members DESC, repo_name, repo_name_full",
    ),
    "members_total": TableFunction(
        "members", "total_projects BIGINT",
        "SELECT count(repo_name_full) AS total_projects FROM (SELECT repo_name, repo_name_full FROM {fact} "
        "GROUP BY repo_name, repo_name_full HAVING count(DISTINCT member_login) > 10)",
        "total_projects",
    ),
    "members_hourly": TableFunction(
        "members", "date DATE, h INT, total BIGINT",
        "SELECT date, hour(created_at) AS h, count(*) AS total FROM {fact} GROUP BY date, hour(created_at)",
        "date DESC, h DESC",
    ),
    "members_daily": TableFunction(
        "members", "date DATE, total BIGINT", "SELECT date, count(*) AS total FROM {fact} GROUP BY date", "date"
    ),
    "commits_hourly": TableFunction(
        "commits", "date DATE, h INT, total BIGINT",
        "SELECT date, hour(created_at) AS h, count(*) AS total FROM {fact} GROUP BY date, hour(created_at)",
        "date DESC, h DESC",
    ),
    "commits_daily": TableFunction(
        "commits", "date DATE, total BIGINT", "SELECT date, count(*) AS total FROM {fact} GROUP BY date", "date"
    ),
    "commit_day_span": TableFunction(
        "commits", "min_created_at DATE, max_created_at DATE",
        "SELECT min(date) AS min_created_at, max(date) AS max_created_at FROM {fact}", "min_created_at",
    ),
    "running_commits": TableFunction(
        "commits", "author_name STRING, created_at TIMESTAMP_NTZ, date DATE, sum_commits BIGINT",
        """
        SELECT author_name, created_at, date, sum_commits
        FROM (
          SELECT author_name, created_at, date, n,
                 sum(n) OVER (PARTITION BY author_name, date ORDER BY created_at ROWS UNBOUNDED PRECEDING) AS sum_commits
          FROM (SELECT author_name, created_at, date, count(*) AS n FROM {fact} GROUP BY author_name, created_at, date)
        ) LATERAL VIEW explode(sequence(1L, n)) copies AS copy
        """,
        "author_name, created_at, date, sum_commits",
    ),
    "repos_daily_rows": TableFunction(
        "repos", "date DATE, total BIGINT", "SELECT date, count(*) AS total FROM {fact} GROUP BY date", "date DESC"
    ),
}


def register(spark: SparkSession, root: str, facts=tuple(FACTS)) -> list[str]:
    """Makes views of the facts stored under ``root`` and table functions of their metrics; returns their names.

    Views are named as the facts, functions as the exported metrics. Both are
    temporary, belong to the session and replace others of their names. They
    show what counts at the time of the call: call again after a run. Functions
    take a first and a last day, both included; NULL, or nothing, is open.
    """
    for name in facts:
        read_fact(spark, root, name).createOrReplaceTempView(name)
    made = {name: function for name, function in FUNCTIONS.items() if function.fact in facts}
    for name, function in made.items():
        days = f"(SELECT * FROM {function.fact} WHERE (date_from IS NULL OR date >= date_from) AND (date_to IS NULL OR date <= date_to))"
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(date_from DATE DEFAULT NULL, date_to DATE DEFAULT NULL) "
            f"RETURNS TABLE({function.returns}) RETURN {function.body.format(fact=days)}"
        )
    return sorted([*facts, *made])


def sql_metric(spark: SparkSession, name: str, date_from: str | None = None, date_to: str | None = None, limit: int = 0) -> DataFrame:
    """A registered metric in its own order, of a range of days; a positive ``limit`` keeps the first rows."""
    if name not in FUNCTIONS:
        raise ValueError(f"unknown metric: {name}")
    text = f"SELECT * FROM {name}(CAST(:date_from AS DATE), CAST(:date_to AS DATE)) ORDER BY {FUNCTIONS[name].order}"
    rows = spark.sql(text, {"date_from": date_from, "date_to": date_to})
    return rows.limit(limit) if limit > 0 else rows
