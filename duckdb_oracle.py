"""The registered queries as DuckDB SQL over the flat ``events`` table.

Written from the rules in FIXTURES.md, not from the Spark code: facts come from
flat joins, the calendar from ``generate_series``.
"""

from __future__ import annotations

_ACTIVITY = """
activity AS (
    SELECT
        event_id AS e,
        user_id AS u,
        CASE event_type
            WHEN 'click' THEN 'PushEvent'
            WHEN 'purchase' THEN 'PushEvent'
            WHEN 'signup' THEN 'MemberEvent'
            WHEN 'view' THEN 'WatchEvent'
            WHEN 'error' THEN 'IssuesEvent'
        END AS type,
        CASE WHEN event_id % 301 NOT IN (11, 12) THEN date_trunc('second', ts) END AS event_ts,
        CASE WHEN event_id % 301 = 11 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S')
            WHEN event_id % 301 = 12 THEN NULL
            WHEN event_id % 41 = 7 THEN strftime(ts + INTERVAL 2 HOUR, '%Y-%m-%dT%H:%M:%S+02:00')
            WHEN event_id % 41 = 9 THEN strftime(ts - INTERVAL 330 MINUTE, '%Y-%m-%dT%H:%M:%S-0530')
            ELSE strftime(ts, '%Y-%m-%dT%H:%M:%SZ') END AS created_at,
        CAST(event_ts AS DATE) AS date,
        CAST(hour(event_ts) AS INTEGER) AS hour,
        CASE WHEN event_id % 3 <> 0 THEN event_id % 7 END AS org_id,
        CASE WHEN event_id % 3 <> 0 THEN 'org' || (event_id % 7) END AS org_login,
        (event_id // 2) % 185 AS repo_id,
        CASE
            WHEN event_id % 97 = 0 THEN 'noslash'
            WHEN event_id % 89 = 0 THEN 'owner1/'
            WHEN event_id % 83 = 0 THEN 'owner2/repo1/extra'
            WHEN event_id % 10 = 0 THEN 'owner0/repo0'
            WHEN (event_id // 4) % 37 < 5 THEN 'owner' || ((event_id // 4) % 37) || '/repo0'
            ELSE 'owner' || ((event_id // 4) % 37) || '/repo' || ((event_id // 2) % 5)
        END AS repo_name_full,
        CASE WHEN event_type = 'signup'
            THEN CASE WHEN event_id % 6 = 0 THEN 'removed' ELSE 'added' END
        END AS action,
        CASE WHEN event_type = 'signup' THEN user_id END AS member_id,
        CASE WHEN event_type = 'signup' THEN 'm' || user_id END AS member_login,
        CASE WHEN event_type = 'signup' THEN 'User' END AS member_type,
        CASE WHEN type = 'PushEvent' THEN 'refs/heads/b' || (event_id % 3) END AS ref,
        CASE event_id % 5 WHEN 0 THEN 'branch' WHEN 1 THEN 'tag' END AS ref_type,
        CASE WHEN event_type = 'error' THEN 'state' || (event_id % 2) END AS review
    FROM events
),
named AS (
    SELECT *,
        split_part(repo_name_full, '/', 1) AS repo_author,
        CASE WHEN contains(repo_name_full, '/') THEN split_part(repo_name_full, '/', 2) END AS repo_name
    FROM activity
)"""

_REPOS = """,
repos AS (
    SELECT date, hour, repo_author, repo_name, count(*) AS total_events
    FROM named WHERE event_ts IS NOT NULL GROUP BY ALL
)"""

_COMMITS = """,
commits AS (
    SELECT date, event_ts AS created_at,
        CASE WHEN (e + n.i) % 59 <> 0 THEN 'dev' || ((u * 7 + e + n.i * 13) % 1000) END AS author_name
    FROM activity JOIN (VALUES (0), (1), (2)) AS n(i) ON n.i < e % 4
    WHERE type = 'PushEvent' AND e % 61 <> 3 AND event_ts IS NOT NULL
)"""

_ADDED = """,
added AS (
    SELECT date, event_ts AS created_at, member_login, member_type, org_login,
        'u' || u AS actor_login, repo_name_full, repo_name, repo_author
    FROM named WHERE type = 'MemberEvent' AND action = 'added'
)"""

_MEMBERS = f"""{_ADDED},
members AS (SELECT * FROM added WHERE created_at IS NOT NULL)"""

_IDLE = """,
span AS (SELECT min(date) AS lo, max(date) AS hi FROM commits),
calendar AS (
    SELECT CAST(d AS DATE) AS day
    FROM span, generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY) AS t(d)
),
idle AS (
    SELECT a.author_name, c.day AS interval_start_dt
    FROM (SELECT DISTINCT author_name FROM commits WHERE author_name IS NOT NULL) a
    CROSS JOIN calendar c
    WHERE NOT EXISTS (
        SELECT 1 FROM commits k WHERE k.author_name = a.author_name AND k.date = c.day
    )
)"""

_OWNERS_GT1 = """
SELECT repo_author, count(DISTINCT repo_name) AS repos_total
FROM repos GROUP BY repo_author HAVING count(DISTINCT repo_name) > 1
"""

_OWNER_ACTIVITY = """
SELECT repo_author, count(repo_name) AS total_repo_events,
    count(DISTINCT repo_name) AS total_repos
FROM named GROUP BY repo_author HAVING count(DISTINCT repo_name) > 1
"""

_PER_DAY = """
SELECT date, author_name, count(*) AS total_commits
FROM commits GROUP BY date, author_name HAVING count(*) {having}
"""

_PROJECTS = """
SELECT repo_name, repo_name_full, count(DISTINCT member_login) AS total_members
FROM members GROUP BY repo_name, repo_name_full HAVING count(DISTINCT member_login) > 10
"""

_HOURLY = """
SELECT date, CAST(hour(created_at) AS INTEGER) AS h, count(*) AS total
FROM {fact} GROUP BY ALL
"""

_DAILY = "SELECT date, count(*) AS total FROM {fact} GROUP BY date"


def _raw(sql: str) -> str:
    return f"WITH {_ACTIVITY} {sql}"


def _repos(sql: str) -> str:
    return f"WITH {_ACTIVITY}{_REPOS} {sql}"


def _commits(sql: str) -> str:
    return f"WITH {_ACTIVITY}{_COMMITS} {sql}"


def _members(sql: str) -> str:
    return f"WITH {_ACTIVITY}{_MEMBERS} {sql}"


ORACLE: dict[str, str] = {
    "repos_hourly": _repos("SELECT * FROM repos"),
    "commits_fact": _commits("SELECT * FROM commits"),
    "members_fact": _members("SELECT * FROM members"),
    "reduction_ratio": f"""
        WITH {_ACTIVITY}{_REPOS}{_COMMITS}{_MEMBERS},
        sizes AS (
            SELECT 'repos' AS fact, count(*) AS rows_out FROM repos
            UNION ALL SELECT 'commits', count(*) FROM commits
            UNION ALL SELECT 'members', count(*) FROM members
        ),
        total AS (SELECT count(*) AS rows_in FROM activity)
        SELECT fact, rows_in, rows_out,
            CAST(rows_in AS DOUBLE) / nullif(CAST(rows_out AS DOUBLE), 0) AS ratio
        FROM sizes, total
    """,
    "repo_owners_gt1": _repos(_OWNERS_GT1),
    "repo_owner_activity": _raw(_OWNER_ACTIVITY),
    "repo_owner_total": _raw(
        f"SELECT count(DISTINCT repo_author) AS total_owners FROM ({_OWNER_ACTIVITY})"
    ),
    "repos_per_owner": _raw(
        "SELECT repo_author, count(DISTINCT repo_name) AS total_repo_name "
        "FROM named GROUP BY repo_author"
    ),
    "repos_of_owner": _raw(
        "SELECT DISTINCT repo_name_full FROM named WHERE repo_author = 'owner7'"
    ),
    "repos_daily_rows": _repos(_DAILY.format(fact="repos")),
    "top_repo_owners": _repos(f"{_OWNERS_GT1} ORDER BY repos_total DESC, repo_author LIMIT 100"),
    "commits_ge2_per_day": _commits(_PER_DAY.format(having=">= 2")),
    "commits_gt1_from_raw": _commits(_PER_DAY.format(having="> 1")),
    "commits_le1_per_day": _commits(_PER_DAY.format(having="<= 1")),
    "commit_day_span": _commits(
        "SELECT CAST(min(created_at) AS DATE) AS min_created_at, "
        "CAST(max(created_at) AS DATE) AS max_created_at FROM commits"
    ),
    "commits_hourly": _commits(_HOURLY.format(fact="commits")),
    "commits_daily": _commits(_DAILY.format(fact="commits")),
    "running_commits_per_day": _commits(
        "SELECT author_name, created_at, date, CAST(sum(1) OVER "
        "(PARTITION BY author_name, date ORDER BY created_at) AS BIGINT) AS sum_commits FROM commits"
    ),
    "inactive_days": f"WITH {_ACTIVITY}{_COMMITS}{_IDLE} SELECT * FROM idle",
    "top_commit_days": _commits(
        _PER_DAY.format(having=">= 2") + "ORDER BY author_name NULLS FIRST, total_commits DESC, date LIMIT 100"
    ),
    "top_inactive_days": f"""
        WITH {_ACTIVITY}{_COMMITS}{_IDLE}
        SELECT * FROM idle ORDER BY author_name, interval_start_dt LIMIT 100
    """,
    "projects_gt10_members": _members(_PROJECTS),
    "projects_gt10_total": _members(
        f"SELECT count(repo_name_full) AS total_projects FROM ({_PROJECTS})"
    ),
    "members_per_repo": _members(
        "SELECT repo_name_full, count(DISTINCT member_login) AS total_member_logins "
        "FROM added GROUP BY repo_name_full"
    ),
    "members_per_repo_hour": _members(
        "SELECT date, CAST(hour(created_at) AS INTEGER) AS hour, repo_name_full, "
        "count(DISTINCT member_login) AS total_member_logins FROM added GROUP BY ALL"
    ),
    "members_hourly": _members(_HOURLY.format(fact="members")),
    "members_daily": _members(_DAILY.format(fact="members")),
    "member_listing_sorted": _raw(
        "SELECT date, hour, created_at, repo_name_full, member_login AS member_name "
        "FROM activity WHERE type = 'MemberEvent' AND action = 'added'"
    ),
    "top_projects": _members(
        f"{_PROJECTS} ORDER BY total_members DESC, repo_name NULLS FIRST, repo_name_full LIMIT 100"
    ),
    "activity_count": _raw("SELECT count(*) AS total_events FROM activity"),
    "event_span": _raw(
        "SELECT min(created_at) AS min_created_at, max(created_at) AS max_created_at FROM activity"
    ),
    "events_per_hour": _raw("SELECT hour, count(*) AS total_events FROM activity GROUP BY hour"),
    "events_per_type": _raw("SELECT type, count(*) AS total_events FROM activity GROUP BY type"),
    "events_per_repo": _raw(
        "SELECT repo_name_full, count(*) AS total_events FROM activity GROUP BY repo_name_full"
    ),
    "missing_hours": f"""
        WITH {_ACTIVITY},
        seen AS (SELECT DISTINCT date, hour FROM activity WHERE date IS NOT NULL),
        spine AS (
            SELECT CAST(t.d AS DATE) AS date, CAST(hour(t.d) AS INTEGER) AS hour
            FROM (SELECT min(date) AS lo, max(date) AS hi FROM seen) AS s,
                generate_series(
                    CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP) + INTERVAL 23 HOUR,
                    INTERVAL 1 HOUR) AS t(d)
        )
        SELECT date, hour, CAST(date AS VARCHAR) || '-' || hour || '.json.gz' AS file_name
        FROM spine ANTI JOIN seen USING (date, hour)
    """,
    "stream_hourly_counts": _raw(
        "SELECT date, hour, type, count(*) AS total_events FROM activity "
        "WHERE event_ts IS NOT NULL GROUP BY ALL"
    ),
    "stream_repos": _repos("SELECT * FROM repos"),
    "repo_columns": _raw(
        "SELECT CAST(e AS VARCHAR) AS id, repo_name_full, repo_author, repo_name FROM named"
    ),
    "actor_repo_listing": _raw(
        "SELECT 'u' || u AS actor_display_login, u AS actor_id, 'u' || u AS actor_login, "
        "repo_id, repo_name_full, type FROM activity"
    ),
    "push_details": _raw(
        """
        SELECT
            CASE WHEN type = 'PushEvent' AND e % 61 <> 3 THEN array_to_string(
                [x FOR x IN [
                    CASE WHEN e % 4 > 0 AND e % 59 <> 0 THEN 'dev' || ((u * 7 + e) % 1000) END,
                    CASE WHEN e % 4 > 1 AND (e + 1) % 59 <> 0 THEN 'dev' || ((u * 7 + e + 13) % 1000) END,
                    CASE WHEN e % 4 > 2 AND (e + 2) % 59 <> 0 THEN 'dev' || ((u * 7 + e + 26) % 1000) END
                ] IF x IS NOT NULL], ',') END AS author_names,
            ref, ref_type, review, type
        FROM activity
        """
    ),
    "repo_org_listing": _raw(
        "SELECT repo_name_full, org_id, org_login, action, type FROM activity"
    ),
    "events_with_member": _raw(
        "SELECT type, member_id, member_login, member_type FROM activity "
        "WHERE member_login IS NOT NULL"
    ),
    "member_details": _raw(
        "SELECT created_at, member_id, member_login, member_type, action, org_login, "
        "'u' || u AS actor_login, repo_name_full, type FROM activity WHERE type = 'MemberEvent'"
    ),
}
