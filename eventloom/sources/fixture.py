"""Nested activity derived from the flat ``events`` test table.

The rules are deterministic and stated in FIXTURES.md, so another engine can
repeat them on the flat table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_EVENTS = (
    "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
)
_IS_PUSH = "event_type IN ('click', 'purchase')"
_IS_MEMBER = "event_type = 'signup'"


def _commit(i: int) -> str:
    name = f"CASE WHEN (event_id + {i}) % 59 <> 0 THEN concat('dev', (user_id * 7 + event_id + {i * 13}) % 1000) END"
    return f"named_struct('author', named_struct('name', {name}))"


def _time(shift: str, zone: str) -> str:
    # From text: date_format would pass through the session time zone.
    return f"concat(substring(replace(CAST(ts {shift} AS STRING), ' ', 'T'), 1, 19), '{zone}')"


_ACTIVITY = {
    "id": "CAST(event_id AS STRING)",
    "type": f"""
        CASE WHEN {_IS_PUSH} THEN 'PushEvent'
             WHEN {_IS_MEMBER} THEN 'MemberEvent'
             WHEN event_type = 'view' THEN 'WatchEvent'
             WHEN event_type = 'error' THEN 'IssuesEvent' END""",
    "created_at": f"""
        CASE WHEN event_id % 301 = 11 THEN {_time("", "")}
             WHEN event_id % 301 = 12 THEN NULL
             WHEN event_id % 41 = 7 THEN {_time("+ INTERVAL '2' HOUR", "+02:00")}
             WHEN event_id % 41 = 9 THEN {_time("- INTERVAL '05:30' HOUR TO MINUTE", "-0530")}
             ELSE {_time("", "Z")} END""",
    "actor": """
        named_struct('id', user_id,
                     'login', concat('u', user_id),
                     'display_login', concat('u', user_id))""",
    "org": """
        CASE WHEN event_id % 3 <> 0
             THEN named_struct('id', event_id % 7, 'login', concat('org', event_id % 7)) END""",
    "repo": """
        named_struct(
            'id', (event_id div 2) % 185,
            'name', CASE
                WHEN event_id % 97 = 0 THEN 'noslash'
                WHEN event_id % 89 = 0 THEN 'owner1/'
                WHEN event_id % 83 = 0 THEN 'owner2/repo1/extra'
                WHEN event_id % 10 = 0 THEN 'owner0/repo0'
                WHEN (event_id div 4) % 37 < 5
                    THEN concat('owner', (event_id div 4) % 37, '/repo0')
                ELSE concat('owner', (event_id div 4) % 37, '/repo', (event_id div 2) % 5) END)""",
    "payload": f"""
        named_struct(
            'action', CASE WHEN {_IS_MEMBER} THEN if(event_id % 6 = 0, 'removed', 'added') END,
            'member', CASE WHEN {_IS_MEMBER} THEN named_struct(
                'id', user_id, 'login', concat('m', user_id), 'type', 'User') END,
            'commits', CASE WHEN {_IS_PUSH} AND event_id % 61 <> 3 THEN
                slice(array({_commit(0)}, {_commit(1)}, {_commit(2)}),
                      1, CAST(event_id % 4 AS INT)) END,
            'ref', CASE WHEN {_IS_PUSH} THEN concat('refs/heads/b', event_id % 3) END,
            'ref_type', CASE WHEN event_id % 5 = 0 THEN 'branch' WHEN event_id % 5 = 1 THEN 'tag' END,
            'review', CASE WHEN event_type = 'error' THEN concat('state', event_id % 2) END)""",
}


def activity_from_events(events: DataFrame) -> DataFrame:
    return events.selectExpr(*[f"{sql} AS {name}" for name, sql in _ACTIVITY.items()])


def read_events_activity(spark: SparkSession, folder: str) -> DataFrame:
    """Activity from ``events.parquet``; the stated schema saves a look at its footers."""
    return activity_from_events(spark.read.schema(_EVENTS).parquet(f"{folder}/events.parquet"))
