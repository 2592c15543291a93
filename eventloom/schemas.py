"""Explicit schemas of the raw event files and of the three fact tables.

Nothing is inferred: an hour without a single member event still has
``payload.member`` (as NULL), and the files are parsed once instead of twice.
"""

from __future__ import annotations

from pyspark.sql import types as T


TEXT, LONG, INT, DAY, TIME = (
    T.StringType(), T.LongType(), T.IntegerType(), T.DateType(), T.TimestampNTZType()
)


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


_COMMIT_LIST = T.ArrayType(_struct(author=_struct(name=TEXT)))
_LOGIN = _struct(login=TEXT)

# Every field any operator reads. ``created_at`` stays text; see functions.columns.
ACTIVITY = _struct(
    id=TEXT,
    type=TEXT,
    created_at=TEXT,
    actor=_struct(id=LONG, login=TEXT, display_login=TEXT),
    org=_struct(id=LONG, login=TEXT),
    repo=_struct(id=LONG, name=TEXT),
    payload=_struct(
        action=TEXT,
        member=_struct(id=LONG, login=TEXT, type=TEXT),
        commits=_COMMIT_LIST,
        ref=TEXT,
        ref_type=TEXT,
        review=TEXT,
    ),
)

# The JSON reader prunes top-level columns only, so jobs that build facts ask
# for just the leaves they need.
_REPOS_INPUT = _struct(created_at=TEXT, repo=_struct(name=TEXT))
_COMMITS_INPUT = _struct(type=TEXT, created_at=TEXT, payload=_struct(commits=_COMMIT_LIST))
_MEMBERS_INPUT = _struct(
    type=TEXT,
    created_at=TEXT,
    actor=_LOGIN,
    org=_LOGIN,
    repo=_struct(name=TEXT),
    payload=_struct(action=TEXT, member=_struct(login=TEXT, type=TEXT)),
)
_FACT_INPUT = _struct(
    type=TEXT,
    created_at=TEXT,
    actor=_LOGIN,
    org=_LOGIN,
    repo=_struct(name=TEXT),
    payload=_struct(action=TEXT, member=_struct(login=TEXT, type=TEXT), commits=_COMMIT_LIST),
)

REPOS = _struct(date=DAY, hour=INT, repo_author=TEXT, repo_name=TEXT, total_events=LONG)
COMMITS = _struct(date=DAY, created_at=TIME, author_name=TEXT)
MEMBERS = _struct(
    date=DAY,
    created_at=TIME,
    member_login=TEXT,
    member_type=TEXT,
    org_login=TEXT,
    actor_login=TEXT,
    repo_name_full=TEXT,
    repo_name=TEXT,
    repo_author=TEXT,
)

FACTS = {"repos": REPOS, "commits": COMMITS, "members": MEMBERS}

# Day of the file a row came from, and what wrote it: the outer and the inner storage partition.
SOURCE_DATE = "source_date"
BATCH = "batch"

# Name of the hourly file a row came from, and the partition of live counts.
SOURCE_FILE = "source_file"


def input_schema(facts) -> T.StructType:
    """The narrowest file schema from which all of ``facts`` can be built."""
    facts = set(facts)
    if unknown := facts - FACTS.keys():
        raise ValueError(f"unknown facts: {sorted(unknown)}")
    single = {"repos": _REPOS_INPUT, "commits": _COMMITS_INPUT, "members": _MEMBERS_INPUT}
    return single[facts.pop()] if len(facts) == 1 else _FACT_INPUT
