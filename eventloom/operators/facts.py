"""Builders of the three fact tables from raw activity.

Events without a usable time have no day and enter no fact; ``rejects`` holds
them. ``carry`` names extra columns to keep, such as ``source_date``.

Each builder picks its nested fields before it adds the time: the time is used
more than once, so Spark keeps it in a projection of its own, and struct columns
passing through that projection would be read from Parquet as a whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.functions.columns import with_event_time, with_repo_columns


def is_push() -> Column:
    return F.col("type") == "PushEvent"


def is_member_added() -> Column:
    return (F.col("type") == "MemberEvent") & (F.col("payload.action") == "added")


def _timed(events: DataFrame) -> DataFrame:
    return with_event_time(events).where(F.col("event_ts").isNotNull())


def _time_columns(activity: DataFrame) -> list[str]:
    """What ``with_event_time`` needs of a raw frame, or made of it before."""
    made = ["event_ts", "date", "hour"]
    return made if set(made) <= set(activity.columns) else ["created_at"]


def rejects(activity: DataFrame) -> DataFrame:
    """Raw events whose ``created_at`` is missing, malformed or without a zone."""
    return with_event_time(activity).where(F.col("event_ts").isNull()).select(activity.columns)


def build_repos(activity: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """Events per (date, hour, repository)."""
    return (
        _timed(with_repo_columns(activity))
        .groupBy(*carry, "date", "hour", "repo_author", "repo_name")
        .agg(F.count(F.lit(1)).alias("total_events"))
    )


def merge_repos(parts: DataFrame) -> DataFrame:
    """One row per (date, hour, repository) from rollups of separate inputs.

    Needed where one hour's events lie in files of two days or in two stream
    batches, each rolled up alone.
    """
    return parts.groupBy("date", "hour", "repo_author", "repo_name").agg(
        F.sum("total_events").alias("total_events")
    )


def build_commits(activity: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per commit of a push; the time is that of the push."""
    pushes = activity.where(is_push()).select(
        *carry,
        *_time_columns(activity),
        F.col("payload.commits.author.name").alias("author_names"),
    )
    return _timed(pushes).select(
        *carry,
        "date",
        F.col("event_ts").alias("created_at"),
        F.explode("author_names").alias("author_name"),
    )


def build_members(activity: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per member added to a repository."""
    added = with_repo_columns(activity.where(is_member_added())).select(
        *carry,
        *_time_columns(activity),
        F.col("payload.member.login").alias("member_login"),
        F.col("payload.member.type").alias("member_type"),
        F.col("org.login").alias("org_login"),
        F.col("actor.login").alias("actor_login"),
        F.col("repo.name").alias("repo_name_full"),
        "repo_name",
        "repo_author",
    )
    return _timed(added).select(
        *carry,
        "date",
        F.col("event_ts").alias("created_at"),
        "member_login",
        "member_type",
        "org_login",
        "actor_login",
        "repo_name_full",
        "repo_name",
        "repo_author",
    )


BUILDERS = {"repos": build_repos, "commits": build_commits, "members": build_members}


def reduction_ratio(activity: DataFrame) -> DataFrame:
    """Rows in, rows out and their ratio for each fact, in one pass.

    Events are grouped as for ``repos``, so each group is one row of that fact
    and carries its events' shares of the other two.
    """
    events = with_repo_columns(activity).select(
        *_time_columns(activity),
        "repo_author",
        "repo_name",
        F.when(is_push(), F.greatest(F.size("payload.commits"), F.lit(0))).alias("commits"),
        is_member_added().alias("added"),
    )
    timed = F.col("event_ts").isNotNull()
    groups = (
        with_event_time(events)
        .groupBy("date", "hour", "repo_author", "repo_name")
        .agg(
            F.count(F.lit(1)).alias("events"),
            F.max(timed).alias("timed"),
            F.sum(F.when(timed, F.col("commits"))).alias("commits"),
            F.count_if(timed & F.col("added")).alias("members"),
        )
    )
    totals = groups.agg(
        F.coalesce(F.sum("events"), F.lit(0)).alias("rows_in"),
        F.count_if("timed").alias("repos"),
        F.coalesce(F.sum("commits"), F.lit(0)).alias("commits"),
        F.coalesce(F.sum("members"), F.lit(0)).alias("members"),
    )
    per_fact = F.array(
        *[F.struct(F.lit(n).alias("fact"), F.col(n).alias("rows_out")) for n in BUILDERS]
    )
    return totals.select("rows_in", F.inline(per_fact)).select(
        "fact",
        "rows_in",
        "rows_out",
        (F.col("rows_in").cast("double") / F.nullif("rows_out", F.lit(0))).alias("ratio"),
    )
