"""Plain projections and filters of raw activity."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.functions.columns import with_repo_columns


def repo_columns(activity: DataFrame) -> DataFrame:
    """Each event's repository name and its two parts."""
    return with_repo_columns(activity).select(
        "id", F.col("repo.name").alias("repo_name_full"), "repo_author", "repo_name"
    )


def actor_repo_listing(activity: DataFrame) -> DataFrame:
    return activity.select(
        F.col("actor.display_login").alias("actor_display_login"),
        F.col("actor.id").alias("actor_id"),
        F.col("actor.login").alias("actor_login"),
        F.col("repo.id").alias("repo_id"),
        F.col("repo.name").alias("repo_name_full"),
        "type",
    )


def push_details(activity: DataFrame) -> DataFrame:
    """Commit authors, branch fields and review of each event."""
    return activity.select(
        F.col("payload.commits.author").alias("authors"),
        F.col("payload.commits.author.name").alias("author_names"),
        F.col("payload.ref").alias("ref"),
        F.col("payload.ref_type").alias("ref_type"),
        F.col("payload.review").alias("review"),
        "type",
    )


def repo_org_listing(activity: DataFrame) -> DataFrame:
    return activity.select(
        F.col("repo.name").alias("repo_name_full"),
        F.col("org.id").alias("org_id"),
        F.col("org.login").alias("org_login"),
        F.col("payload.action").alias("action"),
        "type",
    )


def events_with_member(activity: DataFrame) -> DataFrame:
    """Events that carry a member, whatever their type."""
    return activity.where(F.col("payload.member").isNotNull()).select(
        "type", F.col("payload.member").alias("member")
    )


def member_details(activity: DataFrame) -> DataFrame:
    """Member events of all actions."""
    return activity.where(F.col("type") == "MemberEvent").select(
        "created_at",
        F.col("payload.member").alias("member"),
        F.col("payload.member.id").alias("member_id"),
        F.col("payload.member.login").alias("member_login"),
        F.col("payload.member.type").alias("member_type"),
        F.col("payload.action").alias("action"),
        F.col("org.login").alias("org_login"),
        F.col("actor.login").alias("actor_login"),
        F.col("repo.name").alias("repo_name_full"),
        "type",
    )
