"""Members added to projects."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.functions.columns import with_event_time
from eventloom.operators.facts import is_member_added
from eventloom.operators.rollups import hourly


def projects_gt10_members(members: DataFrame) -> DataFrame:
    """Projects with more than ten distinct added members, largest first."""
    return (
        members.groupBy("repo_name", "repo_name_full")
        .agg(F.countDistinct("member_login").alias("total_members"))
        .where("total_members > 10")
        .orderBy(F.desc("total_members"), "repo_name", "repo_name_full")
    )


def projects_gt10_total(members: DataFrame) -> DataFrame:
    """How many such projects there are."""
    return projects_gt10_members(members).agg(F.count("repo_name_full").alias("total_projects"))


def members_hourly(members: DataFrame) -> DataFrame:
    return hourly(members)


def _added(activity: DataFrame) -> DataFrame:
    return activity.where(is_member_added()).withColumns(
        {"repo_name_full": F.col("repo.name"), "member_login": F.col("payload.member.login")}
    )


def members_per_repo(activity: DataFrame) -> DataFrame:
    return (
        _added(activity)
        .groupBy("repo_name_full")
        .agg(F.countDistinct("member_login").alias("total_member_logins"))
        .orderBy(F.desc("total_member_logins"), "repo_name_full")
    )


def members_per_repo_hour(activity: DataFrame) -> DataFrame:
    return (
        with_event_time(_added(activity))
        .groupBy("date", "hour", "repo_name_full")
        .agg(F.countDistinct("member_login").alias("total_member_logins"))
        .orderBy(F.desc("total_member_logins"), "date", "hour", "repo_name_full")
    )


def member_listing_sorted(activity: DataFrame) -> DataFrame:
    """All added members in order of time, repository and member.

    A global sort reads its input twice, once to sample the sort keys. The few
    member rows are shuffled first, so that the raw files are read only once.
    """
    return (
        with_event_time(_added(activity))
        .select(
            "date",
            "hour",
            "created_at",
            "repo_name_full",
            F.col("member_login").alias("member_name"),
        )
        .hint("rebalance")
        .orderBy("date", "hour", "created_at", "repo_name_full", "member_name")
    )
