"""Repository owners."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.functions.columns import with_repo_columns


def repo_owners_gt1(repos: DataFrame) -> DataFrame:
    """Owners of more than one repository, most repositories first.

    The owner's name breaks ties: the order is total, and the many owners of
    exactly two repositories spread over the partitions of the sort.
    """
    return (
        repos.groupBy("repo_author")
        .agg(F.countDistinct("repo_name").alias("repos_total"))
        .where("repos_total > 1")
        .orderBy(F.desc("repos_total"), "repo_author")
    )


def repo_owner_activity(activity: DataFrame) -> DataFrame:
    """As ``repo_owners_gt1`` from raw events, with the owner's event total."""
    return (
        with_repo_columns(activity)
        .groupBy("repo_author")
        .agg(
            F.count("repo_name").alias("total_repo_events"),
            F.countDistinct("repo_name").alias("total_repos"),
        )
        .where("total_repos > 1")
        .orderBy(F.desc("total_repos"), "repo_author")
    )


def repo_owner_total(activity: DataFrame) -> DataFrame:
    """How many owners ``repo_owner_activity`` has.

    Owners are unique there, so a plain count needs no second distinct step.
    """
    return repo_owner_activity(activity).agg(F.count("repo_author").alias("total_owners"))


def repos_per_owner(activity: DataFrame) -> DataFrame:
    return (
        with_repo_columns(activity)
        .groupBy("repo_author")
        .agg(F.countDistinct("repo_name").alias("total_repo_name"))
        .orderBy(F.desc("total_repo_name"), "repo_author")
    )


def repos_of_owner(activity: DataFrame, owner: str) -> DataFrame:
    """Distinct full names of one owner's repositories."""
    return (
        with_repo_columns(activity)
        .where(F.col("repo_author") == owner)
        .select(F.col("repo.name").alias("repo_name_full"))
        .distinct()
    )


def repos_daily_rows(repos: DataFrame) -> DataFrame:
    """Fact rows, not events, per day, newest first."""
    return repos.groupBy("date").agg(F.count(F.lit(1)).alias("total")).orderBy(F.desc("date"))
