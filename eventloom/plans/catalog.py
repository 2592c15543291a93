"""Named queries over the ``events`` test table, as nested activity.

Nested results are flattened here so that any SQL engine can repeat them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.operators import commits, facts, listings, members, owners, profile, rollups
from eventloom.sources.fixture import read_events_activity
from eventloom.streaming import live

TOP = 100
OWNER = "owner7"


def _activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_events_activity(spark, sf_dir)


def _on_activity(query: Callable[[DataFrame], DataFrame]):
    return lambda spark, sf_dir: query(_activity(spark, sf_dir))


def _on_fact(name: str, query: Callable[[DataFrame], DataFrame] = lambda fact: fact):
    return lambda spark, sf_dir: query(facts.BUILDERS[name](_activity(spark, sf_dir)))


def _push_details(activity: DataFrame) -> DataFrame:
    names = F.array_join("author_names", ",").alias("author_names")
    return listings.push_details(activity).select(names, "ref", "ref_type", "review", "type")


def _events_with_member(activity: DataFrame) -> DataFrame:
    return listings.events_with_member(activity).select(
        "type",
        F.col("member.id").alias("member_id"),
        F.col("member.login").alias("member_login"),
        F.col("member.type").alias("member_type"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    # fact tables
    "repos_hourly": _on_fact("repos"),
    "commits_fact": _on_fact("commits"),
    "members_fact": _on_fact("members"),
    "reduction_ratio": _on_activity(facts.reduction_ratio),
    # owners
    "repo_owners_gt1": _on_fact("repos", owners.repo_owners_gt1),
    "repo_owner_activity": _on_activity(owners.repo_owner_activity),
    "repo_owner_total": _on_activity(owners.repo_owner_total),
    "repos_per_owner": _on_activity(owners.repos_per_owner),
    "repos_of_owner": _on_activity(lambda a: owners.repos_of_owner(a, OWNER)),
    "repos_daily_rows": _on_fact("repos", owners.repos_daily_rows),
    "top_repo_owners": _on_fact(
        "repos", lambda r: rollups.with_limit(owners.repo_owners_gt1(r), TOP)
    ),
    # commits
    "commits_ge2_per_day": _on_fact("commits", commits.commits_ge2_per_day),
    "commits_gt1_from_raw": _on_activity(commits.commits_gt1_from_raw),
    "commits_le1_per_day": _on_activity(commits.commits_le1_per_day),
    "commit_day_span": _on_fact("commits", commits.commit_day_span),
    "commits_hourly": _on_fact("commits", commits.commits_hourly),
    "commits_daily": _on_fact("commits", lambda c: rollups.daily(commits.commits_hourly(c))),
    "running_commits_per_day": _on_fact("commits", commits.running_commits_per_day),
    "inactive_days": _on_fact("commits", commits.inactive_days),
    "top_commit_days": _on_fact(
        "commits", lambda c: rollups.with_limit(commits.commits_ge2_per_day(c), TOP)
    ),
    "top_inactive_days": _on_fact("commits", lambda c: commits.top_inactive_days(c, TOP)),
    # members
    "projects_gt10_members": _on_fact("members", members.projects_gt10_members),
    "projects_gt10_total": _on_fact("members", members.projects_gt10_total),
    "members_per_repo": _on_activity(members.members_per_repo),
    "members_per_repo_hour": _on_activity(members.members_per_repo_hour),
    "members_hourly": _on_fact("members", members.members_hourly),
    "members_daily": _on_fact("members", lambda m: rollups.daily(members.members_hourly(m))),
    "member_listing_sorted": _on_activity(members.member_listing_sorted),
    "top_projects": _on_fact(
        "members", lambda m: rollups.with_limit(members.projects_gt10_members(m), TOP)
    ),
    # raw activity
    "activity_count": _on_activity(profile.activity_count),
    "event_span": _on_activity(profile.event_span),
    "events_per_hour": _on_activity(profile.events_per_hour),
    "events_per_type": _on_activity(profile.events_per_type),
    "events_per_repo": _on_activity(profile.events_per_repo),
    "missing_hours": _on_activity(profile.missing_hours),
    # stream operators over all events at once: a finished stream whose hours are all closed
    "stream_hourly_counts": _on_activity(live.stream_hourly_counts),
    "stream_repos": _on_activity(live.stream_repos),
    "repo_columns": _on_activity(listings.repo_columns),
    "actor_repo_listing": _on_activity(listings.actor_repo_listing),
    "push_details": _on_activity(_push_details),
    "repo_org_listing": _on_activity(listings.repo_org_listing),
    "events_with_member": _on_activity(_events_with_member),
    "member_details": _on_activity(lambda a: listings.member_details(a).drop("member")),
}
