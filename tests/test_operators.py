"""Operators on hand-written rows, and identities between results."""

from __future__ import annotations

import datetime as dt
from collections import Counter
from itertools import groupby

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from eventloom import schemas
from eventloom.functions import with_event_time, with_repo_columns
from eventloom.operators import commits as commit_ops
from eventloom.operators import facts, listings, members, owners, profile, rollups
from eventloom.sources import activity_from_events
from tests.conftest import TESTDATA

DAY = dt.date(2024, 1, 1)


def event(kind, at, repo="ann/tools", authors=None, action=None, login=None, org=None):
    member = None if login is None else (2, login, "User")
    commits = None if authors is None else [((a,),) for a in authors]
    return ("1", kind, at, (1, "ann", "ann"), org, (9, repo), (action, member, commits, None, None, None))


def activity(spark, *events):
    return spark.createDataFrame(list(events), schemas.ACTIVITY)


def commits_of(spark, rows):
    """Rows of (author, day number, second of the day)."""
    midnight = dt.datetime.combine(DAY, dt.time())
    return spark.createDataFrame(
        [(DAY + dt.timedelta(days=d), midnight + dt.timedelta(days=d, seconds=s), a) for a, d, s in rows],
        schemas.COMMITS,
    )


def rows(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_repository_names(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        names = ["a/b", "noslash", "a/b/c", "a/", None]
        frame = activity(spark, *[event("X", None, repo=n) for n in names])
        got = with_repo_columns(frame).select("repo_author", "repo_name").collect()
        assert [tuple(r) for r in got] == [
            ("a", "b"), ("noslash", None), ("a", "b"), ("a", ""), (None, None)]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_day_and_hour_do_not_depend_on_the_session_zone(spark, zone):
    frame = activity(spark, event("X", "2024-01-01T23:59:59Z"), event("X", "2024-01-02T00:00:00Z"),
                     event("X", "2024-03-10T02:30:00Z"))
    got = with_event_time(frame).select("event_ts", "date", "hour").collect()
    assert [tuple(r) for r in got] == [
        (dt.datetime(2024, 1, 1, 23, 59, 59), dt.date(2024, 1, 1), 23),
        (dt.datetime(2024, 1, 2), dt.date(2024, 1, 2), 0),
        (dt.datetime(2024, 3, 10, 2, 30), dt.date(2024, 3, 10), 2)]


def test_times_with_an_offset_are_told_in_utc(spark, zone):
    times = {"2024-01-02T01:00:00+02:00": (2024, 1, 1, 23), "2024-01-01T20:30:00-0330": (2024, 1, 2, 0),
             "2024-03-10T02:30:00+00:00": (2024, 3, 10, 2), "2024-03-31T03:30:00+0200": (2024, 3, 31, 1)}
    frame = activity(spark, *[event("PushEvent", t, authors=["a"]) for t in times])
    got = {r.created_at: r for r in with_event_time(frame).collect()}
    for text, (y, m, d, h) in times.items():
        assert (got[text].date, got[text].hour) == (dt.date(y, m, d), h)
        assert got[text].event_ts == dt.datetime(y, m, d, h, 0 if text.endswith("+02:00") or text.endswith("0330") else 30)
    assert facts.build_commits(frame).count() == 4 and facts.rejects(frame).count() == 0


def test_activity_with_one_time_column_only(spark):
    frame = activity(spark, event("PushEvent", "2024-01-01T00:00:00Z", authors=["a"])).withColumn("date", F.lit("2023-01-01").cast("date"))
    for build in facts.BUILDERS.values():
        assert {r.date for r in build(frame).collect()} <= {DAY}


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_unusable_times_are_rejects_and_enter_no_fact(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        bad = ["not-a-time", "2024-01-01T00:00:00+99:00", "2024-01-01T00:00:00", None, "Z", "2024-01-01T00:00+"]
        frame = activity(spark, event("PushEvent", "2024-01-01T00:00:00Z", authors=["a"]),
                         *[event("PushEvent", b, authors=["a"]) for b in bad])
        assert facts.rejects(frame).count() == len(bad)
        assert facts.build_commits(frame).count() == 1
        assert facts.build_repos(frame).collect()[0].total_events == 1
        out = {r.fact: (r.rows_in, r.rows_out) for r in facts.reduction_ratio(frame).collect()}
        assert out == {"repos": (7, 1), "commits": (7, 1), "members": (7, 0)}
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_commits_are_exploded_from_pushes_only(spark):
    at = "2024-01-01T00:00:00Z"
    frame = activity(spark, event("PushEvent", at, authors=["a", "a", None]), event("PushEvent", at, authors=[]),
                     event("PushEvent", at), event("WatchEvent", at, authors=["b"]))
    got = facts.build_commits(frame)
    assert got.schema.names == schemas.COMMITS.names
    assert [r.author_name for r in got.orderBy("author_name").collect()] == [None, "a", "a"]


def test_members_are_added_ones_and_org_may_be_missing(spark):
    at = "2024-01-01T00:00:00Z"
    frame = activity(spark, event("MemberEvent", at, action="added", login="bob"),
                     event("MemberEvent", at, action="added", login="cy", org=(5, "acme")),
                     event("MemberEvent", at, action="removed", login="dee"))
    got = facts.build_members(frame)
    assert {(r.member_login, r.org_login) for r in got.collect()} == {("bob", None), ("cy", "acme")}
    assert members.members_per_repo(frame).collect()[0].total_member_logins == 2
    assert listings.events_with_member(frame).count() == 3
    assert listings.member_details(frame).count() == 3


def test_nameless_repositories_are_a_group_but_not_a_repository(spark):
    at = "2024-01-01T00:00:00Z"
    frame = activity(spark, event("X", at, repo="solo"), event("X", at, repo="solo"), event("X", at, repo="solo/one"))
    repos = facts.build_repos(frame)
    assert repos.count() == 2
    assert owners.repo_owners_gt1(repos).count() == 0
    assert [tuple(r) for r in owners.repos_per_owner(frame).collect()] == [("solo", 1)]


def brute_facts(events):
    """The three facts by plain loops."""
    repos, commits, added = Counter(), Counter(), Counter()
    for _, kind, at, actor, org, repo, payload in events:
        try:
            time = dt.datetime.strptime(at or "", "%Y-%m-%dT%H:%M:%S%z").astimezone(dt.UTC).replace(tzinfo=None)
        except ValueError:
            continue
        name = repo[1]
        parts = (name or "").split("/")
        owner = None if name is None else parts[0]
        short = parts[1] if len(parts) > 1 else None
        repos[time.date(), time.hour, owner, short] += 1
        if kind == "PushEvent":
            for (author,) in payload[2] or []:
                commits[time.date(), time, author[0]] += 1
        if kind == "MemberEvent" and payload[0] == "added":
            member = payload[1] or (None, None, None)
            added[time.date(), time, member[1], member[2], org and org[1], actor[1], name, short, owner] += 1
    return Counter({(*key, n): 1 for key, n in repos.items()}), commits, added


EVENTS = st.builds(
    event,
    st.sampled_from(["PushEvent", "MemberEvent", "WatchEvent"]),
    st.sampled_from(["2024-01-01T00:00:00Z", "2024-01-01T23:59:59Z", "2024-01-02T00:00:00Z", "bad",
                     "2024-01-01T00:00:00+01:00", "2024-01-01T22:30:00-0330", "2024-01-02T00:00:00", None]),
    st.sampled_from(["a/x", "a/y", "b/x", "a", "a/x/z", "/x", "a/", None]),
    st.none() | st.lists(st.sampled_from(["Ann", "Bo", None]), max_size=3),
    st.sampled_from(["added", "removed", None]),
    st.sampled_from(["m1", "m2", None]),
    st.sampled_from([(1, "org"), None]),
)


@settings(max_examples=6, derandomize=True, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(EVENTS, min_size=1, max_size=20))
def test_facts_against_brute_force(spark, events):
    frame = activity(spark, *events).coalesce(1)
    want = brute_facts(events)
    for (name, build), expected in zip(facts.BUILDERS.items(), want, strict=True):
        assert rows(build(frame).select(*schemas.FACTS[name].fieldNames())) == expected, name
    sizes = {r.fact: r.rows_out for r in facts.reduction_ratio(frame).collect()}
    assert sizes == {name: sum(c.values()) for name, c in zip(facts.BUILDERS, want, strict=True)}


def test_ties_are_broken_by_name(spark):
    repos = spark.createDataFrame(
        [(a, r) for a in "zyxw" for r in "12"] + [("many", r) for r in "123"], "repo_author string, repo_name string")
    got = [r.repo_author for r in owners.repo_owners_gt1(repos).collect()]
    assert got == ["many", "w", "x", "y", "z"]
    assert [r.repo_author for r in rollups.with_limit(owners.repo_owners_gt1(repos), 2).collect()] == ["many", "w"]
    assert rollups.with_limit(owners.repo_owners_gt1(repos), 0).count() == 5


def test_commits_of_one_instant_share_the_running_count(spark):
    got = commit_ops.running_commits_per_day(
        commits_of(spark, [("a", 0, 5), ("a", 0, 5), ("a", 0, 9), ("a", 1, 0), ("b", 0, 5)]))
    assert sorted((r.author_name, r.date.day, r.created_at.second, r.sum_commits) for r in got.collect()) == [
        ("a", 1, 5, 2), ("a", 1, 5, 2), ("a", 1, 9, 3), ("a", 2, 0, 1), ("b", 1, 5, 1)]


def test_instants_within_a_second_are_apart(spark):
    at = dt.datetime.combine(DAY, dt.time())
    frame = spark.createDataFrame([(DAY, at + dt.timedelta(microseconds=m), "a") for m in (5, 1, 5, 9)], schemas.COMMITS)
    got = sorted((r.created_at.microsecond, r.sum_commits) for r in commit_ops.running_commits_per_day(frame).collect())
    assert got == [(1, 1), (5, 3), (5, 3), (9, 4)]


def test_running_count_keeps_every_commit_of_a_crowded_instant(spark, monkeypatch):
    monkeypatch.setattr(commit_ops, "_EXPAND_AT_ONCE", 3)
    sizes = {0: 1, 1: 2, 2: 3, 3: 4, 4: 6, 5: 7, 6: 10}
    got = commit_ops.running_commits_per_day(
        commits_of(spark, [("bot", 0, s) for s, n in sizes.items() for _ in range(n)]))
    total, want = 0, Counter()
    for s, n in sizes.items():
        total += n
        want[s, total] = n
    assert Counter((r.created_at.second, r.sum_commits) for r in got.collect()) == want


def brute_inactive(commit_rows):
    days = [d for _, d, _ in commit_rows]
    authors = {a for a, _, _ in commit_rows if a is not None}
    active = {(a, d) for a, d, _ in commit_rows}
    return sorted((a, DAY + dt.timedelta(days=d)) for a in authors
                  for d in range(min(days), max(days) + 1) if (a, d) not in active)


def test_inactive_days_by_hand(spark):
    got = commit_ops.inactive_days(commits_of(spark, [("a", 0, 1), ("a", 2, 1), ("b", 1, 1), (None, 3, 1)]))
    assert sorted(tuple(r) for r in got.collect()) == [
        ("a", DAY + dt.timedelta(days=1)), ("a", DAY + dt.timedelta(days=3)), ("b", DAY),
        ("b", DAY + dt.timedelta(days=2)), ("b", DAY + dt.timedelta(days=3))]


def test_a_calendar_of_one_day_has_no_inactive_day(spark):
    assert commit_ops.inactive_days(commits_of(spark, [("a", 0, 1), ("b", 0, 2)])).count() == 0
    assert commit_ops.inactive_days(commits_of(spark, [])).count() == 0


@settings(max_examples=8, derandomize=True, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c", None]), st.integers(0, 9), st.integers(0, 3)),
                min_size=1, max_size=25), st.integers(1, 12))
def test_windowed_results_against_brute_force(spark, commit_rows, n):
    commits = commits_of(spark, commit_rows).coalesce(1)
    want = brute_inactive(commit_rows)
    assert sorted(tuple(r) for r in commit_ops.inactive_days(commits).collect()) == want
    assert [tuple(r) for r in commit_ops.top_inactive_days(commits, n).collect()] == want[:n]
    running = Counter()
    for a, d, s in commit_rows:
        running[a, d, s, sum(1 for x in commit_rows if x[:2] == (a, d) and x[2] <= s)] += 1
    got = Counter((r.author_name, (r.date - DAY).days, r.created_at.second, r.sum_commits)
                  for r in commit_ops.running_commits_per_day(commits).collect())
    assert got == running


def test_missing_hours_by_hand(spark):
    frame = activity(spark, event("X", "2024-01-01T05:10:00Z"), event("X", "2024-01-03T00:00:00Z"))
    got = profile.missing_hours(frame).collect()
    assert len(got) == 72 - 2
    names = {r.file_name for r in got}
    assert {"2024-01-01-0.json.gz", "2024-01-02-9.json.gz", "2024-01-03-23.json.gz"} <= names
    assert not {"2024-01-01-5.json.gz", "2024-01-03-0.json.gz"} & names
    assert profile.missing_hours(frame.limit(0)).count() == 0


@pytest.fixture(scope="module")
def sample(spark):
    return activity_from_events(spark.read.parquet(f"{TESTDATA}/sf0.01/events.parquet"))


def test_results_do_not_depend_on_the_session_zone(spark, sample, zone):
    commits = facts.build_commits(sample)
    assert facts.build_repos(sample).count() == 5_857
    assert commit_ops.inactive_days(commits).count() == 24_638
    assert rollups.hourly(commits).count() == 710


def test_event_totals_agree(spark, sample):
    total = sample.count()
    assert profile.activity_count(sample).first()[0] == total
    repos = facts.build_repos(sample)
    timed = total - facts.rejects(sample).count()
    assert total - timed == 68
    assert repos.agg(F.sum("total_events")).first()[0] == timed
    assert facts.merge_repos(repos.unionByName(repos)).agg(F.sum("total_events")).first()[0] == 2 * timed
    for counts in (profile.events_per_hour, profile.events_per_type, profile.events_per_repo):
        assert counts(sample).agg(F.sum("total_events")).first()[0] == total


def test_reduction_ratio_counts_the_built_facts(spark, sample):
    got = {r.fact: r for r in facts.reduction_ratio(sample).collect()}
    for name, build in facts.BUILDERS.items():
        assert got[name].rows_out == build(sample).count()
        assert got[name].ratio == pytest.approx(10_000 / got[name].rows_out)
    empty = {r.fact: tuple(r)[1:] for r in facts.reduction_ratio(sample.limit(0)).collect()}
    assert empty == dict.fromkeys(facts.BUILDERS, (0, 0, None))


def test_author_days_agree(spark, sample):
    commits = facts.build_commits(sample)
    ge2, le1 = commit_ops.commits_ge2_per_day(commits), commit_ops.commits_le1_per_day(sample)
    assert rows(ge2) == rows(commit_ops.commits_gt1_from_raw(sample))
    active = commits.select("date", "author_name").distinct().count()
    assert ge2.count() + le1.count() == active
    authors = commits.select("author_name").distinct().count()
    first, last = commit_ops.commit_day_span(commits).first()
    assert commit_ops.inactive_days(commits).count() + active == authors * ((last - first).days + 1)
    last_value = commit_ops.running_commits_per_day(commits).groupBy("date", "author_name").agg(
        F.max("sum_commits").alias("total_commits"))
    assert rows(last_value.where("total_commits >= 2")) == rows(ge2)


def test_daily_sums_agree_with_hourly_counts(spark, sample):
    added = facts.build_members(sample)
    hourly = members.members_hourly(added)
    by_day = {day: sum(r.total for r in group) for day, group in groupby(hourly.collect(), key=lambda r: r.date)}
    assert dict(rollups.daily(hourly).collect()) == by_day
    assert sum(by_day.values()) == added.count()
    projects = members.projects_gt10_members(added)
    assert members.projects_gt10_total(added).first()[0] == projects.count() == 42
