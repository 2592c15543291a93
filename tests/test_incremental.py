"""Sets kept day by day against the metrics over all facts; the index of landed files."""

from __future__ import annotations

import datetime as dt
import gzip
import random
from collections import Counter

import pytest

from eventloom import __main__ as cli
from eventloom.operators import commits, members, owners
from eventloom.plans import incremental
from eventloom.plans.compact import compact
from eventloom.plans.daily import run_day, run_days, run_metrics
from eventloom.plans.incremental import SETS, advance, distinct_counts, register_kept
from eventloom.sinks.manifest import commit
from eventloom.sources import hours_landed, index_files, read_fact, read_index, stream_activity
from eventloom.streaming import stream_facts
from tests.test_files import land, member, push

DAYS = [f"2024-01-{day:02}" for day in range(1, 6)]


def rows(df):
    return Counter(tuple(r) for r in df.select(sorted(df.columns)).collect())


def some_events(rng, day):
    """Few names, so that pairs come on several days, and commits of the day before and after."""
    out = []
    for _ in range(rng.randrange(1, 12)):
        at = dt.datetime.fromisoformat(f"{day}T12:00:00") + dt.timedelta(days=rng.choice([-1, 0, 0, 0, 1]))
        at = at.isoformat() + "Z"
        repo = rng.choice(["ann/a", "ann/b", "ann/c", "bob/a", "bob/b", "noslash", "/x"])
        out.append(push(at, repo=repo, authors=rng.choices(["Ann", "Bob", "Cy", None], k=rng.randrange(3))))
        out.append(member(at, login=f"m{rng.randrange(14)}", repo=rng.choice(["ann/a", "bob/b"])))
    return out


def assert_as_full(spark, root):
    full = {
        "repos": owners.repo_owners_gt1(read_fact(spark, root, "repos")),
        "members": members.projects_gt10_members(read_fact(spark, root, "members")),
        "commits_lt1": commits.inactive_days(read_fact(spark, root, "commits")),
    }
    for name, want in full.items():
        got = incremental.KEPT_METRICS[name](spark, root)
        assert got.dtypes == want.dtypes
        assert rows(got) == rows(want), name
    return {name: want.count() for name, want in full.items()}


@pytest.mark.parametrize("seed", [1, 2])
def test_days_that_come_change_and_go(spark, tmp_path, monkeypatch, seed):
    monkeypatch.setattr(incremental, "MAX_LAYERS", 3)
    rng = random.Random(seed)
    landing, root = tmp_path / "in", str(tmp_path / "facts")
    landing.mkdir()
    for day in rng.sample(DAYS, len(DAYS)):  # in any order
        land(landing, f"{day}-7", some_events(rng, day))
        run_day(spark, str(landing), root, day)
        assert advance(spark, root) == dict.fromkeys(SETS, 1)
        sizes = assert_as_full(spark, root)
    assert sizes["repos"] and sizes["commits_lt1"]
    for day in DAYS[:2]:  # an older day again, with other events
        land(landing, f"{day}-7", some_events(rng, day))
    run_days(spark, str(landing), root, DAYS[0], DAYS[1])
    assert set(advance(spark, root, keep_seconds=0).values()) == {2}
    assert_as_full(spark, root)
    (landing / f"{DAYS[2]}-7.json.gz").unlink()  # a day without files now
    run_day(spark, str(landing), root, DAYS[2])
    advance(spark, root, keep_seconds=0)
    assert_as_full(spark, root)
    commit(spark, root, lambda manifest: [manifest.put(fact, DAYS[3], []) for fact in manifest.live])  # and one withdrawn
    advance(spark, root, keep_seconds=0)
    assert_as_full(spark, root)
    assert set(advance(spark, root).values()) == {0}


def test_stream_batches_and_compaction(spark, tmp_path):
    rng = random.Random(3)
    landing, root = tmp_path / "in", str(tmp_path / "facts")
    landing.mkdir()
    for day in DAYS[:3]:
        for hour in (1, 2):
            land(landing, f"{day}-{hour}", some_events(rng, day))
    stream_facts(stream_activity(spark, str(landing), 2), root, str(tmp_path / "progress")).awaitTermination()
    assert set(advance(spark, root).values()) == {3}
    before = rows(distinct_counts(spark, root, "owner_repos"))
    assert_as_full(spark, root)
    assert any(compact(spark, root, "2024-02-01").values())
    advance(spark, root)
    assert rows(distinct_counts(spark, root, "owner_repos")) == before
    assert_as_full(spark, root)


@pytest.mark.parametrize("step", ["_write_days", "_write_pairs", "_write_totals", "_write_spans", "store_version"])
def test_a_broken_call_changes_nothing(spark, tmp_path, monkeypatch, step):
    rng = random.Random(4)
    landing, root = tmp_path / "in", str(tmp_path / "facts")
    landing.mkdir()
    for day in DAYS[:2]:
        land(landing, f"{day}-7", some_events(rng, day))
        run_day(spark, str(landing), root, day)
        if day == DAYS[0]:
            advance(spark, root, ["author_days"])
    before = rows(incremental.inactive_days(spark, root)), rows(distinct_counts(spark, root, "author_days"))

    def broken(*args):
        raise RuntimeError(step)

    with monkeypatch.context() as patch:
        patch.setattr(incremental, step, broken)
        with pytest.raises(RuntimeError):
            advance(spark, root, ["author_days"])
    assert (rows(incremental.inactive_days(spark, root)), rows(distinct_counts(spark, root, "author_days"))) == before
    assert advance(spark, root) == {"owner_repos": 2, "project_members": 2, "author_days": 1}
    assert_as_full(spark, root)


def test_of_two_callers_one_starts_again(spark, tmp_path, monkeypatch):
    rng = random.Random(5)
    landing, root = tmp_path / "in", str(tmp_path / "facts")
    landing.mkdir()
    for day in DAYS[:2]:
        land(landing, f"{day}-7", some_events(rng, day))
    run_day(spark, str(landing), root, DAYS[0])
    whole = incremental._write_totals
    calls = []

    def overtaken(store, batch):
        whole(store, batch)
        if not calls:
            calls.append(batch)
            run_day(spark, str(landing), root, DAYS[1])
            assert advance(spark, root, ["owner_repos"]) == {"owner_repos": 2}

    monkeypatch.setattr(incremental, "_write_totals", overtaken)
    assert advance(spark, root) == {"owner_repos": 0, "project_members": 2, "author_days": 2}
    assert not list((tmp_path / "facts/.sets/owner_repos").glob(f"*/*{calls[0]}*"))
    assert_as_full(spark, root)


def test_nothing_stored(spark, tmp_path):
    root = str(tmp_path / "facts")
    (tmp_path / "in").mkdir()
    run_day(spark, str(tmp_path / "in"), root, DAYS[0])
    advance(spark, root)
    for name, metric in incremental.KEPT_METRICS.items():
        assert metric(spark, root).count() == 0, name
    with pytest.raises(ValueError):
        advance(spark, root, ["other"])


def test_a_metric_reads_no_facts_and_no_pairs(spark, tmp_path):
    landing, root = tmp_path / "in", str(tmp_path / "facts")
    landing.mkdir()
    land(landing, "2024-01-01-7", some_events(random.Random(6), "2024-01-01"))
    run_day(spark, str(landing), root, "2024-01-01")
    advance(spark, root)
    for metric in incremental.KEPT_METRICS.values():
        read = {path.rpartition("/.sets/")[2].split("/")[1] for path in metric(spark, root).inputFiles()}
        assert read <= {"totals", "spans"}


def test_exports_and_views_from_kept_sets(spark, tmp_path, monkeypatch, capsys):
    landing, root = tmp_path / "in", str(tmp_path / "facts")
    landing.mkdir()
    for seed, day in enumerate(DAYS):
        land(landing, f"{day}-7", some_events(random.Random(seed), day))
    run_days(spark, str(landing), root, DAYS[0], DAYS[-1])

    def exported(out, **options):
        targets = run_metrics(spark, root, str(tmp_path / out), "2024-01-31", **options)
        return {t.rpartition("/")[2]: spark.read.csv(t, header=True).collect() for t in targets}

    full, kept = exported("full"), exported("kept", kept=True)
    assert {name: Counter(found) for name, found in full.items()} == {name: Counter(found) for name, found in kept.items()}
    assert exported("first", limit=3) == exported("first_kept", limit=3, kept=True)
    assert exported("days", date_from=DAYS[1]) == exported("days_kept", date_from=DAYS[1], kept=True)
    assert set(register_kept(spark, root)) == {"kept_repos", "kept_members", "kept_commits_lt1"}
    count = spark.sql("SELECT count(*) FROM kept_commits_lt1").first()[0]
    assert count == commits.inactive_days(read_fact(spark, root, "commits")).count()
    monkeypatch.setattr(cli, "get_session", lambda name: spark)
    cli.main(["advance", root, "--sets", "author_days"])
    assert capsys.readouterr().out == "author_days: 0 days changed\n"


def test_landed_files_are_told_apart(spark, tmp_path, monkeypatch, capsys):
    landing, index = tmp_path / "in", str(tmp_path / "index")
    landing.mkdir()
    rng = random.Random(7)
    noise = [push("2024-01-01T00:00:00Z", repo=f"ann/{rng.random()}") for _ in range(3000)]
    for hour in (0, 1, 2):
        land(landing, f"2024-01-01-{hour}", noise)
    whole = (landing / "2024-01-01-1.json.gz").read_bytes()
    (landing / "2024-01-01-1.json.gz").write_bytes(whole[: len(whole) * 2 // 3])  # cut off
    damaged = bytearray(whole)
    damaged[len(whole) // 2] ^= 255
    (landing / "2024-01-01-2.json.gz").write_bytes(damaged)
    (landing / "2024-01-01-3.json.gz").write_bytes(b"")  # created, never filled
    (landing / "2024-01-01-4.json.gz").write_bytes(gzip.compress(b""))
    (landing / "2024-01-01-5.json.gz").write_bytes(gzip.compress(b"{}\n") + gzip.compress(b"{}\n{}\n"))  # two parts
    (landing / "2024-01-01-6.json.gz").write_bytes(gzip.compress(b'{}\r\n{"a":"\xc3\xa9"}'))  # no last line break
    (landing / "2024-01-01-7.json.gz").write_bytes(whole[:6])  # within the header
    states = index_files(spark, str(landing), index, "2024-01-01")
    assert states == {"complete": 3, "cut": 3, "empty": 1}
    assert index_files(spark, str(landing), index, "2024-01-01") == {}
    hours = {r.hour: (r.state, r.lines) for r in hours_landed(spark, str(landing), index, "2024-01-01").collect()}
    assert len(hours) == 24
    assert hours[0] == ("complete", 3000) and hours[5] == ("complete", 3) and hours[6] == ("complete", 2)
    assert hours[1][0] == hours[2][0] == hours[7][0] == "cut" and hours[1][1] < 3000
    assert hours[3] == hours[4] == ("empty", 0)
    assert hours[8] == hours[23] == ("missing", None)

    (landing / "2024-01-01-1.json.gz").write_bytes(whole)  # downloaded again
    land(landing, "2024-01-01-23", noise[:2])
    hours = {r.hour: r.state for r in hours_landed(spark, str(landing), index, "2024-01-01").collect()}
    assert hours[1] == hours[23] == "unread"
    assert index_files(spark, str(landing), index) == {"complete": 2}
    assert read_index(spark, index).count() == 9
    monkeypatch.setattr(cli, "get_session", lambda name: spark)
    cli.main(["landed", str(landing), index, "2024-01-01"])
    told = capsys.readouterr().out.splitlines()
    assert told[0] == "2024-01-01-2.json.gz: cut" and "2024-01-01-8.json.gz: missing" in told and len(told) == 19  # 0, 1, 5, 6 and 23 are whole


def test_an_index_of_nothing(spark, tmp_path):
    assert index_files(spark, str(tmp_path), str(tmp_path / "index"), "2024-01-01") == {}
    assert read_index(spark, str(tmp_path / "index")).count() == 0
    states = hours_landed(spark, str(tmp_path), str(tmp_path / "index"), "2024-01-01", "2024-01-02").select("state").distinct()
    assert [r.state for r in states.collect()] == ["missing"]
