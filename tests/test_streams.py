"""Streams give what the batch operators give on the same files."""

from __future__ import annotations

import os
import pathlib
import uuid
from collections import Counter
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from eventloom import schemas
from eventloom.functions import with_event_time
from eventloom.operators.facts import BUILDERS, build_repos
from eventloom.plans.daily import run_days
from eventloom.session import checkpoint_location
from eventloom.sources import read_activity, read_fact, stream_activity
from eventloom.streaming import live, stream_facts, stream_hourly_counts, stream_repos
from tests.test_files import land, landed, member, push  # noqa: F401


def rows(df):
    return Counter(tuple(r) for r in df.select(sorted(df.columns)).collect())


@pytest.fixture
def out(tmp_path):
    """A new output each time: the session may keep progress in a shared folder."""
    return str(tmp_path / f"facts-{uuid.uuid4().hex}")


def run_to_memory(df, name, fallback):
    checkpoint = checkpoint_location(df.sparkSession, f"{name}-{uuid.uuid4().hex}", fallback)
    query = (df.writeStream.format("memory").queryName(name).outputMode("append")
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
    return df.sparkSession.table(name)


def facts_of(spark, out):
    return {name: rows(read_fact(spark, out, name)) for name in schemas.FACTS}


def built(spark, landed):
    activity = read_activity(spark, landed)
    return {name: rows(build(activity)) for name, build in BUILDERS.items()}


@pytest.fixture
def own_progress(monkeypatch):
    """Progress where the test says, also in a session that names a folder."""
    monkeypatch.setattr(live, "checkpoint_location", lambda spark, name, fallback=None: f"{fallback}/{name}")


def test_stream_facts_equal_batch_facts_over_several_runs(spark, landed, out, tmp_path):
    progress = str(tmp_path / "progress")

    def run():
        stream = stream_activity(spark, landed, max_files_per_trigger=1)
        stream_facts(stream, out, progress).awaitTermination()

    run()
    activity = read_activity(spark, landed)
    assert facts_of(spark, out) == {n: rows(b(activity)) for n, b in BUILDERS.items()}
    run()  # nothing new
    land(pathlib.Path(landed), "2024-01-03-11", [push("2024-01-03T11:00:00Z", authors=("New",)),
                                                member("2024-01-03T11:30:00Z", login="zed")])
    run()
    activity = read_activity(spark, landed)
    assert facts_of(spark, out) == {n: rows(b(activity)) for n, b in BUILDERS.items()}
    pruned = read_fact(spark, out, "commits", "2024-01-03", "2024-01-03")
    assert {r.author_name for r in pruned.collect()} == {"Ann", "New"}


def test_a_file_with_an_old_time_stamp_is_not_passed_over(spark, landed, out, tmp_path):
    stream_facts(stream_activity(spark, landed), out, str(tmp_path / "p")).awaitTermination()
    before = read_fact(spark, out, "commits").count()
    land(pathlib.Path(landed), "2023-06-01-3", [push("2023-06-01T03:00:00Z", authors=("Old",))])
    os.utime(f"{landed}/2023-06-01-3.json.gz", (1_600_000_000, 1_600_000_000))
    stream_facts(stream_activity(spark, landed), out, str(tmp_path / "p")).awaitTermination()
    assert read_fact(spark, out, "commits").count() == before + 1


def test_a_repeated_batch_replaces_itself(spark, landed, out, tmp_path, monkeypatch):
    fail = {"left": 1}
    real = live.write_fact

    def flaky(rows, root, name, batch):
        real(rows, root, name, batch)
        if name == "commits" and fail["left"]:
            fail["left"] -= 1
            raise RuntimeError("lost after the commits were written")

    monkeypatch.setattr(live, "write_fact", flaky)
    with pytest.raises(Exception, match="lost after"):
        stream_facts(stream_activity(spark, landed), out, str(tmp_path / "p")).awaitTermination()
    stream_facts(stream_activity(spark, landed), out, str(tmp_path / "p")).awaitTermination()
    activity = read_activity(spark, landed)
    assert facts_of(spark, out) == {n: rows(b(activity)) for n, b in BUILDERS.items()}


def test_a_batch_that_counts_is_not_stored_again_even_where_it_was_replaced(spark, landed, out, tmp_path, monkeypatch):
    """The stream breaks behind the commit; a batch run takes the days over before it goes on."""
    real = live.commit

    def flaky(*args):
        real(*args)
        raise RuntimeError("lost behind the commit")

    monkeypatch.setattr(live, "commit", flaky)
    with pytest.raises(Exception, match="lost behind"):
        stream_facts(stream_activity(spark, landed), out, str(tmp_path / "p")).awaitTermination()
    monkeypatch.undo()
    assert facts_of(spark, out) == built(spark, landed)
    run_days(spark, landed, out, "2024-01-01", "2024-01-03", keep_seconds=0)
    stream_facts(stream_activity(spark, landed), out, str(tmp_path / "p")).awaitTermination()
    assert facts_of(spark, out) == built(spark, landed)


def test_a_new_checkpoint_over_streamed_facts_is_refused(spark, landed, out, tmp_path, own_progress):
    stream_facts(stream_activity(spark, landed), out, str(tmp_path / "p")).awaitTermination()
    land(pathlib.Path(landed), "2024-01-03-11", [push("2024-01-03T11:00:00Z", authors=("New",))])
    with pytest.raises(ValueError, match="no progress"):
        stream_facts(stream_activity(spark, landed), out, str(tmp_path / "other"))
    stream_facts(stream_activity(spark, landed), out, str(tmp_path / "p")).awaitTermination()
    assert facts_of(spark, out) == built(spark, landed)


def test_lost_progress_with_deleted_inputs(spark, landed, out, tmp_path, own_progress):
    """Numbers start at 0 again, and replace nothing."""
    whole = built(spark, landed)
    stream_facts(stream_activity(spark, landed), out, str(tmp_path / "p")).awaitTermination()
    for file in pathlib.Path(landed).glob("*.gz"):
        file.unlink()
    land(pathlib.Path(landed), "2024-01-04-1", [push("2024-01-04T01:00:00Z", authors=("New", "New"))])
    new = built(spark, landed)
    stream_facts(stream_activity(spark, landed), out, str(tmp_path / "lost"), afresh=True).awaitTermination()
    assert facts_of(spark, out) == {name: whole[name] + new[name] for name in whole}


def test_facts_one_after_the_other(spark, landed, out, tmp_path):
    for name in schemas.FACTS:
        stream_facts(stream_activity(spark, landed), out, str(tmp_path / "p"), facts=(name,)).awaitTermination()
    assert facts_of(spark, out) == built(spark, landed)
    with pytest.raises(ValueError, match="repos"):
        stream_facts(stream_activity(spark, landed), out, str(tmp_path / "p"), facts=("repos", "commits"))


def test_stream_and_batch_share_a_root(spark, landed, out, tmp_path):
    root = pathlib.Path(landed)
    later = root.parent / "later"
    later.mkdir()
    for file in root.glob("2024-01-0[23]*"):
        file.rename(later / file.name)
    run_days(spark, landed, out, "2024-01-01", "2024-01-01")
    stream_facts(stream_activity(spark, str(later), max_files_per_trigger=1), out, str(tmp_path / "p")).awaitTermination()
    for file in later.glob("*.gz"):
        file.rename(root / file.name)
    assert facts_of(spark, out) == built(spark, landed)
    run_days(spark, landed, out, "2024-01-02", "2024-01-03")  # takes over streamed days
    assert facts_of(spark, out) == built(spark, landed)


def test_processed_files_can_be_cleaned_up(spark, landed, out, tmp_path):
    archive = tmp_path / "archive"
    stream = stream_activity(spark, landed, max_files_per_trigger=1, clean_source="archive",
                             archive_dir=str(archive))
    stream_facts(stream, out, str(tmp_path / "p")).awaitTermination()
    assert list(archive.rglob("*.json.gz"))


def closed(df):
    """Only hours that a newer event has closed; the newest stays in state."""
    return df.where("date < '2024-01-03'")


def test_stream_repos_and_counts_equal_batch_for_closed_hours(spark, landed, tmp_path, zone):
    tag = zone.replace("/", "_").lower()
    activity = read_activity(spark, landed)
    repos = run_to_memory(stream_repos(stream_activity(spark, landed)), f"repos_{tag}", str(tmp_path / "r"))
    assert rows(closed(repos)) == rows(closed(build_repos(activity)))
    counts = run_to_memory(stream_hourly_counts(stream_activity(spark, landed)), f"counts_{tag}", str(tmp_path / "c"))
    timed = activity.where("created_at LIKE '2024%'")
    want = timed.groupBy(F.substring("created_at", 1, 13).alias("h"), "type").count()
    got = counts.select(F.concat(F.col("date").cast("string"), F.format_string("T%02d", "hour")).alias("h"),
                        "type", F.col("total_events").alias("count"))
    assert rows(got.where("h < '2024-01-03'")) == rows(want.where("h < '2024-01-03'"))


def batch_counts(spark, source):
    timed = read_activity(spark, str(source))
    return {name: rows(build_repos(timed)) if name == "repos" else rows(
        with_event_time(timed).where("event_ts IS NOT NULL").groupBy("date", "hour", "type").agg(F.count("*").alias("total_events")))
        for name in live.LIVE}


def live_counts(spark, target, late=None):
    return {name: rows(live.read_live(spark, target, name, late)) for name in live.LIVE}


@pytest.fixture
def followed(spark, tmp_path):
    """A folder, an output, and a run that takes up what has landed."""
    source, target = tmp_path / "live-in", str(tmp_path / f"live-{uuid.uuid4().hex}")
    source.mkdir()

    def run(progress="p", **options):
        return live.run_live(stream_activity(spark, str(source), max_files_per_trigger=1), target, str(tmp_path / progress), **options)

    return source, target, run


def test_live_counts_take_late_files_and_report_them(spark, followed):
    source, target, run = followed
    for name, at in (("2024-01-01-5", "05:10"), ("2024-01-01-7", "07:30")):
        land(source, name, [push(f"2024-01-01T{at}:00Z"), "{broken"])
        assert run(late="1 hour") == {"hourly_counts": 0, "repos": 0}
    land(source, "2024-01-01-4", [push("2024-01-01T05:20:00Z")])  # two hours late
    assert run(late="1 hour") == {"hourly_counts": 1, "repos": 1}
    assert live_counts(spark, target) == batch_counts(spark, source)
    assert {r.hour: r.total_events for r in live.read_live(spark, target, "hourly_counts").collect()} == {5: 2, 7: 1}
    assert [r.hour for r in live.read_live(spark, target, "hourly_counts", "1 hour").collect()] == [5]
    assert live.read_live(spark, target, "hourly_counts", "3 hours").count() == 0


def test_live_counts_with_another_lateness(spark, followed):
    """Files 0 to 3 with one hour, six further files and one of hour 20 with three."""
    source, target, run = followed
    for hour in range(4):
        land(source, f"2024-01-01-{hour}", [push(f"2024-01-01T{hour:02}:10:00Z")])
    run(late="1 hour")
    for hour in (4, 5, 6, 7, 8, 9, 20):
        land(source, f"2024-01-01-{hour}", [push(f"2024-01-01T{hour:02}:10:00Z")])
        os.utime(source / f"2024-01-01-{hour}.json.gz", (1_900_000_000 + hour,) * 2)  # read in this order
    assert run(late="3 hours") == {"hourly_counts": 0, "repos": 0}
    assert live_counts(spark, target) == batch_counts(spark, source)
    assert sorted(r.hour for r in live.read_live(spark, target, "hourly_counts", "3 hours").collect()) == list(range(10))


def test_live_counts_with_lost_progress(spark, followed, own_progress):
    source, target, run = followed
    for hour in range(3):
        land(source, f"2024-01-01-{hour}", [push(f"2024-01-01T{hour:02}:10:00Z"), member(f"2024-01-01T{hour:02}:50:00Z")])
    run()
    land(source, "2024-01-02-0", [push("2024-01-01T02:59:00Z")])
    run("lost")
    run("lost again", only=("repos",))
    assert live_counts(spark, target) == batch_counts(spark, source)


def test_live_counts_after_a_failure_between_two_rollups(spark, followed, monkeypatch):
    source, target, run = followed
    land(source, "2024-01-01-5", [push("2024-01-01T05:10:00Z")])
    real, calls = live.exists, []

    def flaky(session, path):
        if "/repos/source_file=" in path and not calls:
            calls.append(path)
            raise RuntimeError("lost behind the first rollup")
        return real(session, path)

    monkeypatch.setattr(live, "exists", flaky)
    with pytest.raises(Exception, match="lost behind"):
        run()
    run()
    assert live_counts(spark, target) == batch_counts(spark, source)


def test_live_counts_of_an_earlier_layout_are_refused(spark, followed, tmp_path):
    source, target, run = followed
    pathlib.Path(f"{target}/repos/_spark_metadata").mkdir(parents=True)
    with pytest.raises(ValueError, match="earlier version"):
        run()


def test_live_counts_of_nothing(spark, followed):
    source, target, run = followed
    assert run() == {"hourly_counts": 0, "repos": 0}
    assert live.read_live(spark, target, "repos", "1 hour").count() == 0


def test_the_cluster_names_the_checkpoint_folder():
    def session(settings):  # the setting itself is fixed once a session runs
        return SimpleNamespace(conf=settings)

    shared = session({"spark.checkpoint.dir": "/shared/progress/"})
    assert checkpoint_location(shared, "facts", "/local") == "/shared/progress/facts"
    assert checkpoint_location(session({}), "facts", "/local") == "/local/facts"
    with pytest.raises(ValueError):
        checkpoint_location(session({}), "facts")
