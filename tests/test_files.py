"""File side: hourly JSON in, partitioned facts and CSV out."""

from __future__ import annotations

import datetime as dt
import gzip
import json
from collections import Counter

import pytest
from pyspark.sql import functions as F

from eventloom import schemas
from eventloom.operators import commits as commit_ops
from eventloom.operators import owners as owner_ops
from eventloom.operators.facts import BUILDERS
from eventloom.plans.daily import STATISTICS, run_day, run_days, run_metrics
from eventloom.plans import daily
from eventloom.sinks.files import export_csv, write_fact
from eventloom.sinks.manifest import begin, commit, inputs_of, read_manifest, tidy
from eventloom.sources import (
    create_fact_table,
    missing_files,
    read_activity,
    read_fact,
    read_latest_hours,
    stored_fact,
)


def push(at, repo="ann/tools", authors=("Ann",), **extra):
    return {"id": "1", "type": "PushEvent", "created_at": at, "actor": {"id": 1, "login": "ann"},
            "repo": {"id": 9, "name": repo},
            "payload": {"commits": [{"author": {"name": a}} for a in authors]}, **extra}


def member(at, login="bob", action="added", repo="ann/tools"):
    return {"type": "MemberEvent", "created_at": at, "actor": {"id": 1, "login": "ann"},
            "repo": {"id": 9, "name": repo},
            "payload": {"action": action, "member": {"id": 2, "login": login, "type": "User"}}}


def land(root, name, events):
    with gzip.open(root / f"{name}.json.gz", "wt") as out:
        for event in events:
            out.write((event if isinstance(event, str) else json.dumps(event)) + "\n")


@pytest.fixture
def landed(tmp_path):
    root = tmp_path / "in"
    root.mkdir()
    land(root, "2024-01-01-0", [push("2024-01-01T00:00:00Z", authors=("Ann", "Ann", "Cy"))])
    land(root, "2024-01-01-23", [
        push("2024-01-01T23:59:59Z", repo="ann/other"),
        push("2024-01-02T00:00:00Z", authors=("Late",)),  # in the previous day's file
        member("2024-01-01T23:10:00Z"),
        member("2024-01-01T23:11:00Z", login="dee", action="removed"),
        push("not-a-time"),
        "{broken",
    ])
    land(root, "2024-01-02-9", [push("2024-01-02T09:00:00Z", authors=()),
                                push("2024-01-02T09:00:00Z", authors=("Ann",)),
                                push("2024-01-02T00:30:00Z", repo="noslash", authors=("Cy",))])
    land(root, "2024-01-03-10", [push("2024-01-03T10:00:00Z", authors=("Ann",))])
    return str(root)


def rows(df):
    return Counter(tuple(r) for r in df.select(sorted(df.columns)).collect())


def test_reads_files_of_a_day_and_keeps_their_day(spark, landed):
    day = read_activity(spark, landed, "2024-01-01")
    assert day.count() == 7
    assert day.select("source_date").distinct().collect()[0][0] == dt.date(2024, 1, 1)
    assert read_activity(spark, landed, "2024-01-01", "2024-01-02").count() == 10
    assert read_activity(spark, landed).count() == 11


def test_no_matching_file_is_an_empty_frame(spark, landed):
    empty = read_activity(spark, landed, "2030-01-01")
    assert empty.count() == 0
    assert {*schemas.ACTIVITY.fieldNames(), "source_date"} == set(empty.columns)
    for name, build in BUILDERS.items():
        assert build(empty).count() == 0
        assert build(empty).columns == schemas.FACTS[name].fieldNames()


def test_latest_hours_go_by_the_hour_in_the_name(spark, landed):
    newest = read_latest_hours(spark, landed, 2).select("source_date").distinct().collect()
    assert {r[0].isoformat() for r in newest} == {"2024-01-03", "2024-01-02"}
    land_hours = read_latest_hours(spark, landed, 3)
    assert land_hours.where("created_at = '2024-01-01T23:59:59Z'").count() == 1
    assert land_hours.where("created_at = '2024-01-01T00:00:00Z'").count() == 0


def test_an_hour_without_member_events_needs_no_member_field(spark, tmp_path):
    land(tmp_path, "2024-01-01-5", [push("2024-01-01T05:00:00Z")])
    activity = read_activity(spark, str(tmp_path))
    assert BUILDERS["members"](activity).count() == 0


def test_nested_review_is_kept_as_text(spark, tmp_path):
    event = push("2024-01-01T05:00:00Z")
    event["payload"]["review"] = {"state": "ok"}
    land(tmp_path, "2024-01-01-5", [event])
    review = read_activity(spark, str(tmp_path)).select("payload.review").first()[0]
    assert json.loads(review) == {"state": "ok"}


@pytest.mark.parametrize("facts", [("repos",), ("commits",), ("members",), ("repos", "members")])
def test_narrow_input_gives_the_same_facts(spark, landed, facts):
    full = read_activity(spark, landed)
    narrow = read_activity(spark, landed, schema=schemas.input_schema(facts))
    for name in facts:
        assert rows(BUILDERS[name](narrow)) == rows(BUILDERS[name](full))


def test_run_day_is_safe_to_repeat(spark, landed, tmp_path):
    out = str(tmp_path / "facts")
    first = run_day(spark, landed, out, "2024-01-01")
    before = {name: rows(read_fact(spark, out, name)) for name in schemas.FACTS}
    assert run_day(spark, landed, out, "2024-01-01") == first
    assert {name: rows(read_fact(spark, out, name)) for name in schemas.FACTS} == before
    assert (first.rows_in, first.rejected) == (7, 2)
    assert first.rows_out == {"repos": 4, "commits": 5, "members": 1}
    assert first.ratio("members") == 7.0


def test_a_run_leaves_events_from_other_days_files_alone(spark, landed, tmp_path):
    out = str(tmp_path / "facts")
    for day in ("2024-01-01", "2024-01-02", "2024-01-02", "2024-01-01"):
        run_day(spark, landed, out, day)
    second = read_fact(spark, out, "commits", "2024-01-02", "2024-01-02")
    assert sorted(r.author_name for r in second.collect()) == ["Ann", "Cy", "Late"]
    midnight = read_fact(spark, out, "repos").where("date = '2024-01-02' and hour = 0")
    assert midnight.count() == 2  # two repositories


def test_range_equals_single_days_and_builders(spark, landed, tmp_path):
    one_by_one, at_once = str(tmp_path / "a"), str(tmp_path / "b")
    for day in ("2024-01-01", "2024-01-02", "2024-01-03"):
        run_day(spark, landed, one_by_one, day)
    for _ in range(2):
        summary = run_days(spark, landed, at_once, "2024-01-01", "2024-01-03")
    activity = read_activity(spark, landed)
    for name, build in BUILDERS.items():
        stored = rows(read_fact(spark, at_once, name))
        assert rows(read_fact(spark, one_by_one, name)) == stored
        assert summary.rows_out[name] == stored_fact(spark, at_once, name).count()
        assert stored == rows(build(activity))


def test_one_file_per_day_unless_the_day_is_large(spark, tmp_path):
    days = spark.range(0, 300_000, 1, 8).selectExpr(
        "if(id < 150, date_add(DATE'2024-01-01', cast(id % 3 as int)), DATE'2024-02-01') AS date",
        "timestampadd(SECOND, cast(id % 86400 as int), cast(DATE'2024-02-01' as timestamp_ntz)) AS created_at",
        "sha1(cast(id as string)) AS author_name", "DATE'2024-02-01' AS source_date")
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2MB")
    try:
        write_fact(days, str(tmp_path), "commits", "run-1")
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    files = Counter(p.parent.parent.name for p in tmp_path.rglob("part-*.parquet"))
    assert files.pop("date=2024-02-01") > 3
    assert files == {f"date=2024-01-0{d}": 1 for d in (1, 2, 3)}
    assert read_fact(spark, str(tmp_path), "commits").count() == 300_000


def test_a_range_rerun_equals_reruns_of_its_days(spark, landed, tmp_path):
    """A file withdrawn, a date gone, and a whole day emptied."""
    corrected = tmp_path / "corrected"
    corrected.mkdir()
    land(corrected, "2024-01-01-0", [push("2024-01-01T00:00:00Z")])
    land(corrected, "2024-01-03-10", [push("2024-01-03T10:00:00Z")])
    outs = [str(tmp_path / name) for name in "ab"]
    for out in outs:
        run_days(spark, landed, out, "2024-01-01", "2024-01-03")
    summary = run_days(spark, str(corrected), outs[0], "2024-01-01", "2024-01-02")
    for day in ("2024-01-01", "2024-01-02"):
        run_day(spark, str(corrected), outs[1], day)
    assert summary.rows_out == {"repos": 1, "commits": 1, "members": 0} and summary.rows_in == 1
    for name in schemas.FACTS:
        assert rows(read_fact(spark, outs[0], name)) == rows(read_fact(spark, outs[1], name))
    assert sorted(str(r.date) for r in read_fact(spark, outs[0], "commits").collect()) == ["2024-01-01", "2024-01-03"]
    assert run_days(spark, str(corrected), outs[0], "2024-01-02", "2024-01-03").rows_out["commits"] == 1
    assert read_fact(spark, outs[0], "commits").count() == 2


def test_nothing_staged_is_left_and_nothing_is_persisted(spark, landed, tmp_path):
    out, before = tmp_path / "facts", set(spark.sparkContext._jsc.getPersistentRDDs())
    run_days(spark, landed, str(out), "2024-01-01", "2024-01-03")
    assert sorted(p.name for p in out.iterdir() if not p.name.startswith(".")) == ["commits", "members", "rejects", "repos"]
    assert set(spark.sparkContext._jsc.getPersistentRDDs()) <= before


def test_rejected_lines_are_kept_with_their_file(spark, landed, tmp_path):
    out = tmp_path / "facts"
    for _ in range(2):
        run_days(spark, landed, str(out), "2024-01-01", "2024-01-03")
        kept = spark.read.json(str(out / "rejects")).collect()
        assert {r.file_name for r in kept} == {"2024-01-01-23.json.gz"} and len(kept) == 2
        assert "{broken" in {r.line for r in kept} and any("not-a-time" in r.line for r in kept)


def test_files_can_be_deleted_after_a_run(spark, landed, tmp_path):
    import pathlib

    run_days(spark, landed, str(tmp_path / "facts"), "2024-01-01", "2024-01-02", clean=True)
    assert [p.name for p in pathlib.Path(landed).glob("*.gz")] == ["2024-01-03-10.json.gz"]
    assert read_fact(spark, str(tmp_path / "facts"), "commits").count() == 7


def test_missing_files_go_by_names(spark, landed):
    """2024-01-02-0 has not landed, though the day before has an event of that hour."""
    got = missing_files(spark, landed, "2024-01-01", "2024-01-04").collect()
    names = [r.file_name for r in got]
    assert len(names) == 4 * 24 - 4
    assert "2024-01-02-0.json.gz" in names and "2024-01-04-23.json.gz" in names
    assert not {"2024-01-01-0.json.gz", "2024-01-01-23.json.gz", "2024-01-02-9.json.gz", "2024-01-03-10.json.gz"} & set(names)
    assert [(r.date, r.hour) for r in got] == sorted((r.date, r.hour) for r in got)
    assert missing_files(spark, landed, "2024-01-03").count() == 23


def test_a_last_day_needs_a_first_day(spark, landed):
    with pytest.raises(ValueError):
        read_activity(spark, landed, last_day="2024-01-02")


def test_withdrawn_events_disappear_with_a_rerun_of_their_day(spark, landed, tmp_path):
    out = str(tmp_path / "facts")
    run_day(spark, landed, out, "2024-01-01")
    corrected = tmp_path / "corrected"
    corrected.mkdir()
    land(corrected, "2024-01-01-0", [push("2024-01-01T00:00:00Z")])
    run_day(spark, str(corrected), out, "2024-01-01")
    assert read_fact(spark, out, "commits").count() == 1


def test_a_day_without_files_is_stored_as_empty(spark, landed, tmp_path):
    out = str(tmp_path / "facts")
    assert run_day(spark, landed, out, "2030-01-01").rows_out == {n: 0 for n in schemas.FACTS}
    assert read_fact(spark, out, "repos").count() == 0


def test_one_fact_per_job(spark, landed, tmp_path):
    out = tmp_path / "facts"
    assert run_day(spark, landed, str(out), "2024-01-01", facts=("commits",)).rows_out == {"commits": 5}
    assert [p.name for p in out.iterdir() if p.name in schemas.FACTS] == ["commits"]
    with pytest.raises(ValueError):
        run_day(spark, landed, str(out), "2024-01-01", facts=("stars",))


def test_read_fact_prunes_days(spark, landed, tmp_path, capsys):
    out = str(tmp_path / "facts")
    run_days(spark, landed, out, "2024-01-01", "2024-01-03")
    fact = read_fact(spark, out, "commits", "2024-01-02", "2024-01-02")
    fact.explain("formatted")
    plan = capsys.readouterr().out
    assert "PartitionFilters: [isnotnull(date" in plan
    assert fact.schema == schemas.COMMITS
    assert len(fact.inputFiles()) >= 1


def test_days_of_a_stored_fact_are_read_off_its_partitions(spark, landed, tmp_path, capsys):
    out = str(tmp_path / "facts")
    run_days(spark, landed, out, "2024-01-01", "2024-01-03")
    span = commit_ops.commit_day_span(read_fact(spark, out, "commits"))
    assert tuple(span.first()) == (dt.date(2024, 1, 1), dt.date(2024, 1, 3))
    rows_per_day = owner_ops.repos_daily_rows(read_fact(spark, out, "repos"))
    assert [tuple(r) for r in rows_per_day.collect()] == [
        (dt.date(2024, 1, 3), 1), (dt.date(2024, 1, 2), 3), (dt.date(2024, 1, 1), 3)]
    assert rows(rows_per_day) == rows(owner_ops.repos_daily_rows(BUILDERS["repos"](read_activity(spark, landed))))
    span.explain("formatted")
    assert "ReadSchema: struct<>" in capsys.readouterr().out


def test_stored_repos_of_one_hour_in_files_of_two_days(spark, tmp_path):
    root, out = tmp_path / "in", str(tmp_path / "facts")
    root.mkdir()
    land(root, "2024-01-01-23", [push("2024-01-02T00:00:01Z"), push("2024-01-01T23:00:00Z")])
    land(root, "2024-01-02-0", [push("2024-01-02T00:00:02Z"), push("2024-01-02T00:00:03Z", repo="ann/other")])
    run_days(spark, str(root), out, "2024-01-01", "2024-01-02")
    repos = read_fact(spark, out, "repos")
    assert rows(repos) == rows(BUILDERS["repos"](read_activity(spark, str(root))))
    assert {str(r.date): r.total for r in owner_ops.repos_daily_rows(repos).collect()} == {"2024-01-01": 1, "2024-01-02": 2}
    one_day = read_fact(spark, out, "repos", "2024-01-02", "2024-01-02")
    assert "PartitionFilters: [isnotnull(date" in one_day._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def test_csv_keeps_text_exactly(spark, tmp_path):
    import csv

    names = [" Ann ", 'An"n', "a,b", "line\nbreak", "", None, "\\", '"', "tab\t", "quote\"\ncomma, "]
    frame = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "i int, name string").coalesce(1)
    target = export_csv(frame, str(tmp_path), "names", "2024-01-31")
    (part,) = [p for p in (tmp_path / "names_2024-01-31").glob("part-*.csv")]
    text = part.read_text()
    with open(part, newline="") as source:
        assert [r[1] for r in csv.reader(source)] == ["name", *(n or "" for n in names)]
    assert '4,""' in text and "5,\n" in text  # empty and NULL differ
    assert target.endswith("names_2024-01-31")


def test_stored_table_in_the_catalog(spark, landed, tmp_path):
    out = str(tmp_path / "facts")
    run_days(spark, landed, out, "2024-01-01", "2024-01-03")
    for _ in range(2):
        create_fact_table(spark, out, "repos", "repos_test")
    try:
        names = [t.name for t in spark.catalog.listTables()]
        assert "repos_test" in names
        counted = spark.table("repos_test").agg(F.sum("total_events")).first()[0]
        assert counted == read_fact(spark, out, "repos").agg(F.sum("total_events")).first()[0] == 9
    finally:
        spark.sql("DROP TABLE IF EXISTS repos_test")


def test_csv_holds_the_whole_result_in_order(spark, tmp_path):
    owners = owner_ops.repo_owners_gt1(spark.createDataFrame(
        [(f"o{i % 5}", f"r{i}") for i in range(17)], "repo_author string, repo_name string"))
    target = export_csv(owners, str(tmp_path), "repos", "2024-01-31")
    assert target.endswith("/repos_2024-01-31")
    back = spark.read.option("header", True).schema(owners.schema).csv(target)
    assert rows(back) == rows(owners)
    lines = []
    for part in sorted((tmp_path / "repos_2024-01-31").glob("part-*.csv")):
        lines += part.read_text().splitlines()[1:]
    assert lines == ["o0,4", "o1,4", "o2,3", "o3,3", "o4,3"]


def test_metric_files(spark, landed, tmp_path):
    out = str(tmp_path / "facts")
    run_days(spark, landed, out, "2024-01-01", "2024-01-03")
    targets = run_metrics(spark, out, str(tmp_path / "csv"), "2024-01-03")
    assert [t.rsplit("/", 1)[1] for t in targets] == [
        "repos_2024-01-03", "commits_gt1_2024-01-03", "commits_lt1_2024-01-03", "members_2024-01-03"]
    idle = spark.read.option("header", True).csv(targets[2])
    assert rows(idle) == rows(
        commit_ops.inactive_days(read_fact(spark, out, "commits"))
        .withColumn("interval_start_dt", F.col("interval_start_dt").cast("string")))
    some = run_metrics(spark, out, str(tmp_path / "csv3"), "2024-01-03", only=("commits_hourly", "commits_lt1"), limit=1)
    assert [spark.read.option("header", True).csv(t).count() for t in some] == [1, 1]
    every = run_metrics(spark, out, str(tmp_path / "csv4"), "2024-01-03", only=tuple(STATISTICS))
    assert len(every) == len(STATISTICS)
    with pytest.raises(ValueError):
        run_metrics(spark, out, str(tmp_path / "csv5"), "2024-01-03", only=("stars",))
    some = run_metrics(spark, out, str(tmp_path / "csv2"), "2024-01-03", "2024-01-02", "2024-01-03")
    assert spark.read.option("header", True).csv(some[1]).count() == 0


class Broken(RuntimeError):
    pass


#: Steps of a run, in order; each test breaks the run before one of them.
STEPS = ["keep_inputs", "read_listed", "write_fact", "commit", "remove", "rejected_lines", "tidy"]


@pytest.mark.parametrize("step", STEPS)
def test_a_run_broken_at_any_step_shows_old_or_new_rows_never_both(spark, landed, tmp_path, monkeypatch, step):
    out = str(tmp_path / "facts")
    corrected = tmp_path / "corrected"
    corrected.mkdir()
    land(corrected, "2024-01-01-0", [push("2024-01-01T00:00:00Z", authors=("Corrected",)), push("never")])
    land(corrected, "2024-01-01-1", [member("2024-01-01T01:00:00Z", login="new")])
    run_days(spark, landed, out, "2024-01-01", "2024-01-02")

    def seen():
        return {name: rows(read_fact(spark, out, name)) for name in schemas.FACTS}

    old, during = seen(), []
    begun = {name: read_fact(spark, out, name) for name in schemas.FACTS}  # a reader that has begun
    for name in STEPS:
        def watched(*args, real=getattr(daily, name), name=name, **kwargs):
            during.append(seen())
            if name == step:
                raise Broken(step)
            return real(*args, **kwargs)

        monkeypatch.setattr(daily, name, watched)
    with pytest.raises(Broken):
        run_days(spark, str(corrected), out, "2024-01-01", "2024-01-01")
    monkeypatch.undo()
    after = seen()
    assert {name: rows(frame) for name, frame in begun.items()} == old
    run_days(spark, str(corrected), out, "2024-01-01", "2024-01-01")
    new = seen()
    assert new != old and all(state in (old, new) for state in [*during, after])
    assert after == (old if step in STEPS[:4] else new)
    assert {r.author_name for r in read_fact(spark, out, "commits", "2024-01-01", "2024-01-01").collect()} == {"Corrected"}


def test_writers_at_once_both_count(spark, landed, tmp_path, monkeypatch):
    """The slower of two commits is applied on top of the faster one."""
    out = str(tmp_path / "facts")
    begin(spark, out)

    def slow(manifest, again=[]):
        if not again:
            again.append(True)
            commit(spark, out, lambda m: m.put("commits", "2024-01-01", ["fast"]))
        manifest.put("commits", "2024-01-02", ["slow"])

    commit(spark, out, slow)
    assert read_manifest(spark, out).live == {"commits": {"2024-01-01": ["fast"], "2024-01-02": ["slow"]}}


def test_replaced_files_go_after_a_time(spark, landed, tmp_path):
    out = tmp_path / "facts"
    for _ in range(3):
        run_days(spark, landed, str(out), "2024-01-01", "2024-01-03")
    assert len(list(out.glob("commits/*/*/batch=*"))) == 3 * 4
    assert tidy(spark, str(out), keep_seconds=0) == 2 * 3 * 3  # runs, facts, days
    assert len(list(out.glob("commits/*/*/batch=*"))) == 4
    assert tidy(spark, str(out), keep_seconds=0) == 0
    run_days(spark, landed, str(out), "2024-01-01", "2024-01-03", keep_seconds=0)
    assert len(list(out.glob("commits/*/*/batch=*"))) == 4
    assert read_fact(spark, str(out), "commits").count() == 8


def test_a_root_without_a_manifest_is_taken_over(spark, landed, tmp_path):
    import shutil

    out = tmp_path / "facts"
    run_days(spark, landed, str(out), "2024-01-01", "2024-01-03")
    before = {name: rows(read_fact(spark, str(out), name)) for name in schemas.FACTS}
    shutil.rmtree(out / ".manifest")
    assert {name: rows(read_fact(spark, str(out), name)) for name in schemas.FACTS} == before
    run_day(spark, landed, str(out), "2024-01-02", facts=("commits",))
    assert {name: rows(read_fact(spark, str(out), name)) for name in schemas.FACTS} == before


def test_a_file_that_lands_during_the_run_stays_and_is_in_the_next(spark, landed, tmp_path, monkeypatch):
    import pathlib

    out, real = str(tmp_path / "facts"), daily.rejected_lines

    def landing(*args):
        land(pathlib.Path(landed), "2024-01-01-12", [push("2024-01-01T12:00:00Z", authors=("Newcomer",)), "{late"])
        land(pathlib.Path(landed), "2024-01-01-0", [push("2024-01-01T00:00:00Z", authors=("Rewritten",) * 9)])
        return real(*args)

    monkeypatch.setattr(daily, "rejected_lines", landing)
    summary = run_days(spark, landed, out, "2024-01-01", "2024-01-02", clean=True)
    monkeypatch.undo()
    assert (summary.rows_in, summary.rejected) == (10, 2)
    assert spark.read.json(f"{out}/rejects").count() == 2
    assert sorted(p.name for p in pathlib.Path(landed).glob("*.gz")) == [
        "2024-01-01-0.json.gz", "2024-01-01-12.json.gz", "2024-01-03-10.json.gz"]
    assert run_day(spark, landed, out, "2024-01-01", clean=True).rows_in == 3
    names = Counter(r.author_name for r in read_fact(spark, out, "commits", "2024-01-01", "2024-01-01").collect())
    assert names == {"Newcomer": 1, "Rewritten": 9}


def test_a_run_keeps_the_list_of_what_it_read(spark, landed, tmp_path):
    out = str(tmp_path / "facts")
    run_day(spark, landed, out, "2024-01-01")
    (run,) = read_manifest(spark, out).batches("commits", "2024-01-01")
    files = inputs_of(spark, out, run)
    assert [f["path"].rsplit("/", 1)[1] for f in files] == ["2024-01-01-0.json.gz", "2024-01-01-23.json.gz"]
    assert all(f["length"] > 0 and f["modified"] > 0 for f in files)


def test_facts_are_counted_while_they_are_written(spark, landed, tmp_path):
    """One job per fact: no scan of the stored fact, none of the staged copy, for its count alone."""
    out, tracker = str(tmp_path / "facts"), spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("counted", "counted")
    try:
        summary = run_days(spark, landed, out, "2024-01-02", "2024-01-02")
        jobs = len(tracker.getJobIdsForGroup("counted"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert summary.rows_out == {name: stored_fact(spark, out, name).count() for name in schemas.FACTS}
    # The list of files, the staged copy, and per fact a shuffle or two and the write.
    assert jobs <= 2 + 3 * len(schemas.FACTS)


def test_a_table_in_the_catalog_has_what_counts(spark, landed, tmp_path):
    out = str(tmp_path / "facts")
    try:
        for _ in range(2):
            run_days(spark, landed, out, "2024-01-01", "2024-01-03")
            create_fact_table(spark, out, "commits", "commits_test")
            assert spark.table("commits_test").count() == 8
    finally:
        spark.sql("DROP TABLE IF EXISTS commits_test")
