"""SQL table functions against the DataFrame metrics, and compaction of stored batches."""

from __future__ import annotations

import pathlib
import uuid
from collections import Counter

import pytest

from eventloom import __main__ as cli
from eventloom import schemas
from eventloom.operators import commits as commit_ops
from eventloom.operators.facts import BUILDERS
from eventloom.plans import compact as compaction
from eventloom.plans.compact import compact
from eventloom.plans.daily import METRICS, STATISTICS, run_day, run_days
from eventloom.plans.sql import FUNCTIONS, register, sql_metric
from eventloom.sinks.files import new_run, write_fact
from eventloom.sinks.manifest import commit, read_manifest, tidy
from eventloom.sources import read_activity, read_events_activity, read_fact, stored_fact, stream_activity
from eventloom.streaming import stream_facts
from tests.conftest import TESTDATA
from tests.test_files import land, landed, push  # noqa: F401

SOURCES = METRICS | STATISTICS
NAMES = {"repos": "repos_gt1", "members": "members_gt10"}


def rows(df):
    return Counter(tuple(r) for r in df.select(sorted(df.columns)).collect())


@pytest.fixture(scope="module")
def facts_root(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("sql") / "facts")
    activity = read_events_activity(spark, f"{TESTDATA}/sf0.01").selectExpr("*", "DATE'2024-01-01' AS source_date")
    run = new_run()
    for name, build in BUILDERS.items():
        write_fact(build(activity, carry=("source_date",)), root, name, run)
    commit(spark, root, lambda manifest: None)
    return root


@pytest.mark.parametrize("name", sorted(SOURCES))
@pytest.mark.parametrize("days", [(None, None), ("2024-01-10", "2024-01-20"), ("2030-01-01", None)])
def test_metrics_by_sql_equal_their_functions(spark, facts_root, name, days):
    register(spark, facts_root)
    fact, metric = SOURCES[name]
    want = metric(read_fact(spark, facts_root, fact, *days))
    got = sql_metric(spark, NAMES.get(name, name), *days)
    assert got.dtypes == want.select(got.columns).dtypes
    assert rows(got) == rows(want)


def test_every_metric_has_a_function():
    assert {NAMES.get(name, name) for name in SOURCES} == FUNCTIONS.keys()


@pytest.mark.parametrize("name", ["repos_gt1", "commits_gt1", "members_gt10", "commits_lt1"])
def test_a_limit_keeps_the_first_rows(spark, facts_root, name):
    register(spark, facts_root)
    first = sql_metric(spark, name, limit=7)
    assert [tuple(r) for r in first.collect()] == [tuple(r) for r in sql_metric(spark, name).collect()[:7]]
    assert "TakeOrderedAndProject(limit=7" in first._jdf.queryExecution().executedPlan().toString()


def test_days_prune_partitions(spark, facts_root):
    register(spark, facts_root)
    plan = spark.sql("SELECT * FROM commits_gt1(DATE'2024-01-10', DATE'2024-01-11')")
    text = plan._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "PartitionFilters: [isnotnull(date" in text


def test_idle_days_of_two_commits_by_sql(spark, facts_root):
    register(spark, facts_root)
    got = spark.sql("SELECT count(*) FROM commits_lt1(DATE'2024-01-10', DATE'2024-01-20')").first()[0]
    assert got == commit_ops.inactive_days(read_fact(spark, facts_root, "commits", "2024-01-10", "2024-01-20")).count()


def test_unknown_metrics_are_refused(spark):
    with pytest.raises(ValueError, match="stars"):
        sql_metric(spark, "stars")


def test_sql_from_the_command_line(spark, facts_root, capsys, monkeypatch):
    monkeypatch.setattr(cli, "get_session", lambda name: spark)
    cli.main(["sql", facts_root, "SELECT count(*) AS days FROM commits_daily() WHERE total > 0"])
    assert "|30" in capsys.readouterr().out


# -- compaction -----------------------------------------------------------------------------------


@pytest.fixture
def streamed(spark, landed, tmp_path):  # noqa: F811
    """Facts in one batch per hourly file."""
    out = str(tmp_path / f"facts-{uuid.uuid4().hex}")
    for hour in range(1, 5):
        land(pathlib.Path(landed), f"2024-01-01-{hour}", [push(f"2024-01-01T0{hour}:00:00Z"), push("2024-01-01T05:00:00Z")])

    def run():
        stream_facts(stream_activity(spark, landed, max_files_per_trigger=1), out, str(tmp_path / "p")).awaitTermination()

    run()
    return out, run


def facts_of(spark, out):
    return {name: rows(read_fact(spark, out, name)) for name in schemas.FACTS}


def files_of(out, name="commits"):
    return len(list(pathlib.Path(out).glob(f"{name}/*/*/*/part-*.parquet")))


def test_compacted_days_have_the_same_rows_in_fewer_files(spark, landed, streamed):  # noqa: F811
    out, run = streamed
    before, begun, many = facts_of(spark, out), read_fact(spark, out, "commits"), files_of(out)
    held = stored_fact(spark, out, "repos").count()
    assert compact(spark, out, "2024-01-03") == {"repos": 6, "commits": 6, "members": 6}
    assert facts_of(spark, out) == before
    assert rows(begun) == before["commits"]  # its files are still there
    assert stored_fact(spark, out, "repos").count() < held
    assert compact(spark, out, "2024-01-03") == {"repos": 0, "commits": 0, "members": 0}
    tidy(spark, out, keep_seconds=0)
    assert files_of(out) < many / 1.5
    assert facts_of(spark, out) == before
    # The stream goes on, and a batch run takes the day over.
    land(pathlib.Path(landed), "2024-01-01-6", [push("2024-01-01T06:00:00Z")])
    run()
    activity = read_activity(spark, landed)
    assert facts_of(spark, out) == {name: rows(build(activity)) for name, build in BUILDERS.items()}
    run_day(spark, landed, out, "2024-01-01")
    assert facts_of(spark, out) == {name: rows(build(activity)) for name, build in BUILDERS.items()}


def test_a_day_that_changes_meanwhile_is_left_alone(spark, landed, streamed, monkeypatch):  # noqa: F811
    out, _ = streamed
    real = compaction.write_fact

    def overtaken(built, root, name, batch):
        written = real(built, root, name, batch)
        if name == "commits":
            run_days(spark, landed, out, "2024-01-01", "2024-01-01")
        return written

    monkeypatch.setattr(compaction, "write_fact", overtaken)
    before = facts_of(spark, out)
    assert compact(spark, out, "2024-01-03", facts=("commits",)) == {"commits": 0}
    monkeypatch.undo()
    assert facts_of(spark, out) == before
    (run,) = read_manifest(spark, out).batches("commits", "2024-01-01")
    assert run.startswith("run-")
    tidy(spark, out, keep_seconds=0)
    assert not list(pathlib.Path(out).glob("commits/*/*/batch=compact-*"))


def test_compaction_of_nothing(spark, tmp_path):
    assert compact(spark, str(tmp_path), "2024-01-03") == {"repos": 0, "commits": 0, "members": 0}
