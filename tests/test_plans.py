"""Physical plans: what must, and what must not, be in them."""

from __future__ import annotations

import re

import pytest

from eventloom.operators import facts, owners
from eventloom.plans.catalog import QUERIES
from eventloom.sources import read_events_activity
from tests.conftest import TESTDATA

SF = f"{TESTDATA}/sf0.001"


def initial_plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def scans_run(df) -> int:
    """File scans that ran; reused shuffles and subqueries are not run again."""
    df.collect()

    def items(seq):
        return [seq.apply(i) for i in range(seq.size())]

    def count(node) -> int:
        name = node.nodeName()
        if name.startswith("Reused"):
            return 0
        if name == "AdaptiveSparkPlan":
            return count(node.executedPlan())
        below = [node.plan()] if "QueryStage" in name else items(node.children())
        below += items(node.subqueries())
        return int(name.startswith("Scan parquet")) + sum(map(count, below))

    return count(df._jdf.queryExecution().executedPlan())


def read_schemas(df) -> list[str]:
    """Columns each Parquet scan reads, unabridged."""
    found = []

    def visit(node):
        if node.nodeName().startswith("Scan parquet"):
            found.append(node.requiredSchema().simpleString())
        for i in range(node.children().size()):
            visit(node.children().apply(i))

    visit(df._jdf.queryExecution().sparkPlan())
    return found


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_worker_no_product_and_pruned_columns(spark, name):
    plan = initial_plan(QUERIES[name](spark, SF))
    for node in ("PythonUDF", "ArrowEval", "BatchEvalPython", "MapInPandas", "CartesianProduct",
                 "BroadcastNestedLoopJoin", "Scan ExistingRDD"):
        assert node not in plan
    for schema in re.findall(r"ReadSchema: struct<(.*?)>", plan):
        assert "value" not in schema and "props" not in schema


@pytest.mark.parametrize("name", sorted(facts.BUILDERS))
def test_builders_do_not_sort(spark, name):
    plan = initial_plan(facts.BUILDERS[name](read_events_activity(spark, SF)))
    assert "rangepartitioning" not in plan and "Sort [" not in plan
    assert plan.count("Exchange") == (1 if name == "repos" else 0)


@pytest.mark.parametrize("name", ["top_repo_owners", "top_commit_days", "top_inactive_days", "top_projects"])
def test_top_k_keeps_k_rows_per_task_instead_of_sorting(spark, name):
    plan = initial_plan(QUERIES[name](spark, SF))
    assert "TakeOrderedAndProject(limit=100" in plan
    assert "rangepartitioning" not in plan


@pytest.mark.parametrize("name", ["repo_owner_total", "projects_gt10_total"])
def test_a_sort_below_a_count_is_dropped(spark, name):
    assert "rangepartitioning" not in initial_plan(QUERIES[name](spark, SF))


@pytest.mark.parametrize("name", ["commits_daily", "members_daily"])
def test_daily_sums_sort_days_only(spark, name):
    assert initial_plan(QUERIES[name](spark, SF)).count("rangepartitioning") == 1


def test_distinct_counts_ignore_the_rollup_below_them(spark):
    """Owners of the fact cost the same shuffles as owners of the events."""
    activity = read_events_activity(spark, SF)
    shuffles = initial_plan(owners.repo_owners_gt1(facts.build_repos(activity))).count("Exchange hashpartitioning")
    assert shuffles == 2


def test_a_hot_owner_is_spread_over_names_before_it_is_counted(spark):
    plan = initial_plan(owners.repo_owner_activity(read_events_activity(spark, SF)))
    keys = re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", plan)
    assert [len(k.split(", ")) for k in keys] == [1, 2]  # printed top down


@pytest.mark.parametrize("name", ["inactive_days", "top_inactive_days", "missing_hours",
                                  "running_commits_per_day", "reduction_ratio", "commits_daily"])
def test_the_events_are_scanned_once(spark, name):
    assert scans_run(QUERIES[name](spark, SF)) == 1


def test_running_count_windows_over_counted_instants(spark):
    plan = initial_plan(QUERIES["running_commits_per_day"](spark, SF))
    assert plan.index("Window") < plan.index("partial_count(1)")
    # Before adaptive execution drops anything: one window, one sort.
    assert len(re.findall(r"\bWindow \[", plan)) == 1 and len(re.findall(r"\bSort \[", plan)) == 1


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    target = str(tmp_path_factory.mktemp("stored") / "activity")
    read_events_activity(spark, SF).write.parquet(target)
    return spark.read.parquet(target)


STORED_SCHEMAS = {
    "repos": "struct<created_at:string,repo:struct<name:string>>",
    "commits": "struct<type:string,created_at:string,"
               "payload:struct<commits:array<struct<author:struct<name:string>>>>>",
    "members": "struct<type:string,created_at:string,actor:struct<login:string>,org:struct<login:string>,"
               "repo:struct<name:string>,payload:struct<action:string,member:struct<login:string,type:string>>>",
}


@pytest.mark.parametrize("name", sorted(facts.BUILDERS))
def test_builders_read_only_their_nested_fields(stored, name):
    assert read_schemas(facts.BUILDERS[name](stored)) == [STORED_SCHEMAS[name]]


def test_type_filter_reaches_a_stored_activity(spark, stored):
    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)
    assert "EqualTo(type,PushEvent)" in initial_plan(facts.build_commits(stored))
    assert "EqualTo(payload.action,added)" in initial_plan(facts.build_members(stored))
