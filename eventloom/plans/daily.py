"""Daily jobs: hourly files to facts, facts to metric files."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Observation, SparkSession
from pyspark.sql import functions as F

from eventloom.functions.calendar import day_names
from eventloom.functions.columns import with_event_time
from eventloom.operators import commits as commit_ops
from eventloom.operators import members as member_ops
from eventloom.operators import owners as owner_ops
from eventloom.operators import rollups
from eventloom.operators.facts import BUILDERS
from eventloom.plans.incremental import KEPT_METRICS, KEPT_SETS, advance
from eventloom.schemas import FACTS, SOURCE_DATE, input_schema
from eventloom.sinks.files import export_csv, new_run, remove, remove_unchanged, staged, write_fact
from eventloom.sinks.manifest import KEEP_SECONDS, Manifest, begin, commit, keep_inputs, tidy
from eventloom.sources.facts import read_fact
from eventloom.sources.raw import landed_files, read_listed, rejected_lines


@dataclass(frozen=True)
class RunSummary:
    """Counts of one extraction; ``rows_out`` is per fact."""

    rows_in: int
    rejected: int
    rows_out: dict[str, int]

    def ratio(self, fact: str) -> float | None:
        out = self.rows_out[fact]
        return self.rows_in / out if out else None


def run_day(spark: SparkSession, in_root: str, out_root: str, day: str, facts=tuple(FACTS), clean: bool = False) -> RunSummary:
    """Rebuild everything that comes from the files of ``day``."""
    return run_days(spark, in_root, out_root, day, day, facts, clean)


def run_days(
    spark: SparkSession,
    in_root: str,
    out_root: str,
    first_day: str,
    last_day: str,
    facts=tuple(FACTS),
    clean: bool = False,
    keep_seconds: float = KEEP_SECONDS,
) -> RunSummary:
    """Build facts from the files of a range of days, parsing each file once.

    The files are listed first, and all that follows is about just these. The
    parsed columns, with the time already split up, are written to shared
    storage and the facts are built from there; that copy goes afterwards. All
    is counted while it is written: one job per fact.

    Readers see nothing of it until one commit puts the run in place of all that
    other runs, or a stream, had stored from files of these days, also where
    this run has no rows. What it replaced is removed after ``keep_seconds``, by
    whichever run is the next.

    Lines without a usable time are kept in ``rejects`` beside the facts.
    ``clean`` deletes the listed files at the end, unless they have changed.
    """
    facts = tuple(facts)
    days, run, schema = day_names(first_day, last_day), new_run(), input_schema(facts)
    begin(spark, out_root)
    files = landed_files(spark, in_root, first_day, last_day)
    keep_inputs(spark, out_root, run, files)
    seen, written = Observation(), {}
    activity = with_event_time(read_listed(spark, files, schema)).drop("created_at")
    activity = activity.observe(
        seen, F.count(F.lit(1)).alias("rows_in"), F.count_if(F.col("event_ts").isNull()).alias("rejected")
    )
    with staged(activity, out_root) as activity:
        for name in facts:
            written[name] = write_fact(BUILDERS[name](activity, carry=(SOURCE_DATE,)), out_root, name, run)

    def replace(manifest: Manifest) -> None:
        for name in facts:
            for day in days:
                manifest.put(name, day, [run])

    commit(spark, out_root, replace)
    counts = {"rows_in": 0, "rejected": 0} | seen.get
    for day in days:
        remove(spark, f"{out_root.rstrip('/')}/rejects/{SOURCE_DATE}={day}")
    if counts["rejected"]:
        rejected_lines(spark, files).write.mode("append").partitionBy(SOURCE_DATE).json(f"{out_root.rstrip('/')}/rejects")
    tidy(spark, out_root, keep_seconds)
    if clean:
        remove_unchanged(spark, files)
    return RunSummary(counts["rows_in"], counts["rejected"], written)


METRICS = {
    "repos": ("repos", owner_ops.repo_owners_gt1),
    "commits_gt1": ("commits", commit_ops.commits_ge2_per_day),
    "commits_lt1": ("commits", commit_ops.inactive_days),
    "members": ("members", member_ops.projects_gt10_members),
}

#: Further statistics, exported when they are asked for.
STATISTICS = {
    "members_hourly": ("members", member_ops.members_hourly),
    "members_daily": ("members", lambda m: rollups.daily(member_ops.members_hourly(m))),
    "commits_hourly": ("commits", commit_ops.commits_hourly),
    "commits_daily": ("commits", lambda c: rollups.daily(commit_ops.commits_hourly(c))),
    "commit_day_span": ("commits", commit_ops.commit_day_span),
    "running_commits": ("commits", commit_ops.running_commits_per_day),
    "repos_daily_rows": ("repos", owner_ops.repos_daily_rows),
    "members_total": ("members", member_ops.projects_gt10_total),
}


def run_metrics(
    spark: SparkSession,
    facts_root: str,
    out_root: str,
    run_date: str,
    date_from: str | None = None,
    date_to: str | None = None,
    only=tuple(METRICS),
    limit: int = 0,
    kept: bool = False,
) -> list[str]:
    """Export metrics over all stored days, or over a range of them.

    ``only`` names metrics or further statistics; a positive ``limit`` keeps the
    first rows of each by its own order, as a page of top entries does. With
    ``kept``, metrics over all days that kept sets answer are read from these,
    brought up to date before.
    """
    known = METRICS | STATISTICS
    if unknown := set(only) - known.keys():
        raise ValueError(f"unknown metrics: {sorted(unknown)}")

    from_sets = KEPT_METRICS if kept and not (date_from or date_to) else {}
    if asked := {KEPT_SETS[name] for name in only if name in from_sets}:
        advance(spark, facts_root, sorted(asked))

    def result(name: str):
        if name in from_sets:
            rows = from_sets[name](spark, facts_root)
            if limit > 0 and name == "commits_lt1":
                rows = rows.orderBy("author_name", "interval_start_dt")
            return rollups.with_limit(rows, limit)
        fact, metric = known[name]
        rows = read_fact(spark, facts_root, fact, date_from, date_to)
        if limit > 0 and name == "commits_lt1":
            return commit_ops.top_inactive_days(rows, limit)
        return rollups.with_limit(metric(rows), limit)

    return [export_csv(result(name), out_root, name, run_date) for name in only]
