"""Commits per author and day, and days without any."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventloom.operators.facts import build_commits
from eventloom.operators.rollups import hourly

# Commits of one author and instant that are expanded within one task.
_EXPAND_AT_ONCE = 1000


def _commits_per_day(commits: DataFrame) -> DataFrame:
    return commits.groupBy("date", "author_name").agg(F.count(F.lit(1)).alias("total_commits"))


def commits_ge2_per_day(commits: DataFrame) -> DataFrame:
    """Authors with two or more commits in a day, by name and number of commits."""
    return (
        _commits_per_day(commits)
        .where("total_commits >= 2")
        .orderBy("author_name", F.desc("total_commits"), "date")
    )


def commits_gt1_from_raw(activity: DataFrame) -> DataFrame:
    """The same authors from raw events, most commits first."""
    return (
        _commits_per_day(build_commits(activity))
        .where("total_commits > 1")
        .orderBy(F.desc("total_commits"), F.desc("author_name"), "date")
    )


def commits_le1_per_day(activity: DataFrame) -> DataFrame:
    """Authors with just one commit on a day they were active."""
    return (
        _commits_per_day(build_commits(activity))
        .where("total_commits <= 1")
        .orderBy(F.desc("total_commits"), F.desc("author_name"), "date")
    )


def commit_day_span(commits: DataFrame) -> DataFrame:
    """First and last day with a commit.

    ``date`` is the day of ``created_at`` and a partition column of the stored
    fact: no column is read there.
    """
    return commits.agg(
        F.min("date").alias("min_created_at"), F.max("date").alias("max_created_at")
    )


def commits_hourly(commits: DataFrame) -> DataFrame:
    return hourly(commits)


def running_commits_per_day(commits: DataFrame) -> DataFrame:
    """Each commit with the author's number of commits of that day up to it.

    Commits of one instant share the value, as under SQL's default RANGE frame.
    They are therefore counted before the window: it then sees one row per
    author and distinct instant of a day, however many commits fall into one.
    Each counted row becomes chunks of its commits, and these are dealt out
    before they are expanded, so a crowded instant is spread over all tasks.
    The number of partitions is given, as adaptive execution would merge the
    chunks by their bytes.
    """
    instants = commits.groupBy("author_name", "date", "created_at").agg(
        F.count(F.lit(1)).alias("n")
    )
    so_far = (
        Window.partitionBy("author_name", "date")
        .orderBy("created_at")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    counted = instants.withColumn("sum_commits", F.sum("n").over(so_far))
    size = F.lit(_EXPAND_AT_ONCE).cast("long")
    starts = F.sequence(F.lit(0).cast("long"), F.col("n") - 1, size)
    tasks = int(commits.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunks = counted.withColumn("start", F.explode(starts)).repartition(
        tasks, "author_name", "created_at", "start"
    )
    copies = F.array_repeat(F.lit(True), F.least(F.col("n") - F.col("start"), size).cast("int"))
    return chunks.withColumn("copy", F.explode(copies)).select(
        "author_name", "created_at", "date", "sum_commits"
    )


def idle_spans(commits: DataFrame) -> DataFrame:
    """Per author, the runs of days without a commit, first and last day of each.

    The calendar runs from the first to the last commit day of all authors,
    commits without an author included. The window sees at most one row per
    author and day.

    The calendar is read off the same distinct author-days as the spans. Its
    count, which depends on their being distinct, keeps the optimizer from
    going back to the commits for it: both sides then share one shuffle.
    """
    active = commits.where(F.col("date").isNotNull()).select("author_name", "date").distinct()
    calendar = active.agg(
        F.min("date").alias("first_day"),
        F.max("date").alias("last_day"),
        F.count(F.lit(1)).alias("author_days"),
    ).where("author_days > 0")
    first_day = calendar.select("first_day").scalar()
    last_day = calendar.select("last_day").scalar()
    by_day = Window.partitionBy("author_name").orderBy("date")
    neighbours = active.withColumns(
        {"previous": F.lag("date").over(by_day), "next": F.lead("date").over(by_day)}
    )

    def run(start, end):
        return F.struct(start.alias("idle_from"), end.alias("idle_to"))

    before = run(
        F.coalesce(F.date_add("previous", 1), first_day), F.date_sub("date", 1)
    )
    after_last = run(F.date_add("date", 1), last_day)
    runs = F.when(F.col("next").isNull(), F.array(before, after_last)).otherwise(F.array(before))
    known = F.when(F.col("author_name").isNotNull(), runs)
    return neighbours.select("author_name", F.inline(known)).where("idle_from <= idle_to")


def _days_of(spans: DataFrame) -> DataFrame:
    return spans.select(
        "author_name", F.explode(F.sequence("idle_from", "idle_to")).alias("interval_start_dt")
    )


def inactive_days(commits: DataFrame) -> DataFrame:
    """Each author with each day of the calendar on which they have no commit.

    The result has about authors x days rows and no order: write it, do not
    collect it.
    """
    return _days_of(idle_spans(commits))


def top_inactive_days(commits: DataFrame, n: int) -> DataFrame:
    """The first ``n`` rows of ``inactive_days`` by author and day.

    The first ``n`` idle spans hold at least the first ``n`` idle days, so only
    those are expanded.
    """
    spans = idle_spans(commits).orderBy("author_name", "idle_from").limit(n)
    return _days_of(spans).orderBy("author_name", "interval_start_dt").limit(n)
