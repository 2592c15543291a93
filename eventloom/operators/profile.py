"""First looks at raw activity: counts, spans, missing hours."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.functions.calendar import hour_file_name
from eventloom.functions.columns import with_event_time


def activity_count(activity: DataFrame) -> DataFrame:
    return activity.agg(F.count(F.lit(1)).alias("total_events"))


def event_span(activity: DataFrame) -> DataFrame:
    return activity.agg(
        F.min("created_at").alias("min_created_at"), F.max("created_at").alias("max_created_at")
    )


def events_per_hour(activity: DataFrame) -> DataFrame:
    """Events per hour of the day."""
    return with_event_time(activity).groupBy("hour").agg(F.count(F.lit(1)).alias("total_events"))


def events_per_type(activity: DataFrame) -> DataFrame:
    return (
        activity.groupBy("type")
        .agg(F.count(F.lit(1)).alias("total_events"))
        .orderBy(F.desc("total_events"), "type")
    )


def events_per_repo(activity: DataFrame) -> DataFrame:
    return activity.groupBy(F.col("repo.name").alias("repo_name_full")).agg(
        F.count(F.lit(1)).alias("total_events")
    )


def missing_hours(activity: DataFrame) -> DataFrame:
    """Hours without events from the first to the last day seen.

    ``file_name`` is the file such events would be in. It may have landed and be
    empty: ``sources.missing_files`` goes by the files. Both sides of the
    anti-join are as long as the calendar, and both come from the same shuffle:
    the count keeps the calendar from being read off the activity once more.
    """
    seen = (
        with_event_time(activity)
        .where("date IS NOT NULL AND hour IS NOT NULL")
        .select("date", "hour")
        .distinct()
    )
    days = seen.agg(
        F.min("date").alias("first_day"),
        F.max("date").alias("last_day"),
        F.count(F.lit(1)).alias("hours_seen"),
    )
    hours = (
        days.where("hours_seen > 0")
        .select(F.explode(F.sequence("first_day", "last_day")).alias("date"))
        .select("date", F.explode(F.sequence(F.lit(0), F.lit(23))).alias("hour"))
    )
    return hours.join(seen, ["date", "hour"], "left_anti").select(
        "date", "hour", hour_file_name(F.col("date"), F.col("hour")).alias("file_name")
    )
