"""Columns derived from the raw event: UTC time parts and repository parts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: Time text that names its zone: ``Z``, ``+hh:mm`` or ``+hhmm``.
_ZONED = r"^\d{4}-.*(Z|T.*[+-]\d{2}:?\d{2})$"
_EPOCH = "1970-01-01 00:00:00"


def utc_timestamp(text: Column) -> Column:
    """UTC wall-clock time of ISO-8601 text with a zone, else NULL.

    The text is an exact instant, told in UTC by counting from the epoch. So the
    TIMESTAMP_NTZ is the same under any session time zone. Text without a zone
    is ambiguous and has no time.
    """
    instant = F.when(text.rlike(_ZONED), text).try_cast("timestamp")
    return F.timestamp_add("MICROSECOND", F.unix_micros(instant), F.lit(_EPOCH).cast("timestamp_ntz"))


def with_event_time(activity: DataFrame) -> DataFrame:
    """Add ``event_ts``, ``date`` and ``hour``; all NULL for an unusable time.

    The time comes out of a generator of one row: filters and projections of it
    stay above, so each event is parsed once, however often its time is used.

    A frame that already has them is returned as it is, so a job can parse the
    time once and keep it.
    """
    if {"event_ts", "date", "hour"} <= set(activity.columns):
        return activity
    timed = activity.select("*", F.explode(F.array(utc_timestamp(F.col("created_at")))).alias("event_ts"))
    return timed.withColumns({"date": F.to_date("event_ts"), "hour": F.hour("event_ts")})


def with_repo_columns(activity: DataFrame) -> DataFrame:
    """Split ``repo.name`` (``owner/name``) into ``repo_author`` and ``repo_name``.

    A name without a slash has a NULL ``repo_name``; further parts are ignored.
    """
    parts = F.split("repo.name", "/")
    return activity.withColumns(
        {"repo_author": F.get(parts, F.lit(0)), "repo_name": F.get(parts, F.lit(1))}
    )
