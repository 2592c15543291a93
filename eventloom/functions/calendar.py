"""Names of hourly files and days."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

FILE_SUFFIX = ".json.gz"


def hour_file_name(date: Column, hour: Column) -> Column:
    """``2024-01-31-7.json.gz``: the hour carries no leading zero."""
    return F.concat(date.cast("string"), F.lit("-"), hour.cast("string"), F.lit(FILE_SUFFIX))


def day_names(first_day: str, last_day: str) -> list[str]:
    """ISO names of the days from ``first_day`` to ``last_day``, both included."""
    first, last = dt.date.fromisoformat(first_day), dt.date.fromisoformat(last_day)
    if last < first:
        raise ValueError(f"{last_day} is before {first_day}")
    return [(first + dt.timedelta(days=i)).isoformat() for i in range((last - first).days + 1)]
