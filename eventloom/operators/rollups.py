"""Counts per hour and their daily sums, shared by the commit and member facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def hourly(fact: DataFrame) -> DataFrame:
    """Fact rows per (date, hour ``h``), newest first."""
    return (
        fact.groupBy("date", F.hour("created_at").alias("h"))
        .agg(F.count(F.lit(1)).alias("total"))
        .orderBy(F.desc("date"), F.desc("h"))
    )


def daily(hourly_counts: DataFrame) -> DataFrame:
    """Sums per date of a result with a ``total`` column."""
    return hourly_counts.groupBy("date").agg(F.sum("total").alias("total")).orderBy("date")


def with_limit(rows: DataFrame, n: int = 0) -> DataFrame:
    """The first ``n`` rows, or all of them if ``n`` is not positive.

    After a sort this becomes a top-k: each task keeps ``n`` rows.
    """
    return rows.limit(n) if n > 0 else rows
