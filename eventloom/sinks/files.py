"""Fact tables as partitioned Parquet, metric results as CSV.

Facts lie in ``source_date=<day of the file>/date=<day of the event>/batch=<run>``.
The innermost part is the batch run or the stream batch that wrote them, so runs
never write over each other, and both kinds share one table.
"""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from eventloom.schemas import BATCH, FACTS, SOURCE_DATE
from eventloom.sinks.manifest import location


def remove(spark: SparkSession, target: str) -> None:
    """Deletes a folder or file, if it is there."""
    files, path = location(spark, target)
    files.delete(path, True)


def exists(spark: SparkSession, target: str) -> bool:
    files, path = location(spark, target)
    return files.exists(path)


def remove_unchanged(spark: SparkSession, files: list[dict]) -> int:
    """Deletes files (path, length, modified) that are still as they were listed; returns how many."""
    gone = 0
    for file in files:
        system, path = location(spark, file["path"])
        if system.exists(path):
            status = system.getFileStatus(path)
            if (status.getLen(), status.getModificationTime()) == (file["length"], file["modified"]):
                gone += bool(system.delete(path, False))
    return gone


@contextlib.contextmanager
def staged(rows: DataFrame, root: str) -> Iterator[DataFrame]:
    """``rows`` as a Parquet copy on shared storage, beside what is built from it, for the time of the block.

    It lies in the folder that the cluster names in ``spark.checkpoint.dir``, or
    under ``root``, which is shared as well. Lost executors lose none of it.
    """
    spark = rows.sparkSession
    folder = (spark.conf.get("spark.checkpoint.dir", None) or root).rstrip("/")
    target = f"{folder}/_staged-{uuid.uuid4().hex}"
    try:
        rows.write.parquet(target)
        yield spark.read.schema(rows.schema).parquet(target)
    finally:
        remove(spark, target)


def new_run() -> str:
    """A name for the partitions of one batch run."""
    return f"run-{uuid.uuid4().hex}"


def write_fact(rows: DataFrame, root: str, name: str, batch: str) -> int:
    """Stores fact rows that carry ``source_date`` under ``batch``; returns how many.

    A repeated batch replaces its own partitions. Rows of a partition are
    brought together first: otherwise each task writes a small file to every day
    it has rows of. Large days are split again. Rows are counted as they are
    written, in the tasks that write.
    """
    written = Observation()
    out = rows.select(SOURCE_DATE, *FACTS[name].fieldNames(), F.lit(batch).alias(BATCH))
    partitions = (SOURCE_DATE, "date", BATCH)
    out.hint("rebalance", *partitions).observe(written, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy(*partitions).parquet(f"{root.rstrip('/')}/{name}")
    return written.get.get("rows", 0)


def export_csv(rows: DataFrame, root: str, metric: str, date: str) -> str:
    """The whole result as CSV part files under ``<root>/<metric>_<date>``.

    Text is kept exactly, outer blanks, quotes and line breaks included; a quote
    within a field is doubled. An empty text is ``""`` and NULL an empty field.
    A sorted result stays sorted in the order of its part files.
    """
    target = f"{root.rstrip('/')}/{metric}_{date}"
    rows.write.mode("overwrite").options(
        header=True,
        escape='"',
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
        emptyValue='""',
        nullValue="",
    ).csv(target)
    return target
