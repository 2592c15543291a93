"""Few large files for days that a stream has filled in many small batches."""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.schemas import FACTS, SOURCE_DATE
from eventloom.sinks.files import write_fact
from eventloom.sinks.manifest import KEEP_SECONDS, Manifest, commit, read_manifest, tidy
from eventloom.sources.facts import stored_fact

#: Size that files are packed to, by what the shuffle before the write measures.
FILE_SIZE = "128MB"
_ADVISED = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


@contextlib.contextmanager
def _file_size(spark: SparkSession, size: str) -> Iterator[None]:
    before = spark.conf.get(_ADVISED)
    spark.conf.set(_ADVISED, size)
    try:
        yield
    finally:
        spark.conf.set(_ADVISED, before)


def _rolled_up(rows: DataFrame, name: str) -> DataFrame:
    """``repos`` has been counted per batch: here, too, one row per hour and repository of a day's files."""
    if name != "repos":
        return rows
    return rows.groupBy(SOURCE_DATE, "date", "hour", "repo_author", "repo_name").agg(F.sum("total_events").alias("total_events"))


def compact(
    spark: SparkSession,
    root: str,
    before_day: str,
    facts=tuple(FACTS),
    file_size: str = FILE_SIZE,
    keep_seconds: float = KEEP_SECONDS,
) -> dict[str, int]:
    """Brings the batches of each day of files before ``before_day`` together in one; returns how many per fact.

    Days with one batch are left alone. The rows stay the same, but for ``repos``
    added up over batches; ``read_fact`` gives what it gave. All days of a fact are one job: their rows are
    shuffled by partition, small ones together and large ones apart, into files
    of about ``file_size``.

    Readers and streams may go on meanwhile. A day whose batches have changed
    since, by a run or a further stream batch, is left as it has become; what
    was written for it is never read and goes with ``tidy``.
    """
    manifest, replaced = read_manifest(spark, root), dict.fromkeys(facts, 0)
    for name in facts:
        days = {} if manifest is None else manifest.live.get(name, {})
        crowded = {day: list(found) for day, found in days.items() if len(found) > 1 and day < before_day}
        if not crowded:
            continue
        batch = f"compact-{uuid.uuid4().hex}"
        rows = stored_fact(spark, root, name)
        rows = rows.where(F.col(SOURCE_DATE).isin([F.lit(day).cast("date") for day in crowded]))
        with _file_size(spark, file_size):
            write_fact(_rolled_up(rows, name), root, name, batch)
        kept: list[str] = []

        def swap(newest: Manifest, name=name, crowded=crowded, batch=batch, kept=kept) -> None:
            kept[:] = [day for day, before in crowded.items() if newest.batches(name, day) == before]
            for day in crowded:
                if day in kept:
                    newest.put(name, day, [batch])
                else:
                    newest.retire(name, day, batch)

        commit(spark, root, swap)
        replaced[name] = sum(len(crowded[day]) for day in kept)
    tidy(spark, root, keep_seconds)
    return replaced
