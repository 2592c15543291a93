"""An index of landed hourly files: which are whole, which are empty, which were cut off.

A file with content is read once after it has landed or changed; its length, time and lines are then
kept under an index folder. Hours of a day are told apart by it: ``complete``, ``empty``,
``cut`` (the download broke off, or the file is damaged), ``missing`` and ``unread``.
"""

from __future__ import annotations

import uuid
from collections import Counter

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom.functions.calendar import hour_file_name
from eventloom.schemas import LONG, TEXT
from eventloom.sinks.manifest import location
from eventloom.sources.raw import day_files, landed_files

_FILE = T.StructType([T.StructField("path", TEXT), T.StructField("length", LONG), T.StructField("modified", LONG)])
_INDEX = T.StructType([*_FILE.fields, T.StructField("lines", LONG), T.StructField("state", TEXT)])
_WRAP = 1 << 32


def read_index(spark: SparkSession, index_root: str) -> DataFrame:
    """All files ever indexed, as (path, length, modified, lines, state): one row per content seen."""
    files, folder = location(spark, index_root)
    if not files.exists(folder):
        return spark.createDataFrame([], _INDEX)
    rows = spark.read.schema(_INDEX).parquet(f"{index_root.rstrip('/')}/update=*")
    return rows.dropDuplicates(["path", "length", "modified"])


def _noted_length(content: str):
    """The number that the last four bytes of a file are, lowest byte first."""
    last = F.hex(F.substring(content, -4, 4))
    return F.conv(F.concat(*[F.substring(last, i, 2) for i in (7, 5, 3, 1)]), 16, 10).cast("long")


def _readable(spark: SparkSession, path: str) -> bool:
    """Whether a file unpacks to its end; one that does not fails the job that reads it."""
    try:
        spark.read.option("ignoreCorruptFiles", False).text(path).count()
        return True
    except (Py4JJavaError, PySparkException):
        return False


def index_files(spark: SparkSession, root: str, index_root: str, first_day: str | None = None, last_day: str | None = None) -> dict[str, int]:
    """Indexes files that are new or changed since they were indexed; returns how many have each state.

    One task per file unpacks it and counts lines and bytes, keeping what it had
    where the file breaks off. The length that gzip notes in a file's last four
    bytes tells whole files: their bytes are as many, modulo 2^32, with or without
    a last line break. Files where this differs are read alone, each in a job of
    its own that fails if the file is damaged: a whole one may consist of several
    gzip parts, and then notes the last one's length. Damage that changes bytes but
    not their number is not looked for: ``rejected_lines`` shows its broken lines.
    """
    files = landed_files(spark, root, first_day, last_day)
    if not files:
        return {}
    known = {(r.path, r.length, r.modified) for r in _of(spark, index_root, files).toLocalIterator()}
    new = [f for f in files if (f["path"], f["length"], f["modified"]) not in known]
    if not new:
        return {}
    paths = [f["path"] for f in new]
    listed = spark.createDataFrame([(f["path"], f["length"], f["modified"]) for f in new], _FILE)
    text = spark.read.option("ignoreCorruptFiles", True).option("lineSep", "\n").text(paths)
    # Paths of text are escaped, those of whole files are not: names are plain and unique in a folder.
    found = text.groupBy(F.col("_metadata.file_name").alias("name")).agg(
        F.count(F.lit(1)).alias("lines"), F.sum(F.octet_length("value") + F.lit(1).cast("long")).alias("bytes")
    )
    noted = spark.read.format("binaryFile").load(paths).select(
        F.element_at(F.split("path", "/"), -1).alias("name"), _noted_length("content").alias("noted")
    )
    none = F.lit(0).cast("long")
    rows = (
        listed.withColumn("name", F.element_at(F.split("path", "/"), -1))
        .join(noted, "name", "left").join(found, "name", "left")
        .select(*_FILE.fieldNames(), F.coalesce("lines", none).alias("lines"), F.coalesce("bytes", none).alias("bytes"), "noted")
    )
    excess = F.pmod(F.col("bytes") - F.col("noted"), F.lit(_WRAP))
    as_noted = F.when(F.col("lines") > 0, excess <= 1).otherwise(F.col("noted") == 0)
    out = []
    for row in rows.withColumn("as_noted", F.coalesce(as_noted, F.lit(False))).collect():
        if not row.as_noted and not _readable(spark, row.path):
            state = "cut"
        else:
            state = "complete" if row.lines else "empty"
        out.append((row.path, row.length, row.modified, row.lines, state))
    target = f"{index_root.rstrip('/')}/update={uuid.uuid4().hex}"
    spark.createDataFrame(out, _INDEX).coalesce(1).write.parquet(target)
    return dict(Counter(state for *_, state in out))


def _of(spark: SparkSession, index_root: str, files: list[dict]) -> DataFrame:
    """What the index has about just these contents."""
    listed = spark.createDataFrame([(f["path"], f["length"], f["modified"]) for f in files], _FILE)
    return read_index(spark, index_root).join(listed, _FILE.fieldNames())


def _without_bytes(spark: SparkSession, root: str, first_day: str, last_day: str | None) -> list[str]:
    """Names of files of no length, which Spark's own listings pass over."""
    files, pattern = location(spark, f"{root.rstrip('/')}/{day_files(first_day, last_day)}")
    return [status.getPath().getName() for status in files.globStatus(pattern) or [] if not status.getLen()]


def hours_landed(spark: SparkSession, root: str, index_root: str, first_day: str, last_day: str | None = None) -> DataFrame:
    """Each hour of the days as (date, hour, file_name, state, length, lines), in order.

    Goes by the files as they are now: one that has landed or changed since it was
    indexed is ``unread``, and one without a byte is ``empty``. Length and lines are
    null where they are not known.
    """
    files = landed_files(spark, root, first_day, last_day)
    listed = spark.createDataFrame([(f["path"], f["length"], f["modified"]) for f in files], _FILE)
    known = listed.join(read_index(spark, index_root), _FILE.fieldNames(), "left").select(
        F.element_at(F.split("path", "/"), -1).alias("file_name"), "length", "lines", F.coalesce("state", F.lit("unread")).alias("state")
    )
    nothing = [(name, 0, 0, "empty") for name in _without_bytes(spark, root, first_day, last_day)]
    known = known.unionByName(spark.createDataFrame(nothing, known.schema))
    days = F.sequence(F.lit(first_day).cast("date"), F.lit(last_day or first_day).cast("date"))
    hours = (
        spark.range(1).select(F.explode(days).alias("date"))
        .select("date", F.explode(F.sequence(F.lit(0), F.lit(23))).alias("hour"))
        .withColumn("file_name", hour_file_name(F.col("date"), F.col("hour")))
    )
    return hours.join(known, "file_name", "left").select(
        "date", "hour", "file_name", F.coalesce("state", F.lit("missing")).alias("state"), "length", "lines"
    ).orderBy("date", "hour")
