"""Raw hourly event files: gzip JSON lines named ``YYYY-MM-DD-H.json.gz``.

Gzip cannot be split, so the unit of parallelism is one hourly file. Each row
carries ``source_date``, the day in its file's name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom.functions.calendar import FILE_SUFFIX, day_names, hour_file_name
from eventloom.functions.columns import utc_timestamp
from eventloom.schemas import ACTIVITY, SOURCE_DATE, SOURCE_FILE

_ANY_AGE = "36500d"


def _with_source_date(rows: DataFrame) -> DataFrame:
    day = F.substring(F.col("_metadata.file_name"), 1, 10)
    return rows.withColumn(SOURCE_DATE, day.try_cast("date"))


def read_activity(
    spark: SparkSession,
    root: str,
    first_day: str | None = None,
    last_day: str | None = None,
    schema: T.StructType = ACTIVITY,
) -> DataFrame:
    """All hourly files of a day, of a range of days or, with no day, of ``root``.

    The days become a file-name filter of one scan: other files are dropped
    when the folder is listed. No matching file gives an empty frame.
    """
    reader = spark.read.schema(schema).option("pathGlobFilter", day_files(first_day, last_day))
    return _with_source_date(reader.json(root))


def landed_files(spark: SparkSession, root: str, first_day: str | None = None, last_day: str | None = None) -> list[dict]:
    """The hourly files of the days as they are now: (path, length, modified), by path. Contents are not read."""
    found = (
        spark.read.format("binaryFile").option("pathGlobFilter", day_files(first_day, last_day)).load(root)
        .select("path", "length", F.unix_millis("modificationTime").alias("modified"))
    )
    return sorted((row.asDict() for row in found.collect()), key=lambda file: file["path"])


def read_listed(spark: SparkSession, files: list[dict], schema: T.StructType = ACTIVITY) -> DataFrame:
    """``read_activity`` of just these files, whatever has landed since they were listed."""
    if not files:
        return spark.createDataFrame([], schema).withColumn(SOURCE_DATE, F.lit(None).cast("date"))
    return _with_source_date(spark.read.schema(schema).json([file["path"] for file in files]))


def day_files(first_day: str | None, last_day: str | None) -> str:
    """The pattern of names of the days' hourly files."""
    if last_day and not first_day:
        raise ValueError("last_day needs first_day")
    if not first_day:
        return f"*{FILE_SUFFIX}"
    return f"{{{','.join(day_names(first_day, last_day or first_day))}}}-*{FILE_SUFFIX}"


def rejected_lines(spark: SparkSession, files: list[dict]) -> DataFrame:
    """The raw lines of listed files that give no event time: (source_date, file_name, line).

    Broken JSON is among them, as are times that are missing, malformed or
    without a zone. Reads the files as text.
    """
    lines = _with_source_date(spark.read.text([file["path"] for file in files]))
    lines = lines.select(SOURCE_DATE, F.col("_metadata.file_name").alias("file_name"), F.col("value").alias("line"))
    # Parsed in the mode of the events, so a line is broken here if it is broken there.
    parsed = F.from_json("line", T.StructType([T.StructField("created_at", T.StringType())]))
    usable = utc_timestamp(parsed["created_at"]).isNotNull()
    return lines.where((F.trim("line") != "") & ~usable)


def missing_files(spark: SparkSession, root: str, first_day: str, last_day: str | None = None) -> DataFrame:
    """Hourly files of the days that are not in ``root``: (date, hour, file_name), in order.

    Only names are listed, no content is read, and the days are those asked
    for: a day without any file is missing as a whole.
    """
    landed = (
        spark.read.format("binaryFile").option("pathGlobFilter", f"*{FILE_SUFFIX}").load(root)
        .select(F.element_at(F.split("path", "/"), -1).alias("file_name"))
    )
    days = F.sequence(F.lit(first_day).cast("date"), F.lit(last_day or first_day).cast("date"))
    hours = (
        spark.range(1).select(F.explode(days).alias("date"))
        .select("date", F.explode(F.sequence(F.lit(0), F.lit(23))).alias("hour"))
        .withColumn("file_name", hour_file_name(F.col("date"), F.col("hour")))
    )
    return hours.join(landed, "file_name", "left_anti").select("date", "hour", "file_name").orderBy("date", "hour")


def read_latest_hours(
    spark: SparkSession, root: str, n: int, schema: T.StructType = ACTIVITY
) -> DataFrame:
    """The ``n`` newest hourly files of ``root``, by the hour in their names.

    Names are listed with the ``binaryFile`` source without reading contents;
    only ``n`` paths reach the driver.
    """
    stem = F.element_at(F.split("path", "/"), -1)
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", f"*{FILE_SUFFIX}")
        .load(root)
        .select("path", F.regexp_extract(stem, r"^(\d{4}-\d{2}-\d{2})-(\d{1,2})\.", 1).alias("day"),
                F.regexp_extract(stem, r"^(\d{4}-\d{2}-\d{2})-(\d{1,2})\.", 2).alias("hour"))
        .where("day <> ''")
    )
    newest = files.orderBy(F.desc("day"), F.col("hour").cast("int").desc()).limit(n)
    paths = [row.path for row in newest.select("path").collect()]
    if not paths:
        return read_activity(spark, root, schema=schema).limit(0)
    return _with_source_date(spark.read.schema(schema).json(paths))


def stream_activity(
    spark: SparkSession,
    root: str,
    max_files_per_trigger: int | None = None,
    clean_source: str = "off",
    archive_dir: str | None = None,
    schema: T.StructType = ACTIVITY,
) -> DataFrame:
    """Hourly files as a stream: each file is read once after it has landed.

    ``clean_source`` is ``off``, ``delete`` or ``archive`` (to ``archive_dir``)
    and applies to files of completed batches. A file counts as new by its name
    alone: by default Spark would pass over one that landed with a time stamp
    more than a week behind the newest, and lose its events. So the names of all
    files ever read stay in the driver's memory and in the progress: one per hour.
    Each row also carries ``source_file``, the name of its file.
    """
    reader = (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", f"*{FILE_SUFFIX}")
        .option("cleanSource", clean_source)
        .option("maxFileAge", _ANY_AGE)
    )
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if archive_dir:
        reader = reader.option("sourceArchiveDir", archive_dir)
    return _with_source_date(reader.json(root)).withColumn(SOURCE_FILE, F.col("_metadata.file_name"))
