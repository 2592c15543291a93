"""Facts and counts kept up to date from a stream of hourly files."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from eventloom.functions.columns import utc_timestamp, with_event_time, with_repo_columns
from eventloom.operators.facts import BUILDERS
from eventloom.schemas import BATCH, DAY, FACTS, INT, LONG, SOURCE_DATE, SOURCE_FILE, TEXT, TIME
from eventloom.session import checkpoint_location
from eventloom.sinks.files import exists, staged, write_fact
from eventloom.sinks.manifest import Manifest, begin, commit, day_key, read_manifest
from eventloom.sources.facts import stored_fact


_STREAM = "stream-"


def _progress(name: str, *parts: str) -> str:
    digest = hashlib.sha256("\n".join(parts).encode()).hexdigest()[:16]
    return f"{name}-{digest}"


def _holds_stream_batches(spark: SparkSession, root: str, name: str) -> bool:
    if not exists(spark, f"{root.rstrip('/')}/{name}"):
        return False
    return not stored_fact(spark, root, name).where(F.col(BATCH).startswith(_STREAM)).isEmpty()


def stream_facts(
    activity: DataFrame,
    out_root: str,
    checkpoint: str | None = None,
    facts=tuple(FACTS),
    trigger: dict | None = None,
    afresh: bool = False,
) -> StreamingQuery:
    """Append each batch of newly landed events to the facts.

    One query parses each file once for all its facts. A batch is stored under
    the identity of the query's progress and its number, and counts for readers
    from one commit on. Repeated after a failure it replaces its files if it
    does not count yet, and is passed over if it does, so nothing is doubled or
    lost, however late it arrives. A batch run over the same days takes them
    over later.

    Progress belongs to ``out_root`` and the set of facts: each has a folder of
    its own in the cluster's checkpoint folder, or in ``checkpoint`` if there is
    none. Without progress every file counts as new. Where the facts hold stream
    batches already, those files would then be stored twice, so this is refused
    unless ``afresh`` says that the files read before are gone.
    """
    spark, facts = activity.sparkSession, tuple(facts)
    where = checkpoint_location(spark, _progress("facts", out_root.rstrip("/"), *sorted(facts)), checkpoint)
    if not afresh and not exists(spark, f"{where}/metadata"):
        held = [name for name in facts if _holds_stream_batches(spark, out_root, name)]
        if held:
            raise ValueError(
                f"{out_root} holds stream batches of {', '.join(held)}, but there is no progress at {where}: "
                "files would be read again; name the old checkpoint, or start afresh if they are gone"
            )

    begin(spark, out_root)

    def store(batch: DataFrame, batch_id: int) -> None:
        # The query's identity lies with its progress and outlives restarts.
        session = batch.sparkSession
        query = session.sparkContext.getLocalProperty("sql.streaming.queryId")
        stored = f"{_STREAM}{query}-{batch_id}"
        manifest = read_manifest(session, out_root)
        if manifest and not all(manifest.follows(name, query, batch_id) for name in facts):
            return
        with staged(with_event_time(batch), out_root) as rows:
            for name in facts:
                write_fact(BUILDERS[name](rows, carry=(SOURCE_DATE,)), out_root, name, stored)
            days = [day_key(row[0]) for row in rows.select(SOURCE_DATE).distinct().collect()]

        def add(manifest: Manifest) -> None:
            for name in facts:
                manifest.note(name, query, batch_id)
                for day in days:
                    manifest.put(name, day, [*manifest.batches(name, day), stored])

        commit(session, out_root, add)

    return (
        activity.writeStream.foreachBatch(store)
        .option("checkpointLocation", where)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def _with_watermark(activity: DataFrame, late: str) -> DataFrame:
    # Watermarks need TIMESTAMP: the instant of the UTC wall-clock time.
    utc = F.col("utc")
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    instant = F.timestamp_micros(F.timestamp_diff("MICROSECOND", epoch, utc))
    timed = activity.withColumn("utc", utc_timestamp(F.col("created_at"))).where(utc.isNotNull())
    return timed.withColumn("event_time", instant).withWatermark("event_time", late)


def _utc(instant: Column) -> Column:
    """UTC wall-clock time of an instant, under any session time zone."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_add("SECOND", F.unix_seconds(instant), epoch)


def _hour_parts(counts: DataFrame, *columns: str) -> DataFrame:
    start = _utc(F.col("window.start"))
    return counts.select(
        F.to_date(start).alias("date"), F.hour(start).alias("hour"), *columns, "total_events"
    )


def stream_hourly_counts(activity: DataFrame, late: str = "1 hour") -> DataFrame:
    """Events per (date, hour, type), each hour emitted once it is complete.

    Events more than ``late`` behind the newest are dropped, as with any
    watermark; the facts, and ``run_live``, keep them.
    """
    counts = _with_watermark(activity, late).groupBy(F.window("event_time", "1 hour"), "type")
    return _hour_parts(counts.agg(F.count(F.lit(1)).alias("total_events")), "type")


def stream_repos(activity: DataFrame, late: str = "1 hour") -> DataFrame:
    """The ``repos`` rollup on a stream; state is held for open hours only."""
    counts = (
        with_repo_columns(_with_watermark(activity, late))
        .groupBy(F.window("event_time", "1 hour"), "repo_author", "repo_name")
        .agg(F.count(F.lit(1)).alias("total_events"))
    )
    return _hour_parts(counts, "repo_author", "repo_name")


#: Live rollups by name: what they count events by, besides date and hour.
LIVE = {"hourly_counts": ("type",), "repos": ("repo_author", "repo_name")}

_KINDS = {"date": DAY, "hour": INT, "type": TEXT, "repo_author": TEXT, "repo_name": TEXT, "total_events": LONG, "newest": TIME, SOURCE_FILE: TEXT}


def _live_folder(spark: SparkSession, root: str, name: str) -> str:
    if exists(spark, f"{root}/{name}/_spark_metadata"):
        raise ValueError(f"{root}/{name} holds complete hours as an earlier version stored them; choose another folder")
    return f"{root}/{name}"


def _live_parts(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Counts per file, hour and group, as they are stored; none if nothing is."""
    columns = ("date", "hour", *LIVE[name], "total_events", "newest", SOURCE_FILE)
    schema = T.StructType([T.StructField(c, _KINDS[c]) for c in columns])
    folder = _live_folder(spark, root, name)
    return spark.read.schema(schema).parquet(folder) if exists(spark, folder) else spark.createDataFrame([], schema)


def _closed(newest: Column, late: str) -> Column:
    """Whether nothing within ``late`` of the newest event can belong to the hour of a row any more."""
    end = F.col("date").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.col("hour") + 1)
    return end + F.expr(f"INTERVAL {late}") <= newest


def read_live(spark: SparkSession, root: str, name: str, late: str | None = None) -> DataFrame:
    """The live counts stored under ``root``: one row per hour and group, of all files so far.

    With ``late``, such as ``"1 hour"``, hours that events up to so much behind
    the newest one may still add to are left out. It can be chosen anew each
    time. An event that comes later still adds to its hour.
    """
    parts = _live_parts(spark, root.rstrip("/"), name)
    counts = parts.groupBy("date", "hour", *LIVE[name]).agg(F.sum("total_events").alias("total_events"))
    if late:
        newest = parts.agg(F.max("newest").alias("newest")).select("newest").scalar()
        counts = counts.where(_closed(newest, late))
    return counts


def run_live(
    activity: DataFrame,
    out_root: str,
    checkpoint: str | None = None,
    late: str = "1 hour",
    only=tuple(LIVE),
    trigger: dict | None = None,
) -> dict[str, int]:
    """Add the files that have landed to the live counts under ``out_root``; ``read_live`` sums them up.

    Counts are stored per hourly file, in a folder of its name that appears as a
    whole. A file that is there is not counted again: neither after a failure,
    nor with lost progress, nor with another set of counts. Events are
    never dropped, however late.

    The numbers returned are of groups (an hour with a type, or a repository)
    that came after their hour had been complete by ``late``, which decides
    nothing else. ``activity`` comes from ``stream_activity``.
    """
    spark, root, only = activity.sparkSession, out_root.rstrip("/"), tuple(only)
    added_late, newest = dict.fromkeys(only, 0), {}
    for name in only:
        newest[name] = _live_parts(spark, root, name).agg(F.max("newest")).first()[0]

    def store(batch: DataFrame, batch_id: int) -> None:
        with staged(with_repo_columns(with_event_time(batch)), root) as rows:
            timed = rows.where(F.col("event_ts").isNotNull())
            landed = [row[0] for row in timed.select(SOURCE_FILE).distinct().collect()]
            for name in only:
                new = [file for file in landed if not exists(batch.sparkSession, f"{root}/{name}/{SOURCE_FILE}={file}")]
                if not new:
                    continue
                counts = (
                    timed.where(F.col(SOURCE_FILE).isin(new))
                    .groupBy("date", "hour", *LIVE[name], SOURCE_FILE)
                    .agg(F.count(F.lit(1)).alias("total_events"), F.max("event_ts").alias("newest"))
                )
                known, seen = Observation(), newest[name]
                late_one = F.lit(False) if seen is None else _closed(F.lit(seen).cast("timestamp_ntz"), late)
                counts.hint("rebalance", SOURCE_FILE).observe(
                    known, F.count_if(late_one).alias("late"), F.max("newest").alias("newest")
                ).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(SOURCE_FILE).parquet(f"{root}/{name}")
                added_late[name] += known.get["late"]
                newest[name] = max(x for x in (seen, known.get["newest"]) if x is not None)

    (
        activity.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint_location(spark, _progress("live", root, *sorted(only)), checkpoint))
        .trigger(**(trigger or {"availableNow": True}))
        .start()
        .awaitTermination()
    )
    return added_late
