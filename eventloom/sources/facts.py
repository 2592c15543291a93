"""Stored fact tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom.operators.facts import merge_repos
from eventloom.schemas import BATCH, DAY, FACTS, SOURCE_DATE, TEXT
from eventloom.sinks.manifest import Manifest, read_manifest


def _all_rows(spark: SparkSession, root: str, name: str) -> DataFrame:
    schema = T.StructType([*FACTS[name].fields, T.StructField(SOURCE_DATE, DAY), T.StructField(BATCH, TEXT)])
    return spark.read.schema(schema).parquet(f"{root.rstrip('/')}/{name}")


def _that_count(rows: DataFrame, root: str, name: str) -> DataFrame:
    """Rows of the batches that the root's manifest names now; all if it has none.

    A condition on partition columns: folders of other batches are not read.
    """
    manifest = read_manifest(rows.sparkSession, root)
    return rows if manifest is None else rows.where(manifest.condition(name))


def stored_fact(spark: SparkSession, root: str, name: str, manifest: Manifest | None = None) -> DataFrame:
    """The stored rows that count, with their ``source_date`` and ``batch``; by a manifest read before, if given."""
    rows = _all_rows(spark, root, name)
    return _that_count(rows, root, name) if manifest is None else rows.where(manifest.condition(name))


def read_fact(
    spark: SparkSession,
    root: str,
    name: str,
    date_from: str | None = None,
    date_to: str | None = None,
) -> DataFrame:
    """The fact ``name``, optionally of some days only (both ends included).

    ``date`` is a partition column, so a range is answered by listing only its
    folders. Each file or stream batch has rolled up ``repos`` alone; here they
    are merged to one row per date, hour and repository, after the range.
    The frame stands for what counts when it is made: a run that replaces days
    meanwhile shows in frames made after its commit, as a whole.
    """
    fact = _all_rows(spark, root, name)
    if date_from:
        fact = fact.where(F.col("date") >= F.lit(date_from).cast("date"))
    if date_to:
        fact = fact.where(F.col("date") <= F.lit(date_to).cast("date"))
    fact = _that_count(fact, root, name).select(*FACTS[name].fieldNames())
    return merge_repos(fact) if name == "repos" else fact


def create_fact_table(spark: SparkSession, root: str, name: str, table: str | None = None) -> str:
    """Register a stored fact in the session catalog; a table of that name elsewhere is an error.

    The table has the partitions that count now; call again after a run. It
    holds the rows as stored: ``repos`` has a row per file or stream batch there,
    which ``operators.facts.merge_repos`` brings together.
    """
    table = table or name
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in FACTS[name].fields)
    location = f"{root.rstrip('/')}/{name}"
    if spark.catalog.tableExists(table):
        detail = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").first()
        if detail.data_type.removeprefix("file:") != location.removeprefix("file:"):
            raise ValueError(f"table {table} is at {detail.data_type}, not at {location}")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} (`{SOURCE_DATE}` DATE, {columns}, `{BATCH}` STRING) "
        f"USING parquet PARTITIONED BY (`{SOURCE_DATE}`, `date`, `{BATCH}`) LOCATION '{location}'"
    )
    spark.catalog.recoverPartitions(table)
    manifest = read_manifest(spark, root)
    if manifest is not None:
        parts = [dict(p.split("=", 1) for p in row.partition.split("/")) for row in spark.sql(f"SHOW PARTITIONS {table}").collect()]
        out = [p for p in parts if p[BATCH] not in manifest.batches(name, p[SOURCE_DATE])]
        for p in out:  # of an external table this drops no file
            values = ", ".join(f"`{k}` = NULL" if v == "__HIVE_DEFAULT_PARTITION__" else f"`{k}` = '{v}'" for k, v in p.items())
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({values})")
    return table


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict, **partitioning) -> DataFrame:
    """A fact kept in a database. Pass ``column``, ``lowerBound``, ``upperBound``
    and ``numPartitions`` to read it with more than one task."""
    return spark.read.jdbc(url, table, properties=properties, **partitioning)
