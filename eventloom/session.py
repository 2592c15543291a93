"""Session settings and cluster-provided locations."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Adaptive execution is relied on to merge small shuffle partitions, to split
# skewed ones in rebalanced writes and to choose broadcasts from measured sizes.
# Stream state is kept off the heap: open hours hold one row per repository.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def get_session(app_name: str = "eventloom", master: str | None = None, **conf) -> SparkSession:
    """A session with ``SETTINGS``; ``master`` is left to spark-submit unless given."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_location(spark: SparkSession, name: str, fallback: str | None = None) -> str:
    """The folder ``name`` for a stream's progress.

    It lies in the shared folder the cluster names in ``spark.checkpoint.dir``;
    ``fallback`` serves sessions that name none, such as local ones.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or fallback
    if not root:
        raise ValueError("set spark.checkpoint.dir or pass a checkpoint location")
    return f"{root.rstrip('/')}/{name}"
