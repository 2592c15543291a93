"""Facts into a database, for users who bring a JDBC driver."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_jdbc(
    rows: DataFrame, url: str, table: str, properties: dict, mode: str = "append"
) -> None:
    """Append rows to a database table, one connection per partition.

    Appending has no key: a second run, or a retried task of a database without
    transactions, adds rows again. The Parquet facts are the rerun-safe copy.
    """
    rows.write.jdbc(url, table, mode=mode, properties=properties)
