"""Every registered query against DuckDB SQL on the same tables."""

from __future__ import annotations

import collections
import datetime as dt

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from duckdb_oracle import ORACLE
from eventloom.plans.catalog import QUERIES
from tests.conftest import TESTDATA

TABLES = "events documents embeddings pages labels".split()

EXPECTED_ROWS = {
    "sf0.001": {"repos_hourly": 803, "commits_fact": 586, "members_fact": 163,
                "repo_owners_gt1": 34, "commits_ge2_per_day": 38, "commits_le1_per_day": 507,
                "inactive_days": 12_723, "projects_gt10_members": 0},
    "sf0.01": {"repos_hourly": 5_857, "commits_fact": 5_820, "members_fact": 1_672,
               "repo_owners_gt1": 34, "commits_ge2_per_day": 480, "commits_le1_per_day": 4_792,
               "inactive_days": 24_638, "projects_gt10_members": 42, "missing_hours": 42},
}
SPARK_TO_DUCKDB = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "date": "DATE",
                   "timestamp_ntz": "TIMESTAMP", "double": "DOUBLE"}


def oracle_rows(sf: str, sql: str):
    con = duckdb.connect()
    for table in TABLES:
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{TESTDATA}/{sf}/{table}.parquet'")
    result = con.sql(sql)
    names = result.columns
    order = sorted(range(len(names)), key=lambda i: names[i])
    types = {names[i]: str(result.types[i]) for i in order}
    return types, collections.Counter(tuple(r[i] for i in order) for r in result.fetchall())


def spark_rows(df):
    df = df.select(sorted(df.columns))
    types = {name: SPARK_TO_DUCKDB[kind] for name, kind in df.dtypes}
    return types, collections.Counter(tuple(r) for r in df.collect())


def compare_with_oracle(spark, query, sql, sf):
    got_types, got = spark_rows(query(spark, f"{TESTDATA}/{sf}"))
    want_types, want = oracle_rows(sf, sql)
    assert got_types == want_types
    assert got == want
    return sum(got.values())


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == ORACLE.keys()
    assert len(QUERIES) == 43  # 41 of the survey's checklist and the two stream operators
    assert QUERIES.keys() <= queries().keys() and ORACLE.keys() <= oracle_sql().keys()


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(spark, name, sf):
    rows = compare_with_oracle(spark, QUERIES[name], ORACLE[name], sf)
    if name in EXPECTED_ROWS[sf]:
        assert rows == EXPECTED_ROWS[sf][name]


def test_missing_hours_go_by_events_of_every_type(spark, tmp_path):
    days = [dt.date(2024, 1, d) for d in (1, 2, 3)]
    untimed = [(11, "2024-01-02 03:00:00", "view"), (12, "2024-01-09 03:00:00", "error")]
    timed = [(1, "2024-01-01 05:10:00", "view"), (7, "2024-01-01 23:59:59", "view"),
             (2, "2024-01-02 09:00:00", "error"), (3, "2024-01-02 10:59:59", "signup"),
             (4, "2024-01-03 00:00:00", "click"), (5, "2024-01-03 01:30:00", "purchase"),
             (6, "2024-01-03 02:00:00", None), (8, "2024-01-03 02:30:00", "error")]
    seen = {(dt.datetime.fromisoformat(ts).date(), dt.datetime.fromisoformat(ts).hour) for _, ts, _ in timed}
    want = collections.Counter((d, f"{d}-{h}.json.gz", h) for d in days for h in range(24) if (d, h) not in seen)

    con = duckdb.connect()
    con.execute("CREATE TABLE events (event_id BIGINT, ts TIMESTAMP, user_id BIGINT, event_type VARCHAR, "
                "value DOUBLE, props VARCHAR)")
    con.executemany("INSERT INTO events VALUES (?, ?, 1, ?, NULL, NULL)", timed + untimed)
    con.execute(f"COPY events TO '{tmp_path}/events.parquet' (FORMAT parquet)")
    assert len(want) == 72 - 7
    assert spark_rows(QUERIES["missing_hours"](spark, str(tmp_path)))[1] == want
    select = f"SELECT date, file_name, hour FROM ({ORACLE['missing_hours']})"
    assert collections.Counter(con.execute(select).fetchall()) == want


def test_entry(spark):
    assert entry(spark).count() == 34
