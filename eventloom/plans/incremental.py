"""Distinct counts and idle days kept up to date day by day, without reading all facts again.

``advance`` takes in the days of files whose batches differ from those it has seen: new
days, days run again, days withdrawn. Per kept set (owner and repository, project and
member, author and day) it stores, under ``<root>/.sets/<name>``:

* ``days``: the distinct pairs of each day of files. When a day changes, what it gave
  before is known and can be taken back.
* ``pairs``: layers of signed numbers, on how many days of files a pair is found. The
  pairs that change join the layers as the small side: these are scanned, not shuffled.
* ``totals``: layers of signed numbers of distinct values per key. A metric reads these
  alone: a row per key and layer, whatever the number of events or days.
* ``spans`` (authors only): layers of signed idle spans between two active days, and of
  the span of each author's activity, recomputed for authors whose days have changed.

Layers are added up when read and brought together in one when there are many. A version
file, put in place by one rename, names the days and layers that count, so a broken or
repeated call changes nothing; of two callers one starts again on top of the other.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom.schemas import DAY, FACTS, LONG, SOURCE_DATE, TEXT
from eventloom.sinks.files import remove
from eventloom.sinks.manifest import KEEP_SECONDS, UNDATED, Manifest, begin, latest_version, location, store_version
from eventloom.sources.facts import stored_fact

#: Layers of a table that are read before they are brought together.
MAX_LAYERS = 16
_VERSIONS_KEPT = 20


@dataclass(frozen=True)
class DistinctSet:
    """The distinct ``value`` per ``key`` of a fact; NULL is a key like another, but never a value."""

    fact: str
    key: tuple[str, ...]
    value: str
    spans: bool = False

    def columns(self) -> tuple[str, ...]:
        return (*self.key, self.value)

    def schema(self, columns: tuple[str, ...]) -> T.StructType:
        return T.StructType([f for c in columns for f in FACTS[self.fact].fields if f.name == c])


SETS = {
    "owner_repos": DistinctSet("repos", ("repo_author",), "repo_name"),
    "project_members": DistinctSet("members", ("repo_name", "repo_name_full"), "member_login"),
    "author_days": DistinctSet("commits", ("author_name",), "date", spans=True),
}

_SPAN = ("author_name", "kind", "idle_from", "idle_to")
_SPANS = T.StructType([T.StructField(c, kind) for c, kind in zip(_SPAN, (TEXT, TEXT, DAY, DAY))])


@dataclass
class _State:
    """``seen``: the batches of each day that are taken in; ``days``: the folder with its pairs;
    ``layers`` by table; ``retired``: (folder, since)."""

    seen: dict[str, list[str]] = field(default_factory=dict)
    days: dict[str, str] = field(default_factory=dict)
    layers: dict[str, list[str]] = field(default_factory=dict)
    retired: list[tuple[str, float]] = field(default_factory=list)
    version: int = -1


class _Store:
    """The tables of one kept set."""

    def __init__(self, spark: SparkSession, root: str, name: str) -> None:
        if name not in SETS:
            raise ValueError(f"unknown set: {name}")
        self.spark, self.kept = spark, SETS[name]
        self.root = f"{root.rstrip('/')}/.sets/{name}"
        kept = self.kept
        self.schemas = {
            "pairs": kept.schema(kept.columns()),
            "totals": kept.schema(kept.key),
            "spans": _SPANS,
        }

    def state(self) -> _State:
        found = latest_version(self.spark, self.root)
        if found is None:
            return _State()
        number, text = found
        return _State(**json.loads(text) | {"version": number})

    def commit(self, state: _State) -> bool:
        """Whether ``state`` has become the version behind the one it was made from."""
        text = json.dumps({k: v for k, v in asdict(state).items() if k != "version"})
        return store_version(self.spark, self.root, state.version + 1, text, _VERSIONS_KEPT)

    def layer(self, table: str, layers: list[str], extra: tuple[str, ...] = ("n",)) -> DataFrame:
        """The signed rows of some layers, with the layer each is from."""
        fields = [*self.schemas[table].fields, *[T.StructField(c, LONG) for c in extra]]
        if not layers:
            return self.spark.createDataFrame([], T.StructType([*fields, T.StructField("layer", TEXT)]))
        reader = self.spark.read.schema(T.StructType([*fields, T.StructField("layer", TEXT)]))
        paths = [f"{self.root}/{table}/layer={layer}" for layer in layers]
        return reader.option("basePath", f"{self.root}/{table}").parquet(*paths)

    def current(self, state: _State, table: str) -> DataFrame:
        """The rows of a table, layers added up; ``n`` is never 0."""
        layers = state.layers.get(table, [])
        if len(layers) == 1:  # of one layer each row stands once
            return self.layer(table, layers).drop("layer")
        return _added_up(self.layer(table, layers), self.schemas[table].fieldNames())

    def write(self, rows: DataFrame, table: str, layer: str) -> None:
        rows.write.mode("overwrite").parquet(f"{self.root}/{table}/layer={layer}")

    def of_batch(self, batch: str) -> DataFrame:
        """The pairs of all days that were stored together."""
        rows = self.spark.read.schema(self.schemas["pairs"]).parquet(f"{self.root}/days/{batch}")
        return rows.select(*self.kept.columns())

    def of_days(self, days: dict[str, str]) -> DataFrame:
        schema = self.schemas["pairs"]
        if not days:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.root}/days/{batch}/day={day}" for day, batch in days.items()])


def _added_up(rows: DataFrame, columns: list[str]) -> DataFrame:
    return rows.groupBy(*columns).agg(F.sum("n").alias("n")).where("n <> 0")


def _among(rows: DataFrame, few: DataFrame, columns) -> DataFrame:
    """Rows whose ``columns``, NULL included, are among those of ``few``: which side to send is left to Spark."""
    few = few.select(*[F.col(c).alias(f"_{c}") for c in columns])
    same = F.lit(True)
    for c in columns:
        same = same & rows[c].eqNullSafe(few[f"_{c}"])
    return rows.join(few, same, "left_semi")


def _day_folder(day: str) -> str:
    return "undated" if day == UNDATED else day


def _write_days(store: _Store, manifest: Manifest, changed: list[str], batch: str) -> dict[str, str]:
    """Stores the distinct pairs of the changed days in one job; returns the folders of those that have any."""
    kept = store.kept
    day = F.coalesce(F.col(SOURCE_DATE).cast("string"), F.lit(UNDATED))
    rows = stored_fact(store.spark, store.root.rpartition("/.sets/")[0], kept.fact, manifest).where(day.isin(changed))
    names = F.when(F.col(SOURCE_DATE).isNull(), F.lit("undated")).otherwise(F.col(SOURCE_DATE).cast("string"))
    pairs = rows.select(names.alias("day"), *kept.columns()).where(F.col(kept.value).isNotNull()).distinct()
    target = f"{store.root}/days/{batch}"
    pairs.hint("rebalance", "day").write.mode("overwrite").partitionBy("day").parquet(target)
    files, path = location(store.spark, target)
    written = {status.getPath().getName().removeprefix("day=") for status in files.listStatus(path)}
    return {_day_folder(d): batch for d in changed if _day_folder(d) in written}


def _write_pairs(store: _Store, state: _State, old: dict[str, str], batch: str) -> None:
    """A layer of what the changed days add to and take from each pair.

    ``turn`` is 1 where a pair comes to be and -1 where it goes. Pairs that a
    day keeps are in no layer.
    """
    columns = list(store.kept.columns())
    change = _added_up(
        store.of_batch(batch).withColumn("n", F.lit(1).cast("long"))
        .unionByName(store.of_days(old).withColumn("n", F.lit(-1).cast("long"))),
        columns,
    )
    before = _among(store.layer("pairs", state.layers.get("pairs", [])), change, columns)
    none = F.lit(0).cast("long")
    both = (
        change.select(*columns, "n", none.alias("before"))
        .unionByName(before.select(*columns, none.alias("n"), F.col("n").alias("before")))
        .groupBy(*columns).agg(F.sum("n").alias("n"), F.sum("before").alias("before"))
    )
    comes, goes = (F.col("before") == 0), (F.col("before") + F.col("n") == 0)
    turn = F.when(comes, 1).when(goes, -1).otherwise(0).cast("long").alias("turn")
    store.write(both.select(*columns, "n", turn), "pairs", batch)


def _write_totals(store: _Store, batch: str) -> None:
    turns = store.layer("pairs", [batch], ("n", "turn"))
    key = list(store.kept.key)
    store.write(turns.groupBy(*key).agg(F.sum("turn").alias("n")).where("n <> 0"), "totals", batch)


def _gaps_and_life(days: DataFrame) -> DataFrame:
    """Of distinct (author, date): the idle spans between two of them, and the span of all."""
    by_day = Window.partitionBy("author_name").orderBy("date")
    gaps = (
        days.withColumn("previous", F.lag("date").over(by_day))
        .select("author_name", F.lit("gap").alias("kind"), F.date_add("previous", 1).alias("idle_from"), F.date_sub("date", 1).alias("idle_to"))
        .where("idle_from <= idle_to")
    )
    life = days.groupBy("author_name").agg(F.min("date").alias("idle_from"), F.max("date").alias("idle_to"))
    return gaps.unionByName(life.withColumn("kind", F.lit("life")))


def _write_spans(store: _Store, state: _State, batch: str) -> None:
    """A layer of the spans that authors with a changed day get and lose."""
    authors = store.layer("pairs", [batch], ("n", "turn")).where("turn <> 0").select("author_name").distinct()
    layers = [*state.layers.get("pairs", []), batch]
    earlier = F.when(F.col("layer") == batch, F.lit(0)).otherwise(F.col("n"))
    days = (
        _among(store.layer("pairs", layers), authors, ["author_name"])
        .groupBy("author_name", "date").agg(F.sum("n").alias("after"), F.sum(earlier).alias("before"))
    )
    after = _gaps_and_life(days.where("after > 0").select("author_name", "date")).withColumn("n", F.lit(1).cast("long"))
    before = _gaps_and_life(days.where("before > 0").select("author_name", "date")).withColumn("n", F.lit(-1).cast("long"))
    store.write(_added_up(after.unionByName(before), list(_SPAN)), "spans", batch)


def _take_in(spark: SparkSession, root: str, name: str) -> int | None:
    """One try: the number of changed days, or None if another caller was faster."""
    store = _Store(spark, root, name)
    state = store.state()  # before the manifest, so that it is never ahead of it
    manifest = begin(spark, root)
    live = manifest.live.get(store.kept.fact, {})
    changed = sorted(d for d in live.keys() | state.seen.keys() if sorted(live.get(d, [])) != sorted(state.seen.get(d, [])))
    if not changed:
        return 0
    batch, now = uuid.uuid4().hex, time.time()
    old = {_day_folder(d): state.days[_day_folder(d)] for d in changed if _day_folder(d) in state.days}
    new = _write_days(store, manifest, changed, batch)
    tables = ["pairs", "totals", *(["spans"] if store.kept.spans else [])]
    _write_pairs(store, state, old, batch)
    _write_totals(store, batch)
    if store.kept.spans:
        _write_spans(store, state, batch)
    state.seen = {d: live[d] for d in live}
    state.days = {d: b for d, b in state.days.items() if d not in old} | new
    state.retired += [(f"days/{b}/day={d}", now) for d, b in old.items()]
    for table in tables:
        layers = [*state.layers.get(table, []), batch]
        state.layers[table] = layers
        if len(layers) > MAX_LAYERS:
            one = f"all-{batch}"
            store.write(store.current(state, table), table, one)
            state.layers[table] = [one]
            state.retired += [(f"{table}/layer={layer}", now) for layer in layers]
    if store.commit(state):
        return len(changed)
    remove(spark, f"{store.root}/days/{batch}")
    for table in tables:
        for layer in (batch, f"all-{batch}"):
            remove(spark, f"{store.root}/{table}/layer={layer}")
    return None


def _tidy(spark: SparkSession, root: str, name: str, keep_seconds: float) -> None:
    """Removes what was replaced longer ago than that."""
    store = _Store(spark, root, name)
    state = store.state()
    due = [r for r in state.retired if r[1] <= time.time() - keep_seconds]
    for folder, _ in due:
        remove(spark, f"{store.root}/{folder}")
    if due:
        state.retired = [r for r in state.retired if r not in due]
        store.commit(state)  # if another was faster, the next call does it


def advance(spark: SparkSession, root: str, names=tuple(SETS), keep_seconds: float = KEEP_SECONDS) -> dict[str, int]:
    """Brings kept sets up to the facts stored under ``root``; returns the number of changed days of each.

    Costs a read of the changed days, of their pairs as they were, and one scan
    of the distinct pairs of all days. A call without changed days only lists.
    """
    done = {}
    for name in names:
        while (days := _take_in(spark, root, name)) is None:
            pass
        _tidy(spark, root, name, keep_seconds)
        done[name] = days
    return done


def distinct_counts(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The number of distinct values per key, of the days taken in: ``n``, never 0."""
    store = _Store(spark, root, name)
    return store.current(store.state(), "totals")


def repo_owners_gt1(spark: SparkSession, root: str) -> DataFrame:
    """``owners.repo_owners_gt1`` of all stored days."""
    counts = distinct_counts(spark, root, "owner_repos").withColumnRenamed("n", "repos_total")
    return counts.where("repos_total > 1").orderBy(F.desc("repos_total"), "repo_author")


def projects_gt10_members(spark: SparkSession, root: str) -> DataFrame:
    """``members.projects_gt10_members`` of all stored days."""
    counts = distinct_counts(spark, root, "project_members").withColumnRenamed("n", "total_members")
    return counts.where("total_members > 10").orderBy(F.desc("total_members"), "repo_name", "repo_name_full")


def inactive_days(spark: SparkSession, root: str) -> DataFrame:
    """``commits.inactive_days`` of all stored days, from spans.

    What depends on the calendar, the days before an author's first and behind
    the last, is added here, so a new day changes no stored row of others.
    """
    store = _Store(spark, root, "author_days")
    spans = store.current(store.state(), "spans")
    lives = spans.where("kind = 'life'")
    # The count keeps the aggregate from giving a row, and so a calendar, where nothing is stored.
    calendar = lives.agg(
        F.min("idle_from").alias("first_day"), F.max("idle_to").alias("last_day"), F.count(F.lit(1)).alias("authors")
    ).where("authors > 0")
    first_day, last_day = calendar.select("first_day").scalar(), calendar.select("last_day").scalar()

    def run(start, end):
        return F.struct(start.alias("low"), end.alias("high"))

    ends = F.array(run(first_day, F.date_sub("idle_from", 1)), run(F.date_add("idle_to", 1), last_day))
    runs = F.when(F.col("kind") == "life", ends).otherwise(F.array(run(F.col("idle_from"), F.col("idle_to"))))
    idle = spans.where("author_name IS NOT NULL").select("author_name", F.inline(runs)).where("low <= high")
    return idle.select("author_name", F.explode(F.sequence("low", "high")).alias("interval_start_dt"))


def register_kept(spark: SparkSession, root: str) -> list[str]:
    """Makes temporary views ``kept_<metric>`` of what is kept now; returns their names. Call again after ``advance``."""
    for name, metric in KEPT_METRICS.items():
        metric(spark, root).createOrReplaceTempView(f"kept_{name}")
    return [f"kept_{name}" for name in KEPT_METRICS]


#: The exported metrics that kept sets answer.
KEPT_METRICS = {"repos": repo_owners_gt1, "members": projects_gt10_members, "commits_lt1": inactive_days}
KEPT_SETS = {"repos": "owner_repos", "members": "project_members", "commits_lt1": "author_days"}
