"""What five filters remove, alone and in every order, kept up by a stream that takes counts back.

Document files come as micro-batches of a stream that ends when all are read. Each
document fails a set of filters (its mask). Four depend on its text alone. The fifth,
having the text of a smaller id, may change later: a state per text holds the smallest
id so far and what was counted for it. Where a smaller id arrives, the count of the
earlier one is retracted and counted again with the fifth filter failed.

The stream's output is signed counts per part, mask and label, a few rows per task and
batch. All orders follow from their sums, however many documents there are.

Before the texts meet, each task joins its copies of a text to the smallest id, so a
text that a third of all rows hold reaches its state as one row per task and batch.
"""

from __future__ import annotations

import contextlib
import itertools
import json
import math
import uuid
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.llm.staging import shared_root

#: Filters by their letter; bit i of a mask is set if the document fails filter i.
FILTERS = "ABCDE"
_COPY = 1 << FILTERS.index("E")
#: Micro-batches that the files are dealt to; a plan size only, results do not depend on it.
BATCHES = 4
#: Texts that a task holds while it joins copies; then it passes them on and starts again.
_TEXTS_AT_ONCE = 50_000
#: Texts, about, that one state holds: an entry per text would cost a call to Python each.
_TEXTS_OF_PAGE = 256

_STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    # Many small stores: files of several megabytes are not set aside for each.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def text_mask(text: Column) -> Column:
    """The bits of the filters that go by the text alone."""
    # Not regexp_extract_all or regexp_count: they copy the text for each match.
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    n_words, distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.octet_length(text) - F.octet_length(F.regexp_replace(text, "[A-Z]+", ""))
    fails = [
        n_words < 50,
        F.lit(100) * distinct < F.lit(65) * n_words,
        F.lit(100) * capitals > F.lit(5) * F.char_length(text),
        text.rlike("[#$%&*|]"),
    ]
    bits = [F.when(fail, F.lit(1 << i)).otherwise(F.lit(0)) for i, fail in enumerate(fails)]
    return sum(bits[1:], bits[0])


_MARKS = "page long, digest string, id long, part string, mask int, label int, n long"
_COUNTS = "part string, mask int, label int, n long"


def _arrow(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string()}
    columns = [field.split() for field in schema.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array([row[i] for row in rows], kinds[kind]) for i, (_, kind) in enumerate(columns)], [name for name, _ in columns]
    )


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (page, digest, id, part, mask, label) of a task as claims and counts.

    A claim is the smallest id of a text here, and is counted as if there were
    none smaller anywhere; other copies are counted as such. Counts have a page
    of the task's own, below 0. Rows without an id are counted alone.
    """
    here = -1 - TaskContext.get().partitionId()
    claims: dict[str, tuple] = {}  # digest: page, id, mask, {(part, label): n}
    counts: Counter = Counter()

    def passed_on() -> pa.RecordBatch:
        rows = [(page, digest, i, part, mask, label, n) for digest, (page, i, mask, holders) in claims.items() for (part, label), n in holders.items()]
        for _, _, _, part, mask, label, n in rows:
            counts[part, mask, label] += n
        rows += [(here, None, None, *group, n) for group, n in counts.items()]
        claims.clear()
        counts.clear()
        return _arrow(rows, _MARKS)

    for batch in batches:
        for page, digest, i, part, mask, label in zip(*(column.to_pylist() for column in batch.columns)):
            if i is None:
                counts[part, mask, label] += 1
                continue
            held = claims.get(digest)
            if held and i > held[1]:
                counts[part, mask | _COPY, label] += 1
            elif held and i == held[1]:
                held[3][part, label] += 1
            else:
                if held:
                    for (other, its), n in held[3].items():
                        counts[other, mask | _COPY, its] += n
                claims[digest] = page, i, mask, Counter({(part, label): 1})
        if len(claims) >= _TEXTS_AT_ONCE:
            yield passed_on()
    yield passed_on()


def _retracted(key: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
    """Counts as they are; of the claims of a page, what is taken back and counted anew.

    The state is the smallest id of each text of the page, and its holders.
    """
    names = ["part", "mask", "label", "n"]
    if key[0] < 0:
        for frame in frames:
            yield frame[names]
        return
    texts = json.loads(state.get[0]) if state.exists else {}
    changes: Counter = Counter()
    for frame in frames:
        columns = (frame[name].tolist() for name in ("digest", "id", *names))
        for digest, i, part, mask, label, n in zip(*columns):
            held = texts.get(digest)
            if held and i > held[0]:
                lost = [(part, label, n)]
            elif held and i == held[0]:
                held[1].append((part, label, n))
                continue
            else:
                lost = held[1] if held else []
                texts[digest] = (i, [(part, label, n)])
            for part, label, n in lost:
                changes[part, mask, label] -= n
                changes[part, mask | _COPY, label] += n
    state.update((json.dumps(texts, separators=(",", ":")),))
    if changes:
        rows = [(*group, n) for group, n in changes.items()]
        yield pd.DataFrame(rows, columns=names).astype({"mask": "int32", "label": "int32"})


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per part, mask and label of a task."""
    sums: Counter = Counter()
    for batch in batches:
        for part, mask, label, n in zip(*(column.to_pylist() for column in batch.columns)):
            sums[part, mask, label] += n
    yield _arrow([(*group, n) for group, n in sums.items() if n], _COUNTS)


@contextlib.contextmanager
def _settings(spark: SparkSession, wanted: dict[str, str]) -> Iterator[None]:
    """``wanted`` for the queries started meanwhile."""
    before = {name: spark.conf.get(name, None) for name in wanted}
    try:
        for name, value in wanted.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def _label_codes(labels: DataFrame, id_col: str) -> DataFrame:
    """(id, label) with bit 0 for good and bit 1 for toxic; one row per id, of several any that says so."""
    says = [F.max(F.when(F.col(name) == 1, 1).otherwise(0)) for name in ("quality", "toxic")]
    codes = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("label_id")).agg(
        (says[0] + 2 * says[1]).cast("int").alias("label")
    )
    return codes.where("label > 0").withColumn("has_id", F.lit(True))


def _stream_files(spark: SparkSession, path: str, batches: int) -> DataFrame:
    """The Parquet files at ``path``, a folder or one file, in about ``batches`` micro-batches."""
    known = spark.read.parquet(path)
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    reader = (
        spark.readStream.schema(known.schema)
        .option("maxFilesPerTrigger", max(1, math.ceil(len(known.inputFiles()) / batches)))
        .option("maxFileAge", "36500d")  # by default files a week older than the newest are passed over
    )
    if at.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(at).isFile():  # streams read folders
        return reader.option("pathGlobFilter", at.getName()).parquet(at.getParent().toString())
    return reader.parquet(path)


def _pages(spark: SparkSession, path: str, where: str) -> int:
    """How many states the texts are spread over; it stays as it was when the progress at ``where`` began."""
    kept = f"{where}/pages"
    at = spark._jvm.org.apache.hadoop.fs.Path(kept)
    if not at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
        rows = spark.read.parquet(path).count()  # from the footers
        spark.range(1).select(F.lit(max(1, rows // _TEXTS_OF_PAGE)).cast("long").alias("pages")).write.parquet(kept)
    return spark.read.schema("pages long").parquet(kept).first().pages


def count_masks(
    spark: SparkSession,
    path: str,
    labels: DataFrame,
    progress: str | None = None,
    batches: int = BATCHES,
    id_col: str = "doc_id",
    text_col: str = "text",
    part_col: str = "source",
) -> DataFrame:
    """(part, mask, label, n) of all documents in the Parquet files at ``path``.

    ``progress`` names a shared folder for the stream's state and counts: a later
    call takes up only files that have come since. Without one the files are
    all read, with a folder of its own that goes when the session's JVM ends.
    """
    where = (progress or f"{shared_root(spark)}/llm-audit-{uuid.uuid4().hex}").rstrip("/")
    if not progress:
        folder = spark._jvm.org.apache.hadoop.fs.Path(where)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)
    docs = _stream_files(spark, path, batches)
    pages = _pages(spark, path, where)
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    marked = docs.select(
        F.sha2(text, 256).alias("digest"),
        F.col(f"`{id_col}`").cast("long").alias("id"),
        F.coalesce(F.col(f"`{part_col}`").cast("string"), F.lit("")).alias("part"),
        text_mask(text).alias("mask"),
    )
    # Rows without an id meet no label; their join keys are spread.
    marked = marked.withColumns({"label_id": F.coalesce("id", F.xxhash64("digest")), "has_id": F.col("id").isNotNull()})
    labelled = marked.join(_label_codes(labels, id_col), ["label_id", "has_id"], "left").select(
        F.pmod(F.xxhash64("digest"), F.lit(pages)).alias("page"),
        "digest", "id", "part", "mask", F.coalesce("label", F.lit(0)).alias("label"),
    )
    changes = (
        labelled.mapInArrow(_joined, _MARKS)
        .groupBy("page")
        .applyInPandasWithState(_retracted, _COUNTS, "texts string", "append", "NoTimeout")
        .mapInArrow(_summed, _COUNTS)
    )
    with _settings(spark, _STATE_STORE):
        query = (
            changes.writeStream.format("parquet").outputMode("append")
            .option("path", f"{where}/counts").option("checkpointLocation", f"{where}/progress")
            .trigger(availableNow=True).start()
        )
        query.awaitTermination()
    # The sink's own log tells which files count: each batch once, also after a failure.
    counts = spark.read.schema(_COUNTS).parquet(f"{where}/counts")
    return counts.groupBy("part", "mask", "label").agg(F.sum("n").alias("n")).where("n <> 0")


def _places() -> str:
    """JSON of each filter behind each set of others: [{bit, before}]."""
    bits = [1 << i for i in range(len(FILTERS))]
    sets = [sum(s) for size in range(len(bits)) for s in itertools.combinations(bits, size)]
    return json.dumps([{"bit": bit, "before": before} for bit in bits for before in sets if not before & bit])


def _orders() -> str:
    """JSON of the orders that have a filter right behind a set of others, by bit and set."""
    found: dict[str, list[str]] = {}
    for order in itertools.permutations(FILTERS):
        before = 0
        for letter in order:
            bit = 1 << FILTERS.index(letter)
            found.setdefault(f"{bit}-{before}", []).append("".join(order))
            before |= bit
    return json.dumps(found)


def all_orders(masks: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step, from counts (part, mask, label, n).

    What a filter removes depends on the set of filters before it, not on their
    order: 80 sums per part, each of which then serves several orders.
    """
    places = F.from_json(F.lit(_places()), "array<struct<bit: int, before: int>>")
    fails = F.col("mask").bitwiseAND(F.col("bit")) != 0
    gone = F.col("mask").bitwiseAND(F.col("before")) != 0
    total = len(list(itertools.permutations(FILTERS)))

    def added(condition: Column, n: Column = F.col("n")) -> Column:
        return F.sum(F.when(condition, n).otherwise(F.lit(0)))

    removed = fails & ~gone
    sums = masks.select("*", F.inline(places)).groupBy("part", "bit", "before").agg(
        added(~fails & ~gone).alias("kept"),
        added(removed).alias("removed"),
        added(fails & gone).alias("redundant"),
        added(F.col("mask") == F.col("bit")).alias("unique_fails"),
        added(removed & (F.col("label").bitwiseAND(F.lit(1)) != 0)).alias("good_lost"),
        added(removed & (F.col("label").bitwiseAND(F.lit(2)) != 0)).alias("toxic_lost"),
        # A document is removed by each of its failed filters in as many orders.
        added(fails, F.col("n") * F.expr(f"{total} div greatest(bit_count(mask), 1)")).alias("shapley"),
    )
    orders = F.from_json(F.lit(_orders()), "map<string, array<string>>")
    return sums.select(
        "part",
        F.explode(F.element_at(orders, F.concat_ws("-", "bit", "before"))).alias("filter_order"),
        (F.bit_count("before") + 1).cast("int").alias("step"),
        "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley",
    )


def audit_filters(spark: SparkSession, path: str, labels: DataFrame, progress: str | None = None, **options) -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley).

    For each part of the documents in the Parquet files at ``path`` (a null part
    is the empty one), each of the 120 orders of the filters and each step: how
    many documents are left after it; are removed by it; fail its filter but were
    removed before; fail its filter alone; are removed here and good, or toxic,
    by ``labels``; and the sum of what its filter removes over all orders.

    A null text counts as empty. Filter E fails for a document with the same text
    as one of a smaller id; repeated rows of one id do not fail for each other,
    and rows without an id neither fail E nor have labels, nor make others fail.
    Texts are the same if their SHA-256 is. Of several labels of one id any counts
    that says good, or toxic. Other columns are not read. No documents give no rows.
    """
    return all_orders(count_masks(spark, path, labels, progress, **options))
