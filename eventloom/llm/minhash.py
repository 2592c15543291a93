"""Near-duplicate documents by MinHash, with every link confirmed on the full shingle sets.

1. Each text gives its set of hashed shingles, the minima of ``BANDS * ROWS`` universal
   hash functions over it, and one key per band of minima.
2. Equal sets are one class, spoken for by its smallest id.
3. In each bucket (band, key) every class is paired with the bucket's first one. Of its
   pairs whose signatures agree enough each class has the best one confirmed on the sets,
   and goes under that one's label.
4. Buckets with several labels are searched completely, block by block, for pairs with
   signatures that agree enough. Classes that such pairs connect are a cluster.
5. The classes of a cluster are compared on their sets, block by block. Those already known
   to be connected are not compared again, and only links that connect more are returned.

So a bucket of copies costs one pair per member, a group of any similarity gives rows in
proportion to its members, and no link between components is lost.
Signatures are kept as the lowest byte of each minimum; texts are read again only for
documents in pairs.
A pair of similarity 0.75 shares no bucket with a chance of (1 - 0.75^5)^40 = 2 in 100,000.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom.llm.blocks import in_blocks, roots
from eventloom.llm.components import connected_components
from eventloom.llm.staging import arrow_batches, give_back, let_go, stage
from eventloom.llm.words import LOWER, WordHasher, chunks, mix, spread, starts_of_words

WORDS, PERCENT = 5, 75
BANDS, ROWS = 40, 5
#: Pairs go on to their sets if so large a share of their minima agree: 4.5 standard
#: deviations below the similarity asked for.
MIN_AGREEING = PERCENT / 100 - 4.5 * (0.75 * 0.25 / (BANDS * ROWS)) ** 0.5
#: Up to so many ids (16 MB) are broadcast to pick out their texts; more are joined by a shuffle.
BROADCAST_IDS = 2_000_000
#: Texts, or pairs of sets, that a task holds at once, and sets of one block.
BATCH, SET_BLOCK = 512, 512
_U64 = np.uint64
_HASH = WordHasher()
_RANDOM = np.random.Generator(np.random.PCG64(2048))
#: Multiply-add hash functions modulo 2^64, of which the high half is used.
_FACTORS = _RANDOM.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) * _U64(2) + _U64(1)
_ADDED = _RANDOM.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64)
_PLACES = [_U64(int(f) | 1) for f in _RANDOM.integers(0, 1 << 63, 64, dtype=np.uint64)]


def shingle_sets(texts: list[str | None], words: int = WORDS) -> Iterator[np.ndarray]:
    """The sorted distinct 64-bit shingle hashes of each text.

    A text with fewer words than a shingle has all of them as one; one without words has none.
    """
    for _, buffer, bounds in chunks(texts):
        starts = starts_of_words(buffer)
        hashes = _HASH(LOWER[buffer], starts)
        cuts = np.searchsorted(starts, bounds)
        n, sizes = len(hashes), np.diff(cuts)
        text = np.repeat(np.arange(len(sizes)), sizes)
        joined, held = hashes * _PLACES[0], np.ones(n, np.uint64)
        for step in range(1, min(words, n)):
            same = text[step:] == text[:-step]
            joined[:-step][same] += hashes[step:][same] * _PLACES[step % 64] + _U64(step // 64)
            held[:-step] += same
        shingles = mix(joined + held)
        for first, size in zip(cuts[:-1].tolist(), sizes.tolist()):
            yield np.unique(shingles[first : first + max(size - words + 1, min(size, 1))])


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """The minima of all hash functions (32 bits each) over each set; none may be empty."""
    found = np.empty((len(sets), BANDS * ROWS), np.uint32)
    low = 0
    while low < len(sets):
        high, size = low + 1, len(sets[low])
        while high < len(sets) and size + len(sets[high]) <= 1 << 14:
            size += len(sets[high])
            high += 1
        keys = np.concatenate(sets[low:high])
        firsts = np.concatenate([[0], np.cumsum([len(s) for s in sets[low : high - 1]], dtype=np.int64)]).astype(np.int64)
        hashed = np.empty_like(keys)
        for k, (factor, added) in enumerate(zip(_FACTORS, _ADDED)):
            np.multiply(keys, factor, out=hashed)
            np.add(hashed, added, out=hashed)
            found[low:high, k] = np.minimum.reduceat(hashed, firsts) >> _U64(32)
        low = high
    return found


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    let_go()
    for batch in batches:
        sets = list(shingle_sets(batch.column(1).to_pylist()))
        full = [s for s in sets if len(s)]
        minima = signatures(full)
        bands = np.zeros((len(full), BANDS), np.uint64)
        for row in range(ROWS):
            bands = mix(bands * _U64(0x9FB21C651E98DF25) + minima[:, row::ROWS])
        keys, sigs = iter(bands.view(np.int64).tolist()), iter(minima)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                pa.array([next(keys) if len(s) else None for s in sets], pa.list_(pa.int64())),
                pa.array([next(sigs).astype(np.uint8).tobytes() if len(s) else None for s in sets], pa.binary()),
            ],
            ["id", "n_shingles", "same", "bands", "minima"],
        )
    give_back()


def _to_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    let_go()
    for batch in batches:
        sets = [s.tobytes() for s in shingle_sets(batch.column(1).to_pylist())]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], ["id", "shingles"])


@F.arrow_udf(T.DoubleType())
def _agreeing(a: pa.Array, b: pa.Array) -> pa.Array:
    left, right = (np.frombuffer(b"".join(x.to_pylist()), np.uint8).reshape(len(x), -1) for x in (a, b))
    return pa.array((left == right).mean(axis=1) if len(left) else [], pa.float64())


@F.arrow_udf(T.BooleanType())
def _alike(a: pa.Array, b: pa.Array) -> pa.Array:
    found = []
    for x, y in zip(a.to_pylist(), b.to_pylist()):
        x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
        both = len(np.intersect1d(x, y, assume_unique=True))
        found.append(100 * both >= PERCENT * (len(x) + len(y) - both))
    return pa.array(found, pa.bool_())


def _sets(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, shingles) of the documents with some ids; only their texts are moved."""
    few = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    with arrow_batches(docs.sparkSession, BATCH):
        return stage(docs.join(few, "id", "left_semi").mapInArrow(_to_sets, "id long, shingles binary"), "sets")


def _confirmed(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """The ``pairs`` (a, b) that are alike by their full sets."""
    pairs = stage(pairs, "pairs")
    ids = stage(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "ids")
    sets = _sets(docs, ids)
    met = pairs.join(sets.toDF("a", "x"), "a").join(sets.toDF("b", "y"), "b")
    with arrow_batches(docs.sparkSession, BATCH):
        return stage(met.where(_alike("x", "y")).select("a", "b").distinct(), "alike")


def _sides(group: pa.Table) -> tuple[np.ndarray, np.ndarray, bool]:
    """Rows of the left and of the right block, and whether they are the same."""
    side = group.column("side").to_numpy()
    left, right = group.column("left")[0].as_py(), group.column("right")[0].as_py()
    return np.flatnonzero(side == left), np.flatnonzero(side == right), left == right


def _agree(minima: np.ndarray, row: int, others: np.ndarray) -> np.ndarray:
    """Those of ``others`` whose signatures agree enough with the row's."""
    return others[(minima[others] == minima[row]).mean(axis=1) >= MIN_AGREEING]


def _clusters(group: pa.Table) -> pa.Table:
    """Links that span all pairs of two blocks of a bucket with different labels that agree enough."""
    rows, others, one = _sides(group)
    ids, labels = group.column("id").to_numpy(), group.column("label").to_numpy()
    minima = np.frombuffer(b"".join(group.column("minima").to_pylist()), np.uint8).reshape(len(ids), -1)
    a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for row in rows.tolist():
        near = others[labels[others] != labels[row]]
        near = _agree(minima, row, near[near > row] if one else near)
        a.append(np.full(len(near), row))
        b.append(near)
    first = roots(len(ids), np.concatenate(a), np.concatenate(b))
    moved = np.flatnonzero(first != np.arange(len(ids)))
    return pa.table({"a": ids[moved], "b": ids[first[moved]]})


def _exact_links(group: pa.Table) -> pa.Table:
    """Links, by the full sets, that connect what has different labels in two blocks of a cluster."""
    rows, others, one = _sides(group)
    ids, labels = group.column("id").to_numpy(), group.column("label").to_numpy().copy()
    minima = np.frombuffer(b"".join(group.column("minima").to_pylist()), np.uint8).reshape(len(ids), -1)
    data = group.column("shingles").to_pylist()
    sizes = np.array([len(d) // 8 for d in data])
    flat, at = np.frombuffer(b"".join(data), np.uint64), np.cumsum(sizes) - sizes
    a, b = [], []
    for row in rows.tolist():
        near = others[labels[others] != labels[row]]
        near = _agree(minima, row, near[near > row] if one else near)
        # In portions: what a row is linked to need not be compared with the rest of that.
        for low in range(0, len(near), 64):
            part = near[low : low + 64]
            part = part[labels[part] != labels[row]]
            if not len(part):
                continue
            own = flat[at[row] : at[row] + sizes[row]]
            theirs = spread(flat, at[part], sizes[part])
            place = np.minimum(np.searchsorted(own, theirs), len(own) - 1)
            both = np.add.reduceat((own[place] == theirs).astype(np.int64), np.cumsum(sizes[part]) - sizes[part])
            for found in part[100 * both >= PERCENT * (sizes[row] + sizes[part] - both)].tolist():
                if labels[found] != labels[row]:
                    labels[labels == labels[found]] = labels[row]
                    a.append(ids[row])
                    b.append(ids[found])
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(``id_col``, n_shingles, component_id, kept) of every row.

    Documents with ``100 * |A and B| >= 75 * |A or B|`` for their sets of distinct
    five-word shingles are linked; ``component_id`` is the smallest id that links
    lead to, and ``kept`` tells whether it is the document's own. Words are split
    at ASCII white space, A-Z lower-cased.

    A null, empty or blank text has no shingles and is linked with nothing. Rows
    with one id are one document that is linked by any of its texts. A null id is
    linked with nothing, has a null component and is kept. No rows give no rows;
    other columns are not kept. Ids are integers.
    """
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    with arrow_batches(docs.sparkSession, BATCH):
        signed = stage(
            rows.mapInArrow(_sign, "id long, n_shingles long, same binary, bands array<long>, minima binary"), "minhash"
        )
    known = signed.where("id is not null and n_shingles > 0")
    # Equal sets: one class. Staged, so that a class of any size can be split in the joins.
    first = stage(known.groupBy("same").agg(F.min("id").alias("first")), "classes")
    copies = stage(known.select("id", "same").join(first, "same").where("id <> first"), "copies")
    speakers = known.join(copies, ["id", "same"], "left_anti")

    banded = speakers.select("id", F.posexplode("bands").alias("band", "key"))
    buckets = banded.groupBy("band", "key").agg(F.min("id").alias("leader"), F.count(F.lit(1)).alias("n"))
    buckets = stage(buckets.where("n > 1"), "buckets")
    crowded = stage(banded.join(buckets, ["band", "key"]), "crowded")
    led = crowded.where("id <> leader").select(F.col("leader").alias("a"), F.col("id").alias("b")).distinct()
    minima = speakers.select("id", "minima")
    rated = (
        led.join(minima.toDF("a", "x"), "a")
        .join(minima.toDF("b", "y"), "b")
        .select("a", "b", _agreeing("x", "y").alias("agreeing"))
        .where(F.col("agreeing") >= MIN_AGREEING)
    )
    best = rated.groupBy("b").agg(F.max(F.struct("agreeing", (-F.col("a")).alias("minus"))).alias("best"))
    links = _confirmed(best.select((-F.col("best.minus")).alias("a"), "b"), rows)

    # What that has not joined.
    label = links.select(F.col("b").alias("id"), F.col("a").alias("label"))
    members = crowded.join(label, "id", "left").withColumn("label", F.coalesce("label", "id"))
    members = stage(members.select("band", "key", "id", "label"), "members")
    mixed = members.groupBy("band", "key").agg(
        F.count(F.lit(1)).alias("n"), F.min("label").alias("low"), F.max("label").alias("high")
    )
    mixed = stage(mixed.where("low <> high").select("band", "key", "n"), "mixed")
    placed = members.join(mixed.select("band", "key"), ["band", "key"], "left_semi").join(minima, "id")
    dealt = in_blocks(placed, mixed, ["band", "key"], "id")
    spans = dealt.groupBy("band", "key", "left", "right").applyInArrow(_clusters, "a long, b long")
    clusters = stage(connected_components(spans).toDF("id", "cluster"), "clusters")
    counted = stage(clusters.groupBy("cluster").agg(F.count(F.lit(1)).alias("n")), "counted")
    sets = _sets(rows, clusters.select("id"))
    placed = clusters.join(label, "id", "left").withColumn("label", F.coalesce("label", "id")).join(minima, "id")
    with arrow_batches(docs.sparkSession, BATCH):
        # The sets come last: they are moved to their documents and to the blocks, not between.
        dealt = in_blocks(placed, counted, ["cluster"], "id", SET_BLOCK).join(sets, "id")
        more = stage(dealt.groupBy("cluster", "left", "right").applyInArrow(_exact_links, "a long, b long"), "more")
    same = copies.select(F.col("id").alias("a"), F.col("first").alias("b"))

    found = stage(connected_components(links.unionByName(more).unionByName(same)).toDF("id", "component_id"), "near")
    out = signed.select("id", "n_shingles").join(found, "id", "left")
    component = F.coalesce("component_id", "id")
    return out.select(
        F.col("id").alias(id_col), "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("id"), F.lit(True)).alias("kept")
    )


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, whose document is kept by ``near_duplicates``."""
    found = near_duplicates(docs, id_col, text_col)
    lost = found.where("not kept").select(F.col(id_col).alias("id")).distinct()
    return docs.join(lost, docs[f"`{id_col}`"].cast("long") == lost["id"], "left_anti")
