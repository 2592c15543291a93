"""Near-duplicate embeddings: random-hyperplane signs in several tables, exact cosines, components.

Vectors equal in every component are one class first. Each class gets one key per
table: the signs of its vector on the table's hyperplanes. The classes of a bucket
(table, key) are compared in blocks by their exact cosines; a pair counts in the
first table whose bucket it shares, so blocks return sums and links that span them
instead of pairs.

Keys have a few bits more than the logarithm of the number of rows, so buckets stay
small at any size, and there are as many tables as it takes to miss a pair at the
threshold with a chance of at most ``MISS``.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.blocks import in_blocks, roots
from eventloom.llm.components import connected_components
from eventloom.llm.staging import stage

COSINE = 0.95
MISS = 0.002
_SEED = 64


def plan_tables(n: int, cosine: float = COSINE, miss: float = MISS) -> tuple[int, int]:
    """(bits, tables) for ``n`` rows."""
    bits = min(60, max(8, math.ceil(math.log2(max(n, 2))) + 2))
    share = (1 - math.acos(cosine) / math.pi) ** bits
    return bits, math.ceil(math.log(miss) / math.log1p(-share))


def _planes(size: int, bits: int, tables: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64([_SEED, size])).standard_normal((size, bits * tables))


def _keys(vectors: np.ndarray, bits: int, tables: int) -> np.ndarray:
    signs = (vectors @ _planes(vectors.shape[1], bits, tables) >= 0).reshape(len(vectors), tables, bits)
    return signs @ (1 << np.arange(bits, dtype=np.int64))


def _classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """id, digest and bytes of each vector; those are null where a vector links with nothing."""
    for batch in batches:
        lists = batch.column(1).to_pylist()
        data: list[bytes | None] = []
        for values in lists:
            vector = np.array(values, np.float64) if values and None not in values else np.zeros(0)
            usable = len(vector) and np.isfinite(vector).all() and vector.any()
            # 0.0 and -0.0 are equal.
            data.append((vector + 0.0).tobytes() if usable else None)
        digests = [hashlib.blake2b(d, digest_size=16).digest() if d else None for d in data]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(digests, pa.binary()), pa.array(data, pa.binary())], ["id", "same", "vector"]
        )


def _unit(rows: list[bytes]) -> np.ndarray:
    vectors = np.frombuffer(b"".join(rows), np.float64).reshape(len(rows), -1)
    # First by the largest component, so that squares neither overflow nor vanish.
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def _hash_with(bits: int, tables: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column("vector").to_pylist()
            by_size: dict[int, list[int]] = {}
            for i, row in enumerate(rows):
                by_size.setdefault(len(row), []).append(i)
            for at in by_size.values():
                for low in range(0, len(at), 2048):
                    part = at[low : low + 2048]
                    keys = _keys(_unit([rows[i] for i in part]), bits, tables)
                    picked = batch.take(pa.array(part))
                    yield pa.RecordBatch.from_arrays(
                        [picked.column("id"), picked.column("size"), picked.column("vector"), pa.array(list(keys), pa.list_(pa.int64()))],
                        ["id", "size", "vector", "keys"],
                    )

    return run


def _links_with(cosine: float):
    def compare(group: pa.Table) -> pa.Table:
        """(id, other, found): links that span what the blocks link, and per id the rows it found."""
        side, table = group.column("side").to_numpy(), group.column("table")[0].as_py()
        left, right = group.column("left")[0].as_py(), group.column("right")[0].as_py()
        ids, sizes = group.column("id").to_numpy(), group.column("size").to_numpy()
        vectors = _unit(group.column("vector").to_pylist())
        keys = np.array(group.column("keys").to_pylist(), np.int64)[:, :table]
        rows, others = np.flatnonzero(side == left), np.flatnonzero(side == right)
        found, ends = np.zeros(len(ids), np.int64), []
        for low in range(0, len(rows), 256):
            part = rows[low : low + 256]
            i, j = np.nonzero(vectors[part] @ vectors[others].T >= cosine - 1e-9)
            a, b = part[i], others[j]
            if left == right:
                a, b = a[ids[a] < ids[b]], b[ids[a] < ids[b]]
            # Near the threshold the sum itself decides, the same way for every block.
            near = np.einsum("ij,ij->i", vectors[a], vectors[b]) >= cosine
            if table:
                near &= ~(keys[a] == keys[b]).any(axis=1)
            a, b = a[near], b[near]
            np.add.at(found, a, sizes[b])
            np.add.at(found, b, sizes[a])
            ends.append((a, b))
        a, b = (np.concatenate(x) for x in zip(*ends)) if ends else (np.zeros(0, np.int64),) * 2
        order = np.argsort(ids)
        place = np.empty(len(ids), np.int64)
        place[order] = np.arange(len(ids))
        first = roots(len(ids), place[a], place[b])
        linked = np.flatnonzero(found)
        others_of = ids[order][first[place[linked]]]
        return pa.table({"id": ids[linked], "other": others_of, "found": found[linked]})

    return compare


def near_duplicate_vectors(
    rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = COSINE, miss: float = MISS
) -> DataFrame:
    """(``id_col``, n_links, component_id, kept) of every row.

    Vectors of equal length whose cosine, in double precision, is at least
    ``cosine`` are linked, if they share a bucket of any table (see ``miss``);
    ``n_links`` counts the other rows linked directly, ``component_id`` is the
    smallest id that links lead to, ``kept`` tells whether it is the row's own.

    Null, empty and zero vectors, and those with null or non-finite components,
    link with nothing. Of rows with one id the one whose vector has the smallest
    digest speaks for all, so each of them has the same result. A null id links
    with nothing, has a null component and is kept. No rows give no rows; other
    columns are not kept. Ids are integers.
    """
    picked = rows.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vector_col}`").cast("array<double>").alias("v"))
    vectors = stage(picked.mapInArrow(_classes, "id long, same binary, vector binary"), "vectors")
    known = vectors.where("id is not null and same is not null").groupBy("id").agg(F.min("same").alias("same"))
    known = stage(known, "known")
    first = known.groupBy("same").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("size"))
    first = stage(first, "classes")
    bits, tables = plan_tables(first.count(), cosine, miss)
    speakers = vectors.join(first, ["id", "same"]).select("id", "size", "vector").dropDuplicates(["id"])
    hashed = stage(speakers.mapInArrow(_hash_with(bits, tables), "id long, size long, vector binary, keys array<long>"), "hashed")

    # Only classes with company in a bucket are shuffled with their vectors.
    placed = hashed.select("id", F.octet_length("vector").alias("bytes"), F.posexplode("keys").alias("table", "key"))
    buckets = placed.groupBy("table", "key", "bytes").agg(F.count(F.lit(1)).alias("n"))
    buckets = stage(buckets.where("n > 1"), "buckets")
    full = hashed.select("id", "size", "vector", "keys", F.octet_length("vector").alias("bytes"), F.posexplode("keys").alias("table", "key"))
    dealt = in_blocks(full, buckets, ["table", "key", "bytes"], "id")
    found = stage(
        dealt.groupBy("table", "key", "bytes", "left", "right").applyInArrow(_links_with(cosine), "id long, other long, found long"), "found"
    )

    copies = known.join(first.withColumnRenamed("id", "first"), "same").select("id", "first", "size")
    copies = stage(copies, "copies")
    links = found.select(F.col("id").alias("a"), F.col("other").alias("b")).unionByName(
        copies.where("id <> first").select(F.col("id").alias("a"), F.col("first").alias("b"))
    )
    parts = connected_components(links).toDF("id", "component_id")
    degrees = stage(found.groupBy("id").agg(F.sum("found").alias("found")).withColumnRenamed("id", "first"), "degrees")
    result = (
        copies.join(degrees, "first", "left")
        .select("id", (F.coalesce("found", F.lit(0)) + F.col("size") - 1).alias("n_links"))
        .join(parts, "id", "left")
    )
    out = vectors.select("id").join(stage(result, "near"), "id", "left")
    component = F.coalesce("component_id", "id")
    return out.select(
        F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"), F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"),
    )
