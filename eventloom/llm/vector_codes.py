"""Vector codes: equal parts of each vector, each told by its nearest codebook entry.

Codebooks are trained by exact integer rounds over metric trees (anchors hierarchy).
Each task cuts its rows into blocks and builds, per block and part, a tree of balls
from the middle out: about sqrt(n) anchors take the points nearest to them, the
anchors are joined pairwise up to a root, and each anchor's own points are divided
the same way below. A ball caches the number and the sum of its points.

A round passes the codebooks to all trees. A ball inherits the entries that its
parent left as candidates and drops those that are farther than another for all its
points; once one is left the ball is wholly owned, and its cached sums count for that
entry. Only in leaves are single points compared, in whole numbers, so rounding
decides nothing. Sums are added up by Spark; the driver sees the codebooks alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.staging import arrow_batches, stage

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096
#: Rows of one block, and points of a ball that is not divided further.
BLOCK, LEAF = 4096, 24
#: Whole numbers below this keep every squared distance within 64 bits, up to 512 components a part.
_LARGEST = 1 << 26
_BLOCKS_AT_ONCE = 8


class MetricTree:
    """Balls over the rows of ``points`` (n, w), whole numbers.

    ``order`` lists the points so that each ball's are at ``low`` to ``high``.
    Ball 0 is the root; ``left`` and ``right`` are -1 in a leaf. ``count`` is
    ``high - low``, ``total`` the sum of the points, ``centre`` their mean and
    ``radius`` at least the distance of the farthest from it.
    """

    def __init__(self, points: np.ndarray, leaf: int = LEAF) -> None:
        self.points, self._leaf = points, leaf
        self._float = points.astype(np.float64)
        self._balls: list[list] = []  # low, high, left, right
        self.order = np.arange(len(points))
        if len(points):
            root = self._build(self.order)
            self.order = np.concatenate(self._ordered(root))
        self._settle()

    def _build(self, members: np.ndarray) -> dict:
        """A ball over ``members``, divided if they are many and not all the same."""
        if len(members) <= self._leaf:
            return {"own": members}
        owned = self._anchors(members)
        if len(owned) == 1:
            return {"own": members}
        return self._join([self._build(own) for own in owned], [self._float[own] for own in owned])

    def _anchors(self, members: np.ndarray) -> list[np.ndarray]:
        """The points of about sqrt(n) anchors, each nearest to its own.

        The next anchor is the farthest point of the widest one. It takes from
        another only points farther from that than half the way between the two.
        """
        at = self._float[members]
        wanted = int(np.ceil(np.sqrt(len(members))))
        far = np.sqrt(((at - at[0]) ** 2).sum(axis=1))
        pivots, owner = [at[0]], np.zeros(len(members), np.int64)
        while len(pivots) < wanted:
            pick = int(np.argmax(far))
            if far[pick] == 0:
                break
            pivot = at[pick]
            between = np.sqrt(((np.array(pivots) - pivot) ** 2).sum(axis=1))
            may = np.flatnonzero(far > between[owner] / 2)
            new = np.sqrt(((at[may] - pivot) ** 2).sum(axis=1))
            nearer = new < far[may]
            far[may[nearer]], owner[may[nearer]] = new[nearer], len(pivots)
            pivots.append(pivot)
        groups = [members[owner == i] for i in range(len(pivots))]
        return [group for group in groups if len(group)]

    @staticmethod
    def _join(balls: list[dict], points: list[np.ndarray]) -> dict:
        """Pairs balls up to one, always those whose common ball is the smallest."""
        n = len(balls)
        count = np.array([len(p) for p in points], np.float64)
        centre = np.array([p.mean(axis=0) for p in points])
        radius = np.array([np.sqrt(((p - c) ** 2).sum(axis=1).max()) for p, c in zip(points, centre)])
        gap = np.sqrt(((centre[:, None] - centre[None]) ** 2).sum(axis=2))
        width = np.maximum(gap + radius[:, None] + radius[None], 2 * np.maximum(radius[:, None], radius[None]))
        width[np.arange(n), np.arange(n)] = np.inf
        alive = np.ones(n, bool)
        for _ in range(n - 1):
            i, j = divmod(int(np.argmin(width)), n)
            balls[i] = {"left": balls[i], "right": balls[j]}
            both = count[i] + count[j]
            middle = (centre[i] * count[i] + centre[j] * count[j]) / both
            radius[i] = max(np.sqrt(((centre[k] - middle) ** 2).sum()) + radius[k] for k in (i, j))
            centre[i], count[i], alive[j] = middle, both, False
            width[j, :] = width[:, j] = np.inf
            others = np.flatnonzero(alive)
            others = others[others != i]
            gap = np.sqrt(((centre[others] - middle) ** 2).sum(axis=1))
            width[i, others] = width[others, i] = np.maximum(gap + radius[others] + radius[i], 2 * np.maximum(radius[others], radius[i]))
        return balls[int(np.flatnonzero(alive)[0])]

    def _ordered(self, root: dict) -> list[np.ndarray]:
        """Numbers the balls, parents first, and lists the points in the order of the leaves."""
        leaves, at, waiting = [], 0, [(root, -1, 0)]
        while waiting:
            ball, parent, side = waiting.pop()
            number = len(self._balls)
            self._balls.append([at, at, -1, -1])
            if parent >= 0:
                self._balls[parent][2 + side] = number
            if "own" in ball:
                leaves.append(ball["own"])
                at += len(ball["own"])
                self._balls[number][1] = at
            else:
                waiting += [(ball["right"], number, 1), (ball["left"], number, 0)]
        for ball in reversed(self._balls):
            if ball[2] >= 0:
                ball[1] = max(self._balls[ball[2]][1], self._balls[ball[3]][1])
        return leaves

    def _settle(self) -> None:
        balls = np.array(self._balls, np.int64).reshape(-1, 4)
        self.low, self.high, self.left, self.right = balls.T
        inside = self.points[self.order]
        sums = np.concatenate([np.zeros((1, self.points.shape[1]), np.int64), np.cumsum(inside, axis=0)])
        self.total = sums[self.high] - sums[self.low]
        self.centre = self.total / np.maximum(self.high - self.low, 1)[:, None]
        self.radius = np.zeros(len(balls))
        for i, (low, high) in enumerate(zip(self.low, self.high)):
            if high - low and inside.shape[1]:
                self.radius[i] = np.sqrt(((inside[low:high] - self.centre[i]) ** 2).sum(axis=1).max())

    def to_bytes(self) -> bytes:
        """Points in the order of the leaves and the balls, as ``from_bytes`` takes them."""
        head = np.array([*self.points.shape, len(self.low)], np.int64)
        parts = [head, self.points[self.order].astype("<i4"), self.order.astype("<i4"), self.total.astype("<i8"), self.radius.astype("<f8")]
        parts += [x.astype("<i4") for x in (self.low, self.high, self.left, self.right)]
        return b"".join(np.ascontiguousarray(part).tobytes() for part in parts)

    @classmethod
    def from_bytes(cls, data: bytes) -> MetricTree:
        tree, at = cls.__new__(cls), 24
        n, width, balls = np.frombuffer(data, "<i8", 3)

        def take(kind: str, *shape: int) -> np.ndarray:
            nonlocal at
            size = int(np.prod(shape, dtype=np.int64))
            found = np.frombuffer(data, kind, size, at).reshape(shape)
            at += found.nbytes
            return found

        tree.points, tree.order = take("<i4", n, width).astype(np.int64), take("<i4", n)
        tree.total, tree.radius = take("<i8", balls, width), take("<f8", balls)
        tree.low, tree.high, tree.left, tree.right = (take("<i4", balls).astype(np.int64) for _ in range(4))
        tree.centre = tree.total / np.maximum(tree.high - tree.low, 1)[:, None]
        return tree  # points are in the order of the leaves here


class Owners:
    """What a pass over a loaded tree found: per entry the number and sum of its points; of each point its entry."""

    def __init__(self, tree: MetricTree, entries: np.ndarray, points: bool = False) -> None:
        """``entries`` (k, w): the codebook. ``points``: whether each point's entry and distance are asked for."""
        self.count = np.zeros(len(entries), np.int64)
        self.total = np.zeros(entries.shape, np.int64)
        self.code = np.zeros(len(tree.points), np.int64)
        self.compared = 0  # points looked at one by one
        if not len(tree.points):
            return
        spots = entries.astype(np.float64)
        apart = np.sqrt(((spots[:, None] - spots[None]) ** 2).sum(axis=2))
        balls, may = np.zeros(1, np.int64), np.ones((1, len(entries)), bool)
        while len(balls):
            may = self._candidates(tree, spots, apart, balls, may)
            owned = may.sum(axis=1) == 1
            whole = balls[owned]
            owner = np.argmax(may[owned], axis=1)
            np.add.at(self.count, owner, tree.high[whole] - tree.low[whole])
            np.add.at(self.total, owner, tree.total[whole])
            if points:
                for ball, entry in zip(whole, owner):
                    self.code[tree.low[ball] : tree.high[ball]] = entry
            leaf = ~owned & (tree.left[balls] < 0)
            for ball, left_over in zip(balls[leaf], may[leaf]):
                self._compare(tree, entries, ball, np.flatnonzero(left_over))
            inner = ~owned & ~leaf
            balls, may = np.concatenate([tree.left[balls[inner]], tree.right[balls[inner]]]), np.concatenate([may[inner]] * 2)

    @staticmethod
    def _candidates(tree, spots, apart, balls, may) -> np.ndarray:
        """Of the inherited candidates those that some point of the ball may have as its nearest.

        An entry goes if it is farther than the one nearest to the centre for
        all points: the difference of squared distances changes along the line
        between the two entries only. Equal distances never drop one.
        """
        centre = tree.centre[balls]
        square = ((centre[:, None] - spots[None]) ** 2).sum(axis=2)
        best = np.argmin(np.where(may, square, np.inf), axis=1)
        rows = np.arange(len(balls))
        reach = 2 * tree.radius[balls][:, None] * apart[best]
        # Room for what rounding may have done to the sums of squares.
        slack = 1e-9 * (square + square[rows, best][:, None] + reach) + 1e-6
        kept = may & (square - square[rows, best][:, None] <= reach + slack)
        kept[rows, best] = True
        return kept

    def _compare(self, tree: MetricTree, entries: np.ndarray, ball: int, left_over: np.ndarray) -> None:
        inside = slice(tree.low[ball], tree.high[ball])
        points = tree.points[inside]
        self.compared += len(points)
        distance = ((points[:, None] - entries[left_over][None]) ** 2).sum(axis=2)
        nearest = left_over[np.argmin(distance, axis=1)]  # the first of equals: the lowest
        self.code[inside] = nearest
        np.add.at(self.count, nearest, 1)
        np.add.at(self.total, nearest, points)


def _whole_numbers(column: pa.Array) -> list[np.ndarray | None]:
    """floor(SCALE * x) of each vector; None where it is null or holds null or non-finite components."""
    rows: list[np.ndarray | None] = []
    for values in column:
        if not values.is_valid or values.values.null_count:
            rows.append(None)
            continue
        vector = values.values.to_numpy(zero_copy_only=False).astype(np.float64)
        if not np.isfinite(vector).all():
            rows.append(None)
            continue
        scaled = np.floor(SCALE * vector)
        if len(scaled) and np.abs(scaled).max() >= _LARGEST:
            raise ValueError(f"vector components have to be below {_LARGEST // SCALE} in size")
        rows.append(scaled.astype(np.int64))
    return rows


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """id, label and whole numbers of the rows that are kept."""
    for batch in batches:
        rows = _whole_numbers(batch.column(2))
        kept = pa.array([i for i, row in enumerate(rows) if row is not None], pa.int64())
        if len(kept):
            numbers = pa.array([row for row in rows if row is not None], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(kept), batch.column(1).take(kept), numbers], ["id", "label", "q"])


def _trees_with(size: int, parts: int):
    """Blocks of rows, with their ids and labels and a tree per part."""
    width = -(-size // parts)  # shorter vectors are filled up with zeros

    def block(ids: list[pa.Array], labels: list[pa.Array], rows: list[np.ndarray]) -> pa.RecordBatch:
        points = np.zeros((sum(map(len, rows)), parts * width), np.int64)
        points[:, :size] = np.concatenate(rows)
        trees = [MetricTree(points[:, p * width : (p + 1) * width]).to_bytes() for p in range(parts)]
        columns = [pa.ListArray.from_arrays(pa.array([0, len(points)], pa.int32()), pa.concat_arrays(x)) for x in (ids, labels)]
        return pa.RecordBatch.from_arrays([*columns, pa.array([trees], pa.list_(pa.binary()))], ["ids", "labels", "trees"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [[], [], []], 0
        for batch in batches:
            for low in range(0, batch.num_rows, BLOCK):
                part = batch.slice(low, BLOCK)
                numbers = part.column(2).flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                for kept, values in zip(held, (part.column(0), part.column(1), numbers.reshape(part.num_rows, size))):
                    kept.append(values)
                n += part.num_rows
                if n >= BLOCK:
                    yield block(*held)
                    held, n = [[], [], []], 0
        if n:
            yield block(*held)

    return run


def _sums_with(codebooks: list[np.ndarray]):
    """(part, entry, component or -1, sum or number) over all blocks of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = [np.zeros(len(c), np.int64) for c in codebooks]
        total = [np.zeros(c.shape, np.int64) for c in codebooks]
        for batch in batches:
            for trees in batch.column(0):
                for part, data in enumerate(trees):
                    found = Owners(MetricTree.from_bytes(data.as_py()), codebooks[part])
                    count[part] += found.count
                    total[part] += found.total
        rows = [
            (part, entry, component, int(value))
            for part in range(len(codebooks))
            for entry in np.flatnonzero(count[part])
            for component, value in ((-1, count[part][entry]), *enumerate(total[part][entry]))
        ]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], kind) for i, kind in enumerate((pa.int32(), pa.int32(), pa.int32(), pa.int64()))],
            ["part", "entry", "component", "value"],
        )

    return run


def _codes_with(codebooks: list[np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, labels, trees in zip(*(batch.column(i) for i in range(3))):
                n = len(ids.values)
                codes, error = np.zeros((n, len(codebooks)), np.uint8), np.zeros(n, np.int64)
                for part, data in enumerate(trees):
                    tree = MetricTree.from_bytes(data.as_py())
                    code = Owners(tree, codebooks[part], points=True).code
                    codes[tree.order, part] = code
                    error[tree.order] += ((tree.points - codebooks[part][code]) ** 2).sum(axis=1)
                text = codes.tobytes().hex()
                width = 2 * len(codebooks)
                texts = [text[i * width : (i + 1) * width] for i in range(n)]
                yield pa.RecordBatch.from_arrays([ids.values, labels.values, pa.array(texts), pa.array(error)], ["id", "label", "code", "error"])

    return run


def _digest(codebooks: list[np.ndarray]) -> str:
    numbers = [str(int(x)) for codebook in codebooks for x in codebook.ravel()]
    return hashlib.sha256(",".join(numbers).encode()).hexdigest()


def compress_vectors(
    rows: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> DataFrame:
    """(``id_col``, code, error, label_error, codebooks_sha256) of every row that is kept.

    Vectors that are null or hold null or non-finite components are dropped, as
    are those of another length than the vector of the smallest id. Components
    become floor(4096 x), which has to be below 2^26 in size: others are refused.
    Vectors are cut into ``parts`` equal parts, filled up with zeros if their
    length does not divide. Each codebook starts as that part of the ``entries``
    smallest ids (of equal ids the smallest vector; null is the largest id), and
    is trained for ``rounds`` rounds: each part goes to its nearest entry, the
    lowest of equals, and each entry that has parts becomes the floor of their
    mean. ``code`` has two hexadecimal digits per part, ``error`` is the sum of
    the final squared distances, ``label_error`` that over equal labels, null
    labels together.

    Every one of repeated rows counts and is returned. No rows, or none that is
    kept, give no rows. Other columns are not read.
    """
    if not 0 < entries <= 256:
        raise ValueError("entries: 1 to 256, two hexadecimal digits")
    spark = rows.sparkSession
    names = [id_col, label_col, vector_col]
    picked = rows.select(*[F.col(f"`{name}`").alias(new) for name, new in zip(names, ("id", "label", "v"))])
    picked = picked.withColumn("v", F.col("v").cast("array<double>"))
    id_type, label_type = (picked.schema[x].dataType.simpleString() for x in ("id", "label"))
    kept = stage(picked.mapInArrow(_whole, f"id {id_type}, label {label_type}, q array<int>"), "whole")

    def same(ids: list):
        known = [i for i in ids if i is not None]
        return F.col("id").isin(known) | (F.col("id").isNull() if None in ids else F.lit(False))

    def smallest(n: int, of: DataFrame) -> list:
        """The smallest ``n`` ids with their smallest vectors: two passes, so that only these vectors are compared."""
        ids = [row.id for row in of.select("id").distinct().orderBy(F.asc_nulls_last("id")).limit(n).collect()]
        first = of.where(same(ids)).groupBy("id").agg(F.min("q").alias("q"))
        return first.orderBy(F.asc_nulls_last("id")).collect()

    first = smallest(1, kept)
    size = len(first[0].q) if first else 0
    kept = kept.where(F.size("q") == size)
    first = smallest(entries, kept)
    start = np.array([row.q for row in first], np.int64).reshape(len(first), size)
    width = -(-size // parts)
    padded = np.zeros((len(start), parts * width), np.int64)
    padded[:, :size] = start
    codebooks = [padded[:, p * width : (p + 1) * width].copy() for p in range(parts)]

    schema = f"ids array<{id_type}>, labels array<{label_type}>, trees array<binary>"
    trees = stage(kept.mapInArrow(_trees_with(size, parts), schema), "trees")
    with arrow_batches(spark, _BLOCKS_AT_ONCE):
        for _ in range(rounds):
            sums = trees.select("trees").mapInArrow(_sums_with(codebooks), "part int, entry int, component int, value long")
            # At most parts x entries x components rows, whatever the input.
            sums = sums.groupBy("part", "entry", "component").agg(F.sum("value").alias("value")).collect()
            number = {(r.part, r.entry): r.value for r in sums if r.component < 0}
            for r in sums:
                if r.component >= 0:
                    codebooks[r.part][r.entry, r.component] = r.value // number[r.part, r.entry]
        coded = trees.mapInArrow(_codes_with(codebooks), f"id {id_type}, label {label_type}, code string, error long")
        coded = stage(coded, "codes")
    errors = stage(coded.groupBy("label").agg(F.sum("error").alias("label_error")), "errors")
    # A join by the label alone, null as any other. Both sides are read, so a hot label's rows can be split.
    errors = errors.withColumnRenamed("label", "of")
    found = coded.join(errors, F.col("label").eqNullSafe(F.col("of")), "left")
    return found.select(
        F.col("id").alias(id_col), "code", "error", "label_error", F.lit(_digest(codebooks)).alias("codebooks_sha256")
    )
