"""Document quality by regularised quadratic discriminant analysis.

Each document becomes a short vector of transformed statistics. Spark adds up the
moments of each class over all labelled rows; the driver sees only those sums. A
class has a Gaussian whose covariance is shrunk towards the pooled one and towards
a multiple of the identity. The score is the logistic function of the difference of
the two log densities, from Mahalanobis distances by Cholesky factors made once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom.llm.staging import let_go, stage
from eventloom.llm.words import LOWER, SPACE, WordHasher, chunks, starts_of_words

#: Weight of the pooled covariance in a class's, and of the identity in both.
TOWARDS_POOLED = 0.2
TOWARDS_IDENTITY = 0.02
_MARKS = {"upper": range(65, 91), "digit": range(48, 58), "stop": b".,;:?'\"()-", "shout": b"!",
          "symbol": b"#$%&*@^~+=<>\\/_{}[]`", "pipe": b"|", "line": b"\n", "wide": range(128, 256)}
STATISTICS = ("bytes", "words", "word_length", *_MARKS, "capitals", "short", "distinct_words", "distinct_lines")
_HASH = WordHasher()


def _by_text(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of ``values`` (one per byte) over each text; none is empty, a space follows each."""
    return np.add.reduceat(values, bounds[:-1], dtype=np.int64)


def _distinct(keys: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Number of distinct keys between neighbouring ``cuts``."""
    text = np.repeat(np.arange(len(cuts) - 1), np.diff(cuts))
    order = np.lexsort((keys, text))
    keys, text = keys[order], text[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (text[1:] != text[:-1])
    return np.bincount(text[new], minlength=len(cuts) - 1)


def _chunk_statistics(buffer: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    n_bytes = np.diff(bounds) - 1
    starts = starts_of_words(buffer)
    cuts = np.searchsorted(starts, bounds)
    n_words = np.diff(cuts)
    lengths = np.diff(np.append(starts, len(buffer)))
    hashes = _HASH(LOWER[buffer], starts)
    breaks = buffer == 10
    line_starts = np.unique(np.concatenate([bounds[:-1], np.flatnonzero(breaks) + 1]))
    line_starts = line_starts[line_starts < len(buffer)]
    line_cuts = np.searchsorted(line_starts, bounds)
    n_lines = np.diff(line_cuts)
    line_keys = _HASH(LOWER[buffer], line_starts)
    per_byte, per_word = np.maximum(n_bytes, 1), np.maximum(n_words, 1)
    columns = [np.log1p(n_bytes), np.log1p(n_words), np.log1p(_by_text(~SPACE[buffer], bounds) / per_word)]
    for kind in _MARKS.values():
        table = np.zeros(256, bool)
        table[list(kind)] = True
        columns.append(np.sqrt(_by_text(table[buffer], bounds) / per_byte))
    first = np.concatenate([[0], np.cumsum((buffer[starts] >= 65) & (buffer[starts] <= 90))])[cuts]
    short = np.concatenate([[0], np.cumsum(lengths <= 4)])[cuts]
    columns += [np.diff(first) / per_word, np.diff(short) / per_word]
    columns += [_distinct(hashes, cuts) / per_word, _distinct(line_keys, line_cuts) / np.maximum(n_lines, 1)]
    return np.column_stack(columns)


def statistics(texts: list[str | None]) -> np.ndarray:
    """One row of ``STATISTICS`` per text; null counts as empty."""
    found = [_chunk_statistics(buffer, bounds) for _, buffer, bounds in chunks(texts)]
    return np.concatenate(found) if found else np.zeros((0, len(STATISTICS)))


@F.arrow_udf(T.ArrayType(T.DoubleType()))
def statistics_udf(texts: pa.Array) -> pa.Array:
    rows = statistics(texts.to_pylist())
    offsets = pa.array(np.arange(len(rows) + 1) * len(STATISTICS), pa.int32())
    return pa.ListArray.from_arrays(offsets, pa.array(rows.ravel()))


@dataclass
class QuadraticDiscriminant:
    """Two Gaussians; ``factors`` holds the Cholesky factor of each covariance.

    Without rows of both classes every score is ``constant``: 1 or 0 if only that
    class has been seen, 0.5 if none.
    """

    means: list[np.ndarray] = field(default_factory=list)
    factors: list[np.ndarray] = field(default_factory=list)
    offset: float = 0.0
    constant: float | None = None

    @classmethod
    def fit(cls, counts: list[float], sums: list[np.ndarray], products: list[np.ndarray]) -> QuadraticDiscriminant:
        """From the number, sum and sum of outer products of the vectors of class 0 and 1."""
        if not all(counts):
            return cls(constant=0.5 if not any(counts) else float(bool(counts[1])))
        means = [s / n for s, n in zip(sums, counts)]
        own = [p / n - np.outer(m, m) for p, n, m in zip(products, counts, means)]
        pooled = sum(n * c for n, c in zip(counts, own)) / sum(counts)
        factors, densities = [], []
        for n, c in zip(counts, own):
            c = (1 - TOWARDS_POOLED) * c + TOWARDS_POOLED * pooled
            level = max(np.trace(c) / len(c), 1e-9)
            c = (1 - TOWARDS_IDENTITY) * c + TOWARDS_IDENTITY * level * np.eye(len(c))
            factors.append(np.linalg.cholesky(c))
            densities.append(np.log(n) - np.log(np.diag(factors[-1])).sum())
        return cls(means, factors, densities[1] - densities[0])

    def score(self, vectors: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(vectors), self.constant)
        far = [
            (np.linalg.solve(factor, (vectors - mean).T) ** 2).sum(axis=0)
            for mean, factor in zip(self.means, self.factors)
        ]
        return 1 / (1 + np.exp(-np.clip((far[0] - far[1]) / 2 + self.offset, -500, 500)))

    def from_text(self) -> object:
        """A function of a text column that gives scores."""
        model = self

        @F.arrow_udf("double")
        def score(texts: pa.Array) -> pa.Array:
            return pa.array(model.score(statistics(texts.to_pylist())), pa.float64())

        return score

    def from_statistics(self) -> object:
        """A function of a column of ``statistics_udf`` that gives scores."""
        model = self

        @F.arrow_udf("double")
        def score(rows: pa.Array) -> pa.Array:
            vectors = rows.flatten().to_numpy(zero_copy_only=False).reshape(len(rows), -1)
            return pa.array(model.score(vectors) if len(rows) else [], pa.float64())

        return score


def is_held_out(key: Column, folds: int, fold: int) -> Column:
    """Whether the CRC-32 of the key as text leaves ``fold`` when divided by ``folds``; a null key is not."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % folds == fold, F.lit(False))


def one_label_each(labels: DataFrame, label: str, id_col: str) -> DataFrame:
    """(id, label): the label of most rows of an id, 1 in a tie; null ids and labels are left out."""
    rows = labels.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label}`").cast("double").alias("y")).dropna()
    return rows.groupBy("id").agg((F.avg("y") >= 0.5).cast("int").alias("label"))


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    let_go()
    k = len(STATISTICS)
    sums = np.zeros((2, 1 + k + k * k))
    for batch in batches:
        vectors = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, k)
        classes = batch.column(1).to_numpy(zero_copy_only=False)
        for c in (0, 1):
            own = vectors[classes == c]
            sums[c] += np.concatenate([[len(own)], own.sum(axis=0), (own.T @ own).ravel()])
    size = sums.shape[1]
    yield pa.RecordBatch.from_pydict({"class": np.repeat([0, 1], size), "at": np.tile(np.arange(size), 2), "value": sums.ravel()})


def fit_quality(vectors: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> QuadraticDiscriminant:
    """From (id, vector) and (id, label); all rows with a label count."""
    k = len(STATISTICS)
    joined = vectors.withColumnRenamed(id_col, "id").join(labels, "id").select("vector", "label")
    parts = joined.mapInArrow(_moments, "class long, at long, value double")
    total = np.zeros((2, 1 + k + k * k))
    for row in parts.groupBy("class", "at").agg(F.sum("value").alias("value")).collect():
        total[row["class"], row["at"]] = row["value"]  # two rows of fixed length
    return QuadraticDiscriminant.fit(
        total[:, 0].tolist(), list(total[:, 1 : 1 + k]), [t.reshape(k, k) for t in total[:, 1 + k :]]
    )


def score_quality(
    docs: DataFrame,
    labels: DataFrame,
    folds: int = 3,
    fold: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
) -> DataFrame:
    """(``id_col``, held_out, score, predicted) of every row.

    Learns from the rows of ``labels`` that ``is_held_out`` does not name; only
    the text gives the score. Null and empty texts have the score of an empty
    text. Rows with one id are scored each, null ids too. An id with several
    labels has that of most, 1 in a tie. Without labels of both classes the score
    is constant (``QuadraticDiscriminant``). An empty table gives no rows; other
    columns are not kept.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias(id_col), statistics_udf(F.col(f"`{text_col}`")).alias("vector"))
    rows = stage(rows, "quality")  # texts are read once
    learn = one_label_each(labels.where(~is_held_out(F.col(f"`{id_col}`"), folds, fold)), label_col, id_col)
    model = fit_quality(rows, learn, id_col)
    return rows.select(
        id_col, is_held_out(F.col(id_col), folds, fold).alias("held_out"), model.from_statistics()("vector").alias("score")
    ).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def keep_quality(
    docs: DataFrame,
    labels: DataFrame,
    folds: int = 3,
    fold: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
) -> DataFrame:
    """The rows of ``docs``, with all their columns, that score 0.5 or more; see ``score_quality``."""
    learn = one_label_each(labels.where(~is_held_out(F.col(f"`{id_col}`"), folds, fold)), label_col, id_col)
    known = docs.select(F.col(f"`{id_col}`").alias(id_col), statistics_udf(F.col(f"`{text_col}`")).alias("vector"))
    model = fit_quality(known, learn, id_col)
    return docs.where(model.from_text()(F.col(f"`{text_col}`")) >= 0.5)
