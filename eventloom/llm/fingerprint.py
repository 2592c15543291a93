"""Homomorphic multiset fingerprints of documents.

A document is the multiset of its paragraphs (lines). Each paragraph becomes a wide
vector, and the fingerprint is the sum of these vectors, lane by lane modulo
2^32. So order does not matter, equal multisets have equal fingerprints, and a
paragraph is put in or taken out by adding or subtracting its vector.

There are two groups of lanes. ``EXACT`` lanes are the BLAKE2b digest of
the paragraph: two multisets with the same sums are, but for chance, equal.
``SKETCH`` lanes are a signed sketch of the paragraph's three-word
shingles, from which two fingerprints tell how alike their documents are.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom.llm.words import WordHasher, chunks, mix, starts_of_words

EXACT, SKETCH = 16, 128
_HASH = WordHasher()
_U64 = np.uint64


class Fingerprint:
    """A sum of paragraph vectors. ``+`` and ``-`` join and part multisets."""

    __slots__ = ("exact", "sketch")

    def __init__(self, exact: np.ndarray | None = None, sketch: np.ndarray | None = None) -> None:
        self.exact = np.zeros(EXACT, np.uint32) if exact is None else exact
        self.sketch = np.zeros(SKETCH, np.uint32) if sketch is None else sketch

    def __add__(self, other: Fingerprint) -> Fingerprint:
        return Fingerprint(self.exact + other.exact, self.sketch + other.sketch)

    def __sub__(self, other: Fingerprint) -> Fingerprint:
        return Fingerprint(self.exact - other.exact, self.sketch - other.sketch)

    def __eq__(self, other: object) -> bool:
        return isinstance(other, Fingerprint) and self.text() == other.text()

    __hash__ = None

    def text(self) -> str:
        raw = self.exact.astype("<u4").tobytes() + self.sketch.astype("<u4").tobytes()
        return base64.b64encode(raw).decode()

    @classmethod
    def parse(cls, text: str) -> Fingerprint:
        raw = base64.b64decode(text)
        return cls(np.frombuffer(raw[: 4 * EXACT], "<u4").astype(np.uint32), np.frombuffer(raw[4 * EXACT :], "<u4").astype(np.uint32))

    def likeness(self, other: Fingerprint) -> float:
        """1 for equal multisets, else the cosine of the sketches, from 0 to below 1."""
        if (self.exact == other.exact).all() and (self.sketch == other.sketch).all():
            return 1.0
        a, b = (x.sketch.astype(np.int32).astype(np.float64) for x in (self, other))
        size = np.sqrt((a @ a) * (b @ b))
        return float(np.clip(a @ b / size, 0, 0.999999)) if size else 0.0


def _sketches(texts: list[str]) -> np.ndarray:
    """The sketch lanes of each text.

    A shingle lies within one paragraph; one of fewer than three words is a shingle itself.
    """
    parts = []
    for _, buffer, bounds in chunks(texts):
        starts = starts_of_words(buffer)
        hashes = _HASH(buffer, starts)
        # Paragraphs end at line feeds and texts; each word knows its paragraph.
        ends = np.union1d(np.flatnonzero(buffer == 10), bounds[1:] - 1)
        home = np.searchsorted(ends, starts)
        text = np.searchsorted(bounds, starts, "right") - 1
        n = len(hashes)
        # A word begins a shingle with the next two, if they are in its paragraph.
        joined, full = hashes.copy(), np.ones(n, bool)
        for step, factor in ((1, 0x9FB21C651E98DF25), (2, 0xD6E8FEB86659FD93)):
            same = np.zeros(n, bool)
            same[: max(n - step, 0)] = home[step:] == home[: max(n - step, 0)]
            shifted = np.zeros(n, np.uint64)
            shifted[: max(n - step, 0)] = hashes[step:]
            joined += np.where(same, shifted, _U64(0)) * _U64(factor)
            full &= same
        leads = np.ones(n, bool)
        leads[1:] = home[1:] != home[:-1]
        use = full | leads
        keys = mix(joined[use])
        lane = (keys & _U64(SKETCH - 1)).astype(np.int64)
        sign = np.where(keys >> _U64(63), 1, -1)
        n_texts = len(bounds) - 1
        lanes = np.bincount(text[use] * SKETCH + lane, weights=sign, minlength=n_texts * SKETCH)
        parts.append(lanes.astype(np.int64).astype(np.uint32).reshape(n_texts, SKETCH))
    return np.concatenate(parts) if parts else np.zeros((0, SKETCH), np.uint32)


def paragraphs(text: str | None) -> list[str]:
    """The lines; a null or empty text has none."""
    return text.split("\n") if text else []


def _exact(text: str) -> np.ndarray:
    digests = b"".join(
        [hashlib.blake2b(p.encode("utf-8", "surrogatepass"), digest_size=4 * EXACT).digest() for p in paragraphs(text)]
    )
    return np.frombuffer(digests, "<u4").reshape(-1, EXACT).sum(axis=0, dtype=np.uint32)


def fingerprints(texts: list[str | None]) -> list[Fingerprint]:
    texts = [t or "" for t in texts]
    return [Fingerprint(_exact(t), s) for t, s in zip(texts, _sketches(texts))]


@F.arrow_udf(T.StringType())
def fingerprint_udf(texts: pa.Array) -> pa.Array:
    """The fingerprint of each text; null counts as empty."""
    return pa.array([f.text() for f in fingerprints(texts.to_pylist())], pa.string())


def edited(text: str, following: str) -> str:
    """The last third of the code points replaced by the first as many, or all, of the next document."""
    n = len(text) // 3
    return text[: len(text) - n] + following[:n]


_AT_ONCE = 256


def _compare(rows: Iterator[tuple]) -> Iterator[list[tuple]]:
    """Of rows (id, text, only a follower) in order, with each document's follower next: results in lists."""

    def results(run: list[tuple]) -> list[tuple]:
        texts = [r[1] or "" for r in run]
        news = [edited(a, b) for a, b in zip(texts, texts[1:])]
        own, changed = fingerprints(texts), fingerprints(news)
        return [
            (run[i][0], len(texts[i]), hashlib.sha256(news[i].encode("utf-8", "surrogatepass")).hexdigest(),
             own[i].text(), changed[i].text(), own[i].likeness(changed[i]), own[i].likeness(own[i + 1]))
            for i in range(len(run) - 1) if not run[i][2]
        ]

    run: list[tuple] = []
    for row in rows:
        run.append(row)
        if len(run) > _AT_ONCE:
            yield results(run)
            run = run[-1:]
    if len(run) > 1:
        yield results(run)


def _cuts_below(value: Column, cuts: list[float]) -> Column:
    """How many of the sorted ``cuts`` are below a value: by halving, with all of them in one literal."""
    if not cuts:
        return F.lit(0)
    at = F.split(F.lit(",".join(map(repr, cuts))), ",").cast("array<double>")
    steps = [1 << i for i in reversed(range(len(cuts).bit_length()))]

    def halve(low: Column, step: Column) -> Column:
        further = F.get(at, low + step - 1) < value  # null behind the last
        return F.when(further, low + step).otherwise(low)

    return F.aggregate(F.array(*[F.lit(i) for i in steps]), F.lit(0), halve)


def compare_with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stretches: int | None = None) -> DataFrame:
    """Each row's fingerprint, that of its edited text, and likenesses to this and to the next document's.

    Columns: ``id_col``, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next. The next document is the one with the next smaller id
    (rows with one id go by their texts); after the last comes the first. A single row
    is its own next. Null texts count as empty; null ids come after all others.
    No rows give no rows. Other columns are not kept.

    Ids are dealt into stretches of equal size by their quantiles, so texts are
    shuffled once; the first row of a stretch is also sent to the one before it.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    spark = docs.sparkSession
    id_type = rows.schema["id"].dataType.simpleString()
    if stretches is None:
        stretches = 4 * max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    # One number per stretch, from ids alone: bounded by ``stretches``.
    shares = [i / stretches for i in range(1, stretches)]
    cuts = sorted(set(rows.select("id").approxQuantile("id", shares, 0.1 / stretches))) if shares else []
    text_hash = F.coalesce(F.sha2("text", 256), F.lit(""))
    nameless = F.lit(-1)
    if not rows.where("id is null").isEmpty():
        # Rows without an id come last, in the order of their texts' hashes: their stretches count down from -1.
        share = F.coalesce(F.conv(F.substring(text_hash, 1, 4), 16, 10).cast("int"), F.lit(0)) / 65536
        nameless = F.lit(-1) - F.floor(share * stretches).cast("int")
    placed = rows.withColumn("stretch", F.when(F.col("id").isNull(), nameless).otherwise(_cuts_below(F.col("id"), cuts)))
    heads = (
        placed.groupBy("stretch").agg(F.max("id").alias("id"), F.count(F.lit(1)).alias("n")).orderBy(F.desc("stretch")).collect()
    )
    schema = f"`{id_col}` {id_type}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    if not heads:
        return spark.createDataFrame([], schema)
    # The head of a stretch (the greatest id; of rows with this id the first by text) follows the stretch before it.
    before = {h.stretch: heads[i - 1].stretch for i, h in enumerate(heads)}
    first = placed.join(
        F.broadcast(spark.createDataFrame([(h.stretch, h.id, before[h.stretch]) for h in heads], f"s int, head {id_type}, target int")),
        (F.col("stretch") == F.col("s")) & F.col("id").eqNullSafe(F.col("head")),
    )
    first = first.groupBy("s", "target").agg(F.min_by(F.struct("id", "text"), F.struct(text_hash.alias("h"))).alias("r"))
    followers = first.select("r.id", "r.text", F.col("target").alias("stretch"), F.lit(True).alias("extra"))
    dealt = (
        placed.select("id", "text", "stretch", F.lit(False).alias("extra")).unionByName(followers)
        .repartition("stretch")
        .sortWithinPartitions("stretch", "extra", F.desc_nulls_last("id"), text_hash)
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def stretches_of_rows():
            for batch in batches:
                kinds[:] = [batch.schema.field("id").type]
                yield from zip(*(batch.column(c).to_pylist() for c in ("id", "text", "extra", "stretch")))

        kinds: list[pa.DataType] = []
        # A follower ends its stretch, so nothing is compared across stretches.
        for found in _compare(stretches_of_rows()):
            types = [kinds[0], pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            arrays = [pa.array([r[i] for r in found], t) for i, t in enumerate(types)]
            yield pa.RecordBatch.from_arrays(arrays, [id_col, "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    return dealt.mapInArrow(run, schema)
