"""Byte-level BPE encoding and decoding, long texts by tree concatenation.

Texts up to ``leaf_chars`` are encoded where they are. Longer ones are cut into
leaves that Spark spreads over tasks; neighbours are then joined pairwise, up a
tree: a growing window around each join is encoded anew until its first token
agrees with the left side and its last with the right side.

Why agreement is exact: a sequence of tokens is the BPE encoding of a stretch of
text if and only if each pair of neighbours is, and agreeing ends put every pair
into one of three encodings. The pre-tokenizer is honoured by starting and ending
windows only where it certainly splits, or within a run of one class of characters
(``_edge``). A window that reaches the ends of the text is exact by itself.
"""

from __future__ import annotations

import base64
import functools
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.llm.words import SPACE, IdTable, WordHasher, chunks, cut, mix, spread

#: The pattern by which byte-level BPE splits text before its merges (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SPECIAL = "<|endoftext|>"
LEAF_CHARS = 32_768
#: Longer texts could have more stretches than the table of known ones takes.
_LONG = 1 << 19
#: White space of the pattern that is not ASCII.
_WIDE_SPACE = "[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
_IDS = np.dtype("<u4")


class ByteBpe:
    """One vocabulary; ``ranks_file`` holds base64 tokens and their ranks."""

    def __init__(self, ranks_file: str, special: dict[str, int]) -> None:
        import tiktoken

        with open(ranks_file, "rb") as lines:
            pairs = (line.split() for line in lines if line.strip())
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.special = special
        self._bpe = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=self.ranks, special_tokens=special)
        self.tokens = {i: t for t, i in self.ranks.items()} | {i: s.encode() for s, i in special.items()}
        pieces = [self.tokens.get(i, b"") for i in range(max(self.tokens) + 1)]
        self._bytes = np.frombuffer(b"".join(pieces), np.uint8)
        self._lengths = np.array([len(p) for p in pieces] + [0])
        self._at = np.concatenate([[0], np.cumsum(self._lengths[:-1])])
        self._hash, self._table = WordHasher(spaces=True), IdTable()
        self._apart = re.compile("|".join([_WIDE_SPACE, *map(re.escape, special)]))

    def encode(self, text: str) -> list[int]:
        return self._bpe.encode(text, allowed_special="all")

    def encode_all(self, texts: list[str | None]) -> Iterator[bytes]:
        """The ids of each text, in order, as little-endian unsigned 32-bit integers.

        Whatever surrounds it, a text splits before a space that no white space
        follows. So texts are cut there, and the ids of each stretch are found once
        and kept. Texts with special tokens or with white space beyond ASCII, and
        very long ones, are left to the encoder.
        """
        apart = [bool(t and (len(t) > _LONG or self._apart.search(t))) for t in texts]
        for first, buffer, bounds in chunks("" if a else t for t, a in zip(texts, apart)):
            for number, ids in enumerate(self._encode_chunk(buffer, bounds), first):
                yield np.array(self.encode(texts[number]), _IDS).tobytes() if apart[number] else ids

    def _encode_chunk(self, buffer: np.ndarray, bounds: np.ndarray) -> list[bytes]:
        begins = np.zeros(len(buffer), bool)
        begins[:-1] = (buffer[:-1] == 0x20) & ~SPACE[buffer[1:]]
        begins[bounds[:-1]] = True
        begins[bounds[1:] - 1] = True  # the space behind a text, a unit without ids
        starts = np.flatnonzero(begins)
        lengths = np.diff(np.append(starts, len(buffer)))
        keys = mix(self._hash(buffer, starts) + lengths.astype(np.uint64))
        real = ~np.isin(starts, bounds[1:] - 1, assume_unique=True)
        starts, lengths, data = starts[real], lengths[real], buffer.tobytes()

        def encode(at: list[int]) -> Iterator[list[int]]:
            for start, size in zip(starts[at].tolist(), lengths[at].tolist()):
                yield self._bpe.encode_ordinary(data[start : start + size].decode())

        ids, counts = self._table.ids(keys[real], encode)
        return cut(ids, counts, np.searchsorted(starts, bounds))

    def decode_all(self, texts_ids: list[bytes | None]) -> Iterator[str]:
        """Bytes that are no UTF-8 become replacement characters, unknown ids nothing."""
        for ids in texts_ids:
            known = np.minimum(np.frombuffer(ids or b"", _IDS), len(self._lengths) - 1).astype(np.int64)
            yield spread(self._bytes, self._at[known], self._lengths[known]).tobytes().decode("utf-8", "replace")

    # -- joins -----------------------------------------------------------------

    def _edge(self, text: str, at: int) -> str | None:
        """How the pre-tokenizer sees position ``at``: ``split``, ``run`` or None (can't tell).

        Contractions reach two characters behind an apostrophe and are kept away from.
        """
        if at in (0, len(text)):
            return "split"
        if "'" in text[max(0, at - 3) : at + 1]:
            return None
        before, after = _char_class(text[at - 1]), _char_class(text[at])
        if before != "S" and after == "S":
            return "split"
        if "S" in (before, after):
            return None
        if before == after:
            return "run"
        # A letter after another mark may be the end of a contraction, the rest always splits.
        return None if before == "O" and after == "L" else "split"

    def join(self, left: str, left_ids: list[int], right: str, right_ids: list[int]) -> list[int]:
        """The encoding of ``left + right`` from those of its halves."""
        if not left or not right:
            return left_ids + right_ids
        size = 32
        while True:
            i, a, start = self._cut(left, left_ids, size, from_end=True)
            j, b, end = self._cut(right, right_ids, size, from_end=False)
            window = self.encode(left[a:] + right[:b])
            agree = window and (start == "split" or window[0] == left_ids[i]) and (end == "split" or window[-1] == right_ids[j - 1])
            if agree or (a == 0 and b == len(right)):
                return left_ids[:i] + window + right_ids[j:]
            size *= 2

    def _cut(self, text: str, ids: list[int], size: int, from_end: bool) -> tuple[int, int, str]:
        """The nearest usable token border at least ``size`` tokens from the join:
        tokens before it, characters before it, and the kind of edge it is."""
        n = len(ids)
        take = size
        while take < n:
            part = ids[n - take :] if from_end else ids[:take]
            raw = b"".join(self.tokens[t] for t in part)
            try:
                chars = len(raw.decode())
            except UnicodeDecodeError:  # within a character
                take += 1
                continue
            at = len(text) - chars if from_end else chars
            kind = self._edge(text, at)
            if kind:
                return (n - take if from_end else take), at, kind
            take += 1 if take < 4 * size else take // 2
        return (0, 0, "split") if from_end else (n, len(text), "split")

    def concatenate(self, leaves: list[tuple[str, list[int]]]) -> list[int]:
        """Joins neighbours pairwise until one sequence is left."""
        while len(leaves) > 1:
            pairs = [
                (a[0] + b[0], self.join(*a, *b)) for a, b in zip(leaves[::2], leaves[1::2])
            ]
            leaves = pairs + leaves[len(pairs) * 2 :]
        return leaves[0][1] if leaves else []




def _char_class(char: str) -> str:
    """L letter, N number, S white space, O other; rarely used kinds count as unknown."""
    kind = unicodedata.category(char)
    if kind[0] in "LN":
        return kind[0]
    # Python also takes four control characters for white space.
    return "S" if char.isspace() and not "\x1c" <= char <= "\x1f" else "O"


@functools.lru_cache(maxsize=4)
def load(ranks_file: str, special: tuple[tuple[str, int], ...]) -> ByteBpe:
    """One per worker and vocabulary."""
    return ByteBpe(ranks_file, dict(special))


def encode_udf(ranks_file: str, special: dict[str, int]):
    """Text to ids (binary, little-endian unsigned 32-bit); null is empty."""
    fixed = tuple(sorted(special.items()))

    @F.arrow_udf("binary")
    def encode(texts: pa.Array) -> pa.Array:
        bpe = load(ranks_file, fixed)
        return pa.array(list(bpe.encode_all(texts.to_pylist())), pa.binary())

    return encode


def decode_udf(ranks_file: str, special: dict[str, int]):
    """Ids (binary) to text; null is empty."""
    fixed = tuple(sorted(special.items()))

    @F.arrow_udf("string")
    def decode(ids: pa.Array) -> pa.Array:
        bpe = load(ranks_file, fixed)
        return pa.array(list(bpe.decode_all(ids.to_pylist())), pa.string())

    return decode


def _leaves(text: Column, leaf_chars: int) -> Column:
    starts = F.sequence(F.lit(0), (F.char_length(text) - 1).cast("int"), F.lit(leaf_chars))
    return F.transform(
        starts, lambda s: F.struct(s.alias("at"), F.substr(text, s + 1, F.lit(leaf_chars)).alias("leaf"))
    )


def encode_documents(
    docs: DataFrame,
    ranks_file: str,
    special: dict[str, int],
    id_col: str = "doc_id",
    text_col: str = "text",
    leaf_chars: int = LEAF_CHARS,
) -> DataFrame:
    """(``id_col``, ``ids``) of every row: ids as little-endian unsigned 32-bit integers.

    Strings of special tokens in a text become their ids. Null and empty texts
    have no ids. Each of several rows with one id is encoded; null ids stay.
    Equal rows with long texts are encoded once and returned as often as they
    occur. No rows give no rows.
    """
    encode = encode_udf(ranks_file, special)
    fixed = tuple(sorted(special.items()))
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    long_text = F.coalesce(F.char_length("text"), F.lit(0)) > leaf_chars
    short = rows.where(~long_text).select("id", encode("text").alias("ids"))
    leaves = (
        rows.where(long_text)
        .select("id", F.xxhash64("text").alias("h"), F.char_length("text").alias("n"),
                F.explode(_leaves(F.col("text"), leaf_chars)).alias("part"))
        .select("id", "h", "n", "part.at", "part.leaf")
        .repartition("id", "h", "at")  # the leaves of one text go to many tasks
        .withColumn("ids", encode("leaf"))
    )
    id_type = rows.schema["id"].dataType

    def join_up(leaves: pa.Table) -> pa.Table:
        bpe = load(ranks_file, fixed)
        got = leaves.to_pydict()
        by_start = {at: (leaf, np.frombuffer(ids, _IDS).tolist()) for at, leaf, ids in zip(got["at"], got["leaf"], got["ids"])}
        ids = np.array(bpe.concatenate([by_start[at] for at in sorted(by_start)]), _IDS).tobytes()
        copies = got["at"].count(0)
        return pa.table({"id": pa.array([got["id"][0]] * copies, leaves.schema.field("id").type), "ids": [ids] * copies})

    schema = f"id {id_type.simpleString()}, ids binary"
    joined = leaves.groupBy("id", "h", "n").applyInArrow(join_up, schema)
    return short.unionByName(joined).withColumnRenamed("id", id_col)
