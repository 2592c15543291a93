"""Sum-of-squares packing of documents into fixed token windows.

Each task tokenizes and packs the documents it reads, in their order: no shuffle,
and a task that runs again gives the same sequences. A document's full windows are
cut off it first; what is left goes, online, to the fill level that keeps the sum
of the squared numbers of partly filled windows smallest, as held in a level array.
Windows still open when a task ends are cut anew into full ones, and their last
rest into powers of two, so nothing is padded.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.staging import keep
from eventloom.llm.words import SPACE, IdTable, WordHasher, chunks, cut, mix

WINDOW = 2048
END_ID = 1
_IDS = np.dtype("<u4")
#: Characters below this are put into words here; texts with others go to the tokenizer.
_PLAIN_END = 0x180
_LONG = 1 << 19
_BATCH_IDS = 4_000_000
_TASK_BITS = 33


def _plain(kind: str) -> str:
    """A character class of the plain code points of a general category."""
    points = [c for c in range(_PLAIN_END) if unicodedata.category(chr(c)).startswith(kind)]
    return "".join(f"\\u{c:04x}" for c in points)


def _two_byte_letters() -> str:
    """A character class of the plain letters beyond ASCII whose lower case is one such letter again."""
    letters = {chr(c) for c in range(0xC0, _PLAIN_END) if unicodedata.category(chr(c)).startswith("L")}
    return "".join(f"\\u{ord(c):04x}" for c in sorted(letters) if c.lower() in letters)


def _byte_of_symbol() -> dict[str, int]:
    """Byte-level vocabularies write a byte as itself if it is printable, else as one of the next free code points."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(hidden)}


class WordTokenizer:
    """Ids by a BPE vocabulary with word ends that lower-cases and drops white space.

    Texts are cut into units (runs of letters, or of what is neither letter nor
    white space, never beside an apostrophe) over their bytes; a unit's ids are
    found once and kept under its hash and length. Texts with special tokens or
    other than plain characters go to the tokenizer as they are.
    """

    def __init__(self, file: str) -> None:
        import tiktoken

        self._file, self._tokenizer = file, None
        letters, numbers = _plain("L"), _plain("N")
        self._words = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{numbers}]|[^ {letters}{numbers}]+")
        # Unit borders go by bytes: ASCII letters, and two bytes from U+00C0 on but two signs and
        # what becomes more than a letter in lower case.
        self._odd = re.compile(f"[^\\t-\\r -~{_two_byte_letters()}]|<\\|")
        # The same vocabulary by bytes, a null byte for the end of a word: ids are in merge order.
        with open(file, encoding="utf-8") as source:
            model = json.load(source)
        end, byte = model["model"]["end_of_word_suffix"], _byte_of_symbol()
        special = {t["content"] for t in model["added_tokens"]}
        ranks = {}
        for token, rank in model["model"]["vocab"].items():
            if token not in special:
                core = token.removesuffix(end)
                ranks[bytes(byte[c] for c in core) + b"\0" * (core != token)] = rank
        self._bpe = tiktoken.Encoding("words", pat_str=r"[^\x00]+\x00", mergeable_ranks=ranks, special_tokens={})
        self._hash = WordHasher()
        self._letter = np.zeros(256, bool)
        self._letter[[*range(97, 123), *range(128, 256)]] = True
        self._table = IdTable()

    def encode_all(self, texts: list[str | None]) -> Iterator[bytes]:
        """The ids of each text, in order, as little-endian unsigned 32-bit integers."""
        apart = [bool(t and (len(t) > _LONG or self._odd.search(t))) for t in texts]
        plain = ("" if a or not t else t.lower() for t, a in zip(texts, apart))
        for first, buffer, bounds in chunks(plain):
            for number, ids in enumerate(self._encode_chunk(buffer, bounds), first):
                yield self._apart(texts[number]) if apart[number] else ids

    def _apart(self, text: str) -> bytes:
        """A text that is odd, or longer than the table of units can be sure to take."""
        if self._odd.search(text):
            return self._whole(text)
        parts, at = [], 0
        while at < len(text):
            cut = text.find(" ", at + _LONG // 2)
            parts.append(text[at : cut if cut >= 0 else len(text)].lower())
            at += len(parts[-1])
        return b"".join(self._encode_chunk(buffer, bounds)[0] for part in parts for _, buffer, bounds in chunks([part]))

    def _whole(self, text: str) -> bytes:
        if self._tokenizer is None:  # large, and most texts do without it
            from tokenizers import Tokenizer

            self._tokenizer = Tokenizer.from_file(self._file)
        return np.array(self._tokenizer.encode(text, add_special_tokens=False).ids, _IDS).tobytes()

    def _encode_chunk(self, buffer: np.ndarray, bounds: np.ndarray) -> list[bytes]:
        starts, lengths = self._unit_spans(buffer)
        if not len(starts):
            return [b""] * (len(bounds) - 1)
        # The length, too, tells units apart.
        keys = mix(self._hash(buffer, starts) + lengths.astype(np.uint64))
        data = buffer.tobytes()

        def encode(at: list[int]) -> Iterator[list[int]]:
            for start, size in zip(starts[at].tolist(), lengths[at].tolist()):
                words = self._words.findall(data[start : start + size].decode())
                yield self._bpe.encode_ordinary("\0".join(words) + "\0")

        ids, counts = self._table.ids(keys, encode)
        return cut(ids, counts, np.searchsorted(starts, bounds))

    def _unit_spans(self, buffer: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        space, letter, mark = SPACE[buffer], self._letter[buffer], buffer == 0x27
        begins = ~space
        begins[1:] &= space[:-1] | ((letter[1:] != letter[:-1]) & ~mark[1:] & ~mark[:-1])
        starts = np.flatnonzero(begins)
        ends_here = ~space[:-1] & (space[1:] | begins[1:])  # the last byte is a space
        return starts, np.flatnonzero(ends_here) + 1 - starts


class SumOfSquaresPacker:
    """Places lengths below ``window`` into open windows.

    ``counts[h]`` is the number of windows filled up to ``h``; ``open[h]`` holds
    the numbers of those windows. Ties go to the fullest level.
    """

    def __init__(self, window: int) -> None:
        self.window = window
        self.counts = np.zeros(window + 1, np.int64)
        self.open: list[list[int]] = [[] for _ in range(window)]
        self.made = 0

    def new_window(self) -> int:
        self.made += 1
        return self.made - 1

    def place(self, size: int) -> tuple[int, int]:
        """(window, offset) for an item of 0 < ``size`` < window."""
        counts, full = self.counts, self.window
        # Change of the sum of squares if level h loses a window and h + size gains one.
        gain = 2 * counts[size:full] + 1
        change = np.empty(full - size + 1, np.int64)
        change[:-1] = gain
        change[-1] = 0  # a full window is no longer counted
        change[1:] -= 2 * counts[1 : full - size + 1] - 1
        change[1:][counts[1 : full - size + 1] == 0] = np.iinfo(np.int64).max
        level = full - size - int(np.argmin(change[::-1]))
        if level:
            window = self.open[level].pop()
            counts[level] -= 1
        else:
            window = self.new_window()
        after = level + size
        if after < full:
            self.open[after].append(window)
            counts[after] += 1
        return window, level


def pack(items: Iterable[tuple[object, bytes]], window: int = WINDOW) -> Iterator[tuple]:
    """(id, start, ids, doc_tokens, sequence, offset) of every piece of ``items`` (id, ids)."""
    packer = SumOfSquaresPacker(window)
    held: dict[int, list[tuple]] = {}  # pieces of open windows
    for key, ids in items:
        total = len(ids) // 4
        whole = total - total % window
        for start in range(0, whole, window):
            yield key, start, ids[4 * start : 4 * (start + window)], total, packer.new_window(), 0
        if whole < total:
            rest = ids[4 * whole :]
            number, offset = packer.place(total - whole)
            pieces = held.setdefault(number, [])
            pieces.append((key, whole, rest, total, number, offset))
            if offset + total - whole == window:
                yield from held.pop(number)
    yield from _cut_anew((piece[:4] for number in sorted(held) for piece in held[number]), packer, window)


def _cut_anew(pieces: Iterable[tuple], packer: SumOfSquaresPacker, window: int) -> Iterator[tuple]:
    """Fills full windows with ``pieces``, then windows of falling powers of two."""
    pieces = list(pieces)
    left = sum(len(p[2]) // 4 for p in pieces)
    room = offset = number = 0
    for key, start, ids, total in pieces:
        at, n = 0, len(ids) // 4
        while at < n:
            if offset == room:
                room = window if left >= window else 1 << (left.bit_length() - 1)
                left -= room
                number, offset = packer.new_window(), 0
            take = min(n - at, room - offset)
            yield key, start + at, ids[4 * at : 4 * (at + take)], total, number, offset
            at, offset = at + take, offset + take


def pack_documents(
    docs: DataFrame,
    tokenizer_file: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    end_id: int = END_ID,
) -> DataFrame:
    """One row per piece: (``id_col``, start, length, ids, doc_tokens, sequence_id, offset).

    ``ids`` are little-endian unsigned 32-bit integers. A document is the ids of
    its text and ``end_id``; a null or empty text is ``end_id`` alone. Each id
    lies in exactly one piece, pieces fill a sequence from 0 without gaps, and
    no sequence is longer than ``window``. Each of several rows with one id is
    packed; null ids stay. No rows give no rows. Other columns are not kept.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    columns = ["start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    schema = f"`{id_col}` {id_type}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    end = np.array([end_id], _IDS).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = keep("words", tokenizer_file, lambda: WordTokenizer(tokenizer_file))
        first = TaskContext.get().partitionId() << _TASK_BITS
        id_types = []

        def documents():
            for batch in batches:
                id_types[:] = [batch.schema.field(0).type]
                texts = batch.column(1).to_pylist()
                for key, ids in zip(batch.column(0).to_pylist(), tokenizer.encode_all(texts)):
                    yield key, ids + end

        rows, size = [], 0
        for key, start, ids, total, number, offset in pack(documents(), window):
            rows.append((key, start, len(ids) // 4, ids, total, first + number, offset))
            size += len(ids) // 4 + 64
            if size >= _BATCH_IDS:
                yield _batch(rows, id_types[0])
                rows, size = [], 0
        if rows:
            yield _batch(rows, id_types[0])

    def _batch(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
        types = [kind, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
        arrays = [pa.array([r[i] for r in rows], t) for i, t in enumerate(types)]
        return pa.RecordBatch.from_arrays(arrays, [id_col, *columns])

    picked = docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`"))
    return picked.mapInArrow(run, schema)
