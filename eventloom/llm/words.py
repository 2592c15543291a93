"""Words of many texts at once, as numpy arrays over their UTF-8 bytes."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np

#: Bytes looked at together: the arrays stay in a processor's cache.
CHUNK_BYTES = 1 << 18

_SEED = 0x5EED
_U64 = np.uint64
_R = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64
_R_INVERSE = pow(_R, -1, 1 << 64)

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads each 64-bit word over all its bits; one to one."""
    x = x ^ (x >> _U64(33))
    x = x * _U64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> _U64(33))
    x = x * _U64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U64(33))


def _powers(factor: int, size: int) -> np.ndarray:
    factors = np.full(size, factor, np.uint64)
    factors[0] = 1
    return np.cumprod(factors)


class WordHasher:
    """64-bit hashes of the words of a buffer: sums of byte values times powers of one odd factor."""

    def __init__(self, spaces: bool = False) -> None:
        """``spaces``: whether white space counts."""
        values = np.random.Generator(np.random.PCG64(_SEED)).integers(1, 1 << 63, 256, dtype=np.uint64)
        self._values = values * _U64(2) + _U64(1)
        if not spaces:
            self._values[SPACE] = 0
        self._powers = self._inverse = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self._powers) < n:
            size = max(n, 2 * CHUNK_BYTES)
            self._powers, self._inverse = (_powers(factor, size) for factor in (_R, _R_INVERSE))

    def __call__(self, buffer: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """A hash per start, of the bytes up to the next start."""
        if not len(starts):
            return np.zeros(0, np.uint64)
        self._grow(len(buffer))
        terms = self._values[buffer] * self._powers[: len(buffer)]
        return mix(np.add.reduceat(terms, starts) * self._inverse[starts])


def starts_of_words(buffer: np.ndarray) -> np.ndarray:
    """Where a byte that is no white space follows one that is, or the begin."""
    inside = ~SPACE[buffer]
    inside[1:] &= SPACE[buffer[:-1]]
    return np.flatnonzero(inside)


def chunks(texts: Iterable[str | None]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(number of the first text, bytes, starts of the texts and the end) for runs of texts.

    A space follows each text, so no word reaches into the next. A text longer
    than ``CHUNK_BYTES`` has a run of its own; null counts as empty.
    """
    first, held, size, number = 0, [], 0, 0
    for number, text in enumerate(texts):
        data = (text or "").encode("utf-8", "surrogatepass")
        if held and size + len(data) > CHUNK_BYTES:
            yield first, *_joined(held)
            first, held, size = number, [], 0
        held.append(data)
        size += len(data) + 1
    if held:
        yield first, *_joined(held)


def _joined(held: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    bounds = np.zeros(len(held) + 1, np.int64)
    np.cumsum([len(d) + 1 for d in held], out=bounds[1:])
    return np.frombuffer(b" ".join(held) + b" ", np.uint8), bounds


class IdTable:
    """Token ids of units of text by the units' keys; forgets all when it is full.

    An open-addressing hash table in arrays, so a lookup of many keys is a few
    array operations. Key 0 marks a free slot.
    """

    def __init__(self, units: int = 1 << 19) -> None:
        self._most = units
        self._forget()

    def _forget(self) -> None:
        slots = 1 << (2 * self._most - 1).bit_length()
        self._keys = np.zeros(slots, np.uint64)
        self._at, self._n = np.zeros(slots, np.int32), np.zeros(slots, np.int32)
        self._ids = np.zeros(1 << 16, np.dtype("<u4"))
        self._used = self._units = 0

    def _find(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key, or -1."""
        mask = len(self._keys) - 1
        slot = (keys & _U64(mask)).astype(np.int64)
        found = self._keys[slot]
        open_ = np.flatnonzero(found != keys)
        while len(open_):
            free = found[open_] == 0
            slot[open_[free]] = -1
            open_ = open_[~free]
            slot[open_] = (slot[open_] + 1) & mask
            found[open_] = self._keys[slot[open_]]
            open_ = open_[found[open_] != keys[open_]]
        return slot

    def _learn(self, keys: list[int], ids_of: Iterable[list[int]]) -> None:
        mask = len(self._keys) - 1
        for key, ids in zip(keys, ids_of):
            if self._used + len(ids) > len(self._ids):
                self._ids = np.concatenate([self._ids, np.zeros(max(len(ids), len(self._ids)), self._ids.dtype)])
            slot = key & mask
            while self._keys[slot]:
                slot = (slot + 1) & mask
            self._keys[slot], self._at[slot], self._n[slot] = key, self._used, len(ids)
            self._ids[self._used : self._used + len(ids)] = ids
            self._used += len(ids)
        self._units += len(keys)

    def ids(self, keys: np.ndarray, encode: Callable[[list[int]], Iterable[list[int]]]) -> tuple[np.ndarray, np.ndarray]:
        """(all ids in order, number of ids of each key); ``encode`` gives the ids of the keys at some positions.

        At most as many different keys as the table has room for.
        """
        keys = keys | _U64(1)
        slots = self._find(keys)
        if (slots < 0).any():
            absent = np.flatnonzero(slots < 0)
            new, first = np.unique(keys[absent], return_index=True)
            first = absent[first]
            if self._units + len(new) > self._most:
                self._forget()
                new, first = np.unique(keys, return_index=True)
            self._learn(new.tolist(), encode(first.tolist()))
            slots = self._find(keys)
        counts = self._n[slots].astype(np.int64)
        return spread(self._ids, self._at[slots], counts), counts


def spread(values: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The stretches of ``values`` from ``starts`` of length ``counts``, one after another."""
    ends = np.cumsum(counts)
    return values[np.repeat(starts - (ends - counts), counts) + np.arange(ends[-1] if len(ends) else 0)]


def cut(ids: np.ndarray, counts: np.ndarray, borders: np.ndarray) -> list[bytes]:
    """The bytes of ``ids`` between borders, which are numbers of units with ``counts`` ids each."""
    at = np.concatenate([[0], np.cumsum(counts)])[borders] * ids.itemsize
    data = ids.tobytes()
    return [data[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
