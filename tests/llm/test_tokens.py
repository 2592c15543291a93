"""Encoding and packing against the tokenizers library and exact round trips."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from eventloom.llm import bpe, packing
from eventloom.llm.queries import QUERIES, SPECIAL_TOKENS, vocabulary
from tests.conftest import TESTDATA

ALPHABETS = ["abcdefgh ", "aaaa", "a1b2'sre ll", "   \n\t ab'", "éüß漢字😀 a", "$$%%''s't", "0123456789", "'re'll'd ", "ab  \n\n  c  ",
             "a\u00a0 \u2003b", "\x1c\x1d a\x85", "".join(map(chr, range(0x20, 0x250)))]
SPECIALS = ["<|endoftext|>", "<|startoftext|>", "the ", "'re", "   ", " \n", "don't"]


def random_texts(n, seed):
    rng = random.Random(seed)
    for i in range(n):
        alphabet = ALPHABETS[i % len(ALPHABETS)] if i % 2 else "".join(ALPHABETS[:9])
        yield "".join(rng.choice(SPECIALS) if rng.random() < 0.03 else rng.choice(alphabet) for _ in range(rng.choice([1, 5, 80, 500])))


@pytest.fixture(scope="module")
def byte_tokenizer():
    return Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def word_tokenizer():
    return Tokenizer.from_file(vocabulary("word_bpe_49k.json"))


@pytest.fixture(scope="module")
def byte_bpe():
    return bpe.ByteBpe(vocabulary("byte_bpe_50k.tiktoken"), SPECIAL_TOKENS)


def numbers(data):
    return np.frombuffer(data, "<u4").tolist()


def test_encoding_and_decoding_equal_the_library(byte_tokenizer, byte_bpe):
    texts = [*random_texts(1500, 1), "", None]
    encoded = list(byte_bpe.encode_all(texts))
    for text, ids, decoded in zip(texts, encoded, byte_bpe.decode_all(encoded)):
        want = byte_tokenizer.encode(text or "", add_special_tokens=False).ids
        assert numbers(ids) == want
        assert decoded == byte_tokenizer.decode(want, skip_special_tokens=False)


@pytest.mark.parametrize("leaf", [1, 7, 60])
def test_tree_concatenation_is_exact(byte_bpe, leaf):
    for text in random_texts(400, leaf):
        parts = [text[i : i + leaf] for i in range(0, len(text), leaf)]
        assert byte_bpe.concatenate([(p, byte_bpe.encode(p)) for p in parts]) == byte_bpe.encode(text)


def test_decoding_of_broken_bytes(byte_bpe, byte_tokenizer):
    ids = byte_tokenizer.encode("漢é😀", add_special_tokens=False).ids
    for at in range(len(ids)):
        part = ids[at : at + 2]
        assert next(byte_bpe.decode_all([np.array(part, "<u4").tobytes()])) == byte_tokenizer.decode(part, skip_special_tokens=False)
    assert next(byte_bpe.decode_all([np.array([60_000], "<u4").tobytes()])) == ""


def test_encode_documents_with_long_texts(spark, byte_tokenizer):
    unsplit = "abcdefgh" * 3000
    docs = [(1, "short text"), (2, None), (3, ""), (4, unsplit), (5, " ".join(random_texts(40, 9))), (5, "another of 5"),
            (6, unsplit), (6, unsplit), (None, "x " * 9000), (7, "<|endoftext|>" * 1000)]
    frame = spark.createDataFrame([(i, t, "ids", 0) for i, t in docs], "doc_id long, text string, ids string, at int")
    rows = bpe.encode_documents(frame, vocabulary("byte_bpe_50k.tiktoken"), SPECIAL_TOKENS, leaf_chars=1000).collect()
    want = [(i, byte_tokenizer.encode(t or "", add_special_tokens=False).ids) for i, t in docs]
    assert sorted(((r.doc_id, numbers(r.ids)) for r in rows), key=str) == sorted(want, key=str)
    assert bpe.encode_documents(frame.limit(0), vocabulary("byte_bpe_50k.tiktoken"), SPECIAL_TOKENS).count() == 0


def test_op9(spark, byte_tokenizer):
    sf = f"{TESTDATA}/sf0.001"
    got = {r.doc_id: r for r in QUERIES["op9_bpe"](spark, sf).collect()}
    for row in spark.read.parquet(f"{sf}/documents.parquet").collect():
        ids = byte_tokenizer.encode(row.text, add_special_tokens=False).ids
        decoded = byte_tokenizer.decode(ids, skip_special_tokens=False)
        assert got[row.doc_id].n_tokens == len(ids)
        assert got[row.doc_id].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[row.doc_id].decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_word_ids_equal_the_library(word_tokenizer):
    own = packing.WordTokenizer(vocabulary("word_bpe_49k.json"))
    texts = [*random_texts(2500, 2), "", None, "ab " * 400_000, "x" * 1_100_000 + " y"]
    for text, ids in zip(texts, own.encode_all(texts)):
        assert numbers(ids) == word_tokenizer.encode(text or "", add_special_tokens=False).ids


def test_word_ids_of_every_plain_character_beside_every_kind_of_neighbour(word_tokenizer):
    """Letter, digit, mark, apostrophe, space, accented letter and the end; both cases are among the characters."""
    own, library = packing.WordTokenizer(vocabulary("word_bpe_49k.json")), word_tokenizer
    beside = ["", "a", "7", "!", "'", " ", "É", "."]
    texts = [left + chr(c) + right for c in range(0x180) for left in beside for right in beside]
    texts += [left + a + b + right for a in "İıſŉKÅ’'" for b in "İi.,'sé" for left in beside for right in beside]
    for text, ids, wanted in zip(texts, own.encode_all(texts), library.encode_batch(texts, add_special_tokens=False)):
        assert np.frombuffer(ids, "<u4").tolist() == wanted.ids, repr(text)


def test_table_of_units_forgets(word_tokenizer):
    own = packing.WordTokenizer(vocabulary("word_bpe_49k.json"))
    own._table._most = 300
    texts = list(random_texts(300, 4))
    for text, ids in zip(texts, own.encode_all(texts)):
        assert numbers(ids) == word_tokenizer.encode(text, add_special_tokens=False).ids


def brute_place(levels, size, window):
    """The level that leaves the smallest sum of squares; the fullest of equals."""
    best = None
    for level in range(window - size + 1):
        if level and not levels.get(level):
            continue
        after = dict(levels)
        if level:
            after[level] -= 1
        if level + size < window:
            after[level + size] = after.get(level + size, 0) + 1
        cost = sum(n * n for n in after.values())
        if best is None or cost <= best[0]:
            best = cost, level, after
    return best[1], best[2]


def test_placing_minimises_the_sum_of_squares():
    rng, window = random.Random(8), 24
    packer, levels = packing.SumOfSquaresPacker(window), {}
    for _ in range(500):
        size = rng.randint(1, window - 1)
        level, levels = brute_place(levels, size, window)
        assert packer.place(size)[1] == level
        assert {h: int(n) for h, n in enumerate(packer.counts) if n} == {h: n for h, n in levels.items() if n}


def check_pieces(pieces, ids_of, window):
    """Every id once, sequences without gaps, next to no padding."""
    sequences, parts = defaultdict(list), defaultdict(list)
    for key, start, ids, total, number, offset in pieces:
        assert ids
        sequences[number].append((offset, len(ids) // 4))
        parts[key].append((start, ids, total))
    padding = 0
    for placed in sequences.values():
        at = 0
        for offset, size in sorted(placed):
            assert offset == at
            at += size
        assert at <= window
        padding += 0 if at & (at - 1) == 0 else window - at
    assert {k: b"".join(ids for _, ids, _ in sorted(p)) for k, p in parts.items()} == ids_of
    assert all(total == len(ids_of[k]) // 4 for k, p in parts.items() for _, _, total in p)
    return padding


@pytest.mark.parametrize("sizes", [[], [1], [2048], [2047, 1], [5000], [1] * 3000, [100, 1948] * 20, list(range(1, 3000, 7))])
def test_pack(sizes):
    ids_of = {i: np.arange(n, dtype="<u4").tobytes() for i, n in enumerate(sizes)}
    assert check_pieces(packing.pack(ids_of.items()), ids_of, 2048) == 0


def test_pack_documents(spark, word_tokenizer):
    docs = {1: "One text", 2: None, 3: "", 4: "word " * 5000, 5: "É 漢 <|endoftext|>", 6: "x"}
    frame = spark.createDataFrame([(i, t, 1, b"") for i, t in docs.items()], "doc_id long, text string, start int, ids binary")
    rows = packing.pack_documents(frame, vocabulary("word_bpe_49k.json")).collect()
    want = {i: np.array([*word_tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4").tobytes() for i, t in docs.items()}
    assert all(r.length == len(r.ids) // 4 for r in rows)
    pieces = [(r.doc_id, r.start, bytes(r.ids), r.doc_tokens, r.sequence_id, r.offset) for r in rows]
    assert check_pieces(pieces, want, 2048) == 0
    assert packing.pack_documents(frame.limit(0), vocabulary("word_bpe_49k.json")).count() == 0
    twice = packing.pack_documents(frame.union(frame), vocabulary("word_bpe_49k.json")).collect()
    assert sum(r.length for r in twice) == 2 * sum(r.length for r in rows)


def test_op5(spark, word_tokenizer):
    sf = f"{TESTDATA}/sf0.001"
    got = defaultdict(list)
    for r in QUERIES["op5_packing"](spark, sf).collect():
        got[r.doc_id].append(r)
    for row in spark.read.parquet(f"{sf}/documents.parquet").collect():
        ids = np.array([*word_tokenizer.encode(row.text, add_special_tokens=False).ids, 1], "<u4")
        pieces = sorted(got[row.doc_id], key=lambda r: r.start)
        assert sum(r.length for r in pieces) == len(ids) == pieces[0].doc_tokens
        for r in pieces:
            assert r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())
