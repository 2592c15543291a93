"""A corpus pipeline over ``documents``: five stages, each on all rows that the one before kept.

Toxic documents go, then those of low quality; lines shared by several documents
stay in one; of near-duplicate documents one stays; what is left is packed into
token windows. All stages but the last return the columns of ``documents``.

The stages cannot be told in SQL (learned scores, hashing, tokens), so there is no
``ORACLE_SQL``; tests compare them with brute-force versions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.llm import line_dedup, minhash, packing, quality, toxicity
from eventloom.llm.queries import vocabulary
from eventloom.llm.staging import prepare, stage


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity scores below 0.5; learned from the labels of its own input."""
    return toxicity.drop_toxic(docs, _labels(spark, sf_dir))


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality scores 0.5 or more; learned from the labels of its own input."""
    return quality.keep_quality(docs, _labels(spark, sf_dir))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with ``text`` and ``n_chars`` of the lines that stay."""
    # The columns travel in a struct: none can be taken for one that the operator adds.
    rows = docs.select("doc_id", "text", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    cleaned = line_dedup.drop_repeated_lines(rows)
    new = {"text": F.col("kept_text"), "n_chars": F.char_length("kept_text").cast("long")}
    return cleaned.select(*[(new[c] if c in new else F.col("doc")[c]).alias(c) for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates."""
    prepare(spark)
    return minhash.drop_near_duplicates(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece: doc_id, start, length, ids, doc_tokens, sequence_id, offset."""
    prepare(spark)
    return packing.pack_documents(docs, vocabulary("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", keep_quality),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_duplicates),
    ("packing", pack),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; the results between stages are written to the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
