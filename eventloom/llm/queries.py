"""The registered queries of this subpackage: each applies one operator to its whole table.

They only derive digests and fixed column names; the operators return texts, ids
and pieces.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.llm import (
    bpe,
    embed_dedup,
    filter_audit,
    fingerprint,
    html_extract,
    license_scan,
    line_dedup,
    minhash,
    oracle,
    packing,
    quality,
    toxicity,
    url_filter,
    vector_codes,
)
from eventloom.llm.staging import prepare

SPECIAL_TOKENS = {bpe.SPECIAL: 50256}

#: (verdict, host, path)
URL_RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]


def vocabulary(name: str) -> str:
    """Where a public tokenizer file lies; it is read on the executors."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op3_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.compare_with_next(_table(spark, sf_dir, "documents"))


def op4_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = html_extract.extract_main_text(_table(spark, sf_dir, "pages"))
    return texts.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack_documents(_table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter.filter_urls(_table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op8_embed_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.near_duplicate_vectors(_table(spark, sf_dir, "embeddings"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = vocabulary("byte_bpe_50k.tiktoken")
    encoded = bpe.encode_documents(_table(spark, sf_dir, "documents"), ranks, SPECIAL_TOKENS)
    decoded = bpe.decode_udf(ranks, SPECIAL_TOKENS)("ids")
    return encoded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(decoded, 256).alias("decoded_sha256"),
    )


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.drop_repeated_lines(docs).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256")
    )


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit_filters(spark, f"{sf_dir}/documents.parquet", _table(spark, sf_dir, "labels"))


def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")  # Spark expressions only: nothing to prepare
    return license_scan.scan_licenses(docs).drop("spans")


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress_vectors(_table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_minhash": op1_minhash,
    "op2_toxicity": op2_toxicity,
    "op3_fingerprint": op3_fingerprint,
    "op4_html_extract": op4_html_extract,
    "op5_packing": op5_packing,
    "op6_quality": op6_quality,
    "op7_url_filter": op7_url_filter,
    "op8_embed_dedup": op8_embed_dedup,
    "op9_bpe": op9_bpe,
    "op10_line_dedup": op10_line_dedup,
    "op11_filter_audit": op11_filter_audit,
    "op12_license_scan": op12_license_scan,
    "op13_vector_codes": op13_vector_codes,
}

_LINES = r"""
lines AS (
  SELECT doc_id, generate_subscripts(parts, 1) AS pos, unnest(parts) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)
),
keyed AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
),
shared AS (
  SELECT key, min(doc_id) AS first FROM keyed WHERE length(key) >= 10
  GROUP BY key HAVING count(DISTINCT doc_id) >= 2
),
marked AS (
  SELECT k.*, coalesce(s.first <> k.doc_id, false) AS dropped FROM keyed k LEFT JOIN shared s USING (key)
)
"""

ORACLE: dict[str, str] = {
    "op7_url_filter": r"""
WITH rules(verdict, host, path) AS (VALUES
  ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
  ('allow', 'com', '/fr/'), ('block', 'com', '/de/')
),
rest AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages
),
parts AS (
  SELECT page_id,
         translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM rest
),
best AS (
  SELECT page_id, arg_max({'rule': r.host || r.path, 'verdict': r.verdict}, length(r.host) * 10000 + length(r.path)) AS b
  FROM parts p JOIN rules r
    ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
  GROUP BY page_id
)
SELECT p.page_id, host, path, b.rule AS rule, coalesce(b.verdict, 'allow') AS verdict
FROM parts p LEFT JOIN best USING (page_id)
""",
    "op10_line_dedup": f"""
WITH {_LINES}
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (WHERE dropped)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
""",
    "op11_filter_audit": oracle.FILTER_AUDIT,
    "op12_license_scan": oracle.LICENSE_SCAN,
    "op13_vector_codes": oracle.VECTOR_CODES,
}
