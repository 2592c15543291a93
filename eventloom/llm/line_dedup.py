"""Lines that several documents share are kept in one of them only.

Lines are exploded with their position, normalised and hashed; documents are counted
per hash; what a document loses comes back as positions, and its text is put together
from the others in their order. Hashes are staged and shuffled for the count; texts are
shuffled once, by document, to meet the positions. All of it is linear in a text.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.llm.staging import stage

#: White space stripped at both ends of a line.
SPACES = " \t\n\x0b\x0c\r"


def line_key(line: Column) -> Column:
    """The line with outer white space stripped and A-Z lower-cased."""
    bare = F.btrim(line, F.lit(SPACES))
    return F.translate(bare, string.ascii_uppercase, string.ascii_lowercase)


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _hashes(text: Column) -> list[Column]:
    """128 bits: one hash would give false matches among 10^12 lines."""
    return [F.xxhash64(text), F.xxhash64(F.lit(1), text)]


def drop_repeated_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_docs: int = 2,
    min_chars: int = 10,
) -> DataFrame:
    """``docs`` with ``n_lines``, ``n_dropped`` and ``kept_text`` in place of the text column.

    Keys (``line_key``) of at least ``min_chars`` code points that at least
    ``min_docs`` documents hold lose all their lines, except in the document
    with the smallest id. Other lines stay as they are, joined by a line feed.

    A null or empty text is one empty line. Rows with the same id are one
    document when documents are counted, and each is cleaned. A row whose id is
    null counts for nothing and keeps its lines. Columns of ``docs`` with the
    names of the three new ones are replaced. An empty table gives no rows.
    """
    # Rows of one id and text lose the same positions: they are known by both, as hashes.
    # Columns of ``docs`` stay in a struct, where no name can clash.
    text = F.col(f"`{text_col}`").cast("string")
    t1, t2 = _hashes(F.coalesce(text, F.lit("")))
    # The text is hashed below the lines, not anew for each of them.
    known = docs.where(F.col(f"`{id_col}`").isNotNull()).select(
        F.col(f"`{id_col}`").alias("id"), t1.alias("t1"), t2.alias("t2"), text.alias("text")
    ).select("id", "t1", "t2", F.posexplode(_lines(F.col("text"))).alias("pos", "line"))
    keyed = known.withColumn("key", line_key(F.col("line"))).where(F.char_length("key") >= min_chars)
    h1, h2 = _hashes(F.col("key"))
    held = stage(keyed.select("id", "t1", "t2", "pos", h1.alias("h1"), h2.alias("h2")), "held")
    many = F.min("id") != F.max("id") if min_docs == 2 else F.count_distinct("id") >= min_docs
    shared = held.groupBy("h1", "h2").agg(F.min("id").alias("first"), many.alias("many"))
    # Staged, so that the join below has an exchange on either side and a hash
    # that a third of all documents hold can be split.
    shared = stage(shared.where("many").select("h1", "h2", "first"), "lines")
    lost = (
        held.join(shared, ["h1", "h2"])
        .where("id <> first")
        .groupBy("id", "t1", "t2")
        .agg(F.collect_set("pos").alias("lost"))  # at most the lines of one document
    )
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.col(f"`{id_col}`").alias("id"), t1.alias("t1"), t2.alias("t2"))
    # Out of a generator of one row, the lines are split once and not anew for each position.
    met = whole.join(lost, ["id", "t1", "t2"], "left")
    met = met.select("doc", "lost", F.explode(F.array(_lines(F.col("doc")[text_col].cast("string")))).alias("lines"))
    # array_except goes by a hash set and keeps the order.
    kept = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.coalesce("lost", F.array().cast("array<int>")))
    done = met.select(
        "doc",
        F.size("lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("lost"), F.lit(0)).cast("long").alias("n_dropped"),
        F.array_join(F.when(F.col("lost").isNull(), F.col("lines")).otherwise(F.transform(kept, lambda p: F.get("lines", p))), "\n").alias("kept_text"),
    )
    new = [c for c in done.columns if c != "doc"]
    return done.select(
        *[(F.col(c) if c in new else F.col("doc")[c]).alias(c) for c in docs.columns], *[c for c in new if c not in docs.columns]
    )
