"""Licence phrases and notices found by diagonal voting; Spark expressions only.

Every run of k words of every text, hashed, is joined to the places it has in the
templates. A hit lies on the diagonal (place in the text less place in the template);
hits of a diagonal are its votes. Neighbouring diagonals of a notice are merged, as
words put in or left out shift what follows; the span so found is verified by the
share of the template's words that it holds. Words, not only hashes, are compared.

Texts are read once. Only hits, and one row per document, are shuffled.
"""

from __future__ import annotations

import re
import string

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: What stands between words.
_BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: (phrase, label): found where its words stand consecutively.
PHRASES = [
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
]

#: (notice, label): found where enough of its words stand near one another. Public licence notices.
NOTICES = [
    ("licensed under the apache license version 2.0", "apache-2.0"),
    ("licensed under the gnu general public license version 3", "gpl-3.0"),
    ("released under the mit license", "mit"),
    ("licensed under cc by-nc 4.0", "cc-by-nc"),
    ("this work is licensed under a creative commons attribution 4.0 international license", "cc-by"),
    ("this work is licensed under a creative commons attribution-noncommercial 4.0 international license", "cc-by-nc"),
    ("this work is licensed under a creative commons attribution-sharealike 4.0 international license", "cc-by-sa"),
    (
        "licensed under the apache license, version 2.0 (the license); you may not use this file except in "
        "compliance with the license. you may obtain a copy of the license at",
        "apache-2.0",
    ),
    (
        "this program is free software: you can redistribute it and/or modify it under the terms of the gnu general "
        "public license as published by the free software foundation, either version 3 of the license, or (at your "
        "option) any later version",
        "gpl-3.0",
    ),
    (
        "permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the software), to deal in the software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the software, "
        "and to permit persons to whom the software is furnished to do so, subject to the following conditions",
        "mit",
    ),
    (
        "permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
        "isc",
    ),
    (
        "redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met",
        "bsd",
    ),
    ("this source code form is subject to the terms of the mozilla public license, v. 2.0", "mpl-2.0"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
]

#: Words in a run, where a template is long enough.
RUN = 3
#: Share of a notice's words that a span has to hold.
SHARE = 0.75
#: Words that all templates together may have: they are broadcast.
MAX_TEMPLATE_WORDS = 100_000


def template_words(text: str) -> list[str]:
    """The words of a template, cut as those of a text are."""
    lowered = text.translate(str.maketrans(string.ascii_uppercase, string.ascii_lowercase))
    return [word for word in re.split(_BREAK, lowered) if word]


def templates(phrases=tuple(PHRASES), notices=tuple(NOTICES)) -> list[tuple[int, str, bool, list[str]]]:
    """(number, label, whether it is a phrase, words) of all templates; each needs two words at least."""
    found = [(label, base, template_words(text)) for base, group in ((True, phrases), (False, notices)) for text, label in group]
    if short := [words for _, _, words in found if len(words) < 2]:
        raise ValueError(f"templates need two words at least: {short}")
    if (size := sum(len(words) for _, _, words in found)) > MAX_TEMPLATE_WORDS:
        raise ValueError(f"templates have {size} words, at most {MAX_TEMPLATE_WORDS} can be broadcast")
    return [(i, *row) for i, row in enumerate(found)]


def _runs(words: DataFrame, place: str) -> DataFrame:
    """A row per word of ``words``, at ``place``: ``w0`` and the words behind it, null beyond the end.

    A row without words stays, with a null place. Neighbours are taken from the
    array by number, which stays within generated code.
    """
    placed = words.select("*", F.posexplode_outer("words").alias(place, "w0"))
    behind = {f"w{i}": F.get("words", F.col(place) + i) for i in range(1, RUN)}
    return placed.withColumns(behind).drop("words")


def _hashes() -> Column:
    """The hashes of the runs of two and of three words that begin at a word."""
    run = [F.col(f"w{i}") for i in range(RUN)]
    return F.array(*[F.struct(F.lit(k).alias("k"), F.xxhash64(*run[:k]).alias("h")) for k in range(2, RUN + 1)])


def _template_runs(spark: SparkSession, rows: list[tuple[int, str, bool, list[str]]]) -> DataFrame:
    """The place of every run of every template, with its words and hash."""
    fixed = F.array(*[
        F.struct(
            F.lit(i).alias("template"), F.lit(label).alias("label"), F.lit(base).alias("base"),
            F.split(F.lit(" ".join(words)), " ").alias("words"),
        )
        for i, label, base, words in rows
    ])
    whole = spark.range(1).select(F.inline(fixed)).withColumn("size", F.size("words"))
    runs = _runs(whole, "place").select("*", F.inline(_hashes()))
    runs = runs.where((F.col("k") == F.least(F.lit(RUN), "size")) & (F.col("place") + F.col("k") <= F.col("size")))
    return runs.select(
        "template", "label", "base", "size", "place", F.col("k").alias("t_k"), F.col("h").alias("t_h"),
        *[F.col(f"w{i}").alias(f"t{i}") for i in range(RUN)],
    )


def _hits(docs: DataFrame, runs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Each place of a text where a run of a template stands, and one row without a template per document.

    Rows of one document share ``row``, which tells repeated rows apart.
    """
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    lowered = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    # Not regexp_extract_all: it copies the text for each word.
    words = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(f"`{id_col}`").alias("id"),
        F.array_remove(F.split(lowered, _BREAK), "").alias("words"),
    ).withColumn("n_words", F.size("words").cast("long"))
    hashed = _runs(words, "pos").select("*", F.inline(_hashes()))
    # The hash alone is the key, one long; words and their number are compared behind the join.
    joined = hashed.join(F.broadcast(runs), F.col("h") == F.col("t_h"), "left")
    same = (F.col("k") == F.col("t_k")) & (F.col("w0") == F.col("t0")) & (F.col("w1") == F.col("t1"))
    same = F.coalesce(same & ((F.col("k") == 2) | (F.col("w2") == F.col("t2"))), F.lit(False))
    first = F.col("pos").isNull() | ((F.col("pos") == 0) & (F.col("k") == 2))
    found = [F.when(same, F.col(name)).alias(name) for name in ("template", "label", "base", "size", "k", "place")]
    return joined.where(same | first).select("row", "id", "n_words", "pos", *found)


def scan_licenses(
    docs: DataFrame,
    phrases=tuple(PHRASES),
    notices=tuple(NOTICES),
    share: float = SHARE,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(``id_col``, n_words, n_base, first_word, last_word, base_labels, labels, score, spans) of every row.

    A phrase is found where all its words stand consecutively; ``n_base`` counts
    these places, ``first_word`` and ``last_word`` are the smallest and largest
    word they begin at, from 0, null without any. A notice is found in a span
    (merged diagonals that differ by at most a quarter of its words from one to
    the next) that holds at least ``share`` of its words and is at most half
    as long again. ``base_labels`` are those of phrases, ``labels`` those of
    notices too: distinct, sorted, joined by commas, empty without any. ``spans``
    has (label, start, end, share) of each, in order, ends excluded. ``score`` is the
    greatest share of a template found in a span, or of the span where that is
    longer, verified or not; 0 without a hit.

    A null text counts as empty: no words. Repeated rows and null ids have a
    result each. Other columns are not read. No rows give no rows.
    """
    runs = _template_runs(docs.sparkSession, templates(phrases, notices))
    # One exchange: all that follows is told apart by ``row`` first. A template's
    # attributes come with each hit, so there is no second join.
    hits = _hits(docs, runs, id_col, text_col).repartition("row")
    doc, template = ["row", "id", "n_words"], ["template", "label", "base", "size", "k"]
    votes = hits.groupBy(*doc, *template, (F.col("pos") - F.col("place")).alias("diagonal")).agg(
        F.min("pos").alias("start"),
        (F.max("pos") + F.max("k")).alias("end"),
        F.collect_list("place").alias("places"),  # at most the template's words
    )
    along = Window.partitionBy("row", "template").orderBy("diagonal")
    apart = F.col("diagonal") - F.lag("diagonal").over(along)
    begins = F.col("base") | apart.isNull() | (apart > F.floor(F.col("size") / 4))
    merged = votes.withColumn("begins", F.when(begins, 1).otherwise(0)).withColumn(
        "cluster", F.when(F.col("template").isNotNull(), F.sum("begins").over(along))
    )
    spans = merged.groupBy(*doc, *template, "cluster").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.flatten(F.collect_list("places")).alias("places")
    )
    held = F.size(F.array_distinct(F.flatten(F.transform("places", lambda p: F.sequence(p, p + F.col("k") - 1)))))
    spans = spans.withColumn("held", F.when(F.col("template").isNotNull(), held))
    spans = spans.withColumn("share", F.col("held") / F.col("size"))
    length = F.col("end") - F.col("start")
    whole = F.col("held") == F.col("size")
    near = (F.col("share") >= share) & (length <= F.col("size") + F.floor(F.col("size") / 2))
    found = F.when(F.col("base"), whole).otherwise(near)
    place = F.when(F.col("base") & found, F.col("start"))
    span = F.struct("start", "end", "label", "share")
    result = spans.groupBy(*doc).agg(
        F.count(place).alias("n_base"),
        F.min(place).cast("long").alias("first_word"),
        F.max(place).cast("long").alias("last_word"),
        F.collect_set(F.when(F.col("base") & found, F.col("label"))).alias("base_labels"),
        F.collect_set(F.when(found, F.col("label"))).alias("labels"),
        F.coalesce(F.max(F.col("held") / F.greatest("size", length)), F.lit(0.0)).alias("score"),
        F.array_sort(F.collect_list(F.when(found, span))).alias("spans"),
    )
    return result.select(
        F.col("id").alias(id_col), "n_words", "n_base", "first_word", "last_word",
        F.array_join(F.array_sort("base_labels"), ",").alias("base_labels"),
        F.array_join(F.array_sort("labels"), ",").alias("labels"),
        "score",
        F.transform("spans", lambda s: F.struct(s["label"].alias("label"), s["start"].alias("start"), s["end"].alias("end"), s["share"].alias("share"))).alias("spans"),
    )
