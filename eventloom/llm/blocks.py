"""Groups of any size compared in blocks, without listing their pairs."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK = 1024


def in_blocks(rows: DataFrame, groups: DataFrame, keys: list[str], spread: str, block: int = BLOCK) -> DataFrame:
    """``rows`` of the groups in ``groups`` (keys, n), dealt out for block against block.

    Adds ``left`` and ``right``, the numbers of the two blocks to compare, and
    ``side``, the block the row is in. A group of up to ``block`` rows is one
    block. A larger one has ceil(n / block) blocks, and each row goes to every
    pair that its block is in: no task gets more than two blocks, and rows, not
    pairs, are shuffled. Rows are dealt to blocks by a hash of ``spread``.
    """
    parts = F.ceil(F.col("n") / block).cast("int")
    dealt = rows.join(groups.select(*keys, parts.alias("parts")), keys).withColumn(
        "side", F.pmod(F.xxhash64(F.lit(7), spread), F.col("parts")).cast("int")
    )
    others = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other")
    return dealt.select("*", others).select(
        *rows.columns, "side", F.least("side", "other").alias("left"), F.greatest("side", "other").alias("right")
    )


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of ``n`` members the first one that the links (a, b) lead to."""
    root = np.arange(n)
    while True:
        least = root.copy()
        np.minimum.at(least, a, root[b])
        np.minimum.at(least, b, root[a])
        least = least[least]
        if (least == root).all():
            return root
        root = least
