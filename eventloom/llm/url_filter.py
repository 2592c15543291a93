"""Allow and block lists over URLs: a trie over reversed host labels and path segments.

The rules are few and checked to be (``max_rules``); the trie is broadcast with the
function that walks it, and pages stay where they are: no shuffle.
"""

from __future__ import annotations

from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_RULES = 1_000_000
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_VERDICT = "struct<rule: string, verdict: string>"


class _Node:
    """``below``: child nodes by label; ``paths``: the path trie of rules of this host."""

    __slots__ = ("below", "paths", "ends")

    def __init__(self) -> None:
        self.below: dict[str, _Node] = {}
        self.paths: _Node | None = None
        self.ends: dict[str, tuple[str, str]] = {}  # begin of the next segment -> (rule, verdict)


class UrlTrie:
    """Rules (verdict, host, path): ``verdict`` is allow or block.

    A rule fits its host and all its subdomains if the URL's path starts with
    the rule's, also within a segment. The rule of the longest host wins, among
    these the one of the longest path; the same host and path in both lists is
    a block.
    """

    def __init__(self, rules: Iterable[tuple[str, str, str]], default: str = "allow") -> None:
        self.root, self.default = _Node(), default
        for verdict, host, path in rules:
            if verdict not in ("allow", "block"):
                raise ValueError(f"verdict must be allow or block: {verdict!r}")
            node = self.root
            for label in reversed(host.split(".")):
                node = node.below.setdefault(label, _Node())
            node.paths = node.paths or _Node()
            *whole, begin = path.split("/")
            node = node.paths
            for segment in whole:
                node = node.below.setdefault(segment, _Node())
            if node.ends.get(begin, ("", ""))[1] != "block":
                node.ends[begin] = (host + path, verdict)

    def _by_path(self, paths: _Node, segments: list[str]) -> tuple[str, str] | None:
        found, node = None, paths
        for segment in segments:
            fits = [begin for begin in node.ends if segment.startswith(begin)]
            if fits:
                found = node.ends[max(fits, key=len)]
            node = node.below.get(segment)
            if node is None:
                break
        return found

    def match(self, host: str, path: str) -> tuple[str | None, str]:
        """(rule or None, verdict) of a lower-cased host and a path."""
        found, node, segments = None, self.root, path.split("/")
        for label in reversed(host.split(".")):
            node = node.below.get(label)
            if node is None:
                break
            if node.paths is not None:
                found = self._by_path(node.paths, segments) or found
        return found or (None, self.default)


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(_rest(url), r"\A[^/?#]*", 0)
    return F.translate(host, _UPPER, _UPPER.lower())


def url_path(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end; else empty."""
    return F.regexp_extract(_rest(url), r"\A[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.coalesce(F.locate("://", url), F.lit(0))
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def filter_urls(
    pages: DataFrame,
    rules: list[tuple[str, str, str]],
    url_col: str = "url",
    default: str = "allow",
    max_rules: int = MAX_RULES,
) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` (null if none fits) and ``verdict``.

    Without a fitting rule the verdict is ``default``: a page is kept unless a
    rule blocks it. A null URL, and one without ``://``, has an empty host and
    path and fits no rule. Columns of these names are replaced. More than
    ``max_rules`` rules are refused, as they would not fit a broadcast.
    """
    if len(rules) > max_rules:
        raise ValueError(f"{len(rules)} rules; at most {max_rules} can be broadcast")
    trie = pages.sparkSession.sparkContext.broadcast(UrlTrie(rules, default))

    @F.arrow_udf(_VERDICT)
    def judge(hosts: pa.Array, paths: pa.Array) -> pa.Array:
        match = trie.value.match
        found = [match(h, p) for h, p in zip(hosts.to_pylist(), paths.to_pylist())]
        return pa.StructArray.from_arrays(
            [pa.array([f[i] for f in found], pa.string()) for i in (0, 1)], ["rule", "verdict"]
        )

    url = F.col(f"`{url_col}`")
    return (
        pages.withColumn("__host", url_host(url)).withColumn("__path", url_path(url))
        .withColumn("__judged", judge("__host", "__path"))
        .withColumn("host", F.col("__host")).withColumn("path", F.col("__path"))
        .withColumn("rule", F.col("__judged.rule")).withColumn("verdict", F.col("__judged.verdict"))
        .drop("__host", "__path", "__judged")
    )
