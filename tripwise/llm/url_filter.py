"""URL filter: a trie over reversed host labels and path segments.

A rule is (host, path, verdict).  It fits a url whose host equals the rule's host or
ends with ``.`` + that host, and whose path starts with the rule's path.  Of the fitting
rules the longest decides (characters of host + path; then the one with more host
labels; then block over allow); without one the ``default`` verdict holds.

Defined cases: a null url and a url without ``://`` have an empty host and path, so no
rule fits; repeated rows are each judged; an empty table gives an empty table; other
columns of the input are kept unless they clash with the result's names, which win.
"""

from __future__ import annotations

from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripwise.llm.common import fresh

Rule = tuple[str, str, str]
#: Above so many bytes of rules the trie is not broadcast: use ``judge_by_join``.
MAX_TRIE_BYTES = 32 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"^[\s\S]*?://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"^[\s\S]*?://[^/?#]*([^?#]*)", 1), F.lit(""))


class UrlTrie:
    """Nodes are ``[children, path trie or None]`` for labels, ``[children, ends]`` for segments.

    A rule's path is cut at ``/``: all but the last piece are segments to be met in
    full, the last one is the beginning of the next segment (mostly empty) and lies in ``ends``.
    """

    def __init__(self, rules: Iterable[Rule]):
        self.root: list = [{}, None]
        for host, path, verdict in rules:
            node = self.root
            for label in reversed(host.split(".")):
                node = node[0].setdefault(label, [{}, None])
            if node[1] is None:
                node[1] = [{}, {}]
            *whole, begin = path.split("/")
            spot = node[1]
            for segment in whole:
                spot = spot[0].setdefault(segment, [{}, {}])
            rank = (len(host) + len(path), host.count("."), verdict == "block")
            held = spot[1].get(begin)
            if held is None or held[0] < rank:
                spot[1][begin] = (rank, host + path, verdict)

    def find(self, host: str, path: str) -> tuple[str, str] | None:
        """Rule string and verdict of the longest fitting rule."""
        best, node, segments = None, self.root, path.split("/")
        for label in reversed(host.split(".")):
            node = node[0].get(label)
            if node is None:
                break
            spot = node[1]
            for segment in segments:
                if spot is None:
                    break
                ends = spot[1]
                if ends:
                    for n in range(len(segment) + 1):
                        hit = ends.get(segment[:n])
                        if hit is not None and (best is None or best[0] < hit[0]):
                            best = hit
                spot = spot[0].get(segment)
        return None if best is None else (best[1], best[2])


def judge(df: DataFrame, rules: list[Rule], url: str = "url", default: str = "allow") -> DataFrame:
    """``df`` with ``host``, ``path``, ``rule`` (null if none fits) and ``verdict``, by a broadcast trie."""
    size = sum(len(h.encode()) + len(p.encode()) for h, p, _ in rules)
    if size > MAX_TRIE_BYTES:
        raise ValueError(f"{size} bytes of rules are too many to broadcast; use judge_by_join")
    shared = df.sparkSession.sparkContext.broadcast(UrlTrie(rules))

    @F.pandas_udf("rule string, verdict string")
    def walk(hosts: pd.Series, paths: pd.Series) -> pd.DataFrame:
        find = shared.value.find
        found = [find(h, p) or (None, default) for h, p in zip(hosts, paths)]
        return pd.DataFrame(found, columns=["rule", "verdict"])

    out = df.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))})
    hit, = fresh(df, "__hit")
    out = out.withColumn(hit, walk("host", "path"))
    return out.withColumns({"rule": F.col(f"{hit}.rule"), "verdict": F.col(f"{hit}.verdict")}).drop(hit)


def judge_by_join(df: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """The same for a table of rules (host, path, verdict) of any size, by an equi-join.

    A url asks for each of its host's suffixes with each of its path's whole-segment
    prefixes; a rule lies under its host and its path up to the last ``/``.  Only the distinct
    (host, path) pairs are joined, so a host with a third of all rows costs its distinct paths.
    """
    held = rules.select(
        F.col("host").alias("rh"), F.regexp_extract("path", r"^([\s\S]*/)?", 0).alias("rk"), F.col("path").alias("rp"),
        F.struct((F.length("host") + F.length("path")).alias("n"), F.size(F.split("host", r"\.")).alias("labels"),
                 (F.col("verdict") == "block").alias("block"), F.concat("host", "path").alias("rule"),
                 F.col("verdict").alias("verdict")).alias("hit"))
    asked = df.select(host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path")).distinct()
    labels, pieces = F.split("host", r"\."), F.split("path", "/")
    keys = asked.withColumn("labels", labels).withColumn("pieces", pieces) \
        .withColumn("i", F.explode(F.sequence(F.lit(1), F.size("labels")))) \
        .withColumn("j", F.explode(F.sequence(F.lit(0), F.size("pieces") - 1))) \
        .withColumn("rh", F.array_join(F.slice("labels", F.col("i"), F.size("labels")), ".")) \
        .withColumn("rk", F.when(F.col("j") == 0, "").otherwise(
            F.concat(F.array_join(F.slice("pieces", F.lit(1), F.col("j")), "/"), F.lit("/"))))
    hit, = fresh(df, "__hit")
    best = keys.join(held, ["rh", "rk"]).filter(F.col("path").startswith(F.col("rp"))) \
        .groupBy("host", "path").agg(F.max("hit").alias(hit))
    out = df.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))}).join(best, ["host", "path"], "left")
    return out.withColumns({"rule": F.col(f"{hit}.rule"),
                            "verdict": F.coalesce(F.col(f"{hit}.verdict"), F.lit(default))}).drop(hit)
