"""Conversation prefix trie: which turns conversations share from their beginning on.

A node is a distinct sequence of first d turns (role, text); the root has none.  Its key is a chain
of 128-bit digests over its turns, so equal keys mean equal sequences, and a conversation is the
path of its keys.

Z-fast trie.  Distinct sequences are dealt by ranges of their paths, so what shares a prefix
lies together, and every task builds a trie of its share.  The trie keeps compacted nodes only (branches and
ends) in a table under the key at the two-fattest depth of their edge: of the depths (p, e] the one
divisible by the largest power of two.  A fat binary search over the depths of a sequence, one look into the
table a step, finds the deepest node that it passes, in logarithmically many steps.
Sequences come in batches: first all of a batch look for their places, then each goes on from
the place found, as others of its batch may have split an edge below it.  At the end edges are
expanded into one row a depth.  A trie with more than ``MAX_NODES`` nodes is emitted and begun anew.

Plan.  Rows of one node from several tasks (those on a border of two ranges) add up in one
aggregation.  Sums over subtrees need no walk through the levels: each node counts for the conversation
that is its smallest member, whose path holds all its ancestors, so one more aggregation adds every node
to all of them.  Copies of a sequence are counted before anything is dealt; ids that end at a node are
hashed in order from joined pieces of ``PIECE`` ids, so a sequence with a third of all
conversations costs a task that many ids in pieces, never all of them at once.

Defined cases: turns go by ``turn`` (null first), then role, then text; null role or text is empty; repeated
rows are turns of their own; rows without a ``conv_id`` belong to no conversation and take no part; an empty
table gives an empty table; other columns are not read.  A path (16 bytes a turn, no texts) must fit
into a task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tripwise.llm.common import split_join, written

WORD = r"[^\x20\x09-\x0D]+"
KEY = 16
ROOT = b"\0" * KEY
MAX_NODES = 200_000
PIECE = 4096
PER_TASK = 20_000


def fattest(a: int, b: int) -> int:
    """The number in (a, b] that is divisible by the largest power of two."""
    return b & (-1 << ((a ^ b).bit_length() - 1))


class ZFastTrie:
    """Compacted trie of paths; a path is the keys of all its prefixes one after another.

    Node i has the depths (above[i], depth[i]] of the path ``path[i]``.
    """

    def __init__(self):
        self.path, self.words, self.above, self.depth, self.parent = [b""], [()], [0], [0], [-1]
        self.count, self.least = [0], [None]
        self.handles: dict[bytes, int] = {}  # key at the two-fattest depth of a node's edge -> node
        self.first: dict[bytes, int] = {}    # key at the first depth of a node's edge -> node

    def __len__(self) -> int:
        return len(self.path)

    @staticmethod
    def key(path: bytes, depth: int) -> bytes:
        return path[KEY * (depth - 1):KEY * depth]

    def handle(self, node: int) -> bytes:
        return self.key(self.path[node], fattest(self.above[node], self.depth[node]))

    def locate(self, path: bytes, begin: int = 0) -> int:
        """The deepest node whose whole sequence begins ``path``, at or below node ``begin``, by fat binary search."""
        found, a, b = begin, self.depth[begin], len(path) // KEY
        while a < b:
            f = fattest(a, b)
            node = self.handles.get(self.key(path, f))
            if node is None:
                b = f - 1
            else:
                e = self.depth[node]
                if e * KEY <= len(path) and self.key(path, e) == self.key(self.path[node], e):
                    found, a = node, e
                else:
                    b = f - 1  # the path leaves this node's edge
        return found

    def _add(self, path: bytes, words: tuple, above: int, depth: int, parent: int) -> int:
        node = len(self.path)
        for held, value in ((self.path, path), (self.words, words), (self.above, above), (self.depth, depth),
                            (self.parent, parent), (self.count, 0), (self.least, None)):
            held.append(value)
        self.handles[self.handle(node)] = node
        self.first[self.key(path, above + 1)] = node
        return node

    def _split(self, node: int, at: int) -> int:
        """A new node at depth ``at`` inside the edge of ``node``, which keeps what lies below it."""
        del self.handles[self.handle(node)]
        upper = self._add(self.path[node], self.words[node], self.above[node], at, self.parent[node])
        self.above[node], self.parent[node] = at, upper
        self.handles[self.handle(node)] = node
        self.first[self.key(self.path[node], at + 1)] = node
        return upper

    def insert(self, path: bytes, words: tuple, count: int, least: int, begin: int = 0) -> None:
        """Add ``count`` sequences equal to ``path``, the smallest id of which is ``least``."""
        depth = len(path) // KEY
        node = self.locate(path, begin)
        a = self.depth[node]
        if a < depth:
            exit_ = self.first.get(self.key(path, a + 1))
            if exit_ is not None:  # leaves inside this edge: the common part is found by halving, keys being chained
                low, high = a + 1, min(depth, self.depth[exit_] - 1)
                while low < high:
                    mid = (low + high + 1) // 2
                    if self.key(path, mid) == self.key(self.path[exit_], mid):
                        low = mid
                    else:
                        high = mid - 1
                node, a = self._split(exit_, low), low
            if a < depth:
                node = self._add(path, words, a, depth, node)
        self.count[node] += count
        self.least[node] = least if self.least[node] is None else min(least, self.least[node])

    def insert_batch(self, batch: list[tuple[bytes, tuple, int, int]]) -> None:
        places = [self.locate(path) for path, *_ in batch]
        for place, (path, words, count, least) in zip(places, batch):
            self.insert(path, words, count, least, place)

    def expanded(self) -> Iterator[tuple[bytes, bytes | None, int, int, int, int]]:
        """Key, parent's key, depth, words of the last turn, members and smallest member of every node of every edge."""
        count, least = list(self.count), list(self.least)
        for node in sorted(range(1, len(self)), key=self.depth.__getitem__, reverse=True):
            up = self.parent[node]
            count[up] += count[node]
            least[up] = least[node] if least[up] is None else min(least[up], least[node])
        if count[0]:
            yield ROOT, None, 0, 0, count[0], least[0]
        for node in range(1, len(self)):
            path, words = self.path[node], self.words[node]
            for d in range(self.above[node] + 1, self.depth[node] + 1):
                yield self.key(path, d), self.key(path, d - 1) or ROOT, d, words[d - 1], count[node], least[node]


def conversations(turns: DataFrame) -> DataFrame:
    """conv_id and its turns in order: an array of (digest of role and text, words of the text)."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = turns.filter("conv_id is not null").select(F.col("conv_id").cast("long"), "turn", role.alias("role"), text.alias("text"))
    place = F.row_number().over(W.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text"))
    # The length of the role keeps ("a", "bc") and ("ab", "c") apart.
    digest = F.substring(F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"), 256)),
                         1, KEY)
    return rows.withColumn("place", place).select(
        "conv_id", "place", digest.alias("digest"), F.regexp_count("text", F.lit(WORD)).cast("int").alias("words")) \
        .groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("place", "digest", "words"))).alias("turns")) \
        .select("conv_id", F.transform("turns", lambda t: F.struct(t["digest"].alias("digest"), t["words"].alias("words"))).alias("turns"))


def rebuilt(convs: DataFrame) -> DataFrame:
    """Conversation c begins with the first h turns of c - c % 20, then has its own behind its first h; h = crc32(c) % 4."""
    base = F.col("conv_id") - F.col("conv_id") % 20
    heads = convs.filter("conv_id % 20 = 0").select(F.col("conv_id").alias("base"), F.slice("turns", 1, 3).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4).cast("int")
    own = F.expr("slice(turns, h + 1, greatest(size(turns) - h, 0))")
    head = F.expr("coalesce(slice(head, 1, h), slice(turns, 1, 0))")
    return convs.withColumns({"base": base, "h": h}).join(heads, "base", "left").select("conv_id", F.concat(head, own).alias("turns"))


def paths(convs: DataFrame) -> DataFrame:
    """conv_id, ``path`` (keys of all prefixes, one after another), its last key and the words of each turn."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            path, last, words = [], [], []
            for turns in batch.column(1).to_pylist():
                key, keys = ROOT, []
                for t in turns:
                    key = hashlib.blake2b(key + t["digest"], digest_size=KEY).digest()
                    keys.append(key)
                path.append(b"".join(keys))
                last.append(key)
                words.append([t["words"] for t in turns])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(path, pa.binary()), pa.array(last, pa.binary()),
                                              pa.array(words, pa.list_(pa.int32()))], ["conv_id", "path", "last", "words"])

    return convs.select("conv_id", "turns").mapInArrow(work, "conv_id long, path binary, last binary, words array<int>")


NODE = "key binary, parent binary, depth long, words long, n long, least long"


def nodes(sequences: DataFrame, max_nodes: int = MAX_NODES) -> DataFrame:
    """All nodes of distinct ``sequences`` (path, words, n, least): key, parent, depth, words, n and least."""
    types = [pa.binary(), pa.binary(), *[pa.int64()] * 4]
    names = [c.split()[0] for c in NODE.split(", ")]

    def rows(trie: ZFastTrie) -> pa.RecordBatch:
        columns = list(zip(*trie.expanded())) or [()] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = ZFastTrie()
        for batch in batches:
            path, words, n, least = (batch.column(i).to_pylist() for i in range(4))
            trie.insert_batch(list(zip(path, words, n, least)))
            if len(trie) > max_nodes:
                yield rows(trie)
                trie = ZFastTrie()
        yield rows(trie)

    parts = max(1, -(-sequences.count() // PER_TASK))
    dealt = sequences.select("path", "words", "n", "least").repartitionByRange(parts, "path")
    return dealt.mapInArrow(work, NODE).groupBy("key").agg(
        F.first("parent").alias("parent"), F.first("depth").alias("depth"), F.first("words").alias("words"),
        F.sum("n").alias("n"), F.min("least").alias("least"))


def subtree_sums(sequences: DataFrame, found: DataFrame) -> DataFrame:
    """key, and of its subtree: childless nodes and saved words.  ``found`` has the nodes with ``children``.

    A node counts for its smallest member; that conversation's path has all its ancestors.
    """
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, leaves, saved = [], [], []
            for path, own in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                depth = len(path) // KEY
                of = np.zeros((2, depth + 1), np.int64)
                for x in own:
                    of[:, x["depth"]] = x["leaves"], x["saved"]
                of = np.cumsum(of[:, ::-1], axis=1)[:, ::-1]
                keys += [ROOT, *(path[KEY * d:KEY * (d + 1)] for d in range(depth))]
                leaves.append(of[0])
                saved.append(of[1])
            flat = [np.concatenate(x) if x else np.empty(0, np.int64) for x in (leaves, saved)]
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), *map(pa.array, flat)], ["key", "leaves", "saved"])

    value = F.struct("depth", (F.col("children") == 0).cast("long").alias("leaves"),
                     ((F.col("n") - 1) * F.col("words")).alias("saved"))
    owned = found.groupBy("least").agg(F.collect_list(value).alias("own"))
    return sequences.select("least", "path").join(owned, "least").select("path", "own") \
        .mapInArrow(work, "key binary, leaves long, saved long") \
        .groupBy("key").agg(F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))


def ends(members: DataFrame, piece: int = PIECE) -> DataFrame:
    """``last`` and the SHA-256 of the ids that end there, in decimal, ascending, joined by commas.

    Ranges of (last, id) give pieces of joined ids; then the pieces of a key are hashed in order,
    one at a time.
    """
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ids = None, []

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([now], pa.binary()), pa.array([ids[0]], pa.int64()),
                                               pa.array([",".join(map(str, ids))])], ["last", "first", "ids"])
        for batch in batches:
            for last, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if ids and (last != now or len(ids) == piece):
                    yield out()
                    ids = []
                now = last
                ids.append(conv)
        if ids:
            yield out()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sha = None, None

        def out(keys: list, hexes: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(hexes, pa.string())], ["last", "ends"])
        for batch in batches:
            keys, hexes = [], []
            for last, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if sha is not None and last == now:
                    sha.update(b"," + ids.encode())
                    continue
                if sha is not None:
                    keys.append(now)
                    hexes.append(sha.hexdigest())
                now, sha = last, hashlib.sha256(ids.encode())
            yield out(keys, hexes)
        if sha is not None:
            yield out([now], [sha.hexdigest()])

    order = ["last", "conv_id"]
    pieces = members.select(*order).repartitionByRange(*order).sortWithinPartitions(*order) \
        .mapInArrow(cut, "last binary, first long, ids string")
    return pieces.repartition("last").sortWithinPartitions("last", "first").select("last", "ids") \
        .mapInArrow(digest, "last binary, ends string")


def trie(convs: DataFrame, max_nodes: int = MAX_NODES) -> DataFrame:
    """One row per node of ``convs`` (conv_id, turns): see the query's contract in ``queries``."""
    members = written(paths(convs), "paths")
    sequences = written(members.groupBy("last").agg(
        F.first("path").alias("path"), F.first("words").alias("words"), F.count("*").alias("n"),
        F.min("conv_id").alias("least")), "sequences")
    found = written(nodes(sequences, max_nodes), "nodes")
    children = found.filter("parent is not null").groupBy("parent").agg(F.count("*").alias("children"))
    counted = written(found.join(children.withColumnRenamed("parent", "key"), "key", "left").withColumn(
        "children", F.coalesce("children", F.lit(0).cast("long"))), "counted")
    sums, hashes = subtree_sums(sequences, counted), ends(members).withColumnRenamed("last", "key")
    whole = written(counted.join(sums, "key").join(hashes, "key", "left"), "whole")
    above = counted.filter("children > 0").select(F.col("key").alias("parent"), F.col("least").alias("parent_conv_id"))
    nothing = hashlib.sha256(b"").hexdigest()
    return split_join(whole, above, ["parent"], "left").select(
        F.col("least").alias("conv_id"), "depth", "parent_conv_id", F.col("n").alias("n_convs"),
        F.col("children").alias("n_children"), "n_leaves", "saved_tokens",
        F.coalesce("ends", F.lit(nothing)).alias("ends_sha256"))
