"""Near-duplicates by MinHash signatures and an LSH forest, confirmed on full shingle sets.

A text's set holds its distinct shingles of four words (A-Z lower-cased; a shorter text is one
shingle), as 64-bit hashes.  Sets link if 100 * intersection >= 80 * union; a component is what links
reach.  Equal sets are one node, so exact copies never meet.

Forest.  A signature has ``TREES * DEPTH`` MinHash values of 16 bits.  Each tree is one order of the
nodes by its ``DEPTH`` values; a region is what shares a prefix.  Regions begin at depth ``FIRST``
and are as deep as they need: one with more than ``REGION`` nodes is cut at the next depth, by
counts over all nodes, and one that is still larger at full depth is dealt into blocks of which
each pair is compared.  Within a region a node's candidates are those whose signature agrees in
``AGREE`` of its values or more (four and a half deviations below the threshold); a search over the
nodes not yet reached gives a spanning forest of them, not all pairs.  Two sets at exactly the
threshold share no region of any tree with a probability of 1e-10, in regions of full depth 6e-5.

Confirmation.  Candidate links gather nodes into groups.  The texts of a group meet once, in one
task, and the exact sizes of intersections decide; again unreached nodes only are compared, so a
group of thousands of near copies costs little more than its members.  A group with more than
``BLOCK`` shingles is dealt into blocks, each pair of blocks a task: no link is lost and no task
grows with the data.

Joins whose sides both grow with the corpus ask for a merge, so the plan is the same at every size.
Skew.  Copies shrink map-side.  Rows of one group or component are never joined on it in one task:
large groups are few and met by broadcast (``split_join``).

Defined cases: a text without words (or null) has an empty set, links with nothing and is its own
component; repeated rows stay; rows without an id link like others, and a component's id is its
smallest id that is not null; ``kept`` compares ids with null equal to null; an empty table gives an
empty table; columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripwise.llm.common import split_join, written
from tripwise.llm.simhash import components

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
SHINGLE = 4
TREES, DEPTH, FIRST = 32, 6, 3
REGION = 1000
AGREE = 0.67
BLOCK = 1 << 20
WORK = 1 << 20

_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)


def _multipliers(n: int) -> np.ndarray:
    """Odd 64-bit numbers from a fixed seed."""
    return np.random.default_rng(7).integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mixed(h: np.ndarray, w: np.ndarray) -> np.ndarray:
    h = (h ^ w) * _ODD
    h = (h ^ (h >> np.uint64(32))) * _MIX
    return h ^ (h >> np.uint64(29))


def shingle_sets(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct shingles of every text, ascending within a text, and where each text begins (and the end)."""
    import xxhash
    number: dict[bytes, int] = {}
    flat, begin = [], [0]
    for t in texts:
        flat += [number.setdefault(w, len(number)) for w in WORD.findall(t.lower())]  # bytes: A-Z only
        begin.append(len(flat))
    name = np.fromiter(map(xxhash.xxh3_64_intdigest, number), np.uint64, len(number))
    word = name[np.array(flat, np.int64)]
    begin = np.array(begin)
    size = np.diff(begin)
    count = np.where(size >= SHINGLE, size - SHINGLE + 1, (size > 0).astype(np.int64))
    doc = np.repeat(np.arange(len(texts)), count)
    ends = np.cumsum(count)
    at = np.arange(len(doc)) - np.repeat(ends - count, count) + begin[doc]
    long = np.minimum(size, SHINGLE)[doc]
    h = long.astype(np.uint64)
    for k in range(SHINGLE):
        more = long > k
        h[more] = _mixed(h[more], word[at[more] + k])
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    return h[new], np.searchsorted(doc[new], np.arange(len(texts) + 1))


def signatures(h: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Rows of 16-bit MinHash values, one for each set that is not empty."""
    starts = begin[:-1][np.diff(begin) > 0]
    out = np.empty((len(starts), TREES * DEPTH), ">u2")
    if len(starts):
        for k, a in enumerate(_multipliers(TREES * DEPTH)):
            out[:, k] = np.minimum.reduceat(((h * a) >> np.uint64(32)).astype(np.uint32), starts) & 0xFFFF
    return out


def _chunks(texts: list[bytes], work: int) -> Iterator[tuple[int, int]]:
    begin = size = 0
    for end in range(1, len(texts) + 1):
        size += len(texts[end - 1])
        if end == len(texts) or size + len(texts[end]) > work:
            yield begin, end
            begin, size = end, 0


def _texts(column: pa.Array) -> list[bytes]:
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, ``h1`` and ``h2`` (hashes of the text), size ``n`` of the set, its 128-bit key ``k1``, ``k2`` and signature."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash
        for batch in batches:
            texts = _texts(batch.column(3))
            for a, b in _chunks(texts, WORK):
                h, begin = shingle_sets(texts[a:b])
                n = np.diff(begin)
                sig, raw = signatures(h, begin).tobytes(), h.tobytes()
                width, row, keys, sigs = TREES * DEPTH * 2, 0, [], []
                for s, e in zip(begin.tolist(), begin[1:].tolist()):
                    keys.append(xxhash.xxh3_128_digest(raw[8 * s:8 * e]))
                    sigs.append(sig[row * width:(row + 1) * width] if e > s else None)
                    row += e > s
                k = np.frombuffer(b"".join(keys), np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(i).slice(a, b - a) for i in range(3)), pa.array(n), pa.array(k[:, 0].copy()),
                     pa.array(k[:, 1].copy()), pa.array(sigs, pa.binary())], ["doc_id", "h1", "h2", "n", "k1", "k2", "sig"])

    return docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("h1"), F.hash("text").alias("h2"), "text") \
        .mapInArrow(work, "doc_id long, h1 long, h2 int, n long, k1 long, k2 long, sig binary")


def _bytes(n: int, first: int) -> F.Column:
    """``n`` values of a tree's path from the ``first`` on."""
    return F.substring("path", 2 * first + 1, 2 * n)


def regions(nodes: DataFrame, region: int) -> DataFrame:
    """(group, node): nodes of ``nodes`` (node, sig) that share a region of some tree; groups hold ``2 * region`` at most.

    Depths are visited from ``FIRST`` on; only rows of regions that are too large go on to the next.
    """
    path = F.explode(F.transform(F.sequence(F.lit(0), F.lit(TREES - 1)), lambda t: F.struct(
        t.alias("tree"), F.substring(F.col("sig"), t * (2 * DEPTH) + 1, F.lit(2 * DEPTH)).alias("path"))))
    rows = nodes.select("node", path.alias("at")).select("node", "at.tree", "at.path")
    rows = rows.select("node", F.xxhash64("tree", _bytes(FIRST, 0)).alias("group"),
                       _bytes(DEPTH - FIRST, FIRST).alias("path"))
    found = []
    for depth in range(FIRST, DEPTH + 1):
        size = written(rows.groupBy("group").count().filter("count > 1"), "region-sizes")
        rows = written(split_join(rows, size.hint("merge"), ["group"], heavy=size), "regions")
        found.append(rows.filter(F.col("count") <= region).select("group", "node"))
        rows = rows.filter(F.col("count") > region)
        if rows.isEmpty():
            break
        if depth < DEPTH:
            rows = rows.select("node", F.xxhash64("group", F.substring("path", 1, 2)).alias("group"),
                               F.expr("substring(path, 3)").alias("path"))
        else:
            blocks = F.ceil(F.col("count") / F.lit(region)).cast("int")
            found.append(_dealt(rows.withColumn("blocks", blocks), "group", "node").select("group", "node"))
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    # Of groups with the same members one is enough.
    same = out.groupBy("group").agg(F.count("*").alias("n"), F.min("node").alias("least"), F.max("node").alias("most"),
                                    F.bit_xor(F.xxhash64("node")).alias("all"))
    one = same.groupBy("n", "least", "most", "all").agg(F.min("group").alias("group")).select("group")
    return out.join(one, "group", "left_semi")


def _dealt(rows: DataFrame, group: str, key: str) -> DataFrame:
    """Rows of a group of ``blocks`` blocks once for each pair of blocks that holds theirs; the pair becomes the group."""
    mine = F.pmod(F.xxhash64(key, F.lit("block")), F.col("blocks")).cast("int")
    pair = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda k: F.struct(
        F.least(mine, k).alias("low"), F.greatest(mine, k).alias("high")))
    return rows.withColumn("pair", F.explode(pair)) \
        .withColumn(group, F.xxhash64(group, "pair.low", "pair.high")).drop("pair", "blocks")


def _spanning(n: int, near) -> tuple[list[int], list[int]]:
    """Forest over ``n`` members: ``near(at, rest)`` tells which of ``rest`` link to ``at``; only unreached ones are asked."""
    left, right, queue, rest = [], [], [], np.arange(n)
    while len(rest):
        if queue:
            at = queue.pop()
        else:
            at, rest = int(rest[0]), rest[1:]
        if not len(rest):
            break
        got = near(at, rest)
        if got.any():
            new = rest[got].tolist()
            left += [at] * len(new)
            right += new
            queue += new
            rest = rest[~got]
    return left, right


LINKS = "a long, b long"


def _links(nodes: np.ndarray, pairs: tuple[list[int], list[int]]) -> pa.Table:
    return pa.Table.from_arrays([pa.array(nodes[np.array(x, np.int64)], pa.int64()) for x in pairs], ["a", "b"])


def candidates(nodes: DataFrame, region: int = REGION) -> DataFrame:
    """Candidate links (a, b), enough to connect all nodes that agree in ``AGREE`` of their values within a region."""
    def work(part: pa.Table) -> pa.Table:
        part = part.sort_by("node")
        at = part.column("node").to_numpy()
        sig = np.frombuffer(b"".join(part.column("sig").to_pylist()), np.uint16).reshape(len(at), -1)
        least = AGREE * sig.shape[1]
        return _links(at, _spanning(len(at), lambda i, rest: (sig[rest] == sig[i]).sum(axis=1) >= least))

    members = written(regions(nodes, region), "members")
    return members.join(nodes.select("node", "sig"), "node").groupBy("group").applyInArrow(work, LINKS).distinct()


def _confirm(nodes: np.ndarray, texts: list[bytes]) -> pa.Table:
    """Links of one group, enough to connect its components, by the exact sizes of intersections."""
    h, begin = shingle_sets(texts)
    size = np.diff(begin)
    values, of = np.unique(h, return_inverse=True)
    mark = np.zeros(len(values), bool)

    def near(at: int, rest: np.ndarray) -> np.ndarray:
        out = np.zeros(len(rest), bool)
        fits = np.flatnonzero((100 * size[rest] >= 80 * size[at]) & (100 * size[at] >= 80 * size[rest]))
        if len(fits):
            mark[of[begin[at]:begin[at + 1]]] = True
            n = size[rest[fits]]
            ends = np.cumsum(n)
            place = np.arange(ends[-1]) + np.repeat(begin[rest[fits]] - (ends - n), n)
            both = np.add.reduceat(mark[of[place]].astype(np.int64), ends - n)
            out[fits] = 100 * both >= 80 * (n + size[at] - both)
            mark[of[begin[at]:begin[at + 1]]] = False
        return out

    return _links(nodes, _spanning(len(nodes), near))


def confirmed(groups: DataFrame, docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """Links (a, b) between nodes of ``groups`` (root, node, n, doc_id, h1, h2: one row of ``docs`` for each node)."""
    def work(part: pa.Table) -> pa.Table:
        part = part.sort_by("node")
        return _confirm(part.column("node").to_numpy(), _texts(part.column("text").combine_chunks()))

    total = groups.groupBy("root").agg(F.sum("n").alias("n"))
    large = written(total.filter(F.col("n") > block).select(
        "root", F.ceil(F.col("n") / F.lit(block / 2)).cast("int").alias("blocks")), "large")
    zero = F.lit(0).cast("long")
    key = [F.coalesce("doc_id", zero).alias("id"), F.col("doc_id").isNull().alias("none")]
    mine = groups.select("root", "node", *key, "h1", "h2")
    texts = docs.select(F.col("doc_id").cast("long"), "text").select(
        *key, F.xxhash64("text").alias("h1"), F.hash("text").alias("h2"), "text")
    held = texts.join(mine.hint("merge"), ["id", "none", "h1", "h2"]).select("root", "node", "text")
    held = written(held.groupBy("root", "node").agg(F.first("text").alias("text")), "group-texts")
    small = held.join(large, "root", "left_anti")
    if not large.isEmpty():  # a group of more than BLOCK shingles: at most as many as the corpus has blocks
        small = small.unionByName(_dealt(split_join(held, large, ["root"]), "root", "node"))
    return small.groupBy("root").applyInArrow(work, LINKS).distinct()


def near_duplicates(docs: DataFrame, region: int = REGION, block: int = BLOCK) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest doc_id reachable) and kept."""
    held = written(sketches(docs), "sketches")
    none, d = F.col("doc_id").isNull(), F.col("doc_id")
    nodes = held.filter("n > 0").groupBy("k1", "k2", "n", "sig").agg(
        F.min(F.struct(none.alias("none"), d.alias("doc_id"), "h1", "h2")).alias("of"))
    # A written number: unique, and the same whenever it is read again.
    nodes = written(nodes.select(F.monotonically_increasing_id().alias("node"), "k1", "k2", "n", "sig", "of.*").drop("none"),
                    "nodes")
    maybe = components(candidates(nodes, region))
    groups = written(nodes.select("node", "n", "doc_id", "h1", "h2").join(maybe, "node"), "groups")
    roots = components(confirmed(groups, docs, block))
    named = written(nodes.select("node", "k1", "k2", "doc_id").join(roots, "node"), "roots")
    least = named.groupBy("root").agg(F.min("doc_id").alias("least"))
    of = written(split_join(named.select("root", "k1", "k2"), least, ["root"]), "linked").select("k1", "k2", "least")
    own = written(nodes.groupBy("k1", "k2").agg(F.min("doc_id").alias("own")).join(of, ["k1", "k2"], "left").select(
        "k1", "k2", F.coalesce("least", "own").alias("component_id")), "components")
    with_set = split_join(held.filter("n > 0").select("doc_id", "n", "k1", "k2"), own, ["k1", "k2"])
    out = with_set.select("doc_id", "n", "component_id").union(
        held.filter("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id")))
    return out.select("doc_id", F.col("n").alias("n_shingles"), "component_id",
                      F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
