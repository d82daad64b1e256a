"""SimHash near-duplicates by a segment-popcount embedding and a grid range-join.

A text's fingerprint is the 64-bit SimHash of its word shingles (XXH64, seed 42).
Two fingerprints link if they differ in at most ``max_bits`` bits; a component is what
links reach.

Candidates.  A fingerprint maps to the vector of the bit counts (0, 1, 2) of its 32
two-bit segments.  The Manhattan distance of two vectors is a lower bound of their
Hamming distance, so linked fingerprints lie within ``max_bits`` of each other.  The 32
coordinates are dealt into ``max_bits + 2`` runs: vectors within that distance agree on at
least two whole runs.  For every pair of runs there is one grid over those
coordinates, and a fingerprint falls into one cell of each grid (15 cells at 4 bits).  Within a
cell the Manhattan distance prunes and the exact bit distance decides.

Skew.  Only distinct fingerprints are joined, so exact copies never meet.  A cell yields
a spanning forest of its links, found by a search over the members not yet reached, not
all pairs: a group of thousands of near copies gives fewer links than members.  A cell
with more than ``max_cell`` members is dealt into blocks, and each pair of blocks is one
group: no link is lost and no group grows with the data.

Defined cases: null text counts as empty; a text without words has fingerprint zero,
which links like any other; a text with fewer words than a shingle is one shingle;
repeated rows stay; null ``doc_id`` rows keep their fingerprint, and a component's id is
its smallest non-null ``doc_id``; an empty table gives an empty table; columns other
than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tripwise.llm.common import fresh, split_join, written

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
LOW = np.uint64(0x5555555555555555)


def fingerprint(text: str | None, words: int = 4) -> int:
    """64-bit SimHash of the word shingles; a bit is set if it is in over half of the hashes."""
    import xxhash
    # bytes.lower touches A-Z only; splitting on these six bytes never cuts a UTF-8 sequence.
    found = WORD.findall((text or "").encode("utf-8", "surrogatepass").lower())
    if not found:
        return 0
    joined, digest = b" ".join(found), xxhash.xxh64_intdigest
    if len(found) <= words:
        return digest(joined, 42)
    ends = np.cumsum([len(w) + 1 for w in found])
    starts = np.concatenate(([0], ends[:-1]))[: len(found) - words + 1].tolist()
    stops = (ends[words - 1:] - 1).tolist()
    h = np.array([digest(joined[a:b], 42) for a, b in zip(starts, stops)], dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, len(h), 1 << 16):  # bounded memory for very long texts
        ones += np.unpackbits(h[i:i + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(
            axis=0, dtype=np.int64)
    bits = (ones * 2 > len(h)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = 4, hashed: bool = False) -> DataFrame:
    """doc_id and ``fp``, the fingerprint as a signed 64-bit integer; if ``hashed``, also ``h``, a hash of the text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = np.array([fingerprint(t, words) for t in batch.column(1).to_pylist()], dtype=np.uint64).view(np.int64)
            more = batch.columns[2:], batch.schema.names[2:]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp), *more[0]], ["doc_id", "fp", *more[1]])

    more = [F.xxhash64("text").alias("h")] if hashed else []
    return docs.select(F.col("doc_id").cast("long"), "text", *more) \
        .mapInArrow(run, "doc_id long, fp long" + ", h long" * hashed)


def _runs(parts: int) -> list[int]:
    """Bit masks of ``parts`` runs of two-bit segments that cover all 32."""
    edges = [round(32 * i / parts) for i in range(parts + 1)]
    return [sum(3 << (2 * s) for s in range(a, b)) for a, b in zip(edges, edges[1:])]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _counts(fp: np.ndarray) -> np.ndarray:
    """Packed bit counts of the 32 two-bit segments."""
    high = fp >> np.uint64(1)
    return ((high ^ fp) & LOW) | ((high & fp & LOW) << np.uint64(1))


def _manhattan(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distance of packed vectors: lanes that differ count 1, or 2 where only the high bit differs."""
    x = a ^ b
    low, high = x & LOW, (x >> np.uint64(1)) & LOW
    return np.bitwise_count(low) + 2 * np.bitwise_count(high & ~low)


def _forest(members: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest of the links within one cell: each member is compared with those not yet reached."""
    left, right = [], []
    rest, queue = members, []
    while len(rest) or queue:
        if queue:
            at = queue.pop()
        else:
            at, rest = rest[0], rest[1:]
        if not len(rest):
            if not queue:
                break
            continue
        near = _manhattan(_counts(rest), _counts(at)) <= max_bits
        if not near.any():
            continue
        near[near] = np.bitwise_count(rest[near] ^ at) <= max_bits
        got = rest[near]
        if len(got):
            left.append(np.full(len(got), at, dtype=np.uint64))
            right.append(got)
            queue.extend(got)
            rest = rest[~near]
    if not left:
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    return np.concatenate(left), np.concatenate(right)


def _links_of_sorted(cell: np.ndarray, fp: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of whole cells lying one after another: small cells at once by offset, large ones by search."""
    starts = np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1])))
    sizes = np.diff(np.append(starts, len(cell)))
    left, right = [], []
    small = np.repeat(sizes <= 64, sizes)
    f, c = fp[small], cell[small]
    p = _counts(f)
    for d in range(1, int(sizes[sizes <= 64].max(initial=1))):
        same = np.flatnonzero(c[d:] == c[:-d])
        if not len(same):
            break
        same = same[_manhattan(p[same], p[same + d]) <= max_bits]
        same = same[np.bitwise_count(f[same] ^ f[same + d]) <= max_bits]
        left.append(f[same])
        right.append(f[same + d])
    for s, n in zip(starts[sizes > 64], sizes[sizes > 64]):
        a, b = _forest(fp[s:s + n], max_bits)
        left.append(a)
        right.append(b)
    return (np.concatenate(left), np.concatenate(right)) if left else (np.empty(0, np.uint64),) * 2


def links(distinct: DataFrame, max_bits: int = 4, max_cell: int = 50_000) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``fp``, enough to connect every component."""
    runs = _runs(max_bits + 2)
    grids = [runs[i] | runs[j] for i, j in itertools.combinations(range(len(runs)), 2)]
    fp = F.col("fp")
    low, high = F.lit(_signed(int(LOW))), F.shiftrightunsigned(fp, 1)
    one, two = high.bitwiseXOR(fp).bitwiseAND(low), high.bitwiseAND(fp).bitwiseAND(low)
    cells = distinct.select(fp, one.bitwiseOR(F.shiftleft(two, 1)).alias("p")).select(fp, F.explode(F.array(*[
        F.xxhash64(F.lit(g), F.col("p").bitwiseAND(F.lit(_signed(mask)))) for g, mask in enumerate(grids)])).alias("cell"))
    # Cells beyond max_cell (few, if any) are dealt into blocks; each pair of blocks is a group.
    large = cells.groupBy("cell").count().filter(F.col("count") > max_cell) \
        .select("cell", F.ceil(F.col("count") / F.lit(max_cell / 2)).cast("int").alias("blocks"))
    mine = F.pmod(F.xxhash64("fp", F.lit("block")), F.col("blocks")).cast("int")
    dealt = cells.join(large, "cell", "left").withColumn("part", F.explode(F.when(
        F.col("blocks").isNull(), F.array(F.lit(0).cast("long"))).otherwise(F.transform(
            F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1),
            lambda k: F.least(mine, k).cast("long") * F.lit(1 << 31) + F.greatest(mine, k)))))
    dealt = dealt.select(F.xxhash64("cell", "part").alias("cell"), "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(pair):
            return pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in pair], ["a", "b"])
        kept_c, kept_f = [], []
        for batch in batches:
            c, f = batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64)
            if not len(c):
                continue
            if kept_c and kept_c[-1][-1] == c[0] == c[-1]:  # one cell goes on
                kept_c.append(c)
                kept_f.append(f)
                continue
            cut = len(c) - int(np.argmax(c[::-1] != c[-1])) if c[0] != c[-1] else 0
            whole = np.concatenate([*kept_c, c[:cut]]), np.concatenate([*kept_f, f[:cut]])
            if len(whole[0]):
                yield out(_links_of_sorted(*whole, max_bits))
            kept_c, kept_f = [c[cut:]], [f[cut:]]
        if kept_c:
            yield out(_links_of_sorted(np.concatenate(kept_c), np.concatenate(kept_f), max_bits))

    return dealt.repartition("cell").sortWithinPartitions("cell").mapInArrow(run, "a long, b long").distinct()


def components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """(node, root): the smallest node reachable, for every node of ``edges`` (a, b).

    Alternating star contractions (large star, small star).  Every round is one
    written table, so a lost executor repeats one round at most; a round aggregates before it
    shuffles, and the edges of a hub stay where they are and get its minimum by broadcast.
    Stops when a round changes nothing.
    """
    def largest_first(e: DataFrame) -> DataFrame:
        return e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()

    def mark(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())

    now = written(largest_first(edges), "links")
    seen = mark(now)
    for _ in range(max_rounds):
        if not seen[0]:
            break
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = split_join(both.filter("b > a"), least, ["a"], rows=seen[0])
        large = written(largest_first(large.select(F.col("b").alias("a"), F.col("m").alias("b"))), "star")
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = split_join(large, low, ["a"])
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).union(low.select("a", F.col("m").alias("b")))
        then = written(largest_first(small), "links")
        new = mark(then)
        now, same, seen = then, new == seen, new
        if same:
            break
    else:
        raise RuntimeError("components did not settle")
    # Settled: every edge points at its component's smallest node.
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _rooted(distinct: DataFrame, max_bits: int, max_cell: int) -> DataFrame:
    """``distinct``, one row a fingerprint ``fp``, with the ``root`` of its component."""
    roots = components(links(distinct.select("fp"), max_bits, max_cell))
    return distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def near_duplicates(docs: DataFrame, words: int = 4, max_bits: int = 4, max_cell: int = 50_000) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits) and component_id."""
    held = written(fingerprints(docs, words), "fingerprints")
    distinct = written(held.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    named = written(_rooted(distinct, max_bits, max_cell), "roots")
    smallest = named.groupBy("root").agg(F.min("least").alias("component_id"))
    of = written(split_join(named, smallest, ["root"]).select("fp", "component_id"), "components")
    return split_join(held, of, ["fp"]).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, words: int = 4, max_bits: int = 4, max_cell: int = 50_000) -> DataFrame:
    """The rows of ``docs`` that stay: of each component the smallest by doc_id (null last), then text.

    A row is known by its doc_id and a hash of its text.  Only where several texts share a component's
    smallest doc_id are texts compared.  Texts meet the list of dropped rows in one join, and
    the window that leaves one of equal rows runs on the same partitioning.
    """
    held = written(fingerprints(docs, words, hashed=True), "fingerprints")
    # The smallest doc_id with its least and its greatest hash: they differ if it has several texts.
    none, d = F.col("doc_id").isNull(), F.col("doc_id")
    distinct = held.groupBy("fp").agg(F.min(F.struct(none.alias("none"), d.alias("d"), "h")).alias("lo"),
                                      F.max(F.struct((~none).alias("some"), F.bitwise_not(d).alias("d"), "h")).alias("hi"))
    named = written(_rooted(written(distinct, "distinct"), max_bits, max_cell), "roots")
    best = named.groupBy("root").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")) \
        .select("root", F.col("lo.d").alias("d"), F.col("lo.h").alias("least"), F.col("hi.h").alias("most"))
    best = written(best, "smallest")
    tied = named.select("fp", "root").join(best.filter("least <> most").select("root", "d"), "root")
    tied = held.join(tied, "fp").filter("doc_id <=> d").select("root", "d", "h").distinct()
    tied = written(tied, "tied")
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("of"), "text")
    first = texts.join(tied, (texts["of"] == tied["h"]) & texts["id"].eqNullSafe(tied["d"])) \
        .groupBy("root").agg(F.min(F.struct("text", "h")).getField("h").alias("chosen"))
    stays = best.join(first, "root", "left").select("root", "d", F.coalesce("chosen", "least").alias("stays"))
    of = written(split_join(named.select("fp", "root"), written(stays, "stays"), ["root"]).select("fp", "d", "stays"), "chosen")
    key, null, text, nth = fresh(docs, "__key", "__null", "__text", "__nth")
    goes = split_join(held, of, ["fp"]).filter("not (doc_id <=> d and h = stays)").select(
        F.coalesce("doc_id", F.lit(0).cast("long")).alias(key), F.col("doc_id").isNull().alias(null), F.col("h").alias(text))
    keyed = docs.withColumns({key: F.coalesce(F.col("doc_id").cast("long"), F.lit(0).cast("long")),
                              null: F.col("doc_id").isNull(), text: F.xxhash64("text")})
    kept = keyed.join(goes.distinct(), [key, null, text], "left_anti")
    row = F.row_number().over(W.partitionBy(key, null, text).orderBy("text"))
    return kept.withColumn(nth, row).filter(F.col(nth) == 1).select(*docs.columns)
