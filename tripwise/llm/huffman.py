"""Token-ID files: canonical length-limited Huffman codes of ids from global counts.

Writing takes two passes.  Documents are encoded into a written table of packed ids, and each
task counts the ids it wrote; the counts of all tasks are summed; package-merge
gives the best code lengths of at most ``LIMIT`` bits, and canonical codes follow from the
lengths alone, which are the file's code book.  A file is a folder with two Parquet
tables, ``codebook`` (id, bits) and ``blocks``, so Spark commits it as a whole and a lost
executor only repeats a task.

The second pass sorts documents by doc_id within ordered buckets and encodes them.  A block
holds about ``BLOCK`` ids of whole documents in ascending doc_id order and is decoded by itself: its row has the position of its first id among all ids, its documents with
their lengths, the bit stream, and the bit offset of every ``LANE``-th id.  Decoding is
driven by a table of all ``LIMIT``-bit prefixes and runs from all checkpoints of a block at once.

Defined cases: null text counts as empty and is its end id; null doc_id comes first,
repeated ids stand in the order of their tokens; a document of any length is one block's
at most; an empty table gives an empty file; only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from tripwise.llm.common import ordered_buckets, token_memo, written
from tripwise.session import scratch_path

LIMIT, BLOCK, LANE, END_ID, ROWS_PER_BUCKET = 16, 1 << 18, 256, 2, 2000
BLOCK_SCHEMA = ("first_id long, n_ids long, doc_ids array<long>, doc_ids_count array<long>, "
                "bits binary, checkpoints binary")


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Package-merge: the lengths (0 for unused ids) of the best prefix code of at most ``limit`` bits."""
    lengths = np.zeros(len(counts), np.int64)
    used = np.flatnonzero(counts)
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << limit:
        raise ValueError(f"{len(used)} ids do not fit into codes of {limit} bits")
    used = used[np.argsort(counts[used], kind="stable")]
    coins = counts[used].astype(np.float64)
    leaf, items = [], coins[:0]
    for _ in range(limit):
        pairs = items[:len(items) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate([coins, pairs])
        order = np.argsort(both, kind="stable")
        leaf.append(order < len(coins))
        items = both[order]
    take, given = 2 * len(used) - 2, np.zeros(len(used), np.int64)
    for is_leaf in reversed(leaf):
        n = int(is_leaf[:take].sum())  # leaves are taken smallest first, so they are a prefix
        given[:n] += 1
        take = 2 * (take - n)
    lengths[used] = given
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes that ascend by (length, id)."""
    codes = np.zeros(len(lengths), np.uint32)
    code, last = 0, 0
    for n in range(1, int(lengths.max(initial=0)) + 1):
        at = np.flatnonzero(lengths == n)
        code <<= n - last
        last = n
        codes[at] = code + np.arange(len(at))
        code += len(at)
    return codes


def pack_bits(ids: np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> tuple[bytes, bytes]:
    """Bit stream (first bit highest) of the ids' codes, and the bit offset of every LANE-th id."""
    n = lengths[ids]
    ends = np.cumsum(n)
    starts = ends - n
    word, value = starts >> 5, codes[ids].astype(np.uint64) << (64 - (starts & 31) - n).astype(np.uint64)
    size = int(ends[-1] >> 5) + 2 if len(ids) else 0
    # Codes never share a bit, so sums of their halves are their unions; below 2^32 they are exact as floats.
    sums = np.bincount(word, weights=(value >> np.uint64(32)).astype(np.float64), minlength=size) \
        + np.bincount(word + 1, weights=(value & np.uint64(0xFFFFFFFF)).astype(np.float64), minlength=size)
    return sums.astype(np.uint32).astype(">u4").tobytes(), starts[::LANE].astype("<u8").tobytes()


def decode_table(lengths: np.ndarray, codes: np.ndarray, limit: int = LIMIT) -> tuple[np.ndarray, np.ndarray]:
    """Id and code length for every prefix of ``limit`` bits."""
    used = np.flatnonzero(lengths)
    used = used[np.lexsort((used, lengths[used]))]
    spans = 1 << (limit - lengths[used])
    ids, bits = np.zeros(1 << limit, np.uint32), np.ones(1 << limit, np.int64)
    n = int(spans.sum())
    ids[:n], bits[:n] = np.repeat(used, spans), np.repeat(lengths[used], spans)  # canonical: consecutive from 0
    return ids, bits


def unpack_bits(stream: bytes, checkpoints: bytes, n: int, table: tuple[np.ndarray, np.ndarray], limit: int = LIMIT) -> np.ndarray:
    """The ``n`` ids of a block: every checkpoint's lane advances by one id a step."""
    raw = np.concatenate([np.frombuffer(stream, np.uint8), np.zeros(4, np.uint8)]).astype(np.uint32)
    window = raw[:-2] << np.uint32(16) | raw[1:-1] << np.uint32(8) | raw[2:]
    at = np.frombuffer(checkpoints, "<u8").astype(np.int64)
    out, last = np.empty((len(at), LANE), np.uint32), len(window) - 1
    ids, bits = table
    for step in range(min(LANE, n)):
        prefix = window[np.minimum(at >> 3, last)] >> (24 - limit - (at & 7)).astype(np.uint32) & np.uint32((1 << limit) - 1)
        out[:, step] = ids[prefix]
        at += bits[prefix]
    return out.reshape(-1)[:n]


def encoded(docs: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """(bucket, okey, doc_id, n, ids) of every document; each task adds one row whose ``counts`` are those of its ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, end = token_memo(tokenizer, True, "<u2"), np.array([end_id], "<u2").tobytes()
        seen = np.zeros(1 << 16, np.int64)
        names = ["bucket", "okey", "doc_id", "n", "ids", "counts"]
        for batch in batches:
            ids = [x + end for x in memo.ids(batch.column(3))]
            seen += np.bincount(np.frombuffer(b"".join(ids), "<u2"), minlength=1 << 16)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array([len(x) // 2 for x in ids], pa.int64()), pa.array(ids, pa.binary()),
                 pa.nulls(len(ids), pa.binary())], names)
        if seen.any():
            used = np.flatnonzero(seen)
            none = [pa.nulls(1, t) for t in (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())]
            packed = np.stack([used, seen[used]]).astype("<i8").tobytes()
            yield pa.RecordBatch.from_arrays([*none, pa.array([packed], pa.binary())], names)

    keyed = ordered_buckets(docs.select(F.col("doc_id").cast("long"), "text"), "doc_id", ROWS_PER_BUCKET)
    return keyed.select("bucket", "okey", "doc_id", "text").mapInArrow(
        run, "bucket int, okey long, doc_id long, n long, ids binary, counts binary")


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID) -> None:
    """Encode whole texts and write a token file in ascending doc_id order."""
    spark = docs.sparkSession
    held = written(encoded(docs, tokenizer, end_id), "token-ids")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x in batch.column(0):
                used, n = np.frombuffer(x.as_buffer(), "<i8").reshape(2, -1)
                yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(n)], ["id", "n"])

    seen = held.select("counts").filter("counts is not null").mapInArrow(count, "id long, n long") \
        .groupBy("id").agg(F.sum("n").alias("n")).collect()  # 2^16 rows at most: ids are packed in two bytes
    counts = np.zeros(1 << 16, np.int64)
    for r in seen:
        counts[r.id] = r.n
    lengths = code_lengths(counts)
    codes = canonical_codes(lengths)
    held = held.filter("bucket is not null")
    upto, starts = 0, {}
    for bucket, n in sorted(tuple(r) for r in held.groupBy("bucket").agg(F.sum("n")).collect()):
        starts[bucket], upto = upto, upto + n
    spark.createDataFrame([(int(i), int(lengths[i])) for i in np.flatnonzero(lengths)], "id long, bits int") \
        .coalesce(1).write.parquet(f"{path}/codebook")
    shared = spark.sparkContext.broadcast((lengths, codes, starts))

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths, codes, starts = shared.value

        def block(first, docs, ids):
            all_ids = np.frombuffer(b"".join(ids), "<u2")
            bits, checkpoints = pack_bits(all_ids, lengths, codes)
            return pa.RecordBatch.from_arrays(
                [pa.array([first], pa.int64()), pa.array([len(all_ids)], pa.int64()), pa.array([docs], pa.list_(pa.int64())),
                 pa.array([[len(x) // 2 for x in ids]], pa.list_(pa.int64())), pa.array([bits], pa.binary()),
                 pa.array([checkpoints], pa.binary())],
                ["first_id", "n_ids", "doc_ids", "doc_ids_count", "bits", "checkpoints"])

        at, begin, upto, docs, ids = None, 0, 0, [], []
        for batch in batches:
            for bucket, doc, n, x in zip(*[batch.column(c).to_pylist() for c in range(4)]):
                if docs and (bucket != at or upto - begin >= BLOCK):
                    yield block(begin, docs, ids)
                    docs, ids = [], []
                if bucket != at:  # a task holds whole buckets, one after another
                    at, upto = bucket, starts[bucket]
                if not docs:
                    begin = upto
                docs.append(doc)
                ids.append(x)
                upto += n
        if docs:
            yield block(begin, docs, ids)

    held.select("bucket", "okey", "doc_id", "n", "ids").repartition("bucket") \
        .sortWithinPartitions("bucket", "okey", "n", "ids").select("bucket", "doc_id", "n", "ids") \
        .mapInArrow(blocks, BLOCK_SCHEMA).write.parquet(f"{path}/blocks")


def decoded(spark: SparkSession, path: str, columns: str, of: Callable[[np.ndarray], list]) -> DataFrame:
    """doc_id, start and, as ``columns``, what ``of`` makes of every document's decoded ids, in the task that decodes them."""
    book = spark.read.schema("id long, bits int").parquet(f"{path}/codebook").collect()  # 2^16 rows at most
    lengths = np.zeros(1 << 16, np.int64)
    for r in book:
        lengths[r.id] = r.bits
    shared = spark.sparkContext.broadcast(decode_table(lengths, canonical_codes(lengths)))
    schema = spark.createDataFrame([], f"doc_id long, start long, {columns}").schema
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, n, docs, counts, bits, checkpoints in zip(*[batch.column(c).to_pylist() for c in range(6)]):
                ids = unpack_bits(bits, checkpoints, n, shared.value).astype("<u4")
                ends = np.cumsum(counts)
                made = zip(*[of(ids[e - c:e]) for e, c in zip(ends, counts)])
                cols = [docs, first + ends - np.array(counts), *made]
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(cols, arrow)], schema=arrow)

    return spark.read.schema(BLOCK_SCHEMA).parquet(f"{path}/blocks").mapInArrow(run, schema)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, ids): every document of a token file, its ids packed as little-endian unsigned 32-bit integers."""
    return decoded(spark, path, "ids binary", lambda ids: [ids.tobytes()])


def round_trip(docs: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """Write a token file below the shared folder, read it back, and digest what was read."""
    path = scratch_path(docs.sparkSession, "tokens")
    write_tokens(docs, path, tokenizer, end_id)
    return decoded(docs.sparkSession, path, "n_tokens long, ids_crc32 long", lambda ids: [len(ids), zlib.crc32(ids)])
