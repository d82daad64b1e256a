"""Packing: first-fit decreasing with a tournament tree of bin capacities, in randomised groups.

A document's ids (with the end id) are cut into pieces of at most ``capacity``; full
pieces are sequences of their own, and what is left of each document is packed.  Pieces are
dealt into groups of about ``GROUP`` by a hash, so no group grows with the data or with one
source, and every group is packed by itself: pieces by falling length, each into the first bin
with room.  The bin is found by descending a tree whose nodes hold the largest free
capacity below them.

Only piece lengths and checksums are shuffled, never ids or texts.

Defined cases: null text counts as empty, and an empty document is its end id; a
document of any length is cut; repeated rows are packed each; ties of length keep
the order of (doc_id, start, salt); an empty table gives an empty table; only ``doc_id`` and
``text`` are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripwise.llm.common import token_memo, written

CAPACITY, END_ID, GROUP = 2048, 1, 4096
PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, salt long"


def first_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of every piece."""
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    leaves = 1
    while leaves < len(lengths):
        leaves *= 2
    free = [capacity] * (2 * leaves)  # node i has the children 2i and 2i + 1; leaves are the bins in order
    for i in np.argsort(-lengths, kind="stable").tolist():
        need, node = int(lengths[i]), 1
        while node < leaves:
            node *= 2
            if free[node] < need:
                node += 1
        bins[i], offsets[i] = node - leaves, capacity - free[node]
        free[node] -= need
        while node > 1:
            node //= 2
            best = max(free[2 * node], free[2 * node + 1])
            if free[node] == best:
                break
            free[node] = best
    return bins, offsets


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Pieces of all documents with their checksums."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, end, salt = token_memo(tokenizer, False, "<u2"), np.array([end_id], "<u4"), 0
        for batch in batches:
            out = []
            for doc, packed in zip(batch.column(0).to_pylist(), memo.ids(batch.column(1))):
                ids = np.concatenate([np.frombuffer(packed, "<u2").astype("<u4"), end])
                for at in range(0, len(ids), capacity):
                    piece = ids[at:at + capacity]
                    salt += 1
                    out.append((doc, at, len(piece), zlib.crc32(piece.tobytes()), len(ids), salt))
            cols = list(zip(*out)) or [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols],
                                             ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "salt"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, PIECE)


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, group: int = GROUP) -> DataFrame:
    """Every piece with its sequence and its offset there; a sequence's id is its group's number times 2^32 plus its bin."""
    cut = written(pieces(docs, tokenizer, capacity, end_id), "pieces")
    groups = max(1, -(-cut.count() // group))
    dealt = cut.withColumn("group", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32", "salt"), F.lit(groups)))

    def run(part: pa.Table) -> pa.Table:  # Arrow keeps ids as integers beside null ones
        part = part.take(pc.sort_indices(part, [(c, "ascending") for c in ("doc_id", "start", "salt")], null_placement="at_start"))
        bins, offsets = first_fit_decreasing(part["length"].to_numpy(), capacity)
        sequence = part["group"].to_numpy() * (1 << 32) + bins
        return part.drop_columns(["group", "salt"]).append_column("sequence_id", pa.array(sequence)) \
            .append_column("offset", pa.array(offsets))

    return dealt.groupBy("group").applyInArrow(
        run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
