"""Regression trees and forests from mergeable histograms.

Thresholds.  A feature's candidate thresholds are its quantiles i / bins over the training rows, from one
bounded sketch a feature; ``x <= threshold`` goes left.  A row's bin is the number of thresholds below it.

Splits.  For every (tree, node, feature, bin) the weight and the weighted label sum are additive, so tasks send partial
histograms that a group-by on (tree, node) adds up; the task that adds them searches the best split: the largest fall
of squared error, ties to the first feature, then the smallest threshold.  A node with at most ``LOCAL`` rows is finished
where its rows meet: tasks send the rows as packed bins instead, and the whole subtree grows there by the same
search.  What reaches the driver is tree-sized.

Whole trees.  The trees of a large forest over rows that a task can hold (``HELD``) are dealt to the tasks instead: each reads
all stored ranks itself and grows its trees from end to end, so that no row is sent.  Rows are records of weight, weighted label and
bins, moved to their node at each split: a node's rows lie together, and what is below a small node stays in the cache.

Randomness has no state.  A row's bootstrap weight in tree t is a Poisson number hashed from (seed, t, row); the features
a node may use are those with the smallest hashes of (seed, t, node, feature).  So a tree depends on its number
alone: the first n trees of a forest are the forest of n trees, and a tree cut at depth d is the tree of
depth d.  One forest a bin count holds every size and depth of a grid; tree 0 sees every row once and all features and
is the forest of one tree (and the plain decision tree).

Nodes are numbered as in a heap: the root is 1, the children of i are 2i (left) and 2i + 1.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripwise.session import compiled_methods, spread, stored

LOCAL = 200_000              # rows of a node that is finished in one task
HISTOGRAMS = 64 << 20        # bytes of histograms a task holds in one pass
SLOTS = 1 << 21              # histogram cells held at once
SCANNED = 1 << 14            # histogram cells searched at once
SENT = 16 << 20              # bytes of packed rows that a task sends at once
HELD = 256 << 20             # bytes of training rows that a task holds to grow whole trees
STORED = 2048                # rows of a stored block of ranks
BLOCK = 8192                 # records that are counted or moved at once: they stay in a core's cache
FEW = 8192                   # records of a node whose subtree grows a level at a time
TOP = 4                      # levels of a tree that are walked by comparing whole columns
ACCURACY = 100_000           # of the quantile sketches: ranks are off by a hundred-thousandth of the rows at most
SKETCHES = 5                 # features sketched in one pass: a sketch of so many ranks takes tens of megabytes a task
ROW = "__row"

#: Cumulative Poisson(1) probabilities.
POISSON = np.cumsum([np.exp(-1.0) / f for f in (1, 1, 2, 6, 24, 120, 720, 5040, 40320, 362880)])


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of the result depends on every bit of x."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _hashed(*parts) -> np.ndarray:
    h = np.zeros(1, np.uint64)
    for p in parts:
        h = _mix(h * np.uint64(0x9E3779B97F4A7C15) + np.asarray(p, np.int64).astype(np.uint64) + np.uint64(1))
    return h


def weights(rows: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """How often each row is drawn for a tree; once for tree 0."""
    if tree == 0:
        return np.ones(len(rows))
    u = (_hashed(seed, tree, rows) >> np.uint64(11)).astype(float) / (1 << 53)
    drawn = (u >= POISSON[0]).astype(float)
    more = np.flatnonzero(u >= POISSON[1])
    for p in POISSON[2:]:
        drawn[more] += 1
        more = more[u[more] >= p]
    drawn[more] += 1
    return drawn


def allowed(tree: int, nodes: np.ndarray, features: int, seed: int) -> np.ndarray:
    """Which features each node may split on: all in tree 0, else a third (rounded up)."""
    if tree == 0:
        return np.ones((len(nodes), features), bool)
    h = _hashed(seed + 1, tree, np.asarray(nodes)[:, None], np.arange(features)[None, :])
    out = np.zeros(h.shape, bool)
    np.put_along_axis(out, np.argsort(h, axis=1, kind="stable")[:, :-(-features // 3)], True, axis=1)
    return out


def thresholds(train: DataFrame, features: Sequence[str], bins: Sequence[int]) -> dict[int, list[np.ndarray]]:
    """{bin count: sorted different thresholds of each feature}, one sketch a feature for all bin counts."""
    probs = sorted({i / b for b in bins for i in range(1, b)})
    value: dict[str, dict[float, float]] = {}
    for at in range(0, len(features), SKETCHES):
        some = features[at:at + SKETCHES]
        row = train.agg(*[F.percentile_approx(f, probs, ACCURACY).alias(f) for f in some]).first()
        value |= {f: dict(zip(probs, row[f] or [])) for f in some}
    return {b: [np.unique([value[f][i / b] for i in range(1, b)] if value[f] else []).astype(float) for f in features]
            for b in bins}


def _bins(x: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    return np.column_stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(cuts)]).astype(np.uint16)


@dataclass
class Ranked:
    """Rows of both halves as ranks among ``every`` threshold."""
    rows: DataFrame
    every: list[np.ndarray]


BLOCKS = "ranks binary, labels binary, numbers binary, held int, is_train boolean"


def ranked(rows: DataFrame, features: Sequence[str], label: str, cuts: dict[int, list[np.ndarray]]) -> Ranked:
    """Rows (of ``numbered``) for ``fit`` and ``errors``, stored once for all bin counts and passes: each row's bins among the
    thresholds of all bin counts together (``ranks``, 16 bits a feature), label and row number.  A stored row is a block of
    up to ``STORED`` rows of one half as bytes, so that a task reads them as fast as they can be copied."""
    m, every = len(features), every_threshold(cuts)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ranks = _bins(_matrix(batch, m), every) if batch.num_rows else np.empty((0, m), np.uint16)
            y, row = batch.column(m).to_numpy(), batch.column(m + 1).to_numpy()
            half = batch.column(m + 2).to_numpy(zero_copy_only=False)
            blocks = [(of[a:a + STORED], flag) for flag in (True, False) for of in [np.flatnonzero(half == flag)]
                      for a in range(0, len(of), STORED)]
            cols = [pa.array([x[of].tobytes() for of, _ in blocks], pa.binary()) for x in (ranks, y, row)]
            yield pa.RecordBatch.from_arrays([*cols, pa.array([len(of) for of, _ in blocks], pa.int32()),
                                              pa.array([flag for _, flag in blocks], pa.bool_())],
                                             ["ranks", "labels", "numbers", "held", "is_train"])

    blocks = rows.select(*features, label, ROW, "is_train").mapInArrow(work, BLOCKS)
    return Ranked(stored(blocks.repartition(2 * blocks.sparkSession.sparkContext.defaultParallelism), "ranked-rows"), every)


def every_threshold(cuts: dict[int, list[np.ndarray]]) -> list[np.ndarray]:
    """Thresholds of each feature, of all bin counts together."""
    return [np.unique(np.concatenate(of)) for of in zip(*cuts.values())]


def _tables(cuts: list[np.ndarray], every: list[np.ndarray]) -> list[np.ndarray]:
    """The bin among ``cuts`` of each rank among ``every``: how many of the cuts are among the first so many."""
    return [np.concatenate([[0], np.cumsum(np.isin(e, c))]).astype(np.uint16) for c, e in zip(cuts, every)]


def _pieces(batches: Iterator[pa.RecordBatch], m: int, cuts: list[np.ndarray], tables: list[np.ndarray] | None) -> Iterator[tuple]:
    """Bins, labels and the column after them (row numbers; ``is_train`` for ``errors``) of the rows of ``numbered``, or (with
    ``tables``) of the blocks of ``ranked``, brought together to ``BLOCK`` rows or more."""
    held, rows = [], 0
    for batch in batches:
        if tables is None:
            if batch.num_rows:
                yield _bins(_matrix(batch, m), cuts), batch.column(m).to_numpy(), batch.column(m + 1).to_numpy(zero_copy_only=False)
            continue
        for i in range(batch.num_rows):
            ranks, y, last = (c[i] for c in batch.columns)
            at = np.frombuffer(ranks.as_buffer(), np.uint16).reshape(-1, m)
            last = np.frombuffer(last.as_buffer(), np.int64) if pa.types.is_binary(last.type) else np.full(len(at), last.as_py())
            held.append((np.column_stack([table.take(at[:, f]) for f, table in enumerate(tables)]), np.frombuffer(y.as_buffer()), last))
            if (rows := rows + len(at)) >= BLOCK:
                yield tuple(map(np.concatenate, zip(*held)))
                held, rows = [], 0
    if held:
        yield tuple(map(np.concatenate, zip(*held)))


def _scan(n: np.ndarray, s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Best fall of squared error and its bin for every row of histograms (nodes x bins)."""
    best, where, step = np.empty(len(n)), np.empty(len(n), np.int64), max(1, SCANNED // n.shape[1])
    for a in range(0, len(n), step):
        left_n, left_s = np.cumsum(n[a:a + step], axis=1), np.cumsum(s[a:a + step], axis=1)
        all_n, all_s = left_n[:, -1:], left_s[:, -1:]
        right_n, right_s = all_n - left_n, all_s - left_s
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = left_s ** 2 / left_n + right_s ** 2 / right_n - all_s ** 2 / all_n
        gain[(left_n <= 0) | (right_n <= 0)] = 0
        where[a:a + step] = at = gain.argmax(axis=1)
        best[a:a + step] = gain[np.arange(len(at)), at]
    return best, where


def grow(bins: np.ndarray, y: np.ndarray, w: np.ndarray, root: int, max_depth: int, tree: int, seed: int,
         width: int) -> list[tuple[int, float, float, int, int]]:
    """Nodes (number, weight, label sum, feature or -1, bin) of the subtree below ``root`` over the given rows."""
    return _grow(bins, w * y, w, root, max_depth, tree, seed, width)


def _grow(bins: np.ndarray, wy: np.ndarray, w: np.ndarray, root: int, max_depth: int, tree: int, seed: int,
          width: int) -> list[tuple[int, float, float, int, int]]:
    out: list[tuple[int, float, float, int, int]] = []
    nodes, slot, m = np.array([root]), np.zeros(len(wy), np.int64), bins.shape[1]
    for depth in range(root.bit_length() - 1, max_depth + 1):
        n, s = np.bincount(slot, w, len(nodes)), np.bincount(slot, wy, len(nodes))
        best, feature, cut = np.zeros(len(nodes)), np.full(len(nodes), -1), np.zeros(len(nodes), np.int64)
        if depth < max_depth:
            may = allowed(tree, nodes, m, seed)
            which = np.nonzero(may)[1].reshape(len(nodes), -1)  # as many features in each node, in ascending order
            flat, start, tries = bins.ravel(), np.arange(len(slot)) * m, which.shape[1]
            for a in range(0, len(nodes), max(1, SLOTS // (width * tries))):
                b = min(len(nodes), a + max(1, SLOTS // (width * tries)))
                inside = slice(None) if b - a == len(nodes) else np.flatnonzero((slot >= a) & (slot < b))
                at_slot, at_start, at_w, at_wy = slot[inside], start[inside], w[inside], wy[inside]
                base, size, sums = (at_slot - a) * width, (b - a) * width, np.empty((2, b - a, tries, width))
                for j in range(tries):
                    key = which[:, j].take(at_slot)
                    key += at_start
                    key = base + flat.take(key)
                    for of, x in zip(sums, (at_w, at_wy)):
                        of[:, j] = np.bincount(key, x, size).reshape(-1, width)
                gain, at = (x.reshape(-1, tries) for x in _scan(*sums.reshape(2, -1, width)))
                j, row = np.where(np.isnan(gain), -np.inf, gain).argmax(axis=1), np.arange(b - a)
                more = np.flatnonzero(gain[row, j] > 0)
                best[a + more], feature[a + more], cut[a + more] = gain[more, j[more]], which[a + more, j[more]], at[more, j[more]]
            feature[best <= 1e-12 * np.maximum(1, s * s / np.maximum(n, 1))] = -1
        out += zip(nodes.tolist(), n.tolist(), s.tolist(), feature.tolist(), cut.tolist())
        split = feature >= 0
        if not split.any():
            break
        keep = split[slot]
        if not keep.all():
            bins, wy, w, slot = bins[keep], wy[keep], w[keep], slot[keep]
        place = np.cumsum(split) - 1
        right = bins[np.arange(len(slot)), feature[slot]] > cut[slot]
        slot = 2 * place[slot] + right
        nodes = np.repeat(nodes[split], 2) * 2 + np.tile([0, 1], int(split.sum()))
    return out


class Records:
    """Training rows that a task holds, and the trees it grows of them.  A record is the weight, the weighted label and the bins,
    padded to words.  Where labels are whole numbers of a bounded size, weight and label share a double (``weight *
    UNIT + sum``): sums over ``BLOCK`` records stay below 2^53, so one histogram holds both exactly.  Else they are a complex number."""

    def __init__(self, rows: int, features: int, width: int):
        self.m, self.width, self.code = features, width, _code(width)
        self.bins = np.zeros((rows, record_bytes(features, width) // 8 - 2), np.uint64)
        self.y, self.row, self.rows, self.shared = np.empty(rows), np.empty(rows, np.int64), 0, True

    def add(self, bins: np.ndarray, y: np.ndarray, row: np.ndarray) -> None:
        a, b = self.rows, self.rows + len(y)
        self.bins.view(self.code)[a:b, :self.m] = bins
        self.y[a:b], self.row[a:b], self.rows = y, row, b
        self.shared = self.shared and bool(((np.abs(y) < UNIT / 2 / BLOCK / len(POISSON)) & (y == np.rint(y))).all())

    def drawn(self, tree: int, seed: int) -> np.ndarray:
        """Records of the rows that are drawn for a tree; the last tree's are overwritten."""
        self.head = 1 if self.shared else 2
        if not hasattr(self, "space"):
            self.space = [np.empty((self.rows, self.head + self.bins.shape[1]), np.uint64) for _ in range(2)]
        n = 0
        for a in range(0, self.rows, BLOCK):
            w = weights(self.row[a:a + BLOCK], tree, seed)
            of = np.flatnonzero(w)
            to, w, y = self.space[0][n:n + len(of)], w[of], self.y[a:a + BLOCK].take(of)
            for i, x in enumerate([w * (UNIT + y)] if self.shared else [w, w * y]):
                to[:, i] = x.view(np.uint64)
            to[:, self.head:] = self.bins[a:a + BLOCK].take(of, axis=0)
            n += len(of)
        return self.space[0][:n]

    def codes(self, records: np.ndarray) -> np.ndarray:
        return records[:, self.head:].view(self.code)[:, :self.m]

    def drawn_labels(self, records: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Weight and weighted label of every record."""
        heads = [np.ascontiguousarray(records[:, i]).view(float) for i in range(self.head)]
        return _parted(heads[0]) if self.shared else tuple(heads)

    def histograms(self, records: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Weight and weighted label sum of every bin of the features ``which``."""
        n, s = np.zeros((2, len(which), self.width))
        for a in range(0, len(records), BLOCK):
            block = records[a:a + BLOCK]
            codes, heads = self.codes(block), np.ascontiguousarray(block[:, :self.head])
            if self.shared:
                of, heads = np.empty(n.shape), heads.view(float)[:, 0]
                for j, f in enumerate(which):
                    of[j] = np.bincount(codes[:, f].astype(np.intp), heads, self.width)
                block_n, block_s = _parted(of)
            else:
                of, heads = np.zeros(n.shape, complex), heads.view(complex)[:, 0]
                for j, f in enumerate(which):
                    np.add.at(of[j], codes[:, f].astype(np.intp), heads)
                block_n, block_s = of.real, of.imag
            n += block_n
            s += block_s
        return n, s

    def halve(self, records: np.ndarray, feature: int, cut: int) -> tuple[np.ndarray, np.ndarray]:
        """Records left and right of a split, in their own place: each half in its order."""
        left, right, aside = 0, 0, self.space[1]
        for a in range(0, len(records), BLOCK):
            block = records[a:a + BLOCK]
            over = self.codes(block)[:, feature] > cut
            of = np.flatnonzero(over)
            block.take(of, axis=0, out=aside[right:right + len(of)], mode="clip")
            right += len(of)
            of = np.flatnonzero(~over)
            block.take(of, axis=0, out=records[left:left + len(of)], mode="clip")
            left += len(of)
        records[left:] = aside[:right]
        return records[:left], records[left:]

    def grow(self, tree: int, max_depth: int, seed: int) -> list[tuple[int, float, float, int, int]]:
        """Nodes of a whole tree, as ``grow`` gives them."""
        out: list[tuple[int, float, float, int, int]] = []
        early = allowed(tree, np.arange(1 << min(max_depth, 12)), self.m, seed)
        waiting = [(1, self.drawn(tree, seed))]
        while waiting:
            node, records = waiting.pop()
            if len(records) <= FEW or node.bit_length() > max_depth:
                if len(records):
                    w, wy = self.drawn_labels(records)
                    out += _grow(np.ascontiguousarray(self.codes(records)), wy, w, node, max_depth, tree, seed, self.width)
                continue
            which = np.flatnonzero(early[node] if node < len(early) else allowed(tree, np.array([node]), self.m, seed)[0])
            n, s = self.histograms(records, which)
            n0, s0 = float(n[0].sum()), float(s[0].sum())
            gain, at = _scan(n, s)
            best = int(gain.argmax())
            if not gain[best] > 1e-12 * max(1, s0 * s0 / n0):
                out.append((node, n0, s0, -1, 0))
                continue
            feature, cut = int(which[best]), int(at[best])
            out.append((node, n0, s0, feature, cut))
            if node.bit_length() == max_depth:  # the children are leaves: their sums are known
                ln, ls = float(n[best, :cut + 1].sum()), float(s[best, :cut + 1].sum())
                out += [(2 * node, ln, ls, -1, 0), (2 * node + 1, n0 - ln, s0 - ls, -1, 0)]
                continue
            left, right = self.halve(records, feature, cut)
            waiting += [(2 * node + 1, right), (2 * node, left)]
        return out


#: A weight's place in a double that it shares with a weighted label sum: sums of ``BLOCK`` weights fit above it.
UNIT = 2.0 ** (53 - (BLOCK * len(POISSON)).bit_length())


def _parted(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weight and weighted label sum of doubles that hold both."""
    w = np.rint(x / UNIT)
    return w, x - w * UNIT


def _code(width: int) -> type:
    return np.uint8 if width <= 256 else np.uint16


def record_bytes(features: int, width: int) -> int:
    """Size of a record: two numbers and the bins, in words."""
    return 16 + -(-features * _code(width)().itemsize // 8) * 8


def _dealt(trees: Sequence[int], features: int, parts: int) -> list[list[int]]:
    """Trees in parts of about equal work: tree 0 sees all rows and features, the others draw 63 % and a third."""
    out, work = [[] for _ in range(min(parts, len(trees)))], [0.0] * min(parts, len(trees))
    for t in sorted(trees):
        i = work.index(min(work))
        out[i].append(t)
        work[i] += 1 if t else features / -(-features // 3) / 0.63
    return out


def _whole_trees(train: DataFrame, total: int, pieces, m: int, trees: Sequence[int], max_depth: int, seed: int, width: int) -> pa.Table:
    """Trees grown from end to end, some in each task.  Every task reads all of ``train`` (stored ranks, labels, row numbers)."""
    spark = train.sparkSession
    parts = _dealt(trees, m, spark.sparkContext.defaultParallelism)

    def work(mine: list[int]):
        def grown(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = Records(total, m, width)
            for piece in pieces(batches):
                held.add(*piece)
            for t in mine:
                cols = list(zip(*held.grow(t, max_depth, seed))) or [()] * 5
                arrays = [pa.array([t] * len(cols[0]), pa.int32()), *(pa.array(c, f.type) for c, f in zip(cols, list(NODE_TYPES)[1:]))]
                yield pa.RecordBatch.from_arrays(arrays, schema=NODE_TYPES)
        return grown

    one = train.coalesce(1)
    with ThreadPoolExecutor(len(parts)) as pool:
        return pa.concat_tables(pool.map(lambda mine: one.mapInArrow(work(mine), NODES).toArrow(), parts))


NODES = "tree int, node long, n double, s double, feature int, cut int"


@dataclass
class Forest:
    """Trees 0..n of one bin count and depth, as arrays over (tree, node), with the thresholds of the features."""
    features: list[str]
    cuts: list[np.ndarray]
    max_depth: int
    nodes: dict[int, dict[int, tuple[float, float, int, int]]] = field(default_factory=dict)

    def flat(self, tree: int, depth: int | None = None) -> "FlatTree":
        """Pointer arrays of a tree, cut at ``depth``."""
        of, depth = self.nodes.get(tree, {}), self.max_depth if depth is None else depth
        order, place = [], {}
        stack = [1] if 1 in of else []
        while stack:  # parents before children, left first
            i = stack.pop()
            place[i] = len(order)
            order.append(i)
            if of[i][2] >= 0 and i.bit_length() <= depth:
                stack += [2 * i + 1, 2 * i]
        inner = [of[i][2] >= 0 and i.bit_length() <= depth for i in order]
        at = lambda i, ok: place[i] if ok else -1
        return FlatTree(np.array([of[i][2] if ok else -1 for i, ok in zip(order, inner)], np.int64),
                        np.array([self.cuts[of[i][2]][of[i][3]] if ok else 0.0 for i, ok in zip(order, inner)]),
                        np.array([at(2 * i, ok) for i, ok in zip(order, inner)], np.int64),
                        np.array([at(2 * i + 1, ok) for i, ok in zip(order, inner)], np.int64),
                        np.array([of[i][1] / of[i][0] for i in order]))

    def model(self, trees: int, depth: int) -> "TreeModel":
        """The forest of ``trees`` trees cut at ``depth``."""
        numbers = [0] if trees == 1 else range(1, trees + 1)
        return TreeModel(list(self.features), [self.flat(t, depth) for t in numbers])


@dataclass
class FlatTree:
    """feature (-1 in a leaf), threshold, left, right and mean label of each node; node 0 is the root."""
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """The leaf of every row of x, by walking all rows a level at a time."""
        at = np.zeros(len(x), np.int64)
        live = np.flatnonzero(self.feature[at] >= 0) if len(self.feature) else np.empty(0, np.int64)
        while len(live):
            here = at[live]
            down = x[live, self.feature[here]] <= self.threshold[here]
            at[live] = np.where(down, self.left[here], self.right[here])
            live = live[self.feature[at[live]] >= 0]
        return at

    def printed(self, pad: str = "  ") -> list[str]:
        lines, stack = [], [(0, 1, "")]
        while stack:
            i, depth, head = stack.pop()
            if head:
                lines.append(pad * depth + head)
                depth += 1
            if self.feature[i] < 0:
                lines.append(f"{pad * depth}Predict: {float(self.value[i])!r}")
                continue
            test = f"(feature {self.feature[i]} %s {float(self.threshold[i])!r})"
            lines.append(f"{pad * depth}If {test % '<='}")
            stack += [(int(self.right[i]), depth, f"Else {test % '>'}"), (int(self.left[i]), depth + 1, "")]
        return lines


_LINE = re.compile(r"^( *)(?:(If|Else) \(feature (\d+) (<=|>) ([^)]+)\)|Predict: (\S+))\s*$")


def parse_printed(text: str) -> list[FlatTree]:
    """Trees of the printed form (``If``, ``Else`` and ``Predict`` lines, indented by depth); other lines begin a tree."""
    trees: list[list[tuple]] = []
    fresh = True
    for line in text.splitlines():
        m = _LINE.match(line)
        if not m:
            fresh = True
            continue
        if fresh:
            trees.append([])
            fresh = False
        if m.group(2) != "Else":
            trees[-1].append((int(m.group(3)), float(m.group(5)), None) if m.group(2) else (-1, 0.0, float(m.group(6))))
    out = []
    for rows in trees:
        left, right = [-1] * len(rows), [-1] * len(rows)
        waiting: list[int] = []  # inner nodes whose right child has not come yet; lines are left first
        for i, (f, _, _) in enumerate(rows):
            if i and rows[i - 1][0] >= 0:
                left[i - 1] = i
            elif i:
                right[waiting.pop()] = i
            if f >= 0:
                waiting.append(i)
        if waiting:
            raise ValueError("a printed tree ends before its last branch")
        out.append(FlatTree(np.array([r[0] for r in rows]), np.array([r[1] for r in rows]), np.array(left), np.array(right),
                            np.array([np.nan if r[2] is None else r[2] for r in rows])))
    return out


@dataclass
class TreeModel:
    """One tree or the mean of several, scored a batch at a time."""
    features: list[str]
    trees: list[FlatTree]

    @property
    def depth(self) -> int:
        """Levels below the root of the deepest tree."""
        deepest = 0
        for t in self.trees:
            level = np.zeros(len(t.feature), np.int64)
            for i in np.flatnonzero(t.feature >= 0):  # parents come before their children
                level[t.left[i]] = level[t.right[i]] = level[i] + 1
            deepest = max(deepest, int(level.max(initial=0)))
        return deepest

    @property
    def toDebugString(self) -> str:
        lines = [f"TreeModel of {len(self.trees)} trees"]
        for i, t in enumerate(self.trees):
            lines += [f"Tree {i}", *t.printed()]
        return "\n".join(lines) + "\n"

    def predict_col(self, spark: SparkSession) -> Column:
        shared = spark.sparkContext.broadcast(self.trees)

        @F.pandas_udf("double")  # not of iterators: several models in one projection share a worker
        def score(*batch: pd.Series) -> pd.Series:
            trees, x = shared.value, np.column_stack([c.to_numpy(float) for c in batch])
            return pd.Series(sum(t.value[t.leaves(x)] for t in trees) / len(trees))

        return score(*[F.col(f).cast("double") for f in self.features])

    def transform(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        return df.withColumn(out, self.predict_col(df.sparkSession))

    def save(self, spark: SparkSession, path: str) -> None:
        rows = [(i, j, int(t.feature[j]), float(t.threshold[j]), int(t.left[j]), int(t.right[j]), float(t.value[j]))
                for i, t in enumerate(self.trees) for j in range(len(t.feature))]
        table = spark.createDataFrame(rows, "tree int, node int, feature int, threshold double, left int, right int, value double")
        table.withColumn("features", F.lit(json.dumps(self.features))).coalesce(1).write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> "TreeModel":
        rows = spark.read.parquet(path).orderBy("tree", "node").toPandas()
        trees = [FlatTree(g["feature"].to_numpy(np.int64), g["threshold"].to_numpy(float), g["left"].to_numpy(np.int64),
                          g["right"].to_numpy(np.int64), g["value"].to_numpy(float)) for _, g in rows.groupby("tree")]
        return TreeModel(json.loads(rows["features"].iloc[0]), trees)


def numbered(df: DataFrame, features: Sequence[str], label: str, path: str | None = None) -> DataFrame:
    """Features, label, ``is_train`` and a row number, stored once (at ``path`` if given) and dealt over all cores: draws of a
    row are the same in every pass."""
    cols = [F.col(f).cast("double").alias(f) for f in features]
    rows = df.select(*cols, F.col(label).cast("double").alias(label), "is_train", F.monotonically_increasing_id().alias(ROW))
    with compiled_methods(df.sparkSession):  # features of a trip are more code than HotSpot compiles in one method
        return stored(spread(rows, ROW), "training-rows", path)


def _matrix(batch: pa.RecordBatch, features: int) -> np.ndarray:
    return np.column_stack([batch.column(i).to_numpy() for i in range(features)]) if batch.num_rows else np.empty((0, features))


def fit(rows: DataFrame | Ranked, features: Sequence[str], label: str, trees: Sequence[int], max_depth: int,
        cuts: list[np.ndarray], seed: int, local: int = LOCAL) -> Forest:
    """The trees of the given numbers over the training rows of ``rows`` (from ``numbered``).  A grid gives them as
    ranks (from ``ranked``), which spares each pass the search for bins."""
    features, m, width = list(features), len(features), max([len(c) for c in cuts], default=0) + 1
    forest = Forest(features, cuts, max_depth, {t: {} for t in trees})
    of_ranks = isinstance(rows, Ranked)
    train = (rows.rows if of_ranks else rows).where("is_train")
    spark, total = train.sparkSession, train.agg(F.sum("held") if of_ranks else F.count("*")).first()[0] or 0
    train = train.select("ranks", "labels", "numbers") if of_ranks else train.select(*features, label, ROW)
    tables = _tables(cuts, rows.every) if of_ranks else None
    todo = {(t, 1): float(total) for t in trees} if total else {}

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        return _pieces(batches, m, cuts, tables)

    if of_ranks and todo and 2 * len(trees) >= spark.sparkContext.defaultParallelism \
            and total * record_bytes(m, width) <= HELD:
        found = _whole_trees(train, total, pieces, m, trees, max_depth, seed, width)
        for t, i, *node in zip(*[c.to_numpy().tolist() for c in found.columns]):
            forest.nodes[t][i] = tuple(node)
        return forest

    while todo:
        small = {key for key, n in todo.items() if n <= local}
        large = sorted(set(todo) - small)[:max(1, HISTOGRAMS // (m * width * 16))]
        asked = sorted(small) + large
        shared = spark.sparkContext.broadcast((forest.nodes, set(asked), small))

        def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            grown, wanted, few = shared.value
            by_tree: dict[int, list[int]] = {}
            for t, node in sorted(wanted):
                by_tree.setdefault(t, []).append(node)
            large = {t: [node for node in nodes if (t, node) not in few] for t, nodes in by_tree.items()}
            sums = {t: np.zeros((2, m, len(nodes) * width)) for t, nodes in large.items() if nodes}
            for bins, y, row in pieces(batches):
                out, held = [], 0
                for t, nodes in by_tree.items():
                    w = weights(row, t, seed)
                    at = np.where(w > 0, _route(grown[t], bins), 0)
                    if t in sums:
                        place = np.searchsorted(large[t], at)
                        of = np.flatnonzero(np.take(large[t], place, mode="clip") == at)
                        base, w_of, size = place[of] * width, w[of], len(large[t]) * width
                        wy = w_of * y[of]
                        for f in range(m):
                            key = base + bins[of, f]
                            sums[t][0, f] += np.bincount(key, w_of, size)
                            sums[t][1, f] += np.bincount(key, wy, size)
                    nodes = [node for node in nodes if (t, node) in few]
                    if not nodes:
                        continue
                    order = np.argsort(at, kind="stable")
                    edges = np.searchsorted(at[order], nodes)
                    ends = np.searchsorted(at[order], nodes, "right")
                    for node, begin, end in zip(nodes, edges, ends):
                        of = order[begin:end]
                        if len(of):
                            out.append((t, node, bins[of].tobytes(), y[of].tobytes(), w[of].tobytes()))
                            held += len(of) * (2 * m + 16)
                    if held > SENT:
                        yield _blobs(out)
                        out, held = [], 0
                yield _blobs(out)
            for t, s in sums.items():
                s = s.reshape(2, m, -1, width)
                for j, node in enumerate(large[t]):
                    if s[0, :, j].any():
                        yield _blobs([(t, node, None, s[1, :, j].tobytes(), s[0, :, j].tobytes())])

        def search(part: pa.Table) -> pa.Table:
            t, node = part["tree"][0].as_py(), part["node"][0].as_py()
            a, b, c = (part[x].to_pylist() for x in ("bins", "y", "w"))
            if a[0] is not None:
                got = grow(np.frombuffer(b"".join(a), np.uint16).reshape(-1, m), np.frombuffer(b"".join(b)),
                           np.frombuffer(b"".join(c)), node, max_depth, t, seed, width)
            else:
                s, n = (sum(np.frombuffer(x) for x in blobs).reshape(m, width) for blobs in (b, c))
                n0, s0 = float(n[0].sum()), float(s[0].sum())
                gain, at = _scan(n, s)
                gain[~allowed(t, np.array([node]), m, seed)[0]] = 0
                f = int(gain.argmax()) if node.bit_length() <= max_depth and gain.max() > 1e-12 * max(1, s0 * s0 / n0) else -1
                got = [(node, n0, s0, f, int(at[f]) if f >= 0 else 0)]
                if f >= 0:  # the children's sums: they need no pass of their own to be leaves
                    ln, ls = float(n[f, :at[f] + 1].sum()), float(s[f, :at[f] + 1].sum())
                    got += [(2 * node, ln, ls, -2, 0), (2 * node + 1, n0 - ln, s0 - ls, -2, 0)]
            return pa.Table.from_pylist([dict(tree=t, node=i, n=n, s=s, feature=f, cut=k) for i, n, s, f, k in got], NODE_TYPES)

        found = train.mapInArrow(send, "tree int, node long, bins binary, y binary, w binary") \
            .groupBy("tree", "node").applyInArrow(search, NODES).toArrow()
        for key in asked:
            todo.pop(key)
        for t, i, n, s, f, k in zip(*[found[c].to_pylist() for c in ("tree", "node", "n", "s", "feature", "cut")]):
            if f == -2 and i.bit_length() <= max_depth:
                todo[t, i] = n
            forest.nodes[t][i] = (n, s, max(f, -1), k)
    return forest


NODE_TYPES = pa.schema([("tree", pa.int32()), ("node", pa.int64()), ("n", pa.float64()), ("s", pa.float64()),
                        ("feature", pa.int32()), ("cut", pa.int32())])


def _blobs(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [()] * 5
    types = (pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], ["tree", "node", "bins", "y", "w"])


def _route(nodes: dict[int, tuple], bins: np.ndarray) -> np.ndarray:
    """The deepest grown node of every row."""
    at = np.ones(len(bins), np.int64)
    if not nodes:
        return at
    size = max(nodes) + 1
    feature, cut = np.full(size, -1), np.zeros(size, np.int64)
    for i, (_, _, f, k) in nodes.items():
        feature[i], cut[i] = f, k
    live = np.flatnonzero(feature[at] >= 0)
    while len(live):
        here = at[live]
        at[live] = 2 * here + (bins[live, feature[here]] > cut[here])
        live = live[feature[at[live]] >= 0]
    return at


ERRORS = "trees int, depth int, is_train boolean, sse double, n long"


def errors(rows: DataFrame | Ranked, forest: Forest, label: str, sizes: Sequence[int], depths: Sequence[int]) -> dict:
    """{(trees, depth): (train MSE, test MSE)} for every size and depth in one pass: running means over the trees."""
    m, sizes, depths = len(forest.features), sorted(sizes), sorted(depths)
    numbers = ([0] if 1 in sizes else []) + list(range(1, max(sizes) + 1 if max(sizes) > 1 else 1))
    of_ranks, cuts = isinstance(rows, Ranked), forest.cuts
    table, tables = (rows.rows, _tables(cuts, rows.every)) if of_ranks else (rows, None)
    code = _code(max([len(c) for c in cuts], default=0) + 1)
    shared = table.sparkSession.sparkContext.broadcast({t: _nodes(forest.nodes.get(t, {}), max(depths)) for t in numbers})

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = {t: Walk(nodes, depths, code) for t, nodes in shared.value.items()}
        total: dict[tuple, list] = {}

        def add(size: int, got: np.ndarray, y: np.ndarray, train: np.ndarray) -> None:
            square = (y[:, None] - got) ** 2
            for flag, of in ((True, train), (False, ~train)):
                sse, n = square[of].sum(axis=0), int(of.sum())
                for d, e in zip(depths, sse):
                    t = total.setdefault((size, d, flag), [0.0, 0])
                    t[0] += float(e)
                    t[1] += n

        for bins, y, train in _pieces(batches, m, cuts, tables):
            columns = np.ascontiguousarray(bins.T, code)
            running = np.zeros((len(y), len(depths)))
            for t in numbers:
                got = trees[t].values.take(trees[t].leaves(columns), axis=0)
                if t == 0:
                    add(1, got, y, train)
                    continue
                running += got
                if t in sizes and t > 1:
                    add(t, running / t, y, train)
        out = [(*key, *v) for key, v in total.items()]
        cols = list(zip(*out)) or [()] * 5
        types = (pa.int32(), pa.int32(), pa.bool_(), pa.float64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], ["trees", "depth", "is_train", "sse", "n"])

    sums = table.select(*(["ranks", "labels"] if of_ranks else [*forest.features, label]), "is_train").mapInArrow(work, ERRORS) \
        .groupBy("trees", "depth", "is_train").agg(F.sum("sse").alias("sse"), F.sum("n").alias("n")).collect()
    mse = {(r["trees"], r["depth"], r["is_train"]): r["sse"] / r["n"] if r["n"] else float("nan") for r in sums}
    nan = float("nan")
    return {(t, d): (mse.get((t, d, True), nan), mse.get((t, d, False), nan)) for t in sizes for d in depths}


def _nodes(of: dict[int, tuple], depth: int) -> tuple[np.ndarray, ...]:
    """Number, level, feature (-1 in a leaf), bin and mean label of the nodes of a tree cut at ``depth``, level by level."""
    number = sorted(i for i in of if i.bit_length() <= depth + 1)
    level = np.array([i.bit_length() - 1 for i in number], np.int64)
    feature = np.array([of[i][2] for i in number], np.int64)
    feature[level == depth] = -1
    return (np.array(number, np.int64), level, feature, np.array([of[i][3] for i in number], np.int64),
            np.array([of[i][1] / of[i][0] for i in number]))


class Walk:
    """A tree that rows, given as columns of bins, walk down together.  Nodes are in the order of ``_nodes``, so those of a split
    are neighbours; a leaf is below itself.  ``values`` has each node's prediction at every depth."""

    def __init__(self, nodes: tuple[np.ndarray, ...], depths: Sequence[int], code: type):
        number, level, feature, cut, mean = nodes
        inner, here = feature >= 0, np.arange(len(number))
        self.levels = int(level.max(initial=0))
        self.feature = np.where(inner, feature, 0)
        self.cut = np.where(inner, cut, np.iinfo(code).max).astype(code)
        self.below = np.where(inner, np.searchsorted(number, 2 * number), here)
        self.values = np.full((max(1, len(number)), len(depths)), np.nan)
        above = np.searchsorted(number, number // 2)
        for depth in range(self.levels + 1 if len(number) else 0):
            of = np.flatnonzero(level == depth)
            self.values[of] = np.where(np.array(depths) >= depth, mean[of, None], self.values[above[of]])

    def leaves(self, columns: np.ndarray) -> np.ndarray:
        """The leaf of every row.  The first levels compare whole columns, the others look up each row's own."""
        n = columns.shape[1]
        at = np.zeros(n, np.int64)
        if not self.levels:
            return at
        reached = [(0, np.ones(n, bool))]
        for _ in range(min(TOP, self.levels)):
            lower = []
            for node, rows in reached:
                if (below := int(self.below[node])) == node:
                    lower.append((node, rows))
                    continue
                right = columns[self.feature[node]] > self.cut[node]
                right &= rows
                lower += [(below, rows ^ right), (below + 1, right)]
            reached = lower
        near = np.zeros(n, np.uint8)
        for node, rows in reached:
            near |= rows.view(np.uint8) * np.uint8(node)
        at[:] = near
        flat, row, start = columns.ravel(), np.arange(n), self.feature * n
        cell, held, cut, to = np.empty(n, np.int64), np.empty(n, columns.dtype), np.empty(n, columns.dtype), np.empty(n, np.int64)
        for _ in range(self.levels - TOP):
            start.take(at, out=cell, mode="clip")
            cell += row
            flat.take(cell, out=held, mode="clip")
            self.cut.take(at, out=cut, mode="clip")
            self.below.take(at, out=to, mode="clip")
            to += held > cut
            at, to = to, at
        return at
