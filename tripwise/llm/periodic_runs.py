"""Periodic runs of words: seed and extend on the diagonals of a text against itself.

A run is a stretch of consecutive words with smallest period q (words q apart are equal), of at
least ``max(MIN_LENGTH, 2 * q)`` words, that no neighbouring word extends.  On the diagonal of lag q
it is a stretch of at least ``overlap(q) = max(MIN_LENGTH - q, q)`` equal words.

Seeds.  Lags are taken in bands.  Every lag of a band guarantees an overlap of at least
``k + step - 1`` words, so each stretch holds a whole k-gram that begins at a multiple of ``step``.
The index lists where each k-gram occurs; a seed is such a begin with another occurrence in the same
document at a lag of the band.  A band takes at most 5 seeds a word however repetitive the text is:
no pair of occurrences is ever left out, and a text of one word a million times costs no square.

Extension.  Seeds go by lag and place.  A table of the furthest word covered on each lag suppresses a
seed that lies within the stretch found before it, so every stretch is extended once.  Names of the
grams of 1, 2, 4, ... words (equal names, equal grams) give the longest common extension in
logarithmically many steps, exactly.  A stretch whose period has a smaller divisor that is a period
too begins and ends where the run of that divisor does: of equal stretches the smallest period stays.

Plan.  One pass without any shuffle: documents are independent, a task takes about ``WORK`` bytes of
texts at a time (one text at least) and works on all their words at once; separators that
occur once keep documents apart.  Memory is bounded by the longest text: four bytes a word for
each doubling up to its longest repeated stretch.

Defined cases: null text counts as empty; a text without words has no runs and collapses to the empty
text; repeated rows and null ids stay, one row each; an empty table gives an empty table; columns
other than the id and the text are not read, so their names cannot clash.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
MIN_LENGTH = 12
WORK = 1 << 20
RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"

_find = re.compile(WORD.encode()).findall


def _bands(levels: int) -> Iterator[tuple[int, int, int, int]]:
    """(level of the k-gram, step, first lag, lag behind the last): every overlap is k + step - 1 at least."""
    yield 2, 3, 1, 15  # k = 4: overlaps of lags 1 to 14 are 6 or more
    for level in range(3, levels):
        k = 1 << level
        yield level, k, 2 * k - 1, 4 * k - 1


def _names(words: np.ndarray) -> list[np.ndarray]:
    """Names of the grams of 1, 2, 4, ... words at each place, as far as any occurs twice; -1 where one occurs once."""
    out, n, size = [], len(words), 1
    at, key = np.arange(n), words.astype(np.int64)
    while len(at):
        order = np.argsort(key, kind="stable")
        new = np.ones(len(key), bool)
        new[1:] = key[order[1:]] != key[order[:-1]]
        group = np.cumsum(new) - 1
        twice = (np.bincount(group) > 1)[group]
        if not twice.any():
            break
        name = np.full(n, -1, np.int32)
        name[at[order[twice]]] = group[twice]
        out.append(name)
        at = np.flatnonzero(name[: n - size] >= 0) if n > size else np.empty(0, np.int64)
        at = at[name[at + size] >= 0]
        key = name[at].astype(np.int64) << 32 | name[at + size]
        size *= 2
    return out


def _common(names: list[np.ndarray], i: np.ndarray, j: np.ndarray, back: bool) -> np.ndarray:
    """How many words agree from i and j on (or before them, if ``back``); j > i."""
    total = np.zeros(len(i), np.int64)
    for level in range(len(names) - 1, -1, -1):
        name = names[level]
        a, b = (i - total - (1 << level), j - total - (1 << level)) if back else (i + total, j + total)
        inside = (a >= 0) & (b < len(name))
        a, b = np.where(inside, a, 0), np.where(inside, b, 0)
        total += (inside & (name[a] >= 0) & (name[a] == name[b])).astype(np.int64) << level
    return total


def _seeds(name: np.ndarray, doc: np.ndarray, step: int, first: int, behind: int) -> tuple[np.ndarray, np.ndarray]:
    """Places i (multiples of ``step``) and lags in [first, behind) where the same gram occurs in the same document."""
    n = len(name)
    held = np.flatnonzero(name >= 0)
    index = np.sort(name[held].astype(np.int64) * n + held)  # occurrences by gram, then place
    i = held[held % step == 0]
    base = name[i].astype(np.int64) * n
    a = np.searchsorted(index, base + np.minimum(i + first, n))
    b = np.searchsorted(index, base + np.minimum(i + behind, n))
    count = b - a
    i = np.repeat(i, count)
    ends = np.cumsum(count)
    j = index[np.arange(len(i)) + np.repeat(a - (ends - count), count)] % n
    same = doc[i] == doc[j]
    return i[same], (j - i)[same]


def find_runs(words: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and period of all runs, by start, then period.

    ``words`` are the word numbers of documents one after another, with a number that occurs once
    behind each of them; ``doc`` is the document of each place.
    """
    names = _names(words)
    found = []
    for level, step, first, behind in _bands(len(names)):
        if level >= len(names):
            break
        i, lag = _seeds(names[level], doc, step, first, behind)
        order = np.lexsort((i, lag))
        i, lag = i[order], lag[order]
        # The furthest word covered on this lag is the end of the seed before, or of the stretch that holds it.
        uncovered = np.ones(len(i), bool)
        uncovered[1:] = (lag[1:] != lag[:-1]) | (i[1:] > i[:-1] + (1 << level))
        i, lag = i[uncovered], lag[uncovered]
        start = i - _common(names, i, i + lag, back=True)
        equal = i + _common(names, i, i + lag, back=False) - start
        long = equal >= np.maximum(MIN_LENGTH - lag, lag)
        found.append(np.stack([start[long], (equal + lag)[long], lag[long]]))
    if not found:
        return (np.empty(0, np.int64),) * 3
    start, length, period = np.concatenate(found, axis=1)
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    least = np.ones(len(start), bool)
    least[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    start, length, period = start[least], length[least], period[least]
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def _batch(texts: list[bytes]) -> tuple[pa.Array, pa.Array]:
    """Runs and collapsed text of every text."""
    cut = [_find(t) for t in texts]
    number: dict[bytes, int] = {}
    flat, begins = [], [0]
    for k, words in enumerate(cut):
        flat += [number.setdefault(w, len(number)) for w in words]
        flat.append(-1 - k)  # a separator of its own
        begins.append(len(flat))
    words, begin = np.array(flat, np.int64), np.array(begins)
    del flat
    start, length, period = find_runs(words, np.repeat(np.arange(len(cut)), np.diff(begin)))
    of = np.searchsorted(begin, start, "right") - 1
    edge = np.searchsorted(of, np.arange(len(cut) + 1))
    drop = np.zeros(len(words) + 1, np.int64)
    np.add.at(drop, start + period, 1)
    np.add.at(drop, start + length, -1)
    kept = np.cumsum(drop) == 0
    collapsed = [b" ".join(w if a == b else compress(w, kept[s:s + len(w)].tolist()))
                 for w, s, a, b in zip(cut, begins, edge.tolist(), edge[1:].tolist())]
    rows = pa.StructArray.from_arrays([pa.array(x) for x in (start - begin[of], length, period)],
                                      ["start", "length", "period"])
    return pa.ListArray.from_arrays(pa.array(edge, pa.int32()), rows), \
        pa.array(collapsed, pa.binary()).cast(pa.string())


def runs(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The id, ``runs`` (start, length, period; by start, then period) and ``collapsed`` of every document.

    ``collapsed`` joins by one space the words that stay if each run keeps its first period only.
    """
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or b"" for t in batch.column(1).cast(pa.binary()).to_pylist()]
            begin = size = 0
            for end in range(1, len(texts) + 1):
                size += len(texts[end - 1])
                if end == len(texts) or size + len(texts[end]) > WORK:
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(begin, end - begin),
                                                      *_batch(texts[begin:end])], [key, "runs", "collapsed"])
                    begin, size = end, 0

    found = docs.select(key, text)
    kind = found.schema[key].dataType.simpleString()
    return found.mapInArrow(work, f"`{key}` {kind}, runs {RUNS}, collapsed string")


def with_planted_period(key: Column, text: Column) -> Column:
    """The text, or, where crc32 of the key in decimal is a multiple of 10, one whose end repeats with a period.

    With g = floor(crc32 / 10) and n words, word i from a = g % n on becomes word a + (i - a) % p, where
    p = 1 + floor((n - a) / (3 + g % 8)).  A text without words, or with a null key, stays.
    """
    h = F.crc32(key.cast("string").cast("binary"))
    g = F.floor(h / 10).cast("long")

    def repeated(words: Column) -> Column:
        n = F.size(words).cast("long")
        a = g % n
        p = F.floor((n - a) / (g % 8 + 3)).cast("long") + 1
        places = F.sequence(F.lit(0).cast("long"), n - 1)
        return F.when(n > 0, F.array_join(F.transform(places, lambda i: F.get(words, F.when(i < a, i).otherwise(
            a + (i - a) % p).cast("int"))), " ")).otherwise(text)

    # The words are bound once by a one-element array.
    words = F.array(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)))
    return F.when(h % 10 == 0, F.get(F.transform(words, repeated), F.lit(0))).otherwise(text)


def digests(docs: DataFrame) -> DataFrame:
    """One row per document of ``documents`` after ``with_planted_period``: its runs, the longest one, and digests."""
    found = runs(docs.select("doc_id", with_planted_period(F.col("doc_id"), F.col("text")).alias("text")))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select("doc_id", "runs", "collapsed", longest.alias("top")).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("top.start")).alias("start"),
        F.col("top.length").alias("length"), (-F.col("top.period")).alias("period"),
        F.floor(F.col("top.length") * -1000 / F.col("top.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
