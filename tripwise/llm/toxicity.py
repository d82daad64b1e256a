"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

Features are the hashed character n-grams (5 and 6) that occur in the lower-cased text, with one
space before and after it.  For each, the log ratio of its smoothed share in
toxic and in other training texts is taken; the ``keep`` features whose ratio is most
certain (largest ratio over its standard error) enter a logistic regression on
presence times ratio, both classes weighing the same.  The score is its probability.

Training reads at most about ``MAX_TRAIN`` labelled rows (a documented bound, chosen by a hash
of doc_id); every text is scored whole.  Only the text enters a score.

Defined cases: null text counts as empty and is scored like any other (prior and
padding only); a doc_id labelled more than once counts as toxic if one label says so; null
labels are left out; without any labelled text every score is 0; repeated rows stay;
an empty table gives an empty table; the other columns stay as they are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripwise.llm.common import fit_logistic, sample_share, written

#: At most about so many labelled rows are read for training.
MAX_TRAIN = 40_000
BITS, SIZES, KEEP, ALPHA = 20, (5, 6), 1 << 12, 1.0


def buckets(text: str | None) -> np.ndarray:
    """Hashed n-grams of a text, with repeats; long texts are taken in overlapping pieces."""
    u = np.frombuffer(f" {text or ''} ".lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    out, step, top = [], 1 << 20, max(SIZES)
    for at in range(0, len(u), step):
        piece = u[at:at + step + top - 1]
        h = np.zeros(len(piece), dtype=np.uint32)
        for n in range(1, top + 1):
            if n > len(piece):
                break
            h = h[:len(piece) - n + 1] * np.uint32(0x01000193) + piece[n - 1:]
            if n in SIZES:
                x = h[:step]
                x = (x ^ (x >> np.uint32(15))) * np.uint32(0x9E3779B1) + np.uint32(n * 0x85EBCA6B & 0xFFFFFFFF)
                out.append((x ^ (x >> np.uint32(13))) * np.uint32(0xC2B2AE35) >> np.uint32(32 - BITS))
    return np.concatenate(out) if out else np.empty(0, np.uint32)


@dataclass
class Model:
    """``weight``: per bucket, 0 where it was not kept; ``bias``: intercept."""

    weight: np.ndarray
    bias: float

    def score(self, spark: SparkSession, text: Column) -> Column:
        """Probability that a text is toxic, as a column; the model (4 MB) is broadcast."""
        shared = spark.sparkContext.broadcast((self.weight, self.bias))

        @F.pandas_udf("double")
        def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
            weight, bias = shared.value
            for batch in texts:
                z = np.empty(len(batch))
                for i, t in enumerate(batch):
                    got = buckets(t)
                    got = np.unique(got[weight[got] != 0])
                    z[i] = bias + weight[got].sum(dtype=np.float64)
                yield pd.Series(1 / (1 + np.exp(-np.clip(z, -35, 35))))

        return run(text)


def fit(train: DataFrame) -> Model:
    """Model of a table with ``text`` and ``toxic`` (0 or 1) of bounded size."""
    spark = train.sparkSession

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((2, 1 << BITS), dtype=np.int64)
        for batch in batches:
            for t, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                seen[int(y), np.unique(buckets(t))] += 1
        at = np.flatnonzero(seen.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(seen[1, at]), pa.array(seen[0, at])], ["f", "p", "q"])

    counts = train.mapInArrow(count, "f long, p long, q long").groupBy("f").agg(
        (F.sum("p") + F.lit(ALPHA)).alias("p"), (F.sum("q") + F.lit(ALPHA)).alias("q"))
    counts = written(counts, "ngram-counts")
    empty = np.zeros(1 << BITS, dtype=np.float32)
    sums = counts.agg(F.sum("p"), F.sum("q")).first()
    if sums[0] is None:
        return Model(empty, -35.0)
    ratio = F.log(F.col("p") / F.lit(sums[0])) - F.log(F.col("q") / F.lit(sums[1]))
    sure = F.abs(ratio) / F.sqrt(1 / F.col("p") + 1 / F.col("q"))
    best = counts.select("f", ratio.alias("r"), sure.alias("z")).orderBy(F.desc("z"), "f").limit(KEEP).toPandas()
    place = np.full(1 << BITS, -1, dtype=np.int32)
    place[best["f"].to_numpy()] = np.arange(len(best))
    shared = spark.sparkContext.broadcast(place)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spot = shared.value
        for batch in batches:
            got = [spot[buckets(t)] for t in batch.column(0).to_pylist()]
            got = [np.unique(g[g >= 0]).astype("<u2").tobytes() for g in got]
            yield pa.RecordBatch.from_arrays([batch.column(1).cast(pa.int32()), pa.array(got, pa.binary())], ["y", "x"])

    sample = train.mapInArrow(rows, "y int, x binary").collect()
    x = [np.frombuffer(r.x, dtype="<u2") for r in sample]
    cols = np.concatenate(x).astype(np.int64)
    at = np.repeat(np.arange(len(x)), [len(r) for r in x])
    ratios = best["r"].to_numpy()
    y = np.array([r.y for r in sample], dtype=float)
    share = float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
    w, bias = fit_logistic(at, cols, ratios[cols], y, len(ratios), l2=1e-3, rate=0.02,
                           weight=np.where(y == 1, 1 / share, 1 / (1 - share)))
    weight = empty
    weight[best["f"].to_numpy()] = w * ratios
    return Model(weight, bias)


def labelled(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> DataFrame:
    """Training rows (text, toxic): about ``max_train`` of the labelled documents.

    The sampled ids (bounded by ``max_train``) are broadcast, so no text is shuffled.  Should their rows be
    more (an id may repeat), rows are sampled by id and text; equal rows are learnt from once.
    """
    known = labels.filter("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("__toxic"))
    known = written(known, "labels")
    ids = F.broadcast(sample_share(known, ["doc_id"], max_train, known.count()))
    train = docs.select(F.col("doc_id").alias("__id"), "text").join(ids, F.col("__id") == ids["doc_id"]) \
        .select("doc_id", "text", F.col("__toxic").cast("int").alias("toxic"))
    train = sample_share(train, ["doc_id", "text"], max_train, train.count()).dropDuplicates()
    return written(train.select("text", "toxic"), "training-texts")


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text is a multiple of 5; such labels are never learnt from."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5 == 0


def classify(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN, prefix: str = "") -> DataFrame:
    """``docs`` with ``held_out``, ``score`` and ``predicted`` (names after ``prefix``; they replace columns of that name)."""
    learn = labels.filter(~held_out(F.col("doc_id")))
    model = fit(labelled(docs, learn, max_train))
    out = docs.withColumns({f"{prefix}held_out": held_out(F.col("doc_id")),
                            f"{prefix}score": model.score(docs.sparkSession, F.col("text"))})
    return out.withColumn(f"{prefix}predicted", (F.col(f"{prefix}score") >= 0.5).cast("int"))
