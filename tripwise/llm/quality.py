"""Quality: a weak-label model over heuristic labellers trains a hashed linear scorer.

Eight heuristics vote good, bad or nothing on every text.  Expectation-maximisation
(two latent classes, one vote distribution per labeller and class) estimates how far
each can be trusted from the agreement of the votes alone; no label is read.  The
statistics it needs are the counts of the vote patterns of all documents, at most
3^8 rows.  The posterior of a pattern is a soft label, and a logistic regression on hashed
features of the text's form (character-class trigrams, repeated words and lines) learns from
about ``MAX_TRAIN`` documents (a documented bound) and scores every document.

Defined cases: null text counts as empty; an empty text gets no vote and the
intercept's score; a text too short for a heuristic gets no vote from it; without any vote
all scores are 1 (nothing speaks against a text); repeated rows stay; an empty
table gives an empty table; other columns stay as they are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq
from unicodedata import category

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripwise.llm.common import fit_logistic, fresh, sample_share

#: At most about so many documents train the scorer.
MAX_TRAIN = 20_000
BITS = 14
BAD, GOOD, NONE = 0, 1, 2
LABELLERS = ("symbols", "capitals", "word_repeats", "doubled_symbols", "lone_symbols", "variety", "line_repeats", "sentences")
LOWER, UPPER, DIGIT, SPACE, OTHER = 97, 65, 48, 32, 127
_CLASS: list[np.ndarray] = []


def _class_table() -> np.ndarray:
    """Character class by code point: letters, capitals, digits and white space fold, ASCII symbols stay."""
    if not _CLASS:
        table = np.full(0x110000, OTHER, dtype=np.uint8)
        table[0x20000:0x40000] = LOWER
        for c in range(0x20000):
            kind = category(chr(c))
            table[c] = (UPPER if kind in ("Lu", "Lt") else LOWER if kind[0] in "LM" else DIGIT if kind[0] == "N"
                        else SPACE if kind[0] in "ZC" else c if c < 128 else OTHER)
        table[10] = 10
        _CLASS.append(table)
    return _CLASS[0]


def _vote(value: float, good: float, bad: float) -> int:
    return GOOD if value <= good else BAD if value >= bad else NONE


def look(text: str | None) -> tuple[str, np.ndarray, list[float]]:
    """Votes (one digit per labeller), character classes and the measured shares of a text."""
    text = text or ""
    shape = _class_table()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)]
    kinds = np.bincount(shape, minlength=128)
    letters, blank = kinds[LOWER] + kinds[UPPER], kinds[SPACE] + kinds[10]
    symbols = len(shape) - letters - kinds[DIGIT] - blank
    words = text.split()
    n, lines = len(words), [x for x in text.split("\n") if x]
    symbol = (shape != LOWER) & (shape != UPPER) & (shape != DIGIT) & (shape != SPACE) & (shape != 10)
    doubled = int((symbol[1:] & (shape[1:] == shape[:-1])).sum())
    lone = sum(len(w) == 1 and not w.isalnum() for w in words)
    repeats = sum(map(eq, words, words[1:]))
    ends = sum(w[-1] in ".!?…。" and w[-2:] != "!!" for w in words)
    share = [symbols / max(1, len(shape)), kinds[UPPER] / max(1, letters), repeats / max(1, n), doubled / max(1, n),
             lone / max(1, n), 1 - len(set(words)) / max(1, n), 1 - len(set(lines)) / max(1, len(lines)), ends / max(1, n)]
    votes = [
        _vote(share[0], 0.05, 0.08) if len(shape) else NONE,
        _vote(share[1], 0.10, 0.30) if letters >= 10 else NONE,
        _vote(share[2], 0.05, 0.20) if n >= 10 else NONE,
        _vote(share[3], 0.02, 0.15) if n >= 3 else NONE,
        _vote(share[4], 0.02, 0.15) if n >= 5 else NONE,
        _vote(share[5], 0.45, 0.75) if 20 <= n <= 1000 else NONE,
        _vote(share[6], 0.20, 0.70) if len(lines) >= 5 else NONE,
        (GOOD if 0.01 <= share[7] <= 0.5 else BAD if share[7] < 0.004 else NONE) if n >= 100 else NONE,
    ]
    return "".join(map(str, votes)), shape, share


def features(shape: np.ndarray, share: list[float]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed character-class trigrams with their shares (square roots, so their norm is 1), and graded repeats."""
    x = shape.astype(np.uint32)
    if len(x) >= 3:
        h = (x[:-2] << np.uint32(14) | x[1:-1] << np.uint32(7) | x[2:]) * np.uint32(0x9E3779B1) >> np.uint32(32 - BITS)
        count = np.bincount(h, minlength=1 << BITS)
        at = np.flatnonzero(count)
        value = np.sqrt(count[at] / len(h))
    else:
        at, value = np.empty(0, np.int64), np.empty(0)
    graded = [(i * 16 + min(15, int(16 * share[i]))) * 40503 % (1 << BITS) for i in (2, 4, 5, 6)]
    return np.concatenate([at, graded]).astype("<u2"), np.concatenate([value, np.full(4, 0.5)]).astype("<f4")


def accuracies(patterns: list[str], counts: np.ndarray, rounds: int = 200) -> tuple[np.ndarray, np.ndarray, float]:
    """EM over vote patterns: posterior of good per pattern, vote shares [labeller, class, vote], share of good."""
    votes = np.array([[int(c) for c in p] for p in patterns], dtype=int).reshape(len(patterns), -1)
    good, bad = (votes == GOOD).sum(1), (votes == BAD).sum(1)
    post = np.where(good + bad == 0, 0.5, (good + 1) / (good + 3 * bad + 2))  # a vote against weighs more: heuristics look for faults
    total = counts.sum()
    table, prior = np.full((votes.shape[1], 2, 3), 1 / 3), 0.5
    for _ in range(rounds):
        weight = np.stack([(1 - post) * counts, post * counts])
        prior = float(np.clip(weight[1].sum() / total, 0.01, 0.99))
        for j in range(votes.shape[1]):
            for v in (BAD, GOOD, NONE):
                table[j, :, v] = weight[:, votes[:, j] == v].sum(1)
        table = (table + 0.5) / (table.sum(2, keepdims=True) + 1.5)
        # Votes of nothing say only that a text is short or in between: they are left out.
        z = np.full(len(votes), np.log(prior / (1 - prior)))
        for j in range(votes.shape[1]):
            told = votes[:, j] != NONE
            given = table[j, :, :2] / table[j, :, :2].sum(1, keepdims=True)
            z[told] += np.log(given[1, votes[told, j]] / given[0, votes[told, j]])
        post = 1 / (1 + np.exp(-np.clip(z, -35, 35)))
    return post, table, prior


@dataclass
class Model:
    weight: np.ndarray
    bias: float
    #: posterior of good by vote pattern
    posterior: dict[str, float]
    #: accuracy of each labeller where it votes, as EM estimates it
    accuracy: dict[str, float]

    def score(self, spark: SparkSession, text: Column) -> Column:
        """Struct of ``votes``, ``posterior`` and ``score`` (probability of good) of a text."""
        shared = spark.sparkContext.broadcast((self.weight, self.bias, self.posterior))

        @F.pandas_udf("votes string, posterior double, score double")
        def run(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            weight, bias, posterior = shared.value
            for batch in texts:
                out = []
                for t in batch:
                    votes, shape, share = look(t)
                    at, value = features(shape, share)
                    z = bias + float((weight[at] * value).sum())
                    out.append((votes, posterior.get(votes), 1 / (1 + np.exp(-max(-35.0, min(35.0, z))))))
                yield pd.DataFrame(out, columns=["votes", "posterior", "score"])

        return run(text)


def fit(docs: DataFrame, max_train: int = MAX_TRAIN) -> Model:
    """Weak labels from all documents' votes, scorer from about ``max_train`` of them."""
    @F.pandas_udf("string")
    def votes(texts: pd.Series) -> pd.Series:
        return pd.Series([look(t)[0] for t in texts], dtype=object)

    seen = docs.select(votes("text").alias("votes")).groupBy("votes").count().orderBy("votes").collect()
    n = sum(r["count"] for r in seen)
    none = str(NONE) * len(LABELLERS)
    if not any(r.votes != none for r in seen):
        return Model(np.zeros(1 << BITS), 35.0, {}, {})
    post, table, prior = accuracies([r.votes for r in seen], np.array([r["count"] for r in seen], dtype=float))
    posterior = {r.votes: float(p) for r, p in zip(seen, post)}
    right = {}
    for j, name in enumerate(LABELLERS):
        told = (1 - prior) * table[j, 0, :2].sum() + prior * table[j, 1, :2].sum()
        right[name] = float(((1 - prior) * table[j, 0, BAD] + prior * table[j, 1, GOOD]) / told)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for t in batch.column(0).to_pylist():
                v, shape, share = look(t)
                at, value = features(shape, share)
                out.append((v, at.tobytes(), value.tobytes()))
            a, b, c = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.string()), pa.array(b, pa.binary()), pa.array(c, pa.binary())],
                                             ["votes", "at", "value"])

    # By id and text, equal rows once: a hot id is sampled like any other rows.
    sample = sample_share(docs.select("doc_id", "text"), ["doc_id", "text"], max_train, n).dropDuplicates().select("text") \
        .mapInArrow(rows, "votes string, at binary, value binary").collect()
    sample = [r for r in sample if r.votes != none]
    cols = [np.frombuffer(r["at"], dtype="<u2") for r in sample]
    y = np.array([posterior[r.votes] for r in sample])
    w, bias = fit_logistic(np.repeat(np.arange(len(cols)), [len(c) for c in cols]), np.concatenate(cols).astype(np.int64),
                           np.concatenate([np.frombuffer(r.value, dtype="<f4") for r in sample]).astype(float), y,
                           1 << BITS, l2=1e-6, rate=0.3) if sample else (np.zeros(1 << BITS), 35.0)
    return Model(w, bias, posterior, right)


def classify(docs: DataFrame, max_train: int = MAX_TRAIN, threshold: float = 0.2, prefix: str = "") -> DataFrame:
    """``docs`` with ``votes``, ``posterior`` (of the weak labels), ``score`` and ``predicted`` (1: good).

    A text is rejected only on clear evidence: a score below ``threshold``.  The names
    come after ``prefix`` and replace columns of that name.
    """
    model = fit(docs, max_train)
    judged, = fresh(docs, "__judged")
    out = docs.withColumn(judged, model.score(docs.sparkSession, F.col("text")))
    out = out.withColumns({prefix + c: F.col(f"{judged}.{c}") for c in ("votes", "posterior", "score")}).drop(judged)
    return out.withColumn(f"{prefix}predicted", (F.col(f"{prefix}score") >= threshold).cast("int"))
