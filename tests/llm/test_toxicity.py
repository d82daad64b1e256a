"""Held-out accuracy on labelled data; the model against a plain one; edge cases."""

import math
import random
import zlib

import numpy as np
from helpers import SF_MID, documents, save
from pyspark.sql import functions as F

from tripwise.llm import toxicity as tx
from tripwise.llm.queries import QUERIES


def test_held_out_accuracy(spark):
    out = QUERIES["op2_toxicity"](spark, SF_MID)
    labels = spark.read.parquet(f"{SF_MID}/labels.parquet")
    rows = out.join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    held = [r for r in rows if r.held_out]
    toxic = [r for r in held if r.toxic]
    assert len(toxic) >= 3
    assert sum(r.predicted == r.toxic for r in held) / len(held) > 0.95
    assert out.count() == spark.read.parquet(f"{SF_MID}/documents.parquet").count()


def test_buckets_of_long_texts_equal_those_of_one_piece():
    text = "añb " * 300_000
    got = tx.buckets(text)
    assert len(got) == sum(len(text) + 2 - n + 1 for n in tx.SIZES)
    assert set(got.tolist()) <= set(tx.buckets("añb " * 6).tolist())
    assert len(tx.buckets(None)) == len(tx.buckets("")) == 0 and len(tx.buckets("abc")) == 1


def test_weights_follow_the_sign_of_the_ratio(spark):
    texts = ["you vile thing", "what a vile remark", "lovely day", "a fine day today"] * 10
    train = spark.createDataFrame([(t, int("vile" in t)) for t in texts], "text string, toxic int")
    model = tx.fit(train)
    p = {b for t in texts if "vile" in t for b in tx.buckets(t).tolist()}
    q = {b for t in texts if "vile" not in t for b in tx.buckets(t).tolist()}
    assert (model.weight[list(p - q)] > 0).all() and (model.weight[list(q - p)] < 0).all()
    assert set(np.flatnonzero(model.weight).tolist()) <= p | q


def test_training_rows_stay_bounded_when_an_id_repeats(spark):
    texts = [f"text number {i}" for i in range(900)]
    docs = documents(spark, texts * 2, [7 if i % 3 == 0 else i for i in range(900)] * 2)
    labels = spark.createDataFrame([(i, i % 2) for i in range(900)], "doc_id long, toxic int")
    for limit in (100, 5000):
        rows = tx.labelled(docs, labels, limit).collect()
        assert len(rows) == len(set(rows)) and len(rows) <= 1.5 * limit
    assert len(rows) == 900


def plain_model(rows):
    """Counts of n-grams, log-count ratios and weighted descent with plain loops over dictionaries."""
    counts = [{}, {}]
    for text, y in rows:
        for b in set(tx.buckets(text).tolist()):
            counts[y][b] = counts[y].get(b, 0) + 1
    every = set(counts[0]) | set(counts[1])
    p = {b: counts[1].get(b, 0) + tx.ALPHA for b in every}
    q = {b: counts[0].get(b, 0) + tx.ALPHA for b in every}
    n, m = sum(p.values()), sum(q.values())
    ratio = {b: math.log(p[b] / n) - math.log(q[b] / m) for b in every}
    sure = {b: abs(ratio[b]) / math.sqrt(1 / p[b] + 1 / q[b]) for b in every}
    kept = sorted(every, key=lambda b: (-round(sure[b], 9), b))[:tx.KEEP]
    x = [sorted(set(tx.buckets(t).tolist()) & set(kept)) for t, _ in rows]
    y = [float(label) for _, label in rows]
    share = min(max(sum(y) / len(y), 1e-3), 1 - 1e-3)
    weight = [1 / share if label else 1 / (1 - share) for label in y]
    weight = [v / sum(weight) for v in weight]
    prior = min(max(sum(v * label for v, label in zip(weight, y)), 1e-3), 1 - 1e-3)
    w, b = dict.fromkeys(kept, 0.0), math.log(prior / (1 - prior))
    m1, m2, b1, b2 = dict.fromkeys(kept, 0.0), dict.fromkeys(kept, 0.0), 0.0, 0.0
    for t in range(1, 301):
        g = [v * (1 / (1 + math.exp(-(b + sum(ratio[f] * w[f] for f in row)))) - label) for v, row, label in zip(weight, x, y)]
        grad = {f: 1e-3 * w[f] for f in kept}
        for d, row in zip(g, x):
            for f in row:
                grad[f] += ratio[f] * d
        for f in kept:
            m1[f], m2[f] = 0.9 * m1[f] + 0.1 * grad[f], 0.999 * m2[f] + 0.001 * grad[f] ** 2
            w[f] -= 0.02 * (m1[f] / (1 - 0.9 ** t)) / (math.sqrt(m2[f] / (1 - 0.999 ** t)) + 1e-8)
        b1, b2 = 0.9 * b1 + 0.1 * sum(g), 0.999 * b2 + 0.001 * sum(g) ** 2
        b -= 0.02 * (b1 / (1 - 0.9 ** t)) / (math.sqrt(b2 / (1 - 0.999 ** t)) + 1e-8)
    return {f: w[f] * ratio[f] for f in kept}, b


def test_model_equals_a_plain_one(spark):
    rng = random.Random(5)
    mild, vile = ["sun", "river", "bread", "calm"], ["rot", "scum", "vermin"]
    rows = []
    for i in range(60):
        y = int(i % 3 == 0)
        rows.append((" ".join(rng.choices(mild + vile * y, k=rng.randint(1, 8))), y))
    model = tx.fit(spark.createDataFrame(rows, "text string, toxic int"))
    weight, bias = plain_model(rows)
    assert abs(model.bias - bias) < 1e-6 and set(np.flatnonzero(model.weight)) <= set(weight)
    assert max(abs(model.weight[f] - v) for f, v in weight.items()) < 1e-5


def test_edge_cases(spark, tmp_path):
    texts = ["bad wicked text", None, "", "x" * 3_000_000, "bad wicked text"]
    docs = documents(spark, texts, [1, 2, None, 4, 1]).withColumn("score", F.lit("clash"))
    save(docs, tmp_path)
    schema = "doc_id long, quality int, toxic int"
    save(spark.createDataFrame([(1, None, 1), (1, 0, 0), (2, None, 0), (None, 0, 1), (4, 1, None)], schema), tmp_path, "labels")
    rows = QUERIES["op2_toxicity"](spark, str(tmp_path)).collect()
    assert len(rows) == 5 and all(0 <= r.score <= 1 for r in rows)
    save(docs.limit(0), tmp_path / "e")
    save(spark.createDataFrame([], schema), tmp_path / "e", "labels")
    assert QUERIES["op2_toxicity"](spark, str(tmp_path / "e")).count() == 0
    save(docs, tmp_path / "u")
    save(spark.createDataFrame([], schema), tmp_path / "u", "labels")
    assert {r.predicted for r in QUERIES["op2_toxicity"](spark, str(tmp_path / "u")).collect()} == {0}
