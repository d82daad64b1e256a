"""Accuracy against labels the model never reads; EM against known accuracies; edge cases."""

import math

import numpy as np
from helpers import SF_MID, SF_SMALL, documents, save
from pyspark.sql import functions as F

from tripwise.llm import quality as ql
from tripwise.llm.common import sample_share
from tripwise.llm.queries import QUERIES


def test_clean_stays_and_junk_goes(spark):
    labels = spark.read.parquet(f"{SF_MID}/labels.parquet")
    rows = QUERIES["op3_quality"](spark, SF_MID).join(labels, "doc_id").collect()
    good = [r.predicted for r in rows if r.quality == 1]
    junk = [r.predicted for r in rows if r.quality == 0]
    assert sum(good) / len(good) > 0.99 and sum(junk) / len(junk) < 0.05


def test_em_finds_the_accuracies():
    rng = np.random.default_rng(2)
    truth = rng.random(20_000) < 0.7
    accuracy = [0.9, 0.8, 0.75, 0.6, 0.85, 0.7, 0.65, 0.8]
    votes = np.array([np.where(rng.random(len(truth)) < 0.2, ql.NONE, np.where(rng.random(len(truth)) < a, truth, ~truth).astype(int))
                      for a in accuracy]).T
    patterns, counts = np.unique(["".join(map(str, v)) for v in votes], return_counts=True)
    post, table, prior = ql.accuracies(list(patterns), counts.astype(float))
    assert abs(prior - 0.7) < 0.05
    for j, a in enumerate(accuracy):
        assert abs(table[j, 1, ql.GOOD] / table[j, 1, :2].sum() - a) < 0.06
    of = dict(zip(patterns, post))
    assert np.mean([(of["".join(map(str, v))] >= 0.5) == t for v, t in zip(votes, truth)]) > 0.9


def plain_em(votes, rounds=200):
    """EM over all rows, one at a time."""
    n = len(votes[0])
    post = []
    for v in votes:
        good, bad = v.count(ql.GOOD), v.count(ql.BAD)
        post.append((good + 1) / (good + 3 * bad + 2) if good + bad else 0.5)
    for _ in range(rounds):
        prior = min(max(sum(post) / len(post), 0.01), 0.99)
        seen = [[[0.5] * 3, [0.5] * 3] for _ in range(n)]
        for v, p in zip(votes, post):
            for j, x in enumerate(v):
                seen[j][0][x] += 1 - p
                seen[j][1][x] += p
        post = []
        for v in votes:
            z = math.log(prior / (1 - prior))
            for j, x in enumerate(v):
                if x != ql.NONE:
                    good, bad = seen[j][1], seen[j][0]
                    z += math.log(good[x] / (good[ql.GOOD] + good[ql.BAD]) / (bad[x] / (bad[ql.GOOD] + bad[ql.BAD])))
            post.append(1 / (1 + math.exp(-max(-35, min(35, z)))))
    return post


def test_posteriors_equal_a_plain_em_over_all_rows(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    rows = ql.classify(docs).select("votes", "posterior").collect()
    want = plain_em([[int(c) for c in r.votes] for r in rows])
    assert len(rows) == docs.count() and max(abs(r.posterior - p) for r, p in zip(rows, want)) < 1e-6


def test_training_rows_stay_bounded_and_names_may_clash(spark):
    texts = [f"Plain sentence number {i} stands here for a while." for i in range(600)]
    docs = documents(spark, texts, [3 if i % 3 == 0 else i for i in range(600)])
    spread = sample_share(docs, ["doc_id", "text"], 60, 600)
    assert 30 < spread.count() < 100 and 0 < spread.filter("doc_id = 3").count() < 60
    out = ql.classify(docs.withColumn("__judged", F.lit("kept")), prefix="x_")
    assert {r["__judged"] for r in out.collect()} == {"kept"}


def test_votes():
    good = "The quick brown fox jumps over the lazy dog again. " * 4
    assert ql.look(good)[0][:3] == "111"
    assert ql.look("WHAT!! IS!! THIS!! NOISE!! ABOUT!!")[0][:2] == "00"
    assert ql.look("again " * 30)[0][2] == "0"
    assert ql.look(None)[0] == ql.look("")[0] == "2" * len(ql.LABELLERS)


def test_edge_cases(spark, tmp_path):
    docs = documents(spark, ["Some plain words here.", None, "", "x" * 2_000_000, "Some plain words here.", "😀\ud83d"[:1]],
                     [1, 2, None, 4, 1, 5]).withColumn("score", F.lit("clash"))
    rows = QUERIES["op3_quality"](spark, save(docs, tmp_path / "a")).collect()
    assert len(rows) == 6 and all(0 <= r.score <= 1 for r in rows)
    assert QUERIES["op3_quality"](spark, save(docs.limit(0), tmp_path / "e")).count() == 0
    empty = documents(spark, [None, ""])
    assert {r.predicted for r in QUERIES["op3_quality"](spark, save(empty, tmp_path / "n")).collect()} == {1}
