"""Components by MinHash and an LSH forest against all pairs of full sets."""

import random
import re

import numpy as np
from helpers import documents, save
from pyspark.sql import functions as F

from tripwise.llm import lsh_forest as lf
from tripwise.llm.common import split_join, written
from tripwise.llm.queries import QUERIES


def plain_set(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {tuple(w[i:i + 4]) for i in range(max(1, len(w) - 3))} if w else set()


def plain_rows(texts):
    sets = [plain_set(t) for t in texts]
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    of = {}
    for i, s in enumerate(sets):
        for g in s:
            of.setdefault(g, []).append(i)
    pairs = {(i, j) for holders in of.values() for i in holders for j in holders if i < j}
    for i, j in pairs:
        both = len(sets[i] & sets[j])
        if 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
            a, b = sorted((find(i), find(j)))
            root[b] = a
    return [(i, len(s), find(i), find(i) == i) for i, s in enumerate(sets)]


def odd_texts(rng, clusters=40, copies=8):
    vocab = [f"w{i}" for i in range(300)] + ["É", "é", "x\x85y", "Straße"]
    texts = [None, "", " \n\t", "one", "ONE", "one two", "one  two\n", "a b c", "a b c d", "A B C D", "a b c d e", "a " * 50]
    for _ in range(clusters):  # chains around the threshold: each text is an edit of one before
        family = [rng.choices(vocab, k=rng.randint(4, 120))]
        for _ in range(rng.randint(0, copies)):
            w = list(rng.choice(family))
            for _ in range(rng.randint(1, 4)):
                w[rng.randrange(len(w))] = rng.choice(vocab)
            family.append(w)
        texts += [rng.choice([" ", "\n"]).join(w) if rng.random() < 0.7 else " ".join(w).upper() for w in family]
    texts += [texts[20]] * 40
    rng.shuffle(texts)
    return texts


def test_query_equals_all_pairs(spark, tmp_path):
    texts = odd_texts(random.Random(4))
    docs = documents(spark, texts).withColumn("h1", F.lit("clash")).withColumn("node", F.lit(1)).withColumn("sig", F.lit(2))
    got = QUERIES["op12_lsh_forest"](spark, save(docs, tmp_path)).collect()
    want = plain_rows(texts)
    assert len({r[2] for r in want}) < len(texts) * 0.7
    assert sorted(map(tuple, got)) == want


def test_regions_cut_at_every_depth_and_groups_dealt_into_blocks(spark):
    rng = random.Random(6)
    base = [f"w{i}" for i in range(150)]
    texts = [" ".join(base)]
    for i in range(60):  # one dense region, in which some texts are linked only through others
        w = list(base)
        for _ in range(rng.randint(1, 4)):
            w[rng.randrange(150)] = f"x{i}"
        texts.append(" ".join(w))
    texts += odd_texts(rng, 15)
    want = plain_rows(texts)
    for region, block in ((5, 1000), (1, 300)):
        got = lf.near_duplicates(documents(spark, texts), region, block).collect()
        assert sorted(map(tuple, got)) == want


def test_links_at_the_threshold_share_a_region(spark):
    """Pairs of sets of 90 shingles with a similarity of exactly 80/100: none may be lost."""
    pairs = [([f"{p}a{i}" for i in range(93)], [f"{p}a{i}" for i in range(83)] + [f"{p}b{i}" for i in range(10)])
             for p in range(120)]
    texts = [" ".join(w) for pair in pairs for w in pair]
    assert all(len(plain_set(a) & plain_set(b)) == 80 for a, b in zip(texts[::2], texts[1::2]))
    got = {r.doc_id: r.component_id for r in lf.near_duplicates(documents(spark, texts)).collect()}
    assert got == {i: i - i % 2 for i in range(len(texts))}


def test_signatures_estimate_similarity():
    same = [f"s{i}" for i in range(160)]
    texts = [" ".join(same + [f"{k}t{i}" for i in range(40)]).encode() for k in range(30)]
    h, begin = lf.shingle_sets(texts)
    sig = lf.signatures(h, begin)
    true = len(set(h[begin[0]:begin[1]]) & set(h[begin[1]:begin[2]])) / len(set(h[begin[0]:begin[2]]))
    got = [(sig[i] == sig[j]).mean() for i in range(30) for j in range(i)]
    assert abs(np.mean(got) - true) < 0.02 and min(got) > true - 4.5 * (true * (1 - true) / 192) ** 0.5


def test_null_ids_repeated_rows_and_empty_table(spark, tmp_path):
    a, b = "a b c d e f g h i j k l m n o p q r s t u v w x y z", "other words than these are in it"
    rows = [(None, a), (5, a), (5, a), (3, a + " 1"), (None, b), (None, b), (8, None), (None, ""), (5, b + " b")]
    df = documents(spark, [t for _, t in rows], [i for i, _ in rows])
    got = QUERIES["op12_lsh_forest"](spark, save(df, tmp_path / "r")).collect()
    want = [(None, 23, 3, False), (5, 23, 3, False), (5, 23, 3, False), (3, 24, 3, True), (None, 4, 5, False),
            (None, 4, 5, False), (8, 0, 8, True), (None, 0, None, True), (5, 5, 5, True)]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert QUERIES["op12_lsh_forest"](spark, save(documents(spark, []), tmp_path / "e")).count() == 0


def test_split_join_leaves_rows_of_heavy_keys_where_they_are(spark):
    left = written(spark.range(9000).selectExpr("if(id < 5000, 1, id) as k", "id as v").union(
        spark.createDataFrame([(None, 1)], "k long, v long")), "left")
    right = spark.createDataFrame([(1, "hot"), (5001, "cold"), (9, "none")], "k long, w string")
    for how in ("inner", "left"):
        got, want = split_join(left, right, ["k"], how), left.join(right, "k", how)
        assert sorted(got.collect(), key=str) == sorted(want.collect(), key=str)
