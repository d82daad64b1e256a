"""Fingerprints by a second formula; links and components against all pairs."""

import random

import numpy as np
import xxhash
from pyspark.sql import functions as F
from helpers import documents, save

from tripwise.llm import simhash as sh
from tripwise.llm.queries import QUERIES


def plain_fingerprint(text, k=4):
    words, word = [], ""
    for c in (text or "") + " ":
        if c in " \t\n\v\f\r":
            words += [word] if word else []
            word = ""
        else:
            word += chr(ord(c) + 32) if "A" <= c <= "Z" else c
    if not words:
        return 0
    grams = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def plain_components(fps, bits=4):
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    fps = sorted(set(fps))
    for i, a in enumerate(fps):
        for b in fps[i + 1:]:
            if (a ^ b).bit_count() <= bits:
                root[find(b)] = find(a)
    return {f: find(f) for f in fps}


def check(rows, texts):
    fps = [plain_fingerprint(t) for t in texts]
    assert {(r.doc_id, r.fingerprint) for r in rows} == {(i, f"{f:016x}") for i, f in enumerate(fps)}
    group = plain_components(fps)
    least = {}
    for i, f in enumerate(fps):
        least.setdefault(group[f], i)
    assert {r.doc_id: r.component_id for r in rows} == {i: least[group[f]] for i, f in enumerate(fps)}


def test_query_equals_all_pairs(spark, tmp_path):
    rng = random.Random(5)
    vocab = ["w%d" % i for i in range(40)] + ["É", "Straße", "ÀB", "x\x85y"]
    base = [" ".join(rng.choices(vocab, k=rng.randint(1, 120))) for _ in range(60)]
    texts = [None, "", " \n", "one", "One", "two  words", "a b c", "a b c d", "a b c d e"] + base
    for t in base * 3:  # near copies: one word changed
        w = t.split(" ")
        w[rng.randrange(len(w))] = rng.choice(vocab)
        texts.append((" " if rng.random() < 0.5 else "\t\n").join(w).upper() if rng.random() < 0.3 else " ".join(w))
    texts += [base[0]] * 30
    rows = QUERIES["op8_simhash_near_dedup"](spark, save(documents(spark, texts), tmp_path)).collect()
    assert len(rows) == len(texts)
    check(rows, texts)


def test_links_connect_like_all_pairs_even_in_dealt_cells(spark):
    rng = random.Random(1)
    fps = {0, (1 << 64) - 1}
    for _ in range(30):  # clusters around centres, some of them dense
        centre = rng.getrandbits(64)
        for _ in range(rng.choice([2, 5, 150])):
            f = centre
            for _ in range(rng.randint(0, 5)):
                f ^= 1 << rng.randrange(64)
            fps.add(f)
    want = plain_components(fps)
    df = spark.createDataFrame([(int(np.uint64(f).view(np.int64)),) for f in fps], "fp long")
    for max_cell in (50_000, 40):
        links = sh.links(df, 4, max_cell)
        pairs = [(int(np.int64(r.a).view(np.uint64)), int(np.int64(r.b).view(np.uint64))) for r in links.collect()]
        assert all((a ^ b).bit_count() <= 4 for a, b in pairs)
        roots = {r.node: r.root for r in sh.components(links).collect()}
        got = {f: roots.get(int(np.uint64(f).view(np.int64)), int(np.uint64(f).view(np.int64))) for f in fps}
        same = lambda m: {frozenset(k for k in m if m[k] == v) for v in set(m.values())}
        assert same(got) == same(want)
    assert len(pairs) < 15 * len(fps) * 40


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 400), (7, 7)], "a long, b long")
    got = {r.node: r.root for r in sh.components(edges).collect()}
    assert got == {i: 0 for i in range(201)} | {500: 400, 400: 400}


def test_empty_table_and_repeated_rows(spark, tmp_path):
    assert QUERIES["op8_simhash_near_dedup"](spark, save(documents(spark, []), tmp_path / "e")).count() == 0
    df = documents(spark, ["a b c d e", "a b c d e", None, "x"], [3, 3, None, None]).withColumn("fp", F.lit(1))
    rows = QUERIES["op8_simhash_near_dedup"](spark, save(df, tmp_path / "r")).collect()
    assert len(rows) == 4 and sorted(r.component_id or -1 for r in rows) == [-1, -1, 3, 3]


def test_one_row_of_each_component_stays_whatever_its_key(spark):
    words = [" ".join(f"{name}{i}" for i in range(40)) for name in ("ash", "bay", "cat", "dog", "elm")]
    a, b, c, d, e = words
    rows = [(1, a), (5, b), (5, a), (9, b), (7, c), (7, d), (None, a), (None, e), (None, e), (None, e.upper()), (8, c), (7, c),
            (3, d + "  "), (2, None), (2, "")]
    assert len({sh.fingerprint(x) for x in words}) == 5
    docs = documents(spark, [t for _, t in rows], [i for i, _ in rows]).withColumn("__text", F.lit("clash"))
    left = sh.one_of_each(docs)
    assert left.columns == docs.columns
    left = left.collect()
    assert {r["__text"] for r in left} == {"clash"}
    # a: row 1; b: row 5, though another text of 5 goes; c: row 7; d: row 3; e: a row without an id, the smallest text.
    assert sorted(((r.doc_id, r.text) for r in left), key=str) == sorted(
        [(1, a), (5, b), (7, c), (3, d + "  "), (None, e.upper()), (2, None)], key=str)
