"""Runs against a plain search over every lag and place."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from helpers import documents, save
from pyspark.sql import functions as F

from tripwise.llm import periodic_runs as pr
from tripwise.llm.queries import QUERIES


def plain_runs(w):
    """All runs by comparing every word with every later one."""
    n, best = len(w), {}
    for q in range(1, n // 2 + 1):
        t = 0
        while t + q < n:
            if w[t] != w[t + q]:
                t += 1
                continue
            s = t
            while t + q < n and w[t] == w[t + q]:
                t += 1
            if t - s + q >= max(12, 2 * q):
                best.setdefault((s, t - s + q), q)  # the smallest period comes first
    return sorted((s, length, q) for (s, length), q in best.items())


def plain_row(doc_id, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(w)
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = plain_runs(w)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    top = max(found, key=lambda r: (r[1], -r[0], -r[2])) if found else None

    def sha(x):
        return hashlib.sha256(x.encode()).hexdigest()
    return (doc_id, len(found), *((top[0], top[1], top[2], 1000 * top[1] // top[2]) if top else (None,) * 4),
            sha("".join("%d,%d,%d\n" % r for r in found)), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


def odd_texts(rng):
    yield from (None, "", " \t\n", "a", "a " * 11, "a " * 12, "a b " * 6, "a b " * 5 + "a", "\x85 x " * 40, "É é " * 9)
    for _ in range(150):
        letters = rng.choice(["ab", "abc", "abcdefgh"])
        yield " ".join(rng.choice(letters) for _ in range(rng.randint(0, 90)))
    for _ in range(120):  # periods of all bands, inside runs, broken runs, two runs side by side
        parts = []
        for _ in range(rng.randint(1, 4)):
            unit = [rng.choice("ab" if rng.random() < 0.5 else "abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(1, 70))]
            length = int(len(unit) * rng.uniform(0.5, 5))
            part = (unit * 6)[:length]
            if part and rng.random() < 0.3:
                part[rng.randrange(len(part))] = "Z"
            parts += part
        yield rng.choice([" ", "\n\t"]).join(parts)
    a, b = "a", "a b"  # words of Fibonacci: runs of very many periods
    for _ in range(9):
        a, b = b, b + " " + a
    yield b


def test_query_equals_plain_search(spark, tmp_path):
    texts = list(odd_texts(random.Random(3)))
    docs = documents(spark, texts).withColumn("runs", F.lit("clash")).withColumn("collapsed", F.lit(1))
    got = QUERIES["op13_periodic_runs"](spark, save(docs, tmp_path)).collect()
    want = [plain_row(i, t) for i, t in enumerate(texts)]
    assert sum(r[1] for r in want) > 200
    assert sorted(map(tuple, got)) == sorted(want)


@pytest.mark.parametrize("n", [3000, 4097])
def test_very_repetitive_texts_are_found_whole(n):
    def runs(w):
        words = np.array([*w, -1])
        return [tuple(map(int, r)) for r in zip(*pr.find_runs(words, np.zeros(len(words), int)))]
    assert runs([0] * n) == [(0, n, 1)]
    unit = list(range(n // 3))
    assert runs((unit * 4)[:n]) == [(0, n, len(unit))]
    blocks = ([0] * 500 + [1]) * 5
    assert runs(blocks) == plain_runs(blocks)


def test_repeated_rows_null_ids_and_empty_table(spark, tmp_path):
    rows = [("x y " * 10, None), ("x y " * 10, 7), ("x y " * 10, 7), (None, None)]
    df = documents(spark, [t for t, _ in rows], [i for _, i in rows])
    got = QUERIES["op13_periodic_runs"](spark, save(df, tmp_path / "r")).collect()
    assert sorted(map(tuple, got), key=str) == sorted((plain_row(i, t) for t, i in rows), key=str)
    assert QUERIES["op13_periodic_runs"](spark, save(documents(spark, []), tmp_path / "e")).count() == 0


def test_operator_keeps_spans_and_text(spark):
    row = pr.runs(documents(spark, ["so " + "tra la " * 8 + "end"])).first()
    assert [tuple(r) for r in row.runs] == [(1, 16, 2)] and row.collapsed == "so tra la end"


def test_batches_of_any_size_agree(spark, monkeypatch):
    texts = list(odd_texts(random.Random(8)))[:60]
    raw = [(t or "").encode() for t in texts]
    whole = pr._batch(raw)
    single = [pr._batch([t]) for t in raw]
    assert whole[0].to_pylist() == [s[0].to_pylist()[0] for s in single]
    assert whole[1].to_pylist() == [s[1].to_pylist()[0] for s in single]
