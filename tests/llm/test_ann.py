"""Recall against brute force, exact scores, copies, edge cases."""

import numpy as np
from helpers import SF_MID, save

from tripwise.llm import ann
from tripwise.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, k=5):
    rows = [(i, np.array(v, np.float64)) for i, v in rows]
    out = {}
    for q, x in rows:
        if q % 50 == 0:
            s = [(-float(x @ y / (np.linalg.norm(x) * np.linalg.norm(y))), i) for i, y in rows if i != q]
            out[q] = [(i, -c) for c, i in sorted((round(c, 12), i) for c, i in s)[:k]]
    return out


def got(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def test_recall_on_the_table(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF_MID}/embeddings.parquet").collect()]
    want, found = brute(rows), got(QUERIES["op5_ann_one_bit"](spark, SF_MID))
    assert want.keys() == found.keys() and all(len(v) == 5 for v in found.values())
    hits = sum(len({i for i, _ in want[q]} & {i for i, _ in found[q]}) for q in want)
    assert hits / (5 * len(want)) >= 0.99
    exact = {q: dict(w) for q, w in want.items()}
    assert all(abs(s - exact[q][i]) < 1e-9 for q in found for i, s in found[q] if i in exact[q])


def test_several_blocks_copies_and_bad_rows(spark, tmp_path, monkeypatch):
    rng = np.random.default_rng(3)
    x = rng.standard_normal((900, 16)).astype(np.float32)
    x[100:500] = x[100]  # one vector for a third of the rows, eight queries among them
    rows = [(int(i), [float(v) for v in row], 0) for i, row in enumerate(x)]
    good = [(i, v) for i, v, _ in rows]
    bad = [(1000, None, 0), (1050, [0.0] * 16, 0), (1100, [None] + [1.0] * 15, 0), (1150, [float("nan")] * 16, 0),
           (1200, [float("inf")] + [1.0] * 15, 0), (1250, [1.0] * 3, 0), (None, [1.0] * 16, 0), rows[0], rows[100], (1300, [], 0)]
    monkeypatch.setattr(ann, "ENTRIES", 100)
    monkeypatch.setattr(ann, "QUERIES", 4)
    found = got(QUERIES["op5_ann_one_bit"](spark, save(spark.createDataFrame(rows + bad, SCHEMA), tmp_path, "embeddings")))
    want = brute(good)
    assert want.keys() == found.keys()
    assert sum(len({i for i, _ in want[q]} & {i for i, _ in found[q]}) for q in want) / (5 * len(want)) >= 0.97
    for q in range(100, 500, 50):
        assert [i for i, _ in found[q]] == [i for i in range(100, 107) if i != q][:5]


def test_every_vector_of_an_id_and_every_length_take_part(spark, tmp_path):
    rows = [(50, [1.0, 0.0], 0), (1, [1.0, 0.1], 0), (1, [0.0, 1.0], 0), (2, [1.0, 1.0], 0), (2, [1.0, 1.0], 0), (3, [0.5, 0.5], 0),
            (100, [1.0, 0.0, 0.0], 0), (4, [1.0, 0.0, 1.0], 0), (5, [0.0, 1.0, 0.0], 0), (150, [1.0], 0),
            (200, [0.0, 0.0, 0.0, 1.0], 0), (200, [0.0, 0.0, 1.0, 1.0], 0), (9, [0.0, 0.0, 0.0, 2.0], 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    found = QUERIES["op5_ann_one_bit"](spark, save(df, tmp_path, "embeddings")).collect()
    of = lambda q: [(r.rank, r.vec_id, round(r.score, 6)) for r in sorted(found) if r.query_id == q]
    assert of(50) == [(1, 1, 0.995037), (2, 2, 0.707107), (3, 3, 0.707107), (4, 1, 0.0)]
    assert of(100) == [(1, 4, 0.707107), (2, 5, 0.0)] and of(150) == []
    assert of(200) == [(1, 9, 0.707107), (1, 9, 1.0), (2, 200, 0.707107), (2, 200, 0.707107)]


def test_few_rows_and_empty(spark, tmp_path):
    few = spark.createDataFrame([(0, [1.0, 0.0], 0), (50, [1.0, 1.0], 0), (7, [0.0, 2.0], 0)], SCHEMA)
    found = got(QUERIES["op5_ann_one_bit"](spark, save(few, tmp_path / "f", "embeddings")))
    assert {q: [i for i, _ in v] for q, v in found.items()} == {0: [50, 7], 50: [0, 7]}
    assert abs(found[0][1][1]) < 1e-15
    assert QUERIES["op5_ann_one_bit"](spark, save(few.limit(0), tmp_path / "e", "embeddings")).count() == 0


def test_estimates_lie_within_their_bounds():
    rng = np.random.default_rng(1)
    x, q = rng.standard_normal((2000, 64)), rng.standard_normal((50, 64))
    turn = ann.rotation(64)
    assert np.allclose(turn.T @ turn, np.eye(64), atol=1e-5)
    packed, f = ann.codes_of(x, turn)
    signs = np.unpackbits(packed, axis=1).astype(np.float32) * 2 - 1
    low, high = ann.bounds(q, signs, f, turn, ann.EPSILON)
    true = ann._units(q) @ ann._units(x).T
    assert ((low <= true) & (true <= high)).mean() > 0.93
