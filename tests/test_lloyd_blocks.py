"""K-means passes over blocks: the same sums as a plain assignment of every point, few points assigned one by one, all
cores at work."""

import numpy as np
import pandas as pd
import pytest

from tripwise.operators import clustering, lloyd
from tripwise.session import spread, stored


def _plain(x, w, centres):
    at = ((x[:, None, :] - centres[None]) ** 2).sum(axis=2).argmin(axis=1)
    return {j: (w[at == j].sum(), *(w[at == j, None] * x[at == j]).sum(axis=0)) for j in np.unique(at)}


def test_blocks_give_the_sums_of_single_points(spark):
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.normal((40.7, -74.0), 0.05, (3000, 2)), np.full((700, 2), (40.75, -73.9)),
                        rng.integers(0, 9, (1300, 2)) / 8.0])  # a crowd, a station, a lattice with ties
    w = rng.integers(1, 4, len(x)).astype(float)
    pts = spark.createDataFrame(pd.DataFrame({"lat": x[:, 0], "lon": x[:, 1], "weight": w}))
    cells = {(5, 0): x[:5], (3, 1): x[[10, 3100, 4000]], (4, 2): np.array([[0.25, 0.25], [0.25, 0.75], [0.75, 0.25], [40.7, -74]]),
             (2, 3): np.array([[40.7, -74.0], [40.7, -74.0]])}
    near = stored(lloyd.blocks(pts), "blocks")
    assert near.selectExpr("sum(n)").first()[0] == w.sum()
    got = {cell: {} for cell in cells}
    for r in lloyd.cluster_sums(near, cells).collect():
        got[r["k"], r["restart"]][r["cluster"]] = (r["n"], r["lat"], r["lon"])
    for cell, centres in cells.items():
        want = _plain(x, w, centres)
        assert got[cell].keys() == want.keys()
        for j, sums in want.items():
            assert got[cell][j] == pytest.approx(sums, rel=1e-12, abs=1e-9)


def test_points_off_the_borders_are_not_assigned_one_by_one():
    x = np.random.default_rng(6).random((200_000, 2))
    p = lloyd._cut(x[:, 0], x[:, 1], np.ones(len(x)))
    lo, hi = p[:, :2].min(axis=2), p[:, :2].max(axis=2)
    centres = x[:8]
    owner = lloyd._owner((lo + hi) / 2, (hi - lo) / 2, centres)
    assert (owner >= 0).mean() > 0.6
    for i in np.flatnonzero(owner >= 0):
        assert (lloyd._nearest(p[i, 0], p[i, 1], centres) == owner[i]).all()
    assert lloyd._owner(np.array([[np.inf, 0.0]]), np.zeros((1, 2)), centres).tolist() == [-1]  # assigned as before


def test_points_of_one_file_are_read_by_all_cores(spark):
    pts = stored(spread(clustering.kmeans_points(spark.range(2000).selectExpr("id / 10 as lat2", "id / 20 as lon2").coalesce(1))), "points")
    cores = spark.sparkContext.defaultParallelism
    assert pts.rdd.getNumPartitions() >= cores
    assert stored(lloyd.blocks(pts), "blocks").rdd.getNumPartitions() >= min(cores, 4)
    assert pts.count() == 2000
