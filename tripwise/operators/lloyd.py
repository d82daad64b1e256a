"""K-means for many centre sets at once: one scan of the points an iteration.

A cell is one fit, known by (k, restart).  All live cells take part in the same pass: a
task assigns its points to the nearest centres of every cell and emits one row of
sums for each cluster of each cell; a group-by on (k, restart, cluster) merges them, so what
reaches the driver is one row a cluster, whatever the data.  Cells whose centres moved by no more than
``TOL`` leave; the loop ends with the last one, or after ``max_iter`` passes.

Points are stored once in blocks of near neighbours, each with its box and its sums (the filtering of Kanungo et al.).  A block
whose box lies nearer to one centre than to all others in every corner adds its sums; only the points of the other
blocks, those across a border of clusters, are assigned one by one.  So a pass costs by blocks and borders, not by
points times centres, and every point is assigned as alone.

Seeds are points in the order of a stored hash: restart r of every k begins with the first k
different points ordered by ``md5('<lat>,<lon>,<seed + r>')`` of the coordinates in millionths of a degree.
They depend on the points alone, not on partitions or on the order of rows, and SQL can repeat them.  Only
points whose hash lies below a bound are sorted, a bound that leaves a few hundred of them; the points
counted once, a station with a third of all trips is one candidate.

A point may carry a ``weight`` (distinct points with their counts): the sums, and so the centres,
are those of that many copies.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from tripwise.session import spread, stored

Cell = tuple[int, int]

# Fixed value of the source's trainer: a set of centres is settled if none moves further.
TOL = 1e-4
#: Points that a hash bound should leave for each seed wanted.
SPARE = 64


def point_hash(lat: Column, lon: Column, seed: int) -> Column:
    """Hash of a point as 32 hexadecimal digits."""
    unit = lambda c: F.floor(c * 1e6 + 0.5).cast("bigint").cast("string")
    return F.md5(F.concat_ws(",", unit(lat), unit(lon), F.lit(str(seed))).cast("binary"))


def point_hash_sql(lat: str, lon: str, seed: str) -> str:
    unit = lambda c: f"floor({c}*1e6 + 0.5)::bigint::varchar"
    return f"md5(concat_ws(',', {unit(lat)}, {unit(lon)}, ({seed})::varchar))"


def seeds(points: DataFrame, most: int, restarts: int, seed: int) -> dict[int, np.ndarray]:
    """The first ``most`` different points (fewer if there are fewer) of each restart's order."""
    lat, lon = F.col("lat"), F.col("lon")
    n = points.agg(F.approx_count_distinct(F.struct(lat, lon)).alias("n")).first()["n"]
    order = Window.partitionBy("restart").orderBy("h", "lat", "lon")

    def first(bound: float) -> dict[int, np.ndarray]:
        hashes = F.array(*[F.struct(F.lit(r).alias("restart"), point_hash(lat, lon, seed + r).alias("h"))
                           for r in range(restarts)])
        rows = points.select(lat, lon, F.explode(hashes).alias("at")).select("lat", "lon", "at.*")
        if bound < 1:
            rows = rows.filter(F.col("h") < F.lit(f"{int(bound * (1 << 32)):08x}"))
        rows = rows.distinct().withColumn("place", F.row_number().over(order)).filter(F.col("place") <= most)
        out: dict[int, list] = {r: [] for r in range(restarts)}
        for row in sorted(rows.collect(), key=lambda row: (row["restart"], row["place"])):  # most * restarts rows
            out[row["restart"]].append((row["lat"], row["lon"]))
        return {r: np.array(c, dtype=float).reshape(-1, 2) for r, c in out.items()}

    bound = SPARE * most / max(1, n)
    found = first(bound)
    if bound < 1 and any(len(c) < most for c in found.values()):  # an unlucky bound: all points take part
        found = first(1.0)
    return found


def _nearest(lat: np.ndarray, lon: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Cluster of every point (ties to the lowest)."""
    best, at = np.full(lat.shape, np.inf), np.zeros(lat.shape, np.int64)
    for j, (a, b) in enumerate(centres):
        d = (lat - a) ** 2 + (lon - b) ** 2
        np.copyto(at, j, where=d < best)
        np.fmin(best, d, out=best)
    return at


BLOCK = 256                  # points of a block
CHUNK = 1 << 20              # points that a task cuts into blocks at once
#: Box (middle, half sides), sums of a block, and its latitudes, longitudes and weights, one after the other.
BLOCKS = "mid_lat double, mid_lon double, half_lat double, half_lon double, n double, lat double, lon double, points binary"


def _cut(lat: np.ndarray, lon: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Points as blocks (blocks x 3 x BLOCK): strips by latitude, cut by longitude.  The last block is filled with
    copies of its last point that weigh nothing."""
    n = -(-len(lat) // BLOCK)
    strip = np.empty(len(lat), np.int64)
    strip[np.argsort(lat, kind="stable")] = np.arange(len(lat)) // (BLOCK * -(-n // max(1, round(n ** 0.5))))
    order = np.lexsort((lon, strip))
    order = np.concatenate([order, np.full(n * BLOCK - len(order), order[-1])])
    weight = w[order]
    weight[len(lat):] = 0
    return np.stack([v.reshape(n, BLOCK) for v in (lat[order], lon[order], weight)], axis=1)


def blocks(points: DataFrame) -> DataFrame:
    """The points (lat, lon, weight) in blocks of near neighbours, dealt over all cores."""
    names = [c.split()[0] for c in BLOCKS.split(", ")]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def cut() -> pa.RecordBatch:
            p = _cut(*(np.concatenate([b.column(i).to_numpy() for b in held]) for i in range(3)))
            lo, hi = p[:, :2].min(axis=2), p[:, :2].max(axis=2)
            with np.errstate(invalid="ignore"):
                mid = (lo + hi) / 2
                half = np.maximum(hi - mid, mid - lo)
            sums = [p[:, 2].sum(axis=1), (p[:, 2] * p[:, 0]).sum(axis=1), (p[:, 2] * p[:, 1]).sum(axis=1)]
            cols = [pa.array(c) for c in (*mid.T, *half.T, *sums)] + [pa.array([x.tobytes() for x in p], pa.binary())]
            return pa.RecordBatch.from_arrays(cols, names)

        held, rows = [], 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= CHUNK:
                yield cut()
                held, rows = [], 0
        if rows:
            yield cut()

    return spread(points.select("lat", "lon", "weight").mapInArrow(work, BLOCKS))


def _owner(mid: np.ndarray, half: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """The centre that is nearest to every point of each box, or -1.  The margin is beyond any rounding of distances."""
    with np.errstate(invalid="ignore", over="ignore"):
        d = ((mid[:, None, :] - centres[None]) ** 2).sum(axis=2)
        at = d.argmin(axis=1)
        apart = np.abs(centres[None] - centres[at][:, None, :])           # blocks x centres x 2
        most = d[np.arange(len(at)), at][:, None] - d + 2 * (half[:, None, :] * apart).sum(axis=2)
        margin = 1e-12 * ((mid ** 2).sum(axis=1) + (half ** 2).sum(axis=1) + (centres ** 2).sum(axis=1).max())
        sure = most < -margin[:, None]
    sure[np.arange(len(at)), at] = np.isfinite(margin)
    return np.where(sure.all(axis=1), at, -1)


SUMS = "k int, restart int, cluster int, n double, lat double, lon double"


def cluster_sums(points: DataFrame, cells: dict[Cell, np.ndarray]) -> DataFrame:
    """For each cluster of each cell: weight and sums of the coordinates, in one pass over ``blocks``."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {cell: np.zeros((len(c), 3)) for cell, c in cells.items()}
        for batch in batches:
            if not batch.num_rows:
                continue
            mid_lat, mid_lon, half_lat, half_lon, *sums = (batch.column(i).to_numpy() for i in range(7))
            mid, half, held = np.column_stack([mid_lat, mid_lon]), np.column_stack([half_lat, half_lon]), batch.column(7)
            for cell, centres in cells.items():
                owner = _owner(mid, half, centres)
                whole, split = owner >= 0, np.flatnonzero(owner < 0)
                for j, v in enumerate(sums):
                    total[cell][:, j] += np.bincount(owner[whole], v[whole], len(centres))
                for a in range(0, len(split), CHUNK // BLOCK):
                    p = np.stack([np.frombuffer(held[int(i)].as_buffer()).reshape(3, BLOCK) for i in split[a:a + CHUNK // BLOCK]])
                    lat, lon, w = (p[:, i].ravel() for i in range(3))
                    at = _nearest(lat, lon, centres)
                    for j, v in enumerate((w, w * lat, w * lon)):
                        total[cell][:, j] += np.bincount(at, v, len(centres))
        rows = [(k, r, j, *sums) for (k, r), t in total.items() for j, sums in enumerate(t.tolist()) if sums[0]]
        yield pa.RecordBatch.from_pylist([dict(zip(names, row)) for row in rows], schema)

    names = [c.split()[0] for c in SUMS.split(", ")]
    schema = pa.schema([(c, pa.int32() if i < 3 else pa.float64()) for i, c in enumerate(names)])
    sums = [F.sum(c).alias(c) for c in ("n", "lat", "lon")]
    return points.mapInArrow(work, SUMS).groupBy("k", "restart", "cluster").agg(*sums)


def fit(points: DataFrame, cells: Sequence[Cell], seed: int, max_iter: int, tol: float = TOL, journal=None,
        key: str = "") -> dict[Cell, np.ndarray]:
    """Settled centres of every cell (k, restart) over ``points`` (lat, lon, weight), whose blocks are read once a pass.
    With a ``journal`` (``Ledger``) each pass leaves its centres under ``key``, and a later call begins with them."""
    kept = journal.get(key) if journal else None
    if kept:
        done, now = kept["done"], {(k, r): np.array(c, dtype=float).reshape(-1, 2) for k, r, c in kept["now"]}
        live = {(k, r) for k, r in kept["live"]}
    else:
        begin = seeds(points, max(k for k, _ in cells), max(r for _, r in cells) + 1, seed)
        done, now = 0, {(k, r): begin[r][:k].copy() for k, r in cells}
        live = {cell for cell in cells if len(now[cell])}
    near = stored(blocks(points), "blocks") if live and done < max_iter else None
    for done in range(done + 1, max_iter + 1):
        if not live:
            break
        moved = {cell: now[cell].copy() for cell in live}
        for row in cluster_sums(near, {cell: now[cell] for cell in sorted(live)}).collect():  # a row a cluster
            moved[row["k"], row["restart"]][row["cluster"]] = row["lat"] / row["n"], row["lon"] / row["n"]
        for cell, centres in moved.items():
            far = ((centres - now[cell]) ** 2).sum(axis=1).max()
            now[cell] = centres
            if far <= tol * tol:
                live.discard(cell)
        if journal:
            journal.put(key, dict(done=done, now=[(*cell, c.tolist()) for cell, c in now.items()], live=sorted(live)))
    return now
