"""Location clusters: nearest-centre assignment, cost, elbow choice of k, k-means fits.

Centres are few (k <= 12), so assignment is a single column expression over
a literal array of centres: no join, no Python, whole-stage code generation.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripwise.operators import lloyd
from tripwise.session import spread, stored
from tripwise.sources.ledger import Ledger, fingerprint, key_of

Centre = tuple[float, float]

# Fixed values of the cluster search: candidate k, restarts per k, iterations.
K_GRID = (6, 7, 8, 9, 10, 11, 12)
RESTARTS = 5
MAX_ITER = 200


def _sq_dist(lat: Column, lon: Column, c: Centre) -> Column:
    a, b = lat - F.lit(float(c[0])), lon - F.lit(float(c[1]))
    return a * a + b * b  # a product: pow() runs in software


def nearest_centre(lat: Column, lon: Column, centres: Sequence[Centre]) -> Column:
    """Index of the nearest centre (squared distance; ties go to the lowest index)."""
    cands = F.array(*[F.struct(_sq_dist(lat, lon, c).alias("d2"), F.lit(i).alias("k"))
                      for i, c in enumerate(centres)])
    best = F.array_min(cands).getField("k").cast("double")
    return F.when(lat.isNull() | lon.isNull(), F.lit(None).cast("double")).otherwise(best)


def min_sq_distance(lat: Column, lon: Column, centres: Sequence[Centre]) -> Column:
    return F.least(*[_sq_dist(lat, lon, c) for c in centres]) if len(centres) > 1 \
        else _sq_dist(lat, lon, centres[0])


def assign_clusters(df: DataFrame, centres: Sequence[Centre],
                    start: tuple[str, str] = ("lat1", "lon1"),
                    end: tuple[str, str] = ("lat2", "lon2")) -> DataFrame:
    """Add ``km1`` (start point cluster) and ``km2`` (end point cluster)."""
    return (df.withColumn("km1", nearest_centre(F.col(start[0]), F.col(start[1]), centres))
              .withColumn("km2", nearest_centre(F.col(end[0]), F.col(end[1]), centres)))


def kmeans_cost(df: DataFrame, centres: Sequence[Centre], lat: str = "lat2", lon: str = "lon2") -> DataFrame:
    """One row: within-cluster sum of squared distances."""
    return df.agg(F.sum(min_sq_distance(F.col(lat), F.col(lon), centres)).alias("cost"))


def cost_table(df: DataFrame, centre_sets: dict, lat: str = "lat2", lon: str = "lon2") -> DataFrame:
    """(k, restart, cost) for several centre sets, computed in ONE pass over ``df``.

    ``centre_sets`` maps k, or (k, restart), to that fit's centres.  Rows with a
    ``weight`` count as so many.
    """
    weight = F.col("weight") if "weight" in df.columns else F.lit(1.0)
    keys = sorted((key if isinstance(key, tuple) else (key, 1)) for key in centre_sets)
    sets = {key: centre_sets[key] if key in centre_sets else centre_sets[key[0]] for key in keys}
    agg = df.agg(*[F.sum(weight * min_sq_distance(F.col(lat), F.col(lon), sets[key])).alias(f"c{i}")
                   for i, key in enumerate(keys)])
    stack = "stack({n}, {items}) as (k, restart, cost)".format(
        n=len(keys), items=", ".join(f"{k}, {r}, c{i}" for i, (k, r) in enumerate(keys)))
    return agg.selectExpr(stack).select(F.col("k").cast("int"), F.col("restart").cast("int"), "cost")


def elbow_table(costs: DataFrame) -> DataFrame:
    """Mean cost per k and the second difference J(k-2) + J(k) - 2 J(k-1).

    ``is_best`` marks k-1 of the largest second difference; strict '>' in a
    k-ordered scan means the earliest maximum wins and NaN never wins.  The
    input is one row per (k, restart): a grid-sized table, not data-sized.
    """
    w = Window.orderBy("k")
    mean = costs.groupBy("k").agg(F.avg("cost").alias("mean_cost"))
    t = mean.withColumn("asd", F.lag("mean_cost", 2).over(w) + F.col("mean_cost")
                        - F.lit(2.0) * F.lag("mean_cost", 1).over(w))
    valid = F.col("asd").isNotNull() & ~F.isnan("asd")
    ranked = t.withColumn("rank", F.when(valid, F.row_number().over(
        Window.orderBy(F.when(valid, F.col("asd")).desc_nulls_last(), F.col("k")))))
    # The chosen k is the middle one of the best triple (k - 1); with fewer
    # than three k the smallest k stands.
    best = ranked.where(F.col("rank") == 1).select((F.col("k") - 1).alias("best_k")).scalar()
    chosen = F.coalesce(best, costs.agg(F.min("k")).scalar())
    return ranked.select("k", "mean_cost", "asd", (F.col("k") == chosen).alias("is_best"))


def kmeans_points(points: DataFrame, lat: str = "lat2", lon: str = "lon2", weighted: bool = False) -> DataFrame:
    """The points k-means clusters: lat, lon, weight.

    ``weighted``: one row per distinct point with its count as ``weight``.  Centre updates and
    cost are sums over points, so a distinct point with weight w counts exactly like w copies;
    for station based trips this turns every iteration over all trips into one over a few
    hundred stations (one partially aggregated group-by, safe under skew).
    """
    p = points.select(F.col(lat).cast("double").alias("lat"), F.col(lon).cast("double").alias("lon")).dropna()
    if weighted:
        return p.groupBy("lat", "lon").agg(F.count(F.lit(1)).cast("double").alias("weight"))
    return p.withColumn("weight", F.lit(1.0))


@dataclass
class CentreModel:
    """Location clusters: a few centres, kept as a table (cluster, lat, lon)."""
    centres: list[Centre]

    def save(self, spark: SparkSession, path: str) -> None:
        rows = [(i, *map(float, c)) for i, c in enumerate(self.centres)]
        spark.createDataFrame(rows, "cluster int, lat double, lon double").coalesce(1).write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> "CentreModel":
        rows = spark.read.parquet(path).orderBy("cluster").collect()
        return CentreModel([(r["lat"], r["lon"]) for r in rows])


def fit_kmeans(points: DataFrame, k: int, seed: int, max_iter: int = MAX_ITER,
               lat: str = "lat2", lon: str = "lon2", weighted: bool = False) -> CentreModel:
    """One fit: seeds in stored hash order, Euclidean distance, at most ``max_iter`` iterations (``lloyd``)."""
    pts = stored(spread(kmeans_points(points, lat, lon, weighted)), "points")
    return _model(lloyd.fit(pts, [(k, 0)], seed, max_iter)[k, 0])


def _model(centres) -> CentreModel:
    return CentreModel([(float(a), float(b)) for a, b in centres])


def centres_of(model: CentreModel) -> list[Centre]:
    return list(model.centres)


def select_k(spark: SparkSession, points: DataFrame, ks: Sequence[int] = K_GRID, restarts: int = RESTARTS,
             max_iter: int = MAX_ITER, seed: int = 42, lat: str = "lat2", lon: str = "lon2", weighted: bool = False,
             journal: Ledger | None = None):
    """Fit every (k, restart) cell, average the cost per k, choose k by the elbow.

    Returns (model, elbow DataFrame, cost DataFrame).  The chosen model is the
    restart-0 fit of the chosen k (identical to a refit with the same seed).
    All cells run in one loop, one scan of the stored points an iteration.
    The cost of a cell is that of its final centres, for all cells in one more
    pass.  ``weighted`` reduces the points to distinct ones with their counts first: the same
    seeds and, but for the order of sums, the same centres.  ``journal`` keeps the centres of each pass over
    the same points with the same parameters, for a search that begins again.
    """
    pts = stored(spread(kmeans_points(points, lat, lon, weighted)), "points")
    key = key_of(points=fingerprint(pts), ks=list(ks), restarts=restarts, max_iter=max_iter, seed=seed) if journal else ""
    fitted = lloyd.fit(pts, [(k, r) for k in ks for r in range(restarts)], seed, max_iter, journal=journal, key=key)
    # Fewer different points than centres: what there is.  No point at all: no cost.
    sets = {cell: _model(c).centres for cell, c in fitted.items() if len(c)}
    costs = [tuple(c) for c in cost_table(pts, sets, "lat", "lon").collect()] if sets else []
    costs = spark.createDataFrame(costs, "k int, restart int, cost double")
    elbow = elbow_table(costs)
    best = elbow.where("is_best").first()
    return _model(fitted[best["k"] if best else min(ks), 0]), elbow, costs
