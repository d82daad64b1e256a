"""Train / test / predict for taxi or bike trips with a tree, forest or linear model.

run(spark, weather, trips, model_dir, kmeans_dir, dataset, algo, mode):

* training:   choose k and fit location clusters on the trips' END points;
              build labelled features (bounded, outliers removed); split;
              grid-search the algorithm; publish clusters, best model and
              split as one version (``bundle``).
* test:       load the published version; score every labelled row; write
              features + prediction + residual to ``<model_dir>_out_test``;
              report the all-rows MSE and the held-out MSE separately.
* prediction: load the published version; score unlabelled rows; write to
              ``<model_dir>_out_prediction``.

Output is partitioned by day (``dt``); with ``replace="days"`` a run overwrites
the days it has rows of and leaves the others.  (The speed bounds of a test run are
those of the trips it is given.)  With ``journal_dir`` a training
that lost its driver goes on where it stopped.

One feature definition serves all three modes, so training and serving agree.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tripwise.operators import clustering, models, scoring, splits
from tripwise.operators.outliers import duration_closed, speed_3sigma
from tripwise.plans import bundle
from tripwise.plans.features import LABEL, build_features, feature_names, joined_features
from tripwise.session import scratch_space, stored
from tripwise.sources import readers, writers
from tripwise.sources.ledger import Ledger

DATASETS = ("taxi", "bike")
ALGOS = ("dt", "rf", "lr")
MODES = ("training", "test", "prediction")


@dataclass
class RunOptions:
    seed: int = 42
    train_fraction: float = 0.7
    split: str = "hash"                      # "hash" (reproducible) or "random"
    cells: list[dict] | None = None          # None = the full original grid
    k_grid: tuple[int, ...] = clustering.K_GRID
    restarts: int = clustering.RESTARTS
    kmeans_iter: int = clustering.MAX_ITER
    parallelism: int = 8
    kmeans_weighted: bool = False            # reduce the points to distinct ones with counts first
    output_format: str = "parquet"
    replace: str = "all"                     # what scored output a run overwrites: "all", or its "days" only
    journal_dir: str | None = None           # finished parts of the searches are kept there, for a resumed training
    rejects_dir: str | None = None           # where rejected trip lines go, with their reasons


def _validate(dataset: str, algo: str, mode: str) -> tuple[str, str, str]:
    d, a, m = dataset.lower(), algo.lower(), mode.lower()
    if d not in DATASETS or a not in ALGOS or m not in MODES:
        raise ValueError(f"usage: dataset in {DATASETS}, algo in {ALGOS}, mode in {MODES}; "
                         f"got {dataset!r}, {algo!r}, {mode!r}")
    return d, a, m


def _frame(spark: SparkSession, src, reader) -> DataFrame:
    return src if isinstance(src, DataFrame) else reader(spark, src)


def _counts(lines: DataFrame) -> dict[str, int]:
    return {r["reason"]: r["lines"] for r in readers.rejects_by_reason(lines).collect()}


def _trips(spark: SparkSession, src, dataset: str, labelled: bool, opts: RunOptions) -> tuple[DataFrame, dict]:
    """Trips and how many lines were accepted or rejected for what, from ONE read of the files: all lines are
    stored with their reason, good and bad ones are told apart there."""
    if isinstance(src, DataFrame):
        return src, {}
    lines = readers.trip_lines(spark, src, dataset, labelled)
    lines = stored(lines.withColumn("raw", F.when(F.col("reject").isNotNull(), F.col("raw"))), "trip-lines")
    if opts.rejects_dir:
        lines.where("reject is not null").select("reject", "raw").write.mode("overwrite").parquet(opts.rejects_dir)
    return readers.good_trips(lines), {"trips": _counts(lines)}


def held_out(opts: RunOptions):
    """The held-out condition of the hash split (test rows of training)."""
    return splits.hash_fraction(F.col("trip_id"), opts.seed) >= F.lit(opts.train_fraction)


def split_frame(df: DataFrame, opts: RunOptions) -> DataFrame:
    """``df`` with ``is_train``: one frame, computed once."""
    if opts.split == "random":
        return models.flagged(*splits.split_random(df, opts.seed, (opts.train_fraction, 1 - opts.train_fraction)))
    return df.withColumn("is_train", ~held_out(opts))


def labelled_features(trips: DataFrame, weather: DataFrame, centres, dataset: str, carry=()) -> DataFrame:
    """Bounded, outlier-free feature rows from ONE read of the trips: the bounded join is stored once, and
    the speed statistics and the filtered rows both come from there."""
    joined = duration_closed(joined_features(trips, weather, centres, dataset, labelled=True, carry=carry), LABEL)
    return speed_3sigma(stored(joined, "features"), "dist", LABEL)


def run(spark: SparkSession, weather, trips, model_dir: str, kmeans_dir: str, dataset: str, algo: str,
        mode: str, opts: RunOptions | None = None) -> dict:
    """One mode for one dataset and algorithm; what it returns are values and paths, so its scratch tables go with it."""
    dataset, algo, mode = _validate(dataset, algo, mode)
    with scratch_space(spark):
        return _run(spark, weather, trips, model_dir, kmeans_dir, dataset, algo, mode, opts or RunOptions())


def _run(spark: SparkSession, weather, trips, model_dir: str, kmeans_dir: str, dataset: str, algo: str, mode: str,
         opts: RunOptions) -> dict:
    feats = feature_names(dataset)
    labelled = mode != "prediction"
    w = _frame(spark, weather, readers.read_weather).persist()
    t, rejects = _trips(spark, trips, dataset, labelled, opts)
    if not isinstance(weather, DataFrame):  # a line a day
        rejects["weather"] = _counts(readers.weather_lines(spark, weather))
    try:
        if mode == "training":
            journal = Ledger(spark, opts.journal_dir) if opts.journal_dir else None
            km, elbow, _ = clustering.select_k(spark, t, opts.k_grid, opts.restarts, opts.kmeans_iter,
                                               opts.seed, weighted=opts.kmeans_weighted, journal=journal)
            both = split_frame(labelled_features(t, w, clustering.centres_of(km), dataset), opts)
            best, results, cell = models.grid_search(spark, algo, both, None, feats, LABEL, opts.cells,
                                                     opts.seed, opts.parallelism, journal)
            if best is None:
                raise RuntimeError("no model was chosen: every grid cell has an undefined test MSE")
            how = dict(split=opts.split, seed=opts.seed, train_fraction=float(opts.train_fraction))
            version = bundle.publish(spark, model_dir, kmeans_dir, algo, km, best, how)
            return dict(mode=mode, rejects=rejects, version=version, k=len(clustering.centres_of(km)), best_cell=cell,
                        results=results.orderBy("cell").collect(), elbow=elbow.collect())
        trained = bundle.current(spark, model_dir, kmeans_dir, algo)
        centres, more = clustering.centres_of(trained.clusters), {}
        if mode == "test":
            opts = replace(opts, **trained.split)
            scored = scoring.score_labelled(trained.model, labelled_features(t, w, centres, dataset, ["dt"]), feats, LABEL)
            # Both errors are metrics of the write.  A random split cannot be told from a row, so its held-out
            # error is known from training only.
            obs = Observation("mse")
            se = F.pow(F.col(LABEL) - F.col("prediction"), 2)
            held = F.when(held_out(opts), se) if opts.split == "hash" else F.lit(None).cast("double")
            scored = scored.observe(obs, F.avg(se).alias("mse"), F.avg(held).alias("mse_held_out"))
        else:
            data = build_features(t, w, centres, dataset, labelled=False, carry=["dt"])
            scored = scoring.score_unlabelled(trained.model, data, feats)
        out = writers.write_scored(scored, f"{model_dir.rstrip('/')}_out_{mode}", opts.output_format,
                                   partition_by=["dt"], replace=opts.replace)
        if mode == "test":
            more = dict(mse_all=obs.get["mse"], mse_held_out=obs.get["mse_held_out"])
        return dict(mode=mode, rejects=rejects, version=trained.version, path=out, schema=scored.schema, **more)
    finally:
        w.unpersist()


def main(argv: list[str]) -> int:
    """python -m tripwise.plans.pipeline <weather> <trips> <model_dir> <kmeans_dir> <Taxi|Bike> <DT|RF|LR>
    <Training|Test|Prediction>"""
    if len(argv) < 7:
        print(main.__doc__)
        return 1
    from tripwise.session import get_session
    try:
        _validate(argv[4], argv[5], argv[6])
    except ValueError as e:
        print(e)
        return 1
    spark = get_session()
    res = run(spark, argv[0], argv[1], argv[2], argv[3], argv[4], argv[5], argv[6])
    for k, v in res.items():
        if k not in ("results", "elbow", "schema"):
            print(f"{k}: {v}")
    return 0


if __name__ == "__main__":
    import sys
    sys.exit(main(sys.argv[1:]))
