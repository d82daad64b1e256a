"""Published runs, where their files are at hand: paths come from environment variables, and tests are skipped without them.

TRIPWISE_TREE: a printed tree.  TRIPWISE_TREE_SCORES: rows of duration, features, prediction and residual it gave.
TRIPWISE_LINEAR, TRIPWISE_LINEAR_SCORES: the same for a list of weights.  TRIPWISE_BIKE_TRIPS and TRIPWISE_WEATHER: the
trips and the weather those rows came from.
"""

import json
import os

import pytest
from pyspark.sql import functions as F

from tripwise.operators import histogram_trees as ht
from tripwise.operators.linear import LinearModel
from tripwise.operators.outliers import duration_closed, speed_3sigma
from tripwise.plans.features import BIKE_FEATURES, joined_features
from tripwise.sources import readers
from tripwise.sources.standins import fixed_centres


def given(*names):
    paths = [os.environ.get(n) for n in names]
    if not all(paths):
        pytest.skip(f"{names} not set")
    return paths


def scored(spark, path):
    schema = ", ".join(f"{c} double" for c in ["dur", *BIKE_FEATURES, "want", "residual"])
    return spark.read.schema(schema).csv(path)


def differing(model, rows):
    off = F.abs(F.col("prediction") - F.col("want")) > 1e-9 * F.abs(F.col("want"))
    res = F.abs(F.col("dur") - F.col("prediction") - F.col("residual")) > 1e-6
    return model.transform(rows).agg(F.count("*").alias("n"), F.count_if(off).alias("scores"), F.count_if(res).alias("residuals")).first()


def test_published_tree_gives_its_published_scores(spark):
    tree, scores = given("TRIPWISE_TREE", "TRIPWISE_TREE_SCORES")
    with open(tree) as f:
        model = ht.TreeModel(BIKE_FEATURES, ht.parse_printed(f.read()))
    got = differing(model, scored(spark, scores))
    assert got.n > 0 and (got.scores, got.residuals) == (0, 0)


def test_published_weights_give_their_published_scores(spark):
    weights, scores = given("TRIPWISE_LINEAR", "TRIPWISE_LINEAR_SCORES")
    with open(weights) as f:
        model = LinearModel(BIKE_FEATURES, json.loads(f.readline()))
    got = differing(model, scored(spark, scores))
    assert got.n > 0 and (got.scores, got.residuals) == (0, 0)


def test_published_trips_give_the_published_rows(spark):
    trips, weather, scores = given("TRIPWISE_BIKE_TRIPS", "TRIPWISE_WEATHER", "TRIPWISE_TREE_SCORES")
    t, w = readers.read_trips(spark, trips, "bike"), readers.read_weather(spark, weather)
    joined = duration_closed(joined_features(t, w, fixed_centres(8), "bike"))
    rows, want = speed_3sigma(joined), scored(spark, scores)
    assert t.count() > joined.count() >= rows.count() == want.count()
    plain = [c for c in ["dur", *BIKE_FEATURES] if c not in ("km1", "km2", "dist")]  # clusters are another fit's
    near = [F.round(F.col(c).cast("double"), 9).alias(c) for c in plain] + [F.round("dist", 3).alias("dist")]
    assert rows.select(near).exceptAll(want.select(near)).count() <= rows.count() // 1000  # rounding of distances
