"""The streamed prediction equals the batch prediction."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from tripwise.operators import linear
from tripwise.plans.features import BIKE_FEATURES, build_features
from tripwise.session import scratch_path
from tripwise.sources import readers, standins as sv, writers
from tripwise.streaming import start_prediction_stream

COLS = ["dt", "time", "id1", "lat1", "lon1", "id2", "lat2", "lon2", "yr", "gdr"]


def test_stream_equals_batch(spark):
    ev = sv.table(spark, SF_SMALL, "events")
    src = writers.write_csv(sv.bike_trips(ev, False).select(*COLS), scratch_path(spark, "in"))
    w = sv.weather(ev)
    model = linear.LinearModel(BIKE_FEATURES, [0.01 * (i + 1) for i in range(len(BIKE_FEATURES))])
    centres = sv.fixed_centres(8)
    sink, ckpt = scratch_path(spark, "out"), scratch_path(spark, "ck")
    start_prediction_stream(spark, src, w, model, centres, "bike", sink, ckpt).awaitTermination()
    streamed = spark.read.parquet(sink).select(*COLS[2:], F.round("prediction", 6).alias("p"))
    batch = build_features(readers.read_trips(spark, src, "bike", False), w, centres, "bike", False)
    batch = model.transform(batch).select(*COLS[2:], F.round("prediction", 6).alias("p"))
    cols = [c for c in streamed.columns if c in batch.columns]
    assert streamed.count() == batch.count() > 0
    assert streamed.select(*cols).exceptAll(batch.select(*cols)).count() == 0
