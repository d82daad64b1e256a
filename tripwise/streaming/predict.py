"""Score arriving trip files with a saved model.

readStream (CSV, explicit schema) -> the batch feature definition (cluster
assignment, stream-static join to the broadcast weather table, calendar and
distance features) -> model -> writeStream with a checkpoint, so a restarted
query resumes where it stopped and each file is scored once.

Only prediction mode streams: the labelled path's three-sigma filter needs
the mean and deviation over the whole data set, which an append-mode stream
cannot know before it ends.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession

from tripwise import schemas
from tripwise.operators.clustering import Centre
from tripwise.operators.models import predict
from tripwise.plans.features import build_features, feature_names
from tripwise.sources.readers import good_trips, parse_trips


def read_trip_stream(spark: SparkSession, trips_dir: str, dataset: str, max_files: int = 1000) -> DataFrame:
    raw = (spark.readStream.schema(schemas.trips_schema(dataset, labelled=False))
           .option("maxFilesPerTrigger", max_files).csv(trips_dir))
    # The same content hash as the batch reader: a trip keeps its id across restarts.
    return good_trips(parse_trips(raw, dataset))


def start_prediction_stream(spark: SparkSession, trips_dir: str, weather: DataFrame, model,
                            centres: Sequence[Centre], dataset: str, sink_dir: str, checkpoint_dir: str,
                            fmt: str = "parquet", available_now: bool = True, processing_time: str | None = None,
                            max_files: int = 1000):
    """Start the scoring query and return its StreamingQuery handle; ``max_files`` bounds one micro-batch."""
    t = read_trip_stream(spark, trips_dir, dataset, max_files)
    feats = build_features(t, weather, centres, dataset, labelled=False)
    scored = predict(model, feats, feature_names(dataset))
    w = (scored.writeStream.format(fmt).outputMode("append")
         .option("checkpointLocation", checkpoint_dir).option("path", sink_dir))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "1 minute")
    return w.start()
