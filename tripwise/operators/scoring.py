"""Scoring: predictions, residuals and mean squared error."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripwise.operators.models import predict


def score_labelled(model, df: DataFrame, features: Sequence[str], label: str = "dur") -> DataFrame:
    """Feature rows + prediction + residual (label - prediction)."""
    p = predict(model, df, features)
    return p.withColumn("residual", F.col(label) - F.col("prediction"))


def score_unlabelled(model, df: DataFrame, features: Sequence[str]) -> DataFrame:
    return predict(model, df, features)


def mse(df: DataFrame, label: str = "dur", prediction: str = "prediction") -> DataFrame:
    """One row: mean of (label - prediction)^2."""
    return df.agg(F.avg(F.pow(F.col(label) - F.col(prediction), 2)).alias("mse"))


def mse_split(df: DataFrame, held_out: Column, label: str = "dur", prediction: str = "prediction") -> DataFrame:
    """One row, one pass: MSE over all rows and over the held-out rows."""
    se = F.pow(F.col(label) - F.col(prediction), 2)
    return df.agg(F.avg(se).alias("mse"), F.avg(F.when(held_out, se)).alias("mse_held_out"))
