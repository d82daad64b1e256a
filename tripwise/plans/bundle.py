"""Clusters, model and split of one training, published together.

A training writes its clusters to ``<kmeans_dir>/<version>`` and its model to ``<model_dir>/<version>``, folders that
nobody else writes to, and then appends one entry (version, algorithm, split) to the manifest ``<model_dir>/manifest``.  Readers
begin with the manifest's last entry, so they see one whole training: an unfinished or failed one is not there, and
a later one changes nothing under a reader at work.  Folders of earlier versions stay until the user deletes them.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

from tripwise.operators import models
from tripwise.operators.clustering import CentreModel
from tripwise.sources.ledger import Ledger

PUBLISHED = "published"


@dataclass
class Bundle:
    version: str
    clusters: CentreModel
    model: object
    split: dict                              # split, seed, train_fraction


def _manifest(model_dir: str) -> str:
    return f"{model_dir.rstrip('/')}/manifest"


def publish(spark: SparkSession, model_dir: str, kmeans_dir: str, algo: str, clusters: CentreModel, model,
            split: dict) -> str:
    """Write all parts under a new version, then make it the current one."""
    version = uuid.uuid4().hex
    models.save_model(spark, clusters, f"{kmeans_dir.rstrip('/')}/{version}")
    models.save_model(spark, model, f"{model_dir.rstrip('/')}/{version}")
    Ledger(spark, _manifest(model_dir)).put(PUBLISHED, dict(version=version, algo=algo.lower(), split=split))
    return version


def current(spark: SparkSession, model_dir: str, kmeans_dir: str, algo: str) -> Bundle:
    """The training published last below ``model_dir``."""
    try:
        entry = Ledger(spark, _manifest(model_dir), begin=False).get(PUBLISHED)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        entry = None
    if entry is None:
        raise FileNotFoundError(f"no training has been published below {model_dir}")
    if entry["algo"] != algo.lower():
        raise ValueError(f"{model_dir} holds a model of kind {entry['algo']!r}, not {algo.lower()!r}")
    version = entry["version"]
    return Bundle(version, models.load_model(spark, f"{kmeans_dir.rstrip('/')}/{version}", "km"),
                  models.load_model(spark, f"{model_dir.rstrip('/')}/{version}", algo), entry["split"])
