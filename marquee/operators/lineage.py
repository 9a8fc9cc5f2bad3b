"""Lineage: from a prediction or an evaluation back to its model and training data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.operators.ranking import first_per_key, last_n_per_key


def model_by_version(models: DataFrame, sequence: str = "seq") -> DataFrame:
    """The first registered row of every model version."""
    return first_per_key(models, ["model_version"], sequence)


def trace_predictions(predictions: DataFrame, models: DataFrame, data: DataFrame, sequence: str = "seq") -> DataFrame:
    """Every prediction request with its model and training data; missing links stay NULL."""
    requests = first_per_key(predictions, ["request_id"], sequence)
    registered = model_by_version(models, sequence).select("model_version", "training_data_id", "artifact_path")
    sources = data.select(F.col("data_id").alias("training_data_id"), "data_source")
    return requests.join(registered, "model_version", "left").join(sources, "training_data_id", "left")


def trace_evaluations(evaluations: DataFrame, models: DataFrame, sequence: str = "seq") -> DataFrame:
    events = first_per_key(evaluations, ["eval_id"], sequence)
    registered = model_by_version(models, sequence).select("model_version", "training_data_id", "artifact_path")
    return events.join(registered, "model_version", "left")


def recent_events(events: DataFrame, key: str = "model_version", sequence: str = "seq", n: int = 100) -> DataFrame:
    """The last ``n`` events of every key, numbered in their original order."""
    return last_n_per_key(events, key, sequence, n)


def recent_events_overall(events: DataFrame, sequence: str = "seq", n: int = 1000) -> DataFrame:
    """The last ``n`` events of the table in their original order."""
    return events.orderBy(F.col(sequence).desc()).limit(n).orderBy(sequence)
