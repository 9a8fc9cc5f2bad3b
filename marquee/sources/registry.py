"""Append-only registries of training data, models, predictions and evaluations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee import schemas
from marquee.sources.files import file_fingerprints
from marquee.sources.sinks import append_table, conform, new_id

PIPELINE_VERSION = "pipeline_v1.0"
MODEL_TYPE = "GBT"


def _checked(rows: DataFrame, required: Sequence[str]) -> DataFrame:
    """Rows whose required fields are all present; a NULL in one fails the write."""
    missing = [c for c in required if c not in rows.columns]
    if missing:
        raise ValueError(f"missing required fields: {missing}")
    return rows.withColumns(
        {
            c: F.when(F.col(c).isNull(), F.raise_error(F.lit(f"required field {c} is NULL")).cast(rows.schema[c].dataType))
            .otherwise(F.col(c))
            for c in required
        }
    )


def _default(rows: DataFrame, name: str, value: Column) -> DataFrame:
    given = F.col(name) if name in rows.columns else F.lit(None)
    return rows.withColumn(name, F.coalesce(given, value))


def data_rows(rows: DataFrame) -> DataFrame:
    rows = _default(_checked(rows, ["data_source", "file_path"]), "timestamp", F.current_timestamp())
    rows = _default(rows, "data_id", new_id("data_", F.col("timestamp")))
    return conform(_default(rows, "file_hash", F.lit("unknown")), schemas.DATA_REGISTRY)


def model_rows(rows: DataFrame) -> DataFrame:
    rows = _default(_checked(rows, ["artifact_path", "training_data_id"]), "build_time", F.current_timestamp())
    rows = _default(rows, "model_version", new_id("v", F.col("build_time")))
    rows = _default(rows, "model_tag", F.col("model_version"))
    for name, value in (
        ("pipeline_version", PIPELINE_VERSION),
        ("model_type", MODEL_TYPE),
        ("git_commit", "unknown"),
        ("git_branch", "unknown"),
    ):
        rows = _default(rows, name, F.lit(value))
    return conform(rows, schemas.MODEL_REGISTRY)


def prediction_rows(rows: DataFrame, inputs: Sequence[str]) -> DataFrame:
    """Prediction events with the fingerprint and missing-cell count of their input columns."""
    rows = _default(_checked(rows, ["userid", "model_version", "prediction"]), "request_id", F.uuid())
    missing = sum((F.col(c).isNull().cast("bigint") for c in inputs), F.lit(0).cast("bigint"))
    payload = F.to_json(F.struct(*[F.col(c) for c in sorted(inputs)]), {"ignoreNullFields": "false"})
    rows = _default(rows, "timestamp", F.current_timestamp()).withColumns(
        {
            "input_hash": F.sha2(payload, 256),
            "input_row_count": F.lit(1).cast("bigint"),
            "input_missing_count": missing,
        }
    )
    return conform(rows, schemas.PREDICTION_EVENTS)


def evaluation_rows(rows: DataFrame) -> DataFrame:
    required = ["model_version", "eval_type", "preproc_path", "model_path", "eval_data_path"]
    rows = _default(_checked(rows, required), "timestamp", F.current_timestamp())
    rows = _default(rows, "eval_id", new_id("eval_", F.col("timestamp")))
    return conform(rows, schemas.EVALUATION_EVENTS)


def append_registry(rows: DataFrame, folder: str, kind: str, **options) -> str:
    """Validate, complete and append registry rows; returns the table path."""
    complete = {
        "data": data_rows,
        "models": model_rows,
        "predictions": prediction_rows,
        "evaluations": evaluation_rows,
    }[kind](rows, **options)
    path = f"{folder}/{kind}"
    append_table(complete, path)
    return path


def register_candidate(spark, folder: str, data: DataFrame, metrics: DataFrame, artifact_path: str) -> DataFrame:
    """Register training data and the model trained on it; returns the model row.

    ``data`` is one row (data_source, file_path, ...), ``metrics`` one row of figures. The artifact is
    recorded with the hash of its files, or of none where there is nothing at the path.
    """
    stored = data_rows(data).collect()  # one row; fixes its generated id
    data_row = spark.createDataFrame(stored, schemas.DATA_REGISTRY)
    append_table(data_row, f"{folder}/data")
    files = file_fingerprints(spark, artifact_path).agg(F.sort_array(F.collect_list("file_hash")).alias("h"))
    digest = files.select(F.sha2(F.concat_ws(",", "h"), 256)).scalar()  # over the files of one model
    model = metrics.select(
        F.concat(F.lit(f"{artifact_path} (sha256="), digest, F.lit(")")).alias("artifact_path"),
        F.lit(stored[0]["data_id"]).alias("training_data_id"),
        F.to_json(F.struct(*metrics.columns)).alias("metrics_json"),
    )
    model_row = spark.createDataFrame(model_rows(model).collect(), schemas.MODEL_REGISTRY)
    append_table(model_row, f"{folder}/models")
    return model_row
