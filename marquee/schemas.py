"""Explicit schemas of the logical tables, as schema texts; no source is read by inference."""

from __future__ import annotations

from pyspark.sql import types as T


def fields(ddl: str) -> list[T.StructField]:
    """The parsed fields of a schema text; needs a running session."""
    return T.StructType.fromDDL(ddl).fields


RAW_LOG = "value STRING"
WATCH = "user_id STRING, movie_id STRING, interaction_count BIGINT, max_minute_reached INT"
RATINGS = "timestamp STRING, user_id STRING, movie_id STRING, rating INT"
USERS = "user_id BIGINT, age INT, occupation STRING, gender STRING"
MOVIES = (
    "id STRING, title STRING, original_language STRING, release_date STRING, runtime INT, "
    "popularity DOUBLE, vote_average DOUBLE, vote_count INT, genres STRING, "
    "spoken_languages STRING, production_countries STRING, overview STRING"
)
MOVIE_DOCUMENT = (
    "id STRING, title STRING, original_language STRING, release_date STRING, runtime INT, "
    "popularity DOUBLE, vote_average DOUBLE, vote_count INT, "
    "genres ARRAY<STRUCT<name: STRING>>, spoken_languages ARRAY<STRUCT<name: STRING>>, "
    "production_countries ARRAY<STRUCT<iso_3166_1: STRING>>, overview STRING"
)

# Telemetry tables: one append-only table per kind of event.
SERVED = "timestamp TIMESTAMP, user_id BIGINT, items ARRAY<STRING>, model_version STRING, response_time DOUBLE"
INTERACTION = (
    "timestamp TIMESTAMP, user_id BIGINT, item_id STRING, model_version STRING, "
    "matched_served BOOLEAN, action_type STRING, watch_time DOUBLE"
)
QUALITY = (
    "timestamp TIMESTAMP, user_id BIGINT, rating DOUBLE, predicted DOUBLE, model_version STRING, "
    "recommendations ARRAY<STRING>, selected STRING"
)
ERROR = "timestamp TIMESTAMP, type STRING, message STRING"
DEPLOYMENT = "timestamp TIMESTAMP, version STRING, model_type STRING"
TELEMETRY = {
    "recommendations": SERVED,
    "interactions": INTERACTION,
    "quality": QUALITY,
    "errors": ERROR,
    "deployments": DEPLOYMENT,
}

# One legacy JSON document holding several arrays.
TELEMETRY_DOCUMENT = (
    "recommendations ARRAY<STRUCT<timestamp: STRING, user_id: STRING, items: ARRAY<STRING>, model_version: STRING>>, "
    "user_interactions ARRAY<STRUCT<timestamp: STRING, user_id: STRING, item_id: STRING, model_version: STRING, "
    "action_type: STRING, watch_time: DOUBLE>>, "
    "recommendation_quality ARRAY<STRUCT<timestamp: STRING, user_id: STRING, rating: STRING, predicted: DOUBLE, "
    "model_version: STRING, recommendations: ARRAY<STRING>, selected: STRING>>, "
    "response_times ARRAY<DOUBLE>, "
    "errors ARRAY<STRUCT<timestamp: STRING, type: STRING, message: STRING>>, "
    "model_versions ARRAY<STRUCT<timestamp: STRING, version: STRING, model_type: STRING>>"
)

MODEL_REGISTRY = (
    "model_version STRING, model_tag STRING, build_time TIMESTAMP, git_commit STRING, git_branch STRING, "
    "pipeline_version STRING, training_data_id STRING, training_row_count BIGINT, model_type STRING, "
    "metrics_json STRING, artifact_path STRING, framework_versions STRING"
)
DATA_REGISTRY = (
    "data_id STRING, timestamp TIMESTAMP, data_source STRING, file_path STRING, file_hash STRING, "
    "row_count BIGINT, column_count INT, missing_values_json STRING, date_range_start STRING, date_range_end STRING"
)
PREDICTION_EVENTS = (
    "request_id STRING, timestamp TIMESTAMP, userid STRING, model_version STRING, prediction STRING, "
    "input_hash STRING, input_row_count BIGINT, input_missing_count BIGINT, inference_latency_ms DOUBLE, extra_json STRING"
)
EVALUATION_EVENTS = (
    "eval_id STRING, timestamp TIMESTAMP, eval_type STRING, model_version STRING, preproc_path STRING, "
    "model_path STRING, eval_data_path STRING, test_set_size BIGINT, rmse DOUBLE, mae DOUBLE, r2 DOUBLE, "
    "precision DOUBLE, recall DOUBLE, f1 DOUBLE, accuracy DOUBLE, inference_time_ms DOUBLE, metrics_json STRING"
)

REFRESH_REPORT = "timestamp TIMESTAMP, users BIGINT, movies BIGINT, interactions BIGINT, ratings BIGINT"
RETRAIN_STATE = "users_seen BIGINT, interactions_seen BIGINT, last_retrain_ts TIMESTAMP"
FEEDBACK_EVENTS = (
    "timestamp TIMESTAMP, event_type STRING, issue STRING, details STRING, action_taken STRING, "
    "canary_percentage_before DOUBLE, canary_percentage_after DOUBLE, reason STRING"
)
TUNING_RESULTS = (
    "timestamp TIMESTAMP, best_params MAP<STRING, DOUBLE>, best_cv_rmse DOUBLE, tuning_time_sec DOUBLE, "
    "cv_folds INT, param_grid_size INT"
)
