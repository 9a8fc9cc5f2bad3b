"""Queries: scans, parsing, ingest, sinks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee import schemas
from marquee.functions import parsing
from marquee.functions import scalars as S
from marquee.operators import features, ingest
from marquee.plans.registry import query
from marquee.plans.views import Views
from marquee.session import scratch_path
from marquee.sources import files, registry, sinks

WATCH_RE = r"/data/m/([^/]+)/(\d+)\.mpg"
RATE_RE = r"GET /rate/([^=]+)=(\d+)"

P_WATCH = rf"""p_watch AS (SELECT str_split(value, ',')[2] user_id, regexp_extract(value, '{WATCH_RE}', 1) movie_id,
  TRY_CAST(regexp_extract(value, '{WATCH_RE}', 2) AS INT) minute_no FROM v_log
  WHERE regexp_matches(value, '{WATCH_RE}') AND len(str_split(value, ',')) >= 3)"""
P_RATING = rf"""p_rating AS (SELECT str_split(value, ',')[1] AS "timestamp", str_split(value, ',')[2] user_id,
  regexp_extract(value, '{RATE_RE}', 1) movie_id, TRY_CAST(regexp_extract(value, '{RATE_RE}', 2) AS INT) rating
  FROM v_log WHERE regexp_matches(value, '{RATE_RE}'))"""
W_AGG = """w_agg AS (SELECT user_id, movie_id, count(DISTINCT minute_no) interaction_count, max(minute_no) max_minute_reached
  FROM p_watch GROUP BY ALL)"""
W_NEW = """w_new AS (SELECT * FROM w_agg w
  WHERE NOT EXISTS (SELECT 1 FROM v_existing_pairs e
                    WHERE CAST(e.user_id AS VARCHAR) = w.user_id AND concat('m', e.movie_id) = w.movie_id)
    AND movie_id NOT IN (SELECT concat('m', movie_id) FROM v_failed))"""
DELIVERED = """delivered AS (SELECT movie_id, title FROM v_movies WHERE movie_id NOT IN (SELECT movie_id FROM v_failed))"""


def movie_key(c: str = "movie_id"):
    """Movie id as the log writes it."""
    return F.concat(F.lit("m"), F.col(c).cast("string"))


def log_pairs(v: Views) -> DataFrame:
    return v.v_existing_pairs.select(F.col("user_id").cast("string").alias("user_id"), movie_key().alias("movie_id"))


def failed_movies(v: Views) -> DataFrame:
    return v.v_failed.select(movie_key().alias("movie_id"))


def watch_agg_of(v: Views) -> DataFrame:
    return ingest.watch_aggregate(parsing.watch_events(v.v_log))


def watch_new_of(v: Views) -> DataFrame:
    return ingest.new_pairs(watch_agg_of(v), log_pairs(v), failed_movies(v))


def delivered_movies(v: Views) -> DataFrame:
    return v.v_movies.join(v.v_failed, "movie_id", "left_anti").select("movie_id", "title")


@query("log_scan", "SELECT value FROM v_log")
def log_scan(v):
    path = scratch_path(v.spark, "log")
    v.v_log.write.text(path)
    return files.log_lines(v.spark, path)


@query("decode_valid", "SELECT value FROM v_log WHERE length(value) % 9 NOT IN (0, 1)")
def decode_valid(v):
    kind = F.length("value") % 9
    broken = F.when(kind == 0, F.unhex(F.lit("FFFE"))).when(kind == 1, F.unhex(F.lit("")))
    messages = v.v_log.select(F.coalesce(broken, F.col("value").cast("binary")).alias("value"))
    return parsing.decode_messages(messages)


@query("parse_watch", "SELECT * FROM p_watch", P_WATCH)
def parse_watch(v):
    return parsing.watch_events(v.v_log)


@query("parse_rating", "SELECT * FROM p_rating", P_RATING)
def parse_rating(v):
    return parsing.rating_events(v.v_log)


@query(
    "parse_rating_split",
    """SELECT user_id, movie_id, rating FROM p_rating
       QUALIFY row_number() OVER (PARTITION BY user_id, movie_id ORDER BY "timestamp" DESC) = 1""",
    P_RATING,
)
def parse_rating_split(v):
    events = parsing.rating_events_by_split(v.v_log)
    return ingest.latest_ratings(events, ["timestamp", "rating"]).drop("timestamp")


@query("watch_agg", "SELECT * FROM w_agg", P_WATCH, W_AGG)
def watch_agg(v):
    return watch_agg_of(v)


@query("watch_new_pairs", "SELECT * FROM w_new", P_WATCH, W_AGG, W_NEW)
def watch_new_pairs(v):
    return watch_new_of(v)


@query(
    "rating_known_semi",
    """SELECT CAST(user_id AS VARCHAR) user_id, concat('m', movie_id) movie_id, rating, event_id FROM v_rating
       WHERE CAST(user_id AS VARCHAR) IN (SELECT user_id FROM w_new) AND concat('m', movie_id) IN (SELECT movie_id FROM w_new)""",
    P_WATCH, W_AGG, W_NEW,
)
def rating_known_semi(v):
    rated = v.v_rating.select(F.col("user_id").cast("string").alias("user_id"), movie_key().alias("movie_id"), "rating", "event_id")
    new = watch_new_of(v)
    return ingest.known_ratings(rated, new, new)


@query(
    "rating_latest",
    """SELECT user_id, movie_id, rating FROM v_rating_big QUALIFY row_number() OVER (PARTITION BY user_id, movie_id
       ORDER BY ts DESC, l_orderkey DESC, l_linenumber DESC, rating DESC) = 1""",
)
def rating_latest(v):
    return ingest.latest_ratings(v.v_rating_big, ["ts", "l_orderkey", "l_linenumber", "rating"]).select(
        "user_id", "movie_id", "rating"
    )


@query(
    "missing_dimension_keys",
    "SELECT DISTINCT movie_id FROM v_watch WHERE movie_id NOT IN (SELECT movie_id FROM delivered)",
    DELIVERED,
)
def missing_dimension_keys(v):
    return ingest.missing_keys(v.v_watch, delivered_movies(v), "movie_id").select(F.col("movie_id").cast("int"))


@query(
    "enrich_quarantine",
    """SELECT w.movie_id, title, d.movie_id IS NULL quarantined FROM (SELECT DISTINCT movie_id FROM v_watch) w
       LEFT JOIN delivered d ON w.movie_id = d.movie_id""",
    DELIVERED,
)
def enrich_quarantine(v):
    return ingest.enrich_or_quarantine(v.v_watch, delivered_movies(v), "movie_id").withColumn(
        "movie_id", F.col("movie_id").cast("int")
    )


@query(
    "distinct_keys",
    """SELECT DISTINCT 'user' kind, CAST(user_id AS VARCHAR) AS key FROM v_watch
       UNION ALL SELECT DISTINCT 'movie', CAST(movie_id AS VARCHAR) FROM v_watch""",
)
def distinct_keys(v):
    return ingest.distinct_keys(v.v_watch, {"user": "user_id", "movie": "movie_id"})


@query(
    "ingest_summary",
    "SELECT count(DISTINCT user_id) users, count(DISTINCT movie_id) movies FROM w_new",
    P_WATCH, W_AGG, W_NEW,
)
def ingest_summary(v):
    return ingest.ingest_summary(ingest.ingest_log(v.v_log, log_pairs(v), failed_movies(v))["watch"])


@query(
    "ingest_ratings",
    """SELECT * FROM p_rating WHERE user_id IN (SELECT user_id FROM w_new) AND movie_id IN (SELECT movie_id FROM w_new)
       QUALIFY row_number() OVER (PARTITION BY user_id, movie_id ORDER BY "timestamp" DESC) = 1""",
    P_WATCH, W_AGG, W_NEW, P_RATING,
)
def ingest_ratings(v):
    return ingest.ingest_log(v.v_log, log_pairs(v), failed_movies(v))["ratings"]


@query(
    "ingest_run",
    """SELECT (SELECT count(*) FROM v_log WHERE value IS NOT NULL AND value <> '') lines, (SELECT count(DISTINCT user_id) FROM w_new) users,
       (SELECT count(DISTINCT movie_id) FROM w_new) movies,
       (SELECT count(*) FROM (SELECT DISTINCT user_id, movie_id FROM p_rating WHERE user_id IN (SELECT user_id FROM w_new)
          AND movie_id IN (SELECT movie_id FROM w_new))) ratings,
       (SELECT count(*) FROM (SELECT DISTINCT user_id FROM w_new) WHERE user_id NOT IN (SELECT CAST(user_id AS VARCHAR) FROM v_users)) quarantined_users,
       (SELECT count(*) FROM (SELECT DISTINCT movie_id FROM w_new) WHERE movie_id NOT IN (SELECT concat('m', movie_id) FROM v_movies
          WHERE movie_id % 7 <> 0)) quarantined_movies""",
    P_WATCH, W_AGG, W_NEW, P_RATING,
)
def ingest_run(v):
    """Collect, parse, enrich and ratings in one run; its counts after a second, idle run."""
    folder = scratch_path(v.spark, "ingest")
    messages = v.v_log.select(F.col("value").cast("binary").alias("value"))
    users = v.v_users.select(F.col("user_id").cast("string").alias("user_id"), "age", "gender")
    movies = v.v_movies.filter("movie_id % 7 <> 0").select(movie_key().alias("movie_id"), "title")
    inputs = (messages, log_pairs(v), failed_movies(v), users, movies, folder)
    ingest.ingest_run(*inputs)
    return ingest.run_summary(ingest.ingest_run(*inputs))


RELEASE = "SELECT movie_id, substr(release_date, 1, 4) raw, TRY_CAST(substr(release_date, 1, 4) AS DOUBLE) number FROM v_movies"


def release_numbers(v: Views) -> DataFrame:
    raw = F.substring("release_date", 1, 4)
    return v.v_movies.select("movie_id", raw.alias("raw"), S.number(raw).alias("number"))


@query("coerce_numeric", RELEASE)
def coerce_numeric(v):
    return release_numbers(v)


@query("drop_missing", f"SELECT * FROM ({RELEASE}) WHERE number IS NOT NULL")
def drop_missing(v):
    return features.clean_keys(release_numbers(v), ["number"])


RAW_IDS = """raw_ids AS (SELECT event_id, CASE event_id % 4 WHEN 0 THEN CAST(user_id AS VARCHAR)
  WHEN 1 THEN concat(' ', user_id, '.7 ') WHEN 2 THEN concat(user_id, 'x') ELSE '' END raw FROM v_event)"""


@query(
    "coerce_id",
    """SELECT event_id, raw, CAST(trunc(TRY_CAST(trim(raw) AS DOUBLE)) AS BIGINT) id FROM raw_ids
       WHERE TRY_CAST(trim(raw) AS DOUBLE) IS NOT NULL""",
    RAW_IDS,
)
def coerce_id(v):
    text, kind = F.col("user_id").cast("string"), F.col("event_id") % 4
    raw = (
        F.when(kind == 0, text)
        .when(kind == 1, F.concat(F.lit(" "), text, F.lit(".7 ")))
        .when(kind == 2, F.concat(text, F.lit("x")))
        .otherwise("")
    )
    read = v.v_event.select("event_id", raw.alias("raw"))
    return read.withColumn("id", S.integer_id(F.col("raw"))).filter(F.col("id").isNotNull())


@query(
    "flatten_movie",
    """SELECT concat('m/', p_partkey) id, concat('m_', p_partkey) safe_id, p_name title, p_size runtime,
       replace(p_name, ' ', ',') genres, '' spoken_languages, '' production_countries, '' overview FROM part""",
)
def flatten_movie(v):
    parsed = v.v_movie_json.select(F.from_json("value", schemas.MOVIE_DOCUMENT).alias("d")).select("d.*")
    return parsing.flatten_movies(parsed).select(
        "id", parsing.safe_file_id(F.col("id")).alias("safe_id"), "title", "runtime", "genres",
        "spoken_languages", "production_countries", "overview",
    )


@query("movie_json_scan", "SELECT concat('m/', p_partkey) id, p_name title, p_size runtime, replace(p_name, ' ', ',') genres FROM part")
def movie_json_scan(v):
    path = scratch_path(v.spark, "movie-json")
    v.v_movie_json.select("value").write.text(path)
    return files.movie_documents(v.spark, path, one_per_file=False).select("id", "title", "runtime", "genres")


@query("split_tokens", "SELECT movie_id, trim(unnest(str_split(genres, ','))) token FROM v_movies")
def split_tokens(v):
    return v.v_movies.select("movie_id", F.explode(S.tokens(F.col("genres"))).alias("token"))


@query("csv_scan", "SELECT * FROM v_users")
def csv_scan(v):
    path = scratch_path(v.spark, "users-csv")
    v.v_users.write.option("header", True).csv(path)
    return files.csv_table(v.spark, path, schemas.USERS)


@query("optional_source", "SELECT movie_id FROM v_failed")
def optional_source(v):
    path = scratch_path(v.spark, "failed")
    v.v_failed.write.parquet(path)
    absent = files.optional_table(v.spark, f"{path}-absent", "movie_id BIGINT")
    return files.optional_table(v.spark, path, "movie_id BIGINT").unionByName(absent)


@query("append_sink", "SELECT * FROM v_users")
def append_sink(v):
    path = scratch_path(v.spark, "users")
    for part in (0, 1):
        sinks.append_table(v.v_users.filter(F.col("user_id") % 2 == part), path, schemas.USERS)
    return v.spark.read.schema(schemas.USERS).parquet(path)


def telemetry_recs(v: Views) -> DataFrame:
    return v.v_recs.select(
        F.col("ts").alias("timestamp"), "user_id", F.col("items").cast("array<string>").alias("items"), "model_version", "response_time"
    )


@query(
    "telemetry_append",
    """SELECT 'recommendations' kind, ts AS "timestamp", user_id, model_version, round(response_time, 6) AS measure FROM v_recs
       UNION ALL SELECT 'interactions', ts, user_id, NULL, NULL FROM v_inter
       UNION ALL SELECT 'quality', ts, user_id, NULL, round(predicted, 6) FROM v_quality
       UNION ALL SELECT 'errors', ts, NULL, 'user ' || CAST(user_id AS VARCHAR), NULL FROM v_error
       UNION ALL SELECT 'deployments', min(ts), NULL, model_version, NULL FROM v_recs GROUP BY model_version, CAST(ts AS DATE)""",
)
def telemetry_append(v):
    """All five kinds of telemetry, appended to their tables and read back."""
    folder = scratch_path(v.spark, "telemetry")
    clicks = v.v_inter.select(F.col("ts").alias("timestamp"), "user_id", F.col("item_id").cast("string").alias("item_id"))
    quality = v.v_quality.select(F.col("ts").alias("timestamp"), "user_id", F.col("rating").cast("double").alias("rating"), "predicted")
    failed = v.v_error.select(
        F.col("ts").alias("timestamp"), F.lit("request").alias("type"), F.concat(F.lit("user "), F.col("user_id").cast("string")).alias("message")
    )
    # A model version is deployed on the days it serves, with its first list.
    deployed = v.v_recs.groupBy("model_version", F.to_date("ts")).agg(F.min("ts").alias("timestamp")).select(
        "timestamp", F.col("model_version").alias("version"), F.lit("rating").alias("model_type")
    )
    tables = {"recommendations": telemetry_recs(v), "interactions": clicks, "quality": quality, "errors": failed, "deployments": deployed}
    text = {"errors": "message", "deployments": "version"}
    measures = {"recommendations": "response_time", "interactions": "watch_time", "quality": "predicted"}
    parts = []
    for kind, rows in tables.items():
        stored = v.spark.read.schema(f"{schemas.TELEMETRY[kind]}, day DATE").parquet(sinks.append_telemetry(rows, folder, kind))
        user = F.col("user_id") if "user_id" in stored.columns else F.lit(None).cast("bigint")
        measure = F.col(measures[kind]) if kind in measures else F.lit(None).cast("double")
        parts.append(stored.select(
            F.lit(kind).alias("kind"), "timestamp", user.alias("user_id"), F.col(text.get(kind, "model_version")).alias("model_version"), measure.alias("measure")
        ))
    return reduce(DataFrame.unionByName, parts)


@query(
    "telemetry_import",
    """SELECT ts AS "timestamp", CAST(user_id AS VARCHAR) user_id, CAST(unnest(items) AS VARCHAR) item, model_version,
       round(response_time, 6) response_time FROM v_recs
       UNION ALL SELECT ts, CAST(user_id AS VARCHAR), CAST(item_id AS VARCHAR), 'click', NULL FROM v_inter
       UNION ALL SELECT ts, CAST(user_id AS VARCHAR), CAST(rating AS VARCHAR), 'quality', NULL FROM v_quality
       UNION ALL SELECT ts, NULL, 'request', concat('user ', CAST(user_id AS VARCHAR)), NULL FROM v_error""",
)
def telemetry_import(v):
    """Legacy documents with lists, interactions, ratings and errors, as tables."""
    path = scratch_path(v.spark, "telemetry-json")
    stamp = F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp")
    user = F.col("user_id").cast("string").alias("user_id")
    served = F.struct(stamp, user, "items", "model_version")
    documents = [
        (telemetry_recs(v), [F.array(served).alias("recommendations"), F.array("response_time").alias("response_times")]),
        (v.v_inter, [F.array(F.struct(stamp, user, F.col("item_id").cast("string").alias("item_id"), F.lit("click").alias("action_type"))).alias("user_interactions")]),
        (v.v_quality, [F.array(F.struct(stamp, user, F.col("rating").cast("string").alias("rating"), "predicted")).alias("recommendation_quality")]),
        (v.v_error, [F.array(F.struct(stamp, F.lit("request").alias("type"), F.concat(F.lit("user "), user).alias("message"))).alias("errors")]),
    ]
    for rows, arrays in documents:
        timed = rows if "timestamp" in rows.columns else rows.withColumnRenamed("ts", "timestamp")
        timed.select(F.to_json(F.struct(*arrays)).alias("value")).write.mode("append").text(path)
    tables = files.telemetry_document(v.spark, path, one_per_file=False)
    none = F.lit(None).cast("double").alias("response_time")
    lists = tables["recommendations"].select("timestamp", "user_id", F.explode("items").alias("item"), "model_version", "response_time")
    clicks = tables["interactions"].select("timestamp", "user_id", F.col("item_id").alias("item"), F.col("action_type").alias("model_version"), none)
    rated = tables["quality"].select(
        "timestamp", "user_id", F.col("rating").cast("int").cast("string").alias("item"), F.lit("quality").alias("model_version"), none
    )
    failed = tables["errors"].select(
        "timestamp", F.lit(None).cast("string").alias("user_id"), F.col("type").alias("item"), F.col("message").alias("model_version"), none
    )
    return lists.unionByName(clicks).unionByName(rated).unionByName(failed)


@query(
    "registry_append",
    """SELECT 'models' kind, model_version id, training_data_id detail, artifact_path target FROM v_model_registry
       UNION ALL SELECT 'data', data_id, data_source, concat('data/', data_id) FROM v_data_registry
       UNION ALL SELECT 'evaluations', CAST(eval_id AS VARCHAR), model_version, 'offline' FROM v_evaluation_events
       UNION ALL SELECT 'predictions', CAST(request_id AS VARCHAR), model_version, CAST(userid AS VARCHAR) FROM v_prediction_events""",
)
def registry_append(v):
    folder = scratch_path(v.spark, "registry")
    text = lambda c: F.col(c).cast("string").alias(c)
    models = registry.append_registry(v.v_model_registry.drop("seq"), folder, "models")
    data = registry.append_registry(
        v.v_data_registry.withColumn("file_path", F.concat(F.lit("data/"), "data_id")), folder, "data"
    )
    evaluated = v.v_evaluation_events.select(
        text("eval_id"), "model_version", "rmse", F.lit("offline").alias("eval_type"),
        *[F.lit("-").alias(c) for c in ("preproc_path", "model_path", "eval_data_path")],
    )
    evaluations = registry.append_registry(evaluated, folder, "evaluations")
    served = v.v_prediction_events.select(text("request_id"), text("userid"), "model_version", text("prediction"))
    predictions = registry.append_registry(served, folder, "predictions", inputs=["userid", "prediction"])
    read = v.spark.read.parquet
    return (
        read(models).select(F.lit("models").alias("kind"), F.col("model_version").alias("id"), F.col("training_data_id").alias("detail"), F.col("artifact_path").alias("target"))
        .union(read(data).select(F.lit("data"), "data_id", "data_source", "file_path"))
        .union(read(evaluations).select(F.lit("evaluations"), "eval_id", "model_version", "eval_type"))
        .union(read(predictions).select(F.lit("predictions"), "request_id", "model_version", "userid"))
    )


@query("clamp_pct", "SELECT event_id, least(greatest(round(value - 50, 6), 0), 100) pct FROM v_event")
def clamp_pct(v):
    return v.v_event.select("event_id", S.percentage((F.col("value") - 50).cast("string"), 10.0).alias("pct"))


@query(
    "parse_served_payload",
    "SELECT event_id, array_to_string(items, '|') items FROM v_recs",
)
def parse_served_payload(v):
    ids = F.col("items").cast("array<string>")
    quoted = F.to_json(F.struct(ids.alias("recommendations")))
    nested = F.to_json(F.struct(F.transform(ids, lambda i: F.struct(i.alias("item_id"))).alias("recommendations")))
    kind = F.col("event_id") % 4
    payload = F.when(kind == 0, quoted).when(kind == 1, nested).when(kind == 2, F.to_json("items")).otherwise(F.array_join(ids, ", "))
    return v.v_recs.select("event_id", F.array_join(S.served_items(payload), "|").alias("items"))


@query("row_fingerprint", """SELECT user_id, sha256(CAST(json_object('age', age, 'gender', gender, 'occupation', occupation,
       'user_id', user_id) AS VARCHAR)) sha FROM v_users""")
def row_fingerprint(v):
    return v.v_users.select("user_id", S.row_fingerprint("user_id", "age", "gender", "occupation").alias("sha"))


@query("file_fingerprint")
def file_fingerprint(v):
    return files.file_fingerprints(v.spark, f"{v.folder}/*.parquet")
