"""Queries: streams over the supplied events, checked against their batch twins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.operators.windows import LATENCY_BOUNDS
from marquee.plans.ingest import P_RATING
from marquee.plans.online import ATTRIBUTED, N_BOUNDS, _quantile_sql
from marquee.plans.registry import query
from marquee.plans.views import Views
from marquee.session import materialise, scratch_path
from marquee.sources.streams import parquet_stream
from marquee.streaming import attribution, counters, ingest


PARTS = 4
PART_SQL = f"""spanned AS (SELECT min(epoch_us(ts)) lo, max(epoch_us(ts)) hi FROM v_event),
  parted AS (SELECT e.*, coalesce((epoch_us(e.ts) - lo) * {PARTS} // (hi - lo + 1), {PARTS}) part FROM v_event e, spanned)"""


def fed(v: Views, folder: str, parts: range) -> None:
    """Write some of the PARTS + 1 stretches of the events, one after the other, each by many tasks."""
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    span = v.events.agg(F.struct(F.min(at).alias("lo"), F.max(at).alias("hi")).alias("s")).scalar()
    part = F.coalesce(F.floor((at - span["lo"]) * PARTS / (span["hi"] - span["lo"] + 1)), F.lit(PARTS))
    for k in parts:  # the file source reads in the order of writing
        rows = v.events.filter(part == k)
        if k < PARTS or not rows.isEmpty():
            rows.repartition(feed_tasks(v)).write.parquet(f"{folder}/part={k}")


def feed_tasks(v: Views) -> int:
    return max(1, v.events.rdd.getNumPartitions() // PARTS)


def stream_of(v: Views, folder: str) -> Views:
    """The adapter views over a folder of parts; a micro-batch takes the files of one part."""
    return Views(v.spark, v.folder, events=parquet_stream(v.spark, f"{folder}/*", v.events.schema, files_per_batch=feed_tasks(v)))


def live(v: Views) -> Views:
    """The adapter views over the events as a stream of PARTS micro-batches, each a stretch of time.

    Events without a time follow in a part of their own.
    """
    folder = scratch_path(v.spark, "event-parts")
    fed(v, folder, range(PARTS + 1))
    return stream_of(v, folder)


def checkpoint(v: Views) -> str:
    return scratch_path(v.spark, "stream-checkpoint")


@query("stream_ingest", "SELECT value FROM v_log")
def stream_ingest(v):
    out = scratch_path(v.spark, "raw-log")
    messages = live(v).v_log.select(F.col("value").cast("binary").alias("value"))
    ingest.collect_lines(messages, out, checkpoint(v))
    return v.spark.read.schema("value STRING").parquet(out)


@query(
    "stream_lag",
    f"""SELECT 'raw-log' query, (SELECT count(*) FROM v_event) produced, count(*) consumed,
        (SELECT count(*) FROM v_event) - count(*) lag FROM parted WHERE part < {PARTS // 2}""",
    PART_SQL,
)
def stream_lag(v):
    """What the raw log's query has not read yet when half of the parts came after its run."""
    folder, progress = scratch_path(v.spark, "event-parts"), scratch_path(v.spark, "progress")
    fed(v, folder, range(PARTS // 2))
    messages = stream_of(v, folder).v_log.select(F.col("value").cast("binary").alias("value"))
    run = ingest.collect_lines(messages, scratch_path(v.spark, "raw-log"), checkpoint(v))
    ingest.append_progress(run, "raw-log", progress)
    fed(v, folder, range(PARTS // 2, PARTS + 1))
    produced = v.spark.read.schema(v.events.schema).parquet(f"{folder}/*").agg(F.count(F.lit(1)).alias("produced"))
    return ingest.consumer_lag(v.spark, progress, produced.withColumn("query", F.lit("raw-log")))


@query(
    "stream_watch",
    """SELECT concat('', CAST(user_id AS VARCHAR)) user_id, concat('m', CAST(item AS VARCHAR)) movie_id,
       count(DISTINCT CAST(floor(value) AS INT)) interaction_count, max(CAST(floor(value) AS INT)) max_minute_reached FROM parted p WHERE event_type = 'view'
       AND part = (SELECT min(part) FROM parted q WHERE q.event_type = 'view' AND q.user_id = p.user_id AND q.item = p.item) GROUP BY 1, 2""",
    PART_SQL,
)
def stream_watch(v):
    """Counts of the micro-batch in which a pair first occurs; later minutes are ignored."""
    out = scratch_path(v.spark, "watch")
    nothing = v.spark.createDataFrame([], "movie_id STRING")
    ingest.collect_watch_pairs(live(v).v_log, out, checkpoint(v), nothing)
    return ingest.watch_table(v.spark, out)


@query(
    "stream_rating_upsert",
    """SELECT * FROM p_rating QUALIFY row_number() OVER (PARTITION BY user_id, movie_id ORDER BY "timestamp" DESC) = 1""",
    P_RATING,
)
def stream_rating_upsert(v):
    out, snapshots = scratch_path(v.spark, "ratings"), scratch_path(v.spark, "rating-snapshots")
    ingest.collect_ratings(live(v).v_log, out, checkpoint(v))
    ingest.compact_ratings(v.spark, out, snapshots)
    return ingest.current_ratings(v.spark, out, snapshots).drop("batch")


def served_and_clicked(v: Views) -> DataFrame:
    served = v.v_event.filter("event_type = 'view'").select(
        "event_id", "ts", "user_id",
        F.array(*[((F.col("item") + d) % 100).cast("string") for d in (0, 7, 13)]).alias("items"),
        F.when(F.col("event_id") % 10 == 0, "v2").otherwise("v1").alias("model_version"),
        F.lit(None).cast("string").alias("item_id"),
    )
    clicked = v.v_event.filter("event_type = 'click'").select(
        "event_id", "ts", "user_id", F.lit(None).cast("array<string>").alias("items"),
        F.lit(None).cast("string").alias("model_version"), F.col("item").cast("string").alias("item_id"),
    )
    return served.unionByName(clicked)


@query("stream_attribution", "SELECT * FROM attributed", ATTRIBUTED)
def stream_attribution(v):
    out = scratch_path(v.spark, "attributed")
    attribution.attribute_clicks(served_and_clicked(live(v)), out, checkpoint(v), keep="36500 DAYS")
    return attribution.attributed(v.spark, out)


def health_events(v: Views) -> DataFrame:
    kind = (
        F.when(F.col("event_type") == "view", "served")
        .when(F.col("event_type") == "purchase", "rating")
        .when(F.col("event_type") == "error", "error")
    )
    value = F.col("value")
    rated, served = F.col("event_type") == "purchase", F.col("event_type") == "view"
    return v.v_event.select(
        "ts", "user_id", kind.alias("kind"),
        F.when(served, F.array(*[((F.col("item") + d) % 100) for d in (0, 7, 13)])).alias("items"),
        F.when(rated, 1 + F.floor(value).cast("int") % 5).alias("rating"),
        F.when(rated, F.least(F.lit(5.0), F.greatest(F.lit(1.0), value / 20))).alias("predicted"),
        F.when(served, value / 100).alias("response_time"),
    )


@query(
    "stream_counters",
    """SELECT (SELECT count(*) FROM v_recs) served, (SELECT count(*) FROM v_error) errors, count(*) rated,
       round(sum(abs(rating - predicted)), 6) abs_error, round(sum((rating - predicted) * (rating - predicted)), 6) squared_error
       FROM v_quality""",
)
def stream_counters(v):
    out = scratch_path(v.spark, "counters")
    counters.running_counters(health_events(live(v)), out, checkpoint(v))
    return counters.latest_totals(v.spark, out)


HOURLY = f"""hourly AS (SELECT time_bucket(INTERVAL 1 HOUR, ts) h, count(*) FILTER (event_type = 'view') s,
  count(*) FILTER (event_type = 'error') e, coalesce(sum(value / 100) FILTER (event_type = 'view'), 0) r,
  {', '.join(f"count(*) FILTER (event_type = 'view' AND value / 100 <= {b}) c{i}" for i, b in enumerate(LATENCY_BOUNDS))}
  FROM v_event GROUP BY 1),
  sliding AS (SELECT a.h, sum(b.s) s, sum(b.e) e, sum(b.r) r, {', '.join(f'sum(b.c{i}) c{i}' for i in range(N_BOUNDS))}
  FROM hourly a JOIN hourly b ON b.h <= a.h AND b.h > a.h - INTERVAL 24 HOURS GROUP BY 1)"""


@query(
    "stream_online_metrics",
    f"""SELECT h window_end_hour, CAST(s AS BIGINT) num_recommendations, CAST(e AS BIGINT) num_errors,
        round(r, 4) response_time_sum,
        CASE WHEN s = 0 THEN 0 ELSE {_quantile_sql(0.95, [f'c{i}' for i in range(N_BOUNDS)], 's')} END p95_response_time,
        coalesce(round(CAST(e AS DOUBLE) / nullif(s, 0), 6), 0) error_rate FROM sliding""",
    HOURLY,
)
def stream_online_metrics(v):
    exact = ["num_recommendations", "num_errors", "p95_response_time", "error_rate"]
    return streamed_health(v).select("window_end_hour", *exact, F.round("response_time_sum", 4).alias("response_time_sum"))


def streamed_health(v: Views) -> DataFrame:
    out = scratch_path(v.spark, "hourly")
    counters.hourly_health(health_events(live(v)), out, checkpoint(v))
    return counters.sliding_health(v.spark, out)


@query("stream_online_coverage", "SELECT h window_end_hour, true users, true items, true latency FROM sliding", HOURLY)
def stream_online_coverage(v):
    """Whether the sketched figures of every window lie within their stated errors of the exact ones."""
    recent = v.v_recs.select(F.date_trunc("hour", "ts").alias("hour"), "user_id", "items", "response_time")
    found = materialise(streamed_health(v), "sketched").select("window_end_hour", "user_coverage", "item_coverage", "p95_sketched")
    ends = F.transform(F.sequence(F.lit(0), F.lit(23)), lambda k: F.timestamp_seconds(F.unix_seconds("hour") + k * 3600))
    rows = materialise(recent.withColumn("window_end_hour", F.explode(ends)).drop("hour"), "windows")
    users = rows.groupBy("window_end_hour").agg(F.count_distinct("user_id").alias("n_users"))
    items = rows.select("window_end_hour", F.explode("items").alias("item")).groupBy("window_end_hour").agg(F.count_distinct("item").alias("n_items"))
    met = found.join(users, "window_end_hour", "left").join(items, "window_end_hour", "left")
    near = lambda estimate, exact: F.abs(estimate - F.coalesce(exact, F.lit(0))) <= 0.1 * F.coalesce(exact, F.lit(0))
    # The rank of the sketched quantile among the window's response times.
    below = rows.join(found, "window_end_hour").groupBy("window_end_hour").agg(
        (F.count_if(F.col("response_time") <= F.col("p95_sketched")) / F.count(F.lit(1))).alias("rank"),
        (F.lit(1) / F.count(F.lit(1))).alias("one"),
    )
    met = met.join(below, "window_end_hour", "left")
    return met.select(
        "window_end_hour", near(F.col("user_coverage"), F.col("n_users")).alias("users"), near(F.col("item_coverage"), F.col("n_items")).alias("items"),
        F.coalesce(F.abs(F.col("rank") - 0.95) <= 0.03 + F.col("one"), F.lit(True)).alias("latency"),
    )
