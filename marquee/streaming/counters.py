"""Running counters and sliding health metrics from streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.functions.scalars import ratio
from marquee.operators.windows import bucket_counts, histogram_quantile, window_start
from marquee.streaming.ingest import run_available


def running_counters(events: DataFrame, out: str, checkpoint: str) -> None:
    """Totals since the start: served lists, failures, rated events and their error sums.

    ``events`` holds kind ('served', 'rating', 'error'), rating and predicted.
    Spark keeps one row of state; every micro-batch writes the totals so far.
    """
    error = F.col("rating") - F.col("predicted")
    totals = events.groupBy().agg(
        F.count_if(F.col("kind") == "served").alias("served"),
        F.count_if(F.col("kind") == "error").alias("errors"),
        F.count(error).alias("rated"),
        F.coalesce(F.sum(F.abs(error)), F.lit(0.0)).alias("abs_error"),
        F.coalesce(F.sum(error * error), F.lit(0.0)).alias("squared_error"),
    )

    def store(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    run_available(totals.writeStream.outputMode("complete").foreachBatch(store), checkpoint)


def latest_totals(spark: SparkSession, out: str) -> DataFrame:
    stored = spark.read.parquet(out)
    newest = stored.agg(F.max("batch")).scalar()
    return stored.filter(F.col("batch") == newest).drop("batch")


def hourly_health(events: DataFrame, out: str, checkpoint: str) -> None:
    """Mergeable hourly figures of every micro-batch: counts, sums, histogram and sketches.

    ``events`` holds ts, kind, user_id, items and response_time. A micro-batch appends what it adds to each
    hour, so a late event is merged into its hour however late it is, and the stream keeps no state.
    """
    seen = F.col("kind") == "served"

    def store(batch: DataFrame, number: int) -> None:
        rows = batch.withColumn("hour", window_start(F.col("ts"), "1 hour"))
        figures = rows.groupBy("hour").agg(
            F.count_if(seen).alias("served"),
            F.count_if(F.col("kind") == "error").alias("errors"),
            F.coalesce(F.sum("response_time"), F.lit(0.0)).alias("response_sum"),
            bucket_counts(F.col("response_time")).alias("histogram"),
            F.hll_sketch_agg(F.when(seen, F.col("user_id"))).alias("users"),
            F.kll_sketch_agg_double("response_time").alias("latency"),
        )
        shown = rows.select("hour", F.explode("items").alias("item")).groupBy("hour").agg(F.hll_sketch_agg("item").alias("shown"))
        figures.join(shown, "hour", "left").write.mode("overwrite").parquet(f"{out}/batch={number}")

    run_available(events.writeStream.foreachBatch(store), checkpoint)


def compact_hours(spark: SparkSession, out: str, path: str) -> None:
    """The rows of all micro-batches merged to one row per hour, as a table of the same layout."""
    _merged(spark.read.parquet(out), "hour").write.parquet(f"{path}/batch=0")


def _merged(rows: DataFrame, key: str) -> DataFrame:
    """Counts and sums added, sketches united."""
    places = F.posexplode("histogram").alias("place", "n")
    added = rows.select(key, places).groupBy(key, "place").agg(F.sum("n").alias("n"))
    histogram = added.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "n"))), lambda p: p["n"]).alias("histogram"))
    figures = rows.groupBy(key).agg(
        *[F.sum(c).alias(c) for c in ("served", "errors", "response_sum")],
        F.hll_union_agg("users").alias("users"),
        F.hll_union_agg("shown").alias("shown"),
        F.kll_merge_agg_double("latency").alias("latency"),
    )
    return figures.join(histogram, key)


def sliding_health(spark: SparkSession, out: str, hours: int = 24) -> DataFrame:
    """Health over the last ``hours`` at the end of every hour, from the hourly rows.

    Every hour counts in the windows of the ``hours`` hours from itself on; partial rows of an hour are
    merged there, so nothing is sorted and no hour waits for another. Coverages come from HyperLogLog
    sketches (2 % standard error) and ``p95_sketched`` from a KLL sketch (1.5 % of the ranks).
    """
    stored = spark.read.parquet(out).drop("batch")
    ends = F.transform(F.sequence(F.lit(0), F.lit(hours - 1)), lambda k: F.timestamp_seconds(F.unix_seconds("hour") + k * 3600))
    spread = stored.withColumn("window_end_hour", F.explode(ends))
    present = stored.select(F.col("hour").alias("window_end_hour")).distinct()
    summed = _merged(spread.join(present, "window_end_hour", "left_semi").drop("hour"), "window_end_hour")
    count = lambda sketch: F.coalesce(F.hll_sketch_estimate(sketch), F.lit(0))
    return summed.select(
        "window_end_hour",
        F.col("served").alias("num_recommendations"),
        F.col("errors").alias("num_errors"),
        F.col("response_sum").alias("response_time_sum"),
        F.coalesce(ratio(F.col("response_sum"), F.col("served")), F.lit(0.0)).alias("avg_response_time"),
        F.coalesce(histogram_quantile(F.col("histogram"), 0.95), F.lit(0.0)).alias("p95_response_time"),
        F.coalesce(ratio(F.col("errors"), F.col("served")), F.lit(0.0)).alias("error_rate"),
        count("users").alias("user_coverage"),
        count("shown").alias("item_coverage"),
        F.when(F.kll_sketch_get_n_double("latency") > 0, F.kll_sketch_get_quantile_double("latency", F.lit(0.95))).alias("p95_sketched"),
    )
