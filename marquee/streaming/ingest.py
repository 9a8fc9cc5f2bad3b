"""Streaming ingest: raw lines, new watch pairs, and the rating table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from marquee import schemas
from marquee.functions import parsing
from marquee.operators.ingest import PAIR, latest_ratings, watch_aggregate
from marquee.sources.files import optional_table

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROGRESS = "query STRING, run STRING, batch BIGINT, at TIMESTAMP, source INT, start_offset STRING, end_offset STRING, rows BIGINT"
RATING_ORDER = ["timestamp", "rating"]
STORED_RATINGS = "timestamp STRING, user_id STRING, movie_id STRING, rating INT, batch BIGINT"


def run_available(writer, checkpoint: str) -> StreamingQuery:
    """Process everything the source holds now, then stop."""
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def append_progress(query: StreamingQuery, name: str, path: str) -> None:
    """Append what every micro-batch of a run read: its offsets and rows, a row per source."""
    rows = [
        (name, str(p["runId"]), p["batchId"], p["timestamp"], k, str(s["startOffset"]), str(s["endOffset"]), s["numInputRows"])
        for p in query.recentProgress
        for k, s in enumerate(p["sources"])
    ]
    layout = PROGRESS.replace("at TIMESTAMP", "at STRING")
    SparkSession.active().createDataFrame(rows, layout).withColumn("at", F.to_timestamp("at")).write.mode("append").parquet(path)


def consumer_lag(spark: SparkSession, path: str, produced: DataFrame) -> DataFrame:
    """(query, produced, consumed, lag): rows a source holds minus rows its query has read.

    ``path`` holds the progress of all runs; a micro-batch that was repeated counts once. ``produced``
    holds (query, produced).
    """
    progress = spark.read.schema(PROGRESS).parquet(path)
    once = progress.groupBy("query", "source", "batch").agg(F.max("rows").alias("rows"))
    consumed = once.groupBy("query").agg(F.sum("rows").alias("consumed"))
    joined = produced.join(consumed, "query", "left").withColumn("consumed", F.coalesce("consumed", F.lit(0)))
    return joined.withColumn("lag", F.col("produced") - F.col("consumed"))


def collect_lines(messages: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Append the valid messages of a stream to the raw log table."""
    lines = parsing.decode_messages(messages).select("value")
    return run_available(lines.writeStream.format("parquet").option("path", out), checkpoint)


def collect_watch_pairs(lines: DataFrame, out: str, checkpoint: str, failed: DataFrame) -> None:
    """Append each (user, movie) the first time it occurs; later minutes of a pair are ignored.

    The pairs seen so far are the state of a stream operator, kept by RocksDB, one key a pair: a
    micro-batch looks up its own pairs and reads no earlier batch, however long the table is. Each
    micro-batch writes its own ``batch`` partition, so one that is repeated after a failure replaces its
    own rows.
    """
    lines.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    watched = parsing.watch_events(lines).join(failed.select("movie_id").distinct(), "movie_id", "left_anti")
    columns = [*PAIR, "minute_no"]
    first = watched.dropDuplicates(PAIR).select(*columns, F.lit(True).alias("_new"))
    both = watched.select(*columns, F.lit(False).alias("_new")).unionByName(first)

    def store(batch: DataFrame, number: int) -> None:
        batch.persist()
        fresh = batch.filter("_new").select(*PAIR)
        _write_batch(watch_aggregate(batch.filter("NOT _new").join(fresh, PAIR, "left_semi")), out, number)
        batch.unpersist()

    run_available(both.writeStream.foreachBatch(store), checkpoint)


def collect_ratings(lines: DataFrame, out: str, checkpoint: str) -> None:
    """Append the last rating per (user, movie) of every micro-batch."""

    def store(batch: DataFrame, number: int) -> None:
        _write_batch(latest_ratings(batch, RATING_ORDER), out, number)

    run_available(parsing.rating_events(lines).writeStream.foreachBatch(store), checkpoint)


def current_ratings(spark: SparkSession, out: str, snapshots: str | None = None) -> DataFrame:
    """The rating table: the newest snapshot and the batches after it, last write per pair."""
    rows = optional_table(spark, out, STORED_RATINGS)
    if snapshots is not None:
        through, base = _newest_snapshot(spark, snapshots)
        rows = base.unionByName(rows.filter(F.col("batch") > through)) if base is not None else rows
    return latest_ratings(rows, ["batch", *RATING_ORDER])


def compact_ratings(spark: SparkSession, out: str, snapshots: str) -> None:
    """Write the merged table as a new snapshot, so that reads skip the batches it covers."""
    last = optional_table(spark, out, STORED_RATINGS).agg(F.max("batch")).first()[0]
    if last is None:
        return
    current_ratings(spark, out, snapshots).write.mode("overwrite").parquet(f"{snapshots}/through={last}")


def _newest_snapshot(spark: SparkSession, snapshots: str) -> tuple[int, DataFrame | None]:
    layout = f"{STORED_RATINGS}, through BIGINT"
    stored = optional_table(spark, snapshots, layout)
    through = stored.agg(F.max("through")).first()[0]
    if through is None:
        return -1, None
    return through, stored.filter(F.col("through") == through).drop("through")


def _write_batch(rows: DataFrame, out: str, number: int) -> None:
    rows.write.mode("overwrite").parquet(f"{out}/batch={number}")


def watch_table(spark: SparkSession, out: str) -> DataFrame:
    layout = f"{schemas.WATCH}, batch BIGINT"
    return optional_table(spark, out, layout).select(*PAIR, "interaction_count", "max_minute_reached")
