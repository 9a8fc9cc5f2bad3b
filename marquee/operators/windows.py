"""Windowed service metrics; every aggregate merges partial results before its shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marquee.functions.scalars import ratio
from marquee.operators.asof import attach_latest
from marquee.operators.slots import with_next
from marquee.session import materialise

DEFAULT_WINDOW = "10 minutes"
# Upper bounds of the latency histogram, in seconds.
LATENCY_BOUNDS = [0.1, 0.25, 0.5, 1.0, 2.5, 5.0, 10.0, 20.0, 30.0, 60.0, 90.0, 120.0, 180.0, 300.0]
MIN_DENOMINATOR = 1e-9
#: Windows of a gap that one row lays out at a time.
GAP_PIECE = 4_096


def window_start(ts: Column, width: str = DEFAULT_WINDOW) -> Column:
    return F.window(ts, width)["start"]


def windowed(df: DataFrame, width: str = DEFAULT_WINDOW, ts: str = "ts") -> DataFrame:
    return df.withColumn("window_start", window_start(F.col(ts), width))


def count_by(df: DataFrame, *keys: str, width: str = DEFAULT_WINDOW) -> DataFrame:
    return windowed(df, width).groupBy("window_start", *keys).agg(F.count(F.lit(1)).alias("n"))


def error_count(requests: DataFrame, width: str = DEFAULT_WINDOW) -> DataFrame:
    failed = ~F.col("status").between(200, 299)
    return windowed(requests, width).groupBy("window_start").agg(F.count_if(failed).alias("n_errors"))


def event_rate(events: DataFrame, *keys: str, width: str = "1 minute") -> DataFrame:
    """Events per second in each window."""
    seconds = F.unix_timestamp(F.window("ts", width)["end"]) - F.unix_timestamp(F.window("ts", width)["start"])
    return (
        events.select(window_start(F.col("ts"), width).alias("window_start"), seconds.alias("_s"), *keys)
        .groupBy("window_start", *keys)
        .agg(ratio(F.count(F.lit(1)), F.max("_s")).alias("rate"))
    )


def bucket_counts(value: Column, bounds: Sequence[float] = LATENCY_BOUNDS) -> Column:
    """Aggregate: cumulative counts at every bound, then the total (the +Inf bucket)."""
    return F.array(*[F.count_if(value <= b) for b in bounds], F.count(value))


def histogram_quantile(counts: Column, share: float, bounds: Sequence[float] = LATENCY_BOUNDS) -> Column:
    """Quantile interpolated inside its histogram bucket.

    Values above the last finite bound report that bound. The counts merge by
    addition, so this quantile needs no sorted values at any scale.
    """
    last = len(bounds)
    wanted = F.lit(share) * counts[last]
    expr = F.when(counts[last] == 0, F.lit(None).cast("double"))
    for i, bound in enumerate(bounds):
        low, below = (bounds[i - 1], counts[i - 1]) if i else (0.0, F.lit(0))
        inside = F.lit(low) + (bound - low) * F.coalesce(ratio(wanted - below, counts[i] - below), F.lit(1.0))
        expr = expr.when(counts[i] >= wanted, inside)
    return expr.otherwise(bounds[-1])


def latency_quantiles(
    requests: DataFrame, shares: dict[str, float], *keys: str, width: str = DEFAULT_WINDOW, latency: str = "latency"
) -> DataFrame:
    counted = windowed(requests, width).groupBy("window_start", *keys).agg(bucket_counts(F.col(latency)).alias("_c"))
    return counted.select(
        "window_start", *keys, *[histogram_quantile(F.col("_c"), s).alias(name) for name, s in shares.items()]
    )


def histogram_rows(requests: DataFrame, *keys: str, latency: str = "latency") -> DataFrame:
    """Histogram as rows (le, cumulative count), with le NULL for the +Inf bucket."""
    bounds = F.array(*[F.lit(b) for b in LATENCY_BOUNDS], F.lit(None).cast("double"))
    counted = requests.groupBy(*keys).agg(bucket_counts(F.col(latency)).alias("_c"))
    zipped = F.explode(F.arrays_zip(bounds.alias("le"), F.col("_c").alias("n")))
    return counted.select(*keys, zipped.alias("z")).select(*keys, F.col("z.le").alias("le"), F.col("z.n").alias("n"))


def quantile_of_rows(histogram: DataFrame, share: float, *keys: str) -> DataFrame:
    """Quantile from stored (le, count) rows, whose bounds may differ between keys.

    A key holds one row per bucket.
    """
    previous = Window.partitionBy(*keys).orderBy(F.col("le").asc_nulls_last())
    placed = histogram.withColumns(
        {
            "_low": F.coalesce(F.lag("le").over(previous), F.lit(0.0)),
            "_below": F.coalesce(F.lag("n").over(previous), F.lit(0)),
            "_wanted": F.max("n").over(Window.partitionBy(*keys)) * share,
        }
    )
    inside = F.col("_low") + (F.col("le") - F.col("_low")) * F.coalesce(
        ratio(F.col("_wanted") - F.col("_below"), F.col("n") - F.col("_below")), F.lit(1.0)
    )
    hit = placed.filter(F.col("n") >= F.col("_wanted"))
    value = F.coalesce(inside, F.col("_low"))
    return hit.groupBy(*keys).agg(F.min_by(value, F.coalesce("le", F.lit(float("inf")))).alias("quantile"))


def hit_percentage(served: DataFrame, hits: DataFrame, width: str = DEFAULT_WINDOW) -> DataFrame:
    """Hits per served list in percent; windows without hits show 0."""
    shown = windowed(served, width).groupBy("window_start").agg(F.count(F.lit(1)).alias("served"))
    matched = windowed(hits, width).groupBy("window_start").agg(F.count(F.lit(1)).alias("hits"))
    joined = shown.join(matched, "window_start", "full").fillna(0, ["served", "hits"])
    floor = F.greatest(F.col("served").cast("double"), F.lit(MIN_DENOMINATOR))
    return joined.withColumn("ctr_pct", 100 * F.col("hits") / floor)


def interval_seconds(spark: SparkSession, text: str) -> int:
    """Length of an interval such as '10 minutes'."""
    length = spark.range(1).select(F.expr(f"INTERVAL {text}").cast("interval day to second").alias("i")).first()["i"]
    return int(length.total_seconds())


def gaps(events: DataFrame, width: str = DEFAULT_WINDOW) -> DataFrame:
    """Every window between the first and the last event, flagged up or down.

    Each active window looks at the next one; the windows between the two are down. A gap of any
    length is laid out in pieces, so a stray event long ago costs no more than the rows of its gap.
    """
    active = windowed(events.filter(F.col("ts").isNotNull()), width).groupBy("window_start").agg(F.count(F.lit(1)).alias("n"))
    step = interval_seconds(events.sparkSession, width)
    at = F.unix_seconds("window_start")
    followed = with_next(active, "window_start").withColumn("_missing", F.floor((F.unix_seconds("next") - at) / step) - 1)
    pieces = F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("_missing") - 1) / GAP_PIECE))
    piece = followed.filter(F.col("_missing") > 0).select("window_start", "_missing", F.explode(pieces).alias("_piece"))
    from_, to = F.col("_piece") * GAP_PIECE + 1, F.least(F.col("_missing"), (F.col("_piece") + 1) * GAP_PIECE)
    down = piece.select("window_start", F.explode(F.sequence(from_, to)).alias("_k"))
    return followed.select("window_start", "n", F.lit(1).alias("up")).unionByName(
        down.select(F.timestamp_seconds(at + F.col("_k") * step).alias("window_start"), F.lit(0).cast("bigint").alias("n"), F.lit(0).alias("up"))
    )


def offset_lag(offsets: DataFrame) -> DataFrame:
    """Newest produced offset minus newest consumed offset per topic."""
    return offsets.groupBy("topic").agg(
        F.max("produced").alias("produced"), F.coalesce(F.max("consumed"), F.lit(-1)).alias("consumed")
    ).withColumn("lag", F.col("produced") - F.col("consumed"))


def quality_alerts(series: DataFrame, metric: str, threshold: float = 0.1, cooldown: str = "1 hour") -> DataFrame:
    """Windows that raise an alert: metric below the threshold, none raised within the cooldown.

    ``series`` holds one row per window. A low window raises whatever came before if no other low window
    lies within the cooldown before it. From these on, every alert points to the next one, the first low
    window at or after its cooldown; pointers are doubled until no alert is new, so the number of rounds is
    the logarithm of the longest run of alerts.
    """
    low = series.filter((F.col(metric) < threshold) & F.col("window_start").isNotNull())
    low = materialise(low.select(F.unix_micros(F.col("window_start").cast("timestamp")).alias("at")).distinct(), "low")
    pause = interval_seconds(series.sparkSession, cooldown) * 1_000_000
    after = materialise(with_next(low, "at"), "low")
    apart = after.filter(F.col("next") >= F.col("at") + pause).select(F.col("next").alias("at"))
    raised = materialise(apart.unionByName(low.agg(F.min("at").alias("at")).filter(F.col("at").isNotNull())).distinct(), "alerts")
    # The first low window at or after the cooldown is the latest before it when time runs backwards.
    asked = low.select(F.lit(0).alias("all"), "at", F.timestamp_micros(-F.col("at") - pause).alias("ts"), F.lit(0).alias("order"))
    known = low.select(F.lit(0).alias("all"), F.col("at").alias("to"), F.timestamp_micros(-F.col("at")).alias("ts"), F.lit(0).alias("order"))
    jump = attach_latest(asked, known, "all", "ts", "order", "found").select("at", F.col("found.to").alias("to"))
    jump = materialise(jump.filter(F.col("to").isNotNull()), "jumps")
    while True:
        reached = raised.join(jump, "at").select(F.col("to").alias("at")).distinct()
        fresh = materialise(reached.join(raised, "at", "left_anti"), "alerts")
        if fresh.isEmpty():
            return raised.select(F.timestamp_micros("at").alias("alert_at"))
        raised = materialise(raised.unionByName(fresh), "alerts")
        second = jump.select(F.col("at").alias("to"), F.col("to").alias("further"))
        jump = materialise(jump.join(second, "to").select("at", F.col("further").alias("to")), "jumps")
