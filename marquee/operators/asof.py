"""As-of attribution: the latest earlier record of the same key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marquee.operators.slots import ranged
from marquee.session import materialise


def attach_latest(events: DataFrame, history: DataFrame, key: str, ts: str, order: str, out: str = "latest") -> DataFrame:
    """Give every event the most recent ``history`` row of its key at or before it.

    ``events`` and ``history`` share the columns ``key``, ``ts`` and ``order`` (a
    tie-break); the history row arrives as struct ``out``, NULL when there is none.

    Both are dealt out by ranges of (key, time), as many as the rows need. Inside a
    (key, range) the latest row comes from a window. At most one key reaches over
    the border of two ranges; for these few keys the newest row of the earlier
    ranges is carried on. So a hot key, a busy hour, or both, spread over tasks in
    proportion to their rows.
    """
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    seen = history.select(
        F.col(key), micros.alias("_at"), F.col(order).alias("_order"), F.lit(0).alias("_side"),
        F.struct(*[F.col(c) for c in history.columns]).alias("_seen"),
    )
    asked = events.select(
        F.col(key), micros.alias("_at"), F.col(order).alias("_order"), F.lit(1).alias("_side"),
        F.struct(*[F.col(c) for c in events.columns]).alias("_event"),
    )
    both = seen.unionByName(asked, allowMissingColumns=True)
    sorting = [F.col(c) for c in (key, "_at", "_side", "_order")]
    # Read for the borders, the carried rows and the windows.
    both = materialise(ranged(both, sorting).withColumn("_range", F.spark_partition_id()), "asof")

    borders = both.groupBy("_range").agg(F.min(key).alias(key))  # one row per range
    continued = borders.select(key).distinct()
    newest = both.join(F.broadcast(continued), key, "left_semi").groupBy(key, "_range").agg(
        F.max_by(F.col("_seen"), F.when(F.col("_seen").isNotNull(), F.struct("_at", "_order"))).alias("_newest")
    )
    earlier = Window.partitionBy(key).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    carried = newest.select(key, "_range", F.last("_newest", ignorenulls=True).over(earlier).alias("_carried"))
    carried = carried.filter(F.col("_carried").isNotNull())  # at most one row per range and key that goes on

    inside = (
        Window.partitionBy(key, "_range")
        .orderBy("_at", "_side", "_order")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        both.withColumn("_inside", F.last("_seen", ignorenulls=True).over(inside))
        .filter(F.col("_side") == 1)
        .join(F.broadcast(carried), [key, "_range"], "left")
        .select("_event.*", F.coalesce("_inside", "_carried").alias(out))
    )
