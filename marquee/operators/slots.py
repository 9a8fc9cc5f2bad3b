"""Order-preserving numbering of a table.

A window without partitions, or one partitioned by a hot key, sorts its rows in one task. Here the
rows are dealt out by ranges of the whole order, ties and all, and numbered inside their partition;
a table with one row per partition says how many rows stand before it. There are as many partitions
as the rows need, so a key or a value with a third of all rows spreads over a third of the tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marquee.session import materialise

#: monotonically_increasing_id puts the partition above so many bits and the row of the partition below.
ROW_BITS = 33


def ranged(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Rows in ascending ranges of ``order``, sorted inside their partition."""
    return df.repartitionByRange(*order).sortWithinPartitions(*order)


def numbered(df: DataFrame, order: Sequence[Column], out: str = "position", first: int = 0) -> DataFrame:
    """Every row with its place in ``order``, counted from ``first``; rows equal in all of it are interchangeable."""
    table = materialise(ranged(df, order).withColumn("_at", F.monotonically_increasing_id()), "ordered")
    part = F.shiftright("_at", ROW_BITS)
    sizes = table.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))
    inside = F.col("_at").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    # One row per partition of the table.
    return (
        table.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .select(*(F.col(f"`{c}`") for c in df.columns), (F.col("_before") + inside + first).cast("bigint").alias(out))
    )


def global_position(df: DataFrame, primary: str, tiebreak: str, descending: bool = False, out: str = "position") -> DataFrame:
    """1-based position of every row in the order (primary, tiebreak)."""
    leading = F.col(primary).desc() if descending else F.col(primary).asc()
    return numbered(df, [leading, F.col(tiebreak).asc()], out, first=1)


def with_next(df: DataFrame, column: str, out: str = "next") -> DataFrame:
    """Every row with the value of ``column`` that follows its own, NULL for the last; values are distinct."""
    table = materialise(ranged(df, [F.col(column).asc()]).withColumn("_range", F.spark_partition_id()), "ordered")
    # One row per range of the order.
    borders = table.groupBy("_range").agg(F.min(column).alias("_first"))
    following = borders.select("_range", F.lead("_first").over(Window.orderBy("_range")).alias("_following"))
    inside = Window.partitionBy("_range").orderBy(column)
    return (
        table.withColumn("_inside", F.lead(column).over(inside))
        .join(F.broadcast(following), "_range")
        .select(*(F.col(f"`{c}`") for c in df.columns), F.coalesce("_inside", "_following").alias(out))
    )
