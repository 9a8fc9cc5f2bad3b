"""First, last and best rows per key, and top fractions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marquee.functions.scalars import in_share, mixed


def best_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1, rank: str | None = None) -> DataFrame:
    """The first ``n`` rows of each key in the given order.

    The filter on row_number lets Spark cut every key to ``n`` rows before the
    shuffle, so a hot key costs no more than ``n`` rows per input partition.
    """
    name = rank or "_rank"
    window = Window.partitionBy(*keys).orderBy(*order)
    kept = df.withColumn(name, F.row_number().over(window)).filter(F.col(name) <= n)
    return kept if rank else kept.drop(name)


def first_per_key(df: DataFrame, keys: Sequence[str], *order: str) -> DataFrame:
    return best_per_key(df, keys, [F.col(c).asc() for c in order])


def last_per_key(df: DataFrame, keys: Sequence[str], *order: str) -> DataFrame:
    return best_per_key(df, keys, [F.col(c).desc() for c in order])


def last_n_per_key(df: DataFrame, key: str, sequence: str, n: int) -> DataFrame:
    """Newest ``n`` rows per key, numbered in their original order; ``n = 0`` keeps none."""
    newest = best_per_key(df, [key], [F.col(sequence).desc()], n, rank="_age")
    window = Window.partitionBy(key).orderBy(F.col(sequence).asc())
    return newest.withColumn("position", F.row_number().over(window)).drop("_age")


def top_share(counts: DataFrame, value: str, fraction: float = 0.1) -> DataFrame:
    """Share of the total held by the largest ``fraction`` of rows.

    Rows with equal counts are interchangeable, so the work is done on the
    histogram of counts: with N interactions it has at most sqrt(2N) rows.
    """
    histogram = counts.groupBy(F.col(value).alias("_value")).agg(F.count(F.lit(1)).alias("_rows"))
    total = histogram.agg(
        F.struct(
            F.sum("_rows").alias("rows"),
            F.sum(F.col("_rows") * F.col("_value")).alias("amount"),
        ).alias("t")
    ).scalar()
    above = Window.orderBy(F.col("_value").desc()).rowsBetween(Window.unboundedPreceding, -1)
    k = F.greatest(F.lit(1), F.floor(total["rows"] * F.lit(fraction))).cast("bigint")
    taken = F.least(F.col("_rows"), F.greatest(F.lit(0), k - F.col("_above")))
    return (
        histogram.withColumn("_above", F.coalesce(F.sum("_rows").over(above), F.lit(0)))
        .agg(F.sum(taken * F.col("_value")).alias("_top"))
        .select(
            k.alias("k"),
            F.try_divide(F.col("_top").cast("double"), total["amount"].cast("double")).alias("share"),
        )
    )


def sample_cap(df: DataFrame, keys: Sequence[str], cap: int, seed: int = 42) -> DataFrame:
    """``cap`` rows in a seeded random order.

    Rows are ordered by the MD5 of seed and keys. A 65 536-bin histogram of its first
    digits finds the range that holds the first ``cap`` rows, so only about that many
    rows reach the final sort.
    """
    shuffled = df.withColumn("_hash", mixed(*[F.col(k) for k in keys], seed=seed))
    bins = shuffled.groupBy(F.substring("_hash", 1, 4).alias("_bin")).agg(F.count(F.lit(1)).alias("_rows"))
    running = Window.orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    last_bin = (
        bins.withColumn("_before", F.coalesce(F.sum("_rows").over(running), F.lit(0)))
        .filter(F.col("_before") < cap)
        .agg(F.max("_bin").alias("b"))
        .scalar()
    )
    return (
        shuffled.filter(F.substring("_hash", 1, 4) <= last_bin)
        .orderBy("_hash", *keys)
        .limit(cap)
        .drop("_hash")
    )


def sample_fraction(df: DataFrame, keys: Sequence[str], fraction: float, seed: int = 42) -> DataFrame:
    """Reproducible fraction of the rows: a row is in or out by its keys alone."""
    return df.filter(in_share(fraction, *[F.col(k) for k in keys], seed=seed))
