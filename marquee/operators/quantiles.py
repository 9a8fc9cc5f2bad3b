"""Exact quantiles with linear interpolation, without collecting the values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marquee.session import materialise


CELLS = 4_096


def quantiles_of_counts(df: DataFrame, value: str, shares: Sequence[float]) -> Column:
    """Scalar array of exact quantiles of a column with few distinct values.

    Meant for counts, years and ages: equal values are merged into a histogram
    first, so the aggregation buffer grows with the number of distinct values.
    """
    histogram = df.groupBy(F.col(value).alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    probabilities = F.array(*[F.lit(float(s)) for s in shares])
    return histogram.agg(F.percentile("_v", probabilities, F.col("_n"))).scalar()


def exact_quantiles(
    df: DataFrame, value: str, shares: Sequence[float], accuracy: int = 10_000, by: str | None = None
) -> DataFrame:
    """One row per share: (share, quantile), exact for any number of distinct values.

    An approximate sketch brackets each quantile within a few ``1/accuracy`` of
    the rows. Rows below the bracket are only counted; values inside it are merged
    and counted in narrow cells, and only the cells that hold the two neighbouring
    ranks are sorted. Should a bracket miss its quantile, it is widened, up to all
    values. ``by`` names a column of few values that has quantiles of its own for each.
    """
    group = by or "_all"
    data = df if by else df.withColumn(group, F.lit(0))
    data = data.select(group, F.col(value).cast("double").alias("v")).filter(F.col("v").isNotNull() & ~F.isnan("v"))
    # The sketch errs by n / accuracy ranks at most; one more for its rounding of ranks.
    margin = 3.0 / accuracy
    while True:
        found = materialise(_bracketed(data, group, shares, accuracy, margin), "quantiles")
        if margin >= 1 or found.filter("missed").isEmpty():
            return found.select(*([by] if by else []), "share", "quantile")
        margin *= 16


def _bracketed(data: DataFrame, group: str, shares: Sequence[float], accuracy: int, margin: float) -> DataFrame:
    """(group, share, quantile, missed) with brackets of ``margin`` on either side."""

    def border(share: float, side: int) -> Column:
        at = share + side * margin
        extreme = F.min("v") if side < 0 else F.max("v")
        if not 0 < at < 1:
            return extreme
        # Few rows need no bracket, and a rank is wider than the margin there.
        return F.when(F.count("v") <= accuracy, extreme).otherwise(
            F.percentile_approx("v", F.lit(at), F.lit(accuracy))
        )

    brackets = F.array(
        *[F.struct(F.lit(float(s)).alias("share"), border(s, -1).alias("low"), border(s, 1).alias("high")) for s in shares]
    )
    sketch = data.groupBy(group).agg(F.count("v").alias("size"), brackets.alias("brackets"))
    keys = [group, "share"]

    # Per share: a row below the bracket keeps no value, a row above it is dropped. One sketch row per group.
    counted = (
        data.join(F.broadcast(sketch), group)
        .withColumn("b", F.explode("brackets"))
        .filter(F.col("v") <= F.col("b.high"))
        .select(group, "size", "b.*", F.when(F.col("v") >= F.col("b.low"), F.col("v")).alias("v"))
        .groupBy(*keys, "size", "low", "high", "v")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    # Cut each bracket into equal widths, find the cells that hold the two ranks,
    # and look at single values only there. The rows below the bracket are cell -1.
    width = F.try_divide(F.col("v") - F.col("low"), F.col("high") - F.col("low"))
    cells = counted.withColumn(
        "cell", F.when(F.col("v").isNull(), -1).otherwise(F.floor(F.coalesce(width, F.lit(0.0)) * CELLS)).cast("int")
    )
    at = F.col("share") * (F.col("size") - 1)
    in_order = Window.partitionBy(*keys).orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)
    sizes = (
        cells.groupBy(*keys, "size", "cell")
        .agg(F.sum("rows").alias("held"))
        .withColumn("end", F.sum("held").over(in_order))
        .withColumn("at", at)
    )
    start = F.col("end") - F.col("held")
    holds = [(start <= rank) & (F.col("end") > rank) for rank in (F.floor("at"), F.ceil("at"))]
    chosen = sizes.filter(holds[0] | holds[1]).select(*keys, "cell", "at", start.alias("start"))
    # Two cells per share at most.
    upto = Window.partitionBy(*keys, "cell").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = cells.join(F.broadcast(chosen), [*keys, "cell"]).withColumn(
        "upto", F.col("start") + F.sum("rows").over(upto)
    )
    found = ranked.groupBy(*keys, "at").agg(
        F.max(F.col("v").isNull()).alias("missed"),
        F.min(F.when(F.col("upto") > F.floor("at"), F.col("v"))).alias("lower"),
        F.min(F.when(F.col("upto") > F.ceil("at"), F.col("v"))).alias("upper"),
    )
    exact = F.col("lower") + (F.coalesce("upper", "lower") - F.col("lower")) * (F.col("at") - F.floor("at"))
    return found.select(*keys, exact.alias("quantile"), "missed")


def exact_quantile(df: DataFrame, value: str, share: float) -> Column:
    return exact_quantiles(df, value, [share]).select("quantile").scalar()
