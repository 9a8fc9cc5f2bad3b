"""Model quality: regression, classification, ranking and side-by-side accuracy."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.functions.scalars import ratio


def _or_zero(numerator: Column, denominator: Column) -> Column:
    return F.coalesce(ratio(numerator, denominator), F.lit(0.0))


def regression_metrics(scored: DataFrame, *by: str, label: str = "label", prediction: str = "prediction") -> DataFrame:
    error = F.col(prediction) - F.col(label)
    sums = scored.groupBy(*by).agg(
        F.avg(error * error).alias("mse"), F.avg(F.abs(error)).alias("mae"), F.var_pop(label).alias("_spread")
    )
    r2 = F.when(F.col("_spread") > 0, 1 - F.try_divide("mse", "_spread")).otherwise((F.col("mse") == 0).cast("double"))
    return sums.select(*by, "mse", F.sqrt("mse").alias("rmse"), "mae", r2.alias("r2"))


def classification_metrics(
    scored: DataFrame, *by: str, threshold: float = 3, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    actual, called = F.col(label) >= threshold, F.col(prediction) >= threshold
    counts = scored.groupBy(*by).agg(
        F.count_if(actual & called).alias("tp"),
        F.count_if(~actual & called).alias("fp"),
        F.count_if(actual & ~called).alias("fn"),
        F.count_if(actual == called).alias("right"),
        F.count(F.lit(1)).alias("n"),
    )
    tp = F.col("tp")
    return counts.select(
        *by,
        _or_zero(tp, tp + F.col("fp")).alias("precision"),
        _or_zero(tp, tp + F.col("fn")).alias("recall"),
        _or_zero(2 * tp, 2 * tp + F.col("fp") + F.col("fn")).alias("f1"),
        _or_zero(F.col("right"), F.col("n")).alias("accuracy"),
    )


def model_compare(scored: DataFrame, threshold: float = 3, by: Sequence[str] = ("model",)) -> DataFrame:
    """Accuracy of thresholded predictions of several models on one test set."""
    return classification_metrics(scored, *by, threshold=threshold).select(*by, "accuracy")


def ranking_metrics(ranked: DataFrame, truth: DataFrame, k: int = 20) -> DataFrame:
    """Hit, precision, recall and NDCG at ``k``, averaged over users with any truth.

    ``ranked`` holds (movie_id, rank), or (user_id, movie_id, rank) for personal
    lists; ``truth`` holds (user_id, movie_id).
    """
    wanted = truth.select("user_id", "movie_id").distinct()
    keys = ["user_id", "movie_id"] if "user_id" in ranked.columns else ["movie_id"]
    top = ranked.filter(F.col("rank") <= k).select(*keys, "rank")
    gain = F.when(F.col("rank").isNotNull(), 1 / F.log2(F.col("rank") + 1.0))
    per_user = (
        wanted.join(top, keys, "left")
        .groupBy("user_id")
        .agg(
            F.count(F.lit(1)).alias("n_true"),
            F.count("rank").alias("hits"),
            F.coalesce(F.sum(gain), F.lit(0.0)).alias("dcg"),
        )
    )
    ideals = [0.0]
    for place in range(1, k + 1):
        ideals.append(ideals[-1] + 1 / _log2(place + 1))
    ideal = F.get(F.array(*[F.lit(v) for v in ideals]), F.least(F.col("n_true"), F.lit(k)).cast("int"))
    return per_user.agg(
        F.avg((F.col("hits") > 0).cast("double")).alias("hit"),
        F.avg(F.col("hits") / k).alias("precision"),
        F.avg(F.col("hits") / F.col("n_true")).alias("recall"),
        F.avg(F.col("dcg") / ideal).alias("ndcg"),
    )


def _log2(x: float) -> float:
    from math import log2

    return log2(x)
