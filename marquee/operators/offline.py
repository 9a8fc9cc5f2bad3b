"""Offline analyses of the training data: concentration, fairness, diversity, overview."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.functions.scalars import ratio, tokens
from marquee.operators.quantiles import exact_quantile, quantiles_of_counts
from marquee.operators.ranking import top_share
from marquee.operators.summary import as_struct, report_row
from marquee.session import materialise


#: Distinct (user, movie) pairs whose genres a task counts.
TASK_PAIRS = 250_000


def pearson(x: str, y: str) -> Column:
    """Correlation of two columns; NULL instead of an error when one is constant."""
    spread = F.stddev_samp(x) * F.stddev_samp(y)
    return F.try_divide(F.covar_samp(x, y), F.when(spread != 0, spread))


def movie_popularity(ratings: DataFrame, movies: DataFrame) -> DataFrame:
    """Interactions per movie next to its popularity; movies without one are left out."""
    counts = ratings.groupBy("movie_id").agg(F.count(F.lit(1)).alias("interaction_count"))
    scored = movies.filter(F.col("popularity").isNotNull()).select("movie_id", "popularity")
    return counts.join(scored, "movie_id")


def popularity_correlation(per_movie: DataFrame) -> DataFrame:
    return per_movie.agg(
        F.count(F.lit(1)).alias("n_movies"),
        pearson("interaction_count", "popularity").alias("corr"),
    )


def popularity_concentration(per_movie: DataFrame, fraction: float = 0.1) -> DataFrame:
    return top_share(per_movie, "interaction_count", fraction)


def group_fairness(rated: DataFrame, group: str = "gender", rating: str = "rating") -> DataFrame:
    """Count, mean rating and, when predictions exist, mean absolute error per group."""
    if group not in rated.columns:
        raise ValueError(f"no column {group!r} to group by")
    predicted = next((c for c in ("estimated_rating", "prediction") if c in rated.columns), None)
    error = F.avg(F.abs(F.col(predicted) - F.col(rating))) if predicted else F.lit(None).cast("double")
    return (
        rated.filter(F.col(group).isNotNull())
        .groupBy(group)
        .agg(F.count(F.lit(1)).alias("n"), F.avg(rating).alias("mean_rating"), error.alias("mae"))
    )


def genres_per_user(ratings: DataFrame, movies: DataFrame) -> DataFrame:
    """Distinct genres each user touched; users without any count 0.

    A user with a third of all rows shrinks to distinct movies. The genres of a user meet in one task;
    there are as many tasks as the pairs need, so that what a task holds does not grow with the table.
    """
    pairs = materialise(ratings.select("user_id", "movie_id").distinct(), "pairs")
    tasks = max(ratings.sparkSession.sparkContext.defaultParallelism, -(-pairs.count() // TASK_PAIRS))
    genre_lists = movies.select("movie_id", tokens(F.col("genres")).alias("genres"))
    genres = (
        pairs.join(genre_lists, "movie_id", "left")
        .select("user_id", "genres")
        .repartition(tasks, "user_id")
        .select("user_id", F.explode_outer("genres").alias("genre"))
        .distinct()
    )
    return genres.groupBy("user_id").agg(F.count("genre").alias("n_genres"))


def genre_diversity(ratings: DataFrame, movies: DataFrame) -> DataFrame:
    per_user = genres_per_user(ratings, movies)
    spread = quantiles_of_counts(per_user, "n_genres", [0.5, 0.1, 0.9])
    return per_user.agg(F.count(F.lit(1)).alias("n_users"), F.avg("n_genres").alias("mean_genres")).select(
        "n_users",
        "mean_genres",
        spread[0].alias("median_genres"),
        spread[1].alias("p10_genres"),
        spread[2].alias("p90_genres"),
    )


def _per_key(counts: DataFrame, name: str) -> DataFrame:
    median = quantiles_of_counts(counts, "n", [0.5])[0]
    return counts.agg(F.count(F.lit(1)).alias(f"n_{name}s"), F.avg("n").alias(f"mean_interactions_per_{name}")).withColumn(
        f"median_interactions_per_{name}", median
    )


def log_overview(ratings: DataFrame) -> DataFrame:
    """Row, user and movie counts, rating statistics and interactions per user and movie.

    One pass over the ratings makes a table with a row per user and one per movie; every figure comes
    from that table.
    """
    sums = [F.count(F.lit(1)).alias("n"), F.count("rating").alias("rated"), F.sum("rating").alias("total")]
    sums += [F.sum(F.col("rating") * F.col("rating")).alias("squares"), F.min("rating").alias("low"), F.max("rating").alias("high")]
    sides = ratings.groupingSets([["user_id"], ["movie_id"]], "user_id", "movie_id").agg(F.grouping_id().alias("side"), *sums)
    sides = materialise(sides, "per-key")
    users, movies = sides.filter("side = 1"), sides.filter("side = 2")
    rated, total = F.sum("rated"), F.sum("total")
    variance = F.try_divide(F.sum("squares") - F.try_divide(total * total, rated), rated - 1)
    overall = users.agg(
        F.sum("n").alias("n_rows"),
        F.try_divide(total, rated).alias("mean_rating"),
        F.sqrt(F.greatest(variance, F.lit(0.0))).alias("std_rating"),
        F.min("low").alias("min_rating"),
        F.max("high").alias("max_rating"),
    )
    return report_row(ratings.sparkSession, overall, _per_key(users, "user"), _per_key(movies, "movie"))


def feedback_report(ratings: DataFrame, movies: DataFrame, rated_groups: DataFrame, group: str = "gender") -> DataFrame:
    """The four analyses as one document."""
    per_movie = materialise(movie_popularity(ratings, movies), "per-movie")
    fairness = group_fairness(rated_groups, group)
    groups = fairness.agg(F.array_sort(F.collect_list(F.struct(*fairness.columns)))).scalar()
    spark = ratings.sparkSession
    return spark.range(1).select(
        as_struct(report_row(spark, popularity_correlation(per_movie), popularity_concentration(per_movie))).alias(
            "popularity_stats"
        ),
        groups.alias(f"fairness_by_{group}"),
        as_struct(genre_diversity(ratings, movies)).alias("genre_diversity"),
        as_struct(log_overview(ratings)).alias("offline_log_stats"),
    )


def popularity_totals(watched: DataFrame, minutes: str = "minute_no") -> DataFrame:
    return watched.groupBy("movie_id").agg(F.sum(minutes).cast("bigint").alias("minutes"))


def popularity_top(totals: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` most watched movies with their rank; sorts at most ``n`` rows per partition."""
    top = totals.orderBy(F.col("minutes").desc(), F.col("movie_id").asc()).limit(n)
    best = top.agg(F.array_sort(F.collect_list(F.struct((-F.col("minutes")).alias("k"), "movie_id", "minutes"))).alias("a"))
    return best.select(F.posexplode("a").alias("p", "t")).select(
        F.col("t.movie_id").alias("movie_id"), F.col("t.minutes").alias("minutes"), (F.col("p") + 1).alias("rank")
    )


def popularity_summary(totals: DataFrame) -> DataFrame:
    return totals.agg(
        F.sum("minutes").alias("total"),
        F.avg("minutes").alias("mean"),
        F.stddev_samp("minutes").alias("std"),
        F.count(F.lit(1)).alias("n"),
    ).withColumn("median", exact_quantile(totals, "minutes", 0.5))


def dataset_profile(df: DataFrame, ts: str | None = None) -> DataFrame:
    """Rows, columns, missing values per column as JSON, and the date range."""
    missing = F.to_json(F.struct(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns]))
    bounds = (
        [F.min(ts).cast("string").alias("date_range_start"), F.max(ts).cast("string").alias("date_range_end")]
        if ts
        else []
    )
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.lit(len(df.columns)).alias("column_count"),
        missing.alias("missing_values_json"),
        *bounds,
    )


def input_stats(df: DataFrame) -> DataFrame:
    """Row count and number of missing cells."""
    nulls = sum((F.col(c).isNull().cast("bigint") for c in df.columns), F.lit(0).cast("bigint"))
    return df.agg(
        F.count(F.lit(1)).alias("input_row_count"), F.coalesce(F.sum(nulls), F.lit(0)).alias("input_missing_count")
    )


def error_ratio(errors: DataFrame, served: DataFrame) -> DataFrame:
    """All-time errors per served list."""
    n_errors = errors.agg(F.count(F.lit(1)).alias("e"))
    n_served = served.agg(F.count(F.lit(1)).alias("s")).scalar()
    return n_errors.select(ratio(F.col("e"), F.greatest(n_served, F.lit(1))).alias("rate"))
