"""Batch ingest: watch and rating tables, and the keys still to enrich."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.functions import parsing
from marquee.operators.ranking import last_per_key
from marquee.operators.summary import report_row
from marquee.session import materialise
from marquee.sources.files import step_table

PAIR = ["user_id", "movie_id"]


def watch_aggregate(watched: DataFrame) -> DataFrame:
    """Distinct minutes and furthest minute per (user, movie).

    The distinct count shuffles on (user, movie, minute) first, so repeated
    minutes of one hot pair are merged before they meet in one task.
    """
    return watched.groupBy(*PAIR).agg(
        F.countDistinct("minute_no").cast("bigint").alias("interaction_count"),
        F.max("minute_no").alias("max_minute_reached"),
    )


def new_pairs(aggregated: DataFrame, existing: DataFrame, failed: DataFrame) -> DataFrame:
    """Aggregated pairs not stored yet whose movie is not quarantined."""
    return aggregated.join(existing.select(*PAIR), PAIR, "left_anti").join(
        failed.select("movie_id"), "movie_id", "left_anti"
    ).select(*aggregated.columns)


def known_ratings(ratings: DataFrame, users: DataFrame, movies: DataFrame) -> DataFrame:
    """Ratings whose user and movie both occur in the given key sets."""
    return (
        ratings.join(users.select("user_id").distinct(), "user_id", "left_semi")
        .join(movies.select("movie_id").distinct(), "movie_id", "left_semi")
        .select(*ratings.columns)
    )


def latest_ratings(ratings: DataFrame, order: Sequence[str], keys: Sequence[str] = PAIR) -> DataFrame:
    """Last write wins per key; every column that decides must be in ``order``."""
    return last_per_key(ratings, keys, *order)


def missing_keys(facts: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Keys met in the facts that the dimension does not hold yet."""
    return facts.select(key).distinct().join(dimension.select(key), key, "left_anti")


def enrich_or_quarantine(facts: DataFrame, delivered: DataFrame, key: str) -> DataFrame:
    """Every key once, with its delivered attributes or marked for quarantine."""
    found = delivered.withColumn("_found", F.lit(True))
    return (
        facts.select(key)
        .distinct()
        .join(found, key, "left")
        .withColumn("quarantined", F.col("_found").isNull())
        .drop("_found")
    )


def distinct_keys(facts: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """Long table (kind, key) of the distinct values of several columns, in one pass."""
    pairs = F.explode(
        F.array(*[F.struct(F.lit(kind).alias("kind"), F.col(c).cast("string").alias("key")) for kind, c in kinds.items()])
    )
    return facts.select(pairs.alias("p")).select("p.kind", "p.key").filter(F.col("key").isNotNull()).distinct()


def ingest_log(lines: DataFrame, existing: DataFrame, failed: DataFrame) -> dict[str, DataFrame]:
    """New watch pairs and the ratings that belong to them, from raw log lines."""
    watch = materialise(new_pairs(watch_aggregate(parsing.watch_events(lines)), existing, failed), "new-watch")
    ratings = known_ratings(parsing.rating_events(lines), watch, watch)
    return {"watch": watch, "ratings": latest_ratings(ratings, ["timestamp", "rating"])}


def ingest_run(
    messages: DataFrame, existing: DataFrame, failed: DataFrame, users: DataFrame, movies: DataFrame, folder: str
) -> dict[str, DataFrame]:
    """A whole ingest: collect, parse, enrich, ratings; each step is written under ``folder`` and read by the next.

    ``users`` and ``movies`` are what the catalogue delivers for the new keys. A movie it does not
    deliver is quarantined for later runs. A step whose table is there is not done again, so a run that
    was cut short goes on where it stopped.
    """
    spark = messages.sparkSession

    def step(name: str, rows) -> DataFrame:
        return step_table(spark, f"{folder}/{name}", rows)

    lines = step("lines", lambda: parsing.decode_messages(messages).select("value"))
    watch = step("watch", lambda: new_pairs(watch_aggregate(parsing.watch_events(lines)), existing, failed))
    found_users = step("users", lambda: enrich_or_quarantine(watch, users, "user_id"))
    found_movies = step("movies", lambda: enrich_or_quarantine(watch, movies, "movie_id"))
    rated = step("ratings", lambda: latest_ratings(known_ratings(parsing.rating_events(lines), watch, watch), ["timestamp", "rating"]))
    return {"lines": lines, "watch": watch, "users": found_users, "movies": found_movies, "ratings": rated}


def run_summary(run: dict[str, DataFrame]) -> DataFrame:
    """What an ingest run brought in: lines, users, movies, ratings, and the keys left in quarantine."""
    count = lambda name, out: run[name].agg(F.count(F.lit(1)).alias(out))
    held = [run[k].agg(F.count_if("quarantined").alias(f"quarantined_{k}")) for k in ("users", "movies")]
    return report_row(
        run["lines"].sparkSession, *(count(k, k) for k in ("lines", "users", "movies", "ratings")), *held
    )


def ingest_summary(watch: DataFrame) -> DataFrame:
    """How many users and movies an ingest run brought in."""
    users = watch.select("user_id").distinct().agg(F.count(F.lit(1)).alias("users"))
    movies = watch.select("movie_id").distinct().agg(F.count(F.lit(1)).alias("movies"))
    return report_row(watch.sparkSession, users, movies)
