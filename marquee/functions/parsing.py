"""Extraction of watch and rating events from raw log lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The request formats of the click log.
WATCH_PATTERN = r"/data/m/([^/]+)/(\d+)\.mpg"
RATING_PATTERN = r"GET /rate/([^=]+)=(\d+)"
RATING_MARK = "GET /rate/"


def _fields(line: Column) -> Column:
    return F.split(line, ",")


def _leading(line: Column) -> Column:
    return F.regexp_replace(_fields(line)[0], r"^\s+", "")


def decode_messages(messages: DataFrame, value: str = "value") -> DataFrame:
    """Text of broker messages; undecodable and empty payloads are dropped."""
    valid = F.is_valid_utf8(F.col(value)) & (F.length(value) > 0)
    return messages.filter(valid).withColumn(value, F.decode(F.col(value), "UTF-8"))


def watch_events(lines: DataFrame, value: str = "value") -> DataFrame:
    line = F.col(value)
    return (
        lines.filter(line.rlike(WATCH_PATTERN) & (F.size(_fields(line)) >= 3))
        .select(
            _fields(line)[1].alias("user_id"),
            F.regexp_extract(line, WATCH_PATTERN, 1).alias("movie_id"),
            F.regexp_extract(line, WATCH_PATTERN, 2).try_cast("int").alias("minute_no"),
        )
        .filter(F.col("minute_no").isNotNull())
    )


def rating_events(lines: DataFrame, value: str = "value") -> DataFrame:
    line = F.col(value)
    return (
        lines.filter(line.rlike(RATING_PATTERN) & (F.size(_fields(line)) >= 3))
        .select(
            _leading(line).alias("timestamp"),
            _fields(line)[1].alias("user_id"),
            F.regexp_extract(line, RATING_PATTERN, 1).alias("movie_id"),
            F.regexp_extract(line, RATING_PATTERN, 2).try_cast("int").alias("rating"),
        )
        .filter(F.col("rating").isNotNull())
    )


def rating_events_by_split(lines: DataFrame, value: str = "value") -> DataFrame:
    """Rating events read from the third field by position instead of by pattern."""
    line = F.col(value)
    request = F.get(_fields(line), F.lit(2))
    sides = F.split(request, "=")
    return (
        lines.filter(line.contains(RATING_MARK))
        .select(
            _leading(line).alias("timestamp"),
            _fields(line)[1].alias("user_id"),
            F.element_at(F.split(F.get(sides, F.lit(0)), "/"), -1).alias("movie_id"),
            F.trim(F.get(sides, F.lit(1))).try_cast("int").alias("rating"),
        )
        .filter(F.col("rating").isNotNull() & F.col("user_id").isNotNull())
    )


def flatten_movies(documents: DataFrame) -> DataFrame:
    """One flat row per nested movie document."""

    def joined(array: str, field: str) -> Column:
        names = F.transform(F.col(array), lambda item: F.coalesce(item[field], F.lit("")))
        return F.coalesce(F.array_join(names, ","), F.lit(""))

    scalar = ["title", "original_language", "release_date", "runtime", "popularity", "vote_average", "vote_count"]
    return documents.select(
        "id",
        *scalar,
        joined("genres", "name").alias("genres"),
        joined("spoken_languages", "name").alias("spoken_languages"),
        joined("production_countries", "iso_3166_1").alias("production_countries"),
        F.replace(F.coalesce("overview", F.lit("")), F.lit("\n"), F.lit(" ")).alias("overview"),
    )


def safe_file_id(c: Column) -> Column:
    return F.replace(c, F.lit("/"), F.lit("_"))
