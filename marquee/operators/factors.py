"""Collaborative-filtering factors for explicit ratings and implicit watch confidence."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.functions.scalars import number
from marquee.operators.features import mean_embedding
from marquee.operators.slots import global_position
from marquee.session import ensure_checkpoint_dir, materialise


#: Blocks of a side that the trainer takes by itself, and rows up to which it is left at that.
OWN_BLOCKS, FEW_ROWS = 10, 1_000_000
#: Factors of the other side that a task holds at most, and rows of a block whose task holds all of them.
MOST_FACTORS, MOST_ROWS = 1_250_000, 10_000_000


@dataclass
class Factors:
    """Trained factors: (user_id, features), (movie_id, features), and the id map."""

    users: DataFrame
    movies: DataFrame
    ids: DataFrame
    model: ALSModel


def dense_index(df: DataFrame, key: str, out: str = "idx") -> DataFrame:
    """0-based dense index of the distinct values of a numeric key, in key order."""
    distinct = df.select(key).filter(F.col(key).isNotNull()).distinct()
    return global_position(distinct, key, key, out="_p").select(key, (F.col("_p") - 1).alias(out))


def id_map(users: DataFrame, movies: DataFrame) -> DataFrame:
    """(kind, raw_id, idx) from the user and the movie index; ids are kept as text."""
    parts = [
        index.select(F.lit(kind).alias("kind"), F.col(key).cast("string").alias("raw_id"), F.col(code).alias("idx"))
        for index, kind, key, code in (
            (users, "user", "user_id", "user_idx"),
            (movies, "movie", "movie_id", "movie_idx"),
        )
    ]
    return parts[0].unionByName(parts[1])


def rating_scale(ratings: DataFrame) -> DataFrame:
    return ratings.agg(F.min("rating").alias("min_rating"), F.max("rating").alias("max_rating"))


def rating_baseline(ratings: DataFrame, damping: float = 5.0) -> tuple[Column, DataFrame, DataFrame]:
    """Global mean, damped movie offsets and damped user offsets."""
    mean = ratings.agg(F.avg("rating")).scalar()
    movies = ratings.groupBy("movie_id").agg(
        (F.sum(F.col("rating") - mean) / (F.count(F.lit(1)) + damping)).alias("movie_offset")
    )
    users = (
        ratings.join(movies, "movie_id")
        .groupBy("user_id")
        .agg((F.sum(F.col("rating") - mean - F.col("movie_offset")) / (F.count(F.lit(1)) + damping)).alias("user_offset"))
    )
    return mean, movies, users


def _indexed(rows: DataFrame, value: str, keys: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The coded rows and both indices; ``keys`` has the users and movies of ``rows`` and is cheap to read again."""
    users, movies = dense_index(keys, "user_id", "user_idx"), dense_index(keys, "movie_id", "movie_idx")
    coded = (
        rows.join(users, "user_id")
        .join(movies, "movie_id")
        .select(F.col("user_idx").cast("int"), F.col("movie_idx").cast("int"), F.col(value).cast("float").alias("value"))
    )
    return materialise(coded, "als-input", rebalance=True), users, movies


def _blocks(cores: int, rows: int, others: int) -> int:
    """Blocks of one side, whole waves of tasks over the cores.

    A block's task holds the factors of the other side that its rows name: ``others`` at most, and no more than it has
    rows. Every block gets them by shuffle, so there are only as many blocks as the cores or the memory need.
    """
    if rows <= FEW_ROWS:
        return OWN_BLOCKS
    most = MOST_ROWS if others <= MOST_FACTORS else MOST_FACTORS
    return cores * max(1, OWN_BLOCKS // cores, -(-rows // (most * cores)))


def _fit(rows: DataFrame, value: str, keys: DataFrame, seed: int, **params) -> Factors:
    ensure_checkpoint_dir(rows.sparkSession)
    coded, users, movies = _indexed(rows, value, keys)
    cores, size = rows.sparkSession.sparkContext.defaultParallelism, coded.count()
    # An iteration shuffles every factor to most blocks; a checkpoint lets the files of the iterations before it go.
    als = ALS(
        userCol="user_idx", itemCol="movie_idx", ratingCol="value", seed=seed, coldStartStrategy="drop", checkpointInterval=1,
        numUserBlocks=_blocks(cores, size, movies.count()), numItemBlocks=_blocks(cores, size, users.count()), **params
    )
    model = als.fit(coded)

    def named(factors: DataFrame, index: DataFrame, key: str, code: str) -> DataFrame:
        return factors.join(index, factors["id"] == index[code]).select(key, "features")

    return Factors(
        named(model.userFactors, users, "user_id", "user_idx"),
        named(model.itemFactors, movies, "movie_id", "movie_idx"),
        id_map(users, movies),
        model,
    )


def train_explicit(
    ratings: DataFrame, rank: int = 50, iterations: int = 30, reg: float = 0.02, seed: int = 42
) -> Factors:
    """Factors of the rating residual left by the mean and the user and movie offsets."""
    clean = ratings.select("user_id", "movie_id", number(F.col("rating")).alias("rating")).dropna()
    mean, movie_offsets, user_offsets = rating_baseline(clean)
    residual = (
        clean.join(movie_offsets, "movie_id")
        .join(user_offsets, "user_id")
        .select(
            "user_id",
            "movie_id",
            (F.col("rating") - mean - F.col("movie_offset") - F.col("user_offset")).alias("residual"),
        )
    )
    return _fit(residual, "residual", clean, seed, rank=rank, maxIter=iterations, regParam=reg)


def train_implicit(
    watch: DataFrame, rank: int = 50, iterations: int = 20, reg: float = 0.01, alpha: float = 80.0, seed: int = 42
) -> Factors:
    """Factors of the watch score; the trainer applies the confidence 1 + alpha * score itself."""
    scored = watch.select("user_id", "movie_id", F.coalesce("score", F.lit(0.0)).alias("score"))
    return _fit(scored, "score", scored, seed, rank=rank, maxIter=iterations, regParam=reg, alpha=alpha, implicitPrefs=True)


def wide(factors: DataFrame, prefix: str, rank: int) -> DataFrame:
    """Factor array as one column per position, for export."""
    key = factors.columns[0]
    return factors.select(key, *[F.col("features")[i].alias(f"{prefix}{i + 1}") for i in range(rank)])


def mean_embeddings(tables: dict[str, DataFrame]) -> DataFrame:
    """(kind, position, value) means of several factor tables."""
    parts = [
        mean_embedding(t, "features").select(F.lit(kind).alias("kind"), F.col("pos").alias("position"), "value")
        for kind, t in tables.items()
    ]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return union
