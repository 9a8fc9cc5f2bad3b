"""The wide training table: joins, imputation, bins, clips, multi-hot columns, factors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.functions import scalars as S
from marquee.operators.ranking import first_per_key
from marquee.operators.slots import numbered
from marquee.session import materialise

FIXED_COLUMNS = [
    "user_id", "age", "age_bin", "occupation", "gender",
    "movie_id", "runtime", "popularity", "vote_average", "vote_count",
    "release_year", "original_language",
]
MULTI_HOT = ["genre", "country", "lang"]
MOVIE_NUMBERS = ["runtime", "popularity", "vote_average", "vote_count"]
CATEGORIES = ["occupation", "gender", "original_language"]
#: What a movie without tokens, or a rating without a movie, has instead.
NO_TOKEN = "unknown"


def exclude_holdout(df: DataFrame, holdout: DataFrame, key: str = "user_id") -> DataFrame:
    """Rows of keys outside the holdout table, compared in one type."""
    ids = holdout.select(F.col(key).cast(df.schema[key].dataType).alias(key)).distinct()
    return df.join(ids, key, "left_anti").select(*df.columns)


def clean_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(keys))


def enrich(ratings: DataFrame, users: DataFrame, movies: DataFrame) -> DataFrame:
    """Ratings with their user and movie attributes, unmatched ones kept."""
    return ratings.join(users, "user_id", "left").join(movies, "movie_id", "left")


def dedupe_dimension(dimension: DataFrame, key: str, *order: str) -> DataFrame:
    return first_per_key(dimension, [key], *order)


def weighted_median(ratings: DataFrame, dimension: DataFrame, key: str, value: str) -> Column:
    """Median of a dimension attribute over the joined rating rows, as a scalar.

    Ratings are counted per key before the join, so the join and the median work
    on one weighted row per key. Meant for ages and years: few distinct values.
    """
    weights = clean_keys(ratings, [key]).groupBy(key).agg(F.count(F.lit(1)).alias("_w"))
    joined = weights.join(dimension.select(key, F.col(value).alias("_v")), key)
    histogram = joined.groupBy("_v").agg(F.sum("_w").alias("_n"))
    return histogram.agg(F.percentile("_v", F.lit(0.5), F.col("_n"))).scalar()


def token_rows(movies: DataFrame, token_columns: dict[str, str], *keep: str) -> DataFrame:
    """(kept columns, kind, token): a row for every token of the token arrays."""

    def labelled(kind: str, column: str) -> Column:
        return F.transform(F.col(column), lambda t: F.struct(F.lit(kind).alias("kind"), t.alias("token")))

    entries = [labelled(kind, column) for kind, column in token_columns.items()]
    return movies.select(*keep, F.explode(F.concat(*entries)).alias("e")).select(*keep, "e.*")


def vocabulary(movies: DataFrame, token_columns: dict[str, str]) -> DataFrame:
    """Distinct tokens per kind."""
    return token_rows(movies, token_columns).distinct()


def token_index(words: DataFrame) -> DataFrame:
    """(kind, token, position) of a vocabulary, from 0, in order of kind and token.

    A table of any length; stored beside a model it gives train and score one layout.
    """
    return materialise(numbered(words.select("kind", "token"), [F.col("kind").asc(), F.col("token").asc()]), "token-index")


def token_positions(movies: DataFrame, index: DataFrame) -> DataFrame:
    """(movie_id, positions): the ascending positions of a movie's tokens; tokens outside the index have none."""
    rows = token_rows(movies, {kind: f"{kind}_tokens" for kind in MULTI_HOT}, "movie_id")
    return rows.join(index, ["kind", "token"]).groupBy("movie_id").agg(F.sort_array(F.collect_set("position")).alias("positions"))


def sparse_ones(positions: Column, size: int) -> Column:
    """A sparse vector of ``size`` with 1 at the given ascending positions.

    Spark has no function that makes one, but its JSON reader builds any type.
    """
    parts = F.struct(
        F.lit(0).cast("tinyint").alias("type"),
        F.lit(size).alias("size"),
        F.transform(positions, lambda p: p.cast("int")).alias("indices"),
        F.transform(positions, lambda p: F.lit(1.0)).alias("values"),
    )
    return F.from_json(F.to_json(F.struct(parts.alias("v"))), T.StructType([T.StructField("v", VectorUDT())]))["v"]


def token_vectors(movies: DataFrame, index: DataFrame) -> DataFrame:
    """Movie attributes with the token arrays as one sparse vector ``tokens``, made once per movie."""
    found = token_positions(movies, index)
    none = F.array().cast("array<bigint>")
    vector = sparse_ones(F.coalesce("positions", none), index.count())
    plain = movies.drop(*[f"{kind}_tokens" for kind in MULTI_HOT])
    return plain.join(found, "movie_id", "left").withColumn("tokens", vector).drop("positions")


def unknown_tokens(index: DataFrame) -> Column:
    """The tokens of a rating without a movie row, as a scalar: at most one per kind."""
    held = index.filter(F.col("token") == NO_TOKEN).agg(F.sort_array(F.collect_list("position")).alias("p"))
    return held.select(sparse_ones(F.col("p"), index.count()).alias("v")).scalar()


def user_attributes(users: DataFrame) -> DataFrame:
    return users.select(
        "user_id",
        S.number(F.col("age")).alias("age"),
        F.col("occupation"),
        F.col("gender"),
    )


def movie_attributes(movies: DataFrame) -> DataFrame:
    """Movie side of the feature table, computed once per movie rather than per rating."""
    return movies.select(
        "movie_id",
        *[S.number(F.col(c)).alias(c) for c in MOVIE_NUMBERS],
        "original_language",
        S.year_of(F.col("release_date")).alias("release_year"),
        S.tokens(F.coalesce("genres", F.lit("unknown"))).alias("genre_tokens"),
        S.tokens(F.coalesce("production_countries", F.lit("unknown"))).alias("country_tokens"),
        S.language_codes(
            F.col("spoken_languages"), F.coalesce("original_language", F.lit("unknown"))
        ).alias("lang_tokens"),
    )


def fill_constants(df: DataFrame) -> DataFrame:
    """Missing numbers become 0 and missing categories 'unknown', for the columns present."""
    zero = {c: 0.0 for c in MOVIE_NUMBERS if c in df.columns}
    unknown = {c: "unknown" for c in CATEGORIES if c in df.columns}
    return df.fillna(zero).fillna(unknown)


def clip_outliers(df: DataFrame, last_year: int) -> DataFrame:
    bounds = {"age": (5, 100), "runtime": (30, 720), "vote_count": (0, None), "release_year": (1500, last_year)}
    return df.withColumns(
        {c: S.clip(F.col(c), low, high) for c, (low, high) in bounds.items() if c in df.columns}
    )


def multi_hot(kind: str, words: Sequence[str]) -> list[Column]:
    """0/1 columns for the tokens the caller names."""
    tokens = F.col(f"{kind}_tokens")
    return [F.array_contains(tokens, w).cast("int").alias(f"{kind}_{w}") for w in words]


def multi_hot_side(movies: DataFrame, words: dict[str, Sequence[str]]) -> DataFrame:
    """Movie attributes with 0/1 columns for the named tokens instead of the token arrays."""
    hot = [c for kind in MULTI_HOT for c in multi_hot(kind, words.get(kind, []))]
    return movies.select("*", *hot).drop(*[f"{kind}_tokens" for kind in MULTI_HOT])


def hot_columns(words: dict[str, Sequence[str]]) -> list[str]:
    return [f"{kind}_{w}" for kind in MULTI_HOT for w in words.get(kind, [])]


def fill_and_bin(df: DataFrame, age_median: Column, year_median: Column, last_year: int) -> DataFrame:
    """Imputation, then bands, then clips: the band of an out-of-range age stays empty."""
    filled = fill_constants(df).withColumns(
        {
            "age": F.coalesce(F.col("age"), age_median),
            "release_year": F.coalesce(F.col("release_year").cast("double"), year_median),
        }
    )
    return clip_outliers(filled.withColumn("age_bin", S.age_bin(F.col("age"))), last_year)


def feature_table(
    ratings: DataFrame,
    users: DataFrame,
    movies: DataFrame,
    last_year: int,
    index: DataFrame | None = None,
    named: dict[str, Sequence[str]] | None = None,
    factors: dict[str, DataFrame] | None = None,
    rebalance: bool = False,
) -> DataFrame:
    """Training rows: the fixed columns, the rating, the movie's tokens, optional factors.

    With ``index`` the tokens are one sparse vector ``tokens``, whatever their number; ``named`` lists
    tokens that shall have 0/1 columns of their own. ``users`` and ``movies`` hold one row per key.
    ``rebalance`` evens out the partitions while the rows are still narrow, for a table that is read often.
    """
    # The rows and both medians come from one narrow table.
    rated = materialise(clean_keys(ratings, ["user_id", "movie_id"]).select("user_id", "movie_id", "rating"), "rated")
    user_side, movie_side = user_attributes(users), movie_attributes(movies)
    words = named or {}
    laid_out = multi_hot_side(movie_side, words) if index is None else multi_hot_side(movie_side, words).join(
        token_vectors(movie_side.select("movie_id", *[f"{kind}_tokens" for kind in MULTI_HOT]), index), "movie_id"
    )
    sides = [with_factors(side, factors or {}, key) for side, key in ((user_side, "user_id"), (laid_out, "movie_id"))]
    filled = fill_and_bin(
        enrich(rated.hint("rebalance") if rebalance else rated, *sides),
        weighted_median(rated, user_side, "user_id", "age"),
        weighted_median(rated, movie_side, "movie_id", "release_year"),
        last_year,
    )
    # A rating without a movie row carries the token 'unknown' alone.
    hot = [
        F.coalesce(F.col(c), F.lit(1 if c.endswith(f"_{NO_TOKEN}") else 0)).alias(c) for c in hot_columns(words)
    ]
    if index is not None:
        hot.append(F.coalesce(F.col("tokens"), unknown_tokens(index)).alias("tokens"))
    extra = [c for name, table in (factors or {}).items() for c in filled_factors(table, name)]
    return filled.select(*FIXED_COLUMNS, "rating", *hot, *extra)


def factor_key(factors: DataFrame) -> str:
    return "user_id" if "user_id" in factors.columns else "movie_id"


def flagged(factors: DataFrame, name: str) -> DataFrame:
    """(key, name, has_name): the flag is a column of its own, so that who reads it alone moves no vectors."""
    features = F.col("features")
    return factors.select(factor_key(factors), features.alias(name), features.isNotNull().cast("int").alias(f"has_{name}"))


def filled_factors(factors: DataFrame, name: str) -> list[Column]:
    """The factor array, the mean vector where there is none, and the flag."""
    return [
        F.coalesce(F.col(name), mean_vector(factors, "features")).alias(name),
        F.coalesce(F.col(f"has_{name}"), F.lit(0)).alias(f"has_{name}"),
    ]


def with_factors(side: DataFrame, factors: dict[str, DataFrame], key: str) -> DataFrame:
    """A dimension with the factors of its key, also of those it lacks; facts then meet all vectors of a key in one join."""
    for name, table in factors.items():
        if factor_key(table) == key:
            side = side.join(flagged(table, name), key, "full_outer")
    return side


def attach_factors(df: DataFrame, factors: DataFrame, name: str) -> DataFrame:
    """Factor array of a user or movie; the mean vector and a flag where it has none.

    ``factors`` holds (user_id or movie_id, features).
    """
    filled, flag = filled_factors(factors, name)
    return df.join(flagged(factors, name), factor_key(factors), "left").withColumns({name: filled, f"has_{name}": flag})


def mean_embedding(vectors: DataFrame, column: str) -> DataFrame:
    """Mean of every vector position: (pos, value)."""
    return _mean(vectors, column).select(F.posexplode("mean").alias("pos", "value"))


def mean_vector(vectors: DataFrame, column: str) -> Column:
    """The mean vector as a scalar array; as long as one vector, whatever the table size."""
    return _mean(vectors, column).select(F.col("mean").cast("array<float>")).scalar()


def _mean(vectors: DataFrame, column: str) -> DataFrame:
    """One row with the mean vector; whole vectors are summed, without a row per position."""
    present = vectors.filter(F.col(column).isNotNull()).select(array_to_vector(column).alias("v"))
    return present.agg(vector_to_array(Summarizer.mean(F.col("v"))).alias("mean"))


def align_schema(df: DataFrame, expected: Sequence[str]) -> DataFrame:
    """Expected columns in order: missing ones as 0, others dropped."""
    return df.select(*[F.col(c) if c in df.columns else F.lit(0).alias(c) for c in expected])


def confidence(watch: DataFrame, alpha: float = 80.0, w_completion: float = 0.7, w_frequency: float = 0.25) -> DataFrame:
    """Implicit-feedback confidence from watch rows that carry a ``duration``."""
    count = F.coalesce(S.number(F.col("interaction_count")), F.lit(0.0))
    minutes = F.coalesce(S.number(F.col("max_minute_reached")), F.lit(0.0))
    duration = F.coalesce(S.number(F.col("duration")), F.lit(100.0))
    score = w_completion * F.col("completion") + w_frequency * F.col("freq_norm")
    return (
        watch.withColumns({"completion": S.completion(minutes, duration), "freq_norm": S.frequency(count, duration)})
        .withColumn("score", score)
        .withColumn("confidence", F.coalesce(1.0 + alpha * F.col("score"), F.lit(0.0)))
    )


def with_duration(watch: DataFrame, movies: DataFrame) -> DataFrame:
    """Watch rows whose movie has a known runtime; ``movies`` holds one row per movie."""
    runtimes = movies.filter(F.col("runtime").isNotNull()).select("movie_id", F.col("runtime").alias("duration"))
    return watch.join(runtimes, "movie_id")


def cold_start_profiles(requests: DataFrame, users: DataFrame) -> DataFrame:
    """Profile of every requesting user, the default profile for unknown ones."""
    known = users.select("user_id", "age", "occupation", "gender", F.lit(True).alias("_known"))
    joined = requests.select("user_id").distinct().join(known, "user_id", "left")
    return joined.select(
        "user_id",
        *[F.when(F.col("_known"), F.col(c)).otherwise(F.lit(v)).alias(c) for c, v in S.COLD_START.items()],
    )


def hash_split(df: DataFrame, test_share: float = 0.1, seed: int = 42) -> DataFrame:
    """Mark each (user, movie) row 'train' or 'test' by its keys and the seed."""
    test = S.in_share(test_share, F.col("user_id"), F.col("movie_id"), seed=seed)
    return df.withColumn("split", F.when(test, "test").otherwise("train"))


def minmax_scale(df: DataFrame, value: str, train: DataFrame, out: str = "scaled") -> DataFrame:
    """Scale by the range of the training rows; a constant column scales to 0."""
    bounds = train.agg(F.struct(F.min(value).alias("low"), F.max(value).alias("high")).alias("b")).scalar()
    width = bounds["high"] - bounds["low"]
    above = F.col(value) - bounds["low"]
    return df.withColumn(out, S.ratio(above, F.when(width == 0, 1).otherwise(width)))


def minmax_restore(df: DataFrame, scaled: str, value: str, train: DataFrame, out: str) -> DataFrame:
    bounds = train.agg(F.struct(F.min(value).alias("low"), F.max(value).alias("high")).alias("b")).scalar()
    return df.withColumn(out, F.col(scaled) * (bounds["high"] - bounds["low"]) + bounds["low"])


def binarize(df: DataFrame, value: str, threshold: float, out: str = "label") -> DataFrame:
    return df.withColumn(out, (F.col(value) > threshold).cast("int"))
