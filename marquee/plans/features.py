"""Queries: imputation, encoding, splits and the wide feature table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.functions import parsing
from marquee.functions import scalars as S
from marquee.operators import factors, features, offline
from marquee.plans.ingest import P_WATCH, W_AGG, movie_key, watch_agg_of
from marquee.plans.registry import query
from marquee.plans.views import Views
from marquee.session import scratch_path

LAST_YEAR = 2026

# The tokens that occur in the supplied tables.
GENRES = (
    "anvil blue bolt cold gear gizmo hot large new old plate red ring rod small widget".split()
)
COUNTRIES = ["CA", "FR", "US", "unknown"]
LANGUAGES = ["de", "ec", "en", "es", "fr", "la", "me", "pr", "sm", "st"]

ENRICHED = """enriched AS (SELECT r.event_id, r.user_id, r.movie_id, r.rating, u.age, u.occupation, u.gender, m.runtime,
  m.popularity, m.vote_average, m.vote_count, m.original_language, m.genres, m.production_countries, m.spoken_languages,
  YEAR(TRY_CAST(m.release_date AS DATE)) release_year
  FROM v_rating r LEFT JOIN v_users u ON r.user_id = u.user_id LEFT JOIN v_movies m ON r.movie_id = m.movie_id)"""
MEDIANS = """medians AS (SELECT median(u.age) age, median(YEAR(TRY_CAST(m.release_date AS DATE))) release_year
  FROM v_rating_big r LEFT JOIN v_users u ON r.user_id = u.user_id LEFT JOIN v_movies m ON r.movie_id = m.movie_id)"""
AGE_BIN = """CASE WHEN age > 0 AND age <= 18 THEN '0-18' WHEN age > 18 AND age <= 25 THEN '19-25'
  WHEN age > 25 AND age <= 35 THEN '26-35' WHEN age > 35 AND age <= 50 THEN '36-50' WHEN age > 50 AND age <= 100 THEN '50+' END"""
DURATION = """w_dur AS (SELECT w.user_id, w.movie_id, w.interaction_count, w.max_minute_reached, m.runtime duration
  FROM w_agg w JOIN v_movies m ON w.movie_id = concat('m', m.movie_id) WHERE m.runtime IS NOT NULL)"""
PER_RATING = """joined AS (SELECT r.user_id, r.movie_id, r.rating, coalesce(u.age, (SELECT age FROM medians)) age,
  coalesce(occupation, 'unknown') occupation, coalesce(gender, 'unknown') gender, coalesce(runtime, 0) runtime,
  coalesce(popularity, 0) popularity, coalesce(vote_average, 0) vote_average, coalesce(vote_count, 0) vote_count,
  coalesce(YEAR(TRY_CAST(release_date AS DATE)), (SELECT release_year FROM medians)) release_year,
  coalesce(original_language, 'unknown') original_language, coalesce(genres, 'unknown') genres,
  coalesce(production_countries, 'unknown') countries,
  replace(coalesce(spoken_languages, original_language, 'unknown'), ';', ',') langs
  FROM v_rating_big r LEFT JOIN v_users u ON r.user_id = u.user_id LEFT JOIN v_movies m ON r.movie_id = m.movie_id)"""
NAMES = {"en": "English", "fr": "Français", "de": "Deutsch", "es": "Español"}


def _hot_sql(kind: str, words: list[str], text: str) -> str:
    return ", ".join(
        f"CAST(list_contains(str_split({text}, ','), '{NAMES.get(w, w)}') AS INT) AS \"{kind}_{w}\"" for w in words
    )


LANG_TEXT = "replace(coalesce(spoken_languages, original_language), ';', ',')"


def enriched(v: Views) -> DataFrame:
    rated = v.v_rating.select("event_id", "user_id", "movie_id", "rating")
    return features.enrich(rated, features.user_attributes(v.v_users), features.movie_attributes(v.v_movies))


def vocabulary_of(v: Views) -> DataFrame:
    attributes = features.movie_attributes(v.v_movies)
    return features.vocabulary(attributes, {k: f"{k}_tokens" for k in features.MULTI_HOT})


def index_of(v: Views) -> DataFrame:
    return features.token_index(vocabulary_of(v))


def feature_rows(v: Views, ratings: DataFrame | None = None, **options) -> DataFrame:
    """Training rows with the tokens as a sparse vector."""
    return features.feature_table(
        v.v_rating_big if ratings is None else ratings, v.v_users, v.v_movies, LAST_YEAR, index=index_of(v), **options
    )


VOCABULARY = f"""SELECT DISTINCT 'genre' kind, trim(unnest(str_split(coalesce(genres, 'unknown'), ','))) token FROM v_movies
        UNION ALL SELECT DISTINCT 'country', trim(unnest(str_split(coalesce(production_countries, 'unknown'), ','))) FROM v_movies
        UNION ALL SELECT DISTINCT 'lang', CASE t WHEN 'English' THEN 'en' WHEN 'Français' THEN 'fr' WHEN 'Deutsch' THEN 'de'
          WHEN 'Español' THEN 'es' ELSE t END FROM (SELECT unnest(str_split({LANG_TEXT}, ',')) t FROM v_movies)"""
TOKEN_INDEX = f"""token_index AS (SELECT kind, token, row_number() OVER (ORDER BY kind, token) - 1 "position" FROM ({VOCABULARY}))"""
MOVIE_TOKENS = """movie_words AS (SELECT movie_id, 'genre' kind, trim(unnest(str_split(coalesce(genres, 'unknown'), ','))) token FROM v_movies
    UNION SELECT movie_id, 'country', trim(unnest(str_split(coalesce(production_countries, 'unknown'), ','))) FROM v_movies
    UNION SELECT movie_id, 'lang', CASE t WHEN 'English' THEN 'en' WHEN 'Français' THEN 'fr' WHEN 'Deutsch' THEN 'de'
      WHEN 'Español' THEN 'es' ELSE t END FROM (SELECT movie_id, unnest(str_split(LANGS, ',')) t FROM v_movies)),
  movie_tokens AS (SELECT movie_id, concat('(', (SELECT count(*) FROM token_index), ',[', string_agg(CAST("position" AS VARCHAR), ',' ORDER BY "position"),
    '],[', string_agg('1.0', ','), '])') tokens FROM movie_words JOIN token_index USING (kind, token) GROUP BY 1)""".replace("LANGS", LANG_TEXT)


@query("vocabulary", VOCABULARY)
def vocabulary(v):
    return vocabulary_of(v)


@query("token_index", "SELECT * FROM token_index", TOKEN_INDEX)
def token_index(v):
    return index_of(v)


@query("movie_tokens", "SELECT * FROM movie_tokens", TOKEN_INDEX, MOVIE_TOKENS)
def movie_tokens(v):
    """The multi-hot encodings of all kinds as one sparse vector per movie."""
    found = features.token_vectors(features.movie_attributes(v.v_movies), index_of(v))
    return found.select("movie_id", F.col("tokens").cast("string").alias("tokens"))


@query(
    "feature_tokens",
    "SELECT user_id, movie_id, rating, tokens FROM v_rating_big JOIN movie_tokens USING (movie_id)",
    TOKEN_INDEX, MOVIE_TOKENS,
)
def feature_tokens(v):
    """The token part of the training rows."""
    return feature_rows(v).select("user_id", "movie_id", "rating", F.col("tokens").cast("string").alias("tokens"))


@query(
    "normalize_lang",
    f"""SELECT movie_id, CASE t WHEN 'English' THEN 'en' WHEN 'Français' THEN 'fr' WHEN 'Deutsch' THEN 'de' WHEN 'Español' THEN 'es'
        ELSE t END lang FROM (SELECT movie_id, unnest(str_split({LANG_TEXT}, ',')) t FROM v_movies)""",
)
def normalize_lang(v):
    codes = S.language_codes(F.col("spoken_languages"), F.col("original_language"))
    return v.v_movies.select("movie_id", F.explode(codes).alias("lang"))


@query(
    "fill_constant",
    """SELECT event_id, CAST(coalesce(runtime, 0) AS DOUBLE) runtime, round(coalesce(popularity, 0), 6) popularity,
       CAST(coalesce(vote_average, 0) AS DOUBLE) vote_average, CAST(coalesce(vote_count, 0) AS DOUBLE) vote_count,
       coalesce(occupation, 'unknown') occupation, coalesce(gender, 'unknown') gender,
       coalesce(original_language, 'unknown') original_language FROM enriched""",
    ENRICHED,
)
def fill_constant(v):
    return features.fill_constants(enriched(v)).select("event_id", *features.MOVIE_NUMBERS, *features.CATEGORIES)


@query(
    "fill_median",
    "SELECT user_id, CAST(coalesce(age, (SELECT age FROM medians)) AS DOUBLE) age FROM v_users",
    MEDIANS,
)
def fill_median(v):
    median = features.weighted_median(v.v_rating_big, features.user_attributes(v.v_users), "user_id", "age")
    return features.user_attributes(v.v_users).select("user_id", F.coalesce("age", median).alias("age"))


@query(
    "release_year",
    """SELECT movie_id, CAST(coalesce(YEAR(TRY_CAST(release_date AS DATE)), (SELECT release_year FROM medians)) AS DOUBLE) release_year
       FROM v_movies""",
    MEDIANS,
)
def release_year(v):
    movies = features.movie_attributes(v.v_movies)
    median = features.weighted_median(v.v_rating_big, movies, "movie_id", "release_year")
    return movies.select("movie_id", F.coalesce(F.col("release_year").cast("double"), median).alias("release_year"))


@query("age_bin", f"SELECT user_id, age, {AGE_BIN} age_bin FROM v_users")
def age_bin(v):
    return v.v_users.select("user_id", "age", S.age_bin(F.col("age")).alias("age_bin"))


@query(
    "clip_outliers",
    """SELECT event_id, CAST(CASE WHEN age IS NOT NULL THEN least(greatest(age, 5), 100) END AS DOUBLE) age,
       CAST(CASE WHEN runtime IS NOT NULL THEN least(greatest(runtime, 30), 720) END AS DOUBLE) runtime,
       CAST(CASE WHEN vote_count IS NOT NULL THEN greatest(vote_count, 0) END AS DOUBLE) vote_count,
       CAST(CASE WHEN release_year IS NOT NULL THEN least(greatest(release_year, 1500), 2026) END AS INT) release_year FROM enriched""",
    ENRICHED,
)
def clip_outliers(v):
    return features.clip_outliers(enriched(v), LAST_YEAR).select("event_id", "age", "runtime", "vote_count", "release_year")


NAMED = {"genre": GENRES, "country": COUNTRIES, "lang": LANGUAGES}


def _hot(v: Views, kind: str) -> DataFrame:
    return features.movie_attributes(v.v_movies).select("movie_id", *features.multi_hot(kind, NAMED[kind]))


@query("multi_hot_genre", f"SELECT movie_id, {_hot_sql('genre', GENRES, 'genres')} FROM v_movies")
def multi_hot_genre(v):
    return _hot(v, "genre")


@query(
    "multi_hot_country",
    f"""SELECT movie_id, {_hot_sql('country', COUNTRIES, "coalesce(production_countries, 'unknown')")} FROM v_movies""",
)
def multi_hot_country(v):
    return _hot(v, "country")


@query("multi_hot_lang", f"SELECT movie_id, {_hot_sql('lang', LANGUAGES, LANG_TEXT)} FROM v_movies")
def multi_hot_lang(v):
    return _hot(v, "lang")


@query(
    "dim_dedup",
    """SELECT user_id, movie_id first_movie FROM v_rating_big
       QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, l_orderkey, l_linenumber, movie_id) = 1""",
)
def dim_dedup(v):
    first = features.dedupe_dimension(v.v_rating_big, "user_id", "ts", "l_orderkey", "l_linenumber", "movie_id")
    return first.select("user_id", F.col("movie_id").alias("first_movie"))


@query(
    "enrich_ratings",
    """SELECT r.user_id, r.movie_id, r.rating, u.age, u.gender, m.runtime FROM v_rating_big r
       LEFT JOIN v_users u ON r.user_id = u.user_id LEFT JOIN v_movies m ON r.movie_id = m.movie_id""",
)
def enrich_ratings(v):
    rated = v.v_rating_big.select("user_id", "movie_id", "rating")
    return features.enrich(
        rated, v.v_users.select("user_id", "age", "gender"), v.v_movies.select("movie_id", "runtime")
    ).select("user_id", "movie_id", "rating", "age", "gender", "runtime")


FEATURE_SQL = f"""SELECT user_id, CAST(least(greatest(age, 5), 100) AS DOUBLE) age, {AGE_BIN} age_bin, occupation, gender, movie_id,
  CAST(least(greatest(runtime, 30), 720) AS DOUBLE) runtime, round(popularity, 6) popularity,
  CAST(vote_average AS DOUBLE) vote_average, CAST(greatest(vote_count, 0) AS DOUBLE) vote_count,
  CAST(least(greatest(release_year, 1500), 2026) AS DOUBLE) release_year, original_language, rating,
  {_hot_sql('genre', GENRES, 'genres')}, {_hot_sql('country', COUNTRIES, 'countries')}, {_hot_sql('lang', LANGUAGES, 'langs')}
  FROM joined"""


@query("feature_table", FEATURE_SQL, MEDIANS, PER_RATING)
def feature_table(v):
    return named_rows(v)


def named_rows(v: Views, **options) -> DataFrame:
    """Training rows with 0/1 columns for the tokens named above."""
    return features.feature_table(v.v_rating_big, v.v_users, v.v_movies, LAST_YEAR, named=NAMED, **options)


@query("features_roundtrip", FEATURE_SQL, MEDIANS, PER_RATING)
def features_roundtrip(v):
    path = scratch_path(v.spark, "features")
    named_rows(v, rebalance=True).write.parquet(path)
    return v.spark.read.parquet(path)


@query("watch_duration", "SELECT user_id, movie_id, duration FROM w_dur", P_WATCH, W_AGG, DURATION)
def watch_duration(v):
    return watch_with_duration(v).select("user_id", "movie_id", "duration")


def watch_with_duration(v: Views) -> DataFrame:
    movies = v.v_movies.select(movie_key().alias("movie_id"), "runtime")
    return features.with_duration(watch_agg_of(v), movies)


@query(
    "confidence",
    """SELECT user_id, movie_id, duration, round(completion, 6) completion, round(freq_norm, 6) freq_norm,
       round(1 + 80.0 * (0.7 * completion + 0.25 * freq_norm), 6) confidence FROM (
       SELECT *, least(greatest(max_minute_reached / CAST(duration AS DOUBLE), 0), 1) completion,
         ln(1 + interaction_count) / ln(1 + greatest(duration, 1)) freq_norm FROM w_dur)""",
    P_WATCH, W_AGG, DURATION,
)
def confidence(v):
    return features.confidence(watch_with_duration(v)).select(
        "user_id", "movie_id", "duration", "completion", "freq_norm", "confidence"
    )


@query(
    "cold_start_profile",
    """SELECT r.user_id, CASE WHEN u.user_id IS NULL THEN -1 ELSE u.age END age,
       CASE WHEN u.user_id IS NULL THEN 'other or not specified' ELSE u.occupation END occupation,
       CASE WHEN u.user_id IS NULL THEN 'U' ELSE u.gender END gender
       FROM (SELECT user_id FROM v_event UNION SELECT user_id + 10000000 FROM v_event) r
       LEFT JOIN v_users u ON r.user_id = u.user_id""",
)
def cold_start_profile(v):
    requests = v.v_event.select(F.explode(F.array(F.col("user_id"), F.col("user_id") + 10_000_000)).alias("user_id"))
    return features.cold_start_profiles(requests, v.v_users)


EMBED_MEAN = """em AS (SELECT CAST(pos - 1 AS INT) pos, avg(CAST(x AS DOUBLE)) AS value FROM
  (SELECT unnest(embedding) x, generate_subscripts(embedding, 1) pos FROM embeddings) GROUP BY pos)"""


@query("mean_embedding", "SELECT pos, round(value, 6) AS value FROM em", EMBED_MEAN)
def mean_embedding(v):
    return features.mean_embedding(v.embeddings, "embedding")


@query(
    "attach_mean_embedding",
    "SELECT vec_id, pos, round(value, 5) AS value FROM embeddings, em",
    EMBED_MEAN,
)
def attach_mean_embedding(v):
    mean = features.mean_vector(v.embeddings, "embedding")
    attached = v.embeddings.select("vec_id", mean.alias("mean"))
    every = attached.select("vec_id", F.posexplode("mean").alias("pos", "value"))
    return every.withColumn("value", F.round(F.col("value").cast("double"), 5))


@query(
    "id_index",
    "SELECT user_id, row_number() OVER (ORDER BY user_id) - 1 idx FROM (SELECT DISTINCT user_id FROM v_rating_big)",
)
def id_index(v):
    return factors.dense_index(v.v_rating_big, "user_id")


@query(
    "holdout_split",
    """SELECT CASE WHEN user_id IN (SELECT user_id FROM v_holdout) THEN 'holdout' ELSE 'train' END split, count(*) n_rows,
       count(DISTINCT user_id) n_users FROM v_rating_big GROUP BY 1""",
)
def holdout_split(v):
    rated = v.v_rating_big.select("user_id")
    # The holdout arrives as text, as in a CSV of ids.
    holdout = v.v_holdout.select(F.col("user_id").cast("string").alias("user_id"))
    train = features.exclude_holdout(rated, holdout).withColumn("split", F.lit("train"))
    held = rated.join(v.v_holdout, "user_id", "left_semi").withColumn("split", F.lit("holdout"))
    return _split_sizes(train.unionByName(held))


@query(
    "split_hash",
    f"""SELECT CASE WHEN substr(md5(concat('42:', CAST(user_id AS VARCHAR), ':', CAST(movie_id AS VARCHAR))), 1, 8) < '{S.share_limit(0.1)}'
       THEN 'test' ELSE 'train' END split, count(*) n_rows, count(DISTINCT user_id) n_users FROM v_rating_big GROUP BY 1""",
)
def split_hash(v):
    return _split_sizes(features.hash_split(v.v_rating_big.select("user_id", "movie_id"), 0.1))


def _split_sizes(df: DataFrame) -> DataFrame:
    """Rows and users per part; counted per user first, so no part is one task's work."""
    per_user = df.groupBy("split", "user_id").agg(F.count(F.lit(1)).alias("n"))
    return per_user.groupBy("split").agg(F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_users"))


@query(
    "minmax_scale",
    """SELECT event_id, round((minute_no - lo) / CAST(hi - lo AS DOUBLE), 6) scaled, CAST(minute_no AS DOUBLE) restored FROM v_watch,
       (SELECT min(minute_no) lo, max(minute_no) hi FROM v_watch WHERE event_id % 5 <> 0)""",
)
def minmax_scale(v):
    train = v.v_watch.filter("event_id % 5 <> 0")
    scaled = features.minmax_scale(v.v_watch, "minute_no", train)
    return features.minmax_restore(scaled, "scaled", "minute_no", train, "restored").select("event_id", "scaled", "restored")


@query("binarize", "SELECT event_id, CAST(minute_no > 30 AS INT) label FROM v_watch")
def binarize(v):
    return features.binarize(v.v_watch, "minute_no", 30).select("event_id", "label")


@query("rating_scale", "SELECT min(rating) min_rating, max(rating) max_rating FROM v_rating_big")
def rating_scale(v):
    return factors.rating_scale(v.v_rating_big)


@query("align_schema", "SELECT movie_id, 0 AS genre_none, genre_x, 0 AS lang_none FROM (SELECT movie_id, CAST(list_contains(str_split(genres, ','), 'gear') AS INT) genre_x FROM v_movies)")
def align_schema(v):
    movies = features.movie_attributes(v.v_movies)
    hot = movies.select("movie_id", F.array_contains("genre_tokens", "gear").cast("int").alias("genre_x"), "runtime")
    return features.align_schema(hot, ["movie_id", "genre_none", "genre_x", "lang_none"])


@query("input_stats", """SELECT count(*) input_row_count, CAST(sum((age IS NULL)::INT + (occupation IS NULL)::INT + (gender IS NULL)::INT
       + (user_id IS NULL)::INT) AS BIGINT) input_missing_count FROM v_users""")
def input_stats(v):
    return offline.input_stats(v.v_users)


@query(
    "dataset_profile",
    """SELECT count(*) row_count, 6 column_count, CAST(json_object('event_id', count(*) - count(event_id), 'ts', count(*) - count(ts),
       'user_id', count(*) - count(user_id), 'event_type', count(*) - count(event_type), 'value', count(*) - count(value),
       'item', count(*) - count(item)) AS VARCHAR) missing_values_json, CAST(min(ts) AS VARCHAR) date_range_start,
       CAST(max(ts) AS VARCHAR) date_range_end FROM v_event""",
)
def dataset_profile(v):
    return offline.dataset_profile(v.v_event, "ts")


@query(
    "watch_counts_known",
    """SELECT CAST(user_id AS VARCHAR) user_id, count(*) n FROM p_watch WHERE user_id NOT IN
       (SELECT CAST(user_id AS VARCHAR) FROM v_holdout) GROUP BY 1""",
    P_WATCH,
)
def watch_counts_known(v):
    watched = features.exclude_holdout(parsing.watch_events(v.v_log), v.v_holdout)
    return watched.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
