"""Queries: factors, models, recommendations, ranking quality."""

from __future__ import annotations

import time

from pyspark.ml import Pipeline
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee import schemas
from marquee.functions import scalars as S
from marquee.operators import factors, features, metrics, models, offline, ranking, recommend, refresh, retrain, similarity
from marquee.plans.features import DURATION, LAST_YEAR, feature_rows, index_of, watch_with_duration
from marquee.plans.ingest import P_WATCH, W_AGG
from marquee.plans.offline import EARLIER, REFRESH, TOTALS, stats_of, totals_of
from marquee.plans.registry import query
from marquee.plans.views import Views
from marquee.session import materialise, scratch_path
from marquee.sources import registry, sinks
from marquee.sources.files import file_listing

N = 20
PROFILE = ["age_bin", "occupation", "gender"]
CANDIDATES = 10

LIKED = """liked AS (SELECT DISTINCT r.user_id, unnest(str_split(m.genres, ',')) g FROM v_rating r JOIN v_movies m
    ON r.movie_id = m.movie_id WHERE r.rating = 5),
  movie_genres AS (SELECT DISTINCT movie_id, popularity, unnest(str_split(genres, ',')) g FROM v_movies),
  genre_scores AS (SELECT l.user_id, m.movie_id, count(*) * any_value(m.popularity) score FROM liked l JOIN movie_genres m ON l.g = m.g
    GROUP BY 1, 2),
  topn AS (SELECT user_id, movie_id, round(score, 6) score, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, movie_id) AS rank
    FROM genre_scores QUALIFY rank <= 20)"""
LAST_RATINGS = """last_ratings AS (SELECT user_id, movie_id, rating FROM v_rating_big
    QUALIFY row_number() OVER (PARTITION BY user_id, movie_id ORDER BY ts DESC, l_orderkey DESC, l_linenumber DESC, rating DESC) = 1),
  train_ratings AS (SELECT * FROM last_ratings WHERE user_id NOT IN (SELECT user_id FROM v_holdout))"""
POSITIONS = """positions AS (SELECT movie_id, row_number() OVER (ORDER BY count(*) DESC, movie_id) AS "position"
  FROM v_rating_big GROUP BY 1)"""


def genre_recommendations(v: Views) -> DataFrame:
    profiles = recommend.genre_profiles(v.v_rating.filter("rating = 5"), v.v_movies)
    return recommend.recommend_by_genre(profiles, v.v_movies, N)


def long_rank(df: DataFrame) -> DataFrame:
    return df.withColumn("rank", F.col("rank").cast("bigint"))


@query("recommend_topn", "SELECT * FROM topn", LIKED)
def recommend_topn(v):
    return long_rank(genre_recommendations(v))


@query(
    "recommend_csv",
    """SELECT user_id, string_agg(CAST(movie_id AS VARCHAR), ', ' ORDER BY rank) items FROM topn GROUP BY 1""",
    LIKED,
)
def recommend_csv(v):
    return recommend.served_text(genre_recommendations(v))


@query(
    "recommend_unseen",
    """SELECT u.user_id, p.movie_id, row_number() OVER (PARTITION BY u.user_id ORDER BY p."position") AS rank FROM v_users u, positions p
       WHERE NOT EXISTS (SELECT 1 FROM v_rating_big r WHERE r.user_id = u.user_id AND r.movie_id = p.movie_id) QUALIFY rank <= 20""",
    POSITIONS,
)
def recommend_unseen(v):
    ranked = recommend.popularity_positions(v.v_rating_big)
    return long_rank(recommend.recommend_unseen(ranked, v.v_users, v.v_rating_big, N))


@query("popularity_position", "SELECT * FROM positions", POSITIONS)
def popularity_position(v):
    return recommend.popularity_positions(v.v_rating_big).select("movie_id", "position")


POPULAR = """popular AS (SELECT movie_id, row_number() OVER (ORDER BY minutes DESC, movie_id) AS rank FROM totals QUALIFY rank <= 20)"""


@query(
    "recommend_fallback",
    """SELECT user_id, movie_id, rank, false fallback FROM topn WHERE user_id IN (SELECT user_id FROM v_users)
       UNION ALL SELECT u.user_id, p.movie_id, p.rank, true FROM v_users u, popular p
       WHERE u.user_id NOT IN (SELECT user_id FROM topn)""",
    LIKED, TOTALS, POPULAR,
)
def recommend_fallback(v):
    popular = offline.popularity_top(totals_of(v), N).select(F.col("movie_id").cast("bigint"), "rank")
    lists = materialise(genre_recommendations(v), "lists")
    return long_rank(recommend.recommend_fallback(v.v_users, lists, popular, N))


@query(
    "candidate_pairs",
    """SELECT age_bin, occupation, gender, movie_id FROM (SELECT DISTINCT CASE WHEN age > 0 AND age <= 18 THEN '0-18'
       WHEN age > 18 AND age <= 25 THEN '19-25' WHEN age > 25 AND age <= 35 THEN '26-35' WHEN age > 35 AND age <= 50 THEN '36-50'
       WHEN age > 50 AND age <= 100 THEN '50+' END age_bin, occupation, gender FROM v_users), v_movies""",
)
def candidate_pairs(v):
    profiles = v.v_users.withColumn("age_bin", S.age_bin(F.col("age")))
    return recommend.candidate_rows(v.v_movies.select("movie_id"), profiles, PROFILE).select(*PROFILE, "movie_id")


@query(
    "ranking_metrics",
    """SELECT round(avg(CAST(hits > 0 AS INT)), 6) hit, round(avg(hits / 20.0), 6) AS precision,
       round(avg(hits / CAST(n_true AS DOUBLE)), 6) recall, round(avg(dcg / idcg), 6) ndcg FROM per_user JOIN ideals USING (n_true)""",
    TOTALS,
    """top20 AS (SELECT movie_id, row_number() OVER (ORDER BY minutes DESC, movie_id) AS rank FROM totals QUALIFY rank <= 20),
       truth AS (SELECT DISTINCT user_id, item_id movie_id FROM v_inter),
       per_user AS (SELECT user_id, count(*) n_true, count(rank) hits,
         sum(CASE WHEN rank IS NOT NULL THEN 1 / log2(rank + 1) ELSE 0 END) dcg FROM truth LEFT JOIN top20 USING (movie_id) GROUP BY 1),
       ideals AS (SELECT n_true, sum(1 / log2(i + 1)) idcg FROM (SELECT DISTINCT n_true FROM per_user), range(1, 21) t(i)
         WHERE i <= n_true GROUP BY 1)""",
)
def ranking_metrics(v):
    truth = v.v_inter.select("user_id", F.col("item_id").alias("movie_id"))
    return metrics.ranking_metrics(offline.popularity_top(totals_of(v), 20), truth, 20)


SIMILAR = """pairs AS (SELECT DISTINCT user_id, movie_id FROM v_watch), sizes AS (SELECT movie_id, count(*) n FROM pairs GROUP BY 1),
  alike AS (SELECT a.movie_id i, b.movie_id j, count(*) / sqrt(any_value(x.n) * any_value(y.n)) cosine
    FROM pairs a JOIN pairs b ON a.user_id = b.user_id AND a.movie_id < b.movie_id
    JOIN sizes x ON x.movie_id = a.movie_id JOIN sizes y ON y.movie_id = b.movie_id GROUP BY 1, 2)"""


@query("item_item_sim", "SELECT i, j, round(cosine, 6) cosine FROM alike", SIMILAR)
def item_item_sim(v):
    similar = similarity.item_similarity(v.v_watch)
    return similar.select(F.col("i").cast("int"), F.col("j").cast("int"), "cosine")


TOP_SIMILAR = """both_ways AS (SELECT i, j, cosine FROM alike UNION ALL SELECT j, i, cosine FROM alike),
  top_similar AS (SELECT i, j, cosine, row_number() OVER (PARTITION BY i ORDER BY cosine DESC, j) AS rank FROM both_ways
    QUALIFY rank <= 20)"""


@query("item_item_top", "SELECT i, j, round(cosine, 6) cosine, rank FROM top_similar", SIMILAR, TOP_SIMILAR)
def item_item_top(v):
    top = similarity.item_similarity(v.v_watch, top_n=20)
    return long_rank(top.select(F.col("i").cast("int"), F.col("j").cast("int"), "cosine", "rank"))


@query(
    "ranking_item_item",
    """SELECT round(avg(CAST(hits > 0 AS INT)), 6) hit, round(avg(hits / 20.0), 6) AS precision,
       round(avg(hits / CAST(n_true AS DOUBLE)), 6) recall, round(avg(dcg / idcg), 6) ndcg FROM per_user JOIN ideals USING (n_true)""",
    SIMILAR,
    TOP_SIMILAR,
    """suggested AS (SELECT user_id, movie_id, row_number() OVER (PARTITION BY user_id ORDER BY round(score, 9) DESC, movie_id) AS rank
         FROM (SELECT p.user_id, t.j movie_id, sum(t.cosine) score FROM pairs p JOIN top_similar t ON t.i = p.movie_id GROUP BY 1, 2) s
         WHERE NOT EXISTS (SELECT 1 FROM pairs q WHERE q.user_id = s.user_id AND q.movie_id = s.movie_id) QUALIFY rank <= 20),
       truth AS (SELECT DISTINCT user_id, item_id movie_id FROM v_inter),
       per_user AS (SELECT user_id, count(*) n_true, count(rank) hits,
         sum(CASE WHEN rank IS NOT NULL THEN 1 / log2(rank + 1) ELSE 0 END) dcg FROM truth LEFT JOIN suggested USING (user_id, movie_id)
         GROUP BY 1),
       ideals AS (SELECT n_true, sum(1 / log2(i + 1)) idcg FROM (SELECT DISTINCT n_true FROM per_user), range(1, 21) t(i)
         WHERE i <= n_true GROUP BY 1)""",
)
def ranking_item_item(v):
    """The item-item ranker judged like the popularity ranker, on items not yet watched."""
    similar = materialise(similarity.item_similarity(v.v_watch, top_n=20), "similar")
    lists = recommend.recommend_by_similarity(similar, v.v_watch, 20)
    truth = v.v_inter.select("user_id", F.col("item_id").alias("movie_id"))
    return metrics.ranking_metrics(lists, truth, 20)


SAMPLE_KEY = "concat_ws(':', '42', CAST(user_id AS VARCHAR), CAST(movie_id AS VARCHAR), CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR))"


@query(
    "sample_cap",
    f"SELECT * FROM v_rating_big ORDER BY md5({SAMPLE_KEY}), user_id, movie_id, l_orderkey, l_linenumber LIMIT 10000",
)
def sample_cap(v):
    keys = ["user_id", "movie_id", "l_orderkey", "l_linenumber"]
    return ranking.sample_cap(v.v_rating_big, keys, 10_000)


@query("sample_fraction", f"SELECT * FROM v_rating_big WHERE substr(md5({SAMPLE_KEY}), 1, 8) < '{S.share_limit(0.2)}'")
def sample_fraction(v):
    keys = ["user_id", "movie_id", "l_orderkey", "l_linenumber"]
    return ranking.sample_fraction(v.v_rating_big, keys, 0.2)


def last_ratings(v: Views) -> DataFrame:
    """The newest rating of every user and movie."""
    newest = [F.col(c).desc() for c in ("ts", "l_orderkey", "l_linenumber", "rating")]
    return ranking.best_per_key(v.v_rating_big, ["user_id", "movie_id"], newest).select("user_id", "movie_id", "rating")


def training_ratings(v: Views) -> DataFrame:
    return features.exclude_holdout(last_ratings(v), v.v_holdout)


#: (session, folder) -> the files' listing, and what was built from them.
TRAINED: dict[tuple[str, str], tuple[str, dict[str, object]]] = {}


def once(v: Views, kind: str, build):
    """A model trained once in a session for the files of a folder; several queries use it.

    Tables that are written anew have other files, so their models are trained anew; those of the
    files before are forgotten.
    """
    place, files = (v.spark.sparkContext.applicationId, v.folder), file_listing(v.spark, v.folder)
    if TRAINED.get(place, ("", {}))[0] != files:
        TRAINED[place] = (files, {})
    built = TRAINED[place][1]
    if kind not in built:
        built[kind] = build()
    return built[kind]


def explicit(v: Views) -> factors.Factors:
    return once(v, "explicit", lambda: factors.train_explicit(materialise(training_ratings(v), "ratings")))


def watch_scores(v: Views) -> DataFrame:
    return features.confidence(watch_with_duration(v)).select(
        F.col("user_id").cast("bigint").alias("user_id"),
        F.substring("movie_id", 2, 20).cast("bigint").alias("movie_id"),
        "score",
    )


def implicit(v: Views) -> factors.Factors:
    return once(v, "implicit", lambda: factors.train_implicit(materialise(watch_scores(v), "watch-scores")))


def _stored(found: factors.Factors) -> DataFrame:
    """Both factor tables and the id map, written and read back."""
    path = scratch_path(found.users.sparkSession, "factors")
    found.users.write.parquet(f"{path}/users")
    found.movies.write.parquet(f"{path}/movies")
    found.ids.write.parquet(f"{path}/ids")
    read = found.users.sparkSession.read.parquet
    users = read(f"{path}/users").select(F.lit("user").alias("kind"), F.col("user_id").cast("string").alias("raw_id"), "features")
    movies = read(f"{path}/movies").select(F.lit("movie").alias("kind"), F.col("movie_id").cast("string").alias("raw_id"), "features")
    return users.unionByName(movies).join(read(f"{path}/ids"), ["kind", "raw_id"])


@query("mf_explicit")
def mf_explicit(v):
    return _stored(explicit(v))


def _keys(found: factors.Factors) -> DataFrame:
    """What is exact about trained factors: whom they cover, their index, and their length."""
    return _stored(found).select("kind", "raw_id", "idx", F.size("features").cast("bigint").alias("n_factors"))


def _keys_sql(pairs: str) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{kind}' kind, CAST(k AS VARCHAR) raw_id, row_number() OVER (ORDER BY k) - 1 idx, 50::BIGINT n_factors
        FROM (SELECT DISTINCT {kind}_id k FROM {pairs})"""
        for kind in ("user", "movie")
    )


@query("mf_explicit_keys", _keys_sql("train_ratings"), LAST_RATINGS)
def mf_explicit_keys(v):
    return _keys(explicit(v))


WATCH_PAIRS = """watch_pairs AS (SELECT CAST(user_id AS BIGINT) user_id, CAST(substr(movie_id, 2) AS BIGINT) movie_id FROM w_dur)"""


@query("mf_implicit_keys", _keys_sql("watch_pairs"), P_WATCH, W_AGG, DURATION, WATCH_PAIRS)
def mf_implicit_keys(v):
    return _keys(implicit(v))


@query("mf_implicit")
def mf_implicit(v):
    return _stored(implicit(v))


@query("mean_embeddings")
def mean_embeddings(v):
    exp, imp = explicit(v), implicit(v)
    return factors.mean_embeddings(
        {"exp_user": exp.users, "imp_user": imp.users, "exp_movie": exp.movies, "imp_movie": imp.movies}
    )


@query("recommend_factors")
def recommend_factors(v):
    return recommend.recommend_with_factors(explicit(v), N)


@query(
    "recommend_factors_ranks",
    """SELECT user_id, 20::BIGINT n, 20::BIGINT n_movies, 210::BIGINT rank_sum FROM (SELECT DISTINCT user_id FROM train_ratings)""",
    LAST_RATINGS,
)
def recommend_factors_ranks(v):
    """Every user of the factors has a list of N different movies with ranks 1 to N."""
    return _list_shape(recommend.recommend_with_factors(explicit(v), N))


def _list_shape(lists: DataFrame) -> DataFrame:
    return lists.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("movie_id").alias("n_movies"), F.sum("rank").cast("bigint").alias("rank_sum")
    )


FLAGS = [f"has_{k}" for k in ("exp_user", "exp_movie", "imp_user", "imp_movie")]


@query(
    "feature_embedding_flags",
    """SELECT user_id, movie_id, rating, CAST(user_id IN (SELECT user_id FROM train_ratings) AS INT) has_exp_user,
       CAST(movie_id IN (SELECT movie_id FROM train_ratings) AS INT) has_exp_movie,
       CAST(user_id IN (SELECT user_id FROM watch_pairs) AS INT) has_imp_user,
       CAST(movie_id IN (SELECT movie_id FROM watch_pairs) AS INT) has_imp_movie FROM v_rating_big""",
    LAST_RATINGS, P_WATCH, W_AGG, DURATION, WATCH_PAIRS,
)
def feature_embedding_flags(v):
    return feature_embeddings(v).select("user_id", "movie_id", "rating", *FLAGS)


@query("feature_embeddings")
def feature_embeddings(v):
    exp, imp = explicit(v), implicit(v)
    rows = feature_rows(
        v, factors={"exp_user": exp.users, "exp_movie": exp.movies, "imp_user": imp.users, "imp_movie": imp.movies}
    )
    flags = FLAGS
    return rows.select("user_id", "movie_id", "rating", "exp_user", "exp_movie", "imp_user", "imp_movie", *flags)


def training_rows(v: Views) -> DataFrame:
    """Features of the newest ratings of all users outside the holdout."""
    return once(v, "rows", lambda: materialise(feature_rows(v, training_ratings(v), rebalance=True), "training"))


def rating_model_of(v: Views):
    """The rating model at its full size, and its test metrics."""
    return once(v, "rating", lambda: models.train_rating_model(training_rows(v)))


@query("feature_vector")
def feature_vector(v):
    rows = models.model_input(training_rows(v))
    fitted = Pipeline(stages=models.preprocessor(rows)).fit(rows)
    return fitted.transform(rows).select("user_id", "movie_id", F.col("features").cast("string").alias("features"))


@query("rating_model")
def rating_model(v):
    return rating_model_of(v)[1]


@query(
    "rating_model_sizes",
    f"""SELECT count(*) FILTER (NOT test) train_samples, count(*) FILTER (test) test_samples, true AS beats_mean FROM (
        SELECT substr(md5(concat('42:', CAST(user_id AS VARCHAR), ':', CAST(movie_id AS VARCHAR))), 1, 8) < '{S.share_limit(0.1)}' test
        FROM train_ratings)""",
    LAST_RATINGS,
)
def rating_model_sizes(v):
    """The rows it trained and tested on, and whether it is better than the mean by more than noise."""
    return rating_model_of(v)[1].select("train_samples", "test_samples", (F.col("r2") > -0.01).alias("beats_mean"))


def searched(v: Views, seed: int) -> tuple[DataFrame, float]:
    """The random search over CANDIDATES settings on all training rows, and the seconds it took."""
    rows = training_rows(v)
    started = time.perf_counter()
    return models.tune(rows, models.sampled_params(models.LIGHT_SEARCH, CANDIDATES, seed)), time.perf_counter() - started


@query("tune_search")
def tune_search(v):
    return once(v, "search", lambda: searched(v, 42))[0]


@query("tune_search_shape", "SELECT CAST(range AS INT) candidate, 5 n_params, true valid FROM range(10)")
def tune_search_shape(v):
    """Every candidate was judged on all its parameters, and the best is the one of least error."""
    found = once(v, "search", lambda: searched(v, 42))[0]
    least = found.agg(F.min("cv_rmse")).scalar()
    valid = (F.col("cv_rmse") > 0) & (~F.col("best") | (F.col("cv_rmse") == least))
    return found.select("candidate", F.size("params").alias("n_params"), valid.alias("valid"))


def watched_time(v: Views) -> DataFrame:
    watched = v.v_watch.select("user_id", F.col("movie_id").cast("bigint").alias("movie_id"), F.col("minute_no").alias("watch_time"))
    return materialise(watched, "watched", rebalance=True)


@query("tune_latest")
def tune_latest(v):
    """The parameters a training run would use after a search was logged."""
    results, seconds = once(v, "search", lambda: searched(v, 42))
    path = scratch_path(v.spark, "tuning-log")
    sinks.append_table(models.tuning_record(v.spark, results, seconds, 2), path, schemas.TUNING_RESULTS)
    chosen = models.latest_params(v.spark.read.schema(schemas.TUNING_RESULTS).parquet(path))
    return v.spark.createDataFrame(sorted(chosen.items()), "parameter STRING, value DOUBLE")


@query("tune_latest_keys", "SELECT unnest(['colsample_bytree', 'learning_rate', 'max_depth', 'n_estimators', 'subsample']) parameter, true in_range")
def tune_latest_keys(v):
    """The parameters of the logged search, each from its range."""
    ranges = {k: (float(min(r)), float(max(r))) for k, r in models.LIGHT_SEARCH.items()}
    known = v.spark.createDataFrame([(k, *r) for k, r in ranges.items()], "parameter STRING, low DOUBLE, high DOUBLE")
    return tune_latest(v).join(known, "parameter").select("parameter", F.col("value").between(F.col("low"), F.col("high")).alias("in_range"))


WATCH_SPLIT = f"""watch_split AS (SELECT minute_no,
    substr(md5(concat('42:', CAST(user_id AS VARCHAR), ':', CAST(movie_id AS VARCHAR))), 1, 8) < '{S.share_limit(0.2)}' test FROM v_watch)"""


@query(
    "watched_rows",
    """SELECT CASE WHEN test THEN 'test' ELSE 'train' END split, count(*) n, CAST(count(*) FILTER (minute_no > 30) AS BIGINT) n_long,
       round(sum((minute_no - lo) / CAST(hi - lo AS DOUBLE)), 4) scaled
       FROM watch_split, (SELECT min(minute_no) lo, max(minute_no) hi FROM watch_split WHERE NOT test) GROUP BY 1""",
    WATCH_SPLIT,
)
def watched_rows(v):
    """What the watch-time and long-watch models train and test on."""
    rows = models.watched_rows(watched_time(v))
    return rows.groupBy("split").agg(
        F.count(F.lit(1)).alias("n"), F.sum("label").cast("bigint").alias("n_long"), F.round(F.sum("scaled"), 4).alias("scaled")
    )


@query("watchtime_model")
def watchtime_model(v):
    return models.watchtime_model(watched_time(v))[1]


@query("longwatch_model")
def longwatch_model(v):
    return models.longwatch_model(watched_time(v))[1]


def stored_model(v: Views) -> str:
    def build() -> str:
        path = scratch_path(v.spark, "model")
        models.save_model(rating_model_of(v)[0], path)
        return path

    return once(v, "stored", build)


def evaluation_of(v: Views, path: str) -> DataFrame:
    """Figures of a stored model on the ratings of the holdout users."""
    held = last_ratings(v).join(v.v_holdout, "user_id", "left_semi")
    rows = materialise(feature_rows(v, held), "holdout")
    return models.evaluate(models.load_model(path), rows, [c for c in rows.columns if c != "rating"])


def evaluated(v: Views) -> DataFrame:
    """Evaluate the stored model on the holdout users, and record it in the registries."""
    path = stored_model(v)
    result = evaluation_of(v, path)
    folder = scratch_path(v.spark, "registry")
    trained = registry.register_candidate(
        v.spark, folder,
        v.spark.createDataFrame([("ratings", v.folder)], "data_source STRING, file_path STRING"),
        result, path,
    )
    version = trained.select("model_version").scalar()
    event = result.select(
        "*", version.alias("model_version"), F.lit("offline").alias("eval_type"), F.lit(path).alias("model_path"),
        F.lit(path).alias("preproc_path"), F.lit(folder).alias("eval_data_path"),
    )
    stored = v.spark.read.parquet(registry.append_registry(event, folder, "evaluations"))
    return stored.join(trained.select("model_version", "artifact_path"), "model_version")


@query("offline_eval")
def offline_eval(v):
    return evaluated(v).drop("metrics_json", "eval_data_path", "timestamp", "eval_id", "model_version", "model_path", "preproc_path", "artifact_path")


@query(
    "offline_eval_sizes",
    """SELECT count(*) test_set_size, true hashed FROM last_ratings WHERE user_id IN (SELECT user_id FROM v_holdout)""",
    LAST_RATINGS,
)
def offline_eval_sizes(v):
    """The holdout rows it judged, and whether the candidate was registered under its artifact's hash."""
    return evaluated(v).select("test_set_size", F.col("artifact_path").rlike("sha256=[0-9a-f]{64}").alias("hashed"))


@query("model_roundtrip")
def model_roundtrip(v):
    scored = models.load_model(stored_model(v)).transform(models.model_input(training_rows(v)))
    return scored.select("user_id", "movie_id", "rating", "prediction")


@query("model_roundtrip_rows", "SELECT user_id, movie_id, rating, true scored FROM train_ratings", LAST_RATINGS)
def model_roundtrip_rows(v):
    """Every training row has a finite score from the model that was stored and loaded."""
    finite = F.col("prediction").isNotNull() & ~F.isnan("prediction")
    return model_roundtrip(v).select("user_id", "movie_id", "rating", finite.alias("scored"))


def movie_side(v: Views) -> DataFrame:
    """Model features of every movie, filled as in training."""
    movies = features.token_vectors(features.movie_attributes(v.v_movies), index_of(v))
    median = features.weighted_median(v.v_rating_big, movies, "movie_id", "release_year")
    filled = features.clip_outliers(
        features.fill_constants(movies).withColumn("release_year", F.coalesce(F.col("release_year").cast("double"), median)), LAST_YEAR
    )
    return filled.select("movie_id", *features.MOVIE_NUMBERS, "release_year", "original_language", "tokens")


def profiles_of(v: Views) -> DataFrame:
    known = features.cold_start_profiles(v.v_users, v.v_users)
    return known.select(
        "user_id",
        F.coalesce(S.age_bin(F.col("age")), F.lit("unknown")).alias("age_bin"),
        F.coalesce("occupation", F.lit("unknown")).alias("occupation"),
        F.coalesce("gender", F.lit("unknown")).alias("gender"),
    )


def lists_by_model(v: Views, rows: DataFrame, side: DataFrame) -> DataFrame:
    model, _ = models.train_rating_model(rows)
    side = materialise(models.model_input(side), "movie-side")
    return recommend.recommend_with_model(model, side, materialise(profiles_of(v), "profiles"), PROFILE, N)


def batch_lists(v: Views) -> DataFrame:
    return once(v, "lists", lambda: materialise(lists_by_model(v, training_rows(v).drop("age"), movie_side(v)), "lists"))


@query("recommend_batch")
def recommend_batch(v):
    """Rating model on user profile and movie features; every movie for every user."""
    return batch_lists(v)


@query("recommend_batch_ranks", "SELECT user_id, 20::BIGINT n, 20::BIGINT n_movies, 210::BIGINT rank_sum FROM v_users")
def recommend_batch_ranks(v):
    return _list_shape(batch_lists(v))


@query("recommend_embedded")
def recommend_embedded(v):
    """The same with factors: a movie brings its own, every user the mean of all users."""
    exp = explicit(v)
    rows = feature_rows(v, training_ratings(v), factors={"exp_user": exp.users, "exp_movie": exp.movies}, rebalance=True)
    side = features.attach_factors(movie_side(v), exp.movies, "exp_movie").withColumns(
        {"exp_user": features.mean_vector(exp.users, "features"), "has_exp_user": F.lit(0)}
    )
    return lists_by_model(v, materialise(rows.drop("age"), "training"), side)


@query("ranking_model")
def ranking_model(v):
    """The boosted-tree ranker judged like the other rankers."""
    truth = v.v_inter.select("user_id", F.col("item_id").alias("movie_id"))
    return metrics.ranking_metrics(batch_lists(v), truth, N)


@query(
    "retrain_run",
    """SELECT NOT (n.users - o.users < 50 AND n.interactions - o.interactions < 100) retrain, 'reject' decision, 0::BIGINT moved, true repeated
       FROM now_stats n, old_stats o""",
    REFRESH,
)
def retrain_run(v):
    """From the gate to the promotion, taken up twice; ratings without a pattern cannot beat the incumbents."""
    folder = scratch_path(v.spark, "retrain")
    states = refresh.retrain_state(stats_of(v, EARLIER[-1]), F.lit("2024-01-02 00:00:00").cast("timestamp"))
    incumbents = metrics.regression_metrics(v.v_scored, "model").filter("model <> 'candidate'")
    stages = v.spark.createDataFrame([("v1", "old-v1"), ("v2", "old-v2")], "stage STRING, model_version STRING")
    steps = (folder, stats_of(v), states, lambda: stored_model(v), lambda path: evaluation_of(v, path), incumbents, stages)
    first, again = (retrain.retrain_run(*steps) for _ in range(2))
    same = first["model"].first() == again["model"].first() and first["state"].first() == again["state"].first()
    moved = again["stages"].agg(F.count(F.lit(1)).alias("moved")).scalar()
    return again["gate"].select("retrain", again["decision"].select("decision").scalar().alias("decision"), moved.alias("moved"), F.lit(same).alias("repeated"))
