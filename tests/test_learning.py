import random
import threading

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.regression import GBTRegressor
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import functions as F

from marquee.operators import bounds, factors, features, metrics, models, recommend
from marquee.plans import learning


@pytest.fixture(scope="module")
def planted(spark):
    """Ratings made from two planted factors and offsets."""
    rng = np.random.default_rng(1)
    users, movies = rng.normal(size=(60, 2)), rng.normal(size=(40, 2))
    data = [
        (u * 7 + 1000, m * 3, float(3 + 0.4 * users[u, 0] + users[u] @ movies[m]))
        for u in range(60)
        for m in range(40)
        if rng.random() < 0.6
    ]
    return spark.createDataFrame(data, "user_id BIGINT, movie_id BIGINT, rating DOUBLE").cache()


@pytest.fixture(scope="module")
def explicit(planted):
    return factors.train_explicit(planted, rank=4, iterations=8)


def test_shuffles_of_earlier_iterations_can_go(spark, monkeypatch):
    made = []

    class Kept(factors.ALS):
        def fit(self, *args):
            made.append(self.getCheckpointInterval())
            return super().fit(*args)

    monkeypatch.setattr(factors, "ALS", Kept)
    rows = spark.createDataFrame([(u, m, (u * m) % 5 + 1) for u in range(6) for m in range(5)], "user_id BIGINT, movie_id BIGINT, rating INT")
    factors.train_explicit(rows, rank=2, iterations=2)
    factors.train_implicit(rows.select("user_id", "movie_id", (F.col("rating") / 5).alias("score")), rank=2, iterations=2)
    assert made == [1, 1] and spark.sparkContext.getCheckpointDir()


def test_factor_blocks_follow_cores_rows_and_the_other_side(planted, monkeypatch):
    """Small tables keep the trainer's ten; others fill the cores, and a task holds no more factors than the bound."""
    made = []

    class Kept(factors.ALS):
        def fit(self, *args):
            made.append((self.getNumUserBlocks(), self.getNumItemBlocks()))
            return super().fit(*args)

    monkeypatch.setattr(factors, "ALS", Kept)
    factors.train_explicit(planted, rank=2, iterations=1)
    rows, cores = planted.count(), planted.sparkSession.sparkContext.defaultParallelism
    monkeypatch.setattr(factors, "FEW_ROWS", rows - 1)
    factors.train_explicit(planted, rank=2, iterations=1)
    monkeypatch.setattr(factors, "MOST_FACTORS", 50)  # less than the users, more than the movies
    found = factors.train_explicit(planted, rank=2, iterations=1)
    whole = cores * max(1, 10 // cores)
    assert made[:2] == [(10, 10), (whole, whole)] and made[2][0] == whole
    assert made[2][1] >= rows / 50 and made[2][1] % cores == 0
    assert found.users.count() == 60 and found.movies.count() == 40


def test_indices_do_not_compute_the_residuals_again(planted, monkeypatch):
    read = []
    index = factors.dense_index
    monkeypatch.setattr(factors, "dense_index", lambda df, *a: (read.append(set(df.columns)), index(df, *a))[1])
    factors.train_explicit(planted, rank=2, iterations=1)
    assert read == [{"user_id", "movie_id", "rating"}] * 2


def test_explicit_factors_beat_the_mean(planted, explicit):
    mean, movie_offsets, user_offsets = factors.rating_baseline(planted)
    u = explicit.users.withColumnRenamed("features", "p")
    m = explicit.movies.withColumnRenamed("features", "q")
    dot = F.aggregate(F.zip_with("p", "q", lambda a, b: (a * b).cast("double")), F.lit(0.0), lambda s, x: s + x)
    scored = (
        planted.join(u, "user_id").join(m, "movie_id").join(movie_offsets, "movie_id").join(user_offsets, "user_id")
        .select(F.col("rating").alias("label"), (mean + F.col("movie_offset") + F.col("user_offset") + dot).alias("prediction"))
    )
    assert metrics.regression_metrics(scored).first()["r2"] > 0.8
    assert explicit.users.count() == 60 and explicit.movies.count() == 40
    assert explicit.ids.groupBy("kind").agg(F.max("idx")).count() == 2


def test_factor_search_is_exact(explicit):
    got = recommend.recommend_with_factors(explicit, 5).collect()
    users = {r["user_id"]: np.array(r["features"], dtype=np.float32) for r in explicit.users.collect()}
    movies = {r["movie_id"]: np.array(r["features"], dtype=np.float32) for r in explicit.movies.collect()}
    assert len(got) == 5 * len(users)
    for user in list(users)[:10]:
        best = sorted((float(users[user] @ movies[m]) for m in movies), reverse=True)[:5]
        mine = sorted((r["score"] for r in got if r["user_id"] == user), reverse=True)
        assert mine == pytest.approx(best, abs=1e-4)


def test_implicit_factors_cover_all_keys(spark):
    rng = random.Random(2)
    data = [(u, m, rng.random()) for u in range(12) for m in range(9) if rng.random() < 0.5]
    found = factors.train_implicit(spark.createDataFrame(data, "user_id BIGINT, movie_id BIGINT, score DOUBLE"), rank=3, iterations=2)
    assert {r["user_id"] for r in found.users.collect()} == {d[0] for d in data}
    assert all(len(r["features"]) == 3 for r in found.movies.collect())
    wide = factors.wide(found.users, "imp_f", 3)
    assert wide.columns == ["user_id", "imp_f1", "imp_f2", "imp_f3"]


@pytest.fixture(scope="module")
def feature_rows(spark):
    rng = random.Random(3)
    data = []
    for i in range(800):
        band, kind = rng.choice(["0-18", "19-25", None]), rng.choice(["a", "b"])
        runtime = rng.uniform(60, 180)
        rating = 3 + (1 if kind == "a" else -1) + runtime / 180 + rng.gauss(0, 0.1)
        data.append((i, rng.randrange(50), band, "x", kind, "en", runtime, rating))
    schema = "user_id BIGINT, movie_id BIGINT, age_bin STRING, occupation STRING, gender STRING, original_language STRING, runtime DOUBLE, rating DOUBLE"
    return spark.createDataFrame(data, schema).cache()


PARAMS = {"model__n_estimators": 10, "model__max_depth": 3, "model__learning_rate": 0.3}


def test_rating_model_learns_and_survives_storage(feature_rows, tmp_path):
    model, report = models.train_rating_model(feature_rows, PARAMS)
    row = report.first()
    assert row["r2"] > 0.8 and row["train_samples"] + row["test_samples"] == 800
    models.save_model(model, str(tmp_path / "m"))
    again = models.load_model(str(tmp_path / "m"))
    strange = models.model_input(feature_rows.limit(20)).withColumn("gender", F.lit("never seen"))
    first, second = (m.transform(strange).orderBy("user_id").select("prediction").collect() for m in (model, again))
    assert first == second
    # Columns the model expects but the data lacks count as 0.
    expected = [c for c in feature_rows.columns if c != "rating"]
    scores = models.evaluate(model, feature_rows.drop("runtime"), expected).first()
    assert scores["test_set_size"] == 800 and scores["rmse"] > row["rmse"]


def test_parameters_reach_the_trees():
    trees = models.tree_regressor("rating", {"model__n_estimators": 7, "max_depth": 4, "colsample_bytree": 1.0})
    assert trees.getMaxIter() == 7 and trees.getMaxDepth() == 4 and trees.getFeatureSubsetStrategy() == "all"


def test_watch_models_train_in_many_tasks(spark, monkeypatch):
    """Many narrow rows fill one file, but are not one task's work."""
    watched = spark.range(900).select(
        (F.col("id") % 30).alias("user_id"), F.floor(F.col("id") / 30).alias("movie_id"), (F.col("id") % 30 * 3).alias("watch_time")
    ).coalesce(1)
    tasks = []
    for learner in (GBTRegressor, LogisticRegression):
        fit = learner._fit
        monkeypatch.setattr(learner, "_fit", lambda self, df, fit=fit: (tasks.append(df.rdd.getNumPartitions()), fit(self, df))[1])
    whole = [models.watchtime_model(watched, trees=3)[1].first(), models.longwatch_model(watched)[1].first()]
    monkeypatch.setattr(models, "ROWS_PER_TASK", 200)
    parts = [models.watchtime_model(watched, trees=3)[1].first(), models.longwatch_model(watched)[1].first()]
    assert tasks[2:] == [min(5, spark.sparkContext.defaultParallelism)] * 2
    for a, b in zip(whole, parts):
        assert tuple(a) == pytest.approx(tuple(b), rel=1e-6)


def test_search_ranks_candidates(spark, feature_rows):
    results = models.tune(feature_rows, [{"n_estimators": 1, "max_depth": 1}, {"n_estimators": 5, "max_depth": 3}], folds=2)
    found = results.orderBy("cv_rmse").collect()
    assert [r["candidate"] for r in found if r["best"]] == [found[0]["candidate"]] == [1]
    record = models.tuning_record(spark, results, 1.5, 2)
    assert models.latest_params(record)["max_depth"] == 3.0


def test_search_shares_the_trees_of_candidates(feature_rows, monkeypatch):
    """Candidates that differ in their number of trees are trained as one, with the errors of a plain cross-validation."""
    candidates = [{"n_estimators": n, "max_depth": 2, "subsample": s, "colsample_bytree": 1.0} for n, s in ((2, 1.0), (6, 1.0), (4, 1.0), (3, 0.8))]
    rows = models.hash_split(models.model_input(feature_rows), 0.1).filter("split = 'train'")
    prepared = Pipeline(stages=models.preprocessor(rows)).fit(rows).transform(rows).select("features", "rating").cache()
    plain = GBTRegressor(labelCol="rating", maxBins=128, seed=42, stepSize=0.1, maxDepth=2)
    grid = [{plain.maxIter: c["n_estimators"], plain.subsamplingRate: c["subsample"]} for c in candidates]
    judged = CrossValidator(estimator=plain, estimatorParamMaps=grid, evaluator=RegressionEvaluator(labelCol="rating"), numFolds=2, seed=42)
    expected = judged.fit(prepared).avgMetrics
    fits = []
    fit = GBTRegressor._fit
    monkeypatch.setattr(GBTRegressor, "_fit", lambda self, df: (fits.append(self.getMaxIter()), fit(self, df))[1])
    found = models.tune(feature_rows, candidates, folds=2).orderBy("candidate").collect()
    assert [r["cv_rmse"] for r in found] == pytest.approx(expected, rel=1e-9)
    assert sorted(fits) == [3, 3, 6, 6]


def test_search_of_many_rows_fits_one_after_another(feature_rows, monkeypatch):
    """Fits side by side hold their own copies of the rows; the errors are the same either way."""
    candidates = [{"n_estimators": 2, "max_depth": 1, "subsample": s} for s in (0.8, 1.0)]
    running, most, lock = [0], [0], threading.Lock()
    fit = GBTRegressor._fit

    def counted(self, df):
        with lock:
            running[0] += 1
            most[0] = max(most[0], running[0])
        try:
            return fit(self, df)
        finally:
            with lock:
                running[0] -= 1

    monkeypatch.setattr(GBTRegressor, "_fit", counted)
    errors = []
    for rows in (models.ROWS_SIDE_BY_SIDE, 800):
        monkeypatch.setattr(models, "ROWS_SIDE_BY_SIDE", rows)
        most[0] = 0
        errors.append(models.tune(feature_rows, candidates).orderBy("candidate").collect())
    assert most[0] == 1 and errors[0] == errors[1]


def test_search_reads_all_training_rows(feature_rows, monkeypatch):
    got = []
    monkeypatch.setattr(learning, "training_rows", lambda v: feature_rows)
    monkeypatch.setattr(models, "tune", lambda rows, candidates: got.append((rows.count(), len(candidates))))
    learning.searched(None, 42)
    assert got == [(800, learning.CANDIDATES)]


def test_sampled_params_repeat():
    first = models.sampled_params(models.FULL_SEARCH, 5)
    assert first == models.sampled_params(models.FULL_SEARCH, 5) and len(first) == 5
    assert all(3 <= p["max_depth"] < 8 for p in first)


@pytest.fixture(scope="module")
def list_model(feature_rows):
    return models.train_rating_model(feature_rows.drop("original_language"), PARAMS)[0]


PROFILE = ["age_bin", "occupation", "gender"]


def catalogue(spark, n):
    movies = spark.createDataFrame([(m, 60.0 + (37 * m) % 150) for m in range(n)], "movie_id BIGINT, runtime DOUBLE")
    users = spark.createDataFrame(
        [(u, ["0-18", "19-25"][u % 2], "x", ["a", "b"][u // 2 % 2]) for u in range(8)], "user_id BIGINT, age_bin STRING, occupation STRING, gender STRING"
    )
    return movies, users


def brute_lists(model, movies, users, n):
    brute = model.transform(users.join(movies)).select("user_id", "movie_id", "prediction").collect()
    by_user = {}
    for user, movie, prediction in sorted(((r["user_id"], r["movie_id"], r["prediction"]) for r in brute), key=lambda r: (r[0], -r[2], r[1])):
        by_user.setdefault(user, []).append(movie)
    return {user: found[:n] for user, found in by_user.items()}


@pytest.mark.parametrize("block", [4, 256])
def test_model_lists_consider_every_movie(spark, list_model, monkeypatch, block):
    movies, users = catalogue(spark, 70)
    monkeypatch.setattr(recommend, "FIRST_BLOCK", block)
    got = recommend.recommend_with_model(list_model, movies, users, PROFILE, n=3).orderBy("user_id", "rank").collect()
    mine = {u: [r["movie_id"] for r in got if r["user_id"] == u] for u in range(8)}
    assert mine == brute_lists(list_model, movies, users, 3)
    assert recommend.candidate_rows(movies, users, PROFILE).count() == 70 * 4


def test_model_lists_of_few_movies_and_none(spark, list_model):
    movies, users = catalogue(spark, 2)
    got = recommend.recommend_with_model(list_model, movies, users, PROFILE, n=5)
    assert got.groupBy("user_id").count().filter("count = 2").count() == 8
    assert recommend.recommend_with_model(list_model, movies.limit(0), users, PROFILE, n=5).count() == 0


def test_bounds_hold_and_spare_movies(spark, list_model, monkeypatch):
    movies, users = catalogue(spark, 400)
    trees = bounds.Trees.of(list_model, movies.limit(1).join(users.limit(1)))
    most = {r["movie_id"]: r["bound"] for r in bounds.movie_bounds(trees, movies).collect()}
    best = list_model.transform(users.join(movies)).groupBy("movie_id").agg(F.max("prediction").alias("p")).collect()
    assert all(r["p"] <= most[r["movie_id"]] + bounds.ROUNDING for r in best)
    seen = []
    transform = type(list_model).transform
    monkeypatch.setattr(type(list_model), "transform", lambda self, df, *a: (seen.append(df), transform(self, df, *a))[1])
    monkeypatch.setattr(recommend, "FIRST_BLOCK", 20)
    recommend.recommend_with_model(list_model, movies, users, PROFILE, n=3).collect()
    assert sum(df.count() for df in seen) < 400 * 4  # less than the product of movies and profiles


def test_bounds_of_sparse_tokens(spark):
    rng = random.Random(8)
    rows = []
    for i in range(600):
        words = sorted(rng.sample(range(40), 3))
        rows.append((i, i % 60, "0-18", "x", rng.choice(["a", "b"]), words, 3.0 + (7 in words) - (9 in words) + rng.gauss(0, 0.05)))
    schema = "user_id BIGINT, movie_id BIGINT, age_bin STRING, occupation STRING, gender STRING, words ARRAY<BIGINT>, rating DOUBLE"
    table = spark.createDataFrame(rows, schema).withColumn("tokens", features.sparse_ones(F.col("words"), 40)).drop("words")
    model, _ = models.train_rating_model(table, PARAMS)
    movies = table.dropDuplicates(["movie_id"]).select("movie_id", "tokens")
    users = table.select("user_id", *PROFILE).limit(6)
    got = recommend.recommend_with_model(model, movies, users, PROFILE, n=4).orderBy("user_id", "rank").collect()
    expected = brute_lists(model, movies, users, 4)
    assert {u: [r["movie_id"] for r in got if r["user_id"] == u] for u in expected} == expected


def test_fifty_thousand_tokens(spark):
    """Vocabulary, vectors, feature rows and a model, with no column per token."""
    movies = spark.range(2000).select(
        F.col("id").alias("movie_id"), F.lit("t").alias("title"), F.lit("2000-01-01").alias("release_date"), F.lit(90).alias("runtime"),
        F.lit(1.0).alias("popularity"), F.lit(5.0).alias("vote_average"), F.lit(3).alias("vote_count"),
        F.concat_ws(",", F.transform(F.sequence(F.lit(0), F.lit(24)), lambda k: F.concat(F.lit("g"), (F.col("id") * 25 + k).cast("string")))).alias("genres"),
        F.lit("US").alias("production_countries"), F.lit("English").alias("spoken_languages"), F.lit("en").alias("original_language"),
    )
    users = spark.createDataFrame([(u, 20 + u, "x", "M") for u in range(5)], "user_id BIGINT, age INT, occupation STRING, gender STRING")
    ratings = spark.range(60).select((F.col("id") % 5).alias("user_id"), (F.col("id") * 30).alias("movie_id"), (1 + F.col("id") % 5).cast("double").alias("rating"))
    kinds = {k: f"{k}_tokens" for k in features.MULTI_HOT}
    index = features.token_index(features.vocabulary(features.movie_attributes(movies), kinds))
    assert index.count() == 50_002
    rows = features.feature_table(ratings, users, movies, 2026, index=index)
    first = rows.orderBy("movie_id").first()["tokens"]
    assert first.size == 50_002 and len(first.indices) == 27
    model, report = models.train_rating_model(rows, {"n_estimators": 1, "max_depth": 1, "colsample_bytree": 1.0, "subsample": 1.0})
    assert model.stages[-1].numFeatures > 50_000 and report.first()["train_samples"] + report.first()["test_samples"] == 60


def test_genre_lists_against_brute_force(spark):
    rng = random.Random(6)
    tokens = ["a", "b", "c", "d"]
    movies = [(m, float(rng.randrange(20)), ",".join(rng.sample(tokens, rng.randrange(1, 4)))) for m in range(60)]
    liked = [(u, rng.randrange(60)) for u in range(15) for _ in range(rng.randrange(1, 4))]
    movie_df = spark.createDataFrame(movies, "movie_id BIGINT, popularity DOUBLE, genres STRING")
    profiles = recommend.genre_profiles(spark.createDataFrame(liked, "user_id BIGINT, movie_id BIGINT"), movie_df)
    got = recommend.recommend_by_genre(profiles, movie_df, 4).orderBy("user_id", "rank").collect()
    genre = {m: set(g.split(",")) for m, _, g in movies}
    for user in range(15):
        taste = set().union(*[genre[m] for u, m in liked if u == user])
        scored = sorted((-(p * len(taste & genre[m])), m) for m, p, _ in movies if taste & genre[m])[:4]
        assert [r["movie_id"] for r in got if r["user_id"] == user] == [m for _, m in scored]


def test_fallback_fills_only_users_without_lists(spark, rows):
    users = spark.createDataFrame([(1,), (2,)], "user_id BIGINT")
    recs = spark.createDataFrame([(1, 5, 1), (9, 5, 1)], "user_id BIGINT, movie_id BIGINT, rank INT")
    popular = spark.createDataFrame([(7, 1), (8, 2), (6, 3)], "movie_id BIGINT, rank INT")
    assert rows(recommend.recommend_fallback(users, recs, popular, 2)) == [(1, 5, 1, False), (2, 7, 1, True), (2, 8, 2, True)]


def test_served_text(spark, rows):
    recs = spark.createDataFrame([(1, 11, 2), (1, 12, 1), (2, 9, 1)], "user_id BIGINT, movie_id BIGINT, rank INT")
    assert rows(recommend.served_text(recs)) == [(1, "12, 11"), (2, "9")]


def test_similarity_lists_skip_seen_movies(spark, rows):
    similar = spark.createDataFrame([(1, 2, 0.9), (1, 3, 0.5), (4, 3, 0.6), (4, 1, 0.8)], "i BIGINT, j BIGINT, cosine DOUBLE")
    seen = spark.createDataFrame([(7, 1), (7, 4), (7, 1), (8, 1)], "user_id BIGINT, movie_id BIGINT")
    got = recommend.recommend_by_similarity(similar, seen, 1).select("user_id", "movie_id", "rank")
    assert rows(got) == [(7, 3, 1), (8, 2, 1)]


def test_rating_model_takes_factor_arrays(spark, feature_rows, explicit):
    from marquee.operators.features import attach_factors

    known = [r["user_id"] for r in explicit.users.select("user_id").orderBy("user_id").limit(5).collect()]
    moved = feature_rows.withColumn("user_id", F.when(F.col("user_id") < 400, F.lit(known[0])).otherwise(F.lit(-1)))
    rows = attach_factors(moved, explicit.users, "exp_user")
    model, report = models.train_rating_model(rows, PARAMS)
    plain, _ = models.train_rating_model(moved, {"n_estimators": 1})
    assert model.stages[-1].numFeatures == plain.stages[-1].numFeatures + 4 + 1
    assert report.first()["rmse"] < 1
