"""Rating, watch-time and long-watch models with their search, evaluation and storage."""

from __future__ import annotations

import math
import random
import time
from collections.abc import Sequence
from multiprocessing.pool import ThreadPool

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.util import inheritable_thread_target

from marquee import schemas
from marquee.operators import metrics
from marquee.operators.factors import dense_index
from marquee.operators.features import align_schema, binarize, hash_split, minmax_scale
from marquee.operators.summary import report_row
from marquee.session import ensure_checkpoint_dir
from marquee.sources.sinks import conform

CATEGORICAL = ["age_bin", "occupation", "gender", "original_language"]
DEFAULT_PARAMS = {"n_estimators": 100, "learning_rate": 0.1, "max_depth": 3, "subsample": 0.8, "colsample_bytree": 0.8}
# The ranges of the random search, light and full.
LIGHT_SEARCH = {
    "n_estimators": range(50, 200), "max_depth": [2], "learning_rate": [0.05, 0.1],
    "subsample": [0.8, 1.0], "colsample_bytree": [0.8, 1.0],
}
FULL_SEARCH = {
    "n_estimators": range(100, 400), "max_depth": range(3, 8), "learning_rate": [0.03, 0.05, 0.1],
    "subsample": [0.8, 1.0], "colsample_bytree": [0.8, 1.0],
}
#: Rows of the watch models that are worth a task of their own while cores are idle, and rows a task holds at most.
ROWS_PER_TASK, MOST_PER_TASK = 100_000, 2_000_000
#: Rows that all fits of a search side by side have at most: each holds its own binned copy, and these must not crowd each other out.
ROWS_SIDE_BY_SIDE = 6_000_000
#: What tells trees apart, beside their number.
SHAPE = ("stepSize", "maxDepth", "subsamplingRate", "featureSubsetStrategy")


def model_input(features: DataFrame) -> DataFrame:
    """Feature rows ready for the preprocessor: no NULL category or number, arrays as vectors."""
    changed = {}
    for field in features.schema.fields:
        if isinstance(field.dataType, T.ArrayType):
            changed[field.name] = array_to_vector(F.col(field.name))
        elif field.name in CATEGORICAL:
            changed[field.name] = F.coalesce(F.col(field.name), F.lit("unknown"))
    numeric = [f.name for f in features.schema.fields if isinstance(f.dataType, T.NumericType)]
    return features.withColumns(changed).fillna(0, numeric)


def preprocessor(features: DataFrame, target: str = "rating", ignore: Sequence[str] = ("user_id", "movie_id")) -> list:
    """Stages turning feature columns into one vector; an unseen category becomes all zeros."""
    categorical = [c for c in CATEGORICAL if c in features.columns]
    skipped = {target, "split", *ignore, *categorical}
    numeric = [c for c in features.columns if c not in skipped]
    indexed, encoded = [f"{c}_index" for c in categorical], [f"{c}_hot" for c in categorical]
    return [
        StringIndexer(inputCols=categorical, outputCols=indexed, handleInvalid="keep"),
        OneHotEncoder(inputCols=indexed, outputCols=encoded, dropLast=True),
        VectorAssembler(inputCols=encoded + numeric, outputCol="features"),
    ]


def tree_regressor(target: str, params: dict | None = None, seed: int = 42) -> GBTRegressor:
    """Boosted trees on squared error; accepts parameter names with or without a 'model__' prefix."""
    chosen = {**DEFAULT_PARAMS, **{k.removeprefix("model__"): v for k, v in (params or {}).items()}}
    return GBTRegressor(
        labelCol=target,
        featuresCol="features",
        maxIter=int(chosen["n_estimators"]),
        stepSize=float(chosen["learning_rate"]),
        maxDepth=int(chosen["max_depth"]),
        subsamplingRate=float(chosen["subsample"]),
        featureSubsetStrategy=str(float(chosen["colsample_bytree"])) if chosen["colsample_bytree"] < 1 else "all",
        maxBins=128,
        seed=seed,
    )


def train_rating_model(
    features: DataFrame, params: dict | None = None, target: str = "rating", test_share: float = 0.1
) -> tuple[PipelineModel, DataFrame]:
    """Fitted pipeline and one row of test metrics with timings."""
    ensure_checkpoint_dir(features.sparkSession)
    rows = hash_split(model_input(features), test_share)
    train, test = rows.filter("split = 'train'"), rows.filter("split = 'test'")
    started = time.perf_counter()
    model = Pipeline(stages=[*preprocessor(rows, target), tree_regressor(target, params)]).fit(train)
    seconds = time.perf_counter() - started
    results = metrics.regression_metrics(model.transform(test), label=target)
    sizes = rows.agg(F.count_if(F.col("split") == "train").alias("t"), F.count_if(F.col("split") == "test").alias("e"))
    both = sizes.select(F.struct("t", "e")).scalar()
    return model, results.select(
        "rmse",
        "mae",
        "r2",
        F.lit(round(seconds, 2)).alias("training_time_sec"),
        both["t"].alias("train_samples"),
        both["e"].alias("test_samples"),
    )


def sampled_params(search: dict, n: int, seed: int = 42) -> list[dict]:
    """``n`` random settings of the search space."""
    rng = random.Random(seed)
    return [{name: rng.choice(list(values)) for name, values in search.items()} for _ in range(n)]


def tune(
    features: DataFrame,
    candidates: list[dict],
    folds: int = 2,
    target: str = "rating",
    test_share: float = 0.1,
    parallelism: int = 4,
    seed: int = 42,
) -> DataFrame:
    """Cross-validated RMSE of each candidate: (candidate, params, cv_rmse, best)."""
    ensure_checkpoint_dir(features.sparkSession)
    rows = hash_split(model_input(features), test_share).filter("split = 'train'")
    prepared = Pipeline(stages=preprocessor(rows, target)).fit(rows).transform(rows).select("features", target)
    trained: dict[tuple, list[int]] = {}
    for i, params in enumerate(candidates):
        wanted = tree_regressor(target, params, seed)
        trained.setdefault(tuple(wanted.getOrDefault(n) for n in SHAPE), []).append(i)
    sizes = [tree_regressor(target, params, seed).getMaxIter() for params in candidates]
    place = F.floor(F.rand(seed) * folds).alias("fold")  # the folds of CrossValidator
    dealt = prepared.select("*", place).persist()
    errors = [0.0] * len(candidates)

    def run(fold: int, members: list[int]) -> list[tuple[int, float]]:
        """Errors of candidates that differ in their number of trees: the longest one's first trees are the others'."""
        longest = max(members, key=lambda i: sizes[i])
        model = tree_regressor(target, candidates[longest], seed).fit(dealt.filter(F.col("fold") != fold))
        squared = model.evaluateEachIteration(dealt.filter(F.col("fold") == fold), "squared")
        return [(i, math.sqrt(squared[sizes[i] - 1])) for i in members]

    side_by_side = max(1, min(parallelism, ROWS_SIDE_BY_SIDE // max(1, dealt.count())))
    with ThreadPool(processes=side_by_side) as pool:
        groups = sorted(trained.values(), key=lambda members: -max(sizes[i] for i in members))
        work = [(fold, members) for members in groups for fold in range(folds)]
        for found in pool.starmap(inheritable_thread_target(features.sparkSession)(run), work, chunksize=1):
            for i, error in found:
                errors[i] += error
    dealt.unpersist()
    scores = [error / folds for error in errors]
    best = min(range(len(scores)), key=lambda i: scores[i])
    found = [
        (i, {k: float(v) for k, v in params.items()}, float(score), i == best)
        for i, (params, score) in enumerate(zip(candidates, scores))
    ]
    return features.sparkSession.createDataFrame(
        found, "candidate INT, params MAP<STRING, DOUBLE>, cv_rmse DOUBLE, best BOOLEAN"
    )


def latest_params(results: DataFrame) -> dict:
    """Parameters of the newest tuning run, the defaults when there is none."""
    row = results.agg(F.max_by("best_params", "timestamp").alias("p")).first()
    if row is None or row["p"] is None:
        return dict(DEFAULT_PARAMS)
    return {**DEFAULT_PARAMS, **{k.removeprefix("model__"): v for k, v in row["p"].items()}}


def tuning_record(spark: SparkSession, results: DataFrame, seconds: float, folds: int) -> DataFrame:
    """The best candidate in the layout of the tuning log."""
    n = results.agg(F.count(F.lit(1))).scalar()
    record = results.filter("best").select(
        F.current_timestamp().alias("timestamp"),
        F.col("params").alias("best_params"),
        F.col("cv_rmse").alias("best_cv_rmse"),
        F.lit(float(seconds)).alias("tuning_time_sec"),
        F.lit(folds).alias("cv_folds"),
        n.alias("param_grid_size"),
    )
    return conform(record, schemas.TUNING_RESULTS)


def evaluate(model: PipelineModel, features: DataFrame, expected: Sequence[str], target: str = "rating") -> DataFrame:
    """Offline evaluation: align the columns, predict, and report both metric families.

    The time per row covers the whole pass, reading included.
    """
    aligned = align_schema(model_input(features), [*expected, target])
    scored = model.transform(aligned).select(F.col(target).alias("label"), "prediction")
    started = time.perf_counter()
    size = scored.agg(F.count(F.lit(1)).alias("test_set_size"))
    row = report_row(
        features.sparkSession, metrics.regression_metrics(scored), metrics.classification_metrics(scored), size
    ).first()
    seconds = time.perf_counter() - started
    per_row_ms = 1000 * seconds / max(row["test_set_size"], 1)
    return features.sparkSession.createDataFrame(
        [(*row, per_row_ms)],
        "mse DOUBLE, rmse DOUBLE, mae DOUBLE, r2 DOUBLE, precision DOUBLE, recall DOUBLE, f1 DOUBLE, "
        "accuracy DOUBLE, test_set_size BIGINT, inference_time_ms DOUBLE",
    )


def _spread(df: DataFrame, size: int) -> DataFrame:
    """Dealt out evenly over the cores, as far as ``size`` rows need them: narrow rows by the million fill a single file.

    A tree is some twelve short stages, so further tasks cost more than they save.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    tasks = max(min(cores, -(-size // ROWS_PER_TASK)), -(-size // MOST_PER_TASK))
    return df.repartition(tasks) if tasks > 1 else df


def _index_features(watched: DataFrame) -> DataFrame:
    users, movies = dense_index(watched, "user_id", "user_idx"), dense_index(watched, "movie_id", "movie_idx")
    coded = _spread(watched.join(users, "user_id").join(movies, "movie_id"), watched.count())
    return VectorAssembler(inputCols=["user_idx", "movie_idx"], outputCol="features").transform(coded)


def watched_rows(watched: DataFrame, target: str = "watch_time", threshold: float = 30) -> DataFrame:
    """The rows of the two watch models: user, movie, split, target scaled by the training rows, label."""
    rows = hash_split(watched, 0.2)
    scaled = minmax_scale(rows, target, rows.filter("split = 'train'"), "scaled")
    return binarize(scaled, target, threshold)


def watchtime_model(watched: DataFrame, target: str = "watch_time", trees: int = 100, depth: int = 6, rate: float = 0.1):
    """Regressor of watch time scaled to [0, 1] on the two indices: (model, test metrics)."""
    scaled = watched_rows(_index_features(watched), target)
    learner = tree_regressor("scaled", dict(n_estimators=trees, max_depth=depth, learning_rate=rate, subsample=1.0, colsample_bytree=1.0))
    model = learner.fit(scaled.filter("split = 'train'"))
    return model, metrics.regression_metrics(model.transform(scaled.filter("split = 'test'")), label="scaled")


def longwatch_model(watched: DataFrame, target: str = "watch_time", threshold: float = 30):
    """Classifier of watches longer than ``threshold``: (model, test metrics)."""
    rows = watched_rows(_index_features(watched), target, threshold)
    model = LogisticRegression(featuresCol="features", labelCol="label").fit(rows.filter("split = 'train'"))
    scored = model.transform(rows.filter("split = 'test'"))
    return model, metrics.classification_metrics(scored, threshold=1)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
