import math

import pytest
from pyspark.sql import functions as F

from marquee.functions import scalars as S
from marquee.operators import features

MOVIES = """movie_id BIGINT, title STRING, release_date STRING, runtime INT, popularity DOUBLE, vote_average DOUBLE,
  vote_count INT, genres STRING, production_countries STRING, spoken_languages STRING, original_language STRING"""


@pytest.fixture(scope="module")
def tables(spark):
    movies = spark.createDataFrame(
        [
            (101, "A", "2000-01-01", 100, 1.0, 5.0, 10, "Action,Comedy", "US,CA", "English,French", "en"),
            (102, "B", "bad", None, None, None, -5, "Drama, Action & Adventure", "FR", None, "fr"),
        ],
        MOVIES,
    )
    users = spark.createDataFrame(
        [(1, 25, "student", "M"), (2, None, None, None)], "user_id BIGINT, age INT, occupation STRING, gender STRING"
    )
    ratings = spark.createDataFrame(
        [(1, 101, 4.5), (2, 102, 3.0), (1, 999, 1.0), (None, 101, 2.0)], "user_id BIGINT, movie_id BIGINT, rating DOUBLE"
    )
    return ratings, users, movies


@pytest.fixture(scope="module")
def built(spark, tables):
    ratings, users, movies = tables
    words = {
        "genre": ["Action", "Action & Adventure", "Comedy", "Drama", "unknown"], "country": ["CA", "FR", "US"], "lang": ["en", "fr"],
    }
    kinds = {k: f"{k}_tokens" for k in features.MULTI_HOT}
    index = features.token_index(features.vocabulary(features.movie_attributes(movies), kinds))
    return features.feature_table(ratings, users, movies, 2026, index=index, named=words).collect()


def row(built, user, movie):
    return next(r.asDict() for r in built if r["user_id"] == user and r["movie_id"] == movie)


def test_feature_rows_and_columns(built):
    assert len(built) == 3
    first = row(built, 1, 101)
    assert first["rating"] == 4.5 and first["age_bin"] == "19-25"
    assert [first[c] for c in ("genre_Action", "country_US", "lang_en", "lang_fr")] == [1, 1, 1, 1]
    assert first["genre_Drama"] == 0


def test_genre_match_is_exact(built):
    second = row(built, 2, 102)
    assert second["genre_Action & Adventure"] == 1 and second["genre_Action"] == 0


def test_language_falls_back_to_original(built):
    second = row(built, 2, 102)
    assert second["lang_fr"] == 1 and second["lang_en"] == 0


def test_missing_values_are_filled(built):
    second = row(built, 2, 102)
    assert second["age"] == 25.0 and second["occupation"] == "unknown"
    assert second["runtime"] == 30.0 and second["vote_count"] == 0.0 and second["release_year"] == 2000.0
    unmatched = row(built, 1, 999)
    assert unmatched["original_language"] == "unknown" and unmatched["genre_Action"] == 0


def test_wide_values_are_clipped(spark):
    frame = spark.createDataFrame([(200, 1000, -5, None)], "age INT, runtime INT, vote_count INT, release_year INT")
    assert tuple(features.clip_outliers(frame, 2026).first()) == (100, 720, 0, None)


@pytest.mark.parametrize(
    "age, band",
    [(-1, None), (0, None), (1, "0-18"), (18, "0-18"), (19, "19-25"), (25, "19-25"), (50, "36-50"), (100, "50+"), (101, None), (None, None)],
)
def test_age_bin_edges(spark, age, band):
    assert spark.createDataFrame([(age,)], "age INT").select(S.age_bin(F.col("age"))).first()[0] == band


def test_language_tokens_keep_inner_blanks(spark):
    frame = spark.createDataFrame([(" Tiếng Việt ; No Language, Klingon",)], "s STRING")
    codes = frame.select(S.language_codes(F.col("s"), F.lit("en"))).first()[0]
    assert codes == ["vi", "und", "Klingon"]


def test_weighted_median_counts_ratings(spark):
    ratings = spark.createDataFrame([(1,)] * 3 + [(2,)], "user_id BIGINT")
    users = spark.createDataFrame([(1, 20), (2, 60), (3, 90)], "user_id BIGINT, age INT")
    median = features.weighted_median(ratings, users, "user_id", "age")
    assert spark.range(1).select(median).first()[0] == 20.0


def test_token_vectors_agree_with_named_columns(built, spark, tables):
    kinds = {k: f"{k}_tokens" for k in features.MULTI_HOT}
    index = features.token_index(features.vocabulary(features.movie_attributes(tables[2]), kinds)).collect()
    assert [r["position"] for r in sorted(index, key=lambda r: (r["kind"], r["token"]))] == list(range(len(index)))
    for r in (row(built, 1, 101), row(built, 2, 102)):
        held = {(w["kind"], w["token"]) for w in index if r["tokens"][w["position"]] == 1.0}
        assert {f"{k}_{t}" for k, t in held} == {c for c in r if c.startswith(("genre_", "country_", "lang_")) and r[c] == 1}
    # A rating without a movie has the tokens named 'unknown'; here the index holds none.
    assert row(built, 1, 999)["tokens"].numNonzeros() == 0 and row(built, 1, 999)["genre_unknown"] == 1


def test_tokens_outside_the_index(spark, tables):
    index = spark.createDataFrame([("genre", "Drama", 0), ("genre", "unknown", 1)], "kind STRING, token STRING, position BIGINT")
    ratings, users, movies = tables
    found = {r["movie_id"]: list(r["tokens"].toArray()) for r in features.feature_table(ratings, users, movies, 2026, index=index).collect()}
    assert found == {101: [0.0, 0.0], 102: [1.0, 0.0], 999: [0.0, 1.0]}


def test_confidence_formula(spark):
    watch = spark.createDataFrame(
        [("u1", "m1", "10", "90", "100"), ("u2", "m2", "5", "150", "120"), ("u3", "m3", "bad", None, "0"), ("u4", "m4", "1", "3", "0")],
        "user_id STRING, movie_id STRING, interaction_count STRING, max_minute_reached STRING, duration STRING",
    )
    got = {r["user_id"]: r["confidence"] for r in features.confidence(watch).collect()}
    assert got["u1"] == pytest.approx(1 + 80 * (0.7 * 0.9 + 0.25 * math.log(11) / math.log(101)))
    assert got["u2"] == pytest.approx(1 + 80 * (0.7 * 1.0 + 0.25 * math.log(6) / math.log(121)))
    assert got["u3"] == 0.0
    assert got["u4"] == pytest.approx(1 + 80 * (0.7 + 0.25 * math.log(2) / math.log(2)))


def test_cold_start(spark, rows):
    users = spark.createDataFrame([(1, None, "x", "M")], "user_id BIGINT, age INT, occupation STRING, gender STRING")
    asked = spark.createDataFrame([(1,), (22,), (22,)], "user_id BIGINT")
    assert rows(features.cold_start_profiles(asked, users)) == [
        (1, None, "x", "M"),
        (22, -1, "other or not specified", "U"),
    ]


def test_align_schema(spark):
    frame = spark.createDataFrame([(1, 2)], "a INT, b INT")
    aligned = features.align_schema(frame, ["c", "a"])
    assert aligned.columns == ["c", "a"] and tuple(aligned.first()) == (0, 1)


def test_holdout_of_other_type(spark, rows):
    frame = spark.createDataFrame([(1,), (2,)], "user_id BIGINT")
    holdout = spark.createDataFrame([("2",)], "user_id STRING")
    assert rows(features.exclude_holdout(frame, holdout)) == [(1,)]


def test_factors_use_mean_where_missing(spark):
    factors = spark.createDataFrame([(1, [1.0, 3.0]), (2, [3.0, 5.0])], "user_id BIGINT, features ARRAY<FLOAT>")
    frame = spark.createDataFrame([(1,), (9,)], "user_id BIGINT")
    got = {r["user_id"]: (r["exp_user"], r["has_exp_user"]) for r in features.attach_factors(frame, factors, "exp_user").collect()}
    assert got == {1: ([1.0, 3.0], 1), 9: ([2.0, 4.0], 0)}


def test_factors_of_keys_outside_the_dimensions(spark):
    ratings = spark.createDataFrame([(1, 10, 5), (2, 11, 3), (3, 10, 1)], "user_id BIGINT, movie_id BIGINT, rating INT")
    users = spark.createDataFrame([(1, 30, "x", "M"), (4, 20, "y", "F")], "user_id BIGINT, age INT, occupation STRING, gender STRING")
    movies = spark.createDataFrame(
        [(10, "a", "en", "English", "US", "1990-01-01", 100, 1.0, 5, 6)],
        "movie_id BIGINT, genres STRING, original_language STRING, spoken_languages STRING, production_countries STRING, "
        "release_date STRING, runtime INT, popularity DOUBLE, vote_average INT, vote_count INT",
    )
    tables = {
        "u": spark.createDataFrame([(1, [1.0]), (2, [3.0]), (None, None)], "user_id BIGINT, features ARRAY<FLOAT>"),
        "m": spark.createDataFrame([(11, [8.0])], "movie_id BIGINT, features ARRAY<FLOAT>"),
    }
    rows = features.feature_table(ratings, users, movies, 2026, factors=tables)
    got = {r["user_id"]: (r["u"], r["has_u"], r["m"], r["has_m"]) for r in rows.collect()}
    assert got == {1: ([1.0], 1, [8.0], 0), 2: ([3.0], 1, [8.0], 1), 3: ([2.0], 0, [8.0], 0)}
    # The flags alone move no vector: what is asked of one is asked before the rows meet it.
    plan = rows.select("has_u", "has_m")._jdf.queryExecution().optimizedPlan().toString()
    joined = [line for line in plan.splitlines() if "Project" in line and "isnotnull" in line]
    assert joined and all("AS has_" in line and "features#" in line for line in joined)


def test_minmax_of_constant_column(spark):
    frame = spark.createDataFrame([(5,), (5,)], "x INT")
    assert [r["scaled"] for r in features.minmax_scale(frame, "x", frame).collect()] == [0.0, 0.0]


@pytest.mark.parametrize("users, movies", [(range(0, 10_000, 10), [20]), ([3], range(7, 50_007, 50)), (range(3, 10_003, 10), [7])])
def test_split_share_holds_for_ids_in_steps(spark, users, movies):
    pairs = spark.createDataFrame([(u, m) for u in users for m in movies], "user_id BIGINT, movie_id BIGINT")
    split = features.hash_split(pairs, 0.1)
    assert split.filter("split = 'test'").count() == pytest.approx(0.1 * pairs.count(), rel=0.35)
    other = features.hash_split(pairs, 0.1, seed=7)
    assert split.filter("split = 'test'").exceptAll(other.filter("split = 'test'")).count() > 0
