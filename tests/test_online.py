import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from marquee.operators import lineage, metrics, offline, online, refresh, rollout, windows

NOW = datetime(2025, 10, 23, 20, 50)
RECS = "event_id BIGINT, ts TIMESTAMP, user_id STRING, items ARRAY<STRING>, model_version STRING, response_time DOUBLE"
CLICKS = "event_id BIGINT, ts TIMESTAMP, user_id STRING, item_id STRING"


@pytest.fixture(scope="module")
def document(spark):
    """Three lists and four interactions, three of which hit."""
    served = [
        (1, NOW, "u1", ["m1", "m2", "m3"], "v1", 0.4),
        (2, NOW, "u2", ["m2", "m4"], "v2", 0.6),
        (3, NOW, "u3", ["m5", "m1"], "v1", 0.3),
    ]
    clicks = [(10, NOW, "u1", "m2"), (11, NOW, "u1", "m4"), (12, NOW, "u2", "m2"), (13, NOW, "u3", "m5")]
    return spark.createDataFrame(served, RECS), spark.createDataFrame(clicks, CLICKS)


def test_ctr(document, rows):
    served, clicks = document
    assert rows(online.ctr(served, clicks)) == [(7, 3, 3 / 7)]
    assert rows(online.ctr(served, clicks, ["model_version"])) == [("v1", 5, 2, 0.4), ("v2", 2, 1, 0.5)]


def test_ctr_counts_every_interaction_and_every_shown_item(document, rows):
    served, clicks = document
    assert rows(online.ctr(served.union(served), clicks.union(clicks))) == [(14, 6, 6 / 14)]


def test_ctr_without_lists(document, rows):
    served, clicks = document
    nothing = served.filter("false")
    assert rows(online.ctr(nothing, clicks)) == [(0, 0, 0.0)]
    assert rows(online.ctr(nothing, clicks, ["model_version"])) == []
    empty = served.withColumn("items", F.array().cast("array<string>"))
    assert {r["ctr"] for r in online.ctr(empty, clicks, ["model_version"]).collect()} == {0.0}


def test_online_metrics_window(spark):
    old = NOW - timedelta(hours=2)
    served = spark.createDataFrame([(1, NOW, "u1", ["m1", "m2"], "v1", 0.5), (2, old, "u2", ["m3"], "v1", 9.0)], RECS)
    clicks = spark.createDataFrame([(3, NOW, "u1", "m2"), (4, old, "u2", "m9")], CLICKS)
    errors = spark.createDataFrame([(5, NOW, "u1")], "event_id BIGINT, ts TIMESTAMP, user_id STRING")
    got = online.online_metrics(served, clicks, errors, F.lit(NOW), hours=1).first().asDict()
    assert got == {
        "hours": 1, "num_recommendations": 1, "num_interactions": 1, "avg_response_time": 0.5, "p95_response_time": 0.5,
        "error_rate": 1.0, "hit_rate": 1.0, "user_coverage": 1, "item_coverage": 2,
    }
    none = online.online_metrics(served, clicks, errors, F.lit(NOW + timedelta(days=3)), hours=1).first().asDict()
    assert none["num_recommendations"] == 0 and none["p95_response_time"] == 0.0 and none["hit_rate"] == 0.0


def test_first_and_latest_list(spark, rows):
    served = spark.createDataFrame(
        [(1, NOW, "u", ["a"], "v1", 0.1), (2, NOW + timedelta(seconds=1), "u", ["b"], "v2", 0.1)], RECS
    )
    clicks = spark.createDataFrame([(3, NOW, "u", "a"), (4, NOW, "w", "a")], CLICKS)
    latest = online.hits_against(online.latest_list(served), clicks).select("event_id", "hit")
    first = online.hits_against(online.first_list(served), clicks).select("event_id", "hit")
    assert rows(latest) == [(3, 0.0), (4, 0.0)] and rows(first) == [(3, 1.0), (4, 0.0)]


def test_group_rating_skips_bad_values(spark):
    quality = spark.createDataFrame([(1, "4"), (1, "x"), (2, "2"), (3, "5"), (2, None)], "user_id BIGINT, rating STRING")
    users = spark.createDataFrame([(1, "M"), (2, "F"), (3, None)], "user_id BIGINT, gender STRING")
    assert tuple(online.group_rating(quality, users).first()) == (4.0, 2.0, 0.5)


@pytest.mark.parametrize(
    "values, expected",
    [
        ((0.2, 0.2, 0.2, 1.0), None),
        ((0.05, None, None, None), "feedback_low_ctr"),
        ((0.2, 0.2, 0.05, 1.0), "canary_low_ctr_abs+canary_low_ctr_rel"),
        ((0.2, 0.0, 0.05, None), "canary_low_ctr_abs"),
        ((0.12, 0.3, 0.15, 0.5), "canary_low_ctr_rel+fairness_gender"),
    ],
)
def test_issue_flags(spark, values, expected):
    frame = spark.createDataFrame([values], "a DOUBLE, b DOUBLE, c DOUBLE, d DOUBLE")
    assert frame.select(online.issue_flags(*[F.col(c) for c in "abcd"])).first()[0] == expected


@pytest.mark.parametrize(
    "current, issue, expected",
    [(0, None, 5), (5, None, 10), (9, None, 10), (10, None, 25), (25, None, 50), (50, None, 100), (100, None, 100), (50, "x", 0)],
)
def test_staircase(spark, current, issue, expected):
    frame = spark.createDataFrame([(float(current), issue)], "c DOUBLE, i STRING")
    assert frame.select(rollout.staircase_step(F.col("c"), F.col("i"))).first()[0] == expected


@pytest.mark.parametrize(
    "state, event, action, pct",
    [
        ((20.0, "canary_low_ctr_rel", 62, 0.14, 0.09), "canary_abort", "ABORT", 0.0),
        ((50.0, None, 250, 0.135, 0.142), "canary_check", "RAMP", 60.0),
        ((5.0, None, 10, 0.1, 0.1), "canary_check", "RAMP", 10.0),
        ((90.0, None, 30, 0.1, 0.1), "promotion", "PROMOTE_AND_RESET", 0.0),
        ((100.0, None, 30, 0.1, 0.1), "canary_check", "RAMP", 100.0),
        ((20.0, None, 9, 0.1, 0.1), "canary_check", "RAMP", 20.0),
        ((20.0, None, 11, 0.1, 0.1), "canary_check", "RAMP", 20.0),
        ((20.0, None, 20, 0.1, None), "canary_check", "RAMP", 20.0),
    ],
)
def test_linear_rollout(spark, state, event, action, pct):
    frame = spark.createDataFrame([state], "current_pct DOUBLE, issue STRING, n_inter BIGINT, ctr_v1 DOUBLE, ctr_v2 DOUBLE")
    *ramp, got = rollout.linear_rollout(frame).collect()
    assert (got["event_type"], got["action"], got["new_pct"]) == (event, action, pct)
    assert got["reason"]
    # Full rollout logs the ramp to 100 first.
    assert [(r["event_type"], r["action"], r["new_pct"]) for r in ramp] == [("canary_check", "RAMP", 100.0)] * (event == "promotion")


@pytest.mark.parametrize(
    "scores, decision",
    [
        ({"candidate": 0.5, "v2": 0.6, "v1": 0.4}, "promote_v2"),
        ({"candidate": 0.5, "v2": 0.4, "v1": 0.6}, "promote_v1"),
        ({"candidate": 0.5, "v2": 0.5, "v1": 0.5 + 5e-7}, "reject"),
        ({"candidate": 0.5}, "promote_v2"),
    ],
)
def test_promotion(spark, scores, decision):
    frame = spark.createDataFrame(list(scores.items()), "model STRING, rmse DOUBLE")
    assert rollout.promotion(frame).first()["decision"] == decision


def test_stage_pointers(spark, rows):
    stages = spark.createDataFrame([("v1", "a"), ("v2", "b")], "stage STRING, model_version STRING")
    at = F.lit(NOW)

    def moved(word):
        decision = spark.createDataFrame([(word,)], "decision STRING")
        return rows(rollout.stage_pointers(stages, decision, "c", at).drop("valid_from"))

    assert moved("promote_v2") == [("v1", "b"), ("v2", "c")]
    assert moved("promote_v1") == [("v1", "c")]
    assert moved("reject") == []


@pytest.mark.parametrize("seen, retrain", [((70, 450), False), ((40, 450), True), ((70, 400), True), (None, True)])
def test_retrain_gate(spark, seen, retrain):
    stats = spark.createDataFrame([(100, 5, 500, 7)], "users BIGINT, movies BIGINT, interactions BIGINT, ratings BIGINT")
    state = spark.createDataFrame([seen] if seen else [], "users_seen BIGINT, interactions_seen BIGINT")
    assert rollout.retrain_gate(stats, state).first()["retrain"] is retrain


def test_refresh_from_scratch(spark):
    users = spark.createDataFrame([(1,), (2,), (3,)], "user_id BIGINT")
    movies = spark.createDataFrame([(1,)], "movie_id BIGINT")
    stats = refresh.refresh_stats(spark, users, movies, movies, None)
    reports = spark.createDataFrame([], "timestamp TIMESTAMP, users BIGINT, movies BIGINT, interactions BIGINT, ratings BIGINT")
    assert tuple(refresh.refresh_delta(stats, refresh.latest_report(reports)).first()) == (3, 1, 1, 0, 3, 1, 1, 0)


def test_traffic_split(spark):
    def passes(n_v1, n_v2, errors, target):
        served = spark.createDataFrame([("v1",)] * n_v1 + [("v2",)] * n_v2, "model_version STRING")
        return online.traffic_split(served, F.lit(errors), target).first()["pass"]

    assert passes(90, 10, 0, 10.0) and not passes(60, 40, 0, 10.0)
    assert not passes(90, 10, 30, 10.0) and not passes(9, 0, 0, 10.0)
    assert passes(9, 0, 0, 0.0) and not passes(8, 1, 0, 0.0)


def test_canary_share_and_stickiness(spark):
    requests = spark.range(10_000).withColumnRenamed("id", "user_id")
    first = online.canary_assign(requests, 30, "user_id")
    assert first.filter("model = 'v2'").count() == pytest.approx(3000, rel=0.1)
    tens = online.canary_assign(requests.filter("user_id % 10 = 0"), 30, "user_id")
    assert tens.filter("model = 'v2'").count() == pytest.approx(300, rel=0.2)
    assert tens.exceptAll(first).count() == 0
    assert online.canary_assign(requests, 30, "user_id", has_canary=False).filter("model = 'v2'").count() == 0


def test_histogram_quantile_edges(spark):
    values = [0.05, 0.2, 0.2, 400.0]
    frame = spark.createDataFrame([(x,) for x in values], "v DOUBLE")
    counts = frame.agg(windows.bucket_counts(F.col("v")).alias("c"))
    got = counts.select(*[windows.histogram_quantile(F.col("c"), q) for q in (0.25, 0.5, 0.99)]).first()
    assert list(got) == pytest.approx([0.1, 0.1 + 0.15 * 0.5, 300.0])
    empty = frame.filter("false").agg(windows.bucket_counts(F.col("v")).alias("c"))
    assert empty.select(windows.histogram_quantile(F.col("c"), 0.5)).first()[0] is None


def test_quantile_of_stored_rows(spark, rows):
    stored = spark.createDataFrame(
        [("p", 0.1, 1), ("p", 0.25, 3), ("p", None, 4), ("q", 1.0, 0), ("q", None, 2)], "path STRING, le DOUBLE, n BIGINT"
    )
    got = dict(rows(windows.quantile_of_rows(stored, 0.5, "path")))
    assert got["p"] == pytest.approx(0.175) and got["q"] == 1.0


def test_alert_cooldown(spark):
    minutes = [0, 10, 50, 60, 70, 125]
    series = spark.createDataFrame([(NOW + timedelta(minutes=m), 0.05) for m in minutes] + [(NOW, 0.9)], "window_start TIMESTAMP, q DOUBLE")
    got = [r[0] for r in windows.quality_alerts(series, "q").collect()]
    assert sorted(got) == [NOW + timedelta(minutes=m) for m in (0, 60, 125)]


def test_gaps(spark, rows):
    events = spark.createDataFrame([(NOW,), (NOW + timedelta(minutes=25),)], "ts TIMESTAMP")
    assert [r[1:] for r in rows(windows.gaps(events))] == [(1, 1), (0, 0), (1, 1)]


def test_offset_lag_of_unconsumed_topic(spark, rows):
    offsets = spark.createDataFrame([("a", 10, 7), ("b", 4, None)], "topic STRING, produced BIGINT, consumed BIGINT")
    assert rows(windows.offset_lag(offsets)) == [("a", 10, 7, 3), ("b", 4, -1, 5)]


def test_correlation_of_constant_column_is_null(spark):
    frame = spark.createDataFrame([(1, 2.0), (2, 2.0)], "x INT, y DOUBLE")
    assert frame.agg(offline.pearson("x", "y")).first()[0] is None


def test_fairness_needs_its_column_and_skips_null_groups(spark, rows):
    frame = spark.createDataFrame([("F", 4.0), (None, 1.0), ("F", 2.0)], "gender STRING, rating DOUBLE")
    assert rows(offline.group_fairness(frame)) == [("F", 2, 3.0, None)]
    with pytest.raises(ValueError):
        offline.group_fairness(frame, "age_bin")


def test_genre_diversity_counts_users_without_genres(spark):
    ratings = spark.createDataFrame([(1, 1), (1, 2), (2, 9)], "user_id BIGINT, movie_id BIGINT")
    movies = spark.createDataFrame([(1, "a, b"), (2, "b,c")], "movie_id BIGINT, genres STRING")
    assert offline.genre_diversity(ratings, movies).first()["mean_genres"] == 1.5


def test_input_stats(spark):
    frame = spark.createDataFrame([(25, None), (30, 50000), (None, 60000)], "age INT, income INT")
    assert tuple(offline.input_stats(frame).first()) == (3, 2)


def test_regression_and_classification(spark):
    scored = spark.createDataFrame([(1.0, 2.0), (3.0, 3.0), (5.0, 4.0), (4.0, 2.0)], "label DOUBLE, prediction DOUBLE")
    reg = metrics.regression_metrics(scored).first()
    assert reg["mse"] == 1.5 and reg["mae"] == 1.0 and reg["r2"] == pytest.approx(1 - 6 / 8.75)
    cls = metrics.classification_metrics(scored).first()
    assert (cls["precision"], cls["recall"], cls["accuracy"]) == (1.0, pytest.approx(2 / 3), 0.75)
    none = metrics.classification_metrics(scored, threshold=9).first()
    assert (none["precision"], none["recall"], none["f1"], none["accuracy"]) == (0.0, 0.0, 0.0, 1.0)


def test_ranking_metrics_leave_one_out(spark):
    ranked = spark.createDataFrame([(1, 1), (2, 2)], "movie_id BIGINT, rank INT")
    truth = spark.createDataFrame([(1, 2), (2, 9)], "user_id BIGINT, movie_id BIGINT")
    got = metrics.ranking_metrics(ranked, truth, 20).first()
    import math

    assert list(got) == pytest.approx([0.5, 0.5 / 20, 0.5, 0.5 / math.log2(3)])


def test_traces(spark, rows):
    predictions = spark.createDataFrame([("r1", "v1", 1), ("r1", "v9", 2), ("r2", "v9", 3)], "request_id STRING, model_version STRING, seq INT")
    models = spark.createDataFrame([("v1", "d1", "p", 1), ("v1", "d2", "p", 2)], "model_version STRING, training_data_id STRING, artifact_path STRING, seq INT")
    data = spark.createDataFrame([("d1", "raw")], "data_id STRING, data_source STRING")
    traced = lineage.trace_predictions(predictions, models, data).select("request_id", "model_version", "training_data_id", "data_source")
    assert rows(traced) == [("r1", "v1", "d1", "raw"), ("r2", "v9", None, None)]
    evaluations = predictions.withColumnRenamed("request_id", "eval_id")
    assert lineage.trace_evaluations(evaluations, models).count() == 2
    assert [r["seq"] for r in lineage.recent_events_overall(predictions, n=2).collect()] == [2, 3]


def brute_alerts(low, cooldown):
    raised = []
    for at in sorted(low):
        if not raised or at >= raised[-1] + cooldown:
            raised.append(at)
    return raised


@pytest.mark.parametrize("share", [0.02, 0.3, 1.0])
def test_alerts_against_the_sequential_rule(spark, share):
    rng = random.Random(5)
    low = [NOW + timedelta(minutes=10 * k) for k in range(3000) if rng.random() < share]
    series = spark.createDataFrame([(t, 0.05) for t in low], "window_start TIMESTAMP, q DOUBLE").repartition(4)
    for cooldown, text in ((timedelta(hours=1), "1 hour"), (timedelta(minutes=25), "25 minutes")):
        got = sorted(r[0] for r in windows.quality_alerts(series, "q", cooldown=text).collect())
        assert got == brute_alerts(low, cooldown)
    assert windows.quality_alerts(series.limit(0), "q").count() == 0


def test_gap_of_decades(spark):
    events = spark.createDataFrame([(datetime(1970, 1, 1),), (NOW,), (NOW + timedelta(minutes=25),), (None,)], "ts TIMESTAMP")
    found = windows.gaps(events, "1 day")
    days = (NOW.date() - datetime(1970, 1, 1).date()).days
    assert found.count() == found.select("window_start").distinct().count() == days + 1
    assert found.filter("up = 1").count() == 2 and found.agg(F.sum("n")).first()[0] == 3


def test_metrics_of_several_spans_equal_single_ones(spark, rows):
    rng = random.Random(6)
    at = lambda: NOW - timedelta(minutes=rng.randrange(600))
    served = spark.createDataFrame([(k, at(), rng.choice(["u1", "u1", "u2", None]), [f"m{rng.randrange(9)}"], "v1", rng.random()) for k in range(300)], RECS)
    clicks = spark.createDataFrame([(k, at(), rng.choice(["u1", "u3"]), f"m{rng.randrange(9)}") for k in range(100)], CLICKS)
    errors = spark.createDataFrame([(k, at(), "u1") for k in range(20)], "event_id BIGINT, ts TIMESTAMP, user_id STRING")
    args = (served, clicks, errors, F.lit(NOW))
    together = online.online_metrics(*args, hours=[1, 5, 9]).orderBy("hours").collect()
    assert together == [online.online_metrics(*args, hours=h).first() for h in (1, 5, 9)]


def test_detection_counts_lists_without_items(spark):
    served = spark.createDataFrame([(1, NOW, "u", ["a", "b"], "v1", 0.1), (2, NOW, "u", [], "v2", 0.1), (3, NOW, "w", None, "v1", 0.1), (4, NOW, "u", ["a"], "v2", 0.1)], RECS)
    clicks = spark.createDataFrame([(3, NOW, "u", "a"), (4, NOW, "u", "a"), (5, NOW, None, "a"), (6, NOW, "z", "a")], CLICKS)
    quality = spark.createDataFrame([("u", "4"), ("u", "x")], "user_id STRING, rating STRING")
    users = spark.createDataFrame([("u", "M")], "user_id STRING, gender STRING")
    got = online.detection(served, clicks, quality, users).first().asDict()
    assert (got["n_rec_events"], got["n_interaction_events"], got["n_quality_events"]) == (4, 4, 2)
    assert (got["ctr"], got["ctr_v1"], got["ctr_v2"]) == (pytest.approx(2 / 3), 1.0, 2.0)
