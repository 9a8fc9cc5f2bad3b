"""Distributed operators against brute force, on skewed inputs."""

import bisect
import itertools
import math
import random
from collections import Counter, defaultdict
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from marquee.operators import asof, offline, quantiles, ranking, recommend, similarity, slots
from marquee.session import materialise


def frame(spark, data, schema):
    return spark.createDataFrame(data, schema).repartition(4)


@pytest.mark.parametrize("seed", [1, 2])
def test_global_position_with_a_hot_value(spark, seed):
    rng = random.Random(seed)
    data = [(i, 7 if rng.random() < 0.5 else rng.randrange(50)) for i in range(3000)]
    got = slots.global_position(frame(spark, data, "id BIGINT, n INT"), "n", "id", descending=True)
    expected = {r[0]: p for p, r in enumerate(sorted(data, key=lambda r: (-r[1], r[0])), 1)}
    assert {r["id"]: r["position"] for r in got.collect()} == expected


@pytest.mark.parametrize("parts", ["1", "7"])
def test_numbering_of_repeated_and_missing_values(spark, parts):
    rng = random.Random(11)
    data = [(i % 700, rng.choice([None, "a", "a", "a", "b"])) for i in range(2000)]
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        table = slots.numbered(frame(spark, data, "id BIGINT, s STRING"), [F.col("s").desc(), F.col("id").asc()], first=5)
        got = sorted((r["position"], r["s"], r["id"]) for r in table.collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert [r[0] for r in got] == list(range(5, 2005))
    order = sorted(data, key=lambda r: ({"b": 0, "a": 1, None: 2}[r[1]], r[0]))
    assert [(i, s) for _, s, i in got] == order
    assert slots.numbered(spark.createDataFrame([], "id BIGINT"), [F.col("id").asc()]).count() == 0


@pytest.mark.parametrize("n", [1, 2, 61, 5000])
def test_exact_quantiles(spark, n):
    rng = np.random.default_rng(n)
    values = np.where(rng.random(n) < 0.4, 3.0, rng.normal(size=n).round(4))
    df = frame(spark, [(float(x),) for x in values] + [(None,)], "v DOUBLE")
    got = {r["share"]: r["quantile"] for r in quantiles.exact_quantiles(df, "v", [0.0, 0.1, 0.5, 0.95, 1.0], accuracy=200).collect()}
    for share, value in got.items():
        assert value == pytest.approx(np.quantile(values, share)), share


def test_quantiles_of_nothing(spark):
    empty = spark.createDataFrame([], "v DOUBLE")
    assert spark.range(1).select(quantiles.exact_quantile(empty, "v", 0.5)).first()[0] is None


@pytest.mark.parametrize("parts", ["2", "32"])
def test_attach_latest_with_a_hot_key(spark, parts):
    rng = random.Random(5)
    start = datetime(2024, 1, 1)

    def some(n, offset):
        return [
            (offset + i, 1 if rng.random() < 0.4 else rng.randrange(20), start + timedelta(seconds=rng.randrange(400)))
            for i in range(n)
        ]

    history, events = some(600, 0), some(500, 10_000)
    schema = "event_id BIGINT, user_id BIGINT, ts TIMESTAMP"
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = materialise(asof.attach_latest(frame(spark, events, schema), frame(spark, history, schema), "user_id", "ts", "event_id"), "got")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    by_user = defaultdict(list)
    for event_id, user, ts in history:
        by_user[user].append((ts, event_id))
    for found in by_user.values():
        found.sort()
    for r in got.collect():
        known = by_user[r["user_id"]]
        place = bisect.bisect_right(known, (r["ts"], math.inf))
        expected = known[place - 1][1] if place else None
        assert (r["latest"]["event_id"] if r["latest"] else None) == expected


def test_attach_latest_without_history(spark):
    schema = "event_id BIGINT, user_id BIGINT, ts TIMESTAMP"
    events = spark.createDataFrame([(1, 1, datetime(2024, 1, 1))], schema)
    got = asof.attach_latest(events, spark.createDataFrame([], schema), "user_id", "ts", "event_id").collect()
    assert [r["latest"] for r in got] == [None]


def test_co_occurrence_of_light_and_heavy_users(spark, monkeypatch):
    rng = random.Random(3)
    baskets = {u: set(rng.sample(range(90), rng.randrange(1, 12))) for u in range(60)}
    baskets[999] = set(range(80))
    baskets[998] = set(range(30, 90))
    pairs = [(u, i) for u, items in baskets.items() for i in items for _ in range(rng.randrange(1, 3))]
    expected = Counter()
    for items in baskets.values():
        expected.update(itertools.combinations(sorted(items), 2))
    df = frame(spark, pairs, "user_id BIGINT, movie_id BIGINT")
    for slices in (1, 5):
        got = similarity.co_occurrence(df, "user_id", "movie_id", slices)
        assert {(r["i"], r["j"]): r["n"] for r in got.collect()} == dict(expected)


def test_heavy_blocks_smaller_than_the_items(monkeypatch):
    monkeypatch.setattr(similarity, "DENSE_CELLS", 2_048 * 7)
    users = np.repeat(np.arange(3), 20)
    items = np.concatenate([np.arange(20), np.arange(5, 25), np.arange(0, 40, 2)])
    counts = Counter()
    for keys, n in similarity._heavy_counts(users, items, 40):
        counts.update(dict(zip(keys.tolist(), n.tolist())))
    expected = Counter()
    for u in range(3):
        for a, b in itertools.combinations(sorted(items[users == u]), 2):
            expected[int(a) * 40 + int(b)] += 1
    assert counts == expected


def test_similarity_top_n(spark):
    pairs = [(1, 1), (1, 2), (2, 1), (2, 2), (3, 1), (3, 3)]
    top = similarity.item_similarity(frame(spark, pairs, "user_id BIGINT, movie_id BIGINT"), top_n=1)
    assert {(r["i"], r["j"]) for r in top.collect()} == {(1, 2), (2, 1), (3, 1)}


@pytest.mark.parametrize("n", [3, 10])
def test_unseen_with_a_user_who_saw_nearly_everything(spark, n):
    rng = random.Random(n)
    order = list(range(40))
    rng.shuffle(order)
    ranked = frame(spark, [(m, p) for p, m in enumerate(order, 1)], "movie_id BIGINT, position BIGINT")
    seen = {1: set(order[:37]), 2: set(rng.sample(order, 15)), 3: set(), 4: set(order)}
    users = frame(spark, [(u,) for u in seen], "user_id BIGINT")
    pairs = frame(spark, [(u, m) for u, ms in seen.items() for m in ms] * 2, "user_id BIGINT, movie_id BIGINT")
    got = defaultdict(list)
    for r in recommend.recommend_unseen(ranked, users, pairs, n).orderBy("user_id", "rank").collect():
        got[r["user_id"]].append(r["movie_id"])
    for user, movies in seen.items():
        assert got[user] == [m for m in order if m not in movies][:n]


def test_top_share_matches_sorting(spark):
    counts = [1] * 50 + [2] * 20 + [9, 30, 30]
    got = ranking.top_share(frame(spark, [(c,) for c in counts], "c INT"), "c").first()
    k = max(1, int(0.1 * len(counts)))
    assert got["k"] == k and got["share"] == pytest.approx(sum(sorted(counts)[-k:]) / sum(counts))


def test_sample_cap_is_exact_and_repeatable(spark):
    df = spark.range(20_000).repartition(7)
    first = {r["id"] for r in ranking.sample_cap(df, ["id"], 500).collect()}
    second = {r["id"] for r in ranking.sample_cap(df.repartition(3), ["id"], 500).collect()}
    assert len(first) == 500 and first == second
    assert ranking.sample_cap(df, ["id"], 50_000).count() == 20_000


def test_sample_fraction(spark):
    assert abs(ranking.sample_fraction(spark.range(20_000), ["id"], 0.2).count() - 4000) < 300


def test_last_n_per_key(spark, rows):
    df = frame(spark, [("a", i) for i in range(6)] + [("b", 1)], "k STRING, seq INT")
    assert rows(ranking.last_n_per_key(df, "k", "seq", 2)) == [("a", 4, 1), ("a", 5, 2), ("b", 1, 1)]
    assert ranking.last_n_per_key(df, "k", "seq", 0).count() == 0


def test_hot_key_is_cut_before_the_shuffle(spark):
    plan = ranking.best_per_key(spark.range(10).withColumn("k", F.col("id") % 2), ["k"], [F.col("id")], 3)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in text and "Partial" in text


def test_brackets_that_miss_are_widened(spark, monkeypatch):
    values = [float(x) for x in range(2000)]
    df = frame(spark, [(x,) for x in values], "v DOUBLE")
    found = []
    bracketed = quantiles._bracketed

    def narrow(data, group, shares, accuracy, margin):
        found.append(margin)
        table = bracketed(data, group, shares, accuracy, margin)
        return table.withColumn("missed", F.lit(True)) if len(found) < 3 else table

    monkeypatch.setattr(quantiles, "_bracketed", narrow)
    assert quantiles.exact_quantiles(df, "v", [0.5], accuracy=200).first()["quantile"] == pytest.approx(999.5)
    assert found == sorted(found) and len(found) == 3


def test_quantiles_by_group(spark):
    rng = np.random.default_rng(3)
    data = [(g, float(x)) for g, n in ((1, 900), (2, 3), (3, 1)) for x in rng.normal(size=n)]
    got = {(r["g"], r["share"]): r["quantile"] for r in quantiles.exact_quantiles(frame(spark, data, "g INT, v DOUBLE"), "v", [0.25, 0.95], 100, "g").collect()}
    assert got == {(g, s): pytest.approx(np.quantile([v for h, v in data if h == g], s)) for g in (1, 2, 3) for s in (0.25, 0.95)}


def test_unseen_lists_of_users_who_saw_the_head(spark, monkeypatch):
    monkeypatch.setattr(recommend, "HEAD", 3)
    ranked = frame(spark, [(m, m + 1) for m in range(30)], "movie_id BIGINT, position BIGINT")
    users = frame(spark, [(u,) for u in range(4)], "user_id BIGINT")
    seen = frame(spark, [(1, m) for m in range(0, 20, 2)] + [(2, m) for m in range(12)] + [(3, 29)], "user_id BIGINT, movie_id BIGINT")
    held = {u: {r["movie_id"] for r in seen.filter(F.col("user_id") == u).collect()} for u in range(4)}
    got = recommend.recommend_unseen(ranked, users, seen, 4).orderBy("user_id", "rank").collect()
    for u in range(4):
        assert [r["movie_id"] for r in got if r["user_id"] == u] == [m for m in range(30) if m not in held[u]][:4]


def test_genre_lists_sort_one_row_for_a_set(spark):
    """Against brute force; sets of many movies add one row to the sort of a profile, not one for each movie."""
    draw = random.Random(5)
    movies = [(m, ",".join(draw.sample("abcdef", draw.randint(1, 3))), float(draw.randint(1, 40))) for m in range(400)]
    profiles = [(u, sorted(draw.sample("abcdefg", draw.randint(1, 4)))) for u in range(60)] + [(99, ["g"])]
    catalogue = frame(spark, movies, "movie_id INT, genres STRING, popularity DOUBLE")
    lists = recommend.recommend_by_genre(frame(spark, profiles, "user_id INT, profile ARRAY<STRING>"), catalogue, 7)
    wanted = set()
    for user, profile in profiles:
        scores = [(-p * len(set(g.split(",")) & set(profile)), m) for m, g, p in movies]
        wanted |= {(user, m, -x, k) for k, (x, m) in enumerate(sorted(s for s in scores if s[0])[:7], 1)}
    assert {tuple(r) for r in lists.collect()} == wanted
    plan = lists._jdf.queryExecution().optimizedPlan().toString()
    assert "_head" in plan


def test_tasks_of_genre_counts_follow_the_pairs(spark, monkeypatch):
    monkeypatch.setattr(offline, "TASK_PAIRS", 10)
    ratings = spark.createDataFrame([(u, m) for u in range(30) for m in range(u % 7)], "user_id INT, movie_id INT")
    ratings = ratings.unionByName(ratings)
    movies = spark.createDataFrame([(m, f"g{m % 3},g{m}x") for m in range(6)], "movie_id INT, genres STRING")
    counted = offline.genres_per_user(ratings, movies)
    assert {tuple(r) for r in counted.collect()} == {
        (u, len({g for m in range(u % 7) for g in (f"g{m % 3}", f"g{m}x") if m < 6})) for u in range(30) if u % 7
    }
    n_pairs = sum(u % 7 for u in range(30))
    assert f"], {-(-n_pairs // 10)}" in counted._jdf.queryExecution().optimizedPlan().toString()
