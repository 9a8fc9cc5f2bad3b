"""Exact lists of similar items against brute force, with users of many items."""

import math
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from marquee.operators import partners, similarity

SCHEMA = "user_id bigint, movie_id bigint"


def lists(frame):
    out = defaultdict(list)
    for row in sorted(frame.collect(), key=lambda r: (r["i"], r["rank"])):
        out[row["i"]].append((row["j"], round(row["cosine"], 12)))
    return dict(out)


def every_list(rows, n):
    users = defaultdict(set)
    for user, item in rows:
        if user is not None and item is not None:
            users[item].add(user)
    out = {}
    for i, own in users.items():
        found = [(-len(own & users[j]) / math.sqrt(float(len(own)) * len(users[j])), j) for j in users if j != i and own & users[j]]
        if found:
            out[i] = [(j, round(-cosine, 12)) for cosine, j in sorted(found)[:n]]
    return out


@pytest.mark.parametrize("seed, n_heavy, light", [(1, 5, 12), (2, 12, 4), (3, 0, 512)])
def test_lists_equal_all_pairs(spark, seed, n_heavy, light):
    rng = random.Random(seed)
    baskets = {u: rng.sample(range(90), rng.randrange(1, 6)) for u in range(70)}
    baskets.update({900 + k: rng.sample(range(130), rng.randrange(15, 125)) for k in range(n_heavy)})
    rows = [(u, i) for u, items in baskets.items() for i in items for _ in range(rng.randrange(1, 3))]
    rows += [(None, 3), (None, 4), (5, None), (7000, 777)]
    got = partners.top_partners(spark.createDataFrame(rows, SCHEMA), n=4, light=light)
    assert lists(got) == every_list(rows, 4)


def test_items_of_heavy_users_alone(spark):
    """No light user at all: items come in classes, and classes share some of their users."""
    rng = random.Random(9)
    rows = [(u, i) for u in range(6) for i in range(60) if (i % 11 + u) % 3 and rng.random() < 0.9]
    got = partners.top_partners(spark.createDataFrame(rows, SCHEMA), n=5, light=3)
    assert lists(got) == every_list(rows, 5)


def test_no_rows(spark):
    assert similarity.item_similarity(spark.createDataFrame([], SCHEMA), top_n=3).count() == 0


def test_a_user_of_a_million_items(spark):
    """User -1 has them all; five items share one more user, the last thirty have no other."""
    most = 1_000_000
    every = spark.range(most + 30).select(F.lit(-1).cast("bigint").alias("user_id"), F.col("id").alias("movie_id"))
    fives = spark.range(most).select(F.expr("id div 5").alias("user_id"), F.col("id").alias("movie_id"))
    got = similarity.item_similarity(every.unionByName(fives), top_n=6)
    mate = (F.col("rank") <= 4) & (F.expr("i div 5") == F.expr("j div 5")) & (F.round("cosine", 9) == 1)
    lone = (F.col("rank") > 4) & (F.col("j") == most + F.col("rank") - 5) & (F.round("cosine", 9) == round(0.5**0.5, 9))
    figures = got.groupBy((F.col("i") < most).alias("in_five")).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(mate).alias("mates"), F.count_if(lone).alias("lone"), F.min("cosine").alias("least")
    )
    found = {row["in_five"]: row for row in figures.collect()}
    assert (found[True]["rows"], found[True]["mates"], found[True]["lone"]) == (6 * most, 4 * most, 2 * most)
    assert found[False]["rows"] == 6 * 30 and round(found[False]["least"], 9) == 1
