"""Item-item similarity from co-occurrence counts."""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.operators.partners import top_partners

# Ship the functions below inside the tasks, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

ROWS_PER_SLICE = 200_000
# A user with at most this many items lists the pairs directly: linear in the rows.
LIGHT_USER = 32
DENSE_CELLS = 8_000_000


def _merge(first: np.ndarray, second: np.ndarray, n_items: int) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(first.astype(np.int64) * n_items + second, return_counts=True)


def _light_pairs(users: np.ndarray, items: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs inside runs of equal ``users``; ``items`` ascend inside a run."""
    first, second = [], []
    for step in range(1, LIGHT_USER):
        same = users[step:] == users[:-step]
        if not same.any():
            break
        first.append(items[:-step][same])
        second.append(items[step:][same])
    if not first:
        none = np.empty(0, dtype=np.int64)
        return none, none
    return np.concatenate(first), np.concatenate(second)


def _heavy_counts(users: np.ndarray, items: np.ndarray, n_items: int):
    """Co-occurrence of many-item users as products of bounded 0/1 blocks."""
    _, row = np.unique(users, return_inverse=True)
    present, column = np.unique(items, return_inverse=True)
    rows_per_block = 2_048
    width = max(1, min(len(present), DENSE_CELLS // rows_per_block, 2_048))
    for left in range(0, len(present), width):
        for right in range(left, len(present), width):
            shape = (min(width, len(present) - left), min(width, len(present) - right))
            total = np.zeros(shape, dtype=np.float64)
            for low in range(0, row.max() + 1, rows_per_block):
                chosen = (row >= low) & (row < low + rows_per_block)
                blocks = []
                for start, size in ((left, shape[0]), (right, shape[1])):
                    cell = chosen & (column >= start) & (column < start + size)
                    block = np.zeros((rows_per_block, size), dtype=np.float32)
                    block[row[cell] - low, column[cell] - start] = 1.0
                    blocks.append(block)
                total += blocks[0].T @ blocks[1]
            if left == right:
                total = np.triu(total, 1)
            a, b = np.nonzero(total)
            yield present[left + a].astype(np.int64) * n_items + present[right + b], total[a, b].astype(np.int64)


def _slice_counts(pdf: pd.DataFrame) -> pd.DataFrame:
    """Co-occurrence counts of the users in one slice, one row per item pair."""
    if pdf.empty:
        return pd.DataFrame({"i": [], "j": [], "n": []}).astype("int64")
    codes, item = np.unique(pdf["item"].to_numpy(), return_inverse=True)
    user = np.unique(pdf["user"].to_numpy(), return_inverse=True)[1]
    order = np.lexsort((item, user))
    user, item, n_items = user[order], item[order], len(codes)
    light = np.bincount(user)[user] <= LIGHT_USER
    keys, counts = _merge(*_light_pairs(user[light], item[light]), n_items)
    parts = [(keys, counts)]
    if not light.all():
        parts += list(_heavy_counts(user[~light], item[~light], n_items))
    merged = pd.Series(np.concatenate([c for _, c in parts]), index=np.concatenate([k for k, _ in parts]))
    merged = merged.groupby(level=0).sum()
    key = merged.index.to_numpy()
    return pd.DataFrame({"i": codes[key // n_items], "j": codes[key % n_items], "n": merged.to_numpy()})


def co_occurrence(pairs: DataFrame, user: str, item: str, slices: int | None = None) -> DataFrame:
    """Number of users per unordered item pair: (i, j, n) with i < j.

    Whole users are hashed into slices of bounded size. A slice counts pairs of
    light users from sorted runs and of heavy users by block products, and
    returns one row per pair, so no user emits its pairs into the shuffle. A
    distinct user has at most one row per item, however many events it has.
    """
    if slices is None:
        slices = max(1, pairs.count() // ROWS_PER_SLICE + 1)
    distinct = pairs.select(F.col(user).alias("user"), F.col(item).alias("item")).distinct()
    sliced = distinct.withColumn("slice", F.pmod(F.xxhash64("user"), F.lit(slices)))
    counted = sliced.groupBy("slice").applyInPandas(
        lambda pdf: _slice_counts(pdf[["user", "item"]]), schema="i bigint, j bigint, n bigint"
    )
    return counted.groupBy("i", "j").agg(F.sum("n").alias("n"))


def item_similarity(pairs: DataFrame, user: str = "user_id", item: str = "movie_id", top_n: int | None = None) -> DataFrame:
    """Cosine similarity of items over the users they share: (i, j, cosine).

    With ``top_n`` each item keeps its most similar partners, in both directions, and the pairs are not
    all counted (see ``partners``).
    """
    if top_n is not None:
        return top_partners(pairs, user, item, top_n)
    sizes = pairs.select(user, item).distinct().groupBy(item).agg(F.count(F.lit(1)).alias("size"))
    left = sizes.select(F.col(item).alias("i"), F.col("size").alias("size_i"))
    right = sizes.select(F.col(item).alias("j"), F.col("size").alias("size_j"))
    return (
        co_occurrence(pairs, user, item)
        .join(left, "i")
        .join(right, "j")
        .select("i", "j", (F.col("n") / F.sqrt(F.col("size_i").cast("double") * F.col("size_j"))).alias("cosine"))
    )
