"""Hard negatives from a secondary-sort shuffle.

Blocks of anchors meet blocks of rows and are scored by one matrix product. Every pair is packed into a
key (anchor, place, id), whose place falls as the score rises, and the pairs are dealt out by anchor and
sorted inside their partitions by the whole key. An iterator then reads each anchor's pairs as a stream:
a positive opens a window of scores, the next negatives are given to the windows they lie in, and a
window closes when it is full or the scores have fallen below it. No anchor's pairs are ever held.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.tables import prepared
from marquee.session import materialise

#: Which rows are anchors, and whose label moves on by one of CLASSES.
ANCHOR_STEP, MOVED_STEP, CLASSES = 50, 7, 10
POSITIVES, NEGATIVES = 5, 3
#: A negative's score lies between LOW and HIGH percent of its positive's.
LOW, HIGH = 50, 95
SCALE = 256
#: Rows and anchors of a block; one product has ROWS x ANCHORS scores.
ROWS, ANCHORS = 4096, 512
SHAPE = "rows binary, ids binary, labels binary, width int, vectors binary"
PAIR = "anchor_row bigint, anchor_id bigint, place bigint, id bigint"
RESULT = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"


def taking_part(table: DataFrame) -> DataFrame:
    """(vec_id, label, vector) of the rows that take part, labels moved.

    A row with a null vec_id or label, a null or empty vector, or a null or non-finite component takes none.
    """
    vector = F.transform("embedding", lambda x: x.cast("double"))
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    held = table.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("bigint").alias("label"), vector.alias("vector"))
    held = held.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size("vector") > 0) & ~bad)
    label = F.when(F.col("vec_id") % MOVED_STEP == 0, (F.col("label") + 1) % CLASSES).otherwise(F.col("label"))
    return held.select("vec_id", label.alias("label"), "vector")


def _packed(batches) -> Iterator[pa.RecordBatch]:
    """Blocks of at most ROWS rows; every row gets a number of its own. Shorter vectors end in zeros."""
    lead, given = TaskContext.get().partitionId() << 33, 0
    ids, labels, vectors = [], [], []

    def block():
        nonlocal given, ids, labels, vectors
        width = max(map(len, vectors))
        whole = np.zeros((len(vectors), width))
        for k, vector in enumerate(vectors):
            whole[k, : len(vector)] = vector
        # Beyond this no sum of products would be a 64-bit integer: larger components count as the limit.
        limit = float(math.isqrt((1 << 62) // width))
        whole = np.clip(np.floor(SCALE * whole), -limit, limit).astype(np.int64)
        rows = lead + given + np.arange(len(ids), dtype=np.int64)
        given += len(ids)
        packed = _block(rows, np.array(ids, np.int64), np.array(labels, np.int64), whole)
        ids, labels, vectors = [], [], []
        return packed

    for batch in batches:
        for vec_id, label, vector in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            ids.append(vec_id)
            labels.append(label)
            vectors.append(vector.values.to_numpy(zero_copy_only=False))
            if len(ids) == ROWS:
                yield block()
    if ids:
        yield block()


def _width_of(whole: np.ndarray) -> type:
    return np.int16 if len(whole) == 0 or max(-int(whole.min()), int(whole.max())) < 1 << 15 else np.int64


def _anchors(batches) -> Iterator[pa.RecordBatch]:
    """The anchors among the rows of blocks, one a row."""
    for batch in batches:
        for held in batch.to_pylist():
            rows, ids, labels, vectors = _unpacked(held)
            at = np.flatnonzero(ids % ANCHOR_STEP == 0)
            whole = pa.array([v.tobytes() for v in vectors[at].astype(np.int64)], pa.binary())
            yield pa.record_batch([pa.array(rows[at]), pa.array(ids[at]), pa.array(labels[at]), whole], ["row", "id", "label", "vector"])


def _grouped(batches) -> Iterator[pa.RecordBatch]:
    """Blocks of at most ANCHORS anchors."""
    for batch in batches:
        for first in range(0, batch.num_rows, ANCHORS):
            part = batch.slice(first, ANCHORS)
            vectors = [np.frombuffer(v, np.int64) for v in part.column(3).to_pylist()]
            whole = np.zeros((len(vectors), max(map(len, vectors))), np.int64)
            for k, vector in enumerate(vectors):
                whole[k, : len(vector)] = vector
            yield _block(*(c.to_numpy() for c in part.columns[:3]), whole)


def _block(rows: np.ndarray, ids: np.ndarray, labels: np.ndarray, whole: np.ndarray) -> pa.RecordBatch:
    columns = [rows.tobytes(), ids.tobytes(), labels.tobytes(), whole.shape[1], whole.astype(_width_of(whole)).tobytes()]
    types = [pa.binary(), pa.binary(), pa.binary(), pa.int32(), pa.binary()]
    return pa.record_batch([pa.array([c], t) for c, t in zip(columns, types)], ["rows", "ids", "labels", "width", "vectors"])


def _unpacked(held: dict, prefix: str = "") -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    rows, ids, labels = (np.frombuffer(held[prefix + c], np.int64) for c in ("rows", "ids", "labels"))
    raw, width = held[prefix + "vectors"], held[prefix + "width"]
    kind = np.int16 if len(raw) == 2 * width * len(rows) else np.int64
    return rows, ids, labels, np.frombuffer(raw, kind).reshape(len(rows), width)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of all rows of ``a`` and ``b``, as 64-bit integers."""
    width = min(a.shape[1], b.shape[1])  # the rest of the longer vectors meets zeros
    a, b = a[:, :width], b[:, :width]
    most = [max(-int(x.min(initial=0)), int(x.max(initial=0))) for x in (a, b)]
    if most[0] * most[1] * width < 1 << 53:  # doubles are exact up to here
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


def _scored(batches) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(batch.num_rows):
            pair = batch.slice(k, 1).to_pylist()[0]
            rows, ids, labels, vectors = _unpacked(pair)
            order = np.lexsort((rows, ids))
            rows, ids, labels, vectors = rows[order], ids[order], labels[order], vectors[order]
            anchor_rows, anchor_ids, anchor_labels, anchors = _unpacked(pair, "anchor_")
            scores = products(anchors, vectors)
            found = [useful_pairs(scores[j], ids, rows != anchor_rows[j], labels == anchor_labels[j]) for j in range(len(anchor_ids))]
            sizes = [len(place) for place, _ in found]
            yield pa.record_batch(
                [
                    pa.array(np.repeat(anchor_rows, sizes)),
                    pa.array(np.repeat(anchor_ids, sizes)),
                    pa.array(np.concatenate([place for place, _ in found])),
                    pa.array(np.concatenate([own for _, own in found])),
                ],
                ["anchor_row", "anchor_id", "place", "id"],
            )


def useful_pairs(scores: np.ndarray, ids: np.ndarray, other: np.ndarray, same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, id) of the pairs of one anchor that may matter, given the block's rows in order of id.

    ``place`` is -2 * score, one more for a negative: at one score positives come first. Left out is only
    what cannot be in the result, whatever the other blocks hold: all but the block's first positives;
    negatives under half the last of these, because every positive scores as high; negatives below
    zero, because no window goes there; and of negatives of one score all but the first few.
    """
    positive = np.flatnonzero(other & same)
    if len(positive) > POSITIVES:
        cut = np.partition(scores[positive], len(positive) - POSITIVES)[len(positive) - POSITIVES]
        positive = positive[scores[positive] >= cut]
        positive = positive[np.argsort(-scores[positive], kind="stable")][:POSITIVES]
    least = 0
    if len(positive) == POSITIVES:
        least = max(0, -(-LOW * int(scores[positive].min()) // 100))
    negative = np.flatnonzero(~same & (scores >= least))
    negative = negative[np.argsort(-scores[negative], kind="stable")]
    ranked = scores[negative]
    if len(ranked) > NEGATIVES:
        negative = negative[np.concatenate((np.ones(NEGATIVES, bool), ranked[NEGATIVES:] != ranked[:-NEGATIVES]))]
    place = np.concatenate((-2 * scores[positive], -2 * scores[negative] + 1))
    return place, ids[np.concatenate((positive, negative))]


def _mined(batches) -> Iterator[pa.RecordBatch]:
    """The pairs of a partition in the order of their keys; at most POSITIVES windows are held."""
    current, opened, windows = None, 0, []
    for batch in batches:
        out: list[tuple] = []
        for row, anchor, place, own in zip(*(c.to_pylist() for c in batch.columns)):
            if row != current:
                current, opened, windows = row, 0, []
            if place % 2 == 0:
                if opened < POSITIVES:
                    opened += 1
                    windows.append([own, -place // 2, 0])
                continue
            score = (1 - place) // 2
            closed = False
            for window in windows:
                positive, best, given = window
                if 100 * score < LOW * best:
                    window[2], closed = NEGATIVES, True
                elif 100 * score <= HIGH * best:
                    window[2] = given + 1
                    closed |= given + 1 == NEGATIVES
                    out.append((anchor, positive, given + 1, own, best, score))
            if closed:
                windows = [w for w in windows if w[2] < NEGATIVES]
        if out:
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), _RESULT_TYPES)], _RESULT_NAMES)


_RESULT_TYPES = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
_RESULT_NAMES = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def scored_pairs(table: DataFrame) -> DataFrame:
    """(anchor_row, anchor_id, place, id): the key of every pair of an anchor and a row that may matter."""
    blocks = materialise(taking_part(table).mapInArrow(_packed, SHAPE), "vectors")
    # Anchors are a stated query set. Two tables of blocks meet, a pair of blocks at a time; neither side
    # is collected, and Spark broadcasts the smaller one only below its size threshold.
    anchors = blocks.mapInArrow(_anchors, "row bigint, id bigint, label bigint, vector binary").repartition("row").mapInArrow(_grouped, SHAPE)
    named = anchors.select(*(F.col(c).alias(f"anchor_{c}") for c in blocks.columns))
    return blocks.crossJoin(named).mapInArrow(_scored, PAIR)


def hard_negatives(table: DataFrame) -> DataFrame:
    """For each anchor and each of its positives the first negatives in the positive's window of scores.

    An anchor is a row whose vec_id is divisible by ANCHOR_STEP. Its positives are the first POSITIVES other
    rows of its label, by score and then by vec_id. A row that stands in the table several times counts as
    often, and an anchor leaves out only itself. Rows that take no part: see ``taking_part``. Vectors of
    different length are compared over the shorter one. An empty table has no result. Other columns are
    not read.
    """
    prepared(table.sparkSession)
    pairs = scored_pairs(table)
    # repartitionAndSortWithinPartitions in DataFrame form: rows are dealt out by the anchor and sorted
    # by the whole key inside the shuffle's own, spilling sorter.
    dealt = pairs.repartition("anchor_row").sortWithinPartitions("anchor_row", "place", "id")
    return dealt.mapInArrow(_mined, RESULT)
