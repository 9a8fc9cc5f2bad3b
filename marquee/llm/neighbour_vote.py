"""Quality by a vote of the nearest labelled texts in a latent semantic space.

A text is a bag of terms: the shapes of its words (runs of capitals, small letters and digits count once,
other characters stand for themselves), pairs of neighbouring shapes, words that repeat the word before,
and character trigrams, hashed to rows of a term table. A bounded sample of labelled texts gives the
weights of the terms and, by a truncated singular value decomposition, the latent space. The sample's
latent vectors are broadcast; every document's cosines with all of them come from blocked products, and
its nearest neighbours vote with weights that grow with their similarity.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm import words
from marquee.llm.tables import chunks, id_and_text, prepared

#: The bounded training sample: so many labelled rows, first by a hash of their id. Their texts are read
#: whole, and scoring has no bounds.
TRAINING_ROWS = 5000
#: Rows of the term table for shapes and for trigrams, and dimensions of the latent space.
SHAPES, TRIGRAMS, LATENT = 2048, 1024, 48
#: How much a shape counts beside a trigram.
SHAPE_WEIGHT = 3.0
NEIGHBOURS, SHARPNESS = 15, 8
PREDICTED = 0.3
#: Texts and cosines of a block.
BLOCK_BYTES, BLOCK_ROWS = 2_000_000, 256
SCHEMA = "doc_id bigint, score double, similarity double"
_UPPER, _LOWER, _DIGIT, _SPACE = 1, 2, 3, 32


def training_row(doc_id: Column) -> Column:
    """Labels of rows whose crc32(doc_id as text) mod 5 is 0 are held out."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 != 0


def _classes() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[[*range(0x09, 0x0E), 0x20]] = _SPACE
    table[0x41:0x5B], table[0x61:0x7B], table[0x80:], table[0x30:0x3A] = _UPPER, _LOWER, _LOWER, _DIGIT
    table[[0x00, 0x01, 0x02, 0x03]] = 4
    return table


def term_counts(texts: list[bytes], span_hash: words.SpanHash) -> np.ndarray:
    """Counts of the terms of every text, a row each; shapes first, then trigrams. A text without words has none."""
    out = np.zeros((len(texts), SHAPES + TRIGRAMS), np.float32)
    buffer, begins = words.joined(texts)
    starts, ends = words.runs(words.not_space()[buffer])
    if not len(starts):
        return out
    doc = words.owner(begins, starts)
    exact = span_hash(buffer, starts, ends)

    kinds = _classes()[buffer]
    first = np.ones(len(kinds), bool)
    first[1:] = (kinds[1:] != kinds[:-1]) | (kinds[1:] == _SPACE)
    shapes = kinds[first]
    shape = span_hash(shapes, *words.runs(shapes != _SPACE))
    _count(out, doc, shape % np.uint64(SHAPES))
    pair = (doc[1:] == doc[:-1]) & (len(doc) > 1)
    _count(out, doc[1:][pair], words.mix(shape[:-1][pair] * np.uint64(words.BASE) + shape[1:][pair]) % np.uint64(SHAPES))
    again = pair & (exact[1:] == exact[:-1])
    _count(out, doc[1:][again], np.full(int(again.sum()), 1, np.uint64))

    wide, inside = buffer.astype(np.uint32), words.not_space()[buffer]
    at = np.flatnonzero(inside[:-2] | inside[1:-1] | inside[2:])
    own = words.owner(begins, at)
    whole = at + 2 < begins[own + 1]
    at, own = at[whole], own[whole]
    grams = words.mix((wide[at] << np.uint32(16) | wide[at + 1] << np.uint32(8) | wide[at + 2]).astype(np.uint64))
    _count(out, own, grams % np.uint64(TRIGRAMS) + np.uint64(SHAPES))
    return out


def _count(out: np.ndarray, doc: np.ndarray, term: np.ndarray) -> None:
    width = out.shape[1]
    cell, count = np.unique(doc.astype(np.int64) * width + term.astype(np.int64), return_counts=True)
    out.reshape(-1)[cell] += count


def damped(counts: np.ndarray) -> np.ndarray:
    """Square roots of the shares of the terms, for shapes and trigrams apart, so that length has no say."""
    out = np.sqrt(counts)
    for part, weight in ((out[:, :SHAPES], SHAPE_WEIGHT), (out[:, SHAPES:], 1.0)):
        norm = np.sqrt((part * part).sum(axis=1, keepdims=True))
        part *= weight / np.maximum(norm, 1e-9)
    return out


class Space:
    """Term weights, latent axes, and the labelled vectors in them."""

    def __init__(self, terms: np.ndarray, labels: np.ndarray, latent: int = LATENT):
        seen = (terms > 0).sum(axis=0)
        self.weights = (np.log((1 + len(terms)) / (1 + seen)) + 1).astype(np.float32)
        weighted = terms * self.weights
        latent = min(latent, *weighted.shape)
        # Subspace iteration; the start is fixed, so the same sample gives the same axes.
        axes = np.linalg.qr(np.random.default_rng(7).standard_normal((weighted.shape[1], latent)))[0]
        for _ in range(12):
            axes = np.linalg.qr(weighted.T @ (weighted @ axes))[0]
        self.axes = axes.astype(np.float32)
        self.labels = labels.astype(np.float64)
        self.known = self.latent(terms)
        self.prior = round(float(self.labels.mean()), 6)

    def latent(self, terms: np.ndarray) -> np.ndarray:
        """Unit vectors; zero for a text without terms."""
        found = (terms * self.weights) @ self.axes
        norm = np.sqrt((found * found).sum(axis=1, keepdims=True))
        return np.where(norm > 1e-9, found / np.maximum(norm, 1e-9), 0).astype(np.float32)

    def vote(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Score and greatest cosine of every vector. One without a neighbour above zero has the sample's share."""
        cosines = vectors @ self.known.T
        near = min(NEIGHBOURS, cosines.shape[1])
        at = np.argpartition(-cosines, near - 1, axis=1)[:, :near]
        best = np.maximum(np.take_along_axis(cosines, at, axis=1).astype(np.float64), 0)
        weight = best**SHARPNESS
        total = weight.sum(axis=1)
        score = np.where(total > 0, (weight * self.labels[at]).sum(axis=1) / np.maximum(total, 1e-300), self.prior)
        return np.round(np.clip(score, 0, 1), 6), np.round(best.max(axis=1), 6)  # products differ by block in the last digits


def training_sample(docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS) -> tuple[np.ndarray, np.ndarray]:
    """Terms and labels of at most ``rows`` labelled texts; an id labelled twice counts by its lower label.

    The terms are counted in tasks; what reaches the driver is bounded by the sample.
    """
    prepared(docs.sparkSession)
    known = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & training_row(F.col("doc_id")))
    known = known.groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.min("quality").alias("_label"))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = known.orderBy(*order).limit(rows)
    found = id_and_text(docs).join(F.broadcast(chosen), "doc_id")  # at most ``rows`` rows
    # An id may have several rows of different texts: the first by a hash of the text stands for them.
    kept = found.groupBy("doc_id").agg(F.min(F.struct(F.xxhash64("text"), "text", "_label")).alias("_first"))
    held = kept.select("doc_id", F.col("_first.text").alias("text"), F.col("_first._label").alias("label"))

    def counted(batches) -> Iterator[pa.RecordBatch]:
        span_hash = words.SpanHash()
        for batch in batches:
            label = dict(zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()))
            for ids, texts in chunks([batch], BLOCK_BYTES):
                terms = damped(term_counts(texts, span_hash)).astype(np.float16)
                yield pa.record_batch(
                    [pa.array(ids, pa.int64()), pa.array([label[i] for i in ids], pa.int32()), pa.array([t.tobytes() for t in terms], pa.binary())],
                    ["doc_id", "label", "terms"],
                )

    rows_ = held.mapInArrow(counted, "doc_id bigint, label int, terms binary").orderBy(*order).toArrow()
    width = SHAPES + TRIGRAMS
    terms = np.zeros((rows_.num_rows, width), np.float32)
    for k, own in enumerate(rows_.column(2).to_pylist()):
        terms[k] = np.frombuffer(own, np.float16)
    return terms, rows_.column(1).to_numpy().astype(np.float64)


def train(docs: DataFrame, labels: DataFrame) -> Space | None:
    """The latent space of the sample; None if no text of it has a label."""
    terms, known = training_sample(docs, labels)
    return Space(terms, known) if len(known) else None


def scored(docs: DataFrame, space: Space | None) -> DataFrame:
    """doc_id, score and the nearest labelled text's similarity of every row of ``docs``.

    Null and empty texts, and texts like no labelled one, score the share of label 1 in the sample. Without
    a sample every score is 0. Repeated rows get a row each, equal texts equal scores; a text of any
    length is read whole. An empty table gives no rows; other columns are not read.
    """
    spark = prepared(docs.sparkSession).sparkContext
    shared = spark.broadcast(space)  # TRAINING_ROWS x LATENT numbers and the axes: under 2 MB

    def run(batches) -> Iterator[pa.RecordBatch]:
        held, span_hash = shared.value, words.SpanHash()
        for ids, texts in chunks(batches, BLOCK_BYTES):
            for first in range(0, len(ids), BLOCK_ROWS):
                own, part = ids[first : first + BLOCK_ROWS], texts[first : first + BLOCK_ROWS]
                score, near = np.zeros(len(own)), np.zeros(len(own))
                if held is not None:
                    score, near = held.vote(held.latent(damped(term_counts(part, span_hash))))
                yield pa.record_batch([pa.array(own, pa.int64()), pa.array(score), pa.array(near)], ["doc_id", "score", "similarity"])

    return id_and_text(docs).mapInArrow(run, SCHEMA)
