"""Masked pseudo-likelihood scores from a bidirectional window network.

Every word is predicted from its two neighbours on either side by a one-layer network trained with
numpy: each task trains on all its documents, parameters are averaged by Spark after each epoch. The
network predicts the word's class; inside its class a word has its share of the corpus count. The sum of
the conditional log-probabilities over all positions scores a document.

Whole words are counted by 64-bit keys. 2 ** BITS hash buckets are the index from words to classes and
context rows, whose numbers grow with the square root of the number of distinct words. Tasks hold the most
frequent word of each bucket; the counts of all others stay in a written table that is joined by key.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm import words
from marquee.llm.tables import chunks, id_and_text, prepared
from marquee.session import materialise

BITS = 16
#: Least rows of the context tables (0 stands for "no word here"), least classes; units, and words on either side.
CONTEXTS, CLASSES, UNITS, SIDE = 512, 64, 16, 2
EPOCHS, BATCH, RATE = 1, 2048, 0.1
STEP = 128  # words of a batch whose scores are held at once
FIXED = 1 << 20


@dataclass
class Vocabulary:
    context: np.ndarray  # bucket -> row of the context tables
    word_class: np.ndarray  # bucket -> class
    inside: np.ndarray  # bucket -> log of its share of its class
    prior: np.ndarray  # class -> log of its share of the corpus
    contexts: int  # rows of the context tables
    lead: np.ndarray  # bucket -> key of its most frequent word
    lead_share: np.ndarray  # bucket -> log of that word's share of the bucket
    totals: np.ndarray  # bucket -> count
    words: DataFrame | None = None  # key, n and log share of the bucket of all other words; stays on the driver

    def __getstate__(self) -> dict:
        return self.__dict__ | {"words": None}


def sizes(n_words: int) -> tuple[int, int]:
    """Context rows and classes for so many distinct words."""
    return max(CONTEXTS, 2 * isqrt(n_words)), max(CLASSES, isqrt(n_words) // 4)


def vocabulary(words_table: DataFrame) -> Vocabulary:
    """Rows, classes and shares from the counts (bucket, key, n) of all words; bucket counts are smoothed by one.

    The most frequent buckets have a context row, and a class, of their own; the others share the rest.
    """
    each = words_table.groupBy("bucket").agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("n_words"), F.max(F.struct("n", "key")).alias("lead")
    )
    each = materialise(each.select("bucket", "n", "n_words", F.col("lead.n").alias("lead_n"), F.col("lead.key").alias("lead")), "buckets")
    found = each.toArrow()
    at = found.column(0).to_numpy()
    counts, lead_n = np.zeros(1 << BITS, np.int64), np.zeros(1 << BITS, np.int64)
    lead = np.zeros(1 << BITS, np.int64)
    counts[at], lead_n[at], lead[at] = (found.column(k).to_numpy() for k in (1, 3, 4))
    contexts, classes = sizes(int(found.column(2).to_numpy().sum()))
    own_contexts, own_classes = contexts - contexts // 8, classes * 3 // 4

    total = counts + 1.0
    order = np.lexsort((np.arange(len(counts)), -counts))
    rank = np.empty(len(counts), np.int64)
    rank[order] = np.arange(len(counts))
    spread = words.mix(np.arange(len(counts), dtype=np.uint64)).astype(np.int64) & 0xFFFF
    context = np.where(rank < own_contexts, 1 + rank, 1 + own_contexts + spread % (contexts - 1 - own_contexts))
    word_class = np.where(rank < own_classes, rank, own_classes + spread % (classes - own_classes))
    mass = np.bincount(word_class, total, classes)
    others = words_table.join(F.broadcast(each.select("bucket", F.col("n").alias("total"), "lead")), "bucket")
    others = others.where(F.col("key") != F.col("lead")).select("key", F.log(F.col("n") / F.col("total")).alias("share"))
    return Vocabulary(
        context.astype(np.int32),
        word_class.astype(np.int32),
        np.log(total / mass[word_class]).astype(np.float32),
        np.log(mass / mass.sum()),
        contexts,
        lead.view(np.uint64),
        np.log(np.maximum(lead_n, 1) / np.maximum(counts, 1)),
        counts,
        materialise(others, "words"),
    )


class Network:
    """tanh(sum of a context row for each neighbour) times output weights, softmax over classes."""

    def __init__(self, prior: np.ndarray, contexts: int = CONTEXTS):
        draw = np.random.default_rng(1)
        self.tables = (draw.standard_normal((2 * SIDE * contexts, UNITS)) * 0.1).astype(np.float32)
        self.out = (draw.standard_normal((UNITS, len(prior))) * 0.1).astype(np.float32)
        self.bias = prior.astype(np.float32)

    def parameters(self) -> list[np.ndarray]:
        return [self.tables, self.out, self.bias]

    def flat(self) -> np.ndarray:
        return np.concatenate([p.reshape(-1) for p in self.parameters()])

    def load(self, flat: np.ndarray) -> "Network":
        at = 0
        for p in self.parameters():
            p[...] = flat[at : at + p.size].reshape(p.shape)
            at += p.size
        return self

    def inputs(self, rows: np.ndarray) -> np.ndarray:
        """Units of each word and a last column of ones, which meets the bias; rows has a table row for each neighbour."""
        units = np.ones((len(rows), UNITS + 1), np.float32)
        sums = self.tables.take(rows[:, 0], axis=0)
        for k in range(1, rows.shape[1]):
            sums += self.tables.take(rows[:, k], axis=0)
        np.tanh(sums, out=units[:, :-1])
        return units

    def head(self) -> tuple[np.ndarray, bool]:
        """Output weights above the bias, and whether the bias is less the most any score can be: units lie
        between -1 and 1, so one such factor for all words is safe unless the scores may lie too far apart."""
        reach = np.abs(self.out).sum(axis=0)
        top = (self.bias + reach).max()
        near = bool(top - (self.bias - reach).min() <= 80)
        return np.concatenate((self.out, (self.bias - top if near else self.bias)[None])), near

    @staticmethod
    def exponents(units: np.ndarray, head: tuple[np.ndarray, bool]) -> tuple[np.ndarray, np.ndarray]:
        """Class probabilities times a factor of each word, and their sums."""
        weights, near = head
        scores = units @ weights
        if not near:  # one factor for all words would lose the small ones
            scores -= scores.max(axis=1, keepdims=True)
        np.exp(scores, out=scores)
        return scores, scores @ np.ones(scores.shape[1], scores.dtype)

    def forward(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Units and class probabilities."""
        units = self.inputs(rows)
        scores, sums = self.exponents(units, self.head())
        scores /= sums[:, None]
        return units[:, :-1], scores

    def chances(self, rows: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Probability of the target class of each word."""
        units, head = self.inputs(rows), self.head()
        found = np.empty(len(rows), np.float32)
        for at in range(0, len(rows), STEP):
            scores, sums = self.exponents(units[at : at + STEP], head)
            found[at : at + STEP] = scores[np.arange(len(scores)), target[at : at + STEP]] / sums
        return found

    def touched_gradients(self, rows: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """Table rows in use, and the gradients of those rows, the output weights and the bias.

        The scores of STEP words at a time stay in the processor's cache. They are not made probabilities: the
        factor of each word goes to the few units on the other side of the product.
        """
        units, head = self.inputs(rows), self.head()
        total, turned = np.zeros_like(head[0]), np.ascontiguousarray(self.out.T)
        back = np.empty((len(rows), UNITS), np.float32)
        for at in range(0, len(rows), STEP):
            some = units[at : at + STEP]
            error, sums = self.exponents(some, head)
            error[np.arange(len(error)), target[at : at + STEP]] -= sums
            factor = (1 / (sums * len(target)))[:, None]
            back[at : at + STEP] = (error @ turned) * factor
            total += (some * factor).T @ error
        back *= 1 - units[:, :-1] * units[:, :-1]
        place = rows.T.reshape(-1)
        order = np.argsort(place.astype(np.uint16) if len(self.tables) <= 1 << 16 else place, kind="stable")
        ranked = place[order]
        first = np.flatnonzero(np.concatenate(([True], ranked[1:] != ranked[:-1])))
        tables = np.add.reduceat(back.take(order % len(target), axis=0), first, axis=0)
        return ranked[first], [tables, total[:-1], total[-1]]

    def gradients(self, rows: np.ndarray, target: np.ndarray) -> list[np.ndarray]:
        at, (some, out, bias) = self.touched_gradients(rows, target)
        tables = np.zeros_like(self.tables)
        tables[at] = some
        return [tables, out, bias]


def neighbours(context: np.ndarray, owner: np.ndarray, contexts: int = CONTEXTS) -> np.ndarray:
    """Table rows of the words SIDE places to the left and right, 0 beyond the document."""
    n = len(context)
    out = np.empty((n, 2 * SIDE), np.int32)
    for k, shift in enumerate([*range(-SIDE, 0), *range(1, SIDE + 1)]):
        at = np.arange(n) + shift
        inside = (at >= 0) & (at < n)
        at = np.clip(at, 0, max(0, n - 1))
        inside &= owner[at] == owner
        out[:, k] = np.where(inside, context[at], 0) + k * contexts
    return out


def _tokenised(batches) -> Iterator[pa.RecordBatch]:
    span_hash = words.SpanHash()
    for ids, texts in chunks(batches):
        buffer, begins = words.joined(texts)
        buffer = words.lower_table()[buffer]
        starts, ends = words.runs(words.letters_and_digits()[buffer])
        keys = span_hash(buffer, starts, ends).astype("<u8")
        tokens = (keys >> np.uint64(64 - BITS)).astype("<u2")
        edges = np.searchsorted(starts, begins)
        yield pa.record_batch(
            [pa.array(ids, pa.int64()), *(pa.array([x[a:b].tobytes() for a, b in zip(edges, edges[1:])], pa.binary()) for x in (tokens, keys))],
            ["doc_id", "tokens", "keys"],
        )


def tokenised(docs: DataFrame) -> DataFrame:
    """doc_id, the hash buckets of the words (uint16) and their keys (uint64, little-endian), written to the shared folder."""
    prepared(docs.sparkSession)
    return materialise(id_and_text(docs).mapInArrow(_tokenised, "doc_id bigint, tokens binary, keys binary"), "tokens")


def _groups(batches, size: int, kind: str = "<u2") -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
    """(ids, buckets or keys, owner) of whole documents, about ``size`` words at a time; first column id, second words."""
    ids: list = []
    parts: list[np.ndarray] = []
    held = 0
    for batch in batches:
        for key, tokens in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            ids.append(key)
            parts.append(np.frombuffer(tokens, kind))
            held += len(parts[-1]) + 16
            if held >= size:
                yield ids, np.concatenate(parts), np.repeat(np.arange(len(ids)), [len(p) for p in parts])
                ids, parts, held = [], [], 0
    if ids:
        yield ids, np.concatenate(parts), np.repeat(np.arange(len(ids)), [len(p) for p in parts])


def word_counts(tokens: DataFrame) -> DataFrame:
    """(bucket, key, n) of every distinct word of the corpus, written to the shared folder."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        for _, keys, _ in _groups(batches, 1 << 20, "<u8"):
            some, n = np.unique(keys, return_counts=True)
            yield pa.record_batch([pa.array(some.view(np.int64)), pa.array(n.astype(np.int64))], ["key", "n"])

    found = tokens.select("doc_id", "keys").mapInArrow(run, "key bigint, n bigint").groupBy("key").agg(F.sum("n").alias("n"))
    return materialise(found.select(F.shiftrightunsigned("key", 64 - BITS).cast("int").alias("bucket"), "key", "n"), "word-counts")


def bucket_counts(tokens: DataFrame) -> np.ndarray:
    """Occurrences of every bucket in the whole corpus: 2 ** BITS numbers, whatever its size."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << BITS, np.int64)
        for _, buckets, _ in _groups(batches, 1 << 19):
            total += np.bincount(buckets, minlength=1 << BITS)
        seen = np.flatnonzero(total)
        yield pa.record_batch([pa.array(seen), pa.array(total[seen])], ["bucket", "n"])

    found = tokens.select("doc_id", "tokens").mapInArrow(run, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(1 << BITS, np.int64)
    out[found.column(0).to_numpy()] = found.column(1).to_numpy()
    return out


def train(tokens: DataFrame, epochs: int = EPOCHS) -> tuple[Vocabulary, np.ndarray]:
    """Vocabulary and network parameters. Averages are sums of fixed-point numbers, so they do not
    depend on the order in which tasks end; an empty corpus leaves the network at its start."""
    vocab = vocabulary(word_counts(tokens))
    flat = Network(vocab.prior, vocab.contexts).flat()
    for _ in range(epochs):

        def run(batches, flat=flat) -> Iterator[pa.RecordBatch]:
            network = Network(vocab.prior, vocab.contexts).load(flat)
            squares = [np.full_like(p, 1e-4) for p in network.parameters()]
            seen = 0
            for _, buckets, owner in _groups(batches, 1 << 18):
                rows, target = neighbours(vocab.context[buckets], owner, vocab.contexts), vocab.word_class[buckets]
                for at in range(0, len(buckets), BATCH):
                    some = slice(at, at + BATCH)
                    used, gradients = network.touched_gradients(rows[some], target[some])
                    for p, g, s, place in zip(network.parameters(), gradients, squares, (used, ..., ...)):
                        s[place] += g * g
                        p[place] -= RATE * g / np.sqrt(s[place])
                seen += len(buckets)
            weight = seen + 1023 >> 10
            if weight:
                fixed = np.round(network.flat().astype(np.float64) * FIXED).astype(np.int64) * weight
                yield pa.record_batch([pa.array(np.arange(len(fixed) + 1)), pa.array(np.append(fixed, weight))], ["place", "total"])

        sums = tokens.select("doc_id", "tokens").mapInArrow(run, "place bigint, total bigint").groupBy("place").agg(F.sum("total").alias("total")).toArrow()
        if sums.num_rows:
            totals = np.zeros(len(flat) + 1, np.int64)
            totals[sums.column(0).to_numpy()] = sums.column(1).to_numpy()
            flat = (totals[:-1] / totals[-1] / FIXED).astype(np.float32)
    return vocab, flat


def scored(tokens: DataFrame, model: tuple[Vocabulary, np.ndarray]) -> DataFrame:
    """doc_id, n_words, log_likelihood (sum over all words) of every row. Texts without words score 0.

    A word that training has not seen counts as one more in its bucket. Sums over the words that are
    joined are in fixed point, so they do not depend on task order.
    """
    vocab, flat = model

    def run(batches) -> Iterator[pa.RecordBatch]:
        network = Network(vocab.prior, vocab.contexts).load(flat)
        for ids, keys, owner in _groups(batches, 1 << 18, "<u8"):
            buckets = (keys >> np.uint64(64 - BITS)).astype(np.int64)
            rows, target = neighbours(vocab.context[buckets], owner, vocab.contexts), vocab.word_class[buckets]
            led = (vocab.lead[buckets] == keys) & (vocab.totals[buckets] > 0)
            logs = vocab.inside[buckets] + np.where(led, vocab.lead_share[buckets], 0.0)
            for at in range(0, len(buckets), BATCH):
                some = slice(at, at + BATCH)
                logs[some] += np.log(network.chances(rows[some], target[some]) + 1e-12)
            edges = np.concatenate(([0], np.cumsum(np.bincount(owner[~led], minlength=len(ids)))))
            yield pa.record_batch(
                [
                    pa.array(ids, pa.int64()),
                    pa.array(np.bincount(owner, minlength=len(ids)).astype(np.int64)),
                    pa.array(np.bincount(owner, logs, len(ids)).astype(np.float64)),
                    pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), pa.array(keys[~led].view(np.int64))),
                    pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), pa.array(-np.log(vocab.totals[buckets[~led]] + 1.0))),
                ],
                ["doc_id", "n_words", "log_likelihood", "others", "unseen"],
            )

    schema = "doc_id bigint, n_words bigint, log_likelihood double, others array<bigint>, unseen array<double>"
    found = tokens.select("doc_id", "keys").mapInArrow(run, schema).withColumn("row", F.monotonically_increasing_id())
    found = materialise(found, "part-scores")
    each = found.select("row", F.explode(F.arrays_zip("others", "unseen")).alias("word")).select("row", F.col("word.others").alias("key"), "word.unseen")
    share = F.round(F.coalesce("share", "unseen") * FIXED).cast("bigint")
    joined = each.join(vocab.words, "key", "left").groupBy("row").agg((F.sum(share) / FIXED).alias("rest"))
    total = F.col("log_likelihood") + F.coalesce("rest", F.lit(0.0))
    return found.join(joined, "row", "left").select("doc_id", "n_words", total.alias("log_likelihood"))


def pseudo_likelihood(docs: DataFrame) -> DataFrame:
    """Scores of every row of ``docs`` under a network trained on all of them.

    A null text is empty; repeated rows get a row each and count as often; other columns are not read.
    """
    tokens = tokenised(docs)
    return scored(tokens, train(tokens))
