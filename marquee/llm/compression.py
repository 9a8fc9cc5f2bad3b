"""Toxicity by compression distance.

Two pairs of zstandard dictionaries are trained. The first is for single words: one on the words of
ordinary text, one that also holds the parts of words that toxic text says more often. The second is for
phrases: one on whole ordinary texts, one on whole toxic texts. Every word, and every overlapping window
of SPAN words, is compressed with both dictionaries of its pair; the bytes that the toxic one saves are
its distance. A document's largest distances, and how many pass each threshold, are calibrated to a
probability on labelled rows that trained no dictionary.
"""

from __future__ import annotations

import random
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm import words
from marquee.llm.tables import chunks, id_and_text, prepared

#: The bounded training sample: labelled rows of each class, first by a hash of their id, with texts of
#: at most so many bytes. Half of it trains dictionaries, half calibrates. Scoring has no such bounds.
TOXIC_ROWS, ORDINARY_ROWS, TRAINING_BYTES = 2000, 4000, 1 << 15
#: Strings of so many bytes count as toxic if seen in so many contexts, and so many times as often as in ordinary text.
#: Long ones tell stems apart whose short parts are common, as in letters of two bytes.
GRAMS, MIN_CONTEXTS, RATIO = (5, 6, 7, 8), 5, 6.0
#: TOXIC_BYTES is the least size; more strings make the content larger.
TOXIC_BYTES, ORDINARY_BYTES, LEVEL = 2048, 100_000, 4
#: Windows of several words begin at every STEP-th word; dictionaries of whole texts have TEXT_BYTES.
SPAN, STEP, TEXT_BYTES = 8, 4, 100_000
#: Follows every window: zstandard looks for no match in the last bytes of its input.
TAIL = bytes(range(1, 9)) * 2
THRESHOLDS = (2, 3, 4, 5)
SPAN_THRESHOLDS = (2, 4, 6, 8)
PREDICTED = 0.7
SCHEMA = "doc_id bigint, score double, n_windows bigint, largest bigint"


def training_row(doc_id: Column) -> Column:
    """Labels of rows whose crc32(doc_id as text) mod 3 is 1 are held out."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 != 1


def training_sample(docs: DataFrame, labels: DataFrame) -> list[tuple[bytes, int]]:
    """At most TOXIC_ROWS + ORDINARY_ROWS texts with their label, on the driver."""
    known = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & training_row(F.col("doc_id")))
    known = known.groupBy(F.col("doc_id").cast("bigint").alias("_id")).agg(F.max("toxic").alias("_toxic"))
    order = [F.xxhash64("_id"), F.col("_id")]
    chosen = None
    for label, most in ((1, TOXIC_ROWS), (0, ORDINARY_ROWS)):
        part = known.where(F.col("_toxic") == label).orderBy(*order).limit(most)
        chosen = part if chosen is None else chosen.unionByName(part)
    short = docs.where(F.octet_length("text") <= TRAINING_BYTES).select(F.col("doc_id").cast("bigint").alias("_id"), "text")
    found = short.join(F.broadcast(chosen), "_id").dropDuplicates(["_id"])
    rows = found.orderBy(*order).limit(TOXIC_ROWS + ORDINARY_ROWS).select("text", "_toxic").toArrow()
    return list(zip(rows.column(0).cast("binary").to_pylist(), rows.column(1).to_pylist()))


def lowered(text: bytes) -> bytes:
    return text.translate(words.lower_table().tobytes())


def gram_contexts(texts: list[bytes]) -> tuple[Counter, Counter, int]:
    """In how many different pairs of neighbours every word, and every gram of a word, occurs.

    Copies of a text repeat its contexts, so they add nothing.
    """
    seen: set[tuple[bytes, bytes, bytes]] = set()
    for text in texts:
        parts = lowered(text).split()
        seen.update(zip([b""] + parts[:-1], parts, parts[1:] + [b""]))
    word_counts = Counter(w for _, w, _ in seen)
    grams: Counter = Counter()
    for word, count in word_counts.items():
        for gram in _grams(word):
            grams[gram] += count
    return grams, word_counts, len(seen)


def _placed_grams(word: bytes) -> Iterator[tuple[int, bytes]]:
    """Where every gram of the word, with a blank in front, begins; a short word is a gram itself."""
    lead = b" " + word
    for size in GRAMS:
        for k in range(max(1, len(lead) - size + 1)):
            yield k, lead[k : k + size]


def _grams(word: bytes) -> set[bytes]:
    return {gram for _, gram in _placed_grams(word)}


def telling_part(word: bytes, telling: set[bytes]) -> bytes:
    """The word from where its first telling gram begins to where the last one ends."""
    spans = [(k, k + len(gram)) for k, gram in _placed_grams(word) if gram in telling]
    return (b" " + word)[min(spans)[0] : max(end for _, end in spans)] if spans else b""


def chosen_strings(toxic_texts: list[bytes], plain_texts: list[bytes]) -> tuple[Counter, Counter]:
    """Parts of words that toxic text says more often, and the words of ordinary text, with their counts."""
    toxic, toxic_words, toxic_total = gram_contexts(toxic_texts)
    plain, plain_words, plain_total = gram_contexts(plain_texts)
    telling = {
        g for g, n in toxic.items() if n >= MIN_CONTEXTS and n * plain_total >= RATIO * (plain[g] + 0.5) * toxic_total
    }
    parts = Counter()
    for word, count in toxic_words.items():
        part = telling_part(word, telling)
        if part:
            parts[part] += count
    return parts, plain_words


def train_dictionaries(texts: list[bytes], labels: list[int], seed: int = 1) -> tuple[bytes, bytes]:
    """(ordinary, toxic) dictionaries; the toxic one extends the ordinary one by every chosen string."""
    parts, plain_words = chosen_strings(*([t for t, y in zip(texts, labels) if y == label] for label in (1, 0)))
    draw = random.Random(seed)
    ordinary = [b" " + w for w, n in sorted(plain_words.items()) for _ in range(min(n, 50))]
    special = [p for p, n in sorted(parts.items()) for _ in range(n)]
    draw.shuffle(ordinary)
    draw.shuffle(special)
    base = _trained(ordinary, ORDINARY_BYTES, 64)
    content = _trained(special, max(TOXIC_BYTES, sum(map(len, parts))), 16)
    missing = b"".join(p for p in sorted(parts) if p not in content)
    return base + TAIL, base + missing + content + TAIL


def train_on_texts(texts: list[bytes], labels: list[int]) -> tuple[bytes, bytes]:
    """(ordinary, toxic) dictionaries trained on whole texts; too few to train on are taken whole."""
    out = []
    for label in (0, 1):
        whole = [lowered(t) for t, y in zip(texts, labels) if y == label and t]
        try:
            out.append(zstandard.train_dictionary(TEXT_BYTES, whole, k=64, d=6).as_bytes() + TAIL)
        except zstandard.ZstdError:
            out.append(b" ".join(dict.fromkeys(whole)) + TAIL)
    return out[0], out[1]


def _trained(strings: list[bytes], size: int, segment: int) -> bytes:
    """Content of a dictionary trained on samples of six strings; too little to train on is taken whole."""
    samples = [b"".join(strings[k : k + 6]) for k in range(0, len(strings), 6)]
    try:
        return zstandard.train_dictionary(size, samples, k=segment, d=6).as_bytes()
    except zstandard.ZstdError:
        return b"".join(dict.fromkeys(strings))[-size:]


class Distance:
    """Bytes that the toxic dictionary saves on each window."""

    def __init__(self, ordinary: bytes, toxic: bytes):
        self.pair = [self._compressor(d) for d in (ordinary, toxic)]

    @staticmethod
    def _compressor(content: bytes) -> zstandard.ZstdCompressor:
        held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        settings = zstandard.ZstdCompressionParameters.from_level(
            LEVEL, source_size=32, dict_size=len(content), min_match=4, write_checksum=False, write_content_size=False, write_dict_id=False
        )
        held.precompute_compress(compression_params=settings)
        return zstandard.ZstdCompressor(dict_data=held, compression_params=settings)

    def __call__(self, windows: list[bytes]) -> np.ndarray:
        plain, toxic = (c.compress for c in self.pair)
        return np.array([len(plain(w + TAIL)) - len(toxic(w + TAIL)) for w in windows], np.int64)


def largest_and_passed(values: np.ndarray, counts: np.ndarray, thresholds: tuple, low: int, high: int) -> tuple[np.ndarray, list]:
    """The three largest distances of every text, clipped, and how many pass each threshold."""
    owner = np.repeat(np.arange(len(counts)), counts)
    order = np.lexsort((-values, owner))
    first = np.cumsum(counts) - counts
    ranked = values[order]
    best = np.zeros((len(counts), 3))
    for k in range(3):
        has = counts > k
        best[has, k] = np.clip(ranked[first[has] + k], low, high)
    return best, [np.log1p(np.bincount(owner, values >= t, len(counts))) for t in thresholds]


def features(texts: list[bytes], distance: Distance, phrases: Distance) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of every text, its number of words and the largest distance of a word.

    Words have a blank in front; equal ones are compressed once for all texts.
    """
    parts = [lowered(t).split() for t in texts]
    counts = np.fromiter(map(len, parts), np.int64, len(parts))
    flat = pa.array([w for own in parts for w in own], pa.large_binary()).dictionary_encode()
    saved = distance([b" " + w for w in flat.dictionary.to_pylist()])
    values = saved[flat.indices.to_numpy()] if len(saved) else np.empty(0, np.int64)
    best, passed = largest_and_passed(values, counts, THRESHOLDS, -8, 16)
    largest = np.where(counts > 0, best[:, 0], 0).astype(np.int64)

    spans = [[b" " + b" ".join(own[at : at + SPAN]) for at in range(0, max(1, len(own) - SPAN + STEP), STEP)] if own else [] for own in parts]
    n_spans = np.fromiter(map(len, spans), np.int64, len(spans))
    spared = phrases([w for own in spans for w in own])
    far, many = largest_and_passed(spared, n_spans, SPAN_THRESHOLDS, -16, 40)
    return np.column_stack([best, *passed, far, *many, np.log1p(counts)]), counts, largest


def calibrate(x: np.ndarray, y: np.ndarray, steps: int = 60) -> np.ndarray:
    """Weights of a ridge logistic regression by Newton's method; the last is the intercept."""
    x = np.column_stack([x, np.ones(len(x))])
    weights = np.zeros(x.shape[1])
    ridge = np.full(x.shape[1], 1e-1)
    ridge[-1] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        gradient = x.T @ (p - y) + ridge * weights
        hessian = (x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(hessian, gradient)
        weights -= step
        if np.abs(step).max() < 1e-8:
            break
    return weights


def train(sample: list[tuple[bytes, int]]) -> tuple[bytes, bytes, bytes, bytes, np.ndarray] | None:
    """Dictionaries and calibration; None where a class is missing from either half."""
    halves = [(sample[k::2]) for k in (0, 1)]
    if any(len({y for _, y in half}) < 2 for half in halves):
        return None
    texts, labels = map(list, zip(*halves[0]))
    dictionaries = (*train_dictionaries(texts, labels), *train_on_texts(texts, labels))
    texts, labels = map(list, zip(*halves[1]))
    x, _, _ = features(texts, Distance(*dictionaries[:2]), Distance(*dictionaries[2:]))
    return *dictionaries, calibrate(x, np.array(labels, float))


def scored(docs: DataFrame, model: tuple[bytes, bytes, bytes, bytes, np.ndarray] | None) -> DataFrame:
    """doc_id, score, n_windows and the largest distance of every row of ``docs``.

    Null and empty texts have no windows and the score of the calibration for that. Without a model
    every score is 0. Repeated rows get a row each, equal texts equal scores; a text of any length is
    read whole, an empty table has no result, and other columns are not read.
    """
    prepared(docs.sparkSession)

    def run(batches) -> Iterator[pa.RecordBatch]:
        distance, phrases = (Distance(*model[:2]), Distance(*model[2:4])) if model else (None, None)
        for ids, texts in chunks(batches, 4_000_000):
            if distance is None:
                score, counts, largest = np.zeros(len(ids)), np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64)
            else:
                x, counts, largest = features(texts, distance, phrases)
                score = 1 / (1 + np.exp(-np.clip(np.column_stack([x, np.ones(len(x))]) @ model[4], -30, 30)))
            yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(score), pa.array(counts), pa.array(largest)], ["doc_id", "score", "n_windows", "largest"])

    return id_and_text(docs).mapInArrow(run, SCHEMA)
