"""Quality rules by repetition coverage.

Rolling hashes of several n-gram lengths find the words that lie in windows seen before in the same
text; the rules bound the share of characters in such windows and in repeated lines.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm import words
from marquee.llm.tables import chunks, id_and_text, prepared, release_memory

#: The published repetition limits of web-text rule sets, as shares of the characters in words.
GRAM_LIMITS = {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}
LINE_LIMIT = 0.20
#: The base rule.
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
BASE_GRAM = 3
SYMBOLS = b"#*$%&|<>"

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
SHARES = ["dup_line_chars", *(f"dup_{n}gram_chars" for n in GRAM_LIMITS)]
SCHEMA = "doc_id bigint, " + ", ".join(f"{c} bigint" for c in COUNTS + SHARES)


def measure(texts: list[bytes], span_hash: words.SpanHash) -> dict[str, np.ndarray]:
    """The counts of every text. Equality of words, windows and lines is equality of 64-bit hashes."""
    buffer, begins = words.joined(texts)
    n = len(texts)

    def per_text(owner: np.ndarray, weight: np.ndarray | None = None) -> np.ndarray:
        return np.bincount(owner, weight, n).astype(np.int64)

    is_word = words.not_space()[buffer]
    leads = np.concatenate(([0], np.cumsum((buffer & 0xC0) != 0x80)))
    starts, ends = words.runs(is_word)
    doc = words.owner(begins, starts)
    size = leads[ends] - leads[starts]
    out = {"n_words": per_text(doc), "word_chars": per_text(doc, size)}

    symbol = np.zeros(256, bool)
    symbol[list(SYMBOLS)] = True
    out["n_symbols"] = per_text(words.owner(begins, np.flatnonzero(symbol[buffer])))

    line_starts, line_ends = words.runs(buffer != 0x0A)
    line_doc = words.owner(begins, line_starts)
    worded = np.concatenate(([0], np.cumsum(is_word)))
    full = worded[line_ends] > worded[line_starts]
    keys = span_hash(buffer, line_starts, line_ends) ^ words.mix(line_doc.astype(np.uint64))
    _, again = words.repeated(keys[full])
    out["n_dup_lines"] = per_text(line_doc[full][again])
    word_leads = np.concatenate(([0], np.cumsum(is_word & ((buffer & 0xC0) != 0x80))))
    line_size = (word_leads[line_ends] - word_leads[line_starts])[full][again]
    out["dup_line_chars"] = per_text(line_doc[full][again], line_size)

    hashes = span_hash(buffer, starts, ends)
    grams, at = words.gram_hashes(hashes, doc, BASE_GRAM)
    seen, _ = words.repeated(grams)
    out["n_repeat_words"] = per_text(doc[words.covered(at[seen], BASE_GRAM, len(starts))])

    # A repeated longer window consists of repeated shorter ones, so each length looks at what is left.
    alive = np.zeros(len(starts) + max(GRAM_LIMITS), bool)
    alive[at[seen]] = True
    for length in GRAM_LIMITS:
        grams, at = _grams_at(hashes, doc, length, alive)
        seen, later = words.repeated(grams)
        alive = np.zeros_like(alive)
        alive[at[seen]] = True
        inside = words.covered(at[later], length, len(starts))
        out[f"dup_{length}gram_chars"] = per_text(doc[inside], size[inside])
    return out


def _grams_at(hashes, doc, n, alive):
    """As words.gram_hashes, for windows whose first word is alive."""
    at = np.flatnonzero(alive[: max(0, len(hashes) - n + 1)])
    at = at[doc[at] == doc[at + n - 1]]
    total = np.zeros(len(at), np.uint64)
    for k in range(n):
        total = total * np.uint64(words.BASE) + hashes[at + k]
    return words.mix(total + doc[at].astype(np.uint64) * np.uint64(0xA24BAED4963EE407)), at


def _measured(batches) -> Iterator[pa.RecordBatch]:
    span_hash = words.SpanHash()
    for ids, texts in chunks(batches):
        found = measure(texts, span_hash)
        yield pa.record_batch([pa.array(ids, pa.int64()), *(pa.array(found[c]) for c in COUNTS + SHARES)], ["doc_id", *COUNTS, *SHARES])


def repetition(docs: DataFrame) -> DataFrame:
    """Counts of every document: words, symbols, repeated lines and windows, and the characters they cover.

    A null or empty text has no words and counts of zero. Rows are kept apart: a repeated doc_id gives
    a row each time, equal texts equal counts. A text of any length is measured whole, an empty table
    has no result. Other columns of ``docs`` are not read.
    """
    prepared(docs.sparkSession)
    return id_and_text(docs).mapInArrow(_measured, SCHEMA)


def judged(docs: DataFrame) -> DataFrame:
    """``repetition`` with base_failed and kept. A text without words fails the base rule."""
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    good = F.col("dup_line_chars") <= LINE_LIMIT * F.col("word_chars")
    for n, limit in GRAM_LIMITS.items():
        good &= F.col(f"dup_{n}gram_chars") <= limit * F.col("word_chars")
    return repetition(docs).withColumn("base_failed", base).withColumn("kept", ~F.col("base_failed") & good)


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns.

    The verdict is taken inside the row's own task, so nothing is shuffled, repeated ids do not
    multiply rows, and extra columns of any name pass through.
    """
    prepared(docs.sparkSession)
    position = docs.columns.index("text")
    types = docs.schema

    def passing(batches):
        release_memory()
        span_hash = words.SpanHash()
        for batch in batches:
            texts = [t or b"" for t in batch.column(position).cast("binary").to_pylist()]
            first = 0
            while first < len(texts):  # bounded arrays, whole documents
                last, held = first, 0
                while last < len(texts) and (last == first or held < 2_000_000):
                    held += len(texts[last])
                    last += 1
                yield batch.slice(first, last - first).filter(pa.array(verdict(measure(texts[first:last], span_hash))))
                first = last

    return docs.mapInArrow(passing, types)


def verdict(found: dict[str, np.ndarray]) -> np.ndarray:
    """kept, from the counts of ``measure``."""
    good = (found["n_words"] >= MIN_WORDS) & (100 * found["n_repeat_words"] <= MAX_REPEAT_PERCENT * found["n_words"])
    good &= found["dup_line_chars"] <= LINE_LIMIT * found["word_chars"]
    for n, limit in GRAM_LIMITS.items():
        good &= found[f"dup_{n}gram_chars"] <= limit * found["word_chars"]
    return good
