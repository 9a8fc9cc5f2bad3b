"""Hierarchical multi-length packing of tokenised documents.

Each task packs blocks of its own documents, so nothing is shuffled. In a block, documents are cut into
whole windows of the longest context; every rest goes to the shortest context that holds it. From the
longest context down, a rest opens a window and its gap is filled with the longest fitting rests of
shorter contexts, the last one cut to fit. Every window is full, save one in each block. Sequences are
then dealt to step groups of equal token counts.
"""

from __future__ import annotations

import heapq
from bisect import bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from marquee.llm.tables import chunks, id_and_text, prepared
from marquee.llm.tokens import ENCODED_BYTES, encoder, with_end

END_ID = 1
CONTEXTS = (256, 512, 1024, 2048)
#: Tokens that one task packs together, and tokens of a step group.
BLOCK_TOKENS = 1 << 22
STEP_TOKENS = 1 << 15

SCHEMA = (
    "doc_id bigint, start bigint, length bigint, doc_tokens bigint, sequence_id bigint, offset bigint, "
    "context int, step_group bigint, ids binary"
)

Piece = tuple[int, int, int]  # length, document, start


def pack(sizes: list[int], contexts: tuple[int, ...] = CONTEXTS) -> list[tuple[int, list[Piece]]]:
    """Sequences (context, pieces) that hold every token of documents of the given sizes exactly once."""
    longest = contexts[-1]
    done: list[tuple[int, list[Piece]]] = []
    rests: list[Piece] = []
    for doc, size in enumerate(sizes):
        whole = size - size % longest
        done += ((longest, [(longest, doc, at)]) for at in range(0, whole, longest))
        if size > whole:
            rests.append((size - whole, doc, whole))
    rests.sort()
    for k in range(len(contexts) - 1, -1, -1):
        context, below = contexts[k], contexts[k - 1] if k else 0
        while rests and rests[-1][0] > below:
            window = [rests.pop()]
            gap = context - window[0][0]
            if gap < 0:  # left over from a longer context
                length, doc, start = window[0]
                window = [(context, doc, start)]
                insort(rests, (length - context, doc, start + context))
                gap = 0
            while gap and rests:
                fit = bisect_right(rests, (gap, len(sizes), 0)) - 1
                length, doc, start = rests.pop(max(fit, 0))
                if length > gap:
                    insort(rests, (length - gap, doc, start + gap))
                    length = gap
                window.append((length, doc, start))
                gap -= length
            if gap and k:  # nothing is left to fill it: go on with shorter contexts
                for piece in window:
                    insort(rests, piece)
                break
            done.append((longest if gap else context, window))
    return done


def step_groups(lengths: list[int], step_tokens: int = STEP_TOKENS) -> list[int]:
    """A group for every sequence; groups get about equally many tokens, long sequences dealt first."""
    groups = max(1, round(sum(lengths) / step_tokens))
    loads = [(0, g) for g in range(groups)]
    out = [0] * len(lengths)
    for k in sorted(range(len(lengths)), key=lambda k: -lengths[k]):
        load, group = loads[0]
        heapq.heapreplace(loads, (load + lengths[k], group))
        out[k] = group
    return out


def packed(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID) -> DataFrame:
    """One row per piece: where it lies in its document and in its sequence, and its ids (uint32, little-endian).

    A null or empty text is the end id alone. Ties in length are broken by the order of reading; repeated
    rows are packed like any others; an empty table gives no rows; other columns are not read.
    ``context`` is the length the sequence is padded to, if it isn't full.
    """
    prepared(docs.sparkSession)

    def blocks(batches) -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
        encode = encoder(tokenizer_path)
        keys: list = []
        parts: list[np.ndarray] = []
        sizes: list[np.ndarray] = []
        held = 0
        for ids, texts in chunks(batches, ENCODED_BYTES):
            flat, counts = encode([t.decode() for t in texts])
            parts.append(with_end(flat, counts, end_id))
            sizes.append(counts + 1)
            keys += ids
            held += len(parts[-1])
            if held >= BLOCK_TOKENS:
                yield keys, np.concatenate(parts), np.concatenate(sizes)
                keys, parts, sizes, held = [], [], [], 0
        if keys:
            yield keys, np.concatenate(parts), np.concatenate(sizes)

    def run(batches) -> Iterator[pa.RecordBatch]:
        first_sequence = first_group = TaskContext.get().partitionId() << 39
        for keys, flat, sizes in blocks(batches):
            begins = (np.cumsum(sizes) - sizes).tolist()
            counts = sizes.tolist()
            sequences = pack(counts)
            groups = step_groups([sum(p[0] for p in pieces) for _, pieces in sequences])
            rows = []
            for number, ((context, pieces), group) in enumerate(zip(sequences, groups)):
                offset = 0
                for length, doc, start in pieces:
                    at = begins[doc] + start
                    rows.append((keys[doc], start, length, counts[doc], first_sequence + number, offset, context, first_group + group, flat[at : at + length].astype("<u4").tobytes()))
                    offset += length
                if len(rows) >= 4096:
                    yield _batch(rows)
                    rows = []
            if rows:
                yield _batch(rows)
            first_sequence += len(sequences)
            first_group += max(groups) + 1

    return id_and_text(docs).mapInArrow(run, SCHEMA)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows))
    kinds = [pa.int64()] * 6 + [pa.int32(), pa.int64(), pa.binary()]
    names = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "context", "step_group", "ids"]
    return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names)
