"""Token ids in wavelet matrices, one per shard.

A shard file holds whole documents: bit planes of their ids, from the highest bit down, each plane the
stable partition of the one above by its bit, with sampled ranks. Access, rank, select and counting work
on the planes. Shards are rows of a Parquet table, so any store holds them and retries replace them.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marquee.llm.tables import chunks, id_and_text, prepared, small
from marquee.llm.tokens import ENCODED_BYTES, encoder, with_end
from marquee.session import scratch_path

END_ID = 2
LEVELS = 16
SHARD_TOKENS = 1 << 20
BLOCK_WORDS = 8  # 64-bit words between two sampled ranks
MAGIC = b"WMX1"
#: Shards up to which the table of their starts is broadcast.
SMALL_SHARDS = 500_000

SHARD_SCHEMA = "part bigint, shard bigint, n_docs bigint, n_tokens bigint, payload binary"


class WaveletMatrix:
    """Succinct sequence of integers below 2 ** levels."""

    def __init__(self, n: int, planes: list[np.ndarray], zeros: list[int], samples: list[np.ndarray]):
        self.n, self.planes, self.zeros, self.samples = n, planes, zeros, samples

    @classmethod
    def of(cls, values: np.ndarray, levels: int = LEVELS) -> "WaveletMatrix":
        planes, zeros, samples = [], [], []
        kind = np.uint16 if levels <= 16 else np.uint32
        current = values.astype(kind)
        for level in range(levels - 1, -1, -1):
            ones = (current & kind(1 << level)) != 0
            planes.append(cls._words(ones))
            samples.append(cls._sampled(planes[-1]))
            low, high = np.flatnonzero(~ones), np.flatnonzero(ones)
            zeros.append(len(low))
            current = np.concatenate((current.take(low), current.take(high)))
        return cls(len(values), planes, zeros, samples)

    @staticmethod
    def _words(ones: np.ndarray) -> np.ndarray:
        size = 64 * BLOCK_WORDS
        packed = np.packbits(np.concatenate((ones, np.zeros(-len(ones) % size + size, bool))), bitorder="little")
        return packed.view("<u8")

    @staticmethod
    def _sampled(words: np.ndarray) -> np.ndarray:
        """Ones in front of each block."""
        counts = np.bitwise_count(words.reshape(-1, BLOCK_WORDS)).sum(axis=1, dtype=np.int64)
        return (np.cumsum(counts) - counts).astype("<u4")

    def _ones_before(self, level: int, at: np.ndarray) -> np.ndarray:
        """Ones of the plane in front of the positions."""
        words, block = self.planes[level], at // (64 * BLOCK_WORDS)
        total = self.samples[level][block].astype(np.int64)
        rest = at - block * 64 * BLOCK_WORDS
        for k in range(BLOCK_WORDS):
            word = words[block * BLOCK_WORDS + k]
            bits = np.clip(rest - 64 * k, 0, 64)
            kept = np.where(bits == 64, word, word & ((np.uint64(1) << (bits % 64).astype(np.uint64)) - np.uint64(1)))
            total += np.bitwise_count(kept)
        return total

    def _bit(self, level: int, at: np.ndarray) -> np.ndarray:
        return (self.planes[level][at // 64] >> (at % 64).astype(np.uint64)) & np.uint64(1) == 1

    def access(self, at) -> np.ndarray:
        """The values at the positions."""
        at = np.atleast_1d(np.asarray(at, np.int64))
        out = np.zeros(len(at), np.uint32)
        for level in range(len(self.planes)):
            one = self._bit(level, at)
            ones = self._ones_before(level, at)
            out = (out << np.uint32(1)) | one
            at = np.where(one, self.zeros[level] + ones, at - ones)
        return out

    def _range(self, value: int, low: int, high: int) -> tuple[int, int]:
        for level in range(len(self.planes)):
            ones = self._ones_before(level, np.array([low, high]))
            if value >> (len(self.planes) - 1 - level) & 1:
                low, high = (int(self.zeros[level] + x) for x in ones)
            else:
                low, high = int(low - ones[0]), int(high - ones[1])
        return low, high

    def rank(self, value: int, high: int, low: int = 0) -> int:
        """Occurrences of the value in positions low to high, high excluded."""
        first, last = self._range(value, low, high)
        return last - first

    def count(self, value: int) -> int:
        return self.rank(value, self.n)

    def _select_bit(self, level: int, bit: int, k: np.ndarray) -> np.ndarray:
        """Positions of the k-th (from 0) ones or zeros of the plane."""
        samples = self.samples[level].astype(np.int64)
        if not bit:
            samples = np.arange(len(samples)) * 64 * BLOCK_WORDS - samples
        block = np.searchsorted(samples, k, side="right") - 1
        out = np.empty(len(k), np.int64)
        for j in range(len(k)):
            words = self.planes[level][block[j] * BLOCK_WORDS : (block[j] + 1) * BLOCK_WORDS]
            bits = np.unpackbits(words.view(np.uint8), bitorder="little")
            out[j] = block[j] * 64 * BLOCK_WORDS + np.flatnonzero(bits == bit)[k[j] - samples[block[j]]]
        return out

    def occurrences(self, value: int, low: int = 0, high: int | None = None) -> np.ndarray:
        """Ascending positions of the value from the low-th occurrence on, high excluded."""
        first, last = self._range(value, 0, self.n)
        at = np.arange(first + low, last if high is None else min(last, first + high))
        for level in range(len(self.planes) - 1, -1, -1):
            if value >> (len(self.planes) - 1 - level) & 1:
                at = self._select_bit(level, 1, at - self.zeros[level])
            else:
                at = self._select_bit(level, 0, at)
        return at

    def values(self) -> np.ndarray:
        """The whole sequence, undoing the partitions from the lowest plane up."""
        kind = np.uint16 if len(self.planes) <= 16 else np.uint32
        current = np.zeros(self.n, kind)
        for k, level in enumerate(range(len(self.planes) - 1, -1, -1)):
            ones = np.unpackbits(self.planes[level].view(np.uint8), count=self.n, bitorder="little").astype(bool)
            above = np.empty(self.n, kind)
            above[np.flatnonzero(~ones)] = current[: self.zeros[level]]
            above[np.flatnonzero(ones)] = current[self.zeros[level] :] | kind(1 << k)
            current = above
        return current


def to_bytes(matrix: WaveletMatrix, doc_ids: list, sizes: np.ndarray) -> bytes:
    """The shard file: header, documents and their sizes, then each plane with its samples, compressed."""
    press = zstandard.ZstdCompressor(level=1)
    known = np.array([x is not None for x in doc_ids], np.uint8)
    ids = np.array([x or 0 for x in doc_ids], "<i8")
    parts = [ids.tobytes(), known.tobytes(), sizes.astype("<i8").tobytes()]
    for words, samples in zip(matrix.planes, matrix.samples):
        parts += [words.tobytes(), samples.tobytes()]
    packed = [press.compress(p) for p in parts]
    head = struct.pack("<4sHQQ", MAGIC, len(matrix.planes), matrix.n, len(doc_ids))
    head += struct.pack(f"<{len(matrix.zeros)}Q{len(packed)}Q", *matrix.zeros, *map(len, packed))
    return head + b"".join(packed)


def from_bytes(data: bytes) -> tuple[WaveletMatrix, list, np.ndarray]:
    magic, levels, n, _ = struct.unpack_from("<4sHQQ", data)
    if magic != MAGIC:
        raise ValueError("not a shard file")
    at = struct.calcsize("<4sHQQ")
    zeros = struct.unpack_from(f"<{levels}Q", data, at)
    lengths = struct.unpack_from(f"<{2 * levels + 3}Q", data, at + 8 * levels)
    at += 8 * (3 * levels + 3)
    press, parts = zstandard.ZstdDecompressor(), []
    for length in lengths:
        parts.append(press.decompress(data[at : at + length]))
        at += length
    known = np.frombuffer(parts[1], np.uint8)
    ids = [int(i) if k else None for i, k in zip(np.frombuffer(parts[0], "<i8"), known)]
    planes = [np.frombuffer(p, "<u8") for p in parts[3::2]]
    samples = [np.frombuffer(p, "<u4") for p in parts[4::2]]
    return WaveletMatrix(n, planes, list(zeros), samples), ids, np.frombuffer(parts[2], "<i8")


def shards(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID) -> DataFrame:
    """Shard rows in ascending order of doc_id. A null text is empty; a null doc_id comes first; rows
    that share a doc_id are ordered by text; an empty table gives no shards; other columns are not read."""
    prepared(docs.sparkSession)

    def run(batches) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer_path, False)
        part = TaskContext.get().partitionId()
        keys: list = []
        flats: list[np.ndarray] = []
        sizes: list[np.ndarray] = []
        held = number = 0

        def shard() -> pa.RecordBatch:
            values, counts = np.concatenate(flats), np.concatenate(sizes)
            payload = to_bytes(WaveletMatrix.of(values), keys, counts)
            return pa.record_batch(
                [pa.array([x], k) for x, k in ((part, pa.int64()), (number, pa.int64()), (len(keys), pa.int64()), (len(values), pa.int64()), (payload, pa.binary()))],
                ["part", "shard", "n_docs", "n_tokens", "payload"],
            )

        for ids, texts in chunks(batches, ENCODED_BYTES):
            flat, counts = encode([t.decode() for t in texts])
            flats.append(with_end(flat, counts, end_id))
            sizes.append(counts + 1)
            keys += ids
            held += len(flats[-1])
            if held >= SHARD_TOKENS:
                yield shard()
                keys, flats, sizes, held, number = [], [], [], 0, number + 1
        if keys:
            yield shard()

    ordered = id_and_text(docs).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return ordered.mapInArrow(run, SHARD_SCHEMA)


def write(docs: DataFrame, tokenizer_path: str, path: str | None = None) -> str:
    path = path or scratch_path(docs.sparkSession, "wavelet")
    shards(docs, tokenizer_path).write.parquet(path)
    return path


def decoded(spark: SparkSession, path: str) -> DataFrame:
    """Every document of the shard files: part, shard, doc_id, local start, n_tokens, ids (uint32, little-endian)."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                part, shard, payload = (batch.column(k)[row].as_py() for k in range(3))
                matrix, ids, sizes = from_bytes(payload)
                flat = matrix.values().astype("<u4")
                ends = np.cumsum(sizes)
                for first in range(0, len(ids), 512):
                    some = slice(first, first + 512)
                    yield pa.record_batch(
                        [
                            pa.array([part] * len(ids[some]), pa.int64()),
                            pa.array([shard] * len(ids[some]), pa.int64()),
                            pa.array(ids[some], pa.int64()),
                            pa.array((ends - sizes)[some]),
                            pa.array(sizes[some]),
                            pa.array([flat[b - n : b].tobytes() for b, n in zip(ends[some], sizes[some])], pa.binary()),
                        ],
                        ["part", "shard", "doc_id", "local", "n_tokens", "ids"],
                    )

    files = spark.read.schema(SHARD_SCHEMA).parquet(path).select("part", "shard", "payload")
    return files.mapInArrow(run, "part bigint, shard bigint, doc_id bigint, local bigint, n_tokens bigint, ids binary")


def placed(found: DataFrame, path: str) -> DataFrame:
    """Rows of ``decoded``, or what was made of them, with the start of each document among all ids."""
    files = found.sparkSession.read.schema(SHARD_SCHEMA).parquet(path)
    both = found.join(small(shard_starts(files), SMALL_SHARDS), ["part", "shard"])
    return both.withColumn("start", F.col("shard_start") + F.col("local")).drop("part", "shard", "local", "shard_start")


def shard_starts(files: DataFrame) -> DataFrame:
    """Ids in front of each shard. The window without a key runs over one row per partition written."""
    inside = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = files.groupBy("part").agg(F.sum("n_tokens").alias("_n"))
    parts = parts.select("part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    local = files.select("part", "shard", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)).alias("_inside"))
    return local.join(parts, "part").select("part", "shard", (F.col("_before") + F.col("_inside")).alias("shard_start"))
