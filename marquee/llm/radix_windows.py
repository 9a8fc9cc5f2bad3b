"""Repeated byte windows by a depth-limited radix sort of suffixes.

Suffixes are ordered only through LENGTH bytes, most significant digits first, and a group of one is
done. Digits are long: the first is the GRAM-byte string at the suffix's anchor, the least hashed gram
among its first LENGTH bytes, so one anchor stands for a run of neighbouring suffixes and only anchors
are dealt out. Anchors with the same gram whose whole surroundings are equal need no further pass; the
suffixes of the others are cut into further digits, until a group of equal digits is equal through
LENGTH bytes, which makes its members exactly the repeated windows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm import words
from marquee.llm.tables import prepared, small
from marquee.session import materialise

LENGTH = 200
GRAM = 64
#: Bytes handled at a time; longer texts are cut into pieces that overlap by a window.
PIECE = 1 << 17
#: Suffixes that one row of a further pass stands for, from the first of them to the last.
RUNS = (16, 4, 1)
#: Keys up to which a list of them is broadcast; beyond, the same join shuffles.
SMALL_KEYS = 2_000_000

#: Base and seed of the second hash, of 32 bits, of surroundings and last digits; with the first it makes 96 bits.
SECOND_BASE, SECOND_SEED = 0xD1342543DE82EF95, 13

ANCHORS = "d bigint, t bigint, low bigint, high bigint, anchor bigint, gram bigint, around bigint, check int"


class Rolling:
    """64-bit hashes of arbitrary spans of one buffer of at most ``size`` bytes."""

    def __init__(self, size: int, seed: int = 7, base: int = words.BASE):
        self.values = words.byte_values(seed)
        self.up, self.down = words.powers(base, size), words.powers(pow(base, -1, 1 << 64), size)

    def load(self, buffer: np.ndarray) -> None:
        part = self.values[buffer] * self.up[: len(buffer)]
        self.sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(part, dtype=np.uint64)))

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return words.mix((self.sums[ends] - self.sums[starts]) * self.down[starts])

    def grams(self, n: int) -> np.ndarray:
        return words.mix((self.sums[n:] - self.sums[:-n]) * self.down[: len(self.sums) - n])


def anchors(grams: np.ndarray, window: int) -> np.ndarray:
    """Position of the least gram (by its upper bits, then leftmost) of every ``window`` consecutive ones."""
    bits = np.uint64((1 << 21) - 1)
    least = (grams & ~bits) | np.arange(len(grams), dtype=np.uint64)
    size = 1
    while 2 * size <= window:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if size < window:
        step = window - size
        least = np.minimum(least[:-step], least[step:])
    return (least & bits).astype(np.int64)


def _half(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(32)).astype(np.uint32).view(np.int32)


def second_rolling(size: int) -> Rolling:
    return Rolling(size, SECOND_SEED, SECOND_BASE)


def runs_of(data: np.ndarray, begins: np.ndarray, roll: Rolling, second: Rolling) -> tuple[np.ndarray, ...]:
    """Runs of suffixes with one anchor in the texts of ``data``: (text, first, last, anchor, gram, around, check).

    Text k lies at begins[k] to begins[k + 1], its last byte excluded. Positions are places in ``data``;
    gram is the hash of the anchor's gram, around and check are two of the bytes that the run's suffixes read.
    """
    none = *(np.empty(0, np.int64) for _ in range(6)), np.empty(0, np.int32)
    if len(data) < LENGTH:
        return none
    roll.load(data)
    anchor = anchors(roll.grams(GRAM), LENGTH - GRAM + 1)
    at = np.arange(len(anchor))
    text = np.repeat(np.arange(len(begins) - 1), np.diff(begins))[: len(anchor)]
    whole = at + LENGTH <= begins[text + 1] - 1
    at, anchor, text = at[whole], anchor[whole], text[whole]
    if not len(at):
        return none
    second.load(data)
    first = np.flatnonzero(np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1]))))
    low, high = at[first], at[np.append(first[1:], len(at)) - 1]
    anchor, text = anchor[first], text[first]
    read = low, high + LENGTH
    return text, low, high, anchor, roll(anchor, anchor + GRAM).view(np.int64), roll(*read).view(np.int64), _half(second(*read))


def pieces(texts: list[bytes]) -> Iterator[tuple[np.ndarray, list[bytes], np.ndarray]]:
    """(text numbers, texts, offset of each) of at most about PIECE bytes in all; long texts in overlapping parts."""
    numbers: list[int] = []
    parts: list[bytes] = []
    offsets: list[int] = []
    held = 0
    for number, text in enumerate(texts):
        for begin in range(0, max(1, len(text) - LENGTH + 1), PIECE):
            part = text[begin : begin + PIECE + LENGTH - 1]
            if parts and held + len(part) > PIECE:
                yield np.array(numbers), parts, np.array(offsets)
                numbers, parts, offsets, held = [], [], [], 0
            numbers.append(number)
            parts.append(part)
            offsets.append(begin)
            held += len(part) + 1
    if parts:
        yield np.array(numbers), parts, np.array(offsets)


def _anchored(batches) -> Iterator[pa.RecordBatch]:
    roll, second = Rolling(2 * PIECE + 2 * LENGTH), second_rolling(2 * PIECE + 2 * LENGTH)
    for batch in batches:
        d, t = (batch.column(k).to_numpy() for k in (0, 1))
        for numbers, parts, offsets in pieces([x or b"" for x in batch.column(2).to_pylist()]):
            data, begins = words.joined(parts)
            text, low, high, anchor, gram, around, check = runs_of(data, begins, roll, second)
            if len(text):
                shift = offsets[text] - begins[text]
                own = numbers[text]
                yield pa.record_batch(
                    [d[own], t[own], low + shift, high + shift, anchor + shift, gram, around, check],
                    ["d", "t", "low", "high", "anchor", "gram", "around", "check"],
                )


def unit_hashes(
    buffer: np.ndarray, begins: np.ndarray, at: np.ndarray, gram: np.ndarray, which: np.ndarray, unit: np.ndarray, run: int, rolls: tuple[Rolling, ...]
) -> tuple[np.ndarray, ...]:
    """(representative, unit, digit, ...): for each of ``rolls`` a hash of what the suffixes of each unit share.

    Unit u of a representative holds the suffixes that begin u * run to u * run + run - 1 bytes before its
    anchor; all of them read the bytes from the last's beginning to the first's end. Units that reach
    beyond the representative's bytes, at begins[k] to begins[k + 1], hold none of its suffixes.
    """
    begin = begins[which] + at[which] - unit * run
    end = begin - (run - 1) + LENGTH
    inside = (begin >= begins[which]) & (end <= begins[which + 1])
    which, unit, begin, end = which[inside], unit[inside], begin[inside], end[inside]
    digits = []
    for roll in rolls:
        roll.load(buffer)
        shared = words.mix(roll(begin, end) + unit.astype(np.uint64) * np.uint64(words.BASE))
        digits.append((shared ^ words.mix(gram[which].view(np.uint64))).view(np.int64))
    return which, unit, *digits


def _units(run: int):
    """Task of one pass over rows (rep, gram, at, content, units)."""

    def work(batches) -> Iterator[pa.RecordBatch]:
        rolls = None
        for batch in batches:
            rep, gram, at = (batch.column(k).to_numpy() for k in range(3))
            lists = batch.column(4)
            edges, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
            contents = batch.column(3).to_pylist()
            sizes = np.fromiter(map(len, contents), np.int64, len(contents))
            group = np.cumsum(sizes) // PIECE
            for number in np.unique(group):
                some = np.flatnonzero(group == number)
                first, last = int(some[0]), int(some[-1]) + 1
                begins = np.concatenate(([0], np.cumsum(sizes[first:last])))
                if rolls is None or len(rolls[0].up) < begins[-1]:
                    size = max(2 * PIECE, int(begins[-1]))
                    rolls = Rolling(size), second_rolling(size)
                data = np.frombuffer(b"".join(contents[first:last]), np.uint8)
                counts = np.diff(edges[first : last + 1])
                which = np.repeat(np.arange(last - first), counts)
                unit = flat[edges[first] : edges[last]]
                # Passes before the last only narrow the suffixes: a chance match costs a second look.
                which, unit, digit, *check = unit_hashes(data, begins, at[first:last], gram[first:last], which, unit, run, rolls if run == 1 else rolls[:1])
                checks = [_half(c.view(np.uint64)) for c in check]
                yield pa.record_batch([rep[first:last][which], unit, digit, *checks], ["rep", "unit", "digit", *["check"] * len(check)])

    return work


def _row() -> tuple[Column, Column]:
    """Rows with equal id and text share their number; each of them still counts as a place."""
    return F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-(1 << 63))).alias("d"), F.xxhash64(_text()).alias("t")


def _text() -> Column:
    return F.coalesce(F.col("text"), F.lit(""))


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(d, t, runs, starts): runs (low, high) and single starts of repeated suffixes of every row that has any."""
    prepared(docs.sparkSession)
    scanned = docs.select(*_row(), _text().cast("binary").alias("text"))
    found = scanned.mapInArrow(_anchored, ANCHORS)
    grams = found.groupBy("gram").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1).select("gram")
    grams = materialise(grams, "grams")
    found = materialise(found.join(small(grams, SMALL_KEYS), "gram", "left_semi"), "anchors")

    one = F.min(F.struct("d", "t", "low", "high", "anchor")).alias("first")
    same = ["gram", "around", "check"]
    kinds = found.groupBy(*same).agg(F.count(F.lit(1)).alias("n"), one)
    kinds = materialise(kinds.withColumn("rep", F.monotonically_increasing_id()), "kinds")
    equal = found.join(small(kinds.where(F.col("n") > 1).select(*same), SMALL_KEYS), same, "left_semi")
    equal = equal.select("d", "t", F.struct("low", "high").alias("run"), F.lit(None).cast("array<bigint>").alias("starts"))

    several = kinds.groupBy("gram").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1).select("gram")
    reps = kinds.join(several, "gram").select("rep", "gram", "n", "first.*")
    reps = materialise(_with_content(scanned, reps), "representatives")

    first = RUNS[0]
    back = F.col("anchor") - F.col("low")
    units = F.sequence(F.floor((F.col("anchor") - F.col("high")) / first), F.floor(back / first))
    alive = reps.select("rep", units.alias("units"))
    for k, run in enumerate(RUNS):
        held = reps.join(alive, "rep").select("rep", "gram", F.col("at").alias("at"), "content", "units")
        same = ["digit", "check"] if run == 1 else ["digit"]
        digits = held.mapInArrow(_units(run), "rep bigint, unit bigint, digit bigint" + (", check int" if run == 1 else ""))
        digits = materialise(digits, "digits")
        shared = digits.groupBy(*same).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1).select(*same)
        kept = digits.join(shared, same, "left_semi")
        if run > 1:
            parts = run // RUNS[k + 1]
            kept = kept.select("rep", F.explode(F.sequence(F.col("unit") * parts, F.col("unit") * parts + parts - 1)).alias("unit"))
        alive = kept.groupBy("rep").agg(F.collect_list("unit").alias("units"))  # at most LENGTH of them

    single = reps.where(F.col("n") == 1).join(alive, "rep")
    starts = F.transform("units", lambda u: F.col("anchor") - u).alias("starts")
    spans = equal.unionByName(single.select("d", "t", F.lit(None).cast(equal.schema["run"].dataType).alias("run"), starts))
    of_text = spans.groupBy("d", "t").agg(F.collect_list("run").alias("runs"), F.flatten(F.collect_list("starts")).alias("starts"))
    return materialise(of_text, "spans")


def _with_content(scanned: DataFrame, reps: DataFrame) -> DataFrame:
    """Representatives with the bytes that their suffixes read, and where the anchor lies in them."""
    of_row = reps.groupBy("d", "t").agg(F.collect_list(F.struct("rep", "gram", "n", "low", "high", "anchor")).alias("held"))
    of_row = materialise(of_row, "wanted")
    rows = small(of_row.select("d", "t"), SMALL_KEYS)
    texts = scanned.join(rows, ["d", "t"], "left_semi").dropDuplicates(["d", "t"])
    both = texts.join(of_row, ["d", "t"]).select("d", "t", "text", F.explode("held").alias("h"))
    content = F.substring(F.col("text"), (F.col("h.low") + 1).cast("int"), (F.col("h.high") - F.col("h.low") + LENGTH).cast("int"))
    return both.select("d", "t", "h.rep", "h.gram", "h.n", "h.low", "h.high", "h.anchor", (F.col("h.anchor") - F.col("h.low")).alias("at"), content.alias("content"))


def _cut(batches) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, runs, starts = batch.column(1).to_pylist(), batch.column(2), batch.column(3)
        low, high = (runs.values.field(k).to_numpy() for k in range(2))
        single = starts.values.to_numpy()
        run_edges, start_edges = runs.offsets.to_numpy(), starts.offsets.to_numpy()
        kept, spans = [], []
        for k, text in enumerate(texts):
            own, alone = slice(run_edges[k], run_edges[k + 1]), slice(start_edges[k], start_edges[k + 1])
            size = len(text) + 1
            edge = np.bincount(low[own], minlength=size) + np.bincount(single[alone], minlength=size)
            edge -= np.bincount(high[own] + LENGTH, minlength=size) + np.bincount(single[alone] + LENGTH, minlength=size)
            gone = np.cumsum(edge[:-1]) > 0
            kept.append(np.frombuffer(text, np.uint8).take(np.flatnonzero(~gone)).tobytes())
            begins, ends = words.runs(gone)
            spans.append([{"begin": int(a), "end": int(b)} for a, b in zip(begins, ends)])
        kind = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
        sizes = pa.array([len(t) for t in texts], pa.int64())
        yield pa.record_batch([batch.column(0), sizes, pa.array(spans, kind), pa.array(kept, pa.binary())], ["doc_id", "n_bytes", "spans", "kept"])


CUT = "doc_id bigint, n_bytes bigint, spans array<struct<begin: bigint, end: bigint>>, kept binary"


def without_repeats(docs: DataFrame) -> DataFrame:
    """One row for every row of ``docs``: doc_id, n_bytes, removed spans, and the bytes that are kept.

    Each byte inside a LENGTH-byte string that also starts elsewhere, in this row or another, goes. A
    null text is empty; texts shorter than LENGTH stay whole; rows that share id and text are places of
    their own, so they lose all their windows. Texts of any length are cut whole, in overlapping pieces; an
    empty table has no result; other columns are not read.
    """
    spans = repeated_spans(docs)
    scanned = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), *_row(), _text().cast("binary").alias("text"))
    rows = small(spans.select("d", "t"), SMALL_KEYS)
    hit = scanned.join(rows, ["d", "t"], "left_semi").join(spans, ["d", "t"]).select("doc_id", "text", "runs", "starts").mapInArrow(_cut, CUT)
    none = F.array().cast("array<struct<begin: bigint, end: bigint>>")
    clean = scanned.join(rows, ["d", "t"], "left_anti")
    clean = clean.select("doc_id", F.octet_length("text").cast("bigint").alias("n_bytes"), none.alias("spans"), F.col("text").alias("kept"))
    return hit.unionByName(clean)
