"""Near-duplicate classes by BagMinHash over multisets of word shingles.

Every shingle runs Poisson processes over its weight axis, cut into strips of doubling width; a point
counts for texts whose weight reaches its height, and each signature register keeps its earliest point.
Registers of two texts agree with the probability of their weighted Jaccard similarity. Bands of
registers propose links, which the texts' multisets verify; classes are the connected components.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm import words
from marquee.llm.tables import chunks, id_and_text, prepared, release_memory
from marquee.session import materialise

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 32, 5
REGISTERS = BANDS * ROWS
#: Links are tried when so many registers agree: the threshold less four standard errors.
AGREE = int(REGISTERS * (SIMILARITY - 4 * (SIMILARITY * (1 - SIMILARITY) / REGISTERS) ** 0.5))
#: Bands whose buckets are tried in turn: first by a star around one member, where one round links most of
#: a large class, then every pair that is still apart.
ROUNDS = ((0, 1, "star"), (1, BANDS, "star"), (0, BANDS, "open"))
#: Members of a bucket that are compared with as many others at a time.
BLOCK = 64

SIGNATURE_SCHEMA = "doc_id bigint, text_key binary, n_shingles bigint, bands array<bigint>, signature binary"


def shingles(texts: list[bytes], span_hash: words.SpanHash) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, shingle hash, weight) of all distinct shingles. A text of fewer words than a
    shingle, but not none, is one shingle."""
    buffer, begins = words.joined(texts)
    buffer = words.lower_table()[buffer]
    starts, ends = words.runs(words.letters_and_digits()[buffer])
    doc = words.owner(begins, starts)
    hashes = span_hash(buffer, starts, ends)
    counts = np.bincount(doc, minlength=len(texts))
    first = np.cumsum(counts) - counts
    at = np.flatnonzero(doc[: max(0, len(doc) - SHINGLE + 1)] == doc[SHINGLE - 1 :]) if len(doc) >= SHINGLE else np.empty(0, np.int64)
    total = np.zeros(len(at), np.uint64)
    for k in range(SHINGLE):
        total = total * np.uint64(words.BASE) + hashes[at + k]
    owners, values = [doc[at]], [words.mix(total)]
    short = np.flatnonzero((counts > 0) & (counts < SHINGLE))
    if len(short):
        own = np.zeros(len(short), np.uint64)
        for k in range(SHINGLE - 1):
            has = counts[short] > k
            word = hashes[np.minimum(first[short] + k, len(hashes) - 1)]
            own = np.where(has, own * np.uint64(words.BASE) + word + np.uint64(1), own)
        owners.append(short)
        values.append(words.mix(own))
    owner, value = np.concatenate(owners), np.concatenate(values)
    order = np.lexsort((value, owner))
    owner, value = owner[order], value[order]
    new = np.flatnonzero(np.concatenate(([True], (owner[1:] != owner[:-1]) | (value[1:] != value[:-1])))) if len(owner) else np.empty(0, np.int64)
    weight = np.diff(np.append(new, len(owner)))
    return owner[new], value[new], weight


def signatures(n: int, owner: np.ndarray, value: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """BagMinHash signatures (n x REGISTERS, uint64 names of the earliest points; 0 where there is none)."""
    m = REGISTERS
    earliest = np.full(n * m, np.inf)
    name = np.zeros(n * m, np.uint64)
    strips = np.ceil(np.log2(np.maximum(weight, 1))).astype(np.int64)
    which = np.repeat(np.arange(len(owner)), strips + 1)
    strip = np.arange(len(which)) - np.repeat(np.cumsum(strips + 1) - strips - 1, strips + 1)
    text, top = owner[which], weight[which]
    key = words.mix(value[which] ^ words.mix(strip.astype(np.uint64) + np.uint64(0x51ED27)))
    width = np.where(strip > 0, 1 << np.maximum(strip - 1, 0), 1)
    floor = np.where(strip > 0, width, 0)
    time = np.zeros(len(which))
    step = 0
    while len(key):
        step += 1
        draw = words.mix(key + np.uint64(step * words.BASE % (1 << 64)))
        more = words.mix(draw ^ np.uint64(0x2545F4914F6CDD1D))
        uniform = ((draw >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53
        time = time - np.log(uniform) / (m * width)
        height = floor + 1 + ((more >> np.uint64(32)) % width.astype(np.uint64)).astype(np.int64)
        place = text * m + ((more & np.uint64(0xFFFFFFFF)) * np.uint64(m) >> np.uint64(32)).astype(np.int64)
        counts = height <= top
        np.minimum.at(earliest, place[counts], time[counts])
        won = counts & (time == earliest[place])
        name[place[won]] = draw[won]
        latest = earliest.reshape(n, m).max(axis=1)
        alive = time < latest[text]
        key, text, top, width, floor, time = (x[alive] for x in (key, text, top, width, floor, time))
    return name.reshape(n, m)


def _signed(batches) -> Iterator[pa.RecordBatch]:
    release_memory()
    span_hash = words.SpanHash()
    for ids, texts in chunks(batches):
        owner, value, weight = shingles(texts, span_hash)
        names = signatures(len(texts), owner, value, weight)
        size = np.bincount(owner, weight, len(texts)).astype(np.int64)
        bands = np.zeros((len(texts), BANDS), np.uint64)
        for k in range(ROWS):
            bands = words.mix(bands * np.uint64(words.BASE) + names.reshape(len(texts), BANDS, ROWS)[:, :, k])
        offsets = np.concatenate(([0], np.cumsum(np.where(size > 0, BANDS, 0)))).astype(np.int32)
        listed = pa.ListArray.from_arrays(offsets, pa.array(bands[size > 0].reshape(-1).view(np.int64)))
        short = (names >> np.uint64(56)).astype(np.uint8)
        yield pa.record_batch(
            [
                pa.array(ids, pa.int64()),
                pa.array([hashlib.md5(t).digest() for t in texts], pa.binary()),
                pa.array(size),
                listed,
                pa.array([s.tobytes() for s in short], pa.binary()),
            ],
            ["doc_id", "text_key", "n_shingles", "bands", "signature"],
        )


def signed(docs: DataFrame) -> DataFrame:
    prepared(docs.sparkSession)
    return id_and_text(docs).mapInArrow(_signed, SIGNATURE_SCHEMA)


def overlap(value: np.ndarray, weight: np.ndarray, one: slice, two: slice) -> float:
    """Weighted Jaccard similarity of two texts' shingles, each ascending."""
    _, left, right = np.intersect1d(value[one], value[two], assume_unique=True, return_indices=True)
    both = int(np.minimum(weight[one][left], weight[two][right]).sum())
    return both / max(1, int(weight[one].sum() + weight[two].sum()) - both)


def similarity(a: bytes, b: bytes, span_hash: words.SpanHash) -> float:
    owner, value, weight = shingles([a, b], span_hash)
    split = int(np.searchsorted(owner, 1))
    return overlap(value, weight, slice(0, split), slice(split, len(owner)))


def star_links(buckets: DataFrame, texts: DataFrame) -> DataFrame:
    """Links of members (band, hash, node, weight, label) to the member of their bucket that shares most
    buckets with others, where labels differ and the texts reach SIMILARITY."""
    centers = buckets.groupBy("band", "hash").agg(
        F.max(F.struct("weight", "node", "label")).alias("center"), F.min("label").alias("low"), F.max("label").alias("high")
    )
    centers = centers.where(F.col("low") < F.col("high")).select("band", "hash", F.col("center.node").alias("a"), F.col("center.label").alias("_label"))
    found = buckets.join(centers, ["band", "hash"]).where(F.col("label") != F.col("_label"))
    pairs = found.select("a", F.col("node").alias("b")).distinct()

    def run(batches) -> Iterator[pa.RecordBatch]:
        span_hash = words.SpanHash()
        for batch in batches:
            a, b = (batch.column(k).to_pylist() for k in (2, 3))
            yield batch.select(["a", "b"]).filter(pa.array([similarity(x, y, span_hash) >= SIMILARITY for x, y in zip(a, b)], pa.bool_()))

    left = texts.select(F.col("node").alias("a"), F.col("text").cast("binary").alias("text_a"))
    right = texts.select(F.col("node").alias("b"), F.col("text").cast("binary").alias("text_b"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")
    return both.mapInArrow(run, "a bigint, b bigint")


def components(links: DataFrame) -> DataFrame:
    """(node, label) of every node in links (a, b); label is the component's smallest node.

    Labels fall along links and then along labels until none changes; every pass is a written table.
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both = materialise(both, "links")
    labels = materialise(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("label")), "labels")
    while True:
        seen = both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("label").alias("near"))
        lower = labels.join(seen, F.col("node") == F.col("a")).select("node", "label", F.least("label", "near").alias("next"))
        up = labels.select(F.col("node").alias("next"), F.col("label").alias("jump"))
        fresh = lower.join(up, "next").select("node", F.least("next", "jump").alias("label"), (F.least("next", "jump") < F.col("label")).alias("fell"))
        fresh = materialise(fresh, "labels")
        labels = fresh.select("node", "label")
        if not fresh.where("fell").limit(1).count():
            return labels


def open_links(buckets: DataFrame, nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """Links between all members of a bucket whose labels differ and whose texts reach SIMILARITY.

    Buckets are cut into blocks and two blocks meet in one row. There a pair is tried in its first common
    band only, if sizes and signatures allow the threshold, and only links leave the task.
    """
    mixed = buckets.groupBy("band", "hash").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count(F.lit(1)).alias("size"))
    mixed = mixed.where(F.col("low") < F.col("high")).withColumn("blocks", F.ceil(F.col("size") / BLOCK).cast("int"))
    held = buckets.join(mixed.select("band", "hash", "blocks"), ["band", "hash"])
    held = held.join(nodes.select("node", "n_shingles", "signature", "bands"), "node").join(texts, "node")
    held = held.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    member = F.struct("node", "label", "n_shingles", "signature", "bands", F.col("text").cast("binary").alias("text"))
    blocks = held.groupBy("band", "hash", "blocks", "block").agg(F.collect_list(member).alias("members"))  # about BLOCK of them
    blocks = materialise(blocks, "blocks")
    left = blocks.withColumn("other", F.explode(F.sequence(F.col("block"), F.col("blocks") - 1)))
    right = blocks.select("band", "hash", F.col("block").alias("other"), F.col("members").alias("others"))
    met = left.join(right, ["band", "hash", "other"])
    met = met.select("band", "members", F.when(F.col("block") != F.col("other"), F.col("others")).alias("others"))

    def run(batches) -> Iterator[pa.RecordBatch]:
        release_memory()
        span_hash = words.SpanHash()
        for batch in batches:
            for row in range(batch.num_rows):
                band, one, two = (batch.column(k)[row].as_py() for k in range(3))
                links = block_links(one, two, band, span_hash)
                if links:
                    yield pa.record_batch([pa.array(x, pa.int64()) for x in zip(*links)], ["a", "b"])

    return met.mapInArrow(run, "a bigint, b bigint")


def block_links(one: list[dict], two: list[dict] | None, band: int, span_hash: words.SpanHash) -> list[tuple[int, int]]:
    """Links between two blocks, or inside one; a pair that earlier links have joined is not tried again."""
    members = one + (two or [])
    node, label, size, bands = (np.array([x[c] for x in members]) for c in ("node", "label", "n_shingles", "bands"))
    signature = np.frombuffer(b"".join(x["signature"] for x in members), np.uint8).reshape(-1, REGISTERS)
    places = np.arange(len(members))
    edges = value = weight = None
    group = label.copy()
    links = []
    for k in range(len(one)):
        at = places[len(one) :] if two else places[k + 1 :]
        at = at[(group[at] != group[k]) & (np.minimum(size[at], size[k]) >= SIMILARITY * np.maximum(size[at], size[k]))]
        at = at[(signature[at] == signature[k]).sum(axis=1) >= AGREE]
        at = at[(bands[at] == bands[k]).argmax(axis=1) == band]
        if len(at) and edges is None:
            owner, value, weight = shingles([x["text"] for x in members], span_hash)
            edges = np.searchsorted(owner, np.arange(len(members) + 1))
        for j in at:
            if group[j] != group[k] and overlap(value, weight, slice(edges[k], edges[k + 1]), slice(edges[j], edges[j + 1])) >= SIMILARITY:
                links.append((int(node[k]), int(node[j])))
                group[group == group[j]] = group[k]
    return links


def joined_labels(labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """Labels (node, label) after links (a, b) between nodes; only the components that a link touches move."""
    if labels is None:
        return components(links)
    of_a, of_b = (labels.select(F.col("node").alias(c), F.col("label").alias(f"label_{c}")) for c in "ab")
    raised = links.join(of_a, "a", "left").join(of_b, "b", "left")
    step = components(raised.select(F.coalesce("label_a", "a").alias("a"), F.coalesce("label_b", "b").alias("b")).distinct())
    moved = labels.join(step.select(F.col("node").alias("label"), F.col("label").alias("next")), "label", "left")
    moved = moved.select("node", F.coalesce("next", "label").alias("label"))
    return materialise(moved.unionByName(step.join(labels, "node", "left_anti")), "labels")


def classes(docs: DataFrame) -> DataFrame:
    """One row for every row of ``docs``: doc_id, class_id (smallest doc_id of its class), text_key, class_key.

    Classes of different texts may share their smallest doc_id; class_key, the first text key of the
    class, tells them apart. Rows with equal texts share a class, empty and null ones among them, and each repeated row has a row. Texts without words have no
    shingles and meet only their equals. A class whose ids are all null has a null class_id.
    Texts of any length are compared whole; an empty table has no classes; other columns are not read.
    """
    return labelled_rows(docs).select("doc_id", "class_id", "text_key", "class_key")


def labelled_rows(docs: DataFrame) -> DataFrame:
    """As classes, with the label of the component, which is one for each class whatever its ids."""
    found = materialise(signed(docs), "signatures")
    nodes = found.groupBy("text_key").agg(
        F.min("doc_id").alias("first_id"),
        F.first("n_shingles").alias("n_shingles"),
        F.first("bands").alias("bands"),
        F.first("signature").alias("signature"),
    )
    nodes = materialise(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    every = nodes.select("node", F.posexplode("bands").alias("band", "hash"))
    shared = every.groupBy("band", "hash").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > 1)
    buckets = materialise(every.join(shared, ["band", "hash"]), "buckets")
    weights = buckets.groupBy("node").agg(F.sum("size").alias("weight"))
    buckets = materialise(buckets.drop("size").join(weights, "node"), "buckets")

    candidates = buckets.select("node").distinct().join(nodes.select("node", "text_key"), "node")
    keyed = docs.select(F.unhex(F.md5(F.coalesce(F.col("text"), F.lit("")))).alias("text_key"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    texts = keyed.join(candidates, "text_key").groupBy("node").agg(F.first("text").alias("text"))
    texts = materialise(texts, "texts")

    labels = None
    labelled = buckets.withColumn("label", F.col("node"))
    for first, last, propose in ROUNDS:
        some = labelled.where((F.col("band") >= first) & (F.col("band") < last))
        links = star_links(some, texts) if propose == "star" else open_links(some, nodes, texts)
        labels = joined_labels(labels, materialise(links, "links"))
        labelled = buckets.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))

    named = nodes.select("node", "text_key", "first_id").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    ids = named.groupBy("label").agg(F.min("first_id").alias("class_id"), F.min(F.hex("text_key")).alias("class_key"))
    named = named.join(ids, "label").select("text_key", "class_id", "class_key", "label")
    return found.select("doc_id", "text_key").join(named, "text_key").select("doc_id", "class_id", "text_key", "class_key", "label")


def one_of_each_label(docs: DataFrame) -> DataFrame:
    """One row of ``docs``, all columns, for each class: that of the smallest doc_id (null last), then of
    the first text key. Classes that share their smallest id, or have none, keep a row each."""
    def rank(key: Column) -> list[Column]:
        return [F.col("doc_id").isNull().alias("_none"), F.coalesce("doc_id", F.lit(0)).cast("bigint").alias("_id"), key.alias("_key")]

    best = labelled_rows(docs).groupBy("label").agg(F.min(F.struct(*rank(F.hex("text_key")))).alias("best")).select("best.*")
    own = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_doc"),
        *rank(F.upper(F.md5(F.coalesce(F.col("text"), F.lit(""))))),
    )
    kept = own.join(best, ["_none", "_id", "_key"], "left_semi").dropDuplicates(["_none", "_id", "_key"])
    return kept.select(*(F.col("_doc").getField(c).alias(c) for c in docs.columns))
