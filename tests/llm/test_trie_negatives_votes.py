import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from marquee.llm import hard_negatives, neighbour_vote, prefix_trie
from marquee.llm.words import SpanHash

TURNS = "conv_id bigint, turn bigint, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute_trie(rows):
    original = {}
    for c, turn, role, text in rows:
        if c is not None:
            original.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    original = {c: [t[2:] for t in sorted(own)] for c, own in original.items()}
    paths = {}
    for c, own in original.items():
        h = zlib.crc32(str(c).encode()) % 4
        paths[c] = original.get(c - c % 20, [])[:h] + own[h:]
    members = {}
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members.setdefault(tuple(path[:d]), []).append(c)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    out = []
    for node, own in members.items():
        below = [n for n in members if n[: len(node)] == node]
        words = lambda n: len(re.findall(r"[^\x20\x09-\x0D]+", n[-1][1])) if n else 0
        ends = ",".join(str(c) for c in sorted(own) if len(paths[c]) == len(node))
        out.append((
            min(own), len(node), min(members[node[:-1]]) if node else None, len(own), len(children.get(node, [])),
            sum(n not in children for n in below), sum((len(members[n]) - 1) * words(n) for n in below), hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=repr)


def found_trie(spark, rows, parts=3):
    table = spark.createDataFrame(rows, TURNS).repartition(parts)
    return sorted((tuple(r) for r in prefix_trie.prefix_trie(table).select(*COLUMNS).collect()), key=repr)


def test_trie_against_brute_force(spark):
    draw = random.Random(3)
    rows = []
    for c in [*range(0, 45), 100, 107, 2000, 2001, 9000, -3]:
        for k in range(draw.choice((1, 2, 3, 5, 9))):
            rows.append((c, k, draw.choice(("user", "bot")), draw.choice(("a b", "a  b c", "", "d\te"))))
    rows += [(60 + k, 0, "user", "the same") for k in range(5)] + [(60 + k, 1, "bot", "again") for k in range(5)]
    assert found_trie(spark, rows) == brute_trie(rows)


def test_trie_nulls_ties_and_repeats(spark):
    rows = [(0, None, None, "x"), (0, 1, "user", None), (0, 1, "user", None), (0, 1, "bot", "y z"), (None, 0, "user", "lost"),
            (1, None, "", "x"), (1, None, "", "x"), (2, 5, None, None), (3, 7, "user", "w " * 40_000), (21, 0, "user", "no opening")]
    assert found_trie(spark, rows) == brute_trie(rows)
    assert found_trie(spark, []) == []


def test_trie_of_a_long_conversation(spark):
    rows = [(5, k, "user", f"turn {k}") for k in range(3000)] + [(4, k, "user", f"turn {k}") for k in range(1500)]
    found = {(r[0], r[1]): r for r in found_trie(spark, rows)}
    h = {c: zlib.crc32(str(c).encode()) % 4 for c in (4, 5)}
    assert len(found) == sum(n - h[c] for c, n in ((4, 1500), (5, 3000))) + 1 or h[4] == h[5]  # one shared path if both drop as many
    last = found[min(c for c in (4, 5) if 3000 - h[5] == max(d for _, d in found)), 3000 - h[5]] if (4, 3000 - h[5]) in found else found[5, 3000 - h[5]]
    assert last[5] == 1 and last[6] == 0 and last[7] == hashlib.sha256(b"5").hexdigest()


def test_many_conversations_end_at_one_node(spark):
    ids = [k * 20 for k in range(9000)]  # over forty runs of ids
    table = spark.createDataFrame([(c, "u", "t") for c in ids], "conv_id bigint, role string, text string").withColumn("turn", F.lit(0).cast("bigint"))
    found = {r.depth: r for r in prefix_trie.prefix_trie(table).collect()}
    # Every id heads its own block, so all keep their only turn.
    assert len(found) == 2 and found[1].n_convs == 9000 and found[1].n_children == 0 and found[0].n_leaves == 1
    assert found[1].saved_tokens == found[0].saved_tokens == 8999
    assert found[1].ends_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    assert found[0].ends_sha256 == hashlib.sha256(b"").hexdigest()


@pytest.mark.parametrize("shape", ["chain", "star", "random", "broom", "single"])
def test_contraction_of_any_tree(spark, shape):
    draw = random.Random(shape)
    n = 1 if shape == "single" else 400
    up = {"chain": lambda k: k - 1, "star": lambda k: 0, "random": lambda k: draw.randrange(k), "broom": lambda k: k - 1 if k < 200 else 199, "single": None}[shape]
    parent = [None] + [up(k) for k in range(1, n)]
    weight = [draw.randrange(9) for _ in range(n)]
    kids = [parent.count(k) for k in range(n)]
    leaves, saved = [int(not k) for k in kids], list(weight)
    for k in range(n - 1, 0, -1):
        leaves[parent[k]] += leaves[k]
        saved[parent[k]] += saved[k]
    rows = [((k, k * k), None if parent[k] is None else (parent[k], parent[k] ** 2), kids[k], weight[k]) for k in range(n)]
    tree = spark.createDataFrame(rows, "node struct<a:bigint,b:bigint>, parent struct<a:bigint,b:bigint>, n_children bigint, weight bigint")
    found = {r.node.a: (r.leaves, r.saved) for r in prefix_trie.subtree_totals(tree).collect()}
    assert found == {k: (leaves[k], saved[k]) for k in range(n)}


VECTORS = "vec_id bigint, embedding array<float>, label int"


def brute_negatives(rows):
    held = []
    for vec_id, vector, label in rows:
        if vec_id is None or label is None or not vector or any(x is None or not math.isfinite(x) for x in vector):
            continue
        whole = [math.floor(256 * float(np.float32(x))) for x in vector]
        held.append((vec_id, whole, (label + 1) % 10 if vec_id % 7 == 0 else label))
    out = []
    for a, (anchor, v, label) in enumerate(held):
        if anchor % 50:
            continue
        pairs = [(-sum(x * y for x, y in zip(v, w)), i, l == label) for b, (i, w, l) in enumerate(held) if b != a]
        for best, positive, _ in sorted(p for p in pairs if p[2])[:5]:
            inside = sorted(p for p in pairs if not p[2] and 50 * -best <= 100 * -p[0] <= 95 * -best)[:3]
            out += [(anchor, positive, k + 1, i, -best, -s) for k, (s, i, _) in enumerate(inside)]
    return sorted(out)


def found_negatives(spark, rows, parts=3):
    table = spark.createDataFrame(rows, VECTORS).repartition(parts)
    return sorted(tuple(r) for r in hard_negatives.hard_negatives(table).collect())


def test_negatives_against_brute_force(spark, monkeypatch):
    draw = np.random.default_rng(5)
    rows = [(int(k), [float(x) for x in draw.normal(0.1, 0.3, 8).astype(np.float32)], int(draw.integers(0, 4))) for k in range(400)]
    found = found_negatives(spark, rows)
    assert found == brute_negatives(rows) and len(found) > 50
    monkeypatch.setattr(hard_negatives, "ROWS", 16)  # many blocks, each with few positives
    assert found_negatives(spark, rows, 5) == brute_negatives(rows)


def test_negatives_ties_repeats_and_bad_rows(spark):
    v = [0.5, 0.25, 0.0, 1.0]
    rows = [(0, v, 1), (0, v, 1), (50, [0.0] * 4, 1), (100, v, 2), (150, [-x for x in v], 1)]
    rows += [(k, v, k % 3) for k in range(1, 40)] + [(k, [x * 0.8 for x in v], k % 3) for k in range(200, 240)]
    rows += [(None, v, 1), (300, None, 1), (301, v, None), (302, [], 1), (303, [1.0, None, 0.0, 0.0], 1), (304, [float("nan")] * 4, 1),
             (305, [float("inf")] * 4, 2), (306, [0.6, 0.3], 0), (307, v + [9.0], 0)]
    assert found_negatives(spark, rows) == brute_negatives(rows)
    assert found_negatives(spark, []) == []


def test_negatives_of_large_components(spark):
    rows = [(0, [3e38, -3e38], 1), (1, [3e38, -3e38], 1), (2, [2.0, 1.0], 3), (3, [3e38, 1.0], 3)]
    assert all(abs(r[4]) < 2**63 for r in found_negatives(spark, rows))  # limited, no overflow


def test_pruning_of_a_block_keeps_what_matters():
    draw = np.random.default_rng(2)
    for _ in range(200):
        n = int(draw.integers(1, 40))
        scores, ids = draw.integers(-20, 40, n), np.sort(draw.integers(0, 30, n))
        same, other = draw.random(n) < 0.4, np.ones(n, bool)
        place, own = hard_negatives.useful_pairs(scores, ids, other, same)
        best = sorted(zip(-scores[same], ids[same]))[:5]
        kept = sorted(zip(place, own))
        assert sorted((p, i) for p, i in kept if p % 2 == 0) == [(2 * s, i) for s, i in best]
        for s, _ in best:
            inside = [(t, i) for t, i in sorted(zip(-scores[~same], ids[~same])) if 50 * -s <= 100 * -t <= 95 * -s][:3]
            left = [(t, i) for t, i in (((p - 1) // 2, i) for p, i in kept if p % 2) if 50 * -s <= 100 * -t <= 95 * -s][:3]
            assert inside == left


def _texts(n, seed):
    draw = random.Random(seed)
    vocabulary = ["".join(draw.choice("abcdefghijklmnop") for _ in range(draw.randint(2, 8))) for _ in range(300)]
    rows = []
    for k in range(n):
        plain = [draw.choice(vocabulary) for _ in range(draw.randint(30, 90))]
        junk = k % 6 == 0
        rows.append((k, " ".join(w.upper() + "!!" for w in plain) if junk and k % 12 else " ".join([plain[0]] * 40) if junk else " ".join(plain).capitalize() + ".", 0 if junk else 1))
    return rows


def test_votes_on_held_out_rows(spark, table):
    rows = _texts(500, 1)
    docs = table([(k, t) for k, t, _ in rows] + [(1000, None), (1001, ""), (1002, "\n \t"), (1003, "long " * 200_000)])
    labels = spark.createDataFrame([(k, y) for k, _, y in rows] + [(None, 1), (3, None), (4, 7)], "doc_id bigint, quality int")
    space = neighbour_vote.train(docs, labels)
    found = {r.doc_id: r.score for r in neighbour_vote.scored(docs, space).collect()}
    held = [(k, y) for k, _, y in rows if zlib.crc32(str(k).encode()) % 5 == 0]
    assert len(held) > 60 and sum((found[k] >= neighbour_vote.PREDICTED) == bool(y) for k, y in held) >= 0.97 * len(held)
    assert all(0 <= s <= 1 for s in found.values()) and found[1000] == found[1001] == found[1002] == space.prior
    moved = labels.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0)
    again = {r.doc_id: r.score for r in neighbour_vote.scored(docs, neighbour_vote.train(docs, moved)).collect()}
    assert again == found  # held-out labels have no say


def test_blocked_votes_equal_single_ones():
    texts = [t.encode() for _, t, _ in _texts(120, 4)]
    labels = np.array([y for _, _, y in _texts(120, 4)], float)
    terms = neighbour_vote.damped(neighbour_vote.term_counts(texts, SpanHash()))
    space = neighbour_vote.Space(terms, labels)
    score, _ = space.vote(space.latent(terms))
    for k in range(0, 120, 7):
        alone = space.latent(neighbour_vote.damped(neighbour_vote.term_counts([texts[k]], SpanHash())))[0]
        near = sorted(((float(alone @ v), y) for v, y in zip(space.known, labels)), reverse=True)[: neighbour_vote.NEIGHBOURS]
        weights = [max(c, 0) ** neighbour_vote.SHARPNESS for c, _ in near]
        assert score[k] == pytest.approx(sum(w * y for w, (_, y) in zip(weights, near)) / sum(weights), abs=1e-3)


def test_terms_of_a_text_by_hand():
    counts = neighbour_vote.term_counts([b"Ab1 ab ab!", b"", b"x"], SpanHash())
    shapes, grams = counts[:, : neighbour_vote.SHAPES].sum(axis=1), counts[:, neighbour_vote.SHAPES :].sum(axis=1)
    assert list(shapes) == [3 + 2, 0, 1]  # three words, two pairs, no word that repeats the one before
    assert neighbour_vote.term_counts([b"ab ab"], SpanHash())[0, 1] >= 1
    assert grams[0] >= len(b"Ab1 ab ab!") - 2


def test_votes_without_labels_or_rows(spark, table):
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    docs = table([(1, "some text"), (1, "some text"), (None, "x")])
    assert neighbour_vote.train(docs, none) is None
    assert [r.score for r in neighbour_vote.scored(docs, None).collect()] == [0.0] * 3
    assert neighbour_vote.scored(table([]), None).count() == 0


def test_new_operators_with_clashing_columns(spark, clashing):
    extra = ["node", "parent", "depth", "part", "at", "given", "digest", "run", "row", "place", "id", "score", "n_words"]
    add = lambda df: df.withColumns({c: F.lit("z") for c in extra})
    rows = [(0, 0, "user", "a b"), (0, 1, "bot", "c"), (20, 0, "user", "a b")]
    found = prefix_trie.prefix_trie(add(spark.createDataFrame(rows, TURNS))).select(*COLUMNS).collect()
    assert sorted((tuple(r) for r in found), key=repr) == brute_trie(rows)
    vectors = [(k, [0.5, k / 100], k % 2) for k in range(60)]
    assert sorted(map(tuple, hard_negatives.hard_negatives(add(spark.createDataFrame(vectors, VECTORS))).collect())) == brute_negatives(vectors)
    labels = add(spark.createDataFrame([(k, k % 2) for k in range(9)], "doc_id bigint, quality int"))
    docs = clashing([(k, "good words" if k % 2 else "BAD!! BAD!!") for k in range(9)])
    assert neighbour_vote.scored(docs, neighbour_vote.train(docs, labels)).count() == 9


def test_rounds_share_their_code(spark):
    """The round is a column of the tree, so that the compiled code of one round serves all."""
    node = "struct<a:bigint,b:bigint>"
    schema = f"node {node}, up {node}, leaves bigint, saved bigint, edge_leaves bigint, edge_saved bigint, kids bigint, turn int"
    alive = spark.createDataFrame([((0, 0), None, 0, 0, 0, 0, 1, 3), ((1, 1), (0, 0), 1, 5, 0, 0, 0, 3)], schema)
    after = prefix_trie.contraction_round(alive)
    assert [(r["leaves"], r["saved"], r["kids"], r["turn"]) for r in after.collect()] == [(1, 5, 0, 4)]
    assert "xxhash64(turn" in after._jdf.queryExecution().optimizedPlan().toString()
