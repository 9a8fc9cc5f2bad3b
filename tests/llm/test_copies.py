import hashlib
import random

import numpy as np
import pytest

from marquee.llm import bagminhash, radix_windows, words


def brute_spans(rows, length):
    counts = {}
    for _, text in rows:
        data = (text or "").encode()
        for k in range(len(data) - length + 1):
            counts[data[k : k + length]] = counts.get(data[k : k + length], 0) + 1
    out = []
    for i, text in rows:
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for k in range(len(data) - length + 1):
            if counts[data[k : k + length]] > 1:
                gone[k : k + length] = True
        starts, ends = words.runs(gone)
        kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
        out.append((i, len(data), list(zip(starts.tolist(), ends.tolist())), kept))
    return sorted(out, key=repr)


def spans(df):
    return sorted(((r.doc_id, r.n_bytes, [(s.begin, s.end) for s in r.spans], bytes(r.kept)) for r in df.collect()), key=repr)


def prose(rng, n):
    return " ".join("".join(rng.choices("abcdefgé", k=rng.randint(1, 7))) for _ in range(n))


def test_repeated_windows_agree_with_brute_force(table, monkeypatch):
    rng = random.Random(7)
    shared = [prose(rng, n) for n in (30, 50, 60, 120)]
    rows = []
    for k in range(60):
        parts = [prose(rng, rng.randint(0, 40)) for _ in range(3)]
        for p in rng.choices(shared, k=rng.randint(0, 3)):
            cut = rng.randint(0, 60)
            parts.insert(rng.randint(0, 3), p[cut : cut + rng.choice([150, 199, 200, 201, 260, 400])])
        rows.append((k, rng.choice(["", " "]).join(parts)))
    base = prose(rng, 200)
    rows += [(100 + k, base[:500] + str(k) + base[500:]) for k in range(12)]  # near copies
    rows += [(200, "x" * 450), (201, "x" * 200), (202, "ab" * 300), (203, "y" * 199), (204, "z" * 200)]
    rows += [(300, None), (301, ""), (None, prose(rng, 90)), (302, rows[3][1]), (303, base), (303, base)]
    assert spans(radix_windows.without_repeats(table(rows))) == brute_spans(rows, radix_windows.LENGTH)
    monkeypatch.setattr(radix_windows, "PIECE", 700)  # texts in several pieces
    assert [p[1] for p in radix_windows.pieces([b"a" * 2000])][0][0] == b"a" * (700 + 199)


def test_long_texts_are_cut_into_overlapping_pieces():
    rng = np.random.default_rng(1)
    text = rng.integers(97, 100, radix_windows.PIECE * 2 + 300).astype(np.uint8).tobytes()
    parts = [(o, p) for _, parts, offsets in radix_windows.pieces([b"abc", text, b""]) for o, p in zip(offsets.tolist(), parts)]
    own = [(o, p) for o, p in parts if len(p) > 3]
    assert [o for o, _ in own] == [0, radix_windows.PIECE, 2 * radix_windows.PIECE]
    assert all(text[o : o + len(p)] == p for o, p in own) and own[-1][0] + len(own[-1][1]) == len(text)


def test_nothing_repeats_in_an_empty_table(table):
    assert spans(radix_windows.without_repeats(table([]))) == []
    assert spans(radix_windows.without_repeats(table([(1, "short"), (2, "short")]))) == [(1, 5, [], b"short"), (2, 5, [], b"short")]


def multiset(text):
    found = (text or "").lower().split()
    size = min(5, len(found))
    out = {}
    for k in range(len(found) - size + 1 if size else 0):
        g = tuple(found[k : k + size])
        out[g] = out.get(g, 0) + 1
    return out


def weighted(a, b):
    both = sum(min(n, b.get(g, 0)) for g, n in a.items())
    return both / max(1, sum(a.values()) + sum(b.values()) - both)


def brute_classes(rows):
    bags = [multiset(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            if (rows[a][1] or "") == (rows[b][1] or "") or weighted(bags[a], bags[b]) >= 0.8:
                parent[root(a)] = root(b)
    ids = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            ids[root(k)] = min(i, ids.get(root(k), i))
    return sorted(((rows[k][0], ids.get(root(k))) for k in range(len(rows))), key=repr)


def corpus(seed):
    rng = random.Random(seed)
    rows = [(k, " ".join(f"w{rng.randint(0, 400)}" for _ in range(rng.choice([3, 5, 8, 40, 150, 400])))) for k in range(120)]
    for k in range(80):
        found = rows[rng.randint(0, 60)][1].split()
        for _ in range(rng.randint(0, max(1, len(found) // 40))):
            found[rng.randrange(len(found))] = f"new{rng.randint(0, 99)}"
        rows.append((200 + k, " ".join(found)))
    many = " ".join(f"m{k}" for k in range(300)).split()
    for k in range(60):  # one large group of near copies
        copy = list(many)
        copy[rng.randrange(300)] = f"c{k}"
        rows.append((400 + k, " ".join(copy)))
    rows += [(500, "same line again " * 100), (501, "same line again " * 90), (502, "same line again " * 40), (503, "a b"), (504, "A b"), (505, "a c")]
    rows += [(None, rows[0][1]), (None, "only null ids"), (600, None), (601, ""), (601, ""), (602, "!!!"), (1, rows[5][1])]
    return rows


def test_classes_agree_with_brute_force(table):
    for seed in (1, 2):
        rows = corpus(seed)
        found = sorted(((r.doc_id, r.class_id) for r in bagminhash.classes(table(rows)).collect()), key=repr)
        assert found == brute_classes(rows)


def test_registers_estimate_weighted_similarity():
    rng = random.Random(3)
    pairs = []
    for _ in range(40):
        common = {f"s{k}": rng.choice([1, 1, 2, 5, 17]) for k in range(60)}
        a = {**common, **{f"a{k}": rng.randint(1, 9) for k in range(rng.randint(0, 30))}}
        b = {s: max(1, n - rng.choice([0, 0, 2])) for s, n in common.items()}
        pairs.append((a, b))
    bags = [x for p in pairs for x in p]
    owner = np.repeat(np.arange(len(bags)), [len(x) for x in bags])
    value = np.array([int.from_bytes(hashlib.md5(s.encode()).digest()[:8], "little") for x in bags for s in x], np.uint64)
    weight = np.array([n for x in bags for n in x.values()])
    names = bagminhash.signatures(len(bags), owner, value, weight)
    assert (names != 0).all()
    errors = [(names[2 * k] == names[2 * k + 1]).mean() - weighted(*pairs[k]) for k in range(len(pairs))]
    assert abs(np.mean(errors)) < 0.02 and max(map(abs, errors)) < 5 * 0.5 / bagminhash.REGISTERS**0.5


def test_small_blocks_lose_no_link(table, monkeypatch):
    monkeypatch.setattr(bagminhash, "BLOCK", 3)
    rows = corpus(5)
    found = sorted(((r.doc_id, r.class_id) for r in bagminhash.classes(table(rows)).collect()), key=repr)
    assert found == brute_classes(rows)


def test_one_row_of_each_class_stays(table, clashing):
    rows = corpus(6)
    kept = [r.doc_id for r in bagminhash.one_of_each_label(table(rows)).collect()]
    classes = {c for _, c in brute_classes(rows) if c is not None}
    assert {i for i in kept if i is not None} == classes
    assert len(kept) == bagminhash.labelled_rows(table(rows)).select("label").distinct().count()
    given = clashing([(1, "x y z"), (2, "x y z"), (3, None), (None, "q")])
    kept = bagminhash.one_of_each_label(given)
    assert kept.columns == given.columns and sorted((r.doc_id or 0) for r in kept.collect()) == [0, 1, 3]
    assert bagminhash.one_of_each_label(table([])).count() == 0


def test_classes_that_share_their_smallest_id_are_told_apart(table):
    rows = [(1, "a b c d e f g"), (1, "u v w x y z q"), (2, "a b c d e f g"), (3, "u v w x y z q")]
    found = bagminhash.classes(table(rows)).collect()
    assert {r.class_id for r in found} == {1}
    keys = {r.doc_id: r.class_key for r in found if r.doc_id > 1}
    assert keys[2] != keys[3] and len({r.class_key for r in found}) == 2


def test_recall_against_all_pairs(table):
    rng = random.Random(12)
    pool = [f"w{k}" for k in range(400)]
    rows = []
    for k in range(40):  # families of edited copies, from nearly equal to hardly alike
        base = rng.choices(pool, k=rng.randint(30, 200))
        for j in range(6):
            text = [rng.choice(pool) if rng.random() < 0.02 * j else w for w in base]
            rows.append((k * 10 + j, " ".join(text)))
    span_hash, texts = words.SpanHash(), {i: t.encode() for i, t in rows}
    alike = [(a, b) for a in texts for b in texts if a < b and a // 10 == b // 10 and bagminhash.similarity(texts[a], texts[b], span_hash) >= bagminhash.SIMILARITY]
    found = {r.doc_id: r.class_id for r in bagminhash.classes(table(rows)).collect()}
    assert len(alike) > 40 and sum(found[a] == found[b] for a, b in alike) >= 0.99 * len(alike)


@pytest.mark.parametrize("size", [2, 7, 40])
def test_chains_are_one_component(spark, size):
    links = spark.createDataFrame([(k, k + 1) for k in range(size)] + [(100, 101)], "a bigint, b bigint")
    found = {r.node: r.label for r in bagminhash.components(links).collect()}
    assert found == {**{k: 0 for k in range(size + 1)}, 100: 100, 101: 100}
