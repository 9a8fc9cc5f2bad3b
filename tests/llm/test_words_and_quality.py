import random
import re

import numpy as np

from marquee.llm import quality, words


def texts(seed, n):
    rng = random.Random(seed)
    pool = ["a", "bb", "the", "é", "日本", "x#y", "*", "word", "|"]
    out = []
    for _ in range(n):
        lines = [" ".join(rng.choices(pool, k=rng.randint(0, 25))) for _ in range(rng.randint(1, 8))]
        lines += rng.choices(lines, k=rng.randint(0, 3))
        out.append(rng.choice(["\n", "\n\n", "\n\t"]).join(lines))
    return out


def brute(text):
    found = re.findall(r"[^\x20\x09-\x0D]+", text)
    out = {"n_words": len(found), "word_chars": sum(map(len, found)), "n_symbols": sum(text.count(c) for c in "#*$%&|<>")}
    seen, again = set(), []
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            if line in seen:
                again.append(line)
            seen.add(line)
    out["n_dup_lines"] = len(again)
    out["dup_line_chars"] = sum(len(w) for line in again for w in re.findall(r"[^\x20\x09-\x0D]+", line))

    def covered(n, first_too):
        grams = [tuple(found[k : k + n]) for k in range(len(found) - n + 1)]
        before, inside = set(), set()
        for k, g in enumerate(grams):
            if g in before or first_too and grams.count(g) > 1:
                inside.update(range(k, k + n))
            before.add(g)
        return inside

    out["n_repeat_words"] = len(covered(3, True))
    for n in quality.GRAM_LIMITS:
        out[f"dup_{n}gram_chars"] = sum(len(found[k]) for k in covered(n, False))
    return out


def test_measures_agree_with_brute_force():
    given = texts(1, 150) + ["", " ", "\n\n", "one", "a b c a b c a b c"]
    found = quality.measure([t.encode() for t in given], words.SpanHash())
    for k, text in enumerate(given):
        assert {c: int(found[c][k]) for c in found} == brute(text), text


def test_spans_longer_than_a_segment_hash_alike():
    long = np.random.default_rng(1).integers(65, 91, words.SEGMENT * 2 + 7).astype(np.uint8)
    buffer = np.concatenate((long, [10], long, [10], long[:-1])).astype(np.uint8)
    starts, ends = words.runs(buffer != 10)
    a, b, c = words.SpanHash()(buffer, starts, ends)
    assert a == b != c


def test_odd_rows(table, clashing, spark):
    rows = [(None, "x " * 60), (1, None), (2, ""), (2, ""), (3, " ".join(f"w{k}" for k in range(20000)))]
    found = sorted(quality.judged(table(rows)).collect(), key=lambda r: (r.n_words, r.doc_id is None))
    assert [(r.doc_id, r.n_words, r.base_failed, r.kept) for r in found] == [
        (1, 0, True, False), (2, 0, True, False), (2, 0, True, False), (None, 60, True, False), (3, 20000, False, True)
    ]
    assert quality.judged(table([])).count() == 0
    given = clashing([(1, "x " * 60), (2, " ".join(f"w{k}" for k in range(80))), (None, None)])
    kept = quality.keep_good(given)
    assert kept.columns == given.columns and kept.collect() == given.where("doc_id = 2").collect()
    assert quality.keep_good(table([])).count() == 0


def test_kept_rows_are_the_judged_ones(table):
    given = table([(k, t * 4 if k % 3 else t) for k, t in enumerate(texts(2, 60))])
    judged = {r.doc_id for r in quality.judged(given).where("kept").collect()}
    assert {r.doc_id for r in quality.keep_good(given).collect()} == judged
