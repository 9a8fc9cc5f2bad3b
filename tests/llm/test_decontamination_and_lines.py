import random
import re

import pytest

from marquee.llm import line_spread, phrase_index

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items, length=10):
    out = []
    for i, text in docs:
        w = words(text)
        hit, named = set(), set()
        for item, phrase in items:
            p = words(phrase)
            n = min(length, len(p))
            grams = {tuple(p[k : k + n]) for k in range(len(p) - n + 1)} if n else set()
            for k in range(len(w) - n + 1 if n else 0):
                if tuple(w[k : k + n]) in grams:
                    hit.update(range(k, k + n))
                    named.add(item)
        out.append((i, len(w), len(hit), sorted(str(x) for x in named if x is not None)))
    return sorted(out, key=repr)


@pytest.fixture
def items(spark):
    return lambda rows: spark.createDataFrame(rows, "item_id bigint, text string")


def test_hits_agree_with_brute_force(table, items):
    rng = random.Random(4)
    pool = ["the", "The", "of", "Élan", "élan", "x1", "ß", "rare", "a"]
    phrase = lambda n: " ".join(rng.choices(pool, k=n))
    tests = [(k, phrase(rng.choice([1, 2, 3, 9, 10, 11, 14]))) for k in range(2, 12)] + [(12, None), (13, ""), (14, "..."), (None, "rare rare rare"), (15, "Élan")]
    docs = []
    for k in range(60):
        middle = rng.choice([t for _, t in tests if t]) if rng.random() < 0.5 else ""
        docs.append((k, f"{phrase(rng.randint(0, 25))}, {middle}; {phrase(rng.randint(0, 9))}"))
    docs += [(None, tests[0][1]), (100, None), (101, ""), (102, tests[3][1]), (102, tests[3][1]), (103, "rare " * 3000)]
    found = phrase_index.contamination(table(docs), items(tests)).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in found), key=repr) == brute(docs, tests)


def test_no_items_no_documents_and_kept_columns(table, items, clashing):
    assert [tuple(r) for r in phrase_index.contamination(table([(1, "a b")]), items([])).collect()] == [(1, 2, 0, [])]
    assert phrase_index.contamination(table([]), items([(1, "a")])).count() == 0
    given = clashing([(1, "one two"), (2, "three"), (None, "two"), (None, "four")])
    kept = phrase_index.without_contaminated_rows(given, items([(1, "Two")]))
    assert kept.columns == given.columns
    assert sorted(kept.collect(), key=repr) == sorted(given.where("doc_id = 2 or text = 'four'").collect(), key=repr)


def test_proximity(table, items):
    docs = table([(1, "alpha beta gamma delta"), (2, "alpha x beta gamma y delta"), (3, "delta gamma beta alpha"), (4, "alpha x x x beta gamma delta")])
    windows = phrase_index.test_windows(items([(1, "alpha beta gamma delta")]))
    from pyspark.sql import functions as F

    index = phrase_index.build_index(docs, windows.select(F.explode("terms").alias("term")).distinct())
    ids = {r.row: r.doc_id for r in phrase_index.row_totals(index).collect()}
    near = {ids[r.row] for r in phrase_index.matches(index, windows, slop=2).collect()}
    exact = {ids[r.row] for r in phrase_index.matches(index, windows).collect()}
    assert exact == {1} and near >= {1, 2} and 4 not in near


def test_boilerplate_lines_go_and_lines_of_copies_stay(table):
    notice = "all rights are reserved by the owner"
    own = lambda k: f"own text of document {k} that nobody else has in any line at all, with more words"
    rows = [(k, f"{own(k)}\n  {notice} \nshort\n\n{own(k + 100)}", f"s{k % 12}") for k in range(24)]
    rows += [(200 + k, f"{notice}\n{notice}", f"s{k}") for k in range(12)]  # nothing but boilerplate
    copied = "\n".join(own(1000 + k) for k in range(5))
    rows += [(400 + k, copied, f"s{k}") for k in range(12)]  # one text on twelve sites: left to document dedup
    rows += [(300, None, "s1"), (301, "", None), (302, notice, None), (303, own(7), "s1"), (303, own(7), "s2")]
    found = {(r.doc_id, r.text, r.n_chars): r.n_removed_lines for r in line_spread.removed(table(rows)).collect()}
    for k in range(24):
        text = f"{own(k)}\nshort\n\n{own(k + 100)}"
        assert found[k, text, len(text)] == 1
    assert all(found[200 + k, "", 0] == 2 and found[400 + k, copied, len(copied)] == 0 for k in range(12))
    assert found[300, None, 0] == found[301, "", 0] == 0 and found[302, "", 0] == 1
    assert line_spread.without_boilerplate(table(rows)).count() == len(rows)


def test_threshold_is_exact(table):
    line = lambda n: f"this line is on exactly {n} sites of them all"
    rows, k = [], 0
    for n in (8, 9, 10, 11, 25, 40):
        for site in range(n):
            rows += [(k + j, f"{line(n)}\n" + f"own {k + j} words of this one " * 4, f"site{site}") for j in range(2)]
            k += 2
    found = line_spread.removed(table(rows)).collect()
    changed = {r.doc_id for r in found if r.n_removed_lines}
    assert changed == {i for i, t, _ in rows if not t.startswith((line(8), line(9)))}


def test_lines_of_a_long_text_and_of_nobody(table):
    notice = "all rights are reserved by the owner"
    long = "\n".join(f"{notice}\nline {k} of a very long text stands only here" for k in range(30_000))
    rows = [(k, f"{notice}\ntext {k}", f"s{k}") for k in range(10)] + [(50, long, "s1")]
    rows += [(60 + k, f"on many sites that have no name\n{k}", None) for k in range(20)]
    found = {r.doc_id: r for r in line_spread.removed(table(rows)).collect()}
    assert found[50].n_removed_lines == 30_000 and notice not in found[50].text and found[50].text.count("\n") == 29_999
    assert all(found[60 + k].n_removed_lines == 0 for k in range(20)) and found[3].text == "text 3"


def test_other_columns_pass(table, clashing):
    given = clashing([(1, "x"), (None, None)])
    found = line_spread.without_boilerplate(given)
    assert found.columns == given.columns and sorted(found.collect(), key=repr) == sorted(given.collect(), key=repr)
    assert line_spread.without_boilerplate(table([])).count() == 0
