import random

import numpy as np
import pytest

from marquee.llm import packing, tokens, wavelet

public = pytest.importorskip("public_tokenizers")
BYTES, WORDS = public.path("byte_bpe_50k.json"), public.path("word_bpe_49k.json")

ODD = [
    "", " ", "\n", "a  ", "  x", "a   b", "a \n\n  b", "\t a \t", "x\ty z\t w", "q   r", "don't stop's. it's,'s'x", "été là. où É",
    "ÀÉÎ Öß ÿx Straße", "日本語 テキスト", "²x² a_b A1.b2", "é . ́x", "<|endoftext|> hi", "x" * 500, "İstanbul Σας", " \n \n a", "a. b",
]


def random_texts(seed, n):
    rng = random.Random(seed)
    alphabet = ["a", "B", "é", "ß", "'s", "'", ".", ",", " ", " ", " ", "\n", "\t", "1", "22", "_", "日", "the", "ing", " ", "́", "!!", "ll", "'ll"]
    return ["".join(rng.choices(alphabet, k=rng.randint(0, 40))) for _ in range(n)]


@pytest.mark.parametrize("path, blanks", [(BYTES, True), (WORDS, False)])
def test_ids_are_those_of_the_library(path, blanks, monkeypatch):
    encode = tokens.WordEncoder(path, blanks)
    given = ODD + random_texts(3, 3000)
    for size in (len(given), 100):
        for k in range(0, len(given), size):
            some = given[k : k + size]
            flat, counts = encode(some)
            want = [e.ids for e in encode.tokenizer.encode_batch(some, add_special_tokens=False)]
            assert counts.tolist() == [len(x) for x in want]
            assert flat.tolist() == [i for x in want for i in x]
        monkeypatch.setattr(tokens, "TABLE_CHARACTERS", 50)  # forgets between calls


def test_packing_places_every_token_once():
    rng = random.Random(1)
    for _ in range(150):
        sizes = [rng.choice([1, 2, 50, 255, 256, 257, 700, 2048, 2049, 9000, rng.randint(1, 3000)]) for _ in range(rng.randint(0, 50))]
        sequences = packing.pack(sizes)
        pieces = sorted((d, s, n) for _, held in sequences for n, d, s in held)
        reached = {}
        for doc, start, length in pieces:
            assert reached.get(doc, 0) == start and length > 0
            reached[doc] = start + length
        assert reached == dict(enumerate(sizes))
        lengths = [sum(n for n, _, _ in held) for _, held in sequences]
        assert all(n == c for n, (c, _) in zip(lengths, sequences) if n & (n - 1) == 0 and n >= 256)
        assert sum(n != c for n, (c, _) in zip(lengths, sequences)) <= 1 and max(lengths, default=0) <= 2048
        loads = np.bincount(packing.step_groups(lengths, 8192), lengths) if lengths else []
        assert not len(loads) or max(loads) - min(loads) <= 2048


def test_packed_pieces_hold_the_ids(table):
    given = [(k, t) for k, t in enumerate(ODD)] + [(None, "no id"), (1, None), (0, ""), (0, ""), (99, "long text " * 4000)]
    rows = packing.packed(table(given), BYTES).collect()
    encode = tokens.WordEncoder(BYTES)
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
        assert len(r.ids) == 4 * r.length
    for held in sequences.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 2048
    whole = {}
    for r in sorted((r for r in rows if r.doc_id == 99), key=lambda r: r.start):
        whole.setdefault(99, []).extend(np.frombuffer(r.ids, "<u4").tolist())
    assert whole[99] == encode(["long text " * 4000])[0].tolist() + [packing.END_ID]
    assert sum(r.length for r in rows) == sum(int(encode([t or ""])[1][0]) + 1 for _, t in given)
    assert packing.packed(table([]), BYTES).count() == 0


def test_wavelet_answers_agree_with_the_sequence():
    rng = np.random.default_rng(1)
    for n in (1, 63, 64, 511, 512, 513, 4000):
        values = rng.integers(0, 49408, n).astype(np.uint32)
        values[::3] = 2
        data = wavelet.to_bytes(wavelet.WaveletMatrix.of(values), [None, 7], np.array([1, n - 1]))
        matrix, ids, sizes = wavelet.from_bytes(data)
        assert ids == [None, 7] and sizes.tolist() == [1, n - 1]
        assert matrix.values().tolist() == values.tolist() == matrix.access(np.arange(n)).tolist()
        for value in (2, int(values[-1]), 49407):
            assert matrix.count(value) == (values == value).sum()
            assert matrix.occurrences(value).tolist() == np.flatnonzero(values == value).tolist()
            assert matrix.rank(value, n, n // 3) == (values[n // 3 :] == value).sum()
    empty = wavelet.WaveletMatrix.of(np.empty(0, np.uint32))
    assert empty.values().tolist() == [] and empty.count(2) == 0


def test_shards_round_trip_in_order(table, spark, monkeypatch):
    given = [(k, t) for k, t in enumerate(ODD)] + [(None, "no id"), (500, None), (501, "same"), (501, "same"), (-3, "# ## #")]
    path = wavelet.write(table(given), WORDS)
    rows = wavelet.placed(wavelet.decoded(spark, path), path).collect()
    encode = tokens.WordEncoder(WORDS, False)
    at, found = 0, []
    for r in sorted(rows, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
        found.append((r.doc_id, np.frombuffer(r.ids, "<u4").tolist()))
    ordered = sorted(given, key=lambda r: (r[0] is not None, r[0] or 0))
    assert found == [(i, encode([t or ""])[0].tolist() + [wavelet.END_ID]) for i, t in ordered]
    empty = wavelet.write(table([]), WORDS)
    assert wavelet.placed(wavelet.decoded(spark, empty), empty).count() == 0
