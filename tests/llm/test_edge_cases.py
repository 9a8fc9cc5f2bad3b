"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing columns, for every operator."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from marquee.llm import bagminhash, compression, line_spread, packing, phrase_index, pseudo_likelihood, quality, radix_windows, wavelet
from marquee.llm.queries import tokenizer_path

LONG = "a long text with a few words that come again " * 20_000
ROWS = [(1, "one two three"), (1, "one two three"), (None, "one two three"), (2, None), (None, None), (3, ""), (4, " \n\t "), (5, LONG), (6, "é ü 😀 \x00 end")]
NAMES = ["start", "length", "ids", "offset", "tokens", "row", "d", "t", "gram", "node", "label", "bucket", "key", "score", "n_words", "text_key", "_doc", "sequence_id", "shard", "place"]


@pytest.fixture
def given(spark):
    """ROWS with the columns of documents and further ones named like columns the operators use inside."""
    schema = "doc_id bigint, text string"
    table = spark.createDataFrame(ROWS, schema).withColumns({"lang": F.lit("en"), "source": F.lit("s"), "n_chars": F.char_length("text").cast("bigint")})
    return table.withColumns({n: F.lit("x") for n in NAMES}).repartition(3)


def wavelet_rows(docs):
    path = wavelet.write(docs, tokenizer_path("word_bpe_49k.json"))
    return wavelet.decoded(docs.sparkSession, path)


OPERATORS = {
    "decontamination": lambda docs: phrase_index.contamination(docs, docs.sparkSession.createDataFrame([(1, "two three")], "item_id bigint, text string")),
    "quality": quality.judged,
    "packing": lambda docs: packing.packed(docs, tokenizer_path("byte_bpe_50k.json")),
    "wavelet": wavelet_rows,
    "lines": line_spread.removed,
    "likelihood": pseudo_likelihood.pseudo_likelihood,
    "windows": radix_windows.without_repeats,
    "classes": bagminhash.classes,
    "toxicity": lambda docs: compression.scored(docs, None),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_every_row_has_its_result(given, name):
    found = OPERATORS[name](given).collect()
    ids = sorted((r.doc_id is None, r.doc_id or 0) for r in found)
    if name == "packing":  # a row per piece; together they hold every id of every row once
        assert set(ids) == {(i is None, i or 0) for i, _ in ROWS}
        assert sum(r.length for r in found if r.doc_id == 1) == 2 * next(r.doc_tokens for r in found if r.doc_id == 1)
        assert sum(r.length for r in found if r.doc_id == 5) == next(r.doc_tokens for r in found if r.doc_id == 5) > 100_000
    else:
        assert ids == sorted((i is None, i or 0) for i, _ in ROWS)


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_tables_have_empty_results(given, name):
    assert OPERATORS[name](given.limit(0)).count() == 0


def test_equal_rows_have_equal_results(given):
    for name in ("quality", "decontamination", "classes", "toxicity", "windows"):
        rows = [r.asDict() for r in OPERATORS[name](given).collect() if r.doc_id == 1]
        assert len(rows) == 2 and {k: v for k, v in rows[0].items() if k != "doc_id"} == {k: v for k, v in rows[1].items() if k != "doc_id"}, name


def test_filtering_stages_keep_columns_and_clean_rows(spark, given, tmp_path):
    clean = " ".join(f"word{k}" for k in range(80))
    more = spark.createDataFrame([(None, clean + " and"), (None, clean.upper()), (8, "\n".join(f"{clean[k:]} line" for k in range(0, 200, 40)))], "doc_id bigint, text string")
    more = more.withColumns({"lang": F.lit("en"), "source": F.lit(None).cast("string"), "n_chars": F.char_length("text").cast("bigint"), **{n: F.lit("x") for n in NAMES}})
    docs = given.unionByName(more)
    spark.createDataFrame([(1, "nothing of this occurs in any text at all here ever")], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES[:4]:
        kept = stage(spark, docs, str(tmp_path))
        assert kept.columns == docs.columns, name
        texts = {r.text for r in kept.collect()}
        assert {clean + " and"} <= texts, name  # a clean row without id stays in every stage
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0, name
    packed = corpus_pipeline.STAGES[4][1](spark, docs, str(tmp_path))
    assert packed.where("doc_id is null").count() >= 4
