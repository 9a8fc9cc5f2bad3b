import os

import pytest

import corpus_pipeline
from marquee.llm import bagminhash, line_spread, phrase_index, queries

TINY = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(TINY), reason="the supplied tables are absent")


@needs_tables
def test_stages_take_effect_one_after_the_other(spark):
    docs = spark.read.parquet(f"{TINY}/documents.parquet")
    columns = docs.columns
    held = [docs]
    for name, stage in corpus_pipeline.STAGES:
        held.append(corpus_pipeline.materialise(stage(spark, held[-1], TINY), "stage"))
    raw, good, cleaned, unique, clean, pieces = held
    assert all(x.columns == columns for x in held[:-1])
    ids = [{r.doc_id for r in x.select("doc_id").collect()} for x in held]
    assert ids[0] > ids[1] == ids[2] >= ids[3] >= ids[4] == ids[5]
    assert {r.doc_id for r in queries.QUERIES["op2_repetition_quality"](spark, TINY).where("kept").collect()} == ids[1]
    assert {r.class_id for r in bagminhash.classes(cleaned).collect()} == ids[3]
    hit = phrase_index.contamination(unique, spark.read.parquet(f"{TINY}/benchmark.parquet")).where("n_hit > 0")
    assert {r.doc_id for r in hit.collect()} == ids[3] - ids[4]
    assert sorted(line_spread.without_boilerplate(good).collect()) == sorted(cleaned.collect())
    sizes = {}
    for r in pieces.collect():
        sizes.setdefault((r.doc_id, r.doc_tokens), []).append((r.start, r.length))
    for (_, total), parts in sizes.items():
        assert sum(n for _, n in parts) == total


@needs_tables
def test_run_gives_the_last_stage(spark):
    assert corpus_pipeline.run(spark, TINY).columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "context", "step_group"]


def test_empty_documents_pass_every_stage(table, spark, tmp_path):
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = table([])
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
    assert docs.count() == 0


@needs_tables
@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_queries_agree_with_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    from check_queries import TABLES, compare

    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{TINY}/{t}.parquet')")
    good, note = compare(spark, connection, TINY, name, queries.QUERIES[name], queries.ORACLES[name])
    assert good, note


def test_ids_that_are_null_or_shared_cost_no_clean_row(table, spark, tmp_path):
    spark.createDataFrame([(1, "secret phrase")], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    rows = [(None, "the secret phrase"), (None, "clean and null"), (3, "a secret phrase too"), (3, "clean with a shared id"), (4, "other")]
    kept = corpus_pipeline.decontamination(spark, table(rows), str(tmp_path))
    assert sorted(r.text for r in kept.collect()) == ["clean and null", "clean with a shared id", "other"]


def test_classes_that_share_their_smallest_id_keep_a_row_each(table, spark):
    one, two, three, four = (" ".join(f"{c}{k}" for k in range(200)) for c in "abcd")
    rows = [(7, one), (8, one + " more"), (7, two), (9, two), (7, two), (None, three), (None, three + " more"), (None, four), (10, "short"), (11, None), (12, "")]
    kept = [(r.doc_id, r.text) for r in corpus_pipeline.near_dedup(spark, table(rows), "").collect()]
    assert sorted((i, t) for i, t in kept if i is not None) == sorted([(7, one), (7, two), (10, "short"), (11, None)], key=lambda x: (x[0], x[1] or ""))
    assert len([t for i, t in kept if i is None]) == 2 and (None, four) in kept
