import pytest

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def table(spark):
    """Documents with the columns of the documents table; rows are (doc_id, text) or (doc_id, text, source)."""

    def make(rows, parts=3):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, COLUMNS).repartition(parts) if full else spark.createDataFrame([], COLUMNS)

    return make


@pytest.fixture
def clashing(spark):
    """Documents whose further columns are named like columns the operators use inside."""
    names = ["row", "_row", "_doc", "_id", "_key", "_bad", "key", "term", "pos", "n", "label", "node", "kept", "text_key", "d", "t", "_site"]

    def make(rows):
        schema = "doc_id bigint, text string, source string, " + ", ".join(f"`{c}` string" for c in names)
        return spark.createDataFrame([(i, t, "s", *names) for i, t in rows], schema)

    return make
