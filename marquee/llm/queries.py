"""Queries of this package and their SQL counterparts, in DuckDB's dialect."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm import (
    bagminhash,
    compression,
    hard_negatives,
    line_spread,
    neighbour_vote,
    packing,
    phrase_index,
    prefix_trie,
    pseudo_likelihood,
    quality,
    radix_windows,
    template,
    wavelet,
)
from marquee.llm.tables import documents, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(run: Callable[[SparkSession, str], DataFrame]):
    QUERIES[run.__name__] = run
    return run


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_phrase_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = phrase_index.contamination(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        F.col("n_hit").cast("bigint").alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


_LOWER_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)

ORACLES["op1_phrase_decontamination"] = f"""
WITH d AS (SELECT doc_id, {_LOWER_WORDS} AS w FROM documents),
i AS (SELECT item_id, {_LOWER_WORDS} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[s:s + 9], ' ') AS gram
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM i WHERE len(w) > 0)
),
places AS (
  SELECT doc_id, s, n, array_to_string(w[s:s + n - 1], ' ') AS gram
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, (SELECT DISTINCT n FROM windows))
),
hits AS (SELECT DISTINCT doc_id, s, n, item_id FROM places JOIN windows USING (n, gram)),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, list_sort(list(DISTINCT item_id::VARCHAR)) AS ids FROM hits GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(len(ids), 0)::BIGINT AS n_items,
  sha256(coalesce(array_to_string(ids, ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""


@query
def op2_repetition_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(documents(spark, sf_dir)).select("doc_id", *quality.COUNTS, "base_failed", "kept")


def _quality_sql() -> str:
    grams = list(quality.GRAM_LIMITS)
    base = quality.BASE_GRAM

    def gram(n: int) -> str:
        return " || ' ' || ".join(f"lead(word, {k}) OVER o" if k else "word" for k in range(n))

    later = ", ".join(f"(g{n} IS NOT NULL AND row_number() OVER (PARTITION BY doc_id, g{n} ORDER BY pos) > 1) AS later{n}" for n in grams)
    inside = ", ".join(f"coalesce(bool_or(later{n}) OVER (PARTITION BY doc_id ORDER BY pos ROWS {n - 1} PRECEDING), false) AS in{n}" for n in grams)
    sums = ", ".join(f"coalesce(sum(length(word)) FILTER (in{n}), 0) AS dup{n}" for n in grams)
    limits = " AND ".join(f"coalesce(dup{n}, 0) <= {limit} * coalesce(word_chars, 0)" for n, limit in quality.GRAM_LIMITS.items())
    return rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, unnest(x) AS word, generate_subscripts(x, 1) AS pos
      FROM (SELECT doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS x FROM d)),
g AS (SELECT doc_id, pos, word, {gram(base)} AS g{base}, {", ".join(f"{gram(n)} AS g{n}" for n in grams)}
      FROM w WINDOW o AS (PARTITION BY doc_id ORDER BY pos)),
r AS (SELECT doc_id, pos, word, (g{base} IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, g{base}) > 1) AS seen, {later} FROM g),
c AS (SELECT doc_id, word, bool_or(seen) OVER (PARTITION BY doc_id ORDER BY pos ROWS {base - 1} PRECEDING) AS repeat, {inside} FROM r),
s AS (SELECT doc_id, count(*) AS n_words, sum(length(word)) AS word_chars, count(*) FILTER (repeat) AS n_repeat_words, {sums}
      FROM c GROUP BY doc_id),
l AS (SELECT doc_id, line, row_number() OVER (PARTITION BY doc_id, line ORDER BY pos) > 1 AS again
      FROM (SELECT doc_id, unnest(x) AS line, generate_subscripts(x, 1) AS pos FROM (SELECT doc_id, string_split(text, chr(10)) AS x FROM d))
      WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
k AS (SELECT doc_id, count(*) AS n_dup_lines, sum(length(regexp_replace(line, '[\x20\x09-\x0D]', '', 'g'))) AS dup_line
      FROM l WHERE again GROUP BY doc_id),
a AS (SELECT doc_id, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(word_chars, 0)::BIGINT AS word_chars,
        length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
        coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
        coalesce(n_words, 0) < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MAX_REPEAT_PERCENT} * n_words AS base_failed,
        coalesce(dup_line, 0) <= {quality.LINE_LIMIT} * coalesce(word_chars, 0) AND {limits} AS good
      FROM d LEFT JOIN s USING (doc_id) LEFT JOIN k USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND good AS kept FROM a
"""


ORACLES["op2_repetition_quality"] = _quality_sql()


@query
def op3_tiered_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_digest(packing.packed(documents(spark, sf_dir), tokenizer_path("byte_bpe_50k.json")))


def piece_digest(pieces: DataFrame) -> DataFrame:
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "context", "step_group")


@query
def op4_wavelet_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = wavelet.write(documents(spark, sf_dir), tokenizer_path("word_bpe_49k.json"))
    digest = wavelet.decoded(spark, path).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return wavelet.placed(digest, path).select("doc_id", "start", "n_tokens", "ids_crc32")


@query
def op5_site_spread_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_spread.removed(documents(spark, sf_dir)).select("doc_id", "text", "n_chars", "n_removed_lines")


ORACLES["op5_site_spread_lines"] = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, text, source, n_chars, string_split(text, chr(10)) AS x FROM documents),
l AS (SELECT r, text, source, unnest(x) AS line, generate_subscripts(x, 1) AS pos FROM d),
counted AS (SELECT r, text, source, pos, trim(line) AS key FROM l WHERE length(trim(line)) >= {line_spread.MIN_CHARACTERS}),
firsts AS (SELECT key, text, min(source) AS site FROM counted GROUP BY key, text),
spread AS (SELECT key FROM firsts GROUP BY key HAVING count(DISTINCT site) >= {line_spread.MIN_SITES}),
gone AS (SELECT r, pos FROM counted SEMI JOIN spread USING (key)),
cut AS (SELECT r, string_agg(line, chr(10) ORDER BY pos) AS cut_text FROM l ANTI JOIN gone USING (r, pos) GROUP BY r),
n AS (SELECT r, count(*) AS n FROM gone GROUP BY r)
SELECT doc_id, CASE WHEN n.n IS NULL THEN text ELSE coalesce(cut_text, '') END AS text,
  (CASE WHEN n.n IS NULL THEN n_chars ELSE length(coalesce(cut_text, '')) END)::BIGINT AS n_chars,
  coalesce(n.n, 0)::BIGINT AS n_removed_lines
FROM d LEFT JOIN n USING (r) LEFT JOIN cut USING (r)
"""


@query
def op6_template_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = template.extracted(table(spark, sf_dir, "pages"))
    return found.withColumn("n_chars", F.char_length("text").cast("bigint"))


@query
def op7_pseudo_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pseudo_likelihood.pseudo_likelihood(documents(spark, sf_dir))
    per_word = F.when(F.col("n_words") > 0, F.col("log_likelihood") / F.col("n_words"))
    return found.withColumn("per_word", per_word)


@query
def op8_radix_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = radix_windows.without_repeats(documents(spark, sf_dir))
    return found.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).cast("bigint").alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query
def op9_bagminhash_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bagminhash.classes(documents(spark, sf_dir)).select("doc_id", "class_id", "class_key")


@query
def op10_compression_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = compression.train(compression.training_sample(docs, table(spark, sf_dir, "labels")))
    held_out = F.coalesce(~compression.training_row(F.col("doc_id")), F.lit(False))
    return compression.scored(docs, model).select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        (F.col("score") >= compression.PREDICTED).cast("int").alias("predicted"),
        "n_windows",
        "largest",
    )


@query
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


#: DuckDB has no crc32: one step per bit, reflected polynomial 0xEDB88320.
_CRC_STEPS = "flatten(list_transform(string_split(c::VARCHAR, ''), lambda ch: [ord(ch)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))"
_CRC = (
    f"xor(list_reduce(list_concat([4294967295::BIGINT], {_CRC_STEPS}), "
    "lambda h, x: CASE WHEN x >= 0 THEN xor(h, x) ELSE xor(h >> 1, 3988292384 * (h & 1)) END), 4294967295)"
)

ORACLES["op11_prefix_trie"] = rf"""
WITH t AS (SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS k
      FROM conversations WHERE conv_id IS NOT NULL),
h AS (SELECT c, {_CRC} % {prefix_trie.OPENINGS} AS h FROM (SELECT DISTINCT c FROM t)),
r AS (SELECT h.c, 0 AS own, t.k, role, text FROM h JOIN t ON t.c = floor(h.c / {prefix_trie.BLOCK}) * {prefix_trie.BLOCK} AND t.k <= h.h
      UNION ALL SELECT h.c, 1, t.k, role, text FROM h JOIN t ON t.c = h.c AND t.k > h.h),
w AS (SELECT c, row_number() OVER (PARTITION BY c ORDER BY own, k) AS pos, role, text FROM r),
p AS (SELECT c, pos AS depth, list(role || chr(1) || text) OVER (PARTITION BY c ORDER BY pos) AS path,
        len(regexp_extract_all(text, '{prefix_trie.WORD}')) AS n_words FROM w
      UNION ALL SELECT c, 0, []::VARCHAR[], 0 FROM h),
e AS (SELECT c, max(depth) AS last FROM p GROUP BY c),
x AS (SELECT depth, path, min(c) AS conv_id, count(*) AS n_convs, max(n_words) AS n_words,
        string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (depth = e.last) AS ends
      FROM p JOIN e USING (c) GROUP BY depth, path),
k AS (SELECT depth - 1 AS depth, path[1:depth - 1] AS path, count(*) AS n_children FROM x WHERE depth > 0 GROUP BY ALL),
y AS (SELECT x.*, coalesce(k.n_children, 0) AS n_children FROM x LEFT JOIN k USING (depth, path)),
s AS (SELECT top.depth, top.path, count(*) FILTER (low.n_children = 0) AS n_leaves,
        sum((low.n_convs - 1) * low.n_words) AS saved_tokens
      FROM y top JOIN y low ON low.path[1:top.depth] = top.path AND low.depth >= top.depth GROUP BY ALL)
SELECT y.conv_id, y.depth::BIGINT AS depth, up.conv_id AS parent_conv_id, y.n_convs::BIGINT AS n_convs,
  y.n_children::BIGINT AS n_children, n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens,
  sha256(coalesce(y.ends, '')) AS ends_sha256
FROM y JOIN s USING (depth, path) LEFT JOIN y up ON up.depth = y.depth - 1 AND up.path = y.path[1:y.depth - 1]
"""


@query
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.hard_negatives(table(spark, sf_dir, "embeddings"))


ORACLES["op12_hard_negatives"] = f"""
WITH e AS (SELECT row_number() OVER () AS r, vec_id,
        CASE WHEN vec_id % {hard_negatives.MOVED_STEP} = 0 THEN (label + 1) % {hard_negatives.CLASSES} ELSE label END AS label,
        list_transform(embedding, lambda x: floor({hard_negatives.SCALE} * x::DOUBLE)) AS v
      FROM embeddings
      WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.r AS anchor, a.vec_id AS anchor_id, b.vec_id AS id, b.r, a.label = b.label AS same,
        list_inner_product(a.v, b.v)::BIGINT AS score
      FROM e a JOIN e b ON a.vec_id % {hard_negatives.ANCHOR_STEP} = 0 AND a.r <> b.r),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, id, r) <= {hard_negatives.POSITIVES}),
n AS (SELECT p.anchor_id, p.id AS positive_id, s.id AS negative_id, p.score AS positive_score, s.score AS negative_score,
        row_number() OVER (PARTITION BY p.anchor, p.r ORDER BY s.score DESC, s.id, s.r) AS rank
      FROM p JOIN s ON s.anchor = p.anchor AND NOT s.same
        AND {hard_negatives.LOW} * p.score <= 100 * s.score AND 100 * s.score <= {hard_negatives.HIGH} * p.score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= {hard_negatives.NEGATIVES}
"""


@query
def op13_neighbour_vote(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    space = neighbour_vote.train(docs, table(spark, sf_dir, "labels"))
    held_out = F.coalesce(~neighbour_vote.training_row(F.col("doc_id")), F.lit(False))
    predicted = (F.col("score") >= neighbour_vote.PREDICTED).cast("int").alias("predicted")
    return neighbour_vote.scored(docs, space).select("doc_id", held_out.alias("held_out"), "score", predicted, "similarity")
