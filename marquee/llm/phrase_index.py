"""Benchmark decontamination with a positional inverted index, in DataFrame operations only.

The index keeps, for every training row, the positions of the terms that test items use. A window of
test words is looked up from its rarest terms: the position lists of the two rarest, shifted by their
offsets, are intersected first; what is left is intersected with the lists of all other terms.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.tables import prepared, small
from marquee.session import materialise

WINDOW = 10
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words before A-Z are lower-cased; a word of the contract with capitals left in.
CASED_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Rows up to which a table that follows from the test items, or a list of row numbers, is broadcast.
SMALL_ROWS = 500_000


def cased_words(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(CASED_WORD), F.lit(0))


def term(word: Column) -> Column:
    """A-Z lower-cased, nothing else; most words need no second look."""
    return F.when(F.lower(word) == word, word).otherwise(F.translate(word, UPPER, LOWER))


def test_windows(items: DataFrame, length: int = WINDOW) -> DataFrame:
    """(window, phrase, terms, n_terms, item_id) of every window; items with equal windows share the window number.

    An item of fewer words is one window, one without words or text has none. A null item_id is kept
    as null: its windows mark words and name no item.
    """
    words = F.transform(cased_words(F.col("text")), term)
    held = items.select(F.col("item_id").cast("string").alias("item_id"), words.alias("words")).where(F.size("words") > 0)
    starts = F.sequence(F.lit(0), F.greatest(F.size("words") - length, F.lit(0)))
    each = held.select("item_id", "words", F.explode(starts).alias("at"))
    each = each.select("item_id", F.slice("words", F.col("at") + 1, F.lit(length)).alias("terms"))
    each = each.select("item_id", "terms", F.concat_ws(" ", "terms").alias("phrase"))
    numbered = materialise(each.select("phrase", "terms").distinct().withColumn("window", F.monotonically_increasing_id()), "windows")
    return materialise(
        each.select("item_id", "phrase").distinct().join(numbered, "phrase").withColumn("n_terms", F.size("terms")), "items"
    )


def build_index(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """Postings (row, pos, term) of the given terms, and for every row of ``docs`` a closing posting
    without a term, whose pos is the row's number of words and which alone has its doc_id.

    A null or empty text has only its closing posting. Rows are numbered, so repeated or null ids stay
    apart and repeated rows have postings each. Texts of any length are indexed whole; an empty table
    has no postings. Other columns of ``docs`` are not read.
    """
    words = F.array_append(cased_words(F.col("text")), F.lit(None).cast("string"))
    each = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("bigint").alias("doc_id"), words.alias("words"))
    each = each.select("row", "doc_id", F.posexplode("words").alias("pos", "word"))
    each = each.select("row", F.when(F.col("word").isNull(), F.col("doc_id")).alias("doc_id"), "pos", term(F.col("word")).alias("term"))
    known = small(terms.select(F.col("term").alias("_term")), SMALL_ROWS)
    kept = each.join(known, F.col("term") == F.col("_term"), "left").where(F.col("_term").isNotNull() | F.col("term").isNull())
    return materialise(kept.select("row", "doc_id", "pos", "term"), "postings")


def row_totals(index: DataFrame) -> DataFrame:
    return index.where(F.col("term").isNull()).select("row", "doc_id", F.col("pos").cast("bigint").alias("n_words"))


def matches(index: DataFrame, windows: DataFrame, slop: int = 0) -> DataFrame:
    """(window, row, start) of every place where all terms of a window occur in order.

    With ``slop`` a term may lie up to so many words from its place, as counted from the rarest term.
    """
    postings = index.where(F.col("term").isNotNull()).select("row", "pos", "term")
    counts = postings.groupBy("term").agg(F.count(F.lit(1)).alias("count"))
    unique = windows.select("window", "terms", "n_terms").dropDuplicates(["window"])
    each = unique.select("window", "n_terms", F.posexplode("terms").alias("off", "term")).join(counts, "term", "left")
    rarest = Window.partitionBy("window").orderBy(F.coalesce("count", F.lit(0)), "term", "off")
    ranked = materialise(each.withColumn("rank", F.row_number().over(rarest)), "ranked")

    def placed(rank: int) -> DataFrame:
        wanted = small(ranked.where(F.col("rank") == rank), SMALL_ROWS)
        start = F.col("pos") - F.col("off")
        return postings.join(wanted, "term").select("window", "n_terms", "row", start.alias("start")).where(F.col("start") >= -slop)

    shift = F.explode(F.sequence(F.lit(-slop), F.lit(slop)))
    first = placed(1)
    second = placed(2).select("window", "row", F.col("start").alias("_start"))
    near = first.where(F.col("n_terms") > 1).select("*", shift.alias("_shift")).withColumn("_start", F.col("start") + F.col("_shift"))
    both = near.join(second, ["window", "row", "_start"]).select("window", "n_terms", "row", "start").distinct()
    left = materialise(first.where(F.col("n_terms") == 1).unionByName(both), "candidates")
    done = left.where(F.col("n_terms") <= 2).select("window", "row", "start")

    open_ = left.where(F.col("n_terms") > 2)
    others = small(ranked.where(F.col("rank") > 2).select("window", "off", "term"), SMALL_ROWS)
    probes = open_.join(others, "window").select("*", shift.alias("_shift"))
    probes = probes.withColumn("pos", F.col("start") + F.col("off") + F.col("_shift"))
    rows = small(open_.select("row").distinct(), SMALL_ROWS)
    found = probes.join(postings.join(rows, "row", "left_semi"), ["row", "pos", "term"])
    whole = found.groupBy("window", "row", "start", "n_terms").agg(F.countDistinct("off").alias("_found"))
    whole = whole.where(F.col("_found") == F.col("n_terms") - 2).select("window", "row", "start")
    return done.unionByName(whole)


def contamination(docs: DataFrame, items: DataFrame, length: int = WINDOW) -> DataFrame:
    """One row for every row of ``docs``: doc_id, n_words, n_hit, items (ids as strings, sorted).

    Null and empty texts have no words; an empty benchmark or table gives no hits or no rows.
    """
    prepared(docs.sparkSession)
    windows = test_windows(items, length)
    index = build_index(docs, windows.select(F.explode("terms").alias("term")).distinct())
    hits = materialise(matches(index, windows), "hits")
    sizes = small(windows.select("window", "n_terms").distinct(), SMALL_ROWS)
    words = hits.join(sizes, "window").select("row", F.explode(F.sequence(F.col("start"), F.col("start") + F.col("n_terms") - 1)).alias("pos"))
    n_hit = words.distinct().groupBy("row").agg(F.count(F.lit(1)).alias("n_hit"))
    named = small(windows.select("window", "item_id").where(F.col("item_id").isNotNull()), SMALL_ROWS)
    pairs = hits.select("window", "row").distinct().join(named, "window").select("row", "item_id").distinct()
    listed = pairs.groupBy("row").agg(F.array_sort(F.collect_list("item_id")).alias("items"))  # at most every test item
    found = n_hit.join(listed, "row", "left")
    return (
        row_totals(index)
        .join(found, "row", "left")
        .select(
            "doc_id",
            "n_words",
            F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        )
    )


def without_contaminated_rows(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs``, with all their columns, that have no hit themselves.

    The verdict goes by doc_id and text together, so null or repeated ids share none.
    """
    keyed = docs.select(F.xxhash64("doc_id", "text").alias("doc_id"), "text")
    bad = contamination(keyed, items).where(F.col("n_hit") > 0).select(F.col("doc_id").alias("_bad")).distinct()
    return docs.join(bad, F.xxhash64(docs["doc_id"], docs["text"]) == bad["_bad"], "left_anti")
