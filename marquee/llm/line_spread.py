"""Line dedup by distinct-site spread, in DataFrame operations only.

HyperLogLog sketches of the sites of every line are merged by aggregation. Lines near the threshold get
an exact count of distinct sites; lines on many sites are boilerplate and go from the documents. A text
counts for one site however many carry a copy of it, so the lines of a copied text are not boilerplate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.tables import prepared, small
from marquee.session import materialise

#: A line on so many sites or more is boilerplate.
MIN_SITES = 10
#: Lines of fewer characters are never boilerplate: headings and single words repeat by nature.
MIN_CHARACTERS = 20
#: 2 ** 10 registers: a standard error of 3 %. Estimates within a factor of BAND of the threshold are
#: counted exactly; a line outside would have to be off by more than fifteen standard errors.
SKETCH_BITS = 10
BAND = 2.0
#: Rows up to which a list of line keys, or of the positions to cut, is broadcast; beyond it is shuffled.
SMALL_KEYS, SMALL_HITS = 200_000, 100_000


def line_key(line: Column) -> Column:
    """Equal for lines that differ only in blanks at their ends."""
    return F.unhex(F.md5(F.trim(line)))


def _text_key() -> Column:
    return F.unhex(F.md5("text"))


def _row() -> Column:
    """Rows that share id and text are treated alike."""
    return F.concat_ws(":", F.col("doc_id").cast("string"), F.md5("text"))


def line_sites(docs: DataFrame, site: str) -> DataFrame:
    """(_row, _text, _site, pos, key) of every line that is long enough to be boilerplate."""
    held = docs.select(_row().alias("_row"), _text_key().alias("_text"), F.col(site).cast("string").alias("_site"), F.split("text", "\n").alias("lines"))
    each = held.select("_row", "_text", "_site", F.posexplode("lines").alias("pos", "line"))
    each = each.where(F.char_length(F.trim("line")) >= MIN_CHARACTERS)
    return each.select("_row", "_text", "_site", "pos", line_key(F.col("line")).alias("key"))


def spread_lines(lines: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """Keys of the lines (key, _text, _site) on at least ``min_sites`` sites.

    Equal texts count for the first of their sites; a null site counts for none.
    """
    # Most lines stand in fewer rows than a boilerplate line has sites: they need no sketch.
    frequent = lines.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_sites)
    frequent = materialise(frequent.select("key"), "frequent-lines")
    texts = lines.join(small(frequent, SMALL_KEYS), "key", "left_semi").groupBy("key", "_text").agg(F.min("_site").alias("_site"))
    # Distinct pairs: a line of a third of all rows is then as many rows as it has sites.
    pairs = materialise(texts.select("key", "_site").distinct(), "line-sites")
    sketched = pairs.groupBy("key").agg(F.hll_sketch_agg("_site", F.lit(SKETCH_BITS)).alias("sketch"))
    sketched = sketched.select("key", F.hll_sketch_estimate("sketch").alias("sites"))
    likely = sketched.where(F.col("sites") >= min_sites / BAND)
    near = likely.where(F.col("sites") <= min_sites * BAND).select("key")
    counted = pairs.join(small(near, SMALL_KEYS), "key", "left_semi")
    counted = counted.groupBy("key").agg(F.count("_site").alias("sites")).where(F.col("sites") >= min_sites)
    return likely.where(F.col("sites") > min_sites * BAND).select("key").unionByName(counted.select("key"))


def without_boilerplate(docs: DataFrame, site: str = "source", min_sites: int = MIN_SITES) -> DataFrame:
    """``docs``, all rows and columns, with boilerplate lines gone from text; n_chars follows, if there is one.

    A null or empty text stays as it is, a text of boilerplate only becomes empty, a null site counts for
    none, and repeated rows, as rows with equal doc_id and text, are treated alike; a line on just
    ``min_sites`` sites is boilerplate. Lines of very long texts are cut one by one. An empty table stays
    empty. Extra columns pass through, whatever their names.
    """
    return removed(docs, site, min_sites).select(*(F.col(f"`{c}`") for c in docs.columns))


def removed(docs: DataFrame, site: str = "source", min_sites: int = MIN_SITES) -> DataFrame:
    """As without_boilerplate, with a column n_removed_lines in front."""
    prepared(docs.sparkSession)
    lines = materialise(line_sites(docs, site), "lines")
    keys = materialise(spread_lines(lines, min_sites), "boilerplate")
    hits = lines.join(small(keys, SMALL_KEYS), "key", "left_semi").groupBy("_row")
    hits = materialise(hits.agg(F.collect_set("pos").alias("_positions")), "hits")  # at most the lines of one text
    own = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_doc")
    # Documents stream past a table of positions: whole texts are never sorted.
    joined = docs.select(own, _row().alias("_row")).join(small(hits, SMALL_HITS).hint("shuffle_hash"), "_row", "left")
    split = F.split("_doc.text", "\n")
    left = F.array_except(F.sequence(F.lit(0), F.size(split) - 1), F.col("_positions"))
    text = F.array_join(F.transform(left, lambda k: split[k]), "\n")
    changed = F.col("_positions").isNotNull()
    cut = joined.withColumn("_cut", F.when(changed, text))
    fresh = {"text": F.when(changed, F.col("_cut")).otherwise(F.col("_doc.text"))}
    if "n_chars" in docs.columns:
        fresh["n_chars"] = F.when(changed, F.char_length("_cut")).otherwise(F.col("_doc.n_chars"))
    columns = [
        (fresh[c].cast(docs.schema[c].dataType) if c in fresh else F.col("_doc").getField(c)).alias(c) for c in docs.columns
    ]
    n_removed = F.when(changed, F.size("_positions")).otherwise(0).cast("bigint").alias("n_removed_lines")
    return cut.select(n_removed, *columns)
