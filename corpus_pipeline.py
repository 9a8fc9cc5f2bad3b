"""From raw documents to packed training sequences, in five stages.

Each stage takes the rows the one before kept and returns a DataFrame; ``run`` writes every stage's
result to the shared folder and reads it again for the next.

All stages judge row by row: null or shared ids share no verdict, repeated rows are rows of their own
until near-dedup, a null or empty text is a text without words, very long texts are read whole, an empty
table stays empty, and all columns of documents pass, others too, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marquee.llm import bagminhash, line_spread, packing, phrase_index, quality
from marquee.llm.queries import piece_digest, tokenizer_path
from marquee.llm.tables import documents, table
from marquee.session import materialise


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and the repetition limits; texts without words, null ones too, go."""
    return quality.keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that many sources share; a null source counts for none."""
    return line_spread.without_boilerplate(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies: the smallest doc_id, null last, then the first text key."""
    return bagminhash.one_of_each_label(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item, judged row by row."""
    return phrase_index.without_contaminated_rows(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences; a null text is empty and has its end id alone."""
    return piece_digest(packing.packed(docs, tokenizer_path("byte_bpe_50k.json")))


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("near-dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", pack),
]

#: Shingle classes and tokenisers are beyond SQL; the tests hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
