"""Reading, batching and grouping helpers shared by the operators of this package."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.session import configure

BATCH_BYTES = "8m"
BATCH_ROWS = "512"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepared(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def prepared(spark: SparkSession) -> SparkSession:
    """Session settings of the library, and batches cut by size so that rows with long values stay bounded."""
    configure(spark)
    spark.conf.set("spark.sql.parquet.columnarReaderBatchSize", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return spark


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def id_and_text(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The two columns an operator reads, under fixed names; a null text is empty."""
    return docs.select(F.col(key).cast("bigint").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))


def chunks(batches, size: int = 2_000_000) -> Iterator[tuple[list, list[bytes]]]:
    """(ids, texts as UTF-8) of whole documents, about ``size`` bytes at a time; first column id, second text."""
    ids: list = []
    texts: list[bytes] = []
    held = 0
    for batch in batches:
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1).cast("binary").to_pylist()):
            text = text or b""
            ids.append(key)
            texts.append(text)
            held += len(text) + 64
            if held >= size:
                yield ids, texts
                ids, texts, held = [], [], 0
    if ids:
        yield ids, texts


def release_memory() -> None:
    """Give back what earlier tasks of this worker process have kept: encoders' word tables and freed pages."""
    encoders = sys.modules.get("tokenizers")
    if encoders is not None:
        encoders.__dict__.pop("_word_encoders", None)
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # another C library has no such call
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def small(df: DataFrame, most_rows: int) -> DataFrame:
    """``df`` marked for broadcast if a count proves it to have few rows; otherwise as it is."""
    return F.broadcast(df) if df.limit(most_rows + 1).count() <= most_rows else df
