"""Scans: text logs, CSV, Parquet, JSON documents, and sources that may be absent."""

from __future__ import annotations

import ctypes
import ctypes.util
import hashlib
import sys
from collections.abc import Callable, Iterator
from functools import partial
from typing import BinaryIO

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee import schemas
from marquee.functions.parsing import flatten_movies
from marquee.session import materialise

# Ship the functions that run in tasks inside them, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Bytes up to which a file is hashed as one row, and bytes that one task reads where it can seek.
LARGE_FILE = 1 << 30
STRETCH = 256 << 20
HASHED = "path STRING, file_hash STRING"
#: Bytes of OpenSSL's SHA256_CTX: 28 words of 4 bytes.
CONTEXT = 112
#: A hash under way: OpenSSL's SHA256_CTX as bytes, null before the first stretch, and the digest after the last.
UNDER_WAY = "path STRING, length BIGINT, state BINARY, file_hash STRING"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def log_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def csv_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV with a header, read by an explicit schema; malformed fields become NULL."""
    return spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").csv(path)


def optional_table(spark: SparkSession, path: str, schema: str, kind: str = "parquet") -> DataFrame:
    """The table at ``path``, or an empty one of the same schema when nothing is there."""
    reader = spark.read.schema(schema)
    if kind == "csv":
        reader = reader.option("header", True)
    try:
        return reader.format(kind).load(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def step_table(spark: SparkSession, path: str, rows: Callable[[], DataFrame]) -> DataFrame:
    """The table at ``path``; it is made of ``rows`` first, if no earlier run has finished it."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:  # not there, or begun and not finished
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        rows().write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)


def movie_documents(spark: SparkSession, folder: str, one_per_file: bool = True) -> DataFrame:
    """Flat movie rows from a folder of JSON documents; an empty folder is an error."""
    try:
        documents = spark.read.schema(schemas.MOVIE_DOCUMENT).option("multiLine", one_per_file).json(folder)
        files = documents.inputFiles()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        files = []
    if not files:
        raise ValueError(f"no movie documents in {folder}")
    return flatten_movies(documents)


def telemetry_document(spark: SparkSession, path: str, one_per_file: bool = True) -> dict[str, DataFrame]:
    """The arrays of legacy telemetry documents as tables; absent arrays are empty tables.

    The n-th response time belongs to the n-th served list.
    """
    document = spark.read.schema(schemas.TELEMETRY_DOCUMENT).option("multiLine", one_per_file).json(path)

    def rows(array: str) -> DataFrame:
        return document.select(F.explode(array).alias("r")).select("r.*").withColumn(
            "timestamp", F.col("timestamp").try_cast("timestamp")
        )

    served = document.select(
        F.posexplode("recommendations").alias("p", "r"), "response_times"
    ).select("r.*", F.get("response_times", F.col("p")).alias("response_time"))
    return {
        "recommendations": served.withColumn("timestamp", F.col("timestamp").try_cast("timestamp")),
        "interactions": rows("user_interactions"),
        "quality": rows("recommendation_quality").withColumn("rating", F.col("rating").try_cast("double")),
        "errors": rows("errors"),
        "deployments": rows("model_versions"),
    }


def file_listing(spark: SparkSession, path: str) -> str:
    """One hash over the names, sizes and times of all files under ``path``; no file is opened."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    each = F.sha2(F.concat_ws(":", "path", "length", F.unix_micros("modificationTime")), 256)
    # Hashes are added up digit by digit, so the order of the files has no say and nothing is collected.
    parts = [F.sum(F.conv(F.substring(each, 8 * k + 1, 8), 16, 10).cast("bigint")).alias(f"p{k}") for k in range(8)]
    return ":".join(str(p) for p in found.select("path", "length", "modificationTime").agg(*parts).first())


def file_fingerprints(spark: SparkSession, path: str) -> DataFrame:
    """SHA-256 of every file under ``path``; a single row 'unknown' when there is none.

    Files are hashed in tasks, a file a row. In a mounted folder, one of more than STRETCH bytes is read in rounds
    whose tasks take it a stretch further and hand on the state of the hash. Elsewhere, one of more than LARGE_FILE
    bytes is read by the JVM of the driver through the file system of its path, one such file after another.
    """
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.range(1).select(F.lit(path).alias("path"), F.lit("unknown").alias("file_hash"))
    some = files.select("path").first()
    mounted = some is not None and some["path"].startswith("file:")
    most = min(LARGE_FILE, STRETCH) if mounted else LARGE_FILE
    hashed = files.filter(F.col("length") <= most).select("path", F.sha2("content", 256).alias("file_hash"))
    large = files.filter(F.col("length") > most).select("path", "length")
    if mounted:
        return hashed.unionByName(_hashed_in_rounds(large))
    streamed = [(r["path"], _streamed_hash(spark, r["path"])) for r in large.toLocalIterator()]
    return hashed.unionByName(spark.createDataFrame(streamed, HASHED))


def _hashed_in_rounds(files: DataFrame) -> DataFrame:
    """SHA-256 of (path, length) files; a round takes every file one stretch further, each in a task."""
    longest = files.agg(F.max("length")).first()[0] or 0
    state = files.select("path", "length", F.lit(None).cast("binary").alias("state"), F.lit(None).cast("string").alias("file_hash"))
    for at in range(0, longest, STRETCH):
        # Spread evenly: a stretch may take a second.
        state = materialise(state.repartition("path").mapInArrow(partial(_next_stretch, at=at, most=STRETCH), UNDER_WAY), "hashes")
    return state.select("path", "file_hash")


def _sha256() -> ctypes.CDLL | None:
    """OpenSSL's SHA-256, whose state is plain bytes; None where the library or these calls are missing."""
    try:
        found = ctypes.CDLL(ctypes.util.find_library("crypto"))
        text = ctypes.c_char_p
        for call, kinds in (("Init", [text]), ("Update", [text, text, ctypes.c_size_t]), ("Final", [text, text])):
            getattr(found, f"SHA256_{call}").argtypes = kinds
        return found
    except (AttributeError, OSError, TypeError):
        return None


def _next_stretch(batches: Iterator[pa.RecordBatch], at: int, most: int) -> Iterator[pa.RecordBatch]:
    """Bytes ``at`` to ``at + most`` of files named as file:/folder/name, unescaped, added to their hashes.

    Without OpenSSL a file is hashed whole at once.
    """
    library = _sha256()
    for batch in batches:
        if not batch.num_rows:
            continue
        done = []
        for path, length, state, digest in zip(*(batch.column(i).to_pylist() for i in range(4))):
            if digest is None:
                with open("/" + path.removeprefix("file:").lstrip("/"), "rb") as file:
                    if library is None:
                        digest = hashlib.file_digest(file, "sha256").hexdigest()
                    else:
                        state, digest = _advanced(library, file, state, at, most, at + most >= length)
            done.append((path, length, state, digest))
        kinds = (pa.string(), pa.int64(), pa.binary(), pa.string())
        columns = [pa.array(column, kind) for column, kind in zip(zip(*done), kinds)]
        yield pa.RecordBatch.from_arrays(columns, ["path", "length", "state", "file_hash"])


def _advanced(library: ctypes.CDLL, file: BinaryIO, state: bytes | None, at: int, most: int, last: bool) -> tuple[bytes, str | None]:
    """The state of a hash after a stretch, and the digest if it is the last; that one ends with the file."""
    context = ctypes.create_string_buffer(state or b"", CONTEXT)
    if state is None:
        library.SHA256_Init(context)
    file.seek(at)
    while last or most:
        chunk = file.read(1 << 20 if last else min(1 << 20, most))
        if not chunk:
            break
        library.SHA256_Update(context, chunk, len(chunk))
        most -= len(chunk)
    if not last:
        return context.raw, None
    digest = ctypes.create_string_buffer(32)
    library.SHA256_Final(digest, context)
    return b"", digest.raw.hex()


def _streamed_hash(spark: SparkSession, path: str) -> str:
    """SHA-256 of one file, read by the JVM a buffer at a time."""
    jvm = spark.sparkContext._jvm
    file = jvm.org.apache.hadoop.fs.Path(path)
    stream = file.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(file)
    try:
        return jvm.org.apache.commons.codec.digest.DigestUtils.sha256Hex(stream)
    finally:
        stream.close()
