"""Session settings and shared scratch space."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join partition even when that costs one more shuffle for the
    # aggregate above it: a hot user may hold a third of the fact rows.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings the operators rely on."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str = "marquee", master: str | None = None, **settings) -> SparkSession:
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A machine-local folder is chosen only for a local master, where driver and
    executors share one machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    base = os.path.join(tempfile.gettempdir(), f"marquee-{spark.sparkContext.applicationId}")
    os.makedirs(base, exist_ok=True)
    return base


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder; nothing there is ever overwritten."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Give iterative jobs (ALS, trees) a reliable checkpoint folder."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(scratch_path(spark, "checkpoints"))


def materialise(df: DataFrame, name: str, rebalance: bool = False) -> DataFrame:
    """Write ``df`` as a shared table and read it back.

    Used where a result feeds several passes; unlike a cache it survives the loss
    of the executors that computed it. ``rebalance`` evens out the file sizes, for
    tables an iterative job reads many times.
    """
    path = scratch_path(df.sparkSession, name)
    (df.hint("rebalance") if rebalance else df).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
