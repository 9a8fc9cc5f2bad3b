"""Registration of named queries with their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.plans.views import Views, with_views
from marquee.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

DIGITS = 6


def presentable(df: DataFrame) -> DataFrame:
    """Doubles to six digits and timestamps without a zone, so results compare across engines."""
    changed = {}
    for field in df.schema.fields:
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            changed[field.name] = F.round(F.col(field.name).cast("double"), DIGITS)
        elif isinstance(field.dataType, T.TimestampType):
            changed[field.name] = F.col(field.name).cast("timestamp_ntz")
    return df.withColumns(changed) if changed else df


def query(name: str, sql: str | None = None, *ctes: str):
    """Register a function of the adapter views under ``name``, with the SQL it must agree with."""

    def register(build: Callable[[Views], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return presentable(build(Views(configure(spark), folder)))

        run.__name__ = name
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_views(sql, *ctes)
        return build

    return register
