"""Assembly of one-row reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def as_struct(one_row: DataFrame) -> Column:
    """A one-row DataFrame as a scalar struct column."""
    return one_row.select(F.struct(*[F.col(c) for c in one_row.columns])).scalar()


def report_row(spark: SparkSession, *parts: DataFrame) -> DataFrame:
    """One row holding the columns of several one-row DataFrames side by side."""
    names = [f"_p{i}" for i in range(len(parts))]
    base = spark.range(1).select(*[as_struct(p).alias(n) for p, n in zip(parts, names)])
    return base.select(*[f"{n}.*" for n in names])
