"""Counting and top-k shapes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """``(tbl, n)`` over named tables; Parquet footers answer each count."""
    parts = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("tbl"), "n") for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def count_by(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def yearly(df: DataFrame, at: str, *keys: str) -> DataFrame:
    return df.groupBy(F.year(at).alias("yr"), *keys).agg(F.count(F.lit(1)).alias("n"))


def top_k(df: DataFrame, k: int, *order: Column) -> DataFrame:
    """The first ``k`` rows; ``order`` must end in a unique key.  Plans as TakeOrderedAndProject."""
    return df.orderBy(*order).limit(k)
