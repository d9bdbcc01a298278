"""Latest row of each key, in the two forms that differ on ties."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_row(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row a key: the largest by ``order``, whose last column breaks ties.

    ``max_by`` combines map-side, so a hot key costs one row a task, where a ranking
    window would sort all its rows in one place.
    """
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_best"))
    return best.select(*(F.col(c) if c in keys else F.col(f"_best.{c}").alias(c) for c in df.columns))


def latest_rows_with_ties(df: DataFrame, keys: list[str], at: str) -> DataFrame:
    """Every row whose ``at`` is its key's largest; ties give several."""
    last = df.groupBy(*keys).agg(F.max(at).alias(at))
    return df.join(last, [*keys, at], "left_semi")
