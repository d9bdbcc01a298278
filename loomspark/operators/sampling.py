"""Samples for spot checks, with seeds so that a rerun draws the same."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bernoulli(df: DataFrame, fraction: float = 1e-5, rows: int = 5, seed: int = 1) -> DataFrame:
    """Each row with the given chance, at most ``rows``; reads no more than it must."""
    return df.sample(fraction=fraction, seed=seed).limit(rows)


def shuffled(df: DataFrame, rows: int = 5, seed: int = 1) -> DataFrame:
    """``rows`` rows at random from a small table: a top-k over a random key."""
    return df.orderBy(F.rand(seed)).limit(rows)


def spot_rows(df: DataFrame, fraction: float = 1e-5, rows: int = 5, seed: int = 1) -> DataFrame:
    """The Bernoulli sample, or the shuffled one where it draws nothing."""
    drawn = bernoulli(df, fraction, rows, seed)
    return drawn if not drawn.isEmpty() else shuffled(df, rows, seed)
