"""Constraint and fidelity checks, as DataFrames of violations and as assertions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class ConstraintError(ValueError):
    """Rows break a declared constraint."""


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that more than one row has, nulls taken as equal, with their row count ``n``."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row with the number of nulls of each column."""
    return df.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in columns))


def require_table(df: DataFrame, name: str, keys: list[str], required: list[str]) -> DataFrame:
    """``df`` itself, or an error that names the null columns or duplicate keys."""
    nulls = null_counts(df, required).first().asDict() if required else {}
    if bad := {c: n for c, n in nulls.items() if n}:
        raise ConstraintError(f"{name}: nulls in required columns: {bad}")
    if keys and (row := duplicate_keys(df, keys).first()) is not None:
        raise ConstraintError(f"{name}: key {[row[k] for k in keys]} occurs {row.n} times")
    return df


def require_rows(tables: dict[str, DataFrame], loaders: dict[str, str]) -> None:
    """Every table holds a row; the error names the loader to run again."""
    if missing := [name for name, df in tables.items() if df.isEmpty()]:
        raise ConstraintError("; ".join(f"{n} is empty: run {loaders.get(n, 'its loader')}" for n in missing))


def require_reference(rows: DataFrame, parents: DataFrame, key: str) -> None:
    """No row refers to a parent that is not there."""
    orphans = rows.where(F.col(key).isNotNull()).join(parents.select(key), key, "left_anti")
    if (row := orphans.first()) is not None:
        raise ConstraintError(f"{key} {row[key]} has no parent")


def require_at_most(part: DataFrame, whole: DataFrame, what: str) -> None:
    if (a := part.count()) > (b := whole.count()):
        raise ConstraintError(f"{what}: {a} rows against {b}")


def within_share(n: Column, expected: Column, percent: int) -> Column:
    """Whether a count is within ``percent`` of what is expected, in whole numbers."""
    return F.abs(n - expected) * 100 <= expected * percent


def file_state(size: Column, sha1: Column, seen_size: Column, seen_sha1: Column) -> Column:
    """What a file on disk is worth: missing, partial (to resume), failed (too large), mismatch or ok."""
    return (
        F.when(seen_size.isNull(), "missing")
        .when(seen_size > size, "failed")
        .when(seen_size < size, "partial")
        .when(sha1.isNull() | (seen_sha1 == sha1), "ok")
        .otherwise("mismatch")
    )


def text_mismatches(stored: DataFrame, given: DataFrame, key: str, text: str) -> DataFrame:
    """Keys of ``given`` whose text hash differs from the stored one, or that are not stored."""
    a = stored.select(key, F.sha1(text).alias("stored_sha1"))
    b = given.select(key, F.sha1(text).alias("given_sha1"))
    return b.join(a, key, "left").where(~F.col("given_sha1").eqNullSafe(F.col("stored_sha1")))


def content_hash(df: DataFrame) -> tuple[int, str]:
    """Row count and an order-free hash of all values, for snapshots."""
    row = df.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)"))).first()
    return row[0], str(row[1] or 0)
