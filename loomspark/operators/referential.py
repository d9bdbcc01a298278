"""Semi and anti joins of the load: references, absence, watermarks, pending files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def accepted(rows: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    """Rows whose key the parent table holds."""
    return rows.join(parents.select(key), key, "left_semi")


def rejected(rows: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    """Rows whose key it lacks, null keys among them."""
    return rows.join(parents.select(key), key, "left_anti")


def insert_if_absent(have: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """``have`` and those rows of ``new`` whose key it lacks; of equal new keys the least row counts.

    Keys compare null-safely, as under a unique constraint that takes nulls as equal.
    """
    rest = [c for c in new.columns if c not in keys]
    one = new.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_row")).select(*keys, *(F.col(f"_row.{c}").alias(c) for c in rest)) if rest else new.distinct()
    h, n = have.select(*keys).alias("h"), one.alias("n")
    same = [F.col(f"h.{k}").eqNullSafe(F.col(f"n.{k}")) for k in keys]
    return have.unionByName(n.join(h, same, "left_anti").select(have.columns))


def above_watermark(rows: DataFrame, loaded: DataFrame, key: str) -> DataFrame:
    """Rows above the largest loaded key (0 if nothing is loaded); null keys pass, to be rejected later.

    The mark is a scalar subquery, so the filter can reach the scan.
    """
    mark = loaded.agg(F.coalesce(F.max(key), F.lit(0)).alias("_mark")).scalar()
    return rows.where(F.col(key).isNull() | (F.col(key) > mark))


def not_loaded(rows: DataFrame, loaded: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not loaded yet: a resume that does not need ascending input."""
    return rows.join(loaded.select(key), key, "left_anti")


def pending(files: DataFrame, finished: DataFrame, name: str) -> DataFrame:
    """Distinct files without the finished ones."""
    return files.select(name).distinct().join(finished.select(name), name, "left_anti")


def listed_files(spark, path: str) -> DataFrame:
    """``(file)``: the first column of a CSV list without a header, blank lines left out."""
    rows = spark.read.csv(path, schema="file string", enforceSchema=True, mode="PERMISSIVE", ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True)
    return rows.where("file IS NOT NULL AND file <> ''")
