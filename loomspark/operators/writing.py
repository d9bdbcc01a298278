"""Sinks: checked table writes with overwrite or append, laid out for the queries that follow."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspark.schemas import TABLES, UNIQUE

from . import quality

#: How a table's files are laid out: range key, then order inside a file.
LAYOUT = {
    "page": (["page_namespace", "page_title"], []),
    "page_restrictions": (["pr_page"], []),
    "logging": (["log_type", "log_timestamp"], ["log_namespace", "log_title"]),
    "revision": (["rev_page"], ["rev_timestamp", "rev_actor"]),
    "revision_text": (["rev_id"], []),
    "change_tag": (["ct_rev_id"], ["ct_log_id"]),
}


def table_path(base: str, name: str) -> str:
    return f"{base}/{name}"


def read(spark: SparkSession, base: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name].schema).parquet(table_path(base, name))


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def read_or_empty(spark: SparkSession, base: str, name: str) -> DataFrame:
    if _exists(spark, table_path(base, name)):
        return read(spark, base, name)
    return spark.createDataFrame([], TABLES[name].schema)


def write(df: DataFrame, base: str, name: str, mode: str = "overwrite") -> DataFrame:
    """Write a table, its constraints checked on the written rows, and return it as read.

    ``overwrite`` writes beside the old table and swaps it in when all checks have passed,
    so a failed load leaves the old rows.  ``append`` checks keys against those there are.
    """
    spark, t = df.sparkSession, TABLES[name]
    staging = f"{base}/_staging/{name}-{uuid.uuid4().hex}"
    by, inside = LAYOUT.get(name, ([], []))
    out = df.select(t.columns)
    if by:
        # ranges are drawn from a pass of their own, so the rows are made before: a dump is parsed once
        rows = f"{staging}-rows"
        out.write.parquet(rows)
        out = spark.read.schema(t.schema).parquet(rows).repartitionByRange(*by).sortWithinPartitions(*by, *inside)
    out.write.parquet(staging)
    if by:
        _drop(spark, rows)
    fresh = spark.read.schema(t.schema).parquet(staging)
    quality.require_table(fresh, name, list(t.keys), list(t.required))
    if name in UNIQUE:
        quality.require_table(fresh, name, list(UNIQUE[name]), [])
    target = table_path(base, name)
    if mode == "append" and _exists(spark, target):
        # only keys in the new rows' range can meet theirs: the scan skips what lies beyond
        ends = fresh.agg(F.min(t.keys[0]).alias("low"), F.max(t.keys[0]).alias("high")).first()
        have = read(spark, base, name).select(*t.keys).where(F.col(t.keys[0]).between(F.lit(ends.low), F.lit(ends.high)))
        quality.require_table(have.unionByName(fresh.select(*t.keys)), name, list(t.keys), [])
        fresh.write.mode("append").parquet(target)
        _drop(spark, staging)
    else:
        _swap(spark, staging, target)
    return read(spark, base, name)


def _swap(spark: SparkSession, source: str, target: str) -> None:
    jvm = spark._jvm.org.apache.hadoop.fs
    a, b = jvm.Path(source), jvm.Path(target)
    system = b.getFileSystem(spark._jsc.hadoopConfiguration())
    old = jvm.Path(target + ".old")
    system.mkdirs(b.getParent())
    if system.exists(b):
        system.delete(old, True)
        system.rename(b, old)
    if not system.rename(a, b):
        raise OSError(f"{source} could not be moved to {target}")
    system.delete(old, True)


def _drop(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def publish(spark: SparkSession, base: str, name: str) -> None:
    """A loaded table under its name in the catalog, analysed; what stood there before is replaced, no file is touched."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    path = table_path(base, name).replace("'", "\\'")
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in TABLES[name].schema)
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet LOCATION '{path}'")
    analyze(spark, name)


def analyze(spark: SparkSession, name: str) -> None:
    """Column statistics of a catalog table, for the optimiser."""
    spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS FOR ALL COLUMNS")
