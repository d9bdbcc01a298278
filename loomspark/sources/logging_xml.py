"""Log items and namespaces of the logging XML, by Spark's own XML source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: All strings: bad numbers must reach the reject rules, not vanish in the reader.
ITEM = (
    "id string, timestamp string, contributor struct<_deleted: string, username: string, id: string, ip: string>, comment struct<_VALUE: string, _deleted: string>, "
    "type string, action string, logtitle string, params string"
)


def read_logitems(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """Raw items of .xml or .xml.gz files with surrounding blanks kept; ``limit`` counts items over all files."""
    reader = spark.read.format("xml").option("rowTag", "logitem").option("ignoreSurroundingSpaces", "false").schema(ITEM)
    items = reader.load(path)
    return items if limit is None else items.limit(limit)


def read_namespaces(spark: SparkSession, path: str) -> DataFrame:
    """``(prefix, namespace)``: lower-cased prefixes of siteinfo; the nameless main namespace is left out."""
    rows = spark.read.format("xml").option("rowTag", "namespace").schema("_key string, _VALUE string").load(path)
    named = rows.select(F.lower(F.trim("_VALUE")).alias("prefix"), F.trim("_key").try_cast("int").alias("namespace"))
    return named.where("prefix <> '' AND namespace IS NOT NULL").distinct()


def namespace_map(namespaces: DataFrame):
    """The prefixes as a map literal: a site has some dozens."""
    pairs = [(r.prefix, r.namespace) for r in namespaces.orderBy("prefix").collect()]
    if not pairs:
        return F.create_map().cast("map<string,int>")
    return F.create_map(*(F.lit(x) for p in pairs for x in p))
