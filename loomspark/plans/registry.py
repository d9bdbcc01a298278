"""All queries by name, each with the SQL that an independent engine can run."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register a query under ``name`` with its SQL counterpart."""

    def add(f):
        QUERIES[name] = f
        if oracle:
            ORACLES[name] = oracle
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query(
    "yearly_filtered_counts",
    """SELECT CAST(year(o_orderdate) AS INTEGER) AS yr, o_orderpriority, count(*) AS n FROM orders
       WHERE o_orderstatus IN ('F', 'P') GROUP BY 1, 2""",
)
def yearly_filtered_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").where(F.col("o_orderstatus").isin("F", "P"))
    return orders.groupBy(F.year("o_orderdate").alias("yr"), "o_orderpriority").agg(F.count(F.lit(1)).alias("n")).orderBy("yr", "o_orderpriority")
