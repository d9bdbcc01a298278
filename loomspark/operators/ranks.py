"""Ranks inside groups of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loomspark.session import written


def ranked(rows: DataFrame, keys: list[str], order: list[str], name: str = "rank") -> DataFrame:
    """``rows`` with the number, from 0, of each row among those of its keys, by ``order`` (which must not tie).

    The sorted rows are cut into ranges that count for themselves and add what the ranges
    before them hold, so a key of very many rows is no task's alone.  Rows with a null key
    leave.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.dropna(subset=keys).repartitionByRange(parts, *keys, *order).withColumn("_part", F.spark_partition_id())
    ranged = written(ranged, "ranges")  # the bounds come from a sample: they must not move
    inside = ranged.withColumn("_nth", F.row_number().over(Window.partitionBy(*keys, "_part").orderBy(*order)) - 1)
    counts = ranged.groupBy(*keys, "_part").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(*keys, "_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    return inside.join(before, [*keys, "_part"]).select(*rows.columns, (F.col("_nth") + F.col("_before")).alias(name))
