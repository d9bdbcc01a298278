"""The shared actor dimension: distinct null-safe keys, stable ids, set-based resolution."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loomspark.session import written

KEYS = ("actor_user", "actor_name")


def empty_dimension(spark: SparkSession, like: DataFrame) -> DataFrame:
    """A dimension without actors, with the key types of ``like``."""
    return like.select(*KEYS).where("false").select(F.lit(None).cast("bigint").alias("actor_id"), *KEYS)


def distinct_keys(keys: DataFrame) -> DataFrame:
    """Distinct (user, name); null users count as equal, a null name is no actor."""
    return keys.select(*KEYS).where(F.col("actor_name").isNotNull()).distinct()


def assign_ids(keys: DataFrame, known: DataFrame) -> DataFrame:
    """``(actor_id, actor_user, actor_name)``: known actors keep their ids, new ones follow in key order.

    New ids are the largest known id plus the rank by (user, name), so they do not depend
    on arrival order.  The rank is counted inside ranges and shifted by the sizes of the
    ranges before; only that table of one row a range meets in one task.
    """
    k = known.select(*(F.col(c).alias(f"_{c}") for c in KEYS))
    new = keys.join(k, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in KEYS], "left_anti")
    order = [F.col("actor_user").asc_nulls_first(), F.col("actor_name")]
    parts = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # the partition number depends on range sampling, so both uses must see one result
    ranged = written(new.repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id()), "actors")
    sizes = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shift = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"))
    top = known.agg(F.coalesce(F.max("actor_id"), F.lit(0)).alias("_top"))
    nth = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    placed = ranged.withColumn("_nth", nth).join(shift, "_part").join(F.broadcast(top))  # one row
    made = placed.select((F.col("_top") + F.col("_shift") + F.col("_nth")).alias("actor_id"), *KEYS)
    return known.select("actor_id", *KEYS).unionByName(made)


def join_ids(rows: DataFrame, dimension: DataFrame) -> DataFrame:
    """All rows with their ``actor_id``; null where the name is null (suppressed or missing)."""
    d = dimension.select("actor_id", *(F.col(c).alias(f"_{c}") for c in KEYS))
    on = F.col("actor_user").eqNullSafe(F.col("_actor_user")) & (F.col("actor_name") == F.col("_actor_name"))
    return rows.join(d, on, "left").drop(*(f"_{c}" for c in KEYS))


def unresolved(rows: DataFrame) -> DataFrame:
    """Rows that name an actor but have no id: must be empty after a resolution."""
    return rows.where(F.col("actor_name").isNotNull() & F.col("actor_id").isNull())
