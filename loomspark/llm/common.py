"""Shared plumbing: Arrow row streams, folds, hashing; ``written`` cuts lineage (see session)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspark.session import ensure_importable, written

__all__ = ["arrow_schema", "bounded_sample", "crc_fold", "map_arrow", "read_table", "runs", "signed", "spread", "text_bytes", "written"]


def read_table(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """A scan of fewer splits than the cluster has cores, dealt to all of them; any larger one as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def map_arrow(df: DataFrame, fn, schema: str) -> DataFrame:
    """``mapInArrow`` over ``fn(batch_as_dict_of_columns) -> dict of columns or None``."""
    ensure_importable(df.sparkSession)
    names = list(df.columns)
    fields = schema_names(schema)
    arrow = arrow_schema(df.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = fn({n: batch.column(i) for i, n in enumerate(names)})
            if out is not None:
                yield pa.RecordBatch.from_arrays([to_arrow(out[f], arrow.field(f).type) for f in fields], schema=arrow)

    return df.mapInArrow(run, schema)


def to_arrow(values, kind: pa.DataType) -> pa.Array:
    if isinstance(values, pa.Array):
        return values
    return pa.array(values, type=kind)


def schema_names(schema: str) -> list[str]:
    from pyspark.sql.types import StructType

    return StructType.fromDDL(schema).names


def arrow_schema(spark: SparkSession, schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(schema))


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each value; null counts as empty."""
    return [v or b"" for v in column.cast(pa.binary()).to_pylist()]


def crc_fold(column: str, parts: int):
    """crc32 of the decimal text of an id, modulo ``parts``."""
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(parts))


def bounded_sample(rows: DataFrame, most: int, size: int) -> list:
    """Rows of ``rows`` (doc_id, text, ..) by the hash of id and text: at most ``most``, up to ``size`` characters.

    The least hashes are taken until the characters are used up, so a text of any length can be
    among them; the text that crosses the bound is the last.  Equal rows count once.
    """
    hashed = rows.withColumn("at", F.xxhash64("doc_id", "text"))
    taken, bound = 0, None
    for r in hashed.select("at", F.length("text").alias("n")).distinct().orderBy("at").limit(most).collect():
        if taken >= size:
            break
        taken, bound = taken + (r.n or 0), r.at
    return [] if bound is None else hashed.where(F.col("at") <= bound).dropDuplicates(["at"]).orderBy("at").limit(most).collect()


def signed(values: np.ndarray) -> np.ndarray:
    """Unsigned 64-bit numbers as Spark's signed longs, bit by bit."""
    return np.ascontiguousarray(values, dtype=np.uint64).view(np.int64)


def runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of maximal runs of equal neighbours."""
    if not len(values):
        empty = np.zeros(0, dtype=np.int64)
        return empty, empty
    start = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1])))
    return start, np.append(start[1:], len(values))
