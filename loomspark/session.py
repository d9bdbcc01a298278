"""Session helpers."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

PACKAGE = __name__.partition(".")[0]


def build_session(cpus: int | str = "*", **conf: str) -> SparkSession:
    """A local session with the settings that tests and the bench share."""
    builder = SparkSession.builder.master(f"local[{cpus}]").config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false")
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def ensure_importable(spark: SparkSession) -> None:
    """Ship this package to the executors unless they can import it already."""
    context = spark.sparkContext
    if getattr(context, "_loom_ready", False):
        return
    name = PACKAGE

    def probe(batches):
        import importlib.util

        import pyarrow as pa

        for _ in batches:
            yield pa.RecordBatch.from_arrays([pa.array([importlib.util.find_spec(name) is not None])], names=["there"])

    there = spark.range(1, numPartitions=1).mapInArrow(probe, "there boolean").first()
    if there is None or not there.there:
        root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        context.addPyFile(shutil.make_archive(os.path.join(tempfile.mkdtemp(), name), "zip", root, name))
    context._loom_ready = True


def workspace(spark: SparkSession) -> str:
    """Folder that driver and executors share: ``spark.checkpoint.dir`` of the session.

    Only a local session that names none (tests) gets a temporary folder; elsewhere executors
    would write to disks of their own, so a missing setting is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="loom-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base


def written(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared folder and read it back; ``options`` are the writer's.

    A lost executor then costs no recomputation of what came before, and every
    consumer reads the same rows.
    """
    spark = df.sparkSession
    path = f"{workspace(spark)}/{name}-{uuid.uuid4().hex}"
    schema = df.schema
    df.write.options(**options).parquet(path)
    return spark.read.schema(schema).parquet(path)
