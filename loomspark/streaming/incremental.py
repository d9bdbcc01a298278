"""Incremental loading as Structured Streaming: new files in, resolved rows out.

The dump project has no streams; this replaces its hand-made resume and finished-file
lists by a file source with a checkpoint.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from loomspark.operators import transforms, writing
from loomspark.operators.referential import not_loaded
from loomspark.sources.logging_xml import ITEM


def stream_logitems(spark: SparkSession, folder: str, files_at_once: int = 1) -> DataFrame:
    """Raw log items of XML files as they arrive in a folder."""
    reader = spark.readStream.format("xml").option("rowTag", "logitem").option("ignoreSurroundingSpaces", "false").option("maxFilesPerTrigger", files_at_once)
    return reader.schema(ITEM).load(folder)


def load_stream(items: DataFrame, base: str, spaces: Column, checkpoint: str) -> StreamingQuery:
    """Append each batch's new items to the tables.

    A batch that is run again finds its ids loaded and adds nothing, so a failure between
    the two table writes costs no duplicate.  Of actors only the new ones are written, and of
    the log ids there are only those in the batch's range are looked at.
    """

    def step(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        batch = batch.persist()
        log_id = F.col("id").try_cast("bigint")
        ends = batch.agg(F.min(log_id).alias("low"), F.max(log_id).alias("high")).first()
        near = writing.read_or_empty(spark, base, "logging").where(F.col("log_id").between(F.lit(ends.low), F.lit(ends.high)))
        parsed = not_loaded(transforms.parsed_logitems(batch, spaces), near, "log_id").dropDuplicates(["log_id"])
        known = writing.read_or_empty(spark, base, "actor")
        _, actors = transforms.logging_rows(parsed, known)
        new = actors.join(known.select("actor_id"), "actor_id", "left_anti")
        rows, _ = transforms.logging_rows(parsed, writing.write(new, base, "actor", "append"))
        writing.write(rows, base, "logging", "append")
        batch.unpersist()

    return items.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, at: str, key: str, width: str = "1 hour", late: str = "1 day") -> DataFrame:
    """Events by window and key, late ones within the watermark included."""
    return events.withWatermark(at, late).groupBy(F.window(at, width).alias("w"), key).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), key, "n")
