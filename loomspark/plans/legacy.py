"""The older three-table model of talk pages: users, pages, revisions, first row seen wins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspark.functions.columns import iso_timestamp
from loomspark.operators.referential import insert_if_absent
from loomspark.schemas import LEGACY, TALK_NAMESPACES
from loomspark.sources.history import read_history


def talk_revisions(spark: SparkSession, path: str) -> DataFrame:
    """History rows of the talk namespaces."""
    return read_history(spark, path).where(F.col("page_namespace").isin(*TALK_NAMESPACES))


def users(history: DataFrame) -> DataFrame:
    """Registered contributors; anonymous ones have no row, though their revisions stay."""
    known = history.where("user_id IS NOT NULL").select(F.col("user_id").cast("int").alias("id"), F.col("user_name").alias("text"), F.col("user_deleted").alias("deleted"))
    return _first(known)


def pages(history: DataFrame) -> DataFrame:
    rows = history.select(F.col("page_id").cast("int").alias("id"), F.col("page_title").alias("title"), F.col("page_namespace").alias("namespace"), F.lit(None).cast("string").alias("restrictions"), F.lit(False).alias("deleted"))
    return _first(rows.where("id IS NOT NULL"))


def revisions(history: DataFrame) -> DataFrame:
    """One row a revision id, times as UTC without a zone."""
    rows = history.where("rev_id IS NOT NULL").select(
        F.col("rev_id").cast("int").alias("id"), iso_timestamp("timestamp").cast("timestamp_ntz").alias("timestamp"), F.col("user_id").cast("int").alias("user_id"), F.col("page_id").cast("int").alias("page_id"),
        "minor", "comment", "text", F.col("text_bytes").cast("int").alias("bytes"), "sha1", F.lit("wikitext").alias("model"), F.lit("text/x-wiki").alias("format"),
        F.col("text_deleted").alias("deleted_text"), F.col("comment_deleted").alias("deleted_comment"), F.col("user_deleted").alias("deleted_user"),
    )
    return _first(rows)


def _first(rows: DataFrame) -> DataFrame:
    """One row an id.  Which row came first is not known across tasks: the least by all columns counts."""
    rest = [c for c in rows.columns if c != "id"]
    return rows.groupBy("id").agg(F.min(F.struct(*rest)).alias("r")).select("id", *(F.col(f"r.{c}").alias(c) for c in rest))


def merge(have: dict[str, DataFrame], history: DataFrame) -> dict[str, DataFrame]:
    """The three tables with the rows of ``history`` whose ids they lack."""
    made = {"users": users(history), "pages": pages(history), "revisions": revisions(history)}
    return {n: insert_if_absent(have[n], made[n], ["id"]) if n in have else made[n] for n in LEGACY}
