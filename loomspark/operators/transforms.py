"""From raw source rows to typed table rows: log items, revisions, wikitext."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomspark.functions import columns as C
from loomspark.functions.params import log_params
from loomspark.schemas import TABLES
from loomspark.session import ensure_importable

from . import actors


def contributor(c: str) -> tuple[Column, Column, Column]:
    """(user id, name, suppressed): a ``deleted`` attribute hides both, an IP stands in for a name."""
    gone = F.col(f"{c}._deleted").isNotNull()
    name = F.coalesce(F.nullif(F.col(f"{c}.username"), F.lit("")), F.nullif(F.col(f"{c}.ip"), F.lit("")))
    return F.when(~gone, C.lenient_int(f"{c}.id")), F.when(~gone, name), F.coalesce(gone, F.lit(False))


def parsed_logitems(items: DataFrame, spaces: Column) -> DataFrame:
    """Log items with typed columns, the actor's natural key and a reject reason (null: usable)."""
    ensure_importable(items.sparkSession)
    user, name, gone = contributor("contributor")
    namespace, title = C.split_title("logtitle", spaces)
    hidden = F.coalesce(F.col("comment._deleted").isNotNull(), F.lit(False))
    at = C.iso_timestamp("timestamp")
    number = C.lenient_int("id")
    kind = F.nullif(F.col("type"), F.lit(""))
    reason = F.when(number.isNull(), "no id").when(kind.isNull(), "no type").when(F.col("timestamp").isNull(), "no timestamp").when(at.isNull(), "bad timestamp")
    return items.select(
        number.alias("log_id"), kind.alias("log_type"), C.default_action("action", kind).alias("log_action"), at.alias("log_timestamp"),
        user.alias("actor_user"), F.encode(name, "UTF-8").alias("actor_name"), namespace.alias("log_namespace"), F.encode(title, "UTF-8").alias("log_title"),
        F.when(~hidden, F.col("comment._VALUE")).alias("log_comment"), log_params("params").alias("log_params"), C.deleted_bits(hidden, gone).alias("log_deleted"), reason.alias("reject_reason"),
    )


def rejects(parsed: DataFrame) -> DataFrame:
    """``(reject_reason, n)`` of the items that a load leaves out."""
    return parsed.where("reject_reason IS NOT NULL").groupBy("reject_reason").agg(F.count(F.lit(1)).alias("n"))


def logging_rows(parsed: DataFrame, known_actors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(logging, actor): usable items with resolved actors, and the grown dimension.

    All keys of the input are resolved at once; known actors keep their ids.
    """
    usable = parsed.where("reject_reason IS NULL")
    dimension = actors.assign_ids(actors.distinct_keys(usable), known_actors)
    rows = actors.join_ids(usable, dimension)
    table = rows.select(*(F.lit(None).cast("bigint").alias(c) if c == "log_page" else F.col(SOURCE.get(c, c)).alias(c) for c in TABLES["logging"].columns))
    return table, dimension


SOURCE = {"log_actor": "actor_id", "log_actor_name": "actor_name"}


def parsed_revisions(history: DataFrame) -> DataFrame:
    """Stub revisions, typed.  Without a contributor, or without its name unless suppressed, a row is rejected."""
    at = C.iso_timestamp("timestamp")
    nameless = ~F.col("user_deleted") & (~F.col("has_contributor") | F.col("user_name").isNull())
    reason = F.when(F.col("rev_id").isNull(), "no id").when(at.isNull(), "bad timestamp").when(nameless, "no contributor")
    return history.select(
        "file", "rev_id", F.col("page_id").alias("rev_page"), "page_namespace", at.alias("rev_timestamp"), F.col("minor").alias("rev_minor"),
        F.when(~F.col("comment_deleted"), F.col("comment")).alias("rev_comment"), F.col("sha1").alias("rev_sha1"), F.col("text_bytes").alias("rev_len"),
        "rev_parent_id", F.col("user_id").alias("actor_user"), F.encode("user_name", "UTF-8").alias("actor_name"), reason.alias("reject_reason"),
    )


def revision_rows(parsed: DataFrame, known_actors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(revision, actor) of the usable rows."""
    usable = parsed.where("reject_reason IS NULL")
    dimension = actors.assign_ids(actors.distinct_keys(usable), known_actors)
    rows = actors.join_ids(usable, dimension).withColumn("rev_actor", F.col("actor_id"))
    return rows.select(*TABLES["revision"].columns), dimension


def revision_texts(history: DataFrame) -> DataFrame:
    """Wikitext rows: suppressed ones are left out, empty ones stay with no bytes.

    The length is that of the encoded text, whatever the file's ``bytes`` says.
    """
    seen = history.where("NOT text_deleted AND rev_id IS NOT NULL")
    return seen.select("rev_id", C.text_binary("text").alias("rev_text"), C.text_length("text").cast("bigint").alias("rev_text_bytes"))


def parse_counts(history: DataFrame) -> DataFrame:
    """``(file, seen, loaded, suppressed)``: what parsing yields, before any reference is checked."""
    gone = F.col("text_deleted")
    return history.groupBy("file").agg(F.count(F.lit(1)).alias("seen"), F.count_if(~gone).alias("loaded"), F.count_if(gone).alias("suppressed"))
