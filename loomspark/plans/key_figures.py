"""The sentinel statements over the dump tables, and the legacy latest-revision queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspark.functions.columns import escaped_bytes
from loomspark.operators import latest
from loomspark.operators.counts import count_by, row_counts, top_k, yearly

Tables = dict[str, DataFrame]

#: Tables whose rows the first figure counts: all but the wikitext.
COUNTED = ("page", "page_restrictions", "protected_titles", "user_groups", "user_former_groups", "change_tag", "change_tag_def", "logging", "revision", "actor")


def connection(spark: SparkSession) -> DataFrame:
    """Where the figures come from: catalog, user, Spark version."""
    return spark.range(1).select(F.current_database().alias("database"), F.current_user().alias("user"), F.version().alias("version"))


def kf01_row_counts(t: Tables) -> DataFrame:
    return row_counts({n: t[n] for n in COUNTED})


def kf02_pages_by_namespace(t: Tables) -> DataFrame:
    return count_by(t["page"], "page_namespace").withColumnRenamed("n", "pages").orderBy("page_namespace")


def kf03_restrictions(t: Tables) -> DataFrame:
    return count_by(t["page_restrictions"], "pr_type", "pr_level").orderBy("pr_type", "pr_level")


def kf04_creation_protection(t: Tables) -> DataFrame:
    return count_by(t["protected_titles"], "pt_create_perm").orderBy("pt_create_perm")


def kf05_log_types(t: Tables) -> DataFrame:
    return count_by(t["logging"], "log_type").orderBy(F.desc("n"), "log_type")


def kf06_protection_by_year(t: Tables) -> DataFrame:
    events = t["logging"].where(F.col("log_type").isin("protect", "unprotect", "move_prot"))
    return yearly(events, "log_timestamp", "log_type").orderBy("yr", "log_type")


def kf07_recent_protections(t: Tables) -> DataFrame:
    events = top_k(t["logging"].where("log_type = 'protect'"), 5, F.desc("log_timestamp"), F.desc("log_id"))
    return events.select("log_timestamp", "log_namespace", escaped_bytes("log_title").alias("title"), "log_params")


def kf08_revisions_by_year(t: Tables) -> DataFrame:
    return yearly(t["revision"], "rev_timestamp").withColumnRenamed("n", "revisions").orderBy("yr")


def kf09_actors(t: Tables) -> DataFrame:
    user = F.col("actor_user")
    return t["actor"].agg(F.count_if(user.isNotNull()).alias("registered"), F.count_if(user.isNull()).alias("anon"), F.count(F.lit(1)).alias("total"))


def kf10_groups(t: Tables) -> DataFrame:
    return top_k(count_by(t["user_groups"], "ug_group").withColumnRenamed("n", "members"), 15, F.desc("members"), F.col("ug_group"))


def kf11_top_admins(t: Tables) -> DataFrame:
    # actors are few against events: count by id first, then look up ten names' worth
    per = t["logging"].where("log_type = 'protect' AND log_actor IS NOT NULL").groupBy(F.col("log_actor").alias("actor_id")).agg(F.count(F.lit(1)).alias("protect_actions"))
    named = per.join(t["actor"], "actor_id")
    return top_k(named, 10, F.desc("protect_actions"), F.col("actor_id")).select(escaped_bytes("actor_name").alias("admin"), "protect_actions")


def kf12_protected_pages(t: Tables, normalized: bool = False) -> DataFrame:
    """First protected pages with their last protect event.

    Titles are compared as stored.  The XML's keep spaces where the page table has
    underscores, so ``normalized`` compares the event's title with underscores.
    """
    pages = t["page_restrictions"].join(t["page"], F.col("pr_page") == F.col("page_id"))
    first = top_k(pages, 10, F.col("page_namespace"), F.col("page_title"), F.col("pr_id"))
    first = first.select("pr_id", "page_title", "page_namespace", "pr_type", "pr_level", "pr_expiry")
    title = F.encode(F.replace(F.decode("log_title", "ISO-8859-1"), F.lit(" "), F.lit("_")), "ISO-8859-1") if normalized else F.col("log_title")
    events = t["logging"].where("log_type = 'protect'").select("log_namespace", title.alias("event_title"), "log_timestamp")
    wanted = first.select(F.col("page_namespace").alias("log_namespace"), F.col("page_title").alias("event_title")).distinct()
    last = events.join(F.broadcast(wanted), ["log_namespace", "event_title"], "left_semi").groupBy("log_namespace", "event_title").agg(F.max("log_timestamp").alias("last_protect_event"))
    both = first.join(last, (F.col("page_namespace") == F.col("log_namespace")) & (F.col("page_title") == F.col("event_title")), "left")
    return both.orderBy("page_namespace", "page_title", "pr_id").select(escaped_bytes("page_title").alias("title"), "page_namespace", "pr_type", "pr_level", "pr_expiry", "last_protect_event")


FIGURES: dict[str, Callable[[Tables], DataFrame]] = {f.__name__: f for f in (
    kf01_row_counts, kf02_pages_by_namespace, kf03_restrictions, kf04_creation_protection, kf05_log_types, kf06_protection_by_year, kf07_recent_protections,
    kf08_revisions_by_year, kf09_actors, kf10_groups, kf11_top_admins, kf12_protected_pages,
)}


def visible_talk(pages: DataFrame, revisions: DataFrame, cutoff: str, namespace: int = 1) -> DataFrame:
    """Revisions of one namespace up to a real instant, none of whose flags is set or unknown."""
    p = pages.where((F.col("namespace") == namespace) & ~F.col("deleted")).select(F.col("id").alias("page_id"), "title")
    shown = ~F.col("deleted_text") & ~F.col("deleted_comment") & ~F.col("deleted_user")
    r = revisions.where((F.col("timestamp") <= F.lit(cutoff).cast("timestamp_ntz")) & shown).withColumnRenamed("id", "revision_id")
    return r.join(p, "page_id")


def latest_talk(pages: DataFrame, revisions: DataFrame, cutoff: str) -> DataFrame:
    """One latest visible revision a page; of equal times the highest id."""
    return latest.latest_row(visible_talk(pages, revisions, cutoff), ["page_id"], ["timestamp", "revision_id"])


def latest_talk_with_ties(pages: DataFrame, revisions: DataFrame, cutoff: str) -> DataFrame:
    """Every visible revision at its page's latest time."""
    return latest.latest_rows_with_ties(visible_talk(pages, revisions, cutoff), ["page_id"], "timestamp")
