"""Queries through the dump formats: rows of the driver's tables are written as SQL dump, logging
XML and page history, and loaded again by the sources and transforms that real dumps take.

Each SQL counterpart states what the loaded rows must be, from the tables alone.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomspark.operators import transforms
from loomspark.session import workspace
from loomspark.sources.history import read_history
from loomspark.sources.logging_xml import read_logitems
from loomspark.sources.mysqldump import read_dump

from .registry import query, table


def _folder(lines: DataFrame, name: str) -> str:
    """The lines as gzip files of a new folder."""
    path = f"{workspace(lines.sparkSession)}/{name}-{uuid.uuid4().hex}"
    lines.write.text(path, compression="gzip")
    return path


def _export(lines: DataFrame, head: str = "") -> DataFrame:
    """The lines of every partition, and so of every file, inside one root element and after ``head``."""

    def whole(batches):
        import pyarrow as pa

        def line(text: str) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([text])], names=["value"])

        yield line('<mediawiki xmlns="http://www.mediawiki.org/xml/export-0.11/">' + head)
        yield from batches
        yield line("</mediawiki>")

    return lines.select("value").mapInArrow(whole, "value string")


def _stamp(at: str, form: str = "yyyyMMddHHmmss") -> Column:
    return F.date_format(at, form)


def _quoted(c: Column) -> Column:
    """A string literal of a dump, its marks escaped."""
    for mark, escape in (("\\", "\\\\"), ("'", "\\'"), ("\n", "\\n"), ("\0", "\\0")):
        c = F.replace(c, F.lit(mark), F.lit(escape))
    return F.concat(F.lit("'"), c, F.lit("'"))


def _xml(c: Column) -> Column:
    for mark, escape in (("&", "&amp;"), ("<", "&lt;"), ("\r", "&#13;")):
        c = F.replace(c, F.lit(mark), F.lit(escape))
    return c


@query(
    "dump_load",
    r"""SELECT o_orderkey AS page_id, CAST(o_custkey % 4 AS INTEGER) AS page_namespace, 'It''s \ "' || o_orderpriority || chr(10) || 'é' AS page_title,
        o_orderstatus = 'F' AS page_is_redirect, o_orderstatus = 'O' AS page_is_new, o_totalprice AS page_random, CAST(epoch(o_orderdate) AS BIGINT) AS touched,
        CASE WHEN o_orderkey % 3 = 2 THEN CAST(epoch(o_orderdate) AS BIGINT) END AS links_updated, o_custkey AS page_latest, CAST(length(o_orderpriority) AS BIGINT) AS page_len,
        CASE WHEN o_orderkey % 2 = 0 THEN 'wikitext' END AS page_content_model, o_orderpriority AS page_lang FROM orders""",
)
def q_dump_load(spark, d):
    """Strings with escapes, ``_binary`` and hexadecimal literals, numbers, NULL and invalid times, three tuples an INSERT."""
    key, status, priority = F.col("o_orderkey"), F.col("o_orderstatus"), F.col("o_orderpriority")
    title = F.concat(F.lit("It's \\ \""), priority, F.lit("\né"))
    spelled = F.when(key % 2 == 0, _quoted(title)).when(key % 5 == 0, F.concat(F.lit("0x"), F.hex(F.encode(title, "UTF-8")))).otherwise(F.concat(F.lit("_binary "), _quoted(title)))
    updated = F.when(key % 3 == 0, "NULL").when(key % 3 == 1, "'00000000000000'").otherwise(_quoted(_stamp("o_orderdate")))
    values = [
        key, F.col("o_custkey") % 4, spelled, (status == "F").cast("int"), F.when(status == "O", "'1'").otherwise("'0'"), F.col("o_totalprice"), _quoted(_stamp("o_orderdate")),
        updated, F.col("o_custkey"), F.length(priority), F.when(key % 2 == 0, "'wikitext'").otherwise("NULL"), _quoted(priority),
    ]
    tuples = table(spark, d, "orders").select(F.floor(key / 3).alias("third"), F.concat(F.lit("("), F.concat_ws(",", *(v.cast("string") for v in values)), F.lit(")")).alias("row"))
    inserts = tuples.groupBy("third").agg(F.concat(F.lit("INSERT INTO `page` VALUES "), F.array_join(F.collect_list("row"), ","), F.lit(";")).alias("value"))
    other = inserts.select(F.replace("value", F.lit("`page`"), F.lit("`page_props`")).alias("value"))
    loaded = read_dump(spark, "page", f"{_folder(inserts.select('value').unionByName(other), 'dump')}/part-*")
    same = ["page_id", "page_namespace", "page_is_redirect", "page_is_new", "page_random", "page_latest", "page_len", "page_content_model", "page_lang"]
    return loaded.select(*same, F.decode("page_title", "UTF-8").alias("page_title"), F.unix_seconds("page_touched").alias("touched"), F.unix_seconds("page_links_updated").alias("links_updated"))


@query(
    "logging_load",
    """SELECT event_id AS log_id, event_type AS log_type, CASE WHEN event_id % 3 = 0 THEN event_type ELSE 'act' END AS log_action,
        CASE WHEN event_id % 50 NOT IN (7, 8) THEN CAST(floor(epoch(ts)) AS BIGINT) END AS at, CASE WHEN user_id % 5 > 1 THEN user_id END AS actor_user,
        CASE WHEN user_id % 5 = 1 THEN '10.0.0.' || user_id WHEN user_id % 5 > 1 THEN 'Ü & <' || user_id END AS actor_name,
        CAST(CASE WHEN event_id % 2 = 0 THEN 3 ELSE 0 END AS INTEGER) AS log_namespace, CASE WHEN event_id % 2 = 0 THEN 'A:' || user_id ELSE 'Odd: ' || user_id END AS log_title,
        CASE WHEN event_id % 7 <> 0 THEN 'on ' || event_type END AS log_comment,
        CASE event_id % 4 WHEN 0 THEN '{"4::user":"' || event_type || '","n":' || event_id || '}' WHEN 1 THEN '{"a":"' || event_type || '","b":[1,null]}'
             WHEN 2 THEN '{"raw":"' || event_type || '"}' END AS log_params,
        CAST((CASE WHEN event_id % 7 = 0 THEN 2 ELSE 0 END) | (CASE WHEN user_id % 5 = 0 THEN 4 ELSE 0 END) AS INTEGER) AS log_deleted,
        CASE event_id % 50 WHEN 7 THEN 'no timestamp' WHEN 8 THEN 'bad timestamp' END AS reject_reason FROM events""",
)
def q_logging_load(spark, d):
    """Users, addresses and suppressed contributors; parameters as PHP, JSON, plain text and none; two kinds of rejects."""
    n, user, kind = F.col("event_id"), F.col("user_id"), F.col("event_type")

    def tag(name: str, body: Column | str) -> Column:
        return F.concat(F.lit(f"<{name}>"), F.lit(body) if isinstance(body, str) else body.cast("string"), F.lit(f"</{name}>"))

    who = F.when(user % 5 == 0, '<contributor deleted="deleted" />').when(user % 5 == 1, tag("contributor", tag("ip", F.concat(F.lit("10.0.0."), user))))
    who = who.otherwise(tag("contributor", F.concat(tag("username", _xml(F.concat(F.lit("Ü & <"), user))), tag("id", user))))
    php = F.concat(F.lit('a:2:{s:7:"4::user";s:'), F.octet_length(kind), F.lit(':"'), kind, F.lit('";s:1:"n";i:'), n, F.lit(";}"))
    params = F.when(n % 4 == 0, php).when(n % 4 == 1, F.concat(F.lit('{"b": [1, null], "a": "'), kind, F.lit('"}'))).when(n % 4 == 2, kind).otherwise("")
    at = F.when(n % 50 == 7, "").when(n % 50 == 8, tag("timestamp", "soon")).otherwise(tag("timestamp", _stamp("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")))
    item = F.concat(
        tag("id", n), at, who, F.when(n % 7 == 0, '<comment deleted="deleted" />').otherwise(tag("comment", F.concat(F.lit("on "), kind))), tag("type", kind),
        F.when(n % 3 == 0, "<action />").otherwise("<action>act</action>"), tag("logtitle", F.concat(F.when(n % 2 == 0, "User talk:A:").otherwise("Odd: "), user)), tag("params", params),
    )
    folder = _folder(_export(table(spark, d, "events").select(tag("logitem", item).alias("value"))), "logging")
    parsed = transforms.parsed_logitems(read_logitems(spark, folder), F.create_map(F.lit("user talk"), F.lit(3)))
    same = ["log_id", "log_type", "log_action", "actor_user", "log_namespace", "log_comment", "log_params", "log_deleted", "reject_reason"]
    texts = (F.decode(c, "UTF-8").alias(c) for c in ("actor_name", "log_title"))
    return parsed.select(*same, *texts, F.unix_seconds("log_timestamp").alias("at"))


def _history_folder(spark, d) -> str:
    """Conversations as page histories: a turn is a revision, every fourth one suppressed."""
    turn, text = F.col("turn"), F.coalesce("text", F.lit(""))
    body = F.when(turn % 4 == 3, '<text bytes="5" deleted="deleted" />').otherwise(F.concat(F.lit('<text bytes="'), F.octet_length(text), F.lit('" xml:space="preserve">'), _xml(text), F.lit("</text>")))
    who = F.when(turn % 4 == 1, '<contributor deleted="deleted" />').when(turn % 4 == 2, "").otherwise(F.concat(F.lit("<contributor><username>"), "role", F.lit("</username><id>"), "conv_id", F.lit("</id></contributor>")))
    page = F.concat(F.lit("<page><title>Talk:T</title><ns>1</ns><id>"), "conv_id", F.lit("</id><revision><id>"), F.col("conv_id") * 1000 + turn, F.lit("</id>"))
    page = F.concat(page, F.when(turn > 0, F.concat(F.lit("<parentid>"), F.col("conv_id") * 1000 + turn - 1, F.lit("</parentid>"))).otherwise(""))
    page = F.concat(page, F.lit("<timestamp>2024-01-02T03:04:05Z</timestamp>"), who, F.when(turn % 2 == 0, "<minor />").otherwise(""))
    page = F.concat(page, F.lit("<comment>c</comment>"), body, F.lit("<sha1>s</sha1></revision></page>"))

    return _folder(_export(table(spark, d, "conversations").select(page.alias("value"))), "history")


def _history(spark, d) -> DataFrame:
    return read_history(spark, f"{_history_folder(spark, d)}/part-*")


@query(
    "history_load",
    """SELECT conv_id * 1000 + turn AS rev_id, conv_id AS rev_page, CAST(1 AS INTEGER) AS page_namespace, CAST(1704164645 AS BIGINT) AS at, turn % 2 = 0 AS rev_minor, 'c' AS rev_comment,
        's' AS rev_sha1, CASE WHEN turn % 4 = 3 THEN 5 ELSE CAST(strlen(coalesce(text, '')) AS BIGINT) END AS rev_len, CASE WHEN turn > 0 THEN conv_id * 1000 + turn - 1 END AS rev_parent_id,
        CASE WHEN turn % 4 IN (0, 3) THEN conv_id END AS actor_user, CASE WHEN turn % 4 IN (0, 3) THEN role END AS actor_name,
        CASE WHEN turn % 4 = 2 THEN 'no contributor' END AS reject_reason FROM conversations""",
)
def q_history_load(spark, d):
    parsed = transforms.parsed_revisions(_history(spark, d))
    same = ["rev_id", "rev_page", "page_namespace", "rev_minor", "rev_comment", "rev_sha1", "rev_len", "rev_parent_id", "actor_user", "reject_reason"]
    return parsed.select(*same, F.decode("actor_name", "UTF-8").alias("actor_name"), F.unix_seconds("rev_timestamp").alias("at"))


@query(
    "history_text_load",
    """SELECT conv_id * 1000 + turn AS rev_id, coalesce(text, '') AS rev_text, CAST(strlen(coalesce(text, '')) AS BIGINT) AS rev_text_bytes
       FROM conversations WHERE turn % 4 <> 3""",
)
def q_history_text_load(spark, d):
    return transforms.revision_texts(_history(spark, d)).select("rev_id", F.decode("rev_text", "UTF-8").alias("rev_text"), "rev_text_bytes")
