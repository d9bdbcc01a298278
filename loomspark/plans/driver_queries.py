"""Queries over the driver's tables, one for each relational operator of the dump engine.

The dump tables have no counterpart among the driver's, so each operator is shown on a
table of the same shape: ``events`` stands for log events, ``orders`` for revisions,
``customer`` for actors, ``documents`` for wikitext.  Every result has a total order or
none that matters, every tie a rule.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loomspark.functions import columns as C
from loomspark.functions.keywords import keyword_hits
from loomspark.operators import actors, latest, quality, referential
from loomspark.operators.counts import count_by, row_counts, top_k, yearly

from . import format_queries, load_queries, research, study_queries  # noqa: F401 (all but research register their own queries)
from .registry import ORACLES, QUERIES, query, table

__all__ = ["ORACLES", "QUERIES"]

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "labels", "conversations", "pages")


@query("row_counts", " UNION ALL ".join(f"SELECT '{t}' AS tbl, count(*) AS n FROM {t}" for t in TABLES))
def q_row_counts(spark: SparkSession, d: str) -> DataFrame:
    return row_counts({t: table(spark, d, t) for t in TABLES})


@query("count_by_key", "SELECT c_nationkey, count(*) AS n FROM customer GROUP BY 1")
def q_count_by_key(spark, d):
    return count_by(table(spark, d, "customer"), "c_nationkey")


@query("count_by_two_keys", "SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY 1, 2")
def q_count_by_two_keys(spark, d):
    return count_by(table(spark, d, "lineitem"), "l_returnflag", "l_linestatus")


@query("count_by_permission", "SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1")
def q_count_by_permission(spark, d):
    return count_by(table(spark, d, "orders"), "o_orderpriority")


@query("events_by_type", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def q_events_by_type(spark, d):
    return count_by(table(spark, d, "events"), "event_type").orderBy(F.desc("n"), "event_type")


@query(
    "latest_events_sample",
    """SELECT ts, event_id, user_id, json_extract_string(props, '$.k') AS k FROM events
       WHERE event_type = 'purchase' ORDER BY ts DESC, event_id DESC LIMIT 5""",
)
def q_latest_events_sample(spark, d):
    events = table(spark, d, "events").where("event_type = 'purchase'")
    picked = top_k(events, 5, F.desc("ts"), F.desc("event_id"))
    return picked.select("ts", "event_id", "user_id", F.get_json_object("props", "$.k").alias("k"))


@query("yearly_counts", "SELECT CAST(year(o_orderdate) AS INTEGER) AS yr, count(*) AS n FROM orders GROUP BY 1")
def q_yearly_counts(spark, d):
    return yearly(table(spark, d, "orders"), "o_orderdate")


@query(
    "conditional_counts",
    """SELECT count(*) FILTER (WHERE c_acctbal > 0) AS positive, count(*) FILTER (WHERE c_acctbal <= 0) AS other,
       count(*) AS total FROM customer""",
)
def q_conditional_counts(spark, d):
    bal = F.col("c_acctbal")
    return table(spark, d, "customer").agg(F.count_if(bal > 0).alias("positive"), F.count_if(bal <= 0).alias("other"), F.count(F.lit(1)).alias("total"))


@query("top_groups", "SELECT p_brand, count(*) AS n FROM part GROUP BY 1 ORDER BY n DESC, p_brand LIMIT 15")
def q_top_groups(spark, d):
    return top_k(count_by(table(spark, d, "part"), "p_brand"), 15, F.desc("n"), F.col("p_brand"))


@query(
    "top_actors_join",
    """SELECT c_name, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus = 'F'
       GROUP BY c_custkey, c_name ORDER BY n DESC, c_name LIMIT 10""",
)
def q_top_actors_join(spark, d):
    # counting by key first leaves one row a customer to join
    per = table(spark, d, "orders").where("o_orderstatus = 'F'").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    named = per.join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).select("c_name", "n")
    return top_k(named, 10, F.desc("n"), F.col("c_name"))


@query(
    "entity_last_event",
    """SELECT c_custkey, n_name, c_mktsegment,
       (SELECT max(o_orderdate) FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F') AS last_event
       FROM customer JOIN nation ON c_nationkey = n_nationkey ORDER BY c_nationkey, c_custkey LIMIT 10""",
)
def q_entity_last_event(spark, d):
    people = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    first = top_k(people, 10, F.col("c_nationkey"), F.col("c_custkey")).select("c_custkey", "n_name", "c_mktsegment")
    # ten rows are left: only their events are aggregated
    orders = table(spark, d, "orders").where("o_orderstatus = 'F'")
    own = orders.join(first.select(F.col("c_custkey").alias("o_custkey")), "o_custkey", "left_semi")
    last = own.groupBy("o_custkey").agg(F.max("o_orderdate").alias("last_event"))
    return first.join(last, first.c_custkey == last.o_custkey, "left").drop("o_custkey")


@query(
    "latest_row_per_key",
    """SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM (
       SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS nth FROM orders) WHERE nth = 1""",
)
def q_latest_row_per_key(spark, d):
    orders = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    return latest.latest_row(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"])


@query(
    "latest_row_ties",
    """SELECT o.o_custkey, o.o_orderkey, o.o_orderdate FROM orders o
       JOIN (SELECT o_custkey, max(o_orderdate) AS m FROM orders GROUP BY 1) x ON o.o_custkey = x.o_custkey AND o.o_orderdate = x.m""",
)
def q_latest_row_ties(spark, d):
    orders = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return latest.latest_rows_with_ties(orders, ["o_custkey"], "o_orderdate")


@query(
    "asof_cutoff_latest",
    """SELECT o_custkey, o_orderkey, o_orderdate FROM (
       SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS nth FROM orders
       WHERE o_orderdate <= TIMESTAMP '1998-01-01 00:00:00' AND o_orderstatus <> 'P') WHERE nth = 1""",
)
def q_asof_cutoff_latest(spark, d):
    visible = table(spark, d, "orders").where("o_orderdate <= TIMESTAMP_NTZ '1998-01-01 00:00:00' AND o_orderstatus <> 'P'")
    return latest.latest_row(visible.select("o_custkey", "o_orderkey", "o_orderdate"), ["o_custkey"], ["o_orderdate", "o_orderkey"])


_ACTOR_KEYS = "SELECT nullif(user_id % 7, 0) AS actor_user, event_type AS actor_name FROM events"


def _event_keys(spark, d) -> DataFrame:
    return table(spark, d, "events").select(F.expr("nullif(user_id % 7, 0)").alias("actor_user"), F.col("event_type").alias("actor_name"))


@query("actor_dimension", f"SELECT DISTINCT actor_user, actor_name FROM ({_ACTOR_KEYS})")
def q_actor_dimension(spark, d):
    return actors.distinct_keys(_event_keys(spark, d))


@query(
    "actor_resolution_join",
    f"""SELECT a.actor_user, a.actor_name, count(*) AS n FROM ({_ACTOR_KEYS}) e
        JOIN (SELECT DISTINCT actor_user, actor_name FROM ({_ACTOR_KEYS})) a
        ON e.actor_user IS NOT DISTINCT FROM a.actor_user AND e.actor_name = a.actor_name GROUP BY 1, 2""",
)
def q_actor_resolution_join(spark, d):
    keys = _event_keys(spark, d)
    known = actors.assign_ids(actors.distinct_keys(keys), actors.empty_dimension(spark, keys))
    found = actors.join_ids(keys, known)
    return found.groupBy("actor_user", "actor_name").agg(F.count("actor_id").alias("n"))


@query("referential_filter", "SELECT doc_id, quality FROM labels WHERE doc_id IN (SELECT doc_id FROM documents WHERE lang = 'en')")
def q_referential_filter(spark, d):
    parents = table(spark, d, "documents").where("lang = 'en'")
    return referential.accepted(table(spark, d, "labels"), parents, "doc_id").select("doc_id", "quality")


@query("referential_rejects", "SELECT doc_id, quality FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents WHERE lang = 'en')")
def q_referential_rejects(spark, d):
    parents = table(spark, d, "documents").where("lang = 'en'")
    return referential.rejected(table(spark, d, "labels"), parents, "doc_id").select("doc_id", "quality")


@query(
    "insert_if_absent",
    """SELECT s_suppkey AS id, s_name AS name FROM supplier
       UNION ALL SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT s_suppkey FROM supplier)""",
)
def q_insert_if_absent(spark, d):
    have = table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    new = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    return referential.insert_if_absent(have, new, ["id"])


@query(
    "resume_watermark",
    """SELECT event_id, event_type FROM events
       WHERE event_id > (SELECT coalesce(max(event_id), 0) FROM events WHERE ts < TIMESTAMP '2024-01-15 00:00:00')""",
)
def q_resume_watermark(spark, d):
    events = table(spark, d, "events")
    loaded = events.where("ts < TIMESTAMP_NTZ '2024-01-15 00:00:00'")
    return referential.above_watermark(events, loaded, "event_id").select("event_id", "event_type")


@query(
    "pending_files",
    """SELECT DISTINCT 'part-' || CAST(l_partkey AS VARCHAR) || '.7z' AS file FROM lineitem WHERE l_partkey NOT IN (
       SELECT l_partkey FROM lineitem WHERE l_suppkey % 7 = 1)""",
)
def q_pending_files(spark, d):
    lines = table(spark, d, "lineitem").select("l_suppkey", F.concat(F.lit("part-"), F.col("l_partkey").cast("string"), F.lit(".7z")).alias("file"))
    return referential.pending(lines.select("file"), lines.where("l_suppkey % 7 = 1").select("file"), "file")


@query("duplicate_keys", "SELECT text AS key, count(*) AS n FROM documents GROUP BY 1 HAVING count(*) > 1")
def q_duplicate_keys(spark, d):
    return quality.duplicate_keys(table(spark, d, "documents"), ["text"]).withColumnRenamed("text", "key")


@query(
    "null_violations",
    """SELECT count(*) FILTER (WHERE k IS NULL) AS k, count(*) FILTER (WHERE event_type IS NULL) AS event_type
       FROM (SELECT nullif(user_id % 5, 0) AS k, event_type FROM events)""",
)
def q_null_violations(spark, d):
    rows = table(spark, d, "events").select(F.expr("nullif(user_id % 5, 0)").alias("k"), "event_type")
    return quality.null_counts(rows, ["k", "event_type"])


@query("text_bytes", "SELECT doc_id, CAST(strlen(coalesce(text, '')) AS BIGINT) AS n_bytes FROM documents")
def q_text_bytes(spark, d):
    return table(spark, d, "documents").select("doc_id", C.text_length("text").cast("bigint").alias("n_bytes"))


@query("text_sha1", "SELECT sha1(text) AS sha1, count(*) AS n FROM documents GROUP BY 1")
def q_text_sha1(spark, d):
    return table(spark, d, "documents").groupBy(F.sha1(F.encode("text", "UTF-8")).alias("sha1")).agg(F.count(F.lit(1)).alias("n"))


@query("base64_bytes", "SELECT conv_id, turn, base64(encode(text)) AS b64 FROM conversations")
def q_base64_bytes(spark, d):
    return table(spark, d, "conversations").select("conv_id", "turn", F.regexp_replace(F.base64(F.encode("text", "UTF-8")), "\r\n", "").alias("b64"))


@query("json_field_counts", "SELECT json_extract_string(props, '$.k') AS k, count(*) AS n FROM events GROUP BY 1")
def q_json_field_counts(spark, d):
    return table(spark, d, "events").groupBy(F.get_json_object("props", "$.k").alias("k")).agg(F.count(F.lit(1)).alias("n"))


_MW = """CASE o_orderkey % 5 WHEN 0 THEN 'infinity' WHEN 1 THEN '0000' || strftime(o_orderdate, '%m%d%H%M%S')
         WHEN 2 THEN strftime(o_orderdate, '%Y') || '0230000000' ELSE strftime(o_orderdate, '%Y%m%d%H%M%S') END"""


@query(
    "mw_timestamp_parse",
    f"""SELECT o_orderkey, CASE WHEN regexp_matches(raw, '^[0-9]{{14}}$') AND raw NOT LIKE '0000%' THEN try_strptime(raw, '%Y%m%d%H%M%S') END AS ts
        FROM (SELECT o_orderkey, {_MW} AS raw FROM orders)""",
)
def q_mw_timestamp_parse(spark, d):
    at, form = F.col("o_orderdate"), "yyyyMMddHHmmss"
    pick = F.col("o_orderkey") % 5
    raw = F.when(pick == 0, "infinity").when(pick == 1, F.concat(F.lit("0000"), F.date_format(at, "MMddHHmmss")))
    raw = raw.when(pick == 2, F.concat(F.date_format(at, "yyyy"), F.lit("0230000000"))).otherwise(F.date_format(at, form))
    return table(spark, d, "orders").select("o_orderkey", C.mw_timestamp(raw).cast("timestamp_ntz").alias("ts"))


_TITLE = "CASE o_orderkey % 3 WHEN 0 THEN 'User talk:' || o_orderpriority WHEN 1 THEN 'X: ' || o_orderpriority ELSE o_orderpriority END"


@query(
    "title_split",
    f"""SELECT o_orderkey, CAST(CASE WHEN lower(split_part(t, ':', 1)) = 'user talk' AND t LIKE '%:%' THEN 3 ELSE 0 END AS INTEGER) AS namespace,
        CASE WHEN lower(split_part(t, ':', 1)) = 'user talk' AND t LIKE '%:%' THEN substr(t, position(':' IN t) + 1) ELSE t END AS title
        FROM (SELECT o_orderkey, {_TITLE} AS t FROM orders)""",
)
def q_title_split(spark, d):
    name = F.col("o_orderpriority")
    pick = F.col("o_orderkey") % 3
    title = F.when(pick == 0, F.concat(F.lit("User talk:"), name)).when(pick == 1, F.concat(F.lit("X: "), name)).otherwise(name)
    spaces = F.create_map(F.lit("user talk"), F.lit(3), F.lit("talk"), F.lit(1))
    namespace, rest = C.split_title(title, spaces)
    return table(spark, d, "orders").select("o_orderkey", namespace.alias("namespace"), rest.alias("title"))


@query(
    "action_default",
    """SELECT event_type, coalesce(nullif(CASE WHEN user_id % 3 = 0 THEN '' WHEN user_id % 3 = 1 THEN NULL ELSE 'x' END, ''), event_type) AS action, count(*) AS n
       FROM events GROUP BY 1, 2""",
)
def q_action_default(spark, d):
    raw = F.when(F.col("user_id") % 3 == 0, "").when(F.col("user_id") % 3 == 2, "x")
    rows = table(spark, d, "events").select("event_type", C.default_action(raw, F.col("event_type")).alias("action"))
    return count_by(rows, "event_type", "action")


@query(
    "deleted_bitmask",
    """SELECT CAST((CASE WHEN user_id % 2 = 0 THEN 2 ELSE 0 END) | (CASE WHEN user_id % 3 = 0 THEN 4 ELSE 0 END) AS INTEGER) AS deleted, count(*) AS n
       FROM events GROUP BY 1""",
)
def q_deleted_bitmask(spark, d):
    mask = C.deleted_bits(F.col("user_id") % 2 == 0, F.col("user_id") % 3 == 0)
    return count_by(table(spark, d, "events").select(mask.alias("deleted")), "deleted")


@query(
    "namespace_parity",
    """SELECT c_nationkey % 2 = 1 AS is_talk, CAST(c_nationkey - c_nationkey % 2 AS INTEGER) AS subject_namespace, count(*) AS n
       FROM customer GROUP BY 1, 2""",
)
def q_namespace_parity(spark, d):
    rows = table(spark, d, "customer").select(C.is_talk("c_nationkey").alias("is_talk"), C.subject_namespace("c_nationkey").alias("subject_namespace"))
    return count_by(rows, "is_talk", "subject_namespace")


@query("html_title", "SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title FROM pages")
def q_html_title(spark, d):
    return table(spark, d, "pages").select("page_id", F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"))


_SIGNED = """':' || role || ' [[User:U' || CAST(conv_id AS VARCHAR) || '|u]] ' || lpad(CAST(turn % 24 AS VARCHAR), 2, '0') || ':05, '
             || CAST(1 + conv_id % 28 AS VARCHAR) || ' January 2020 (UTC)'"""


def _signed_lines(spark, d) -> DataFrame:
    line = F.format_string(":%s [[User:U%d|u]] %s:05, %d January 2020 (UTC)", F.col("role"), F.col("conv_id"), F.lpad((F.col("turn") % 24).cast("string"), 2, "0"), 1 + F.col("conv_id") % 28)
    return table(spark, d, "conversations").select("conv_id", "turn", line.alias("line"))


@query(
    "signature_extract",
    rf"""SELECT conv_id, turn, regexp_extract(line, '\[\[User:(.+?)\|', 1) AS author,
        regexp_extract(line, '([0-9]{{2}}:[0-9]{{2}}, [0-9]{{1,2}} [A-Za-z]+ [0-9]{{4}}) \(UTC\)', 1) AS stamp,
        CAST(length(line) - length(ltrim(line, ':')) AS INTEGER) AS indentation
        FROM (SELECT conv_id, turn, {_SIGNED} AS line FROM conversations)""",
)
def q_signature_extract(spark, d):
    line = "line"
    return _signed_lines(spark, d).select("conv_id", "turn", C.signature_user(line).alias("author"), C.signature_date(line).alias("stamp"), C.indentation(line).alias("indentation"))


@query(
    "message_thread",
    """WITH m AS (SELECT conv_id, turn, role, ':' || role AS line, lpad(CAST(turn % 24 AS VARCHAR), 2, '0') || ':05, ' || CAST(1 + conv_id % 28 AS VARCHAR) || ' January 2020' AS stamp
         FROM conversations),
       n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, line) AS id, rank() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS before FROM m)
       SELECT conv_id, CAST(id AS INTEGER) AS id, 'Thread' AS section, 'U' || CAST(conv_id AS VARCHAR) AS author, stamp,
         CASE WHEN id = 1 THEN 'Thread' || chr(10) ELSE '' END || role || ' u ' || stamp || ' (UTC)' AS content,
         CAST(before AS INTEGER) AS reply_to, CAST(turn + 1 AS INTEGER) AS indentation FROM n""",
)
def q_message_thread(spark, d):
    """Messages of talk pages built from the conversations, each turn one level deeper."""
    from loomspark.functions.talk import talk_messages

    line = F.concat(F.expr("repeat(':', CAST(turn AS INT))"), F.col("line"))
    lines = _signed_lines(spark, d).select("conv_id", "turn", line.alias("line"))
    pages = lines.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "line"))).alias("ls"))
    text = F.concat(F.lit("== Thread ==\n"), F.array_join(F.col("ls.line"), "\n"))
    found = talk_messages(pages.select("conv_id", text.alias("text")), "conv_id", "text")
    return found.withColumn("reply_to", F.coalesce("reply_to", F.lit(0)))


_WORDS = "('idiot', 'the', 'que', 'und')"


@query(
    "keyword_match",
    f"""SELECT doc_id, word, count(*) AS n FROM (
        SELECT doc_id, unnest(regexp_extract_all(lower(text), '[a-zà-öø-ÿß]+')) AS word FROM documents) WHERE word IN {_WORDS} GROUP BY 1, 2""",
)
def q_keyword_match(spark, d):
    words = spark.createDataFrame([("idiot",), ("the",), ("que",), ("und",)], "word string")
    return keyword_hits(table(spark, d, "documents"), words, "doc_id", "text")


@query(
    "score_by_group",
    """SELECT lang, count(*) AS n, round(avg(toxic), 9) AS mean_toxic, round(avg(quality), 9) AS mean_quality
       FROM labels JOIN documents USING (doc_id) GROUP BY 1""",
)
def q_score_by_group(spark, d):
    scored = table(spark, d, "labels").join(table(spark, d, "documents").select("doc_id", "lang"), "doc_id")
    return scored.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("toxic"), 9).alias("mean_toxic"), F.round(F.avg("quality"), 9).alias("mean_quality"))


@query(
    "file_status",
    """SELECT CASE WHEN seen IS NULL THEN 'missing' WHEN seen > want THEN 'failed' WHEN seen < want THEN 'partial'
       WHEN same THEN 'ok' ELSE 'mismatch' END AS status, count(*) AS n, CAST(sum(want) AS BIGINT) AS bytes
       FROM (SELECT n_chars AS want, CASE doc_id % 5 WHEN 0 THEN NULL WHEN 1 THEN n_chars + 1 WHEN 2 THEN n_chars - 1 ELSE n_chars END AS seen,
             doc_id % 5 = 3 AS same FROM documents) GROUP BY 1""",
)
def q_file_status(spark, d):
    pick = F.col("doc_id") % 5
    seen = F.when(pick == 1, F.col("n_chars") + 1).when(pick == 2, F.col("n_chars") - 1).when(pick > 2, F.col("n_chars"))
    hashed = F.when(pick == 3, "a").otherwise("b")
    state = quality.file_state(F.col("n_chars"), F.lit("a"), seen, hashed)
    return table(spark, d, "documents").groupBy(state.alias("status")).agg(F.count(F.lit(1)).alias("n"), F.sum("n_chars").alias("bytes"))


@query(
    "parse_counters",
    """SELECT source, count(*) AS seen, count(*) FILTER (WHERE n_chars >= 500) AS loaded, count(*) FILTER (WHERE n_chars < 500) AS skipped
       FROM documents GROUP BY 1""",
)
def q_parse_counters(spark, d):
    size = F.col("n_chars")
    return table(spark, d, "documents").groupBy("source").agg(F.count(F.lit(1)).alias("seen"), F.count_if(size >= 500).alias("loaded"), F.count_if(size < 500).alias("skipped"))


@query("top_types_parsed", "SELECT event_type, count(*) AS n FROM events GROUP BY 1 ORDER BY n DESC, event_type LIMIT 10")
def q_top_types_parsed(spark, d):
    return top_k(count_by(table(spark, d, "events"), "event_type"), 10, F.desc("n"), F.col("event_type"))


@query(
    "watermark",
    """SELECT loader, coalesce(max(event_id), 0) AS watermark FROM (SELECT unnest(['click', 'none such', 'view']) AS loader)
       LEFT JOIN events ON event_type = loader GROUP BY 1""",
)
def q_watermark(spark, d):
    loaders = spark.createDataFrame([("click",), ("none such",), ("view",)], "loader string")
    last = table(spark, d, "events").groupBy(F.col("event_type").alias("loader")).agg(F.max("event_id").alias("last"))
    return loaders.join(last, "loader", "left").select("loader", F.coalesce("last", F.lit(0).cast("bigint")).alias("watermark"))


@query("natural_part_order", "SELECT DISTINCT 'stub' || CAST(o_orderkey % 12 AS VARCHAR) || '.xml.gz' AS file, o_orderkey % 12 AS part FROM orders")
def q_natural_part_order(spark, d):
    file = F.concat(F.lit("stub"), (F.col("o_orderkey") % 12).cast("string"), F.lit(".xml.gz"))
    return table(spark, d, "orders").select(file.alias("file")).distinct().withColumn("part", C.part_number("file")).orderBy("part", "file")


@query(
    "content_fidelity",
    """SELECT count(*) AS compared, count(*) FILTER (WHERE sha1(a.text) = sha1(b.text)) AS equal FROM documents a
       JOIN documents b ON b.doc_id = (SELECT min(c.doc_id) FROM documents c WHERE c.n_chars = a.n_chars AND c.lang = a.lang) AND a.doc_id <> b.doc_id""",
)
def q_content_fidelity(spark, d):
    """Each document against the first of the same size and language: a size alone does not make a text equal."""
    docs = table(spark, d, "documents").select("doc_id", "n_chars", "lang", F.sha1(F.encode("text", "UTF-8")).alias("sha1"))
    first = docs.groupBy("n_chars", "lang").agg(F.min(F.struct("doc_id", "sha1")).alias("first"))
    both = docs.join(first, ["n_chars", "lang"]).where("doc_id <> first.doc_id")
    return both.agg(F.count(F.lit(1)).alias("compared"), F.count_if(F.col("sha1") == F.col("first.sha1")).alias("equal"))


@query("relative_difference", "SELECT user_id, count(*) AS n, abs(count(*) - 66) * 100 <= 66 * 10 AS within_share FROM events GROUP BY 1")
def q_relative_difference(spark, d):
    counted = count_by(table(spark, d, "events"), "user_id")
    return counted.withColumn("within_share", quality.within_share(F.col("n"), F.lit(66), 10))


@query("set_difference", "SELECT DISTINCT o_custkey AS id FROM orders EXCEPT SELECT s_suppkey FROM supplier")
def q_set_difference(spark, d):
    return table(spark, d, "orders").select(F.col("o_custkey").alias("id")).subtract(table(spark, d, "supplier").select(F.col("s_suppkey").alias("id")))


# -- research statistics: specified by the documents only, hence marked x_ ------------------

_SECONDS = "epoch_us(ts)"


@query(
    "x_inertia",
    f"""SELECT event_id, count(*) OVER (PARTITION BY user_id, event_type ORDER BY {_SECONDS} RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS inertia
        FROM events""",
)
def q_x_inertia(spark, d):
    return research.inertia(_timed(spark, d), ["user_id", "event_type"], "t").select("event_id", "inertia")


def _timed(spark, d) -> DataFrame:
    return table(spark, d, "events").withColumn("t", F.unix_micros(F.col("ts").cast("timestamp")))


@query(
    "x_subset_repetition",
    """WITH h AS (SELECT event_type || strftime(ts, '%Y%m%d%H') AS id, date_trunc('hour', min(ts)) AS t, list_sort(list_distinct(list(user_id % 10))) AS s FROM events GROUP BY 1)
       SELECT a.id, (SELECT count(*) FROM h b WHERE b.t < a.t AND list_has_all(b.s, a.s)) AS prior FROM h a""",
)
def q_x_subset_repetition(spark, d):
    # an hour of one event type is a hyperevent over user classes
    hour = F.concat("event_type", F.date_format("ts", "yyyyMMddHH")).alias("id")
    events = table(spark, d, "events").groupBy(hour).agg(F.date_trunc("hour", F.min("ts")).alias("t"), F.collect_set(F.col("user_id") % 10).alias("members"))
    return research.subset_repetition(events, "id", "t", "members").withColumnRenamed("repetition", "prior")


@query(
    "x_lookback_activity",
    f"""SELECT event_id, round(ln(1 + count(*) OVER (PARTITION BY user_id ORDER BY {_SECONDS} RANGE BETWEEN 86400000000 PRECEDING AND 1 PRECEDING)), 9) AS day_activity FROM events""",
)
def q_x_lookback_activity(spark, d):
    return research.lookback_activity(_timed(spark, d), "user_id", "t", {"day_activity": 86_400_000_000}).select("event_id", "day_activity")


@query(
    "x_interevent_median",
    f"""SELECT event_type, CAST(median(gap) AS DOUBLE) AS median_gap FROM (
        SELECT event_type, {_SECONDS} - lag({_SECONDS}) OVER (PARTITION BY event_type, user_id ORDER BY {_SECONDS}, event_id) AS gap FROM events) WHERE gap IS NOT NULL GROUP BY 1""",
)
def q_x_interevent_median(spark, d):
    return research.interevent_median(_timed(spark, d), ["event_type"], ["user_id"], "t", "event_id")


@query(
    "x_text_bytes_stats",
    "SELECT lang, round(avg(n_chars), 9) AS mean_size, median(n_chars) AS median_size FROM documents GROUP BY 1",
)
def q_x_text_bytes_stats(spark, d):
    return table(spark, d, "documents").groupBy("lang").agg(F.round(F.avg("n_chars"), 9).alias("mean_size"), F.median("n_chars").alias("median_size"))


@query(
    "x_null_edit_share",
    """SELECT count(*) AS n, count(*) FILTER (WHERE a.o_orderpriority = b.o_orderpriority) AS same FROM orders a JOIN orders b ON b.o_orderkey = a.o_orderkey - 1""",
)
def q_x_null_edit_share(spark, d):
    orders = table(spark, d, "orders").select(F.col("o_orderkey").alias("rev_id"), (F.col("o_orderkey") - 1).alias("rev_parent_id"), F.col("o_orderpriority").alias("rev_sha1"))
    return research.null_edits(orders)


@query(
    "x_popularity",
    f"""SELECT event_id, count(*) OVER (PARTITION BY event_type ORDER BY {_SECONDS} RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS popularity FROM events""",
)
def q_x_popularity(spark, d):
    return research.inertia(_timed(spark, d), ["event_type"], "t", "popularity", width=3_600_000_000).select("event_id", "popularity")


@query(
    "x_access_tier",
    """SELECT user_id, CASE WHEN n >= 60 AND days >= 28 THEN 'extended-confirmed' WHEN n >= 10 AND days >= 4 THEN 'auto-confirmed' ELSE 'new' END AS tier
       FROM (SELECT user_id, count(*) AS n, date_diff('day', min(ts)::DATE, max(ts)::DATE) AS days FROM events GROUP BY 1)""",
)
def q_x_access_tier(spark, d):
    events = table(spark, d, "events")
    seen = events.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.date_diff(F.max("ts"), F.min("ts")).alias("days"))
    return seen.select("user_id", research.access_tier(F.col("n"), F.col("days"), extended=(60, 28)).alias("tier"))


@query(
    "x_return_share",
    """SELECT count(*) AS stays, count(*) FILTER (WHERE back) AS returned FROM (
       SELECT a.event_id, bool_or(b.event_id IS NOT NULL) AS back FROM events a LEFT JOIN events b
       ON a.user_id = b.user_id AND b.event_type = 'click' AND b.ts > a.ts AND b.ts <= a.ts + INTERVAL 1 DAY WHERE a.event_type = 'error' GROUP BY 1)""",
)
def q_x_return_share(spark, d):
    events = _timed(spark, d)
    return research.return_share(events.where("event_type = 'error'"), events.where("event_type = 'click'"), "user_id", "t", 86_400_000_000, "event_id")


@query(
    "x_coeditor_clustering",
    """WITH p AS (SELECT DISTINCT l_orderkey AS page, l_suppkey AS editor FROM lineitem)
       SELECT a.editor AS editor_a, b.editor AS editor_b, count(*) AS shared FROM p a JOIN p b ON a.page = b.page AND a.editor < b.editor GROUP BY 1, 2 HAVING count(*) >= 2""",
)
def q_x_coeditor_clustering(spark, d):
    rows = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("page"), F.col("l_suppkey").alias("editor"))
    return research.shared_pages(rows, "page", "editor", least=2)


@query(
    "x_composition_shift",
    """SELECT o_custkey % 20 AS page, o_orderdate >= TIMESTAMP '1998-01-01' AS after, CAST(median(n) AS DOUBLE) AS median_edits, round(avg(CASE WHEN n < 3 THEN 1.0 ELSE 0.0 END), 9) AS small_share
       FROM (SELECT o_custkey, o_orderdate, count(*) OVER (PARTITION BY o_custkey) AS n FROM orders) GROUP BY 1, 2""",
)
def q_x_composition_shift(spark, d):
    orders = table(spark, d, "orders").withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("o_custkey")))
    after = (F.col("o_orderdate") >= F.expr("TIMESTAMP_NTZ '1998-01-01 00:00:00'")).alias("after")
    return orders.groupBy((F.col("o_custkey") % 20).alias("page"), after).agg(F.median("n").alias("median_edits"), F.round(F.avg(F.when(F.col("n") < 3, 1.0).otherwise(0.0)), 9).alias("small_share"))


@query(
    "x_level_counts",
    """SELECT event_type, k, n FROM (SELECT event_type, json_extract_string(props, '$.k') AS k, count(*) AS n,
       row_number() OVER (PARTITION BY event_type ORDER BY count(*) DESC, json_extract_string(props, '$.k')) AS nth FROM events GROUP BY 1, 2) WHERE nth <= 5""",
)
def q_x_level_counts(spark, d):
    counted = table(spark, d, "events").groupBy("event_type", F.get_json_object("props", "$.k").alias("k")).agg(F.count(F.lit(1)).alias("n"))
    nth = F.row_number().over(Window.partitionBy("event_type").orderBy(F.desc("n"), "k"))
    return counted.withColumn("nth", nth).where("nth <= 5").drop("nth")


@query(
    "x_editor_coreness",
    """SELECT user_id, count(*) AS edits, CAST(date_diff('day', min(ts)::DATE, max(ts)::DATE) AS INTEGER) AS tenure_days,
       round(0.5 * ln(1 + count(*)) + 0.5 * ln(1 + date_diff('day', min(ts)::DATE, max(ts)::DATE)), 9) AS coreness FROM events GROUP BY 1""",
)
def q_x_editor_coreness(spark, d):
    return research.editor_coreness(table(spark, d, "events"), "user_id", "ts")


@query(
    "x_page_coreness",
    "SELECT l_partkey, count(*) AS edits, count(DISTINCT l_suppkey) AS editors, round(ln(1 + count(DISTINCT l_suppkey)), 9) AS coreness FROM lineitem GROUP BY 1",
)
def q_x_page_coreness(spark, d):
    return research.page_coreness(table(spark, d, "lineitem"), "l_partkey", "l_suppkey")


@query(
    "x_balance",
    """SELECT covariate, round((avg(v) FILTER (WHERE t) - avg(v) FILTER (WHERE NOT t)) / sqrt((var_samp(v) FILTER (WHERE t) + var_samp(v) FILTER (WHERE NOT t)) / 2), 9) AS smd
       FROM (SELECT c_acctbal > 0 AS t, 'nation' AS covariate, CAST(c_nationkey AS DOUBLE) AS v FROM customer
             UNION ALL SELECT c_acctbal > 0, 'key', CAST(c_custkey AS DOUBLE) FROM customer) GROUP BY 1""",
)
def q_x_balance(spark, d):
    rows = table(spark, d, "customer").select((F.col("c_acctbal") > 0).alias("t"), F.col("c_nationkey").alias("nation"), F.col("c_custkey").alias("key"))
    return research.balance(rows, "t", ["nation", "key"])


@query(
    "x_difference_in_differences",
    """WITH c AS (SELECT o_custkey, o_custkey % 2 = 0 AS t, avg(o_totalprice) FILTER (WHERE o_orderdate >= TIMESTAMP '1998-01-01') AS a,
               avg(o_totalprice) FILTER (WHERE o_orderdate < TIMESTAMP '1998-01-01') AS b FROM orders GROUP BY 1, 2)
       SELECT round(avg(a - b) FILTER (WHERE t) - avg(a - b) FILTER (WHERE NOT t), 6) AS effect FROM c WHERE a IS NOT NULL AND b IS NOT NULL""",
)
def q_x_difference_in_differences(spark, d):
    after = F.col("o_orderdate") >= F.expr("TIMESTAMP_NTZ '1998-01-01 00:00:00'")
    rows = table(spark, d, "orders").select("o_custkey", (F.col("o_custkey") % 2 == 0).alias("t"), after.alias("after"), "o_totalprice")
    return research.difference_in_differences(rows, "o_custkey", "t", "after", "o_totalprice")
