"""A whole load as a query: dumps written from the driver's tables are loaded, checked and asked for the key figures.

The SQL counterpart states the figures from the tables alone, so it covers the dump's column order, the
namespaces of the site, the resolution of actors over two loads and the checked writes.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomspark.operators import writing
from loomspark.schemas import TABLES
from loomspark.session import workspace

from . import key_figures, loading
from .format_queries import _export, _folder, _history_folder, _quoted, _stamp
from .registry import query, table

#: Tasks that parse a dump's statements.
SPREAD = 8
#: Rows of an INSERT.
INSERT_ROWS = 1000
NAMESPACES = '<siteinfo><namespaces><namespace key="0" /><namespace key="1">Talk</namespace><namespace key="3">User talk</namespace></namespaces></siteinfo>'


def _inserts(rows: DataFrame, name: str, values: list[Column]) -> DataFrame:
    """Inserts of at most ``INSERT_ROWS`` rows each, dealt by hash: more rows make more statements, not longer ones."""
    tuples = rows.select(F.concat(F.lit("("), F.concat_ws(",", *(v.cast("string") for v in values)), F.lit(")")).alias("row"))

    def statements(batches):
        import pyarrow as pa

        for batch in batches:
            found = batch.column(0).to_pylist()
            lines = [f"INSERT INTO `{name}` VALUES {','.join(found[a : a + INSERT_ROWS])};" for a in range(0, len(found), INSERT_ROWS)]
            yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], names=["value"])

    return tuples.repartition(F.xxhash64("row")).mapInArrow(statements, "value string")


def _log_items(events: DataFrame) -> DataFrame:
    n, user = F.col("event_id"), F.col("user_id").cast("string")
    who = F.when(F.col("user_id") % 5 == 0, F.concat(F.lit("<contributor><ip>10.0.0."), user, F.lit("</ip></contributor>")))
    who = who.otherwise(F.concat(F.lit("<contributor><username>Editor "), user, F.lit("</username><id>"), user, F.lit("</id></contributor>")))
    kind = F.when(F.col("event_type") == "purchase", "protect").otherwise(F.col("event_type"))
    title = F.concat(F.when(n % 2 == 0, "Talk:").otherwise("Page "), (n % 40).cast("string"))
    parts = [
        "<logitem><id>", n.cast("string"), "</id><timestamp>", _stamp("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"), "</timestamp>", who, "<comment>c</comment><type>", kind,
        "</type><action>", kind, "</action><logtitle>", title, "</logtitle><params /></logitem>",
    ]
    return events.select(F.concat(*(F.lit(p) if isinstance(p, str) else p for p in parts)).alias("value"))


_FIGURES = """
WITH g AS (SELECT *, CASE WHEN event_type = 'purchase' THEN 'protect' ELSE event_type END AS kind, CASE WHEN user_id % 5 = 0 THEN '10.0.0.' ELSE 'Editor ' END || user_id AS name,
         CASE WHEN user_id % 5 <> 0 THEN user_id END AS u FROM events),
  r AS (SELECT * FROM conversations WHERE turn % 4 <> 2),
  a AS (SELECT u, name FROM g UNION SELECT conv_id, role FROM r WHERE turn % 4 IN (0, 3)),
  f AS (
    SELECT 'rows' AS figure, 'page' AS k, count(*) AS n FROM orders
    UNION ALL SELECT 'rows', 'page_restrictions', count(*) FROM customer
    UNION ALL SELECT 'rows', 'logging', count(*) FROM g
    UNION ALL SELECT 'rows', 'revision', count(*) FROM r
    UNION ALL SELECT 'rows', 'actor', count(*) FROM a
    UNION ALL SELECT 'namespace', CAST(o_custkey % 4 AS VARCHAR), count(*) FROM orders GROUP BY 2
    UNION ALL SELECT 'restriction', lower(c_mktsegment) || ' ' || (c_nationkey % 3), count(*) FROM customer GROUP BY 2
    UNION ALL SELECT 'log type', kind, count(*) FROM g GROUP BY 2
    UNION ALL SELECT 'protect year', CAST(year(ts) AS VARCHAR), count(*) FROM g WHERE kind = 'protect' GROUP BY 2
    UNION ALL SELECT 'revision year', '2024', count(*) FROM r
    UNION ALL SELECT 'actors', 'registered', count(u) FROM a
    UNION ALL SELECT 'actors', 'anon', count(*) - count(u) FROM a
    UNION ALL SELECT 'log namespace', CASE WHEN event_id % 2 = 0 THEN '1' ELSE '0' END, count(*) FROM g GROUP BY 2
    UNION ALL SELECT 'protecting', name, count(*) FROM g WHERE kind = 'protect' GROUP BY 2
  )
SELECT figure, k, CAST(n AS BIGINT) AS n FROM f
"""


@query("load_and_figures", _FIGURES)
def q_load_and_figures(spark, d):
    base = f"{workspace(spark)}/load-{uuid.uuid4().hex}"
    orders, people = table(spark, d, "orders"), table(spark, d, "customer")
    key = F.col("o_orderkey")
    pages = [key, F.col("o_custkey") % 4, _quoted(F.concat(F.lit("P"), key.cast("string"))), F.lit(0), F.lit(1), F.lit(0.5), _quoted(_stamp("o_orderdate")), F.lit("NULL"), key, F.lit(7), F.lit("'wikitext'"), F.lit("NULL")]
    loading.load_dump(spark, "page", f"{_folder(_inserts(orders, 'page', pages), 'page')}/part-*", base, SPREAD)
    # the dump has its own order of columns
    limits = [F.col("c_custkey") % 5000, _quoted(F.lower("c_mktsegment")), _quoted((F.col("c_nationkey") % 3).cast("string")), F.lit(0), F.lit("'infinity'"), F.col("c_custkey")]
    loading.load_dump(spark, "page_restrictions", f"{_folder(_inserts(people, 'page_restrictions', limits), 'restrictions')}/part-*", base)
    loading.load_logging(spark, _folder(_export(_log_items(table(spark, d, "events")), NAMESPACES), "log"), base)
    loading.load_revisions(spark, f"{_history_folder(spark, d)}/part-*", base)
    t = {n: writing.read_or_empty(spark, base, n) for n in TABLES}
    named = lambda df, figure, k, n: df.select(F.lit(figure).alias("figure"), k.cast("string").alias("k"), n.cast("bigint").alias("n"))
    counts = key_figures.kf01_row_counts(t).where("tbl IN ('page', 'page_restrictions', 'logging', 'revision', 'actor')")
    actors = key_figures.kf09_actors(t).select(F.explode(F.create_map(F.lit("registered"), "registered", F.lit("anon"), "anon")).alias("k", "n"))
    per = t["logging"].where("log_type = 'protect'").groupBy("log_actor").agg(F.count(F.lit(1)).alias("n")).join(t["actor"], F.col("log_actor") == F.col("actor_id"))
    out = [
        named(counts, "rows", F.col("tbl"), F.col("n")),
        named(key_figures.kf02_pages_by_namespace(t), "namespace", F.col("page_namespace"), F.col("pages")),
        named(key_figures.kf03_restrictions(t), "restriction", F.concat_ws(" ", "pr_type", "pr_level"), F.col("n")),
        named(key_figures.kf05_log_types(t), "log type", F.col("log_type"), F.col("n")),
        named(key_figures.kf06_protection_by_year(t), "protect year", F.col("yr"), F.col("n")),
        named(key_figures.kf08_revisions_by_year(t), "revision year", F.col("yr"), F.col("revisions")),
        named(actors, "actors", F.col("k"), F.col("n")),
        named(t["logging"].groupBy("log_namespace").agg(F.count(F.lit(1)).alias("n")), "log namespace", F.col("log_namespace"), F.col("n")),
        named(per, "protecting", F.decode("actor_name", "UTF-8"), F.col("n")),
    ]
    whole = out[0]
    for part in out[1:]:
        whole = whole.unionByName(part)
    return whole

