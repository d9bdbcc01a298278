"""Queries of the study's statistics: choice models, matching, looks back, exploration (extensions, hence ``x_``)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomspark.functions.keywords import phrase_hits

from . import choice, exploration, lookback, matching, network, research, rights
from .registry import query, table

#: Coefficients at which the likelihood's terms are shown.
THETA = (0.4, 3.0, -2.0)

_LINES = """l AS (SELECT l_orderkey, l_linenumber, l_returnflag = 'R' AS chosen, l_quantity / 50 AS x0, l_discount AS x1, l_tax AS x2 FROM lineitem),
  e AS (SELECT *, exp(0.4 * x0 + 3.0 * x1 - 2.0 * x2) AS w FROM l)"""


def _lines(spark, d) -> DataFrame:
    rows = table(spark, d, "lineitem")
    return rows.select("l_orderkey", "l_linenumber", (F.col("l_returnflag") == "R").alias("chosen"), (F.col("l_quantity") / 50).alias("x0"), F.col("l_discount").alias("x1"), F.col("l_tax").alias("x2"))


@query(
    "x_choice_probability",
    f"""WITH {_LINES} SELECT l_orderkey, l_linenumber, round(w, 9) AS rate, round(w / sum(w) OVER (PARTITION BY l_orderkey), 9) AS probability FROM e""",
)
def q_x_choice_probability(spark, d):
    found = choice.choice_probabilities(_lines(spark, d), "l_orderkey", ["x0", "x1", "x2"], list(THETA))
    return found.select("l_orderkey", "l_linenumber", F.round("rate", 9).alias("rate"), F.round("probability", 9).alias("probability"))


def _means(x: str) -> str:
    return f"sum(w * {x}) / sum(w)"


@query(
    "x_choice_gradient",
    f"""WITH {_LINES}, s AS (
          SELECT l_orderkey, count(*) FILTER (WHERE chosen) AS m, count(*) AS n, sum(ln(w)) FILTER (WHERE chosen) - count(*) FILTER (WHERE chosen) * ln(sum(w)) AS ll,
            {", ".join(f"sum(x{i}) FILTER (WHERE chosen) AS c{i}, {_means(f'x{i}')} AS e{i}" for i in range(3))},
            {", ".join(f"{_means(f'x{i} * x{j}')} AS q{i}_{j}" for i in range(3) for j in range(i + 1))}
          FROM e GROUP BY 1 HAVING m > 0 AND n > 1)
        SELECT count(*) AS strata, CAST(sum(m) AS BIGINT) AS cases, round(sum(ll), 6) AS ll, {", ".join(f"round(sum(c{i} - m * e{i}), 6) AS g{i}" for i in range(3))},
          {", ".join(f"round(sum(m * (q{i}_{j} - e{i} * e{j})), 6) AS h{i}_{j}" for i in range(3) for j in range(i + 1))} FROM s""",
)
def q_x_choice_gradient(spark, d):
    fixed = choice.centred(_lines(spark, d), "l_orderkey", "chosen", ["x0", "x1", "x2"])
    terms = choice.likelihood_terms(fixed, list(THETA))
    rounded = [c for c in terms.columns if c not in ("strata", "cases")]
    return terms.select("strata", "cases", *(F.round(c, 6).alias(c) for c in rounded))


@query("x_choice_fit")
def q_x_choice_fit(spark, d):
    """The fitted coefficients; tests hold them against a dense fit."""
    return choice.fit_conditional_logit(_lines(spark, d), "l_orderkey", "chosen", ["x0", "x1", "x2"]).frame(spark)


# -- matching ------------------------------------------------------------------------------

CALIPER = 0.02

#: Greedy by distance, lower score, ids: one pair a step in every stratum.
_GREEDY = f"""WITH RECURSIVE r AS (
    SELECT c_custkey AS id, c_nationkey AS g, c_mktsegment IN ('BUILDING', 'MACHINERY') AS treated, round(1 / (1 + exp(-(c_acctbal / 5000 - 1))), 3) AS s FROM customer
  ), p AS (
    SELECT g, abs(a.s - b.s) AS away, least(a.s, b.s) AS low, a.id AS t, b.id AS c,
      row_number() OVER (PARTITION BY g ORDER BY abs(a.s - b.s), least(a.s, b.s), a.id, b.id) AS nth
    FROM r a JOIN r b USING (g) WHERE a.treated AND NOT b.treated AND abs(a.s - b.s) <= {CALIPER}
  ), m AS (
    SELECT g, t, c, away, nth, [t, c] AS used FROM p WHERE nth = 1
    UNION ALL
    SELECT g, t, c, away, nth, used FROM (
      SELECT p.g, p.t, p.c, p.away, p.nth, list_concat(m.used, [p.t, p.c]) AS used, row_number() OVER (PARTITION BY p.g ORDER BY p.nth) AS k
      FROM m JOIN p ON m.g = p.g AND p.nth > m.nth AND NOT list_contains(m.used, p.t) AND NOT list_contains(m.used, p.c)) WHERE k = 1
  )"""


def _people(spark, d) -> DataFrame:
    score = F.round(1 / (1 + F.exp(-(F.col("c_acctbal") / 5000 - 1))), 3)
    treated = F.col("c_mktsegment").isin("BUILDING", "MACHINERY")
    return table(spark, d, "customer").select("c_custkey", "c_nationkey", "c_acctbal", treated.alias("treated"), score.alias("score"))


@query("x_matched_pairs", f"{_GREEDY} SELECT t AS treated_id, c AS control_id, round(away, 9) AS distance FROM m")
def q_x_matched_pairs(spark, d):
    pairs = matching.matched_pairs(_people(spark, d), "c_custkey", "treated", "score", CALIPER, ["c_nationkey"])
    return pairs.withColumn("distance", F.round("distance", 9))


@query(
    "x_matched_balance",
    f"""{_GREEDY}, u AS (SELECT unnest([t, c]) AS id FROM m), v AS (
          SELECT c_mktsegment IN ('BUILDING', 'MACHINERY') AS treated, c_acctbal, c_custkey IN (SELECT id FROM u) AS kept FROM customer)
        SELECT 'c_acctbal' AS covariate, {", ".join(f"round((avg(c_acctbal) FILTER (WHERE treated{k}) - avg(c_acctbal) FILTER (WHERE NOT treated{k})) / sqrt((var_samp(c_acctbal) FILTER (WHERE treated{k}) + var_samp(c_acctbal) FILTER (WHERE NOT treated{k})) / 2), 6) AS {name}" for k, name in (("", "before"), (" AND kept", "after")))} FROM v""",
)
def q_x_matched_balance(spark, d):
    people = _people(spark, d)
    pairs = matching.matched_pairs(people, "c_custkey", "treated", "score", CALIPER, ["c_nationkey"])
    both = matching.balance_before_and_after(people, pairs, "c_custkey", "treated", ["c_acctbal"])
    return both.select("covariate", F.round("before", 6).alias("before"), F.round("after", 6).alias("after"))


# -- looks back ------------------------------------------------------------------------------

_REVISIONS = """v AS (SELECT user_id AS page, event_id AS rev, epoch(date_trunc('second', ts))::BIGINT AS tm, event_type || (event_id % 3) AS sha, CAST(round(value * 100) AS BIGINT) AS size FROM events),
  o AS (SELECT *, row_number() OVER (PARTITION BY page ORDER BY tm, rev) - 1 AS position FROM v),
  b AS (SELECT a.page, a.position, max(z.position) AS back FROM o a JOIN o z ON a.page = z.page AND a.sha = z.sha AND z.position < a.position AND z.position >= a.position - 15 GROUP BY 1, 2),
  w AS (SELECT o.*, CASE WHEN position - back >= 2 THEN back END AS reverts_to FROM o LEFT JOIN b USING (page, position))"""


def _revisions(spark, d) -> DataFrame:
    at = F.unix_seconds(F.col("ts").cast("timestamp"))
    sha = F.concat("event_type", (F.col("event_id") % 3).cast("string"))
    return table(spark, d, "events").select(F.col("user_id").alias("page"), F.col("event_id").alias("rev"), at.alias("at"), sha.alias("sha"), F.round(F.col("value") * 100).cast("bigint").alias("size"))


@query(
    "x_identity_reverts",
    f"""WITH {_REVISIONS} SELECT page, rev, position, reverts_to, coalesce(position - reverts_to - 1, 0) AS reverted,
        EXISTS (SELECT 1 FROM w z WHERE z.page = w.page AND z.position > w.position AND z.reverts_to < w.position) AS undone FROM w""",
)
def q_x_identity_reverts(spark, d):
    found = lookback.identity_reverts(_revisions(spark, d), "page", "rev", "at", "sha")
    return found.select("page", "rev", F.col("position"), "reverts_to", "reverted", "undone")


_REQUESTS = "q AS (SELECT event_id AS request, user_id AS page, epoch(date_trunc('second', ts))::BIGINT AS t FROM events WHERE event_type = 'error')"


def _requests(spark, d) -> DataFrame:
    rows = table(spark, d, "events").where("event_type = 'error'")
    return rows.select(F.col("event_id").alias("request"), F.col("user_id").alias("page"), F.unix_seconds(F.col("ts").cast("timestamp")).alias("t"))


@query(
    "x_matching_covariates",
    f"""WITH {_REVISIONS}, {_REQUESTS} SELECT request, q.page, t,
        {", ".join(f"round(ln(1 + count(*) FILTER (WHERE tm >= t - {s}{c})), 9) AS {m}_{n}" for m, c in (("activity", ""), ("controversy", " AND reverts_to IS NOT NULL")) for n, s in lookback.SPANS.items())},
        round(ln(1 + count(tm)), 9) AS age, round(ln(1 + coalesce(max(size), 0)), 9) AS length
        FROM q LEFT JOIN w ON q.page = w.page AND w.tm < t GROUP BY 1, 2, 3""",
)
def q_x_matching_covariates(spark, d):
    found = lookback.matching_covariates(_requests(spark, d), _revisions(spark, d), "page", "t", "rev", "at", "sha", "size")
    return found.select("request", "page", "t", *(F.round(c, 9).alias(c) for c in found.columns[3:]))


@query(
    "x_majority_topic",
    f"""WITH {_REVISIONS}, {_REQUESTS}, n AS (
          SELECT request, substr(sha, 1, 1) AS topic, row_number() OVER (PARTITION BY request ORDER BY tm DESC, rev DESC) AS back FROM q JOIN v ON q.page = v.page AND v.tm < t),
        c AS (SELECT request, topic, count(*) AS n, min(back) AS latest FROM n WHERE back <= 5 GROUP BY 1, 2)
        SELECT q.request, (SELECT topic FROM c WHERE c.request = q.request ORDER BY n DESC, latest LIMIT 1) AS majority FROM q""",
)
def q_x_majority_topic(spark, d):
    events = _revisions(spark, d).withColumn("topic", F.substring("sha", 1, 1))
    return lookback.majority_before(_requests(spark, d), events, "page", "t", "at", "rev", "topic", width=604_800).select("request", "majority")


@query(
    "x_exploration",
    """WITH e AS (SELECT event_id, user_id, epoch(date_trunc('second', ts))::BIGINT AS t, (event_type = 'click')::INT + 0.5 AS v0, value / 100 AS v1, (event_id % 7) / 7 AS v2 FROM events),
       p AS (SELECT a.event_id, a.v0, a.v1, a.v2, """
    + ", ".join(f"sum(b.v{i} * pow(2, (b.t - a.t) / 86400.0)) AS p{i}" for i in range(3))
    + """ FROM e a LEFT JOIN e b ON a.user_id = b.user_id AND b.t < a.t GROUP BY 1, 2, 3, 4)
       SELECT event_id, round((v0 * p0 + v1 * p1 + v2 * p2) / (sqrt(v0 * v0 + v1 * v1 + v2 * v2) * sqrt(p0 * p0 + p1 * p1 + p2 * p2)), 9) AS familiarity FROM p""",
)
def q_x_exploration(spark, d):
    at = F.unix_seconds(F.col("ts").cast("timestamp"))
    v = [((F.col("event_type") == "click").cast("int") + 0.5).alias("v0"), (F.col("value") / 100).alias("v1"), ((F.col("event_id") % 7) / 7).alias("v2")]
    events = table(spark, d, "events").select("event_id", "user_id", at.alias("t"), *v)
    found = exploration.exploration(events, "event_id", "user_id", "t", ["v0", "v1", "v2"], half_life=86_400, width=5 * 86_400)
    return found.select("event_id", F.round("familiarity", 9).alias("familiarity"))


# -- rights ----------------------------------------------------------------------------------

_CHANGES = """c AS (SELECT user_id AS member, epoch(date_trunc('second', ts))::BIGINT AS t, event_id AS o, CASE WHEN event_id % 3 = 0 THEN 'sysop' ELSE 'templateeditor' END AS grp,
    event_type IN ('click', 'view') AS granted FROM events WHERE event_type <> 'error')"""


def _changes(spark, d) -> DataFrame:
    group = F.when(F.col("event_id") % 3 == 0, "sysop").otherwise("templateeditor")
    rows = table(spark, d, "events").where("event_type <> 'error'")
    return rows.select(F.col("user_id").alias("member"), F.unix_seconds(F.col("ts").cast("timestamp")).alias("t"), F.col("event_id").alias("o"), group.alias("grp"), F.col("event_type").isin("click", "view").alias("granted"))


@query(
    "x_membership_intervals",
    f"""WITH {_CHANGES}, w AS (SELECT *, lag(granted) OVER (PARTITION BY member, grp ORDER BY t, o) AS was FROM c),
        n AS (SELECT *, lead(t) OVER (PARTITION BY member, grp ORDER BY t, o) AS after, row_number() OVER (PARTITION BY member, grp ORDER BY t, o) AS nth FROM w WHERE was IS NULL OR was <> granted)
        SELECT member, grp, CASE WHEN granted THEN t END AS "start", CASE WHEN granted THEN after ELSE t END AS "end" FROM n
        WHERE (granted AND (after IS NULL OR t < after)) OR (NOT granted AND nth = 1)""",
)
def q_x_membership_intervals(spark, d):
    return rights.membership_intervals(_changes(spark, d), "member", "t", "o")


@query(
    "x_groups_at",
    f"""WITH {_CHANGES}, q AS (SELECT event_id AS request, user_id AS member, epoch(date_trunc('second', ts))::BIGINT AS tm FROM events WHERE event_type = 'error'),
        g AS (SELECT unnest(['sysop', 'templateeditor']) AS grp),
        s AS (SELECT request, g.grp, coalesce(arg_max(granted, (t, o)) FILTER (WHERE t < tm), NOT arg_min(granted, (t, o)) FILTER (WHERE t >= tm), false) AS member_of
              FROM q CROSS JOIN g LEFT JOIN c ON c.member = q.member AND c.grp = g.grp GROUP BY 1, 2)
        SELECT request, coalesce(string_agg(grp, ',' ORDER BY grp) FILTER (WHERE member_of), '') AS groups FROM s GROUP BY 1""",
)
def q_x_groups_at(spark, d):
    asked = table(spark, d, "events").where("event_type = 'error'").select(F.col("event_id").alias("request"), F.col("user_id").alias("member"), F.unix_seconds(F.col("ts").cast("timestamp")).alias("at"))
    found = rights.groups_at(asked, _changes(spark, d), "member", "t", "o", ["sysop", "templateeditor"], width=604_800, at="at")
    return found.select("request", F.array_join("groups", ",").alias("groups"))


@query(
    "x_editor_standing",
    """WITH p AS (SELECT user_id, event_id % 11 AS page, count(*) AS n FROM events GROUP BY 1, 2),
       d AS (SELECT user_id, round(ln(sum(n)) - sum(n * ln(n)) / sum(n), 9) AS diversity FROM p GROUP BY 1),
       e AS (SELECT user_id, count(*) AS edits, CAST(date_diff('day', min(ts)::DATE, max(ts)::DATE) AS INTEGER) AS tenure_days, CASE WHEN user_id % 4 < 3 THEN user_id % 4 ELSE 0 END AS level FROM events GROUP BY 1)
       SELECT user_id, edits, tenure_days, CAST(level AS BIGINT) AS level, diversity, round(0.25 * ln(1 + edits) + 0.25 * ln(1 + tenure_days) + 0.25 * level + 0.25 * diversity, 6) AS standing FROM e JOIN d USING (user_id)""",
)
def q_x_editor_standing(spark, d):
    events = table(spark, d, "events").withColumn("page", F.col("event_id") % 11)
    levels = events.select("user_id", (F.col("user_id") % 4).alias("level")).where("level < 3").distinct()
    return research.editor_standing(events, "user_id", "page", "ts", levels)


@query(
    "x_team_standing",
    """WITH s AS (SELECT user_id, ln(1 + count(*)) AS v FROM events GROUP BY 1), r AS (SELECT user_id, round(v, 9) AS v FROM s),
       t AS (SELECT DISTINCT event_type || strftime(ts, '%Y%m%d%H') AS id, user_id FROM events)
       SELECT id, count(*) AS members, round(avg(v), 6) AS mean FROM t JOIN r USING (user_id) GROUP BY 1""",
)
def q_x_team_standing(spark, d):
    """Mean standing of the editors of an hour of one event type."""
    events = table(spark, d, "events")
    standing = events.groupBy("user_id").agg(F.round(F.log1p(F.count(F.lit(1))), 9).alias("v"))
    teams = events.groupBy(F.concat("event_type", F.date_format("ts", "yyyyMMddHH")).alias("id")).agg(F.collect_set("user_id").alias("members"))
    return research.team_standing(teams, "id", "members", standing, "user_id", "v")


@query(
    "x_page_standing",
    """WITH p AS (SELECT l_orderkey % 300 AS page, count(DISTINCT l_suppkey) AS editors FROM lineitem GROUP BY 1),
       c AS (SELECT o_custkey % 300 AS page, count(DISTINCT o_orderpriority || o_orderstatus) AS sources FROM orders WHERE o_custkey % 3 <> 0 GROUP BY 1)
       SELECT page, editors, coalesce(sources, 0) AS sources, round(0.5 * ln(1 + editors) + 0.5 * ln(1 + coalesce(sources, 0)), 9) AS standing FROM p LEFT JOIN c USING (page)""",
)
def q_x_page_standing(spark, d):
    edits = table(spark, d, "lineitem").select((F.col("l_orderkey") % 300).alias("page"), F.col("l_suppkey").alias("editor"))
    cited = table(spark, d, "orders").where("o_custkey % 3 <> 0").select((F.col("o_custkey") % 300).alias("page"), F.concat("o_orderpriority", "o_orderstatus").alias("source"))
    return research.page_standing(edits, cited, "page", "editor")


# -- networks --------------------------------------------------------------------------------


@query(
    "x_citations",
    rf"""SELECT DISTINCT page_id, lower(unnest(regexp_extract_all(url || chr(32) || html, '{network.HOST}', 1))) AS source FROM pages""",
)
def q_x_citations(spark, d):
    return network.citations(table(spark, d, "pages").select("page_id", F.concat_ws(" ", "url", "html").alias("text")), "page_id", "text")


def _h_rounds(n: int) -> str:
    """``n`` rounds of h-indices in SQL."""
    rounds = []
    for k in range(n):
        rounds.append(
            f"""v{k + 1} AS MATERIALIZED (SELECT side, node, max(least(value, nth)) AS value FROM (
                  SELECT b.side, b.node, v.value, row_number() OVER (PARTITION BY b.side, b.node ORDER BY v.value DESC) AS nth
                  FROM b JOIN v{k} v ON v.side = b.other AND v.node = b.dst) GROUP BY 1, 2)"""
        )
    return ", ".join(rounds)


@query(
    "x_coreness",
    f"""WITH e AS (SELECT DISTINCT CAST(l_orderkey % 3000 AS VARCHAR) AS page, CAST(l_suppkey AS VARCHAR) AS source FROM lineitem),
        b AS MATERIALIZED (SELECT 'page' AS side, page AS node, 'source' AS other, source AS dst FROM e UNION ALL SELECT 'source', source, 'page', page FROM e),
        v0 AS (SELECT side, node, count(*) AS value FROM b GROUP BY 1, 2), {_h_rounds(40)} SELECT side, node, CAST(value AS BIGINT) AS coreness FROM v40""",
)
def q_x_coreness(spark, d):
    edges = table(spark, d, "lineitem").select((F.col("l_orderkey") % 3000).alias("page"), F.col("l_suppkey").alias("source"))
    return network.coreness(edges, "page", "source")


@query(
    "x_four_cycles",
    """WITH p AS (SELECT DISTINCT l_orderkey AS page, l_suppkey AS editor FROM lineitem),
       s AS (SELECT a.editor, b.editor AS other, count(*) AS n FROM p a JOIN p b ON a.page = b.page AND a.editor <> b.editor GROUP BY 1, 2)
       SELECT editor, CAST(sum(n * (n - 1) / 2) AS BIGINT) AS cycles FROM s GROUP BY 1""",
)
def q_x_four_cycles(spark, d):
    rows = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("page"), F.col("l_suppkey").alias("editor"))
    return network.four_cycles(rows, "page", "editor")


@query(
    "x_composition_tenure",
    """WITH e AS (SELECT user_id, event_type, date_diff('day', DATE '2024-01-16', ts::DATE) AS away FROM events),
       s AS (SELECT DISTINCT event_type, user_id, away >= 0 AS after FROM e WHERE away >= -2 AND away < 2),
       b AS (SELECT user_id, count(*) AS n, max(-away) AS tenure FROM e WHERE away < 0 GROUP BY 1)
       SELECT event_type, after, count(*) AS editors, CAST(median(coalesce(n, 0)) AS DOUBLE) AS median_edits, CAST(median(coalesce(tenure, 0)) AS DOUBLE) AS median_tenure,
         round(avg(CASE WHEN coalesce(n, 0) < 33 THEN 1.0 ELSE 0.0 END), 9) AS newcomer_share FROM s LEFT JOIN b USING (user_id) GROUP BY 1, 2""",
)
def q_x_composition_tenure(spark, d):
    """Who edits in the two days before and after a cut: their edits and tenure until then."""
    events = table(spark, d, "events").withColumn("day", F.to_date("ts"))
    return research.composition_shift(events, "event_type", "user_id", "day", F.lit("2024-01-16").cast("date"), 2, 33)


# -- texts -----------------------------------------------------------------------------------

PHRASES = ("the", "idiot", "of the", "que", "und die", "you are")


@query(
    "phrase_match",
    f"""WITH w AS (SELECT doc_id, regexp_extract_all(lower(text), '[a-zà-öø-ÿß]+') AS w FROM documents),
        s AS (SELECT doc_id, unnest(list_concat(w, list_transform(list_zip(w, w[2:]), lambda z: z[1] || ' ' || z[2]))) AS phrase FROM w)
        SELECT doc_id, phrase, count(*) AS n FROM s WHERE phrase IN {PHRASES} GROUP BY 1, 2""",
)
def q_phrase_match(spark, d):
    phrases = spark.createDataFrame([(p,) for p in PHRASES], "phrase string")
    return phrase_hits(table(spark, d, "documents"), phrases, "doc_id", "text")


@query(
    "text_bytes_by_year",
    """SELECT CAST(year(o_orderdate) AS INTEGER) AS yr, count(*) AS n, round(avg(octet_length(encode(text))), 6) AS mean_bytes, CAST(median(octet_length(encode(text))) AS DOUBLE) AS median_bytes
       FROM documents JOIN orders ON doc_id = o_orderkey GROUP BY 1""",
)
def q_text_bytes_by_year(spark, d):
    """Average and median text bytes by year; an order of the same number dates the text."""
    sizes = table(spark, d, "documents").select(F.col("doc_id").alias("o_orderkey"), F.octet_length("text").alias("bytes"))
    dated = sizes.join(table(spark, d, "orders").select("o_orderkey", F.year("o_orderdate").alias("yr")), "o_orderkey")
    return dated.groupBy("yr").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("bytes"), 6).alias("mean_bytes"), F.median("bytes").alias("median_bytes"))
