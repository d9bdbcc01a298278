"""What was known of a page before a moment: reverts, activity, length, age, quality, topic.

Every measure counts strictly earlier rows only.  Time is a whole number.  Looks back over
a span partition by page and span, looks over the whole past add up stretches, so the cost
stays in proportion to the rows and no page is one task's alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loomspark.operators.ranks import ranked

#: Spans of the looks back in seconds (fixed values: an hour, a day, a week).
SPANS = {"1h": 3_600, "24h": 86_400, "1w": 604_800}
#: How many revisions back an identity revert reaches at most.
RADIUS = 15


def identity_reverts(revisions: DataFrame, page: str, rev: str, at: str, sha: str, radius: int = RADIUS) -> DataFrame:
    """``revisions`` with ``position`` in the page, ``reverts_to``, ``reverted`` (how many) and ``undone``.

    A revision reverts if its content equals that of the nearest earlier revision of the page
    with the same content, at most ``radius`` back, and others lie between; those are undone.
    Equal neighbours are null edits and undo nothing.  A revision without a hash (suppressed)
    neither reverts nor is a target, but can be undone.  Revisions of one time are in the
    order of their ids, which must be unique in a page.  Rows without a page leave.
    """
    placed = ranked(revisions, [page], [at, rev], "position").withColumn("_zone", F.floor(F.col("position") / radius))
    known = placed.where(F.col(sha).isNotNull())
    inside = known.withColumn("_last", F.lag("position").over(Window.partitionBy(page, sha, "_zone").orderBy("position")))
    before = known.groupBy(page, sha, (F.col("_zone") + 1).alias("_zone")).agg(F.max("position").alias("_zone_last"))
    both = inside.join(before, [page, sha, "_zone"], "left").withColumn("_from", F.coalesce("_last", "_zone_last"))
    gap = F.col("position") - F.col("_from")
    found = both.select(page, F.col("position"), F.when((gap >= 2) & (gap <= radius), F.col("_from")).alias("reverts_to")).where("reverts_to IS NOT NULL")
    marked = placed.join(found, [page, "position"], "left")
    # a revision is undone if a later one within reach goes back beyond it: its own zone and the next one hold those
    zones = marked.select(page, "position", "reverts_to", "_zone", F.explode(F.array(F.col("_zone"), F.col("_zone") - 1)).alias("_seen"))
    ahead = Window.partitionBy(page, "_seen").orderBy("position").rangeBetween(1, radius)
    reach = zones.withColumn("_least", F.min("reverts_to").over(ahead)).where("_seen = _zone AND _least < position").select(page, "position", F.lit(True).alias("_undone"))
    whole = marked.join(reach, [page, "position"], "left")
    return whole.select(*revisions.columns, "position", "reverts_to", F.coalesce(F.col("position") - F.col("reverts_to") - 1, F.lit(0)).alias("reverted"), F.coalesce("_undone", F.lit(False)).alias("undone"))


def _beside(requests: DataFrame, events: DataFrame, page: str, t: str, event_t: str, measures: dict[str, Column], into) -> DataFrame:
    """Requests and events in one table: the request as a struct (null for events), the measures null for requests.

    Events without a page or time leave; requests without one see no event.  ``into`` gives, for a time column and whether the row is an event, the zone or zones it is in.
    """
    asks = requests.select(F.col(page).alias("_page"), F.col(t).alias("_t"), F.struct(*requests.columns).alias("_ask"), *(F.lit(None).alias(m) for m in measures), into(F.col(t), False).alias("_zone"))
    known = events.where(F.col(page).isNotNull() & F.col(event_t).isNotNull())
    seen = known.select(F.col(page).alias("_page"), F.col(event_t).alias("_t"), *(c.alias(m) for m, c in measures.items()), into(F.col(event_t), True).alias("_zone"))
    return asks.unionByName(seen, allowMissingColumns=True)


def span_measures(requests: DataFrame, events: DataFrame, page: str, t: str, event_t: str, spans: dict[str, int], sums: dict[str, Column] | None = None, tops: dict[str, Column] | None = None) -> DataFrame:
    """``requests`` with, for each span, ``<sum>_<span>`` (0 without events) and ``<top>_<span>`` (null without).

    They are sums and maxima over the page's events in [t - span, t).  Both tables name their page alike.
    """
    sums, tops = sums or {}, tops or {}
    measures = sums | tops
    for name, span in spans.items():
        zone = lambda at, event, span=span: F.explode(F.array(F.floor(at / span), F.floor(at / span) + 1)) if event else F.floor(at / span)
        both = _beside(requests, events, page, t, event_t, measures, zone)
        past = Window.partitionBy("_page", "_zone").orderBy("_t").rangeBetween(-span, -1)
        found = [F.coalesce(F.sum(m).over(past), F.lit(0)).alias(f"{m}_{name}") for m in sums] + [F.max(m).over(past).alias(f"{m}_{name}") for m in tops]
        # the windows see the events; then the requests alone go on
        requests = both.select("_ask", *found).where("_ask IS NOT NULL").select("_ask.*", *(f"{m}_{name}" for m in measures))
    return requests


def history_measures(requests: DataFrame, events: DataFrame, page: str, t: str, event_t: str, width: int, sums: dict[str, Column] | None = None, tops: dict[str, Column] | None = None) -> DataFrame:
    """As :func:`span_measures` over the whole past, in stretches of ``width``; columns are named as the measures."""
    sums, tops = sums or {}, tops or {}
    measures = sums | tops
    both = _beside(requests, events, page, t, event_t, measures, lambda at, _: F.floor(at / width))
    past = Window.partitionBy("_page", "_zone").orderBy("_t").rangeBetween(Window.unboundedPreceding, -1)
    folds = {m: F.sum if m in sums else F.max for m in measures}
    inside = both.select("*", *(folds[m](m).over(past).alias(f"_in_{m}") for m in measures)).where("_ask IS NOT NULL")
    totals = both.groupBy("_page", "_zone").agg(*(folds[m](m).alias(f"_all_{m}") for m in measures))
    earlier = Window.partitionBy("_page").orderBy("_zone").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(F.col("_page").alias("_of"), F.col("_zone").alias("_at"), *(folds[m](f"_all_{m}").over(earlier).alias(f"_pre_{m}") for m in measures))
    joined = inside.join(carried, F.col("_page").eqNullSafe(F.col("_of")) & F.col("_zone").eqNullSafe(F.col("_at")))
    out = [(F.coalesce(f"_in_{m}", F.lit(0)) + F.coalesce(f"_pre_{m}", F.lit(0))).alias(m) for m in sums] + [F.greatest(f"_in_{m}", f"_pre_{m}").alias(m) for m in tops]
    return joined.select("_ask.*", *out)


def majority_before(requests: DataFrame, events: DataFrame, page: str, t: str, event_t: str, event_id: str, label: str, width: int, last: int = 5) -> DataFrame:
    """``requests`` with ``majority``: the commonest label of the page's ``last`` events before, ties to the later one.

    Events without a label do not count.  No earlier event gives null.  The requests' columns must tell their rows apart.
    """
    placed = ranked(events.where(F.col(label).isNotNull()), [page], [event_t, event_id], "_position")
    asked = history_measures(requests, placed, page, t, event_t, width, sums={"_seen": F.lit(1)})
    asked = asked.select(F.struct(*requests.columns).alias("_ask"), F.col(page).alias("_page"), F.explode(F.sequence(F.lit(1), F.lit(last))).alias("_back"), "_seen").withColumn("_position", F.col("_seen") - F.col("_back"))
    labels = placed.select(F.col(page).alias("_page"), "_position", F.col(label).alias("_label"))
    found = asked.join(labels, ["_page", "_position"]).groupBy("_ask", "_label").agg(F.count(F.lit(1)).alias("n"), F.max("_position").alias("latest"))
    best = found.groupBy("_ask").agg(F.max_by("_label", F.struct("n", "latest")).alias("majority"))
    keyed = requests.withColumn("_ask", F.struct(*requests.columns))
    return keyed.join(best, "_ask", "left").select(*requests.columns, "majority")


def matching_covariates(requests: DataFrame, revisions: DataFrame, page: str, t: str, rev: str, at: str, sha: str, size: str, spans: dict[str, int] = SPANS, width: int = 2_592_000, radius: int = RADIUS) -> DataFrame:
    """``requests`` with ln(1 + edits) and ln(1 + reverts) in each span before, ln(1 + edits so far) and ln(1 + largest size so far).

    The revisions' time has the unit of the requests'; a page without revisions has zeros.
    """
    marked = identity_reverts(revisions.select(page, rev, at, sha, size), page, rev, at, sha, radius)
    counted = span_measures(requests, marked, page, t, at, spans, sums={"activity": F.lit(1), "controversy": F.col("reverts_to").isNotNull().cast("int")})
    aged = history_measures(counted, marked, page, t, at, width, sums={"age": F.lit(1)}, tops={"length": F.col(size)})
    logs = [F.log1p(f"{m}_{s}").alias(f"{m}_{s}") for m in ("activity", "controversy") for s in spans]
    return aged.select(*requests.columns, *logs, F.log1p("age").alias("age"), F.log1p(F.coalesce("length", F.lit(0))).alias("length"))
