"""Research statistics that the dump project's documents specify without code: extensions.

Where a formula is not given there, the one here is ours and says so.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .lookback import history_measures


def inertia(events: DataFrame, keys: list[str], t: str, name: str = "inertia", width: int | None = None) -> DataFrame:
    """Earlier events with the same keys; those at the same time do not count.  ``t`` is a whole number.

    With ``width``, a key's events are counted in stretches of that time, each a task's own, and
    the stretches before are added: for keys that very many events have.
    """
    order = Window.orderBy(t).rangeBetween(Window.unboundedPreceding, -1)
    if width is None:
        return events.withColumn(name, F.count(F.lit(1)).over(order.partitionBy(*keys)))
    parted = events.withColumn("_b", F.floor(F.col(t) / width))
    inside = parted.withColumn("_n", F.count(F.lit(1)).over(order.partitionBy(*keys, "_b")))
    sums = parted.groupBy(*keys, "_b").agg(F.count(F.lit(1)).alias("_all"))
    earlier = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*(F.col(k).alias(f"_{k}") for k in keys), F.col("_b").alias("_b2"), F.coalesce(F.sum("_all").over(earlier), F.lit(0)).alias("_before"))
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys] + [F.col("_b").eqNullSafe(F.col("_b2"))]
    return inside.join(sums, same).select(*events.columns, (F.col("_n") + F.col("_before")).alias(name))


def subset_repetition(events: DataFrame, id_col: str, t: str, members: str, width: int | None = None) -> DataFrame:
    """``(id, repetition)``: earlier events whose members include all of this event's.

    Teams meet again, so the distinct sets are compared, not the events: a set and its
    supersets meet on the set's rarest member, which every superset must hold.  The events of
    all supersets then are one history of the set, in which each of its events counts what lies
    before it, with ``width`` in stretches of that time.  An event without members has none.
    """
    at = F.col(t) if isinstance(events.schema[t].dataType, (T.IntegerType, T.LongType)) else F.unix_micros(F.col(t).cast("timestamp"))
    base = events.select(F.col(id_col).alias("id"), at.cast("bigint").alias("t"), F.array_sort(F.array_distinct(members)).alias("s"))
    sets = base.select("s").distinct()
    each = sets.select("s", F.explode("s").alias("m"))
    often = each.groupBy("m").agg(F.count(F.lit(1)).alias("n"))
    rare = each.join(often, "m").groupBy("s").agg(F.min_by("m", F.struct("n", "m")).alias("m"))
    holds = each.select(F.col("s").alias("s2"), "m")
    wider = rare.join(holds, "m").where((F.size("s2") >= F.size("s")) & (F.size(F.array_except("s", "s2")) == 0)).select("s", "s2")
    history = wider.join(base.select(F.col("s").alias("s2"), F.col("t").alias("t2")), "s2").select("s", "t2")
    found = history_measures(base, history, "s", "t", "t2", width or 1 << 62, sums={"repetition": F.lit(1)})
    return found.select(F.col("id").alias(id_col), F.col("repetition").cast("bigint").alias("repetition"))


def hyperevents(edits: DataFrame, page: str, editor: str, at: str, gap: str) -> DataFrame:
    """``(page, editors, start)``: sessions of edits on a page with no pause of ``gap`` or more."""
    return edits.groupBy(page, F.session_window(at, gap).alias("w")).agg(F.sort_array(F.collect_set(editor)).alias("editors")).select(page, "editors", F.col("w.start").alias("start"))


def lookback_activity(events: DataFrame, key: str, t: str, spans: dict[str, int]) -> DataFrame:
    """ln(1 + events in the span before), one column a span, to nine digits."""
    for name, span in spans.items():
        past = Window.partitionBy(key).orderBy(t).rangeBetween(-span, -1)
        events = events.withColumn(name, F.round(F.log1p(F.count(F.lit(1)).over(past)), 9))
    return events


def interevent_median(events: DataFrame, groups: list[str], keys: list[str], t: str, tie: str) -> DataFrame:
    """Median time between neighbouring events of the same keys, by group."""
    order = Window.partitionBy(*groups, *keys).orderBy(t, tie)
    gaps = events.select(*groups, (F.col(t) - F.lag(t).over(order)).alias("gap")).where("gap IS NOT NULL")
    return gaps.groupBy(*groups).agg(F.median("gap").alias("median_gap"))


def null_edits(revisions: DataFrame) -> DataFrame:
    """Revisions with a known parent, and those whose content hash equals the parent's."""
    parent = revisions.select(F.col("rev_id").alias("rev_parent_id"), F.col("rev_sha1").alias("parent_sha1"))
    both = revisions.join(parent, "rev_parent_id")
    return both.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("rev_sha1") == F.col("parent_sha1")).alias("same"))


def access_tier(edits: Column, days: Column, auto: tuple[int, int] = (10, 4), extended: tuple[int, int] = (500, 30), groups: Column | None = None) -> Column:
    """Highest tier that (edits, days) reaches; membership in sysop or templateeditor goes first."""
    tier = F.when((edits >= extended[0]) & (days >= extended[1]), "extended-confirmed").when((edits >= auto[0]) & (days >= auto[1]), "auto-confirmed").otherwise("new")
    if groups is None:
        return tier
    return F.when(F.array_contains(groups, "sysop"), "sysop").when(F.array_contains(groups, "templateeditor"), "templateeditor").otherwise(tier)


def return_share(left: DataFrame, right: DataFrame, key: str, t: str, span: int, id_col: str) -> DataFrame:
    """How many ``left`` events a ``right`` event of the same key follows within ``span``.

    Time is cut into buckets of one span.  What follows lies in the event's own bucket, if its last
    event is later, or in the next one, if its first is near enough: two numbers a bucket
    decide, so no events are paired.
    """
    bucket = F.floor(F.col(t) / span)
    a = left.select(F.col(key).alias("k"), F.col(id_col).alias("id"), F.col(t).alias("t"), bucket.alias("b"))
    z = right.groupBy(F.col(key).alias("k"), bucket.alias("b")).agg(F.min(t).alias("first"), F.max(t).alias("last"))
    own = z.select("k", "b", F.col("last"))
    after = z.select("k", (F.col("b") - 1).alias("b"), F.col("first"))
    both = a.join(own, ["k", "b"], "left").join(after, ["k", "b"], "left")
    back = (F.col("last") > F.col("t")) | (F.col("first") <= F.col("t") + span)
    each = both.groupBy("id").agg(F.bool_or(back).alias("back"))
    return each.agg(F.count(F.lit(1)).alias("stays"), F.count_if(F.col("back")).alias("returned"))


def shared_pages(edits: DataFrame, page: str, editor: str, least: int = 1) -> DataFrame:
    """Pairs of editors with at least ``least`` pages in common.

    Pages with a single editor leave before the join.
    """
    own = edits.select(page, editor).distinct()
    several = own.groupBy(page).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(page)
    own = own.join(several, page, "left_semi")
    other = own.select(page, F.col(editor).alias("editor_b"))
    pairs = own.select(page, F.col(editor).alias("editor_a")).join(other, page).where("editor_a < editor_b")
    return pairs.groupBy("editor_a", "editor_b").agg(F.count(F.lit(1)).alias("shared")).where(F.col("shared") >= least)


def editor_coreness(edits: DataFrame, editor: str, at: str, weights: tuple[float, float] = (0.5, 0.5)) -> DataFrame:
    """``(editor, edits, tenure_days, coreness)``: ln(1 + edits) and ln(1 + days between first and last), weighted; weights ours."""
    each = edits.groupBy(editor).agg(F.count(F.lit(1)).alias("edits"), F.date_diff(F.max(at), F.min(at)).alias("tenure_days"))
    return each.withColumn("coreness", F.round(weights[0] * F.log1p("edits") + weights[1] * F.log1p("tenure_days"), 9))


def page_coreness(edits: DataFrame, page: str, editor: str) -> DataFrame:
    """``(page, edits, editors, coreness)``: ln(1 + distinct editors); views and quality are not in the dumps."""
    each = edits.groupBy(page).agg(F.count(F.lit(1)).alias("edits"), F.count_distinct(editor).alias("editors"))
    return each.withColumn("coreness", F.round(F.log1p("editors"), 9))


def core_assortativity(edits: DataFrame, editor: str, page: str, at: str) -> DataFrame:
    """One row: correlation of editor and page coreness over distinct (editor, page) pairs; negative is mixing."""
    pairs = edits.select(editor, page).distinct()
    e = editor_coreness(edits, editor, at).select(editor, F.col("coreness").alias("e"))
    p = page_coreness(edits, page, editor).select(page, F.col("coreness").alias("p"))
    return pairs.join(e, editor).join(p, page).agg(F.count(F.lit(1)).alias("pairs"), F.round(F.corr("e", "p"), 6).alias("assortativity"))


def case_control(events: DataFrame, candidates: DataFrame, stratum: str, cases: str, controls: int, seed: int = 1) -> DataFrame:
    """Each stratum's cases and ``controls`` times as many of its other candidates, drawn by a seeded hash."""
    own = events.select(stratum, F.col(cases).alias("member")).distinct()
    counts = own.groupBy(stratum).agg(F.count(F.lit(1)).alias("n"))
    rest = candidates.select(stratum, F.col(cases).alias("member")).distinct().join(own, [stratum, "member"], "left_anti")
    order = Window.partitionBy(stratum).orderBy(F.xxhash64("member", F.lit(seed)), "member")
    drawn = rest.join(counts, stratum).withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= controls * F.col("n"))
    return own.withColumn("is_case", F.lit(True)).unionByName(drawn.select(stratum, "member").withColumn("is_case", F.lit(False)))


def balance(rows: DataFrame, treated: str, covariates: list[str]) -> DataFrame:
    """``(covariate, smd)``: difference of means over the pooled deviation; below 0.1 counts as balanced."""
    t = F.col(treated)
    parts = [F.expr(f"stack({len(covariates)}, {', '.join(f"'{c}', CAST({c} AS DOUBLE)" for c in covariates)}) AS (covariate, value)")]
    long = rows.select(treated, *parts)
    side = lambda f, yes: f(F.when(t if yes else ~t, F.col("value")))
    spread = F.sqrt((side(F.var_samp, True) + side(F.var_samp, False)) / 2)
    return long.groupBy("covariate").agg(F.round((side(F.avg, True) - side(F.avg, False)) / F.nullif(spread, F.lit(0.0)), 9).alias("smd"))


def difference_in_differences(rows: DataFrame, page: str, treated: str, after: str, outcome: str) -> DataFrame:
    """One row ``effect``: change of treated pages less that of others, each page weighing alike (page effects)."""
    cell = rows.groupBy(page, treated).agg(F.avg(F.when(F.col(after), F.col(outcome))).alias("a"), F.avg(F.when(~F.col(after), F.col(outcome))).alias("b")).where("a IS NOT NULL AND b IS NOT NULL")
    change = cell.select(treated, (F.col("a") - F.col("b")).alias("d"))
    return change.agg(F.round(F.avg(F.when(F.col(treated), F.col("d"))) - F.avg(F.when(~F.col(treated), F.col("d"))), 6).alias("effect"))


def composition_shift(edits: DataFrame, page: str, editor: str, day: str, cut: Column, span: int, newcomer: int) -> DataFrame:
    """``(page, after, editors, median_edits, median_tenure, newcomer_share)`` for the days before and after ``cut``.

    The editors of a side are those who edited the page at most ``span`` days before the cut, or from
    it on for as long.  An editor's edits, on any page, and days since the first one count up to
    the cut; one whose first edit is later has none and no tenure.  ``newcomer_share`` is the share
    with fewer than ``newcomer`` edits.  ``day`` is a date.
    """
    away = F.date_diff(day, cut)
    active = edits.select(page, editor, away.alias("_away")).where((F.col("_away") >= -span) & (F.col("_away") < span))
    sides = active.select(page, editor, (F.col("_away") >= 0).alias("after")).distinct()
    before = edits.where(away < 0).groupBy(editor).agg(F.count(F.lit(1)).alias("_edits"), F.max(-away).alias("_tenure"))
    both = sides.join(before, editor, "left").select(page, "after", F.coalesce("_edits", F.lit(0)).alias("_edits"), F.coalesce("_tenure", F.lit(0)).alias("_tenure"))
    share = F.avg((F.col("_edits") < newcomer).cast("double"))
    return both.groupBy(page, "after").agg(F.count(F.lit(1)).alias("editors"), F.median("_edits").alias("median_edits"), F.median("_tenure").alias("median_tenure"), F.round(share, 9).alias("newcomer_share"))


def diversity(edits: DataFrame, editor: str, page: str) -> DataFrame:
    """``(editor, diversity)``: entropy of an editor's edits over pages, in nats; 0 for a single page."""
    each = edits.groupBy(editor, page).agg(F.count(F.lit(1)).alias("_n"))
    sums = each.groupBy(editor).agg(F.sum("_n").alias("_all"), F.sum(F.col("_n") * F.log(F.col("_n").cast("double"))).alias("_log"))
    return sums.select(editor, F.round(F.log(F.col("_all").cast("double")) - F.col("_log") / F.col("_all"), 9).alias("diversity"))


def editor_standing(edits: DataFrame, editor: str, page: str, at: str, levels: DataFrame, weights: tuple[float, float, float, float] = (0.25, 0.25, 0.25, 0.25)) -> DataFrame:
    """``(editor, edits, tenure_days, level, diversity, standing)``: coreness from all four indicators, weights ours.

    ``levels`` is (editor, level), a number for the highest formal right; an editor without one has 0.
    """
    base = editor_coreness(edits, editor, at).drop("coreness")
    both = base.join(diversity(edits, editor, page), editor).join(levels.select(editor, "level"), editor, "left").withColumn("level", F.coalesce("level", F.lit(0)))
    parts = (F.log1p("edits"), F.log1p("tenure_days"), F.col("level").cast("double"), F.col("diversity"))
    return both.withColumn("standing", F.round(sum((w * p for w, p in zip(weights, parts, strict=True)), F.lit(0.0)), 6))


def team_standing(teams: DataFrame, id_col: str, members: str, standing: DataFrame, editor: str, value: str) -> DataFrame:
    """``(id, members, mean)``: the mean of the members' values; unknown members do not count, a team of none has null."""
    each = teams.select(id_col, F.explode(F.array_distinct(members)).alias(editor)).join(standing.select(editor, value), editor)
    means = each.groupBy(id_col).agg(F.count(F.lit(1)).alias("members"), F.round(F.avg(value), 6).alias("mean"))
    return teams.select(id_col).join(means, id_col, "left").select(id_col, F.coalesce("members", F.lit(0)).alias("members"), "mean")


def page_standing(edits: DataFrame, cited: DataFrame, page: str, editor: str, weights: tuple[float, float] = (0.5, 0.5)) -> DataFrame:
    """``(page, editors, sources, standing)``: ln(1 + distinct editors) and ln(1 + distinct cited sources), weights ours.

    ``cited`` is (page, source); views and quality are not in the dumps.
    """
    own = edits.groupBy(page).agg(F.count_distinct(editor).alias("editors"))
    theirs = cited.groupBy(page).agg(F.count_distinct("source").alias("sources"))
    both = own.join(theirs, page, "left").withColumn("sources", F.coalesce("sources", F.lit(0)))
    return both.withColumn("standing", F.round(weights[0] * F.log1p("editors") + weights[1] * F.log1p("sources"), 9))
