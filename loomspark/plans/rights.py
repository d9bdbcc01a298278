"""User rights over time: membership intervals rebuilt from rights events, and the tier held at a moment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomspark.operators.ranks import ranked

from .lookback import history_measures
from .research import access_tier


def rights_changes(events: DataFrame, user: str, t: str, order: str, old: str, new: str) -> DataFrame:
    """``(user, t, order, grp, granted)``: what each rights event, which names the groups before and after, adds and takes.

    Null lists are empty; groups in both lists do not change.
    """
    empty = F.array().cast("array<string>")
    before, after = F.coalesce(old, empty), F.coalesce(new, empty)
    change = lambda groups, granted: F.transform(groups, lambda g: F.struct(g.alias("grp"), F.lit(granted).alias("granted")))
    both = F.concat(change(F.array_except(after, before), True), change(F.array_except(before, after), False))
    return events.select(user, t, order, F.explode(both).alias("c")).select(user, t, order, "c.grp", "c.granted")


def membership_intervals(changes: DataFrame, user: str, t: str, order: str, grp: str = "grp", granted: str = "granted") -> DataFrame:
    """``(user, grp, start, end)``: when a user was in a group, from ``start`` up to before ``end``.

    A grant to a member and a revocation from a non-member change nothing.  A first event
    that revokes shows a membership from the beginning (null start); one that still holds has a
    null end.  Events of one time count in ``order``.  An interval of no length is left out.
    """
    plain = changes.select(F.col(user).alias("_u"), F.col(grp).alias("_g"), F.col(t).alias("_t"), F.col(order).alias("_o"), F.col(granted).alias("_in")).dropna()
    # neighbours meet by rank, so that one user of very many events is no task's alone
    placed = ranked(plain, ["_u", "_g"], ["_t", "_o"], "_n")
    earlier = placed.select("_u", "_g", (F.col("_n") + 1).alias("_n"), F.col("_in").alias("_was"))
    turns = placed.join(earlier, ["_u", "_g", "_n"], "left").where("_was IS NULL OR _was <> _in").select("_u", "_g", "_t", "_o", "_in")
    turns = ranked(turns, ["_u", "_g"], ["_t", "_o"], "_n")
    later = turns.select("_u", "_g", (F.col("_n") - 1).alias("_n"), F.col("_t").alias("_end"))
    held = turns.where("_in").join(later, ["_u", "_g", "_n"], "left").select("_u", "_g", F.col("_t").alias("start"), F.col("_end").alias("end"))
    from_the_start = turns.where("NOT _in AND _n = 0").select("_u", "_g", F.lit(None).cast(plain.schema["_t"].dataType).alias("start"), F.col("_t").alias("end"))
    both = held.unionByName(from_the_start).where("start IS NULL OR end IS NULL OR start < end")
    return both.select(F.col("_u").alias(user), F.col("_g").alias(grp), "start", "end")


def groups_at(requests: DataFrame, changes: DataFrame, user: str, t: str, order: str, groups: list[str], width: int, at: str | None = None) -> DataFrame:
    """``requests`` with ``groups``: those of ``groups`` that the user was in just before the request's time.

    The state of a group is that of its last change before; without one, the opposite of the
    first change later: a revocation shows earlier membership.  ``at`` is the requests' time column (default ``t``),
    ``width`` the stretch of time that one task looks at.
    """
    at = at or t
    state = {f"_g{i}": F.when(F.col("grp") == g, F.struct(F.col(t).alias("t"), F.col(order).alias("o"), F.col("granted").cast("int").alias("granted"))) for i, g in enumerate(groups)}
    found = history_measures(requests, changes, user, at, t, width, tops=state)
    # the same with time turned round: the nearest change that is not before
    back = {f"_f{i}": F.when(F.col("grp") == g, F.struct(-F.col(t).alias("t"), -F.col(order).alias("o"), F.col("granted").cast("int").alias("granted"))) for i, g in enumerate(groups)}
    turned = found.withColumn("_turned", -F.col(at) + 1)
    found = history_measures(turned, changes.withColumn("_turned_t", -F.col(t)), user, "_turned", "_turned_t", width, tops=back)
    member = [F.when(F.coalesce(F.col(f"_g{i}.granted"), 1 - F.col(f"_f{i}.granted"), F.lit(0)) == 1, F.lit(g)) for i, g in enumerate(groups)]
    return found.select(*requests.columns, F.array_compact(F.array(*member)).alias("groups"))


def tiers_at(edits: DataFrame, changes: DataFrame, user: str, t: str, order: str, width: int, day: int = 86_400, groups: tuple[str, ...] = ("sysop", "templateeditor")) -> DataFrame:
    """``edits`` with ``tier``: the highest access that the user's earlier edits, their age and their rights gave then.

    ``t`` is in seconds in both tables (``day`` of them a day).
    """
    rows = edits.select(F.col(user).alias("_u"), F.col(t).alias("_t"))
    seen = history_measures(edits, rows.withColumnRenamed("_u", user), user, t, "_t", width, sums={"_edits": F.lit(1)}, tops={"_back": -F.col("_t")})
    held = groups_at(seen, changes, user, t, order, list(groups), width)
    days = F.floor((F.col(t) + F.coalesce("_back", -F.col(t))) / day)
    return held.select(*edits.columns, access_tier(F.col("_edits"), days, groups=F.col("groups")).alias("tier"))
