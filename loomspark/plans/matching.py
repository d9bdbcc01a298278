"""Greedy nearest matching of treated and control rows within a caliper, without replacement.

All admissible pairs (same exact values, scores at most a caliper apart) are thought of in the order
of distance, then of their lower score, then of the members' ids, and a pair is taken where both
are free.  No pairs are listed for that.  Equal scores pair up by rank; what is left
has one side at each score, and the closest pair of a sorted line is always one of
neighbours.  So a sorted range of scores settles its inside alone: a pair is certain while
it is closer than anything beyond the range could come to the range's ends.  What stays
open near the ends is handed on, and the next level settles wider ranges of it.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loomspark.operators import ranks
from loomspark.session import ensure_importable, written

from .choice import fit_propensity, propensity
from .research import balance

#: Distinct scores in a range, and ranges that become one at the next level.
RANGE_SCORES, FAN_IN = 4096, 8
#: Pairs of equal scores that one row of a block stands for.
BLOCK = 4096


def settle(score, side, count, used, caliper: float, closed_left: bool, closed_right: bool):
    """Certain transfers of one range, and what must be handed on.

    The arrays are groups in the order of their distinct scores: side 1 is treated, ``count``
    members are free, those before ``used`` are not.  A closed end has nothing beyond it.
    Returns transfers (treated group, its first member, control group, its first member,
    members) and the open groups as indices, with ``count`` and ``used`` updated in place.
    """
    n = len(score)
    ahead, behind = list(range(1, n + 1)), list(range(-1, n - 1))
    gone = [False] * n
    left, right = 0, n - 1
    low = -np.inf if closed_left else score[0]
    high = np.inf if closed_right else score[-1]
    open_: list[int] = []
    moves: list[tuple[int, int, int, int, int]] = []
    queue: list[tuple[float, float, int, int]] = []

    def meet(a: int, b: int) -> None:
        if 0 <= a and b < n and side[a] != side[b] and score[b] - score[a] <= caliper:
            heapq.heappush(queue, (score[b] - score[a], score[a], a, b))

    def leave(i: int) -> None:
        gone[i] = True
        a, b = behind[i], ahead[i]
        if a >= 0:
            ahead[a] = b
        if b < n:
            behind[b] = a

    for i in range(n - 1):
        meet(i, i + 1)
    while queue:
        away, _, a, b = heapq.heappop(queue)
        if gone[a] or gone[b] or ahead[a] != b:
            continue
        # whatever lies beyond an end may act first: the end is open, and the next group the end
        while left < n and score[left] - low <= away:
            open_.append(left)
            low, nxt = score[left], ahead[left]
            leave(left)
            left = nxt
        while right >= 0 and not gone[right] and high - score[right] <= away:
            open_.append(right)
            high, nxt = score[right], behind[right]
            leave(right)
            right = nxt
        if gone[a] or gone[b]:
            continue
        k = min(count[a], count[b])
        t, c = (a, b) if side[a] else (b, a)
        moves.append((t, used[t], c, used[c], k))
        for i in (a, b):
            used[i] += k
            count[i] -= k
        before, after = behind[a], ahead[b]
        for i in (a, b):
            if not count[i]:
                leave(i)
                if i == left:
                    left = ahead[i]
                if i == right:
                    right = behind[i]
        last = b if count[b] else a if count[a] else None
        if last is None:
            meet(before, after)
        else:
            meet(before, last)
            meet(last, after)
    open_ += [i for i in range(n) if not gone[i] and (score[i] - low <= caliper and not closed_left or high - score[i] <= caliper and not closed_right)]
    return moves, sorted(open_)


def _pruned(state: DataFrame) -> DataFrame:
    """Open groups without those that nothing left in their stratum can reach.

    Others consume a range of one side from its ends inwards: not more members, from each
    end, than the other side has in the whole stratum.
    """
    sums = state.groupBy("stratum").agg(*(F.coalesce(F.sum(F.when(F.col("side") == s, F.col("count"))), F.lit(0)).alias(f"all{s}") for s in (0, 1)))
    ranges = state.groupBy("stratum", "part").agg(F.min("side").alias("least"), F.max("side").alias("most"))
    both = state.join(sums.where("all0 > 0 AND all1 > 0"), "stratum").join(ranges, ["stratum", "part"])
    order = Window.partitionBy("stratum", "part")
    outside = lambda column: F.coalesce(F.sum("count").over(order.orderBy(column).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    both = both.withColumn("from_left", outside(F.col("score"))).withColumn("from_right", outside(F.desc("score")))
    other = F.when(F.col("side") == 0, F.col("all1")).otherwise(F.col("all0"))
    return both.where((F.col("least") != F.col("most")) | (F.least("from_left", "from_right") < other)).select(state.columns)


def matched_pairs(rows: DataFrame, id_col: str, treated: str, score: str, caliper: float, exact: list[str] | None = None, range_scores: int = RANGE_SCORES, fan_in: int = FAN_IN) -> DataFrame:
    """``(treated_id, control_id, distance)``: the greedy matching described above.

    Rows with a null or NaN in any of the columns take no part.  Ids are whole numbers and
    unique.  A side without rows, or an empty table, gives no pairs.
    """
    spark = rows.sparkSession
    ensure_importable(spark)
    stratum = F.to_json(F.struct(*exact)) if exact else F.lit("")
    plain = rows.dropna(subset=[id_col, treated, score, *(exact or [])]).select(
        stratum.alias("stratum"), (F.col(score).cast("double") + 0.0).alias("score"), F.col(treated).cast("int").alias("side"), F.col(id_col).alias("id")
    )
    ranked = written(ranks.ranked(plain.where(~F.isnan("score")), ["stratum", "score", "side"], ["id"]), "matchranks")
    sides = ranked.groupBy("stratum", "score").agg(F.count_if(F.col("side") == 1).alias("nt"), F.count_if(F.col("side") == 0).alias("nc"))
    groups = sides.withColumn("even", F.least("nt", "nc"))
    groups = written(groups, "matchgroups")
    zero = F.lit(0).cast("bigint")
    transfers = groups.where("even > 0").select("stratum", F.col("score").alias("score_t"), zero.alias("from_t"), F.col("score").alias("score_c"), zero.alias("from_c"), F.col("even").alias("k"))
    alone = groups.where("nt <> nc").select("stratum", "score", F.when(F.col("nt") > F.col("nc"), 1).otherwise(0).alias("side"), F.abs(F.col("nt") - F.col("nc")).alias("count"), F.col("even").alias("used"))
    n = alone.count()
    alone = alone.repartitionByRange(max(1, -(-n // range_scores)), "stratum", "score").withColumn("part", F.spark_partition_id())
    state = written(alone, "matchopen")
    fields = "stratum string, score_t double, from_t bigint, score_c double, from_c bigint, k bigint, part int, score double, side int, count bigint, used bigint"

    def run(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("score")
        score, side = frame.score.to_numpy(), frame.side.tolist()
        count, used = frame["count"].tolist(), frame.used.tolist()
        moves, left = settle(score, side, count, used, caliper, bool(frame.closed_left.iloc[0]), bool(frame.closed_right.iloc[0]))
        out = [(key[0], score[t], a, score[c], b, k, None, None, None, None, None) for t, a, c, b, k in moves]
        out += [(key[0], None, None, None, None, None, key[1], score[i], side[i], count[i], used[i]) for i in left if count[i]]
        return pd.DataFrame(out, columns=[f.split()[0] for f in fields.split(", ")])

    while True:
        ends = state.groupBy("stratum").agg(F.min("part").alias("first"), F.max("part").alias("last"))
        marked = state.join(ends, "stratum").withColumn("closed_left", F.col("part") == F.col("first")).withColumn("closed_right", F.col("part") == F.col("last"))
        settled = written(marked.drop("first", "last").groupBy("stratum", "part").applyInPandas(run, fields), "matchlevel")
        transfers = transfers.unionByName(settled.where("k IS NOT NULL").select(transfers.columns))
        state = settled.where("k IS NULL").select("stratum", "score", "side", "count", "used", "part")
        state = written(_pruned(state).withColumn("part", F.floor(F.col("part") / fan_in).cast("int")), "matchopen")
        if state.isEmpty():
            break
    blocks = transfers.withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("k") - 1) / BLOCK))))
    members = F.sequence(F.col("block") * BLOCK, F.least((F.col("block") + 1) * BLOCK, F.col("k")) - 1)
    each = blocks.withColumn("i", F.explode(members)).select("stratum", "score_t", (F.col("from_t") + F.col("i")).alias("rank_t"), "score_c", (F.col("from_c") + F.col("i")).alias("rank_c"))
    ours = ranked.where("side = 1").select("stratum", F.col("score").alias("score_t"), F.col("rank").alias("rank_t"), F.col("id").alias("treated_id"))
    theirs = ranked.where("side = 0").select("stratum", F.col("score").alias("score_c"), F.col("rank").alias("rank_c"), F.col("id").alias("control_id"))
    both = each.join(ours, ["stratum", "score_t", "rank_t"]).join(theirs, ["stratum", "score_c", "rank_c"])
    return both.select("treated_id", "control_id", F.abs(F.col("score_t") - F.col("score_c")).alias("distance"))


def propensity_pairs(rows: DataFrame, id_col: str, treated: str, covariates: list[str], exact: list[str] | None = None, deviations: float = 1.0) -> DataFrame:
    """:func:`matched_pairs` on the fitted chance to be treated, with a caliper of so many of its standard deviations.

    A caliper on a further measure is an exact value of its band, named in ``exact`` (a quality
    level within a quarter: its floor in quarters).
    """
    theta = fit_propensity(rows, treated, covariates)
    scored = written(rows.select(id_col, treated, *(exact or []), propensity(covariates, theta).alias("chance")), "propensity")
    spread = scored.agg(F.stddev_samp("chance")).first()[0]
    return matched_pairs(scored, id_col, treated, "chance", deviations * (spread or 0.0), exact)


def matched_rows(rows: DataFrame, pairs: DataFrame, id_col: str) -> DataFrame:
    """Rows of both members of every pair, with the pair's treated id as ``pair``."""
    ours = pairs.select(F.col("treated_id").alias(id_col), F.col("treated_id").alias("pair"))
    theirs = pairs.select(F.col("control_id").alias(id_col), F.col("treated_id").alias("pair"))
    return rows.join(ours.unionByName(theirs), id_col)


def balance_before_and_after(rows: DataFrame, pairs: DataFrame, id_col: str, treated: str, covariates: list[str]) -> DataFrame:
    """``(covariate, before, after)``: standardised differences of all rows, and of the matched ones."""
    before = balance(rows, treated, covariates).withColumnRenamed("smd", "before")
    after = balance(matched_rows(rows, pairs, id_col), treated, covariates).withColumnRenamed("smd", "after")
    return before.join(after, "covariate")
