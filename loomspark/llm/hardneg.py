"""Hard negatives by a nearest-neighbour join over Voronoi cells.

A vector x becomes the point [x, sqrt(M*M - |x|^2)] and an anchor [q, 0]: the squared distance
of the two is |q|^2 + M*M - 2 q.x, so the nearest point has the largest product.  Every
point belongs to the cell of its nearest pivot.  What is known of a cell (how far its points
and anchors lie from the pivot) bounds what an anchor of one cell can be served by a
candidate of another, and a candidate travels only to the groups of anchors that it may
serve.  There blocks of anchors meet slices of candidates in whole numbers.  One join finds
the positives, the next the negatives, whose scores the positives bound on both sides.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loomspark.session import ensure_importable

from .common import arrow_schema, map_arrow, read_table, spread, written
from .mtree import SCALE, farthest_first

ANCHOR_DIVISOR, SHIFT_DIVISOR, LABELS = 50, 7, 10
POSITIVES, NEGATIVES = 5, 3
#: Hundredths of the positive's score between which a negative's lies.
LEAST_PERCENT, MOST_PERCENT = 50, 95
#: Pivots, and the vectors among which they are chosen.
PIVOTS, PIVOT_SAMPLE = 64, 4096
#: Anchors in a block, candidates in a slice, and candidates that meet a block at once.
BLOCK_ANCHORS, SLICE_ROWS, STEP = 2048, 2048, 1024
#: Rows of cell bounds up to which they are broadcast; beyond, both sides are salted.
BOUNDS_LIMIT, SALTS = 200_000, 16
#: Room of distances for rounding.
SLACK = 1e-6


def labelled_vectors(table: DataFrame, scale: int = SCALE, shift: int = SHIFT_DIVISOR, labels: int = LABELS) -> DataFrame:
    """``(vec_id, label, v array<double>)`` of floor(scale * x); every ``shift``-th id has the next label, modulo ``labels``.

    Rows with a null id, label or vector, an empty vector, or a null or non-finite component take no part.
    """
    doubles = table.select("vec_id", F.col("label").cast("bigint").alias("label"), F.transform("embedding", lambda x: x.cast("double")).alias("v"))
    fine = doubles.where("vec_id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL AND size(v) > 0")
    fine = fine.where(~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))
    label = F.when(F.col("vec_id") % shift == 0, (F.col("label") + 1) % labels).otherwise(F.col("label"))
    return fine.select("vec_id", label.alias("label"), F.transform("v", lambda x: F.floor(x * scale).cast("double")).alias("v"))


def _celled(rows: DataFrame, pivots: np.ndarray, top: float, is_anchor: str) -> DataFrame:
    """Rows with the cell and pivot distance of their candidate point, and of their anchor point where they are one."""

    def nearest(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        squares = (points**2).sum(axis=1)[:, None] - 2 * points @ pivots.T + (pivots**2).sum(axis=1)[None]
        cell = squares.argmin(axis=1)
        return cell, np.sqrt(((points - pivots[cell]) ** 2).sum(axis=1))

    def run(cols):
        v = cols["v"].flatten().to_numpy(zero_copy_only=False).reshape(len(cols["v"]), -1)
        cell, d = nearest(np.concatenate([v, np.sqrt(np.maximum(top - (v**2).sum(axis=1), 0))[:, None]], axis=1))
        own, own_d = nearest(np.concatenate([v, np.zeros((len(v), 1))], axis=1))
        asks = np.array(cols["asks"].to_pylist(), bool)
        return {c: cols[c] for c in ("row", "vec_id", "label", "v", "asks")} | {
            "cell": cell.tolist(),
            "d": d.tolist(),
            "own_cell": [int(c) if a else None for c, a in zip(own, asks, strict=True)],
            "own_d": [float(x) if a else None for x, a in zip(own_d, asks, strict=True)],
        }

    marked = rows.withColumn("asks", F.expr(is_anchor))
    return map_arrow(marked, run, "row bigint, vec_id bigint, label bigint, v array<double>, asks boolean, cell int, d double, own_cell int, own_d double")


def _pivot_distances(spark: SparkSession, pivots: np.ndarray) -> DataFrame:
    """``(own_cell, cell, apart)``: one row a pair of pivots, whose number is a parameter."""
    apart = np.sqrt(((pivots[:, None] - pivots[None]) ** 2).sum(axis=2))
    return F.broadcast(spark.createDataFrame([(i, j, float(apart[i, j])) for i in range(len(pivots)) for j in range(len(pivots))], "own_cell int, cell int, apart double"))


def _groups(anchors: DataFrame, keys: list[str], n_pivots: int, block: int) -> DataFrame:
    """``(keys, own_cell, grp, blocks)``: neighbouring cells together, as many groups as blocks of anchors are due."""
    cells = anchors.groupBy(*keys, "own_cell").agg(F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))  # a row a cell
    due = F.least(F.lit(n_pivots), F.ceil(F.sum("n").over(whole) / block)).cast("int")
    named = cells.withColumn("grp", F.floor(F.col("own_cell") * due / n_pivots).cast("int"))
    size = F.sum("n").over(Window.partitionBy(*keys, "grp"))
    return named.select(*keys, "own_cell", "grp", F.ceil(size / block).cast("int").alias("blocks"))


def _served(candidates: DataFrame, bounds: DataFrame, keys: list[str]) -> DataFrame:
    """Candidates once for each group that they may serve: ``bounds`` has (keys, cell, grp, blocks, low, high)."""
    named = bounds.select(*(F.col(k).alias(f"of_{k}") for k in keys), F.col("cell").alias("of_cell"), "grp", "blocks", "low", "high")
    meet = F.col("cell") == F.col("of_cell")
    for k in keys:
        meet = meet & (F.col(k) == F.col(f"of_{k}"))
    meet = meet & F.col("d").between(F.col("low"), F.col("high"))
    if bounds.count() <= BOUNDS_LIMIT:
        found = candidates.join(F.broadcast(named), meet)
    else:
        grains = named.withColumn("grain", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        found = candidates.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int")).join(grains, meet & (F.col("salt") == F.col("grain")))
    return found.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))


def _met(spark: SparkSession, anchors: DataFrame, candidates: DataFrame, slices: int, k: int, same_label: bool) -> DataFrame:
    """``(row, question, vec_id, score)``: the best ``k`` of each slice for each anchor's questions.

    ``anchors`` are (unit columns, row, vec_id, label, v, lows, highs), a question for each
    pair of bounds; ``candidates`` (unit columns, row, vec_id, label, v).  An anchor goes to
    every slice of its group's candidates, a candidate to one.
    """
    fields = "kind int, lows array<bigint>, highs array<bigint>, row bigint, vec_id bigint, label bigint, v array<double>"
    unit = F.xxhash64(*(F.col(c) for c in ("part", "grp", "block", "slice")))
    left = anchors.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1)))).withColumn("kind", F.lit(0))
    right = candidates.withColumn("slice", F.pmod(F.xxhash64("row", F.lit(3)), F.lit(slices)).cast("int")).withColumn("kind", F.lit(1))
    for c in ("lows", "highs"):
        right = right.withColumn(c, F.array().cast("array<bigint>"))
    names = ["part", "grp", "block", "slice", *(f.split()[0] for f in fields.split(", "))]
    rows = left.select(names).unionByName(right.select(names)).withColumn("unit", unit)
    dealt = rows.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "unit").sortWithinPartitions("unit", "part", "grp", "block", "slice", "kind")
    out = "row bigint, question int, vec_id bigint, score bigint"
    kind = arrow_schema(spark, out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, asked, meeting = None, [], None
        for batch in batches:
            cols = {n: batch.column(i) for i, n in enumerate(names)}
            at = np.stack([cols[c].to_numpy(zero_copy_only=False) for c in ("part", "grp", "block", "slice", "kind")], axis=1).astype(np.int64)
            edges = np.concatenate(([0], np.flatnonzero((at[1:] != at[:-1]).any(axis=1)) + 1, [len(at)])) if len(at) else []
            for a, b in zip(edges, edges[1:], strict=False):
                here, is_candidate = tuple(at[a, :4].tolist()), at[a, 4] == 1
                if here != unit:
                    if meeting:
                        yield from _results(meeting, kind)
                    unit, asked, meeting = here, [], None
                part = {n: c.slice(a, b - a) for n, c in cols.items()}
                if not is_candidate:
                    asked.append(part)
                elif asked or meeting:
                    if meeting is None:
                        meeting, asked = Meeting(asked, k, same_label), []
                    for start in range(0, b - a, STEP):
                        meeting.add({n: part[n].slice(start, STEP) for n in ("row", "vec_id", "label", "v")})
        if meeting:
            yield from _results(meeting, kind)

    def _results(meeting: Meeting, kind: pa.Schema) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(meeting.rows(), kind, strict=True)], schema=kind)

    return dealt.select(*names).mapInArrow(run, out)


def _wide(column) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


class Meeting:
    """A block of anchors and the best candidates seen so far for each of their questions."""

    #: Stands for no candidate.
    NONE = np.iinfo(np.int64).min

    def __init__(self, asked: list[dict], k: int, same_label: bool):
        whole = {n: pa.chunked_array([a[n] for a in asked]).combine_chunks() for n in ("row", "label", "v", "lows", "highs")}
        self.row, self.label, self.v = (whole[n].to_numpy(zero_copy_only=False) if n != "v" else _wide(whole[n]) for n in ("row", "label", "v"))
        lows, highs = whole["lows"].to_pylist(), whole["highs"].to_pylist()
        self.of = np.repeat(np.arange(len(lows)), [len(x) for x in lows])
        self.question = np.concatenate([np.arange(len(x)) for x in lows])
        self.low, self.high = (np.array([x for xs in many for x in xs], np.int64) for many in (lows, highs))
        self.k, self.same_label = k, same_label
        self.score = np.full((len(self.of), k), self.NONE)
        self.vec_id = np.full((len(self.of), k), np.iinfo(np.int64).max)

    def add(self, cols: dict) -> None:
        """Up to ``STEP`` candidates; a key of score and place among them, in order of ids, makes ties exact."""
        row, vec_id, label = (cols[n].to_numpy(zero_copy_only=False) for n in ("row", "vec_id", "label"))
        by = np.argsort(vec_id, kind="stable")
        row, vec_id, label, v = row[by], vec_id[by], label[by], _wide(cols["v"])[by]
        score = (self.v @ v.T).astype(np.int64)
        same = self.label[:, None] == label[None]
        fit = same & (self.row[:, None] != row[None]) if self.same_label else ~same
        key = np.where(fit, score * STEP + (STEP - 1 - np.arange(len(by)))[None], self.NONE)
        k = min(self.k, len(by))
        for a in range(0, len(self.of), BLOCK_ANCHORS):
            own = slice(a, a + BLOCK_ANCHORS)
            keys, scores = key[self.of[own]], score[self.of[own]]
            keys = np.where((scores >= self.low[own, None]) & (scores <= self.high[own, None]), keys, self.NONE)
            best = np.argpartition(keys, len(by) - k, axis=1)[:, len(by) - k :]
            found = np.take_along_axis(keys, best, axis=1)
            none = found == self.NONE
            new_score = np.where(none, self.NONE, np.take_along_axis(scores, best, axis=1))
            new_id = np.where(none, np.iinfo(np.int64).max, vec_id[best])
            both, ids = np.concatenate([self.score[own], new_score], axis=1), np.concatenate([self.vec_id[own], new_id], axis=1)
            # the least number has no negative: order by its complement
            top = np.lexsort((ids, ~both), axis=1)[:, : self.k]
            self.score[own], self.vec_id[own] = np.take_along_axis(both, top, axis=1), np.take_along_axis(ids, top, axis=1)

    def rows(self) -> list[np.ndarray]:
        at, place = np.nonzero(self.score != self.NONE)
        return [self.row[self.of[at]], self.question[at].astype(np.int32), self.vec_id[at, place], self.score[at, place]]


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("row", "question").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mined(
    vectors: DataFrame,
    is_anchor: str = f"vec_id % {ANCHOR_DIVISOR} = 0",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    percent: tuple[int, int] = (LEAST_PERCENT, MOST_PERCENT),
    pivots: int = PIVOTS,
    block: int = BLOCK_ANCHORS,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)`` of (vec_id, label, v).

    Scores are inner products of whole numbers (below 2**20 in size, at most 1,000 of them).  An
    anchor's positives are its first ``positives`` other rows of the same label; a positive's
    negatives the first ``negatives`` rows of other labels whose score lies between
    ``percent`` hundredths of the positive's.  First means the higher score, ties to the
    smaller id.  Only vectors of the commonest length (ties: the shorter) take part.  Rows of
    a repeated id are candidates each, and each such anchor has rows of its own.  A positive
    of negative score has no negatives, one of score zero those of score zero.  Fewer
    candidates give fewer rows, an empty table none; further columns are ignored.
    """
    spark = vectors.sparkSession
    ensure_importable(spark)
    out = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    named = vectors.select("vec_id", "label", "v")
    lengths = named.groupBy(F.size("v").alias("dim")).agg(F.count(F.lit(1)).alias("n"), F.max(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)).alias("top"))
    common = lengths.orderBy(F.desc("n"), "dim").first()
    if common is None:
        return spark.createDataFrame([], out)
    rows = spread(named.where(F.size("v") == common.dim)).withColumn("row", F.monotonically_increasing_id())
    rows = written(rows, "minedrows")  # the row numbers are fixed from here on
    sample = rows.select("v").distinct().orderBy(F.xxhash64("v"), "v").limit(PIVOT_SAMPLE).collect()
    points = np.array([r.v for r in sample])
    points = np.concatenate([points, np.sqrt(np.maximum(common.top - (points**2).sum(axis=1), 0))[:, None]], axis=1)
    centres = farthest_first(points, pivots)
    celled = written(_celled(rows, centres, common.top, is_anchor), "minedcells")
    apart = _pivot_distances(spark, centres)
    slices = max(1, -(-common.n // slice_rows))
    anchors = celled.where("asks").select("row", "vec_id", "label", "v", "own_cell", "own_d")
    body = ["row", "vec_id", "label", "v"]

    # positives: how near the (positives + 1)-th point of the label is at most, itself included, for a cell's anchors
    nearest = Window.partitionBy("label", "cell").orderBy("d")
    firsts = celled.select("label", "cell", "d").withColumn("nth", F.row_number().over(nearest)).where(F.col("nth") <= positives + 1)
    radius = anchors.groupBy("label", "own_cell").agg(F.max("own_d").alias("wide"))
    reach = firsts.join(radius, "label").join(apart, ["own_cell", "cell"]).select("label", "own_cell", (F.col("wide") + F.col("apart") + F.col("d")).alias("far"))
    by_reach = Window.partitionBy("label", "own_cell").orderBy("far")
    theta = reach.withColumn("nth", F.row_number().over(by_reach)).where(F.col("nth") == positives + 1).select("label", "own_cell", F.col("far").alias("theta"))
    groups = _groups(anchors, ["label"], len(centres), block)
    own = radius.join(theta, ["label", "own_cell"], "left").join(groups, ["label", "own_cell"])
    room = F.coalesce(F.col("theta"), F.lit(float("inf"))) + F.col("wide") + SLACK * (1 + common.top**0.5)
    bounds = own.join(apart, "own_cell").groupBy("label", "cell", "grp", "blocks").agg(F.min(F.col("apart") - room).alias("low"), F.max(F.col("apart") + room).alias("high"))
    bounds = written(bounds, "positivebounds")
    everything = F.array(F.lit(-(2**62)).cast("bigint")), F.array(F.lit(2**62).cast("bigint"))
    block_of = F.pmod(F.xxhash64("row", F.lit(5)), F.col("blocks")).cast("int").alias("block")
    asking = anchors.join(groups, ["label", "own_cell"]).select(F.col("label").alias("part"), "grp", block_of, *body, everything[0].alias("lows"), everything[1].alias("highs"))
    serving = _served(celled.select(*body, "cell", "d"), bounds, ["label"]).select(F.col("label").alias("part"), "grp", "block", *body)
    found = _best(_met(spark, asking, serving, slices, positives, same_label=True), positives)
    first = written(found.select("row", F.col("rank").alias("place"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")

    # negatives: whole scores between the shares of the positive's, as distances for the cells
    low, high = F.ceil(F.col("positive_score") * percent[0] / 100).cast("bigint"), F.floor(F.col("positive_score") * percent[1] / 100).cast("bigint")
    pairs = F.sort_array(F.collect_list(F.struct("place", low.alias("low"), high.alias("high"))))
    asked = first.groupBy("row").agg(pairs.alias("pairs")).select("row", F.col("pairs.low").alias("lows"), F.col("pairs.high").alias("highs"))
    asked = written(anchors.join(asked, "row"), "negativeanchors")
    size = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x) + common.top
    away = lambda score: F.sqrt(F.greatest(size - 2 * score, F.lit(0.0)))
    asked_cells = asked.groupBy("own_cell").agg(F.max("own_d").alias("wide"), F.max(away(F.array_min("lows"))).alias("outer"), F.min(away(F.array_max("highs"))).alias("inner"))
    groups = _groups(asked, [], len(centres), block)
    spare = SLACK * (1 + common.top**0.5)
    least = F.greatest(F.col("apart") - F.col("wide") - F.col("outer"), F.col("inner") - F.col("wide") - F.col("apart")) - spare
    bounds = asked_cells.join(groups, "own_cell").join(apart, "own_cell").groupBy("cell", "grp", "blocks").agg(F.min(least).alias("low"), F.max(F.col("apart") + F.col("wide") + F.col("outer") + spare).alias("high"))
    bounds = written(bounds, "negativebounds")
    asking = asked.join(F.broadcast(groups), "own_cell").select(F.lit(0).cast("bigint").alias("part"), "grp", block_of, *body, "lows", "highs")
    serving = _served(celled.select(*body, "cell", "d"), bounds, []).select(F.lit(0).cast("bigint").alias("part"), "grp", "block", *body)
    found = _best(_met(spark, asking, serving, slices, negatives, same_label=False), negatives)
    kept = found.select("row", (F.col("question") + 1).alias("place"), "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    ids = anchors.select("row", F.col("vec_id").alias("anchor_id"))
    return kept.join(first, ["row", "place"]).join(ids, "row").select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op13_hardneg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mined(labelled_vectors(read_table(spark, sf_dir, "embeddings")))


#: The same rows in DuckDB: all anchors against all rows.
OP13_SQL = f"""
WITH v AS (
  SELECT row_number() OVER () AS n, vec_id, CASE WHEN vec_id % {SHIFT_DIVISOR} = 0 THEN (label + 1) % {LABELS} ELSE label END AS label,
    list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), u AS (
  SELECT * FROM v WHERE len(v) = (SELECT len(v) FROM v GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)
), s AS (
  SELECT a.n AS anchor, a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, CAST(list_inner_product(a.v, c.v) AS BIGINT) AS score
  FROM u a JOIN u c ON a.vec_id % {ANCHOR_DIVISOR} = 0 AND a.n <> c.n
), p AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id) AS place FROM s WHERE same) WHERE place <= {POSITIVES}
), r AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
    CAST(row_number() OVER (PARTITION BY p.anchor, p.place ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank
  FROM p JOIN s ON p.anchor = s.anchor AND NOT s.same AND {LEAST_PERCENT} * p.score <= 100 * s.score AND 100 * s.score <= {MOST_PERCENT} * p.score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM r WHERE rank <= {NEGATIVES}
"""
