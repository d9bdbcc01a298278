"""Exact top-k inner product by best-first search over paged M-trees.

A vector x becomes the point [x, sqrt(M*M - |x|^2)] and a query [q, 0]; the closer the
points, the larger the inner product, so a metric tree answers maximum inner product.
Each shard of the candidates is one tree of pages with covering radii and distances to
the parent.  Shards hold the vectors nearest to one pivot.  A block of queries visits the
shards of its own pivot first; with the k-th scores found there it visits only those others
whose root could reach one of them, and there too a page whose triangle-inequality bound
cannot reach the k-th score is never computed.
"""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loomspark.session import ensure_importable

from .common import arrow_schema, map_arrow, read_table, written

SCALE, QUERY_DIVISOR, TOP = 256, 50, 5
#: Vectors in a shard's tree, in a leaf page, and queries in a block.
SHARD_VECTORS, PAGE, BLOCK_QUERIES = 16_384, 128, 512
#: Pivots at most, the vectors they are chosen from, and the roots that a task knows by heart.
MOST_PIVOTS, PIVOT_SAMPLE, ROOT_LIMIT = 256, 4096, 50_000


class MTree:
    """Two levels of pages over distinct points, built by farthest-first pivots.

    Equal vectors are one entry with its ``keep`` smallest ids: of equal scores only the
    smallest ids can reach a top ``keep``.
    """

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, keep: int):
        order = np.lexsort((ids,))
        ids, vectors = ids[order], vectors[order]
        distinct, inverse = np.unique(vectors, axis=0, return_inverse=True)
        self.members = _first_members(ids, inverse.ravel(), len(distinct), keep)
        norms = np.einsum("ij,ij->i", distinct, distinct)
        self.top = float(norms.max()) if len(norms) else 0.0
        points = np.concatenate([distinct, np.sqrt(np.maximum(self.top - norms, 0))[:, None]], axis=1)
        self.pages = []
        for inner in _clusters(points, np.arange(len(points)), max(1, round(len(points) / (PAGE * 16)))):
            leaves = []
            for leaf in _clusters(points, inner, max(1, round(len(inner) / PAGE))):
                pivot = points[leaf].mean(axis=0)
                away = np.sqrt(((points[leaf] - pivot) ** 2).sum(axis=1))
                by = np.argsort(away)
                leaves.append((pivot, float(away.max()), leaf[by], away[by]))
            pivot = np.mean([p for p, *_ in leaves], axis=0)
            to_parent = np.array([np.sqrt(((p - pivot) ** 2).sum()) for p, *_ in leaves])
            radius = float(max(d + leaf[1] for d, leaf in zip(to_parent, leaves, strict=True)))
            self.pages.append((pivot, radius, to_parent, leaves))
        self.vectors = distinct
        self.leaves_read = 0

    def root(self) -> tuple[np.ndarray, float]:
        """A centre and the farthest vector's distance from it."""
        centre = self.vectors.mean(axis=0)
        return centre, float(np.sqrt(((self.vectors - centre) ** 2).sum(axis=1).max())) * (1 + 1e-9)

    def search(self, query: np.ndarray, k: int, own: int | None, floor: float = -np.inf) -> list[tuple[int, int]]:
        """The ``k`` best (score, id), larger scores first and ties to the smaller id.

        One entry of the id ``own`` with the query's vector, the query's row itself, is left
        out.  Entries below ``floor``, which ``k`` others are known to reach, need not be found.
        """
        point = np.append(query, 0.0)
        size = float(query @ query)
        slack = 1e-9 * (size + self.top + 1)
        best: list[tuple[int, int]] = []  # heap of (score, -id): the worst on top

        def reach(distance: float) -> float:
            """The largest score a point this far away can have."""
            return (size + self.top - max(distance, 0.0) ** 2) / 2 + slack

        queue = []
        for n, (pivot, radius, _, _) in enumerate(self.pages):
            d = float(np.sqrt(((point - pivot) ** 2).sum()))
            heapq.heappush(queue, (-reach(d - radius), n, -1, d))
        while queue:
            bound, n, leaf, d = heapq.heappop(queue)
            least = max(best[0][0], floor) if len(best) == k else floor
            if -bound < least:
                break
            if leaf < 0:
                _, _, to_parent, leaves = self.pages[n]
                for m, (pivot, radius, _, _) in enumerate(leaves):
                    # the parent's distance bounds the child's without computing it
                    if reach(abs(d - to_parent[m]) - radius) < least:
                        continue
                    own_d = float(np.sqrt(((point - pivot) ** 2).sum()))
                    heapq.heappush(queue, (-reach(own_d - radius), n, m, own_d))
                continue
            _, _, entries, away = self.pages[n][3][leaf]
            self.leaves_read += 1
            if least > -np.inf:
                far = np.sqrt(max(size + self.top - 2 * (least - slack), 0.0))
                a, b = np.searchsorted(away, (d - far, d + far), side="left")
                entries = entries[max(0, a - 1) : b + 1]
            scores = self.vectors[entries] @ query
            for i in np.argsort(-scores, kind="stable") if len(best) < k else np.flatnonzero(scores >= least):
                score = int(scores[i])
                if len(best) == k and score < best[0][0]:
                    continue
                members = self.members[entries[i]]
                if own in members and np.array_equal(self.vectors[entries[i]], query):
                    at = members.index(own)
                    members = members[:at] + members[at + 1 :]
                for x in members:
                    item = (score, -x)
                    if len(best) < k:
                        heapq.heappush(best, item)
                    elif item > best[0]:
                        heapq.heapreplace(best, item)
                    else:
                        break
        return [(s, -x) for s, x in sorted(best, reverse=True)]


def _first_members(ids: np.ndarray, group: np.ndarray, n: int, keep: int) -> list[list[int]]:
    order = np.argsort(group, kind="stable")  # ids are ascending inside a group
    edges = np.searchsorted(group[order], np.arange(n + 1))
    return [ids[order[a : min(b, a + keep)]].tolist() for a, b in zip(edges, edges[1:], strict=False)]


def _clusters(points: np.ndarray, members: np.ndarray, n: int) -> list[np.ndarray]:
    """Members by their nearest of ``n`` pivots, chosen farthest first."""
    if n <= 1 or len(members) <= 1:
        return [members]
    own = points[members]
    nearest = ((own - own[0]) ** 2).sum(axis=1)
    label = np.zeros(len(own), np.int64)
    for k in range(1, min(n, len(own))):
        far = int(nearest.argmax())
        d = ((own - own[far]) ** 2).sum(axis=1)
        label[d < nearest] = k
        nearest = np.minimum(nearest, d)
    return [members[label == k] for k in range(n) if (label == k).any()]


def farthest_first(points: np.ndarray, n: int) -> np.ndarray:
    """``n`` of the points, each the farthest from those before, in an order that keeps near ones together."""
    chosen, nearest = [0], ((points - points[0]) ** 2).sum(axis=1)
    while len(chosen) < n and nearest.max() > 0:
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, ((points - points[chosen[-1]]) ** 2).sum(axis=1))
    left = points[chosen]
    order = [0]
    rest = set(range(1, len(left)))
    while rest:  # a chain of nearest neighbours: groups are stretches of it
        near = min(rest, key=lambda i: (((left[i] - left[order[-1]]) ** 2).sum(), i))
        order.append(near)
        rest.remove(near)
    return left[order]


def scaled_vectors(table: DataFrame, scale: int = SCALE) -> DataFrame:
    """``(vec_id, v array<double>)`` of floor(scale * x); rows with a null or non-finite component take no part."""
    doubles = table.select("vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("v")).where("vec_id IS NOT NULL AND v IS NOT NULL AND size(v) > 0")
    fine = doubles.where(~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))
    return fine.select("vec_id", F.transform("v", lambda x: F.floor(x * scale).cast("double")).alias("v"))


def top_products(vectors: DataFrame, queries: DataFrame, k: int = TOP, shard_vectors: int = SHARD_VECTORS, block: int = BLOCK_QUERIES) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` best candidates of every query row.

    Both tables have (vec_id, v), further columns are ignored whatever their names.  Every
    row but the query's own is a candidate: rows of one id are candidates each, and each is
    asked for.  Only vectors of the query's length count.  Components must be whole numbers
    below 2**26 in size, so that products are exact.  Fewer than ``k`` candidates give
    fewer rows; empty tables none.

    A shard's tree travels to one task for each of the two rounds, is opened once and answers
    the blocks of queries that visit it.
    """
    spark = vectors.sparkSession
    ensure_importable(spark)
    vectors, queries = vectors.select("vec_id", "v"), queries.select("vec_id", "v")
    n_rows = vectors.count()
    pivots = _pivots(vectors, min(MOST_PIVOTS, -(-n_rows // shard_vectors)))
    order = Window.partitionBy("query_id", "question").orderBy(F.desc("score"), "vec_id")
    # equal rows are one question, asked ``copies`` times
    asking = _celled(queries.groupBy("vec_id", "v").agg(F.count(F.lit(1)).alias("copies")), pivots)
    placed = _celled(vectors.withColumn("copies", F.lit(1).cast("bigint")), pivots)
    shards = _parts(placed, shard_vectors)
    trees = written(_packed(placed, shards, 7, lambda ids, values, *_: MTree(ids, values, k + 1)), "mtrees")
    asked = _packed(asking.withColumn("floor", F.lit(float("-inf"))), _parts(asking, block), 13, lambda *rows: rows)
    # the first round: the shards of the queries' own cells
    here = F.broadcast(spark.createDataFrame([(c, first + i) for c, (first, n) in shards.items() for i in range(n)], "cell int, part bigint"))
    found = written(_visited(trees, asked.drop("part").join(here, "cell"), k), "firsttop")
    if sum(n for _, n in shards.values()) > 1:
        kth = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), "question", F.col("score").cast("double").alias("kth"))
        floors = asking.join(kth, ["vec_id", "question"], "left").withColumn("floor", F.coalesce("kth", F.lit(float("-inf"))))
        asked = _packed(floors, _parts(asking, block), 13, lambda *rows: rows)
        found = found.unionByName(_visited(trees, _routed(trees, asked, shards), k))
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    once = best.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), "copies")))
    return once.select("query_id", "rank", "vec_id", "score")


def _question(v: np.ndarray) -> int:
    """What tells rows of one id and different vectors apart."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(v.tobytes())).astype(np.int64))


def _pivots(vectors: DataFrame, n: int) -> np.ndarray:
    """Up to ``n`` far apart vectors of a bounded sample, of the sample's commonest length."""
    if n <= 1:
        return np.zeros((0, 0))
    sample = [r.v for r in vectors.select("v").distinct().orderBy(F.xxhash64("v"), "v").limit(PIVOT_SAMPLE).collect()]
    dims = [len(v) for v in sample]
    dim = max(sorted(set(dims)), key=dims.count)
    return farthest_first(np.array([v for v in sample if len(v) == dim]), n)


def _celled(rows: DataFrame, pivots: np.ndarray) -> DataFrame:
    """Rows with the number of their nearest pivot (0 for vectors of another length) and their vector's hash."""
    sizes = (pivots**2).sum(axis=1)

    def run(cols):
        cells = np.zeros(len(cols["v"]), np.int64)
        values = [np.array(v) for v in cols["v"].to_pylist()]
        at = [i for i, v in enumerate(values) if len(pivots) and len(v) == pivots.shape[1]]
        if at:
            cells[at] = (sizes[None] - 2 * np.array([values[i] for i in at]) @ pivots.T).argmin(axis=1)
        return {"vec_id": cols["vec_id"], "v": cols["v"], "copies": cols["copies"], "cell": cells.tolist(), "question": [_question(v) for v in values]}

    return map_arrow(rows.select("vec_id", "v", "copies"), run, "vec_id bigint, v array<double>, copies bigint, cell int, question bigint")


def _parts(rows: DataFrame, size: int) -> dict[int, tuple[int, int]]:
    """For each cell, the first of its parts and how many of about ``size`` rows it has; cells are as few as pivots."""
    out, first = {}, 0
    for r in rows.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).orderBy("cell").collect():
        n = max(1, -(-r.n // size))
        out[r.cell] = (first, n)
        first += n
    return out


def _packed(rows: DataFrame, parts: dict[int, tuple[int, int]], salt: int, make) -> DataFrame:
    """``(part, cell, dim, body)``: what ``make`` gives for the ids, vectors, copies and floors of each part."""
    spark = rows.sparkSession
    kind = arrow_schema(spark, "part bigint, cell int, dim int, body binary")
    named = spark.createDataFrame([(c, first, n) for c, (first, n) in parts.items()], "cell int, first bigint, parts bigint")
    floor = "floor" if "floor" in rows.columns else F.lit(0.0).alias("floor")
    # rows of one id and vector are one entry or question; others of the id may go elsewhere
    part = (F.col("first") + F.pmod(F.xxhash64("vec_id", "v", F.lit(salt)), F.col("parts"))).alias("part")
    dealt = rows.join(F.broadcast(named), "cell").select("vec_id", "v", "copies", floor, "cell", part)
    n = min(max(1, sum(n for _, n in parts.values())), int(spark.conf.get("spark.sql.shuffle.partitions")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int, int], list] = {}
        for batch in batches:
            for i, v, c, f, cell, p in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for key in [key for key in held if key[0] != p]:  # sorted by part: the others are whole
                    yield body(key, held.pop(key))
                held.setdefault((p, cell, len(v)), []).append((i, v, c, f))
        for key in list(held):
            yield body(key, held.pop(key))

    def body(key, members):
        ids, values, copies, floors = zip(*members, strict=True)
        made = make(np.array(ids, np.int64), np.array(values), np.array(copies, np.int64), np.array(floors))
        return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip((*key, pickle.dumps(made)), kind, strict=True)], schema=kind)

    return dealt.repartition(n, "part").sortWithinPartitions("part").mapInArrow(run, "part bigint, cell int, dim int, body binary")


def _routed(trees: DataFrame, asked: DataFrame, shards: dict[int, tuple[int, int]]) -> DataFrame:
    """``(part, dim, body)``: each block for the shards outside its cell whose root can reach a query's floor.

    A root is a centre and a radius: q.x <= q.c + |q| r.  Beyond ``ROOT_LIMIT`` shards every block goes everywhere.
    """
    spark = trees.sparkSession
    of = {first + i: cell for cell, (first, n) in shards.items() for i in range(n)}

    def rooted(cols):
        made = [pickle.loads(b).root() for b in cols["body"].to_pylist()]
        return {"part": cols["part"], "dim": cols["dim"], "centre": [c.tolist() for c, _ in made], "radius": [r for _, r in made]}

    roots = map_arrow(trees.select("part", "dim", "body"), rooted, "part bigint, dim int, centre array<double>, radius double")
    known = roots.limit(ROOT_LIMIT + 1).collect()
    by_dim = {}
    if len(known) <= ROOT_LIMIT:
        for dim in {r.dim for r in known}:
            own = [r for r in known if r.dim == dim]
            by_dim[dim] = (np.array([r.part for r in own]), np.array([r.centre for r in own]), np.array([r.radius for r in own]))

    def route(cols):
        out = {"part": [], "dim": [], "body": []}
        for cell, dim, body in zip(cols["cell"].to_pylist(), cols["dim"].to_pylist(), cols["body"].to_pylist()):
            if dim not in by_dim and len(known) <= ROOT_LIMIT:
                continue
            if dim in by_dim:
                parts, centres, radii = by_dim[dim]
                _, v, _, floors = pickle.loads(body)
                bound = v @ centres.T + np.sqrt((v**2).sum(axis=1))[:, None] * radii[None]
                some = parts[(bound * (1 + 1e-9 * np.sign(bound)) + 1e-6 >= floors[:, None]).any(axis=0)].tolist()
            else:
                some = list(of)
            some = [p for p in some if of[p] != cell]
            out["part"] += some
            out["dim"] += [dim] * len(some)
            out["body"] += [body] * len(some)
        return out

    return map_arrow(asked.select("cell", "dim", "body"), route, "part bigint, dim int, body binary")


def _visited(trees: DataFrame, visits: DataFrame, k: int) -> DataFrame:
    """``(query_id, question, copies, vec_id, score)``: what each shard has for the blocks that visit it."""
    spark = trees.sparkSession
    meet = trees.select("part", "dim", F.lit(0).alias("kind"), "body").unionByName(visits.select("part", "dim", F.lit(1).alias("kind"), "body"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = meet.repartition(parts, "part").sortWithinPartitions("part", "dim", "kind")
    fields = "query_id bigint, question bigint, copies bigint, vec_id bigint, score bigint"
    kind = arrow_schema(spark, fields)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, at = None, None
        for batch in batches:
            for part, dim, what, body in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if what == 0:
                    tree, at = pickle.loads(body), (part, dim)
                elif at == (part, dim):
                    rows = []
                    for i, v, c, floor in zip(*pickle.loads(body), strict=True):
                        question = _question(v)
                        rows += [(int(i), question, int(c), x, s) for s, x in tree.search(v, k, int(i), floor)]
                    yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], f.type) for c, f in enumerate(kind)], schema=kind)

    return dealt.mapInArrow(search, fields)


def op9_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = scaled_vectors(read_table(spark, sf_dir, "embeddings"))
    return top_products(vectors, vectors.where(F.col("vec_id") % QUERY_DIVISOR == 0))


#: The same rows in DuckDB: all queries against all vectors.
OP9_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS n, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.n AS question, q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.n <> c.n AND len(q.v) = len(c.v)
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY question ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
