"""Connected components of an edge table by alternating star contractions."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomspark.session import ensure_importable

from .common import arrow_schema, written

#: Links that a task joins at once; a table of no more needs no round of exchanges.
BLOCK_LINKS = 1 << 18


def connected_components(edges: DataFrame, max_rounds: int = 60, block: int = BLOCK_LINKS) -> DataFrame:
    """``edges(a long, b long)`` to ``(node long, root long)``; root is the smallest node.

    First every task joins the links that it reads, ``block`` at a time, and passes on
    stars.  If ``block`` or fewer are left, one more such step settles them.  Else every
    round points the larger neighbours of a node at its smallest one, then
    does the same for the smaller neighbours.  Both steps keep connectivity, each is
    one aggregate with map-side combine and one join that adaptive execution can
    split, and a hub only ever sends its minimum.  Rounds grow with the logarithm
    of a chain's length.  Self links and repeated links are harmless; an empty
    table gives an empty result.
    """
    state = written(_contracted(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")), block), "links")
    seen = _mark(state)
    for _ in range(max_rounds):
        if seen[0] == 0:
            break
        if seen[0] <= block:
            state = written(_contracted(state.coalesce(1), block), "links")
            break
        both = state.unionByName(state.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        state = written(small.select("e.u", "e.v").where("u <> v").distinct(), "links")
        now = _mark(state)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return state.select(F.col("u").alias("node"), F.col("v").alias("root"))


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every node of the links ``(a, b)`` but the smallest of its component, and that one."""
    nodes, places = np.unique(np.concatenate([a, b]), return_inverse=True)
    parent = list(range(len(nodes)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    for x, y in places.reshape(2, -1).T.tolist():
        x, y = root(x), root(y)
        parent[max(x, y)] = min(x, y)
    roots = np.fromiter(map(root, range(len(nodes))), np.int64, len(nodes))
    rest = np.flatnonzero(roots != np.arange(len(nodes)))
    return nodes[rest], nodes[roots[rest]]


def _contracted(pairs: DataFrame, block: int) -> DataFrame:
    """Stars in place of the links (u, v) that a task reads, ``block`` of them at a time."""
    ensure_importable(pairs.sparkSession)
    kind = arrow_schema(pairs.sparkSession, "u bigint, v bigint")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def settled() -> pa.RecordBatch:
            ends = [np.concatenate([x.column(i).to_numpy() for x in held]) for i in (0, 1)]
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in stars(*ends)], schema=kind)

        for batch in batches:
            if held and size + batch.num_rows > block:
                yield settled()
                held, size = [], 0
            held.append(batch)
            size += batch.num_rows
        if held:
            yield settled()

    return pairs.mapInArrow(run, "u bigint, v bigint")


def _mark(state: DataFrame) -> tuple[int, int]:
    """Row count and an order-free checksum; equal marks mean nothing moved."""
    row = state.agg(F.count(F.lit(1)), F.coalesce(F.bit_xor(F.xxhash64("u", "v")), F.lit(0))).first()
    return row[0], row[1]
