"""The page and source, editor and page graphs: citations, coreness by h-index rounds, four-cycles by ordered wedges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loomspark.session import written

#: What cites a source: an address' host, or an identifier in a citation template.
HOST = r"(?i)https?://(?:www\.)?([a-z0-9.-]+\.[a-z]{2,})"
IDENTIFIER = r"(?i)\|\s*(doi|isbn|pmid)\s*=\s*([^|}\s]+)"


def citations(texts: DataFrame, page: str, text: str) -> DataFrame:
    """``(page, source)``, once each: hosts of addresses and identifiers of citation templates, in lower case."""
    hosts = F.transform(F.regexp_extract_all(text, F.lit(HOST), F.lit(1)), F.lower)
    names, values = (F.regexp_extract_all(text, F.lit(IDENTIFIER), F.lit(i)) for i in (1, 2))
    marks = F.zip_with(names, values, lambda n, v: F.lower(F.concat(n, F.lit(":"), v)))
    return texts.where(F.col(page).isNotNull()).select(page, F.explode(F.array_distinct(F.concat(hosts, marks))).alias("source")).distinct()


def coreness(edges: DataFrame, left: str, right: str, rounds: int = 100) -> DataFrame:
    """``(side, node, coreness)`` of a bipartite graph; sides are the columns' names, nodes strings.

    The coreness of a node is the largest k such that it survives when nodes of fewer
    than k neighbours are peeled off until none is left.  Each round, a node's value becomes
    the largest h for which h of its neighbours have at least h; from the degrees on this falls to the
    coreness.  Neighbours are counted by value before a node sees them, so a node of very many
    neighbours handles as many rows as there are values.  Rows with a null leave; repeated
    edges are one.
    """
    pairs = edges.select(F.col(left).cast("string").alias("a"), F.col(right).cast("string").alias("b")).dropna().distinct()
    both = pairs.select(F.lit(left).alias("side"), F.col("a").alias("node"), F.lit(right).alias("other"), F.col("b").alias("to"))
    both = both.unionByName(pairs.select(F.lit(right).alias("side"), F.col("b").alias("node"), F.lit(left).alias("other"), F.col("a").alias("to")))
    both = written(both, "edges")
    values = written(both.groupBy("side", "node").agg(F.count(F.lit(1)).alias("value")), "coreness")
    total = values.agg(F.sum("value")).first()[0]
    for _ in range(rounds):
        theirs = values.select(F.col("side").alias("other"), F.col("node").alias("to"), "value")
        counted = both.join(theirs, ["other", "to"]).groupBy("side", "node", "value").agg(F.count(F.lit(1)).alias("n"))
        above = Window.partitionBy("side", "node").orderBy(F.desc("value")).rowsBetween(Window.unboundedPreceding, 0)
        values = written(counted.withColumn("least", F.least("value", F.sum("n").over(above))).groupBy("side", "node").agg(F.max("least").alias("value")), "coreness")
        now = values.agg(F.sum("value")).first()[0]
        if now == total:
            return values.withColumnRenamed("value", "coreness")
        total = now
    raise RuntimeError(f"coreness did not settle in {rounds} rounds")


def four_cycles(edits: DataFrame, page: str, editor: str) -> DataFrame:
    """``(editor, cycles)``: how often the editor meets a co-editor of one page on a second page.

    A cycle is two editors and two pages, each editor on both.  All nodes are ranked by degree;
    a wedge is kept only where its last end ranks above its centre and its other end,
    so that a page of very many editors is an end, hardly ever a centre: the wedges number
    at most edges times arboricity, not the square of a page's editors.  Wedges of equal ends make the
    cycles.  Every editor of an edit is listed; rows with a null leave.
    """
    pairs = edits.select(F.col(page).alias("p"), F.col(editor).alias("e")).dropna().distinct()
    pairs = written(pairs, "coedits")
    degree = {c: pairs.groupBy(c).agg(F.count(F.lit(1)).alias(f"d{c}")) for c in ("p", "e")}
    # a rank that no two nodes share: degree, side, node
    rank = lambda c, side: F.struct(F.col(f"d{c}").alias("d"), F.lit(side).alias("s"), F.col(c).cast("string").alias("n"))
    ranks = pairs.join(degree["p"], "p").join(degree["e"], "e").select(rank("p", 0).alias("p"), rank("e", 1).alias("e"))
    edges = written(ranks.select(F.greatest("p", "e").alias("high"), F.least("p", "e").alias("low")), "rankededges")
    # wedge high - low - other: from the highest node down to a centre and on to another node below the highest
    down = edges.select(F.col("low").alias("centre"), F.col("high").alias("top"))
    other = edges.select(F.col("low").alias("centre"), F.col("high").alias("end")).unionByName(edges.select(F.col("high").alias("centre"), F.col("low").alias("end")))
    wedges = down.join(other, "centre").where("end < top")
    ends = wedges.groupBy("top", "end").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    ends = written(ends, "wedges")
    pairs_of = (F.col("n") * (F.col("n") - 1) / 2).cast("bigint")
    met = ends.where("top.s = 1")  # two editors are the ends: all cycles are theirs
    own = met.select(F.col("top.n").alias("e"), pairs_of.alias("k")).unionByName(met.select(F.col("end.n").alias("e"), pairs_of.alias("k")))
    # two pages are the ends: every centre is an editor, in a cycle with each other centre
    centres = wedges.join(ends.where("top.s = 0").select("top", "end", "n"), ["top", "end"]).select(F.col("centre.n").alias("e"), (F.col("n") - 1).cast("bigint").alias("k"))
    sums = own.unionByName(centres).groupBy("e").agg(F.sum("k").alias("cycles"))
    every = degree["e"].select("e", F.col("e").cast("string").alias("name"))
    return every.join(sums.withColumnRenamed("e", "name"), "name", "left").select(F.col("e").alias(editor), F.coalesce("cycles", F.lit(0)).cast("bigint").alias("cycles"))
