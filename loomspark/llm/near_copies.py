"""Near copies by shingle similarity: texts whose sets of five-word shingles agree to 0.8 or more.

The near-duplicate operator goes first, over five-word shingles: fingerprints by majority
vote, their 64 one-wildcard variants, equal variants joined, at most three of 64 bits
different.  At similarity 0.8 a bit of a fingerprint differs with a chance of 0.15, so most
such pairs are further apart.  For these the same index is laid over wider symbols.  The
signature has minimum hashes in place of bits, of which 0.2 differ: it is cut into seven
segments of six symbols, and where one segment differs in at most one symbol, both texts
share a variant with a single symbol wildcarded.  Every link of either index is verified on
the two whole sets of shingles.  A pair of similarity 0.8 shares no variant of symbols with a
chance of 0.345**7, six in ten thousand, and less the more it agrees.

Texts whose fingerprints link, or that share a variant of symbols and whose signatures agree
to some degree, are one family.  Links are looked for inside families, by whole shingle sets
and among all members, in blocks: a task holds one block and gives back links that span its
components, never pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loomspark.session import ensure_importable

from .common import arrow_schema, map_arrow, signed, spread, text_bytes, written
from .components import connected_components
from .simhash import SEED, shingle_hashes, voted
from .simhash import links as fingerprint_links

SHINGLE_WORDS = 5
LEAST_SIMILARITY = 0.8
SEGMENTS, SYMBOLS = 7, 6
#: Segments whose variants are looked at first; the others' only where they join more.
FIRST_SEGMENTS = 2
#: Share of equal symbols below which two texts of a key are not of one family: a pair of similarity 0.8 has less once in a million.
LEAST_AGREEMENT = 0.5
#: Members and bytes of a block.
BLOCK_NODES, BLOCK_BYTES = 1024, 32 << 20
#: Shingles whose minimum hashes are taken at once, and columns of a block's incidence.
BLOCK, COLUMNS = 4096, 4096

_SIZE = SEGMENTS * SYMBOLS
_FACTORS = np.random.default_rng(SEED).integers(1 << 31, size=(_SIZE, 2), dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_PLACES = np.random.default_rng(SEED + 1).integers(1 << 63, size=_SIZE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(text: bytes, size: int = SHINGLE_WORDS) -> np.ndarray:
    """The distinct hashes of all shingles, ascending; a shorter text is one shingle, a wordless one has none."""
    return np.unique(shingle_hashes(text, size))


def symbols(marks: np.ndarray) -> np.ndarray:
    """The minimum hashes of a set; an empty set has the largest number everywhere."""
    low = (marks ^ (marks >> np.uint64(32))).astype(np.uint32)
    least = np.full(_SIZE, np.iinfo(np.uint32).max, np.uint32)
    for i in range(0, len(low), BLOCK):
        np.minimum(least, (_FACTORS[:, :1] * low[None, i : i + BLOCK] + _FACTORS[:, 1:]).min(axis=1), out=least)
    return least


def variants(signatures: np.ndarray) -> np.ndarray:
    """Keys of the one-wildcard variants, a row of ``SEGMENTS * SYMBOLS`` for each row of symbols.

    A segment's key is a sum of terms, one for each symbol at its place; leaving one term out is its variant.
    """
    with np.errstate(over="ignore"):
        terms = (signatures.astype(np.uint64) + np.uint64(1)) * _PLACES
        terms ^= terms >> np.uint64(29)
        terms *= _PLACES
        whole = terms.reshape(-1, SEGMENTS, SYMBOLS).sum(axis=2, dtype=np.uint64)
        keys = np.repeat(whole, SYMBOLS, axis=1) - terms + _PLACES  # the place left out is part of the key
        return keys ^ (keys >> np.uint64(31))


def _marked(docs: DataFrame) -> DataFrame:
    """``(doc_id, mark, node, fp, signature)``: equal sets of shingles are one node; one without shingles has no signature."""

    def run(cols):
        nodes, fps, rows = [], [], []
        for t in text_bytes(cols["text"]):
            hashes = shingle_hashes(t, SHINGLE_WORDS)
            found = np.unique(hashes)
            nodes.append(xxhash.xxh64_intdigest(found.tobytes(), SEED))
            fps.append(voted(hashes))
            rows.append(symbols(found).astype(">u4").tobytes() if len(found) else None)
        return {
            "doc_id": cols["doc_id"],
            "mark": cols["mark"],
            "node": signed(np.array(nodes, np.uint64)),
            "fp": signed(np.array(fps, np.uint64)),
            "signature": rows,
        }

    return map_arrow(docs.select("doc_id", F.xxhash64("text").alias("mark"), "text"), run, "doc_id bigint, mark bigint, node bigint, fp bigint, signature binary")


def _nodes(marks: DataFrame) -> DataFrame:
    """``(node, doc_id, mark, fp, signature, keys)``, a row for each node: its smallest id, with that text's fingerprint."""

    def run(cols):
        bodies = cols["signature"].to_pylist()
        matrix = np.frombuffer(b"".join(b for b in bodies if b), ">u4").reshape(-1, _SIZE)
        keys = iter(signed(variants(matrix)).tolist())
        return cols | {"keys": [next(keys) if b else [] for b in bodies]}

    each = marks.groupBy("node").agg(F.min(F.struct("doc_id", "mark", "fp")).alias("rep"), F.first("signature").alias("signature"))
    return map_arrow(each.select("node", "rep.doc_id", "rep.mark", "rep.fp", "signature"), run, "node bigint, doc_id bigint, mark bigint, fp bigint, signature binary, keys array<bigint>")


def by_fingerprint(nodes: DataFrame) -> DataFrame:
    """``(a, b)``: links that connect the nodes (node, fp) whose fingerprints are equal or at most three bits apart."""
    fps = written(nodes.groupBy("fp").agg(F.min("node").alias("least")), "nearfps")
    same = nodes.join(fps, "fp").where("node <> least").select(F.col("least").alias("a"), F.col("node").alias("b"))
    ends = [fps.select(F.col("fp").alias(c), F.col("least").alias(f"{c}_node")) for c in "ab"]
    near = fingerprint_links(fps.select("fp")).join(ends[0], "a").join(ends[1], "b")
    return same.unionByName(near.select(F.col("a_node").alias("a"), F.col("b_node").alias("b")))


def agreement(bodies: list[bytes], least: float = LEAST_SIMILARITY) -> np.ndarray:
    """Which pairs of signatures have enough symbols in common to be ``least`` alike."""
    rows = np.frombuffer(b"".join(bodies), np.uint32).reshape(len(bodies), -1)
    equal = np.zeros((len(rows), len(rows)), np.uint8)
    for column in rows.T:
        equal += column[:, None] == column[None]
    return equal >= min(LEAST_AGREEMENT, least - 0.3) * rows.shape[1]


def resemblance(bodies: list[bytes], least: float = LEAST_SIMILARITY) -> np.ndarray:
    """Which pairs of shingle sets share at least ``least`` of their union; counted, not estimated."""
    sets = [np.frombuffer(b, np.uint64) for b in bodies]
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    values = np.concatenate(sets)
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    first = np.concatenate(([True], values[1:] != values[:-1]))
    column = np.cumsum(first) - 1
    shared = np.bincount(column)[column] > 1  # what a single set holds adds to no pair
    owner, column = owner[shared], np.unique(column[shared], return_inverse=True)[1]
    common = np.zeros((len(sets), len(sets)), np.float32)
    for at in range(0, int(column.max()) + 1 if len(column) else 0, COLUMNS):
        a, b = np.searchsorted(column, (at, at + COLUMNS))
        part = np.zeros((len(sets), min(COLUMNS, int(column[b - 1]) - at + 1)), np.float32)
        part[owner[a:b], column[a:b] - at] = 1
        common += part @ part.T
    common = common.astype(np.int64)
    return common / np.maximum(sizes[:, None] + sizes[None] - common, 1) >= least


def spanning(alike: np.ndarray, roots: list[int]) -> list[tuple[int, int]]:
    """Links, as places, that join all that ``alike`` and equal roots connect; none inside a root."""
    root = np.unique(np.array(roots, np.int64), return_inverse=True)[1]
    alike = alike | (root[:, None] == root[None])
    links, seen = [], np.zeros(len(root), bool)
    for start in range(len(root)):
        if seen[start]:
            continue
        seen[start] = True
        queue = [start]
        while queue:
            at = queue.pop()
            new = np.flatnonzero(alike[at] & ~seen)
            seen[new] = True
            links += [(at, int(x)) for x in new if root[x] != root[at]]
            queue += new.tolist()
    return links


def _links(units: DataFrame, alike: Callable[[list[bytes]], np.ndarray]) -> DataFrame:
    """``(a, b)``: links that span each unit's components, of rows (grp, near, far, node, root, body)."""
    ensure_importable(units.sparkSession)
    kind = arrow_schema(units.sparkSession, "a bigint, b bigint")
    unit = ["grp", "near", "far"]
    parts = int(units.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = units.select(*unit, "node", "root", "body").repartition(parts, *unit).sortWithinPartitions(*unit)

    def found(nodes, roots, bodies) -> Iterator[pa.RecordBatch]:
        if len(set(roots)) > 1:
            pairs = [(nodes[i], nodes[j]) for i, j in spanning(alike(bodies), roots)]
            if pairs:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*pairs, strict=True)], schema=kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, held = None, ([], [], [])
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for *key, node, root, body in zip(*columns, strict=True):
                if key != here:
                    yield from found(*held)
                    here, held = key, ([], [], [])
                for column, value in zip(held, (node, root, body), strict=True):
                    column.append(value)
        yield from found(*held)

    return dealt.mapInArrow(run, "a bigint, b bigint")


class Joined:
    """The components that the links found so far make."""

    def __init__(self):
        self.roots: DataFrame | None = None

    def add(self, new: DataFrame) -> bool:
        new = written(new, "nearlinks")
        if new.isEmpty():
            return False
        if self.roots is not None:
            new = new.unionByName(self.roots.select(F.col("node").alias("a"), F.col("root").alias("b")))
        self.roots = connected_components(new)
        return True

    def placed(self, rows: DataFrame) -> DataFrame:
        if self.roots is None:
            return rows.withColumn("root", F.col("node"))
        return rows.join(self.roots, "node", "left").withColumn("root", F.coalesce("root", "node"))


def join_groups(rows: DataFrame, alike: Callable[[list[bytes]], np.ndarray], joined: Joined, nodes: int, size: int) -> None:
    """Adds links to ``joined`` until it has all components of ``alike`` over the members of each group.

    ``rows`` are (grp, node, body).  A group that fits a block is one task's and done with
    it.  A larger one is cut into blocks twice, at random each time, which joins nearly all
    that belongs together.  What then is not of the group's largest component meets all of
    the group, block by block; so no pair of different components is left out, however
    large the group, and members already joined meet only the few others.
    """

    def split(placed: DataFrame) -> DataFrame:
        sums = placed.groupBy("grp").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("body")).alias("bytes"), F.min("root").alias("low"), F.max("root").alias("high"))
        parts = F.greatest(F.ceil(F.col("n") / nodes), F.ceil(F.col("bytes") / size)).cast("int")
        return sums.where("low <> high").select("grp", parts.alias("parts"))

    def block(seed: int, parts: str):
        return F.pmod(F.xxhash64("node", F.lit(seed)), F.col(parts)).cast("int")

    placed = joined.placed(rows)
    groups = written(split(placed), "neargroups")
    joined.add(_links(placed.join(groups, "grp").withColumn("near", block(1, "parts")).withColumn("far", F.lit(0)), alike))
    large = groups.where("parts > 1").select("grp")
    if large.isEmpty():
        return
    rows = written(rows.join(large, "grp", "left_semi"), "nearlarge")
    placed = joined.placed(rows)
    joined.add(_links(placed.join(split(placed), "grp").withColumn("near", block(2, "parts")).withColumn("far", F.lit(0)), alike))
    placed = joined.placed(rows)
    groups = split(placed).where("parts > 1")
    members = placed.join(groups, "grp").groupBy("grp", "parts", "root").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("body")).alias("bytes"))
    ends = members.groupBy("grp", "parts").agg(F.max_by("root", F.struct("n", "root")).alias("main"), F.sum("n").alias("all"), F.sum("bytes").alias("all_bytes"), F.max(F.struct("n", "root", "bytes")).alias("most"))
    rest = F.greatest(F.ceil((F.col("all") - F.col("most.n")) / nodes), F.ceil((F.col("all_bytes") - F.col("most.bytes")) / size)).cast("int")
    ends = written(ends.select("grp", "parts", "main", rest.alias("rest")), "nearrest")
    if ends.isEmpty():
        return
    both = placed.join(ends, "grp")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    few = both.where("root <> main").withColumn("near", block(3, "rest")).withColumn("far", each("parts"))
    all_ = both.withColumn("far", block(4, "parts")).withColumn("near", each("rest"))
    # a member that is in a unit twice stands there once
    units = few.unionByName(all_).dropDuplicates(["grp", "near", "far", "node"])
    joined.add(_links(units, alike))


def near_copies(docs: DataFrame, least: float = LEAST_SIMILARITY, nodes: int = BLOCK_NODES, size: int = BLOCK_BYTES) -> DataFrame:
    """``(doc_id, component_id)`` for every row with an id: the smallest id reachable over verified links.

    Two texts are linked if their shingle sets are alike enough; every pair of a family is
    accounted for, so of the links only those can be missing whose fingerprints differ in
    more than three bits and whose signatures share no variant (six in ten thousand at
    similarity 0.8) or agree in less than half (one in a million).  Rows between tasks are in
    proportion to the texts: a node sends its fingerprint with 64 variants and itself with 42,
    a member travels once for each shared variant with its signature, and at most a few times
    with its set.  Only a family of more than ``nodes`` members (or ``size`` bytes) whose
    members do not link costs more: those that are not of its largest component meet the
    others in blocks.

    Null and wordless texts are one node, without links; equal texts are one node; an empty
    table gives no rows; texts of any length are read whole; further columns are ignored.
    """
    rows = docs.where("doc_id IS NOT NULL")
    marks = written(_marked(rows), "nearmarks")
    each = written(_nodes(marks), "nearnodes")
    families, links = Joined(), Joined()
    families.add(by_fingerprint(each.where("signature IS NOT NULL").select("node", "fp")))
    # signatures go only to keys that several nodes have
    exploded = each.select(F.posexplode("keys").alias("place", "grp"), "node")
    several = exploded.groupBy("grp").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low <> high")
    shared = exploded.join(several, "grp", "left_semi")
    keyed = written(shared.join(each.select("node", F.col("signature").alias("body")), "node"), "nearkeys")
    for some in (F.col("place") < FIRST_SEGMENTS * SYMBOLS, F.col("place") >= FIRST_SEGMENTS * SYMBOLS):
        join_groups(keyed.where(some).select("grp", "node", "body"), lambda many: agreement(many, least), families, nodes, size)
    if families.roots is not None:
        members = families.roots.unionByName(families.roots.select(F.col("root").alias("node"), "root").distinct()).distinct()
        wanted = each.select("node", "doc_id", "mark").join(members, "node")
        texts = rows.select("doc_id", F.xxhash64("text").alias("mark"), "text").join(wanted, ["doc_id", "mark"]).dropDuplicates(["node"])

        def sets(cols):
            return {"grp": cols["root"], "node": cols["node"], "body": [shingles(t).tobytes() for t in text_bytes(cols["text"])]}

        bodies = written(map_arrow(texts.select("root", "node", "text"), sets, "grp bigint, node bigint, body binary"), "nearsets")
        join_groups(bodies, lambda many: resemblance(many, least), links, nodes, size)
    placed = links.placed(each.select("node", "doc_id"))
    lowest = placed.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return marks.select("doc_id", "node").join(placed.join(lowest, "root").select("node", "component_id"), "node").select("doc_id", "component_id")


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that stand for their group: the smallest id of each component.

    Rows without an id stay.  Repeated rows of one id and text leave a single row.  Null and
    wordless texts form one group.  Columns of any name travel along; an empty table gives no rows.
    """
    stay = near_copies(spread(docs), **options).where("component_id = doc_id").select("doc_id").distinct()
    # the rows travel as one struct, so that no column of theirs can clash
    rows = docs.select("doc_id", F.xxhash64("text").alias("mark"), F.struct(*docs.columns).alias("row"))
    first = Window.partitionBy("doc_id", "mark").orderBy(F.lit(0))
    kept = rows.join(stay, "doc_id", "left_semi").withColumn("nth", F.row_number().over(first)).where("nth = 1").select("row.*")
    return kept.unionByName(docs.where("doc_id IS NULL")).select(docs.columns)
