"""SimHash near-duplicates through deletion-variant signatures.

A 64-bit fingerprint is cut into two 32-bit segments.  When two fingerprints differ
in at most three bits, one segment differs in at most one, so both share a variant
of that segment with a single bit wildcarded.  Each distinct fingerprint indexes its
64 one-wildcard variants, an equality exchange brings equal variants together, and
every link is verified on all 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_arrow, read_table, signed, spread, text_bytes, written
from .components import connected_components

SHINGLE_WORDS = 3
MAX_BITS = 3
SEED = 42
#: Fingerprints under one variant that are compared directly; larger groups are cut again.
GROUP_CAP = 4096

_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
_LANES = np.arange(8, dtype=np.int64) * 256


def shingle_hashes(text: bytes, shingle: int = SHINGLE_WORDS) -> np.ndarray:
    """The hash of every shingle, repeats included; a shorter text is one shingle, a wordless one has none."""
    words = text.lower().split()  # bytes: A-Z only, and the six ASCII white-space bytes
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return np.array([digest(b" ".join(words), SEED)] if words else [], dtype="<u8")
    return np.array([digest(b" ".join(s), SEED) for s in zip(*(words[i:] for i in range(shingle)), strict=False)], dtype="<u8")


def voted(hashes: np.ndarray) -> int:
    """Majority vote over the bits of all hashes; none give zero."""
    if not len(hashes):
        return 0
    lanes = hashes.view(np.uint8).reshape(-1, 8)
    counts = np.bincount((lanes + _LANES).ravel(), minlength=2048).reshape(8, 256) @ _BITS
    return int.from_bytes(np.packbits((counts * 2 > len(hashes)).ravel(), bitorder="little").tobytes(), "little")


def fingerprint(text: bytes, shingle: int = SHINGLE_WORDS) -> int:
    return voted(shingle_hashes(text, shingle))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE_WORDS) -> DataFrame:
    """``(doc_id, fp long)``, a row for each input row; null text counts as empty."""

    def run(cols):
        marks = np.array([fingerprint(t, shingle) for t in text_bytes(cols["text"])], dtype=np.uint64)
        return {"doc_id": cols["doc_id"], "fp": signed(marks)}

    return map_arrow(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), run, "doc_id bigint, fp bigint")


def _spanning(fps: np.ndarray, bits: int) -> list[tuple[int, int]]:
    """Links of a spanning forest of the graph "at most ``bits`` apart" over distinct values.

    A vertex once reached leaves the open set, so a dense group costs about one
    comparison a member and gives one link a member, never all pairs.
    """
    open_set, links = fps.copy(), []
    while len(open_set):
        frontier, open_set = [open_set[0]], open_set[1:]
        while frontier and len(open_set):
            at = frontier.pop()
            near = np.bitwise_count(open_set ^ at) <= bits
            if near.any():
                found = open_set[near]
                links += [(int(at), int(x)) for x in found]
                frontier += list(found)
                open_set = open_set[~near]
    return links


def _linker(n_keys: int, bits: int, cap: int | None):
    """Arrow function over rows ``(keys.., fp)`` sorted by keys and fp.

    Of a group that goes on beyond a batch at most ``cap`` rows are held; a larger one
    leaves row by row as it streams through.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, hot = None, None
        for batch in batches:
            rows = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            if hot is not None and rows.shape[1]:
                other = np.flatnonzero(rows[0] != hot)
                cut = int(other[0]) if len(other) else rows.shape[1]
                yield _hot(rows[:, :cut])
                if cut == rows.shape[1]:
                    continue
                rows, hot = rows[:, cut:], None
            if held is not None:
                rows = np.concatenate([held, rows], axis=1)
            if not rows.shape[1]:
                continue
            cut = _last_run(rows, n_keys)
            if cut:
                yield from _emit(rows[:, :cut])
            held = rows[:, cut:]
            if cap is not None and held.shape[1] > cap:
                hot = held[0, 0]
                yield _hot(held)
                held = None
        if held is not None:
            yield from _emit(held)

    def _hot(rows: np.ndarray) -> pa.RecordBatch:
        none = pa.nulls(rows.shape[1], pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(rows[0]), pa.array(rows[n_keys]), none], names=["key", "a", "b"])

    def _last_run(rows: np.ndarray, n: int) -> int:
        same = np.ones(rows.shape[1], dtype=bool)
        for k in range(n):
            same &= rows[k] == rows[k, -1]
        other = np.flatnonzero(~same)
        return int(other[-1]) + 1 if len(other) else 0

    def _emit(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        new = np.zeros(rows.shape[1], dtype=bool)
        new[0] = True
        for k in range(n_keys):
            new[1:] |= rows[k, 1:] != rows[k, :-1]
        start = np.flatnonzero(new)
        end = np.append(start[1:], rows.shape[1])
        fps = rows[n_keys].view(np.uint64)
        pair = start[end - start == 2]
        near = pair[np.bitwise_count(fps[pair] ^ fps[pair + 1]) <= bits]
        a, b, key = [rows[n_keys, near]], [rows[n_keys, near + 1]], [np.zeros(len(near), np.int64)]
        hot_key, hot_fp = [], []
        big = end - start > 2
        for s, e in zip(start[big].tolist(), end[big].tolist(), strict=True):
            if cap is not None and e - s > cap:
                hot_key.append(rows[0, s:e])
                hot_fp.append(rows[n_keys, s:e])
            elif links := _spanning(fps[s:e], bits):
                both = np.array(links, dtype=np.uint64).view(np.int64)
                a.append(both[:, 0])
                b.append(both[:, 1])
                key.append(np.zeros(len(links), np.int64))
        links = np.concatenate(a)
        hot = np.concatenate(hot_fp) if hot_fp else np.zeros(0, np.int64)
        fields = [
            pa.array(np.concatenate([*key, *hot_key])),
            pa.array(np.concatenate([links, hot])),
            pa.array(np.concatenate([*b, np.zeros(len(hot), np.int64)]), mask=np.arange(len(links) + len(hot)) >= len(links)),
        ]
        yield pa.RecordBatch.from_arrays(fields, names=["key", "a", "b"])

    return run


def _variants(low: str, high: str, width: int) -> str:
    """One-wildcard variants of two segments of ``width`` bits as ``(slot << 32) | rest``."""
    one = "CAST(1 AS BIGINT)"
    seg = f"IF(v < {width}, {low}, {high})"
    return f"transform(sequence(0, {2 * width - 1}), v -> (CAST(v AS BIGINT) << 32) | ({seg} & ~({one} << (v % {width}))))"


def links(fps: DataFrame, bits: int = MAX_BITS, group_cap: int = GROUP_CAP) -> DataFrame:
    """Links ``(a, b)`` that connect distinct fingerprints at most ``bits`` (up to 3) apart.

    The links form a spanning forest of every shared-variant group, so the components
    equal those of all pairs.  A group above ``group_cap`` is not compared at once: its
    other half is cut into two 16-bit segments and indexed the same way, which leaves
    at most 2**18 distinct values under a key, a bound on memory with no case lost.
    """
    if not 0 <= bits <= 3:
        raise ValueError("two segments with one wildcard cover at most three bits")
    mask = "CAST(4294967295 AS BIGINT)"
    first = fps.select(F.explode(F.expr(_variants(f"(fp & {mask})", f"(shiftrightunsigned(fp, 32) & {mask})", 32))).alias("key"), "fp")
    n = _parts(fps.sparkSession)
    keyed = first.repartition(n, "key").sortWithinPartitions("key", "fp")
    found = written(keyed.mapInArrow(_linker(1, bits, group_cap), "key bigint, a bigint, b bigint"), "simlinks")
    hot = found.where("b IS NULL").select("key", F.col("a").alias("fp"))
    out = found.where("b IS NOT NULL").select("a", "b")
    if not hot.isEmpty():
        other = f"IF(shiftright(key, 32) < 32, shiftrightunsigned(fp, 32), fp) & {mask}"
        half = hot.select("key", "fp", F.expr(other).alias("o"))
        second = half.select("key", F.explode(F.expr(_variants("(o & 65535)", "shiftright(o, 16)", 16))).alias("key2"), "fp")
        keyed = second.repartition(n, "key", "key2").sortWithinPartitions("key", "key2", "fp")
        more = written(keyed.mapInArrow(_linker(2, bits, None), "key bigint, a bigint, b bigint"), "simlinks2")
        out = out.unionByName(more.select("a", "b"))
    return out


def _parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE_WORDS, bits: int = MAX_BITS, group_cap: int = GROUP_CAP) -> DataFrame:
    """``(doc_id, fp, component_id)``, a row for each input row.

    component_id is the smallest non-null id reachable over links of at most ``bits``
    differing bits.  Null and wordless texts have fingerprint zero and link like any
    other; equal fingerprints are one node, however many rows have them; rows with a
    null id take their component's id; an empty table gives no rows; further columns
    are ignored.
    """
    marks = written(fingerprints(docs, id_col, text_col, shingle), "simfps")
    nodes = written(marks.groupBy("fp").agg(F.min("doc_id").alias("least")), "simnodes")
    roots = connected_components(links(nodes.select("fp"), bits, group_cap))
    placed = nodes.join(roots, nodes.fp == roots.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    least = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    component = placed.join(least, "root").select("fp", "component_id")
    return marks.join(component, "fp").select("doc_id", "fp", "component_id")


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_duplicates(spread(read_table(spark, sf_dir, "documents")))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
