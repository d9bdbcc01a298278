"""Substring dedup over words by prefix-partitioned suffix trees."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_arrow, read_table
from .repeats import Segment, Words, covered, flagged_windows, identified, runs, with_spans

WINDOW_WORDS = 13
#: Whether a byte is inside a word: all but the six ASCII white-space bytes.
_INSIDE = np.array([b not in b"\x20\x09\x0a\x0b\x0c\x0d" for b in range(256)], np.int8)


def suffix_tree(strings: list[np.ndarray], least_depth: int) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int, int]]]:
    """Suffixes in order with the tree's deep internal nodes.

    Returns (string index, start) of every suffix of at least ``least_depth`` symbols,
    ordered by its symbols, and the internal nodes of depth ``least_depth`` or more as
    (depth, first leaf, last leaf + 1).  Sorting works one prefix symbol at a time over
    those suffixes that still share their prefix, so single leaves drop out early.
    """
    owner = np.concatenate([np.full(max(0, len(s) - least_depth + 1), i, np.int64) for i, s in enumerate(strings)] or [np.zeros(0, np.int64)])
    start = np.concatenate([np.arange(max(0, len(s) - least_depth + 1)) for s in strings] or [np.zeros(0, np.int64)])
    base = np.cumsum([0] + [len(s) + 1 for s in strings])
    flat = np.full(base[-1] + 1, -1, np.int64)
    for i, s in enumerate(strings):
        flat[base[i] : base[i] + len(s)] = s
    at = base[owner] + start
    order = np.arange(len(at))
    group = np.zeros(len(at), np.int64)  # first leaf of the node that a leaf is in so far
    open_leaves = np.arange(len(at))
    nodes: list[tuple[int, int, int]] = []
    depth = 0
    while len(open_leaves):
        # a leaf that has ended (symbol -1) is alone from here on
        symbol = flat[at[order[open_leaves]] + depth]
        ended = symbol < 0
        symbol = np.where(ended, -1 - np.arange(len(symbol)), symbol)
        rank = np.lexsort((symbol, group[open_leaves]))
        order[open_leaves] = order[open_leaves][rank]
        g, symbol = group[open_leaves], symbol[rank]  # the groups are in order already
        new = np.concatenate(([True], (g[1:] != g[:-1]) | (symbol[1:] != symbol[:-1])))
        head = np.flatnonzero(new)
        size = np.diff(np.append(head, len(g)))
        if depth >= least_depth:  # a node branches here if its group falls apart
            gh, gn = runs(g)
            for a, b in zip(gh.tolist(), gn.tolist(), strict=True):
                if new[a + 1 : b].any():
                    nodes.append((depth, int(open_leaves[a]), int(open_leaves[a]) + b - a))
        group[open_leaves] = np.repeat(open_leaves[head], size)
        open_leaves = open_leaves[np.repeat(size > 1, size)]
        depth += 1
    return owner[order], start[order], nodes


def resolve_words(segments: list[Segment], window: int, smaller_only: bool) -> Iterator[tuple[int, np.ndarray]]:
    """Windows of distinct segments that a segment with a smaller document also holds.

    A trie over the groups' minimisers comes first: the group is the first symbol of
    every path, so one tree serves a whole chunk and groups never mix.  A deep internal
    node names the windows below it as one repeated string; its least document decides.
    """
    groups: dict[int, list[int]] = {}
    for i, seg in enumerate(segments):
        groups.setdefault(seg.group, []).append(i)
    multiple = [i for g in groups.values() if len(g) > 1 for i in g]
    singles = [g[0] for g in groups.values() if len(g) == 1]
    # a lone segment can still hold one window twice, in one document: never smaller
    for i in singles if not smaller_only else []:
        multiple.append(i)
    if not multiple:
        return
    names: dict[bytes, int] = {}
    words = [[names.setdefault(w, len(names)) for w in segments[i].text.split()] for i in multiple]
    strings = [np.array(w, np.int64) for w in words]
    owner, start, nodes = suffix_tree(strings, window)
    flags = [np.zeros(segments[i].windows, bool) for i in multiple]
    least = np.array([segments[i].least for i in multiple], np.int64)
    seen = np.array([segments[i].count for i in multiple], np.int64)
    group = np.array([segments[i].group for i in multiple], np.int64)
    # the shallowest deep nodes hold all others
    for _, a, b in _outermost(nodes):
        o, s = owner[a:b], start[a:b]
        for g in np.unique(group[o]):
            own = group[o] == g
            if smaller_only:
                low = least[o[own]].min()
                hit = own & (least[o] > low)
            else:
                hit = own if seen[o[own]].sum() > 1 else own & False
            for x, y in zip(o[hit].tolist(), s[hit].tolist(), strict=True):
                flags[x][y] = True
    for i, f in zip(multiple, flags, strict=True):
        if f.any():
            yield i, f


def _outermost(nodes: list[tuple[int, int, int]]) -> Iterator[tuple[int, int, int]]:
    end = -1
    for depth, a, b in sorted(nodes, key=lambda n: (n[1], -n[2])):
        if a >= end:
            yield depth, a, b
            end = b


def maximal_repeats(texts: list[bytes], least_words: int) -> list[tuple[bytes, int]]:
    """Repeated word strings of ``least_words`` or more that end where the tree branches.

    Returns each string with its number of places; a general view of one subtree.
    """
    names: dict[bytes, int] = {}
    split = [t.split() for t in texts]
    strings = [np.array([names.setdefault(w, len(names)) for w in s], np.int64) for s in split]
    owner, start, nodes = suffix_tree(strings, least_words)
    return [(b" ".join(split[owner[a]][start[a] : start[a] + depth]), b - a) for depth, a, b in nodes]


def word_flags(rows: DataFrame, window: int = WINDOW_WORDS, **limits) -> DataFrame:
    """``(rid, spans)`` of windows that also start in a document of smaller id."""
    return flagged_windows(rows, Words(window), resolve_words, smaller_only=True, **limits)


def substring_dedup(docs: DataFrame, window: int = WINDOW_WORDS, **limits) -> DataFrame:
    """``(doc_id, text, n_words, n_removed, kept_sha256, kept)``, a row for each input row.

    A word goes when a window of ``window`` words that covers it also starts in a
    document of smaller id.  ``kept`` is the text with those words and the white space
    after them cut out (unchanged where nothing goes).  Null and wordless texts have no
    window; a null id is neither smaller nor larger than another, so such rows stay
    whole; rows that share an id never remove one another's words; repeated rows get the
    same answer; texts of any length are read whole; further columns are ignored,
    whatever their names; an empty table gives no rows.
    """

    def run(cols):
        out: dict[str, list] = {k: [] for k in ("n_words", "n_removed", "kept_sha256", "kept")}
        for mark, text, spans in zip(*(cols[c].to_pylist() for c in ("mark", "text", "spans")), strict=True):
            data = (text or "").encode()
            words = data.split()
            gone = covered(spans, mark, window, len(words))
            n = int(gone.sum())
            out["n_words"].append(len(words))
            out["n_removed"].append(n)
            kept = compress(words, (~gone).tolist()) if n else words
            out["kept_sha256"].append(hashlib.sha256(b" ".join(kept)).hexdigest())
            out["kept"].append(_cut(data, gone).decode() if n else text)
        return out | {k: cols[k] for k in ("doc_id", "text")}

    rows = identified(docs.select("doc_id", "text"))
    flags = word_flags(rows, window, **limits)
    return map_arrow(with_spans(rows, flags), run, "doc_id bigint, text string, n_words bigint, n_removed bigint, kept_sha256 string, kept string")


def cut_repeats(docs: DataFrame, window: int = WINDOW_WORDS, **limits) -> DataFrame:
    """All rows and columns, repeated words cut out of ``text`` and ``n_chars`` counted anew.

    A text that keeps all its words stays as it is, to the byte.  Null texts, null and
    repeated ids and empty tables are as in :func:`substring_dedup`; columns of any name
    travel along unchanged.
    """
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    # the further columns travel as one struct, by their place, so that no name can clash
    carried = F.struct(F.lit(0).alias("c0"), *(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(rest, 1)))
    rows = identified(docs.select("doc_id", "text", carried.alias("rest")))
    kind = rows.schema["rest"].dataType.simpleString()

    def run(cols):
        out = []
        for mark, text, spans in zip(*(cols[c].to_pylist() for c in ("mark", "text", "spans")), strict=True):
            if not spans:
                out.append(text)
                continue
            data = (text or "").encode()
            gone = covered(spans, mark, window, len(data.split()))
            out.append(_cut(data, gone).decode() if gone.any() else text)
        return {"doc_id": cols["doc_id"], "text": out, "rest": cols["rest"]}

    flags = word_flags(rows, window, **limits)
    cut = map_arrow(with_spans(rows, flags), run, f"doc_id bigint, text string, rest {kind}")
    named = {"doc_id": F.col("doc_id"), "text": F.col("text")}
    named |= {c: F.col(f"rest.c{i}") for i, c in enumerate(rest, 1)}
    if "n_chars" in rest:
        named["n_chars"] = F.length("text").cast("bigint")
    return cut.select(*(named[c].alias(c) for c in docs.columns))


def _cut(data: bytes, gone: np.ndarray) -> bytes:
    out, last = [], 0
    # where words begin, and the end of the text
    at = np.append(np.flatnonzero(np.diff(_INSIDE[np.frombuffer(data, np.uint8)], prepend=0) > 0), len(data)).tolist()
    start, end = runs(gone)
    for a, b in zip(start.tolist(), end.tolist(), strict=True):
        if gone[a]:
            out.append(data[last : at[a]])
            last = at[b]
    out.append(data[last:])
    return b"".join(out)


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(read_table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


#: The same rows in DuckDB, window by window.
OP8_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS words FROM documents
), w AS (
  SELECT doc_id, pos, array_to_string(words[pos:pos + 12], ' ') AS k FROM (SELECT *, unnest(range(1, len(words) - 11)) AS pos FROM d)
), f AS (
  SELECT k, min(doc_id) AS least FROM w GROUP BY k
), g AS (
  SELECT DISTINCT doc_id, pos + j AS pos FROM w JOIN f USING (k), range(0, 13) t(j) WHERE least < doc_id
), p AS (
  SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS pos FROM d
), kept AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY pos) AS text FROM p ANTI JOIN g USING (doc_id, pos) GROUP BY doc_id
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""
