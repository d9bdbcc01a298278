"""Byte-string dedup by external induced sorting.

Shards of segments are suffix-sorted with common-prefix values by recursive induction:
suffix tuples travel through priority queues that spill sorted runs to disk.  The
level below the recursion works on content-defined phrases: a phrase runs from one
trigger position to the next and includes the next trigger's bytes, so no phrase is a
prefix of another and the order of phrase names is the order of the bytes.  Suffixes
that start between triggers are induced from the ranks of the triggers after them.
"""

from __future__ import annotations

import hashlib
import heapq
import tempfile
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_arrow, read_table
from .repeats import Octets, Segment, covered, few_files, flagged_windows, gram_hashes, identified, runs, with_spans

WINDOW_BYTES = 400
TRIGGER_BYTES = 16
TRIGGER_MASK = 31
#: Tuples a queue keeps in memory before it writes a sorted run to disk.
QUEUE_TUPLES = 400_000

_WIDTH = 4
_BLOCK = 8192


class SpillQueue:
    """Priority queue of integer 4-tuples; beyond ``limit`` it writes sorted runs to disk."""

    def __init__(self, seeds: Iterator[tuple] = (), limit: int = QUEUE_TUPLES):
        self.heap: list[tuple] = []
        self.limit = limit
        self.heads: list[tuple] = []  # (next tuple, run number, iterator)
        self.number = 0
        self._add(iter(seeds))

    def _add(self, run: Iterator[tuple]) -> None:
        first = next(run, None)
        if first is not None:
            heapq.heappush(self.heads, (first, self.number, run))
        self.number += 1

    def push(self, item: tuple) -> None:
        heapq.heappush(self.heap, item)
        if len(self.heap) > self.limit:
            self.heap.sort()
            self._add(_on_disk(self.heap))
            self.heap = []

    def pop(self) -> tuple | None:
        if self.heap and (not self.heads or self.heap[0] < self.heads[0][0]):
            return heapq.heappop(self.heap)
        if not self.heads:
            return None
        item, number, run = self.heads[0]
        following = next(run, None)
        if following is None:
            heapq.heappop(self.heads)
        else:
            heapq.heapreplace(self.heads, (following, number, run))
        return item


def _on_disk(items: list[tuple]) -> Iterator[tuple]:
    file = tempfile.TemporaryFile()  # noqa: SIM115  unnamed: gone with the last reference
    np.array(items, dtype=np.int64).tofile(file)
    file.seek(0)

    def read():
        while len(block := np.fromfile(file, dtype=np.int64, count=_WIDTH * _BLOCK)):
            yield from map(tuple, block.reshape(-1, _WIDTH).tolist())
        file.close()

    return read()


class _RangeMin:
    """Minimum of the values after an index, while values are appended."""

    def __init__(self):
        self.at: list[int] = []
        self.value: list[int] = []

    def append(self, index: int, value: int) -> None:
        while self.value and self.value[-1] >= value:
            self.value.pop()
            self.at.pop()
        self.value.append(value)
        self.at.append(index)

    def after(self, index: int) -> int:
        return self.value[bisect_right(self.at, index)]


def induced_sort(text: list[int], limit: int = QUEUE_TUPLES) -> tuple[list[int], list[int]]:
    """Suffix order and common-prefix values of ``text`` (numbers from 1).

    ``lcp[i]`` belongs to the suffixes of rank i-1 and i; a virtual 0 ends the text.
    """
    t = [*text, 0]
    n = len(t)
    if n == 1:
        return [], []
    s_type = bytearray(n)
    s_type[n - 1] = 1
    span = [1] * n  # length of the run of equal numbers from here
    for i in range(n - 2, -1, -1):
        s_type[i] = t[i] < t[i + 1] or (t[i] == t[i + 1] and s_type[i + 1])
        if t[i] == t[i + 1]:
            span[i] = span[i + 1] + 1
    stars = [i for i in range(1, n) if s_type[i] and not s_type[i - 1]]
    order, common = _sort_stars(t, stars, limit)

    # descents, in ascending order: seeds are the sorted star suffixes
    seeds = ((t[p], 1, k, p) for k, p in enumerate(order))
    queue, low, last, count = SpillQueue(seeds, limit), _RangeMin(), {}, 0
    made_lcp: dict[int, int] = {}
    descents: list[int] = []
    descent_lcp: list[int] = []
    before, before_kind, index = -1, 0, 0
    while (item := queue.pop()) is not None:
        c, kind, k, p = item
        if before < 0 or t[before] != c:
            shared = 0
        elif kind == 1:
            shared = common[k] if before_kind == 1 else min(span[before], span[p])
        else:
            shared = made_lcp.pop(p)
        low.append(index, shared)
        if kind == 0:
            descents.append(p)
            descent_lcp.append(shared)
        q = p - 1
        if p and not s_type[q]:
            d = t[q]
            made_lcp[q] = 1 + low.after(last[d]) if d in last else 0
            last[d] = index
            queue.push((d, 0, count, q))
            count += 1
        before, before_kind, index = p, kind, index + 1

    # ascents, in descending order: seeds are the sorted descents
    seeds = ((-t[p], 1, k, p) for k, p in enumerate(reversed(descents)))
    queue, low, last, count = SpillQueue(seeds, limit), _RangeMin(), {}, 0
    made_lcp = {}
    out: list[int] = []
    lcp: list[int] = []
    before, before_kind, index = n - 1, 0, 0
    while (item := queue.pop()) is not None:
        c, kind, k, p = item
        if not out or -t[before] != c:
            shared = 0
        elif kind == 0:
            shared = made_lcp.pop(p)
        else:
            shared = min(span[before], span[p]) if before_kind == 0 else descent_lcp[len(descents) - k]
        low.append(index, shared)
        if out:
            lcp.append(shared)
        out.append(p)
        q = p - 1
        if p and s_type[q]:
            d = t[q]
            made_lcp[q] = 1 + low.after(last[d]) if d in last else 0
            last[d] = index
            queue.push((-d, 0, count, q))
            count += 1
        before, before_kind, index = p, kind, index + 1
    out.reverse()
    lcp.append(0)
    lcp.reverse()
    return out, lcp


def _sort_stars(t: list[int], stars: list[int], limit: int) -> tuple[list[int], list[int]]:
    """Star suffixes in order, each with what it shares with the one before.

    Star substrings get their rank as a name; while names repeat, the string of names is
    sorted by the same procedure.  A substring that ends where another goes on sorts
    after it, for its last number is an ascent there and a descent in the other.
    """
    top = (float("inf"),)
    keys = [(*t[a : b + 1], *top) for a, b in zip(stars, stars[1:], strict=False)]
    names = {k: i for i, k in enumerate(sorted(set(keys)), 1)}
    reduced = [names[k] for k in keys]
    if len(names) == len(reduced):
        places = [0] * len(reduced)
        for i, x in enumerate(reduced):
            places[x - 1] = i
        shared = [0] * len(reduced)
    else:
        places, shared = induced_sort(reduced, limit)
    order, common = [stars[-1]] + [stars[i] for i in places], [0]
    for k, (x, m) in enumerate(zip(places, shared, strict=True)):
        if k == 0:
            common.append(0)
            continue
        a, b = stars[places[k - 1] + m], stars[x + m]
        e = 0
        while t[a + e] == t[b + e]:
            e += 1
        common.append(b - stars[x] + e)
    return order, common


def _phrases(segments: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All segments in one buffer: bytes, segment starts, triggers, and each trigger's segment."""
    base = np.cumsum([0] + [len(s) for s in segments])
    data = np.frombuffer(b"".join(segments), np.uint8)
    if len(data) < TRIGGER_BYTES:
        return data, base, np.zeros(0, np.int64), np.zeros(0, np.int64)
    hit = np.flatnonzero((gram_hashes(data.astype(np.uint64) + np.uint64(1), TRIGGER_BYTES) & np.uint64(TRIGGER_MASK)) == 0)
    owner = np.searchsorted(base, hit, side="right") - 1
    inside = hit + TRIGGER_BYTES <= base[owner + 1]
    return data, base, hit[inside], owner[inside]


def ranked_triggers(data: np.ndarray, base: np.ndarray, at: np.ndarray, owner: np.ndarray, depth: int, limit: int = QUEUE_TUPLES) -> tuple[np.ndarray, np.ndarray]:
    """Triggers in the byte order of what follows them, with shared bytes up to ``depth``.

    The names of a segment's phrases, closed by a number of its own, are one string of
    the induced sort; the first differing phrase is then compared byte by byte.
    """
    raw = data.tobytes()
    ends = base[owner + 1]
    last = np.append(owner[1:] != owner[:-1], True)
    stop = np.where(last, ends, np.append(at[1:] + TRIGGER_BYTES, 0))
    phrases = [raw[a:b] for a, b in zip(at.tolist(), stop.tolist(), strict=True)]
    closers = int(last.sum())
    names = {p: i for i, p in enumerate(sorted(set(phrases)), closers + 1)}
    text: list[int] = []
    place: list[int] = []  # position in the string of each trigger
    closer = 0
    for p, z in zip(phrases, last.tolist(), strict=True):
        place.append(len(text))
        text.append(names[p])
        if z:
            closer += 1
            text.append(closer)
    order, common = induced_sort(text, limit)
    trigger = np.full(len(text), -1, np.int64)
    trigger[place] = np.arange(len(at))
    order_t = trigger[np.array(order, np.int64)]
    real = np.flatnonzero(order_t >= 0)  # closers come first and part nothing
    ranked, shared = order_t[real], np.array(common, np.int64)[real]
    lcp = np.zeros(len(ranked), np.int64)
    if len(ranked) > 1:
        a, b, m = ranked[:-1], ranked[1:], shared[1:]
        # equal names cover the bytes up to the trigger after them
        after = np.minimum(b + m, len(at) - 1)
        done = np.where(m == 0, 0, np.where((b + m < len(at)) & (owner[after] == owner[b]), at[after], ends[b]) - at[b])
        room = np.minimum(np.minimum(ends[a] - at[a], ends[b] - at[b]), depth)
        done = np.minimum(done, room)
        going = np.flatnonzero(done < room)
        while len(going):
            same = data[at[a[going]] + done[going]] == data[at[b[going]] + done[going]]
            going = going[same]
            done[going] += 1
            going = going[done[going] < room[going]]
        lcp[1:] = done
    return ranked, lcp


def resolve_bytes(segments: list[Segment], window: int, smaller_only: bool) -> Iterator[tuple[int, np.ndarray]]:
    """Windows of distinct segments whose bytes also start elsewhere.

    A window is named by its first trigger: how far before it the window starts, those
    bytes, and the class of triggers that share the remaining bytes.  Equal names are
    equal windows.  Windows without a trigger are few and are grouped by their digest.
    """
    groups: dict[int, list[int]] = {}
    for i, seg in enumerate(segments):
        groups.setdefault(seg.group, []).append(i)
    use = [i for g in groups.values() for i in g if len(g) > 1 or segments[i].count == 1]
    if not use:
        return
    data, base, at, owner = _phrases([segments[i].text for i in use])
    places = np.array([segments[i].count for i in use], np.int64)
    windows = np.array([segments[i].windows for i in use], np.int64)
    first = base[:-1]
    flags = np.zeros(len(data) + 1, bool)
    named = np.zeros(len(data) + 1, bool)
    if len(at):
        ranked, lcp = ranked_triggers(data, base, at, owner, window)
        rank = np.empty(len(at), np.int64)
        rank[ranked] = np.arange(len(ranked))
        before = np.where(np.append(True, owner[1:] != owner[:-1]), first[owner] - 1, np.append(-1, at[:-1]))
        reach = np.minimum(at - before - 1, window - TRIGGER_BYTES)
        left = np.zeros(len(at), np.int64)
        live = np.arange(len(at))
        for back in range(int(reach.max()) + 1):
            live = live[reach[live] >= back]
            if not len(live):
                break
            if back:
                left[live] = np.unique(left[live] * 256 + data[at[live] - back], return_inverse=True)[1]
            inside = live[at[live] - back < first[owner[live]] + windows[owner[live]]]
            if not len(inside):
                continue
            kind = np.cumsum(lcp < window - back)[rank[inside]]
            _, name = np.unique(kind * (int(left.max()) + 1) + left[inside], return_inverse=True)
            total = np.bincount(name, weights=places[owner[inside]])
            start = at[inside] - back
            named[start] = True
            flags[start[total[name] > 1]] = True
    rest: dict[bytes, list[int]] = {}
    raw = data.tobytes()
    weight: dict[bytes, int] = {}
    for j in range(len(use)):
        for s in (first[j] + np.flatnonzero(~named[first[j] : first[j] + windows[j]])).tolist():
            key = xxhash.xxh3_128_digest(raw[s : s + window])
            rest.setdefault(key, []).append(s)
            weight[key] = weight.get(key, 0) + int(places[j])
    for key, starts in rest.items():
        if weight[key] > 1:
            flags[starts] = True
    for j, i in enumerate(use):
        own = flags[first[j] : first[j] + windows[j]]
        if own.any():
            yield i, own


def byte_dedup(docs: DataFrame, window: int = WINDOW_BYTES, **limits) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept)``, a row for each input row.

    A byte of the UTF-8 text goes when a string of ``window`` bytes that covers it also
    starts anywhere else, in the same document too.  Null texts are empty; texts shorter
    than a window stay whole; texts of any length are read whole; rows that share an id,
    a null one too, are rows like any other, so of equal rows all go; further columns are
    ignored, whatever their names; an empty table gives no rows.
    """

    def run(cols):
        out: dict[str, list] = {k: [] for k in ("n_bytes", "n_removed", "n_spans", "kept_sha256", "kept")}
        for mark, text, spans in zip(*(cols[c].to_pylist() for c in ("mark", "text", "spans")), strict=True):
            data = (text or "").encode()
            gone = covered(spans, mark, window, len(data))
            kept = np.frombuffer(data, np.uint8)[~gone].tobytes() if spans else data
            start, _ = runs(gone)
            out["n_bytes"].append(len(data))
            out["n_removed"].append(int(gone.sum()))
            out["n_spans"].append(int(gone[start].sum()))
            out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
            out["kept"].append(kept)
        return out | {"doc_id": cols["doc_id"]}

    rows = identified(docs.select("doc_id", "text"))
    flags = flagged_windows(rows, Octets(window), resolve_bytes, smaller_only=False, **limits)
    return few_files(map_arrow(with_spans(rows, flags), run, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary"))


def op5_byte_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_dedup(read_table(spark, sf_dir, "documents")).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


#: The same rows in DuckDB, window by window over the bytes; removed runs are islands of window starts.
OP5_SQL = """
WITH d AS (
  SELECT doc_id, encode(coalesce(text, '')) AS h, octet_length(encode(coalesce(text, ''))) AS size FROM documents
), w AS (
  SELECT doc_id, pos, md5(array_slice(h, pos + 1, pos + 400)) AS k FROM (SELECT *, unnest(range(0, size - 399)) AS pos FROM d)
), hit AS (
  SELECT doc_id, pos FROM w SEMI JOIN (SELECT k FROM w GROUP BY k HAVING count(*) > 1) USING (k)
), run AS (
  SELECT *, sum(CASE WHEN pos <= before + 400 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY pos) AS island
  FROM (SELECT *, lag(pos) OVER (PARTITION BY doc_id ORDER BY pos) AS before FROM hit)
), span AS (
  SELECT doc_id, min(pos) AS a, max(pos) + 400 AS b FROM run GROUP BY doc_id, island
), piece AS (
  SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS z FROM span
), cut AS (
  SELECT doc_id, count(*) AS n, sum(b - a) AS gone, max(b) AS last, string_agg(hex(array_slice(h, z + 1, a)), '' ORDER BY a) AS head
  FROM piece JOIN d USING (doc_id) GROUP BY doc_id
)
SELECT doc_id, CAST(size AS BIGINT) AS n_bytes, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed, CAST(coalesce(n, 0) AS BIGINT) AS n_spans,
  sha256(unhex(coalesce(head, '') || hex(array_slice(h, coalesce(last, 0) + 1, size)))) AS kept_sha256
FROM d LEFT JOIN cut USING (doc_id)
"""
