"""Repeated windows across a corpus, grouped by prefixes of variable length.

Every window of ``window`` consecutive symbols has a minimiser: the least hash of the
``gram``-symbol pieces inside it.  Equal windows have equal minimisers, so the
minimiser names the group in which a window can meet its equals.  Each level works over
two exchanges:

1. per Arrow batch, one row for each minimiser, with the weight of its windows; rows of
   a batch in which it stands twice need no answer and are dealt by document instead, so
   that a minimiser of very many documents sends one place a batch to its group;
2. minimisers with more than one place go back to their documents, which emit the runs of
   windows that these name as segments.  Equal segments of a batch collapse to one place
   as well: the others are known to repeat and leave as spans;
3. a group's distinct segments go to a resolver (suffix tree or induced sorting).

A group heavier than ``group`` symbols does not fit that step.  Its segments go to the
next level, where they are cut anew by a piece twice as long (in the end the whole
window), as often as needed; only they move again.  Every group that is resolved fits in
memory, whatever the size of the corpus, and at the last level a group is one window.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_schema, map_arrow, runs, signed, written

_MULT = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)
#: Bytes of segments that a resolver gets at once; it takes whole groups.
CHUNK_BYTES = 1_000_000
#: Partitions whose rows are written to one file.
PARTS_A_FILE = 8
#: Bytes of texts whose symbols are hashed in a row; a longer text is one such piece.
FLAT_BYTES = 1 << 17

#: A place of a segment: row, mark of its text, first window, and how many windows from there.
_PLACE = "<qiii"
#: Windows of a text that repeat.
_SPAN = np.dtype([("mark", "<i4"), ("start", "<i4"), ("n", "<i4")])


def sliding(values: np.ndarray, width: int, op) -> np.ndarray:
    """``op`` over every ``width`` neighbours, by doubling."""
    out, step = values, 1
    while step * 2 <= width:
        out = op(out[:-step], out[step:])
        step *= 2
    rest = width - step
    return op(out[: len(out) - rest], out[rest:]) if rest else out


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(29))) * _MIX
    return values ^ (values >> np.uint64(32))


def gram_hashes(symbols: np.ndarray, gram: int) -> np.ndarray:
    """A mixed hash of every ``gram`` neighbouring symbols."""
    out, step = symbols, 1
    with np.errstate(over="ignore"):
        power = np.array(_MULT)
        while step * 2 <= gram:
            out = out[:-step] * power + out[step:]
            power = power * power
            step *= 2
        if rest := gram - step:
            out = out[:-rest] * power + out[rest:]
        return _mixed(out)


#: Powers of an odd number and of its inverse, modulo 2**64.
_BASE = 0xD6E8FEB86659FD93
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> list[np.ndarray]:
    """The first ``n`` powers or more; tables for texts of ordinary length are kept."""
    if _POWERS and len(_POWERS[0]) >= n:
        return _POWERS
    with np.errstate(over="ignore"):
        size = max(n, FLAT_BYTES * 2)
        made = [np.cumprod(np.append(np.uint64(1), np.full(size - 1, b, np.uint64)), dtype=np.uint64) for b in (_BASE, pow(_BASE, -1, 1 << 64))]
    if size <= 1 << 20:
        _POWERS[:] = made
    return made


def word_hashes(data: bytes, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of each stretch of ``data``; equal ones where two differ cost time only, groups are told apart by their bytes."""
    up, down = _powers(len(data))
    with np.errstate(over="ignore"):
        sums = np.cumsum((np.frombuffer(data, np.uint8) + np.uint64(1)) * up[: len(data)], dtype=np.uint64)
        sums = np.append(np.uint64(0), sums)
        return _mixed((sums[end] - sums[start]) * down[start])


@dataclass
class Flat:
    """The symbols of several texts in a row."""

    symbols: np.ndarray
    first: np.ndarray  # where each text's symbols begin, and the end of the last
    data: bytes
    start: np.ndarray  # where each symbol's bytes begin and end
    end: np.ndarray


class Unit:
    """How a text falls into symbols, and the lengths of the pieces that name its windows."""

    def __init__(self, window: int, gram: int, group: int):
        self.window, self.group = window, group
        self.grams = []
        while gram < window:
            self.grams.append(gram)
            gram *= 2
        self.grams.append(window)


class Words(Unit):
    """Words between the six ASCII white-space bytes."""

    def __init__(self, window: int = 13, gram: int = 4, group: int = 1_000_000):
        super().__init__(window, gram, group)

    def split(self, text: bytes) -> list[bytes]:
        return text.split()

    def symbols(self, parts: list[bytes]) -> np.ndarray:
        return self._flat(parts, [len(parts)]).symbols

    def flat(self, texts: list[bytes]) -> Flat:
        parts = [t.split() for t in texts]
        return self._flat([w for p in parts for w in p], [len(p) for p in parts])

    def _flat(self, words: list[bytes], counts: list[int]) -> Flat:
        data = b" ".join(words)
        end = np.append(np.flatnonzero(np.frombuffer(data, np.uint8) == 32), len(data)) if words else np.zeros(0, np.int64)
        start = np.append(0, end[:-1] + 1) if words else end
        return Flat(word_hashes(data, start, end), np.cumsum([0, *counts]), data, start, end)

    def segment(self, parts: list[bytes], start: int, end: int) -> bytes:
        return b" ".join(parts[start:end])


class Octets(Unit):
    """Single bytes."""

    def __init__(self, window: int = 400, gram: int = 64, group: int = 4_000_000):
        super().__init__(window, gram, group)

    def split(self, text: bytes) -> bytes:
        return text

    def symbols(self, parts: bytes) -> np.ndarray:
        return np.frombuffer(parts, np.uint8).astype(np.uint64) + np.uint64(1)

    def flat(self, texts: list[bytes]) -> Flat:
        data = b"".join(texts)
        at = np.arange(len(data) + 1)
        return Flat(self.symbols(data), np.cumsum([0, *map(len, texts)]), data, at[:-1], at[1:])

    def segment(self, parts: bytes, start: int, end: int) -> bytes:
        return parts[start:end]


def minimisers(unit: Unit, parts, level: int = 0) -> np.ndarray:
    """The minimiser of each window, by pieces of a level's length; none if the document is shorter than one."""
    if len(parts) < unit.window:
        return np.zeros(0, np.uint64)
    gram = unit.grams[level]
    return sliding(gram_hashes(unit.symbols(parts), gram), unit.window - gram + 1, np.minimum)


@dataclass
class Named:
    """Runs of windows of one minimiser inside one of several texts: minimiser, text, first window, end."""

    name: np.ndarray
    owner: np.ndarray
    start: np.ndarray
    end: np.ndarray
    pieces: tuple[np.ndarray, np.ndarray] | None


def named_runs(unit: Unit, flat: Flat, pieces: bool = False) -> Named | None:
    """The runs, with ``pieces`` also the text and hash of every piece that is the least of some window; None without a window."""
    window, gram = unit.window, unit.grams[0]
    n = len(flat.symbols) - window + 1
    if n < 1:
        return None
    grams, width = gram_hashes(flat.symbols, gram), window - gram + 1
    least = sliding(grams, width, np.minimum)
    owner = np.repeat(np.arange(len(flat.first) - 1), np.diff(flat.first))
    inside = owner[:n] == owner[window - 1 :]
    start = np.flatnonzero(np.append(True, (least[1:] != least[:-1]) | (inside[1:] != inside[:-1])))
    end = np.append(start[1:], n)
    own = inside[start]
    start, end = start[own], end[own]
    if not len(start):
        return None
    named = Named(least[start], owner[start], start, end, None)
    if not pieces:
        return named
    # a piece is the least of a window if the greatest of its windows' minimisers is itself
    pad = np.zeros(width - 1, np.uint64)
    most = sliding(np.concatenate([pad, np.where(inside, least, np.uint64(0)), pad]), width, np.maximum)
    hit = np.flatnonzero((most == grams) & (most > 0))
    named.pieces = owner[hit], grams[hit]
    return named


@dataclass
class Segment:
    """A distinct segment of a group."""

    group: int
    text: bytes
    windows: int
    count: int  # places, over all documents
    least: int  # smallest document id
    places: list  # (rid, mark, start, n) that its own flags concern


def identified(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text, further columns) with ``rid``, a hash of id and text that rows are dealt and met by,
    and ``mark``, a second hash of the text.

    Rows of equal id and text share both and get the same answer.  Rows of other texts
    under one id, null ids among them, are dealt apart.
    """
    return docs.withColumn("rid", F.xxhash64("doc_id", "text")).withColumn("mark", F.hash("text"))


def dealt_texts(docs: DataFrame) -> DataFrame:
    """The rows dealt by ``rid``; every use of one plan is the same exchange, done once."""
    return docs.repartition(_parts(docs), "rid")


def _parts(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def few_files(df: DataFrame) -> DataFrame:
    """A task and a file for several partitions, one after the other, where that leaves work for all cores; else ``df`` as it is."""
    files = -(-_parts(df) // PARTS_A_FILE)
    return df.coalesce(files) if files >= 2 * df.sparkSession.sparkContext.defaultParallelism else df


def _rows(cols, smaller_only: bool) -> Iterator[tuple]:
    """(rid, doc_id, mark, text, asked names) of each row that takes part."""
    asked = [None] * len(cols["rid"])
    if "hs" in cols:
        values, at = cols["hs"].values.to_numpy(), cols["hs"].offsets.to_numpy()
        asked = [values[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
    for r, d, k, t, hs in zip(cols["rid"].to_pylist(), cols["doc_id"].to_pylist(), cols["mark"].to_pylist(), cols["text"].cast(pa.binary()).to_pylist(), asked, strict=True):
        if t and not (smaller_only and d is None):
            yield r, d or 0, k, t, hs


def _flats(unit: Unit, rows: Iterator[tuple]) -> Iterator[tuple[list[tuple], Flat]]:
    """The rows in stretches of about ``FLAT_BYTES``, each with its symbols."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[3])
        if size >= FLAT_BYTES:
            yield held, unit.flat([r[3] for r in held])
            held, size = [], 0
    if held:
        yield held, unit.flat([r[3] for r in held])


_SEGMENTS = "h bigint, deal bigint, text binary, windows int, places bigint, least bigint, at binary"


def flagged_windows(docs: DataFrame, unit: Unit, resolve: Callable, smaller_only: bool, group: int | None = None, chunk: int = CHUNK_BYTES) -> DataFrame:
    """``(rid, spans array<binary>)`` of window starts whose content repeats.

    ``docs`` is a table of :func:`identified` rows.  With ``smaller_only`` a window counts
    only when it also starts in a document of smaller id, and rows without an id take no
    part; else when it starts anywhere else.  ``resolve(segments, window, smaller_only)``
    yields (segment index, boolean array) over distinct segments.  ``group`` is the
    weight in symbols up to which a group is resolved at once.
    """
    spark = docs.sparkSession
    group, last = unit.group if group is None else group, len(unit.grams) - 1
    schema = "h bigint, deal bigint, at binary, weight bigint"
    held = map_arrow(docs.select("rid", "doc_id", "mark", "text"), _gram_rows(unit, smaller_only), schema)
    held = held.repartition(_parts(docs), F.coalesce("deal", "h")).sortWithinPartitions("h")
    schema = "rid bigint, h bigint, heavy boolean"
    shared = held.mapInArrow(_sharing(group if last else None, arrow_schema(spark, schema)), schema)
    # a small part of what came in: a file for several partitions, yet work for all cores
    files = max(2 * spark.sparkContext.defaultParallelism, -(-_parts(docs) // PARTS_A_FILE))
    shared = written(shared.coalesce(files), "shared")
    given = dealt_texts(docs).join(shared.groupBy("rid").agg(F.collect_set("h").alias("hs")), "rid")
    rows = map_arrow(given, _segment_rows(unit, not last, smaller_only), _SEGMENTS)
    heavy, level, spans = shared.where("heavy").select("h").distinct(), 0, None

    def resolved(some: DataFrame) -> DataFrame:
        keyed = some.repartition(_parts(docs), F.coalesce("deal", "h")).sortWithinPartitions("h", "text")
        schema = "rid bigint, at binary"
        found = keyed.mapInArrow(_solver(unit, resolve if level < last else None, smaller_only, chunk, arrow_schema(spark, schema)), schema)
        return found if spans is None else spans.unionByName(found)

    while level < last and not heavy.isEmpty():
        rows = rows if level else written(rows, "segments")
        spans = resolved(rows.join(heavy, "h", "left_anti").select(rows.columns))
        level += 1
        heavy_rows = rows.join(heavy, "h", "left_semi").select(rows.columns)
        rows = written(map_arrow(heavy_rows, _split_rows(unit, level), _SEGMENTS), "segments")
        heavy = rows.groupBy("h").agg(F.sum(F.col("windows") + F.lit(unit.window - 1)).alias("n")).where(F.col("n") > group).select("h")
    return resolved(rows).groupBy("rid").agg(F.collect_set("at").alias("spans"))


def _gram_rows(unit: Unit, smaller_only: bool):
    """Rows (h, deal, at, weight): a minimiser of the batch, packed row ids, symbols of its distinct segments.

    One row for each minimiser goes to its group (deal null) with the first row's id, twice if
    it stands twice in the batch; then a second row has the ids of all others.
    """

    def run(cols):
        hs, ids, times = [], [], []
        run_h, run_text, run_size = [], [], []
        for rows, flat in _flats(unit, _rows(cols, smaller_only)):
            named = named_runs(unit, flat, pieces=True)
            if named is None:
                continue
            owner, h = named.pieces
            run_h.append(named.name)
            with np.errstate(over="ignore"):
                sums = np.append(np.uint64(0), np.cumsum(gram_hashes(flat.symbols, unit.window), dtype=np.uint64))
                run_text.append(sums[named.end] - sums[named.start])
            run_size.append(named.end - named.start + unit.window - 1)
            order = np.lexsort((owner, h))
            owner, h = owner[order], h[order]
            start = np.flatnonzero(np.append(True, (owner[1:] != owner[:-1]) | (h[1:] != h[:-1])))
            hs.append(h[start])
            ids.append(np.array([r[0] for r in rows], np.int64)[owner[start]])
            # a window can repeat inside one document
            times.append(np.ones(len(start), np.int64) if smaller_only else np.diff(np.append(start, len(h))))
        if not hs:
            return None
        h, rid, times = map(np.concatenate, (hs, ids, times))
        order = np.argsort(h, kind="stable")
        h, rid = h[order], rid[order]
        start, end = runs(h)
        twice = np.add.reduceat(times[order], start) > 1
        first = np.repeat(rid[start], np.where(twice, 2, 1))
        several = np.flatnonzero(end - start > 1)
        others = np.ones(len(h), bool)
        others[start] = False
        sizes = np.concatenate([np.where(twice, 2, 1), (end - start - 1)[several]])
        offsets = pa.array(np.append(0, np.cumsum(sizes)).astype(np.int32) * 8)
        data = pa.py_buffer(np.concatenate([first, rid[others]]).tobytes())
        none = len(start)
        deal = np.concatenate([np.zeros(none, np.int64), rid[start[several] + 1]])
        return {
            "h": pa.array(signed(np.concatenate([h[start], h[start[several]]]))),
            "deal": pa.array(deal, mask=np.arange(len(deal)) < none),
            "at": pa.Array.from_buffers(pa.binary(), len(sizes), [None, offsets.buffers()[1], data]),
            "weight": pa.array(np.concatenate([weights(*map(np.concatenate, (run_h, run_text, run_size))), np.zeros(len(several), np.int64)])),
        }

    def weights(h, text, size):
        """Symbols of the distinct segments of each minimiser, ascending."""
        order = np.lexsort((text, h))
        h, text, size = h[order], text[order], size[order]
        start, _ = runs(h)
        once = np.append(True, (h[1:] != h[:-1]) | (text[1:] != text[:-1]))
        return np.add.reduceat(np.where(once, size, 0), start)

    return run


def _sharing(group: int | None, schema: pa.Schema):
    """From rows of :func:`_gram_rows`, sorted by h: (rid, h, heavy) for each place of a name with two or more.

    An open run holds one id a batch of the scan.  Only rows that went to the group know its weight.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []  # rows (h, id, weight) of the last, open run
        for batch in batches:
            if not batch.num_rows:
                continue
            column = batch.column(2)
            ids = np.frombuffer(b"".join(column.to_pylist()), "<i8")
            sizes = np.diff(np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]) // 8
            h = np.repeat(batch.column(0).to_numpy(), sizes)
            to_group = np.repeat(batch.column(1).is_null().to_numpy(zero_copy_only=False), sizes)
            if not to_group.all():
                yield _pairs(ids[~to_group], h[~to_group], False)
                if not to_group.any():
                    continue
            # an id that stands for two places has its row's weight once
            weight = np.zeros(len(h), np.int64)
            weight[np.cumsum(sizes) - 1] = batch.column(3).to_numpy()
            rows = tuple(x[to_group] for x in (h, ids, weight))
            if held:
                rows = tuple(np.concatenate(x) for x in zip(*held, rows, strict=True))
            cut = int(runs(rows[0])[0][-1])
            if cut:
                yield settled(*(x[:cut] for x in rows))
            held = [tuple(x[cut:] for x in rows)]
        if held:
            yield settled(*held[0])

    def settled(h, ids, weight):
        start, end = runs(h)
        size = np.repeat(end - start, end - start)
        heavy = np.repeat(np.add.reduceat(weight, start) > group, end - start) if group is not None else np.zeros(len(h), bool)
        # one row of a document is enough
        once = np.append(True, (h[1:] != h[:-1]) | (ids[1:] != ids[:-1])) & (size > 1)
        return _pairs(ids[once], h[once], heavy[once])

    def _pairs(ids, h, heavy):
        return pa.RecordBatch.from_arrays([pa.array(ids), pa.array(h), pa.array(np.broadcast_to(heavy, len(h)))], schema=schema)

    return run


def _segment_rows(unit: Unit, last: bool, smaller_only: bool):
    """Rows (h, deal, text, windows, places, least, at): the distinct segments of the batch under asked names.

    ``at`` packs the places that still need the group's answer.  The others are known to
    repeat: they leave as packed spans of their row, in one row with the row's id as ``deal``.
    At the last level a run of windows of one name is one window, ``n`` times.
    """

    def run(cols):
        found: dict[tuple[int, bytes], list] = {}
        for rows, flat in _flats(unit, _rows(cols, smaller_only)):
            named = named_runs(unit, flat)
            if named is None:
                continue
            asked = np.concatenate([r[4] for r in rows]).view(np.uint64)
            with np.errstate(over="ignore"):
                # the text is part of the key, for each asks on its own
                asked = asked + np.repeat(np.arange(len(rows)), [len(r[4]) for r in rows]).astype(np.uint64) * _MULT
                pick = np.flatnonzero(np.isin(named.name + named.owner.astype(np.uint64) * _MULT, asked))
            start, end, owner = named.start[pick], named.end[pick], named.owner[pick]
            stop = start + unit.window if last else end + unit.window - 1
            columns = (owner, signed(named.name[pick]), start - flat.first[owner], end - start, flat.start[start], flat.end[stop - 1])
            for o, h, s, n, a, b in zip(*(c.tolist() for c in columns), strict=True):
                rid, d, k = rows[o][:3]
                found.setdefault((h, flat.data[a:b]), []).append((d, rid, k, s, n))
        if not found:
            return None
        known = _Spans()
        counts, leasts, ats = [], [], []
        for places in found.values():
            if len(places) == 1 and (smaller_only or not last):
                (d, *place), n = places[0], 1
                least, at = d, struct.pack(_PLACE, *place)
            else:
                n = sum(p[4] for p in places) if last else len(places)
                least, at = min(p[0] for p in places), b""
                for d, *place in places:
                    if d > least if smaller_only else n > 1:
                        known.add(*place)
                    else:
                        at += struct.pack(_PLACE, *place)
            counts.append(n)
            leasts.append(least)
            ats.append(at)
        spans = list(known.packed())
        none = [None] * len(spans)
        return {
            "h": [h for h, _ in found] + none,
            "deal": [None] * len(found) + [r for r, _ in spans],
            "text": [t for _, t in found] + none,
            "windows": ([1] * len(found) if last else [places[0][4] for places in found.values()]) + none,
            "places": counts + none,
            "least": leasts + none,
            "at": ats + [at for _, at in spans],
        }

    return run


def _split_rows(unit: Unit, level: int):
    """The segments of heavy groups cut by the minimisers of a level; groups of the new ones part the old."""
    last = level == len(unit.grams) - 1

    def run(cols):
        out: dict[str, list] = {c: [] for c in ("h", "text", "windows", "places", "least", "at")}
        for h, text, places, least, at in zip(*(cols[c].to_pylist() for c in ("h", "text", "places", "least", "at")), strict=True):
            parts = unit.split(text)
            own = list(struct.iter_unpack(_PLACE, at))
            with np.errstate(over="ignore"):
                names = signed(_mixed(np.array(h, np.int64).view(np.uint64) * _MULT + minimisers(unit, parts, level)))
            for s, e in zip(*(x.tolist() for x in runs(names)), strict=True):
                out["h"].append(int(names[s]))
                out["text"].append(unit.segment(parts, s, s + unit.window if last else e + unit.window - 1))
                out["windows"].append(1 if last else e - s)
                out["places"].append(places * (e - s) if last else places)
                out["least"].append(least)
                out["at"].append(b"".join(struct.pack(_PLACE, rid, mark, start + s, e - s) for rid, mark, start, _ in own))
        return out | {"deal": [None] * len(out["h"])}

    return run


class _Spans:
    """Spans gathered by row id."""

    def __init__(self):
        self.by_row: dict[int, list] = {}

    def add(self, rid: int, mark: int, start: int, n: int) -> None:
        self.by_row.setdefault(rid, []).append((mark, start, n))

    def packed(self) -> Iterator[tuple[int, bytes]]:
        for rid, spans in self.by_row.items():
            yield rid, np.array(spans, _SPAN).tobytes()


def _solver(unit: Unit, resolve: Callable | None, smaller_only: bool, chunk: int, schema: pa.Schema):
    """From rows of :func:`_segment_rows`, sorted by h and text: (rid, packed spans)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[Segment] = []  # whole groups gathered for one resolver call, the last one still open
        weight = 0
        spans = _Spans()

        def settle() -> Iterator[pa.RecordBatch]:
            for i, flags in resolve(held, unit.window, smaller_only) if resolve else ():
                starts, ends = runs(flags)
                for a, b in zip(starts.tolist(), ends.tolist(), strict=True):
                    if flags[a]:
                        for rid, mark, start, _ in held[i].places:
                            spans.add(rid, mark, start + a, b - a)
            rows = list(spans.packed())
            spans.by_row.clear()
            held.clear()
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array([r for r, _ in rows], pa.int64()), pa.array([a for _, a in rows], pa.binary())], schema=schema)

        for batch in batches:
            for h, deal, text, windows, places, least, at in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if deal is not None:
                    for mark, start, n in np.frombuffer(at, _SPAN).tolist():
                        spans.add(deal, mark, start, n)
                    weight += len(at)
                    continue
                own = list(struct.iter_unpack(_PLACE, at))
                now = held[-1] if held else None
                if now is None or (now.group, now.text) != (h, text):
                    if weight >= chunk and (now is None or now.group != h):
                        yield from settle()
                        weight = 0
                    held.append(Segment(h, text, windows, places, least, []))
                    weight += len(text)
                    if smaller_only or places == 1:
                        held[-1].places = own
                    else:
                        for p in own:
                            spans.add(*p)
                else:
                    _add(now, places, least, own, smaller_only, spans)
        yield from settle()

    return run


def _add(seg: Segment, places: int, least: int, own: list[tuple], smaller_only: bool, spans: _Spans) -> None:
    """More places of one segment: those whose repetition is certain now leave as spans, the rest wait."""
    if smaller_only:
        known = seg.places if least < seg.least else own if least > seg.least else []
        waiting = own if least < seg.least else seg.places if least > seg.least else seg.places + own
    else:
        known, waiting = seg.places + own, []
    for p in known:
        spans.add(*p)
    seg.places, seg.count, seg.least = waiting, seg.count + places, min(seg.least, least)


def covered(spans, mark: int, window: int, size: int) -> np.ndarray:
    """Which of ``size`` symbols go: those in a window that starts in one of the row's spans."""
    edge = np.zeros(size + 1, np.int64)
    for packed in spans or ():
        s = np.frombuffer(packed, _SPAN)
        s = s[s["mark"] == mark]
        np.add.at(edge, s["start"], 1)
        np.add.at(edge, s["start"] + s["n"] - 1 + window, -1)
    return np.cumsum(edge[:-1]) > 0


def with_spans(docs: DataFrame, flags: DataFrame) -> DataFrame:
    """All rows of ``docs``, the table the flags came from, with ``spans`` (null: none)."""
    return dealt_texts(docs).join(flags, "rid", "left")
