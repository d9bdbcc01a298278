"""Best-fit packing of token pieces into fixed-length sequences, improved by swaps."""

from __future__ import annotations

import json
import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_schema, map_arrow, read_table, spread, written

SEQUENCE_TOKENS = 2048
#: Pieces packed together in one task: enough for tight bins, small enough for memory.
SHELF_PIECES = 20_000
#: Rounds of the local search over the underfull bins of a shelf.
SEARCH_ROUNDS = 6


class Encoder:
    """Token ids as the ``tokenizers`` file gives them without added special tokens.

    The file's vocabulary and its merge order also drive ``tiktoken``, which gives the
    same ids several times faster; texts that hold a special token's string go through
    ``tokenizers`` itself.
    """

    def __init__(self, path: str):
        self.path = path
        self._fast = None

    def __reduce__(self):
        return Encoder, (self.path,)

    def _load(self):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        with open(self.path, encoding="utf-8") as f:
            spec = json.load(f)
        byte_of = _byte_alphabet()
        special = {t["content"] for t in spec.get("added_tokens", [])}
        ranks = {bytes(byte_of[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
        self.special = sorted(special)
        self.slow = Tokenizer.from_file(self.path)
        self._fast = tiktoken.Encoding("packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def __call__(self, text: str) -> np.ndarray:
        if self._fast is None:
            self._load()
        if any(s in text for s in self.special):
            return np.array(self.slow.encode(text, add_special_tokens=False).ids, np.uint32)
        return np.array(self._fast.encode_ordinary(text), np.uint32)


def _byte_alphabet() -> dict[str, int]:
    """The characters that byte-level vocabularies write bytes with: printable ones as they are, the rest from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {chr(b): b for b in printable}
    for i, b in enumerate(b for b in range(256) if b not in set(printable)):
        out[chr(256 + i)] = b
    return out


def pieces(docs: DataFrame, encoder: Encoder, capacity: int = SEQUENCE_TOKENS, end_id: int = 0) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32)``: every document's tokens and one end id.

    Only documents longer than ``capacity`` are cut; their first piece takes the
    remainder, so that all others are full.
    """
    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"

    def run(cols):
        out: dict[str, list] = {k: [] for k in ("doc_id", "piece", "start", "length", "ids_crc32")}
        for d, text in zip(cols["doc_id"].to_pylist(), cols["text"].to_pylist(), strict=True):
            ids = np.append(encoder(text or ""), np.uint32(end_id)).astype("<u4")
            first = len(ids) % capacity or capacity
            edges = [0, *range(first, len(ids) + 1, capacity)]
            for i, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
                for k, v in zip(out, (d, i, a, b - a, zlib.crc32(ids[a:b].tobytes())), strict=True):
                    out[k].append(v)
        return out

    return map_arrow(docs.select("doc_id", "text"), run, schema)


class Shelf:
    """Bins of one capacity over items with sizes; bins are lists of item numbers."""

    def __init__(self, sizes: np.ndarray, capacity: int):
        self.sizes, self.capacity = [int(s) for s in sizes], capacity
        self.bins: list[list[int]] = []
        self.fill: list[int] = []

    def best_fit(self) -> None:
        """Largest first, each into the fullest bin that takes it."""
        room: list[tuple[int, int]] = []  # (free, bin), sorted
        for i in sorted(range(len(self.sizes)), key=lambda i: (-self.sizes[i], i)):
            s = self.sizes[i]
            at = bisect_left(room, (s, -1))
            if at < len(room):
                free, b = room.pop(at)
                self.bins[b].append(i)
                self.fill[b] += s
            else:
                free, b = self.capacity, len(self.bins)
                self.bins.append([i])
                self.fill.append(s)
            if free > s:
                insort(room, (free - s, b))

    def search(self, rounds: int) -> None:
        """Moves and swaps between underfull bins that raise the sum of squared fills.

        The emptiest bin gives: a document moves where it fits best; or one of its
        documents goes for a smaller one, or a pair of it for one, such that the fuller
        bin gains.  Every step raises the squared fill, so the search ends; a bin that
        runs empty is one sequence less.
        """
        for _ in range(rounds):
            open_bins = sorted((b for b in range(len(self.bins)) if self.bins[b] and self.fill[b] < self.capacity), key=lambda b: self.fill[b])
            if len(open_bins) < 2 or sum(self.fill[b] for b in open_bins) > (len(open_bins) - 1) * self.capacity:
                break  # no bin can be saved any more
            changed = False
            stock = sorted((self.sizes[i], i, b) for b in open_bins for i in self.bins[b])
            where = {i: b for _, i, b in stock}
            for giver in open_bins:
                changed |= self._empty(giver, open_bins, stock, where)
            if not changed:
                break
        keep = [b for b in range(len(self.bins)) if self.bins[b]]
        self.bins, self.fill = [self.bins[b] for b in keep], [self.fill[b] for b in keep]

    def _empty(self, giver: int, open_bins: list[int], stock: list, where: dict[int, int]) -> bool:
        changed = False
        for i in sorted(self.bins[giver], key=lambda i: -self.sizes[i]):
            if i not in self.bins[giver]:
                continue
            size = self.sizes[i]
            fits = [b for b in open_bins if b != giver and self.bins[b] and self.fill[b] + size <= self.capacity and self.fill[b] + size > self.fill[giver]]
            if fits:
                self._move(i, giver, max(fits, key=lambda b: self.fill[b]), where)
                changed = True
                continue
            changed |= self._swap((i,), giver, stock, where)
        own = sorted(self.bins[giver], key=lambda i: -self.sizes[i])[:12]
        for a in range(len(own)):
            for b in range(a + 1, len(own)):
                if own[a] in self.bins[giver] and own[b] in self.bins[giver]:
                    changed |= self._swap((own[a], own[b]), giver, stock, where)
        return changed

    def _swap(self, out: tuple[int, ...], giver: int, stock: list, where: dict[int, int]) -> bool:
        """Trade ``out`` of the giver for one smaller document of a fuller bin, at the best gain."""
        size = sum(self.sizes[i] for i in out)
        best = None
        at = bisect_right(stock, (size - 1, len(self.sizes), 0))
        for s, j, _ in reversed(stock[max(0, at - 64) : at]):
            b = where[j]
            more = size - s
            if b == giver or self.fill[b] + more > self.capacity or self.fill[b] + more <= self.fill[giver]:
                continue
            gain = 2 * more * (self.fill[b] - self.fill[giver] + more)
            if best is None or gain > best[0]:
                best = (gain, j, b)
        if best is None or best[0] <= 0:
            return False
        _, j, b = best
        for i in out:
            self._move(i, giver, b, where)
        self._move(j, b, giver, where)
        return True

    def _move(self, i: int, source: int, target: int, where: dict[int, int]) -> None:
        self.bins[source].remove(i)
        self.bins[target].append(i)
        self.fill[source] -= self.sizes[i]
        self.fill[target] += self.sizes[i]
        where[i] = target


def pack(rows: DataFrame, capacity: int = SEQUENCE_TOKENS, shelf_pieces: int = SHELF_PIECES, rounds: int = SEARCH_ROUNDS) -> DataFrame:
    """``rows`` (doc_id, piece, length, ..) with ``sequence_id`` and ``offset``.

    Rows are dealt evenly into shelves of about ``shelf_pieces`` by a hash of their
    place and their number in the table, so that many equal rows are not one shelf's.  Each
    shelf packs best fit and then searches.  It wastes at most part of a few bins, so more
    shelves hardly cost sequences.  ``rows`` is read twice and must be a written table.
    """
    total = rows.count()
    shelves = max(1, round(total / shelf_pieces))
    spark = rows.sparkSession
    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint"
    arrow = arrow_schema(spark, schema)
    names = [f for f in arrow.names if f not in ("sequence_id", "offset")]
    dealt = rows.select(*names, F.pmod(F.xxhash64("doc_id", "piece", "start", "ids_crc32", F.monotonically_increasing_id()), F.lit(shelves)).alias("shelf"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, number = [], None
        for batch in batches:
            numbers = batch.column(5).to_numpy()
            edges = [0, *(np.flatnonzero(numbers[1:] != numbers[:-1]) + 1).tolist(), len(numbers)]
            for a, b in zip(edges, edges[1:], strict=False):
                if a == b:
                    continue
                if number is not None and numbers[a] != number:
                    yield settle(number, held)
                    held = []
                number = int(numbers[a])
                held.append(batch.slice(a, b - a))
        if held:
            yield settle(number, held)

    def settle(number: int, held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held).combine_chunks()
        shelf = Shelf(table.column(3).to_numpy(), capacity)
        shelf.best_fit()
        shelf.search(rounds)
        sequence, offset = np.zeros(len(table), np.int64), np.zeros(len(table), np.int64)
        for b, items in enumerate(shelf.bins):
            at = 0
            for i in items:
                sequence[i], offset[i] = (number << 32) + b, at
                at += shelf.sizes[i]
        columns = [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in table.columns[:5]]
        return pa.RecordBatch.from_arrays([*columns, pa.array(sequence), pa.array(offset)], schema=arrow)

    n = min(shelves, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return dealt.repartition(n, "shelf").sortWithinPartitions("shelf", "doc_id", "piece", "start").mapInArrow(run, schema)


def packed_documents(docs: DataFrame, path: str | None = None, capacity: int = SEQUENCE_TOKENS, **options) -> DataFrame:
    """Every document's pieces with the sequence and offset they are packed at.

    Null and empty texts are the end id alone; texts of any length are read whole and cut into
    pieces; null ids and repeated rows, however many, are packed like any others; further
    columns are ignored; an empty table gives no rows.
    """
    import public_tokenizers

    cut = written(pieces(docs, Encoder(path or public_tokenizers.path("byte_bpe_50k.json")), capacity), "pieces")
    return pack(cut, capacity, **options)


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_documents(spread(read_table(spark, sf_dir, "documents")))
