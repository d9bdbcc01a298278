"""Byte-level BPE by a lazily determinised finite-state transducer, and streaming decode.

The greedy merges have one last token for every prefix of a piece: the token ``t`` that
ends there and is compatible with the last token of the prefix before it, meaning that
merging the two tokens' bytes alone gives the two back.  So a left-to-right machine
suffices.  Its state holds, for every boundary that a longer token might still start
from, the bytes read since and the last token there; each step names the last token of
the prefix read.  Following last tokens back gives the ids; those that all boundaries
still open agree on are emitted while a long piece is being read.  States and
transitions come into being when a text first needs them.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterable, Iterator

import numpy as np
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_arrow, read_table, spread

#: Transitions a machine may hold before it forgets them and starts afresh.
STATE_LIMIT = 400_000
#: Bytes of a piece after which, each time, its settled tokens leave.
WINDOW = 1024
#: Verdicts on token pairs that a machine remembers.
PAIR_LIMIT = 600_000
#: Pieces of text whose ids a worker remembers (twice, an older half included), and the longest such piece in bytes.
PIECE_LIMIT, PIECE_BYTES = 300_000, 48


class Transducer:
    """Merges compiled on demand.  A state is a tuple of (bytes since boundary, last token there)."""

    START = ((b"", -1),)

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.token = {i: b for b, i in ranks.items()}
        self.size = {i: len(b) for b, i in ranks.items()}
        self.heads = {b[:n] for b in ranks for n in range(1, len(b))}  # proper prefixes of tokens
        self.reachable: dict[bytes, bool] = {}
        self.compatible: dict[int, bool] = {}
        self.states: dict[tuple, int] = {}
        self.content: list[tuple] = []
        self.steps: dict[int, tuple[int, int]] = {}
        self._reset()

    def _reset(self) -> None:
        self.states, self.content, self.steps = {}, [], {}
        self._number(self.START)

    def _number(self, state: tuple) -> int:
        at = self.states.get(state)
        if at is None:
            at = self.states[state] = len(self.content)
            self.content.append(state)
        return at

    def merged(self, data: bytes) -> list[int]:
        """Ids of ``data`` by applying the lowest-ranked merge until none is left."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                rank = self.ranks.get(parts[i] + parts[i + 1])
                if rank is not None and (best is None or rank < best):
                    best, at = rank, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[p] for p in parts]

    def _fits(self, last: int, data: bytes) -> bool:
        """Whether the token ``data`` may follow ``last`` (-1: the piece's start)."""
        ok = self.reachable.get(data)
        if ok is None:
            ok = self.reachable[data] = self.merged(data) == [self.ranks[data]]
        if not ok or last < 0:
            return ok
        rank = self.ranks[data]
        pair = (last << 32) | rank
        ok = self.compatible.get(pair)
        if ok is None:
            if len(self.compatible) >= PAIR_LIMIT:
                self.compatible.clear()
            ok = self.compatible[pair] = self.merged(self.token[last] + data) == [last, rank]
        return ok

    def _step(self, at: int, byte: int) -> tuple[int, int]:
        """The next state, and the last token of the prefix that ends here."""
        new = bytes([byte])
        ending, ranks, heads = -1, self.ranks, self.heads
        alive = []
        for since, last in self.content[at]:
            longer = since + new
            if ending < 0 and longer in ranks and self._fits(last, longer):
                ending = ranks[longer]
            if longer in heads:
                alive.append((longer, last))
        if ending < 0:
            raise AssertionError("a prefix without a last token")
        alive.append((b"", ending))
        return self._number(tuple(alive)), ending

    def _back(self, lasts: list[int], end: int) -> list[int]:
        """The tokens up to ``end``, by following last tokens back."""
        out, size = [], self.size
        while end:
            token = lasts[end - 1]
            out.append(token)
            end -= size[token]
        out.reverse()
        return out

    def _settled(self, lasts: list[int], at: int) -> int:
        """The furthest boundary that every open boundary's tokens pass through."""
        common: set[int] | None = None
        for since, _ in self.content[at]:
            end = len(lasts) - len(since)
            path = {end}
            while end:
                end -= self.size[lasts[end - 1]]
                path.add(end)
            common = path if common is None else common & path
        return max(common)

    def feed(self, data: bytes) -> list[int]:
        """Ids of one piece."""
        whole = self.ranks.get(data)
        if whole is not None:  # a piece that is a token stays one
            return [whole]
        if len(self.steps) > STATE_LIMIT:
            self._reset()
        at, steps, lasts, out = 0, self.steps, [], []
        wait = WINDOW
        for byte in data:
            key = (at << 8) | byte
            step = steps.get(key)
            if step is None:
                step = steps[key] = self._step(at, byte)
            at, last = step
            lasts.append(last)
            if len(lasts) == wait:
                sure = self._settled(lasts, at)
                out += self._back(lasts, sure)
                del lasts[:sure]
                wait = len(lasts) + WINDOW  # where nothing is settled yet, the next window may settle it
        return out + self._back(lasts, len(lasts)) if out else self._back(lasts, len(lasts))


class Utf8Machine:
    """Incremental UTF-8 decoder over chunks of bytes: a state is the open sequence.

    Complete characters leave at once, an open sequence waits for its rest, and a byte
    that cannot go on gives U+FFFD for the maximal broken part before it.
    """

    #: First byte's range: how many bytes follow and the bounds of the next one (fixed values of UTF-8).
    LEADS = ((0xC2, 0xDF, 1, 0x80, 0xBF), (0xE0, 0xE0, 2, 0xA0, 0xBF), (0xE1, 0xEC, 2, 0x80, 0xBF), (0xED, 0xED, 2, 0x80, 0x9F), (0xEE, 0xEF, 2, 0x80, 0xBF), (0xF0, 0xF0, 3, 0x90, 0xBF), (0xF1, 0xF3, 3, 0x80, 0xBF), (0xF4, 0xF4, 3, 0x80, 0x8F))

    def __init__(self):
        self.open, self.need, self.low, self.high = b"", 0, 0x80, 0xBF
        self.lead = {b: lead[2:] for lead in self.LEADS for b in range(lead[0], lead[1] + 1)}

    def feed(self, data: bytes) -> str:
        if not self.open and data.isascii():
            return data.decode("ascii")
        out = []
        for b in data:
            if self.need:
                if self.low <= b <= self.high:
                    self.open += bytes([b])
                    self.need -= 1
                    self.low, self.high = 0x80, 0xBF
                    if not self.need:
                        out.append(self.open.decode())
                        self.open = b""
                    continue
                out.append("�")
                self.open, self.need, self.low, self.high = b"", 0, 0x80, 0xBF
            if b < 0x80:
                out.append(chr(b))
            elif b in self.lead:
                self.open = bytes([b])
                self.need, self.low, self.high = self.lead[b]
            else:
                out.append("�")
        return "".join(out)

    def end(self) -> str:
        broken = "�" if self.open else ""
        self.open, self.need, self.low, self.high = b"", 0, 0x80, 0xBF
        return broken


def _narrowed(pattern: str) -> str:
    """The pattern for text of ASCII characters only, where its classes are short lists: the standard module is faster on these."""
    for wide, narrow in ((r"[^\s\p{L}\p{N}]", r"[^\t-\r A-Za-z0-9]"), (r"\p{L}", "[A-Za-z]"), (r"\p{N}", "[0-9]"), (r"\s", r"[\t-\r ]"), (r"\S", r"[^\t-\r ]")):
        pattern = pattern.replace(wide, narrow)
    return pattern


class PieceMemo(dict):
    """Pieces of text to their ids as little-endian unsigned 32-bit numbers, found when first asked for."""

    def __init__(self, machine: Transducer):
        super().__init__()
        self.machine = machine
        self.older: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.older.get(piece)
        if ids is None:
            ids = np.array(self.machine.feed(piece.encode()), "<u4").tobytes()
        if len(piece) <= PIECE_BYTES:
            if len(self) >= PIECE_LIMIT:
                self.older = dict(self)
                self.clear()
            self[piece] = ids
        return ids


class Codec:
    """Encoder and decoder over a tiktoken rank file; loaded once in each worker."""

    _loaded: dict[tuple[str, str], Codec] = {}

    def __init__(self, path: str, pattern: str):
        self.path = path
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.machine = Transducer(ranks)
        self.vocabulary = [b""] * (max(ranks.values()) + 1)
        for b, i in ranks.items():
            self.vocabulary[i] = b
        # \s of the rank files is Unicode's White_Space, which the regex module spells so
        self.pieces = regex.compile(pattern.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")).findall
        self.ascii_pieces = re.compile(_narrowed(pattern)).findall
        self.memo = PieceMemo(self.machine)

    @classmethod
    def load(cls, path: str, pattern: str) -> Codec:
        key = (path, pattern)
        if key not in cls._loaded:
            cls._loaded[key] = cls(path, pattern)
        return cls._loaded[key]

    def packed(self, text: str) -> bytes:
        """Ids of ``text`` as little-endian unsigned 32-bit numbers."""
        return b"".join(map(self.memo.__getitem__, (self.ascii_pieces if text.isascii() else self.pieces)(text)))

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.packed(text), "<u4").tolist()

    def decode_bytes(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.vocabulary.__getitem__, ids))

    def decode_stream(self, chunks: Iterable[Iterable[int]]) -> Iterator[str]:
        """Text of ids that arrive in chunks; a character split over tokens waits for its end."""
        machine = Utf8Machine()
        for chunk in chunks:
            if text := machine.feed(self.decode_bytes(chunk)):
                yield text
        if text := machine.end():
            yield text


#: Ids that the streaming decoder takes at a time.
CHUNK_IDS = 65_536


def encode_documents(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256[, ids, decoded])``, a row for each input row.

    ids_sha256 is over ids as little-endian unsigned 32-bit numbers, decoded_sha256 over
    the bytes that the streaming decoder gives back for them.  Null texts are empty: no
    ids, the digests of nothing.  Texts of any length are read whole, their longest piece
    window by window.  Text is never normalised; special tokens' strings are
    ordinary text; further columns are ignored; an empty table gives no rows.
    """
    extra = ", ids array<int>, decoded string" if keep_ids else ""

    def run(cols):
        codec = Codec.load(path, pattern)
        out: dict[str, list] = {k: [] for k in ("n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded")}
        for text in cols["text"].to_pylist():
            packed = codec.packed(text or "")
            ids = np.frombuffer(packed, "<u4").tolist()
            out["n_tokens"].append(len(ids))
            out["ids_sha256"].append(hashlib.sha256(packed).hexdigest())
            digest, decoded = hashlib.sha256(), []
            for part in codec.decode_stream(ids[i : i + CHUNK_IDS] for i in range(0, len(ids), CHUNK_IDS)):
                digest.update(part.encode())
                decoded.append(part)
            out["decoded_sha256"].append(digest.hexdigest())
            if keep_ids:
                out["ids"].append(ids)
                out["decoded"].append("".join(decoded))
        return out | {"doc_id": cols["doc_id"]}

    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + extra
    return map_arrow(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), run, schema)


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return encode_documents(spread(read_table(spark, sf_dir, "documents")), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
