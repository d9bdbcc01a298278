"""Encoding and decoding by a SentencePiece model of merge type, by exact backtracking.

Merging takes the best-scored neighbours first, of equal scores the leftmost.  Its result
is the one sequence of pieces in which every piece is what its own text merges to and
every two neighbours come back when their texts are merged together.  So the encoder lays
pieces from left to right: the longest that matches (an Aho-Corasick automaton finds it
for every place in one pass), if it fits the piece before, else a shorter one; a place
from which nothing leads to the end is marked in a bitfield and never tried again.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterable, Iterator

import ahocorasick
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_arrow, read_table, spread

#: What the model files write for a space (fixed value of the format).
SPACE = "▁"
#: Kinds of pieces in the model file (fixed values of the format).
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
#: Chunks of text whose ids a worker remembers (twice, an older half included), and the longest such chunk.
CHUNK_LIMIT, CHUNK_LENGTH = 300_000, 48
#: Verdicts on neighbours that a worker remembers.
PAIR_LIMIT = 600_000
#: Places of a chunk whose longest matches are held at once.
PLACES = 65_536


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """The fields (number, value) of one message in the wire format of protocol buffers."""

    def varint(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            byte = data[at]
            value |= (byte & 0x7F) << shift
            at, shift = at + 1, shift + 7
            if byte < 0x80:
                return value, at

    at = 0
    while at < len(data):
        tag, at = varint(at)
        kind = tag & 7
        if kind == 0:
            value, at = varint(at)
        else:
            if kind == 2:
                size, at = varint(at)
            else:
                size = {1: 8, 5: 4}[kind]
            value, at = data[at : at + size], at + size
        yield tag >> 3, value


class PieceModel:
    """Encoder and decoder over one model file; loaded once in each worker.

    Models of another type than merging, with a table of character normalisation or with
    unused pieces are refused.
    """

    _loaded: dict[str, PieceModel] = {}

    def __init__(self, path: str):
        with open(path, "rb") as f:
            model = list(_fields(f.read()))
        trainer = dict(_fields(b"".join(v for n, v in model if n == 2)))
        normalizer = dict(_fields(b"".join(v for n, v in model if n == 3)))
        if trainer.get(3, 1) != 2 or normalizer.get(2) or trainer.get(24) or not normalizer.get(5, 1):
            raise ValueError("only merge models without character normalisation are read")
        self.dummy_prefix, self.squeeze = bool(normalizer.get(3, 1)), bool(normalizer.get(4, 1))
        self.byte_fallback = bool(trainer.get(35, 0))
        self.ids: dict[str, int] = {}
        self.score: dict[str, float] = {}
        self.bytes: dict[int, int] = {}
        self.unknown, own = 0, []
        #: What an id decodes to; a byte of 128 and more is a lone surrogate until the bytes are put together.
        self.surface: list[str] = []
        for i, piece in enumerate(v for n, v in model if n == 1):
            entry = dict(_fields(piece))
            text, kind = entry.get(1, b"").decode(), entry.get(3, NORMAL)
            shown = text.replace(SPACE, " ")
            if kind in (NORMAL, USER_DEFINED):
                if text not in self.ids:
                    self.ids[text], self.score[text] = i, struct.unpack("<f", entry.get(2, bytes(4)))[0]
                if kind == USER_DEFINED:
                    own.append(text)
            elif kind == BYTE:
                byte = int(text[3:5], 16)
                self.bytes[byte] = i
                shown = chr(byte) if byte < 128 else chr(0xDC00 + byte)
            elif kind == UNKNOWN:
                self.unknown, shown = i, trainer.get(44, " ⁇ ".encode()).decode()
            elif kind == CONTROL:
                shown = ""
            else:
                raise ValueError("models with unused pieces are not read")
            self.surface.append(shown)
        self.spaced = frozenset(i for t, i in self.ids.items() if t.startswith(SPACE))
        self.longest_piece = max(map(len, self.ids), default=1)
        self.automaton = ahocorasick.Automaton()
        for text in self.ids:
            self.automaton.add_word(text[::-1], text)
        self.automaton.make_automaton()
        self.names = [str(i) for i in range(len(self.surface))]
        self.own = re.compile("(" + "|".join(re.escape(t) for t in sorted(own, key=len, reverse=True)) + ")") if own else None
        self.chunks = self._chunk_pattern()
        self.shorter: dict[str, str | None] = {}
        self.whole: dict[str, bool] = {}
        self.fitting: dict[tuple[str, str], bool] = {}
        self.memo: dict[str, list[int]] = {}
        self.older: dict[str, list[int]] = {}

    @classmethod
    def load(cls, path: str) -> PieceModel:
        if path not in cls._loaded:
            cls._loaded[path] = cls(path)
        return cls._loaded[path]

    def _chunk_pattern(self):
        """Cuts a text where no merge can cross, as no piece holds the two characters side by side.

        That is around characters that only stand alone, and before spaces that follow others.
        """
        joined = {c for t in self.ids if len(t) > 1 for c in t}
        alone = "".join(re.escape(chr(c)) for c in range(128) if chr(c) not in joined)
        if any(SPACE in t.lstrip(SPACE) for t in self.ids):
            return re.compile(f"[{alone}]|[^{alone}]+" if alone else "(?s:.+)").findall
        single = f"[{alone}]|" if alone else ""
        return re.compile(f"{single}{SPACE}*[^{SPACE}{alone}]+|{SPACE}+").findall

    def merged(self, text: str) -> list[str]:
        """``text`` after merging: the best-scored neighbours first, of equal scores the leftmost."""
        parts, score = list(text), self.score
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _fits(self, last: str | None, piece: str) -> bool:
        """Whether ``piece`` may follow ``last``."""
        ok = self.whole.get(piece)
        if ok is None:
            ok = len(self.merged(piece)) == 1
            if piece in self.ids:
                self.whole[piece] = ok
        if not ok or last is None:
            return ok
        pair = (last, piece)
        ok = self.fitting.get(pair)
        if ok is None:
            if len(self.fitting) >= PAIR_LIMIT:
                self.fitting.clear()
            ok = self.fitting[pair] = self.merged(last + piece) == [last, piece]
        return ok

    def _shorter(self, piece: str) -> str | None:
        """The next shorter piece that ``piece`` starts with; any single character is one."""
        if len(piece) == 1:
            return None
        found = self.shorter.get(piece)
        if found is None:
            found = self.shorter[piece] = next((piece[:n] for n in range(len(piece) - 1, 1, -1) if piece[:n] in self.ids), piece[0])
        return found

    def _longest(self, text: str, start: int) -> list[str]:
        """The longest piece at each of the next places: the automaton reads the text backwards."""
        stop = min(len(text), start + PLACES)
        window = text[start : stop + self.longest_piece]
        found, end = list(text[start:stop]), len(window) - 1
        seen = len(window)
        for at, piece in self.automaton.iter(window[::-1]):
            place = end - at
            if place != seen:  # the first match that ends at a place is the longest
                seen = place
                if place < len(found):
                    found[place] = piece
        return found

    def pieces(self, text: str) -> list[str]:
        """The pieces of one chunk; a character that no piece holds is one of its own."""
        if text in self.ids and self._fits(None, text):
            return [text]
        failed = bytearray(len(text) // 8 + 1)
        base, matches = 0, self._longest(text, 0)
        out: list[str] = []
        at, piece = 0, matches[0]
        while True:
            end = at + len(piece)
            if not failed[end >> 3] >> (end & 7) & 1 and self._fits(out[-1] if out else None, piece):
                out.append(piece)
                at = end
                if at == len(text):
                    return out
                if not base <= at < base + len(matches):
                    base, matches = at, self._longest(text, at)
                piece = matches[at - base]
                continue
            less = self._shorter(piece)
            while less is None:
                if not out:
                    raise AssertionError("a text without pieces")
                failed[at >> 3] |= 1 << (at & 7)
                piece = out.pop()
                at -= len(piece)
                less = self._shorter(piece)
            piece = less

    def _chunk_ids(self, chunk: str) -> list[int]:
        out: list[int] = []
        unknown = False
        for piece in self.pieces(chunk):
            i = self.ids.get(piece)
            if i is not None:
                out.append(i)
            elif self.byte_fallback:
                out += [self.bytes[b] for b in piece.encode()]
            elif not unknown:  # neighbours without a piece are one unknown id
                out.append(self.unknown)
            unknown = i is None and not self.byte_fallback
        return out

    def normalized(self, text: str) -> str:
        if self.squeeze:
            text = re.sub(" +", " ", text.strip(" "))
        if text and self.dummy_prefix:
            text = " " + text
        return text.replace(" ", SPACE)

    def encode(self, text: str) -> list[int]:
        """Ids of ``text``, without begin and end."""
        text, out = self.normalized(text), []
        for part in self.own.split(text) if self.own else (text,):
            if self.own and part in self.ids and self.own.fullmatch(part):
                out.append(self.ids[part])
                continue
            for chunk in self.chunks(part):
                ids = self.memo.get(chunk)
                if ids is None:
                    ids = self._remember(chunk)
                if out and ids[0] == self.unknown == out[-1]:
                    ids = ids[1:]
                out += ids
        return out

    def _remember(self, chunk: str) -> list[int]:
        ids = self.older.get(chunk)
        if ids is None:
            ids = self._chunk_ids(chunk)
        if len(chunk) <= CHUNK_LENGTH:
            if len(self.memo) >= CHUNK_LIMIT:
                self.older, self.memo = self.memo, {}
            self.memo[chunk] = ids
        return ids

    def decode(self, ids: Iterable[int]) -> str:
        """Text of ``ids``: the leading space goes, bytes make characters, a byte that makes none gives U+FFFD."""
        ids = list(ids)
        text = "".join(map(self.surface.__getitem__, ids))
        if self.dummy_prefix or self.squeeze:
            first = next((i for i in ids if self.surface[i]), None)
            if first in self.spaced:
                text = text[1:]
        if text.isascii():
            return text
        try:
            return text.encode("utf-8", "surrogateescape").decode()
        except UnicodeDecodeError:
            return re.sub("[\udc80-\udcff]+", lambda run: _characters(run[0].encode("utf-8", "surrogateescape")), text)


def _characters(data: bytes) -> str:
    """Bytes as characters; each byte that is no part of a character is U+FFFD."""
    out, at = [], 0
    while at < len(data):
        for size in (1, 2, 3, 4):
            try:
                out.append(data[at : at + size].decode())
            except UnicodeDecodeError:
                continue
            at += size
            break
        else:
            out.append("�")
            at += 1
    return "".join(out)


def encode_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256[, ids, decoded])``, a row for each input row.

    ids_sha256 is over the decimal ids joined by commas, decoded_sha256 over the text that
    the ids decode to.  Null and empty texts have no ids and the digests of nothing.  Texts
    of any length are read whole; equal rows give equal rows; an id may be null; further
    columns are ignored; an empty table gives no rows.
    """
    extra = ", ids array<int>, decoded string" if keep_ids else ""

    def run(cols):
        model = PieceModel.load(path)
        out: dict[str, list] = {k: [] for k in ("n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded")}
        for text in cols["text"].to_pylist():
            ids = model.encode(text or "")
            decoded = model.decode(ids)
            out["n_tokens"].append(len(ids))
            out["ids_sha256"].append(hashlib.sha256(",".join(map(model.names.__getitem__, ids)).encode()).hexdigest())
            out["decoded_sha256"].append(hashlib.sha256(decoded.encode()).hexdigest())
            if keep_ids:
                out["ids"].append(ids)
                out["decoded"].append(decoded)
        return out | {"doc_id": cols["doc_id"]}

    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + extra
    return map_arrow(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), run, schema)


def op11_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return encode_documents(spread(read_table(spark, sf_dir, "documents")), public_tokenizers.path("piece_bpe_32k.model"))
