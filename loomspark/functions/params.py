"""Log parameters: JSON, else PHP-serialised, else the raw string, as canonical JSON."""

from __future__ import annotations

import json
import math

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


class PhpError(ValueError):
    """The bytes are not one PHP value of the kinds read here."""


class PhpReader:
    """Reads N, b, i, d, s and a values; objects and references are refused."""

    def __init__(self, data: bytes):
        self.data, self.at = data, 0

    def value(self):
        kind = self._take(1)
        if kind == b"N":
            self._expect(b";")
            return None
        self._expect(b":")
        if kind == b"b":
            return self._until(b";") == b"1"
        if kind == b"i":
            return self._number(int, b";")
        if kind == b"d":
            return self._number(float, b";")
        if kind == b"s":
            text = self._string()
            self._expect(b";")
            return text
        if kind == b"a":
            size = self._number(int, b":")
            self._expect(b"{")
            out = {}
            for _ in range(size):
                key = self.value()
                if not isinstance(key, (int, bytes)) or isinstance(key, bool):
                    raise PhpError("array key")
                out[key] = self.value()
            self._expect(b"}")
            return out
        raise PhpError(f"kind {kind!r}")

    def _string(self) -> bytes:
        size = self._number(int, b":")
        self._expect(b'"')
        text = self._take(size)
        self._expect(b'"')
        return text

    def _number(self, kind, end: bytes):
        raw = self._until(end)
        try:
            if kind is float and raw in (b"NAN", b"INF", b"-INF"):
                return float(raw.decode().replace("NAN", "nan").replace("INF", "inf"))
            return kind(raw)
        except ValueError as e:
            raise PhpError("number") from e

    def _take(self, n: int) -> bytes:
        if n < 0 or self.at + n > len(self.data):
            raise PhpError("end of data")
        self.at += n
        return self.data[self.at - n : self.at]

    def _expect(self, what: bytes) -> None:
        if self._take(len(what)) != what:
            raise PhpError(f"{what!r} expected")

    def _until(self, end: bytes) -> bytes:
        stop = self.data.find(end, self.at)
        if stop < 0:
            raise PhpError("end of data")
        out, self.at = self.data[self.at : stop], stop + len(end)
        return out


def _text(b: bytes) -> str:
    try:
        return b.decode("utf-8")
    except UnicodeDecodeError:
        return b.decode("latin-1")


def plain(value):
    """The value with string keys, text for bytes, and strings for numbers that JSON lacks."""
    match value:
        case dict():
            return {_text(k) if isinstance(k, bytes) else str(k): plain(v) for k, v in value.items()}
        case list():
            return [plain(v) for v in value]
        case bytes():
            return _text(value)
        case float() if math.isnan(value):
            return "NaN"
        case float() if math.isinf(value):
            return "Infinity" if value > 0 else "-Infinity"
    return value


def parse_params(raw: str | None) -> str | None:
    """Canonical JSON (keys sorted, compact, not ASCII-escaped), or None for nothing and for null."""
    trimmed = raw.strip() if raw is not None else ""
    if not trimmed:
        return None
    try:
        value = plain(json.loads(trimmed))
    except (ValueError, RecursionError):
        try:
            value = plain(PhpReader(trimmed.encode("utf-8", "surrogateescape")).value())
        except (PhpError, RecursionError):
            value = {"raw": raw}
    return None if value is None else json.dumps(value, ensure_ascii=False, sort_keys=True, separators=(",", ":"))


def log_params(c: Column | str) -> Column:
    """The column's parameters by an Arrow UDF; Python's JSON rules accept what Spark's refuse."""

    @F.pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        return s.map(parse_params, na_action="ignore")

    return run(c)


def param_field(params: Column | str, path: str) -> Column:
    """One field of canonical parameters as text, e.g. ``$.level`` or ``$['5::duration']``."""
    return F.try_variant_get(F.try_parse_json(params), path, "string")
