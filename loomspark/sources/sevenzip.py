"""Reading a 7z archive of one file over the standard library's LZMA.

Understands what dump archives use: one folder with one coder (copy, LZMA or LZMA2),
and headers that are stored plainly or packed the same way.  More than one file, other
coders or several volumes are refused.
"""

from __future__ import annotations

import io
import lzma
import struct
from typing import BinaryIO

#: Section ids of the container format (fixed values).
END, HEADER, MAIN_STREAMS, FILES, PACK, UNPACK, SUBSTREAMS = 0x00, 0x01, 0x04, 0x05, 0x06, 0x07, 0x08
SIZE, CRC, FOLDER, CODER_SIZES, PACKED_HEADER = 0x09, 0x0A, 0x0B, 0x0C, 0x17
MAGIC = b"7z\xbc\xaf\x27\x1c"


class ArchiveError(ValueError):
    """Not an archive that this reader understands."""


class _Cursor:
    def __init__(self, data: bytes):
        self.data = io.BytesIO(data)

    def byte(self) -> int:
        b = self.data.read(1)
        if not b:
            raise ArchiveError("header ends early")
        return b[0]

    def take(self, n: int) -> bytes:
        return self.data.read(n)

    def number(self) -> int:
        """The format's variable-length number: leading ones of the first byte count more bytes."""
        first = self.byte()
        value, mask = 0, 0x80
        for k in range(8):
            if not first & mask:
                return value | (first & (mask - 1)) << (8 * k)
            value |= self.byte() << (8 * k)
            mask >>= 1
        return value

    def expect(self, what: int) -> None:
        if (got := self.byte()) != what:
            raise ArchiveError(f"section {got:#x} where {what:#x} is due")


class _Streams:
    """Where the single packed stream lies and how it is coded."""

    def __init__(self, c: _Cursor):
        self.offset = self.packed = self.size = 0
        self.filters: list[dict] | None = None
        while (section := c.byte()) != END:
            if section == PACK:
                self.offset, n = c.number(), c.number()
                if n != 1:
                    raise ArchiveError(f"{n} packed streams")
                while (part := c.byte()) != END:
                    if part != SIZE:
                        self._digests(c, 1)
                    else:
                        self.packed = c.number()
            elif section == UNPACK:
                self._folder(c)
            elif section == SUBSTREAMS:
                while (part := c.byte()) != END:
                    if part == 0x0D:  # number of files in the folder
                        if (n := c.number()) != 1:
                            raise ArchiveError(f"{n} files")
                    elif part == CRC:
                        self._digests(c, 1)
                    else:
                        raise ArchiveError(f"part {part:#x}")
            else:
                raise ArchiveError(f"section {section:#x}")

    @staticmethod
    def _digests(c: _Cursor, n: int) -> None:
        if not c.byte():
            raise ArchiveError("digests of some streams only")
        c.take(4 * n)

    def _folder(self, c: _Cursor) -> None:
        c.expect(FOLDER)
        if c.number() != 1 or c.byte() != 0 or c.number() != 1:
            raise ArchiveError("more than one folder or coder")
        flags = c.byte()
        method = c.take(flags & 0x0F)
        if flags & 0x10:
            raise ArchiveError("coder with several streams")
        properties = c.take(c.number()) if flags & 0x20 else b""
        if method == b"\x00":
            self.filters = None
        elif method == b"\x21":
            bits = properties[0]
            self.filters = [{"id": lzma.FILTER_LZMA2, "dict_size": 0xFFFFFFFF if bits == 40 else (2 | bits & 1) << (bits // 2 + 11)}]
        elif method == b"\x03\x01\x01":
            lc, rest = properties[0] % 9, properties[0] // 9
            self.filters = [{"id": lzma.FILTER_LZMA1, "lc": lc, "lp": rest % 5, "pb": rest // 5, "dict_size": struct.unpack("<I", properties[1:5])[0]}]
        else:
            raise ArchiveError(f"coder {method.hex()}")
        c.expect(CODER_SIZES)
        self.size = c.number()
        while (part := c.byte()) != END:
            if part != CRC:
                raise ArchiveError(f"part {part:#x}")
            self._digests(c, 1)


class _Entry(io.RawIOBase):
    """The single file's bytes, decoded as they are read: memory holds one block and the dictionary."""

    def __init__(self, source: BinaryIO, streams: _Streams, block: int = 1 << 20):
        source.seek(32 + streams.offset)
        self.source, self.left_packed, self.left, self.block = source, streams.packed, streams.size, block
        self.decoder = lzma.LZMADecompressor(lzma.FORMAT_RAW, filters=streams.filters) if streams.filters else None

    def readable(self) -> bool:
        return True

    def readinto(self, out) -> int:
        want = min(len(out), self.left)
        data = b""
        while want and not data:
            if self.decoder is None:
                data = self.source.read(min(want, self.left_packed))
                self.left_packed -= len(data)
            else:
                feed = b""
                if self.decoder.needs_input and self.left_packed:
                    feed = self.source.read(min(self.block, self.left_packed))
                    self.left_packed -= len(feed)
                data = self.decoder.decompress(feed, want)
            if not data and not self.left_packed and (self.decoder is None or self.decoder.needs_input):
                raise ArchiveError("data ends early")
        out[: len(data)] = data
        self.left -= len(data)
        return len(data)


def open_single(source: BinaryIO) -> io.BufferedReader:
    """A stream over the only file of an archive (a seekable binary file)."""
    start = source.read(32)
    if start[:6] != MAGIC:
        raise ArchiveError("no 7z signature")
    offset, size = struct.unpack("<QQ", start[12:28])
    source.seek(32 + offset)
    header = source.read(size)
    while header[:1] == bytes([PACKED_HEADER]):
        packed = _Streams(_Cursor(header[1:]))
        header = io.BufferedReader(_Entry(source, packed)).read(packed.size)
    c = _Cursor(header)
    c.expect(HEADER)
    c.expect(MAIN_STREAMS)
    streams = _Streams(c)
    c.expect(FILES)
    if (n := c.number()) != 1:
        raise ArchiveError(f"an archive of one file is due, not of {n}")
    return io.BufferedReader(_Entry(source, streams), 1 << 16)
