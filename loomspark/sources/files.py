"""Opening dump files on executors: any file system that Arrow reads, by suffix gzip, 7z or plain."""

from __future__ import annotations

import fnmatch
import glob
import gzip
import hashlib
import io
import re
from collections.abc import Iterator
from typing import BinaryIO

from pyarrow import fs

from .sevenzip import open_single

CHUNK = 1 << 22


def filesystem(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if re.match(r"[a-z0-9+]+://|file:", path) else (fs.LocalFileSystem(), path)


def open_bytes(path: str) -> BinaryIO:
    """The decompressed bytes of a .gz, .7z or plain file, as a stream."""
    system, name = filesystem(path)
    if name.endswith(".7z"):
        return open_single(system.open_input_file(name))
    raw = system.open_input_stream(name, compression=None)
    return gzip.GzipFile(fileobj=raw) if name.endswith(".gz") else io.BufferedReader(raw) if isinstance(raw, io.RawIOBase) else raw


def lines(path: str, start: int = 0, stop: int | None = None) -> Iterator[str]:
    """Lines as latin-1 text without their line feed; a last one without it counts.

    With ``start`` and ``stop`` those that begin in that range of a plain file's bytes: neighbouring
    ranges share no line and lose none, wherever their border falls.
    """
    if start == 0 and stop is None:
        with open_bytes(path) as f:
            yield from (line for _, line in _lines(f, 0))
        return
    system, name = filesystem(path)
    with system.open_input_file(name) as f:
        # the byte before tells whether a line begins here
        f.seek(max(0, start - 1))
        found = _lines(f, max(0, start - 1))
        if start:
            next(found, None)
        for at, line in found:
            if stop is not None and at >= stop:
                return
            yield line


def _lines(f: BinaryIO, at: int) -> Iterator[tuple[int, str]]:
    """Lines with the place where they begin, from an open file at place ``at``."""
    rest: list[bytes] = []  # pieces of a line that has not ended
    held = 0
    while chunk := f.read(CHUNK):
        first, *more = chunk.split(b"\n")
        rest.append(first)
        held += len(first)
        if not more:
            continue
        yield at, b"".join(rest).decode("latin-1")
        at += held + 1
        for line in more[:-1]:
            yield at, line.decode("latin-1")
            at += len(line) + 1
        rest, held = [more[-1]], len(more[-1])
    if held:
        yield at, b"".join(rest).decode("latin-1")


def ranges(path: str, size: int) -> list[tuple[int, int | None]]:
    """Byte ranges of about ``size`` of a plain file; a packed one is a single range."""
    system, name = filesystem(path)
    if name.endswith((".gz", ".7z")):
        return [(0, None)]
    whole = system.get_file_info(name).size
    return [(a, min(a + size, whole)) for a in range(0, whole, size)]


def natural_key(path: str) -> tuple[int, int, str]:
    """Part number, then first page, then name."""
    name = path.rsplit("/", 1)[-1]
    part, page = re.search(r"(?:history|stub)(\d+)\.", name), re.search(r"p(\d+)p\d+", name)
    return (int(part.group(1)) if part else 0, int(page.group(1)) if page else 0, name)


def discover(pattern: str) -> list[str]:
    """Files of a comma-separated list of paths or globs of the last part, in natural order.

    Globs of any file system that Arrow lists match, so ``s3://`` and ``hdfs://`` as well.
    """
    found = []
    for p in pattern.split(","):
        p = p.strip()
        found += _matching(p) if re.search(r"[*?\[]", p) else [p]
    return sorted(set(found), key=natural_key)


def _matching(pattern: str) -> list[str]:
    if "://" not in pattern or pattern.startswith("file://"):
        return glob.glob(pattern.removeprefix("file://"))
    folder, _, last = pattern.rpartition("/")
    system, name = filesystem(folder)
    inside = system.get_file_info(fs.FileSelector(name, allow_not_found=True))
    return [f"{folder}/{f.base_name}" for f in inside if f.is_file and fnmatch.fnmatchcase(f.base_name, last)]


def sha1_of(path: str, chunk: int = 1 << 20) -> str:
    """SHA-1 of the stored (not decompressed) bytes."""
    system, name = filesystem(path)
    digest = hashlib.sha1()
    with system.open_input_stream(name, compression=None) as f:
        while block := f.read(chunk):
            digest.update(block)
    return digest.hexdigest()
