"""Fetching a run's files over HTTP: the status file with a cache, dump files with resume and retry."""

from __future__ import annotations

import os
import time
import urllib.error
import urllib.request
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomspark.session import ensure_importable

from .files import filesystem, sha1_of

CHUNK = 1 << 20
TIMEOUT_SECONDS = 60
#: Attempts for a file, and the seconds that the wait grows by after each (fixed values).
ATTEMPTS, BACKOFF_SECONDS = 3, 5
#: How long a fetched status file counts as fresh (fixed value).
CACHE_SECONDS = 24 * 3600

RESULT = "file string, state string, size bigint, sha1 string, message string"


class Outcome(NamedTuple):
    """``ok`` (fetched), ``skipped`` (was complete), ``mismatch`` (hash differs) or ``failed``; nothing wrong is overwritten."""

    state: str
    size: int | None
    sha1: str | None
    message: str


def fetch_manifest(url: str, cache: str, refresh: bool = False) -> str:
    """Path of the status file on the driver: the cached one if it is fresh, else fetched and swapped in whole."""
    if not refresh and os.path.exists(cache) and time.time() - os.path.getmtime(cache) < CACHE_SECONDS:
        return cache
    with urllib.request.urlopen(url, timeout=TIMEOUT_SECONDS) as answer:
        body = answer.read()
    with open(cache + ".new", "wb") as f:
        f.write(body)
    os.replace(cache + ".new", cache)
    return cache


def fetch_file(url: str, target: str, size: int | None, sha1: str | None, attempts: int = ATTEMPTS, backoff: float = BACKOFF_SECONDS) -> Outcome:
    """One file to a folder of any file system that Arrow writes.

    A complete file is only verified; one that is too large or whose hash differs is left
    for its owner to judge; a partial one is resumed where the server and the file system
    can, and else fetched anew.  Without a known size any file that is there is fetched anew.
    """
    system, name = filesystem(target)

    def there() -> int:
        info = system.get_file_info(name)
        return info.size if info.is_file else 0

    have = there()
    if size is not None and have > size:
        return Outcome("failed", have, None, f"larger than the {size} bytes of the manifest")
    if size is not None and have == size and system.get_file_info(name).is_file:
        return _verdict(target, size, sha1, "skipped")
    problem = ""
    for nth in range(1, attempts + 1):
        try:
            _stream(url, system, name, there() if size is not None else 0)
        except (OSError, urllib.error.URLError) as e:
            problem = f"{type(e).__name__}: {e}"
        else:
            have = there()
            if size is None or have == size:
                return _verdict(target, have, sha1, "ok")
            if have > size:
                return Outcome("failed", have, None, f"{have} bytes came, not {size}")
            problem = f"{have} of {size} bytes came"
        if nth < attempts:
            time.sleep(backoff * nth)
    return Outcome("failed", there(), None, problem)


def _verdict(target: str, size: int, sha1: str | None, good: str) -> Outcome:
    seen = sha1_of(target)
    return Outcome(good if sha1 is None or seen == sha1 else "mismatch", size, seen, "" if sha1 is None or seen == sha1 else f"SHA-1 should be {sha1}")


def _stream(url: str, system, name: str, start: int) -> None:
    """Append what follows byte ``start``; the whole file where the answer is no part or the store cannot append."""
    sink = None
    if start:
        try:
            sink = system.open_append_stream(name, compression=None)
        except NotImplementedError:
            start = 0
    request = urllib.request.Request(url, headers={"Range": f"bytes={start}-"} if start else {})
    try:
        with urllib.request.urlopen(request, timeout=TIMEOUT_SECONDS) as answer:
            if sink is None or answer.status != 206:
                if sink is not None:
                    sink.close()
                sink = system.open_output_stream(name, compression=None)
            while block := answer.read(CHUNK):
                sink.write(block)
    finally:
        if sink is not None:
            sink.close()


def download(files: DataFrame, base_url: str, folder: str, lanes: int = 3, attempts: int = ATTEMPTS, backoff: float = BACKOFF_SECONDS) -> DataFrame:
    """``(file, state, size, sha1, message)`` of the manifest's ``(file, size, sha1)`` after fetching into ``folder``.

    Executors fetch, ``lanes`` files at once, as mirrors ask for few connections; the folder
    must be one that all of them share.  A task that is run again verifies what is complete
    and resumes what is not.  Use the result once: each action fetches or verifies anew.
    """
    ensure_importable(files.sparkSession)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for row in batch.to_pylist():
                got = fetch_file(f"{base_url}/{row['file']}", f"{folder}/{row['file']}", row["size"], row["sha1"], attempts, backoff)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([v], t) for v, t in zip((row["file"], *got), (pa.string(), pa.string(), pa.int64(), pa.string(), pa.string()), strict=True)],
                    names=["file", *Outcome._fields],
                )

    return files.select("file", F.col("size").cast("bigint").alias("size"), "sha1").repartition(lanes, "file").mapInArrow(run, RESULT)
