"""``spark.read.format("wikihistory")``: flat revisions of page-history XML, a partition a file.

Pages stream: a revision leaves memory before the next is parsed, so a page with a very
long history costs no more than a short one.
"""

from __future__ import annotations

import xml.etree.ElementTree as ET
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader

from loomspark.schemas import flat_schema
from loomspark.session import ensure_importable

from .files import discover, open_bytes
from .mysqldump import DumpFile

SCHEMA = (
    "file string, page_id bigint, page_namespace int, page_title string, rev_id bigint, rev_parent_id bigint, timestamp string, "
    "has_contributor boolean, user_deleted boolean, user_name string, user_id bigint, minor boolean, comment string, comment_deleted boolean, "
    "text string, text_bytes bigint, text_deleted boolean, sha1 string"
)
BATCH_ROWS, BATCH_BYTES = 5_000, 32 << 20


def local(tag: str) -> str:
    """The tag's name without its namespace."""
    return tag.rpartition("}")[2]


def _int(text: str | None) -> int | None:
    try:
        return int(text) if text and text.strip() else None
    except ValueError:
        return None


def revisions(stream, limit: int | None = None) -> Iterator[dict]:
    """Revision rows of an export stream; ``limit`` counts rows of this file."""
    root, holder, page, count = None, None, {}, 0
    depth: list[str] = []
    for event, elem in ET.iterparse(stream, events=("start", "end")):
        name = local(elem.tag)
        if event == "start":
            root = elem if root is None else root
            depth.append(name)
            if name == "page":
                page, holder = {}, elem
            continue
        depth.pop()
        parent = depth[-1] if depth else ""
        if name == "revision" and parent == "page":
            if limit is not None and count >= limit:
                return
            yield _revision(elem, page)
            count += 1
            holder.remove(elem)
        elif parent == "page" and name in ("title", "ns", "id"):
            page[name] = elem.text
        elif name == "page" and root is not None:
            root.clear()


def _revision(elem: ET.Element, page: dict) -> dict:
    part = {local(e.tag): e for e in elem}
    who, text, comment = part.get("contributor"), part.get("text"), part.get("comment")
    names = {local(e.tag): e.text for e in who} if who is not None else {}
    gone = who is not None and who.get("deleted") is not None

    def content(tag: str) -> str | None:
        return part[tag].text if tag in part else None

    return {
        "page_id": _int(page.get("id")), "page_namespace": _int(page.get("ns")), "page_title": page.get("title"),
        "rev_id": _int(content("id")), "rev_parent_id": _int(content("parentid")), "timestamp": content("timestamp"),
        "has_contributor": who is not None, "user_deleted": gone, "user_name": None if gone else names.get("username") or names.get("ip"),
        "user_id": None if gone else _int(names.get("id")), "minor": "minor" in part,
        "comment": comment.text if comment is not None else None, "comment_deleted": comment is not None and comment.get("deleted") is not None,
        "text": text.text if text is not None else None, "text_bytes": _int(text.get("bytes")) if text is not None else None,
        "text_deleted": text is not None and text.get("deleted") is not None, "sha1": content("sha1"),
    }


class HistoryReader(DataSourceReader):
    def __init__(self, path: str, limit: int | None):
        self.path, self.limit = path, limit

    def partitions(self) -> list[DumpFile]:
        return [DumpFile(p) for p in discover(self.path)]

    def read(self, partition: DumpFile) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        schema = to_arrow_schema(flat_schema(SCHEMA))
        rows, size = [], 0
        with open_bytes(partition.path) as stream:
            for row in revisions(stream, self.limit):
                rows.append(row | {"file": partition.path})
                size += len(row["text"] or "")
                if len(rows) >= BATCH_ROWS or size >= BATCH_BYTES:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)
                    rows, size = [], 0
        yield pa.RecordBatch.from_pylist(rows, schema=schema)


class WikiHistory(DataSource):
    """Options: ``path`` (comma-separated .xml, .xml.gz or .7z files or globs), ``limit`` (rows of each file)."""

    @classmethod
    def name(cls) -> str:
        return "wikihistory"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> HistoryReader:
        return HistoryReader(self.options["path"], _int(self.options.get("limit")))


def read_history(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    ensure_importable(spark)
    spark.dataSource.register(WikiHistory)
    reader = spark.read.format("wikihistory").option("path", path)
    return (reader if limit is None else reader.option("limit", str(limit))).load()
