"""Talk-page messages: a signed stretch of lines is one message, indentation makes the thread."""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from loomspark.functions.wikitext import plain_text
from loomspark.session import ensure_importable

__all__ = ["messages", "plain_text", "register_talk", "talk_messages"]

#: What marks a heading and a signature (fixed patterns).
SECTION, AUTHOR, STAMP = re.compile(r"^==\s*(.+?)\s*=="), re.compile(r"\[\[User:(.+?)\|"), re.compile(r"(\d{2}:\d{2}, \d{1,2} \w+ \d{4}) \(UTC\)")

MESSAGE = "id int, section string, author string, stamp string, content string, reply_to int, indentation int"


def messages(text: str | None) -> Iterator[tuple]:
    """Rows of ``MESSAGE`` in page order; an unsigned tail gives none.

    The answered message is the nearest earlier one that is indented less.  The open
    ancestors form a stack, as a deeper message can never be answered past a shallower one.
    """
    pending: list[str] = []
    section, number = None, 0
    ancestors: list[tuple[int, int]] = []  # (indentation, id), indentation rising
    for line in (text or "").split("\n"):
        if found := SECTION.match(line):
            section = found.group(1)
        pending.append(line)
        author, stamp = AUTHOR.search(line), STAMP.search(line)
        if not (author and stamp):
            continue
        number += 1
        depth = len(line) - len(line.lstrip(":"))
        while ancestors and ancestors[-1][0] >= depth:
            ancestors.pop()
        parent = ancestors[-1][1] if ancestors and depth else None
        ancestors.append((depth, number))
        yield number, section, author.group(1), stamp.group(1), plain_text("\n".join(pending)), parent, depth
        pending = []


def talk_messages(pages: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id_col`` and the message columns, one row a message, by Arrow batches."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema

    ensure_importable(pages.sparkSession)
    kind = pages.schema[id_col].dataType.simpleString()
    ddl = f"`{id_col}` {kind}, {MESSAGE}"
    schema = to_arrow_schema(StructType.fromDDL(ddl))

    def run(batches):
        for batch in batches:
            rows = [(i, *m) for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) for m in messages(t)]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(schema)], schema=schema)

    return pages.select(id_col, F.col(text_col)).mapInArrow(run, ddl)


def register_talk(spark: SparkSession, name: str = "talk_messages") -> None:
    """A table function for lateral use in SQL: ``FROM pages, LATERAL talk_messages(text)``."""
    from pyspark.sql.functions import udtf

    class TalkMessages:
        def eval(self, text: str):
            yield from messages(text)

    spark.udtf.register(name, udtf(TalkMessages, returnType=MESSAGE))
