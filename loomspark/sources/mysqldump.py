"""``spark.read.format("mysqldump")``: one table of a SQL dump, a partition a file.

A gzip stream can only be read from its start, and parsing is the slow part of it.  So with
``spread`` one task a file unpacks the statements only, and all tasks parse them; a plain file is
cut into ranges of bytes, each of which starts at the first line after its border.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from loomspark.functions.mysql import converter, created_columns, insert_payload, value_tuples
from loomspark.schemas import TABLES, Table
from loomspark.session import ensure_importable, written

from .files import discover, lines, ranges

BATCH_ROWS = 10_000
#: Bytes of statements in a batch, and of a plain file's range.
BATCH_BYTES, RANGE_BYTES = 8 << 20, 64 << 20
#: Row groups of written statements: a reader unpacks 4,096 rows or a whole group at once, and statements are long.  The
#: size is that of packed pages and counts at every row, so a group unpacks to some ``BATCH_BYTES``.
SHORT_GROUPS = {"parquet.block.size": str(BATCH_BYTES // 4), "parquet.page.size.row.check.min": "1", "parquet.enable.dictionary": "false"}


class DumpFile(InputPartition):
    def __init__(self, path: str):
        super().__init__(path)
        self.path = path


class MysqlDumpReader(DataSourceReader):
    def __init__(self, table: str, path: str):
        self.table, self.path = TABLES[table], path

    def partitions(self) -> list[DumpFile]:
        return [DumpFile(p) for p in discover(self.path)]

    def read(self, partition: DumpFile) -> Iterator[pa.RecordBatch]:
        return parsed(lines(partition.path), self.table)


def parsed(statements: Iterator[str], table: Table) -> Iterator[pa.RecordBatch]:
    """The typed rows of all inserts into a table, in batches."""
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = table.schema
    arrow = to_arrow_schema(schema)
    convert = converter(table.dump, [(f.name, f.dataType.simpleString()) for f in schema])
    rows: list[tuple] = []
    for line in statements:
        payload = insert_payload(line, table.name)
        for row in value_tuples(payload) if payload else ():
            rows.append(convert(row))
            if len(rows) >= BATCH_ROWS:
                yield _batch(rows, arrow)
                rows = []
    yield _batch(rows, arrow)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


class MysqlDump(DataSource):
    """Options: ``table`` (one of the dump tables) and ``path`` (comma-separated files or globs).

    Inserts into other tables and those with a column list are passed over; anything
    that is not a value list fails the task.
    """

    @classmethod
    def name(cls) -> str:
        return "mysqldump"

    def _table(self) -> str:
        table = self.options.get("table", "")
        if table not in TABLES or not TABLES[table].dump:
            raise ValueError(f"no dump table named {table!r}")
        return table

    def schema(self):
        return TABLES[self._table()].schema

    def reader(self, schema) -> MysqlDumpReader:
        return MysqlDumpReader(self._table(), self.options["path"])


class FileRange(InputPartition):
    def __init__(self, path: str, start: int, stop: int | None):
        super().__init__((path, start, stop))
        self.path, self.start, self.stop = path, start, stop


class StatementReader(DataSourceReader):
    def __init__(self, table: str, path: str, size: int):
        self.table, self.path, self.size = table, path, size

    def partitions(self) -> list[FileRange]:
        return [FileRange(p, a, b) for p in discover(self.path) for a, b in ranges(p, self.size)]

    def read(self, partition: FileRange) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for line in lines(partition.path, partition.start, partition.stop):
            if insert_payload(line, self.table):
                held.append(line.encode("latin-1"))
                size += len(line)
                if size >= BATCH_BYTES:
                    yield _statements(held)
                    held, size = [], 0
        yield _statements(held)


def _statements(held: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(held, pa.binary())], names=["statement"])


class DumpStatements(DataSource):
    """The inserts of one table as they stand, unparsed.  Options: ``table``, ``path`` and ``range_bytes``."""

    @classmethod
    def name(cls) -> str:
        return "dumpstatements"

    def schema(self) -> str:
        return "statement binary"

    def reader(self, schema) -> StatementReader:
        return StatementReader(self.options["table"], self.options["path"], int(self.options.get("range_bytes", RANGE_BYTES)))


def spread_dump(spark: SparkSession, table: str, path: str, parts: int, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """The typed table, parsed by ``parts`` tasks; the statements are written once, so no lost executor unpacks a file again."""
    ensure_importable(spark)
    spark.dataSource.register(DumpStatements)
    raw = spark.read.format("dumpstatements").option("table", table).option("path", path).option("range_bytes", range_bytes).load()
    dealt = written(raw.repartition(parts), f"statements-{table}", **SHORT_GROUPS)
    known = TABLES[table]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # one statement at a time leaves Arrow's memory
        return parsed((v.as_py().decode("latin-1") for b in batches for v in b.column(0)), known)

    return dealt.mapInArrow(run, known.schema)


def read_dump(spark: SparkSession, table: str, path: str, check: bool = True, spread: int | None = None) -> DataFrame:
    """The typed table, with ``spread`` parsed by so many tasks.  A dump whose own column order differs from the known one warns."""
    ensure_importable(spark)
    spark.dataSource.register(MysqlDump)
    if check:
        for file in discover(path):
            found = created_columns(lines(file), table)
            if found and tuple(found) != TABLES[table].dump:
                warnings.warn(f"{file}: columns of {table} are {found}, not {list(TABLES[table].dump)}", stacklevel=2)
    if spread:
        return spread_dump(spark, table, path, spread)
    return spark.read.format("mysqldump").option("table", table).option("path", path).load()
