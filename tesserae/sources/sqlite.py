"""SQLite tables as a Spark data source, read by row-id ranges."""

from __future__ import annotations

import sqlite3
import uuid
from collections.abc import Iterator

from pyspark import TaskContext
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

KINDS = {"INTEGER": "bigint", "BIGINT": "bigint", "INT": "bigint", "REAL": "double", "DOUBLE": "double", "FLOAT": "double", "BLOB": "binary"}


def _quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


class RowRange(InputPartition):
    def __init__(self, low: int, high: int) -> None:
        super().__init__(None)
        self.low, self.high = low, high


class SqliteReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict) -> None:
        self.schema, self.options = schema, options

    def partitions(self) -> list[RowRange]:
        with sqlite3.connect(self.options["path"]) as con:
            low, high = con.execute(f"SELECT min(rowid), max(rowid) FROM {_quoted(self.options['table'])}").fetchone()
        if low is None:
            return [RowRange(0, -1)]
        step = int(self.options.get("rowsperpartition", 200_000))
        return [RowRange(a, min(a + step, high + 1)) for a in range(low, high + 1, step)]

    def read(self, partition: RowRange) -> Iterator[tuple]:
        names = ", ".join(_quoted(f.name) for f in self.schema.fields)
        with sqlite3.connect(self.options["path"]) as con:
            yield from con.execute(f"SELECT {names} FROM {_quoted(self.options['table'])} WHERE rowid >= ? AND rowid < ?", (partition.low, partition.high))


class Staged(WriterCommitMessage):
    def __init__(self, name: str) -> None:
        self.name = name


class SqliteWriter(DataSourceWriter):
    """Each task fills a table of its own, which a second try begins anew; the commit moves them all in one transaction."""

    def __init__(self, schema: StructType, options: dict, overwrite: bool) -> None:
        self.schema, self.options, self.overwrite = schema, options, overwrite
        self.run = uuid.uuid4().hex

    def _connect(self) -> sqlite3.Connection:
        return sqlite3.connect(self.options["path"], timeout=600)

    def _create(self, con: sqlite3.Connection, name: str, again: str = "") -> None:
        kinds = {"bigint": "INTEGER", "int": "INTEGER", "double": "REAL", "binary": "BLOB"}
        con.execute(f"CREATE TABLE {again} {_quoted(name)} ({', '.join(_quoted(f.name) + ' ' + kinds.get(f.dataType.simpleString(), 'TEXT') for f in self.schema.fields)})")

    def write(self, iterator: Iterator[Row]) -> Staged:
        name = f"staged_{self.run}_{TaskContext.get().partitionId()}"
        con = self._connect()
        with con:
            con.execute(f"DROP TABLE IF EXISTS {_quoted(name)}")
            self._create(con, name)
            con.executemany(f"INSERT INTO {_quoted(name)} VALUES ({', '.join('?' * len(self.schema.fields))})", (tuple(r) for r in iterator))
        con.close()
        return Staged(name)

    def commit(self, messages: list) -> None:
        target = self.options["table"]
        con = self._connect()
        with con:
            con.execute("BEGIN")
            if self.overwrite:
                con.execute(f"DROP TABLE IF EXISTS {_quoted(target)}")
            self._create(con, target, "IF NOT EXISTS")
            for m in messages:
                if m is not None:
                    con.execute(f"INSERT INTO {_quoted(target)} SELECT * FROM {_quoted(m.name)}")
                    con.execute(f"DROP TABLE {_quoted(m.name)}")
            for column in filter(None, self.options.get("index", "").split(",")):
                con.execute(f"CREATE INDEX IF NOT EXISTS {_quoted(f'idx_{target}_{column}')} ON {_quoted(target)} ({_quoted(column)})")
        con.close()

    def abort(self, messages: list) -> None:
        con = self._connect()
        with con:
            for (name,) in con.execute("SELECT name FROM sqlite_master WHERE name LIKE ?", (f"staged_{self.run}_%",)).fetchall():
                con.execute(f"DROP TABLE {_quoted(name)}")
        con.close()


class SqliteSource(DataSource):
    """format("sqlite"), options path and table, for writing also index; the file must lie where all executors see it."""

    @classmethod
    def name(cls) -> str:
        return "sqlite"

    def schema(self) -> str:
        with sqlite3.connect(self.options["path"]) as con:
            cols = con.execute(f"PRAGMA table_info({_quoted(self.options['table'])})").fetchall()
        if not cols:
            raise ValueError(f"no table {self.options['table']}")
        return ", ".join(f"`{c[1]}` {KINDS.get(c[2].upper().split('(')[0], 'string')}" for c in cols)

    def reader(self, schema: StructType) -> SqliteReader:
        return SqliteReader(schema, dict(self.options))

    def writer(self, schema: StructType, overwrite: bool) -> SqliteWriter:
        return SqliteWriter(schema, dict(self.options), overwrite)


def read_sqlite(spark: SparkSession, path: str, table: str) -> DataFrame:
    spark.dataSource.register(SqliteSource)
    return spark.read.format("sqlite").option("path", path).option("table", table).load()


def write_sqlite(df: DataFrame, path: str, table: str, mode: str = "append", index: tuple[str, ...] = ()) -> None:
    """df appended to a table, or in place of it, with an index for each column named."""
    df.sparkSession.dataSource.register(SqliteSource)
    df.write.format("sqlite").mode(mode).option("path", path).option("table", table).option("index", ",".join(index)).save()
