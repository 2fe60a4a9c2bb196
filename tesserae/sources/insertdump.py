"""Tables from SQL dumps that consist of INSERT statements."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

COLUMN = re.compile(r"^\s*`(?P<name>[^`]+)`\s+(?P<kind>[a-z]+)", re.I)
STATEMENT = re.compile(r"^INSERT INTO `(?P<table>[^`]+)` (?:\([^)]*\) )?VALUES ", re.I)
VALUE = re.compile(r"""(?P<null>NULL)|(?P<hex>0x[0-9A-Fa-f]*)|(?P<number>-?[0-9][0-9.eE+-]*)|'(?P<text>(?:[^'\\]|\\.|'')*)'""", re.S)
ESCAPE = re.compile(r"\\(.)|''", re.S)
# What escapes stand for, and which kinds of column hold numbers.
ESCAPES = {"0": "\0", "b": "\b", "n": "\n", "r": "\r", "t": "\t", "Z": "\x1a"}
KINDS = {"int": "bigint", "bigint": "bigint", "smallint": "bigint", "mediumint": "bigint", "tinyint": "bigint", "double": "double", "float": "double"}


def schema_of(spark: SparkSession, path: str, table: str) -> T.StructType:
    """The columns that the dump's CREATE TABLE names: integers, doubles, and text for all else."""
    head = spark.read.text(path).where("not startswith(value, 'INSERT INTO')")
    lines = [r[0] for r in head.where(F.col("value").rlike(r"^(CREATE TABLE|\s*`|\) )")).collect()]  # as many as the dump's tables have columns
    out, inside = T.StructType(), False
    for line in lines:
        if line.upper().startswith("CREATE TABLE"):
            inside = f"`{table}`" in line
        elif line.startswith(")"):
            inside = False
        elif inside and (m := COLUMN.match(line)):
            kind = KINDS.get(m["kind"].lower(), "string")
            out.add(m["name"], {"bigint": T.LongType(), "double": T.DoubleType(), "string": T.StringType()}[kind])
    if not out.fields:
        raise ValueError(f"{path} creates no table {table}")
    return out


def _rows(line: str) -> Iterator[list]:
    """The tuples of one statement."""
    at = STATEMENT.match(line).end()
    row: list | None = None
    while at < len(line):
        c = line[at]
        if c == "(":
            row, at = [], at + 1
        elif c == ")":
            yield row
            row, at = None, at + 1
        elif row is None and c == ";":
            return
        elif c in ", ":
            at += 1
        else:
            m = VALUE.match(line, at)
            if not m or row is None:
                raise ValueError(f"no value at {at}: {line[at : at + 40]!r}")
            if m["null"]:
                row.append(None)
            elif m["text"] is not None:
                row.append(ESCAPE.sub(lambda e: "'" if e[0] == "''" else ESCAPES.get(e[1], e[1]), m["text"]))
            else:
                row.append(bytes.fromhex(m["hex"][2:]).decode("utf-8", "replace") if m["hex"] else m["number"])
            at = m.end()


def read_inserts(spark: SparkSession, path: str, table: str) -> DataFrame:
    """The rows of one table of a dump: each line with an INSERT is read by itself, so lines are spread over all tasks.

    Broken statements are an error. Compressed files that cannot be cut are
    read by one task each.
    """
    schema = schema_of(spark, path, table)
    casts = [{"bigint": int, "double": float}.get(f.dataType.simpleString(), str) for f in schema.fields]
    arrow = [pa.int64() if c is int else pa.float64() if c is float else pa.string() for c in casts]
    names = schema.names

    def parse(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for line in part.column(0).to_pylist():
                rows = list(_rows(line))
                yield pa.RecordBatch.from_arrays([pa.array([None if r[i] is None else c(r[i]) for r in rows], t) for i, (c, t) in enumerate(zip(casts, arrow))], names)

    lines = spark.read.text(path).where(F.startswith("value", F.lit(f"INSERT INTO `{table}` ")))
    return lines.mapInArrow(parse, schema)


def write_inserts(df: DataFrame, path: str, table: str, together: int = 1_000) -> None:
    """df as a dump, about `together` rows a statement."""

    def value(f: T.StructField):  # noqa: ANN202
        c = F.col(f.name).cast("string")
        if f.dataType.simpleString() not in ("bigint", "int", "double"):
            for a, b in (("\\", "\\\\"), ("'", "\\'"), ("\n", "\\n"), ("\r", "\\r")):
                c = F.replace(c, F.lit(a), F.lit(b))
            c = F.concat(F.lit("'"), c, F.lit("'"))
        return F.coalesce(c, F.lit("NULL"))

    rows = df.select(F.concat(F.lit("("), F.concat_ws(",", *[value(f) for f in df.schema.fields]), F.lit(")")).alias("row"), F.floor(F.monotonically_increasing_id() / together).alias("line"))
    inserts = rows.groupBy("line").agg(F.concat(F.lit(f"INSERT INTO `{table}` VALUES "), F.array_join(F.collect_list("row"), ","), F.lit(";")).alias("value")).select("value")
    kinds = {"bigint": "bigint(20)", "int": "int(11)", "double": "double"}
    create = [f"CREATE TABLE `{table}` (", *[f"  `{f.name}` {kinds.get(f.dataType.simpleString(), 'varbinary(255)')}," for f in df.schema.fields], ") ENGINE=InnoDB;"]
    head = df.sparkSession.createDataFrame([("\n".join(create),)], "value string")
    head.coalesce(1).unionByName(inserts).write.text(path)
