"""Marks on tables that were written to the end.

A folder may exist without its table: a run that was lost leaves the files of some
tasks, or only a temporary folder. So the last thing written beside a table is a mark
with its number of rows and its schema, and a folder counts as a table only if
both are what is found there.
"""

from __future__ import annotations

import json

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from reachgrid.sources.tables import path_exists

# Spark and other readers of a folder pass over names that begin so.
MARK = "_complete.json"
COMMITTED = "_SUCCESS"


def _file(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _fields(schema: T.StructType) -> list[list[str]]:
    """Names and types; whether a column may be missing is up to the writer."""
    return [[f.name, f.dataType.simpleString()] for f in schema]


def _found(spark: SparkSession, path: str) -> dict | None:
    """Rows and columns of what lies there, from the footers; None if nothing does."""
    try:
        df = spark.read.parquet(path)
        return {"rows": df.count(), "columns": _fields(df.schema)}
    except (PySparkException, Py4JJavaError):
        return None


def mark_complete(spark: SparkSession, path: str, rows: int | None = None) -> None:
    """Mark a table that has just been written. With ``rows``, the number that should
    be there, another number raises."""
    found = _found(spark, path)
    if found is None or rows not in (None, found["rows"]):
        raise RuntimeError(f"Incomplete table: {path}")
    target, system = _file(spark, f"{path.rstrip('/')}/{MARK}")
    out = system.create(target, True)
    out.write(bytearray(json.dumps(found).encode()))
    out.close()


def read_mark(spark: SparkSession, path: str) -> dict | None:
    """The mark beside a table; None if there is none that can be read."""
    target, system = _file(spark, f"{path.rstrip('/')}/{MARK}")
    if not system.exists(target):
        return None
    length = system.getFileStatus(target).getLen()
    stream = system.open(target)
    try:
        text = bytes(stream.readNBytes(int(length))).decode()
        return json.loads(text)
    except (ValueError, Py4JJavaError):
        return None
    finally:
        stream.close()


def is_complete(spark: SparkSession, path: str, like: DataFrame | None = None) -> bool:
    """Whether a folder holds a whole table, with the columns of ``like`` if it is given.

    A table with a mark has the rows and columns of its mark. Tables of other writers
    have none: a folder is whole if its job was committed, a single file if it can be
    read, as its footer comes last.
    """
    if not path_exists(spark, path):
        return False
    target, system = _file(spark, path)
    mark = read_mark(spark, path) if system.getFileStatus(target).isDirectory() else None
    if mark is None and system.getFileStatus(target).isDirectory():
        if not path_exists(spark, f"{path.rstrip('/')}/{COMMITTED}"):
            return False
    found = _found(spark, path)
    if found is None or (mark is not None and mark != found):
        return False
    return like is None or sorted(found["columns"]) == sorted(_fields(like.schema))
