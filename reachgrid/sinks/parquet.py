"""Parquet output: plain, in chunks of bounded size, or routed per table."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from reachgrid.schema import CELL, GEOMETRY, GEOMETRY_TABLES, HOSPITAL, LARGE_TABLES
from reachgrid.sinks.complete import is_complete, mark_complete
from reachgrid.sinks.geoparquet import full_path, write_geoparquet
from reachgrid.sources.tables import Snapshot, Source

CHUNK_ROWS = 100_000_000

# Row groups of clustered tables are small, so that few of them are read in vain.
GROUP_BYTES = 16 * 1024 * 1024


def write_parquet(
    df: DataFrame, path: str, compression: str = "SNAPPY", mode: str = "overwrite"
) -> None:
    df.write.mode(mode).option("compression", compression.lower()).parquet(path)


def write_chunks(
    df: DataFrame,
    folder: str,
    table: str,
    compression: str = "SNAPPY",
    chunk_size: int = CHUNK_ROWS,
    mode: str = "overwrite",
) -> str:
    """Write ``<folder>/<table>_chunks`` with at most ``chunk_size`` rows a file.

    Every task cuts its own files, so the write runs in parallel; a table in
    one partition gives the fewest files possible.
    """
    path = f"{folder.rstrip('/')}/{table}_chunks"
    (
        df.write.mode(mode)
        .option("compression", compression.lower())
        .option("maxRecordsPerFile", chunk_size)
        .parquet(path)
    )
    return path


def write_clustered(
    df: DataFrame,
    folder: str,
    table: str,
    by: str = CELL,
    then: str = HOSPITAL,
    compression: str = "SNAPPY",
    chunk_size: int = CHUNK_ROWS,
    group_bytes: int = GROUP_BYTES,
) -> str:
    """``write_chunks`` with the rows in ranges of ``by``, then of ``then``.

    Files and row groups hold neighbouring values of ``by``, so that a scan of a few
    of them reads little, and dictionaries or Bloom filters of ``then``. All rows of a
    value of ``by`` lie side by side, in one task unless they are very many; a value
    that holds much of the table is cut by ``then``.
    """
    path = f"{folder.rstrip('/')}/{table}_chunks"
    (
        df.repartitionByRange(by, then)
        .sortWithinPartitions(by, then)
        .write.mode("overwrite")
        .option("compression", compression.lower())
        .option("maxRecordsPerFile", chunk_size)
        .option("parquet.block.size", group_bytes)
        .option(f"parquet.bloom.filter.enabled#{then}", "true")
        .option("parquet.bloom.filter.adaptive.enabled", "true")
        .parquet(path)
    )
    return path


def write_partitioned(
    df: DataFrame,
    path: str,
    by: str = "Bundesland",
    compression: str = "SNAPPY",
    max_rows_per_file: int = CHUNK_ROWS,
) -> None:
    """One folder per value of ``by``.

    Rows are rebalanced by value, which makes few files of a good size; a value
    that holds much of the table is split between tasks again.
    """
    (
        df.hint("rebalance", by)
        .write.mode("overwrite")
        .option("compression", compression.lower())
        .option("maxRecordsPerFile", max_rows_per_file)
        .partitionBy(by)
        .parquet(path)
    )


def export_all_tables(
    tables: dict[str, DataFrame],
    output_dir: str,
    large_tables: Iterable[str] = LARGE_TABLES,
    geometry_tables: Iterable[str] = GEOMETRY_TABLES,
    geometry_column: str = GEOMETRY,
    compression: str = "SNAPPY",
    chunk_size: int = CHUNK_ROWS,
    clustered: bool = False,
) -> dict[str, str]:
    """Write every table in the form it needs; the result names form and path. Tables
    are marked as they are finished. ``clustered`` writes travel times by cell and
    hospital (see ``write_clustered``)."""
    root = output_dir.rstrip("/")
    geometry_tables, large_tables = set(geometry_tables), set(large_tables)
    for name in geometry_tables.intersection(tables):
        full_path(tables[name].sparkSession, root)
    written = {}
    for name, df in tables.items():
        path = f"{root}/{name}.parquet"
        if name in geometry_tables:
            write_geoparquet(df, path, geometry_column, compression)
            written[name] = path
        elif clustered and {CELL, HOSPITAL}.issubset(df.columns):
            written[name] = write_clustered(
                df, root, name, compression=compression, chunk_size=chunk_size
            )
        elif name in large_tables:
            written[name] = write_chunks(df, root, name, compression, chunk_size)
        else:
            write_parquet(df, path, compression)
            written[name] = path
        mark_complete(df.sparkSession, written[name])
    return written


def copy_tables(
    spark: SparkSession, source: Source, target_dir: str, tables: Iterable[str] | str
) -> list[str]:
    """Copy tables into a snapshot; the ones it already has are left alone.

    ``"all"`` copies every table of the source. A table is there if it is whole (see
    ``complete``) and has the columns of the source; one that was written in part is
    written anew. Copies are counted while they are written and marked when all rows
    are there. Returns the copied names.
    """
    names = source.tables(spark) if tables == "all" else list(tables)
    target = Snapshot(target_dir.rstrip("/"))
    copied = []
    for name in names:
        df = source.table(spark, name)
        present = target.find(spark, name)
        if present is not None and is_complete(spark, present, df):
            continue
        path = present or f"{target.path}/{name}.parquet"
        rows = Observation()
        counted = df.observe(rows, F.count(F.lit(1)).alias("rows"))
        write_parquet(counted, path)
        mark_complete(spark, path, rows.get["rows"])
        copied.append(name)
    return copied
