"""GeoParquet output.

Spark's Parquet writer cannot add the footer entry that makes a file
GeoParquet. This data source lets each task write its own file with the entry:
geometry types and bounding box describe that file, so readers can skip it.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    WriterCommitMessage,
)

from reachgrid.functions.geometry import BOUNDS, curve_place, geometry_bounds
from reachgrid.functions.wkb import TYPE_NAMES, read
from reachgrid.schema import BOX, GEOMETRY, require_columns
from reachgrid.sources.tables import list_names, qualified

# Versions and names of the file format.
VERSION = "1.0.0"
COVERING_VERSION = "1.1.0"
FORMAT = "geoparquet"

# Files that the commit moves at a time.
MOVES = 32

# Batches are gathered up to this size, so that row groups are worth a read.
ROW_GROUP_BYTES = 64 * 1024 * 1024


class FileInfo:
    """Geometry types and bounding box of the rows written so far."""

    def __init__(self):
        self.types: set[str] = set()
        self.box: tuple | None = None

    def add(self, column: pa.ChunkedArray) -> None:
        for chunk in column.chunks:
            shapes = read(chunk)
            self.types.update(TYPE_NAMES[k] for k in np.unique(shapes.kinds()).tolist() if k)
            boxes = shapes.boxes()
            boxes = boxes[~np.isnan(boxes[:, 0])]
            if len(boxes):
                box = (*boxes[:, :2].min(0).tolist(), *boxes[:, 2:].max(0).tolist())
                self.box = box if self.box is None else _join(self.box, box)

    def footer(self, column: str, covering: bool = False) -> bytes:
        # Without a CRS entry the format means WGS84 longitude and latitude.
        entry: dict = {"encoding": "WKB", "geometry_types": sorted(self.types)}
        if self.box is not None:
            entry["bbox"] = list(self.box)
        if covering:
            entry["covering"] = {BOX: {side: [BOX, side] for side in BOUNDS}}
        version = COVERING_VERSION if covering else VERSION
        return json.dumps(
            {"version": version, "primary_column": column, "columns": {column: entry}}
        ).encode()


def _row_groups(batches: Iterable[pa.RecordBatch], group_bytes: int) -> Iterator[pa.Table]:
    """The batches in tables of about the size of a row group."""
    waiting, size = [], 0
    for batch in batches:
        parts = max(1, -(-batch.nbytes // group_bytes))
        step = max(1, -(-batch.num_rows // parts))
        for at in range(0, batch.num_rows, step):
            part = batch.slice(at, step)
            waiting.append(part)
            size += part.nbytes
            if size >= group_bytes:
                yield pa.Table.from_batches(waiting)
                waiting, size = [], 0
    if waiting:
        yield pa.Table.from_batches(waiting)


def _join(a: tuple, b: tuple) -> tuple:
    return (min(a[0], b[0]), min(a[1], b[1]), max(a[2], b[2]), max(a[3], b[3]))


@dataclass
class _Written(WriterCommitMessage):
    name: str | None


class _Writer(DataSourceArrowWriter):
    """Each task writes under a name of its own into a pending folder; the
    commit moves the files of the successful attempts into place."""

    def __init__(self, path: str, schema, overwrite: bool, options: dict):
        self.path = path.rstrip("/")
        self.schema = schema
        self.overwrite = overwrite
        self.column = options.get("geometry", GEOMETRY)
        self.codec = options.get("compression", "snappy")
        self.covering = options.get("covering") == "true"
        self.group_bytes = int(options.get("groupbytes", ROW_GROUP_BYTES))
        self.pending = f"{self.path}/_pending-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        filesystem, folder = resolve(self.pending)
        filesystem.create_dir(folder, recursive=True)
        name = f"part-{uuid.uuid4().hex}.parquet"
        writer, info = None, FileInfo()
        try:
            for table in _row_groups(iterator, self.group_bytes):
                if writer is None:
                    writer = pq.ParquetWriter(
                        f"{folder}/{name}",
                        table.schema,
                        filesystem=filesystem,
                        compression=self.codec,
                    )
                info.add(table.column(self.column))
                writer.write_table(table)
            if writer is not None:
                writer.add_key_value_metadata({"geo": info.footer(self.column, self.covering)})
        finally:
            if writer is not None:
                writer.close()
        return _Written(name if writer is not None else None)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        filesystem, target = resolve(self.path)
        _, pending = resolve(self.pending)
        filesystem.create_dir(target, recursive=True)
        names = [m.name for m in messages if m is not None and m.name]
        # a late attempt writes into the pending folder, where nobody reads it
        with ThreadPoolExecutor(MOVES) as pool:
            if self.overwrite:
                found = filesystem.get_file_info(pafs.FileSelector(target))
                old = [entry.path for entry in found if entry.is_file]
                list(pool.map(filesystem.delete_file, old))
            if not names:
                self._write_empty(filesystem, target)
            list(
                pool.map(
                    lambda name: filesystem.move(f"{pending}/{name}", f"{target}/{name}"),
                    names,
                )
            )
        self._drop_pending(filesystem, pending)

    def _write_empty(self, filesystem, target: str) -> None:
        from pyspark.sql.pandas.types import to_arrow_schema

        schema = to_arrow_schema(self.schema).with_metadata(
            {"geo": FileInfo().footer(self.column, self.covering)}
        )
        pq.write_table(
            schema.empty_table(),
            f"{target}/part-{uuid.uuid4().hex}.parquet",
            filesystem=filesystem,
        )

    def _drop_pending(self, filesystem, pending: str) -> None:
        if filesystem.get_file_info(pending).type != pafs.FileType.NotFound:
            filesystem.delete_dir(pending)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        filesystem, pending = resolve(self.pending)
        self._drop_pending(filesystem, pending)


def resolve(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a full URI or an absolute path; raises where pyarrow
    knows no such file system. What Hadoop calls s3a or s3n is s3 there."""
    scheme, mark, rest = uri.partition("://")
    if mark and scheme in ("s3a", "s3n"):
        uri = f"s3://{rest}"
    elif not mark:
        uri = uri.removeprefix("file:")
    return pafs.FileSystem.from_uri(uri)


def full_path(spark: SparkSession, path: str) -> str:
    """The path with its file system, as Spark's own writers complete it. Raises,
    before anything is written, if tasks could not write there."""
    full = qualified(spark, path)
    resolve(full)
    return full


class GeoParquet(DataSource):
    """``df.write.format("geoparquet")`` with options path, geometry, codec."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return _Writer(self.options["path"], schema, overwrite, self.options)


def write_geoparquet(
    df: DataFrame,
    path: str,
    column: str = GEOMETRY,
    compression: str = "SNAPPY",
    mode: str = "overwrite",
    covering: bool = False,
    group_bytes: int = ROW_GROUP_BYTES,
) -> None:
    """Write a table with a WKB column as a folder of GeoParquet files.

    With ``covering`` the rows are sorted along a curve through their places, and a
    column ``bbox`` with the box of each is added, which the footers name as its
    covering: a reader by box then skips files and row groups.
    """
    require_columns(df, [column])
    path = full_path(df.sparkSession, path)
    df.sparkSession.dataSource.register(GeoParquet)
    if covering:
        box = geometry_bounds(F.col(column)).dropFields("type")
        df = df.withColumn(BOX, box).withColumn("_place", curve_place(F.col(BOX)))
        df = df.repartitionByRange("_place").sortWithinPartitions("_place").drop("_place")
    (
        df.write.format(FORMAT)
        .mode(mode)
        .option("geometry", column)
        .option("compression", compression.lower())
        .option("covering", str(covering).lower())
        .option("groupBytes", group_bytes)
        .save(path)
    )


def geo_entries(spark: SparkSession, path: str) -> DataFrame:
    """``file, version, primary_column, encoding, geometry_types, bbox, covering`` of
    the files of a folder, from their footers, which the tasks read."""
    full = full_path(spark, path)
    names = [n for n in list_names(spark, full) if n.endswith(".parquet")]
    files = spark.createDataFrame([(f"{full}/{n}",) for n in names], "file string")

    def footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for file in batch["file"].to_pylist():
                system, place = resolve(file)
                with system.open_input_file(place) as source:
                    geo = json.loads(pq.ParquetFile(source).metadata.metadata[b"geo"])
                primary = geo["primary_column"]
                entry = geo["columns"][primary]
                rows.append({
                    "file": file, "version": geo["version"], "primary_column": primary,
                    "encoding": entry["encoding"], "geometry_types": entry["geometry_types"],
                    "bbox": entry.get("bbox"), "covering": "covering" in entry,
                })
            yield pa.RecordBatch.from_pylist(rows, schema)

    text, number = pa.string(), pa.float64()
    schema = pa.schema([
        ("file", text), ("version", text), ("primary_column", text), ("encoding", text),
        ("geometry_types", pa.list_(text)), ("bbox", pa.list_(number)), ("covering", pa.bool_()),
    ])
    return files.mapInArrow(
        footers,
        "file string, version string, primary_column string, encoding string, "
        "geometry_types array<string>, bbox array<double>, covering boolean",
    )
