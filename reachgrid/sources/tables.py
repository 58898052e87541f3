"""Where the tables come from: a Parquet snapshot or a PostgreSQL database."""

from __future__ import annotations

import os
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reachgrid.schema import (
    BOX,
    CELL_MUNICIPALITY,
    CELL_PEOPLE,
    GEOMETRY,
    GEOMETRY_TABLES,
    TRAVEL_TIMES,
)
from reachgrid.functions.geometry import BOUNDS, geometry_bounds, normalise_geometry


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists on whatever file system its URI names."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return target.getFileSystem(conf).exists(target)


def list_names(spark: SparkSession, path: str) -> list[str]:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return sorted(s.getPath().getName() for s in target.getFileSystem(conf).listStatus(target))


def qualified(spark: SparkSession, path: str) -> str:
    """The full form of a path, with its file system."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return target.getFileSystem(conf).makeQualified(target).toString().rstrip("/")


def require_file_exists(spark: SparkSession, path: str) -> None:
    if not path_exists(spark, path):
        raise FileNotFoundError(f"File not found: {path}")


@dataclass(frozen=True)
class Snapshot:
    """A folder with one Parquet file, folder or chunk folder per table."""

    path: str

    def __post_init__(self):
        if not self.path:
            raise ValueError("path is required for a snapshot")

    def find(self, spark: SparkSession, name: str) -> str | None:
        """Where a table lies, whole or not; None if nowhere."""
        for candidate in (f"{name}.parquet", f"{name}_chunks", name):
            full = f"{self.path.rstrip('/')}/{candidate}"
            if path_exists(spark, full):
                return full
        return None

    def folder(self, spark: SparkSession, name: str) -> str:
        found = self.find(spark, name)
        if found is None:
            raise FileNotFoundError(f"File not found: {self.path}/{name}.parquet")
        return found

    def table(self, spark: SparkSession, name: str) -> DataFrame:
        return spark.read.parquet(self.folder(spark, name))

    def tables(self, spark: SparkSession) -> list[str]:
        require_file_exists(spark, self.path)
        found = set()
        for entry in list_names(spark, self.path):
            for suffix in (".parquet", "_chunks"):
                if entry.endswith(suffix):
                    found.add(entry.removesuffix(suffix))
        return sorted(found)


@dataclass(frozen=True)
class Postgres:
    """A schema of a PostgreSQL database, read over JDBC.

    Unset connection values come from the environment variables ``HOST``,
    ``PORT``, ``DB``, ``USER`` and ``PASSWORD``. The tables named in ``sliced`` are
    read in parallel slices of ``slice_blocks`` blocks of their file: each block is
    read once, whatever the keys are and without an index.
    """

    schema: str = "public"
    host: str | None = None
    port: int | None = None
    database: str | None = None
    user: str | None = None
    password: str | None = field(default=None, repr=False)
    sslmode: str = "prefer"
    fetch_size: int = 50_000
    slice_blocks: int = 65_536
    sliced: tuple[str, ...] = (TRAVEL_TIMES, CELL_MUNICIPALITY, CELL_PEOPLE)
    geometry_tables: tuple[str, ...] = GEOMETRY_TABLES
    geometry_column: str = GEOMETRY

    def options(self) -> dict[str, str]:
        env = os.environ
        host = self.host or env.get("HOST")
        port = self.port or env.get("PORT") or 5432
        database = self.database or env.get("DB")
        if not host or not database:
            raise ValueError("Could not connect to Postgres: HOST and DB must be set")
        return {
            "url": f"jdbc:postgresql://{host}:{port}/{database}?sslmode={self.sslmode}",
            "driver": "org.postgresql.Driver",
            "user": self.user or env.get("USER", ""),
            "password": self.password or env.get("PASSWORD", ""),
            "fetchsize": str(self.fetch_size),
        }

    def table_name(self, name: str) -> str:
        return f'"{self.schema}"."{name}"'

    def size_query(self, name: str) -> str:
        """SQL for the blocks of a table's file."""
        table = self.table_name(name).replace("'", "''")
        return (
            f"SELECT pg_relation_size('{table}'::regclass) "
            "/ current_setting('block_size')::bigint AS blocks"
        )

    def predicates(self, blocks: int) -> list[str]:
        """Disjoint conditions on the place of a row that cover every row; the last
        one is open, for rows added since the size was taken."""
        edges = list(range(0, max(blocks, 1), self.slice_blocks))
        lower = [f"ctid >= '({edge},0)'::tid" for edge in edges]
        upper = [f" AND ctid < '({edge},0)'::tid" for edge in edges[1:]]
        return [low + high for low, high in zip(lower, [*upper, ""])]

    def table(self, spark: SparkSession, name: str) -> DataFrame:
        options = self.options()
        if name in self.sliced:
            size = spark.read.format("jdbc").options(**options, query=self.size_query(name))
            url = options.pop("url")
            df = spark.read.jdbc(
                url,
                self.table_name(name),
                predicates=self.predicates(size.load().first()[0]),
                properties=options,
            )
        else:
            df = (
                spark.read.format("jdbc")
                .options(**options, dbtable=self.table_name(name))
                .load()
            )
        if name in self.geometry_tables and self.geometry_column in df.columns:
            df = normalise_geometry(df, self.geometry_column)
        return df

    def tables(self, spark: SparkSession) -> list[str]:
        names = (
            spark.read.format("jdbc")
            .options(**self.options(), dbtable="information_schema.tables")
            .load()
            .filter(F.col("table_schema") == self.schema)
            .filter(F.col("table_type") == "BASE TABLE")
            .select("table_name")
        )
        # One row per table of a schema: a catalogue listing, not data.
        return sorted(row[0] for row in names.toLocalIterator())


Source = Snapshot | Postgres


def make_source(kind: str = "postgres", path: str | None = None, **options) -> Source:
    """The source of a run: ``"postgres"`` or ``"snapshot"`` with its path."""
    if kind == "postgres":
        return Postgres(**options)
    if kind == "snapshot":
        if path is None:
            raise ValueError("path is required when kind = 'snapshot'")
        return Snapshot(path, **options)
    raise ValueError(f"source must be 'postgres' or 'snapshot', got: {kind}")


def read_geoparquet(
    spark: SparkSession,
    path: str,
    box: tuple[float, float, float, float] | None = None,
) -> DataFrame:
    """A GeoParquet folder or file; the geometry is a WKB binary column.

    ``box`` (west, south, east, north) keeps geometries whose boxes touch it. The scan
    skips row groups by it if the file holds the boxes, in a column that is not
    returned; without one they are measured.
    """
    require_file_exists(spark, path)
    df = spark.read.parquet(path)
    covered = dict(df.dtypes).get(BOX) == f"struct<{','.join(f'{b}:double' for b in BOUNDS)}>"
    if box is not None:
        west, south, east, north = (float(side) for side in box)
        own = F.col(BOX) if covered else geometry_bounds(F.col(GEOMETRY))
        df = df.filter(
            (own["xmin"] <= east) & (own["xmax"] >= west)
            & (own["ymin"] <= north) & (own["ymax"] >= south)
        )
    return df.drop(BOX) if covered else df


def read_chunks(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """All chunk files of a table below ``<folder>/<table>_chunks``."""
    chunks = f"{folder.rstrip('/')}/{table}_chunks"
    if not path_exists(spark, chunks) or not any(
        n.endswith(".parquet") for n in list_names(spark, chunks)
    ):
        raise FileNotFoundError("No chunk files found.")
    return spark.read.parquet(chunks)
