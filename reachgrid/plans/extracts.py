"""Extracts of the travel-time tables: by area, by hospital, or everything.

A run writes a Parquet snapshot: the selected travel times, the filter list
that selected them and the supporting tables. Running it again overwrites what
it computes, so an extract never mixes two lists. An extract into the folder it
reads leaves the tables there as they are.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from reachgrid.operators.filters import (
    filter_by_cells,
    filter_by_hospitals,
    geofilter_cells,
    match_template,
    unmatched_template_rows,
    within,
)
from reachgrid.operators.quality import table_counts
from reachgrid.schema import (
    ADMIN_UNITS,
    CELL,
    CELL_MUNICIPALITY,
    CELL_PEOPLE,
    GEOMETRY,
    GEOMETRY_TABLES,
    HOSPITAL,
    LARGE_TABLES,
    SUPPORT_TABLES,
    TRAVEL_TIMES,
    TRAVEL_TIMES_SUBSET,
)
from reachgrid.sinks.lists import write_list
from reachgrid.sinks.parquet import CHUNK_ROWS, export_all_tables, write_parquet
from reachgrid.sources.lists import (
    read_hospital_list,
    read_municipality_list,
    read_template,
)
from reachgrid.sources.tables import Snapshot, Source, qualified

# Tables that an extract computes from.
INPUT_TABLES = (ADMIN_UNITS, CELL_MUNICIPALITY, CELL_PEOPLE, TRAVEL_TIMES, *SUPPORT_TABLES)


@dataclass(frozen=True)
class Extract:
    """What a run wrote: the folder, a path per table and the row counts."""

    output_dir: str
    written: dict[str, str]
    table_counts: DataFrame


def preprocess_geofilter_list(
    spark: SparkSession, template_csv: str, source: Source, output_csv: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Municipalities a template names, and the template rows that name none."""
    template = read_template(spark, template_csv)
    units = source.table(spark, ADMIN_UNITS)
    matched = match_template(template, units)
    if output_csv is not None:
        write_list(matched, output_csv)
    return matched, unmatched_template_rows(template, units)


def _in_place(spark: SparkSession, source: Source, output_dir: str) -> bool:
    """Whether an extract goes into the folder that it reads."""
    return isinstance(source, Snapshot) and qualified(spark, source.path) == qualified(
        spark, output_dir
    )


def _keep_inputs(
    spark: SparkSession, source: Source, output_dir: str, computed: Iterable[str]
) -> None:
    """Raise, before anything is written, if a computed table would replace an input."""
    if _in_place(spark, source, output_dir):
        lost = sorted({*computed} & {*INPUT_TABLES})
        if lost:
            raise ValueError(f"The extract would overwrite its input: {', '.join(lost)}")


def _write_filter(
    spark: SparkSession, keys: DataFrame, output_dir: str, name: str, compression: str
) -> tuple[str, DataFrame]:
    """Write the filter list first; the selection then reads it back."""
    path = f"{output_dir.rstrip('/')}/{name}.parquet"
    write_parquet(keys, path, compression)
    return path, spark.read.schema(keys.schema).parquet(path)


def _sieved(spark: SparkSession, source: Source, keys: DataFrame, column: str) -> DataFrame:
    """Travel times to be joined with keys; of a snapshot only row groups that may hold
    one are read."""
    times = source.table(spark, TRAVEL_TIMES)
    return within(times, keys, column) if isinstance(source, Snapshot) else times


def _write_extract(
    spark: SparkSession,
    source: Source,
    output_dir: str,
    filters: dict[str, str],
    selected: dict[str, DataFrame],
    support: Iterable[str],
    geometry_tables: Iterable[str],
    geometry_column: str,
    compression: str,
    chunk_size: int,
    large_tables: Iterable[str],
    clustered: bool = False,
) -> Extract:
    support = list(support)
    kept = {}
    if _in_place(spark, source, output_dir):
        # the tables are there already, and would be read while they are replaced
        kept = {n: source.folder(spark, n) for n in support}
    tables = {**selected, **{n: source.table(spark, n) for n in support if n not in kept}}
    written = filters | kept | export_all_tables(
        tables,
        output_dir,
        large_tables=large_tables,
        geometry_tables=geometry_tables,
        geometry_column=geometry_column,
        compression=compression,
        chunk_size=chunk_size,
        clustered=clustered,
    )
    # Counting the written files reads their footers, not the source again.
    result = Snapshot(output_dir)
    counts = table_counts({n: result.table(spark, n) for n in written})
    return Extract(output_dir, written, counts)


def run_geofilter(
    spark: SparkSession,
    municipality_csv: str,
    source: Source,
    output_dir: str,
    relevant_tables: Iterable[str] = SUPPORT_TABLES,
    tables_to_copy: Iterable[str] | None = None,
    geometry_tables: Iterable[str] = GEOMETRY_TABLES,
    geometry_column: str = GEOMETRY,
    filter_table_name: str = "Geofilter",
    target_table_name: str = TRAVEL_TIMES_SUBSET,
    compression: str = "SNAPPY",
    chunk_size: int = CHUNK_ROWS,
) -> Extract:
    """Travel times from the inhabited cells of the listed municipalities."""
    _keep_inputs(spark, source, output_dir, [filter_table_name, target_table_name])
    municipalities = read_municipality_list(spark, municipality_csv)
    cells = geofilter_cells(
        municipalities,
        source.table(spark, ADMIN_UNITS),
        source.table(spark, CELL_MUNICIPALITY),
        source.table(spark, CELL_PEOPLE),
    )
    path, cells = _write_filter(
        spark, cells, output_dir, filter_table_name, compression
    )
    times = _sieved(spark, source, cells, CELL)
    subset = filter_by_cells(times, cells)
    return _write_extract(
        spark,
        source,
        output_dir,
        {filter_table_name: path},
        {target_table_name: subset},
        relevant_tables if tables_to_copy is None else tables_to_copy,
        geometry_tables,
        geometry_column,
        compression,
        chunk_size,
        {*LARGE_TABLES, target_table_name},
    )


def geofilter(
    spark: SparkSession,
    template_csv: str,
    source: Source,
    output_dir: str,
    preprocessed_csv: str,
    **options,
) -> Extract:
    """Clean a template and extract the travel times of its municipalities."""
    preprocess_geofilter_list(spark, template_csv, source, preprocessed_csv)
    return run_geofilter(spark, preprocessed_csv, source, output_dir, **options)


def klinikfilter(
    spark: SparkSession,
    hospital_csv: str,
    source: Source,
    output_dir: str,
    relevant_tables: Iterable[str] = SUPPORT_TABLES,
    tables_to_copy: Iterable[str] | None = None,
    geometry_tables: Iterable[str] = GEOMETRY_TABLES,
    geometry_column: str = GEOMETRY,
    filter_table_name: str = "Klinikfilter",
    target_table_name: str = TRAVEL_TIMES_SUBSET,
    compression: str = "SNAPPY",
    chunk_size: int = CHUNK_ROWS,
    dedupe_keys: bool = False,
) -> Extract:
    """Travel times to the listed hospitals."""
    _keep_inputs(spark, source, output_dir, [filter_table_name, target_table_name])
    hospitals = read_hospital_list(spark, hospital_csv).select(HOSPITAL)
    path, hospitals = _write_filter(
        spark, hospitals, output_dir, filter_table_name, compression
    )
    times = _sieved(spark, source, hospitals, HOSPITAL)
    subset = filter_by_hospitals(times, hospitals, dedupe_keys)
    return _write_extract(
        spark,
        source,
        output_dir,
        {filter_table_name: path},
        {target_table_name: subset},
        relevant_tables if tables_to_copy is None else tables_to_copy,
        geometry_tables,
        geometry_column,
        compression,
        chunk_size,
        {*LARGE_TABLES, target_table_name},
    )


def komplettexport(
    spark: SparkSession,
    source: Source,
    output_dir: str,
    relevant_tables: Iterable[str] | str = "all",
    geometry_tables: Iterable[str] = GEOMETRY_TABLES,
    geometry_column: str = GEOMETRY,
    compression: str = "SNAPPY",
    chunk_size: int = CHUNK_ROWS,
    clustered: bool = False,
) -> Extract:
    """Every table of a source as a snapshot, travel times clustered on request."""
    names = source.tables(spark) if relevant_tables == "all" else relevant_tables
    return _write_extract(
        spark,
        source,
        output_dir,
        {},
        {},
        names,
        geometry_tables,
        geometry_column,
        compression,
        chunk_size,
        LARGE_TABLES,
        clustered,
    )
