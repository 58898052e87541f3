"""One query per operator, each over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reachgrid.functions.geometry import geometry_bounds, normalise_geometry
from reachgrid.functions.text import (
    create_polygon_label,
    create_polygon_label_differenz,
    format_ewz,
    format_fahrtzeit,
    format_label_columns,
)
from reachgrid.operators import analyses
from reachgrid.operators.difference import difference_cells
from reachgrid.operators.filters import (
    filter_by_cells,
    filter_by_hospitals,
    geofilter_cells,
    match_template,
    unmatched_template_rows,
)
from reachgrid.operators.nearest import (
    COPIES,
    cell_units,
    minimum_times,
    nearest_hospitals,
    nearest_times,
    scenario_times,
)
from reachgrid.operators.publish import (
    UNIT_PROPERTIES,
    add_empty_scenario2_columns,
    build_scenario_properties,
    clinic_properties,
    join_properties_to_polygons,
)
from reachgrid.operators.quality import duplicate_keys, table_counts
from reachgrid.operators.summary import (
    compute_percentage_covered,
    filter_by_coverage,
    inhabited_cells,
    summarise_times,
    threshold_of_times,
)
from reachgrid.plans.extracts import geofilter, klinikfilter, komplettexport
from reachgrid.plans.history import compare_time_points, store_time_point
from reachgrid.plans.publish import (
    assemble_feature_collection,
    build_export_json,
    kliniken_to_geojson,
    szenario_to_geojson,
)
from reachgrid.plans.scenario import (
    scenario_all_levels,
    scenario_cells,
    scenario_difference,
    scenario_difference_cells,
    scenario_summary,
)
from reachgrid.schema import (
    ADMIN_UNITS,
    CELL_MUNICIPALITY,
    CELL_PEOPLE,
    GEOMETRY,
    HOSPITAL,
    LAYOUT_COMBINED,
    LAYOUT_SPLIT,
    TRAVEL_TIMES,
    TRAVEL_TIMES_SUBSET,
)
from reachgrid.session import scratch
from reachgrid.sinks.complete import mark_complete
from reachgrid.sinks.geoparquet import geo_entries, write_geoparquet
from reachgrid.sinks.lists import write_list
from reachgrid.sinks.parquet import (
    copy_tables,
    export_all_tables,
    write_chunks,
    write_parquet,
    write_partitioned,
)
from reachgrid.sources.lists import read_template
from reachgrid.sources.tables import Snapshot, list_names, read_chunks, read_geoparquet
from workload.model import Model

CREATED_AT = "2024-01-01T00:00:00Z"
TIMESTAMP = "2024-01-01T00:00:00.000Z"
CLOSURE_KEYS = ["Gitterzellen_ID", "Einwohner", "Kreis"]

Query = Callable[[SparkSession, str], DataFrame]


def rounded(df: DataFrame) -> DataFrame:
    """Floating columns at six decimals, so that sums compare across engines."""
    return df.withColumns(
        {
            f.name: F.round(F.col(f"`{f.name}`"), 6)
            for f in df.schema
            if isinstance(f.dataType, T.DoubleType)
        }
    )


def units(m: Model) -> DataFrame:
    """Every cell with inhabitants and administrative units."""
    return cell_units(m.cells_combined, m.admin_units)


# Sources and sinks


def snapshot_scan(m: Model) -> DataFrame:
    return Snapshot(m.folder).table(m.spark, "customer")


def parquet_roundtrip(m: Model) -> DataFrame:
    path = scratch(m.spark, "parquet")
    write_parquet(m.cells_combined, path, compression="GZIP")
    return m.spark.read.parquet(path)


def chunked_roundtrip(m: Model) -> DataFrame:
    folder = scratch(m.spark, "chunks")
    write_chunks(m.travel_times, folder, "Entfernungsdaten", chunk_size=20_000)
    return read_chunks(m.spark, folder, "Entfernungsdaten")


def geoparquet_roundtrip(m: Model) -> DataFrame:
    """Boxes of what was written, and what the footers of its files say."""
    path = scratch(m.spark, "geo")
    write_geoparquet(m.polygons, path)
    entries = geo_entries(m.spark, path).select(
        F.lit(True).alias("geo"), "version", "primary_column", "encoding",
        F.array_join("geometry_types", ",").alias("geometry_types"),
    )
    back = read_geoparquet(m.spark, path)
    boxes = back.select(
        F.lit(True).alias("geo"),
        "Gemeindeschluessel", "Gemeindename", geometry_bounds(F.col(GEOMETRY)).alias("b"),
    ).select("geo", "Gemeindeschluessel", "Gemeindename", "b.*")
    return boxes.join(entries.distinct(), "geo").drop("geo")


def geoparquet_box(m: Model) -> DataFrame:
    """Polygons that touch a box, from a file with boxes."""
    path = scratch(m.spark, "geo")
    write_geoparquet(m.polygons, path, covering=True)
    back = read_geoparquet(m.spark, path, box=(3.5, 8.2, 9, 9))
    return back.select(
        "Gemeindeschluessel", "Gemeindename", geometry_bounds(F.col(GEOMETRY)).alias("b")
    ).select("Gemeindeschluessel", "Gemeindename", "b.*")


def _model_tables(m: Model) -> dict[str, DataFrame]:
    return {
        "Entfernungsdaten": m.travel_times,
        "Gitterzellen_Gemeinde_Mapping": m.cell_municipality,
        "Gitterzellen_Einwohner_Mapping": m.cell_people,
        "Verwaltungsgebiete_Mapping": m.admin_units,
        "Krankenhaus_Standortliste": m.hospital_sites,
    }


def export_router(m: Model) -> DataFrame:
    folder = scratch(m.spark, "export")
    written = export_all_tables(_model_tables(m), folder)
    result = Snapshot(folder)
    return table_counts({n: result.table(m.spark, n) for n in written})


def copied_tables(m: Model) -> DataFrame:
    """Two tables first, then all: the second run leaves the first two alone."""
    folder = scratch(m.spark, "copy")
    source = Snapshot(m.folder)
    runs = [
        copy_tables(m.spark, source, folder, wanted)
        for wanted in (["customer", "lineitem"], "all", "all")
    ]
    copy = Snapshot(folder)
    counts = [
        table_counts({n: copy.table(m.spark, n) for n in names}).withColumn("lauf", F.lit(run))
        for run, names in enumerate(runs, 1)
        if names
    ]
    return reduce(DataFrame.unionByName, counts)


def write_spread(df: DataFrame, path: str) -> None:
    """Several files, however few rows there are; many rows are dealt out over as many
    tasks as their size asks for."""
    third = max(1, -(-df.count() // 3))  # from the footers
    df.hint("rebalance").write.option("maxRecordsPerFile", third).parquet(path)


def copy_repaired(m: Model) -> DataFrame:
    """Copies over what lost runs have left: a folder without files, a table of which
    files are missing, and whole tables, which stay."""
    folder = scratch(m.spark, "copy")
    source = Snapshot(m.folder)
    names = ["customer", "lineitem", "nation", "orders", "supplier"]
    copy_tables(m.spark, source, folder, names[2:])
    lost = m.spark._jvm.org.apache.hadoop.fs.Path
    system = lost(folder).getFileSystem(m.spark.sparkContext._jsc.hadoopConfiguration())
    system.mkdirs(lost(f"{folder}/customer.parquet/_temporary/0"))
    write_spread(m.raw("lineitem"), f"{folder}/lineitem.parquet")
    mark_complete(m.spark, f"{folder}/lineitem.parquet")
    parts = [n for n in list_names(m.spark, f"{folder}/lineitem.parquet") if n.startswith("part-")]
    system.delete(lost(f"{folder}/lineitem.parquet/{parts[0]}"), False)
    copied = copy_tables(m.spark, source, folder, names)
    copy = Snapshot(folder)
    counts = table_counts({n: copy.table(m.spark, n) for n in names})
    return counts.withColumn("kopiert", F.col("tabelle").isin(*copied))


def partitioned_export(m: Model) -> DataFrame:
    folder = scratch(m.spark, "partitioned")
    write_partitioned(m.admin_units, folder, "Bundesland")
    return m.spark.read.parquet(folder)


def _template_csv(m: Model) -> str:
    """The template as its users write it: separated by semicolons, without lines."""
    path = scratch(m.spark, "template")
    rows = m.template.drop("Zeile").write.option("header", True).option("sep", ";")
    rows.option("nullValue", "NA").csv(path)
    return path


def _model_snapshot(m: Model, clustered: bool = False) -> Snapshot:
    folder = scratch(m.spark, "snapshot")
    export_all_tables(_model_tables(m), folder, clustered=clustered)
    return Snapshot(folder)


def template_csv(m: Model) -> DataFrame:
    template = read_template(m.spark, _template_csv(m))
    return unmatched_template_rows(template, m.admin_units).drop("Zeile")


def geofilter_run(clustered: bool):
    def run(m: Model) -> DataFrame:
        folder = scratch(m.spark, "geofilter")
        geofilter(
            m.spark,
            _template_csv(m),
            _model_snapshot(m, clustered),
            folder,
            scratch(m.spark, "municipalities"),
            tables_to_copy=[ADMIN_UNITS, CELL_MUNICIPALITY, CELL_PEOPLE],
        )
        return read_chunks(m.spark, folder, TRAVEL_TIMES_SUBSET)

    return run


def klinikfilter_run(clustered: bool):
    def run(m: Model) -> DataFrame:
        hospitals = scratch(m.spark, "hospitals")
        write_list(m.scenario, hospitals)
        folder = scratch(m.spark, "klinikfilter")
        snapshot = _model_snapshot(m, clustered)
        klinikfilter(m.spark, hospitals, snapshot, folder, tables_to_copy=[ADMIN_UNITS])
        return read_chunks(m.spark, folder, TRAVEL_TIMES_SUBSET)

    return run


def clustered_nearest(m: Model) -> DataFrame:
    """Nearest hospitals of a clustered snapshot, whose tasks hold whole cells."""
    times = _model_snapshot(m, clustered=True).table(m.spark, TRAVEL_TIMES)
    return nearest_hospitals(times, m.all_hospitals)


def full_export(m: Model) -> DataFrame:
    folder = scratch(m.spark, "full")
    return komplettexport(m.spark, _model_snapshot(m), folder).table_counts


def ewkb_clean(m: Model) -> DataFrame:
    """A point per customer, in either byte order, with an SRID or without."""
    place = F.concat(F.lpad(F.hex("c_custkey"), 16, "0"), F.lit("0" * 16))
    heads = ("0101000020E6100000", "0020000001000010E6", "0101000000", "0000000001")
    head = F.lit(heads[3])
    for kind, value in enumerate(heads[:3]):
        head = F.when(F.col("c_custkey") % 4 == kind, value).otherwise(head)
    wkb = F.when(F.col("c_acctbal") >= 0, F.unhex(F.concat(head, place)))
    clean = normalise_geometry(m.raw("customer").withColumn(GEOMETRY, wkb))
    return clean.select("c_custkey", F.hex(GEOMETRY).alias("wkb"))


# Filters


def geofilter_cells_query(m: Model) -> DataFrame:
    listed = match_template(m.template, m.admin_units)
    return geofilter_cells(listed, m.admin_units, m.cell_municipality, m.cell_people)


def geofilter_subset(m: Model) -> DataFrame:
    return filter_by_cells(m.travel_times, geofilter_cells_query(m))


def klinikfilter_subset(m: Model) -> DataFrame:
    return filter_by_hospitals(m.travel_times, m.scenario)


# Nearest hospitals


def nearest_times_query(m: Model) -> DataFrame:
    return nearest_times(m.travel_times, m.all_hospitals)


def nearest_hospital(m: Model) -> DataFrame:
    return nearest_hospitals(m.travel_times, m.all_hospitals)


def min_time(m: Model) -> DataFrame:
    return minimum_times(scenario_times(m.travel_times, m.all_hospitals))


def grid_cell_data_query(layout: str):
    return lambda m: scenario_cells(m.tables(layout), m.scenario)


# Summaries


def travel_time_summary(m: Model) -> DataFrame:
    return summarise_times(m.travel_times, units(m), ["Kreis_ID", "Kreis"])


def multi_threshold(m: Model) -> DataFrame:
    return summarise_times(
        m.travel_times, units(m), ["Kreis_ID", "Kreis"], [15, 30, None, 45, 30]
    )


def affected_population(m: Model) -> DataFrame:
    return threshold_of_times(m.travel_times, units(m), ["Gemeindeschluessel"], 25)


def inhabited(m: Model) -> DataFrame:
    return inhabited_cells(m.tables(LAYOUT_SPLIT).cells, m.admin_units, "Kreis")


def scenario(level: str, layout: str = LAYOUT_COMBINED):
    return lambda m: scenario_summary(m.tables(layout), m.scenario, level)


def all_levels(m: Model) -> DataFrame:
    return scenario_all_levels(m.tables(), m.scenario, 30)


def global_coverage(m: Model) -> DataFrame:
    return compute_percentage_covered(scenario("Gemeinde")(m))


def coverage_filter(m: Model) -> DataFrame:
    return filter_by_coverage(scenario("Gemeinde", LAYOUT_SPLIT)(m), 90)


def difference_cells_query(m: Model) -> DataFrame:
    return scenario_difference_cells(m.tables(), m.all_hospitals, m.scenario)


def difference_of_cells(m: Model) -> DataFrame:
    """The same from two tables of cell rows, as they are read from files."""
    tables = m.tables()
    return difference_cells(
        scenario_cells(tables, m.all_hospitals), scenario_cells(tables, m.scenario)
    )


def difference_summary(m: Model) -> DataFrame:
    return scenario_difference(
        m.tables(), m.all_hospitals, m.scenario, ["Kreis_ID", "Kreis"]
    )


# Quality


def table_counts_query(m: Model) -> DataFrame:
    return table_counts(_model_tables(m))


def duplicate_keys_query(m: Model) -> DataFrame:
    return duplicate_keys(
        m.travel_times, ["Gitterzellen_ID", "Krankenhaus_Standortnummer"]
    )


# Texts


def _line_key() -> list:
    return ["l_orderkey", "l_linenumber", "l_partkey"]


def format_minutes(m: Model) -> DataFrame:
    value = F.col("l_extendedprice") / 97
    known = F.when(F.col("l_tax") > 0, value)
    return m.raw("lineitem").select(
        *_line_key(),
        format_fahrtzeit(known).alias("eine_stelle"),
        format_fahrtzeit(known, 2).alias("zwei_stellen"),
    )


def format_population(m: Model) -> DataFrame:
    price = F.col("o_totalprice")
    value = (
        F.when(F.col("o_orderstatus") == "F", F.floor(price * 10).cast("double"))
        .when(F.col("o_orderstatus") == "O", price)
    )
    return m.raw("orders").select("o_orderkey", format_ewz(value).alias("EWZ"))


def format_labels(m: Model) -> DataFrame:
    data = m.raw("orders").select(
        "o_orderkey",
        (F.col("o_totalprice") / 7).alias("wert"),
        F.floor("o_totalprice").alias("ganz"),
        F.col("o_orderstatus").alias("text"),
    )
    return format_label_columns(data, ["wert", "ganz", "text", "fehlt"]).select(
        "o_orderkey", "wert_formatted", "ganz_formatted", "text_formatted"
    )


def polygon_label(m: Model) -> DataFrame:
    return create_polygon_label(scenario("Gemeinde")(m), "Gemeindename").select(
        "Gemeindeschluessel", "label"
    )


def difference_label(m: Model) -> DataFrame:
    return create_polygon_label_differenz(difference_summary(m), "Kreis").select(
        "Kreis_ID", "label"
    )


# Publishing


def scenario_properties(m: Model) -> DataFrame:
    covered = filter_by_coverage(scenario("Gemeinde", LAYOUT_SPLIT)(m), 90)
    return add_empty_scenario2_columns(build_scenario_properties(covered))


def polygon_properties(m: Model) -> DataFrame:
    joined = join_properties_to_polygons(m.polygons, scenario_properties(m))
    return joined.select(*UNIT_PROPERTIES)


def clinic_properties_query(m: Model) -> DataFrame:
    return clinic_properties(m.hospital_sites, m.admin_units).drop(GEOMETRY)


def _results(m: Model):
    return szenario_to_geojson(
        scenario("Gemeinde", LAYOUT_SPLIT)(m),
        m.polygons,
        m.scenario,
        grenzwert_abdeckung=90,
        created_at=CREATED_AT,
    )


def _clinics(m: Model):
    return kliniken_to_geojson(m.hospital_sites, m.admin_units)


def geojson_features(m: Model) -> DataFrame:
    return _results(m).features


def clinic_features(m: Model) -> DataFrame:
    return _clinics(m).features


def feature_collection(m: Model) -> DataFrame:
    return assemble_feature_collection(_results(m))


def export_document(m: Model) -> DataFrame:
    return build_export_json(_clinics(m), _results(m), timestamp=TIMESTAMP)


# Further analyses


def nearest_single(m: Model) -> DataFrame:
    return analyses.naechstes_krankenhaus(m.travel_times)


def closure_impact(m: Model) -> DataFrame:
    return analyses.schliessung_simulieren(
        m.travel_times, m.closed, ["Kreis"], CLOSURE_KEYS, units(m)
    )


def closure_each(m: Model) -> DataFrame:
    return analyses.schliessungen_einzeln(m.travel_times, ["Kreis"], units(m))


def redundancy(m: Model) -> DataFrame:
    return analyses.redundanz_analyse(m.travel_times, 3)


def isochrone(m: Model) -> DataFrame:
    return analyses.erreichbare_gebiete(m.travel_times, "000000000002", 30)


def catchment(m: Model) -> DataFrame:
    return analyses.einzugsgebiet(m.travel_times, units(m))


def time_bands(m: Model) -> DataFrame:
    return analyses.fahrzeit_kategorien(m.travel_times)


def snapshot_comparison(m: Model) -> DataFrame:
    tables = m.tables()
    reference = scenario_cells(tables, m.all_hospitals, counted=True)
    changed = scenario_cells(tables, m.scenario, counted=True)
    return analyses.zeitreihen_vergleich(
        {"2020": reference, "2024": changed}, ["Bundesland"], COPIES
    )


def snapshot_changes(m: Model) -> DataFrame:
    """The same for two stored time points, the later one without a few hospitals: only
    ranges of cells with other rows are summed again."""
    tables, folder = m.tables(), scratch(m.spark, "time-points")
    names = ["2020", "2024"]
    hospitals = [m.all_hospitals, m.all_hospitals.join(m.few_closed, HOSPITAL, "left_anti")]
    before = None
    for name, listed in zip(names, hospitals):
        data = scenario_cells(tables, listed, counted=True)
        store_time_point(data, f"{folder}/{name}", ["Bundesland"], COPIES, before, 32)
        before = f"{folder}/{name}"
    return compare_time_points(m.spark, {n: f"{folder}/{n}" for n in names}, ["Bundesland"])


_BY_NAME: dict[str, Callable[[Model], DataFrame]] = {
    "scenario_gemeinde": scenario("Gemeinde"),
    "scenario_kreis": scenario("Kreis"),
    "scenario_regierungsbezirk": scenario("Regierungsbezirk"),
    "scenario_bundesland": scenario("Bundesland"),
    "scenario_gemeinde_split": scenario("Gemeinde", LAYOUT_SPLIT),
    "scenario_all_levels": all_levels,
    "nearest_hospital": nearest_hospital,
    "nearest_times": nearest_times_query,
    "min_time": min_time,
    "grid_cell_data": grid_cell_data_query(LAYOUT_COMBINED),
    "grid_cell_data_split": grid_cell_data_query(LAYOUT_SPLIT),
    "inhabited_cells": inhabited,
    "travel_time_summary": travel_time_summary,
    "multi_threshold": multi_threshold,
    "affected_population": affected_population,
    "global_coverage": global_coverage,
    "coverage_filter": coverage_filter,
    "difference_cells": difference_cells_query,
    "difference_of_cells": difference_of_cells,
    "difference_summary": difference_summary,
    "geofilter_match": lambda m: match_template(m.template, m.admin_units),
    "geofilter_unmatched": lambda m: unmatched_template_rows(m.template, m.admin_units),
    "geofilter_cells": geofilter_cells_query,
    "geofilter_subset": geofilter_subset,
    "klinikfilter_subset": klinikfilter_subset,
    "table_counts": table_counts_query,
    "duplicate_keys": duplicate_keys_query,
    "format_minutes": format_minutes,
    "format_population": format_population,
    "format_labels": format_labels,
    "polygon_label": polygon_label,
    "difference_label": difference_label,
    "scenario_properties": scenario_properties,
    "polygon_properties": polygon_properties,
    "clinic_properties": clinic_properties_query,
    "geojson_features": geojson_features,
    "clinic_features": clinic_features,
    "feature_collection": feature_collection,
    "export_document": export_document,
    "snapshot_scan": snapshot_scan,
    "parquet_roundtrip": parquet_roundtrip,
    "chunked_roundtrip": chunked_roundtrip,
    "geoparquet_roundtrip": geoparquet_roundtrip,
    "geoparquet_box": geoparquet_box,
    "export_router": export_router,
    "copy_tables": copied_tables,
    "copy_repaired": copy_repaired,
    "partitioned_export": partitioned_export,
    "template_csv": template_csv,
    "geofilter_run": geofilter_run(clustered=False),
    "geofilter_clustered": geofilter_run(clustered=True),
    "klinikfilter_run": klinikfilter_run(clustered=False),
    "klinikfilter_clustered": klinikfilter_run(clustered=True),
    "clustered_nearest": clustered_nearest,
    "full_export": full_export,
    "ewkb_clean": ewkb_clean,
    "nearest_single": nearest_single,
    "closure_impact": closure_impact,
    "closure_each": closure_each,
    "redundancy": redundancy,
    "isochrone": isochrone,
    "catchment": catchment,
    "time_bands": time_bands,
    "snapshot_comparison": snapshot_comparison,
    "snapshot_changes": snapshot_changes,
}


def _query(build: Callable[[Model], DataFrame]) -> Query:
    return lambda spark, folder: rounded(build(Model(spark, folder)))


QUERIES: dict[str, Query] = {name: _query(build) for name, build in _BY_NAME.items()}
