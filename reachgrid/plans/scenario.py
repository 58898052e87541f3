"""Travel-time summaries of a hospital scenario."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reachgrid.functions.numbers import percent
from reachgrid.operators.difference import difference_of_times, with_difference
from reachgrid.operators.nearest import (
    COPIES,
    REFERENCE,
    SCENARIO,
    cell_table,
    cell_units,
    grid_cell_data,
    nearest_compared,
    nearest_counted,
    nearest_hospitals,
    nearest_times,
    nearest_times_compared,
)
from reachgrid.operators.rows import repeat_rows
from reachgrid.operators.summary import (
    CELLS_INHABITED,
    CELLS_REACHED,
    COVERAGE,
    add_coverage,
    clean_thresholds,
    fahrzeit_zusammenfassung,
    inhabited_cells,
    level_of,
    partial_columns,
    prepared_rows,
    rolled_up,
)
from reachgrid.schema import (
    ADMIN_UNITS,
    CELL,
    CELL_COMBINED,
    CELL_MUNICIPALITY,
    CELL_PEOPLE,
    HOSPITAL,
    LAYOUT_COMBINED,
    LAYOUT_SPLIT,
    LEVELS,
    MUNICIPALITY,
    PEOPLE,
    SECONDS,
    TRAVEL_TIMES,
    TRAVEL_TIMES_SUBSET,
    one_of,
)
from reachgrid.sources.lists import read_hospital_list
from reachgrid.sources.tables import Source

LEVEL = "Ebene"
UNIT_ID = "Einheit_ID"
UNIT = "Einheit"


@dataclass(frozen=True)
class ScenarioTables:
    """The tables a scenario is computed on; ``cells`` follows one layout."""

    travel_times: DataFrame
    cells: DataFrame
    admin_units: DataFrame


def read_tables(
    spark: SparkSession,
    source: Source,
    entfernungsdaten_table: str = TRAVEL_TIMES,
    gitterzellen_layout: str = LAYOUT_COMBINED,
) -> ScenarioTables:
    one_of(
        entfernungsdaten_table,
        (TRAVEL_TIMES, TRAVEL_TIMES_SUBSET),
        "entfernungsdaten_table",
    )
    one_of(gitterzellen_layout, (LAYOUT_COMBINED, LAYOUT_SPLIT), "gitterzellen_layout")
    if gitterzellen_layout == LAYOUT_COMBINED:
        cells = cell_table(gitterzellen_layout, source.table(spark, CELL_COMBINED))
    else:
        cells = cell_table(
            gitterzellen_layout,
            municipality=source.table(spark, CELL_MUNICIPALITY),
            people=source.table(spark, CELL_PEOPLE),
        )
    return ScenarioTables(
        source.table(spark, entfernungsdaten_table),
        cells,
        source.table(spark, ADMIN_UNITS),
    )


def scenario_cells(
    tables: ScenarioTables,
    hospitals: DataFrame,
    ties: str = "all",
    counted: bool = False,
) -> DataFrame:
    """One row per cell and nearest hospital with all administrative columns.

    ``counted`` keeps equal rows together with their number, for a summary
    that takes it.
    """
    find = nearest_counted if counted else nearest_hospitals
    nearest = find(tables.travel_times, hospitals, ties)
    return grid_cell_data(nearest, tables.cells, tables.admin_units)


def scenario_summary(
    tables: ScenarioTables,
    hospitals: DataFrame,
    verwaltungsebene: str = "Gemeinde",
    grenzwert_minuten: float | Iterable[float | None] | None = 30,
    ties: str = "all",
) -> DataFrame:
    """Summary and coverage per unit of one administrative level."""
    level = level_of(verwaltungsebene)
    cells = _reached_cells(tables, hospitals, level.group_cols, ties)
    summary = fahrzeit_zusammenfassung(
        cells, level.group_cols, grenzwert_minuten, copies=COPIES
    )
    inhabited = inhabited_cells(tables.cells, tables.admin_units, verwaltungsebene)
    return add_coverage(summary, inhabited, level.id_col)


def scenario_difference(
    tables: ScenarioTables, reference: DataFrame, scenario: DataFrame, by: list[str]
) -> DataFrame:
    """Change of travel times from one list of hospitals to another, per group of
    the administrative columns ``by``."""
    times = nearest_times_compared(tables.travel_times, reference, scenario)
    return difference_of_times(times, cell_units(tables.cells, tables.admin_units, by), by)


def scenario_difference_cells(
    tables: ScenarioTables, reference: DataFrame, scenario: DataFrame
) -> DataFrame:
    """``difference_cells`` of the cell rows of two lists of hospitals, from one scan of
    the travel times.

    The nearest hospitals of both lists come flagged from one reduction. Those of the
    reference and of the scenario meet per cell, as counted rows; administrative columns
    join them by the cell alone, of which a mapping has one row, and copies are written
    out last.
    """
    rows = nearest_compared(tables.travel_times, reference, scenario)
    ends = (REFERENCE, SCENARIO)

    def near(end: str) -> Column:
        entry = F.struct(
            F.col(HOSPITAL).alias(HOSPITAL + end), F.col(SECONDS).alias(SECONDS + end),
            F.col(COPIES + end),
        )
        return F.collect_list(F.when(F.col(COPIES + end) > 0, entry)).alias(end)

    per_cell = rows.groupBy(CELL).agg(*(near(end) for end in ends))
    pairs = per_cell.select(CELL, F.explode(REFERENCE).alias("_r"), SCENARIO)
    pairs = pairs.select(CELL, "_r", F.explode_outer(SCENARIO).alias("_s"))
    pairs = pairs.select(CELL, "_r.*", "_s.*")
    units = cell_units(
        tables.cells.select(CELL, PEOPLE, MUNICIPALITY), tables.admin_units
    )
    joined = with_difference(pairs.join(units, CELL, "left"))
    copies = F.col(COPIES + REFERENCE) * F.coalesce(F.col(COPIES + SCENARIO), F.lit(1))
    counted = joined.withColumn("_pairs", copies).drop(*(COPIES + end for end in ends))
    return repeat_rows(counted, "_pairs", "_number").drop("_number")


def _reached_cells(
    tables: ScenarioTables, hospitals: DataFrame, columns: list[str], ties: str
) -> DataFrame:
    nearest = nearest_times(tables.travel_times, hospitals, ties)
    units = cell_units(tables.cells, tables.admin_units, columns)
    return nearest.join(units, CELL, "left")


def _on_all_levels(rows: DataFrame) -> DataFrame:
    """Every row once per level, with the unit it belongs to there."""
    units = [
        F.struct(
            F.lit(level.name).alias(LEVEL),
            F.col(level.id_col).alias(UNIT_ID),
            F.col(level.name_col).alias(UNIT),
        )
        for level in LEVELS.values()
    ]
    return rows.select("*", F.explode(F.array(*units)).alias("_unit")).select(
        *rows.columns, "_unit.*"
    )


def _apart(rows: DataFrame) -> DataFrame:
    """Rows with ``_cell``: the cell, if the mapping has it more than once. Counts of
    all others add up from one level to the next."""
    several = F.count(F.lit(1)).over(Window.partitionBy(CELL)) > 1
    return rows.withColumn("_cell", F.when(several, F.col(CELL)))


def scenario_all_levels(
    tables: ScenarioTables,
    hospitals: DataFrame,
    grenzwert_minuten: float | Iterable[float | None] | None = 30,
    ties: str = "all",
) -> DataFrame:
    """The summaries of all levels in one table, from one pass over the times.

    Cells are summed per municipality, and municipalities to the other levels; the sums
    are exact. A cell counts once in a unit: cells that the mapping has several times
    are carried along by name up to the last step, all others by number.
    """
    columns = list(
        dict.fromkeys(c for level in LEVELS.values() for c in level.group_cols)
    )
    thresholds = clean_thresholds(grenzwert_minuten)
    cells = prepared_rows(_apart(_reached_cells(tables, hospitals, columns, ties)), COPIES)
    once = F.col("_cell").isNull().cast("long")
    small = cells.groupBy(*columns, "_cell").agg(*partial_columns(thresholds, F.sum(once)))
    summary = _on_all_levels(small).groupBy(
        LEVEL, UNIT_ID, UNIT, "Bundesland", "Bundesland_ID"
    ).agg(*rolled_up(thresholds))
    # The denominators count cells under the key of the unit table, which is
    # NULL for a municipality that table does not know.
    known = tables.admin_units.withColumn("_key", F.col(MUNICIPALITY))
    mapped = _apart(tables.cells.select(CELL, MUNICIPALITY).filter(F.col(CELL).isNotNull()))
    mapped = mapped.groupBy(MUNICIPALITY, "_cell").agg(F.sum(once).alias("_once"))
    units = mapped.join(known, MUNICIPALITY, "left")
    units = units.drop(MUNICIPALITY).withColumnRenamed("_key", MUNICIPALITY)
    inhabited = (
        _on_all_levels(units)
        .groupBy(F.col(LEVEL).alias("_level"), F.col(UNIT_ID).alias("_id"))
        .agg((F.sum("_once") + F.count_distinct("_cell")).alias(CELLS_INHABITED))
    )
    same = (summary[LEVEL] == inhabited["_level"]) & summary[UNIT_ID].eqNullSafe(
        inhabited["_id"]
    )
    return (
        summary.join(inhabited, same, "left")
        .drop("_level", "_id")
        .withColumn(COVERAGE, percent(F.col(CELLS_REACHED), F.col(CELLS_INHABITED)))
    )


def szenario_berechnung(
    spark: SparkSession,
    hospital_csv: str,
    source: Source,
    grenzwert_minuten: float | Iterable[float | None] | None = 30,
    verwaltungsebene: str = "Gemeinde",
    entfernungsdaten_table: str = TRAVEL_TIMES,
    gitterzellen_layout: str = LAYOUT_COMBINED,
    return_gitterzellen_daten: bool = False,
    ties: str = "all",
) -> DataFrame:
    """Scenario of the hospitals in a CSV list on the tables of a source.

    Returns the summary per unit, or with ``return_gitterzellen_daten`` the
    cell rows it is made of.
    """
    hospitals = read_hospital_list(spark, hospital_csv)
    tables = read_tables(spark, source, entfernungsdaten_table, gitterzellen_layout)
    if return_gitterzellen_daten:
        return scenario_cells(tables, hospitals, ties)
    return scenario_summary(tables, hospitals, verwaltungsebene, grenzwert_minuten, ties)

