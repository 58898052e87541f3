"""The nearest hospitals of a scenario for every grid cell.

A cell or a group of equal rows may be a large part of the table, so nothing
here gathers the rows of a cell: every task reduces what it reads to the smallest
times of its cells, and the travel times are read once (see ``smallest``).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reachgrid.operators.rows import repeat_rows
from reachgrid.operators.smallest import smallest_times
from reachgrid.schema import (
    ADMIN_COLUMNS,
    CELL,
    HOSPITAL,
    LAYOUT_COMBINED,
    LAYOUT_SPLIT,
    MUNICIPALITY,
    PEOPLE,
    SECONDS,
    one_of,
    require_columns,
)

# Number of equally near hospitals a row stands for.
COPIES = "Anzahl_Naechste"

# Ends of the columns of a reference and of a scenario.
REFERENCE = "_Referenz"
SCENARIO = "_Szenario"


def scenario_times(travel_times: DataFrame, hospitals: DataFrame) -> DataFrame:
    """Travel times to the hospitals of a scenario; a hospital listed twice
    counts twice."""
    require_columns(hospitals, [HOSPITAL])
    return travel_times.select(HOSPITAL, CELL, SECONDS).join(
        hospitals.select(HOSPITAL), HOSPITAL
    )


def minimum_times(times: DataFrame) -> DataFrame:
    """Shortest known travel time per cell."""
    return times.groupBy(CELL).agg(F.min(SECONDS).alias("min_fahrzeit"))


def listed_times(travel_times: DataFrame, **lists: DataFrame) -> DataFrame:
    """Travel times to the hospitals of any of the lists, with a column per list: how
    often the hospital is in it. Rows without a cell or a time are left out."""
    rows = []
    for name, listed in lists.items():
        require_columns(listed, [HOSPITAL])
        flags = [F.lit(int(other == name)).alias(other) for other in lists]
        rows.append(listed.select(HOSPITAL, *flags))
    listed = reduce(DataFrame.unionByName, rows).groupBy(HOSPITAL)
    listed = listed.agg(*(F.sum(name).alias(name) for name in lists))
    times = travel_times.select(HOSPITAL, CELL, SECONDS).join(listed, HOSPITAL)
    return times.filter(F.col(SECONDS).isNotNull() & F.col(CELL).isNotNull())


def nearest_hospitals(
    travel_times: DataFrame, hospitals: DataFrame, ties: str = "all"
) -> DataFrame:
    """The nearest hospitals per cell: all of them, or one where they tie.

    ``"all"`` reduces the times to the smallest of each cell, in one scan and one
    shuffle of what is left, and writes rows that were counted out again. ``"one"``
    takes the smallest hospital number. A cell without any known time has no nearest
    hospital.
    """
    one_of(ties, ("all", "one"), "ties")
    if ties == "one":
        times = scenario_times(travel_times, hospitals)
        return nearest_single(times.filter(F.col(SECONDS).isNotNull()))
    counted = nearest_counted(travel_times, hospitals)
    return repeat_rows(counted, COPIES, "_number").select(HOSPITAL, CELL, SECONDS)


def nearest_counted(
    travel_times: DataFrame, hospitals: DataFrame, ties: str = "all"
) -> DataFrame:
    """The nearest hospitals with equal rows counted."""
    if ties != "all":
        nearest = nearest_hospitals(travel_times, hospitals, ties)
        return nearest.withColumn(COPIES, F.lit(1).cast("long"))
    times = listed_times(travel_times, **{COPIES: hospitals})
    return smallest_times(times, lists=(COPIES,)).select(HOSPITAL, CELL, SECONDS, COPIES)


def nearest_single(times: DataFrame, by: str = CELL) -> DataFrame:
    """Exactly one row per cell: shortest time, then smallest hospital number.

    Only the first row of a group is wanted, so Spark drops the others in each
    task before it shuffles.
    """
    rest = [c for c in times.columns if c not in (by, SECONDS, HOSPITAL)]
    order = Window.partitionBy(by).orderBy(
        F.col(SECONDS).asc_nulls_last(), HOSPITAL, *rest
    )
    return (
        times.withColumn("_rank", F.row_number().over(order))
        .filter(F.col("_rank") == 1)
        .drop("_rank")
    )


def nearest_times(
    travel_times: DataFrame, hospitals: DataFrame, ties: str = "all"
) -> DataFrame:
    """Shortest known time per cell with the number of hospitals that share it.

    This is all a summary needs of ``nearest_hospitals``. It leaves the cells
    where the next join, with their units, wants them.
    """
    nearest = nearest_counted(travel_times, hospitals, ties)
    return nearest.filter(F.col(CELL).isNotNull()).groupBy(CELL).agg(
        F.min(SECONDS).alias(SECONDS), F.sum(COPIES).alias(COPIES)
    )


def nearest_compared(
    travel_times: DataFrame, reference: DataFrame, scenario: DataFrame
) -> DataFrame:
    """``Krankenhaus_Standortnummer, Gitterzellen_ID, Fahrzeit_Sekunden`` of all rows
    that are nearest in a reference or in a scenario, and how often in each, from one
    scan of the travel times."""
    names = (COPIES + REFERENCE, COPIES + SCENARIO)
    times = listed_times(travel_times, **dict(zip(names, (reference, scenario))))
    return smallest_times(times, lists=names).select(HOSPITAL, CELL, SECONDS, *names)


def nearest_times_compared(
    travel_times: DataFrame, reference: DataFrame, scenario: DataFrame
) -> DataFrame:
    """Shortest known times per cell to the hospitals of a reference and to those
    of a scenario, each with the number of hospitals that share it.

    The travel times are read once whatever is compared. Cells the reference does
    not reach are absent; a hospital listed twice counts twice.
    """
    rows = nearest_compared(travel_times, reference, scenario)
    ends = (REFERENCE, SCENARIO)

    def least(end: str):
        return F.min(F.when(F.col(COPIES + end) > 0, F.col(SECONDS)))

    found = rows.groupBy(CELL).agg(
        *(least(end).alias(SECONDS + end) for end in ends),
        *(F.sum(F.when(F.col(COPIES + e) > 0, F.col(COPIES + e))).alias(COPIES + e) for e in ends),
    )
    return found.filter(F.col(SECONDS + REFERENCE).isNotNull())


def cell_table(
    layout: str,
    combined: DataFrame | None = None,
    municipality: DataFrame | None = None,
    people: DataFrame | None = None,
) -> DataFrame:
    """Cells with municipality and inhabitants in either table layout.

    The split layout keeps cells without inhabitants, their number is NULL.
    """
    one_of(layout, (LAYOUT_COMBINED, LAYOUT_SPLIT), "gitterzellen_layout")
    if layout == LAYOUT_COMBINED:
        return combined.select(CELL, MUNICIPALITY, PEOPLE)
    return (
        municipality.select(CELL, MUNICIPALITY)
        .join(people.select(CELL, PEOPLE), CELL, "left")
        .select(CELL, MUNICIPALITY, PEOPLE)
    )


def cell_units(
    cells: DataFrame, admin_units: DataFrame, columns: list[str] | None = None
) -> DataFrame:
    """Cells with the administrative columns of their municipality.

    Cells of a municipality the unit table does not know stay, without units;
    the key of the unit table itself is never NULL.
    Units are attached to the cells and not to the much longer list of times,
    so a large municipality is never a join key of that list.
    """
    columns = columns or [c for c in ADMIN_COLUMNS if c in admin_units.columns]
    columns = [c for c in columns if c != MUNICIPALITY]
    units = admin_units.select(MUNICIPALITY, *columns)
    return cells.join(units, MUNICIPALITY, "left").select(*cells.columns, *columns)


def grid_cell_data(
    nearest: DataFrame, cells: DataFrame, admin_units: DataFrame
) -> DataFrame:
    """Nearest rows with inhabitants and administrative units."""
    units = cell_units(cells.select(CELL, PEOPLE, MUNICIPALITY), admin_units)
    return nearest.join(units, CELL, "left")
