"""Further analyses of travel times: closures, redundancy, reach, catchment."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reachgrid.functions.numbers import (
    count_values,
    exact_product,
    minutes,
    no_nan,
    percent,
    total,
)
from reachgrid.operators.difference import fahrzeit_differenz_zusammenfassung
from reachgrid.operators.nearest import nearest_single
from reachgrid.operators.rows import repeat_rows
from reachgrid.operators.smallest import COPIES, NEXT_SECONDS, smallest_times, two_nearest
from reachgrid.operators.summary import fahrzeit_zusammenfassung
from reachgrid.schema import CELL, HOSPITAL, PEOPLE, SECONDS, require_columns

RANK = "Rang"
BAND = "Fahrzeit_Kategorie"
TIME_POINT = "Zeitpunkt"


def naechstes_krankenhaus(data: DataFrame, by: str = CELL) -> DataFrame:
    """One row per cell, the nearest hospital."""
    return nearest_single(data, by)


def _nearest_with_units(data: DataFrame, units: DataFrame | None) -> DataFrame:
    """One row per cell; inhabitants and units join these few rows, where they
    are not already in the data."""
    nearest = nearest_single(data)
    return nearest if units is None else nearest.join(units, CELL, "left")


def schliessung_simulieren(
    data: DataFrame,
    closed: DataFrame,
    by: list[str],
    keys: list[str],
    units: DataFrame | None = None,
) -> DataFrame:
    """Change of travel times if the listed hospitals close."""
    remaining = data.join(closed.select(HOSPITAL), HOSPITAL, "left_anti")
    return fahrzeit_differenz_zusammenfassung(
        _nearest_with_units(data, units),
        _nearest_with_units(remaining, units),
        by,
        keys,
    )


def schliessungen_einzeln(
    data: DataFrame, by: list[str], units: DataFrame
) -> DataFrame:
    """Change of travel times if one hospital closes, for every hospital at once.

    A row per hospital and unit in which it is the nearest of a cell; it equals the
    row that ``schliessung_simulieren`` gives for this hospital alone. In all other
    units the closure changes nothing. Rows without a hospital cannot close.

    The travel times are reduced to the two nearest hospitals of each cell, in one
    scan. Where the nearest one closes, the other one's time takes its place; sums
    over the units come from those over hospitals and units, as every cell has one
    nearest hospital. ``units`` has a row per cell.
    """
    require_columns(units, [CELL, PEOPLE, *by])
    cells = two_nearest(data).join(
        units.select(*dict.fromkeys([CELL, PEOPLE, *by])), CELL, "left"
    )
    cells = cells.withColumn("_people", no_nan(cells, PEOPLE))
    people, known = F.col("_people"), F.col(SECONDS).isNotNull()
    lost = known & F.col(NEXT_SECONDS).isNull()
    change = F.col(NEXT_SECONDS) - F.col(SECONDS)
    sums = cells.groupBy(HOSPITAL, *by).agg(
        total(people).alias("_everyone"),
        total(F.when(known, people)).alias("_weights"),
        F.count_if(known & people.isNull()).alias("_unknown"),
        total(F.when(lost, people)).alias("_lost"),
        F.count_if(lost & people.isNull()).alias("_lost_unknown"),
        exact_product(change, people).alias("_weighted"),
        total(F.when(change > 0, people)).alias("Anzahl_Betroffene"),
    )
    of_unit = Window.partitionBy(*by)
    whole = {c: F.sum(c).over(of_unit) for c in ("_everyone", "_weights", "_unknown")}
    sums = sums.withColumns({f"{c}_unit": value for c, value in whole.items()})
    mean = F.try_divide(
        minutes(F.coalesce(F.col("_weighted"), F.lit(0))),
        (F.col("_weights_unit") - F.col("_lost")).cast("double"),
    )
    certain = F.col("_unknown_unit") == F.col("_lost_unknown")
    return sums.filter(F.col(HOSPITAL).isNotNull()).select(
        HOSPITAL,
        *by,
        F.col("_everyone_unit").alias("Einwohner_Gesamt"),
        F.when(certain, mean).alias("Mittlere_Gewichtete_Fahrzeit_Differenz"),
        "Anzahl_Betroffene",
        percent(F.col("Anzahl_Betroffene"), F.col("_everyone_unit")).alias("Prozent_Betroffene"),
    )


def redundanz_analyse(data: DataFrame, n: int = 2) -> DataFrame:
    """The ``n`` nearest hospitals per cell, more where the last ones tie.

    The times are reduced to the smallest of each cell, in one scan. All rows with
    these times are counted, ranked by their counts and written out again, so that a
    large group of copies is never ranked row by row.
    """
    counted = smallest_times(data, n)
    in_order = Window.partitionBy(CELL).orderBy(SECONDS, HOSPITAL)
    before = F.sum(COPIES).over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    ranked = counted.withColumn("_before", F.coalesce(before, F.lit(0)))
    return repeat_rows(ranked, COPIES, "_copy").select(
        CELL, HOSPITAL, SECONDS, (F.col("_before") + F.col("_copy")).alias(RANK)
    )


def erreichbare_gebiete(
    data: DataFrame, hospital: str, max_minuten: float = 30
) -> DataFrame:
    """Rows of a hospital within a travel time, the limit included."""
    return data.filter(
        (F.col(HOSPITAL) == F.lit(hospital))
        & (no_nan(data, SECONDS) <= F.lit(max_minuten * 60))
    )


def einzugsgebiet(data: DataFrame, units: DataFrame | None = None) -> DataFrame:
    """Inhabitants and municipalities each hospital is nearest to."""
    nearest = _nearest_with_units(data, units)
    require_columns(nearest, [PEOPLE, "Gemeindename"])
    return nearest.groupBy(HOSPITAL).agg(
        total(no_nan(nearest, PEOPLE)).alias("Einwohner_Versorgt"),
        count_values(F.col("Gemeindename")).alias("Gemeinden_Anzahl"),
    )


def fahrzeit_kategorien(
    data: DataFrame,
    breaks: tuple[float, ...] = (15, 30, 60),
    labels: list[str] | None = None,
) -> DataFrame:
    """Travel-time band of every row; a band includes its upper limit."""
    if labels is None:
        inner = [f"{a:g}-{b:g} min" for a, b in zip(breaks, breaks[1:])]
        labels = [f"≤ {breaks[0]:g} min", *inner, f"> {breaks[-1]:g} min"]
    if len(labels) != len(breaks) + 1:
        raise ValueError("labels must have one entry more than breaks")
    time = minutes(no_nan(data, SECONDS))
    limits = list(zip(breaks, labels))
    band = reduce(
        lambda chain, item: chain.when(time <= F.lit(float(item[0])), F.lit(item[1])),
        limits[1:],
        F.when(time <= F.lit(float(limits[0][0])), F.lit(limits[0][1])),
    )
    return data.withColumn(BAND, band.when(time.isNotNull(), F.lit(labels[-1])))


def zeitreihen_vergleich(
    datasets: dict[str, DataFrame], by: list[str], copies: str | None = None
) -> DataFrame:
    """The same summary for several data sets, told apart by name."""
    columns = [*by, CELL, SECONDS, PEOPLE, *([copies] if copies else [])]
    tagged = [
        df.select(*dict.fromkeys(columns)).withColumn(TIME_POINT, F.lit(name))
        for name, df in datasets.items()
    ]
    return fahrzeit_zusammenfassung(
        reduce(DataFrame.unionByName, tagged), [*by, TIME_POINT], copies=copies
    )
