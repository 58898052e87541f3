"""Population-weighted summaries of travel times per group."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reachgrid.functions.numbers import (
    count_values,
    exact_product,
    exact_weight,
    mean_of_sums,
    minutes,
    no_nan,
    percent,
    total,
    unknown_weight,
    weighted_mean,
)
from reachgrid.schema import (
    CELL,
    LEVELS,
    MUNICIPALITY,
    PEOPLE,
    SECONDS,
    Level,
    one_of,
    require_columns,
)

_PEOPLE = "_people"
_SECONDS = "_seconds"
_MINUTES = "_minutes"
_COPIES = "_copies"

MEAN = "Mittlere_Gewichtete_Fahrzeit"
COVERAGE = "Prozent_Abgedeckt_pro_Gemeinde"
CELLS_REACHED = "Anzahl_Gitterzellen"
CELLS_INHABITED = "Anzahl_bewohnte_Gitterzellen"


def clean_thresholds(values: float | Iterable[float | None] | None) -> list[float]:
    """Thresholds in given order without missing values and repetitions."""
    if values is None:
        return []
    if isinstance(values, (int, float)):
        values = [values]
    return list(dict.fromkeys(v for v in values if v is not None and v == v))


def _prepare(data: DataFrame, copies: str | None) -> DataFrame:
    require_columns(data, [SECONDS, PEOPLE])
    return data.withColumns(
        {
            _PEOPLE: no_nan(data, PEOPLE),
            _SECONDS: no_nan(data, SECONDS),
            _MINUTES: minutes(no_nan(data, SECONDS)),
            _COPIES: F.col(copies) if copies else F.lit(1),
        }
    )


def affected(threshold: float) -> Column:
    """Inhabitants strictly beyond a threshold; unknown times do not count."""
    beyond = F.col(_MINUTES) > F.lit(float(threshold))
    return total(F.when(beyond, F.col(_PEOPLE) * F.col(_COPIES)))


def _threshold_columns(thresholds: list[float]) -> list[Column]:
    people = total(F.col(_PEOPLE) * F.col(_COPIES))
    return _affected_columns({t: affected(t) for t in thresholds}, people)


def _affected_columns(beyond: dict[float, Column], people: Column) -> list[Column]:
    """All counts, then all shares; named by threshold if there are several."""
    suffix = {t: f"_{t:g}min" if len(beyond) > 1 else "" for t in beyond}
    counts = [c.alias(f"Anzahl_Betroffene{suffix[t]}") for t, c in beyond.items()]
    shares = [
        percent(c, people).alias(f"Prozent_Betroffene{suffix[t]}")
        for t, c in beyond.items()
    ]
    return counts + shares


def summarise_threshold(
    data: DataFrame, by: list[str], threshold: float, copies: str | None = None
) -> DataFrame:
    """Affected inhabitants at one threshold, which the result also names."""
    prepared = _prepare(data, copies)
    return (
        prepared.groupBy(*by)
        .agg(*_threshold_columns([threshold]))
        .withColumn("Schwellenwert", F.lit(float(threshold)))
    )


def summary_columns(thresholds: list[float]) -> list[Column]:
    people = F.col(_PEOPLE)
    copies = F.col(_COPIES)
    return [
        total(people * copies).alias("Einwohner_Gesamt"),
        minutes(weighted_mean(F.col(_SECONDS), people, copies)).alias(MEAN),
        count_values(F.col(CELL)).alias(CELLS_REACHED),
        *_threshold_columns(thresholds),
    ]


def fahrzeit_zusammenfassung(
    data: DataFrame,
    by: list[str],
    grenzwert_minuten: float | Iterable[float | None] | None = None,
    copies: str | None = None,
) -> DataFrame:
    """Inhabitants, weighted mean time, cells and affected people per group.

    One threshold gives ``Anzahl_Betroffene`` and ``Prozent_Betroffene``,
    several give one suffixed pair each, none gives neither. All of them come
    out of one aggregation over one pass. ``copies`` names a column with the
    number of rows each row stands for.
    """
    require_columns(data, [CELL, *by])
    prepared = _prepare(data, copies)
    thresholds = clean_thresholds(grenzwert_minuten)
    return prepared.groupBy(*by).agg(*summary_columns(thresholds))


def summarise_times(
    travel_times: DataFrame,
    units: DataFrame,
    by: list[str],
    grenzwert_minuten: float | Iterable[float | None] | None = None,
) -> DataFrame:
    """``fahrzeit_zusammenfassung`` of a long list of times and its cells.

    The times are reduced to one row per cell first, which happens on the map
    side for the most part. Inhabitants and units join these rows, so neither
    the whole list nor a large cell is ever the side of a join.
    """
    require_columns(travel_times, [CELL, SECONDS])
    require_columns(units, [CELL, PEOPLE, *by])
    thresholds = clean_thresholds(grenzwert_minuten)
    seconds = no_nan(travel_times, SECONDS)
    time = minutes(seconds)
    names = {t: f"_beyond_{i}" for i, t in enumerate(thresholds)}
    cells = travel_times.groupBy(CELL).agg(
        F.count(F.lit(1)).alias("_rows"),
        F.count(time).alias("_known"),
        F.sum(seconds).alias("_sum"),
        *(F.count_if(time > F.lit(float(t))).alias(n) for t, n in names.items()),
    )
    joined = cells.join(units, CELL, "left").withColumn(_PEOPLE, no_nan(units, PEOPLE))
    people = F.col(_PEOPLE)
    everyone = total(people * F.col("_rows"))
    # All times of a cell have the same weight.
    mean = mean_of_sums(
        exact_product(F.col("_sum"), people),
        exact_weight(F.col("_sum"), people, F.col("_known")),
        unknown_weight(F.col("_sum"), people),
    )
    beyond = {t: total(people * F.col(n)) for t, n in names.items()}
    return joined.groupBy(*by).agg(
        everyone.alias("Einwohner_Gesamt"),
        minutes(mean).alias(MEAN),
        count_values(F.col(CELL)).alias(CELLS_REACHED),
        *_affected_columns(beyond, everyone),
    )


def threshold_of_times(
    travel_times: DataFrame, units: DataFrame, by: list[str], threshold: float
) -> DataFrame:
    """``summarise_threshold`` of a long list of times and its cells, reduced to
    cells before anything is joined."""
    found = summarise_times(travel_times, units, by, threshold)
    return found.select(
        *by,
        "Anzahl_Betroffene",
        "Prozent_Betroffene",
        F.lit(float(threshold)).alias("Schwellenwert"),
    )


def partial_columns(thresholds: list[float], reached: Column) -> list[Column]:
    """Sums of a small unit from which ``rolled_up`` makes those of larger ones;
    ``reached`` counts cells that are in no other one."""
    people, copies, seconds = F.col(_PEOPLE), F.col(_COPIES), F.col(_SECONDS)
    return [
        total(people * copies).alias("_people_sum"),
        exact_product(seconds, people, copies).alias("_weighted"),
        exact_weight(seconds, people, copies).alias("_weights"),
        unknown_weight(seconds, people).alias("_unknown"),
        reached.alias("_reached"),
        *(affected(t).alias(f"_beyond_{i}") for i, t in enumerate(thresholds)),
    ]


def rolled_up(thresholds: list[float]) -> list[Column]:
    """``summary_columns`` from the sums of smaller units and from the cells that may
    be in several of them, in ``_cell``."""
    people = total(F.col("_people_sum"))
    mean = mean_of_sums(F.sum("_weighted"), F.sum("_weights"), F.max("_unknown"))
    beyond = {t: total(F.col(f"_beyond_{i}")) for i, t in enumerate(thresholds)}
    return [
        people.alias("Einwohner_Gesamt"),
        minutes(mean).alias(MEAN),
        (F.sum("_reached") + F.count_distinct("_cell")).alias(CELLS_REACHED),
        *_affected_columns(beyond, people),
    ]


def prepared_rows(data: DataFrame, copies: str | None = None) -> DataFrame:
    """The rows with what ``partial_columns`` needs."""
    return _prepare(data, copies)


def level_of(verwaltungsebene: str) -> Level:
    return LEVELS[one_of(verwaltungsebene, LEVELS, "Verwaltungsebene")]


def inhabited_cells(
    cells: DataFrame, admin_units: DataFrame, verwaltungsebene: str
) -> DataFrame:
    """Number of distinct cells per unit; cells of unknown units form one group."""
    id_col = level_of(verwaltungsebene).id_col
    units = admin_units.select(F.col(MUNICIPALITY).alias("_unit"), F.col(id_col).alias("_id"))
    return (
        cells.join(units, cells[MUNICIPALITY] == units["_unit"], "left")
        .groupBy(F.col("_id").alias(id_col))
        .agg(F.count_distinct(CELL).alias(CELLS_INHABITED))
    )


def add_coverage(summary: DataFrame, inhabited: DataFrame, id_col: str) -> DataFrame:
    """Share of a unit's inhabited cells the scenario reaches, in percent."""
    known = inhabited.withColumnRenamed(id_col, "_id")
    joined = summary.join(known, summary[id_col].eqNullSafe(known["_id"]), "left")
    return joined.drop("_id").withColumn(
        COVERAGE, percent(F.col(CELLS_REACHED), F.col(CELLS_INHABITED))
    )


def compute_percentage_covered(summary: DataFrame) -> DataFrame:
    """One row with the share of all inhabited cells reached, 0 if there are none.

    Only units the scenario reaches are in a summary, so the denominator leaves
    out units without any reached cell.
    """
    require_columns(summary, [CELLS_REACHED, CELLS_INHABITED])
    reached = total(no_nan(summary, CELLS_REACHED)).cast("double")
    inhabited = total(no_nan(summary, CELLS_INHABITED)).cast("double")
    return summary.agg(
        F.when(inhabited == 0, F.lit(0.0))
        .otherwise(percent(reached, inhabited))
        .alias("percentage_covered")
    )


def filter_by_coverage(summary: DataFrame, grenzwert_abdeckung: float = 99) -> DataFrame:
    """Units covered to at least the given percentage."""
    require_columns(summary, [COVERAGE])
    return summary.filter(no_nan(summary, COVERAGE) >= F.lit(float(grenzwert_abdeckung)))
