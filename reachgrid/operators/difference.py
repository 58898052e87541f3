"""Comparing the travel times of a scenario with those of a reference."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reachgrid.functions.numbers import minutes, no_nan, percent, total, weighted_mean
from reachgrid.operators.nearest import COPIES, REFERENCE, SCENARIO
from reachgrid.operators.rows import count_rows
from reachgrid.schema import CELL, PEOPLE, SECONDS, require_columns

DIFFERENCE = "Fahrzeit_Differenz_Minuten"

# Columns two cell tables are matched on by default.
DEFAULT_KEYS = [
    "Einwohner",
    "Gitterzellen_ID",
    "Gemeindename",
    "Gemeindeschluessel",
    "Bundesland",
    "Regierungsbezirk",
    "Kreis",
    "Bundesland_ID",
    "Regierungsbezirk_ID",
    "Kreis_ID",
    "Gemeinde_ID",
]


def _suffixed(
    reference: DataFrame, scenario: DataFrame, keys: list[str], copies: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Both tables with shared columns that are no keys told apart by suffix."""
    require_columns(reference, [SECONDS, *keys])
    require_columns(scenario, [SECONDS, *keys])
    shared = (set(reference.columns) & set(scenario.columns)) - {*keys, copies}
    return (
        reference.withColumnsRenamed({c: c + REFERENCE for c in shared}),
        scenario.withColumnsRenamed({c: c + SCENARIO for c in shared}),
    )


def _null_safe_left_join(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Left join in which a missing key equals a missing key.

    Spark hashes such keys like plain ones, so the join stays an equality join.
    """
    right = right.withColumnsRenamed({k: f"_{k}" for k in keys})
    same = reduce(
        lambda a, b: a & b, (left[k].eqNullSafe(right[f"_{k}"]) for k in keys)
    )
    return left.join(right, same, "left").drop(*(f"_{k}" for k in keys))


def change_of(joined: DataFrame) -> Column:
    """Seconds more in the scenario than in the reference."""
    return no_nan(joined, SECONDS + SCENARIO) - no_nan(joined, SECONDS + REFERENCE)


def with_difference(joined: DataFrame) -> DataFrame:
    return joined.withColumn(DIFFERENCE, minutes(change_of(joined)))


def difference_cells(
    reference: DataFrame, scenario: DataFrame, keys: list[str] | None = None
) -> DataFrame:
    """Reference rows with their scenario rows and the change in minutes.

    Every reference row of a cell meets every scenario row of it, so ties on both
    sides multiply; the summary multiplies their counts instead. Reference rows
    without a partner stay, with an unknown change. Keys may be
    NULL on both sides. ``keys=["Gitterzellen_ID"]`` is enough, and cheaper to
    shuffle, where a cell has one municipality and one population.
    """
    keys = keys or DEFAULT_KEYS
    left, right = _suffixed(reference, scenario, keys)
    return with_difference(_null_safe_left_join(left, right, keys))


def fahrzeit_differenz_zusammenfassung(
    reference: DataFrame,
    scenario: DataFrame,
    by: list[str],
    keys: list[str] | None = None,
    copies: str | None = None,
) -> DataFrame:
    """Weighted mean change and people with longer times, per group.

    Rows that are equal in all that matters are counted on each side before
    the join; matches multiply the counts instead of the rows. ``copies`` names
    a column of both tables with the number of rows each row stands for.
    """
    keys = keys or DEFAULT_KEYS
    left, right = _suffixed(reference, scenario, keys, copies)

    def collapsed(side: DataFrame, name: str) -> DataFrame:
        wanted = {*keys, *by, PEOPLE, SECONDS + REFERENCE, SECONDS + SCENARIO}
        kept = [c for c in side.columns if c in wanted]
        return count_rows(side, kept, name, copies)

    joined = _null_safe_left_join(
        collapsed(left, "_left"), collapsed(right, "_right"), keys
    )
    return _summed(joined, by)


def difference_of_times(times: DataFrame, units: DataFrame, by: list[str]) -> DataFrame:
    """The same summary from ``nearest_times_compared`` and the units of the cells,
    of which each cell has one row. Only cells are joined, on the cell alone.
    """
    counts = {COPIES + REFERENCE: "_left", COPIES + SCENARIO: "_right"}
    joined = times.withColumnsRenamed(counts).join(
        units.select(*dict.fromkeys([CELL, PEOPLE, *by])), CELL, "left"
    )
    return _summed(joined, by)


def _summed(joined: DataFrame, by: list[str]) -> DataFrame:
    """The summary of matched rows that stand for ``_left`` times ``_right`` pairs."""
    require_columns(joined, [PEOPLE, *by])
    pairs = F.col("_left") * F.coalesce(F.col("_right"), F.lit(1))
    prepared = joined.withColumns(
        {"_pairs": pairs, "_people": no_nan(joined, PEOPLE), "_change": change_of(joined)}
    )
    people, pairs = F.col("_people"), F.col("_pairs")
    everyone = total(people * pairs)
    change = F.col("_change")
    worse = total(F.when(change > 0, people * pairs))
    return prepared.groupBy(*by).agg(
        everyone.alias("Einwohner_Gesamt"),
        minutes(weighted_mean(change, people, pairs)).alias(
            "Mittlere_Gewichtete_Fahrzeit_Differenz"
        ),
        worse.alias("Anzahl_Betroffene"),
        percent(worse, everyone).alias("Prozent_Betroffene"),
    )
