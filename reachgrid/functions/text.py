"""Display strings for numbers and HTML labels, built from column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reachgrid.functions.numbers import STEADY_DIGITS, is_number
from reachgrid.schema import require_columns

# Texts shown on the maps.
NO_DATA = "keine Daten"
SMALL_SPACE = '<span style="font-size:50%;"> </span>'
MINUTES_SUFFIX = " Minuten"
# Stand-in for the thousands mark while the decimal mark is exchanged.
_MARK = "\u0001"


def _grouped(number: Column, digits: int, big_mark: str, decimal_mark: str) -> Column:
    text = F.replace(F.format_number(number, digits), F.lit(","), F.lit(_MARK))
    text = F.replace(text, F.lit("."), F.lit(decimal_mark))
    return F.replace(text, F.lit(_MARK), F.lit(big_mark))


def _known(number: Column) -> Column:
    number = number.cast("double")
    return F.when(~F.isnan(number), number)


def format_fahrtzeit(value: Column, digits: int = 1) -> Column:
    """Minutes as ``12,3 Minuten``; a missing value as ``keine Daten``."""
    text = _grouped(_known(value), digits, " ", ",")
    return F.coalesce(F.concat(text, F.lit(MINUTES_SUFFIX)), F.lit(NO_DATA))


def format_ewz(value: Column) -> Column:
    """Inhabitants with a small HTML space between thousands.

    Whole numbers carry no decimals, others two.
    """
    number = _known(value)
    text = F.when(
        number == F.floor(number), _grouped(number, 0, SMALL_SPACE, ",")
    ).otherwise(_grouped(number, 2, SMALL_SPACE, ","))
    return F.coalesce(text, F.lit(NO_DATA))


# Counts of people, whole in any column type unless they were estimated.
PEOPLE_COUNTS = ("Einwohner_Gesamt", "Anzahl_Betroffene")


def _formatted(
    df: DataFrame, name: str, digits: int, big_mark: str, decimal_mark: str, number: Column
) -> Column:
    if not is_number(df, name):
        return F.col(f"`{name}`").cast("string")
    whole = isinstance(df.schema[name].dataType, T.IntegralType)
    text = _grouped(number, 0 if whole else digits, big_mark, decimal_mark)
    if name in PEOPLE_COUNTS and not whole:
        people = _grouped(number, 0, big_mark, decimal_mark)
        text = F.when(number == F.floor(number), people).otherwise(text)
    return F.coalesce(text, F.lit("NA"))


def format_label_columns(
    df: DataFrame,
    columns: list[str],
    digits: int = 1,
    big_mark: str = " ",
    decimal_mark: str = ",",
) -> DataFrame:
    """Add ``<column>_formatted`` for every listed column the table has.

    Integer columns and whole counts of people show no decimals, other floating
    values ``digits`` of them and a missing number ``NA``. Each row is formatted on its own, without padding.
    """
    added = {
        f"{c}_formatted": _formatted(
            df, c, digits, big_mark, decimal_mark, _known(F.col(f"`{c}`"))
        )
        for c in columns
        if c in df.columns
    }
    return df.withColumns(added) if added else df


def _label_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """The same for computed means and shares, whose last digits depend on the
    order they were summed in: a label must not change from run to run."""
    return df.withColumns(
        {
            f"{c}_formatted": _formatted(
                df, c, 1, " ", ",", F.round(_known(F.col(f"`{c}`")), STEADY_DIGITS)
            )
            for c in columns
        }
    )


def _label(df: DataFrame, unit: str, value_col: str, caption: str) -> DataFrame:
    base = [value_col, "Einwohner_Gesamt"]
    affected = ["Anzahl_Betroffene", "Prozent_Betroffene"]
    require_columns(df, base + [unit])
    long_form = all(c in df.columns for c in affected)
    df = _label_columns(df, base + (affected if long_form else []))
    parts = [
        F.lit("<strong>"),
        F.coalesce(F.col(f"`{unit}`").cast("string"), F.lit("NA")),
        F.lit(f"</strong><br/>{caption}: "),
        F.col(f"{value_col}_formatted"),
        F.lit("<br/>Einwohner:innen: "),
        F.col("Einwohner_Gesamt_formatted"),
    ]
    if long_form:
        parts += [
            F.lit("<br/>Betroffene Einwohner:innen: "),
            F.col("Anzahl_Betroffene_formatted"),
            F.lit("<br/>Prozent Betroffene: "),
            F.col("Prozent_Betroffene_formatted"),
            F.lit("%"),
        ]
    return df.withColumn("label", F.concat(*parts))


def create_polygon_label(df: DataFrame, unit: str) -> DataFrame:
    """HTML label of a travel-time summary, headed by the column ``unit``."""
    return _label(df, unit, "Mittlere_Gewichtete_Fahrzeit", "Fahrzeit in min")


def create_polygon_label_differenz(df: DataFrame, unit: str) -> DataFrame:
    """HTML label of a difference summary, headed by the column ``unit``."""
    return _label(
        df, unit, "Mittlere_Gewichtete_Fahrzeit_Differenz", "Fahrzeit-Differenz in min"
    )
