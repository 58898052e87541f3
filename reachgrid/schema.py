"""Tables, columns and administrative levels of the travel-time data model.

Column names are German because they are the public names of the data sets;
everything that consumes a published table relies on them.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T

CELL = "Gitterzellen_ID"
HOSPITAL = "Krankenhaus_Standortnummer"
SECONDS = "Fahrzeit_Sekunden"
METRES = "Fahrstrecke_Meter"
PEOPLE = "Einwohner"
MUNICIPALITY = "Gemeindeschluessel"
GEOMETRY = "geometry"
# The box of each geometry, where a file holds it.
BOX = "bbox"

# Names of the published tables.
TRAVEL_TIMES = "Entfernungsdaten"
TRAVEL_TIMES_SUBSET = "Entfernungsdaten_subset"
CELL_MUNICIPALITY = "Gitterzellen_Gemeinde_Mapping"
CELL_PEOPLE = "Gitterzellen_Einwohner_Mapping"
CELL_COMBINED = "Gitterzellen_mit_Einwohnern_Gemeinde_Mapping"
ADMIN_UNITS = "Verwaltungsgebiete_Mapping"
HOSPITAL_SITES = "Krankenhaus_Standortliste"
SUPPORT_TABLES = (
    "Gitterzellen_Gemeinde_Mapping",
    "Gitterzellen_Einwohner_Mapping",
    "Verwaltungsgebiete_Mapping",
    "Gemeindegrenzen_Polygone",
    "Kreisgrenzen_Polygone",
    "Landesgrenzen_Polygone",
    "Regierungsbezirksgrenzen_Polygone",
    "Krankenhaus_Standortliste",
)
GEOMETRY_TABLES = (
    "Gemeindegrenzen_Polygone",
    "Kreisgrenzen_Polygone",
    "Landesgrenzen_Polygone",
    "Regierungsbezirksgrenzen_Polygone",
    "Krankenhaus_Standortliste",
)
# A filtered extract is as large as what was asked for, so it is chunked too.
LARGE_TABLES = ("Entfernungsdaten", "Entfernungsdaten_subset")

# Accepted names of the two grid-cell layouts.
LAYOUT_COMBINED = "Gemeinde_and_Einwohner_mapping_combined"
LAYOUT_SPLIT = "Gemeinde_and_Einwohner_mapping_split"

FACT_COLUMNS = [CELL, HOSPITAL, SECONDS, METRES]
ADMIN_COLUMNS = [
    "Gemeindeschluessel",
    "Gemeindename",
    "Gemeinde_ID",
    "Kreis",
    "Kreis_ID",
    "Regierungsbezirk",
    "Regierungsbezirk_ID",
    "Bundesland",
    "Bundesland_ID",
]


def strings(*names: str) -> T.StructType:
    """Schema of nullable string columns; keys keep their leading zeros."""
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


FACT_SCHEMA = T.StructType(
    [
        T.StructField(CELL, T.StringType()),
        T.StructField(HOSPITAL, T.StringType()),
        T.StructField(SECONDS, T.IntegerType()),
        T.StructField(METRES, T.IntegerType()),
    ]
)
ADMIN_SCHEMA = strings(*ADMIN_COLUMNS)
TEMPLATE_COLUMNS = ["Bundesland", "Regierungsbezirk", "Kreis", "Gemeindename"]


@dataclass(frozen=True)
class Level:
    """One administrative level and the columns that identify a unit on it."""

    name: str
    id_col: str
    name_col: str

    @property
    def group_cols(self) -> list[str]:
        # The state is always shown for context; on state level it is the unit.
        return list(
            dict.fromkeys([self.id_col, self.name_col, "Bundesland", "Bundesland_ID"])
        )


LEVELS = {
    level.name: level
    for level in (
        Level("Gemeinde", "Gemeindeschluessel", "Gemeindename"),
        Level("Kreis", "Kreis_ID", "Kreis"),
        Level("Regierungsbezirk", "Regierungsbezirk_ID", "Regierungsbezirk"),
        Level("Bundesland", "Bundesland_ID", "Bundesland"),
    )
}


def one_of(value: str, allowed: Iterable[str], what: str) -> str:
    allowed = list(allowed)
    if value not in allowed:
        raise ValueError(f"{what} must be one of {', '.join(allowed)}; got: {value}")
    return value


def require_columns(df: DataFrame, columns: Iterable[str]) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError("Missing required columns: " + ", ".join(missing))
