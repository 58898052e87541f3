"""Map properties of units and hospitals, and their GeoJSON features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reachgrid.functions.geometry import geojson_geometry
from reachgrid.functions.numbers import STEADY_DIGITS, no_nan
from reachgrid.functions.text import NO_DATA, format_ewz, format_fahrtzeit
from reachgrid.schema import GEOMETRY, MUNICIPALITY, require_columns

# Property names of the published features, in output order.
UNIT_PROPERTIES = [
    "AGS",
    "GEN",
    "EWZ",
    "fahrtzeit_scenario_1_str",
    "fahrtzeit_scenario_2_str",
    "fahrtzeit_difference_str",
    "fahrtzeit_scenario_1",
    "fahrtzeit_scenario_2",
    "fahrtzeit_difference",
]
HOSPITAL_PROPERTIES = ["id", "name", "adress", "bundesland", "kreis", "gemeinde"]
SITE_ID = "Krankenhaus_Standort_ID"
OPERATOR = "Träger"
# Numbers are published with four decimals, coordinates included.
DIGITS = 4


def build_scenario_properties(summary: DataFrame) -> DataFrame:
    """Key, name, inhabitants and mean time of every unit, ready to show."""
    mean = "Mittlere_Gewichtete_Fahrzeit"
    require_columns(
        summary, ["Gemeindeschluessel", "Gemeindename", "Einwohner_Gesamt", mean]
    )
    time = F.round(no_nan(summary, mean), STEADY_DIGITS)
    return summary.select(
        F.col("Gemeindeschluessel").alias("AGS"),
        F.col("Gemeindename").alias("GEN"),
        format_ewz(F.col("Einwohner_Gesamt")).alias("EWZ"),
        time.alias("fahrtzeit_scenario_1"),
        format_fahrtzeit(time).alias("fahrtzeit_scenario_1_str"),
    )


def add_empty_scenario2_columns(properties: DataFrame) -> DataFrame:
    """The second scenario and the difference as not available."""
    return properties.withColumns(
        {
            "fahrtzeit_scenario_2": F.lit(None).cast("double"),
            "fahrtzeit_scenario_2_str": F.lit(NO_DATA),
            "fahrtzeit_difference": F.lit(None).cast("double"),
            "fahrtzeit_difference_str": F.lit(NO_DATA),
        }
    )


def join_properties_to_polygons(polygons: DataFrame, properties: DataFrame) -> DataFrame:
    """Every polygon with the properties of its unit, NULL where it has none.

    A polygon's own key is published, and its own name where the properties
    lack one.
    """
    require_columns(polygons, [MUNICIPALITY])
    joined = polygons.join(
        properties, polygons[MUNICIPALITY].eqNullSafe(properties["AGS"]), "left"
    )
    if "Gemeindename" in polygons.columns:
        joined = joined.withColumn("GEN", F.coalesce("GEN", "Gemeindename"))
    return joined.withColumn("AGS", F.col(MUNICIPALITY))


def clinic_properties(sites: DataFrame, admin_units: DataFrame) -> DataFrame:
    """One row per hospital site with its published properties and geometry.

    Where a site has several rows, the first by its other columns is kept.
    """
    require_columns(
        sites,
        [SITE_ID, "Krankenhaus_Standortnummer", "Bezeichnung", OPERATOR, "Adresse"],
    )
    units = admin_units.select(
        F.col(MUNICIPALITY).alias("_unit"), "Gemeindename", "Kreis", "Bundesland"
    )
    title = F.col("Bezeichnung")
    operator = F.col(OPERATOR)
    name = F.when(operator.isNull(), title).otherwise(
        F.concat(title, F.lit(" ("), operator, F.lit(")"))
    )
    joined = sites.join(
        units, sites[MUNICIPALITY].eqNullSafe(units["_unit"]), "left"
    ).select(
        SITE_ID,
        F.struct(
            F.col("Krankenhaus_Standortnummer").alias("id"),
            name.alias("name"),
            F.col("Adresse").alias("adress"),
            F.col("Bundesland").alias("bundesland"),
            F.col("Kreis").alias("kreis"),
            F.col("Gemeindename").alias("gemeinde"),
            F.col(GEOMETRY),
        ).alias("_row"),
    )
    return (
        joined.groupBy(SITE_ID)
        .agg(F.min("_row").alias("_row"))
        .select(SITE_ID, "_row.*")
    )


def _json_value(df: DataFrame, name: str) -> Column:
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return F.round(no_nan(df, name), DIGITS).alias(name)
    return F.col(name)


def properties_json(df: DataFrame, columns: list[str]) -> Column:
    """JSON object of the columns; missing values are written as null."""
    require_columns(df, columns)
    return F.to_json(
        F.struct(*(_json_value(df, c) for c in columns)), {"ignoreNullFields": "false"}
    )


def to_features(
    df: DataFrame,
    properties: list[str],
    key: str,
    geometry: str = GEOMETRY,
) -> DataFrame:
    """One GeoJSON Feature text per row, with its sort key."""
    require_columns(df, [key, geometry])
    feature = F.concat(
        F.lit('{"type":"Feature","properties":'),
        properties_json(df, properties),
        F.lit(',"geometry":'),
        F.coalesce(geojson_geometry(F.col(geometry), DIGITS), F.lit("null")),
        F.lit("}"),
    )
    return df.select(F.col(key).alias("key"), feature.alias("line"))
