"""GeoJSON collections and the export document of the map frontend."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reachgrid.operators.publish import (
    HOSPITAL_PROPERTIES,
    SITE_ID,
    UNIT_PROPERTIES,
    add_empty_scenario2_columns,
    build_scenario_properties,
    clinic_properties,
    join_properties_to_polygons,
    to_features,
)
from reachgrid.operators.summary import compute_percentage_covered, filter_by_coverage
from reachgrid.schema import HOSPITAL, one_of
from reachgrid.session import stored
from reachgrid.sinks.documents import (
    item_lines,
    json_text,
    lines,
    text_line,
    value_line,
)

# Constants of the published documents.
CRS = {"type": "name", "properties": {"name": "urn:ogc:def:crs:OGC:1.3:CRS84"}}
EXPORT_VERSION = "1.0"
RESULT_MODES = ("fahrtzeit_scenario_1", "fahrtzeit_scenario_2", "fahrtzeit_difference")
NO_FILTERS = {"bundesland": [], "kreis": [], "gemeinde": []}


def utc_now() -> str:
    return datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")


@dataclass(frozen=True)
class ScenarioInfo:
    """Metadata of a published scenario: its hospitals and their coverage.

    ``percentage`` is a table of one row with the column percentage_covered.
    """

    hospitals: DataFrame | None = None
    percentage: DataFrame | None = None
    created_at: str | None = None


@dataclass(frozen=True)
class Collection:
    """A feature collection before it is laid out as a document."""

    features: DataFrame
    scenario1: ScenarioInfo | None = None
    scenario2: ScenarioInfo | None = None
    #: The same collection with what a document reads several times stored.
    with_stored: Callable[[], Collection] | None = None


def _quoted(text: Column) -> Column:
    """JSON string of a text column."""
    array = F.to_json(F.array(text))
    return F.substring(array, F.lit(2), F.length(array) - 2)


def _hospital_items(hospitals: DataFrame, suffix: str = "") -> DataFrame:
    number = F.col(HOSPITAL).cast("string")
    return hospitals.select(
        number.alias("key"), F.concat(_quoted(number), F.lit(suffix)).alias("line")
    )


class _Layout:
    """Collects the parts of a document in order."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.parts: list[DataFrame] = []
        self.text = ""

    def add_text(self, text: str) -> None:
        self.text += text

    def _flush(self) -> None:
        if self.text:
            self.parts.append(text_line(self.spark, len(self.parts), self.text))
            self.text = ""

    def add_items(self, items: DataFrame) -> None:
        self._flush()
        self.parts.append(item_lines(items, len(self.parts)))

    def add_value(self, one_row: DataFrame, value: Column) -> None:
        self._flush()
        self.parts.append(value_line(one_row, len(self.parts), value))

    def add_scenario(self, info: ScenarioInfo) -> None:
        self.add_text('{"list":[')
        if info.hospitals is not None:
            self.add_items(_hospital_items(info.hospitals))
        self.add_text('],"hash":"","percentage_covered":')
        if info.percentage is None:
            self.add_text("null")
        else:
            number = F.round("percentage_covered", 4).cast("string")
            self.add_value(info.percentage, F.coalesce(number, F.lit("null")))
        created = json_text(info.created_at or utc_now())
        self.add_text(f',"created_at":{created}}}')

    def add_collection(self, collection: Collection) -> None:
        if collection.with_stored is not None:
            collection = collection.with_stored()
        crs = json_text(CRS)
        self.add_text(f'{{"type":"FeatureCollection","crs":{crs},"features":[')
        self.add_items(stored(collection.features, "features"))
        self.add_text("]")
        if collection.scenario1 is not None:
            self.add_text(',"mainHash":"","scenario1":')
            self.add_scenario(collection.scenario1)
        if collection.scenario2 is not None:
            self.add_text(',"scenario2":')
            self.add_scenario(collection.scenario2)
        self.add_text("}")

    def document(self) -> DataFrame:
        self._flush()
        return lines(*self.parts)


def assemble_feature_collection(collection: Collection) -> DataFrame:
    """The collection as document lines."""
    layout = _Layout(collection.features.sparkSession)
    layout.add_collection(collection)
    return layout.document()


def szenario_to_geojson(
    summary: DataFrame,
    polygons: DataFrame,
    hospitals: DataFrame | None = None,
    grenzwert_abdeckung: float = 99,
    created_at: str | None = None,
) -> Collection:
    """Every municipality polygon with the times of a scenario.

    Units covered to less than the threshold are published without values; the
    overall coverage counts them. A document stores the summary, one row per
    unit, when it is assembled, because it reads it several times.
    """

    def build(summary: DataFrame, again: Callable | None = None) -> Collection:
        covered = filter_by_coverage(summary, grenzwert_abdeckung)
        properties = add_empty_scenario2_columns(build_scenario_properties(covered))
        joined = join_properties_to_polygons(polygons, properties)
        info = ScenarioInfo(hospitals, compute_percentage_covered(summary), created_at)
        features = to_features(joined, UNIT_PROPERTIES, "AGS")
        return Collection(features, info, with_stored=again)

    return build(summary, lambda: build(stored(summary, "summary")))


def kliniken_to_geojson(sites: DataFrame, admin_units: DataFrame) -> Collection:
    """Every hospital site with its names, as a collection of points."""
    properties = clinic_properties(sites, admin_units)
    return Collection(to_features(properties, HOSPITAL_PROPERTIES, SITE_ID))


def _has_rows(df: DataFrame) -> DataFrame:
    return df.agg((F.count(F.lit(1)) > 0).cast("string").alias("answer"))


def build_export_json(
    clinics: Collection,
    results: Collection,
    results_mode: str = "fahrtzeit_scenario_1",
    result_geo_filters: dict[str, list[str]] | None = None,
    timestamp: str | None = None,
) -> DataFrame:
    """The document the map frontend imports: selection, results, hospitals.

    Both selections are always present, as empty objects where nothing is
    selected; the second scenario of the results is left out if there is none.
    """
    one_of(results_mode, RESULT_MODES, "results_mode")
    stamp = timestamp or utc_now().replace("Z", ".000Z")
    layout = _Layout(results.features.sparkSession)
    layout.add_text(
        f'{{"version":{json_text(EXPORT_VERSION)},"timestamp":{json_text(stamp)}'
    )
    selected = [
        info.hospitals.select(HOSPITAL).distinct()
        if info is not None and info.hospitals is not None
        else None
        for info in (results.scenario1, results.scenario2)
    ]
    for number, hospitals in enumerate(selected, start=1):
        layout.add_text(f',"checkedClinicsScenario{number}":{{')
        if hospitals is not None:
            layout.add_items(_hospital_items(hospitals, ":true"))
        layout.add_text("}")
    layout.add_text(f',"resultsMode":{json_text(results_mode)},"scenario2Visible":')
    if selected[1] is None:
        layout.add_text("false")
    else:
        layout.add_value(_has_rows(selected[1]), F.col("answer"))
    filters = NO_FILTERS if result_geo_filters is None else result_geo_filters
    layout.add_text(f',"resultGeoFilters":{json_text(filters)},"results":')
    layout.add_collection(results)
    layout.add_text(',"clinics":')
    layout.add_collection(clinics)
    layout.add_text("}")
    return layout.document()
