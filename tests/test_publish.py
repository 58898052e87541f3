import json

import pytest
from pyspark.sql import functions as F

from reachgrid.functions.geometry import point_wkb, square_wkb
from reachgrid.operators.publish import (
    UNIT_PROPERTIES,
    add_empty_scenario2_columns,
    build_scenario_properties,
    clinic_properties,
    join_properties_to_polygons,
    to_features,
)
from reachgrid.plans.publish import (
    Collection,
    ScenarioInfo,
    assemble_feature_collection,
    build_export_json,
    kliniken_to_geojson,
    szenario_to_geojson,
)
from reachgrid.sinks.documents import item_lines, write_document, write_features

SPACE = '<span style="font-size:50%;"> </span>'
SUMMARY = (
    "Gemeindeschluessel string, Gemeindename string, Einwohner_Gesamt double, "
    "Mittlere_Gewichtete_Fahrzeit double, Anzahl_Gitterzellen double, "
    "Anzahl_bewohnte_Gitterzellen double, Prozent_Abgedeckt_pro_Gemeinde double"
)


def summary(spark, *data):
    return spark.createDataFrame(list(data), SUMMARY)


def polygons(spark, *keys):
    df = spark.createDataFrame(
        [(k, f"Stadt {k}", float(i)) for i, k in enumerate(keys)],
        "Gemeindeschluessel string, Gemeindename string, x double",
    )
    return df.select(
        "Gemeindeschluessel",
        "Gemeindename",
        square_wkb(F.col("x"), F.lit(0.0)).alias("geometry"),
    )


def hospitals(spark, *ids):
    return spark.createDataFrame([(i,) for i in ids], "Krankenhaus_Standortnummer string")


def parsed(document, tmp_path, name="doc"):
    path = tmp_path / name
    write_document(document, str(path))
    text = "".join(p.read_text() for p in sorted(path.glob("part-*")))
    return json.loads(text)


def test_properties(spark):
    df = build_scenario_properties(
        summary(spark, ("01234567", "Nordhafen", 40817.0, 8.6125, 3.0, 3.0, 100.0))
    )
    assert df.columns == [
        "AGS",
        "GEN",
        "EWZ",
        "fahrtzeit_scenario_1",
        "fahrtzeit_scenario_1_str",
    ]
    assert tuple(df.collect()[0]) == (
        "01234567",
        "Nordhafen",
        f"40{SPACE}817",
        8.6125,
        "8,6 Minuten",
    )
    with pytest.raises(ValueError, match="Missing required columns"):
        build_scenario_properties(spark.range(1))


def test_second_scenario_is_empty(spark):
    df = add_empty_scenario2_columns(spark.range(1))
    assert tuple(df.collect()[0])[1:] == (None, "keine Daten", None, "keine Daten")


def test_polygons_all_survive(spark):
    properties = add_empty_scenario2_columns(
        build_scenario_properties(summary(spark, ("A", None, 6400.0, 27.5, 1.0, 1.0, 100.0)))
    )
    df = join_properties_to_polygons(polygons(spark, "A", "B"), properties)
    found = {r.AGS: (r.GEN, r.EWZ, r.fahrtzeit_scenario_1) for r in df.collect()}
    assert found == {
        "A": ("Stadt A", f"6{SPACE}400", 27.5),
        "B": ("Stadt B", None, None),
    }


def test_scenario_document(spark, tmp_path):
    data = summary(
        spark,
        ("A", "Stadt A", 7300.0, 18.25, 50.0, 50.0, 100.0),
        ("B", "Stadt B", 910.0, 41.5, 50.0, 100.0, 50.0),
    )
    collection = szenario_to_geojson(
        data, polygons(spark, "A", "B", "C"), hospitals(spark, "H1", "H2"),
        created_at="2024-01-01T00:00:00Z",
    )
    doc = parsed(assemble_feature_collection(collection), tmp_path)
    assert list(doc) == ["type", "crs", "features", "mainHash", "scenario1"]
    assert doc["crs"]["properties"]["name"] == "urn:ogc:def:crs:OGC:1.3:CRS84"
    assert doc["scenario1"] == {
        "list": ["H1", "H2"],
        "hash": "",
        "percentage_covered": 66.6667,
        "created_at": "2024-01-01T00:00:00Z",
    }
    features = {f["properties"]["AGS"]: f for f in doc["features"]}
    assert list(features) == ["A", "B", "C"]
    assert list(features["A"]["properties"]) == UNIT_PROPERTIES
    assert features["A"]["properties"]["fahrtzeit_scenario_1"] == 18.25
    assert features["A"]["geometry"]["type"] == "Polygon"
    # Covered too little, or not at all: kept without values.
    for key in "BC":
        values = features[key]["properties"]
        assert values["GEN"] == f"Stadt {key}"
        assert values["EWZ"] is None and values["fahrtzeit_scenario_1"] is None
    lines = tmp_path / "lines"
    write_features(collection.features, str(lines))
    text = "".join(p.read_text() for p in lines.glob("part-*"))
    assert len([json.loads(line) for line in text.splitlines()]) == 3


def test_collection_without_metadata_or_features(spark, tmp_path):
    empty = szenario_to_geojson(
        summary(spark), polygons(spark, "A").limit(0), None, created_at="x"
    )
    doc = parsed(assemble_feature_collection(empty), tmp_path)
    assert doc["features"] == []
    assert doc["scenario1"]["list"] == []
    assert doc["scenario1"]["percentage_covered"] == 0
    second = Collection(empty.features, empty.scenario1, ScenarioInfo(created_at="y"))
    doc = parsed(assemble_feature_collection(second), tmp_path, "two")
    assert doc["scenario2"] == {
        "list": [], "hash": "", "percentage_covered": None, "created_at": "y"
    }


def sites(spark):
    df = spark.createDataFrame(
        [
            ("K2", "02", "Klinik", "Stadt", "Weg 1", "A", 8.0),
            ("K1", "01", "Haus", None, 'Weg "2"', "Z", 9.0),
            ("K2", "02", "Klinik", "Stadt", "Weg 1", "A", 8.0),
        ],
        "Krankenhaus_Standort_ID string, Krankenhaus_Standortnummer string, "
        "Bezeichnung string, `Träger` string, Adresse string, "
        "Gemeindeschluessel string, x double",
    )
    return df.withColumn("geometry", point_wkb(F.col("x"), F.lit(50.0))).drop("x")


def admin(spark):
    return spark.createDataFrame(
        [("A", "Ort", "Kreis", "Land")],
        "Gemeindeschluessel string, Gemeindename string, Kreis string, Bundesland string",
    )


def test_clinics(spark, tmp_path):
    df = clinic_properties(sites(spark), admin(spark)).orderBy("Krankenhaus_Standort_ID")
    assert [(r.id, r.name, r.kreis) for r in df.collect()] == [
        ("01", "Haus", None),
        ("02", "Klinik (Stadt)", "Kreis"),
    ]
    clinics = kliniken_to_geojson(sites(spark), admin(spark))
    doc = parsed(assemble_feature_collection(clinics), tmp_path)
    assert list(doc) == ["type", "crs", "features"]
    assert doc["features"][0] == {
        "type": "Feature",
        "properties": {
            "id": "01",
            "name": "Haus",
            "adress": 'Weg "2"',
            "bundesland": None,
            "kreis": None,
            "gemeinde": None,
        },
        "geometry": {"type": "Point", "coordinates": [9, 50]},
    }


def test_export_document(spark, tmp_path):
    data = summary(spark, ("A", "Stadt A", 1.0, 2.0, 1.0, 1.0, 100.0))
    results = szenario_to_geojson(data, polygons(spark, "A"), hospitals(spark, "H1", "H1"))
    clinics = kliniken_to_geojson(sites(spark), admin(spark))
    doc = parsed(build_export_json(clinics, results, timestamp="t"), tmp_path)
    assert list(doc) == [
        "version",
        "timestamp",
        "checkedClinicsScenario1",
        "checkedClinicsScenario2",
        "resultsMode",
        "scenario2Visible",
        "resultGeoFilters",
        "results",
        "clinics",
    ]
    assert doc["version"] == "1.0"
    assert doc["checkedClinicsScenario1"] == {"H1": True}
    assert doc["checkedClinicsScenario2"] == {}
    assert doc["scenario2Visible"] is False
    assert doc["resultGeoFilters"] == {"bundesland": [], "kreis": [], "gemeinde": []}
    assert "scenario2" not in doc["results"]
    assert len(doc["clinics"]["features"]) == 2
    both = Collection(
        results.features, results.scenario1, ScenarioInfo(hospitals(spark, "H2"))
    )
    doc = parsed(
        build_export_json(clinics, both, "fahrtzeit_difference", {"kreis": ["K"]}),
        tmp_path,
        "both",
    )
    assert doc["checkedClinicsScenario2"] == {"H2": True}
    assert doc["scenario2Visible"] is True
    assert doc["resultsMode"] == "fahrtzeit_difference"
    with pytest.raises(ValueError, match="results_mode"):
        build_export_json(clinics, results, "anders")


def test_features_round_and_blank_numbers(spark):
    df = spark.createDataFrame(
        [("A", 1.23456789, float("nan"))], "k string, a double, b double"
    ).withColumn("geometry", F.lit(None).cast("binary"))
    feature = json.loads(to_features(df, ["a", "b"], "k").collect()[0].line)
    assert feature == {
        "type": "Feature",
        "properties": {"a": 1.2346, "b": None},
        "geometry": None,
    }


def test_equal_items_are_all_written(spark):
    """Copies of the first element must not lose or double a comma."""
    items = spark.createDataFrame(
        [("a", "{}")] * 3 + [("a", '{"x":1}'), ("b", "{}"), (None, "[]")],
        "key string, line string",
    )
    lines = item_lines(items, 0).orderBy("section", "key", "line").collect()
    values = json.loads("[" + "".join(r.line for r in lines) + "]")
    assert values == [[], {"x": 1}, {}, {}, {}, {}]
