import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from reachgrid.operators.analyses import (
    einzugsgebiet,
    erreichbare_gebiete,
    fahrzeit_kategorien,
    naechstes_krankenhaus,
    redundanz_analyse,
    schliessung_simulieren,
    schliessungen_einzeln,
    zeitreihen_vergleich,
)
from tests.conftest import rows

SCHEMA = (
    "Gitterzellen_ID string, Krankenhaus_Standortnummer string, "
    "Fahrzeit_Sekunden int, Einwohner int, Gemeindename string"
)


def table(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


DATA = [
    ("1", "a", 600, 10, "Ort"),
    ("1", "b", 900, 10, "Ort"),
    ("2", "a", 1200, 20, "Ort"),
    ("2", "b", 1200, 20, "Ort"),
    ("3", "b", 60, 30, None),
]


def test_nearest_and_catchment(spark):
    df = table(spark, *DATA)
    assert {(r[0], r.Krankenhaus_Standortnummer) for r in naechstes_krankenhaus(df).collect()} == {
        ("1", "a"), ("2", "a"), ("3", "b")
    }
    assert rows(einzugsgebiet(df)) == [("a", 30, 1), ("b", 30, 1)]


def test_closure(spark):
    df = table(spark, *DATA)
    closed = spark.createDataFrame([("a",)], "Krankenhaus_Standortnummer string")
    keys = ["Gitterzellen_ID", "Einwohner", "Gemeindename"]
    out = schliessung_simulieren(df, closed, ["Gemeindename"], keys)
    found = {r.Gemeindename: r for r in out.collect()}
    assert found["Ort"].Mittlere_Gewichtete_Fahrzeit_Differenz == pytest.approx(5 * 10 / 30)
    assert found["Ort"].Anzahl_Betroffene == 10
    assert found[None].Anzahl_Betroffene == 0


def test_every_closure_at_once_equals_each_alone(spark):
    random.seed(12)
    names = ["a", "b", "c", "d", None]
    data = [
        (f"c{random.randint(0, 25)}", random.choice(names), random.choice([None, 1, 60, 90, 600]))
        for _ in range(90)
    ]
    data += [("copies", "a", 5)] * 60 + [("copies", "b", 5), ("lonely", "d", 3), (None, "c", 7)]
    times = spark.createDataFrame(data, SCHEMA.rpartition(", Einwohner")[0])
    cells = {d[0] for d in data if d[0] is not None}
    units = spark.createDataFrame(
        [(c, random.choice([None, 0, 10, 25]), random.choice(["X", "Y", None])) for c in sorted(cells)],
        "Gitterzellen_ID string, Einwohner long, Kreis string",
    )
    keys = ["Gitterzellen_ID", "Einwohner", "Kreis"]
    every = defaultdict(dict)
    for r in schliessungen_einzeln(times, ["Kreis"], units).collect():
        every[r.Krankenhaus_Standortnummer][r.Kreis] = tuple(r)[2:]
    assert set(every) <= set(names) - {None}
    for name in names[:-1]:
        closed = spark.createDataFrame([(name,)], "Krankenhaus_Standortnummer string")
        alone = schliessung_simulieren(times, closed, ["Kreis"], keys, units).collect()
        for r in alone:
            if r.Kreis in every[name]:
                assert every[name][r.Kreis] == pytest.approx(tuple(r)[1:]), (name, r)
            else:
                assert not r.Anzahl_Betroffene and not r.Mittlere_Gewichtete_Fahrzeit_Differenz


def test_reach_includes_the_limit(spark):
    df = erreichbare_gebiete(table(spark, *DATA), "a", 10)
    assert [r.Gitterzellen_ID for r in df.collect()] == ["1"]


def test_bands(spark):
    times = [(t,) for t in (0, 900, 901, 1800, 3600, 3601, None)]
    df = fahrzeit_kategorien(spark.createDataFrame(times, "Fahrzeit_Sekunden int"))
    assert [r.Fahrzeit_Kategorie for r in df.collect()] == [
        "≤ 15 min", "≤ 15 min", "15-30 min", "15-30 min", "30-60 min", "> 60 min", None
    ]
    named = fahrzeit_kategorien(
        spark.createDataFrame(times[:1], "Fahrzeit_Sekunden int"), (10,), ["nah", "fern"]
    )
    assert named.collect()[0].Fahrzeit_Kategorie == "nah"
    with pytest.raises(ValueError, match="labels"):
        fahrzeit_kategorien(named, (10,), ["nah"])


def test_time_points(spark):
    df = zeitreihen_vergleich(
        {"2020": table(spark, *DATA[:2]), "2024": table(spark, *DATA)}, ["Gemeindename"]
    )
    assert {(r.Gemeindename, r.Zeitpunkt): r.Einwohner_Gesamt for r in df.collect()} == {
        ("Ort", "2020"): 20, ("Ort", "2024"): 60, (None, "2024"): 30
    }


@pytest.mark.parametrize("n", [1, 2, 5])
def test_redundancy_against_brute_force(spark, n):
    """Copies, ties and a cell with a third of the rows."""
    random.seed(n)
    data = [("heavy", f"h{random.randint(0, 9)}", random.randint(0, 5)) for _ in range(100)]
    data += [("copies", "h1", 7)] * 100
    data += [
        (f"c{random.randint(0, 20)}", f"h{random.randint(0, 9)}",
         random.choice([None, 1, 2, 3]))
        for _ in range(100)
    ]
    cells = defaultdict(list)
    for cell, hospital, seconds in data:
        if seconds is not None:
            cells[cell].append((seconds, hospital))
    expected = []
    for cell, found in cells.items():
        found.sort()
        limit = found[min(n, len(found)) - 1][0]
        expected += [
            (cell, h, s, i + 1) for i, (s, h) in enumerate(found) if s <= limit
        ]
    df = spark.createDataFrame(
        data,
        "Gitterzellen_ID string, Krankenhaus_Standortnummer string, Fahrzeit_Sekunden int",
    )
    out = redundanz_analyse(df, n).withColumn("Rang", F.col("Rang").cast("int"))
    assert sorted(map(tuple, out.collect())) == sorted(expected)
