import random

import pytest
from pyspark.sql import functions as F

from reachgrid.operators.difference import (
    difference_cells,
    difference_of_times,
    fahrzeit_differenz_zusammenfassung,
)
from reachgrid.operators.nearest import (
    COPIES,
    REFERENCE,
    SCENARIO,
    nearest_times,
    nearest_times_compared,
)
from reachgrid.schema import CELL, SECONDS
from tests.conftest import rows

SCHEMA = "Gemeinde string, Fahrzeit_Sekunden double, Einwohner double"
KEYS = ["Gemeinde", "Einwohner"]


def compare(spark, reference, scenario):
    left = spark.createDataFrame(reference, SCHEMA)
    right = spark.createDataFrame(scenario, SCHEMA)
    df = fahrzeit_differenz_zusammenfassung(left, right, ["Gemeinde"], KEYS)
    return {r.Gemeinde: r for r in df.collect()}


def seconds(*minutes, people=(100.0, 200.0, 150.0)):
    return [("A", None if m is None else m * 60.0, p) for m, p in zip(minutes, people)]


@pytest.mark.parametrize(
    "before, after, people, mean, affected",
    [
        ((20, 30), (25, 35), (100.0, 200.0), 5, 300),
        ((30, 40), (20, 30), (100.0, 200.0), -10, 0),
        ((20, 30), (20, 30), (100.0, 200.0), 0, 0),
        ((20, 30, 40), (25, 35, 45), (100.0, 200.0, 150.0), 5, 450),
        ((20, 30, 40), (25, 30, 35), (100.0, 200.0, 150.0), -250 / 450, 100),
        ((20, 30, 40), (25, 25, 30), (100.0, 200.0, 300.0), -3500 / 600, 100),
        ((30, 40, 50), (20, 40, 40), (100.0, 200.0, 150.0), -2500 / 450, 0),
        ((20, None, 30), (25, 35, 35), (100.0, 200.0, 150.0), 5, 250),
        ((20, 30, 40), (25, None, 45), (100.0, 200.0, 150.0), 5, 250),
    ],
)
def test_mean_and_affected(spark, before, after, people, mean, affected):
    row = compare(
        spark, seconds(*before, people=people), seconds(*after, people=people)
    )["A"]
    assert row.Mittlere_Gewichtete_Fahrzeit_Differenz == pytest.approx(mean)
    assert row.Anzahl_Betroffene == affected
    assert row.Einwohner_Gesamt == sum(people)
    assert row.Prozent_Betroffene == pytest.approx(affected / sum(people) * 100)


def test_missing_key_equals_missing_key(spark):
    people = (100.0, None, 150.0)
    row = compare(
        spark, seconds(20, 30, 40, people=people), seconds(25, 35, 45, people=people)
    )["A"]
    assert row.Einwohner_Gesamt == 250
    assert row.Mittlere_Gewichtete_Fahrzeit_Differenz is None


def test_reference_rows_without_partner_stay(spark):
    reference = seconds(20, 30) + [("B", 2400.0, 150.0)]
    found = compare(spark, reference, seconds(25, 35))
    assert found["A"].Mittlere_Gewichtete_Fahrzeit_Differenz == pytest.approx(5)
    assert found["B"].Mittlere_Gewichtete_Fahrzeit_Differenz is None
    assert (found["B"].Einwohner_Gesamt, found["B"].Anzahl_Betroffene) == (150, 0)


def test_empty(spark):
    assert compare(spark, [], []) == {}


def test_cells_carry_both_times(spark):
    left = spark.createDataFrame(seconds(20) + [("C", 60.0, 1.0)], SCHEMA)
    right = spark.createDataFrame(seconds(25) + [("D", 60.0, 1.0)], SCHEMA)
    df = difference_cells(left, right, KEYS)
    assert set(df.columns) == {
        *KEYS,
        "Fahrzeit_Sekunden_Referenz",
        "Fahrzeit_Sekunden_Szenario",
        "Fahrzeit_Differenz_Minuten",
    }
    found = {r.Gemeinde: r.Fahrzeit_Differenz_Minuten for r in df.collect()}
    assert found == {"A": 5.0, "C": None}


def test_counted_summary_equals_the_rows_with_a_heavy_key(spark):
    """Ties on both sides multiply; a third of all rows sits on one key."""
    ids = spark.range(600).select(
        F.when(F.col("id") < 200, "A").otherwise(
            F.concat(F.lit("G"), (F.col("id") % 40).cast("string"))
        ).alias("Gemeinde"),
        (F.col("id") % 7 * 60).cast("double").alias("Fahrzeit_Sekunden"),
        F.lit(10.0).alias("Einwohner"),
    )
    other = ids.withColumn("Fahrzeit_Sekunden", F.col("Fahrzeit_Sekunden") + 30)
    cells = difference_cells(ids, other, KEYS)
    better = F.col("Fahrzeit_Differenz_Minuten") > 0
    expected = {
        r[0]: (r[1], pytest.approx(r[2]), r[3])
        for r in cells.groupBy("Gemeinde").agg(
            F.sum("Einwohner"),
            F.avg("Fahrzeit_Differenz_Minuten"),
            F.sum(F.when(better, F.col("Einwohner")).otherwise(0.0)),
        ).collect()
    }
    df = fahrzeit_differenz_zusammenfassung(ids, other, ["Gemeinde"], KEYS)
    found = {r[0]: (r[1], r[2], r[3]) for r in df.collect()}
    assert found == expected


def test_times_of_both_sides_in_two_scans(spark):
    """Minima and ties of both lists, as two separate runs give them."""
    random.seed(5)
    names = [f"h{i}" for i in range(8)]
    data = [("heavy", random.choice(names), random.randint(3, 6)) for _ in range(150)]
    data += [
        (f"c{random.randint(0, 30)}", random.choice(names),
         random.choice([None, 1, 2, 3]))
        for _ in range(200)
    ]
    times = spark.createDataFrame(
        data + [(None, "h1", 1)],
        "Gitterzellen_ID string, Krankenhaus_Standortnummer string, Fahrzeit_Sekunden int",
    )

    def listed(*chosen):
        return spark.createDataFrame([(c,) for c in chosen], "Krankenhaus_Standortnummer string")

    before, after = listed(*names[:5], "h1"), listed("h2", "h3", "h3", "h7")
    both = nearest_times_compared(times, before, after)
    old = {r[0]: (r[1], r[2]) for r in nearest_times(times, before).collect()}
    new = {r[0]: (r[1], r[2]) for r in nearest_times(times, after).collect()}
    found = {
        r[CELL]: (
            (r[SECONDS + REFERENCE], r[COPIES + REFERENCE]),
            (r[SECONDS + SCENARIO], r[COPIES + SCENARIO]),
        )
        for r in both.collect()
    }
    assert found == {c: (old[c], new.get(c, (None, None))) for c in old}

    units = spark.createDataFrame(
        [(c, i % 3, 10.0 * i if i % 4 else None) for i, c in enumerate(sorted(old)) if i % 7],
        "Gitterzellen_ID string, Kreis int, Einwohner double",
    )
    whole = fahrzeit_differenz_zusammenfassung(
        nearest_times(times, before).join(units, CELL, "left"),
        nearest_times(times, after).join(units, CELL, "left"),
        ["Kreis"],
        [CELL, "Kreis", "Einwohner"],
        copies=COPIES,
    )
    assert rows(difference_of_times(both, units, ["Kreis"])) == rows(whole)


def test_travel_times_are_read_once(spark, tmp_path):
    path = str(tmp_path / "ed")
    spark.createDataFrame(
        [("c", "h", 1)],
        "Gitterzellen_ID string, Krankenhaus_Standortnummer string, Fahrzeit_Sekunden int",
    ).write.parquet(path)
    listed = spark.createDataFrame([("h",)], "Krankenhaus_Standortnummer string")
    both = nearest_times_compared(spark.read.parquet(path), listed, listed)
    plan = both._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parquet") == 1
