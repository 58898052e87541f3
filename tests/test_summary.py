import pytest
from pyspark.sql import functions as F

from reachgrid.operators.summary import (
    add_coverage,
    clean_thresholds,
    compute_percentage_covered,
    fahrzeit_zusammenfassung,
    filter_by_coverage,
    inhabited_cells,
    summarise_threshold,
    summarise_times,
    threshold_of_times,
)

SCHEMA = (
    "Gemeinde string, Gitterzellen_ID string, Fahrzeit_Sekunden double, Einwohner double"
)
THREE = [("A", "G1", 1200.0, 100.0), ("A", "G2", 1800.0, 200.0), ("A", "G3", 2400.0, 150.0)]


def summary(spark, data, thresholds=None, by=("Gemeinde",), **options):
    df = spark.createDataFrame(data, SCHEMA)
    return fahrzeit_zusammenfassung(df, list(by), thresholds, **options)


def one(df):
    (row,) = df.collect()
    return row


def test_total_mean_and_cells(spark):
    row = one(summary(spark, THREE[:2]))
    assert row.Einwohner_Gesamt == 300
    assert row.Mittlere_Gewichtete_Fahrzeit == pytest.approx((20 * 100 + 30 * 200) / 300)
    assert row.Anzahl_Gitterzellen == 2
    assert "Anzahl_Betroffene" not in row


def test_groups_are_separate(spark):
    data = THREE + [("B", "G4", 600.0, 10.0)]
    found = {r.Gemeinde: r.Einwohner_Gesamt for r in summary(spark, data).collect()}
    assert found == {"A": 450, "B": 10}


def test_repeated_cells_count_once(spark):
    data = [("A", g, 1200.0, 1.0) for g in ("G1", "G2", "G1", "G2")]
    assert one(summary(spark, data)).Anzahl_Gitterzellen == 2


def test_a_missing_cell_counts_as_one_value(spark):
    data = [("A", "G1", 1.0, 1.0), ("A", None, 1.0, 1.0), ("A", None, 1.0, 1.0)]
    assert one(summary(spark, data)).Anzahl_Gitterzellen == 2


def test_single_threshold(spark):
    row = one(summary(spark, THREE, 25))
    assert row.Anzahl_Betroffene == 350
    assert row.Prozent_Betroffene == pytest.approx(350 / 450 * 100)


def test_threshold_itself_is_not_beyond(spark):
    assert one(summary(spark, THREE, 40)).Anzahl_Betroffene == 0


def test_missing_time_leaves_the_mean(spark):
    data = [("A", "G1", 1200.0, 100.0), ("A", "G2", None, 200.0), ("A", "G3", 1800.0, 150.0)]
    row = one(summary(spark, data, 10))
    assert row.Mittlere_Gewichtete_Fahrzeit == 26
    assert row.Einwohner_Gesamt == 450
    assert row.Anzahl_Betroffene == 250


def test_nan_is_missing(spark):
    nan = float("nan")
    row = one(summary(spark, [("A", "G1", nan, 5.0), ("A", "G2", 600.0, nan)], 1))
    assert row.Einwohner_Gesamt == 5
    assert row.Anzahl_Betroffene == 0
    assert row.Mittlere_Gewichtete_Fahrzeit is None


def test_missing_weight_makes_the_mean_unknown_but_not_the_total(spark):
    data = [("A", "G1", 1200.0, 100.0), ("A", "G2", 1800.0, None), ("A", "G3", 2400.0, 150.0)]
    row = one(summary(spark, data))
    assert row.Einwohner_Gesamt == 250
    assert row.Mittlere_Gewichtete_Fahrzeit is None


def test_missing_weight_of_a_missing_time_does_no_harm(spark):
    data = [("A", "G1", 1200.0, 100.0), ("A", "G2", None, None)]
    assert one(summary(spark, data)).Mittlere_Gewichtete_Fahrzeit == 20


def test_no_inhabitants_at_all(spark):
    row = one(summary(spark, [("A", "G1", 1200.0, None), ("A", "G2", None, None)], 5))
    assert row.Einwohner_Gesamt == 0
    assert row.Mittlere_Gewichtete_Fahrzeit is None
    assert row.Anzahl_Betroffene == 0
    assert row.Prozent_Betroffene is None


def test_zero_weights(spark):
    row = one(summary(spark, [("A", "G1", 1200.0, 0.0), ("A", "G2", 1800.0, 0.0)]))
    assert row.Mittlere_Gewichtete_Fahrzeit is None


def test_several_thresholds(spark):
    df = summary(spark, THREE, [30, 60])
    assert df.columns[-4:] == [
        "Anzahl_Betroffene_30min",
        "Anzahl_Betroffene_60min",
        "Prozent_Betroffene_30min",
        "Prozent_Betroffene_60min",
    ]
    row = one(df)
    assert row.Anzahl_Betroffene_30min == 150
    assert row.Prozent_Betroffene_30min == pytest.approx(150 / 450 * 100)
    assert (row.Anzahl_Betroffene_60min, row.Prozent_Betroffene_60min) == (0, 0)


def test_missing_and_repeated_thresholds_are_ignored(spark):
    assert clean_thresholds([30, None, 60, 30, float("nan")]) == [30, 60]
    assert clean_thresholds(None) == clean_thresholds([]) == []
    dirty = summary(spark, THREE, [30, None, 60, 30])
    clean = summary(spark, THREE, [30, 60])
    assert dirty.columns == clean.columns
    assert dirty.collect() == clean.collect()


def test_single_threshold_equals_the_column_of_several(spark):
    single = one(summary(spark, THREE, 30))
    several = one(summary(spark, THREE, [30, 60]))
    assert single.Anzahl_Betroffene == several.Anzahl_Betroffene_30min
    assert single.Prozent_Betroffene == several.Prozent_Betroffene_30min


def test_empty_table(spark):
    df = summary(spark, [], [30, 60])
    assert df.count() == 0
    assert "Anzahl_Betroffene_30min" in df.columns


def test_copies_stand_for_rows(spark):
    times = spark.createDataFrame(THREE, SCHEMA).withColumn("n", F.lit(3))
    counted = one(fahrzeit_zusammenfassung(times, ["Gemeinde"], 25, copies="n"))
    repeated = one(summary(spark, THREE * 3, 25))
    assert counted == repeated


def test_summary_of_times_equals_summary_of_rows(spark):
    """Copies, unknown times and people, unmapped cells, one heavy cell."""
    times = spark.range(900).select(
        F.when(F.col("id") < 300, "heavy")
        .otherwise(F.concat(F.lit("G"), (F.col("id") % 23).cast("string")))
        .alias("Gitterzellen_ID"),
        F.when(F.col("id") % 11 != 0, F.col("id") % 50 * 60.0).alias("Fahrzeit_Sekunden"),
    )
    units = times.select("Gitterzellen_ID").distinct().select(
        "Gitterzellen_ID",
        F.when(F.col("Gitterzellen_ID") == "G3", None).otherwise(7).alias("Einwohner"),
        F.substring("Gitterzellen_ID", 2, 1).alias("Kreis"),
    ).filter("Gitterzellen_ID <> 'G5'")
    rows = times.join(units, "Gitterzellen_ID", "left")
    for thresholds in (None, 20, [10, 20, None]):
        expected = fahrzeit_zusammenfassung(rows, ["Kreis"], thresholds)
        found = summarise_times(times, units, ["Kreis"], thresholds)
        assert found.columns == expected.columns
        by_unit = {r.Kreis: r.asDict() for r in expected.collect()}
        assert by_unit.keys() == {r.Kreis for r in found.collect()}
        for row in found.collect():
            want = by_unit[row.Kreis]
            got = row.asDict()
            for name, value in want.items():
                exact = value is None or isinstance(value, str)
                assert got[name] == (value if exact else pytest.approx(value)), name


def test_threshold_summary_names_its_threshold(spark):
    row = one(summarise_threshold(spark.createDataFrame(THREE, SCHEMA), ["Gemeinde"], 25))
    assert (row.Anzahl_Betroffene, row.Schwellenwert) == (350, 25.0)


def test_missing_columns(spark):
    with pytest.raises(ValueError, match="Missing required columns: Einwohner"):
        fahrzeit_zusammenfassung(
            spark.createDataFrame([("a", 1)], "Gitterzellen_ID string, Fahrzeit_Sekunden int"),
            ["Gitterzellen_ID"],
        )


def test_coverage_filter(spark):
    df = spark.createDataFrame(
        [("A", 100.0), ("B", 99.0), ("C", 98.0), ("D", None), ("E", float("nan"))],
        "Gemeindeschluessel string, Prozent_Abgedeckt_pro_Gemeinde double",
    )
    assert [r[0] for r in filter_by_coverage(df).collect()] == ["A", "B"]
    assert filter_by_coverage(df, 98).count() == 3
    with pytest.raises(ValueError):
        filter_by_coverage(df.drop("Prozent_Abgedeckt_pro_Gemeinde"))


def test_overall_coverage(spark):
    schema = "Anzahl_Gitterzellen double, Anzahl_bewohnte_Gitterzellen double"

    def covered(data):
        return one(compute_percentage_covered(spark.createDataFrame(data, schema)))[0]

    assert covered([(80.0, 100.0), (90.0, 100.0)]) == 85
    assert covered([(10.0, 0.0)]) == 0
    assert covered([]) == 0
    assert covered([(50.0, 100.0), (5.0, None)]) == pytest.approx(55)
    with pytest.raises(ValueError, match="Missing required columns"):
        compute_percentage_covered(spark.range(1))


def test_inhabited_cells_of_unknown_units_form_one_group(spark):
    cells = spark.createDataFrame(
        [("1", "a"), ("1", "a"), ("2", "a"), ("3", "x"), ("4", None)],
        "Gitterzellen_ID string, Gemeindeschluessel string",
    )
    units = spark.createDataFrame(
        [("a", "K")], "Gemeindeschluessel string, Kreis_ID string"
    )
    found = {r[0]: r[1] for r in inhabited_cells(cells, units, "Kreis").collect()}
    assert found == {"K": 2, None: 2}


def test_coverage_matches_the_missing_unit(spark):
    left = spark.createDataFrame(
        [("K", 1), (None, 3), ("L", 1)], "Kreis_ID string, Anzahl_Gitterzellen int"
    )
    right = spark.createDataFrame(
        [("K", 2), (None, 4)], "Kreis_ID string, Anzahl_bewohnte_Gitterzellen int"
    )
    found = {
        r.Kreis_ID: r.Prozent_Abgedeckt_pro_Gemeinde
        for r in add_coverage(left, right, "Kreis_ID").collect()
    }
    assert found == {"K": 50.0, None: 75.0, "L": None}


def test_level_names_are_checked(spark):
    with pytest.raises(ValueError, match="Verwaltungsebene"):
        inhabited_cells(spark.range(1), spark.range(1), "Stadt")


def test_threshold_of_times_equals_the_joined_form(spark):
    times = spark.createDataFrame(
        [("a", 600), ("a", 1800), ("a", None), ("b", 1500), ("c", 3000), ("d", 10)],
        "Gitterzellen_ID string, Fahrzeit_Sekunden int",
    )
    units = spark.createDataFrame(
        [("a", 10, "x"), ("b", 5, "x"), ("c", None, "y")],
        "Gitterzellen_ID string, Einwohner long, Kreis string",
    )
    found = threshold_of_times(times, units, ["Kreis"], 25)
    joined = times.join(units, "Gitterzellen_ID", "left")
    wanted = summarise_threshold(joined, ["Kreis"], 25)
    assert found.columns == wanted.columns
    key = lambda row: str(row[0])
    assert sorted(found.collect(), key=key) == sorted(wanted.collect(), key=key)
