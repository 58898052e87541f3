import pytest
from pyspark.sql import functions as F

from reachgrid.functions.text import (
    create_polygon_label,
    create_polygon_label_differenz,
    format_ewz,
    format_fahrtzeit,
    format_label_columns,
)

SPACE = '<span style="font-size:50%;"> </span>'


def text(spark, expression, *values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    return [r[0] for r in df.select(expression).collect()]


def test_minutes(spark):
    values = (7.062, None, 0.04, 48210.31, 33.3, float("nan"))
    assert text(spark, format_fahrtzeit(F.col("x")), *values) == [
        "7,1 Minuten",
        "keine Daten",
        "0,0 Minuten",
        "48 210,3 Minuten",
        "33,3 Minuten",
        "keine Daten",
    ]
    assert text(spark, format_fahrtzeit(F.col("x"), 2), 7.068) == ["7,07 Minuten"]


def test_minutes_round_the_binary_value(spark):
    assert text(spark, format_fahrtzeit(F.col("x"), 2), 0.125, 1.005, 0.375) == [
        "0,12 Minuten",
        "1,00 Minuten",
        "0,38 Minuten",
    ]


def test_people(spark):
    values = (20836417.0, None, 7.0, 3060.0, 92040.25, 811.0)
    assert text(spark, format_ewz(F.col("x")), *values) == [
        f"20{SPACE}836{SPACE}417",
        "keine Daten",
        "7",
        f"3{SPACE}060",
        f"92{SPACE}040,25",
        "811",
    ]


def labelled(spark, rows, schema, columns, **options):
    return format_label_columns(spark.createDataFrame(rows, schema), columns, **options)


def test_label_columns(spark):
    df = labelled(spark, [(1234.567, 300, "a")], "v double, n int, s string",
                  ["v", "n", "s", "absent"])
    row = df.collect()[0]
    assert (row.v_formatted, row.n_formatted, row.s_formatted) == ("1 234,6", "300", "a")
    assert "absent_formatted" not in df.columns


def test_label_column_digits_and_marks(spark):
    def value(**options):
        df = labelled(spark, [(1234.567,)], "v double", ["v"], **options)
        return df.collect()[0].v_formatted

    assert value(digits=0) == "1 235"
    assert value(digits=2) == "1 234,57"
    assert value(big_mark=",", decimal_mark=".") == "1,234.6"


def test_label_columns_missing_and_empty(spark):
    df = labelled(spark, [(123.0,), (None,), (456.0,)], "v double", ["v"])
    assert [r.v_formatted for r in df.collect()] == ["123,0", "NA", "456,0"]
    empty = labelled(spark, [], "v double", ["v"])
    assert empty.count() == 0 and "v_formatted" in empty.columns


BASE = "Gemeindename string, {value} double, Einwohner_Gesamt long"
LONG = BASE + ", Anzahl_Betroffene long, Prozent_Betroffene double"


@pytest.mark.parametrize(
    "label, value, caption",
    [
        (create_polygon_label, "Mittlere_Gewichtete_Fahrzeit", "Fahrzeit in min"),
        (
            create_polygon_label_differenz,
            "Mittlere_Gewichtete_Fahrzeit_Differenz",
            "Fahrzeit-Differenz in min",
        ),
    ],
)
def test_labels(spark, label, value, caption):
    short = spark.createDataFrame([("Ort", 26.67, 1300)], BASE.format(value=value))
    assert label(short, "Gemeindename").collect()[0].label == (
        f"<strong>Ort</strong><br/>{caption}: 26,7<br/>Einwohner:innen: 1 300"
    )
    long = spark.createDataFrame(
        [("Ort", 26.67, 1300, 200, 66.67)], LONG.format(value=value)
    )
    assert label(long, "Gemeindename").collect()[0].label == (
        f"<strong>Ort</strong><br/>{caption}: 26,7<br/>Einwohner:innen: 1 300"
        "<br/>Betroffene Einwohner:innen: 200<br/>Prozent Betroffene: 66,7%"
    )
    for column in (value, "Einwohner_Gesamt"):
        with pytest.raises(ValueError, match=f"Missing required columns: {column}"):
            label(short.drop(column), "Gemeindename")
    assert label(short.limit(0), "Gemeindename").count() == 0


@pytest.mark.parametrize("people, shown", [(300.0, "300"), (1300.0, "1 300"), (2.5, "2,5")])
def test_whole_counts_of_people_show_no_decimals(spark, people, shown):
    schema = (
        "Gemeindename string, Mittlere_Gewichtete_Fahrzeit double, Einwohner_Gesamt double, "
        "Anzahl_Betroffene double, Prozent_Betroffene double"
    )
    df = spark.createDataFrame([("Ort", 20.0, people, 200.0, 50.0)], schema)
    assert create_polygon_label(df, "Gemeindename").collect()[0].label == (
        f"<strong>Ort</strong><br/>Fahrzeit in min: 20,0<br/>Einwohner:innen: {shown}"
        "<br/>Betroffene Einwohner:innen: 200<br/>Prozent Betroffene: 50,0%"
    )


def test_several_thresholds_give_the_short_label(spark):
    df = spark.createDataFrame(
        [("Ort", 1.0, 2, 3)],
        BASE.format(value="Mittlere_Gewichtete_Fahrzeit") + ", Anzahl_Betroffene_30min long",
    )
    assert "Betroffene" not in create_polygon_label(df, "Gemeindename").collect()[0].label
