import random

import pytest

from reachgrid.operators import filters
from reachgrid.operators.filters import (
    filter_by_cells,
    filter_by_hospitals,
    geofilter_cells,
    match_template,
    unmatched_template_rows,
    within,
)
from reachgrid.sinks.parquet import write_clustered
from tests.conftest import rows, scanned_rows

UNITS = [
    ("1", "Ort A", "Kreis 1", "RB 1", "Land 1"),
    ("2", "Ort B", "Kreis 1", "RB 1", "Land 1"),
    ("3", "Ort C", "Kreis 2", "RB 1", "Land 1"),
    ("4", "Ort A", "Kreis 3", "RB 2", "Land 2"),
    ("5", "Ort D", None, "RB 2", "Land 2"),
]
UNIT_SCHEMA = (
    "Gemeindeschluessel string, Gemeindename string, Kreis string, "
    "Regierungsbezirk string, Bundesland string"
)
COLUMNS = ["Bundesland", "Regierungsbezirk", "Kreis", "Gemeindename"]


def test_a_clustered_table_is_read_in_part(spark, tmp_path):
    """The same rows, from a few row groups of a table clustered by cell."""
    times = spark.range(300_000).selectExpr(
        "lpad(string(xxhash64(id) % 5000 + 5000), 6, '0') AS Gitterzellen_ID",
        "concat('h', string(id % 700)) AS Krankenhaus_Standortnummer",
        "int(id % 3000) AS Fahrzeit_Sekunden",
        "int(id) AS Fahrstrecke_Meter",
    )
    times.repartition(4).write.parquet(f"{tmp_path}/plain_chunks")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_clustered(times, str(tmp_path), "clustered", group_bytes=64 * 1024)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    area = spark.range(300).selectExpr("lpad(string(id + 700), 6, '0') AS Gitterzellen_ID")
    few = area.limit(20)
    for cells, share in ((area, 0.25), (few, 0.1)):
        found = {}
        for name in ("plain", "clustered"):
            table = spark.read.parquet(f"{tmp_path}/{name}_chunks")
            kept = filter_by_cells(within(table, cells, "Gitterzellen_ID"), cells)
            assert rows(kept) == rows(filter_by_cells(table, cells))
            sieve = within(table, cells, "Gitterzellen_ID").select("Fahrstrecke_Meter")
            found[name] = scanned_rows(sieve)
        assert found["clustered"] < share * found["plain"] and found["plain"] > 250_000


def test_scan_conditions(spark, monkeypatch):
    monkeypatch.setattr(filters, "LISTED", 3)
    monkeypatch.setattr(filters, "RANGES", 4)
    table = spark.createDataFrame([(c,) for c in "abcdefghijklmn"] + [(None,)], "k string")
    for listed in ("", "b", "nab", "acegikm"):
        keys = spark.createDataFrame([(c,) for c in listed] + [(None,), (None,)], "k string")
        kept = {r.k for r in table.filter(filters.scan_condition(keys, "k")).collect()}
        assert set(listed) <= kept and None not in kept
        if len(listed) <= 3:
            assert kept == set(listed)


def units(spark, data=UNITS):
    return spark.createDataFrame(data, UNIT_SCHEMA)


def template(spark, *lines):
    schema = "Zeile long, " + ", ".join(f"{c} string" for c in COLUMNS)
    return spark.createDataFrame([(i + 1, *line) for i, line in enumerate(lines)], schema)


def matched(spark, *lines):
    df = match_template(template(spark, *lines), units(spark))
    assert df.columns == units(spark).columns
    return sorted(r.Gemeindeschluessel for r in df.collect())


def test_levels_and_wildcards(spark):
    assert matched(spark, ("Land 1", None, None, None)) == ["1", "2", "3"]
    assert matched(spark, (None, "RB 2", None, None)) == ["4", "5"]
    assert matched(spark, (None, None, None, "Ort A")) == ["1", "4"]
    assert matched(spark, ("Land 2", None, None, "Ort A")) == ["4"]
    assert matched(spark, (None, None, None, None)) == ["1", "2", "3", "4", "5"]
    assert matched(spark, ("Land 2", None, None, "Ort B")) == []


def test_overlapping_rows_give_a_unit_once(spark):
    lines = [("Land 1", None, None, None), (None, None, "Kreis 1", None)] * 2
    assert matched(spark, *lines) == ["1", "2", "3"]


def test_a_missing_value_of_a_unit_matches_only_wildcards(spark):
    assert matched(spark, (None, None, "Kreis 3", None)) == ["4"]
    assert matched(spark, ("Land 2", None, None, "Ort D")) == ["5"]


def test_template_with_one_column(spark):
    df = spark.createDataFrame([(1, "Kreis 2"), (2, "nirgends")], "Zeile long, Kreis string")
    assert [r.Gemeindeschluessel for r in match_template(df, units(spark)).collect()] == ["3"]
    with pytest.raises(ValueError, match="at least one"):
        match_template(spark.createDataFrame([("x",)], "Ort string"), units(spark))
    with pytest.raises(ValueError, match="Zeile"):
        match_template(df.drop("Zeile"), units(spark))


def test_repeated_key_keeps_the_unit_of_the_earliest_row(spark):
    data = [("1", "Alt", "K", "R", "L"), ("1", "Neu", "K", "R", "L")]
    lines = [(None, None, None, "Neu"), (None, None, None, "Alt")]
    df = match_template(template(spark, *lines), units(spark, data))
    assert [r.Gemeindename for r in df.collect()] == ["Neu"]


def test_unmatched_rows(spark):
    lines = [("Land 1", None, None, None), ("Land 1", None, "Kreis 3", None),
             (None, None, None, None), (None, None, None, "Ort Z")]
    df = unmatched_template_rows(template(spark, *lines), units(spark))
    assert rows(df, "Zeile") == [(2, "Land 1", None, "Kreis 3", None),
                                 (4, None, None, None, "Ort Z")]
    assert unmatched_template_rows(template(spark, *lines), units(spark, [])).count() == 4


def test_match_against_brute_force(spark):
    random.seed(5)

    def value(options):
        return random.choice([None, *options])

    data = [
        (str(i), f"O{random.randint(0, 3)}", value(["K1", "K2"]), value(["R1"]), value(["L1", "L2"]))
        for i in range(60)
    ]
    lines = [
        (value(["L1", "L3"]), value(["R1"]), value(["K1", "K3"]), value(["O1", "O9"]))
        for _ in range(25)
    ]
    lines = [line for line in lines if any(line)]

    def fits(line, unit):
        fields = dict(zip(COLUMNS, (unit[4], unit[3], unit[2], unit[1])))
        return all(w is None or fields[c] == w for c, w in zip(COLUMNS, line))

    df = match_template(template(spark, *lines), units(spark, data))
    expected = sorted(u[0] for u in data if any(fits(line, u) for line in lines))
    assert sorted(r[0] for r in df.collect()) == expected
    missing = unmatched_template_rows(template(spark, *lines), units(spark, data))
    assert sorted(r.Zeile for r in missing.collect()) == [
        i + 1 for i, line in enumerate(lines) if not any(fits(line, u) for u in data)
    ]


FACT = (
    "Gitterzellen_ID string, Krankenhaus_Standortnummer string, "
    "Fahrzeit_Sekunden int, Fahrstrecke_Meter int"
)


def fact(spark):
    return spark.createDataFrame(
        [("1", "a", 1, 1), ("1", "b", 2, 2), ("2", "a", 3, 3), (None, None, 4, 4)], FACT
    )


def test_cells_of_listed_municipalities(spark):
    listed = spark.createDataFrame(
        [("1",), ("1",), (None,), ("9",)], "Gemeindeschluessel string"
    )
    mapping = spark.createDataFrame(
        [("z1", "1"), ("z1", "1"), ("z2", "2"), ("z3", "1"), ("z4", None), ("z9", "9")],
        "Gitterzellen_ID string, Gemeindeschluessel string",
    )
    people = spark.createDataFrame(
        [("z1", 5), ("z1", 6), ("z2", 1), ("z4", 1), ("z9", 1)],
        "Gitterzellen_ID string, Einwohner int",
    )
    df = geofilter_cells(listed, units(spark), mapping, people)
    assert rows(df) == [("z1",)]


def test_times_of_cells_are_not_multiplied(spark):
    cells = spark.createDataFrame([("1",), ("1",), (None,)], "Gitterzellen_ID string")
    assert filter_by_cells(fact(spark), cells).count() == 2


def test_repeated_hospitals_multiply_unless_told_otherwise(spark):
    listed = spark.createDataFrame(
        [("a",), ("a",), (None,)], "Krankenhaus_Standortnummer string"
    )
    assert filter_by_hospitals(fact(spark), listed).count() == 4
    assert filter_by_hospitals(fact(spark), listed, dedupe_keys=True).count() == 2
    with pytest.raises(ValueError, match="Missing required columns"):
        filter_by_hospitals(fact(spark), spark.range(1))
