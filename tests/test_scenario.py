import random

import pytest
from pyspark.sql import functions as F

from reachgrid.functions.geometry import point_wkb
from reachgrid.plans.extracts import geofilter, klinikfilter, komplettexport, run_geofilter
from reachgrid.operators.difference import difference_cells
from reachgrid.plans.scenario import (
    ScenarioTables,
    read_tables,
    scenario_all_levels,
    scenario_cells,
    scenario_difference,
    scenario_difference_cells,
    scenario_summary,
    szenario_berechnung,
)
from reachgrid.schema import ADMIN_COLUMNS, LAYOUT_SPLIT, LEVELS
from reachgrid.sources.tables import Snapshot
from tests.conftest import rows


@pytest.fixture(scope="module")
def snapshot(spark, tmp_path_factory):
    """Five cells in three municipalities of two districts, and one unmapped."""
    root = tmp_path_factory.mktemp("snapshot")
    times = [
        ("z1", "h1", 600), ("z1", "h2", 600), ("z1", "h3", 60),
        ("z2", "h1", 2400), ("z2", "h2", 1200),
        ("z3", "h1", None), ("z3", "h2", 3600),
        ("z4", "h3", 60),
        ("z5", "h1", 300),
        ("z6", "h1", 900),
    ]
    mapping = [("z1", "m1"), ("z2", "m1"), ("z3", "m2"), ("z4", "m2"), ("z5", "m3"),
               ("z7", "m1")]
    people = [("z1", 100), ("z2", 50), ("z3", 10), ("z4", 5), ("z7", 1)]
    units = [
        ("m1", "Ort 1", "m1", "Kreis 1", "k1", "RB", "r", "Land", "l"),
        ("m2", "Ort 2", "m2", "Kreis 2", "k2", "RB", "r", "Land", "l"),
    ]
    cell = "Gitterzellen_ID string"
    tables = {
        "Entfernungsdaten": (
            [(*t, 7) for t in times],
            f"{cell}, Krankenhaus_Standortnummer string, Fahrzeit_Sekunden int, "
            "Fahrstrecke_Meter int",
        ),
        "Gitterzellen_Gemeinde_Mapping": (mapping, f"{cell}, Gemeindeschluessel string"),
        "Gitterzellen_Einwohner_Mapping": (people, f"{cell}, Einwohner long"),
        "Verwaltungsgebiete_Mapping": (units, ", ".join(f"{c} string" for c in ADMIN_COLUMNS)),
    }
    frames = {n: spark.createDataFrame(*t) for n, t in tables.items()}
    frames["Gitterzellen_mit_Einwohnern_Gemeinde_Mapping"] = frames[
        "Gitterzellen_Gemeinde_Mapping"
    ].join(frames["Gitterzellen_Einwohner_Mapping"], "Gitterzellen_ID")
    frames["Krankenhaus_Standortliste"] = spark.range(3).select(
        F.concat(F.lit("h"), (F.col("id") + 1).cast("string")).alias("id"),
        point_wkb(F.col("id"), F.col("id")).alias("geometry"),
    )
    for name, df in frames.items():
        df.write.parquet(f"{root}/{name}.parquet")
    return Snapshot(str(root))


@pytest.fixture(scope="module")
def hospitals_csv(tmp_path_factory):
    path = tmp_path_factory.mktemp("lists") / "hospitals.csv"
    path.write_text("Krankenhaus_Standortnummer\nh1\nh2\n")
    return str(path)


def result(df, id_col="Gemeindeschluessel"):
    return {r[id_col]: r for r in df.collect()}


def test_municipalities(spark, snapshot, hospitals_csv):
    df = szenario_berechnung(spark, hospitals_csv, snapshot)
    assert df.columns == [
        "Gemeindeschluessel",
        "Gemeindename",
        "Bundesland",
        "Bundesland_ID",
        "Einwohner_Gesamt",
        "Mittlere_Gewichtete_Fahrzeit",
        "Anzahl_Gitterzellen",
        "Anzahl_Betroffene",
        "Prozent_Betroffene",
        "Anzahl_bewohnte_Gitterzellen",
        "Prozent_Abgedeckt_pro_Gemeinde",
    ]
    found = result(df)
    assert set(found) == {"m1", "m2", None}
    # h1 and h2 tie for z1, so its inhabitants count twice.
    m1 = found["m1"]
    assert m1.Einwohner_Gesamt == 250
    assert m1.Mittlere_Gewichtete_Fahrzeit == pytest.approx((10 * 200 + 20 * 50) / 250)
    assert (m1.Anzahl_Gitterzellen, m1.Anzahl_bewohnte_Gitterzellen) == (2, 3)
    assert m1.Prozent_Abgedeckt_pro_Gemeinde == pytest.approx(200 / 3)
    m2 = found["m2"]
    assert (m2.Einwohner_Gesamt, m2.Anzahl_Betroffene, m2.Prozent_Betroffene) == (10, 10, 100)
    # z5 and z6 are in no combined mapping and form the unit without a key.
    assert found[None].Anzahl_Gitterzellen == 2
    assert found[None].Anzahl_bewohnte_Gitterzellen is None


def test_one_hospital_per_cell(spark, snapshot, hospitals_csv):
    df = szenario_berechnung(spark, hospitals_csv, snapshot, ties="one")
    assert result(df)["m1"].Einwohner_Gesamt == 150


def test_split_layout(spark, snapshot, hospitals_csv):
    df = szenario_berechnung(
        spark, hospitals_csv, snapshot, gitterzellen_layout=LAYOUT_SPLIT
    )
    found = result(df)
    # m3 is missing from the unit table: a unit by key, but without coverage.
    assert set(found) == {"m1", "m2", "m3", None}
    assert found["m3"].Prozent_Abgedeckt_pro_Gemeinde is None
    assert found["m3"].Mittlere_Gewichtete_Fahrzeit is None
    assert found[None].Anzahl_bewohnte_Gitterzellen == 1


def test_totals_of_levels_agree(spark, snapshot, hospitals_csv):
    totals = set()
    for level in LEVELS:
        df = szenario_berechnung(
            spark, hospitals_csv, snapshot, verwaltungsebene=level
        )
        row = df.agg(F.sum("Einwohner_Gesamt"), F.sum("Anzahl_Betroffene")).collect()[0]
        totals.add(tuple(row))
    assert totals == {(260, 10)}


def test_all_levels_equal_each_level(spark, snapshot, hospitals_csv):
    tables = read_tables(spark, snapshot, gitterzellen_layout=LAYOUT_SPLIT)
    listed = spark.read.option("header", True).csv(hospitals_csv)
    together = scenario_all_levels(tables, listed, [15, 30])
    for name, level in LEVELS.items():
        single = scenario_summary(tables, listed, name, [15, 30])
        part = together.filter(F.col("Ebene") == name).select(
            F.col("Einheit_ID").alias(level.id_col),
            F.col("Einheit").alias(level.name_col),
            *[c for c in single.columns if c not in (level.id_col, level.name_col)],
        )
        key = level.id_col
        assert rows(part.select(*single.columns), key) == rows(single, key)


def random_tables(spark, seed, twice=True):
    """Cells of which some are mapped to several municipalities, or to one twice."""
    rng = random.Random(seed)
    mapping = [(f"c{i}", f"m{rng.randint(0, 9)}", rng.choice([None, 0, rng.randint(1, 999)]))
               for i in range(80)]
    if twice:
        mapping += [(c, f"m{rng.randint(0, 9)}", p) for c, _, p in mapping[:20]] + mapping[:5]
    units = [
        (f"m{i}", f"Ort {i}", f"m{i}", f"K {i % 4}", f"k{i % 4}", f"R {i % 2}", f"r{i % 2}", "L", "l")
        for i in range(8)
    ]
    times = [
        (f"c{rng.randint(0, 89)}", f"h{rng.randint(0, 9)}", rng.choice([None, *range(0, 4000, 130)]))
        for _ in range(900)
    ]
    return ScenarioTables(
        spark.createDataFrame(
            times, "Gitterzellen_ID string, Krankenhaus_Standortnummer string, Fahrzeit_Sekunden int"
        ),
        spark.createDataFrame(
            mapping, "Gitterzellen_ID string, Gemeindeschluessel string, Einwohner long"
        ),
        spark.createDataFrame(units, ", ".join(f"{c} string" for c in ADMIN_COLUMNS)),
    )


def hospital_list(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "Krankenhaus_Standortnummer string")


def test_all_levels_of_cells_that_are_mapped_several_times(spark):
    tables = random_tables(spark, 1)
    listed = hospital_list(spark, "h1", "h2", "h3", "h3")
    together = scenario_all_levels(tables, listed, 20)
    for name, level in LEVELS.items():
        single = scenario_summary(tables, listed, name, 20)
        part = together.filter(F.col("Ebene") == name).select(
            F.col("Einheit_ID").alias(level.id_col),
            F.col("Einheit").alias(level.name_col),
            *[c for c in single.columns if c not in (level.id_col, level.name_col)],
        )
        assert rows(part.select(*single.columns), level.id_col) == rows(single, level.id_col)


def test_cells_are_not_exploded_to_levels(spark, tmp_path):
    """The only rows written once per level are those of municipalities."""
    tables = random_tables(spark, 2)
    df = scenario_all_levels(tables, hospital_list(spark, "h1"), 20)
    lines = df._jdf.queryExecution().optimizedPlan().toString().splitlines()
    generated = [i for i, line in enumerate(lines) if "Generate explode" in line]
    assert len(generated) == 2
    for at in generated:
        below = next(line for line in lines[at:] if "Aggregate [" in line)
        assert "_cell" in below


def test_sums_do_not_depend_on_partitions(spark):
    """The same bits, however the rows are dealt out."""
    found = set()
    for parts in (1, 3, 7):
        tables = random_tables(spark, 3)
        tables = ScenarioTables(
            tables.travel_times.repartition(parts), tables.cells.repartition(parts), tables.admin_units
        )
        listed = hospital_list(spark, *(f"h{i}" for i in range(8)))
        means = scenario_summary(tables, listed, "Kreis", 20)
        changes = scenario_difference(tables, listed, hospital_list(spark, "h1", "h2"), ["Kreis"])
        both = rows(means, "Kreis_ID"), rows(changes, "Kreis")
        found.add(repr(both))
    assert len(found) == 1


def test_difference_cells_in_one_scan_equal_those_of_two_tables(spark):
    tables = random_tables(spark, 4, twice=False)
    reference = hospital_list(spark, "h1", "h2", "h3", "h3", "h9")
    scenario = hospital_list(spark, "h2", "h5", "h5")
    one = scenario_difference_cells(tables, reference, scenario)
    two = difference_cells(scenario_cells(tables, reference), scenario_cells(tables, scenario))
    assert sorted(one.columns) == sorted(two.columns)
    assert rows(one.select(*two.columns)) == rows(two)


def test_difference_cells_read_the_times_once(spark, tmp_path):
    tables = random_tables(spark, 5)
    tables.travel_times.write.parquet(f"{tmp_path}/times")
    stored = ScenarioTables(
        spark.read.parquet(f"{tmp_path}/times"), tables.cells, tables.admin_units
    )
    listed = hospital_list(spark, "h1"), hospital_list(spark, "h2")
    for df in (
        scenario_difference_cells(stored, *listed),
        scenario_difference(stored, *listed, ["Kreis"]),
        scenario_all_levels(stored, listed[0], 20),
    ):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Fahrzeit_Sekunden") and plan.count("Relation [") == 1


def test_cells(spark, snapshot, hospitals_csv):
    df = szenario_berechnung(
        spark, hospitals_csv, snapshot, return_gitterzellen_daten=True
    )
    assert set(df.columns) == {
        "Krankenhaus_Standortnummer",
        "Gitterzellen_ID",
        "Fahrzeit_Sekunden",
        "Einwohner",
        *ADMIN_COLUMNS,
    }
    assert df.count() == 6


def test_arguments_are_checked(spark, snapshot, hospitals_csv):
    for options in (
        {"verwaltungsebene": "Stadt"},
        {"entfernungsdaten_table": "andere"},
        {"gitterzellen_layout": "anders"},
    ):
        with pytest.raises(ValueError):
            szenario_berechnung(spark, hospitals_csv, snapshot, **options)
    with pytest.raises(FileNotFoundError):
        szenario_berechnung(spark, "/absent.csv", snapshot)


COPIED = ["Verwaltungsgebiete_Mapping", "Krankenhaus_Standortliste"]


def counts(extract):
    return {r.tabelle: r.n for r in extract.table_counts.collect()}


def test_geofilter_from_a_template(spark, snapshot, tmp_path):
    template = tmp_path / "template.csv"
    template.write_text("Kreis;Gemeindename\nKreis 1;\nKreis 9;\n")
    cleaned = str(tmp_path / "cleaned.csv")
    out = str(tmp_path / "out")
    extract = geofilter(
        spark, str(template), snapshot, out, cleaned, tables_to_copy=COPIED, chunk_size=2
    )
    assert counts(extract) == {
        "Geofilter": 3,
        "Entfernungsdaten_subset": 5,
        "Verwaltungsgebiete_Mapping": 2,
        "Krankenhaus_Standortliste": 3,
    }
    assert extract.written["Entfernungsdaten_subset"].endswith("_chunks")
    # A second run with another list replaces the first.
    template.write_text("Kreis;Gemeindename\nKreis 2;\n")
    extract = geofilter(
        spark, str(template), snapshot, out, cleaned, tables_to_copy=COPIED
    )
    assert counts(extract)["Geofilter"] == 2
    assert counts(extract)["Entfernungsdaten_subset"] == 3
    again = run_geofilter(spark, cleaned, snapshot, out, tables_to_copy=COPIED)
    assert counts(again) == counts(extract)


def test_klinikfilter_feeds_a_scenario(spark, snapshot, hospitals_csv, tmp_path):
    copied = [
        "Verwaltungsgebiete_Mapping",
        "Gitterzellen_Gemeinde_Mapping",
        "Gitterzellen_Einwohner_Mapping",
    ]
    extract = klinikfilter(
        spark, hospitals_csv, snapshot, str(tmp_path), tables_to_copy=copied
    )
    assert counts(extract)["Entfernungsdaten_subset"] == 8
    assert counts(extract)["Klinikfilter"] == 2
    options = {"gitterzellen_layout": LAYOUT_SPLIT}
    whole = szenario_berechnung(spark, hospitals_csv, snapshot, **options)
    part = szenario_berechnung(
        spark,
        hospitals_csv,
        Snapshot(extract.output_dir),
        entfernungsdaten_table="Entfernungsdaten_subset",
        **options,
    )
    assert rows(part, "Gemeindeschluessel") == rows(whole, "Gemeindeschluessel")


def test_complete_export(spark, snapshot, tmp_path):
    extract = komplettexport(spark, snapshot, str(tmp_path))
    assert counts(extract) == {
        n: snapshot.table(spark, n).count() for n in snapshot.tables(spark)
    }
    assert Snapshot(extract.output_dir).tables(spark) == snapshot.tables(spark)


def test_extracts_into_their_source_keep_its_tables(spark, snapshot, tmp_path, hospitals_csv):
    root = str(tmp_path / "own")
    komplettexport(spark, snapshot, root)
    own = Snapshot(root)
    before = {n: own.table(spark, n).count() for n in own.tables(spark)}
    assert counts(komplettexport(spark, own, f"{root}/")) == before
    extract = klinikfilter(spark, hospitals_csv, own, root, tables_to_copy=list(before)[:2])
    assert counts(extract)["Entfernungsdaten_subset"] == 8
    assert {n: own.table(spark, n).count() for n in before} == before
    with pytest.raises(ValueError, match="overwrite its input"):
        klinikfilter(spark, hospitals_csv, own, root, target_table_name="Entfernungsdaten")
    assert {n: own.table(spark, n).count() for n in before} == before
