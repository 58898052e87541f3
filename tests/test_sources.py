import re

import pytest

from reachgrid.schema import ADMIN_SCHEMA, FACT_SCHEMA
from reachgrid.sources.lists import (
    number_lines,
    read_hospital_list,
    read_municipality_list,
    read_template,
)
from reachgrid.sources.tables import Postgres, Snapshot, make_source, require_file_exists
from tests.conftest import rows


def written(tmp_path, text, name="list.csv"):
    path = tmp_path / name
    path.write_text(text)
    return str(path)


def test_template(spark, tmp_path):
    path = written(
        tmp_path,
        "Gemeindename;Kreis;Bundesland\nOrt;;Land\nNA;Kreis;\n\"A;B\";01;\n",
    )
    df = read_template(spark, path)
    assert rows(df, "Zeile") == [
        (1, "Ort", None, "Land"),
        (2, None, "Kreis", None),
        (3, "A;B", "01", None),
    ]
    with pytest.raises(ValueError, match="at least one of the columns"):
        read_template(spark, written(tmp_path, "Ort\nx\n", "other.csv"))
    with pytest.raises(FileNotFoundError, match="File not found: .*absent.csv"):
        read_template(spark, str(tmp_path / "absent.csv"))


def test_lists_keep_leading_zeros(spark, tmp_path):
    path = written(tmp_path, "Gemeindeschluessel,Gemeindename\n01001001,Ort\n,\n")
    df = read_municipality_list(spark, path)
    assert df.schema["Gemeindeschluessel"].dataType.typeName() == "string"
    assert df.first().Gemeindeschluessel == "01001001"
    hospitals = written(tmp_path, "Krankenhaus_Standortnummer,x\n0260,1\n", "h.csv")
    assert read_hospital_list(spark, hospitals).first()[0] == "0260"


def test_lists_need_their_key(spark, tmp_path):
    path = written(tmp_path, "Standortnummer\n260310716\n")
    with pytest.raises(ValueError, match="Krankenhaus_Standortnummer"):
        read_hospital_list(spark, path)
    with pytest.raises(ValueError, match="Gemeindeschluessel"):
        read_municipality_list(spark, path)


def test_lines_are_numbered_across_partitions(spark):
    df = number_lines(spark.range(1000, numPartitions=7))
    assert [r.Zeile - 1 for r in df.orderBy("id").collect()] == list(range(1000))


def test_snapshot(spark, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/a.parquet")
    spark.range(4).write.parquet(f"{tmp_path}/b_chunks")
    snapshot = Snapshot(str(tmp_path))
    assert snapshot.tables(spark) == ["a", "b"]
    assert snapshot.table(spark, "a").count() == 3
    assert snapshot.table(spark, "b").count() == 4
    with pytest.raises(FileNotFoundError, match="File not found"):
        snapshot.table(spark, "c")
    with pytest.raises(ValueError, match="path is required"):
        Snapshot("")
    require_file_exists(spark, str(tmp_path))


def test_postgres_options(monkeypatch):
    for name, value in {"DB": "d", "HOST": "h", "PORT": "5433", "USER": "u",
                        "PASSWORD": "p"}.items():
        monkeypatch.setenv(name, value)
    source = Postgres(schema="geo")
    options = source.options()
    assert options["url"] == "jdbc:postgresql://h:5433/d?sslmode=prefer"
    assert (options["user"], options["password"]) == ("u", "p")
    assert source.table_name("T") == '"geo"."T"'
    assert "p" not in repr(Postgres(password="geheim")).split("password")
    monkeypatch.delenv("HOST")
    with pytest.raises(ValueError, match="Could not connect"):
        source.options()


@pytest.mark.parametrize("blocks", [0, 1, 9, 10, 11, 35])
def test_postgres_slices_cover_every_row_once(blocks):
    slices = Postgres(slice_blocks=10).predicates(blocks)
    assert len(slices) == max(1, -(-blocks // 10))
    bounds = [[int(n) for n in re.findall(r"'\((\d+),0\)'::tid", s)] for s in slices]
    assert bounds[0][0] == 0 and len(bounds[-1]) == 1
    assert all(a[1] == b[0] for a, b in zip(bounds, bounds[1:]))
    # no function on a column, and one lower bound each
    assert all(s.startswith("ctid >= ") and s.count("ctid") <= 2 for s in slices)


def test_postgres_size_names_the_table():
    query = Postgres(schema="geo").size_query("Entfernungsdaten")
    assert """pg_relation_size('"geo"."Entfernungsdaten"'::regclass)""" in query


def test_source_choice():
    assert make_source("snapshot", "/data") == Snapshot("/data")
    assert make_source(slice_blocks=2).slice_blocks == 2
    with pytest.raises(ValueError, match="path is required"):
        make_source("snapshot")
    with pytest.raises(ValueError, match="got: oracle"):
        make_source("oracle")


def test_declared_schemas_hold_text_keys():
    assert {f.dataType.typeName() for f in ADMIN_SCHEMA} == {"string"}
    assert [f.name for f in FACT_SCHEMA][:2] == [
        "Gitterzellen_ID",
        "Krankenhaus_Standortnummer",
    ]
