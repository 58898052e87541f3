import json
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from reachgrid.functions.geometry import point_wkb, square_wkb
from reachgrid.operators.quality import check_primary_key_exists, duplicate_keys, table_counts
from reachgrid.operators.rows import CHUNK, count_rows, repeat_rows
from reachgrid.sinks.complete import is_complete, mark_complete, read_mark
from reachgrid.sinks.geoparquet import full_path, geo_entries, resolve, write_geoparquet
from reachgrid.sinks.lists import write_list
from reachgrid.sinks.parquet import (
    copy_tables,
    export_all_tables,
    write_chunks,
    write_parquet,
    write_partitioned,
)
from reachgrid.sources.lists import read_municipality_list
from reachgrid.sources.tables import Snapshot, read_chunks, read_geoparquet
from tests.conftest import rows, scanned_rows


def parts(path):
    return sorted(Path(path).glob("*.parquet"))


@pytest.mark.parametrize("codec", ["SNAPPY", "GZIP"])
def test_parquet_keeps_values(spark, tmp_path, codec):
    data = [(1, "test1", 10.5, True), (2, "test2", 20.3, False), (3, None, 30.7, True)]
    df = spark.createDataFrame(data, "id int, name string, value double, flag boolean")
    path = str(tmp_path / "t.parquet")
    write_parquet(df, path, codec)
    back = spark.read.parquet(path)
    assert back.schema == df.schema
    assert rows(back) == data
    files = [pq.ParquetFile(p).metadata for p in parts(path)]
    groups = [m.row_group(i) for m in files for i in range(m.num_row_groups)]
    assert {g.column(0).compression for g in groups} == {codec}


def test_chunks_are_bounded_and_read_back(spark, tmp_path):
    df = spark.range(500).withColumn("data", F.concat(F.lit("v"), F.col("id").cast("string")))
    folder = write_chunks(df, str(tmp_path), "large", chunk_size=100)
    assert folder == f"{tmp_path}/large_chunks"
    assert max(pq.ParquetFile(p).metadata.num_rows for p in parts(folder)) <= 100
    back = read_chunks(spark, str(tmp_path), "large")
    assert rows(back) == rows(df)
    assert back.filter("id = 150").collect()[0].data == "v150"


@pytest.mark.parametrize("n, files", [(500, 5), (250, 3), (1, 1)])
def test_fewest_chunks(spark, tmp_path, n, files):
    one_partition = spark.range(n).coalesce(1)
    folder = write_chunks(one_partition, str(tmp_path), "t", chunk_size=100)
    sizes = [pq.ParquetFile(p).metadata.num_rows for p in parts(folder)]
    assert sum(sizes) == n
    assert len([s for s in sizes if s]) == files and max(sizes) <= 100


def test_no_chunks(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="No chunk files found"):
        read_chunks(spark, str(tmp_path), "absent")


def points(spark, *xy):
    df = spark.createDataFrame(
        [(i, float(x), float(y)) for i, (x, y) in enumerate(xy)], "id int, x double, y double"
    )
    return df.select("id", point_wkb(F.col("x"), F.col("y")).alias("geometry"))


def geo_entry(path):
    return json.loads(pq.ParquetFile(path).metadata.metadata[b"geo"])


def test_geoparquet(spark, tmp_path):
    path = str(tmp_path / "g.parquet")
    write_geoparquet(points(spark, (8, 50), (9, 51)).coalesce(1), path)
    (file,) = parts(path)
    entry = geo_entry(file)
    assert entry["primary_column"] == "geometry"
    assert entry["columns"]["geometry"] == {
        "encoding": "WKB",
        "geometry_types": ["Point"],
        "bbox": [8, 50, 9, 51],
    }
    back = read_geoparquet(spark, path)
    assert back.columns == ["id", "geometry"] and back.count() == 2


def test_geoparquet_overwrites_appends_and_writes_empty(spark, tmp_path):
    path = str(tmp_path / "g.parquet")
    many = points(spark, *[(i, i) for i in range(20)]).repartition(4)
    write_geoparquet(many, path)
    assert len(parts(path)) == 4
    assert all("bbox" in geo_entry(p)["columns"]["geometry"] for p in parts(path))
    write_geoparquet(many, path)
    assert read_geoparquet(spark, path).count() == 20
    write_geoparquet(many, path, mode="append")
    assert read_geoparquet(spark, path).count() == 40
    write_geoparquet(many.limit(0), path)
    assert read_geoparquet(spark, path).count() == 0
    assert not list(Path(path).glob("_pending*"))
    with pytest.raises(FileNotFoundError, match="File not found"):
        read_geoparquet(spark, str(tmp_path / "absent"))


def test_geoparquet_of_polygons_and_missing_geometries(spark, tmp_path):
    path = str(tmp_path / "p.parquet")
    df = spark.createDataFrame([(1, 0.0), (2, None)], "id int, x double")
    df = df.withColumn(
        "geometry", F.when(F.col("x").isNotNull(), square_wkb(F.coalesce("x", F.lit(0.0)), F.lit(0.0)))
    ).coalesce(1)
    write_geoparquet(df, path)
    assert geo_entry(parts(path)[0])["columns"]["geometry"]["geometry_types"] == ["Polygon"]
    assert read_geoparquet(spark, path).filter("geometry IS NULL").count() == 1


def test_geoparquet_by_box_skips_row_groups(spark, tmp_path):
    """Points of a grid in no order, written along the curve."""
    grid = spark.range(40_000).selectExpr("(id * 7919) % 40000 AS id")
    grid = grid.selectExpr("id", "id % 200 * 0.5D - 50 AS x", "floor(id / 200) * 0.25D - 25 AS y")
    df = grid.select("id", point_wkb(F.col("x"), F.col("y")).alias("geometry"))
    path, plain = str(tmp_path / "covered.parquet"), str(tmp_path / "plain.parquet")
    write_geoparquet(df, path, covering=True, group_bytes=32 * 1024)
    write_geoparquet(df, plain)
    assert geo_entry(parts(path)[0])["version"] == "1.1.0"
    assert geo_entry(parts(path)[0])["columns"]["geometry"]["covering"]["bbox"]["xmin"] == ["bbox", "xmin"]
    box = (-10.2, -5, 3.4, 2.3)
    expected = rows(grid.filter("x BETWEEN -10.2 AND 3.4 AND y BETWEEN -5 AND 2.3").select("id"))
    for folder in (path, plain):
        found = read_geoparquet(spark, folder, box)
        assert found.columns == ["id", "geometry"]
        assert rows(found.select("id")) == expected
    assert scanned_rows(read_geoparquet(spark, path, box)) < 8_000
    assert scanned_rows(read_geoparquet(spark, plain, box)) == 40_000
    entries = geo_entries(spark, path).collect()
    assert len(entries) == len(parts(path)) and all(e.covering for e in entries)
    assert {e.geometry_types[0] for e in entries} == {"Point"}
    assert min(e.bbox[0] for e in entries) == -50 and max(e.bbox[3] for e in entries) == 24.75


def test_geoparquet_by_box_of_missing_geometries(spark, tmp_path):
    df = spark.createDataFrame([(1, 0.0), (2, None), (3, 9.0)], "id int, x double")
    square = square_wkb(F.coalesce("x", F.lit(0.0)), F.lit(0.0))
    df = df.select("id", F.when(F.col("x").isNotNull(), square).alias("geometry"))
    path = str(tmp_path / "g.parquet")
    write_geoparquet(df, path, covering=True)
    assert rows(read_geoparquet(spark, path).select("id")) == [(1,), (2,), (3,)]
    assert rows(read_geoparquet(spark, path, (1, 1, 5, 5)).select("id")) == [(1,)]
    write_geoparquet(df.limit(0), path, covering=True)
    assert read_geoparquet(spark, path, (1, 1, 5, 5)).count() == 0


def test_copies_are_complete_or_absent(spark, tmp_path):
    """Whatever a lost run has left is no table."""
    source, target = tmp_path / "source", tmp_path / "target"
    for name in ("a", "b", "c", "d", "e"):
        spark.range(30).repartition(3).write.parquet(f"{source}/{name}.parquet")
    (target / "a.parquet" / "_temporary" / "0").mkdir(parents=True)  # no file yet
    spark.range(30).repartition(3).write.parquet(f"{target}/b.parquet")
    mark_complete(spark, f"{target}/b.parquet")
    parts(target / "b.parquet")[0].unlink()  # a file has gone
    spark.range(10).write.parquet(f"{target}/c.parquet")
    (target / "c.parquet" / "_SUCCESS").unlink()  # never committed
    spark.range(30).selectExpr("id AS other").write.parquet(f"{target}/d.parquet")
    spark.range(7).write.parquet(f"{target}/e.parquet")  # somebody else's, committed
    tables = Snapshot(str(source))
    assert copy_tables(spark, tables, str(target), "all") == ["a", "b", "c", "d"]
    for name, n in (("a", 30), ("b", 30), ("c", 30), ("d", 30), ("e", 7)):
        assert spark.read.parquet(f"{target}/{name}.parquet").count() == n
        assert is_complete(spark, f"{target}/{name}.parquet")
    assert copy_tables(spark, tables, str(target), "all") == []
    (target / "a.parquet" / "_complete.json").write_text("{")  # a mark cut short
    assert copy_tables(spark, tables, str(target), ["a"]) == []  # committed all the same
    (target / "a.parquet" / "_SUCCESS").unlink()
    assert copy_tables(spark, tables, str(target), ["a"]) == ["a"]


def test_marks_tell_missing_rows(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    spark.range(5).write.parquet(path)
    with pytest.raises(RuntimeError, match="Incomplete"):
        mark_complete(spark, path, 6)
    with pytest.raises(RuntimeError, match="Incomplete"):
        mark_complete(spark, str(tmp_path / "absent"))
    mark_complete(spark, path, 5)
    assert read_mark(spark, path) == {"rows": 5, "columns": [["id", "bigint"]]}
    assert not is_complete(spark, str(tmp_path / "absent"))
    assert not is_complete(spark, path, spark.range(1).selectExpr("id AS x"))
    # a file that was cut off has no footer; a whole one needs no mark
    whole = parts(path)[0].read_bytes()
    (tmp_path / "cut.parquet").write_bytes(whole[:-20])
    (tmp_path / "whole.parquet").write_bytes(whole)
    assert not is_complete(spark, str(tmp_path / "cut.parquet"))
    assert is_complete(spark, str(tmp_path / "whole.parquet"))


def test_router(spark, tmp_path):
    tables = {
        "plain": spark.range(3),
        "Entfernungsdaten_subset": spark.range(5),
        "Krankenhaus_Standortliste": points(spark, (8, 50)),
    }
    written = export_all_tables(tables, str(tmp_path), chunk_size=2)
    assert written["plain"].endswith("/plain.parquet")
    assert written["Entfernungsdaten_subset"].endswith("/Entfernungsdaten_subset_chunks")
    assert geo_entry(parts(written["Krankenhaus_Standortliste"])[0])
    snapshot = Snapshot(str(tmp_path))
    assert snapshot.tables(spark) == sorted(tables)
    counts = table_counts({n: snapshot.table(spark, n) for n in tables})
    assert {r.tabelle: r.n for r in counts.collect()} == {
        "plain": 3,
        "Entfernungsdaten_subset": 5,
        "Krankenhaus_Standortliste": 1,
    }


def test_copies_skip_what_is_there(spark, tmp_path):
    source, target = str(tmp_path / "s"), str(tmp_path / "t")
    write_parquet(spark.range(2), f"{source}/a.parquet")
    write_parquet(spark.range(3), f"{source}/b.parquet")
    assert copy_tables(spark, Snapshot(source), target, ["a"]) == ["a"]
    write_parquet(spark.range(9), f"{source}/a.parquet")
    assert copy_tables(spark, Snapshot(source), target, "all") == ["b"]
    assert Snapshot(target).table(spark, "a").count() == 2


def test_partitioned(spark, tmp_path):
    df = spark.range(100).select(
        F.when(F.col("id") < 70, "Land A").otherwise("Land B").alias("Bundesland"), "id"
    )
    path = str(tmp_path / "p")
    write_partitioned(df, path)
    assert sorted(p.name for p in Path(path).glob("Bundesland=*")) == [
        "Bundesland=Land A",
        "Bundesland=Land B",
    ]
    assert spark.read.parquet(path).count() == 100


def test_list_round_trip_keeps_leading_zeros(spark, tmp_path):
    df = spark.createDataFrame(
        [("01001001", "Ort, klein"), ("01001002", None)],
        "Gemeindeschluessel string, Gemeindename string",
    )
    path = str(tmp_path / "list.csv")
    write_list(df, path)
    assert rows(read_municipality_list(spark, path)) == rows(df)


def test_keys(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2), (None, 3)], "k string, v int")
    assert {tuple(r) for r in duplicate_keys(df, ["k"]).collect()} == {("a", 2), (None, 1)}
    assert not check_primary_key_exists(df, ["k"])
    assert check_primary_key_exists(df.filter("k = 'b'"), ["k"])


def test_counting_and_repeating_rows(spark):
    df = spark.createDataFrame([("a",)] * 3 + [("b",)], "k string")
    counted = count_rows(df, ["k"], "n")
    assert rows(repeat_rows(counted, "n", "i")) == [("a", 1), ("a", 2), ("a", 3), ("b", 1)]
    large = spark.createDataFrame([("x", 2 * CHUNK + 1)], "k string, n long")
    out = repeat_rows(large, "n", "i").agg(F.count("*"), F.count_distinct("i"), F.max("i"))
    assert tuple(out.collect()[0]) == (2 * CHUNK + 1,) * 3


def test_geoparquet_of_points_next_to_other_geometries(spark, tmp_path):
    mixed = points(spark, (8, 50), (9, 51)).unionByName(
        spark.range(1).select(
            F.col("id").cast("int").alias("id"),
            square_wkb(F.lit(3.0), F.lit(4.0)).alias("geometry"),
        )
    )
    path = str(tmp_path / "mixed")
    write_geoparquet(mixed.coalesce(1), path)
    entry = geo_entry(parts(path)[0])["columns"]["geometry"]
    assert entry["geometry_types"] == ["Point", "Polygon"]
    assert entry["bbox"] == [3.0, 4.0, 9.0, 51.0]


def test_geoparquet_paths(spark, tmp_path):
    assert resolve(str(tmp_path))[1] == resolve(f"file:{tmp_path}")[1] == str(tmp_path)
    assert resolve(f"file://{tmp_path}")[1] == str(tmp_path)
    with pytest.raises(pa.ArrowInvalid):
        resolve("unknown://folder/table")
    assert full_path(spark, "relative/table").startswith("file:/")
