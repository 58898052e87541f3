import json
import random
import struct

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from reachgrid.functions import wkb
from reachgrid.functions.geometry import (
    geojson_geometry,
    geometry_bounds,
    point_wkb,
    square_wkb,
    strip_srid,
)
from tests.one_wkb import bounds, geojson, read_wkb


def point(x, y, order="<", code=1, srid=None):
    head = struct.pack(order + "BI", 1 if order == "<" else 0, code)
    if srid is not None:
        head += struct.pack(order + "I", srid)
    return head + struct.pack(order + "2d", x, y)


def line(code, points, order="<"):
    flat = [v for p in points for v in p]
    return struct.pack(f"{order}BII{len(flat)}d", 1, code, len(points), *flat)


def many(code, parts):
    return struct.pack("<BII", 1, code, len(parts)) + b"".join(parts)


def polygon(*rings):
    body = b"".join(
        struct.pack(f"<I{2 * len(r)}d", len(r), *(v for p in r for v in p)) for r in rings
    )
    return struct.pack("<BII", 1, 3, len(rings)) + body


SQUARE = [(0, 0), (1, 0), (1, 1), (0, 1), (0, 0)]


def convert(spark, *values):
    df = spark.createDataFrame([(bytearray(v) if v else None,) for v in values], "g binary")
    return [
        r[0] and json.loads(r[0]) for r in df.select(geojson_geometry(F.col("g"))).collect()
    ]


def test_geojson_of_every_type(spark):
    found = convert(
        spark,
        point(8, 50),
        point(8.123456, 50.5, ">"),
        line(2, [(0, 0), (1, 2)]),
        polygon(SQUARE, [(0.2, 0.2), (0.4, 0.2), (0.2, 0.4), (0.2, 0.2)]),
        many(4, [point(1, 2), point(3, 4)]),
        many(5, [line(2, [(0, 0), (1, 1)])]),
        many(6, [polygon(SQUARE)]),
        many(7, [point(1, 2), polygon(SQUARE)]),
        None,
    )
    square = [list(p) for p in SQUARE]
    assert found == [
        {"type": "Point", "coordinates": [8, 50]},
        {"type": "Point", "coordinates": [8.1235, 50.5]},
        {"type": "LineString", "coordinates": [[0, 0], [1, 2]]},
        {
            "type": "Polygon",
            "coordinates": [square, [[0.2, 0.2], [0.4, 0.2], [0.2, 0.4], [0.2, 0.2]]],
        },
        {"type": "MultiPoint", "coordinates": [[1, 2], [3, 4]]},
        {"type": "MultiLineString", "coordinates": [[[0, 0], [1, 1]]]},
        {"type": "MultiPolygon", "coordinates": [[square]]},
        {
            "type": "GeometryCollection",
            "geometries": [
                {"type": "Point", "coordinates": [1, 2]},
                {"type": "Polygon", "coordinates": [square]},
            ],
        },
        None,
    ]


def test_empty_point_and_height(spark):
    nan = float("nan")
    with pytest.raises(Exception, match="NaN"):
        convert(spark, point(nan, 5))
    height = struct.pack("<BI3d", 1, 1001, 1, 2, 3)
    assert convert(spark, point(nan, nan), height, many(4, [])) == [
        {"type": "Point", "coordinates": []},
        {"type": "Point", "coordinates": [1, 2, 3]},
        {"type": "MultiPoint", "coordinates": []},
    ]


def test_only_longitude_and_latitude(spark):
    with pytest.raises(Exception, match="not longitude and latitude"):
        convert(spark, point(500000, 5600000))


@pytest.mark.parametrize("order", ["<", ">"])
def test_srid_is_removed(spark, order):
    plain = point(8, 50, order)
    extended = point(8, 50, order, 1 | 0x20000000, 4326)
    df = spark.createDataFrame(
        [(bytearray(extended),), (bytearray(plain),), (None,)], "g binary"
    )
    found = [r[0] for r in df.select(strip_srid(F.col("g"))).collect()]
    assert found == [plain, plain, None]
    assert read_wkb(extended)[0] == "Point"


def test_srid_removal_keeps_other_flags(spark):
    head = struct.pack("<BII", 1, 1 | 0x20000000 | 0x80000000, 4326)
    body = struct.pack("<3d", 1, 2, 3)
    df = spark.createDataFrame([(bytearray(head + body),)], "g binary")
    plain = df.select(strip_srid(F.col("g"))).collect()[0][0]
    assert plain == struct.pack("<BI", 1, 1 | 0x80000000) + body


def test_built_geometries(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 4.0)], "x double, y double")
    df = df.select(
        point_wkb(F.col("x"), F.col("y")).alias("p"),
        square_wkb(F.col("x"), F.col("y")).alias("s"),
    )
    first, second = df.collect()
    assert bytes(first.p) == point(1, 2)
    assert bounds(read_wkb(second.s)[1]) == (3, 4, 4, 5)
    boxes = df.select(geometry_bounds(F.col("s")).alias("b")).select("b.*").collect()
    assert tuple(boxes[0]) == ("Polygon", 1, 2, 2, 3)


def random_shape(rng, depth=0, code=None):
    """A value of any type and byte order, with or without height and SRID."""
    order = rng.choice("<>")
    code = code or rng.choice([1, 2, 3] if depth > 2 else [1, 2, 3, 4, 5, 6, 7])
    extra = rng.choice([0, 0, 1000, 2000, 3000, 0x80000000])
    dims = 2 + {0: 0, 3000: 2}.get(extra, 1)
    flags = rng.choice([0, 0x20000000]) if depth == 0 else 0
    head = struct.pack(order + "BI", order == "<", code + extra | flags)
    head += struct.pack(order + "I", 4326) if flags else b""

    def numbers(n):
        values = [rng.choice([rng.uniform(-90, 90), rng.randint(-90, 90), 0.00005, -0.00004, 8.12345])
                  for _ in range(n * dims)]
        return struct.pack(f"{order}{n * dims}d", *values)

    def counted(n):
        return struct.pack(order + "I", n)

    if code == 1:
        empty = rng.random() < 0.2
        return head + (struct.pack(f"{order}{dims}d", *[float("nan")] * dims) if empty else numbers(1))
    n = rng.randint(0, 4)
    if code == 2:
        return head + counted(n) + numbers(n)
    if code == 3:
        sizes = [rng.randint(0, 5) for _ in range(n)]
        return head + counted(n) + b"".join(counted(k) + numbers(k) for k in sizes)
    part = code - 3 if code < 7 else None
    return head + counted(n) + b"".join(random_shape(rng, depth + 1, part) for _ in range(n))


@pytest.mark.parametrize("seed", range(6))
def test_columns_equal_single_values(seed):
    rng = random.Random(seed)
    values = [None if rng.random() < 0.1 else random_shape(rng) for _ in range(120)]
    column = pa.array([b"before", *values, b"after"], pa.binary()).slice(1, len(values))
    shapes = wkb.read(column)
    texts = wkb.geojson(shapes, 4).to_pylist()
    boxes, kinds = shapes.boxes(), shapes.kinds()
    for value, text, box, kind in zip(values, texts, boxes, kinds):
        if value is None:
            assert text is None and kind == 0 and np.isnan(box).all()
            continue
        name, shape = read_wkb(value)
        assert wkb.TYPE_NAMES[kind] == name
        assert text == geojson(name, shape, 4)
        expected = bounds(shape)
        assert np.isnan(box).all() if expected is None else tuple(box) == expected
    nothing = wkb.read(pa.array([None, None], pa.binary()))
    assert wkb.geojson(nothing, 4).to_pylist() == [None, None]
    assert len(wkb.geojson(wkb.read(pa.array([], pa.binary())), 4)) == 0


@pytest.mark.parametrize("digits", [0, 1, 4, 6])
def test_numbers_are_rounded_like_single_ones(digits):
    rng = random.Random(digits)
    values = [rng.uniform(-200, 200) for _ in range(2_000)]
    values += [i / 2 * 10**-digits for i in range(-50, 50)] + [0.1 * i for i in range(-50, 50)]
    values += [1e300, -1e300, 1e15 + 0.3, 123456.000049999, 5e-324, -0.0, float("nan"), float("inf")]
    for value, text in zip(values, wkb.number_texts(np.array(values), digits).to_pylist()):
        single = f"{value:.{digits}f}"
        single = single.rstrip("0").rstrip(".") if "." in single else single
        assert text == ("0" if single in ("-0", "") else single)
