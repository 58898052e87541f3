"""Geometries as WKB in a binary column.

Spark cannot write its own geometry type to Parquet, so a geometry is kept as
plain WKB. Reading a coordinate out of WKB is the one thing the built-in
functions cannot do; it runs on arrays of whole Arrow batches (see ``wkb``).
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reachgrid.functions.wkb import LAT_LIMIT, LON_LIMIT, TYPE_NAMES, geojson, read

def strip_srid(wkb: Column) -> Column:
    """Extended WKB without its SRID; plain WKB comes back unchanged.

    The byte with the flags is the last one of a little-endian type code and
    the first one of a big-endian code. Only built-in functions are used.
    """
    text = F.hex(wkb)
    little = F.substring(text, 1, 2) == "01"
    flags = F.conv(
        F.when(little, F.substring(text, 9, 2)).otherwise(F.substring(text, 3, 2)),
        16,
        10,
    ).cast("int")
    plain = F.lpad(F.hex(flags.bitwiseAND(F.lit(0xDF)).cast("long")), 2, "0")
    head = F.when(little, F.concat(F.substring(text, 1, 8), plain)).otherwise(
        F.concat(F.substring(text, 1, 2), plain, F.substring(text, 5, 6))
    )
    body = F.substring(text, 19, 2**31 - 1)
    has_srid = flags.bitwiseAND(F.lit(0x20)) != 0
    return F.when(has_srid, F.unhex(F.concat(head, body))).otherwise(wkb)


def normalise_geometry(df: DataFrame, column: str = "geometry") -> DataFrame:
    """Clean the WKB column of a table taken over from a spatial database."""
    return df.withColumn(column, strip_srid(F.col(column)))


def geojson_geometry(wkb: Column, digits: int = 4) -> Column:
    """GeoJSON text of a WKB column, coordinates rounded to ``digits``.

    Coordinates must be WGS84 longitude and latitude; others are an error.
    """

    @F.arrow_udf("string")
    def convert(values: pa.Array) -> pa.Array:
        shapes = read(values)
        shapes.check()
        return geojson(shapes, digits)

    return convert(wkb)


BOUNDS = ("xmin", "ymin", "xmax", "ymax")


def geometry_bounds(wkb: Column) -> Column:
    """Struct of geometry type and bounding box of a WKB column."""

    @F.arrow_udf("struct<type:string,xmin:double,ymin:double,xmax:double,ymax:double>")
    def measure(values: pa.Array) -> pa.Array:
        shapes = read(values)
        names = np.array([None, *TYPE_NAMES.values()], object)[shapes.kinds()]
        boxes = shapes.boxes()
        columns = [pa.array(boxes[:, i], mask=np.isnan(boxes[:, i])) for i in range(4)]
        return pa.StructArray.from_arrays(
            [pa.array(names, pa.string()), *columns], ["type", *BOUNDS]
        )

    return measure(wkb)


def _little_endian_wkb(code: int, counts: list[int], xy: np.ndarray) -> pa.Array:
    """One WKB value per row of ``xy``, all with the same head."""
    head = np.frombuffer(struct.pack(f"<BI{len(counts)}I", 1, code, *counts), "u1")
    body = np.ascontiguousarray(xy, "<f8").view("u1").reshape(len(xy), -1)
    values = np.hstack([np.broadcast_to(head, (len(xy), len(head))), body])
    ends = np.arange(len(xy) + 1, dtype=np.int32) * values.shape[1]
    buffers = [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(values))]
    return pa.Array.from_buffers(pa.binary(), len(xy), buffers)


def point_wkb(x: Column, y: Column) -> Column:
    """WKB point from two coordinate columns; a missing coordinate is NaN."""

    @F.arrow_udf("binary")
    def build(xs: pa.Array, ys: pa.Array) -> pa.Array:
        return _little_endian_wkb(1, [], np.column_stack([_floats(xs), _floats(ys)]))

    return build(x, y)


def _floats(column: pa.Array) -> np.ndarray:
    return column.cast(pa.float64()).to_numpy(zero_copy_only=False)


def square_wkb(x: Column, y: Column, side: float = 1.0) -> Column:
    """WKB square with its south-west corner at the given coordinates."""

    @F.arrow_udf("binary")
    def build(xs: pa.Array, ys: pa.Array) -> pa.Array:
        west, south = _floats(xs), _floats(ys)
        east, north = west + side, south + side
        ring = [west, south, east, south, east, north, west, north, west, south]
        return _little_endian_wkb(3, [1, 5], np.column_stack(ring))

    return build(x, y)


# Steps per axis of the curve by which places are ordered: 16 bits each.
CURVE_STEPS = 1 << 16


def _spread(value: Column) -> Column:
    """The bits of a number below 2^16 with a zero before each."""
    for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
        value = value.bitwiseOR(F.shiftleft(value, shift)).bitwiseAND(F.lit(mask).cast("long"))
    return value


def curve_place(box: Column) -> Column:
    """The place of a box's centre on a Z-order curve over longitude and latitude: near
    places mostly have near numbers. Missing boxes have none."""

    def step(low: Column, high: Column, limit: float) -> Column:
        centre = (low + high) / 2
        at = F.floor((centre + limit) / (2 * limit) * CURVE_STEPS)
        return F.greatest(F.lit(0), F.least(F.lit(CURVE_STEPS - 1), at)).cast("long")

    x = step(box["xmin"], box["xmax"], LON_LIMIT)
    y = step(box["ymin"], box["ymax"], LAT_LIMIT)
    return _spread(x).bitwiseOR(F.shiftleft(_spread(y), 1))
