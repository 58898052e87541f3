"""Reads one WKB value after the other; what the columnar reader is compared with."""

import struct

import numpy as np

from reachgrid.functions.wkb import FLAG_M, FLAG_SRID, FLAG_Z, TYPE_NAMES


class Reader:
    """Walks over one WKB value."""

    def __init__(self, data: bytes):
        self.data = data
        self.at = 0

    def _number(self, order: str) -> int:
        value = struct.unpack_from(order + "I", self.data, self.at)[0]
        self.at += 4
        return value

    def _points(self, order: str, count: int, dims: int) -> np.ndarray:
        flat = np.frombuffer(self.data, order + "f8", count * dims, self.at)
        self.at += count * dims * 8
        return flat.reshape(count, dims)

    def geometry(self) -> tuple[str, list]:
        """Type name and nested coordinate arrays; parts for a collection."""
        order = "<" if self.data[self.at] == 1 else ">"
        self.at += 1
        code = self._number(order)
        dims = 2 + bool(code & FLAG_Z) + bool(code & FLAG_M)
        if code & FLAG_SRID:
            self.at += 4
        code &= 0x0FFFFFFF
        dims += (0, 1, 1, 2)[code // 1000]
        name = TYPE_NAMES[code % 1000]
        if name == "Point":
            return name, self._points(order, 1, dims)
        count = self._number(order)
        if name == "LineString":
            return name, self._points(order, count, dims)
        if name == "Polygon":
            return name, [
                self._points(order, self._number(order), dims) for _ in range(count)
            ]
        return name, [self.geometry() for _ in range(count)]


def _digits(value: float, digits: int) -> str:
    text = f"{value:.{digits}f}"
    if "." in text:
        text = text.rstrip("0").rstrip(".")
    return "0" if text in ("-0", "") else text


def _point_text(point: np.ndarray, digits: int) -> str:
    return "[" + ",".join(_digits(v, digits) for v in point) + "]"


def _line_text(points: np.ndarray, digits: int) -> str:
    return "[" + ",".join(_point_text(p, digits) for p in points) + "]"


def _coordinates(name: str, shape, digits: int) -> str:
    if name == "Point":
        return "[]" if np.isnan(shape).all() else _point_text(shape[0], digits)
    if name == "LineString":
        return _line_text(shape, digits)
    if name == "Polygon":
        return "[" + ",".join(_line_text(ring, digits) for ring in shape) + "]"
    return "[" + ",".join(_coordinates(n, s, digits) for n, s in shape) + "]"


def geojson(name: str, shape, digits: int) -> str:
    if name == "GeometryCollection":
        parts = ",".join(geojson(n, s, digits) for n, s in shape)
        return f'{{"type":"{name}","geometries":[{parts}]}}'
    return f'{{"type":"{name}","coordinates":{_coordinates(name, shape, digits)}}}'


def bounds(shape) -> tuple[float, float, float, float] | None:
    """Smallest x and y, largest x and y; None for an empty geometry."""
    if isinstance(shape, np.ndarray):
        xy = shape[:, :2]
        xy = xy[~np.isnan(xy).any(axis=1)]
        if not len(xy):
            return None
        return (*map(float, xy.min(axis=0)), *map(float, xy.max(axis=0)))
    parts = [bounds(p[1] if isinstance(p, tuple) else p) for p in shape]
    parts = [p for p in parts if p is not None]
    if not parts:
        return None
    west, south, east, north = zip(*parts)
    return min(west), min(south), max(east), max(north)


def read_wkb(data: bytes) -> tuple[str, list]:
    return Reader(bytes(data)).geometry()


def finite(name: str, shape) -> bool:
    """Whether all coordinates are numbers; an empty point, all NaN, is none."""
    if name == "Point":
        return bool(np.isfinite(shape).all() or np.isnan(shape).all())
    if name == "LineString":
        return bool(np.isfinite(shape).all())
    if name == "Polygon":
        return all(np.isfinite(ring).all() for ring in shape)
    return all(finite(n, s) for n, s in shape)
