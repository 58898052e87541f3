"""WKB geometries of a whole batch in arrays.

The values of a column are read side by side: every step reads the next part of each
value that has one left, so that the number of steps is that of the parts of the
largest geometry, whatever the number of values. Coordinates lie in one array, with
offsets per path (a point, a line, a ring), and paths and parts belong to the nodes of
the geometries; all further work is done on these arrays.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# WKB type codes, and the flags of the extended form.
TYPE_NAMES = {
    1: "Point",
    2: "LineString",
    3: "Polygon",
    4: "MultiPoint",
    5: "MultiLineString",
    6: "MultiPolygon",
    7: "GeometryCollection",
}
FLAG_Z = 0x80000000
FLAG_M = 0x40000000
FLAG_SRID = 0x20000000
POINT, LINE, POLYGON, COLLECTION = 1, 2, 3, 7
LON_LIMIT = 180.0
LAT_LIMIT = 90.0

COMMA = pa.scalar(",", pa.large_string())

# Scaled numbers from here on are written one by one.
LARGEST = 1e9


@dataclass(frozen=True)
class Shapes:
    """The geometries of a column.

    Nodes are geometries and their parts, those of a value in the order in which they
    are read: ``row, kind, parent`` (a node, -1 for the value itself), ``level``. Paths:
    ``node, points`` (their number), ``dims``. ``numbers`` are all coordinates.
    """

    rows: int
    row: np.ndarray
    kind: np.ndarray
    parent: np.ndarray
    level: np.ndarray
    node: np.ndarray
    points: np.ndarray
    dims: np.ndarray
    numbers: np.ndarray

    def starts(self) -> np.ndarray:
        """Where the coordinates of each path begin."""
        sizes = self.points * self.dims
        return np.cumsum(sizes) - sizes

    def xy(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The row, x and y of every point."""
        path = np.repeat(np.arange(len(self.points)), self.points)
        within = np.arange(len(path)) - np.repeat(np.cumsum(self.points) - self.points, self.points)
        at = self.starts()[path] + within * self.dims[path]
        return self.row[self.node[path]], self.numbers[at], self.numbers[at + 1]

    def boxes(self) -> np.ndarray:
        """Smallest x and y, largest x and y per row; NaN for one without points."""
        row, x, y = self.xy()
        known = ~(np.isnan(x) | np.isnan(y))
        row, x, y = row[known], x[known], y[known]
        boxes = np.full((self.rows, 4), np.nan)
        if len(row):
            begin = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1])))
            found = row[begin]
            for i, (take, values) in enumerate(
                ((np.minimum, x), (np.minimum, y), (np.maximum, x), (np.maximum, y))
            ):
                boxes[found, i] = take.reduceat(values, begin)
        return boxes

    def kinds(self) -> np.ndarray:
        """The type code of every row, 0 for a missing value."""
        kinds = np.zeros(self.rows, np.int64)
        top = self.parent < 0
        kinds[self.row[top]] = self.kind[top]
        return kinds

    def check(self) -> None:
        """Raise if a coordinate is no number (an empty point, all NaN, may be) or no
        longitude and latitude."""
        finite = np.isfinite(self.numbers)
        if not finite.all():
            path = np.repeat(np.arange(len(self.points)), self.points * self.dims)
            empty = np.bincount(path[~np.isnan(self.numbers)], minlength=len(self.points)) == 0
            empty &= self.kind[self.node] == POINT
            if (~finite & ~empty[path]).any():
                raise ValueError("Coordinates hold NaN or infinite values")
        boxes = self.boxes()
        limits = np.array([LON_LIMIT, LAT_LIMIT, LON_LIMIT, LAT_LIMIT])
        outside = (np.abs(boxes) > limits).any(1)
        if outside.any():
            box = tuple(boxes[outside][0].tolist())
            raise ValueError(f"Coordinates are not longitude and latitude: {box}")


class _Bytes:
    """The bytes of a column, read at many places at once."""

    def __init__(self, column: pa.Array):
        column = column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column
        _, offsets, data = column.buffers()
        at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
        self.starts = at[:-1].copy()
        whole = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
        # room to read eight bytes from any place
        self.data = np.concatenate([whole, np.zeros(16, np.uint8)])

    def byte(self, at: np.ndarray) -> np.ndarray:
        return self.data[at]

    def number(self, at: np.ndarray, little: np.ndarray) -> np.ndarray:
        parts = self.data[at[:, None] + np.arange(4)].astype(np.int64)
        shifts = np.array([0, 8, 16, 24])
        weights = np.where(little[:, None], shifts, shifts[::-1])
        return (parts << weights).sum(1)

    def doubles(self, at: np.ndarray, counts: np.ndarray, little: np.ndarray) -> np.ndarray:
        """Runs of numbers, one run after the other. The bytes are seen as numbers from
        each of eight beginnings, of which a run lies on one."""
        ends = np.cumsum(counts)
        out = np.empty(int(ends[-1]) if len(ends) else 0)
        for order, mark in (("<f8", True), (">f8", False)):
            for phase in range(8):
                runs = np.flatnonzero((little == mark) & (at % 8 == phase) & (counts > 0))
                if not len(runs):
                    continue
                size = (len(self.data) - phase) // 8 * 8
                numbers = self.data[phase : phase + size].view(order)
                n = counts[runs]
                step = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
                first = np.repeat(at[runs] // 8, n)
                target = np.repeat(ends[runs] - n, n)
                out[target + step] = numbers[first + step]
        return out


def read(column: pa.Array) -> Shapes:
    """The geometries of a binary column; missing values have no nodes."""
    data = _Bytes(column)
    row = np.flatnonzero(column.is_valid().to_numpy(zero_copy_only=False))
    at = data.starts[row].copy()
    depth = np.zeros(len(row), np.int64)
    open_nodes: list[np.ndarray] = []  # per depth the node of each value's container
    left: list[np.ndarray] = []  # and the parts it has still to come
    nodes: list[tuple] = []
    paths: list[tuple] = []
    n_nodes = 0
    active = np.arange(len(row))
    while len(active):
        here = at[active]
        little = data.byte(here) == 1
        code = data.number(here + 1, little)
        here = here + 5 + 4 * ((code & FLAG_SRID) != 0)
        dims = 2 + ((code & FLAG_Z) != 0) + ((code & FLAG_M) != 0)
        code &= 0x0FFFFFFF
        dims += np.array([0, 1, 1, 2])[code // 1000]
        kind = code % 1000
        node = n_nodes + np.arange(len(active))
        n_nodes += len(active)
        parent = np.full(len(active), -1)
        for d in range(len(open_nodes)):
            inside = depth[active] == d + 1
            parent[inside] = open_nodes[d][active[inside]]
        nodes.append((row[active], kind, parent, depth[active]))

        count = np.where(kind == POINT, 1, 0)
        several = kind != POINT
        count[several] = data.number(here[several], little[several])
        here = here + 4 * several
        single = kind <= LINE
        paths.append((node[single], here[single], count[single], dims[single], little[single]))
        here = here + np.where(single, 8 * count * dims, 0)
        rings = np.where(kind == POLYGON, count, 0)
        while (more := rings > 0).any():
            number = data.number(here[more], little[more])
            paths.append((node[more], here[more] + 4, number, dims[more], little[more]))
            here[more] += 4 + 8 * number * dims[more]
            rings[more] -= 1
        at[active] = here

        # containers are opened; what is finished closes those it was the last part of
        opened = (kind > POLYGON) & (count > 0)
        for d in np.unique(depth[active[opened]]).tolist():
            if d == len(left):
                left.append(np.zeros(len(row), np.int64))
                open_nodes.append(np.zeros(len(row), np.int64))
            these = opened & (depth[active] == d)
            left[d][active[these]] = count[these]
            open_nodes[d][active[these]] = node[these]
        depth[active[opened]] += 1
        closing = active[~opened]
        done = np.zeros(len(row), bool)
        while len(closing):
            done[closing[depth[closing] == 0]] = True
            closing = closing[depth[closing] > 0]
            for d in np.unique(depth[closing]).tolist():
                left[d - 1][closing[depth[closing] == d]] -= 1
            over = np.zeros(len(closing), bool)
            for d in np.unique(depth[closing]).tolist():
                own = depth[closing] == d
                over[own] = left[d - 1][closing[own]] == 0
            closing = closing[over]
            depth[closing] -= 1
        active = active[~done[active]]

    def joined(parts: list[tuple], n: int) -> list[np.ndarray]:
        if not parts:
            return [np.empty(0, np.int64)] * n
        return [np.concatenate([p[i] for p in parts]) for i in range(n)]

    node_row, kind, parent, level = joined(nodes, 4)
    path_node, place, points, dims, little = joined(paths, 5)
    # all of a value together, in the order in which it was read
    order = np.argsort(node_row, kind="stable")
    number = np.empty(len(order), np.int64)
    number[order] = np.arange(len(order))
    parent = np.where(parent < 0, -1, number[parent] if len(number) else parent)[order]
    by_node = np.argsort(number[path_node] if len(number) else path_node, kind="stable")
    place, points, dims = place[by_node], points[by_node], dims[by_node]
    numbers = data.doubles(place, points * dims, little[by_node].astype(bool))
    return Shapes(
        len(column), node_row[order], kind[order], parent, level[order],
        number[path_node][by_node] if len(number) else path_node, points, dims, numbers,
    )


def number_texts(values: np.ndarray, digits: int) -> pa.Array:
    """Numbers rounded to so many decimals, without zeros at the end. What lies so near
    the middle of two decimals that a product cannot tell is rounded one by one."""
    scale = 10**digits
    with np.errstate(invalid="ignore", over="ignore"):
        scaled = values * scale
        doubtful = np.abs(scaled - np.floor(scaled) - 0.5) < 1e-5
        doubtful |= ~(np.abs(scaled) < LARGEST)
        whole = np.where(doubtful, 0, np.rint(scaled)).astype(np.int64)
    size = np.abs(whole)
    head = pa.array(size // scale).cast(pa.string())
    head = pc.if_else(pa.array(whole < 0), pc.binary_join_element_wise("-", head, ""), head)
    texts = head
    if digits:
        tail = pc.utf8_lpad(pa.array(size % scale).cast(pa.string()), digits, "0")
        tail = pc.binary_join_element_wise(".", pc.utf8_rtrim(tail, characters="0"), "")
        texts = pc.if_else(
            pa.array(size % scale == 0), head, pc.binary_join_element_wise(head, tail, "")
        )
    at = np.flatnonzero(doubtful)
    if not len(at):
        return texts
    single = []
    for value in values[at].tolist():
        text = f"{value:.{digits}f}"
        text = text.rstrip("0").rstrip(".") if "." in text else text
        single.append("0" if text in ("-0", "") else text)
    return pc.replace_with_mask(texts, pa.array(doubtful), pa.array(single, pa.string()))


def _concatenated(*parts: str | pa.Array) -> pa.Array:
    """Large strings side by side."""
    large = [pa.scalar(p, pa.large_string()) if isinstance(p, str) else p for p in (*parts, "")]
    return pc.binary_join_element_wise(*large)


def _bracketed(texts: pa.Array, counts: np.ndarray) -> pa.Array:
    """Consecutive texts as JSON arrays of so many each."""
    offsets = pa.array(np.concatenate(([0], np.cumsum(counts))).astype(np.int32))
    joined = pc.binary_join(pa.ListArray.from_arrays(offsets, texts), COMMA)
    return _concatenated("[", joined, "]")


def geojson(shapes: Shapes, digits: int) -> pa.Array:
    """The GeoJSON text of every row, null for a missing value."""
    numbers = number_texts(shapes.numbers, digits).cast(pa.large_string())
    points = _bracketed(numbers, np.repeat(shapes.dims, shapes.points))
    paths = _bracketed(points, shapes.points)
    n = len(shapes.kind)
    texts = np.empty(n, object)
    n_paths = np.bincount(shapes.node, minlength=n)
    first_path = np.cumsum(n_paths) - n_paths
    first_point = np.cumsum(shapes.points) - shapes.points

    kind = shapes.kind
    point = np.flatnonzero(kind == POINT)
    if len(point):
        path = first_path[point]
        start = shapes.starts()[path]
        size = shapes.dims[path]
        known = np.isnan(shapes.numbers).astype(np.int64)
        before = np.concatenate(([0], np.cumsum(known)))
        empty = before[start + size] - before[start] == size
        own = pc.if_else(pa.array(empty), pa.scalar("[]", pa.large_string()), points.take(pa.array(first_point[path])))
        texts[point] = own.to_numpy(zero_copy_only=False)
    line = np.flatnonzero(kind == LINE)
    texts[line] = paths.take(pa.array(first_path[line])).to_numpy(zero_copy_only=False)
    polygon = np.flatnonzero(kind == POLYGON)
    of_polygon = np.flatnonzero(kind[shapes.node] == POLYGON)
    rings = _bracketed(paths.take(pa.array(of_polygon)), n_paths[polygon])
    texts[polygon] = rings.to_numpy(zero_copy_only=False)

    def wrapped(nodes: np.ndarray) -> pa.Array:
        """Coordinates, or the geometries of a collection, as objects."""
        heads = np.array(
            ["", *(f'{{"type":"{name}","coordinates":' for name in TYPE_NAMES.values())], object
        )
        heads[COLLECTION] = '{"type":"GeometryCollection","geometries":'
        return _concatenated(
            pa.array(heads[kind[nodes]], pa.large_string()),
            pa.array(texts[nodes], pa.large_string()),
            "}",
        )

    parts = np.bincount(shapes.parent[shapes.parent >= 0], minlength=n)
    for level in range(int(shapes.level.max()) if n else 0, -1, -1):
        containers = np.flatnonzero((shapes.level == level) & (kind > POLYGON))
        below = np.flatnonzero((shapes.level == level + 1) & (shapes.parent >= 0))
        if not len(containers):
            continue
        inner = pa.array(texts[below], pa.large_string())
        in_collection = kind[shapes.parent[below]] == COLLECTION
        if in_collection.any():
            inner = pc.if_else(pa.array(in_collection), wrapped(below), inner)
        texts[containers] = _bracketed(inner, parts[containers]).to_numpy(zero_copy_only=False)
    top = np.flatnonzero(shapes.parent < 0)
    found = np.full(shapes.rows, None, object)
    found[shapes.row[top]] = wrapped(top).to_numpy(zero_copy_only=False)
    return pa.array(found, pa.string())
