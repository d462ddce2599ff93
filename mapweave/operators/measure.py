"""Distances of many pairs of geometries at once, as numpy arrays inside Spark's tasks.

The values are those of :func:`mapweave.functions.geometry.closest_on_first`, by the same formulas in the
same order; a row's cost there is that of interpreted lambdas for every vertex and edge.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from mapweave.session import ship_package

STEP_TESTS = 1 << 19  # tests of a vertex against an edge made at once; bounds the memory of a task
BATCH_BYTES = 16 << 20
_POINT = "struct<d:double,x:double,y:double>"
MARGIN = 1e-6  # by which inner boxes are narrower than what was found free of edges, for rounding


class Shapes:
    """Vertices, edges and the first vertex of each part of a column of geometries, with bounds for each of them."""

    def __init__(self, column: pa.StructArray):
        parts = column.field("parts")
        part_at, rings = _lists(parts)
        ring_at, vertices = _lists(rings)
        vertex_at, flat = _lists(vertices)
        kinds = column.field("kind").to_pylist()
        self.null = column.is_null().to_numpy(zero_copy_only=False)
        self.areal = np.array([k in ("Polygon", "MultiPolygon") for k in kinds], bool)
        x, y = (flat.field(c).to_numpy(zero_copy_only=False).astype(np.float64) for c in "xy")
        self.v_at = vertex_at[ring_at[part_at]]
        self.v = np.stack([x, y])
        # an edge begins at every vertex that is not the last one of its ring; a point is one edge without length
        point = np.array([k == "Point" for k in kinds], bool)
        ends = np.zeros(len(x), bool)
        ends[vertex_at[1:][vertex_at[1:] > vertex_at[:-1]] - 1] = True
        of_point = np.repeat(point, np.diff(self.v_at))
        first = np.flatnonzero(~ends | of_point)
        second = np.where(of_point[first], first, first + 1)
        self.s_at = np.searchsorted(first, self.v_at)
        self.s = np.stack([x[first], y[first], x[second], y[second]])
        # the first vertex of the first ring of every part that has one
        n_rings = np.diff(ring_at)
        head = ring_at[:-1][n_rings > 0]
        filled = vertex_at[head + 1] > vertex_at[head]
        corner_part = np.flatnonzero(n_rings > 0)[filled]
        corner = vertex_at[head[filled]]
        self.h_at = np.searchsorted(corner_part, part_at)
        self.h = np.stack([x[corner], y[corner]])


def _lists(array: pa.ListArray) -> tuple[np.ndarray, pa.Array]:
    """Bounds of the lists, from 0, and their items (a NULL list has none)."""
    lengths = array.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    return np.concatenate([[0], np.cumsum(lengths)]), array.flatten()


def _product(a_at: np.ndarray, b_at: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Every item of ``a`` with every item of ``b`` of each row, ``a`` outermost: both indices, the row's place and the bounds of the rows."""
    na, nb = a_at[rows + 1] - a_at[rows], b_at[rows + 1] - b_at[rows]
    n = na * nb
    at = np.concatenate([[0], np.cumsum(n)])
    place = np.repeat(np.arange(len(rows)), n)
    k = np.arange(at[-1]) - at[place]
    per = np.maximum(nb, 1)[place]
    return a_at[rows][place] + k // per, b_at[rows][place] + k % per, place, at


def _first_true(hit: np.ndarray, place: np.ndarray, n: int) -> np.ndarray:
    """Index of each row's first hit, -1 where it has none."""
    out = np.full(n, -1)
    found = np.flatnonzero(hit)[::-1]
    out[place[found]] = found
    return out


def _inside(outer: Shapes, inner: Shapes, rows: np.ndarray) -> np.ndarray:
    """The first corner of ``inner`` that lies in the area ``outer``, as an index into its corners (-1: none)."""
    out = np.full(len(rows), -1)
    areal = np.flatnonzero(outer.areal[rows])
    h, s, place, _ = _product(inner.h_at, outer.s_at, rows[areal])
    (px, py), (x1, y1, x2, y2) = inner.h[:, h], outer.s[:, s]
    left = ((y1 > py) != (y2 > py)) & (px < (x2 - x1) * (py - y1) / (y2 - y1) + x1)
    corner = inner.h_at[rows[areal]]
    several = inner.h_at[rows[areal] + 1] - corner
    at = np.concatenate([[0], np.cumsum(several)])
    odd = np.bincount(at[place] + h - corner[place], weights=left, minlength=at[-1]).astype(np.int64) % 2 == 1
    got = _first_true(odd, np.repeat(np.arange(len(areal)), several), len(areal))
    out[areal] = np.where(got >= 0, corner + got - at[:-1], -1)
    return out


def _least(d: np.ndarray, x: np.ndarray, y: np.ndarray, place: np.ndarray, n: int) -> np.ndarray:
    """The least (d, x, y) of each row, as three rows; infinite where a row has none."""
    keep = ~np.isnan(d)
    d, x, y, place = d[keep], x[keep], y[keep], place[keep]
    best = np.full((3, n), np.inf)
    starts = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]])) if len(place) else np.zeros(0, np.int64)
    rows = place[starts]
    if len(starts):
        best[0, rows] = np.fmin.reduceat(d, starts)
        x = np.where(d == best[0, place], x, np.inf)
        best[1, rows] = np.fmin.reduceat(x, starts)
        best[2, rows] = np.fmin.reduceat(np.where(x == best[1, place], y, np.inf), starts)
    return best


def _to_edges(points: Shapes, edges: Shapes, rows: np.ndarray, on_edge: bool) -> np.ndarray:
    """Least distance of the vertices of ``points`` from ``edges``, with the vertex or (``on_edge``) the place on the edge."""
    v, s, place, _ = _product(points.v_at, edges.s_at, rows)
    (px, py), (x1, y1, x2, y2) = points.v[:, v], edges.s[:, s]
    dx, dy = x2 - x1, y2 - y1
    len2 = dx * dx + dy * dy
    t = np.where(len2 > 0, np.minimum(np.maximum(((px - x1) * dx + (py - y1) * dy) / len2, 0.0), 1.0), 0.0)
    qx, qy = x1 + t * dx, y1 + t * dy
    d = np.sqrt((px - qx) * (px - qx) + (py - qy) * (py - qy))
    return _least(d, qx, qy, place, len(rows)) if on_edge else _least(d, px, py, place, len(rows))


def _crossings(a: Shapes, b: Shapes, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether an edge of ``a`` crosses one of ``b`` properly, and where the first such pair does."""
    i, j, place, _ = _product(a.s_at, b.s_at, rows)
    (sx1, sy1, sx2, sy2), (tx1, ty1, tx2, ty2) = a.s[:, i], b.s[:, j]

    def side(ax, ay, bx, by, cx, cy):
        return np.sign((bx - ax) * (cy - ay) - (by - ay) * (cx - ax))

    proper = (side(sx1, sy1, sx2, sy2, tx1, ty1) * side(sx1, sy1, sx2, sy2, tx2, ty2) < 0) & (
        side(tx1, ty1, tx2, ty2, sx1, sy1) * side(tx1, ty1, tx2, ty2, sx2, sy2) < 0
    )
    first = _first_true(proper, place, len(rows))
    k = np.maximum(first, 0)
    if not len(i):
        return first >= 0, np.zeros((2, len(rows)))
    sx1, sy1, sx2, sy2, tx1, ty1, tx2, ty2 = (c[k] for c in (sx1, sy1, sx2, sy2, tx1, ty1, tx2, ty2))
    u = ((tx1 - sx1) * (ty2 - ty1) - (ty1 - sy1) * (tx2 - tx1)) / ((sx2 - sx1) * (ty2 - ty1) - (sy2 - sy1) * (tx2 - tx1))
    return first >= 0, np.stack([sx1 + u * (sx2 - sx1), sy1 + u * (sy2 - sy1)])


def closest(a: Shapes, b: Shapes, rows: np.ndarray, both: bool) -> list[np.ndarray]:
    """(d, x, y) of the point of ``a`` that is nearest to ``b`` for some rows, and of that of ``b`` nearest to ``a``."""
    with np.errstate(all="ignore"):
        in_a, in_b = _inside(a, b, rows), _inside(b, a, rows)
        out = []
        for one, two, first, second in ((a, b, in_a, in_b), (b, a, in_b, in_a))[: 2 if both else 1]:
            best = np.full((3, len(rows)), np.inf)
            best[0, (first >= 0) | (second >= 0)] = 0.0
            for found, shapes, free in ((first, two, first >= 0), (second, one, (first < 0) & (second >= 0))):
                best[1:, free] = shapes.h[:, found[free]]
            open_ = np.flatnonzero((first < 0) & (second < 0))
            crosses, at = _crossings(one, two, rows[open_])
            best[:, open_[crosses]] = np.stack([np.zeros(crosses.sum()), *at[:, crosses]])
            open_ = open_[~crosses]
            p, q = _to_edges(one, two, rows[open_], False), _to_edges(two, one, rows[open_], True)
            # the lesser one in the order of d, x, y
            less = (q[0] < p[0]) | ((q[0] == p[0]) & ((q[1] < p[1]) | ((q[1] == p[1]) & (q[2] < p[2]))))
            best[:, open_] = np.where(less, q, p)
            out.append(best)
    return out


def _measured(batch: pa.RecordBatch, g1: str, g2: str, both: bool) -> pa.RecordBatch:
    names = [n for n in batch.schema.names if n not in (g1, g2)]
    a, b = Shapes(batch.column(g1)), Shapes(batch.column(g2))
    n_a, n_b = (np.diff(s.v_at) + np.diff(s.s_at) for s in (a, b))
    work = np.cumsum(n_a * n_b)
    found, start = [], 0
    while start < len(work):
        done = work[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(work, done + STEP_TESTS, side="right")))
        found.append(closest(a, b, np.arange(start, stop), both))
        start = stop
    null, columns = a.null | b.null, [batch.column(n) for n in names]
    for k in range(2 if both else 1):
        d, x, y = np.concatenate([f[k] for f in found], axis=1) if found else np.zeros((3, 0))
        at = [pa.array(c, mask=np.isinf(d)) for c in (x, y)]
        columns.append(pa.StructArray.from_arrays([pa.array(d), *at], names=["d", "x", "y"], mask=pa.array(null)))
    return pa.RecordBatch.from_arrays(columns, names=[*names, *("p1", "p2")[: 2 if both else 1]])


def _inner(shapes: Shapes) -> np.ndarray:
    """(minx, miny, maxx, maxy) of a box whose points all belong to the geometry; NaN where none is known.

    For an area that holds the middle of its box, it is that box drawn together to the middle until no edge passes through
    it. For other geometries it is their first vertex.
    """
    n = len(shapes.v_at) - 1
    out = np.full((4, n), np.nan)
    rows = np.flatnonzero(np.diff(shapes.v_at) > 0)
    out[:, rows] = shapes.v[[0, 1, 0, 1]][:, shapes.v_at[rows]]
    rows = np.flatnonzero(shapes.areal & (np.diff(shapes.v_at) > 0) & (np.diff(shapes.s_at) > 0))
    if not len(rows):
        return out
    # vertices and edges of rows without areas lie between those of the others, so every row is reduced
    filled = np.flatnonzero(np.diff(shapes.v_at) > 0)
    low, high = (np.full((2, n), np.nan) for _ in range(2))
    low[:, filled], high[:, filled] = (f.reduceat(shapes.v, shapes.v_at[filled], axis=1) for f in (np.minimum, np.maximum))
    middle, half = (low + high) / 2, (high - low) / 2
    edged = np.flatnonzero(np.diff(shapes.s_at) > 0)
    of = np.repeat(np.arange(n), np.diff(shapes.s_at))
    x1, y1, x2, y2 = shapes.s
    with np.errstate(all="ignore"):
        cx, cy = middle[:, of]
        left = ((y1 > cy) != (y2 > cy)) & (cx < (x2 - x1) * (cy - y1) / (y2 - y1) + x1)
        # how far the box may grow before it meets an edge: least at an end or where the edge meets a diagonal
        u1, v1, u2, v2 = (x1 - cx) / half[0, of], (y1 - cy) / half[1, of], (x2 - cx) / half[0, of], (y2 - cy) / half[1, of]
        du, dv = u2 - u1, v2 - v1
        free = np.minimum(np.maximum(np.abs(u1), np.abs(v1)), np.maximum(np.abs(u2), np.abs(v2)))
        for t in ((v1 - u1) / (du - dv), -(u1 + v1) / (du + dv)):
            at = np.maximum(np.abs(u1 + t * du), np.abs(v1 + t * dv))
            free = np.where((t > 0) & (t < 1), np.fmin(free, at), free)
        odd, room = np.zeros(n, bool), np.zeros(n)
        odd[edged] = np.add.reduceat(left.astype(np.int64), shapes.s_at[edged]) % 2 == 1
        room[edged] = np.minimum.reduceat(free, shapes.s_at[edged])
        reach = half * np.minimum(room, 1.0) - MARGIN
        good = rows[odd[rows] & (reach[:, rows] > 0).all(axis=0)]
    out[:, good] = np.concatenate([(middle - reach)[:, good], (middle + reach)[:, good]])
    return out


def with_inner_box(df: DataFrame, geom: str, box: str) -> DataFrame:
    """``df`` without the geometry ``geom``, with ``box``: a box of points that belong to it (NULL where none is known)."""
    _small_batches(df)
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name != geom)
    sides = ("minx", "miny", "maxx", "maxy")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = [n for n in batch.schema.names if n != geom]
            found = _inner(Shapes(batch.column(geom)))
            none = ~np.isfinite(found).all(axis=0)
            boxes = pa.StructArray.from_arrays([pa.array(c) for c in found], names=list(sides), mask=pa.array(none))
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], boxes], names=[*names, box])

    return df.mapInArrow(run, f"{kept}, `{box}` struct<{','.join(f'{s}:double' for s in sides)}>")


def _small_batches(df: DataFrame) -> None:
    """Ships the package and bounds the batches of a frame's tasks in bytes, unless the session does."""
    spark = df.sparkSession
    ship_package(spark)
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, None) in (None, str(2**31 - 1), str(2**63 - 1), "-1"):
        spark.conf.set(key, str(BATCH_BYTES))


def measured(pairs: DataFrame, g1: str, g2: str, both: bool = False) -> DataFrame:
    """``pairs`` without the geometries ``g1`` and ``g2``, with ``p1`` (and ``p2``): distance and the closest point on either.

    The point is NULL where a geometry is NULL or one has no vertices.
    """
    _small_batches(pairs)
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pairs.schema.fields if f.name not in (g1, g2))
    points = ", ".join(f"{p} {_POINT}" for p in ("p1", "p2")[: 2 if both else 1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _measured(batch, g1, g2, both)

    return pairs.mapInArrow(run, f"{kept}, {points}")
