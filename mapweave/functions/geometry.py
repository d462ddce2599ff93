"""Geometry as plain Spark columns.

A geometry is a :data:`mapweave.schema.GEOM_TYPE` struct
``{kind, parts: array<array<array<{x, y}>>>}``. All functions here build
Column expressions (built-in functions and JVM higher-order functions), so
they run inside the executor JVM without Python workers. Per-row functions
are used only on bounded geometries (points and ways); unbounded areas are
handled as edge tables by :mod:`mapweave.operators.spatial`.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

INF = float("inf")


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _dbl(v: float) -> Column:
    return F.lit(float(v)).cast("double")


def let(value: Column, body) -> Column:
    """Evaluate ``body(v)`` with ``v`` bound to ``value`` once.

    Column expressions are trees, so a sub-expression used twice is built
    (and analysed) twice; nesting multiplies that. Binding through a
    one-element ``transform`` keeps every heavy sub-expression single.
    """
    return F.element_at(F.transform(F.array(value), body), F.lit(1))


# ---------------------------------------------------------------- construction


def vertex(x, y) -> Column:
    return F.struct(_c(x).cast("double").alias("x"), _c(y).cast("double").alias("y"))


def point(x, y) -> Column:
    """Point geometry from two numeric columns; NULL when a coordinate is NULL."""
    def build(v):
        geom = F.struct(F.lit("Point").alias("kind"), F.array(F.array(F.array(v))).alias("parts"))
        return F.when(v.getField("x").isNotNull() & v.getField("y").isNotNull(), geom)

    return let(vertex(x, y), build)


def polygon(shell: Column, holes: Column | None = None) -> Column:
    """Polygon from a closed shell ring and an optional array of closed hole rings."""
    rings = F.array(shell) if holes is None else F.concat(F.array(shell), holes)
    return F.struct(F.lit("Polygon").alias("kind"), F.array(rings).alias("parts"))


def geometry_from_vertices(vertices: str) -> Column:
    """Way geometry from its ordered vertex array column (array<struct<x, y>>).

    1 vertex -> Point; >= 4 vertices with first == last -> Polygon; otherwise
    LineString (so a closed 3-vertex way stays a LineString). An empty list
    raises, as there is no geometry for it.
    """
    kind = (
        "CASE WHEN size(_vv) = 1 THEN 'Point' "
        "WHEN size(_vv) >= 4 AND try_element_at(_vv, 1).x = try_element_at(_vv, -1).x "
        "AND try_element_at(_vv, 1).y = try_element_at(_vv, -1).y THEN 'Polygon' "
        "WHEN size(_vv) >= 2 THEN 'LineString' "
        "ELSE raise_error('Provide at least one point as input') END"
    )
    body = f"CASE WHEN _vv IS NULL THEN NULL ELSE named_struct('kind', {kind}, 'parts', array(array(_vv))) END"
    return F.expr(_let(vertices, "_vv", body))


def geom_kind(g) -> Column:
    return _c(g).getField("kind")


def geom_x(g) -> Column:
    """x of a point geometry (first vertex of other kinds)."""
    return _first_vertex(g).getField("x")


def geom_y(g) -> Column:
    return _first_vertex(g).getField("y")


def _first_vertex(g) -> Column:
    one = F.lit(1)
    return F.try_element_at(F.try_element_at(F.try_element_at(_c(g).getField("parts"), one), one), one)


# ---------------------------------------------------------------- decomposition
#
# Heavy per-row functions are written as Spark SQL text: one ``F.expr`` call
# builds the whole expression JVM-side, where building it Column by Column
# would cost thousands of driver round-trips. Arguments are column names
# (or SQL expressions) of geometry values.


def _let(value: str, var: str, body: str) -> str:
    return f"element_at(transform(array({value}), {var} -> {body}), 1)"


def rings_sql(g: str) -> str:
    return f"flatten(transform({g}.parts, _rp -> transform(_rp, (_rr, _ri) -> named_struct('hole', _ri > 0, 'ring', _rr))))"


def vertices_sql(g: str) -> str:
    return f"flatten(flatten({g}.parts))"


def pairs_sql(arr: str) -> str:
    """Consecutive vertex pairs of a vertex array ``arr`` (a simple reference)."""
    m = f"greatest(size({arr}) - 1, 0)"
    return (
        f"zip_with(slice({arr}, 1, {m}), slice({arr}, 2, {m}), "
        "(_pu, _pv) -> named_struct('x1', _pu.x, 'y1', _pu.y, 'x2', _pv.x, 'y2', _pv.y))"
    )


def segments_sql(g: str) -> str:
    """All segments of ``g``; a point yields one zero-length segment."""
    return (
        f"CASE WHEN {g}.kind = 'Point' THEN transform({vertices_sql(g)}, "
        "_sw -> named_struct('x1', _sw.x, 'y1', _sw.y, 'x2', _sw.x, 'y2', _sw.y)) "
        f"ELSE flatten(transform(flatten({g}.parts), _sr -> {pairs_sql('_sr')})) END"
    )


def rings(g) -> Column:
    """array<struct<hole boolean, ring array<vertex>>> of all parts."""
    return F.expr(rings_sql(g)) if isinstance(g, str) else _rings_col(g)


def _rings_col(geom: Column) -> Column:
    per_part = F.transform(
        geom.getField("parts"), lambda p: F.transform(p, lambda r, i: F.struct((i > 0).alias("hole"), r.alias("ring")))
    )
    return F.flatten(per_part)


def vertices(g) -> Column:
    """All vertices of a geometry, flattened."""
    return F.flatten(F.flatten(_c(g).getField("parts")))


def _pairs(arr: str) -> Column:
    """Consecutive vertex pairs of a vertex-array column as segments {x1, y1, x2, y2}."""
    return F.expr(pairs_sql(arr))


def segments(g: str) -> Column:
    return F.expr(segments_sql(g))


def transform_vertices(g, fn) -> Column:
    """Apply ``fn(x, y) -> (x', y')`` to every vertex of a geometry."""
    geom = _c(g)

    def move(v):
        nx, ny = fn(v.getField("x"), v.getField("y"))
        return F.struct(nx.alias("x"), ny.alias("y"))

    parts = F.transform(geom.getField("parts"), lambda p: F.transform(p, lambda r: F.transform(r, move)))
    return F.when(geom.isNotNull(), F.struct(geom.getField("kind").alias("kind"), parts.alias("parts")))


def bbox_sql(g: str) -> str:
    body = (
        "named_struct('minx', array_min(transform(_bv, _b1 -> _b1.x)), 'miny', array_min(transform(_bv, _b2 -> _b2.y)), "
        "'maxx', array_max(transform(_bv, _b3 -> _b3.x)), 'maxy', array_max(transform(_bv, _b4 -> _b4.y)))"
    )
    return _let(vertices_sql(g), "_bv", body)


def bbox(g: str) -> Column:
    """{minx, miny, maxx, maxy} of a geometry."""
    return F.expr(bbox_sql(g))


# ---------------------------------------------------------------- centroid

_ZERO6 = "named_struct('a', 0D, 'mx', 0D, 'my', 0D, 'l', 0D, 'lx', 0D, 'ly', 0D)"
_ZERO9 = "named_struct('a', 0D, 'mx', 0D, 'my', 0D, 'l', 0D, 'lx', 0D, 'ly', 0D, 'px', 0D, 'py', 0D, 'n', 0D)"


def centroid_sql(g: str) -> str:
    # segment relative to the base vertex _cb, with its absolute midpoint
    rel = (
        "zip_with(slice(_cr.ring, 1, greatest(size(_cr.ring) - 1, 0)), slice(_cr.ring, 2, greatest(size(_cr.ring) - 1, 0)), "
        "(_cu, _cv) -> named_struct('x1', _cu.x - _cb.x, 'y1', _cu.y - _cb.y, 'x2', _cv.x - _cb.x, 'y2', _cv.y - _cb.y, "
        "'mx', (_cu.x + _cv.x) / 2, 'my', (_cu.y + _cv.y) / 2))"
    )
    step_body = (
        "named_struct('a', _ca.a + _ct.c, 'mx', _ca.mx + _ct.c * (_cs.x1 + _cs.x2), 'my', _ca.my + _ct.c * (_cs.y1 + _cs.y2), "
        "'l', _ca.l + _ct.len, 'lx', _ca.lx + _ct.len * _cs.mx, 'ly', _ca.ly + _ct.len * _cs.my)"
    )
    step = "(_ca, _cs) -> " + _let(
        "named_struct('c', _cs.x1 * _cs.y2 - _cs.x2 * _cs.y1, "
        "'len', sqrt((_cs.x2 - _cs.x1) * (_cs.x2 - _cs.x1) + (_cs.y2 - _cs.y1) * (_cs.y2 - _cs.y1)))",
        "_ct",
        step_body,
    )
    sign = "(CASE WHEN _cr.hole THEN -1D ELSE 1D END) * signum(_cq.a)"
    finish_ring = (
        f"_cq -> named_struct('a', {sign} * _cq.a, 'mx', {sign} * _cq.mx, 'my', {sign} * _cq.my, "
        "'l', _cq.l, 'lx', _cq.lx, 'ly', _cq.ly, 'px', try_element_at(_cr.ring, 1).x, 'py', try_element_at(_cr.ring, 1).y, 'n', 1D)"
    )
    per_ring = f"transform({rings_sql('_cg')}, _cr -> aggregate({rel}, {_ZERO6}, {step}, {finish_ring}))"
    add = (
        "(_cz, _cw) -> named_struct('a', _cz.a + _cw.a, 'mx', _cz.mx + _cw.mx, 'my', _cz.my + _cw.my, 'l', _cz.l + _cw.l, "
        "'lx', _cz.lx + _cw.lx, 'ly', _cz.ly + _cw.ly, 'px', _cz.px + _cw.px, 'py', _cz.py + _cw.py, 'n', _cz.n + _cw.n)"
    )
    areal = "(_cg.kind IN ('Polygon', 'MultiPolygon') AND _cf.a != 0)"
    finish = (
        "_cf -> named_struct('kind', 'Point', 'parts', array(array(array(named_struct("
        f"'x', CASE WHEN {areal} THEN _cb.x + _cf.mx / (3 * _cf.a) WHEN _cf.l > 0 THEN _cf.lx / _cf.l ELSE _cf.px / _cf.n END, "
        f"'y', CASE WHEN {areal} THEN _cb.y + _cf.my / (3 * _cf.a) WHEN _cf.l > 0 THEN _cf.ly / _cf.l ELSE _cf.py / _cf.n END)))))"
    )
    body = _let(f"try_element_at({vertices_sql('_cg')}, 1)", "_cb", f"aggregate({per_ring}, {_ZERO9}, {add}, {finish})")
    return _let(g, "_cg", f"CASE WHEN _cg IS NULL THEN NULL ELSE {body} END")


def centroid(g: str) -> Column:
    """Centroid as a point geometry.

    Areal kinds: area-weighted (shells positive, holes negative, triangles
    taken from the first vertex); zero-area polygons and lines: length-weighted
    segment midpoints; otherwise the mean of the rings' first vertices.
    """
    return F.expr(centroid_sql(g))


# ---------------------------------------------------------------- distance

_START = "named_struct('d', CAST('Infinity' AS DOUBLE), 'x', CAST(NULL AS DOUBLE), 'y', CAST(NULL AS DOUBLE))"
_NOHIT = "named_struct('d', CAST(NULL AS DOUBLE), 'x', CAST(NULL AS DOUBLE), 'y', CAST(NULL AS DOUBLE))"


def _project_sql(p: str, s: str, tag: str) -> str:
    """struct(d, x, y): nearest point on segment ``s`` to vertex ``p``."""
    e, t = f"_e{tag}", f"_t{tag}"
    len2 = f"({e}.dx * {e}.dx + {e}.dy * {e}.dy)"
    tval = f"CASE WHEN {len2} > 0 THEN least(greatest((({p}.x - {s}.x1) * {e}.dx + ({p}.y - {s}.y1) * {e}.dy) / {len2}, 0D), 1D) ELSE 0D END"
    qx, qy = f"({s}.x1 + {t} * {e}.dx)", f"({s}.y1 + {t} * {e}.dy)"
    inner = f"named_struct('d', sqrt(({p}.x - {qx}) * ({p}.x - {qx}) + ({p}.y - {qy}) * ({p}.y - {qy})), 'x', {qx}, 'y', {qy})"
    return _let(f"named_struct('dx', {s}.x2 - {s}.x1, 'dy', {s}.y2 - {s}.y1)", e, _let(tval, t, inner))


def _orient_sql(a: str, b: str, c: str) -> str:
    (ax, ay), (bx, by), (cx, cy) = a, b, c
    return f"signum(({bx} - {ax}) * ({cy} - {ay}) - ({by} - {ay}) * ({cx} - {ax}))"


def _crossing_sql(s: str, t: str) -> str:
    s1, s2, t1, t2 = (f"{s}.x1", f"{s}.y1"), (f"{s}.x2", f"{s}.y2"), (f"{t}.x1", f"{t}.y1"), (f"{t}.x2", f"{t}.y2")
    proper = (
        f"({_orient_sql(s1, s2, t1)} * {_orient_sql(s1, s2, t2)} < 0 AND "
        f"{_orient_sql(t1, t2, s1)} * {_orient_sql(t1, t2, s2)} < 0)"
    )
    den = f"(({s}.x2 - {s}.x1) * ({t}.y2 - {t}.y1) - ({s}.y2 - {s}.y1) * ({t}.x2 - {t}.x1))"
    u = f"((({t}.x1 - {s}.x1) * ({t}.y2 - {t}.y1) - ({t}.y1 - {s}.y1) * ({t}.x2 - {t}.x1)) / {den})"
    return proper, f"({s}.x1 + {u} * ({s}.x2 - {s}.x1))", f"({s}.y1 + {u} * ({s}.y2 - {s}.y1))"


def _inside_sql(p: str, segs: str) -> str:
    return (
        f"(size(filter({segs}, _iz -> ((_iz.y1 > {p}.y) != (_iz.y2 > {p}.y)) AND "
        f"({p}.x < (_iz.x2 - _iz.x1) * ({p}.y - _iz.y1) / (_iz.y2 - _iz.y1) + _iz.x1))) % 2 = 1)"
    )


def _corners_sql(g: str) -> str:
    """SQL text: the first vertex of every part."""
    heads = f"transform({g}.parts, _cp -> try_element_at(try_element_at(_cp, 1), 1))"
    return f"filter({heads}, _ch -> _ch IS NOT NULL)"


def closest_sql(g1: str, g2: str) -> str:
    """SQL of struct(d, x, y): distance of two geometries and the point on g1 nearest g2."""
    from_a = (
        f"aggregate(_k.va, {_START}, (_m1, _pa) -> least(_m1, aggregate(_k.sb, {_START}, "
        f"(_m2, _sb) -> least(_m2, named_struct('d', {_project_sql('_pa', '_sb', 'a')}.d, 'x', _pa.x, 'y', _pa.y)))))"
    )
    from_b = (
        f"aggregate(_k.vb, {_START}, (_m3, _pb) -> least(_m3, aggregate(_k.sa, {_START}, "
        f"(_m4, _sa) -> least(_m4, {_project_sql('_pb', '_sa', 'b')}))))"
    )
    proper, ix, iy = _crossing_sql("_s1", "_s2")
    crossing = (
        f"aggregate(_k.sa, {_NOHIT}, (_x1, _s1) -> aggregate(_k.sb, _x1, (_x2, _s2) -> "
        f"CASE WHEN _x2.d IS NULL AND {proper} THEN named_struct('d', 0D, 'x', {ix}, 'y', {iy}) ELSE _x2 END))"
    )
    # one corner of every part: without a crossing, a part lies inside the other geometry as its corner does
    in_a = f"CASE WHEN _k.a.kind IN ('Polygon', 'MultiPolygon') THEN try_element_at(filter(_k.hb, _hb -> {_inside_sql('_hb', '_k.sa')}), 1) END"
    in_b = f"CASE WHEN _k.b.kind IN ('Polygon', 'MultiPolygon') THEN try_element_at(filter(_k.ha, _ha -> {_inside_sql('_ha', '_k.sb')}), 1) END"
    body = _let(
        f"coalesce({in_a}, {in_b})",
        "_in",
        "CASE WHEN _in IS NOT NULL THEN named_struct('d', 0D, 'x', _in.x, 'y', _in.y) "
        f"ELSE {_let(crossing, '_cx', f'CASE WHEN _cx.d IS NOT NULL THEN _cx ELSE least({from_a}, {from_b}) END')} END",
    )
    bound = (
        f"named_struct('a', _ga, 'b', _gb, 'sa', {segments_sql('_ga')}, 'sb', {segments_sql('_gb')}, "
        f"'va', {vertices_sql('_ga')}, 'vb', {vertices_sql('_gb')}, 'ha', {_corners_sql('_ga')}, 'hb', {_corners_sql('_gb')})"
    )
    pair = f"named_struct('a', {g1}, 'b', {g2})"
    return _let(
        pair,
        "_gp",
        f"CASE WHEN _gp.a IS NULL OR _gp.b IS NULL THEN NULL ELSE "
        + _let("_gp.a", "_ga", _let("_gp.b", "_gb", _let(bound, "_k", body)))
        + " END",
    )


def closest_on_first(g1: str, g2: str) -> Column:
    """struct(d, x, y): planar distance of two geometries and the point on g1 nearest g2.

    Touching, crossing or containment give distance 0. Cost is
    |g1| x |g2| vertex-segment tests, meant for way-sized geometries.
    """
    return F.expr(closest_sql(g1, g2))


def distance(g1: str, g2: str) -> Column:
    return closest_on_first(g1, g2).getField("d")


# ---------------------------------------------------------------- reprojection
#
# Transverse Mercator by the Krueger series (third order) for the UTM family and the
# Gauss-Krueger zones, Lambert azimuthal equal-area, spherical Mercator. UTM
# scale 0.9996, false easting 500000 m, false northing 0 m (north) / 10000000 m (south).

# fixed values: semi-major axis and flattening of the ellipsoids
_ELLIPSOIDS = {
    "GRS80": (6378137.0, 1 / 298.257222101),
    "WGS84": (6378137.0, 1 / 298.257223563),
    "Bessel": (6377397.155, 1 / 299.1528128),
}
# fixed values: position-vector shift of the German main triangle net to WGS84 (m, arc seconds, parts per million)
DHDN_TO_WGS84 = (598.1, 73.7, 418.2, 0.202, 0.045, -2.455, 6.7)
_K0 = 0.9996
_E0 = 500000.0


class Crs:
    """A coordinate reference system understood by :func:`reproject`.

    ``kind`` is ``geographic`` (4326), ``transverse`` (UTM: 258xx, 326xx, 327xx; Gauss-Krueger zones 2 to 5:
    31466 to 31469, whose datum takes a seven-parameter shift), ``equal-area`` (European
    Lambert azimuthal: 3035) or ``web`` (Web Mercator: 3857).
    """

    def __init__(self, code: str):
        self.code = code.lower().strip()
        m = re.fullmatch(r"epsg:(\d+)", self.code)
        if not m:
            raise ValueError(f"unsupported CRS: {code}")
        num = int(m.group(1))
        self.kind, self.shift, self.ellipsoid = "transverse", None, "WGS84"
        self.k0, self.n0 = _K0, 0.0
        if num == 4326:
            self.kind = "geographic"
        elif num == 3857:
            self.kind = "web"
        elif num == 3035:
            self.kind, self.ellipsoid = "equal-area", "GRS80"
        elif 25828 <= num <= 25838:
            self._utm("GRS80", num - 25800)
        elif 32601 <= num <= 32660:
            self._utm("WGS84", num - 32600)
        elif 32701 <= num <= 32760:
            self._utm("WGS84", num - 32700)
            self.n0 = 10000000.0
        elif 31466 <= num <= 31469:
            zone = num - 31464
            self.ellipsoid, self.shift, self.k0 = "Bessel", DHDN_TO_WGS84, 1.0
            self.lon0, self.e0 = 3.0 * zone, zone * 1e6 + 500000.0
        else:
            raise ValueError(f"unsupported CRS: {code}")
        self.geographic = self.kind == "geographic"
        self.a, f = _ELLIPSOIDS[self.ellipsoid]
        self.e2 = f * (2 - f)
        n = f / (2 - f)
        self.n = n
        self.A = self.a / (1 + n) * (1 + n * n / 4 + n**4 / 64)
        self.e = 2 * math.sqrt(n) / (1 + n)
        self.alpha = (n / 2 - 2 * n * n / 3 + 5 * n**3 / 16, 13 * n * n / 48 - 3 * n**3 / 5, 61 * n**3 / 240)
        self.beta = (n / 2 - 2 * n * n / 3 + 37 * n**3 / 96, n * n / 48 + n**3 / 15, 17 * n**3 / 480)
        self.delta = (2 * n - 2 * n * n / 3 - 2 * n**3, 7 * n * n / 3 - 8 * n**3 / 5, 56 * n**3 / 15)

    def _utm(self, ellipsoid: str, zone: int) -> None:
        self.ellipsoid, self.lon0, self.e0 = ellipsoid, 6.0 * zone - 183.0, _E0


# fixed values: origin of the European equal-area projection (degrees, metres)
_LAEA_LON0, _LAEA_LAT0, _LAEA_E0, _LAEA_N0 = 10.0, 52.0, 4321000.0, 3210000.0


def _authalic(crs: Crs) -> tuple[float, float, float, float, float]:
    """Of the equal-area projection: q at the pole, authalic radius, sine and cosine of the origin's authalic latitude, scale d."""
    e, e2 = math.sqrt(crs.e2), crs.e2
    q = lambda s: (1 - e2) * (s / (1 - e2 * s * s) + math.atanh(e * s) / e)
    s0 = math.sin(math.radians(_LAEA_LAT0))
    qp, radius = q(1.0), crs.a * math.sqrt(q(1.0) / 2)
    beta = math.asin(q(s0) / qp)
    d = crs.a * math.cos(math.radians(_LAEA_LAT0)) / math.sqrt(1 - e2 * s0 * s0) / (radius * math.cos(beta))
    return qp, radius, math.sin(beta), math.cos(beta), d


def _to_laea(lon: Column, lat: Column, crs: Crs):
    qp, radius, sin0, cos0, d = _authalic(crs)
    e = math.sqrt(crs.e2)
    s, lam = F.sin(F.radians(lat)), F.radians(lon - _dbl(_LAEA_LON0))
    q = _dbl(1 - crs.e2) * (s / (1 - _dbl(crs.e2) * s * s) + F.atanh(_dbl(e) * s) / _dbl(e))
    beta = F.asin(F.least(F.greatest(q / _dbl(qp), _dbl(-1)), _dbl(1)))
    b = _dbl(radius) * F.sqrt(2 / (1 + _dbl(sin0) * F.sin(beta) + _dbl(cos0) * F.cos(beta) * F.cos(lam)))
    north = _dbl(cos0) * F.sin(beta) - _dbl(sin0) * F.cos(beta) * F.cos(lam)
    return _dbl(_LAEA_E0) + b * _dbl(d) * F.cos(beta) * F.sin(lam), _dbl(_LAEA_N0) + b / _dbl(d) * north


def _from_laea(east: Column, north: Column, crs: Crs):
    qp, radius, sin0, cos0, d = _authalic(crs)
    x, y = (east - _dbl(_LAEA_E0)) / _dbl(d), (north - _dbl(_LAEA_N0)) * _dbl(d)
    rho = F.hypot(x, y)
    c = 2 * F.asin(rho / _dbl(2 * radius))
    # sin(c) / rho without a division by zero at the origin
    ratio = F.when(rho > 0, F.try_divide(F.sin(c), rho)).otherwise(_dbl(1 / radius))
    beta = F.asin(F.cos(c) * _dbl(sin0) + y * ratio * _dbl(cos0))
    e2 = crs.e2
    lat = beta
    for k, w in ((2, e2 / 3 + 31 * e2**2 / 180 + 517 * e2**3 / 5040), (4, 23 * e2**2 / 360 + 251 * e2**3 / 3780), (6, 761 * e2**3 / 45360)):
        lat = lat + _dbl(w) * F.sin(k * beta)
    lam = F.atan2(x * ratio, F.cos(c) * _dbl(cos0) - y * ratio * _dbl(sin0))
    return F.degrees(lam) + _dbl(_LAEA_LON0), F.degrees(lat)


def _to_web(lon: Column, lat: Column, crs: Crs):
    return _dbl(crs.a) * F.radians(lon), _dbl(crs.a) * F.atanh(F.sin(F.radians(lat)))


def _from_web(east: Column, north: Column, crs: Crs):
    return F.degrees(east / _dbl(crs.a)), F.degrees(F.asin(F.tanh(north / _dbl(crs.a))))


def shifted_datum(lon: Column, lat: Column, source: str, target: str, shift: tuple[float, ...], back: bool = False):
    """(lon, lat) at height 0 on ellipsoid ``source`` moved to ellipsoid ``target`` by a seven-parameter position-vector shift.

    ``back`` applies the inverse of ``shift``.
    """
    a, f = _ELLIPSOIDS[source]
    e2 = f * (2 - f)
    phi, lam = F.radians(lat), F.radians(lon)
    r = _dbl(a) / F.sqrt(1 - _dbl(e2) * F.sin(phi) * F.sin(phi))
    xyz = F.struct((r * F.cos(phi) * F.cos(lam)).alias("x"), (r * F.cos(phi) * F.sin(lam)).alias("y"), (r * _dbl(1 - e2) * F.sin(phi)).alias("z"))
    dx, dy, dz = shift[:3]
    rx, ry, rz = (math.radians(v / 3600) for v in shift[3:6])
    m = 1 + shift[6] * 1e-6
    rows = ((1.0, -rz, ry), (rz, 1.0, -rx), (-ry, rx, 1.0))
    if back:
        det = 1 + rx * rx + ry * ry + rz * rz
        v = (rx, ry, rz)
        # inverse of I + [v]x, exactly: (I - [v]x + v v') / det
        rows = tuple(tuple((((i == j) - (rows[i][j] - (i == j))) + v[i] * v[j]) / det for j in range(3)) for i in range(3))

    def moved(p: Column) -> Column:
        at = [p.getField(n) for n in "xyz"]
        if back:
            at = [(c - _dbl(t)) / _dbl(m) for c, t in zip(at, (dx, dy, dz), strict=True)]
        out = [_dbl(row[0]) * at[0] + _dbl(row[1]) * at[1] + _dbl(row[2]) * at[2] for row in rows]
        if not back:
            out = [_dbl(m) * c + _dbl(t) for c, t in zip(out, (dx, dy, dz), strict=True)]
        return F.struct(*[c.alias(n) for c, n in zip(out, "xyz", strict=True)])

    b, g = _ELLIPSOIDS[target]
    ee = g * (2 - g)

    def geodetic(p: Column) -> Column:
        """Bowring's closed form; near the surface its error is below a micrometre."""
        x, y, z = (p.getField(n) for n in "xyz")
        flat = F.hypot(x, y)
        u = F.atan2(z, _dbl(1 - g) * flat)
        up = z + _dbl(ee / (1 - ee) * b * (1 - g)) * F.pow(F.sin(u), 3)
        out = flat - _dbl(ee * b) * F.pow(F.cos(u), 3)
        return F.struct(F.degrees(F.atan2(y, x)).alias("lon"), F.degrees(F.atan2(up, out)).alias("lat"))

    at = let(let(xyz, moved), geodetic)
    return at.getField("lon"), at.getField("lat")


def _to_utm(lon: Column, lat: Column, crs: Crs):
    phi = F.radians(lat)
    dlam = F.radians(lon - F.lit(crs.lon0))
    e = _dbl(crs.e)
    t = F.sinh(F.atanh(F.sin(phi)) - e * F.atanh(e * F.sin(phi)))
    xi = F.atan2(t, F.cos(dlam))
    eta = F.atanh(F.sin(dlam) / F.sqrt(1 + t * t))
    east = eta
    north = xi
    for j, aj in enumerate(crs.alpha, start=1):
        east = east + _dbl(aj) * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
        north = north + _dbl(aj) * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
    k = _dbl(crs.k0 * crs.A)
    return _dbl(crs.e0) + k * east, _dbl(crs.n0) + k * north


def _from_utm(east: Column, north: Column, crs: Crs):
    k = _dbl(crs.k0 * crs.A)
    xi = (north - _dbl(crs.n0)) / k
    eta = (east - _dbl(crs.e0)) / k
    xi_p, eta_p = xi, eta
    for j, bj in enumerate(crs.beta, start=1):
        xi_p = xi_p - _dbl(bj) * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
        eta_p = eta_p - _dbl(bj) * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
    chi = F.asin(F.sin(xi_p) / F.cosh(eta_p))
    phi = chi
    for j, dj in enumerate(crs.delta, start=1):
        phi = phi + _dbl(dj) * F.sin(2 * j * chi)
    lam = F.atan2(F.sinh(eta_p), F.cos(xi_p))
    return F.degrees(lam) + F.lit(crs.lon0), F.degrees(phi)


_FORWARD = {"transverse": _to_utm, "equal-area": _to_laea, "web": _to_web}
_INVERSE = {"transverse": _from_utm, "equal-area": _from_laea, "web": _from_web}


def reproject_xy(x, y, src: str, dst: str):
    """(x', y') Column pair: coordinates moved from CRS ``src`` to ``dst``."""
    s, d = Crs(src), Crs(dst)
    x, y = _c(x).cast("double"), _c(y).cast("double")
    if s.code == d.code:
        return x, y
    if not s.geographic:
        x, y = _INVERSE[s.kind](x, y, s)
        if s.shift:
            x, y = shifted_datum(x, y, s.ellipsoid, "WGS84", s.shift)
    if not d.geographic:
        if d.shift:
            x, y = shifted_datum(x, y, "WGS84", d.ellipsoid, d.shift, back=True)
        x, y = _FORWARD[d.kind](x, y, d)
    return x, y


def reproject(g, src: str, dst: str) -> Column:
    """Geometry with every vertex moved from ``src`` to ``dst`` (edges stay straight)."""
    if Crs(src).code == Crs(dst).code:
        return _c(g)
    return transform_vertices(g, lambda x, y: reproject_xy(x, y, src, dst))


def as_text(g, digits: int | None = None) -> Column:
    """Well-known text of a geometry, e.g. ``POINT (1.49 42.47)`` or ``POLYGON ((0.0 0.0, ...))``.

    ``digits`` rounds the coordinates. A geometry without vertices is ``EMPTY``.
    """
    number = (lambda v: F.round(v, digits).cast("string")) if digits is not None else (lambda v: v.cast("string"))

    def ring(r: Column) -> Column:
        return F.array_join(F.transform(r, lambda v: F.concat(number(v.getField("x")), F.lit(" "), number(v.getField("y")))), ", ")

    def listed(items: Column, text) -> Column:
        return F.array_join(F.transform(items, lambda i: F.concat(F.lit("("), text(i), F.lit(")"))), ", ")

    def build(geom: Column) -> Column:
        kind, parts = geom.getField("kind"), geom.getField("parts")
        flat = F.when(kind == "MultiPolygon", listed(parts, lambda p: listed(p, ring)))
        flat = flat.when(kind == "Polygon", listed(F.flatten(parts), ring)).otherwise(ring(F.flatten(F.flatten(parts))))
        body = F.when(F.size(F.flatten(F.flatten(parts))) > 0, F.concat(F.lit("("), flat, F.lit(")"))).otherwise(F.lit("EMPTY"))
        return F.when(geom.isNotNull(), F.concat(F.upper(kind), F.lit(" "), body))

    return let(_c(g), build)
