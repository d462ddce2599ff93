import math

import pytest
from pyspark.sql import functions as F

from mapweave.functions import geometry as G


def _geom(spark, pts):
    df = spark.createDataFrame([(1, [{"x": float(x), "y": float(y)} for x, y in pts])], "id int, v array<struct<x:double,y:double>>")
    return df.select(G.geometry_from_vertices("v").alias("g"))


@pytest.mark.parametrize(
    "pts,kind",
    [
        ([(0, 0), (0, 1), (1, 1), (1, 0), (0, 0)], "Polygon"),
        ([(0, 0), (1, 1), (2, 2)], "LineString"),
        ([(0, 0), (1, 1)], "LineString"),
        ([(0, 0), (1, 1), (0, 0)], "LineString"),
        ([(0, 0)], "Point"),
    ],
)
def test_kinds(spark, pts, kind):
    assert _geom(spark, pts).first().g.kind == kind


def test_empty_vertex_list_raises(spark):
    with pytest.raises(Exception, match="at least one point"):
        _geom(spark, []).collect()


def _centroid(spark, pts):
    row = _geom(spark, pts).select(G.centroid("g").alias("c")).first().c
    return row.parts[0][0][0].x, row.parts[0][0][0].y


def test_centroids(spark):
    assert _centroid(spark, [(0, 0), (2, 0), (2, 2), (0, 2), (0, 0)]) == pytest.approx((1, 1))
    # clockwise shell gives the same centroid
    assert _centroid(spark, [(0, 0), (0, 2), (2, 2), (2, 0), (0, 0)]) == pytest.approx((1, 1))
    # lines: length-weighted midpoints
    assert _centroid(spark, [(0, 0), (2, 0), (2, 1)]) == pytest.approx(((2 * 1 + 1 * 2) / 3, (0 + 1 * 0.5) / 3))
    assert _centroid(spark, [(3, 4)]) == pytest.approx((3, 4))


def test_centroid_with_hole(spark):
    shell = F.array(*[G.vertex(F.lit(x), F.lit(y)) for x, y in [(0, 0), (4, 0), (4, 4), (0, 4), (0, 0)]])
    hole = F.array(*[G.vertex(F.lit(x), F.lit(y)) for x, y in [(0, 0), (1, 0), (1, 1), (0, 1), (0, 0)]])
    g = spark.range(1).select(G.polygon(shell, F.array(hole)).alias("g"))
    c = g.select(G.centroid("g").alias("c")).first().c.parts[0][0][0]
    # 16 * (2, 2) - 1 * (0.5, 0.5) over area 15
    assert (c.x, c.y) == pytest.approx(((32 - 0.5) / 15, (32 - 0.5) / 15))


def _pair(spark, a, b):
    df = spark.createDataFrame([(a, b)], "a array<struct<x:double,y:double>>, b array<struct<x:double,y:double>>")
    df = df.select(G.geometry_from_vertices("a").alias("ga"), G.geometry_from_vertices("b").alias("gb"))
    return df.select(G.closest_on_first("ga", "gb").alias("r")).first().r


def _v(pts):
    return [{"x": float(x), "y": float(y)} for x, y in pts]


def test_distances(spark):
    square = _v([(0, 0), (2, 0), (2, 2), (0, 2), (0, 0)])
    assert _pair(spark, _v([(0, 0)]), _v([(3, 4)])).d == pytest.approx(5)
    assert _pair(spark, _v([(1, 1)]), square).d == 0  # inside
    r = _pair(spark, _v([(3, 1)]), square)
    assert r.d == pytest.approx(1) and (r.x, r.y) == pytest.approx((3, 1))
    r = _pair(spark, square, _v([(3, 1)]))  # closest point on the square
    assert r.d == pytest.approx(1) and (r.x, r.y) == pytest.approx((2, 1))
    crossing = _pair(spark, _v([(0, 0), (2, 2)]), _v([(0, 2), (2, 0)]))
    assert crossing.d == 0 and (crossing.x, crossing.y) == pytest.approx((1, 1))


def test_utm_forward_and_back(spark):
    df = spark.createDataFrame([(9.0, 48.0), (1.5, 42.5)], "lon double, lat double")
    e, n = G.reproject_xy("lon", "lat", "epsg:4326", "epsg:25832")
    out = df.select(e.alias("e"), n.alias("n")).collect()
    assert out[0].e == pytest.approx(500000.0, abs=1e-6)
    assert out[0].n == pytest.approx(5316300.224, abs=1e-3)
    back = df.select(e.alias("e"), n.alias("n"))
    lon, lat = G.reproject_xy("e", "n", "epsg:25832", "epsg:4326")
    rows = back.select(lon.alias("lon"), lat.alias("lat")).collect()
    assert rows[0].lon == pytest.approx(9.0, abs=1e-7) and rows[0].lat == pytest.approx(48.0, abs=1e-7)
    assert rows[1].lon == pytest.approx(1.5, abs=1e-7) and rows[1].lat == pytest.approx(42.5, abs=1e-7)


def test_unknown_crs():
    with pytest.raises(ValueError):
        G.Crs("epsg:3395")


def test_jts_oracle_random_polygons(spark):
    """Centroid and point distance against the JTS library shipped in Spark's jars (driver only)."""
    try:
        jts = spark._jvm.org.locationtech.jts
        factory = jts.geom.GeometryFactory()
        jts.geom.Coordinate(0.0, 0.0)
    except Exception:  # pragma: no cover
        pytest.skip("JTS not reachable")
    import random

    rng = random.Random(7)
    rows, expect = [], []
    for _ in range(20):
        n = rng.randint(3, 9)
        cx, cy = rng.uniform(-5, 5), rng.uniform(-5, 5)
        angles = sorted(rng.uniform(0, 2 * math.pi) for _ in range(n))
        pts = [(cx + rng.uniform(0.5, 2) * math.cos(a), cy + rng.uniform(0.5, 2) * math.sin(a)) for a in angles]
        pts.append(pts[0])
        px, py = rng.uniform(-8, 8), rng.uniform(-8, 8)
        coords = spark.sparkContext._gateway.new_array(jts.geom.Coordinate, len(pts))
        for i, (x, y) in enumerate(pts):
            coords[i] = jts.geom.Coordinate(float(x), float(y))
        poly = factory.createPolygon(coords)
        pt = factory.createPoint(jts.geom.Coordinate(px, py))
        c = poly.getCentroid()
        expect.append((c.getX(), c.getY(), poly.distance(pt)))
        rows.append((_v(pts), _v([(px, py)])))
    df = spark.createDataFrame(rows, "a array<struct<x:double,y:double>>, b array<struct<x:double,y:double>>")
    df = df.select(G.geometry_from_vertices("a").alias("ga"), G.geometry_from_vertices("b").alias("gb"))
    got = df.select(G.centroid("ga").alias("c"), G.distance("ga", "gb").alias("d")).collect()
    for (ex, ey, ed), r in zip(expect, got):
        assert r.c.parts[0][0][0].x == pytest.approx(ex, abs=1e-9)
        assert r.c.parts[0][0][0].y == pytest.approx(ey, abs=1e-9)
        assert r.d == pytest.approx(ed, abs=1e-9)


def test_published_control_points(spark):
    """UTM coordinates as published for two well-known towers."""
    rows = spark.createDataFrame([(2.2945, 48.8582, -79.3871389, 43.6425667)], "a double, b double, c double, d double")
    e1, n1 = G.reproject_xy("a", "b", "epsg:4326", "epsg:32631")
    e2, n2 = G.reproject_xy("c", "d", "epsg:4326", "epsg:32617")
    r = rows.select(e1.alias("e1"), n1.alias("n1"), e2.alias("e2"), n2.alias("n2")).first()
    assert abs(r.e1 - 448251.8) < 0.5 and abs(r.n1 - 5411932.7) < 0.5
    assert abs(r.e2 - 630084) < 1.5 and abs(r.n2 - 4833438) < 1.5


def test_distance_of_multi_part_geometries(spark):
    def ring(x, y, h):
        return F.array(*[G.vertex(F.lit(x + dx), F.lit(y + dy)) for dx, dy in ((-h, -h), (h, -h), (h, h), (-h, h), (-h, -h))])

    def multi(*rings):
        return F.struct(F.lit("MultiPolygon").alias("kind"), F.array(*[F.array(r) for r in rings]).alias("parts"))

    df = spark.range(1).select(
        G.polygon(ring(5.0, 5.0, 5.0)).alias("big"), multi(ring(-9.0, 5.0, 1.0), ring(5.0, 5.0, 1.0)).alias("two"), multi(ring(-9.0, 5.0, 1.0)).alias("one")
    )
    r = df.select(
        G.distance("big", "two").alias("a"), G.distance("two", "big").alias("b"), G.distance("big", "one").alias("c"), G.distance("one", "big").alias("d")
    ).first()
    assert (r.a, r.b, r.c, r.d) == (0.0, 0.0, 8.0, 8.0)
