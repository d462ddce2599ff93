"""Repaired areas against an independent geometry library on the driver and against closed forms."""

import math
import random

import pytest
from pyspark.sql import functions as F

from mapweave.functions import geometry as G
from mapweave.operators import repair as R
from mapweave.operators import rings as K
from mapweave.operators import spatial as S

GEOM = "struct<kind:string,parts:array<array<array<struct<x:double,y:double>>>>>"


def shapes(spark, polygons):
    """Areas from {id: [[ring, ...], ...]} with rings as lists of (x, y)."""
    rows = []
    for i, parts in polygons.items():
        parts = [[[{"x": float(x), "y": float(y)} for x, y in ring] for ring in part] for part in parts]
        rows.append((i, {"kind": "Polygon" if len(parts) == 1 else "MultiPolygon", "parts": parts}, "t"))
    return spark.createDataFrame(rows, f"id bigint, geom {GEOM}, tag string")


class Library:
    """The geometry classes in Spark's own jars, on the driver."""

    def __init__(self, spark):
        self.j = spark._jvm.org.locationtech.jts
        self.reader = self.j.io.WKTReader()

    def read(self, parts):
        text = ", ".join("(" + ", ".join("(" + ", ".join(f"{x!r} {y!r}" for x, y in ring) + ")" for ring in p) + ")" for p in parts)
        return self.reader.read(f"MULTIPOLYGON ({text})")

    def even_odd_area(self, parts):
        """Area of the faces of the linework whose inner point has odd parity."""
        rings = [r for p in parts for r in p]
        lines = self.reader.read("MULTILINESTRING (" + ", ".join("(" + ", ".join(f"{x!r} {y!r}" for x, y in r) + ")" for r in rings) + ")")
        maker = self.j.operation.polygonize.Polygonizer()
        maker.add(self.j.operation.union.UnaryUnionOp.union(lines))
        total = 0.0
        faces = maker.getPolygons()
        for face in faces.toArray():
            p = face.getInteriorPoint()
            px, py = p.getX(), p.getY()
            odd = False
            for r in rings:
                for (x1, y1), (x2, y2) in zip(r[:-1], r[1:], strict=True):
                    if (y1 > py) != (y2 > py) and px < x1 + (py - y1) * (x2 - x1) / (y2 - y1):
                        odd = not odd
            total += face.getArea() if odd else 0.0
        return total


def plain(parts):
    return [[[(v.x, v.y) for v in ring] for ring in part] for part in parts]


def check(spark, polygons, cell=0.7):
    """Repairs every shape; each must be valid and have the even-odd area."""
    lib = Library(spark)
    df = shapes(spark, polygons)
    got = {r.id: r.geom for r in R.repaired_geometries(S.area_edges(df, "geom", "id"), "id", cell).collect()}
    for i, parts in polygons.items():
        want = lib.even_odd_area(parts)
        if i not in got:
            assert want < 1e-9, (i, want)
            continue
        geom = lib.read(plain(got[i].parts))
        error = lib.j.operation.valid.IsValidOp(geom).getValidationError()
        assert error is None, (i, error.toString())
        assert geom.getArea() == pytest.approx(want, rel=1e-9, abs=1e-9), i
    return got


def test_known_shapes(spark):
    square = [(0, 0), (4, 0), (4, 4), (0, 4), (0, 0)]
    got = check(
        spark,
        {
            1: [[square]],
            2: [[[(0, 0), (4, 4), (4, 0), (0, 4), (0, 0)]]],  # a bow tie: two triangles
            3: [[square, [(1, 1), (3, 1), (3, 3), (1, 3), (1, 1)]]],  # a hole
            4: [[square, [(0, 0), (2, 1), (1, 2), (0, 0)]]],  # a hole that touches its shell in a vertex
            5: [[square], [[(2, 2), (6, 2), (6, 6), (2, 6), (2, 2)]]],  # overlapping shells: the overlap goes
            6: [[square], [[(4, 0), (8, 0), (8, 4), (4, 4), (4, 0)]]],  # shells side by side become one
            7: [[square], [square]],  # twice the same: nothing is left
            8: [[square, [(3, 1), (6, 1), (6, 3), (3, 3), (3, 1)]]],  # a hole across the border
            9: [[[(0, 0), (4, 0), (4, 4), (2, 0), (0, 4), (0, 0)]]],  # a vertex on an edge
            10: [[[(0, 0), (6, 0), (6, 6), (0, 6), (0, 0)], [(1, 1), (5, 1), (5, 5), (1, 5), (1, 1)]], [[(2, 2), (4, 2), (4, 4), (2, 4), (2, 2)]]],
            11: [[[(0, 0), (2, 2), (4, 0), (4, 4), (2, 2), (0, 4), (0, 0)]]],  # touches itself in a vertex
            12: [[[(0, 0), (4, 0), (4, 4), (4, 6), (4, 4), (0, 4), (0, 0)]]],  # a spike
            13: [[square, [(1, 1), (2, 2), (1, 3), (1, 1)], [(3, 1), (3, 3), (2, 2), (3, 1)]]],  # holes that touch each other
        },
    )
    rings = {i: sorted((len(part), sum(map(len, part))) for part in g.parts) for i, g in got.items()}
    assert rings[1] == [(1, 5)] and rings[2] == [(1, 4), (1, 4)] and rings[3] == [(2, 10)] and rings[4] == [(2, 9)]
    assert 7 not in got and rings[6] == [(1, 7)] and rings[10] == [(1, 5), (2, 10)] and got[10].kind == "MultiPolygon"


@pytest.mark.parametrize("cell", [0.7, 3.0, 50.0])
def test_random_stars_are_valid_and_keep_the_even_odd_area(spark, cell):
    rng = random.Random(7)
    polygons = {}
    for i in range(25):
        n = rng.randrange(3, 14)
        whole = rng.random() < 0.5  # grid points meet in vertices and overlap along edges
        draw = (lambda: (rng.randrange(6), rng.randrange(6))) if whole else (lambda: (rng.uniform(0, 6), rng.uniform(0, 6)))
        parts = []
        for _ in range(rng.randrange(1, 3)):
            ring = [draw() for _ in range(n)]
            parts.append([ring + ring[:1]])
        polygons[i] = parts
    check(spark, polygons, cell)


def test_make_valid_changes_only_invalid_areas(spark):
    square = [(0, 0), (4, 0), (4, 4), (0, 4), (0, 0)]
    df = shapes(spark, {1: [[square]], 2: [[[(0, 0), (4, 4), (4, 0), (0, 4), (0, 0)]]], 3: [[square], [square]]})
    df = df.unionByName(spark.createDataFrame([(4, None, "t")], df.schema))
    out = R.make_valid(df, "geom", "id", 1.0)
    assert out.columns == df.columns and out.schema["geom"].dataType == df.schema["geom"].dataType
    got = {r.id: r.geom for r in out.collect()}
    assert plain(got[1].parts) == [[[(float(x), float(y)) for x, y in square]]]
    assert got[2].kind == "MultiPolygon" and got[3] is None and got[4] is None
    valid = df.where("id = 1")
    assert R.make_valid(valid, "geom", "id", 1.0).collect() == valid.collect()


def test_repaired_edges_answer_points_as_before(spark):
    rng = random.Random(3)
    polygons = {i: [[(lambda r: r + r[:1])([(rng.uniform(0, 5), rng.uniform(0, 5)) for _ in range(9)])]] for i in range(6)}
    df = shapes(spark, polygons)
    edges = S.area_edges(df, "geom", "id")
    mended = R.repaired_edges(edges, "id", 1.0)
    points = spark.createDataFrame([(k, rng.uniform(0, 5), rng.uniform(0, 5)) for k in range(400)], "p bigint, x double, y double")
    found = [
        sorted(tuple(r) for r in S.point_area_pairs(points, F.col("x"), F.col("y"), S.AreaSet(df, e, "id"), 1.0).select("p", "id").collect())
        for e in (edges, mended)
    ]
    assert found[0] == found[1] and len(found[0]) > 100
    rings = mended.groupBy("id", "ring").agg(F.sum(F.expr("x1 * y2 - x2 * y1")).alias("a"), F.first("hole").alias("hole")).collect()
    assert all((r.a < 0) == r.hole for r in rings)


def test_ranked_cycles_of_any_length(spark):
    rng = random.Random(5)
    rows, want = [], {}
    for key in range(4):
        for length in (1, 2, 3, 7, 8, 33):
            nodes = rng.sample(range(10**6), length)
            rows += [(key, a, b) for a, b in zip(nodes, nodes[1:] + nodes[:1], strict=True)]
            at = nodes.index(min(nodes))
            want.update({(key, n): (min(nodes), k, length) for k, n in enumerate(nodes[at:] + nodes[:at])})
    got = K.ranked_cycles(spark.createDataFrame(rows, "key int, node bigint, next bigint"), ["key"]).collect()
    assert {(r.key, r.node): (r.cycle, r["rank"], r.length) for r in got} == want


def test_repair_of_empty_input(spark):
    df = shapes(spark, {1: [[[(0, 0), (1, 0), (1, 1), (0, 0)]]]}).where("id = 2")
    assert R.repaired_geometries(S.area_edges(df, "geom", "id"), "id").count() == 0
    assert R.make_valid(df, "geom", "id").count() == 0


def test_a_pentagram_keeps_its_points(spark):
    tips = [(math.cos(math.pi * (0.5 + 0.8 * k)), math.sin(math.pi * (0.5 + 0.8 * k))) for k in range(5)]
    got = check(spark, {1: [[tips + tips[:1]]]}, 0.25)
    assert len(got[1].parts) == 5 and all(len(ring) == 4 for part in got[1].parts for ring in part)
    text = spark.createDataFrame([(got[1],)], f"geom {GEOM}").select(G.as_text("geom")).first()[0]
    assert text.startswith("MULTIPOLYGON (((")
