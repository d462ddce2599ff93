"""Distances and intersections piece by piece against the whole-geometry functions and brute force."""

import math
import random

import pytest
from pyspark.sql import functions as F

from mapweave.functions import geometry as G
from mapweave.operators import pieces as P
from mapweave.operators import spatial as S

GEOM = "struct<kind:string,parts:array<array<array<struct<x:double,y:double>>>>>"


def frame(spark, rows, key, geom):
    return spark.createDataFrame(rows, f"{key} int, {geom} {GEOM}")


def star(rng, x, y, r, n):
    """A closed ring around (x, y) whose radius wavers."""
    pts = [(x + r * f * math.cos(t), y + r * f * math.sin(t)) for t, f in ((2 * math.pi * i / n, rng.uniform(0.5, 1)) for i in range(n))]
    return [*pts, pts[0]]


def drawn(rng):
    x, y, r, n = rng.uniform(0, 100), rng.uniform(0, 100), rng.choice([2, 10, 30]), rng.choice([5, 40, 90])
    kind = rng.randrange(5)
    if kind == 0:
        return ("Point", [[[(x, y)]]])
    if kind == 1:
        return ("LineString", [[star(rng, x, y, r, n)[:-1]]])
    if kind == 2:
        return ("MultiPolygon", [[star(rng, x, y, r, n)], [star(rng, x + 2.5 * r, y, r, n)]])
    if kind == 3:
        return ("Polygon", [[star(rng, x, y, r, n), [(x + (a - x) * 0.3, y + (b - y) * 0.3) for a, b in star(rng, x, y, r, n)]]])
    return ("Polygon", [[star(rng, x, y, r, n)]])


@pytest.fixture(scope="module")
def sides(spark):
    rng = random.Random(3)
    left = frame(spark, [(i, drawn(rng)) for i in range(25)], "lk", "g1")
    right = frame(spark, [(i, drawn(rng)) for i in range(25)], "rk", "g2")
    return left.cache(), right.cache()


@pytest.fixture(scope="module")
def whole(sides):
    left, right = sides
    both = left.crossJoin(right).select("lk", "rk", G.closest_on_first("g1", "g2").alias("p1"))
    return {(r.lk, r.rk): r.p1 for r in both.collect()}


def test_pair_distances_equal_whole_geometries(spark, sides, whole):
    left, right = sides
    pairs = left.select("lk").crossJoin(right.select("rk"))
    got = {(r.lk, r.rk): r for r in P.pair_distances(pairs, left, right).collect()}
    assert got.keys() == whole.keys()
    for k, p in whole.items():
        assert math.isclose(got[k].p1.d, p.d, abs_tol=1e-9), (k, got[k], p)
        if p.d > 0:
            one, two = got[k].p1, got[k].p2
            assert math.isclose(math.hypot(one.x - two.x, one.y - two.y), p.d, abs_tol=1e-9)
    bounded = {(r.lk, r.rk) for r in P.pair_distances(pairs, left, right, radius=20.0).collect()}
    assert bounded == {k for k, p in whole.items() if p.d <= 20}
    best = P.pair_distances(pairs, left, right, nearest_only=True).groupBy("lk").agg(F.min("p1.d").alias("d")).collect()
    assert all(math.isclose(r.d, min(p.d for k, p in whole.items() if k[0] == r.lk), abs_tol=1e-9) for r in best) and len(best) == 25


def test_intersecting_pairs_equal_distance_zero(spark, sides, whole):
    left, right = sides
    got = sorted((r.lk, r.rk) for r in P.intersecting_pairs(left, right).collect())
    assert got == sorted(k for k, p in whole.items() if p.d == 0) and len(got) > 20


def test_two_borders_of_50000_edges(spark):
    """Facing wavy borders: the boxes that are opened stay far below the product, and the distance is the planted one."""
    n = 50_000

    def side(base, sign, spike):
        wave = [(float(i), base + sign * (3 + math.sin(i / 40))) for i in range(n)]
        wave[spike] = (float(spike), base)
        return ("Polygon", [[[*wave, (float(n), base + sign * 900), (0.0, base + sign * 900), wave[0]]]])

    left, right = frame(spark, [(1, side(0.0, -1, 31_000))], "lk", "g1"), frame(spark, [(2, side(0.5, 1, 31_000))], "rk", "g2")
    counted = []
    stage = P.materialize

    def counting(df, name):
        out = stage(df, name)
        if name == "open-boxes":
            counted.append(out.count())
        return out

    P.materialize = counting
    try:
        row = P.pair_distances(spark.createDataFrame([(1, 2)], "lk int, rk int"), left, right).first()
    finally:
        P.materialize = stage
    assert (row.p1.d, row.p1.x, row.p1.y) == (0.5, 31_000.0, 0.0) and row.p2.y == 0.5
    assert sum(counted) < 20 * n / P.PIECE * P.FAN


def test_join_intersecting_awkward_rows(spark):
    square = lambda x, h: ("Polygon", [[[(x - h, -h), (x + h, -h), (x + h, h), (x - h, h), (x - h, -h)]]])
    ring = ("Polygon", [[[(-9.0, -9.0), (9.0, -9.0), (9.0, 9.0), (-9.0, 9.0), (-9.0, -9.0)], [(-5.0, -5.0), (5.0, -5.0), (5.0, 5.0), (-5.0, 5.0), (-5.0, -5.0)]]])
    one = frame(spark, [(1, square(0.0, 1.0)), (1, square(0.0, 1.0)), (2, None), (3, ("Point", [[[(9.0, 0.0)]]])), (4, square(7.0, 0.5)), (5, square(0.0, 99.0)), (6, ("LineString", []))], "a", "p")
    two = frame(spark, [(10, ring), (11, None), (12, ("LineString", [[[(-1.0, 0.0), (1.0, 0.0)]]]))], "b", "q")
    out = P.join_intersecting(one, two, "p", "q")
    assert sorted((r.a, r.b) for r in out.collect()) == [(1, 12), (1, 12), (3, 10), (4, 10), (5, 10), (5, 12)]
    assert out.columns == ["a", "p", "b", "q"]
    assert P.join_intersecting(one.limit(0), two, "p", "q").count() == 0
    with pytest.raises(RuntimeError):
        P.join_intersecting(one, one, "p", "p")
    with pytest.raises(ValueError):
        P.join_intersecting(one, two, "a", "q")


def test_nearest_join_of_large_shapes_equals_small_path(spark, monkeypatch):
    rng = random.Random(8)
    shapes = [drawn(rng) for _ in range(40)]
    left, right = frame(spark, list(enumerate(shapes[:20])), "a", "p"), frame(spark, list(enumerate(shapes[20:])), "b", "q")
    plane = "epsg:25832"
    results = []
    for limit in (10**9, 0):
        monkeypatch.setattr(S, "PAIR_EDGES", limit)
        out = S.join_nearest_geometry(left, right, "p", "q", plane, plane, plane, max_meter=15.0, tie_breaker=["b"], join_type="fullouter")
        results.append(sorted((str(r.a), str(r.b), r.distance and round(r.distance, 9)) for r in out.collect()))
    assert results[0] == results[1]


def _round_areas(spark, n, step, key, shift, edges=72):
    """``n`` x ``n`` discs of ``edges`` edges, ``step`` apart; every fifth is a C that does not hold the middle of its box."""
    at = [(math.cos(2 * math.pi * i / edges), math.sin(2 * math.pi * i / edges)) for i in range(edges)]
    thin = [(x, y) for x, y in at if x < 0.5] + [(0.9 * x, 0.9 * y) for x, y in reversed(at) if x < 0.5]
    rows = []
    for i in range(n * n):
        cx, cy = shift + step * (i // n), shift + step * (i % n)
        ring = [(cx + 10 * x, cy + 10 * y) for x, y in (thin if i % 5 == 0 else at)]
        rows.append((i, [[[*ring, ring[0]]]]))
    df = spark.createDataFrame(rows, f"{key} int, parts array<array<array<struct<x:double,y:double>>>>")
    return df.select(key, F.struct(F.lit("Polygon").alias("kind"), "parts").alias(f"g_{key}"))


def test_overlapping_large_areas_do_not_measure_every_pair(spark, monkeypatch):
    """Of all the areas that cover a left one, only those are measured that may come first."""
    left, right = _round_areas(spark, 8, 1.0, "a", 0.0), _round_areas(spark, 8, 1.0, "b", 0.3)
    measured, keep = [], S.materialize
    monkeypatch.setattr(S, "materialize", lambda df, name="table": measured.append((name, t := keep(df, name))) or t)
    out = S.join_nearest_geometry(left, right, "g_a", "g_b", *["epsg:25832"] * 3, max_meter=50.0, tie_breaker=["b"], key_columns=["a"])
    got = {r.a: (r.b, r.distance) for r in out.collect()}
    assert [df.count() for name, df in measured if name == "nearest-sized"][0] < 64 * 64 / 4
    pairs = left.crossJoin(right).select("a", "b", G.distance("g_a", "g_b").alias("d")).collect()
    best = {a: min((r.d, r.b) for r in pairs if r.a == a) for a in got}
    assert len(got) == 64 and got == {a: (b, d) for a, (d, b) in best.items()}
