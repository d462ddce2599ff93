import os

import pytest
from pyspark.sql import functions as F

from mapweave.functions import geometry as G
from mapweave.operators import spatial as S
from mapweave.plans import catalog
from mapweave.plans import fixtures as FX
from mapweave.session import measured_bytes

from conftest import SF_SMALL


def _square_with_hole(spark):
    def ring(pts):
        return F.array(*[G.vertex(F.lit(float(x)), F.lit(float(y))) for x, y in pts])

    shell = ring([(0, 0), (4, 0), (4, 4), (0, 4), (0, 0)])
    hole = ring([(1, 1), (1, 3), (3, 3), (3, 1), (1, 1)])
    return spark.range(1).select(F.lit("A").alias("region"), G.polygon(shell, F.array(hole)).alias("poly"))


@pytest.mark.parametrize("cell", [0.3, 1.0, 2.5, 10.0])
def test_point_in_area_cases(spark, cell):
    pts = spark.createDataFrame(
        [(1, 0.5, 0.5), (2, 2.0, 2.0), (3, 5.0, 1.0), (4, 4.0, 2.0), (5, 0.0, 0.0), (6, 3.5, 3.9), (7, 1.0, 2.0), (8, 3.2, 2.0)],
        "pid int, x double, y double",
    ).select("pid", G.point("x", "y").alias("pt"))
    out = S.join_point_in_area(pts, "pt", _square_with_hole(spark), "poly", area_key="region", cell_size=cell)
    assert out.columns == ["region", "poly", "pid", "pt"]
    # inside: 1, 6, 8; in hole: 2; outside: 3; on boundary: 4, 5, 7 (hole edge)
    assert sorted(r.pid for r in out.collect()) == [1, 6, 8]


def test_point_in_area_argument_checks(spark):
    pts = spark.createDataFrame([(1, 0.5, 0.5)], "pid int, x double, y double").select("pid", G.point("x", "y").alias("pt"))
    areas = _square_with_hole(spark)
    with pytest.raises(AssertionError, match="'test_point' not in data frame df_in"):
        S.join_point_in_area(pts, "test_point", areas, "poly", area_key="region")
    with pytest.raises(AssertionError, match="'test_poly' not in data frame df_polygon"):
        S.join_point_in_area(pts, "pt", areas, "test_poly", area_key="region")
    with pytest.raises(AssertionError, match="'pid' in data frame df_in is of type"):
        S.join_point_in_area(pts, "pid", areas, "poly", area_key="region")
    with pytest.raises(AssertionError, match="'region' in data frame df_polygon is of type"):
        S.join_point_in_area(pts, "pt", areas, "region", area_key="region")


def test_point_in_area_cell_invariance(spark):
    pts = FX.fx_points(spark, SF_SMALL).select("point_id", G.point("lon", "lat").alias("pt"))
    areas = catalog._areas_geom(FX.fx_big_areas(spark, SF_SMALL)).select("area_id", "geom")
    results = []
    for cell in (0.07, 0.25, 1.0, 4.0):
        out = S.join_point_in_area(pts, "pt", areas, "geom", area_key="area_id", cell_size=cell)
        results.append(sorted((r.point_id, r.area_id) for r in out.collect()))
    assert all(r == results[0] for r in results)
    assert len(results[0]) > 0


def _nearest(spark, how="leftouter", cell=None, radius=50000, widen=None):
    pts = FX.fx_points(spark, SF_SMALL).select("point_id", G.point("lon", "lat").alias("pt"))
    sites = FX.fx_sites(spark, SF_SMALL).select("site_id", G.point("lon", "lat").alias("site"))
    out = S.join_nearest_geometry(
        pts, sites, "pt", "site", max_meter=radius, join_type=how, cell_size=cell, tie_breaker=["site_id"], widen=widen
    )
    return sorted((r.point_id, r.site_id, None if r.distance is None else round(r.distance, 6)) for r in out.collect())


def test_nearest_cell_invariance_and_outer(spark):
    base = _nearest(spark)
    for cell in (9000.0, 23000.0, 120000.0):
        assert _nearest(spark, cell=cell) == base
    assert any(r[1] is None for r in base)  # some points have no site within the radius
    inner = _nearest(spark, how="inner")
    assert inner == [r for r in base if r[1] is not None]


def test_nearest_argument_checks(spark):
    a = spark.createDataFrame([(1, 1.0, 1.0)], "id int, x double, y double").select("id", G.point("x", "y").alias("g"))
    with pytest.raises(RuntimeError, match="in common"):
        S.join_nearest_geometry(a, a, "g", "g")
    b = a.select(F.col("id").alias("id2"), F.col("g").alias("g2"))
    with pytest.raises(ValueError):
        S.join_nearest_geometry(a, b, "g", "g2", join_type="left_semi")


def test_self_intersections(spark):
    def ring(pts):
        return F.array(*[G.vertex(F.lit(float(x)), F.lit(float(y))) for x, y in pts])

    shapes = spark.range(1).select(
        F.lit(1).alias("k"), G.polygon(ring([(0, 0), (2, 2), (2, 0), (0, 2), (0, 0)])).alias("g")
    ).unionByName(spark.range(1).select(F.lit(2).alias("k"), G.polygon(ring([(0, 0), (2, 0), (2, 2), (0, 2), (0, 0)])).alias("g")))
    for cell in (0.3, 1.0, 5.0):
        rep = S.invalid_areas(S.area_edges(shapes, "g", "k"), "k", cell).collect()
        assert [(r.k, r.n_crossings, r.invalidity_explain) for r in rep] == [(1, 1, "Self-intersection[1.0 1.0]")]


def test_assembled_geometry_matches_edge_table(spark):
    from mapweave.operators.areas import assemble_areas

    areas = assemble_areas(
        FX.fx_map(spark, SF_SMALL), catalog.FIXTURE_AREA_FILTER, {"name": "element_at(tags, 'name')"},
        add_debug_columns=True, cell_size=0.25, result_polygon_name="multipolygon",
    )
    rows = areas.areas.collect()
    for r in rows:
        shells = [p[0] for p in r.multipolygon.parts]
        holes = [h for p in r.multipolygon.parts for h in p[1:]]
        assert sum(len(s) for s in shells) == r.outer_point_count
        assert sum(len(h) for h in holes) == r.inner_point_count
        assert r.invalidity_explain is None
    pts = FX.fx_points(spark, SF_SMALL).select("point_id", G.point("lon", "lat").alias("pt"))
    via_edges = S.join_point_in_area(pts, "pt", areas, cell_size=0.25).select("point_id", "name")
    geo = areas.areas.select("id", "name", "multipolygon")
    via_geom = S.join_point_in_area(pts, "pt", geo, "multipolygon", area_key="id", cell_size=0.5).select("point_id", "name")
    assert sorted(via_edges.collect()) == sorted(via_geom.collect())


def test_broadcast_limit_fallback_same_result(spark):
    pts = FX.fx_points(spark, SF_SMALL).select("point_id", G.point("lon", "lat").alias("pt"))
    areas = catalog._areas_geom(FX.fx_areas(spark, SF_SMALL)).select("area_id", "geom")

    def run():
        out = S.join_point_in_area(pts, "pt", areas, "geom", area_key="area_id", cell_size=0.25)
        return out, sorted((r.point_id, r.area_id) for r in out.collect())

    _, small = run()
    spark.conf.set("mapweave.broadcast.maxBytes", "0")
    try:
        df, forced = run()
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("mapweave.broadcast.maxBytes")
    assert forced == small and small
    assert "shuffle_hash" in df._jdf.queryExecution().analyzed().toString().lower() or "ShuffledHashJoin" in plan or "SortMergeJoin" in plan


@pytest.mark.parametrize("max_edges", [0, 1, 3])
def test_dense_cells_refined_same_result(spark, max_edges):
    """Records over the edge limit move to a finer grid; the answer must not change."""
    pts = FX.fx_points(spark, SF_SMALL).select("point_id", G.point("lon", "lat").alias("pt"))
    areas = catalog._areas_geom(FX.fx_areas(spark, SF_SMALL)).select("area_id", "geom")
    base = S.join_point_in_area(pts, "pt", areas, "geom", area_key="area_id", cell_size=0.5)
    refined = S.join_point_in_area(pts, "pt", areas, "geom", area_key="area_id", cell_size=0.5, max_edges=max_edges)
    expect = sorted((r.point_id, r.area_id) for r in base.collect())
    assert expect and sorted((r.point_id, r.area_id) for r in refined.collect()) == expect
    index = S.cell_index(S.area_edges(areas, "geom", "area_id"), "area_id", 0.5, max_edges=max_edges)
    assert index.depth > 1
    coarse_max = index.records.where("__lvl = 0").selectExpr("coalesce(max(size(__e)), 0) AS m").first().m
    assert coarse_max <= max_edges
    assert index.records.where("__lvl = 1").count() > 0


def test_refined_square_with_hole(spark):
    pts = spark.createDataFrame(
        [(1, 0.5, 0.5), (2, 2.0, 2.0), (3, 5.0, 1.0), (4, 4.0, 2.0), (5, 0.0, 0.0), (6, 3.5, 3.9), (7, 1.0, 2.0), (8, 3.2, 2.0)],
        "pid int, x double, y double",
    ).select("pid", G.point("x", "y").alias("pt"))
    out = S.join_point_in_area(pts, "pt", _square_with_hole(spark), "poly", area_key="region", cell_size=4.0, max_edges=1)
    assert sorted(r.pid for r in out.collect()) == [1, 6, 8]


def test_self_intersections_refined_pentagram(spark):
    import math

    pts = [(math.cos(math.pi / 2 + i * 4 * math.pi / 5), math.sin(math.pi / 2 + i * 4 * math.pi / 5)) for i in range(5)]
    pts.append(pts[0])
    ring = F.array(*[G.vertex(F.lit(float(x)), F.lit(float(y))) for x, y in pts])
    shapes = spark.range(1).select(F.lit(7).alias("k"), G.polygon(ring).alias("g"))
    edges = S.area_edges(shapes, "g", "k")
    results = []
    for cell, max_edges in ((0.1, 512), (0.5, 512), (2.0, 512), (2.0, 1), (0.5, 0)):
        found = S.self_intersections(edges, "k", cell, max_edges=max_edges).collect()
        results.append(sorted((round(r.x, 9), round(r.y, 9)) for r in found))
    assert len(results[0]) == 5
    assert all(r == results[0] for r in results)


def test_nearest_both_widening_plans_agree(spark):
    base = _nearest(spark, cell=9000.0)
    spark.conf.set("mapweave.broadcast.maxBytes", "0")
    try:
        forced = _nearest(spark, cell=9000.0)
    finally:
        spark.conf.unset("mapweave.broadcast.maxBytes")
    assert forced == base and base


def test_border_polygons_frame_and_keyless_join(spark):
    from mapweave.operators.areas import border_polygons

    frame = border_polygons(
        FX.fx_map(spark, SF_SMALL), catalog.FIXTURE_AREA_FILTER, {"region": "element_at(tags, 'name')"},
        add_debug_columns=True, cell_size=0.25,
    )
    assert frame.columns == ["region", "multipolygon", "id", "outer_polygon_count", "inner_polygon_count",
                             "outer_point_count", "inner_point_count", "invalidity_explain"]
    pts = FX.fx_points(spark, SF_SMALL).select("point_id", G.point("lon", "lat").alias("pt"))
    keyless = S.join_point_in_area(pts, "pt", frame.select("region", "multipolygon"), "multipolygon", cell_size=0.25)
    assert keyless.columns == ["region", "multipolygon", "point_id", "pt"]
    keyed = S.join_point_in_area(pts, "pt", frame, "multipolygon", area_key="id", cell_size=0.25)
    assert sorted((r.point_id, r.region) for r in keyless.collect()) == sorted((r.point_id, r.region) for r in keyed.collect())


@pytest.mark.parametrize("widen", ["left", "right"])
def test_nearest_widening_side_does_not_change_result(spark, widen):
    assert _nearest(spark, cell=9000.0, widen=widen) == _nearest(spark, cell=9000.0)


PLANE = "epsg:25832"


def _plane_points(spark, rows, key, geom):
    return spark.createDataFrame(rows, f"{key} int, x double, y double").select(key, G.point("x", "y").alias(geom))


@pytest.mark.parametrize("how", ["inner", "leftouter", "rightouter", "fullouter"])
def test_nearest_join_types(spark, how):
    left = _plane_points(spark, [(1, 0.0, 0.0), (2, 100.0, 0.0), (3, 9000.0, 0.0)], "a", "p")
    right = _plane_points(spark, [(10, 1.0, 0.0), (11, 60.0, 0.0), (12, 5000.0, 0.0), (13, -20.0, 0.0)], "b", "q")
    out = S.join_nearest_geometry(left, right, "p", "q", PLANE, PLANE, PLANE, max_meter=50, join_type=how, tie_breaker=["b"])
    got = sorted(((r.a, r.b) for r in out.collect()), key=str)
    want = [(1, 10), (2, 11)]
    if how in ("leftouter", "fullouter"):
        want.append((3, None))
    if how in ("rightouter", "fullouter"):
        want.append((None, 12))  # 13 has a left row in the radius, though not as its nearest
    assert got == sorted(want, key=str)
    assert out.columns == ["a", "p", "b", "q", "distance"]


def test_nearest_against_brute_force(spark):
    """Mixed sizes and densities: clusters, lone rows, boxes wider than the cells, equal places."""
    import math
    import random

    rng = random.Random(4)
    left = [(i, rng.choice([0, 500, 2500]) + rng.random() * rng.choice([1, 30, 900]), rng.random() * 900, rng.choice([0.0, 0.0, 40.0])) for i in range(150)]
    right = [(i, rng.choice([0, 500, 2500]) + rng.random() * rng.choice([1, 30, 900]), rng.random() * 900, rng.choice([0.0, 0.0, 5.0, 300.0])) for i in range(200)]
    right += [(1000 + i, 700.0, 700.0, 0.0) for i in range(20)]

    def frame(rows, key, geom):
        df = spark.createDataFrame(rows, f"{key} int, x double, y double, h double")
        x, y, h = F.col("x"), F.col("y"), F.col("h")
        ring = F.array(G.vertex(x - h, y - h), G.vertex(x + h, y - h), G.vertex(x + h, y + h), G.vertex(x - h, y + h), G.vertex(x - h, y - h))
        return df.select(key, F.when(h > 0, G.polygon(ring)).otherwise(G.point("x", "y")).alias(geom))

    radius = 200.0
    want = {}
    for i, x, y, h in left:
        near = []
        for j, u, v, k in right:
            gap = math.hypot(max(abs(x - u) - h - k, 0), max(abs(y - v) - h - k, 0))
            if gap <= radius:
                near.append((round(gap, 6), j))
        want[i] = min(near) if near else (None, None)
    for cell in (None, 37.0, 900.0):
        out = S.join_nearest_geometry(
            frame(left, "a", "p"), frame(right, "b", "q"), "p", "q", PLANE, PLANE, PLANE, max_meter=radius, cell_size=cell,
            tie_breaker=["b"], key_columns=["a"],
        )
        got = {r.a: (None if r.distance is None else round(r.distance, 6), r.b) for r in out.collect()}
        assert {k: v[0] for k, v in got.items()} == {k: v[0] for k, v in want.items()}
        assert sum(got[k] != want[k] for k in want) <= 2  # rounding may swap ties


def test_candidates_stay_flat_when_the_right_side_grows_in_place(spark):
    import random

    rng = random.Random(9)

    def boxes(n, key):
        rows = [(i, rng.random() * 1000, rng.random() * 1000) for i in range(n)]
        df = spark.createDataFrame(rows, f"{key} int, x double, y double")
        box = F.struct(F.col("x").alias("minx"), F.col("y").alias("miny"), F.col("x").alias("maxx"), F.col("y").alias("maxy"))
        return df.select(key, box.alias("b1" if key == "lk" else "b2"))

    left = boxes(100, "lk")
    few = S._candidates(left, boxes(500, "rk"), 1000.0, 1000.0).count()
    many = S._candidates(left, boxes(5000, "rk"), 1000.0, 1000.0).count()
    assert many < 2 * few and many < 100 * 150


def test_zero_size_areas_have_a_centroid(spark):
    ring = lambda *pts: F.array(*[G.vertex(F.lit(float(x)), F.lit(float(y))) for x, y in pts])
    flat = spark.range(1).select(F.lit(1).alias("k"), G.polygon(ring((0, 0), (4, 0), (4, 0), (0, 0))).alias("g"))
    dot = spark.range(1).select(F.lit(2).alias("k"), G.polygon(ring((7, 8), (7, 8), (7, 8), (7, 8))).alias("g"))
    got = {r.k: (r.cx, r.cy) for r in S.edge_centroids(S.area_edges(flat.unionByName(dot), "g", "k"), "k").collect()}
    assert got == {1: (2.0, 0.0), 2: (7.0, 8.0)}


def test_records_stay_small_where_many_edges_crowd(spark):
    """A tiny ring of 3000 edges far below the cell size needs several levels."""
    import math

    n, r = 3000, 1e-3
    pts = [(0.3 + r * math.cos(2 * math.pi * i / n), 0.3 + r * math.sin(2 * math.pi * i / n)) for i in range(n)]
    rows = [(1, 0, False, *a, *b) for a, b in zip(pts, pts[1:] + pts[:1])]
    edges = spark.createDataFrame(rows, "k int, ring int, hole boolean, x1 double, y1 double, x2 double, y2 double")
    index = S.cell_index(edges, "k", 1.0, max_edges=100)
    assert index.depth > 2
    assert index.records.selectExpr("max(size(__e)) AS m").first().m <= 100
    probes = [(i, 0.3 + r * f * math.cos(i), 0.3 + r * f * math.sin(i), f < 1) for i, f in enumerate([0.1, 0.5, 0.99, 1.01, 1.5, 40.0] * 20)]
    points = spark.createDataFrame(probes, "i int, x double, y double, inside boolean")
    areas = S.AreaSet(areas=spark.createDataFrame([(1, "a")], "k int, name string"), edges=edges, key="k")
    got = {r.i for r in S.point_area_pairs(points, F.col("x"), F.col("y"), areas, 1.0, max_edges=100).collect()}
    assert got == {i for i, _, _, inside in probes if inside}


def test_area_keys_must_be_unique(spark):
    areas = _square_with_hole(spark)
    pts = spark.createDataFrame([(1, 0.5, 0.5)], "pid int, x double, y double").select("pid", G.point("x", "y").alias("pt"))
    with pytest.raises(ValueError, match="'region' is not unique"):
        S.join_point_in_area(pts, "pt", areas.unionByName(areas), "poly", area_key="region")


def test_edges_in_cells_are_broadcast_by_their_rows_not_their_files(spark):
    """Staged edges of many alike areas take few bytes on disk, but the rows of every cell would go to the driver."""
    ring = [(0.0, 0.0), (8.0, 8.0), (8.0, 0.0), (0.0, 8.0), (0.0, 0.0)]
    geom = G.polygon(F.array(*[G.vertex(F.lit(x), F.lit(y)) for x, y in ring]))
    edges = S.area_edges(spark.range(400).select(F.col("id").alias("k"), geom.alias("g")), "g", "k")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "600k")
    try:
        levels = list(S.bounded_cells(edges, "k", 1.0))
        local = levels[0][0]
        assert sum(os.path.getsize(f.removeprefix("file:")) for f in local.inputFiles()) < 600 << 10 < measured_bytes(local)
        for found in (S.self_intersections(edges, "k", levels=levels), S.shared_stretches(edges, "k", levels=levels)):
            plan = found._jdf.queryExecution().sparkPlan().toString()
            assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
        assert [(r.n_crossings, r.x, r.y, r["count"]) for r in S.invalid_areas(edges, "k", 1.0).groupBy("n_crossings", "x", "y").count().collect()] == [(1, 4.0, 4.0, 400)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_validity_stages_the_edges_once(spark, monkeypatch):
    staged = []
    keep = S.materialize
    monkeypatch.setattr(S, "materialize", lambda df, name="table": staged.append(name) or keep(df, name))
    S.invalid_areas(S.area_edges(_square_with_hole(spark), "poly", "region"), "region", 1.0)
    assert staged.count("validity-edges") == 1
