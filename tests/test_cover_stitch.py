"""Covering of large areas, ring stitching by joins, and what the debug columns say of odd relations."""

import math
import random

import pytest
from pyspark.sql import functions as F

from mapweave.functions import geometry as G
from mapweave.operators import areas as A
from mapweave.operators import spatial as S
from mapweave.plans import fixtures as FX


def rings_edges(spark, rings):
    """Edge table of areas {id: [(hole, [(x, y), ...]), ...]} with open rings."""
    rows = []
    for i, parts in rings.items():
        for n, (hole, vs) in enumerate(parts):
            rows += [(i, n, hole, *map(float, (*a, *b))) for a, b in zip(vs, vs[1:] + vs[:1], strict=True)]
    return spark.createDataFrame(rows, "id bigint, ring int, hole boolean, x1 double, y1 double, x2 double, y2 double")


def circle(cx, cy, r, n, wobble=0.0, seed=0):
    rng = random.Random(seed)
    return [
        (cx + (r + rng.uniform(-wobble, wobble)) * math.cos(2 * math.pi * k / n), cy + (r + rng.uniform(-wobble, wobble)) * math.sin(2 * math.pi * k / n))
        for k in range(n)
    ]


def inside(rings, x, y):
    odd = False
    for _, vs in rings:
        for (x1, y1), (x2, y2) in zip(vs, vs[1:] + vs[:1], strict=True):
            if (y1 > y) != (y2 > y) and x < x1 + (y - y1) * (x2 - x1) / (y2 - y1):
                odd = not odd
    return odd


@pytest.mark.parametrize("cell", [None, 0.02, 0.3])
def test_areas_of_all_sizes_in_one_index(spark, cell):
    rng = random.Random(2)
    rings = {1: [(False, circle(8, 50, 6, 600, 0.2)), (True, circle(8, 51, 2, 200, 0.05))], 2: [(False, circle(9, 50, 3, 300, 0.1, 5))]}
    for k in range(20):
        rings[10 + k] = [(False, circle(rng.uniform(2, 14), rng.uniform(45, 55), rng.uniform(0.01, 0.4), 30, 0.003, k))]
    edges = rings_edges(spark, rings)
    points = [(k, rng.uniform(1, 15), rng.uniform(43, 57)) for k in range(300)]
    points += [(1000 + k, vs[0][0] + rng.uniform(-0.02, 0.02), vs[0][1] + rng.uniform(-0.02, 0.02)) for k, parts in rings.items() for _, vs in parts[:1]]
    frame = spark.createDataFrame(points, "p bigint, x double, y double")
    areas = S.AreaSet(edges.select("id").distinct(), edges, "id")
    got = {(r.p, r.id) for r in S.point_area_pairs(frame, F.col("x"), F.col("y"), areas, cell).collect()}
    assert got == {(p, i) for p, x, y in points for i, parts in rings.items() if inside(parts, x, y)} and len(got) > 200


def test_records_of_a_large_area_follow_its_border(spark):
    # a country of 16 degrees with cells of a hundredth: 2.5 million cells inside, 5,000 along the border
    edges = rings_edges(spark, {1: [(False, circle(8, 50, 8, 2000))]})
    index = S.cell_index(edges, "id", 0.01)
    assert index.depth > 2 and index.records.count() < 60_000
    half = S.cell_index(rings_edges(spark, {1: [(False, circle(8, 50, 4, 2000))]}), "id", 0.01)
    assert index.records.count() < 3 * half.records.count()
    got = spark.createDataFrame([(8.0, 50.0), (15.9, 50.0), (16.1, 50.0), (1.0, 53.0)], "x double, y double")
    found = S.point_area_pairs(got, F.col("x"), F.col("y"), S.AreaSet(edges.select("id").distinct(), edges, "id"), 0.01)
    assert sorted(r.x for r in found.collect()) == [1.0, 8.0, 15.9]


def test_cell_size_is_read_from_the_borders(spark):
    fine, coarse = (S.measured_cell_size(rings_edges(spark, {1: [(False, circle(0, 0, r, 400))]})) for r in (1, 64))
    assert coarse == 64 * fine
    assert S.measured_cell_size(rings_edges(spark, {1: [(False, circle(0, 0, 1, 5))]}).where("false")) == 1.0


def ends_of(spark, relations):
    rows = [(i, w, pos, role, head, tail) for i, ways in relations.items() for pos, (w, role, head, tail) in enumerate(ways)]
    return spark.createDataFrame(rows, "id bigint, way_id bigint, member_pos int, role string, head bigint, tail bigint")


def shape_of(rows):
    """Rings as cyclic sequences that begin with their smallest member, in their direction."""
    out = set()
    by_ring = {}
    for way, role, ring, seq, turned in rows:
        by_ring.setdefault((role, ring), []).append((seq, way, turned))
    for (role, ring), members in by_ring.items():
        seq = [(w, bool(t)) for _, w, t in sorted(members)]
        at = seq.index(min(seq))
        out.add((role, ring < 0, tuple(seq[at:] + seq[:at]) if ring >= 0 else tuple(sorted(seq))))
    return out


def test_stitching_by_joins_gives_the_rings_of_the_greedy_rules(spark):
    rng = random.Random(9)
    relations = {}
    for i in range(40):
        ways, way, node = [], 0, 0
        for _ in range(rng.randrange(1, 4)):
            role, n = rng.choice(["outer", "outer", "inner"]), rng.choice([1, 2, 3, 5, 9, 17])
            ring = [(way + k, role, node + k, node + (k + 1) % n) for k in range(n)]
            ways += [(w, r, t, h) if rng.random() < 0.4 else (w, r, h, t) for w, r, h, t in ring]
            way, node = way + n, node + n
        rng.shuffle(ways)
        if i % 8 == 0:
            ways.append((way, "outer", node, node + 1))  # an open chain: the greedy rules decide
        if i % 8 == 1:
            ways.append((way, "outer", ways[0][2], ways[0][2]))  # a node of three or more ends
        relations[i] = ways
    ends = A.materialize(ends_of(spark, relations), "test-ends")
    got = {}
    for r in A.stitch_rings(ends).collect():
        got.setdefault(r.id, []).append(r)
    for i, ways in relations.items():
        rows, ok = A._stitch_ways([(w, r, h, t) for w, r, h, t in ways])
        assert {r.ok for r in got[i]} == {ok} and {r.way_count for r in got[i]} == {len(ways)}
        mine = [(r.way_id, r.role, r.ring, r.seq, r.reversed) for r in got[i]]
        assert len(mine) == len(rows)
        assert {(role, open_, frozenset(w for w, _ in seq)) for role, open_, seq in shape_of(mine)} == {
            (role, open_, frozenset(w for w, _ in seq)) for role, open_, seq in shape_of(rows)
        }
        if i % 8 > 1:  # closed rings: the same cyclic order too, in either direction
            turned = lambda seq: tuple((w, not t) for w, t in reversed(seq))
            both = {(role, s) for role, _, seq in shape_of(rows) for s in (seq, (turned(seq)[-1:] + turned(seq)[:-1]))}
            assert all((role, seq) in both for role, _, seq in shape_of(mine))


def test_no_python_where_rings_are_unambiguous(spark):
    ends = A.materialize(ends_of(spark, {1: [(1, "outer", 1, 2), (2, "outer", 1, 2)], 2: [(3, "outer", 5, 5)]}), "test-ends")
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert "InPandas" not in plan(A.stitch_rings(ends))
    tangled = A.materialize(ends_of(spark, {1: [(1, "outer", 1, 2), (2, "outer", 2, 3)]}), "test-ends")
    assert "InPandas" in plan(A.stitch_rings(tangled))


def odd_map(spark):
    """A square (1), one with a way that goes nowhere (2), one with an inner ring of two nodes (3), and a bow tie (4)."""
    corners = [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0)]
    nodes = [(100 * r + k, x + 3 * r, y) for r in range(1, 5) for k, (x, y) in enumerate([*corners, (0.2, 0.2), (0.4, 0.4)])]
    order = {1: [0, 1, 2, 3, 0], 2: [0, 1, 2, 3, 0], 3: [0, 1, 2, 3, 0], 4: [0, 2, 1, 3, 0]}
    ways = [(10 * r, [100 * r + k for k in order[r]]) for r in order] + [(21, [204, 205]), (31, [304, 305, 304])]
    members = {1: [(10, "outer")], 2: [(20, "outer"), (21, "outer")], 3: [(30, "outer"), (31, "inner")], 4: [(40, "outer")]}
    rel = [(r, [{"id": w, "relationType": 1, "role": role} for w, role in ms], {"type": "boundary"}) for r, ms in members.items()]
    return FX.MapFrames(
        nodes=FX._pad(spark.createDataFrame(nodes, "id bigint, longitude double, latitude double"), 0),
        ways=FX._pad(spark.createDataFrame(ways, "id bigint, nodes array<bigint>"), 1),
        relations=FX._pad(spark.createDataFrame(rel, "id bigint, relations array<struct<id:bigint,relationType:tinyint,role:string>>, tags map<string,string>"), 2),
    )


def test_debug_columns_of_odd_relations(spark):
    found = A.assemble_areas(odd_map(spark), "element_at(tags, 'type') = 'boundary'", {}, add_debug_columns=True, cell_size=0.25)
    got = {r.id: r for r in found.areas.collect()}
    assert {i: r.has_open_chain for i, r in got.items()} == {1: False, 2: True, 3: False, 4: False}
    assert got[1].invalidity_explain is None and got[2].invalidity_explain is None
    assert got[3].invalidity_explain.startswith("Too few points in geometry component[9.2 0.2")
    assert got[4].invalidity_explain == "Self-intersection[12.5 0.5]"


def test_border_polygons_are_repaired(spark):
    select = "element_at(tags, 'type') = 'boundary' AND id IN (1, 4)"
    mended, raw = (
        {len(r.multipolygon.parts): r for r in A.border_polygons(odd_map(spark), select, {}, repair=flag, cell_size=0.25).collect()} for flag in (True, False)
    )
    assert set(mended) == {1, 2} and set(raw) == {1}
    assert sorted(len(part[0]) for part in mended[2].multipolygon.parts) == [4, 4]


def test_vertices_in_which_rings_touch_or_cross(spark):
    square = [(0, 0), (4, 0), (4, 4), (0, 4)]
    edges = rings_edges(
        spark,
        {
            1: [(False, square), (True, [(0, 0), (2, 1), (1, 2)])],  # touches in one vertex: valid
            2: [(False, square), (True, [(0, 0), (2, 1), (-1, 2)])],  # leaves the shell through its vertex and an edge
            3: [(False, [(0, 0), (2, 2), (4, 0), (4, 4), (2, 2), (0, 4)])],
            4: [(False, square), (False, [(4, 4), (6, 4), (6, 6), (4, 6)])],  # neighbours at a corner
            5: [(False, [(0, 0), (4, 0), (4, 4), (2, 2)]), (False, [(2, 2), (4, 5), (0, 5), (3, 0)])],
            6: [(False, [(0, 0), (2, 0)])],
        },
    )
    touches = {(r.id, r.x, r.y, r.crossing) for r in S.vertex_touches(edges, "id").collect()}
    assert (3, 2.0, 2.0, False) in touches and not {t for t in touches if t[0] in (1, 4, 6)}
    text = {r.id: r.invalidity_explain for r in S.invalid_areas(edges, "id", 1.0).collect()}
    assert 1 not in text and 4 not in text and text[3] == "Ring Self-intersection[2.0 2.0]"
    assert text[2].startswith("Self-intersection[") and text[6] == "Too few points in geometry component[0.0 0.0]"


def test_text_of_geometries(spark):
    rows = spark.range(1).select(
        G.as_text(G.point(F.lit(1.494), F.lit(42.47)), 2).alias("a"),
        G.as_text(G.polygon(F.array(*[G.vertex(F.lit(x), F.lit(y)) for x, y in ((0, 0), (1, 0), (0, 1), (0, 0))]))).alias("b"),
        G.as_text(F.expr("named_struct('kind', 'LineString', 'parts', CAST(array() AS array<array<array<struct<x:double,y:double>>>>))")).alias("c"),
        G.as_text(G.point(F.lit(None).cast("double"), F.lit(1.0))).alias("d"),
    ).first()
    assert tuple(rows) == ("POINT (1.49 42.47)", "POLYGON ((0.0 0.0, 1.0 0.0, 0.0 1.0, 0.0 0.0))", "LINESTRING EMPTY", None)
