"""Repair of areas whose rings cross, overlap or touch themselves.

The repaired area is what even-odd parity says of the linework, the same that the point joins
answer for the unrepaired edges. All steps are joins, aggregates and windows over edge rows:

1. *Noding.* Edges of one area that share a cell are cut at their crossings and wherever a
   vertex lies on them. Crossing points are rounded to ``snap``, so several edges that cross in one place
   get one vertex.
2. *Parity.* Equal pieces cancel in pairs. What is left separates inside from outside
   everywhere, and an even number of pieces meets in each vertex.
3. *Faces.* Each piece gives two half-edges. At its end a half-edge goes on with the next one in clockwise
   order around the vertex, which keeps one face to the left all along. The cycles are ranked by pointer
   jumping (:mod:`mapweave.operators.rings`); a cycle lies around an inner face if the parity
   beside its widest half-edge says so.
4. *Rings.* Where an inner face touches itself in a vertex, its cycle is cut there: half-edges that
   come in go on with the next of their own cycle across the outside. No ring visits a vertex twice.
5. *Polygons.* Rings that run counter-clockwise are shells. A hole belongs to the shell of
   its own face, or else to the smallest shell around it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mapweave.functions import geometry as G
from mapweave.operators.rings import ranked_cycles
from mapweave.operators.spatial import (
    DEFAULT_MAX_EDGES, EDGE_COLS, _q, area_edges, bounded_cells, cell_index, inside_record_sql, invalid_areas, locate,
)
from mapweave.session import materialize

SNAP = 1e-10  # of a degree: a hundredth of a millimetre


def _end(edge: str, n: int) -> str:
    return f"named_struct('x', {edge}.x{n}, 'y', {edge}.y{n})"


def _on_sql(edge: str, x: str, y: str) -> str:
    """SQL text: (x, y) lies on the edge, but is none of its ends."""
    straight = f"{G._orient_sql((f'{edge}.x1', f'{edge}.y1'), (f'{edge}.x2', f'{edge}.y2'), (x, y))} = 0"
    within = " AND ".join(f"{v} BETWEEN least({edge}.{c}1, {edge}.{c}2) AND greatest({edge}.{c}1, {edge}.{c}2)" for v, c in ((x, "x"), (y, "y")))
    ends = " AND ".join(f"NOT ({x} = {edge}.x{n} AND {y} = {edge}.y{n})" for n in (1, 2))
    return f"({straight} AND {within} AND {ends})"


def noded_edges(edges: DataFrame, key: str, cell_size: float = 0.01, snap: float = SNAP, max_edges: int = DEFAULT_MAX_EDGES) -> DataFrame:
    """``(key, a, b, n)``: pieces of the edges between all points where edges of their area meet.

    ``a < b`` are vertex structs ``x, y``; ``n`` counts the edges that run along the piece.
    Pieces meet only in their ends.
    """
    a, b = F.struct(F.col("x1").alias("x"), F.col("y1").alias("y")), F.struct(F.col("x2").alias("x"), F.col("y2").alias("y"))
    once = (
        edges.select(_q(key).alias("__key"), F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))
        .where("a < b")
        .groupBy("__key", "a", "b")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    once = materialize(once.selectExpr("__key", "a.x AS x1", "a.y AS y1", "b.x AS x2", "b.y AS y2", "n"), "undirected-edges")
    proper, ix, iy = G._crossing_sql("least(s, t)", "greatest(s, t)")  # both edges get the same point
    ix, iy = (f"round({v} / {snap}D) * {snap}D" for v in (ix, iy))
    met = f"""filter(array(CASE WHEN {proper} THEN named_struct('x', {ix}, 'y', {iy}) END,
        CASE WHEN {_on_sql('s', 't.x1', 't.y1')} THEN {_end('t', 1)} END,
        CASE WHEN {_on_sql('s', 't.x2', 't.y2')} THEN {_end('t', 2)} END), _m -> _m IS NOT NULL)"""
    cuts = None
    for local, _ in bounded_cells(once, "__key", cell_size, max_edges):
        one = local.select("__key", "__c", "__k", F.col("__edge").alias("s"))
        pairs = one.join(local.select("__key", "__c", "__k", F.col("__edge").alias("t")), ["__key", "__c", "__k"]).where("s <> t")
        found = pairs.select("__key", "s", F.explode(F.expr(met)).alias("p"))
        cuts = found if cuts is None else cuts.unionByName(found)
    at = F.struct(
        ((F.col("p.x") - F.col("s.x1")) * (F.col("s.x2") - F.col("s.x1")) + (F.col("p.y") - F.col("s.y1")) * (F.col("s.y2") - F.col("s.y1"))).alias("t"),
        F.col("p.x").alias("x"), F.col("p.y").alias("y"),
    )
    cut = cuts.groupBy("__key", F.col("s.x1").alias("x1"), F.col("s.y1").alias("y1"), F.col("s.x2").alias("x2"), F.col("s.y2").alias("y2")).agg(
        F.sort_array(F.collect_set(at)).alias("at")
    )
    whole = once.join(cut, ["__key", *EDGE_COLS], "left")
    stops = (
        "concat(array(named_struct('x', x1, 'y', y1)), transform(coalesce(at, array()), _t -> named_struct('x', _t.x, 'y', _t.y)), "
        "array(named_struct('x', x2, 'y', y2)))"
    )
    pieces = whole.select("__key", "n", F.explode(F.expr(
        f"transform(array({stops}), _v -> zip_with(slice(_v, 1, size(_v) - 1), slice(_v, 2, size(_v) - 1), "
        "(_p, _q) -> named_struct('a', least(_p, _q), 'b', greatest(_p, _q))))[0]"
    )).alias("e"))
    return pieces.where("e.a < e.b").groupBy(F.col("__key").alias(key), F.col("e.a").alias("a"), F.col("e.b").alias("b")).agg(F.sum("n").alias("n"))


def _angle(origin: str, to: str) -> Column:
    return F.atan2(F.col(f"{to}.y") - F.col(f"{origin}.y"), F.col(f"{to}.x") - F.col(f"{origin}.x"))


def face_cycles(pieces: DataFrame, key: str) -> DataFrame:
    """``(key, u, v, cycle, rank, length)``: both half-edges of every piece ``(key, a, b)``, in cycles that keep one face to the left."""
    darts = pieces.select(key, F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        pieces.select(key, F.col("b").alias("u"), F.col("a").alias("v"))
    )
    around = Window.partitionBy(key, "u").orderBy("angle", "v")
    whole = around.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # the twin of u -> v is v -> u; in clockwise order around v the half-edge before it goes on
    turned = darts.withColumn("angle", _angle("u", "v")).withColumn("on", F.coalesce(F.lag("v").over(around), F.last("v").over(whole)))
    links = turned.select(
        key, F.struct(F.col("v").alias("u"), F.col("u").alias("v")).alias("node"), F.struct(F.col("u"), F.col("on").alias("v")).alias("next")
    )
    return ranked_cycles(materialize(links, "half-edges"), [key]).select(key, "node.u", "node.v", "cycle", "rank", "length")


def _signed_areas(cycles: DataFrame, by: list[str]) -> DataFrame:
    """Twice the signed area of each cycle, relative to a corner of its own."""
    corner = Window.partitionBy(*by)
    rel = cycles.withColumn("ox", F.min("u.x").over(corner)).withColumn("oy", F.min("u.y").over(corner))
    cross = F.expr("(u.x - ox) * (v.y - oy) - (v.x - ox) * (u.y - oy)")
    return rel.groupBy(*by).agg(F.sum(cross).alias("area"))


def _inner_cycles(cycles: DataFrame, pieces: DataFrame, key: str, cell_size: float, max_edges: int) -> DataFrame:
    """``(key, cycle)`` of the cycles with the inside to their left.

    The parity below the middle of the widest half-edge is read off the cell records, in which the
    half-edge itself does not count. A record's line lies just above its height, so an edge through the middle
    that does not rise there is below it.
    """
    widest = cycles.groupBy(key, "cycle").agg(F.max_by(F.struct("u", "v"), F.struct(F.expr("abs(v.x - u.x)"), "u", "v")).alias("d"))
    probes = widest.selectExpr(
        f"`{key}`", "cycle", "d.u AS u", "d.v AS v", "d.u.x + (d.v.x - d.u.x) / 2 AS px", "d.u.y + (d.v.y - d.u.y) / 2 AS py"
    )
    lines = pieces.selectExpr(f"`{key}` AS __own", "a.x AS x1", "a.y AS y1", "b.x AS x2", "b.y AS y2")
    index = cell_index(lines, "__own", cell_size, max_edges=max_edges, name="face-records")
    met = locate(probes, "px", "py", index, match=(key, "__own"))
    own = "(_o.x1 = least(u, v).x AND _o.y1 = least(u, v).y AND _o.x2 = greatest(u, v).x AND _o.y2 = greatest(u, v).y)"
    inside, _ = inside_record_sql("px", "py", "__Y", e=f"filter(__e, _o -> NOT {own})")
    below = f"({inside} <> (py = __Y AND (v.y - u.y) * (v.x - u.x) <= 0))"
    return met.where(F.expr(f"{below} <> (v.x > u.x)")).select(key, "cycle").distinct()


def _cut_at_vertices(cycles: DataFrame, key: str) -> DataFrame:
    """Rings ``(key, face, u, v, ring, rank)`` of the inner cycles; none visits a vertex twice."""
    faces = cycles.select(key, F.col("cycle").alias("face"), "u", "v", "rank")
    twice = materialize(faces.groupBy(key, "face", "u").count().where("count > 1").select(key, "face").distinct(), "touching-faces")
    plain = faces.withColumn("ring", F.col("face"))
    if twice.isEmpty():
        return plain
    touching = faces.join(twice, [key, "face"], "left_semi")
    arrive = touching.select(key, "face", F.col("v").alias("at"), F.col("u").alias("other"), F.lit(0).alias("leaves"), _angle("v", "u").alias("angle"))
    leave = touching.select(key, "face", F.col("u").alias("at"), F.col("v").alias("other"), F.lit(1).alias("leaves"), _angle("u", "v").alias("angle"))
    around = Window.partitionBy(key, "face", "at").orderBy("angle", "leaves", "other")
    out = F.when(F.col("leaves") == 1, F.col("other"))
    following = F.first(out, ignorenulls=True).over(around.rowsBetween(1, Window.unboundedFollowing))
    wrapped = F.first(out, ignorenulls=True).over(around.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    paired = arrive.unionByName(leave).withColumn("on", F.coalesce(following, wrapped)).where("leaves = 0")
    links = paired.select(
        key, "face", F.struct(F.col("other").alias("u"), F.col("at").alias("v")).alias("node"),
        F.struct(F.col("at").alias("u"), F.col("on").alias("v")).alias("next"),
    )
    rings = ranked_cycles(materialize(links, "touching-half-edges"), [key, "face"]).select(key, "face", "node.u", "node.v", F.col("cycle").alias("ring"), "rank")
    return plain.join(twice, [key, "face"], "left_anti").select(*rings.columns).unionByName(rings)


def repaired_rings(
    edges: DataFrame, key: str, cell_size: float = 0.01, snap: float = SNAP, max_edges: int = DEFAULT_MAX_EDGES
) -> tuple[DataFrame, DataFrame]:
    """Rings of the repaired areas, and which shell each hole belongs to.

    The first frame has ``key, ring, hole, shell, u, v, rank``, one row per edge in order, with ``shell``
    the ring that the row's polygon begins with; areas that have no inside have no rows. The
    second is ``key, ring, hole, shell, area``.
    """
    pieces = materialize(noded_edges(edges, key, cell_size, snap, max_edges).where("n % 2 = 1"), "noded-edges")
    cycles = materialize(face_cycles(pieces, key), "face-cycles")
    inner = cycles.join(_inner_cycles(cycles, pieces, key, cell_size, max_edges), [key, "cycle"], "left_semi")
    rings = materialize(_cut_at_vertices(inner, key), "face-rings")
    sizes = _signed_areas(rings, [key, "face", "ring"]).where("area <> 0").withColumn("hole", F.col("area") < 0)
    sizes = materialize(sizes.withColumn("area", F.abs("area") / 2), "ring-areas")
    shells = sizes.where("NOT hole")
    holes = sizes.where("hole")
    own = shells.groupBy(key, "face").agg(F.min_by("ring", "area").alias("shell"))
    named = holes.join(own, [key, "face"], "left")
    loose = materialize(named.where("shell IS NULL").drop("shell"), "loose-holes")
    if not loose.isEmpty():
        around = rings.join(shells.select(key, "ring", F.col("area").alias("around")), [key, "ring"])
        lines = around.select(F.struct(F.col(key).alias("id"), "ring", "around").alias("__shell"), F.expr("u.x AS x1"), F.expr("u.y AS y1"), F.expr("v.x AS x2"), F.expr("v.y AS y2"))
        index = cell_index(lines, "__shell", cell_size, max_edges=max_edges, name="shell-records")
        probe = rings.join(loose.select(key, "ring"), [key, "ring"], "left_semi").groupBy(key, "ring").agg(F.min("u").alias("p"))
        probes = probe.select(key, "ring", F.col("p.x").alias("px"), F.col("p.y").alias("py"))
        inside, on_edge = inside_record_sql("px", "py", "__Y")
        met = locate(probes, "px", "py", index, match=(key, "__shell.id")).where(F.expr(f"{inside} AND NOT {on_edge}"))
        found = met.groupBy(key, "ring").agg(F.min_by("__shell.ring", F.struct("__shell.around", "__shell.ring")).alias("shell"))
        named = named.where("shell IS NOT NULL").unionByName(loose.join(found, [key, "ring"]), allowMissingColumns=True)
    named = named.unionByName(shells.withColumn("shell", F.col("ring"))).select(key, "ring", "hole", "shell", "area")
    named = materialize(named, "repaired-rings")
    return rings.join(named.drop("area"), [key, "ring"]).select(key, "ring", "hole", "shell", "u", "v", "rank"), named


def repaired_edges(edges: DataFrame, key: str, cell_size: float = 0.01, snap: float = SNAP, max_edges: int = DEFAULT_MAX_EDGES) -> DataFrame:
    """Edge table ``key, ring, hole, x1, y1, x2, y2`` of the repaired areas; rings are numbered per area."""
    rows, rings = repaired_rings(edges, key, cell_size, snap, max_edges)
    number = (F.row_number().over(Window.partitionBy(key).orderBy("shell", "hole", "ring")) - 1).alias("number")
    numbered = rings.select(key, "ring", number)
    return rows.join(numbered, [key, "ring"]).select(
        key, F.col("number").alias("ring"), "hole", F.expr("u.x AS x1"), F.expr("u.y AS y1"), F.expr("v.x AS x2"), F.expr("v.y AS y2")
    )


def repaired_geometries(edges: DataFrame, key: str, cell_size: float = 0.01, snap: float = SNAP, max_edges: int = DEFAULT_MAX_EDGES) -> DataFrame:
    """``(key, geom)``: a Polygon, or a MultiPolygon where several shells are left. Areas without an inside have no row."""
    rows, _ = repaired_rings(edges, key, cell_size, snap, max_edges)
    closed = F.expr("transform(array(transform(_vs, _v -> _v.u)), _c -> concat(_c, slice(_c, 1, 1)))[0]")
    rings = rows.groupBy(key, "shell", "hole", "ring").agg(F.sort_array(F.collect_list(F.struct("rank", "u"))).alias("_vs"))
    rings = rings.select(key, "shell", F.struct("hole", "ring", closed.alias("vs")).alias("r"))
    polygons = rings.groupBy(key, "shell").agg(F.expr("transform(sort_array(collect_list(r)), _r -> _r.vs)").alias("rings"))
    parts = polygons.groupBy(key).agg(F.expr("transform(sort_array(collect_list(struct(shell, rings))), _p -> _p.rings)").alias("parts"))
    kind = F.when(F.size("parts") == 1, F.lit("Polygon")).otherwise(F.lit("MultiPolygon"))
    return parts.select(key, F.struct(kind.alias("kind"), "parts").alias("geom"))


def with_repaired(
    df: DataFrame, geometry_column: str, edges: DataFrame, key: str, cell_size: float = 0.01, snap: float = SNAP, max_edges: int = DEFAULT_MAX_EDGES
) -> DataFrame:
    """``df`` with the geometry of the areas that ``edges`` shows to be invalid replaced by their repaired form."""
    bad = materialize(invalid_areas(edges, key, cell_size, max_edges).select(_q(key)), "invalid-keys")
    if bad.isEmpty():
        return df
    mended = repaired_geometries(edges.join(bad, key, "left_semi"), key, cell_size, snap, max_edges)
    mended = bad.join(mended, key, "left").select(_q(key), F.col("geom").alias("__mended"), F.lit(True).alias("__bad"))
    new = F.when(F.col("__bad"), F.col("__mended")).otherwise(_q(geometry_column))
    return df.join(mended, key, "left").withColumn(geometry_column, new).select(*[_q(c) for c in df.columns])


def make_valid(
    df: DataFrame, geometry_column: str, key: str, cell_size: float = 0.01, snap: float = SNAP, max_edges: int = DEFAULT_MAX_EDGES
) -> DataFrame:
    """``df`` with invalid areas in ``geometry_column`` replaced by their repaired form; all else stays as it is.

    ``key`` names a unique column. An invalid area without any inside becomes NULL.
    """
    edges = materialize(area_edges(df, geometry_column, key), "repair-edges")
    return with_repaired(df, geometry_column, edges, key, cell_size, snap, max_edges)
