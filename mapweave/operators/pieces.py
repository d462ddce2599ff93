"""Geometries cut into pieces: distance and intersection without products of whole borders.

A piece is a run of up to ``PIECE`` consecutive edges with its box. Pieces that follow
each other lie near each other, so boxes over runs of ``FAN`` pieces, of ``FAN`` such runs and so on
are a search tree that needs no index of its own: a node is a number, its parent that number
divided by ``FAN``. Both operators work on rows of pieces and boxes and test edges
against edges only within a pair of pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mapweave.functions import geometry as G
from mapweave.operators import measure as M
from mapweave.operators import spatial as S
from mapweave.schema import check_for_duplicate_columns, is_geometry
from mapweave.session import materialize, sized_join

PIECE = 4
FAN = 8
TASK_PAIRS = 4096  # pairs of pieces measured in one task
OPEN_ROWS = 8 * TASK_PAIRS  # pairs of nodes opened in one task
MARGIN = 1e-6  # metres by which bounds are kept wider, for rounding
FEW_EDGES = 4096  # vertices of an area whose edges are tested one after the other for a point


def pieces(df: DataFrame, key: str, geom: str) -> DataFrame:
    """(key, n, piece, box): the runs of edges of each geometry, numbered along its rings.

    A piece is a line, or a point where a ring has one vertex. NULL and empty geometries have none.
    """
    runs = (
        f"flatten(transform(filter(flatten({geom}.parts), r -> size(r) > 0), "
        f"r -> transform(sequence(0, greatest(size(r) - 2, 0), {PIECE}), s -> slice(r, s + 1, {PIECE + 1}))))"
    )
    rows = df.select(key, F.posexplode(F.expr(runs)).alias("n", "run"))
    piece = "named_struct('kind', CASE WHEN size(run) = 1 THEN 'Point' ELSE 'LineString' END, 'parts', array(array(run))) AS piece"
    return rows.selectExpr(key, "n", piece).withColumn("box", G.bbox("piece"))


def corners(df: DataFrame, key: str, geom: str) -> DataFrame:
    """(key, px, py): the first vertex of every part."""
    heads = df.select(key, F.explode(F.expr(G._corners_sql(geom))).alias("v"))
    return heads.select(key, F.col("v.x").alias("px"), F.col("v.y").alias("py"))


def _tree(parts: DataFrame, key: str, depth: int) -> DataFrame:
    """(key, level, n, box, v): boxes of runs of ``FAN ** level`` pieces, each with one of its vertices."""
    level = F.explode(F.sequence(F.lit(0), F.lit(max(depth - 1, 0)))).alias("level")
    at = parts.select(key, "n", "box", G._first_vertex("piece").alias("v"), level).withColumn("n", F.floor(F.col("n") / F.pow(F.lit(float(FAN)), "level")).cast("int"))
    sides = [f"{f}(box.{f}{a}) AS {f}{a}" for f in ("min", "max") for a in "xy"]
    flat = at.groupBy(key, "level", "n").agg(*[F.expr(s) for s in sides], F.min("v").alias("v"))
    return flat.select(key, "level", "n", F.struct("minx", "miny", "maxx", "maxy").alias("box"), "v")


def _contained(pairs: DataFrame, left: DataFrame, right: DataFrame) -> DataFrame:
    """(lk, rk, x, y): a part's corner of one geometry of a pair that lies inside the other, the smallest of them."""
    found = None
    for own, g, other, area, box in (("rk", "g2", "lk", "g1", "b1"), ("lk", "g1", "rk", "g2", "b2")):
        inner, outer = (right, left) if own == "rk" else (left, right)
        areal = outer.where(G.geom_kind(area).isin("Polygon", "MultiPolygon"))
        probes = pairs.join(corners(inner, own, g), own).join(areal.select(other, G.bbox(area).alias(box)), other)
        within = f"px BETWEEN {box}.minx AND {box}.maxx AND py BETWEEN {box}.miny AND {box}.maxy"
        probes = materialize(probes.where(within).select("lk", "rk", "px", "py"), "corner-probes")
        if probes.isEmpty():
            continue
        asked = areal.join(probes.select(other).distinct(), other, "left_semi")
        # an area of few edges is tested as it is; one of many is described by the records of its cells
        simple = F.size(G.vertices(F.col(area))) <= FEW_EDGES
        few = probes.join(asked.where(simple).select(other, G.segments(area).alias("__e")), other)
        _, on_edge = S.inside_record_sql("px", "py", "0D")
        p = "named_struct('x', px, 'y', py)"
        met = few.where(F.expr(f"{G._inside_sql(p, '__e')} AND NOT {on_edge}")).select("lk", "rk", "px", "py")
        if not asked.where(~simple).isEmpty():
            many = asked.where(~simple).withColumn("__area", F.col(other))
            index = S.cell_index(S.area_edges(many, area, "__area"), "__area", None, name="corner-records")
            inside, on_edge = S.inside_record_sql("px", "py", "__Y")
            located = S.locate(probes, "px", "py", index, match=(other, "__area")).where(F.expr(f"{inside} AND NOT {on_edge}"))
            met = met.unionByName(located.select("lk", "rk", "px", "py"))
        # a corner of the second geometry comes before one of the first
        here = met.select("lk", "rk", F.struct(F.lit(own == "lk").alias("late"), F.col("px").alias("x"), F.col("py").alias("y")).alias("p"))
        found = here if found is None else found.unionByName(here)
    if found is None:
        return pairs.select("lk", "rk", F.lit(0.0).alias("x"), F.lit(0.0).alias("y")).limit(0)
    return found.groupBy("lk", "rk").agg(F.min("p").alias("p")).select("lk", "rk", F.col("p.x").alias("x"), F.col("p.y").alias("y"))


def pair_distances(
    pairs: DataFrame, left: DataFrame, right: DataFrame, radius: float = float("inf"), nearest_only: bool = False, second: bool = True
) -> DataFrame:
    """(lk, rk, p1, p2): exact planar distance ``p.d`` and the closest point ``p.x, p.y`` on either geometry.

    ``p2`` is left out unless ``second``. ``pairs`` holds distinct ``lk, rk``, ``left`` ``lk, g1``, ``right`` ``rk, g2``. Pairs farther apart than
    ``radius`` have no row; with ``nearest_only`` those may go too that are surely not
    the nearest of their ``lk`` (all equally near ones stay); a column ``reach`` of ``pairs`` tells how far that is at most. Crossing, touching and contained geometries have
    distance 0. Rows without a geometry have no result.

    Branch and bound: each round opens the nodes of both trees that are left, one equi-join each, learns per
    group the least distance that some pair of nodes has between one vertex of each, and drops the pairs of boxes that
    are farther apart. What is left after the last round follows the stretch on which the borders are about
    nearest, not the product of their lengths.
    """
    # read several times below: only the geometries that some pair asks for
    left, right = (
        materialize(df.join(sized_join(materialize(pairs.select(key).distinct(), "asked-keys")), key, "left_semi"), "asked-shapes")
        for df, key in ((left, "lk"), (right, "rk"))
    )
    contained = materialize(_contained(pairs, left, right), "contained-pairs")
    zero = F.struct(F.lit(0.0).alias("d"), "x", "y")
    ends = ["p1", "p2"] if second else ["p1"]
    inside = contained.select("lk", "rk", *[zero.alias(p) for p in ends])
    apart = pairs.join(contained, ["lk", "rk"], "left_anti")
    sides = []
    for df, key, geom in ((left, "lk", "g1"), (right, "rk", "g2")):
        sides.append(materialize(pieces(df, key, geom), "pieces"))
    last = max(p.agg(F.max("n")).first()[0] or 0 for p in sides)
    depth = 1
    while FAN**depth <= last:
        depth += 1
    trees = [materialize(_tree(p, key, depth), "piece-tree") for p, key in zip(sides, ("lk", "rk"), strict=True)]
    by = ["lk"] if nearest_only else ["lk", "rk"]
    limit = F.least(F.col("reach"), F.lit(float(radius))) if "reach" in pairs.columns else F.lit(float(radius))
    front = apart.select("lk", "rk", F.lit(0).alias("up1"), F.lit(0).alias("up2"), limit.alias("limit"), F.lit(None).cast("struct<minx:double,miny:double,maxx:double,maxy:double>").alias("q2"))
    if nearest_only:  # beside a pair of distance 0 only others of that distance count
        settled = contained.select("lk").distinct().withColumn("settled", F.lit(MARGIN))
        front = front.join(settled, "lk", "left").withColumn("limit", F.least("limit", "settled")).drop("settled")
    for level in reversed(range(depth)):
        first, second_nodes = (
            tree.where(F.col("level") == level).select(key, F.floor(F.col("n") / FAN).cast("int").alias(f"up{k}"), F.col("n").alias(f"n{k}"), F.col("box").alias(f"b{k}"), F.col("v").alias(f"v{k}"))
            for tree, key, k in zip(trees, ("lk", "rk"), "12", strict=True)
        )
        # one side's nodes are held against the other's parent first, so that few of their products are made
        opening = front.join(first, ["lk", "up1"]).where(F.col("q2").isNull() | (S._box_gap("b1", "q2") <= F.col("limit")))
        opening = opening.join(second_nodes, ["rk", "up2"])
        gap, reach = S._box_gap("b1", "b2").alias("gap"), F.expr("hypot(v1.x - v2.x, v1.y - v2.y)").alias("reach")
        opened = materialize(opening.select("lk", "rk", "n1", "n2", gap, reach, "limit", F.col("b2").alias("q2")).where(F.col("gap") <= F.col("limit")), "open-boxes")
        bound = opened.groupBy(*by).agg(F.min("reach").alias("bound"))
        # a little more than the bound, for rounding
        near = opened.join(bound, by).withColumn("limit", F.least(F.col("limit"), F.col("bound") * (1 + 1e-9) + MARGIN)).where("gap <= limit")
        front = near.select("lk", "rk", F.col("n1").alias("up1"), F.col("n2").alias("up2"), "limit", "q2")
        front = front.repartition(opened.count() // OPEN_ROWS + 1, "lk", "up1")
    a = sides[0].select("lk", F.col("n").alias("up1"), F.col("piece").alias("s1"))
    b = sides[1].select("rk", F.col("n").alias("up2"), F.col("piece").alias("s2"))
    # few bytes, much arithmetic: spread by the number of rows
    front = front.select("lk", "rk", "up1", "up2")
    front = front.repartition(front.count() // TASK_PAIRS + 1, "lk", "rk", "up1")
    met = front.join(a, ["lk", "up1"]).join(b, ["rk", "up2"]).select("lk", "rk", "s1", "s2")
    best = M.measured(met, "s1", "s2", second).select("lk", "rk", F.struct(*ends).alias("p"))
    best = best.groupBy("lk", "rk").agg(F.min("p").alias("p")).select("lk", "rk", "p.*")
    return best.where(F.col("p1.d") <= radius).unionByName(inside)


def intersecting_pairs(left: DataFrame, right: DataFrame, tolerance: float = 0.0) -> DataFrame:
    """Distinct (lk, rk) of geometries ``lk, g1`` and ``rk, g2`` that have a point in common (borders count).

    Pieces whose boxes overlap meet in the one cell that holds the corner where the overlap begins, by an
    equi-join over cells of several widths, and are tested edge by edge. Geometries without
    a common border point intersect if a part's corner lies in the other one. ``tolerance`` lets
    borders that are so near count as touching (a vertex on a slanting edge is rarely on it in floating point).
    """
    a = materialize(pieces(left, "lk", "g1").withColumnsRenamed({"piece": "s1", "box": "b1"}), "pieces")
    b = materialize(pieces(right, "rk", "g2").withColumnsRenamed({"piece": "s2", "box": "b2"}), "pieces")
    widest = max(p.agg(F.max(S._extent(box))).first()[0] or 0.0 for p, box in ((a, "b1"), (b, "b2")))
    # pieces go with their boxes: there are far more pairs than pieces
    asked = S._spread(a).select(F.struct("lk", "n").alias("lk"), "b1", F.lit(float(tolerance)).alias("reach"), "s1")
    met = S._box_pairs(asked, b.select(F.struct("rk", "n").alias("rk"), "b2", "s2"), widest or 1.0)
    tested = met.select(F.col("lk.lk").alias("lk"), F.col("rk.rk").alias("rk"), "s1", "s2")
    touching = M.measured(tested, "s1", "s2").where(F.col("p1.d") <= tolerance).select("lk", "rk")

    def holding(areas: DataFrame, key: str, geom: str, others: DataFrame, own: str, g: str) -> DataFrame:
        areal = areas.where(G.geom_kind(geom).isin("Polygon", "MultiPolygon")).select(key, geom)
        found = S.point_area_pairs(corners(others, own, g), F.col("px"), F.col("py"), S.AreaSet(areal, S.area_edges(areal, geom, key), key))
        return found.select("lk", "rk")

    return touching.unionByName(holding(right, "rk", "g2", left, "lk", "g1")).unionByName(holding(left, "lk", "g1", right, "rk", "g2")).distinct()


def join_intersecting(df_1: DataFrame, df_2: DataFrame, column_1: str, column_2: str, tolerance: float = 0.0) -> DataFrame:
    """Inner join of the rows whose geometries intersect; columns of ``df_1``, then of ``df_2``.

    Both columns are in one coordinate system. Points, lines, polygons and multipolygons meet each
    other; every pair of rows comes once. NULL geometries meet nothing; repeated rows each have
    their pairs; an empty side gives no rows. Clashing column names raise ``RuntimeError``, as in the other joins.
    """
    check_for_duplicate_columns(df_1, df_2)
    for df, column in ((df_1, column_1), (df_2, column_2)):
        if column not in df.columns or not is_geometry(df.schema[column].dataType):
            raise ValueError(f"'{column}' is no geometry column")
    rows_1, rows_2 = S._numbered(df_1, "__lk", None, "intersect-left"), S._numbered(df_2, "__rk", None, "intersect-right")
    left = rows_1.select(F.col("__lk").alias("lk"), S._q(column_1).alias("g1")).where("g1 IS NOT NULL")
    right = rows_2.select(F.col("__rk").alias("rk"), S._q(column_2).alias("g2")).where("g2 IS NOT NULL")
    found = intersecting_pairs(left, right, tolerance).select(F.col("lk").alias("__lk"), F.col("rk").alias("__rk"))
    joined = found.join(rows_1, "__lk").join(rows_2, "__rk")
    return joined.select(*[S._q(c) for c in df_1.columns + df_2.columns])
