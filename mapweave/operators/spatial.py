"""Spatial joins as equi-joins on grid cells.

Point in area
-------------
Areas are decomposed into an edge table. Space is cut into square cells of
``cell_size``. For every (area, cell) the join needs

* the area's edges that pass through the cell, and
* the "inside intervals" of the cell row's bottom line ``y = k * cell``: the
  x-ranges of that line that lie inside the area (pairs of sorted crossings).

A point (px, py) in cell (c, k) is inside an area when the parity of the path
P -> (px, k*cell) -> (+inf, k*cell) is odd: the horizontal part is one
interval lookup, the vertical part counts crossings with the local edges.
Points on an edge are not contained (boundary does not match). Large areas
begin with coarse cells, a few across the area; only those that the border passes
through are split, down to ``cell_size``, so whole inner parts are one record each and
the number of records follows the length of the border, not the area. Nothing depends on how many
points arrive, and each point meets only the records of its own cells.
Points join records with one equi-join on (c, k); AQE picks broadcast when the
record side is measured small and splits hot cells on the point side.

Nearest geometry
----------------
Both sides are reprojected to a metric CRS and searched by keys and boxes
alone. First each left row learns a reach: from its distance to the one right vertex that stands
for its cell on each of a few levels, so dense places give a short reach. Then it looks
for right boxes within the reach in cells about as wide as the reach. The few
pairs left get their geometries back, are measured exactly and reduced with
``min_by`` (partial aggregation, no window, no collection of a group). Candidates
per left row follow the distance to its neighbours, not the number of rows in
a radius.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mapweave.functions import geometry as G
from mapweave.operators import measure as M
from mapweave.schema import check_for_duplicate_columns, is_geometry
from mapweave.session import broadcast_limit, materialize, measured_bytes, sized_broadcast, sized_join

EDGE_COLS = ["x1", "y1", "x2", "y2"]


@dataclass(frozen=True)
class AreaSet:
    """Areas as payload rows plus an edge table, joined by ``key``.

    ``areas`` holds one row per area (``key`` plus attribute columns);
    ``edges`` holds ``key, ring, hole, x1, y1, x2, y2`` (each ring once).
    """

    areas: DataFrame
    edges: DataFrame
    key: str
    hidden_key: bool = False

    @property
    def visible_columns(self) -> list[str]:
        return [c for c in self.areas.columns if not (self.hidden_key and c == self.key)]


def _q(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def area_edges(df: DataFrame, geom_col: str, key_col: str) -> DataFrame:
    """Edge table of the areal geometries in ``geom_col`` (other kinds give no edges)."""
    areal = df.where(G.geom_kind(_q(geom_col)).isin("Polygon", "MultiPolygon"))
    rings = areal.select(_q(key_col).alias(key_col), F.posexplode(G.rings(_q(geom_col))).alias("ring", "r"))
    segs = rings.select(
        key_col, "ring", F.col("r.hole").alias("hole"), F.explode(G._pairs("r.ring")).alias("s")
    )
    return segs.select(key_col, "ring", "hole", *[F.col("s").getField(c).alias(c) for c in EDGE_COLS])


def as_area_set(df_polygon: DataFrame | AreaSet, polygon_column: str | None, area_key: str | None) -> AreaSet:
    """Normalise a geometry frame (or an AreaSet) to an AreaSet."""
    if isinstance(df_polygon, AreaSet):
        return df_polygon
    if area_key is None:
        # the join reads the areas twice (edges, payload): give each row an id once and keep it
        keyed = materialize(df_polygon.withColumn("__area_row", F.monotonically_increasing_id()), "keyed-areas")
        return AreaSet(
            areas=keyed, edges=area_edges(keyed, polygon_column, "__area_row"), key="__area_row", hidden_key=True
        )
    twice = df_polygon.groupBy(_q(area_key)).count().where(F.col("count") > 1)
    if not twice.isEmpty():
        raise ValueError(f"'{area_key}' is not unique in data frame df_polygon")
    return AreaSet(areas=df_polygon, edges=area_edges(df_polygon, polygon_column, area_key), key=area_key)


# ---------------------------------------------------------------- cell records


def _floor_div(v: Column, cell: float) -> Column:
    return F.floor(v / F.lit(float(cell))).cast("long")


def edge_cells(edges: DataFrame, key: str, cell_size: float) -> DataFrame:
    """(key, __k, __c, __edge) for every cell an edge passes through.

    The edge is clipped to each cell row it spans and spread over the cells
    of the clipped x-range, so a long diagonal edge is copied to O(rows +
    columns) cells, not to its whole bounding box.
    """
    w = float(cell_size)
    eps = w * 1e-9
    e = edges.select(
        _q(key).alias("__key"), *EDGE_COLS, F.least("y1", "y2").alias("__miny"), F.greatest("y1", "y2").alias("__maxy")
    )
    rows = e.withColumn(
        "__k", F.explode(F.sequence(_floor_div(F.col("__miny") - eps, w), _floor_div(F.col("__maxy") + eps, w)))
    )
    ylo = F.greatest(F.col("__miny"), F.col("__k") * w)
    yhi = F.least(F.col("__maxy"), (F.col("__k") + 1) * w)
    dy = F.col("y2") - F.col("y1")

    def x_at(y: Column) -> Column:
        return F.col("x1") + (y - F.col("y1")) * (F.col("x2") - F.col("x1")) / dy

    flat = dy == 0
    xlo = F.when(flat, F.least("x1", "x2")).otherwise(F.least(x_at(ylo), x_at(yhi)))
    xhi = F.when(flat, F.greatest("x1", "x2")).otherwise(F.greatest(x_at(ylo), x_at(yhi)))
    return rows.select(
        F.col("__key").alias(key),
        "__k",
        F.explode(F.sequence(_floor_div(xlo - eps, w), _floor_div(xhi + eps, w))).alias("__c"),
        F.struct(*EDGE_COLS).alias("__edge"),
    )


# every level's cells are REFINE times finer than the last; LEVELS_DOWN of them are enough to tell
# apart any two edges that doubles can (beyond that, edges meet in one vertex)
REFINE = 8
LEVELS_DOWN = 6
DEFAULT_MAX_EDGES = 512


@dataclass(frozen=True)
class Grid:
    """Nested square cells. Indices and line heights of all levels derive from the finest one, so they always agree."""

    cell_size: float
    refine: int = REFINE
    levels: int = LEVELS_DOWN + 1

    @property
    def finest(self) -> float:
        return self.cell_size / self.refine ** (self.levels - 1)

    def blocks(self, level: int) -> int:
        """Finest cells along one side of a cell of ``level``."""
        return self.refine ** (self.levels - 1 - level)

    def size(self, level: int) -> float:
        return self.finest * self.blocks(level)

    def line(self, k: Column, level: int) -> Column:
        return (k * self.blocks(level)) * self.finest

    def point_cell(self, px: Column, py: Column) -> tuple[Column, Column]:
        """Finest cell of a point."""
        k = _floor_div(py, self.finest)
        return _floor_div(px, self.finest), F.when(k * self.finest > py, k - 1).otherwise(k)

    def at(self, index: Column, level: int) -> Column:
        """Index of a finest cell's block at ``level``."""
        return _div(index, self.blocks(level))


def _div(v: Column, n: int) -> Column:
    """Integer floor division of a long column."""
    return F.floor(v / F.lit(n)).cast("long")


def _line_intervals(e: DataFrame, rows: Column, line_y) -> DataFrame:
    """(__key, __k, a, b): inside intervals of the lines ``y = line_y(k)`` for the rows ``k`` in ``rows``.

    Half-open rule: a vertex on the line counts as below it. Crossings of one
    line with one area are sorted and paired (window bounded by the number of
    crossings of that line).
    """
    lines = e.withColumn("__k", F.explode(rows)).withColumn("__Y", line_y(F.col("__k")))
    crossing = lines.where((F.col("y1") > F.col("__Y")) != (F.col("y2") > F.col("__Y"))).select(
        "__key",
        "__k",
        (F.col("x1") + (F.col("__Y") - F.col("y1")) * (F.col("x2") - F.col("x1")) / (F.col("y2") - F.col("y1"))).alias("__x"),
    )
    line_order = Window.partitionBy("__key", "__k").orderBy("__x")
    return (
        crossing.withColumn("__rn", F.row_number().over(line_order))
        .withColumn("__nx", F.lead("__x").over(line_order))
        .where((F.col("__rn") % 2 == 1) & F.col("__nx").isNotNull())
        .select("__key", "__k", F.col("__x").alias("a"), F.col("__nx").alias("b"))
    )


_NO_IV = "struct<a:double,b:double>"
_NO_EDGE = "struct<x1:double,y1:double,x2:double,y2:double>"


def _records(local: DataFrame, covered: DataFrame, dense: DataFrame | None, level: int, grid: Grid) -> DataFrame:
    """Records of one level; a dense (area, cell) only leaves a mark that its finer cells are to be asked."""
    both = local.select("__key", "__c", "__k", "__edge", F.lit(None).cast(_NO_IV).alias("__ivs")).unionByName(
        covered.select("__key", "__c", "__k", F.lit(None).cast(_NO_EDGE).alias("__edge"), "__ivs")
    )
    cells = ["__key", "__c", "__k"]
    sparse = both if dense is None else both.join(dense, cells, "left_anti")
    rows = (
        sparse.groupBy("__c", "__k", "__key")
        .agg(F.collect_list("__edge").alias("__e"), F.collect_list("__ivs").alias("__iv"))
        .withColumn("__deeper", F.lit(False))
    )
    columns = [
        F.lit(level).alias("__lvl"), "__c", "__k", grid.line(F.col("__k"), level).alias("__Y"), "__key", "__e", "__iv", "__deeper",
    ]
    if dense is None:
        return rows.select(*columns)
    marks = dense.select(
        "__c", "__k", "__key", F.array().cast(f"array<{_NO_EDGE}>").alias("__e"), F.array().cast(f"array<{_NO_IV}>").alias("__iv")
    )
    return rows.unionByName(marks.withColumn("__deeper", F.lit(True))).select(*columns)


@dataclass(frozen=True)
class CellIndex:
    """Area records keyed by (first level, level, cell x, cell row) for point lookups."""

    records: DataFrame
    key: str
    grid: Grid
    levels: dict[int, int]  # first level of some areas -> the last one they use

    @property
    def depth(self) -> int:
        """Number of levels in use."""
        return max(self.levels.values()) - min(self.levels) + 1


CELLS_ACROSS = 4  # an area begins at the coarsest level with so many cells across it
EDGES_PER_CELL = 8  # about so many edges of a border in one cell, where no cell size is given


def measured_cell_size(edges: DataFrame, key: str | None = None) -> float:
    """Cell size for these edges: a power of two of about ``EDGES_PER_CELL`` times their mean length.

    With the areas' ``key``, cells are at most about as wide as a ``CELLS_ACROSS``-th of the mean area: where
    borders have few edges, a point should not meet all the areas of a wide cell.
    """
    mean = edges.agg(F.avg(F.greatest(F.abs(F.col("x2") - F.col("x1")), F.abs(F.col("y2") - F.col("y1"))))).first()[0]
    if not mean:
        return 1.0
    size = EDGES_PER_CELL * mean
    if key is not None:
        low, high = (lambda a: F.min(F.least(f"{a}1", f"{a}2"))), (lambda a: F.max(F.greatest(f"{a}1", f"{a}2")))
        extents = edges.groupBy(_q(key)).agg(F.greatest(high("x") - low("x"), high("y") - low("y")).alias("__extent"))
        size = min(size, extents.agg(F.avg("__extent")).first()[0] / CELLS_ACROSS)
    return 2.0 ** math.ceil(math.log2(size))


def _first_levels(e: DataFrame, cell_size: float, refine: int) -> tuple[int, DataFrame | None]:
    """How many levels stand above ``cell_size``, and the first level of every area (None: one level for all)."""
    extents = e.groupBy("__key").agg(
        F.greatest(F.max(F.greatest("x1", "x2")) - F.min(F.least("x1", "x2")), F.max("__maxy") - F.min("__miny")).alias("__extent")
    )
    widest = extents.agg(F.max("__extent")).first()[0] or 0.0
    above = max(0, math.floor(math.log(max(widest, 1e-300) / CELLS_ACROSS / cell_size, refine) + 1e-9)) if widest > 0 else 0
    if not above:
        return 0, None
    own = F.floor(F.log(float(refine), F.greatest("__extent", F.lit(1e-300)) / (CELLS_ACROSS * cell_size)) + 1e-9).cast("int")
    return above, extents.select("__key", (above - F.greatest(F.lit(0), F.least(F.lit(above), own))).alias("__first"))


def _edges_in_cells(e: DataFrame, grid: Grid, level: int, parents: DataFrame | None) -> DataFrame:
    """Edge cells of one level with ``__above``, the edges of the cell they refine (NULL at level 0).

    Only cells inside the ``parents`` (dense cells of the level above) are kept where given.
    """
    if parents is None:
        return edge_cells(e, "__key", grid.size(level)).withColumn("__above", F.lit(None).cast("bigint"))
    inside = edge_cells(e.join(parents.select("__key").distinct(), "__key", "left_semi"), "__key", grid.size(level))
    up = [_div(F.col(c), grid.refine).alias(f"__p{c[2:]}") for c in ("__c", "__k")]
    above = parents.select("__key", F.col("__c").alias("__pc"), F.col("__k").alias("__pk"), F.col("__n").alias("__above"))
    return inside.select("*", *up).join(above, ["__key", "__pc", "__pk"]).drop("__pc", "__pk")


def _crowded(local: DataFrame, grid: Grid, level: int, max_edges: int) -> DataFrame | None:
    """(area, cell) with more than ``max_edges`` edges that finer cells can tell apart, and their number ``__n``; None where there is none.

    Finer cells help where several vertices lie in the cell, or where the split that led here
    helped. They don't where edges meet in one vertex or pass through side by side.
    """
    c, k = grid.point_cell(F.col("__edge.x1"), F.col("__edge.y1"))
    own = (grid.at(c, level) == F.col("__c")) & (grid.at(k, level) == F.col("__k"))
    x, y = F.when(own, F.col("__edge.x1")), F.when(own, F.col("__edge.y1"))
    cells = ["__key", "__c", "__k"]
    counted = local.groupBy(*cells).agg(
        F.count(F.lit(1)).alias("__n"),
        F.first("__above").alias("__above"),
        (F.max(x) - F.min(x) + F.max(y) - F.min(y)).alias("__spread"),
    )
    helps = (F.coalesce("__spread", F.lit(0.0)) > 0) | F.col("__above").isNull() | (F.col("__n") < F.col("__above"))
    dense = counted.where((F.col("__n") > max_edges) & helps).select(*cells, "__n")
    return None if dense.isEmpty() else sized_join(materialize(dense, "crowded-cells"))


def _covered_cells(e: DataFrame, grid: Grid, level: int, parents: DataFrame | None) -> DataFrame:
    """Cells next to the inside intervals of their row's bottom line; intervals are cut to the ``parents`` where given."""
    size = grid.size(level)
    if parents is not None:
        e = e.join(parents.select("__key").distinct(), "__key", "left_semi")
    rows = F.sequence(_floor_div(F.col("__miny"), size) - 1, _floor_div(F.col("__maxy"), size) + 1)
    spans = _line_intervals(e, rows, lambda k: grid.line(k, level))
    first, last = _floor_div(F.col("a"), size) - 1, _floor_div(F.col("b"), size) + 1
    if parents is not None:
        spans = spans.withColumn("__pk", _div(F.col("__k"), grid.refine)).join(
            parents.select("__key", F.col("__k").alias("__pk"), F.col("__c").alias("__pc")), ["__key", "__pk"]
        )
        first = F.greatest(first, F.col("__pc") * grid.refine)
        last = F.least(last, F.col("__pc") * grid.refine + (grid.refine - 1))
        spans = spans.where(first <= last)
    return spans.select("__key", "__k", F.explode(F.sequence(first, last)).alias("__c"), F.struct("a", "b").alias("__ivs"))


def cell_index(
    edges: DataFrame,
    key: str,
    cell_size: float | None = None,
    max_edges: int = DEFAULT_MAX_EDGES,
    refine: int = REFINE,
    name: str = "area-cell-records",
) -> CellIndex:
    """Records ``(__first, __lvl, __c, __k, __Y, key, __e, __iv, __deeper)`` of the areas in ``edges``.

    Cells of ``cell_size`` (measured from the edges if None) describe the borders. A large area begins
    with cells some powers of ``refine`` coarser; those that its border passes through
    become marks and are described by finer ones. Where one area has more than
    ``max_edges`` edges inside one cell of ``cell_size``, that (area, cell) is described by cells
    ``refine`` times finer, and so on for as many levels as the data needs, so
    the work per point and the size of one record stay small however large an area or dense a
    border is. Only edges that meet in one vertex, or run side by side through a cell,
    stay together. The record table is written once and broadcast only if its measured rows fit.
    """
    cell_size = float(cell_size) if cell_size else measured_cell_size(edges, key)
    e = edges.select(
        _q(key).alias("__key"), *EDGE_COLS, F.least("y1", "y2").alias("__miny"), F.greatest("y1", "y2").alias("__maxy")
    )
    base, first_levels = _first_levels(e, cell_size, refine)
    grid = Grid(cell_size * refine**base, refine, base + LEVELS_DOWN + 1)
    if first_levels is None:
        groups = {0: e}
    else:
        first_levels = sized_join(materialize(first_levels, "first-levels"))
        used = sorted(r[0] for r in first_levels.select("__first").distinct().collect())  # at most one for each level
        groups = {n: e.join(first_levels.where(F.col("__first") == n).select("__key"), "__key", "left_semi") for n in used}
    records, last = None, {}
    for first, own in groups.items():
        parents, level = None, first
        while True:
            local = materialize(_edges_in_cells(own, grid, level, parents), "edge-cells")
            if level < base:  # every cell that the border passes through is split
                dense = sized_join(materialize(local.groupBy("__key", "__c", "__k").agg(F.count(F.lit(1)).alias("__n")), "border-cells"))
            else:
                dense = None if level == grid.levels - 1 else _crowded(local, grid, level, max_edges)
            rows = _records(local, _covered_cells(own, grid, level, parents), dense, level, grid).withColumn("__first", F.lit(first))
            records = rows if records is None else records.unionByName(rows)
            if dense is None:
                break
            parents, level = dense, level + 1
        last[first] = level
    return CellIndex(sized_broadcast(records.withColumnRenamed("__key", key), name), key, grid, last)


def locate(points: DataFrame, px: str, py: str, index: CellIndex, match: tuple[str, str] | None = None) -> DataFrame:
    """Points joined with the records of their cells (one equi-join for each level in use).

    Adds ``__lvl, __c, __k, __Y, key, __e, __iv``; evaluate with
    :func:`inside_record_sql` using ``__Y`` as the line height. ``match``
    ``(point column, record key field)`` adds one more equality to the join
    keys, e.g. to meet only the areas of the point's own relation. Only points
    that meet a mark go on to the next level, and only with that area.
    """
    grid, columns = index.grid, points.columns
    fine_c, fine_k = grid.point_cell(F.col(px), F.col(py))
    placed = points.withColumn("__fc", fine_c).withColumn("__fk", fine_k)
    found = None
    for first, last in index.levels.items():
        asked = placed
        for level in range(first, last + 1):
            cells = asked.withColumn("__c", grid.at(F.col("__fc"), level)).withColumn("__k", grid.at(F.col("__fk"), level))
            records = index.records.where((F.col("__first") == first) & (F.col("__lvl") == level)).drop("__first")
            if level > first:
                joined = cells.join(records, ["__c", "__k", index.key])
            elif match is None:
                joined = cells.join(records, ["__c", "__k"])
            else:
                own = records.withColumn("__match", F.col(match[1]))
                joined = cells.withColumn("__match", F.col(match[0])).join(own, ["__c", "__k", "__match"]).drop("__match")
            here = joined.where(~F.col("__deeper")).select(*columns, "__lvl", "__c", "__k", "__Y", index.key, "__e", "__iv")
            found = here if found is None else found.unionByName(here)
            asked = joined.where(F.col("__deeper")).select(*columns, "__fc", "__fk", index.key)
    return found


# ---------------------------------------------------------------- validity


def _cell_crossings(local: DataFrame, key: str, cell_of_point) -> DataFrame:
    """Proper crossings of edge pairs that share a cell, kept in the cell that contains them."""
    a = local.select(_q(key).alias("__ka"), F.col("__c").alias("__ca"), F.col("__k").alias("__kka"), F.col("__edge").alias("s"))
    b = local.select(_q(key).alias("__kb"), F.col("__c").alias("__cb"), F.col("__k").alias("__kkb"), F.col("__edge").alias("t"))
    pairs = a.join(
        b,
        (F.col("__ka") == F.col("__kb"))
        & (F.col("__ca") == F.col("__cb"))
        & (F.col("__kka") == F.col("__kkb"))
        & (F.col("s") < F.col("t")),
    )
    proper, ix, iy = G._crossing_sql("s", "t")
    found = pairs.where(F.expr(proper)).select(
        "__ka", "__ca", "__kka", F.expr(ix).alias("__x"), F.expr(iy).alias("__y")
    )
    c, k = cell_of_point(F.col("__x"), F.col("__y"))
    return found.where((c == F.col("__ca")) & (k == F.col("__kka"))).select(
        F.col("__ka").alias(key), F.col("__x").alias("x"), F.col("__y").alias("y")
    )


def edge_crossings(left: DataFrame, left_key: str, right: DataFrame, right_key: str, cell_size: float) -> DataFrame:
    """Distinct (left_key, right_key) whose edges cross properly; both keys are structs with an equal ``id``."""
    a = edge_cells(left, left_key, cell_size).withColumnRenamed("__edge", "s")
    b = edge_cells(right, right_key, cell_size).withColumnRenamed("__edge", "t")
    proper, _, _ = G._crossing_sql("s", "t")
    pairs = a.withColumn("__id", F.col(left_key).getField("id")).join(
        b.withColumn("__id", F.col(right_key).getField("id")), ["__id", "__c", "__k"]
    )
    return pairs.where(F.expr(proper)).select(left_key, right_key).distinct()


def bounded_cells(edges: DataFrame, key: str, cell_size: float, max_edges: int = DEFAULT_MAX_EDGES, refine: int = REFINE):
    """Levels of ``(edges in cells, cell of a point)`` in which edges of one area can be paired.

    An (area, cell) with more than ``max_edges`` edges is left out of its level and comes
    again in cells ``refine`` times finer, as in :func:`cell_index`, so the pairs of a cell stay
    bounded. The rows are ``__key, __c, __k, __edge``; the key is ``__key``.
    """
    grid = Grid(float(cell_size), refine)
    e = edges.select(_q(key).alias("__key"), *EDGE_COLS)
    parents, level = None, 0
    while True:

        def cell_of(x: Column, y: Column, level=level):
            c, k = grid.point_cell(x, y)
            return grid.at(c, level), grid.at(k, level)

        local = materialize(_edges_in_cells(e, grid, level, parents), "edge-cells")
        dense = None if level == grid.levels - 1 else _crowded(local, grid, level, max_edges)
        yield sized_join(local, local if dense is None else local.join(dense, ["__key", "__c", "__k"], "left_anti")), cell_of
        if dense is None:
            return
        parents, level = dense, level + 1


def self_intersections(
    edges: DataFrame, key: str, cell_size: float = 0.01, max_edges: int = DEFAULT_MAX_EDGES, refine: int = REFINE, levels: list | None = None
) -> DataFrame:
    """(key, x, y) for every proper crossing of two edges of the same area.

    Edges meet only the edges that share a cell with them (equi-join on
    area and cell); a crossing found in several shared cells is kept only in
    the cell that contains the crossing point. Edges that merely touch at a
    shared vertex are not reported. Crowded cells are searched in finer ones
    (``levels`` of :func:`bounded_cells`, where a caller has them).
    """
    out = None
    for local, cell_of in levels or bounded_cells(edges, key, cell_size, max_edges, refine):
        found = _cell_crossings(local, "__key", cell_of)
        out = found if out is None else out.unionByName(found)
    return out.withColumnRenamed("__key", key)


def shared_stretches(
    edges: DataFrame, key: str, cell_size: float = 0.01, max_edges: int = DEFAULT_MAX_EDGES, levels: list | None = None
) -> DataFrame:
    """(key, x, y) where two edges of one area run along each other: the beginning of each such stretch.

    Collinear edges that only meet end to end have no stretch in common. Equal edges are
    found by counting, all others by the equi-join on area and cell, crowded cells in finer ones; a stretch is
    reported in the cell of its beginning.
    """
    a, b = F.struct(F.col("x1").alias("x"), F.col("y1").alias("y")), F.struct(F.col("x2").alias("x"), F.col("y2").alias("y"))
    out = (
        edges.select(_q(key).alias(key), F.least(a, b).alias("p"), F.greatest(a, b).alias("q"))
        .where("p < q")
        .groupBy(key, "p", "q")
        .count()
        .where("count > 1")
        .select(key, "p.x", "p.y")
    )

    def end(e: str, n: int) -> str:
        return f"named_struct('x', {e}.x{n}, 'y', {e}.y{n})"

    def low(e: str) -> str:
        return f"least({end(e, 1)}, {end(e, 2)})"

    def high(e: str) -> str:
        return f"greatest({end(e, 1)}, {end(e, 2)})"

    line = [("s.x1", "s.y1"), ("s.x2", "s.y2")]
    straight = " AND ".join(f"{G._orient_sql(*line, (f't.x{n}', f't.y{n}'))} = 0" for n in (1, 2))
    for local, cell_of in levels or bounded_cells(edges, key, cell_size, max_edges):
        one = local.select("__key", "__c", "__k", F.col("__edge").alias("s"))
        pairs = one.join(local.select("__key", "__c", "__k", F.col("__edge").alias("t")), ["__key", "__c", "__k"]).where("s < t")
        along = pairs.where(F.expr("s.x1 <> s.x2 OR s.y1 <> s.y2")).where(F.expr(straight))
        spans = along.select(
            F.col("__key").alias(key), "__c", "__k",
            F.expr(f"greatest({low('s')}, {low('t')})").alias("p"), F.expr(f"least({high('s')}, {high('t')})").alias("q"),
        )
        c, k = cell_of(F.col("p.x"), F.col("p.y"))
        out = out.unionByName(spans.where((F.col("p") < F.col("q")) & (c == F.col("__c")) & (k == F.col("__k"))).select(key, "p.x", "p.y"))
    return out.distinct()


def vertex_touches(edges: DataFrame, key: str) -> DataFrame:
    """(key, x, y, crossing) of the vertices in which a ring meets itself, or in which two rings cross.

    A ring that has four or more edges at one vertex touches itself there (``crossing`` false). Two
    rings cross in a common vertex (true) if their edges alternate in the order around it;
    rings that only touch are not reported, nor are vertices where edges run along each other.
    """
    ends = edges.where("x1 <> x2 OR y1 <> y2").select(
        _q(key).alias(key), "ring", F.expr("inline(array(named_struct('x', x1, 'y', y1, 'a', atan2(y2 - y1, x2 - x1)), named_struct('x', x2, 'y', y2, 'a', atan2(y1 - y2, x1 - x2))))")
    )
    per_ring = ends.groupBy(key, "x", "y", "ring").agg(F.collect_list("a").alias("angles"))
    met = per_ring.groupBy(key, "x", "y").agg(
        F.max(F.size("angles")).alias("most"), F.flatten(F.collect_list(F.transform("angles", lambda a: F.struct(a.alias("a"), F.col("ring"))))).alias("es")
    )
    busy = met.where("size(es) > 2").withColumn("es", F.sort_array("es"))
    apart = "size(array_distinct(transform(es, _e -> _e.a))) = size(es)"
    # between the two edges of one ring an odd number of another ring's
    alternate = """exists(array_distinct(transform(es, _e -> _e.ring)), _r -> exists(array_distinct(transform(es, _e -> _e.ring)), _o -> _o <> _r
        AND size(filter(slice(es, array_position(transform(es, _e -> _e.ring), _r), size(es)
            - array_position(reverse(transform(es, _e -> _e.ring)), _r) + 2 - array_position(transform(es, _e -> _e.ring), _r)), _m -> _m.ring = _o)) % 2 = 1))"""
    told = busy.withColumn("crossing", F.expr(f"most = 2 AND {apart} AND {alternate}"))
    return told.where(F.expr(f"crossing OR (most > 2 AND {apart})")).select(key, "x", "y", "crossing")


def degenerate_rings(edges: DataFrame, key: str) -> DataFrame:
    """(key, x, y) of the rings with fewer than three different vertices, by their smallest one."""
    ends = edges.select(_q(key).alias(key), "ring", F.expr("inline(array(named_struct('x', x1, 'y', y1), named_struct('x', x2, 'y', y2)))"))
    rings = ends.groupBy(key, "ring").agg(F.count_distinct("x", "y").alias("n"), F.min(F.struct("x", "y")).alias("p"))
    return rings.where("n < 3").select(key, "p.x", "p.y")


def nested_shells(edges: DataFrame, key: str, cell_size: float = 0.01, max_edges: int = DEFAULT_MAX_EDGES) -> DataFrame:
    """(key, x, y) for every shell that lies inside its own area's other rings, by its smallest vertex.

    A shell in a hole is an island and not reported. Only areas with several shells are looked at.
    """
    several = edges.where(~F.col("hole")).groupBy(key).agg(F.count_distinct("ring").alias("n")).where("n > 1").select(key)
    several = sized_join(materialize(several, "several-shells"))
    if several.isEmpty():
        return several.select(key, F.lit(0.0).alias("x"), F.lit(0.0).alias("y")).limit(0)
    rings = edges.join(several, key, "left_semi").withColumn("__ring", F.struct(_q(key).alias("k"), F.col("ring").alias("r")))
    index = cell_index(rings, "__ring", cell_size, max_edges=max_edges, name="shell-records")
    probes = rings.where(~F.col("hole")).groupBy(key, "ring").agg(F.min(F.struct(F.col("x1").alias("x"), F.col("y1").alias("y"))).alias("p"))
    probes = probes.select(key, F.col("ring").alias("own"), F.col("p.x").alias("px"), F.col("p.y").alias("py"))
    met = locate(probes, "px", "py", index, match=(key, "__ring.k")).where(F.col("__ring.r") != F.col("own"))
    inside, on_edge = inside_record_sql("px", "py", "__Y")
    around = met.where(F.expr(f"{inside} AND NOT {on_edge}")).select(key, "own", "px", "py", "__ring").distinct()
    odd = around.groupBy(key, "own", "px", "py").count().where("count % 2 = 1")
    return odd.select(key, F.col("px").alias("x"), F.col("py").alias("y"))


# what makes an area invalid, in the order in which it is reported; fixed values: the texts
INVALID = ("Too few points in geometry component", "Self-intersection", "Ring Self-intersection", "Nested shells")


def invalid_areas(edges: DataFrame, key: str, cell_size: float = 0.01, max_edges: int = DEFAULT_MAX_EDGES) -> DataFrame:
    """(key, n_crossings, x, y, invalidity_explain) for areas that are not valid.

    ``invalidity_explain`` reads ``reason[x y]`` for the first reason of ``INVALID`` that holds, at the
    smallest point (x, then y): a ring of fewer than three vertices; edges that cross, begin to run along each
    other, or rings that cross in a vertex; a ring that touches itself in a vertex; a shell in
    another. Valid areas have no row. ``n_crossings`` counts proper crossings. Rings are compared when
    ``edges`` tells rings and holes apart. Each reason reads the edges anew, so they are staged once, spread over the tasks.
    """
    edges = materialize(edges.repartition(_q(key), "x1", "y1"), "validity-edges")
    levels = list(bounded_cells(edges, key, cell_size, max_edges))
    reason = lambda df, n, counts=0: df.select(_q(key).alias(key), "x", "y", F.lit(n).alias("reason"), F.lit(counts).alias("counts"))
    found = reason(self_intersections(edges, key, levels=levels), 1, 1).unionByName(reason(shared_stretches(edges, key, levels=levels), 1))
    if {"ring", "hole"} <= set(edges.columns):
        touches = vertex_touches(edges, key)
        found = (
            found.unionByName(reason(touches.where("crossing"), 1))
            .unionByName(reason(touches.where("NOT crossing"), 2))
            .unionByName(reason(nested_shells(edges, key, cell_size, max_edges), 3))
            .unionByName(reason(degenerate_rings(edges, key), 0))
        )
    per_area = found.groupBy(key).agg(F.sum("counts").cast("bigint").alias("n_crossings"), F.min(F.struct("reason", "x", "y")).alias("p"))
    text = F.element_at(F.array(*[F.lit(t) for t in INVALID]), F.col("p.reason") + 1)
    return per_area.select(
        key,
        "n_crossings",
        F.col("p.x").alias("x"),
        F.col("p.y").alias("y"),
        F.format_string("%s[%s %s]", text, F.col("p.x").cast("string"), F.col("p.y").cast("string")).alias(
            "invalidity_explain"
        ),
    )


def _point_cell(px: Column, py: Column, w: float):
    c = _floor_div(px, w)
    k0 = _floor_div(py, w)
    k = F.when(k0 * w > py, k0 - 1).otherwise(k0)
    return c, k


def inside_record_sql(px: str, py: str, Y: str, e: str = "__e", iv: str = "__iv") -> tuple[str, str]:
    """(inside, on_edge) SQL for a point against one (area, cell) record."""
    horiz = f"exists({iv}, _hi -> _hi.a <= {px} AND {px} < _hi.b)"
    yc = f"(_ve.y1 + ({px} - _ve.x1) * (_ve.y2 - _ve.y1) / (_ve.x2 - _ve.x1))"
    vertical = (
        f"(size(filter({e}, _ve -> ((_ve.x1 > {px}) != (_ve.x2 > {px})) AND "
        f"({yc} > {Y} OR ({yc} = {Y} AND (_ve.y2 - _ve.y1) / (_ve.x2 - _ve.x1) > 0)) AND {yc} < {py})) % 2 = 1)"
    )
    on_edge = (
        f"exists({e}, _oe -> (_oe.x2 - _oe.x1) * ({py} - _oe.y1) - (_oe.y2 - _oe.y1) * ({px} - _oe.x1) = 0 "
        f"AND {px} >= least(_oe.x1, _oe.x2) AND {px} <= greatest(_oe.x1, _oe.x2) "
        f"AND {py} >= least(_oe.y1, _oe.y2) AND {py} <= greatest(_oe.y1, _oe.y2))"
    )
    return f"(({horiz}) != {vertical})", on_edge


def point_area_pairs(
    points: DataFrame, x: Column, y: Column, areas: AreaSet, cell_size: float | None = None, max_edges: int = DEFAULT_MAX_EDGES
) -> DataFrame:
    """Point rows extended with ``areas.key`` for every area that contains them."""
    index = cell_index(areas.edges, areas.key, cell_size, max_edges=max_edges)
    pts = points.withColumn("__px", x.cast("double")).withColumn("__py", y.cast("double"))
    joined = locate(pts, "__px", "__py", index)
    inside, on_edge = inside_record_sql("__px", "__py", "__Y")
    return joined.where(F.expr(f"{inside} AND NOT {on_edge}")).drop(
        "__lvl", "__c", "__k", "__Y", "__px", "__py", "__e", "__iv"
    )


def join_point_in_area(
    df_in: DataFrame,
    point_column: str,
    df_polygon: DataFrame | AreaSet,
    polygon_column: str | None = None,
    *,
    area_key: str | None = None,
    cell_size: float | None = None,
    partition_count: int | None = None,
    max_edges: int = DEFAULT_MAX_EDGES,
) -> DataFrame:
    """Inner join of points with the areas that contain them (boundary excluded).

    One output row per (point row, containing area row); columns are the area
    side's then the point side's. ``df_polygon`` is a frame with a geometry
    column (``area_key`` may name a unique key column; without one, rows are
    numbered once and the numbered frame is written to the checkpoint folder)
    or an :class:`AreaSet`. ``cell_size`` is measured from the borders if not given. ``partition_count`` is accepted for compatibility; AQE
    sizes partitions at runtime.
    """
    assert point_column in df_in.schema.fieldNames(), f"'{point_column}' not in data frame df_in"
    assert is_geometry(df_in.schema[point_column].dataType), (
        f"'{point_column}' in data frame df_in is of type '{df_in.schema[point_column].dataType}'"
    )
    if not isinstance(df_polygon, AreaSet):
        assert polygon_column in df_polygon.schema.fieldNames(), f"'{polygon_column}' not in data frame df_polygon"
        assert is_geometry(df_polygon.schema[polygon_column].dataType), (
            f"'{polygon_column}' in data frame df_polygon is of type '{df_polygon.schema[polygon_column].dataType}'"
        )
    areas = as_area_set(df_polygon, polygon_column, area_key)
    key = areas.key
    tmp_key = "__area_key"
    pairs = point_area_pairs(
        df_in,
        G.geom_x(_q(point_column)),
        G.geom_y(_q(point_column)),
        AreaSet(areas.areas, areas.edges.withColumnRenamed(key, tmp_key), tmp_key, True),
        cell_size,
        max_edges,
    )
    # many points meet one area: its attributes go to the points if they fit, else AQE splits hot keys
    payload = areas.areas.withColumn(tmp_key, _q(key))
    small = measured_bytes(payload) <= broadcast_limit(payload.sparkSession)
    joined = pairs.join(F.broadcast(payload) if small else payload, on=tmp_key, how="inner")
    return joined.select(*[_q(c) for c in areas.visible_columns], *[_q(c) for c in df_in.columns])


# ---------------------------------------------------------------- centroids


def edge_centroids(edges: DataFrame, key: str) -> DataFrame:
    """(key, cx, cy) area-weighted centroid per area from its edge table.

    Shells count positive and holes negative whatever their orientation. Sums
    are taken relative to a corner of the area, so small areas far from the
    origin keep their precision; areas of size zero take the length-weighted
    middle of their edges (the corner itself if they have no length). Streaming
    aggregates only; nothing is collected.
    """
    corner = edges.groupBy(key).agg(F.min("x1").alias("ox"), F.min("y1").alias("oy"))
    e = edges.join(corner, key).select(
        key, "ring", "hole", "ox", "oy",
        (F.col("x1") - F.col("ox")).alias("x1"), (F.col("y1") - F.col("oy")).alias("y1"),
        (F.col("x2") - F.col("ox")).alias("x2"), (F.col("y2") - F.col("oy")).alias("y2"),
    )
    cross = F.col("x1") * F.col("y2") - F.col("x2") * F.col("y1")
    length = F.hypot(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1"))
    sx, sy = F.col("x1") + F.col("x2"), F.col("y1") + F.col("y2")
    per_ring = e.groupBy(key, "ring").agg(
        F.first("hole").alias("hole"), F.first("ox").alias("ox"), F.first("oy").alias("oy"),
        F.sum(cross).alias("a"), F.sum(cross * sx).alias("mx"), F.sum(cross * sy).alias("my"),
        F.sum(length).alias("l"), F.sum(length * sx / 2).alias("lx"), F.sum(length * sy / 2).alias("ly"),
    )
    sign = F.when(F.col("hole"), F.lit(-1.0)).otherwise(F.lit(1.0)) * F.signum("a")
    per_area = per_ring.groupBy(key).agg(
        F.first("ox").alias("ox"), F.first("oy").alias("oy"),
        F.sum(sign * F.col("a")).alias("a"), F.sum(sign * F.col("mx")).alias("mx"), F.sum(sign * F.col("my")).alias("my"),
        F.sum("l").alias("l"), F.sum("lx").alias("lx"), F.sum("ly").alias("ly"),
    )

    def middle(moment: str, along: str) -> Column:
        by_area = F.try_divide(F.col(moment), 3 * F.col("a"))
        return F.coalesce(F.when(F.col("a") != 0, by_area), F.try_divide(F.col(along), F.col("l")), F.lit(0.0))

    return per_area.select(
        key, (F.col("ox") + middle("mx", "lx")).alias("cx"), (F.col("oy") + middle("my", "ly")).alias("cy")
    )


# ---------------------------------------------------------------- nearest

# cell sizes of the search: the radius divided by powers of STEP, LEVELS of them
STEP, LEVELS = 4, 7
PAIR_EDGES = 4096  # vertex pairs up to which two geometries are measured in one row
TASK_ROWS = 5000  # rows whose neighbours one task looks for, or pairs measured in one task
SAMPLES = 8  # vertices that stand for a geometry where its reach is learned


def _spread(df: DataFrame, *by: str) -> DataFrame:
    """A staged ``df`` dealt by its number of rows: few bytes, but much work and memory for each."""
    return df.repartition(df.count() // TASK_ROWS + 1, *by)


def _samples(geom: str) -> Column:
    """Up to ``SAMPLES`` vertices of a geometry, evenly spaced; NULL where it has none."""
    return G.let(G.vertices(F.col(geom)), lambda v: F.when(F.size(v) > 0, F.transform(
        F.sequence(F.lit(0), F.least(F.size(v), F.lit(SAMPLES)) - 1),
        lambda i: F.get(v, F.floor(i * F.size(v) / F.least(F.size(v), F.lit(SAMPLES))).cast("int")),
    )))


def _cells_of_box(box: str, pad: Column | float, size: Column) -> Column:
    """array<struct<c, k>> of the cells of edge ``size`` that a padded box touches."""

    def span(low: str, high: str) -> Column:
        first = F.floor((F.col(f"{box}.{low}") - pad) / size).cast("long")
        last = F.floor((F.col(f"{box}.{high}") + pad) / size).cast("long")
        return F.sequence(first, last)

    ys = span("miny", "maxy")
    return F.flatten(
        F.transform(span("minx", "maxx"), lambda c: F.transform(ys, lambda k: F.struct(c.alias("c"), k.alias("k"))))
    )


def _extent(box: str) -> Column:
    return F.greatest(F.col(f"{box}.maxx") - F.col(f"{box}.minx"), F.col(f"{box}.maxy") - F.col(f"{box}.miny"))


def _place(box: str) -> Column:
    """The one vertex of a box without extent, as samples (NULL for other boxes)."""
    return F.when(_extent(box) == 0, F.array(F.struct(F.col(f"{box}.minx").alias("x"), F.col(f"{box}.miny").alias("y"))))


def _box_gap(a: str, b: str) -> Column:
    """Distance of two boxes: no two points of theirs are nearer."""
    dx = F.greatest(F.lit(0.0), F.col(f"{b}.minx") - F.col(f"{a}.maxx"), F.col(f"{a}.minx") - F.col(f"{b}.maxx"))
    dy = F.greatest(F.lit(0.0), F.col(f"{b}.miny") - F.col(f"{a}.maxy"), F.col(f"{a}.miny") - F.col(f"{b}.maxy"))
    return F.hypot(dx, dy)


def _box_reach(a: str, b: str) -> Column:
    """Greatest distance of any two points of the boxes: the geometries inside are not farther apart."""
    dx = F.greatest(F.abs(F.col(f"{b}.maxx") - F.col(f"{a}.minx")), F.abs(F.col(f"{a}.maxx") - F.col(f"{b}.minx")))
    dy = F.greatest(F.abs(F.col(f"{b}.maxy") - F.col(f"{a}.miny")), F.abs(F.col(f"{a}.maxy") - F.col(f"{b}.miny")))
    return F.hypot(dx, dy)


def _level_sizes(base: float) -> list[float]:
    return [base / STEP**j for j in range(LEVELS)]


def _size_of(level: Column, base: float) -> Column:
    return F.element_at(F.array(*[F.lit(s) for s in _level_sizes(base)]), level + 1)


def _finest_level(width: Column, base: float) -> Column:
    """Finest level whose cells are at least ``width`` wide (level 0 where none is)."""
    return F.size(F.filter(F.array(*[F.lit(s) for s in _level_sizes(base)[1:]]), lambda s: s >= width))


def _reach_bounds(left: DataFrame, right: DataFrame, radius: float, base: float) -> DataFrame:
    """Left boxes ``(lk, b1)`` with ``reach``: some right geometry is surely no farther (the radius where none is known).

    ``left`` holds ``lk, b1, v1`` and ``right`` ``v2``, a few vertices of either geometry. One right vertex
    stands for each cell of each level, so a left vertex meets at most
    one per level, however dense the right side is.
    """
    levels = F.explode(F.sequence(F.lit(0), F.lit(LEVELS - 1))).alias("level")

    def placed(df: DataFrame, vertices: str, x: str, y: str, *keep: str) -> DataFrame:
        size = _size_of(F.col("level"), base)
        at = df.select(*keep, F.explode(vertices).alias("v")).select(*keep, F.col("v.x").alias(x), F.col("v.y").alias(y), levels)
        return at.withColumn("c", F.floor(F.col(x) / size).cast("long")).withColumn("r", F.floor(F.col(y) / size).cast("long"))

    # both coordinates of one row: any vertex of the cell will do, and plain numbers are aggregated by hash
    one = placed(right, "v2", "x2", "y2").groupBy("level", "c", "r").agg(F.first("x2").alias("x2"), F.first("y2").alias("y2"))
    met = placed(left, "v1", "x1", "y1", "lk").join(one, ["level", "c", "r"])
    best = met.groupBy("lk").agg(F.min(F.hypot(F.col("x1") - F.col("x2"), F.col("y1") - F.col("y2"))).alias("found"))
    # a little more than the bound, for rounding
    reach = F.least(F.lit(radius), F.coalesce(F.col("found"), F.lit(radius)) * (1 + 1e-9) + 1e-6)
    return left.join(best, "lk", "left").select("lk", "b1", reach.alias("reach"))


def _candidates(left: DataFrame, right: DataFrame, radius: float, base: float) -> DataFrame:
    """Pairs ``(lk, rk, b1, b2, reach)`` that may hold the nearest right geometry of a left one within the radius.

    Further columns of ``right`` are carried.

    Work per left row follows the reach, not the density.
    """
    left = left if "v1" in left.columns else left.withColumn("v1", _place("b1"))
    right = right if "v2" in right.columns else right.withColumn("v2", _place("b2"))
    bounds = materialize(_reach_bounds(_spread(left, "lk"), right, radius, base), "nearest-bounds")
    return _box_pairs(_spread(bounds, "lk"), right.drop("v2"), base)


def _box_pairs(bounded: DataFrame, right: DataFrame, base: float) -> DataFrame:
    """Pairs ``(lk, rk, b1, b2, reach)`` of boxes that are no farther apart than the left row's ``reach``; other columns are carried.

    A left row looks into the cells, about as wide as its reach, that its box
    touches when padded by the reach. Right rows lie in the cells of every level not
    finer than themselves; those too wide for the left row's level are looked up at their
    own level. The corner where both boxes begin to overlap names one cell, so a pair
    comes up once.
    """
    seeking = bounded.withColumn("own", _finest_level(F.greatest("reach", _extent("b1")), base))
    native = right.withColumn("native", _finest_level(_extent("b2"), base))
    # what either side uses of the few levels
    used = [r[0] for r in seeking.select("own").distinct().collect()]
    wide = [r[0] for r in native.select("native").distinct().collect()]
    numbers = lambda xs: F.array(*[F.lit(x) for x in sorted(xs)]) if xs else F.array().cast("array<int>")

    def keyed(df: DataFrame, keys: Column, box: str, pad, *keep: str) -> DataFrame:
        rows = df.select("*", F.explode(keys).alias("key")).withColumn("size", _size_of(F.col("key.level"), base))
        cells = F.explode(_cells_of_box(box, pad, F.col("size"))).alias("cell")
        return rows.select(*keep, box, "size", "key", cells).select(*keep, box, "size", "key.kind", "key.level", "cell.c", "cell.k")

    key = lambda kind, level: F.struct(F.lit(kind).alias("kind"), level.alias("level"))
    ask = F.concat(
        F.array(key(0, F.col("own"))),
        F.transform(F.filter(numbers(wide), lambda j: j < F.col("own")), lambda j: key(1, j)),
    )
    offer = F.concat(
        F.transform(F.filter(numbers(used), lambda j: j <= F.col("native")), lambda j: key(0, j)),
        F.array(key(1, F.col("native"))),
    )
    more = [c for c in right.columns if c not in ("rk", "b2")]
    own = [c for c in bounded.columns if c not in ("lk", "b1", "reach")]
    asked = keyed(seeking, ask, "b1", F.col("reach"), "lk", "reach", *own)
    offered = keyed(native, offer, "b2", F.lit(0.0), "rk", *more).drop("size")
    pairs = asked.join(offered, ["kind", "level", "c", "k"])
    begin_x = F.greatest(F.col("b1.minx") - F.col("reach"), F.col("b2.minx"))
    begin_y = F.greatest(F.col("b1.miny") - F.col("reach"), F.col("b2.miny"))
    here = (F.floor(begin_x / F.col("size")) == F.col("c")) & (F.floor(begin_y / F.col("size")) == F.col("k"))
    return pairs.where(here & (_box_gap("b1", "b2") <= F.col("reach"))).select("lk", "rk", "b1", "b2", "reach", *own, *more)


def _overlapping(left: DataFrame, right: DataFrame, boxes: DataFrame, base: float, ties: Sequence[str]) -> DataFrame:
    """(lk, known): of the right rows that surely have a point in common with a left one, the first in the order of ``ties`` (and ``rk``).

    Found by boxes alone: all points of an inner box (:func:`measure.with_inner_box`) belong to the geometry, so
    geometries with overlapping inner boxes are at distance 0. Others may be too.
    """
    own = M.with_inner_box(left.select("lk", "g1"), "g1", "b1").where("b1 IS NOT NULL").withColumn("reach", F.lit(0.0))
    others = M.with_inner_box(right.join(boxes.select("rk"), "rk", "left_semi").select("rk", *ties, "g2"), "g2", "b2")
    own = materialize(own, "inner-left")
    others = sized_join(materialize(others.where("b2 IS NOT NULL"), "inner-right"))
    met = _box_pairs(_spread(own, "lk"), others, base)
    known = F.min(F.struct(*[F.col(t) for t in ties], F.col("rk"))).alias("known")
    return sized_join(materialize(met.groupBy("lk").agg(known), "nearest-met"))


def _nearest_pairs(left: DataFrame, right: DataFrame, radius: float, base: float, ties: Sequence[str], points: tuple[bool, bool]) -> DataFrame:
    """(lk, rk, d, x1, y1, x2, y2): the nearest right row within the radius of each left row that has one.

    ``left`` holds ``lk, g1, b1, n1, v1``, ``right`` holds ``rk, g2, b2, n2, v2`` (number of vertices, samples) and the tie columns. Keys and boxes
    alone are searched; geometries join the few pairs that survive. Pairs of more than
    ``PAIR_EDGES`` vertex pairs are measured piece by piece, and where such come up, left rows that surely overlap a right
    one meet only those right rows that come before it in the order of ties. ``points`` asks
    for the closest point on either side.
    """
    # of right rows in one and the same place one stands for all
    order = F.struct(*[F.col(t) for t in ties], F.col("rk"))
    spots = right.where(_extent("b2") == 0).groupBy("b2").agg(F.min_by(F.struct("rk", *ties), order).alias("r")).select("r.*", "b2")
    shapes = right.where(_extent("b2") > 0).select("rk", *ties, "b2", "v2")
    boxes = shapes.unionByName(spots.withColumn("v2", _place("b2")))
    if left.where(_extent("b1") > 0).isEmpty() and right.where(_extent("b2") > 0).isEmpty():
        # points only: their boxes are all there is to measure
        gap = _box_gap("b1", "b2")
        place = [F.struct(gap.alias("d"), F.col(f"{b}.minx").alias("x"), F.col(f"{b}.miny").alias("y")).alias(p) for b, p in (("b1", "p1"), ("b2", "p2"))]
        rank = F.struct(gap.alias("d"), *[F.col(t) for t in ties], F.col("rk"))
        met = _candidates(left.select("lk", "b1", "v1"), boxes, radius, base).where(gap <= radius)
        return met.groupBy("lk").agg(F.min_by(F.struct("rk", *place), rank).alias("best")).select("lk", "best.*")
    n_edges = [df.agg(F.max(n)).first()[0] or 0 for df, n in ((left, "n1"), (right, "n2"))]
    large = n_edges[0] * n_edges[1] > PAIR_EDGES
    # among areas of many edges, those that surely overlap are told by boxes (a closest point has to be measured)
    met = _overlapping(left, right, boxes, base, ties) if large and not any(points) else None
    asked = left if met is None else left.join(met.select("lk"), "lk", "left_anti")
    near = _candidates(asked.select("lk", "b1", "v1"), boxes.select("rk", "b2", "v2"), radius, base)
    near = materialize(near, "nearest-candidates")
    closest = near.groupBy("lk").agg(F.min(_box_reach("b1", "b2")).alias("bound"))
    kept = near.join(closest, "lk").where(_box_gap("b1", "b2") <= F.col("bound") * (1 + 1e-9) + 1e-6).select("lk", "rk", "reach")
    n_pairs = near.count()
    if met is not None:
        # beside a right row of distance 0 only others that come before it in the order of ties count
        before = F.struct(*[F.col(t) for t in ties], F.col("rk")) < F.col("known")
        bounded = left.select("lk", "b1").join(met, "lk").withColumn("reach", F.lit(M.MARGIN))
        rivals = _box_pairs(_spread(materialize(bounded, "nearest-known"), "lk"), sized_join(materialize(boxes.drop("v2"), "nearest-boxes")), base).where(before)
        rivals = materialize(rivals.select("lk", "rk", "reach"), "nearest-rivals")
        kept, n_pairs = kept.unionByName(rivals), n_pairs + rivals.count()
    wide, tasks = None, n_pairs // TASK_ROWS + 1
    if large:
        sized = kept.join(left.select("lk", "n1"), "lk").join(right.select("rk", "n2"), "rk")
        sized = materialize(sized.select("lk", "rk", "reach", (F.col("n1") * F.col("n2") > PAIR_EDGES).alias("wide")), "nearest-sized")
        wide, kept = sized.where("wide").select("lk", "rk", "reach"), sized.where("NOT wide").select("lk", "rk")
    # the right geometry comes first, so that the left row's own shuffle is the last one before its pairs are measured
    pairs = kept.select("lk", "rk").join(right.select("rk", "g2", *ties), "rk").repartition(tasks, "lk").join(left.select("lk", "g1"), "lk")

    if wide is not None and kept.isEmpty():  # nothing to join the geometries for
        pairs = pairs.limit(0)
    measured = M.measured(pairs, "g1", "g2", points[1])
    if wide is not None:
        from mapweave.operators.pieces import pair_distances

        far = pair_distances(wide, left.select("lk", "g1"), right.select("rk", "g2"), radius, nearest_only=True, second=points[1])
        measured = measured.select(*far.columns, *ties).unionByName(far.join(right.select("rk", *ties), "rk"))
    if met is not None:
        zero = F.struct(F.lit(0.0).alias("d"), *[F.lit(None).cast("double").alias(c) for c in "xy"])
        measured = measured.unionByName(met.select("lk", "known.rk", zero.alias("p1"), *[f"known.{t}" for t in ties]))
    shown = F.struct("rk", "p1", *(["p2"] if points[1] else []))
    rank = F.struct(F.col("p1.d").alias("d"), *[F.col(t) for t in ties], F.col("rk"))
    return measured.where(F.col("p1.d") <= radius).groupBy("lk").agg(F.min_by(shown, rank).alias("best")).select("lk", "best.*")


def _numbered(df: DataFrame, key: str, columns: Sequence[str] | None, name: str) -> DataFrame:
    """``df`` with a row key: the caller's unique columns, or an id on a staged copy (a recomputed task can't renumber it)."""
    if columns:
        return materialize(df.withColumn(key, F.struct(*[_q(c) for c in columns])), name)
    return materialize(df.withColumn(key, F.monotonically_increasing_id()), name)


def join_nearest_geometry(
    df_in_1: DataFrame,
    df_in_2: DataFrame,
    column_name_1: str,
    column_name_2: str,
    epsg_1: str = "epsg:4326",
    epsg_2: str = "epsg:4326",
    epsg_meter_based: str = "epsg:25832",
    partition_count: int | None = None,
    distance_meter_column: str = "distance",
    max_meter: float = 5000,
    join_type: str = "leftouter",
    closest_point_column_1: str | None = None,
    closest_point_column_2: str | None = None,
    cell_size: float | None = None,
    tie_breaker: Sequence[str] | None = None,
    widen: str | None = None,
    key_columns: Sequence[str] | None = None,
) -> DataFrame:
    """For every row of ``df_in_1`` the nearest row of ``df_in_2`` within ``max_meter``.

    Distances are planar in ``epsg_meter_based``; touching or overlapping
    geometries have distance 0. ``join_type`` is ``inner``, ``leftouter`` (unmatched
    left rows kept with NULLs), ``rightouter`` or ``fullouter`` (all right rows that
    no left row has within the radius are kept with NULLs). Optional closest points
    are returned in each side's own CRS. ``tie_breaker`` (right-side columns)
    makes the choice among equal distances deterministic. ``key_columns`` name
    left columns that are unique and not NULL; without them left rows are numbered once
    on a staged copy. ``cell_size`` (metres, the coarsest cells of the search; default
    ``max_meter``) only changes the work split. ``partition_count`` and ``widen`` are
    accepted for compatibility and change nothing.
    """
    how = join_type.lower().replace("_", "")
    how = {"left": "leftouter", "right": "rightouter", "outer": "fullouter", "full": "fullouter"}.get(how, how)
    if how not in ("inner", "leftouter", "rightouter", "fullouter"):
        raise ValueError(f"join_type must be 'inner', 'leftouter', 'rightouter' or 'fullouter', got {join_type!r}")
    check_for_duplicate_columns(df_in_1, df_in_2)
    radius, base = float(max_meter), float(cell_size or max_meter)
    left_cols, right_cols, ties = list(df_in_1.columns), list(df_in_2.columns), list(tie_breaker or [])

    shape_1 = G.reproject(_q(column_name_1), epsg_1, epsg_meter_based)
    shape_2 = G.reproject(_q(column_name_2), epsg_2, epsg_meter_based)
    vertex_count = lambda g: F.size(G.vertices(g)).cast("long")
    left_rows = _numbered(df_in_1, "__lk", key_columns, "nearest-left")
    right_rows = _numbered(df_in_2, "__rk", None, "nearest-right")
    tied = [_q(c).alias(f"__t{i}") for i, c in enumerate(ties)]

    def shapes(rows: DataFrame, key: str, shape: Column, k: str, *more: Column) -> DataFrame:
        """Key, geometry, box, number of vertices and samples, reprojected and boxed once, in tasks of few rows."""
        g = f"g{k}"
        dealt = _spread(rows).select(_q(f"__{key}").alias(key), shape.alias(g), *more).where(f"{g} IS NOT NULL")
        columns = [G.bbox(g).alias(f"b{k}"), vertex_count(g).alias(f"n{k}"), _samples(g).alias(f"v{k}")]
        return materialize(dealt.select("*", *columns), "nearest-shapes")

    left = shapes(left_rows, "lk", shape_1, "1")
    right = shapes(right_rows, "rk", shape_2, "2", *tied)
    names = [f"__t{i}" for i in range(len(ties))]
    wanted = (closest_point_column_1 is not None, closest_point_column_2 is not None)
    found = _nearest_pairs(left, right, radius, base, names, wanted)
    found = found.select(F.col("lk").alias("__lk"), F.col("rk").alias("__rk"), *[c for c in ("p1", "p2") if c in found.columns])

    right_side = right_rows.select("__rk", *[_q(c) for c in right_cols])
    matched = found.join(right_side, "__rk")
    joined = left_rows.join(matched, "__lk", "left" if how in ("leftouter", "fullouter") else "inner")
    out = [_q(c) for c in left_cols + right_cols] + [F.col("p1.d").alias(distance_meter_column)]
    for column, point, crs in ((closest_point_column_1, "p1", epsg_1), (closest_point_column_2, "p2", epsg_2)):
        if column:
            x, y = G.reproject_xy(F.col(f"{point}.x"), F.col(f"{point}.y"), epsg_meter_based, crs)
            out.append(F.when(F.col(f"{point}.d").isNotNull(), G.point(x, y)).alias(column))
    result = joined.select(*out)
    if how in ("rightouter", "fullouter"):
        # the same search from the right side tells which right rows have company; a reach below the radius tells it at once
        asking = right.select(F.col("rk").alias("lk"), *[F.col(f"{c}2").alias(f"{c}1") for c in "gbnv"])
        company = left.select(F.col("lk").alias("rk"), *[F.col(f"{c}1").alias(f"{c}2") for c in "gbnv"])
        known = materialize(_reach_bounds(_spread(asking.select("lk", "b1", "v1"), "lk"), company, radius, base), "company")
        known = known.where(F.col("reach") < radius).select("lk")
        flip = _nearest_pairs(materialize(asking.join(known, "lk", "left_anti"), "no-company-yet"), company, radius, base, [], (False, False))
        flip = flip.select("lk").unionByName(known)
        alone = right_side.join(flip.select(F.col("lk").alias("__rk")), "__rk", "left_anti").drop("__rk")
        result = result.unionByName(alone, allowMissingColumns=True)
    return result
