"""Distances measured as arrays against the row-wise SQL expression."""

import random

from pyspark.sql import functions as F
from pyspark.sql import types as T

from mapweave.functions import geometry as G
from mapweave.operators import measure as M
from mapweave.operators import spatial as S
from mapweave.schema import GEOM_TYPE


def _shapes(rng, n):
    """Points, lines, polygons with holes and multipolygons on a small grid, so that many touch, cross or hold each other."""
    at = lambda: (float(rng.randint(0, 6)), float(rng.randint(0, 6)))
    out = []
    for _ in range(n):
        kind = rng.choice(["Point", "LineString", "Polygon", "MultiPolygon", "Empty", "Null"])
        if kind == "Null":
            out.append(None)
        elif kind == "Empty":
            out.append(("LineString", []))
        elif kind == "Point":
            out.append((kind, [[[at()]]]))
        elif kind == "LineString":
            out.append((kind, [[[at() for _ in range(rng.randint(1, 4))]]]))
        else:
            parts = []
            for _ in range(1 if kind == "Polygon" else 2):
                (x, y), w = at(), rng.random() * 3
                ring = lambda r, x=x, y=y: [(x - r, y - r), (x + r, y), (x, y + r), (x - r, y - r)]
                parts.append([ring(w), ring(w / 4)] if rng.random() < 0.5 else [ring(w)])
            out.append((kind, parts))
    return out


def test_arrays_measure_what_the_expression_measures(spark):
    rng = random.Random(4)
    rows = [(i, a, b) for i, (a, b) in enumerate(zip(_shapes(rng, 1500), _shapes(rng, 1500), strict=True))]
    schema = T.StructType([T.StructField("i", T.IntegerType()), T.StructField("a", GEOM_TYPE), T.StructField("b", GEOM_TYPE)])
    pairs = spark.createDataFrame(rows, schema)
    want = pairs.select("i", G.closest_on_first("a", "b").alias("p1"), G.closest_on_first("b", "a").alias("p2"))
    assert sorted(M.measured(pairs, "a", "b", both=True).collect()) == sorted(want.collect())
    small, M.STEP_TESTS = M.STEP_TESTS, 7
    try:
        assert sorted(M.measured(pairs, "a", "b").collect()) == sorted(want.drop("p2").collect())
    finally:
        M.STEP_TESTS = small


def test_cells_are_no_wider_than_areas_of_few_edges(spark):
    ring = F.array(*[G.vertex(F.lit(float(x)), F.lit(float(y))) for x, y in ((0, 0), (3000, 0), (3000, 3000), (0, 3000), (0, 0))])
    edges = S.area_edges(spark.range(1).select(F.lit(1).alias("k"), G.polygon(ring).alias("g")), "g", "k")
    assert S.cell_index(edges, "k").grid.cell_size <= 1024


def test_search_is_dealt_by_rows(spark):
    # one file of many rows used to be one task, whose memory grew with the rows
    assert S._spread(spark.range(4 * S.TASK_ROWS + 1, numPartitions=1)).rdd.getNumPartitions() == 5
