"""Registered queries (Spark) and their DuckDB oracles.

Each query takes ``(spark, sf_dir)``, reads the benchmark tables there (or
frames Spark derives from them) and returns a DataFrame of scalar columns.
``ORACLES[name]`` is DuckDB SQL over the same tables giving the same rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mapweave.functions import geometry as G
from mapweave.functions.housenumber import expand_house_numbers
from mapweave.operators import columns as C
from mapweave.operators import pieces as P
from mapweave.operators import spatial as S
from mapweave.operators.repair import make_valid
from mapweave.plans import fixtures as FX
from mapweave.plans import oracle as O

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# cell edge (degrees) used by the fixture point-in-area queries
FIXTURE_CELL = 0.25


def query(name: str, oracle: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return register


def diamond(cx: str, cy: str, r: str, h: str):
    """Diamond polygon geometry with an optional diamond hole (h > 0)."""
    x, y = F.col(cx), F.col(cy)

    def ring(rad):
        return F.array(
            G.vertex(x + rad, y), G.vertex(x, y + rad), G.vertex(x - rad, y), G.vertex(x, y - rad), G.vertex(x + rad, y)
        )

    no_holes = F.array().cast("array<array<struct<x:double,y:double>>>")
    holes = F.when(F.col(h) > 0, F.array(ring(F.col(h)))).otherwise(no_holes)
    return G.polygon(ring(F.col(r)), holes)


def _areas_geom(df: DataFrame) -> DataFrame:
    return df.withColumn("geom", diamond("cx", "cy", "r", "h"))


# ------------------------------------------------------------------ generic column operators


@query(
    "prefix_columns",
    "SELECT c_custkey AS cus_c_custkey, c_name AS cus_c_name, c_nationkey AS cus_c_nationkey FROM customer",
)
def q_prefix_columns(spark, d):
    return C.add_column_prefix(FX.table(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey"), "cus_")


@query(
    "wrap_struct",
    "SELECT c_custkey, c_name AS info_c_name, c_nationkey AS info_c_nationkey FROM customer",
)
def q_wrap_struct(spark, d):
    customers = FX.table(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey")
    wrapped = C.wrap_columns_into_struct(customers, ["c_name", "c_nationkey"], "info")
    return wrapped.select("c_custkey", F.col("info.c_name").alias("info_c_name"), F.col("info.c_nationkey").alias("info_c_nationkey"))


@query(
    "explode_scalar",
    """SELECT vec_id, CAST(i AS INT) AS pos, CAST(embedding[i + 1] AS DOUBLE) AS value, label
       FROM embeddings, range(len(embedding)) t(i)""",
)
def q_explode_scalar(spark, d):
    df = FX.table(spark, d, "embeddings").select("vec_id", "embedding", "label")
    out = C.explode_col(df, "embedding", explode_prefix="value", position_column_name="pos")
    return out.withColumn("value", F.col("value").cast("double"))


@query(
    "explode_struct",
    """SELECT l_orderkey,
              CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_quantity) - 1 AS INT) AS pos,
              l_linenumber AS item_l_linenumber, l_partkey AS item_l_partkey, l_quantity AS item_l_quantity
       FROM lineitem""",
)
def q_explode_struct(spark, d):
    li = FX.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    wrapped = C.wrap_columns_into_struct(li, ["l_linenumber", "l_partkey", "l_quantity"], "item")
    lists = C.aggregate_column_to_list(wrapped, ["l_orderkey"], "item", "items")
    return C.explode_col(lists, "items", explode_prefix="item_", position_column_name="pos")


@query(
    "collect_sorted",
    """SELECT l_orderkey, string_agg(CAST(l_partkey AS VARCHAR), ',' ORDER BY l_partkey) AS parts,
              CAST(count(*) AS INT) AS n_parts
       FROM lineitem GROUP BY l_orderkey""",
)
def q_collect_sorted(spark, d):
    li = FX.table(spark, d, "lineitem").select("l_orderkey", "l_partkey")
    lists = C.aggregate_column_to_list(li, ["l_orderkey"], "l_partkey", "parts")
    return lists.select(
        "l_orderkey",
        F.concat_ws(",", F.transform("parts", lambda x: x.cast("string"))).alias("parts"),
        F.size("parts").alias("n_parts"),
    )


@query(
    "collect_unsorted",
    """SELECT l_orderkey, CAST(count(*) AS INT) AS n_items, sum(l_quantity) AS qty
       FROM lineitem GROUP BY l_orderkey""",
)
def q_collect_unsorted(spark, d):
    li = FX.table(spark, d, "lineitem").select("l_orderkey", "l_quantity")
    lists = C.aggregate_column_to_list(li, ["l_orderkey"], "l_quantity", "qs", sort_list=False)
    return lists.select(
        "l_orderkey",
        F.size("qs").alias("n_items"),
        F.aggregate(F.array_sort("qs"), F.lit(0.0), lambda a, b: a + b).alias("qty"),
    )


_DEDUPE_SQL = """SELECT o_custkey, o_orderkey, o_totalprice, o_orderstatus FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice {dir} NULLS LAST, o_orderkey) AS rn
  FROM orders) t WHERE rn = 1"""


@query("dedupe_max", _DEDUPE_SQL.format(dir="DESC"))
def q_dedupe_max(spark, d):
    o = FX.table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderstatus")
    return C.remove_duplicate_rows(o, "o_custkey", "o_totalprice", True, tie_breaker=["o_orderkey"])


@query("dedupe_min", _DEDUPE_SQL.format(dir="ASC"))
def q_dedupe_min(spark, d):
    o = FX.table(spark, d, "orders").alias("o").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderstatus")
    return C.remove_duplicate_rows(o.alias("t"), "t.o_custkey", "o_totalprice", False, tie_breaker=["o_orderkey"])


# ------------------------------------------------------------------ house numbers

_HOUSE_SQL = """WITH h AS (SELECT CAST(o_orderkey AS BIGINT) AS id, o_orderkey % 8 AS arm,
                                  CAST(1 + o_orderkey % 50 AS BIGINT) AS n FROM orders)
SELECT id, CAST(v AS VARCHAR) AS housenumber FROM (
  SELECT id, unnest(CASE arm
    WHEN 0 THEN [CAST(n AS VARCHAR)]
    WHEN 1 THEN [CAST(n AS VARCHAR), CAST(n + 2 AS VARCHAR), CAST(n + 4 AS VARCHAR), CAST(n AS VARCHAR) || '-' || CAST(n + 4 AS VARCHAR)]
    WHEN 2 THEN [CAST(n AS VARCHAR), CAST(n + 1 AS VARCHAR), CAST(n + 2 AS VARCHAR), CAST(n + 3 AS VARCHAR),
                 CAST(n AS VARCHAR) || '-' || CAST(n + 3 AS VARCHAR)]
    WHEN 3 THEN [CAST(n + 5 AS VARCHAR), CAST(n AS VARCHAR), CAST(n + 5 AS VARCHAR) || '-' || CAST(n AS VARCHAR)]
    WHEN 4 THEN [CAST(n AS VARCHAR) || 'a', CAST(n AS VARCHAR) || 'b', CAST(n AS VARCHAR) || 'c', CAST(n AS VARCHAR) || 'a-c']
    WHEN 5 THEN [CAST(n AS VARCHAR) || 'a', CAST(n AS VARCHAR) || 'b', CAST(n AS VARCHAR) || 'a-' || CAST(n AS VARCHAR) || 'b']
    WHEN 6 THEN [CAST(n AS VARCHAR), CAST(n + 1 AS VARCHAR), CAST(n AS VARCHAR) || ', ' || CAST(n + 1 AS VARCHAR)]
    ELSE [CAST(n AS VARCHAR), CAST(n + 1 AS VARCHAR), CAST(n AS VARCHAR) || '/' || CAST(n + 1 AS VARCHAR)] END) AS v
  FROM h) t"""


@query("house_numbers", _HOUSE_SQL)
def q_house_numbers(spark, d):
    house = FX.fx_house(spark, d)
    return house.select("id", F.explode_outer(expand_house_numbers("housenumber")).alias("housenumber"))


# ------------------------------------------------------------------ point in area

_PIA_SQL = O.with_(O.FX_POINTS, "{areas}") + """
SELECT p.point_id, a.area_id FROM fx_points p JOIN {name} a
  ON ABS(lon - cx) + ABS(lat - cy) < r AND NOT (h > 0 AND ABS(lon - cx) + ABS(lat - cy) <= h)"""


@query("point_in_area", _PIA_SQL.format(areas=O.FX_AREAS, name="fx_areas"))
def q_point_in_area(spark, d):
    pts = FX.fx_points(spark, d).select("point_id", G.point("lon", "lat").alias("pt"))
    areas = _areas_geom(FX.fx_areas(spark, d)).select("area_id", "geom")
    joined = S.join_point_in_area(pts, "pt", areas, "geom", area_key="area_id", cell_size=FIXTURE_CELL)
    return joined.select("point_id", "area_id")


@query("point_in_area_multi", _PIA_SQL.format(areas=O.FX_BIG_AREAS, name="fx_big_areas"))
def q_point_in_area_multi(spark, d):
    pts = FX.fx_points(spark, d).select("point_id", G.point("lon", "lat").alias("pt"))
    areas = _areas_geom(FX.fx_big_areas(spark, d)).select("area_id", "geom")
    joined = S.join_point_in_area(pts, "pt", areas, "geom", area_key="area_id", cell_size=FIXTURE_CELL)
    return joined.select("point_id", "area_id")


_GRID_SQL = """SELECT CAST(s_suppkey AS INT) AS area_id, CAST(2 * (s_suppkey % 100) + 1 AS DOUBLE) AS cx,
       CAST(46 + 2 * CAST(floor(s_suppkey / 100) AS INT) AS DOUBLE) AS cy FROM supplier"""


def _grid(spark, d):
    """A place of its own for every supplier."""
    return FX.table(spark, d, "supplier").selectExpr(
        "CAST(s_suppkey AS INT) AS area_id", "CAST(2 * (s_suppkey % 100) + 1 AS DOUBLE) AS cx",
        "CAST(46 + 2 * CAST(floor(s_suppkey / 100) AS INT) AS DOUBLE) AS cy", "0.9D AS r", "0.3D AS h",
    )


@query("area_centroids", f"SELECT area_id, ROUND(cx, 6) AS cx, ROUND(cy, 6) AS cy FROM ({_GRID_SQL})")
def q_area_centroids(spark, d):
    areas = _areas_geom(_grid(spark, d)).select("area_id", "geom")
    cents = S.edge_centroids(S.area_edges(areas, "geom", "area_id"), "area_id")
    return cents.select("area_id", F.round("cx", 6).alias("cx"), F.round("cy", 6).alias("cy"))


# ------------------------------------------------------------------ reprojection and nearest

_E, _N = O.utm_sql("lon", "lat")


@query(
    "reproject_utm",
    O.with_(O.FX_POINTS) + f"SELECT point_id, ROUND({_E}, 3) AS easting, ROUND({_N}, 3) AS northing FROM fx_points",
)
def q_reproject_utm(spark, d):
    pts = FX.fx_points(spark, d)
    e, n = G.reproject_xy("lon", "lat", "epsg:4326", "epsg:25832")
    return pts.select("point_id", F.round(e, 3).alias("easting"), F.round(n, 3).alias("northing"))


# Lambert azimuthal and Web Mercator in their textbook form
_E2 = "0.006694380022900787"
_ECC = f"sqrt({_E2})"


def _q_sql(s: str) -> str:
    return f"(1 - {_E2}) * ({s} / (1 - {_E2} * {s} * {s}) - ln((1 - {_ECC} * {s}) / (1 + {_ECC} * {s})) / (2 * {_ECC}))"


@query(
    "reproject_systems",
    O.with_(
        O.FX_POINTS,
        f"k AS (SELECT {_q_sql('1.0')} AS qp, {_q_sql('sin(radians(52.0))')} AS q0, sin(radians(52.0)) AS s0, cos(radians(52.0)) AS c0)",
        "o AS (SELECT qp, 6378137.0 * sqrt(qp / 2) AS rq, asin(q0 / qp) AS b0, s0, c0 FROM k)",
        f"d AS (SELECT *, 6378137.0 * c0 / sqrt(1 - {_E2} * s0 * s0) / (rq * cos(b0)) AS d FROM o)",
        f"p AS (SELECT point_id, lon, lat, radians(lon - 10) AS lam, asin(({_q_sql('sin(radians(lat))')}) / qp) AS b, rq, b0, d FROM fx_points, d)",
        "r AS (SELECT *, rq * sqrt(2 / (1 + sin(b0) * sin(b) + cos(b0) * cos(b) * cos(lam))) AS w FROM p)",
    )
    + """SELECT point_id, ROUND(4321000 + w * d * cos(b) * sin(lam), 3) AS easting,
                ROUND(3210000 + w / d * (cos(b0) * sin(b) - sin(b0) * cos(b) * cos(lam)), 3) AS northing,
                ROUND(6378137.0 * radians(lon), 3) AS web_x, ROUND(6378137.0 * ln(tan(pi() / 4 + radians(lat) / 2)), 3) AS web_y,
                CAST(0 AS BIGINT) AS moved FROM r""",
)
def q_reproject_systems(spark, d):
    """Equal-area and Web Mercator coordinates; ``moved`` counts steps of 5 mm lost by way of a Gauss-Krueger zone."""
    pts = FX.fx_points(spark, d)
    e, n = G.reproject_xy("lon", "lat", "epsg:4326", "epsg:3035")
    x, y = G.reproject_xy("lon", "lat", "epsg:4326", "epsg:3857")
    gk = pts.select("point_id", e.alias("e"), n.alias("n"), x.alias("x"), y.alias("y"), *[
        c.alias(a) for c, a in zip(G.reproject_xy("lon", "lat", "epsg:4326", "epsg:31468"), ("gx", "gy"), strict=True)
    ])
    bx, by = G.reproject_xy("gx", "gy", "epsg:31468", "epsg:3857")
    moved = F.floor(F.hypot(bx - F.col("x"), by - F.col("y")) / 0.005).cast("long").alias("moved")
    return gk.select("point_id", F.round("e", 3).alias("easting"), F.round("n", 3).alias("northing"), F.round("x", 3).alias("web_x"), F.round("y", 3).alias("web_y"), moved)


def _nearest_sql(outer: bool, radius: float) -> str:
    join = "LEFT JOIN" if outer else "JOIN"
    return O.with_(
        O.FX_POINTS,
        O.FX_SITES,
        f"p AS (SELECT point_id, {_E} AS e, {_N} AS n FROM fx_points)",
        f"s AS (SELECT site_id, {_E} AS e, {_N} AS n FROM fx_sites)",
        f"""c AS (SELECT p.point_id, s.site_id,
                         SQRT((p.e - s.e) * (p.e - s.e) + (p.n - s.n) * (p.n - s.n)) AS d
                  FROM p, s)""",
        f"""b AS (SELECT *, row_number() OVER (PARTITION BY point_id ORDER BY d, site_id) AS rn
                  FROM c WHERE d <= {radius})""",
    ) + f"""SELECT p.point_id, b.site_id, ROUND(b.d, 3) AS distance
            FROM p {join} b ON p.point_id = b.point_id AND b.rn = 1"""


def _nearest(spark, d, how: str, cell: float | None):
    pts = FX.fx_points(spark, d).select("point_id", G.point("lon", "lat").alias("pt"))
    sites = FX.fx_sites(spark, d).select("site_id", G.point("lon", "lat").alias("site"))
    out = S.join_nearest_geometry(
        pts, sites, "pt", "site", max_meter=50000, join_type=how, cell_size=cell, tie_breaker=["site_id"]
    )
    return out.select("point_id", "site_id", F.round("distance", 3).alias("distance"))


@query("nearest_left", _nearest_sql(True, 50000))
def q_nearest_left(spark, d):
    return _nearest(spark, d, "leftouter", None)


@query("nearest_inner", _nearest_sql(False, 50000))
def q_nearest_inner(spark, d):
    return _nearest(spark, d, "inner", None)


@query("nearest_cells", _nearest_sql(True, 50000))
def q_nearest_cells(spark, d):
    return _nearest(spark, d, "leftouter", 7000.0)


# ------------------------------------------------------------------ address unification


@query(
    "address_unify",
    O.with_(O.FX_POINTS)
    + """SELECT segment AS street, CAST(1 + point_id % 50 AS VARCHAR) AS housenumber,
              ROUND(avg(lon), 6) AS longitude, ROUND(avg(lat), 6) AS latitude
       FROM fx_points GROUP BY 1, 2""",
)
def q_address_unify(spark, d):
    from mapweave.plans.addresses import unify_addresses

    pts = FX.fx_points(spark, d).select(
        F.col("segment").alias("street"),
        (1 + F.col("point_id") % 50).cast("string").alias("housenumber"),
        F.col("lon").alias("longitude"),
        F.col("lat").alias("latitude"),
    )
    out = unify_addresses(pts)
    return out.select("street", "housenumber", F.round("longitude", 6).alias("longitude"), F.round("latitude", 6).alias("latitude"))


# ------------------------------------------------------------------ entity tables

from mapweave.operators.areas import assemble_areas  # noqa: E402
from mapweave.operators.features import extract_features, way_geometries  # noqa: E402
from mapweave.plans.addresses import ADDRESS_FILTER, AddressConfig, build_address_list  # noqa: E402

_ENTITY_CTES = (O.FX_POINTS, O.FX_SITES, O.FX_AREAS, O.FX_NODES, O.FX_WAYS)


def _size0(c: str):
    return F.coalesce(F.size(F.col(c)), F.lit(0))


@query(
    "scan_split_counts",
    """SELECT CAST(0 AS TINYINT) AS type,
              (SELECT 8 * count(*) FROM nation) + (SELECT count(*) FROM customer) + (SELECT 4 * count(*) FROM supplier) AS n_rows,
              CAST(0 AS BIGINT) AS n_node_refs, CAST(0 AS BIGINT) AS n_members
       UNION ALL
       SELECT CAST(1 AS TINYINT), (SELECT 5 * count(*) FROM nation) + (SELECT count(*) FROM supplier),
              (SELECT 13 * count(*) FROM nation)
              + (SELECT sum(CASE s_suppkey % 4 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 5 END) FROM supplier),
              CAST(0 AS BIGINT)
       UNION ALL
       SELECT CAST(2 AS TINYINT), (SELECT count(*) FROM nation), CAST(0 AS BIGINT),
              (SELECT 6 * count(*) - 2 FROM nation)""",
)
def q_scan_split_counts(spark, d):
    m = FX.split_entities(FX.fx_entities(spark, d))
    parts = []
    for kind, frame in enumerate((m.nodes, m.ways, m.relations)):
        parts.append(
            frame.agg(
                F.lit(kind).cast("tinyint").alias("type"),
                F.count(F.lit(1)).alias("n_rows"),
                F.sum(_size0("nodes")).cast("bigint").alias("n_node_refs"),
                F.sum(_size0("relations")).cast("bigint").alias("n_members"),
            )
        )
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


_CITY_NAMES = "('NATION_0', 'NATION_9')"
FIXTURE_CITY_FILTER = (
    "element_at(tags, 'boundary') = 'administrative' AND "
    "try_cast(element_at(tags, 'admin_level') AS INT) IN (8,6) OR "
    "(try_cast(element_at(tags, 'admin_level') AS INT) = 4 AND "
    f"element_at(tags, 'name') IN {_CITY_NAMES})"
)
_CITY_SQL = f"(level IN (8, 6) OR (level = 4 AND n_name IN {_CITY_NAMES}))"


@query(
    "tag_filter",
    O.with_(O.FX_AREAS, O.FX_LEVELS)
    + f"""SELECT CAST(1000 + area_id AS BIGINT) AS id, n_name AS name, admin_level
          FROM fx_levels WHERE {_CITY_SQL}""",
)
def q_tag_filter(spark, d):
    rel = FX.fx_map(spark, d).relations.where(FIXTURE_CITY_FILTER)
    return rel.select("id", F.element_at("tags", "name").alias("name"), F.element_at("tags", "admin_level").alias("admin_level"))


@query(
    "member_way_join",
    """WITH m AS (SELECT * FROM (VALUES (0, 2, 'outer'), (1, -1, 'admin_centre'), (2, 0, 'outer'), (3, 4, 'inner'),
                                       (4, 1, 'outer'), (5, 3, 'outer')) v(p, w, role))
       SELECT CAST(1000 + n_nationkey AS BIGINT) AS id,
              CAST(p - CASE WHEN n_nationkey = 23 AND p > 3 THEN 1 ELSE 0 END AS INT) AS member_pos,
              CAST(n_nationkey * 10 + w AS BIGINT) AS way_id, role AS way_role,
              CAST(CASE WHEN w = 4 THEN 5 ELSE 2 END AS INT) AS n_nodes
       FROM nation, m
       WHERE role IN ('inner', 'outer') AND NOT (n_nationkey = 24 AND w = 3) AND NOT (n_nationkey = 23 AND w = 4)""",
)
def q_member_way_join(spark, d):
    m = FX.fx_map(spark, d)
    members = C.explode_col(m.relations.select("id", "relations"), "relations", "way_", position_column_name="member_pos")
    members = members.where(F.col("way_role").isin("inner", "outer"))
    ways = C.add_column_prefix(m.ways.select("id", "nodes"), "way_")
    joined = members.join(ways, ["way_id"])
    return joined.select("id", "member_pos", "way_id", "way_role", F.size("way_nodes").alias("n_nodes"))


@query(
    "way_node_join",
    O.with_(*_ENTITY_CTES, O.FX_WAY_VERTS)
    + "SELECT way_id, pos AS node_pos, node_id, ROUND(x, 6) AS lon, ROUND(y, 6) AS lat FROM fx_way_verts",
)
def q_way_node_join(spark, d):
    m = FX.fx_map(spark, d)
    exploded = C.explode_col(m.ways.select("id", "nodes"), "nodes", "node_id", position_column_name="node_pos")
    nodes = C.add_column_prefix(m.nodes.select("id", "longitude", "latitude"), "n_")
    joined = exploded.join(nodes, F.col("node_id") == F.col("n_id"))
    return joined.select(
        F.col("id").alias("way_id"),
        "node_pos",
        "node_id",
        F.round("n_longitude", 6).alias("lon"),
        F.round("n_latitude", 6).alias("lat"),
    )


@query(
    "way_geometry_kind",
    O.with_(*_ENTITY_CTES, O.FX_WAY_VERTS)
    + """SELECT way_id AS id,
              CASE WHEN count(*) = 1 THEN 'Point'
                   WHEN count(*) >= 4 AND arg_min(x, pos) = arg_max(x, pos) AND arg_min(y, pos) = arg_max(y, pos)
                   THEN 'Polygon' ELSE 'LineString' END AS kind,
              CAST(count(*) AS INT) AS n_points
       FROM fx_way_verts GROUP BY way_id""",
)
def q_way_geometry_kind(spark, d):
    m = FX.fx_map(spark, d)
    geoms = way_geometries(m.ways.select("id", "nodes"), m.nodes, "geom")
    return geoms.select("id", G.geom_kind("geom").alias("kind"), F.size(G.vertices("geom")).alias("n_points"))


_FEATURES_SQL = """features AS (
  SELECT 'N' || CAST(1000000 + point_id AS VARCHAR) AS id, segment AS street,
         CAST(1 + point_id % 50 AS VARCHAR) AS housenumber, lon AS x, lat AS y
  FROM fx_points
  UNION ALL
  SELECT 'W' || CAST(5000 + site_id AS VARCHAR), 'Site', CAST(site_id AS VARCHAR),
         CASE site_id % 4 WHEN 1 THEN lon WHEN 2 THEN lon + 0.005 ELSE lon + 0.0075 END,
         CASE site_id % 4 WHEN 1 THEN lat WHEN 2 THEN lat + 0.005 ELSE lat + 0.0025 END
  FROM fx_sites)"""


@query(
    "features_union",
    O.with_(O.FX_POINTS, O.FX_SITES, _FEATURES_SQL)
    + "SELECT id, street, housenumber, ROUND(x, 6) AS lon, ROUND(y, 6) AS lat FROM features",
)
def q_features_union(spark, d):
    feats = extract_features(
        FX.fx_map(spark, d),
        ADDRESS_FILTER,
        {"street": "element_at(tags, 'addr:street')", "housenumber": "element_at(tags, 'addr:housenumber')"},
        id_column="id",
        centroid_column="pt",
    )
    return feats.select(
        "id", "street", "housenumber", F.round(G.geom_x("pt"), 6).alias("lon"), F.round(G.geom_y("pt"), 6).alias("lat")
    )


FIXTURE_AREA_FILTER = "element_at(tags, 'type') = 'boundary'"


@query(
    "area_assembly_stats",
    """SELECT CAST(1000 + n_nationkey AS BIGINT) AS id, n_name AS name,
              1 AS outer_polygon_count, CASE WHEN n_nationkey = 23 THEN 0 ELSE 1 END AS inner_polygon_count,
              5 AS outer_point_count, CASE WHEN n_nationkey = 23 THEN 0 ELSE 5 END AS inner_point_count
       FROM nation WHERE n_nationkey <> 24""",
)
def q_area_assembly_stats(spark, d):
    areas = assemble_areas(
        FX.fx_map(spark, d), FIXTURE_AREA_FILTER, {"name": "element_at(tags, 'name')"}, add_debug_columns=True,
        cell_size=FIXTURE_CELL,
    )
    return areas.areas.select(
        "id", "name", "outer_polygon_count", "inner_polygon_count", "outer_point_count", "inner_point_count"
    )


@query(
    "point_in_area_hole",
    O.with_(O.FX_POINTS, O.FX_AREAS)
    + """SELECT p.point_id, a.n_name AS name FROM fx_points p JOIN fx_areas a
           ON ABS(lon - cx) + ABS(lat - cy) < r AND a.area_id <> 24
          AND NOT (a.area_id <> 23 AND ABS(lon - cx) + ABS(lat - cy) <= h)""",
)
def q_point_in_area_hole(spark, d):
    areas = assemble_areas(
        FX.fx_map(spark, d), FIXTURE_AREA_FILTER, {"name": "element_at(tags, 'name')"}, cell_size=FIXTURE_CELL
    )
    pts = FX.fx_points(spark, d).select("point_id", G.point("lon", "lat").alias("pt"))
    return S.join_point_in_area(pts, "pt", areas, cell_size=FIXTURE_CELL).select("point_id", "name")


FIXTURE_ADDRESS_CONFIG = AddressConfig(
    postcode_filter=FIXTURE_AREA_FILTER,
    postcode_columns={"plz": "element_at(tags, 'name')"},
    city_filter=FIXTURE_CITY_FILTER,
    cell_size=FIXTURE_CELL,
)


@query(
    "address_list",
    O.with_(O.FX_POINTS, O.FX_SITES, O.FX_AREAS, O.FX_LEVELS, _FEATURES_SQL)
    + f"""SELECT f.street, a.n_name AS plz, a.n_name AS city, f.housenumber,
                 ROUND(avg(f.x), 6) AS longitude, ROUND(avg(f.y), 6) AS latitude
          FROM features f JOIN fx_areas a
            ON ABS(f.x - a.cx) + ABS(f.y - a.cy) < a.r AND a.area_id <> 24
           AND NOT (a.area_id <> 23 AND ABS(f.x - a.cx) + ABS(f.y - a.cy) <= a.h)
          JOIN fx_levels l ON l.area_id = a.area_id AND {_CITY_SQL.replace('level', 'l.level').replace('n_name', 'l.n_name')}
          GROUP BY 1, 2, 3, 4""",
)
def q_address_list(spark, d):
    out = build_address_list(FX.fx_map(spark, d), FIXTURE_ADDRESS_CONFIG)
    return out.select(
        "street", "plz", "city", "housenumber", F.round("longitude", 6).alias("longitude"), F.round("latitude", 6).alias("latitude")
    )


# ------------------------------------------------------------------ nearest area, closest points

_AREA_RADIUS = 30000


def _nearest_area_sql(with_points: bool) -> str:
    lon_sql, lat_sql = O.utm_inverse_sql("b.qx", "b.qy")
    proj = (
        "LEAST(GREATEST(((p.px - s.x1) * (s.x2 - s.x1) + (p.py - s.y1) * (s.y2 - s.y1)) / "
        "((s.x2 - s.x1) * (s.x2 - s.x1) + (s.y2 - s.y1) * (s.y2 - s.y1)), 0.0), 1.0)"
    )
    ctes = [
        O.FX_POINTS,
        O.FX_AREAS,
        f"p AS (SELECT point_id, {_E} AS px, {_N} AS py FROM fx_points)",
        O.diamond_segments_cte(),
        f"""c AS (SELECT p.point_id, s.area_id, p.px, p.py, s.x1 + {proj} * (s.x2 - s.x1) AS qx,
                         s.y1 + {proj} * (s.y2 - s.y1) AS qy,
                         CASE WHEN ((s.y1 > p.py) != (s.y2 > p.py))
                               AND p.px < (s.x2 - s.x1) * (p.py - s.y1) / (s.y2 - s.y1) + s.x1 THEN 1 ELSE 0 END AS hit
                  FROM p, fx_area_segs s)""",
        """pa AS (SELECT point_id, area_id, sum(hit) % 2 = 1 AS inside,
                         arg_min(struct_pack(qx := qx, qy := qy), sqrt((px - qx) * (px - qx) + (py - qy) * (py - qy))) AS q,
                         min(sqrt((px - qx) * (px - qx) + (py - qy) * (py - qy))) AS dmin, any_value(px) AS px, any_value(py) AS py
                  FROM c GROUP BY point_id, area_id)""",
        """pd AS (SELECT point_id, area_id, CASE WHEN inside THEN 0.0 ELSE dmin END AS d,
                         CASE WHEN inside THEN px ELSE q.qx END AS qx, CASE WHEN inside THEN py ELSE q.qy END AS qy
                  FROM pa)""",
        f"""b AS (SELECT *, row_number() OVER (PARTITION BY point_id ORDER BY d, area_id) AS rn
                  FROM pd WHERE d <= {_AREA_RADIUS})""",
    ]
    cols = "p.point_id, b.area_id, ROUND(b.d, 3) AS distance"
    if with_points:
        cols += f", ROUND({lon_sql}, 6) AS near_lon, ROUND({lat_sql}, 6) AS near_lat"
    return O.with_(*ctes) + f"SELECT {cols} FROM p LEFT JOIN b ON p.point_id = b.point_id AND b.rn = 1"


def _nearest_area(spark, d, with_points: bool):
    pts = FX.fx_points(spark, d).select("point_id", G.point("lon", "lat").alias("pt"))
    areas = _areas_geom(FX.fx_areas(spark, d)).select("area_id", "geom")
    out = S.join_nearest_geometry(
        pts, areas, "pt", "geom", max_meter=_AREA_RADIUS, join_type="leftouter", tie_breaker=["area_id"],
        closest_point_column_2="near" if with_points else None,
    )
    cols = [F.col("point_id"), F.col("area_id"), F.round("distance", 3).alias("distance")]
    if with_points:
        cols += [F.round(G.geom_x("near"), 6).alias("near_lon"), F.round(G.geom_y("near"), 6).alias("near_lat")]
    return out.select(*cols)


@query("nearest_area_distance", _nearest_area_sql(False))
def q_nearest_area_distance(spark, d):
    return _nearest_area(spark, d, False)


@query("closest_point", _nearest_area_sql(True))
def q_closest_point(spark, d):
    return _nearest_area(spark, d, True)


# ------------------------------------------------------------------ validity


@query(
    "invalid_areas",
    f"""SELECT area_id, CAST(1 AS BIGINT) AS n_crossings, ROUND(cx, 6) AS x, ROUND(cy, 6) AS y FROM ({_GRID_SQL}) WHERE area_id % 3 = 0""",
)
def q_invalid_areas(spark, d):
    """Diamonds with holes, and a self-crossing ring in every third place."""
    x, y = F.col("cx"), F.col("cy")
    ring = F.array(
        G.vertex(x - 1, y - 1), G.vertex(x + 1, y + 1), G.vertex(x + 1, y - 1), G.vertex(x - 1, y + 1), G.vertex(x - 1, y - 1)
    )
    grid = _areas_geom(_grid(spark, d))
    shapes = grid.select("area_id", F.when(F.col("area_id") % 3 == 0, G.polygon(ring)).otherwise(F.col("geom")).alias("geom"))
    report = S.invalid_areas(S.area_edges(shapes, "geom", "area_id"), "area_id", cell_size=FIXTURE_CELL)
    return report.select("area_id", "n_crossings", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"))


# ------------------------------------------------------------------ planar shapes that grow with the tables

# squares of customers and pairs of squares of suppliers, in metres of the metric system itself
_PLANE = "epsg:25832"
_PLANE_RADIUS = 4000.0
_SPOTS_SQL = """spots AS (
  SELECT CAST(c_custkey AS BIGINT) AS point_id, CAST((c_custkey * 7919) % 100003 AS DOUBLE) AS x,
         CAST((c_custkey * 104729) % 100019 AS DOUBLE) AS y FROM customer)"""
_BLOCKS_SQL = """blocks AS (
  SELECT CAST(s_suppkey AS BIGINT) AS block_id, CAST((s_suppkey * 6101 + 17) % 10007 AS DOUBLE) * 10 AS x,
         CAST((s_suppkey * 3571 + 29) % 10009 AS DOUBLE) * 10 AS y FROM supplier)"""
_SMALL, _BIG, _APART = 3.0, 250.0, 1500.0


def _spots(spark, d):
    return FX.table(spark, d, "customer").selectExpr(
        "CAST(c_custkey AS BIGINT) AS point_id",
        "CAST((c_custkey * 7919) % 100003 AS DOUBLE) AS x",
        "CAST((c_custkey * 104729) % 100019 AS DOUBLE) AS y",
    )


def _blocks(spark, d):
    return FX.table(spark, d, "supplier").selectExpr(
        "CAST(s_suppkey AS BIGINT) AS block_id",
        "CAST((s_suppkey * 6101 + 17) % 10007 AS DOUBLE) * 10 AS bx",
        "CAST((s_suppkey * 3571 + 29) % 10009 AS DOUBLE) * 10 AS by",
    )


def _box_ring(x, y, half: float):
    corners = [(-half, -half), (half, -half), (half, half), (-half, half), (-half, -half)]
    return F.array(*[G.vertex(x + dx, y + dy) for dx, dy in corners])


def _two_parts(x, y):
    """MultiPolygon of two squares, the second one to the east."""
    parts = F.array(F.array(_box_ring(x, y, _BIG)), F.array(_box_ring(x + _APART, y, _BIG)))
    return F.struct(F.lit("MultiPolygon").alias("kind"), parts.alias("parts"))


def _gap_sql(half: float, parts: bool) -> str:
    """Distance of a square of half width ``half`` around (p.x, p.y) from the block's square(s)."""
    one = (
        "sqrt(power(greatest(abs(p.x - {cx}) - {r}, 0), 2) + power(greatest(abs(p.y - b.y) - {r}, 0), 2))".format
    )
    r = _BIG + half
    first = one(cx="b.x", r=r)
    return f"least({first}, {one(cx=f'(b.x + {_APART})', r=r)})" if parts else first


def _plane_sql(half: float, parts: bool, full: bool, extra: str = "") -> str:
    near = O.with_(
        _SPOTS_SQL,
        _BLOCKS_SQL,
        f"c AS (SELECT p.point_id, b.block_id, p.x AS px, p.y AS py, b.x AS mx, b.y AS my, {_gap_sql(half, parts)} AS d FROM spots p, blocks b)",
        f"n AS (SELECT *, row_number() OVER (PARTITION BY point_id ORDER BY d, block_id) AS rn FROM c WHERE d <= {_PLANE_RADIUS})",
    )
    left = f"SELECT p.point_id, n.block_id, ROUND(n.d, 3) AS distance{extra} FROM spots p LEFT JOIN n ON n.point_id = p.point_id AND n.rn = 1"
    alone = " UNION ALL SELECT NULL, block_id, NULL FROM blocks WHERE block_id NOT IN (SELECT block_id FROM n)"
    return near + left + (alone if full else "")


@query("nearest_multi_part", _plane_sql(0.0, True, False))
def q_nearest_multi_part(spark, d):
    """Points to MultiPolygons of two parts."""
    spots = _spots(spark, d).select("point_id", G.point("x", "y").alias("pt"))
    blocks = _blocks(spark, d).select("block_id", _two_parts(F.col("bx"), F.col("by")).alias("geom"))
    out = S.join_nearest_geometry(
        spots, blocks, "pt", "geom", _PLANE, _PLANE, _PLANE, max_meter=_PLANE_RADIUS, tie_breaker=["block_id"], key_columns=["point_id"]
    )
    return out.select("point_id", "block_id", F.round("distance", 3).alias("distance"))


def _squares_join(spark, d, how: str, **more):
    squares = _spots(spark, d).select("point_id", G.polygon(_box_ring(F.col("x"), F.col("y"), _SMALL)).alias("sq"))
    blocks = _blocks(spark, d).select("block_id", _two_parts(F.col("bx"), F.col("by")).alias("geom"))
    return S.join_nearest_geometry(
        squares, blocks, "sq", "geom", _PLANE, _PLANE, _PLANE, max_meter=_PLANE_RADIUS, tie_breaker=["block_id"], join_type=how, **more
    )


@query("nearest_poly_poly", _plane_sql(_SMALL, True, False))
def q_nearest_poly_poly(spark, d):
    """Squares to MultiPolygons; a square inside either part has distance 0."""
    return _squares_join(spark, d, "leftouter").select("point_id", "block_id", F.round("distance", 3).alias("distance"))


@query("nearest_full", _plane_sql(_SMALL, True, True))
def q_nearest_full(spark, d):
    """Full outer: blocks without any square in the radius are kept."""
    return _squares_join(spark, d, "fullouter").select("point_id", "block_id", F.round("distance", 3).alias("distance"))


_STEPS = 32  # edges on each side of a square whose border is drawn finely


def _fine_ring(x, y, half: float):
    """Border of a square in edges of equal length, closed."""
    at = [half * (2 * i / _STEPS - 1) for i in range(_STEPS)]
    border = [(a, -half) for a in at] + [(half, a) for a in at] + [(-a, half) for a in at] + [(-half, -a) for a in at] + [(-half, -half)]
    offsets = F.expr(f"array({', '.join(f"named_struct('x', {dx}D, 'y', {dy}D)" for dx, dy in border)})")
    return F.transform(offsets, lambda o: G.vertex(x + o.getField("x"), y + o.getField("y")))


@query("nearest_large_areas", _plane_sql(_BIG, False, False))
def q_nearest_large_areas(spark, d):
    """Areas of many edges on both sides, measured piece by piece."""
    squares = _spots(spark, d).select("point_id", G.polygon(_fine_ring(F.col("x"), F.col("y"), _BIG)).alias("sq"))
    blocks = _blocks(spark, d).select("block_id", G.polygon(_fine_ring(F.col("bx"), F.col("by"), _BIG)).alias("geom"))
    out = S.join_nearest_geometry(
        squares, blocks, "sq", "geom", _PLANE, _PLANE, _PLANE, max_meter=_PLANE_RADIUS, tie_breaker=["block_id"], key_columns=["point_id"]
    )
    return out.select("point_id", "block_id", F.round("distance", 3).alias("distance"))


_HOLLOW, _WALL, _REACH = 700.0, 1500.0, 300.0


@query(
    "intersecting_shapes",
    O.with_(
        _SPOTS_SQL,
        _BLOCKS_SQL,
        f"""s AS (SELECT point_id, x, y, CASE WHEN point_id % 3 < 2 THEN {_REACH} ELSE 0 END AS hx,
                       CASE WHEN point_id % 3 = 0 THEN {_REACH} ELSE 0 END AS hy FROM spots)""",
    )
    + f"""SELECT point_id, block_id FROM s, blocks b
          WHERE abs(s.x - b.x) <= {_WALL} + hx AND abs(s.y - b.y) <= {_WALL} + hy
            AND NOT (abs(s.x - b.x) + hx < {_HOLLOW} AND abs(s.y - b.y) + hy < {_HOLLOW})""",
)
def q_intersecting_shapes(spark, d):
    """Squares, lines and points that meet squares with a hole."""
    x, y = F.col("x"), F.col("y")
    line = F.struct(F.lit("LineString").alias("kind"), F.array(F.array(F.array(G.vertex(x - _REACH, y), G.vertex(x + _REACH, y)))).alias("parts"))
    kind = F.col("point_id") % 3
    shape = F.when(kind == 0, G.polygon(_box_ring(x, y, _REACH))).when(kind == 1, line).otherwise(G.point("x", "y"))
    walls = G.polygon(_box_ring(F.col("bx"), F.col("by"), _WALL), F.array(_box_ring(F.col("bx"), F.col("by"), _HOLLOW)))
    shapes, blocks = _spots(spark, d).select("point_id", shape.alias("shape")), _blocks(spark, d).select("block_id", walls.alias("geom"))
    return P.join_intersecting(shapes, blocks, "shape", "geom").select("point_id", "block_id")


@query(
    "closest_point_left",
    O.with_(
        _SPOTS_SQL,
        _BLOCKS_SQL,
        f"c AS (SELECT p.point_id, b.block_id, p.x AS px, p.y AS py, b.x AS mx, b.y AS my, {_gap_sql(0.0, False)} AS d FROM spots p, blocks b)",
        f"n AS (SELECT *, row_number() OVER (PARTITION BY block_id ORDER BY d, point_id) AS rn FROM c WHERE d <= {_PLANE_RADIUS})",
    )
    + f"""SELECT block_id, point_id, ROUND(d, 3) AS distance,
              ROUND(CASE WHEN d = 0 THEN px ELSE least(greatest(px, mx - {_BIG}), mx + {_BIG}) END, 3) AS near_x,
              ROUND(CASE WHEN d = 0 THEN py ELSE least(greatest(py, my - {_BIG}), my + {_BIG}) END, 3) AS near_y
       FROM n WHERE rn = 1""",
)
def q_closest_point_left(spark, d):
    """Polygons on the left: the point of the polygon that is nearest to the matched point."""
    spots = _spots(spark, d).select("point_id", G.point("x", "y").alias("pt"))
    blocks = _blocks(spark, d).select("block_id", G.polygon(_box_ring(F.col("bx"), F.col("by"), _BIG)).alias("geom"))
    out = S.join_nearest_geometry(
        blocks, spots, "geom", "pt", _PLANE, _PLANE, _PLANE, max_meter=_PLANE_RADIUS, tie_breaker=["point_id"],
        join_type="inner", closest_point_column_1="near",
    )
    return out.select(
        "block_id", "point_id", F.round("distance", 3).alias("distance"),
        F.round(G.geom_x("near"), 3).alias("near_x"), F.round(G.geom_y("near"), 3).alias("near_y"),
    )


@query(
    "small_area_centroids",
    O.with_(O.FX_SITES) + "SELECT site_id, CAST(50 AS DOUBLE) AS dx, CAST(50 AS DOUBLE) AS dy FROM fx_sites",
)
def q_small_area_centroids(spark, d):
    """Squares of 11 metres far from the origin: the middle, in millionths of a degree from the corner."""
    sites = FX.fx_sites(spark, d)
    x, y, w = F.col("lon"), F.col("lat"), F.lit(1e-4)
    ring = F.array(G.vertex(x, y), G.vertex(x + w, y), G.vertex(x + w, y + w), G.vertex(x, y + w), G.vertex(x, y))
    squares = sites.select("site_id", "lon", "lat", G.polygon(ring).alias("geom"))
    middles = S.edge_centroids(S.area_edges(squares, "geom", "site_id"), "site_id")
    return middles.join(sites, "site_id").select(
        "site_id",
        F.round((F.col("cx") - F.col("lon")) * 1e6, 3).alias("dx"),
        F.round((F.col("cy") - F.col("lat")) * 1e6, 3).alias("dy"),
    )


@query(
    "house_number_parity",
    """SELECT CAST(o_orderkey AS BIGINT) AS id, CAST(o_orderkey % 2 AS INT) AS key_parity,
              CAST(CAST(floor(CAST(o_totalprice AS DOUBLE)) AS BIGINT) % 2 AS INT) AS price_parity,
              CAST(-1 AS INT) AS text_parity
       FROM orders""",
)
def q_house_number_parity(spark, d):
    from mapweave.functions.housenumber import parity

    orders = FX.table(spark, d, "orders").select("o_orderkey", F.col("o_totalprice").cast("double").alias("price"))
    return orders.select(
        F.col("o_orderkey").cast("bigint").alias("id"),
        parity("o_orderkey").alias("key_parity"),
        parity("price").alias("price_parity"),
        parity(F.concat(F.col("o_orderkey").cast("string"), F.lit(".0"))).alias("text_parity"),
    )


@query(
    "house_numbers_long",
    """WITH h AS (SELECT CAST(o_orderkey AS BIGINT) AS id, 12345678901234567000::HUGEINT + o_orderkey % 900 AS n, o_orderkey % 2 AS odd FROM orders)
       SELECT id, CAST(n + k AS VARCHAR) AS number FROM h, (VALUES (0, 0), (2, 0), (4, 0), (0, 1), (1, 1), (2, 1), (3, 1)) v(k, odd) WHERE v.odd = h.odd
       UNION ALL SELECT id, concat(n, '-', n + CASE odd WHEN 0 THEN 4 ELSE 3 END) FROM h""",
)
def q_house_numbers_long(spark, d):
    """Ranges of numbers of 20 digits."""
    orders = FX.table(spark, d, "orders").selectExpr(
        "CAST(o_orderkey AS BIGINT) AS id", "12345678901234567000BD + o_orderkey % 900 AS n", "o_orderkey % 2 AS odd"
    )
    text = orders.selectExpr("id", "concat(CAST(n AS string), '-', CAST(n + CASE odd WHEN 0 THEN 4 ELSE 3 END AS string)) AS h")
    return text.select("id", F.explode(expand_house_numbers("h")).alias("number"))


@query(
    "house_numbers_border",
    """WITH h AS (SELECT CAST(o_orderkey AS BIGINT) AS id, o_orderkey % 5 AS k, o_orderkey % 2 AS odd,
                         CASE WHEN o_orderkey % 3 = 0 THEN CAST(repeat('9', 37) AS HUGEINT) ELSE CAST(repeat('9', 38) AS HUGEINT) END AS top FROM orders),
            r AS (SELECT id, odd, top - k AS n, CASE odd WHEN 0 THEN 8 ELSE 7 END AS d FROM h)
       SELECT id, CAST(n + o.o AS VARCHAR) AS number FROM r, range(0, 9) o(o) WHERE o.o <= d AND (odd = 1 OR o.o % 2 = 0)
       UNION ALL SELECT id, concat(n, '-', n + d) FROM r""",
)
def q_house_numbers_border(spark, d):
    """Ranges that cross 10**37 and 10**38."""
    orders = FX.table(spark, d, "orders").selectExpr(
        "CAST(o_orderkey AS BIGINT) AS id", "o_orderkey % 5 AS k", "CASE o_orderkey % 2 WHEN 0 THEN 8 ELSE 7 END AS d",
        "CASE WHEN o_orderkey % 3 = 0 THEN 37 ELSE 38 END AS digits",
    )
    text = orders.selectExpr("id", "concat(repeat('9', digits - 1), 9 - k, '-1', repeat('0', digits - 1), d - 1 - k) AS h")
    return text.select("id", F.explode(expand_house_numbers("h")).alias("number"))


# relations of suppliers: a U-shaped border and one inner ring in an arm, across the notch or outside
_U_SHAPE = "array(0,0, 9,0, 9,9, 6,9, 6,3, 3,3, 3,9, 0,9, 0,0)"


def _u_map(spark, d):
    """One relation per supplier: two outer ways that close a U, one inner way; node 9 of every third U is unknown."""
    base = FX.table(spark, d, "supplier").selectExpr("CAST(s_suppkey AS BIGINT) AS s")
    corners = base.selectExpr("s", f"posexplode(transform(sequence(0, 7), i -> struct({_U_SHAPE}[2 * i] AS x, {_U_SHAPE}[2 * i + 1] AS y))) AS (j, v)")
    rings = "CASE s % 3 WHEN 0 THEN array(1,4, 2,4, 2,6, 1,6) WHEN 1 THEN array(1,5, 8,5, 8,6, 1,6) ELSE array(4,5, 5,5, 5,8, 4,8) END"
    inner = base.selectExpr("s", f"{rings} AS c").selectExpr(
        "s", "posexplode(transform(sequence(0, 3), i -> struct(c[2 * i] AS x, c[2 * i + 1] AS y))) AS (j, v)"
    )
    inner = inner.withColumn("j", F.col("j") + 20)
    nodes = corners.unionByName(inner).selectExpr(
        "s * 100 + j AS id", "CAST(s % 300 AS DOUBLE) + v.x / 20D AS longitude", "CAST(s DIV 300 AS DOUBLE) + v.y / 20D AS latitude"
    )
    ways = base.selectExpr(
        "s",
        """inline(array(named_struct('w', 0, 'js', array(0, 1, 2, 3, 4)), named_struct('w', 1, 'js', array(0, 7, 6, 5, 4)),
                        named_struct('w', 2, 'js', array(20, 21, 22, 23, 20))))""",
    ).selectExpr("s * 10 + w AS id", "transform(js, j -> s * 100 + j) AS nodes")
    relations = base.selectExpr(
        "s AS id",
        """array(named_struct('id', s * 10, 'relationType', 1Y, 'role', 'outer'),
                 named_struct('id', s * 10 + 2, 'relationType', 1Y, 'role', 'inner'),
                 named_struct('id', s * 10 + 1, 'relationType', 1Y, 'role', 'outer')) AS relations""",
        "map('type', 'boundary') AS tags",
    )
    return FX.MapFrames(nodes=FX._pad(nodes, 0), ways=FX._pad(ways, 1), relations=FX._pad(relations, 2))


@query(
    "area_hole_edges",
    """SELECT CAST(s_suppkey AS BIGINT) AS id, CAST(1 AS INT) AS outer_polygon_count, CAST(1 AS INT) AS inner_polygon_count,
              CAST(9 AS INT) AS outer_point_count, CAST(CASE s_suppkey % 3 WHEN 0 THEN 5 ELSE 0 END AS INT) AS inner_point_count
       FROM supplier""",
)
def q_area_hole_edges(spark, d):
    """Only an inner ring that lies wholly in the U is a hole; one from arm to arm across the notch is none."""
    areas = assemble_areas(_u_map(spark, d), "element_at(tags, 'type') = 'boundary'", {}, add_debug_columns=True, cell_size=0.1).areas
    return areas.select("id", "outer_polygon_count", "inner_polygon_count", "outer_point_count", "inner_point_count")


@query(
    "invalid_area_kinds",
    """WITH s AS (SELECT CAST(s_suppkey AS BIGINT) AS area_id, CAST(s_suppkey % 200 AS DOUBLE) * 100 AS x,
                         CAST(s_suppkey // 200 AS DOUBLE) * 100 AS y FROM supplier)
       SELECT area_id,
              CASE area_id % 5 WHEN 1 THEN concat('Self-intersection[', x + 20, ' ', y, ']')
                               WHEN 2 THEN concat('Nested shells[', x + 10, ' ', y + 10, ']')
                               WHEN 3 THEN concat('Self-intersection[', x + 20, ' ', y + 20, ']')
              END AS invalidity_explain
       FROM s WHERE area_id % 5 IN (1, 2, 3)""",
)
def q_invalid_area_kinds(spark, d):
    """Squares that share a stretch of border, nested shells, bow ties; islands in holes and neighbours at a corner are valid."""
    base = FX.table(spark, d, "supplier").selectExpr(
        "CAST(s_suppkey AS BIGINT) AS area_id", "CAST(s_suppkey % 200 AS DOUBLE) * 100 AS x", "CAST(s_suppkey DIV 200 AS DOUBLE) * 100 AS y"
    )
    x, y, kind = F.col("x"), F.col("y"), F.col("area_id") % 5

    def box(dx, dy, w):
        return F.array(*[G.vertex(x + dx + i, y + dy + j) for i, j in ((0, 0), (w, 0), (w, w), (0, w), (0, 0))])

    tie = F.array(*[G.vertex(x + i, y + j) for i, j in ((0, 0), (40, 40), (40, 0), (0, 40), (0, 0))])
    parts = (
        F.when(kind == 1, F.array(F.array(box(0, 0, 40)), F.array(box(20, 0, 40))))
        .when(kind == 2, F.array(F.array(box(0, 0, 40)), F.array(box(10, 10, 10))))
        .when(kind == 3, F.array(F.array(tie)))
        .when(kind == 4, F.array(F.array(box(0, 0, 40), box(10, 10, 20)), F.array(box(15, 15, 5))))
        .otherwise(F.array(F.array(box(0, 0, 20)), F.array(box(20, 20, 20))))
    )
    shapes = base.select("area_id", F.struct(F.lit("MultiPolygon").alias("kind"), parts.alias("parts")).alias("geom"))
    report = S.invalid_areas(S.area_edges(shapes, "geom", "area_id"), "area_id", cell_size=25.0)
    return report.select("area_id", "invalidity_explain")


# invalid shapes of suppliers, seven kinds of a width that changes with the key
_BROKEN = [
    "CAST(s_suppkey AS BIGINT) AS area_id", "s_suppkey % 7 AS kind", "CAST(8 + 4 * (s_suppkey % 5) AS DOUBLE) AS w",
    "CAST(s_suppkey % 200 AS DOUBLE) * 100 AS x", "CAST(floor(s_suppkey / 200) AS DOUBLE) * 100 AS y",
]


def _broken_shapes(spark, d):
    """Bow ties, overlaps, holes that touch or cross the border, neighbours, twins and rings that touch themselves."""
    base = FX.table(spark, d, "supplier").selectExpr(*_BROKEN)
    x, y, w, kind = F.col("x"), F.col("y"), F.col("w"), F.col("kind")

    def ring(*corners):
        return F.array(*[G.vertex(x + w * i + a, y + w * j + b) for i, j, a, b in [*corners, corners[0]]])

    def box(i, j, u, v, a=0, b=0):
        return ring((i, j, a, b), (u, j, a, b), (u, v, a, b), (i, v, a, b))

    square = box(0, 0, 1, 1)
    parts = (
        F.when(kind == 0, F.array(F.array(ring((0, 0, 0, 0), (1, 1, 0, 0), (1, 0, 0, 0), (0, 1, 0, 0)))))
        .when(kind == 1, F.array(F.array(square), F.array(box(0, 0, 1, 1, 4, 4))))
        .when(kind == 2, F.array(F.array(square, ring((0, 0, 0, 0), (0.5, 0.25, 0, 0), (0.25, 0.5, 0, 0)))))
        .when(kind == 3, F.array(F.array(square), F.array(box(1, 0, 2, 1))))
        .when(kind == 4, F.array(F.array(square), F.array(square)))
        .when(kind == 5, F.array(F.array(square, box(0.5, 0.25, 1.5, 0.75))))
        .otherwise(F.array(F.array(ring((0, 0, 0, 0), (0.5, 0.5, 0, 0), (1, 0, 0, 0), (1, 1, 0, 0), (0.5, 0.5, 0, 0), (0, 1, 0, 0)))))
    )
    return base.select("area_id", F.struct(F.lit("MultiPolygon").alias("kind"), parts.alias("parts")).alias("geom"))


@query(
    "repaired_areas",
    f"""WITH s AS (SELECT {', '.join(_BROKEN)} FROM supplier)
       SELECT area_id, CAST([2, 2, 1, 1, NULL, 2, 2][kind + 1] AS INT) AS n_parts, CAST([2, 2, 2, 1, NULL, 2, 2][kind + 1] AS INT) AS n_rings,
              CAST([8, 14, 9, 7, NULL, 14, 8][kind + 1] AS INT) AS n_points,
              round([w * w / 2, 2 * w * w - 2 * (w - 4) * (w - 4), w * w - 3 * w * w / 32, 2 * w * w, NULL, w * w, w * w / 2][kind + 1], 6) AS area
       FROM s""",
)
def q_repaired_areas(spark, d):
    """Invalid areas made valid, against closed forms of their parts, vertices and areas."""
    valid = make_valid(_broken_shapes(spark, d), "geom", "area_id", cell_size=25.0)
    doubled = """aggregate(flatten(transform(geom.parts, _p -> transform(_p, (_r, _i) -> CASE WHEN _i > 0 THEN -1D ELSE 1D END * abs(aggregate(
        sequence(1, size(_r) - 1), 0D, (_s, _k) -> _s + (_r[_k - 1].x - _r[0].x) * (_r[_k].y - _r[0].y) - (_r[_k].x - _r[0].x) * (_r[_k - 1].y - _r[0].y)))))),
        0D, (_a, _b) -> _a + _b)"""
    return valid.select(
        "area_id",
        F.size("geom.parts").alias("n_parts"),
        F.expr("size(flatten(geom.parts))").alias("n_rings"),
        F.expr("size(flatten(flatten(geom.parts)))").alias("n_points"),
        F.round(F.expr(f"{doubled} / 2"), 6).alias("area"),
    )


@query(
    "invalid_ring_kinds",
    f"""WITH s AS (SELECT {', '.join(_BROKEN)} FROM supplier)
       SELECT area_id, CASE kind WHEN 0 THEN concat('Self-intersection[', x + w / 2, ' ', y + w / 2, ']')
                                 WHEN 1 THEN concat('Self-intersection[', x + 4, ' ', y + w, ']')
                                 WHEN 3 THEN concat('Self-intersection[', x + w, ' ', y, ']')
                                 WHEN 4 THEN concat('Self-intersection[', x, ' ', y, ']')
                                 WHEN 5 THEN concat('Self-intersection[', x + w, ' ', y + w / 4, ']')
                                 ELSE concat('Ring Self-intersection[', x + w / 2, ' ', y + w / 2, ']') END AS invalidity_explain
       FROM s WHERE kind <> 2""",
)
def q_invalid_ring_kinds(spark, d):
    """Why each of the broken shapes is invalid; a hole that touches its shell in one vertex is no fault."""
    edges = S.area_edges(_broken_shapes(spark, d), "geom", "area_id")
    return S.invalid_areas(edges, "area_id", cell_size=25.0).select("area_id", "invalidity_explain")


@query(
    "geometry_text",
    """WITH s AS (SELECT CAST(s_suppkey AS BIGINT) AS id, s_suppkey % 3 AS kind, CAST(s_suppkey % 10 AS DOUBLE) + 0.25 AS x,
                         CAST(s_suppkey % 7 AS DOUBLE) - 0.5 AS y FROM supplier)
       SELECT id, CASE kind WHEN 0 THEN concat('POINT (', x, ' ', y, ')')
                            WHEN 1 THEN concat('LINESTRING (', x, ' ', y, ', ', x + 1, ' ', y + 2, ')')
                            ELSE concat('POLYGON ((', x, ' ', y, ', ', x + 1, ' ', y, ', ', x, ' ', y + 1, ', ', x, ' ', y, '))') END AS wkt
       FROM s""",
)
def q_geometry_text(spark, d):
    """Text of points, lines and polygons of suppliers."""
    base = FX.table(spark, d, "supplier").selectExpr(
        "CAST(s_suppkey AS BIGINT) AS id", "s_suppkey % 3 AS kind", "CAST(s_suppkey % 10 AS DOUBLE) + 0.25D AS x", "CAST(s_suppkey % 7 AS DOUBLE) - 0.5D AS y"
    )
    x, y, kind = F.col("x"), F.col("y"), F.col("kind")
    line = F.array(G.vertex(x, y), G.vertex(x + 1, y + 2))
    corner = F.array(G.vertex(x, y), G.vertex(x + 1, y), G.vertex(x, y + 1), G.vertex(x, y))
    vertices = F.when(kind == 0, F.array(G.vertex(x, y))).when(kind == 1, line).otherwise(corner)
    return base.withColumn("vs", vertices).select("id", G.as_text(G.geometry_from_vertices("vs"), 6).alias("wkt"))
