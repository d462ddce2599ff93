"""DuckDB SQL fragments for the oracle queries.

These restate the fixture views of :mod:`mapweave.plans.fixtures` in SQL that
DuckDB runs on the same parquet tables, plus closed forms of the expected
geometry answers. They never call the library.
"""

from __future__ import annotations

# Krueger series of GRS80 for UTM zone 32 (rectifying radius, 2 sqrt(n) / (1 + n), the three
# coefficients forwards, backwards and for the latitude, central meridian, false northing), worked out
# from a = 6378137 m, 1/f = 298.257222101
UTM32_A = 6367449.145771048
UTM32_E = 0.08181919104281579
UTM32_ALPHA = (0.0008377318229233356, 7.608497033275727e-07, 1.203487805324186e-09)
UTM32_BETA = (0.0008377321681862306, 5.9061109218734e-08, 1.676991204140259e-10)
UTM32_DELTA = (0.003356551465100355, 6.571913257672216e-06, 1.7677460222466733e-08)
UTM32_LON0 = 9.0
UTM32_N0 = 0.0

FX_POINTS = """fx_points AS (
  SELECT CAST(c_custkey AS BIGINT) AS point_id,
         CAST((c_custkey * 7919) % 100003 AS DOUBLE) / CAST(10000.3 AS DOUBLE) AS lon,
         CAST(45 AS DOUBLE) + CAST((c_custkey * 104729) % 100019 AS DOUBLE) / CAST(10001.9 AS DOUBLE) AS lat,
         c_mktsegment AS segment
  FROM customer)"""

FX_SITES = """fx_sites AS (
  SELECT CAST(s_suppkey AS BIGINT) AS site_id,
         CAST((s_suppkey * 6101 + 17) % 10007 AS DOUBLE) / CAST(1000.7 AS DOUBLE) AS lon,
         CAST(45 AS DOUBLE) + CAST((s_suppkey * 3571 + 29) % 10009 AS DOUBLE) / CAST(1000.9 AS DOUBLE) AS lat
  FROM supplier)"""

FX_AREAS = """fx_areas AS (
  SELECT CAST(n_nationkey AS INT) AS area_id, n_name,
         CAST(2 * (n_nationkey % 5) + 1 AS DOUBLE) AS cx,
         CAST(46 + 2 * CAST(FLOOR(n_nationkey / 5) AS INT) AS DOUBLE) AS cy,
         CAST(0.9 AS DOUBLE) AS r, CAST(0.3 AS DOUBLE) AS h
  FROM nation)"""

FX_BIG_AREAS = """fx_big_areas AS (
  SELECT CAST(100 + r_regionkey AS INT) AS area_id, CAST(2 * r_regionkey + 1 AS DOUBLE) AS cx,
         CAST(50 AS DOUBLE) AS cy, CAST(2.5 AS DOUBLE) AS r, CAST(0 AS DOUBLE) AS h
  FROM region)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def utm_sql(lon: str, lat: str) -> tuple[str, str]:
    """(easting, northing) SQL of the Krueger series for UTM zone 32."""
    phi = f"RADIANS({lat})"
    dlam = f"RADIANS({lon} - {UTM32_LON0!r})"
    t = f"SINH(ATANH(SIN({phi})) - {UTM32_E!r} * ATANH({UTM32_E!r} * SIN({phi})))"
    xi = f"ATAN2({t}, COS({dlam}))"
    eta = f"ATANH(SIN({dlam}) / SQRT(1 + ({t}) * ({t})))"
    east, north = eta, xi
    for j, aj in enumerate(UTM32_ALPHA, start=1):
        east += f" + {aj!r} * COS({2 * j} * {xi}) * SINH({2 * j} * {eta})"
        north += f" + {aj!r} * SIN({2 * j} * {xi}) * COSH({2 * j} * {eta})"
    k = 0.9996 * UTM32_A
    return f"(500000.0 + {k!r} * ({east}))", f"({UTM32_N0!r} + {k!r} * ({north}))"


# Entity fixtures in DuckDB form: tags are spread into the columns the oracles read.
FX_NODES = """fx_nodes AS (
  SELECT CAST(area_id AS BIGINT) * 100 + v.j AS id, cx + v.sx * r AS longitude, cy + v.sy * r AS latitude,
         CAST(NULL AS VARCHAR) AS street, CAST(NULL AS VARCHAR) AS housenumber
  FROM fx_areas, (VALUES (0, 1.0, 0.0), (1, 0.0, 1.0), (2, -1.0, 0.0), (3, 0.0, -1.0)) v(j, sx, sy)
  UNION ALL
  SELECT CAST(area_id AS BIGINT) * 100 + v.j, cx + v.sx * h, cy + v.sy * h, NULL, NULL
  FROM fx_areas, (VALUES (10, 1.0, 0.0), (11, 0.0, 1.0), (12, -1.0, 0.0), (13, 0.0, -1.0)) v(j, sx, sy)
  UNION ALL
  SELECT 1000000 + point_id, lon, lat, segment, CAST(1 + point_id % 50 AS VARCHAR) FROM fx_points
  UNION ALL
  SELECT 2000000 + site_id * 10 + v.j, lon + v.dx, lat + v.dy, NULL, NULL
  FROM fx_sites, (VALUES (0, 0.0, 0.0), (1, 0.01, 0.0), (2, 0.01, 0.01), (3, 0.0, 0.01)) v(j, dx, dy))"""

FX_WAYS = """fx_ways AS (
  SELECT CAST(area_id AS BIGINT) * 10 + v.w AS id,
         list_transform(v.js, lambda x: CAST(area_id AS BIGINT) * 100 + x) AS nodes,
         CAST(NULL AS VARCHAR) AS street, CAST(NULL AS VARCHAR) AS housenumber
  FROM fx_areas, (VALUES (0, [0, 1]), (1, [2, 1]), (2, [2, 3]), (3, [0, 3]), (4, [10, 11, 12, 13, 10])) v(w, js)
  UNION ALL
  SELECT 5000 + site_id,
         list_transform(CASE site_id % 4 WHEN 0 THEN [0, 1, 2] WHEN 1 THEN [0]
                                         WHEN 2 THEN [0, 1, 2, 3, 0] ELSE [9, 0, 1, 2, 9] END,
                        lambda x: 2000000 + site_id * 10 + x),
         'Site', CAST(site_id AS VARCHAR)
  FROM fx_sites)"""

# way vertices that exist: (way id, position, node id, x, y)
FX_WAY_VERTS = """fx_way_verts AS (
  SELECT w.id AS way_id, CAST(u.pos - 1 AS INT) AS pos, n.id AS node_id, n.longitude AS x, n.latitude AS y
  FROM fx_ways w, unnest(w.nodes) WITH ORDINALITY AS u(node_id, pos)
  JOIN fx_nodes n ON n.id = u.node_id)"""

# city/postcode levels of the fixture relations: admin_level text and its integer (NULL when not an integer)
FX_LEVELS = """fx_levels AS (
  SELECT area_id, n_name,
         CASE WHEN area_id = 22 THEN '8;9' ELSE CAST(4 + 2 * (area_id % 3) AS VARCHAR) END AS admin_level,
         CASE WHEN area_id = 22 THEN NULL ELSE 4 + 2 * (area_id % 3) END AS level
  FROM fx_areas)"""


def utm_inverse_sql(e: str, n: str) -> tuple[str, str]:
    """(lon, lat) SQL of the inverse Krueger series for UTM zone 32."""
    k = 0.9996 * UTM32_A
    xi = f"(({n}) - {UTM32_N0!r}) / {k!r}"
    eta = f"(({e}) - 500000.0) / {k!r}"
    xi_p, eta_p = f"({xi}", f"({eta}"
    for j, bj in enumerate(UTM32_BETA, start=1):
        xi_p += f" - {bj!r} * SIN({2 * j} * {xi}) * COSH({2 * j} * {eta})"
        eta_p += f" - {bj!r} * COS({2 * j} * {xi}) * SINH({2 * j} * {eta})"
    xi_p += ")"
    eta_p += ")"
    chi = f"ASIN(SIN({xi_p}) / COSH({eta_p}))"
    phi = f"({chi}"
    for j, dj in enumerate(UTM32_DELTA, start=1):
        phi += f" + {dj!r} * SIN({2 * j} * {chi})"
    phi += ")"
    lam = f"ATAN2(SINH({eta_p}), COS({xi_p}))"
    return f"(DEGREES({lam}) + {UTM32_LON0!r})", f"DEGREES({phi})"


def diamond_segments_cte(name: str = "fx_area_segs") -> str:
    """Projected segments of the fx_areas diamonds: shell (radius r) and hole (radius h)."""
    corners = "(VALUES (0, 1.0, 0.0, 0.0, 1.0), (1, 0.0, 1.0, -1.0, 0.0), (2, -1.0, 0.0, 0.0, -1.0), (3, 0.0, -1.0, 1.0, 0.0)) v(j, sx, sy, tx, ty)"
    e1, n1 = utm_sql("(cx + v.sx * rad)", "(cy + v.sy * rad)")
    e2, n2 = utm_sql("(cx + v.tx * rad)", "(cy + v.ty * rad)")
    return f"""{name} AS (
  SELECT area_id, {e1} AS x1, {n1} AS y1, {e2} AS x2, {n2} AS y2
  FROM (SELECT area_id, cx, cy, r AS rad FROM fx_areas UNION ALL SELECT area_id, cx, cy, h FROM fx_areas WHERE h > 0) a,
       {corners})"""
