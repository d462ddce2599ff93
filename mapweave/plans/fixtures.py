"""Map-shaped inputs derived by Spark from the benchmark tables.

Every frame here is a projection of a driver table (customer, supplier,
nation, region, orders), so its size grows with the table. The same
definitions exist as DuckDB SQL in :mod:`mapweave.plans.oracle` for the
independent oracle queries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mapweave.schema import ENTITY_SCHEMA
from mapweave.sources.entities import MapFrames, split_entities


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fx_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One point per customer: lon in [0, 10), lat in [45, 55)."""
    return table(spark, sf_dir, "customer").selectExpr(
        "CAST(c_custkey AS BIGINT) AS point_id",
        "CAST((c_custkey * 7919) % 100003 AS DOUBLE) / CAST(10000.3 AS DOUBLE) AS lon",
        "CAST(45 AS DOUBLE) + CAST((c_custkey * 104729) % 100019 AS DOUBLE) / CAST(10001.9 AS DOUBLE) AS lat",
        "c_mktsegment AS segment",
    )


def fx_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One point per supplier."""
    return table(spark, sf_dir, "supplier").selectExpr(
        "CAST(s_suppkey AS BIGINT) AS site_id",
        "CAST((s_suppkey * 6101 + 17) % 10007 AS DOUBLE) / CAST(1000.7 AS DOUBLE) AS lon",
        "CAST(45 AS DOUBLE) + CAST((s_suppkey * 3571 + 29) % 10009 AS DOUBLE) / CAST(1000.9 AS DOUBLE) AS lat",
    )


def fx_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One diamond (radius r) with a diamond hole (radius h) per nation, 5 x 5 grid."""
    return table(spark, sf_dir, "nation").selectExpr(
        "CAST(n_nationkey AS INT) AS area_id",
        "n_name",
        "CAST(2 * (n_nationkey % 5) + 1 AS DOUBLE) AS cx",
        "CAST(46 + 2 * CAST(FLOOR(n_nationkey / 5) AS INT) AS DOUBLE) AS cy",
        "CAST(0.9 AS DOUBLE) AS r",
        "CAST(0.3 AS DOUBLE) AS h",
    )


def fx_big_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One overlapping diamond without hole per region."""
    return table(spark, sf_dir, "region").selectExpr(
        "CAST(100 + r_regionkey AS INT) AS area_id",
        "CAST(2 * r_regionkey + 1 AS DOUBLE) AS cx",
        "CAST(50 AS DOUBLE) AS cy",
        "CAST(2.5 AS DOUBLE) AS r",
        "CAST(0 AS DOUBLE) AS h",
    )


def fx_house(spark: SparkSession, sf_dir: str) -> DataFrame:
    """House-number strings with a known expansion (arm = o_orderkey % 8)."""
    return (
        table(spark, sf_dir, "orders")
        .selectExpr("o_orderkey", "1 + o_orderkey % 50 AS n")
        .selectExpr(
            "CAST(o_orderkey AS BIGINT) AS id",
            """concat(CASE WHEN o_orderkey % 3 = 0 THEN '00' ELSE '' END,
               CASE o_orderkey % 8
                 WHEN 0 THEN CAST(n AS STRING)
                 WHEN 1 THEN concat(CAST(n AS STRING), '-', CAST(n+4 AS STRING))
                 WHEN 2 THEN concat(CAST(n AS STRING), '-', CAST(n+3 AS STRING))
                 WHEN 3 THEN concat(CAST(n+5 AS STRING), '-', CAST(n AS STRING))
                 WHEN 4 THEN concat(CAST(n AS STRING), 'a-c')
                 WHEN 5 THEN concat(CAST(n AS STRING), 'A-', CAST(n AS STRING), 'b')
                 WHEN 6 THEN concat(CAST(n AS STRING), ', ', CAST(n+1 AS STRING))
                 ELSE concat(CAST(n AS STRING), '/', CAST(n+1 AS STRING)) END) AS housenumber""",
        )
    )


# ------------------------------------------------------------------ entities

_DIAMOND_VERTICES = """inline(array(
  named_struct('j',0,'dx',r,'dy',0D),  named_struct('j',1,'dx',0D,'dy',r),
  named_struct('j',2,'dx',-r,'dy',0D), named_struct('j',3,'dx',0D,'dy',-r),
  named_struct('j',10,'dx',h,'dy',0D), named_struct('j',11,'dx',0D,'dy',h),
  named_struct('j',12,'dx',-h,'dy',0D),named_struct('j',13,'dx',0D,'dy',-h)))"""

_SITE_VERTICES = """inline(array(
  named_struct('j',0,'dx',0D,'dy',0D),       named_struct('j',1,'dx',0.01D,'dy',0D),
  named_struct('j',2,'dx',0.01D,'dy',0.01D), named_struct('j',3,'dx',0D,'dy',0.01D)))"""

_BORDER_WAYS = """inline(array(
  named_struct('w',0,'js',array(0,1)), named_struct('w',1,'js',array(2,1)),
  named_struct('w',2,'js',array(2,3)), named_struct('w',3,'js',array(0,3)),
  named_struct('w',4,'js',array(10,11,12,13,10))))"""


def fx_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    areas = fx_areas(spark, sf_dir).selectExpr("*", _DIAMOND_VERTICES).selectExpr(
        "CAST(area_id AS BIGINT) * 100 + j AS id",
        "cx + dx AS longitude",
        "cy + dy AS latitude",
        "CAST(map() AS MAP<STRING,STRING>) AS tags",
    )
    addresses = fx_points(spark, sf_dir).selectExpr(
        "1000000 + point_id AS id",
        "lon AS longitude",
        "lat AS latitude",
        "map('addr:street', segment, 'addr:housenumber', CAST(1 + point_id % 50 AS STRING)) AS tags",
    )
    sites = fx_sites(spark, sf_dir).selectExpr("*", _SITE_VERTICES).selectExpr(
        "2000000 + site_id * 10 + j AS id",
        "lon + dx AS longitude",
        "lat + dy AS latitude",
        "CAST(map() AS MAP<STRING,STRING>) AS tags",
    )
    return areas.unionByName(addresses).unionByName(sites)


def fx_ways(spark: SparkSession, sf_dir: str) -> DataFrame:
    borders = fx_areas(spark, sf_dir).selectExpr("*", _BORDER_WAYS).selectExpr(
        "CAST(area_id AS BIGINT) * 10 + w AS id",
        "transform(js, x -> CAST(area_id AS BIGINT) * 100 + x) AS nodes",
        "CAST(map() AS MAP<STRING,STRING>) AS tags",
    )
    sites = fx_sites(spark, sf_dir).selectExpr(
        "5000 + site_id AS id",
        """transform(CASE site_id % 4 WHEN 0 THEN array(0,1,2) WHEN 1 THEN array(0)
                                       WHEN 2 THEN array(0,1,2,3,0) ELSE array(9,0,1,2,9) END,
                     x -> 2000000 + site_id * 10 + x) AS nodes""",
        "map('addr:street', 'Site', 'addr:housenumber', CAST(site_id AS STRING)) AS tags",
    )
    return borders.unionByName(sites)


def fx_relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx_areas(spark, sf_dir).selectExpr(
        "1000 + CAST(area_id AS BIGINT) AS id",
        """filter(array(
            named_struct('id', area_id*10L+2, 'relationType', 1Y, 'role', 'outer'),
            named_struct('id', area_id*100L,  'relationType', 0Y, 'role', 'admin_centre'),
            named_struct('id', area_id*10L+0, 'relationType', 1Y, 'role', 'outer'),
            named_struct('id', area_id*10L+4, 'relationType', 1Y, 'role', 'inner'),
            named_struct('id', area_id*10L+1, 'relationType', 1Y, 'role', 'outer'),
            named_struct('id', area_id*10L+3, 'relationType', 1Y, 'role', 'outer')),
          m -> NOT (area_id = 24 AND m.id = 243) AND NOT (area_id = 23 AND m.id = 234)) AS relations""",
        """map('type','boundary', 'boundary','administrative', 'name', n_name,
              'admin_level', CASE WHEN area_id = 22 THEN '8;9' ELSE CAST(4 + 2*(area_id % 3) AS STRING) END) AS tags""",
    )


def _pad(df: DataFrame, kind: int) -> DataFrame:
    cols = []
    for f in ENTITY_SCHEMA.fields:
        if f.name == "type":
            cols.append(F.lit(kind).cast("tinyint").alias("type"))
        elif f.name in df.columns:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*cols)


def fx_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All fixture entities as one table in the entity schema."""
    return (
        _pad(fx_nodes(spark, sf_dir), 0)
        .unionByName(_pad(fx_ways(spark, sf_dir), 1))
        .unionByName(_pad(fx_relations(spark, sf_dir), 2))
    )


def fx_map(spark: SparkSession, sf_dir: str) -> MapFrames:
    """The fixture entities as three frames in the entity schema (no union + split)."""
    return MapFrames(
        nodes=_pad(fx_nodes(spark, sf_dir), 0),
        ways=_pad(fx_ways(spark, sf_dir), 1),
        relations=_pad(fx_relations(spark, sf_dir), 2),
    )
