"""Point, line and polygon features from nodes and ways."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mapweave.functions import geometry as G
from mapweave.sources.entities import MapFrames


def _way_shapes(ways: DataFrame, nodes: DataFrame) -> DataFrame:
    """(id, shape) of the ways whose nodes are known; only ids and coordinates are moved."""
    refs = ways.select("id", F.posexplode("nodes").alias("pos", "node"))
    places = nodes.select(F.col("id").alias("node"), F.col("longitude").alias("x"), F.col("latitude").alias("y"))
    corners = F.sort_array(F.collect_list(F.struct("pos", "x", "y")))
    rows = refs.join(places, "node").groupBy("id").agg(corners.alias("corners"))
    rows = rows.select("id", F.expr("transform(corners, c -> named_struct('x', c.x, 'y', c.y))").alias("line"))
    return rows.select("id", G.geometry_from_vertices("line").alias("shape"))


def way_geometries(df_way: DataFrame, df_node: DataFrame, output_col: str, way_id_column_name: str = "id") -> DataFrame:
    """Ways with their geometry in ``output_col`` instead of ``nodes``.

    A missing node shortens the way; a way without any known node vanishes. The
    geometry is built from ids and coordinates alone (bounded by the way's
    length) and meets the way's other columns once, on the id.
    """
    id_column = F.col(way_id_column_name)
    shapes = _way_shapes(df_way.select(id_column.alias("id"), "nodes"), df_node)
    shapes = shapes.select(F.col("id").alias("__shape_id"), F.col("shape").alias(output_col))
    return df_way.drop("nodes").join(shapes, id_column == F.col("__shape_id")).drop("__shape_id")


def _extra(additional_columns: Mapping[str, str | Column] | None) -> list[Column]:
    if not additional_columns:
        return []
    return [(v if isinstance(v, Column) else F.expr(v)).alias(k) for k, v in additional_columns.items()]


def extract_features(
    map_data: MapFrames,
    feature_filter: str | Column,
    additional_columns: Mapping[str, str | Column] | None = None,
    id_column: str | None = None,
    geometry_column: str | None = None,
    centroid_column: str | None = None,
) -> DataFrame:
    """Features of the nodes and ways that pass ``feature_filter``.

    Nodes become points; ways become their geometry and/or its centroid.
    ``additional_columns`` (name -> SQL text or Column) are evaluated after
    the geometry columns exist, so they may use them. ``id_column`` adds the
    source-tagged id (``N<id>`` / ``W<id>``). Output columns: extras, id,
    centroid, geometry. Relations are never features.
    """
    ways = map_data.ways.where(feature_filter)
    early, late = _by_need(ways, additional_columns)
    # what needs no geometry is worked out first, so tags stay out of the joins
    ways = ways.withColumns(early) if late else ways.select("id", "nodes", *[c.alias(n) for n, c in early.items()])
    nodes = map_data.nodes.where(feature_filter).withColumns(early)
    shaped = {"N": nodes.withColumn("__shape", G.point("longitude", "latitude")), "W": way_geometries(ways, map_data.nodes, "__shape")}
    names = list(additional_columns or {})
    frames = [_features(df, tag, names, late, id_column, geometry_column, centroid_column) for tag, df in shaped.items()]
    return frames[0].unionByName(frames[1])


_EARLY = "__extra_"


def _by_need(df: DataFrame, extras: Mapping[str, str | Column] | None) -> tuple[dict[str, Column], dict[str, Column]]:
    """Extra columns that follow from the entity alone (under working names), and those that need the features' own columns."""
    early, late = {}, {}
    for name, column in zip(extras or {}, _extra(extras), strict=True):
        try:
            df.select(column)
            early[_EARLY + name] = column
        except AnalysisException:
            late[name] = column
    return early, late


def _features(df: DataFrame, tag: str, names: list[str], late, id_column, geometry_column, centroid_column) -> DataFrame:
    """Output columns of the entities of one kind, whose geometry is ``__shape``."""
    made = {}
    if id_column:
        made[id_column] = F.concat(F.lit(tag), F.col("id").cast("string"))
    if centroid_column:
        made[centroid_column] = F.col("__shape") if tag == "N" else G.centroid("__shape")
    if geometry_column:
        made[geometry_column] = F.col("__shape")
    named = df.withColumns(made) if made else df
    return named.select(*[late[n] if n in late else F.col(f"`{_EARLY}{n}`").alias(n) for n in names], *made)
