"""Fixed schemas and plan-time guards."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Entity table: nodes, ways and relations share one schema; `type` is
# 0 = node, 1 = way, 2 = relation.
ENTITY_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType(), True),
        T.StructField("type", T.ByteType(), True),
        T.StructField("latitude", T.DoubleType(), True),
        T.StructField("longitude", T.DoubleType(), True),
        T.StructField("nodes", T.ArrayType(T.LongType(), True), True),
        T.StructField(
            "relations",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("id", T.LongType(), True),
                        T.StructField("relationType", T.ByteType(), True),
                        T.StructField("role", T.StringType(), True),
                    ]
                ),
                True,
            ),
            True,
        ),
        T.StructField("tags", T.MapType(T.StringType(), T.StringType(), True), True),
        T.StructField(
            "info",
            T.StructType(
                [
                    T.StructField("version", T.IntegerType(), True),
                    T.StructField("timestamp", T.TimestampType(), True),
                    T.StructField("changeset", T.LongType(), True),
                    T.StructField("userId", T.IntegerType(), True),
                    T.StructField("userName", T.StringType(), True),
                    T.StructField("visible", T.BooleanType(), True),
                ]
            ),
            True,
        ),
    ]
)

NODE, WAY, RELATION = 0, 1, 2

VERTEX_TYPE = T.StructType([T.StructField("x", T.DoubleType(), True), T.StructField("y", T.DoubleType(), True)])

# Geometry value: kind is Point / LineString / Polygon / MultiPolygon;
# parts -> rings -> vertices. For a polygon part ring 0 is the shell and the
# others are holes; rings of polygons are closed (first vertex == last).
GEOM_TYPE = T.StructType(
    [
        T.StructField("kind", T.StringType(), True),
        T.StructField("parts", T.ArrayType(T.ArrayType(T.ArrayType(VERTEX_TYPE, True), True), True), True),
    ]
)


def is_geometry(data_type: T.DataType) -> bool:
    return data_type == GEOM_TYPE or (
        isinstance(data_type, T.StructType) and data_type.fieldNames() == ["kind", "parts"]
    )


def check_for_duplicate_columns(df_1: DataFrame, df_2: DataFrame, case_sensitive: bool | None = None) -> None:
    """Raise RuntimeError when two frames share a column name.

    Names compare per ``spark.sql.caseSensitive`` unless ``case_sensitive`` is given.
    """
    assert isinstance(df_1, DataFrame), "df_1 is not a pyspark Dataframe"
    assert isinstance(df_2, DataFrame), "df_2 is not a pyspark Dataframe"
    if case_sensitive is None:
        conf = df_1.sparkSession.conf.get("spark.sql.caseSensitive", "false")
        case_sensitive = str(conf).lower() == "true"
    norm = (lambda c: c) if case_sensitive else (lambda c: c.lower())
    right = {norm(c) for c in df_2.columns}
    shared = sorted(c for c in df_1.columns if norm(c) in right)
    if shared:
        raise RuntimeError(f'Dataframes have these columns in common: "{", ".join(shared)}"')
