"""mapweave — map entity tables to analysis-ready address and area tables on Spark.

Every operator takes and returns DataFrames. Spatial work (point in area,
nearest feature, centroids, self-intersections) is expressed as equi-joins on
grid cells plus aggregates and JVM higher-order functions, so it partitions
with the data and needs no native geometry library.
"""

from mapweave.schema import ENTITY_SCHEMA, GEOM_TYPE, check_for_duplicate_columns
from mapweave.sources.entities import MapFrames, read_entities, split_entities
from mapweave.operators.columns import (
    add_column_prefix,
    aggregate_column_to_list,
    explode_col,
    remove_duplicate_rows,
    wrap_columns_into_struct,
)

__all__ = [
    "ENTITY_SCHEMA",
    "GEOM_TYPE",
    "MapFrames",
    "add_column_prefix",
    "aggregate_column_to_list",
    "check_for_duplicate_columns",
    "explode_col",
    "read_entities",
    "remove_duplicate_rows",
    "split_entities",
    "wrap_columns_into_struct",
]
