"""Entity table sources and sinks.

Entities (nodes, ways, relations) share :data:`mapweave.schema.ENTITY_SCHEMA`.
The preferred storage is Parquet partitioned by ``type`` so that reading one
kind prunes the other partitions at the scan.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mapweave.schema import ENTITY_SCHEMA, NODE, RELATION, WAY


@dataclass(frozen=True)
class MapFrames:
    """Nodes, ways and relations as three lazily evaluated frames."""

    nodes: DataFrame
    ways: DataFrame
    relations: DataFrame


def split_entities(raw_df: DataFrame) -> MapFrames:
    """Split one entity frame by kind (``type`` 0/1/2)."""
    return MapFrames(
        nodes=raw_df.where(F.col("type") == NODE),
        ways=raw_df.where(F.col("type") == WAY),
        relations=raw_df.where(F.col("type") == RELATION),
    )


def tag_column(tag: str) -> str:
    """Name of the column that holds a tag written as a column of its own."""
    return f"tag:{tag}"


def read_entities(spark: SparkSession, path: str, fmt: str = "parquet", hot_tags: Sequence[str] = ()) -> MapFrames:
    """Load an entity file or folder once and split it by kind.

    ``fmt="parquet"`` reads with the fixed schema (no inference), plus the
    ``hot_tags`` that :func:`write_entities` wrote as columns;
    ``fmt="pbf"`` decodes PBF extracts with :mod:`mapweave.sources.pbf`; any
    other format name is handed to ``spark.read.format`` so an installed
    connector can be used.
    """
    assert spark is not None, "spark cannot be None"
    assert path is not None, "path cannot be None"
    if fmt == "parquet":
        extra = [T.StructField(tag_column(t), T.StringType()) for t in hot_tags]
        raw = spark.read.schema(T.StructType([*ENTITY_SCHEMA.fields, *extra])).parquet(path)
    elif fmt == "pbf":
        from mapweave.sources import pbf

        pbf.register(spark)
        raw = spark.read.format(pbf.FORMAT_NAME).load(path)
    else:
        raw = spark.read.format(fmt).load(path)
    return split_entities(raw)


def write_entities(raw_df: DataFrame, path: str, mode: str = "overwrite", hot_tags: Sequence[str] = ()) -> None:
    """Write an entity frame as Parquet partitioned by ``type`` (kind pruning on read), sorted by id in each file.

    ``hot_tags`` become columns of their own (:func:`tag_column`), so filters on them reach
    the scan and skip row groups instead of decoding every tag map.
    """
    cols = [c for c in ENTITY_SCHEMA.fieldNames() if c in raw_df.columns]
    hot = [F.try_element_at("tags", F.lit(t)).alias(tag_column(t)) for t in hot_tags]
    raw_df.select(*cols, *hot).sortWithinPartitions("type", "id").write.mode(mode).partitionBy("type").parquet(path)


def write_table(
    df: DataFrame, path: str, files: int | None = None, mode: str = "overwrite", order: Sequence[str] | None = None
) -> None:
    """Parquet sink. By default every task of the last stage writes its own file.

    ``files`` asks for that many files: rows are dealt out anew, by ranges of the
    ``order`` columns where given (each file sorted), so the stage before keeps its
    parallelism.
    """
    out = df
    if files:
        out = df.repartitionByRange(files, *order).sortWithinPartitions(*order) if order else df.repartition(files)
    out.write.mode(mode).parquet(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
