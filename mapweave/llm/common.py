"""Shared helpers of the training-data operators: reading, staging, word tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mapweave.session import checkpoint_dir, ship_package

# text handled at once inside a Python task; bounds the worker's memory, not the work
SLICE_BYTES = 3 << 20

# regular expressions of the two word definitions, as Java and RE2 both read them
SPACE_RUN = r"[\x20\x09-\x0D]+"
NON_ALNUM_RUN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def stage(df: DataFrame) -> DataFrame:
    """Cut the lineage: ``df`` is computed once and kept in the shared checkpoint folder.

    A lost executor costs a re-read. The files go with the returned frame where
    ``spark.cleaner.referenceTracking.cleanCheckpoints`` is set.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def with_package(df: DataFrame) -> DataFrame:
    """Make sure Python workers can import this package before Python runs on ``df``."""
    ship_package(df.sparkSession)
    bounded_batches(df.sparkSession)
    return df


def ascii_lower(text: str) -> str:
    """SQL text that lower-cases A-Z only; pure ASCII rows take the fast path."""
    return (
        f"(CASE WHEN octet_length({text}) = char_length({text}) THEN lower({text}) "
        f"ELSE translate({text}, '{UPPER}', '{UPPER.lower()}') END)"
    )


def sql_words(text: str, separator: str) -> str:
    """SQL text: the non-empty pieces of ``text`` between runs of ``separator`` (only the ends can be empty)."""
    pieces = f"split({text}, '{separator.replace(chr(92), chr(92) * 2)}')"
    cut = (
        "p -> CASE WHEN size(p) = 1 AND p[0] = '' THEN slice(p, 1, 0) "
        "WHEN p[0] = '' AND p[size(p) - 1] = '' THEN slice(p, 2, size(p) - 2) "
        "WHEN p[0] = '' THEN slice(p, 2, size(p) - 1) "
        "WHEN p[size(p) - 1] = '' THEN slice(p, 1, size(p) - 1) ELSE p END"
    )
    return f"transform(array({pieces}), {cut})[0]"


def text_slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut one Arrow batch into row ranges of about ``limit`` bytes of text (a longer single text is one range)."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    if not len(sizes):
        return
    ends = np.cumsum(sizes)
    start = 0
    while start < len(sizes):
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop
    pa.default_memory_pool().release_unused()


class WordTable:
    """The words of a run of texts as codes into a table of distinct words.

    ``codes`` holds one code per word in reading order, ``bounds[i]:bounds[i+1]``
    are the words of text ``i``. ``words`` is an Arrow string array.
    """

    def __init__(self, texts: pa.Array, lower: bool):
        texts = pc.fill_null(texts, "")
        if lower:
            texts = pc.ascii_lower(texts)
        pieces = pc.ascii_split_whitespace(texts)
        bounds = pieces.offsets.to_numpy().astype(np.int64)
        coded = pc.dictionary_encode(pieces.flatten())
        codes = coded.indices.to_numpy(zero_copy_only=False)
        bounds = bounds - bounds[0]
        words = coded.dictionary
        empty = pc.index(words, pa.scalar("", words.type)).as_py()
        if empty >= 0:
            keep = codes != empty
            kept = np.concatenate([[0], np.cumsum(keep)])
            bounds, codes = kept[bounds], codes[keep]
        self.codes, self.bounds, self.words = codes, bounds, words


def mix64(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64 on unsigned 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def connected_components(edges: DataFrame) -> DataFrame:
    """Smallest reachable node per node of an undirected edge table ``(a, b)``; columns ``node, comp``.

    Alternating large-star / small-star rounds, each one shuffle on the node with
    a map-side combine, staged in the shared folder. Nothing is collected; the
    driver reads one count per round. A node with very many links only meets a
    ``min`` aggregate and a skew-splittable join, never a collected list.
    """
    cur = stage(
        edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    while True:
        # large star: every larger neighbour of a node links to the smallest node around it
        both = cur.unionByName(cur.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # small star: a node and its smaller neighbours link to the smallest of them
        low2 = large.groupBy("a").agg(F.min("b").alias("m"))
        hooked = large.join(low2, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        nxt = stage(hooked.unionByName(low2.select("a", F.col("m").alias("b"))).distinct())
        # done when every node has one parent and no parent has a parent
        tops = nxt.select(F.col("b").alias("a")).distinct()
        if nxt.join(tops, "a", "left_semi").isEmpty() and nxt.groupBy("a").count().where("count > 1").isEmpty():
            break
        cur = nxt
    roots = nxt.select(F.col("b").alias("node"), F.col("b").alias("comp")).distinct()
    return nxt.select(F.col("a").alias("node"), F.col("b").alias("comp")).unionByName(roots)


def bounded_batches(spark: SparkSession) -> None:
    """Let Arrow batches of long texts be cut by bytes as well as by rows (unless the session says otherwise)."""
    for key, value in (("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20)),):
        if spark.conf.get(key, None) in (None, str(2**31 - 1), str(2**63 - 1), "-1"):
            spark.conf.set(key, value)


SMALL_ROWS = 400_000  # narrow rows (at most 32 bytes each) that may be broadcast


def sized(df: DataFrame, limit: int = SMALL_ROWS) -> DataFrame:
    """``df`` (narrow and staged) marked for broadcast if its counted rows fit the limit."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def staged_table(df: DataFrame, name: str) -> tuple[DataFrame, Callable[[], None]]:
    """Like :func:`stage` for wide intermediates, as compressed columns; the caller releases it once it has been used up."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)

    def release() -> None:
        spark.range(0).write.mode("overwrite").parquet(path)

    return spark.read.schema(df.schema).parquet(path), release
