"""Reproducible sharding: a keyed Feistel permutation of global row numbers.

Every row gets its place in the order of ``(doc_id, text checksum, size)``. The
permutation maps places to places, so shard and slot are arithmetic on the
permuted place: anyone who knows the number of rows, the number of shards and
the seed can compute where a row goes (:func:`permute`) and which row sits in a
slot (:func:`unpermute`) without reading any other row.

Defined cases: a NULL text has size 1 and checksum 0; an empty text has size 1
as well; NULL ids come first; rows equal in id, size and checksum are
interchangeable and take consecutive places; an empty table gives no rows.
Only the named columns are read, so extra columns never clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stage

PRIME = 2147483647  # halves have at most 31 bits, so round arithmetic stays inside a long
ROUNDS = 8  # even, so that halves of unequal width end where they began
WALK = 96  # steps of cycle walking; each ends the walk with a chance above one half


def _halves(n: int) -> tuple[int, int]:
    bits = max(2, (max(n, 2) - 1).bit_length())
    return bits // 2, bits - bits // 2


def round_keys(n: int, seed: int) -> list[tuple[int, int, int, int]]:
    """Multiplier, offset and the widths of both halves for every round."""
    left, right = _halves(n)
    out, state = [], seed
    for k in range(ROUNDS):
        state = (state * 6364136223846793005 + 1442695040888963407) % (1 << 64)
        mul = (state >> 33) % (PRIME - 2) + 2
        state = (state * 6364136223846793005 + 1442695040888963407) % (1 << 64)
        out.append((mul, (state >> 33) % PRIME, *((left, right) if k % 2 == 0 else (right, left))))
    return out


def _network(n: int, seed: int, backwards: bool) -> str:
    """SQL lambda body: ``x`` permuted over the smallest power-of-two domain that holds ``n`` places."""
    keys = round_keys(n, seed)
    steps = ", ".join(
        f"named_struct('a', {a}L, 'c', {c}L, 'l', {lo}, 'r', {hi})" for a, c, lo, hi in (reversed(keys) if backwards else keys)
    )

    def mixed(half: str) -> str:
        inner = f"transform(array((({half}) % {PRIME}L * s.a + s.c) % {PRIME}L), z -> z ^ shiftright(z, 13))[0]"
        return f"({inner} & (shiftleft(1L, s.l) - 1L))"

    if backwards:
        # y holds the untouched half above, the mixed half below
        kept = "shiftright(y, s.l)"
        step = f"shiftleft((y & (shiftleft(1L, s.l) - 1L)) ^ {mixed(kept)}, s.r) | {kept}"
    else:
        kept = "(y & (shiftleft(1L, s.r) - 1L))"
        step = f"shiftleft({kept}, s.l) | (shiftright(y, s.r) ^ {mixed(kept)})"
    return f"reduce(array({steps}), x, (y, s) -> {step})"


def _walked(place: str, n: int, seed: int, backwards: bool) -> Column:
    once = _network(n, seed, backwards)
    first = f"transform(array({place}), x -> {once})[0]"
    walked = f"reduce(sequence(1, {WALK}), {first}, (x, i) -> CASE WHEN x < {n}L THEN x ELSE {once} END)"
    return F.expr(f"transform(array({walked}), x -> CASE WHEN x < {n}L THEN x ELSE raise_error('cycle walk did not end') END)[0]")


def permute(place: str, n: int, seed: int) -> Column:
    """Permuted place of column ``place`` (0 to n - 1)."""
    return _walked(place, n, seed, backwards=False).cast("long")


def unpermute(place: str, n: int, seed: int) -> Column:
    """Inverse of :func:`permute`."""
    return _walked(place, n, seed, backwards=True).cast("long")


def number_rows(docs: DataFrame) -> tuple[DataFrame, int]:
    """Rows ``(doc_id, size, text_crc32, place)`` with gapless places from 0, and how many there are.

    Equal rows are counted before the shuffle; what is left is range-partitioned,
    staged, and numbered inside each range. The driver sees one count per range.
    """
    keyed = docs.select(
        F.col("doc_id"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
    )
    order = ["doc_id", "text_crc32", "size"]
    ranged = stage(
        keyed.groupBy(*order)
        .agg(F.count(F.lit(1)).alias("__copies"))
        .repartitionByRange(*[F.col(c).asc_nulls_first() for c in order])
        .withColumn("__range", F.spark_partition_id())
    )
    counts = sorted((r[0], r[1]) for r in ranged.groupBy("__range").agg(F.sum("__copies")).collect())
    total, offsets = 0, []
    for part, rows in counts:
        offsets.append((part, total))
        total += rows
    spark = docs.sparkSession
    starts = spark.createDataFrame(offsets, "__range int, __offset long")
    placed = ranged.join(F.broadcast(starts), "__range").selectExpr(
        "doc_id",
        "size",
        "text_crc32",
        "__copies",
        "__offset + sum(__copies) OVER (PARTITION BY __range ORDER BY doc_id NULLS FIRST, text_crc32, size"
        " ROWS UNBOUNDED PRECEDING) - __copies AS __first",
    )
    return placed.selectExpr("doc_id", "size", "text_crc32", "explode(sequence(__first, __first + __copies - 1)) AS place"), total


def shard_rows(docs: DataFrame, shards: int = 16, seed: int = 20240229) -> DataFrame:
    """Assign every row a shard and a slot; shard sizes differ by at most one row.

    Returns ``doc_id, size, text_crc32, place, permuted, shard, slot``.
    """
    rows, n = number_rows(docs)
    return rows.withColumn("permuted", permute("place", n, seed)).selectExpr(
        "*", f"CAST(permuted % {shards} AS int) AS shard", f"permuted DIV {shards} AS slot"
    )
