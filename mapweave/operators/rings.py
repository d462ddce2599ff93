"""Cycles of linked rows, ranked by pointer jumping.

Rows that each name the next row of their cycle are the common form of ring stitching
(ways that meet end to end) and of face tracing (half-edges around a face). Every round each row joins the
row its pointer names and takes over that one's pointer, so the span a row knows doubles and a
cycle of n rows is ranked in log2(n) rounds, each one equi-join over the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mapweave.session import materialize


def ranked_cycles(links: DataFrame, keys: list[str], longest: int | None = None) -> DataFrame:
    """``(*keys, node, cycle, rank, length)`` of the cycles that ``links (*keys, node, next)`` forms.

    Within ``keys`` each node is the ``next`` of exactly one node. ``cycle`` is the smallest node of
    the cycle, at rank 0. ``longest`` is an upper bound of the rows of one key, counted if
    not given; it only sets the number of rounds.
    """
    if longest is None:
        longest = links.groupBy(*keys).count().agg(F.max("count")).first()[0] or 1
    # smallest node of the span that begins here, and the steps to it
    start = F.struct(F.col("node").alias("low"), F.lit(0).cast("bigint").alias("steps"))
    cur = links.select(*keys, "node", F.col("next").alias("far"), start.alias("best"))
    rounds = max(0, int(longest) - 1).bit_length()
    for n in range(rounds):
        ahead = cur.select(*keys, F.col("node").alias("far"), F.col("far").alias("farther"), F.col("best").alias("then"))
        beyond = F.struct(F.col("then.low").alias("low"), (F.col("then.steps") + 2**n).alias("steps"))
        cur = cur.join(ahead, [*keys, "far"]).select(
            *keys, "node", F.col("farther").alias("far"),
            F.when(F.col("then.low") < F.col("best.low"), beyond).otherwise(F.col("best")).alias("best"),
        )
        if n % 2 or n == rounds - 1:  # two rounds for each table that is written
            cur = materialize(cur, "cycle-links")
    lengths = cur.groupBy(*keys, F.col("best.low").alias("cycle")).agg(F.count(F.lit(1)).alias("length"))
    named = cur.select(*keys, "node", F.col("best.low").alias("cycle"), "best.steps").join(lengths, [*keys, "cycle"])
    return named.select(*keys, "node", "cycle", F.expr("(length - steps) % length").alias("rank"), "length")
