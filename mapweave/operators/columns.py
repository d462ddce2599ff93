"""Schema-shaping operators: prefix, wrap, explode, collect, keyed de-duplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

def _q(name: str) -> Column:
    """Column by exact name (dots and other characters are not parsed)."""
    return F.col("`" + name.replace("`", "``") + "`")


def add_column_prefix(df_in: DataFrame, column_prefix: str) -> DataFrame:
    """Rename every column to ``column_prefix + name``; order is kept."""
    return df_in.select([_q(c).alias(f"{column_prefix}{c}") for c in df_in.columns])


def wrap_columns_into_struct(df_in: DataFrame, columns: Sequence[str], wrap_column: str) -> DataFrame:
    """Replace ``columns`` by one non-null struct column ``wrap_column`` (appended last).

    Field order is the order of ``columns``; it is also the sort order of the
    struct, which :func:`aggregate_column_to_list` relies on.
    """
    return df_in.withColumn(wrap_column, F.struct(*[_q(c) for c in columns])).drop(*columns)


def explode_col(
    df_in: DataFrame,
    column: str,
    explode_prefix: str = "way_",
    position_column_name: str | None = None,
) -> DataFrame:
    """One row per array element, replacing the array column in place.

    * array of struct -> one column per field, named ``explode_prefix + field``;
    * array of scalar -> one column named exactly ``explode_prefix``;
    * ``position_column_name`` adds the 0-based element position before them.

    Rows with a NULL or empty array are dropped (``posexplode`` semantics).
    """
    if column not in df_in.columns:
        raise ValueError(f"Column {column} is not in list of columns: {df_in.columns}")
    column_type = df_in.schema[column].dataType
    if not isinstance(column_type, T.ArrayType):
        raise ValueError(f"Column {column} is not of type array: {column_type}")

    where = df_in.columns.index(column)
    names = [_q(c) for c in df_in.columns]
    position = position_column_name or "__mw_position"
    # the generator stands where the array stood; the element keeps the array's name until it is spread
    rows = df_in.select(*names[:where], F.posexplode(names[where]).alias(position, column), *names[where + 1 :])
    kind = column_type.elementType
    if isinstance(kind, T.StructType):
        parts = [names[where].getField(f).alias(explode_prefix + f) for f in kind.names]
    else:
        parts = [names[where].alias(explode_prefix)]
    shown = [_q(position)] if position_column_name else []
    return rows.select(*names[:where], *shown, *parts, *names[where + 1 :])


def aggregate_column_to_list(
    df_in: DataFrame,
    group_by_columns: Sequence[str],
    collect_column: str,
    result_column: str,
    sort_list: bool = True,
) -> DataFrame:
    """Group by ``group_by_columns``; collect ``collect_column`` into ``result_column``.

    Every other column is carried from one row of the group.
    With ``sort_list`` the list is sorted ascending (structs by field order).
    Catalyst plans a partial (map-side) and a final aggregate.
    """
    keys = [_q(c) for c in group_by_columns]
    rest = _others(df_in, [*group_by_columns, collect_column])
    gathered = F.collect_list(_q(collect_column))
    one_row = [F.any_value(F.struct(*[_q(c) for c in rest])).alias("__mw_rest")] if rest else []
    grouped = df_in.groupBy(*keys).agg((F.sort_array(gathered) if sort_list else gathered).alias(result_column), *one_row)
    return grouped.select(*keys, *[F.col("__mw_rest").getField(c).alias(c) for c in rest], _q(result_column))


def _others(df: DataFrame, taken: Sequence[str]) -> list[str]:
    return [c for c in df.columns if c not in set(taken)]


def remove_duplicate_rows(
    df_input: DataFrame,
    unique_col: str,
    decision_col: str,
    decision_max_first: bool = True,
    tie_breaker: Sequence[str] | None = None,
) -> DataFrame:
    """Keep one row per ``unique_col``: the greatest (or least) ``decision_col``.

    NULL decisions lose against all others; NULL keys form one group.
    ``tie_breaker`` columns (ascending, NULLs last) make the choice deterministic
    among equal decisions. Alias-qualified names such as ``t.id`` are accepted.
    Rows are reduced with ``max_by`` / ``min_by``, so each task combines its
    rows before the shuffle and no group is sorted.
    """
    width = len(df_input.columns)
    ties = list(tie_breaker or [])
    helpers = [F.col(unique_col), F.col(decision_col), *[F.col(t) for t in ties]]
    # names by position: the input may hold equal names from both sides of a join
    flat = df_input.select("*", *helpers).toDF(*[f"c{i}" for i in range(width + len(helpers))])
    row = F.struct(*[F.col(f"c{i}") for i in range(width)]).alias("row")
    key, decision = F.col(f"c{width}").alias("key"), F.col(f"c{width + 1}").alias("decision")
    found = flat.select(key, decision, row, *[F.col(f"c{width + 2 + i}").alias(f"t{i}") for i in range(len(ties))])
    if ties:
        order = F.struct(*[x for i in range(len(ties)) for x in (F.col(f"t{i}").isNull().alias(f"n{i}"), F.col(f"t{i}"))])
        found = found.groupBy("key", "decision").agg(F.min_by("row", order).alias("row"))
    if decision_max_first:
        kept = F.max_by("row", F.struct(F.col("decision").isNotNull().alias("known"), F.col("decision")))
    else:
        kept = F.min_by("row", F.struct(F.col("decision").isNull().alias("unknown"), F.col("decision")))
    # a default that is never taken tells the planner that every group has a row, so columns stay non-null
    sample = [_plain_value(f.dataType) for f in df_input.schema.fields]
    if all(v is not None or f.nullable for v, f in zip(sample, df_input.schema.fields, strict=True)):
        kept = F.coalesce(
            kept,
            F.struct(
                *[
                    (F.lit(None).cast(f.dataType) if f.nullable else F.lit(v).cast(f.dataType)).alias(f"c{i}")
                    for i, (v, f) in enumerate(zip(sample, df_input.schema.fields, strict=True))
                ]
            ),
        )
    out = found.groupBy("key").agg(kept.alias("row"))
    return out.select(*[F.col("row").getField(f"c{i}") for i in range(width)]).toDF(*df_input.columns)


def _plain_value(kind: T.DataType):
    """Some value of an atomic type, None for other types."""
    if isinstance(kind, T.StringType):
        return ""
    if isinstance(kind, T.BooleanType):
        return False
    return 0 if isinstance(kind, T.NumericType) else None
