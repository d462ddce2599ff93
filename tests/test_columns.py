import pytest
from pyspark.sql import types as T

from mapweave.operators.columns import (
    add_column_prefix,
    aggregate_column_to_list,
    explode_col,
    remove_duplicate_rows,
    wrap_columns_into_struct,
)
from mapweave.schema import check_for_duplicate_columns


def test_prefix_keeps_order(spark):
    df = spark.createDataFrame([("a", "b", "c")], "firstname string, middlename string, lastname string")
    out = add_column_prefix(df, "p_")
    assert out.columns == ["p_firstname", "p_middlename", "p_lastname"]
    assert out.collect()[0] == ("a", "b", "c")


def test_wrap_struct_non_null_and_last(spark):
    df = spark.createDataFrame([(1, 2, "x")], "id int, node_pos int, node_id string")
    out = wrap_columns_into_struct(df, ["node_pos", "node_id"], "node")
    assert out.columns == ["id", "node"]
    field = out.schema["node"]
    assert not field.nullable
    assert field.dataType.names == ["node_pos", "node_id"]


def test_explode_scalar_in_place_with_position(spark):
    df = spark.createDataFrame([("1", [11, 12, 13]), ("2", [21, 22]), ("3", [31]), ("4", None), ("5", [])],
                               "id string, nodes array<bigint>")
    out = explode_col(df, "nodes", explode_prefix="node_id", position_column_name="pos")
    assert out.columns == ["id", "pos", "node_id"]
    assert out.count() == 6
    assert not out.schema["pos"].nullable
    assert sorted(out.where("id = '1'").select("pos", "node_id").collect()) == [(0, 11), (1, 12), (2, 13)]


def test_explode_struct_fields(spark):
    df = spark.createDataFrame(
        [(1, [(7, 1, "outer"), (8, 1, "inner")], "t")],
        "id bigint, relations array<struct<id:bigint,relationType:tinyint,role:string>>, tag string",
    )
    out = explode_col(df, "relations", "way_")
    assert out.columns == ["id", "way_id", "way_relationType", "way_role", "tag"]
    assert sorted(r.way_id for r in out.collect()) == [7, 8]


def test_explode_errors(spark):
    df = spark.createDataFrame([(1, "x")], "id int, s string")
    with pytest.raises(ValueError, match="is not in list of columns"):
        explode_col(df, "nope")
    with pytest.raises(ValueError, match="is not of type array"):
        explode_col(df, "s")


def test_collect_sorted_and_unsorted(spark):
    df = spark.createDataFrame([(1, 77), (1, 1), (1, 5), (2, 0)], "id int, node_id int")
    out = {r.id: r.nodes for r in aggregate_column_to_list(df, ["id"], "node_id", "nodes").collect()}
    assert out == {1: [1, 5, 77], 2: [0]}
    raw = {r.id: sorted(r.nodes) for r in aggregate_column_to_list(df, ["id"], "node_id", "nodes", sort_list=False).collect()}
    assert raw == {1: [1, 5, 77], 2: [0]}


def test_collect_structs_sorted_by_first_field(spark):
    df = spark.createDataFrame([(1, (2, 20)), (1, (1, 10)), (1, (3, 5))], "id int, node struct<node_pos:int,node_id:int>")
    out = aggregate_column_to_list(df, ["id"], "node", "nodes").collect()[0].nodes
    assert [n.node_pos for n in out] == [1, 2, 3]


def _dedupe_df(spark):
    data = [(1, "ag", 3), (1, "kas", 1), (2, "wg", 5), (3, "je", 1), (3, "af", 9)]
    schema = T.StructType([
        T.StructField("id", T.IntegerType(), False),
        T.StructField("str", T.StringType(), True),
        T.StructField("order_no", T.IntegerType(), False),
    ])
    return spark.createDataFrame(data, schema)


def test_dedupe_max_min(spark):
    df = _dedupe_df(spark)
    mx = remove_duplicate_rows(df, "id", "order_no", True)
    mn = remove_duplicate_rows(df, "id", "order_no", False)
    assert sorted(r.str for r in mx.collect()) == ["af", "ag", "wg"]
    assert sorted(r.str for r in mn.collect()) == ["je", "kas", "wg"]
    assert mx.schema == df.schema


def test_dedupe_ties_and_alias(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "b", 1)], "id int, str string, order_no int").alias("test")
    out = remove_duplicate_rows(df, "test.id", "order_no", True, tie_breaker=["str"])
    assert [r.str for r in out.collect()] == ["a"]


def test_dedupe_nulls_last(spark):
    df = spark.createDataFrame([(1, None), (1, "4"), (1, "10")], "id int, admin_level string")
    # string decision: lexicographic, NULL never wins
    assert remove_duplicate_rows(df, "id", "admin_level").collect()[0].admin_level == "4"


def test_duplicate_column_guard(spark):
    a = spark.createDataFrame([("x", "y")], "c1 string, c2 string")
    b = spark.createDataFrame([("x", "y")], "c2 string, c3 string")
    c = spark.createDataFrame([("x",)], "c4 string")
    with pytest.raises(RuntimeError, match="c2"):
        check_for_duplicate_columns(a, b)
    check_for_duplicate_columns(a, c)
    with pytest.raises(AssertionError):
        check_for_duplicate_columns(a, "not a frame")
