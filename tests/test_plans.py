"""Plan guards: spatial work must stay on equi-joins, filters must reach the scan."""

import pytest

from mapweave.plans import catalog

from conftest import SF_SMALL

SPATIAL = ["point_in_area", "point_in_area_hole", "nearest_left", "nearest_area_distance", "invalid_areas", "address_list"]


@pytest.mark.parametrize("name", SPATIAL)
def test_no_nested_loop_or_cartesian(spark, name):
    df = catalog.QUERIES[name](spark, SF_SMALL)
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoopJoin" not in plan
    assert "CartesianProduct" not in plan


def test_projection_and_pushdown_reach_the_scan(spark):
    from mapweave.sources.entities import read_entities, write_entities
    from mapweave.plans import fixtures as FX
    import os
    import tempfile

    path = os.path.join(tempfile.mkdtemp(prefix="mapweave-plan-"), "entities")
    write_entities(FX.fx_entities(spark, SF_SMALL), path)
    ways = read_entities(spark, path).ways.select("id", "nodes").where("id > 100")
    plan = ways._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(type" in plan and "PushedFilters: [IsNotNull(id), GreaterThan(id,100)]" in plan
    assert "ReadSchema: struct<id:bigint,nodes:array<bigint>>" in plan


def test_hot_tags_are_pushed_into_the_scan(spark, tmp_path):
    from mapweave.plans import fixtures as FX
    from mapweave.sources.entities import read_entities, tag_column, write_entities

    path = str(tmp_path / "entities")
    write_entities(FX.fx_entities(spark, SF_SMALL), path, hot_tags=["addr:housenumber", "none"])
    m = read_entities(spark, path, hot_tags=["addr:housenumber", "none"])
    hit = m.nodes.where(f"`{tag_column('addr:housenumber')}` = '7'")
    plan = hit.select("id")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(`tag:addr:housenumber`,7)" in plan and "tags" not in plan.split("ReadSchema")[1].split("\n")[0]
    want = FX.fx_nodes(spark, SF_SMALL).where("try_element_at(tags, 'addr:housenumber') = '7'").count()
    assert hit.count() == want > 0
    assert m.nodes.where(f"`{tag_column('none')}` IS NOT NULL").count() == 0


def test_tags_stay_out_of_the_exchanges_of_features(spark):
    df = catalog.QUERIES["features_union"](spark, SF_SMALL)
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().explainString(
        spark.sparkContext._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    blocks = [b for b in plan.split("\n\n") if b.split("\n")[0].rstrip().endswith("Exchange")]
    assert blocks and not any("tags#" in b for b in blocks)
