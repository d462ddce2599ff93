import os
import tempfile

from mapweave.plans import fixtures as FX
from mapweave.sources.entities import read_entities, read_table, write_entities, write_table

from conftest import SF_SMALL


def test_entity_round_trip_with_kind_pruning(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="mapweave-test-"), "entities")
    raw = FX.fx_entities(spark, SF_SMALL)
    write_entities(raw, path)
    frames = read_entities(spark, path)
    assert frames.nodes.count() == raw.where("type = 0").count()
    assert frames.ways.count() == raw.where("type = 1").count()
    assert frames.relations.count() == raw.where("type = 2").count()
    plan = frames.ways._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "type" in plan


def test_table_round_trip(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="mapweave-test-"), "t")
    df = FX.fx_points(spark, SF_SMALL)
    write_table(df, path, files=2)
    back = read_table(spark, path)
    assert sorted(back.collect()) == sorted(df.collect())


def test_entry_flagship(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.columns == ["street", "plz", "city", "housenumber", "longitude", "latitude"]
    assert df.count() > 0
    assert set(E.oracle_sql()) <= set(E.queries())


def test_output_files(spark, tmp_path):
    df = spark.range(0, 1000, 1, 7).withColumnRenamed("id", "plz")
    write_table(df, str(tmp_path / "all"))
    write_table(df, str(tmp_path / "some"), files=3, order=["plz"])
    parts = lambda name: sorted(p.name for p in (tmp_path / name).glob("part-*"))
    assert len(parts("all")) == 7 and len(parts("some")) == 3
    spans = []
    for p in parts("some"):
        ids = [r.plz for r in spark.read.parquet(str(tmp_path / "some" / p)).collect()]
        assert ids == sorted(ids)
        spans.append((min(ids), max(ids)))
    spans.sort()
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))


def test_staged_tables_have_an_owner(spark):
    import os

    from mapweave import session
    from mapweave.plans import catalog

    before = session.staged_tables(spark)
    with session.staging(spark):
        rows = catalog.QUERIES["nearest_left"](spark, SF_SMALL).count()
        made = [p.removeprefix("file:") for p in session.staged_tables(spark)[len(before):]]
        assert rows and made and all(os.path.isdir(p) for p in made)
    assert session.staged_tables(spark) == before
    assert not any(os.path.exists(p) for p in made)


def test_no_folder_off_a_local_master_raises():
    import types

    import pytest

    from mapweave import session

    assert session.is_local("local") and session.is_local("local[4]")
    assert not session.is_local("local-cluster[3,2,3000]") and not session.is_local("spark://host:7077")
    context = types.SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077")
    conf = types.SimpleNamespace(get=lambda key, default=None: default)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(types.SimpleNamespace(sparkContext=context, conf=conf))


def test_measured_bytes_bound_the_row_format(spark):
    from pyspark.sql import functions as F

    from mapweave import session

    df = spark.range(50).select(
        "id", F.repeat(F.lit("x"), 100).alias("s"), F.array_repeat(F.struct(F.lit(1.0).alias("a"), F.lit(2.0).alias("b")), 10).alias("v")
    )
    assert 50 * (8 + 100 + 160) <= session.measured_bytes(df) <= 50 * 800
    assert session.measured_bytes(df.limit(0)) == 0
