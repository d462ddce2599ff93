import os
import tempfile


from mapweave.functions import geometry as G
from mapweave.operators import spatial as S
from mapweave.plans import catalog
from mapweave.plans import fixtures as FX

from conftest import SF_SMALL


def test_point_in_area_on_a_stream(spark):
    areas = catalog._areas_geom(FX.fx_areas(spark, SF_SMALL)).select("area_id", "geom")
    batch = FX.fx_points(spark, SF_SMALL)
    src = os.path.join(tempfile.mkdtemp(prefix="mapweave-stream-"), "points")
    batch.write.parquet(src)
    stream = spark.readStream.schema(batch.schema).parquet(src).select("point_id", G.point("lon", "lat").alias("pt"))
    joined = S.join_point_in_area(stream, "pt", areas, "geom", area_key="area_id", cell_size=0.25).select("point_id", "area_id")
    q = joined.writeStream.format("memory").queryName("pia_stream").outputMode("append").start()
    try:
        q.processAllAvailable()
        got = sorted(tuple(r) for r in spark.sql("SELECT point_id, area_id FROM pia_stream").collect())
    finally:
        q.stop()
    static = S.join_point_in_area(
        batch.select("point_id", G.point("lon", "lat").alias("pt")), "pt", areas, "geom", area_key="area_id", cell_size=0.25
    ).select("point_id", "area_id")
    assert got == sorted(tuple(r) for r in static.collect())
    assert got
