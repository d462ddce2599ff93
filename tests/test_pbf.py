import datetime as dt
import os
import tempfile

from pbf_writer import blob, block, dense_nodes, f_bytes, plain_node, relation, way

from mapweave.sources.entities import read_entities
from mapweave.sources.pbf import ingest_pbf

STRINGS = ["", "highway", "residential", "name", "Main", "type", "multipolygon", "outer", "admin_centre", "alice"]


def _write(path):
    nodes = [
        (10, 425000000, 15000000, {}, (1, 1700000000, 5, 7, "alice")),
        (11, 425000100, 15000200, {"name": "Main"}, (2, 1700000100, 6, 7, "alice")),
        (12, 424999900, 14999800, {}, (1, 1700000200, 6, 8, "alice")),
    ]
    g1 = f_bytes(2, dense_nodes(nodes, STRINGS))
    g2 = f_bytes(1, plain_node(-5, -10000000, 20000000))
    g3 = f_bytes(3, way(100, [10, 11, 12, 10], {"highway": "residential"}, STRINGS))
    g4 = f_bytes(4, relation(200, [(100, 1, "outer"), (10, 0, "admin_centre")], {"type": "multipolygon"}, STRINGS))
    with open(path, "wb") as f:
        f.write(blob("OSMHeader", b"", compress=False))
        f.write(blob("OSMData", block(STRINGS, [g1, g2])))
        f.write(blob("OSMData", block(STRINGS, [g3])))
        f.write(blob("OSMData", block(STRINGS, [g4]), compress=False))


def test_pbf_reader_and_ingest(spark):
    root = tempfile.mkdtemp(prefix="mapweave-pbf-")
    path = os.path.join(root, "tiny.osm.pbf")
    _write(path)
    m = read_entities(spark, path, fmt="pbf")
    nodes = {r.id: r for r in m.nodes.collect()}
    assert sorted(nodes) == [-5, 10, 11, 12]
    assert abs(nodes[11].latitude - 42.50001) < 1e-12 and abs(nodes[11].longitude - 1.50002) < 1e-12
    assert nodes[11].tags == {"name": "Main"} and nodes[10].tags == {}
    assert nodes[11].info.version == 2 and nodes[11].info.userName == "alice"
    assert nodes[11].info.timestamp == dt.datetime(2023, 11, 14, 22, 15, 0)
    assert abs(nodes[-5].latitude + 1.0) < 1e-12 and abs(nodes[-5].longitude - 2.0) < 1e-12
    (w,) = m.ways.collect()
    assert (w.id, w.nodes, w.tags) == (100, [10, 11, 12, 10], {"highway": "residential"})
    (r,) = m.relations.collect()
    assert r.id == 200 and [(x.id, x.relationType, x.role) for x in r.relations] == [(100, 1, "outer"), (10, 0, "admin_centre")]

    out = os.path.join(root, "parquet")
    ingest_pbf(spark, path, out, partition_bytes=1)  # one blob per partition
    back = read_entities(spark, out)
    assert (back.nodes.count(), back.ways.count(), back.relations.count()) == (4, 1, 1)


def test_wrong_paths_and_cut_files_raise(spark, tmp_path):
    import pytest

    from mapweave.sources.pbf import blob_index

    for bad in (tmp_path / "none.osm.pbf", tmp_path):  # a folder without any *.pbf file as well
        with pytest.raises(Exception, match="no PBF file"):
            read_entities(spark, str(bad), fmt="pbf").nodes.count()
    whole = tmp_path / "tiny.osm.pbf"
    _write(str(whole))
    data = whole.read_bytes()
    assert len(blob_index(str(whole))) == 3
    for cut in (1, 3, 10):
        part = tmp_path / f"cut{cut}.osm.pbf"
        part.write_bytes(data[:-cut])
        with pytest.raises(ValueError, match="ends inside a blob"):
            blob_index(str(part))
        part.write_bytes(data + data[:cut])
        with pytest.raises(ValueError, match="ends inside a blob"):
            blob_index(str(part))
