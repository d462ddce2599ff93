"""OpenStreetMap PBF extracts as a Spark Python data source.

Layout of the format (public specification): the file is a sequence of
``[4-byte big-endian header length][BlobHeader][Blob]``; each ``OSMData`` blob
holds one zlib-compressed (or raw) ``PrimitiveBlock`` with a string table and
groups of nodes, dense nodes, ways and relations.

Work split: the driver only walks the blob headers (offsets and sizes, no
payload) and groups data blobs into partitions of about ``partitionBytes``
compressed bytes. Each task reads and inflates its own blobs and decodes them
with vectorised varint decoding into rows of
:data:`mapweave.schema.ENTITY_SCHEMA`. The path must be readable as a file
system path by the driver and the executors (local or mounted storage).

Use :func:`ingest_pbf` to convert an extract once into Parquet partitioned by
entity kind; later jobs read that with :func:`mapweave.sources.entities.read_entities`.
"""

from __future__ import annotations

import datetime as _dt
import glob
import os
import struct
import zlib
from collections.abc import Sequence

import numpy as np
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from mapweave.schema import ENTITY_SCHEMA

FORMAT_NAME = "mapweave.pbf"
DEFAULT_PARTITION_BYTES = 32 * 1024 * 1024


# ---------------------------------------------------------------- wire format


def _varint(buf: memoryview, pos: int) -> tuple[int, int]:
    result = shift = 0
    while True:
        b = buf[pos]
        pos += 1
        result |= (b & 0x7F) << shift
        if b < 0x80:
            return result, pos
        shift += 7


def _fields(buf) -> list[tuple[int, int, object]]:
    """(field number, wire type, value) of one message; bytes fields as memoryview."""
    buf = memoryview(buf)
    out = []
    pos, end = 0, len(buf)
    while pos < end:
        tag, pos = _varint(buf, pos)
        num, wt = tag >> 3, tag & 7
        if wt == 0:
            val, pos = _varint(buf, pos)
        elif wt == 2:
            n, pos = _varint(buf, pos)
            val = buf[pos : pos + n]
            pos += n
        elif wt == 1:
            val = buf[pos : pos + 8]
            pos += 8
        elif wt == 5:
            val = buf[pos : pos + 4]
            pos += 4
        else:
            raise ValueError(f"unsupported wire type {wt}")
        out.append((num, wt, val))
    return out


def _packed(b) -> np.ndarray:
    """Packed varints -> uint64 array, decoded without a Python loop."""
    a = np.frombuffer(b, dtype=np.uint8)
    if a.size == 0:
        return np.zeros(0, dtype=np.uint64)
    ends = np.flatnonzero(a < 0x80)
    starts = np.concatenate(([0], ends[:-1] + 1))
    group = np.repeat(np.arange(ends.size), ends - starts + 1)
    shift = ((np.arange(a.size) - starts[group]) * 7).astype(np.uint64)
    vals = (a & 0x7F).astype(np.uint64) << shift
    return np.add.reduceat(vals, starts)


def _zigzag(u: np.ndarray) -> np.ndarray:
    u = u.astype(np.uint64)
    return (u >> np.uint64(1)).astype(np.int64) ^ -(u & np.uint64(1)).astype(np.int64)


def _zz(v: int) -> int:
    return (v >> 1) ^ -(v & 1)


def _s64(v: int) -> int:
    """int64/int32 varints carry negatives as two's complement."""
    return v - (1 << 64) if v >= 1 << 63 else v


# ---------------------------------------------------------------- blocks


def _info(msg, strings, date_gran) -> dict | None:
    if msg is None:
        return None
    d = {"version": None, "timestamp": None, "changeset": None, "userId": None, "userName": None, "visible": None}
    for num, _wt, val in _fields(msg):
        if num == 1:
            d["version"] = _s64(int(val))
        elif num == 2:
            d["timestamp"] = _ts(_s64(int(val)) * date_gran)
        elif num == 3:
            d["changeset"] = _s64(int(val))
        elif num == 4:
            d["userId"] = _s64(int(val))
        elif num == 5:
            d["userName"] = strings[int(val)]
        elif num == 6:
            d["visible"] = bool(val)
    return d


def _ts(ms: int):
    return _dt.datetime(1970, 1, 1) + _dt.timedelta(milliseconds=ms)


def _tags(keys, vals, strings) -> dict:
    return {strings[int(k)]: strings[int(v)] for k, v in zip(keys, vals)}


def decode_block(data: bytes):
    """Rows (entity-schema tuples) of one uncompressed PrimitiveBlock."""
    strings: list[str] = []
    groups = []
    gran, lat_off, lon_off, date_gran = 100, 0, 0, 1000
    for num, _wt, val in _fields(data):
        if num == 1:
            strings = [bytes(s).decode("utf-8") for n, _w, s in _fields(val) if n == 1]
        elif num == 2:
            groups.append(val)
        elif num == 17:
            gran = int(val)
        elif num == 18:
            date_gran = int(val)
        elif num == 19:
            lat_off = _s64(int(val))
        elif num == 20:
            lon_off = _s64(int(val))
    for group in groups:
        for num, _wt, val in _fields(group):
            if num == 1:
                yield _plain_node(val, strings, gran, lat_off, lon_off, date_gran)
            elif num == 2:
                yield from _dense_nodes(val, strings, gran, lat_off, lon_off, date_gran)
            elif num == 3:
                yield _way(val, strings, date_gran)
            elif num == 4:
                yield _relation(val, strings, date_gran)


def _plain_node(msg, strings, gran, lat_off, lon_off, date_gran):
    nid = lat = lon = 0
    keys = vals = np.zeros(0, np.uint64)
    info = None
    for num, _wt, val in _fields(msg):
        if num == 1:
            nid = _zz(int(val))
        elif num == 2:
            keys = _packed(val)
        elif num == 3:
            vals = _packed(val)
        elif num == 4:
            info = val
        elif num == 8:
            lat = _zz(int(val))
        elif num == 9:
            lon = _zz(int(val))
    return (
        nid, 0, 1e-9 * (lat_off + gran * lat), 1e-9 * (lon_off + gran * lon), None, None,
        _tags(keys, vals, strings), _info(info, strings, date_gran),
    )


def _dense_nodes(msg, strings, gran, lat_off, lon_off, date_gran):
    ids = lats = lons = kv = None
    dinfo = None
    for num, _wt, val in _fields(msg):
        if num == 1:
            ids = np.cumsum(_zigzag(_packed(val)))
        elif num == 5:
            dinfo = val
        elif num == 8:
            lats = np.cumsum(_zigzag(_packed(val)))
        elif num == 9:
            lons = np.cumsum(_zigzag(_packed(val)))
        elif num == 10:
            kv = _packed(val)
    if ids is None:
        return
    lat = 1e-9 * (lat_off + gran * lats.astype(np.float64))
    lon = 1e-9 * (lon_off + gran * lons.astype(np.float64))
    tags: list[dict] = [{} for _ in range(ids.size)]
    if kv is not None and kv.size:
        i = node = 0
        kvl = kv.tolist()
        while i < len(kvl) and node < ids.size:
            if kvl[i] == 0:
                node += 1
                i += 1
                continue
            tags[node][strings[kvl[i]]] = strings[kvl[i + 1]]
            i += 2
    infos = [None] * ids.size
    if dinfo is not None:
        cols = {}
        for num, _wt, val in _fields(dinfo):
            cols[num] = _packed(val)
        version = cols.get(1)
        ts = np.cumsum(_zigzag(cols[2])) if 2 in cols else None
        cs = np.cumsum(_zigzag(cols[3])) if 3 in cols else None
        uid = np.cumsum(_zigzag(cols[4])) if 4 in cols else None
        sid = np.cumsum(_zigzag(cols[5])) if 5 in cols else None
        vis = cols.get(6)
        for j in range(ids.size):
            infos[j] = {
                "version": int(version[j]) if version is not None and version.size > j else None,
                "timestamp": _ts(int(ts[j]) * date_gran) if ts is not None and ts.size > j else None,
                "changeset": int(cs[j]) if cs is not None and cs.size > j else None,
                "userId": int(uid[j]) if uid is not None and uid.size > j else None,
                "userName": strings[int(sid[j])] if sid is not None and sid.size > j else None,
                "visible": bool(vis[j]) if vis is not None and vis.size > j else None,
            }
    for j in range(ids.size):
        yield (int(ids[j]), 0, float(lat[j]), float(lon[j]), None, None, tags[j], infos[j])


def _way(msg, strings, date_gran):
    wid = 0
    keys = vals = refs = np.zeros(0, np.uint64)
    info = None
    for num, _wt, val in _fields(msg):
        if num == 1:
            wid = _s64(int(val))
        elif num == 2:
            keys = _packed(val)
        elif num == 3:
            vals = _packed(val)
        elif num == 4:
            info = val
        elif num == 8:
            refs = _packed(val)
    nodes = np.cumsum(_zigzag(refs)).tolist() if refs.size else []
    return (wid, 1, None, None, nodes, None, _tags(keys, vals, strings), _info(info, strings, date_gran))


def _relation(msg, strings, date_gran):
    rid = 0
    keys = vals = roles = mems = types = np.zeros(0, np.uint64)
    info = None
    for num, _wt, val in _fields(msg):
        if num == 1:
            rid = _s64(int(val))
        elif num == 2:
            keys = _packed(val)
        elif num == 3:
            vals = _packed(val)
        elif num == 4:
            info = val
        elif num == 8:
            roles = _packed(val)
        elif num == 9:
            mems = _packed(val)
        elif num == 10:
            types = _packed(val)
    ids = np.cumsum(_zigzag(mems)).tolist() if mems.size else []
    members = [(int(i), int(t), strings[int(r)]) for i, t, r in zip(ids, types.tolist(), roles.tolist())]
    return (rid, 2, None, None, None, members, _tags(keys, vals, strings), _info(info, strings, date_gran))


def _inflate(blob: bytes) -> bytes | None:
    raw = zdata = None
    for num, _wt, val in _fields(blob):
        if num == 1:
            raw = bytes(val)
        elif num == 3:
            zdata = bytes(val)
        elif num == 7:
            import zstandard

            return zstandard.ZstdDecompressor().decompress(bytes(val))
        elif num in (4, 5, 6):
            raise ValueError("unsupported blob compression (lzma/bzip2/lz4)")
    if raw is not None:
        return raw
    if zdata is not None:
        return zlib.decompress(zdata)
    return None


# ---------------------------------------------------------------- planning


def blob_index(path: str) -> list[tuple[int, int]]:
    """(offset, size) of every OSMData blob; reads headers only. A file that ends inside a blob raises."""
    out = []
    length = os.path.getsize(path)
    with open(path, "rb") as f:
        while f.tell() < length:
            head = f.read(4)
            hlen = struct.unpack(">I", head)[0] if len(head) == 4 else length
            header = f.read(hlen) if hlen <= length - f.tell() else b""
            kind, size = "", None
            for num, _wt, val in _fields(header):
                if num == 1:
                    kind = bytes(val).decode()
                elif num == 3:
                    size = int(val)
            offset = f.tell()
            if size is None or offset + size > length:
                raise ValueError(f"{path} ends inside a blob at byte {offset} of {length}")
            if kind == "OSMData":
                out.append((offset, size))
            f.seek(size, os.SEEK_CUR)
    return out


class BlobRange(InputPartition):
    def __init__(self, path: str, blobs: list[tuple[int, int]]):
        self.path = path
        self.blobs = blobs


class PbfReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options.get("path")
        self.partition_bytes = int(options.get("partitionBytes", DEFAULT_PARTITION_BYTES))

    def _files(self) -> list[str]:
        found = glob.glob(os.path.join(self.path, "*.pbf")) if os.path.isdir(self.path) else glob.glob(self.path)
        if not found:
            raise FileNotFoundError(f"no PBF file at {self.path}")
        return sorted(found)

    def partitions(self):
        parts: list[BlobRange] = []
        for path in self._files():
            current, size = [], 0
            for blob in blob_index(path):
                current.append(blob)
                size += blob[1]
                if size >= self.partition_bytes:
                    parts.append(BlobRange(path, current))
                    current, size = [], 0
            if current:
                parts.append(BlobRange(path, current))
        return parts or [BlobRange("", [])]

    def read(self, partition: BlobRange):
        if not partition.blobs:
            return
        with open(partition.path, "rb") as f:
            for offset, size in partition.blobs:
                f.seek(offset)
                data = _inflate(f.read(size))
                if data is not None:
                    yield from decode_block(data)


class PbfDataSource(DataSource):
    """``spark.read.format("mapweave.pbf").load(path)`` -> entity rows."""

    @classmethod
    def name(cls) -> str:
        return FORMAT_NAME

    def schema(self):
        return ENTITY_SCHEMA

    def reader(self, schema):
        return PbfReader(self.options)


def register(spark: SparkSession) -> None:
    from mapweave.session import ship_package

    ship_package(spark)
    spark.dataSource.register(PbfDataSource)


def ingest_pbf(
    spark: SparkSession, pbf_path: str, out_path: str, partition_bytes: int | None = None, hot_tags: Sequence[str] = ()
) -> None:
    """Convert a PBF extract (file, folder or glob) into Parquet partitioned by kind, ``hot_tags`` as columns of their own."""
    from mapweave.sources.entities import write_entities

    register(spark)
    reader = spark.read.format(FORMAT_NAME)
    if partition_bytes:
        reader = reader.option("partitionBytes", str(partition_bytes))
    write_entities(reader.load(pbf_path), out_path, hot_tags=hot_tags)
