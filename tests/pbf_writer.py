"""Minimal PBF encoder for tests (protobuf wire format by hand)."""

import struct
import zlib


def varint(v: int) -> bytes:
    v &= (1 << 64) - 1
    out = bytearray()
    while True:
        b = v & 0x7F
        v >>= 7
        if v:
            out.append(b | 0x80)
        else:
            out.append(b)
            return bytes(out)


def zz(v: int) -> int:
    return (v << 1) ^ (v >> 63)


def f_var(num, v):
    return varint(num << 3) + varint(v)


def f_bytes(num, b):
    return varint(num << 3 | 2) + varint(len(b)) + b


def f_packed(num, vals):
    return f_bytes(num, b"".join(varint(v) for v in vals))


def deltas(vals):
    out, prev = [], 0
    for v in vals:
        out.append(v - prev)
        prev = v
    return out


def dense_nodes(nodes, strings):
    """nodes: list of (id, lat_e7, lon_e7, tags dict, (version, ts_s, changeset, uid, user))."""
    sid = {s: i for i, s in enumerate(strings)}
    ids = [zz(d) for d in deltas([n[0] for n in nodes])]
    lats = [zz(d) for d in deltas([n[1] for n in nodes])]
    lons = [zz(d) for d in deltas([n[2] for n in nodes])]
    kv = []
    for n in nodes:
        for k, v in n[3].items():
            kv += [sid[k], sid[v]]
        kv.append(0)
    info = (
        f_packed(1, [n[4][0] for n in nodes])
        + f_packed(2, [zz(d) for d in deltas([n[4][1] for n in nodes])])
        + f_packed(3, [zz(d) for d in deltas([n[4][2] for n in nodes])])
        + f_packed(4, [zz(d) for d in deltas([n[4][3] for n in nodes])])
        + f_packed(5, [zz(d) for d in deltas([sid[n[4][4]] for n in nodes])])
    )
    return f_packed(1, ids) + f_bytes(5, info) + f_packed(8, lats) + f_packed(9, lons) + f_packed(10, kv)


def way(wid, refs, tags, strings):
    sid = {s: i for i, s in enumerate(strings)}
    return (
        f_var(1, wid)
        + f_packed(2, [sid[k] for k in tags])
        + f_packed(3, [sid[v] for v in tags.values()])
        + f_packed(8, [zz(d) for d in deltas(refs)])
    )


def relation(rid, members, tags, strings):
    sid = {s: i for i, s in enumerate(strings)}
    return (
        f_var(1, rid)
        + f_packed(2, [sid[k] for k in tags])
        + f_packed(3, [sid[v] for v in tags.values()])
        + f_packed(8, [sid[m[2]] for m in members])
        + f_packed(9, [zz(d) for d in deltas([m[0] for m in members])])
        + f_packed(10, [m[1] for m in members])
    )


def plain_node(nid, lat_e7, lon_e7):
    return f_var(1, zz(nid)) + f_var(8, zz(lat_e7)) + f_var(9, zz(lon_e7))


def block(strings, groups, granularity=100):
    table = b"".join(f_bytes(1, s.encode()) for s in strings)
    return f_bytes(1, table) + b"".join(f_bytes(2, g) for g in groups) + f_var(17, granularity)


def blob(kind: str, payload: bytes, compress=True) -> bytes:
    body = f_var(2, len(payload)) + f_bytes(3, zlib.compress(payload)) if compress else f_bytes(1, payload)
    header = f_bytes(1, kind.encode()) + f_var(3, len(body))
    return struct.pack(">I", len(header)) + header + body
