"""N-gram Jaccard join: size-aware, heavy-light.

A document's set are its distinct shingles of ``SHINGLE`` words as 64-bit hashes (fewer
words: the whole sequence as one). Two documents link when their Jaccard similarity is
at least ``LEAST`` / 100; callers can hand in other values of both. Documents with equal sets are one class; only one
document of a class goes on.

Small sets (light): two sets of sizes a <= b link exactly when they share
``c(a, b)`` elements. Every set lists its c-element subsets as hashed keys, for
each partner size; who shares a key is linked, without looking at any pair. A
set is small while its subsets are cheaper than scanning: see :func:`boundary`.

Large sets (heavy): the inverted lists of each set's prefix are scanned. The
global order puts elements by the number of documents that have them, rare ones
first. A set whose prefix has only elements of its own links with nothing; this is
settled by one count over all elements (:func:`_dealt`, packed arrays, one entry
for each distinct element of a slice, so frequent elements are combined before
the shuffle). What is left forms lists. A list does not emit its pairs: sorted by
size, neighbours whose sizes may link are chained, which tells the candidate groups;
lists of frequent elements are salted and their heads chained again. Elements that unrelated
texts share by chance join more and more of them as the table grows, so a group too large for one task is
sieved: a set's parts are its elements in ranges of values, more ranges than two linked
sets can differ in elements, so linked sets have equal parts (:func:`part_keys`), and
what equal parts join is a group of its own. The sets
of a candidate group then meet, and the exact overlaps are counted there from the
inverted lists of the group. Groups over ``GROUP_SETS`` sets or ``GROUP_ITEMS``
elements are split into blocks, and every two blocks meet in a task of their
own, so no task holds an unbounded group and no link is lost. A task returns a
spanning forest of its links, never all pairs.

Defined cases: NULL or word-free texts have the empty set, size 0, and link with
nothing; a NULL doc_id takes no part in links and has a NULL component; rows with
one doc_id are one node; repeated rows are linked with each other; an empty table
gives no rows. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WordTable, connected_components, mix64, sized, stage, staged_table, text_slices, with_package

SHINGLE, LEAST = 3, 90
FREQUENT = 200_000  # most elements whose counts order the scan (16 bytes each); the others are ordered by hash
SEEN_LEAST = 16  # documents that must have an element for its count to be kept
HOT_LIST = 4096  # documents that have an element whose list is salted
SALTS = 64
KEY_BITS = 48  # of an element, where elements are only counted
SLICE_ROWS = 50_000
GROUP_SETS, GROUP_ITEMS = 3000, 1_000_000  # bounds of one verification task


def shared(a: int, b: int, least: int = LEAST) -> int:
    """Smallest overlap of linked sets of sizes a and b."""
    return -(-least * (a + b) // (100 + least))


def partners(n: int, least: int = LEAST) -> range:
    """Sizes that a linked set can have."""
    return range(-(-least * n // 100), 100 * n // least + 1)


def subset_keys(n: int, least: int = LEAST) -> int:
    """Number of subset keys a small set of size n emits."""
    return sum(comb(n, c) for m in partners(n, least) if (c := shared(n, m, least)) <= min(n, m))


def prefix_length(n: int, least: int = LEAST) -> int:
    return n - -(-least * n // 100) + 1


def boundary(least: int = LEAST) -> int:
    """Largest size up to which listing subsets costs less than scanning.

    Scanning a prefix element costs the list entry and, for a candidate, a merge of
    two sets; a set meets about one candidate for each prefix element.
    """
    n = 1
    while subset_keys(n + 1, least) <= 2 * (n + 1) * prefix_length(n + 1, least):
        n += 1
    return n


# ------------------------------------------------------------------ equal parts of linked sets


@lru_cache(maxsize=64)
def size_classes(top: int, least: int = LEAST) -> tuple[int, ...]:
    """First sizes of the classes up to that of ``top`` and of the two after it; linked sets are of one class or of neighbours."""
    firsts = [1]
    while firsts[-1] <= top:
        firsts.append(100 * firsts[-1] // least + 1)
    return (*firsts, 100 * firsts[-1] // least + 1)


@lru_cache(maxsize=1024)
def part_bounds(last: int, least: int = LEAST) -> tuple[np.ndarray, int]:
    """Lower bounds of the parts for a class that ends at size ``last``, and how many of them may be left out.

    Linked sets, the smaller of that class, differ in ``differ`` elements at most, so of
    ``differ + 1 + spare`` parts at least ``spare + 1`` are equal.
    """
    differ = (last + 100 * last // least) * (100 - least) // (100 + least)
    spare = differ // 8 + 1
    parts = differ + 1 + spare
    return np.array([(k << 64) // parts for k in range(parts)], np.uint64), spare


def part_keys(s: np.ndarray, least: int = LEAST) -> np.ndarray:
    """Hashes of the parts of a sorted set; linked sets have one in common.

    Once with the parts of its size class, once with those of the class before. The smallest parts tell least and
    are left out: fewer than any linked set has in common with this one, so the largest
    equal part is kept on both sides.
    """
    firsts = size_classes(1 << len(s).bit_length(), least)
    own = bisect_right(firsts, len(s)) - 1
    out = []
    with np.errstate(over="ignore"):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix64(s ^ np.uint64(0x9E3779B97F4A7C15)))])
        for c in range(max(0, own - 1), own + 1):
            bounds, spare = part_bounds(firsts[c + 1] - 1, least)
            at = np.append(np.searchsorted(s, bounds), len(s))
            size = np.diff(at)
            kept = np.flatnonzero(size >= np.partition(size, spare)[spare])
            place = (np.uint64(c) << np.uint64(40)) + kept.astype(np.uint64)
            out.append(mix64((sums[at[kept + 1]] - sums[at[kept]]) ^ mix64(place + np.uint64(1))))
    return np.concatenate(out)


# ------------------------------------------------------------------ sets of one slice of texts


def shingle_sets(texts: pa.Array, shingle: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of every text."""
    table = WordTable(texts, lower=True)
    if not len(table.words):
        return [np.zeros(0, np.uint64)] * len(texts)
    hashed = pd.util.hash_array(table.words.to_numpy(zero_copy_only=False), categorize=False).astype(np.uint64)
    h = hashed[table.codes]
    out = []
    with np.errstate(over="ignore"):
        starts = max(0, len(h) - shingle + 1)
        grams = h[:starts]
        for k in range(1, shingle):
            factor = np.uint64(0x9E3779B97F4A7C15 if k == 1 else 0xD6E8FEB86659FD93)
            grams = mix64(grams * factor + h[k : k + starts])
        for a, b in zip(table.bounds[:-1], table.bounds[1:], strict=True):
            if b - a >= shingle:
                out.append(np.unique(grams[a : b - shingle + 1]))
            elif b > a:
                whole = np.uint64(b - a)
                for x in h[a:b]:
                    whole = mix64(np.uint64(whole) * np.uint64(0xA0761D6478BD642F) + x)
                out.append(np.array([whole], np.uint64))
            else:
                out.append(np.zeros(0, np.uint64))
    return out


def _signature(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


# rows between the counting stages: kind 0 has the documents of a slice, 1 elements on the way
# to their bucket, 2 counts on the way back to their slice, 3 frequent elements
_COUNTING = "kind int, bucket int, slice bigint, a binary, b binary, c binary, d binary, token bigint, seen bigint"
_COUNTING_ARROW = pa.schema(
    [("kind", pa.int32()), ("bucket", pa.int32()), ("slice", pa.int64())]
    + [(c, pa.binary()) for c in "abcd"]
    + [("token", pa.int64()), ("seen", pa.int64())]
)
_COUNTED = "doc_id bigint, n bigint, sig binary, alone bigint"


def _planes(keys: np.ndarray) -> bytes:
    """The low six bytes of sorted keys, byte plane by byte plane, so that equal high bytes stand together."""
    return keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, : KEY_BITS // 8].T.tobytes()


def _from_planes(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(KEY_BITS // 8, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, : KEY_BITS // 8] = planes.T
    return out.view("<u8").ravel()


def _counting_rows(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=_COUNTING_ARROW)


def _runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First index and length of the runs of equal sorted keys."""
    if not len(keys):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return first, np.diff(np.append(first, len(keys)))


def _dealt(batches: Iterable[pa.RecordBatch], buckets: int, shingle: int) -> Iterator[pa.RecordBatch]:
    """Documents of each slice, and its distinct elements dealt to buckets by value.

    An element that one document of the slice has goes with the document's place, one
    that several have goes with their number only.
    """
    part, number = TaskContext.get().partitionId(), 0
    for batch in batches:
        for rows in (r.slice(k, SLICE_ROWS) for r in text_slices(batch) for k in range(0, len(r), SLICE_ROWS)):
            key, number = part << 32 | number, number + 1
            sets = shingle_sets(rows.column("text"), shingle)
            sizes = np.array([len(x) for x in sets], np.int64)
            ids = rows.column("doc_id")
            out = [
                {
                    "kind": 0, "bucket": key % buckets, "slice": key,
                    "a": pc.fill_null(ids, 0).to_numpy(zero_copy_only=False).astype("<i8").tobytes(),
                    "b": sizes.astype("<i8").tobytes(),
                    "c": b"".join(_signature(x) for x in sets),
                    "d": pc.is_null(ids).to_numpy(zero_copy_only=False).astype(np.uint8).tobytes(),
                }
            ]
            keys = np.concatenate(sets) >> np.uint64(64 - KEY_BITS)
            owner = np.repeat(np.arange(len(sets)), sizes)
            order = np.argsort(keys)
            keys, owner = keys[order], owner[order]
            first, count = _runs(keys)
            single = count == 1
            alone, its = keys[first[single]], owner[first[single]]
            several, times = keys[first[~single]], count[~single]
            edges = (np.arange(buckets + 1, dtype=object) * (1 << KEY_BITS) // buckets).astype(np.uint64)
            at, bt = np.searchsorted(alone, edges), np.searchsorted(several, edges)
            for k in range(buckets):
                if at[k] < at[k + 1] or bt[k] < bt[k + 1]:
                    out.append(
                        {
                            "kind": 1, "bucket": k, "slice": key,
                            "a": _planes(alone[at[k] : at[k + 1]]), "b": its[at[k] : at[k + 1]].astype("<u2").tobytes(),
                            "c": _planes(several[bt[k] : bt[k + 1]]), "d": times[bt[k] : bt[k + 1]].astype("<u4").tobytes(),
                        }
                    )
            yield _counting_rows(out)


def _counted_bucket(held: list[tuple]) -> list[dict]:
    """Per slice, how many elements of each document no other document has; and the frequent elements."""
    alone = [_from_planes(a) for _, a, _, _, _ in held]
    several = [_from_planes(c) for _, _, _, c, _ in held]
    slices = np.repeat(np.arange(len(held)), [len(x) for x in alone])
    owner = np.concatenate([np.frombuffer(b, "<u2") for _, _, b, _, _ in held])
    n_alone = len(owner)
    keys = np.concatenate([*alone, *several])
    weight = np.concatenate([np.ones(n_alone, np.int64), *(np.frombuffer(d, "<u4").astype(np.int64) for *_, d in held)])
    order = np.argsort(keys)
    first, count = _runs(keys[order])
    if not len(first):
        return []
    seen = np.add.reduceat(weight[order], first)
    mine = order[first[(count == 1) & (seen == 1)]]
    out = []
    by_slice = mine[np.argsort(slices[mine], kind="stable")]
    cuts = np.searchsorted(slices[by_slice], np.arange(len(held) + 1))
    for k, (key, *_) in enumerate(held):
        if cuts[k] < cuts[k + 1]:
            counts = np.minimum(np.bincount(owner[by_slice[cuts[k] : cuts[k + 1]]]), 65535)
            out.append({"kind": 2, "slice": key, "a": counts.astype("<u2").tobytes()})
    often = np.flatnonzero(seen >= SEEN_LEAST)
    tokens = keys[order][first[often]].astype(np.int64)
    out += [{"kind": 3, "token": t, "seen": n} for t, n in zip(tokens.tolist(), seen[often].tolist(), strict=True)]
    return out


def _counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Buckets arrive one after the other; one is held at a time. Document rows pass through."""
    bucket, held = None, []
    for batch in batches:
        for row in batch.to_pylist():
            if row["kind"] == 0:
                yield _counting_rows([row])
                continue
            if row["bucket"] != bucket and held:
                yield _counting_rows(_counted_bucket(held))
                held = []
            bucket = row["bucket"]
            held.append((row["slice"], row["a"], row["b"], row["c"], row["d"]))
    if held:
        yield _counting_rows(_counted_bucket(held))


def _summed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one slice stand together, its documents first: one row per document with all its counts."""
    docs, alone = None, np.zeros(0, np.int64)

    def flush():
        ids, null = np.frombuffer(docs["a"], "<i8"), np.frombuffer(docs["d"], np.uint8).astype(bool)
        sigs = [docs["c"][k : k + 16] for k in range(0, len(docs["c"]), 16)]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(ids, pa.int64(), mask=null),
                pa.array(np.frombuffer(docs["b"], "<i8"), pa.int64()),
                pa.array(sigs, pa.binary()),
                pa.array(alone, pa.int64()),
            ],
            names=["doc_id", "n", "sig", "alone"],
        )

    for batch in batches:
        for row in batch.select(["kind", "slice", "a", "b", "c", "d"]).to_pylist():
            if row["kind"] == 0:
                if docs is not None:
                    yield flush()
                docs, alone = row, np.zeros(len(row["a"]) // 8, np.int64)
            else:
                counts = np.frombuffer(row["a"], "<u2")
                alone[: len(counts)] += counts
    if docs is not None:
        yield flush()


def _subset_rows(s: np.ndarray, least: int) -> Iterator[tuple[int, int, int]]:
    """Keys (hash of subset and both sizes, smaller size) of a small set; for own size ``n`` every partner size."""
    n = len(s)
    for m in partners(n, least):
        a, b = min(n, m), max(n, m)
        c = shared(a, b, least)
        if c > a:
            continue
        head = np.array([a, b], "<u8").tobytes()
        for subset in combinations(s.tolist(), c):
            digest = hashlib.blake2b(head + np.array(subset, np.uint64).tobytes(), digest_size=8).digest()
            yield int.from_bytes(digest, "little", signed=True), a, n


def _lists(batches: Iterable[pa.RecordBatch], frequent, least: int, small: int, shingle: int) -> Iterator[pa.RecordBatch]:
    """Rows of the inverted lists: ``kind`` 0 for subsets of small sets, 1 for prefix elements.

    ``part`` is the smaller size of a subset key, or the salt of a frequent element.
    """
    schema = pa.schema([("kind", pa.int32()), ("token", pa.int64()), ("part", pa.int32()), ("n", pa.int32()), ("node", pa.int64())])
    often_t, often_n = frequent.value
    for batch in batches:
        for rows in text_slices(batch):
            light, heavy = [], []
            for node, s in zip(rows.column("doc_id").to_pylist(), shingle_sets(rows.column("text"), shingle), strict=True):
                n = len(s)
                if not n:
                    continue
                if n <= small:
                    light += [(0, key, a, size, node) for key, a, size in _subset_rows(s, least)]
                if n > small or 100 * n >= least * (small + 1):
                    count = np.zeros(n, np.int64)
                    if len(often_t):
                        keys = s >> np.uint64(64 - KEY_BITS)
                        at = np.minimum(np.searchsorted(often_t, keys), len(often_t) - 1)
                        count = np.where(often_t[at] == keys, often_n[at], 0)
                    first = np.lexsort((s, count))[: prefix_length(n, least)]
                    salt = int(mix64(np.array([node], np.int64).view(np.uint64))[0] % np.uint64(SALTS)) + 1
                    part = np.where(count[first] >= HOT_LIST, salt, 0)
                    heavy += [(1, t, p, n, node) for t, p in zip(s[first].view(np.int64).tolist(), part.tolist(), strict=True)]
            cols = list(zip(*light, *heavy, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)


def _parts(batches: Iterable[pa.RecordBatch], least: int, shingle: int) -> Iterator[pa.RecordBatch]:
    """Part keys of the sets of groups."""
    for batch in batches:
        for rows in text_slices(batch):
            keys = [part_keys(s, least) if len(s) else s for s in shingle_sets(rows.column("text"), shingle)]
            owner = np.repeat(np.arange(len(keys)), [len(k) for k in keys])
            token = pa.array(np.concatenate(keys).view(np.int64), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [rows.column("comp").take(pa.array(owner)), token, rows.column("doc_id").take(pa.array(owner))], names=["comp", "token", "node"]
            )


def _chained(rows: DataFrame, by: list[str]) -> DataFrame:
    """Neighbours in the order of size within each list, with what stands before each row."""
    w = Window.partitionBy(*by).orderBy("n", "node")
    return rows.withColumn("before", F.lag("node").over(w)).withColumn("n_before", F.lag("n").over(w))


def _in_blocks(groups: DataFrame, sizes: DataFrame) -> DataFrame:
    """``doc_id, comp, blocks``: the members of groups ``node, comp`` and how many blocks their group is split into."""
    bounds = groups.join(sizes, "node").groupBy("comp").agg(F.count(F.lit(1)).alias("sets"), F.sum("n").alias("items"))
    blocks = F.expr(f"CAST(ceil(greatest(sets / {GROUP_SETS}, items / {GROUP_ITEMS})) AS int)")
    return groups.join(bounds.select("comp", blocks.alias("blocks")), "comp").select(F.col("node").alias("doc_id"), "comp", "blocks")


# ------------------------------------------------------------------ verification of one group


def forest(sizes: np.ndarray, sets: list[np.ndarray], least: int, skip_below: int = 0, split: int | None = None) -> list[tuple[int, int]]:
    """Links (i, j) that span the components of ``sets``; exact overlaps from the group's own inverted lists.

    With ``split``, only pairs between ``[0, split)`` and the rest are looked at. Pairs whose
    both sizes are at most ``skip_below`` are left to the subset keys.
    """
    m = len(sets)
    flat = np.concatenate(sets) if m else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(m), sizes)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    heads = np.flatnonzero(np.concatenate([[True], flat[1:] != flat[:-1]]))
    tails = np.append(heads[1:], len(flat))
    several = tails - heads > 1
    # the lists each set stands in, only those with company
    list_of = np.repeat(np.arange(len(heads)), tails - heads)
    in_company = several[list_of]
    by_owner = np.argsort(owner[in_company], kind="stable")
    own_lists = list_of[in_company][by_owner]
    own_bounds = np.searchsorted(owner[in_company][by_owner], np.arange(m + 1))
    parent = np.arange(m)

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    roots = np.arange(m)
    links = []
    for x in range(m):
        lists = own_lists[own_bounds[x] : own_bounds[x + 1]]
        if not len(lists):
            continue
        lo, hi = (0, m) if split is None else ((split, m) if x < split else (0, split))
        if split is not None and x >= split:
            break
        lengths = tails[lists] - heads[lists]
        ends = np.cumsum(lengths)
        at = np.repeat(heads[lists] - (ends - lengths), lengths) + np.arange(ends[-1])
        overlap = np.bincount(owner[at], minlength=m)
        rx = root(x)
        overlap[: x + 1] = 0
        overlap[:lo] = 0
        overlap[hi:] = 0
        linked = np.flatnonzero((overlap * (100 + least) >= least * (sizes + sizes[x])) & (overlap > 0))
        if skip_below and sizes[x] <= skip_below:
            linked = linked[sizes[linked] > skip_below]
        for y in linked[roots[linked] != roots[x]].tolist():
            ry = root(y)
            if ry != rx:
                parent[max(rx, ry)] = min(rx, ry)
                rx = min(rx, ry)
                links.append((x, y))
                roots[y] = rx
        roots[x] = rx
    return links


def _verify(batches: Iterable[pa.RecordBatch], least: int, small: int) -> Iterator[pa.RecordBatch]:
    """Groups arrive sorted by (comp, i, j); one group is held at a time."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    key, held = None, []

    def flush():
        seen = {}
        for side, node, blob in held:
            seen.setdefault((side, node, blob), None)
        rows = sorted(seen, key=lambda r: (r[0], r[1]))
        sets = [np.frombuffer(r[2], np.uint64) for r in rows]
        sizes = np.array([len(s) for s in sets], np.int64)
        split = sum(r[0] == 0 for r in rows) if key[1] != key[2] else None
        links = forest(sizes, sets, least, small, split)
        return pa.RecordBatch.from_pydict({"a": [rows[i][1] for i, _ in links], "b": [rows[j][1] for _, j in links]}, schema=schema)

    for batch in batches:
        cols = [batch.column(c).to_pylist() for c in ("comp", "i", "j", "side", "node", "blob")]
        for comp, i, j, side, node, blob in zip(*cols, strict=True):
            if key is not None and key != (comp, i, j):
                yield flush()
                held = []
            key = (comp, i, j)
            held.append((side, node, blob))
    if key is not None:
        yield flush()


def _sets(batches: Iterable[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    """Sets of the documents of candidate groups, once for every block pair they belong to."""
    schema = pa.schema(
        [("comp", pa.int64()), ("i", pa.int32()), ("j", pa.int32()), ("side", pa.int32()), ("node", pa.int64()), ("blob", pa.binary())]
    )
    for batch in batches:
        for rows in text_slices(batch):
            out = {c: [] for c in schema.names}
            cols = [rows.column(c).to_pylist() for c in ("comp", "blocks", "doc_id")]
            for comp, blocks, node, s in zip(*cols, shingle_sets(rows.column("text"), shingle), strict=True):
                if not len(s):
                    continue
                mine = int(mix64(np.array([node], np.int64).view(np.uint64))[0] % np.uint64(blocks))
                for other in range(blocks):
                    i, j = min(mine, other), max(mine, other)
                    for c, v in zip(schema.names, (comp, i, j, int(mine != i), node, s.tobytes()), strict=True):
                        out[c].append(v)
            yield pa.RecordBatch.from_pydict(out, schema=schema)


# ------------------------------------------------------------------ the join


def link(docs: DataFrame, least: int = LEAST, shingle: int = SHINGLE) -> DataFrame:
    """Per row: ``doc_id, n_shingles, component_id, class_id``."""
    with_package(docs)
    spark = docs.sparkSession
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    small = boundary(least)

    buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = texts.mapInArrow(lambda b: _dealt(b, buckets, shingle), _COUNTING).repartition("bucket").sortWithinPartitions("bucket")
    counting, counting_done = staged_table(dealt.mapInArrow(_counted, _COUNTING), "counts")
    by_slice = counting.where("kind IN (0, 2)").repartition("slice").sortWithinPartitions("slice", "kind")
    survey = stage(by_slice.mapInArrow(_summed, _COUNTED))
    often = counting.where("kind = 3").select("token", "seen").orderBy(F.desc("seen"), "token").limit(FREQUENT).toArrow()
    counting_done()
    tokens = often["token"].to_numpy().astype(np.uint64)
    order = np.argsort(tokens)
    frequent = spark.sparkContext.broadcast((tokens[order], often["seen"].to_numpy().astype(np.int64)[order]))

    rows = survey.select("doc_id", "n", "sig")
    known = survey.where("n > 0 AND doc_id IS NOT NULL")
    classes = stage(known.groupBy("sig").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.max("alone").alias("alone")))

    # sets with a prefix of their own link with nothing; of the others the smallest id of a class goes on
    prefix = F.expr(f"n - CAST(ceil(n * {least} / 100) AS bigint) + 1")
    reps = stage(classes.where(F.col("alone") < prefix).select(F.col("rep").alias("doc_id")).distinct())
    lists, release = staged_table(
        texts.join(sized(reps), "doc_id", "left_semi").mapInArrow(
            lambda b: _lists(b, frequent, least, small, shingle), "kind int, token bigint, part int, n int, node bigint"
        ),
        "lists",
    )
    # light: a key with a set of the smaller size links all that have it
    keys = lists.where("kind = 0")
    heads = keys.where("n = part").groupBy("token").agg(F.min("node").alias("head"))
    light = stage(keys.join(heads, "token").where("node <> head").select(F.col("node").alias("a"), F.col("head").alias("b")))

    # heavy: sets of one list whose sizes may link are chained; heads of salted lists once more
    linked_sizes = f"before IS NOT NULL AND before <> node AND 100 * n_before >= {least} * n"
    chain = _chained(lists.where("kind = 1"), ["token", "part"])
    salted = chain.where("part > 0 AND (n_before IS NULL OR n_before < n)").select("token", "n", "node")
    again = _chained(salted, ["token"])
    ends = [F.col("node").alias("a"), F.col("before").alias("b")]
    near = chain.where(linked_sizes).select(*ends).unionByName(again.where(linked_sizes).select(*ends))
    groups = stage(connected_components(near))
    release()

    sizes = classes.groupBy(F.col("rep").alias("node")).agg(F.sum("n").alias("n"))
    member = stage(_in_blocks(groups, sizes))
    large = stage(member.where("blocks > 1").select("doc_id", "comp"))
    if not large.isEmpty():
        # sieve: sets of a large group that equal parts join; linked sets stay together
        parts, release = staged_table(
            texts.join(sized(large), "doc_id").mapInArrow(lambda b: _parts(b, least, shingle), "comp bigint, token bigint, node bigint"), "parts"
        )
        firsts = parts.groupBy("comp", "token").agg(F.min("node").alias("b"), F.max("node").alias("last")).where("b < last")
        pieces = stage(connected_components(parts.join(firsts, ["comp", "token"]).select(F.col("node").alias("a"), "b")))
        release()
        member = stage(member.where("blocks = 1").unionByName(_in_blocks(pieces, sizes)))
    sets = texts.join(sized(member), "doc_id").mapInArrow(
        lambda b: _sets(b, shingle), "comp bigint, i int, j int, side int, node bigint, blob binary"
    )
    met = sets.repartition("comp", "i", "j").sortWithinPartitions("comp", "i", "j")
    heavy = met.mapInArrow(lambda b: _verify(b, least, small), "a bigint, b bigint")

    # rows that share a doc_id are one node, even with different texts
    same_id = (
        known.join(classes.select("sig", "rep"), "sig")
        .groupBy("doc_id")
        .agg(F.min("rep").alias("a"), F.max("rep").alias("b"))
        .where("a < b")
        .select("a", "b")
    )
    comps = connected_components(light.unionByName(heavy).unionByName(same_id))
    named = classes.join(comps, classes["rep"] == comps["node"], "left").select(
        "sig", "rep", F.coalesce("comp", "rep").alias("comp")
    )
    return rows.join(named, "sig", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.when(F.col("n") > 0, F.col("comp")).otherwise(F.col("doc_id"))).alias("component_id"),
        F.when(F.col("n") > 0, F.col("rep")).alias("class_id"),
    )


def keep_one(docs: DataFrame, least: int = LEAST, shingle: int = SHINGLE) -> DataFrame:
    """``docs`` with one document of each component (the smallest doc_id); rows without a set or id stay.

    Rows that share a doc_id but not their text are documents of their own here: they stay unless
    they link. Of equal rows one stays.
    """
    hashed = docs.where("doc_id IS NOT NULL").select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h"))
    several = stage(hashed.groupBy("doc_id").agg(F.min("h").alias("a"), F.max("h").alias("b")).where("a <> b").select("doc_id"))
    if several.isEmpty():
        return _smallest(docs, "doc_id", least, shingle)
    # ids of their own for the texts of such an id, above all others so that plain ids are kept first
    marked = sized(several.withColumn("__several", F.lit(True)))
    own = F.expr("CASE WHEN __several THEN (xxhash64(doc_id, coalesce(text, '')) & 2305843009213693951) | 4611686018427387904 ELSE doc_id END")
    named = docs.join(marked, "doc_id", "left").withColumn("__node", own).select(*docs.columns, "__node")
    return _smallest(named, "__node", least, shingle).select(*docs.columns)


def _smallest(docs: DataFrame, node: str, least: int, shingle: int) -> DataFrame:
    """``docs`` with the row of the smallest ``node`` of each component."""
    nodes = docs.select(F.col(node).alias("doc_id"), "text")
    found = stage(link(nodes, least, shingle).where("n_shingles > 0 AND doc_id IS NOT NULL"))
    away = stage(found.where("doc_id <> component_id").select(F.col("doc_id").alias(node)).distinct())
    left = docs.join(sized(away), node, "left_anti").select(*docs.columns)
    # of equal rows that are kept one stays; texts are moved only for such ids
    twice = stage(found.groupBy("doc_id").count().where("count > 1").select(F.col("doc_id").alias(node)))
    marked = sized(twice)
    words = F.expr("coalesce(text, '') RLIKE '[^\\\\x20\\\\x09-\\\\x0D]'")
    once = left.join(marked, node, "left_anti").select(*docs.columns)
    shared_ids = left.join(marked, node, "left_semi").select(*docs.columns)
    return once.unionByName(shared_ids.where(~words)).unionByName(shared_ids.where(words).dropDuplicates([node]))
