"""SimHash near-dedup: fingerprints joined by Golay-code fuzzy hashing.

A text's fingerprint has a bit set where over half of its shingles' 64-bit hashes have it.
Fingerprints that differ in at most ``DISTANCE`` = 3 bits are linked.

Candidates come from keys that linked fingerprints must share. A fingerprint is cut into
three segments (``SEGMENTS``). Three flips over three segments leave one of these cases:

* two segments are equal: both stand in the key, as they are;
* one is equal and another has exactly one flip: the equal one stands in the key, and of
  the other the index of a nearby codeword of the binary Golay code of length 23;
* all three have exactly one flip: codeword indices of the first two, and the half of the third
  that the flip leaves alone.

The code is perfect: every 23-bit word lies within three flips of exactly one codeword.
A single flip changes the parity of its segment. So the side of even parity lists the codeword
of its own segment, and the side of odd parity those of all words one flip away (some six different
ones, as most of these words decode alike); the two lists meet in the codeword of the even side.
Some sixty keys of 34 to 43 bits for each different fingerprint, and no pair is missed.

Only different fingerprints are joined, however many copies a text has. Keys are dealt over
tasks; a task compares the fingerprints of a key and returns links that span them, never all
pairs. A key with more than ``BUCKET`` fingerprints is not held: its rows go on to a second round, in
which every two blocks of it meet in a task of their own.

Defined cases: NULL, empty and word-free texts have fingerprint zero, which is linked like any
other; fewer than three words are one shingle; rows with a NULL ``doc_id`` link others, but only ids that are
not NULL count for ``component_id`` (NULL if there is none); rows of one ``doc_id`` with different
texts are told apart by their fingerprints; repeated rows are equal; an empty table gives
no rows. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import connected_components, sized, stage, text_slices, with_package

SHINGLE, SEED = 3, 42
DISTANCE = 3  # follows from the three segments and the code
SEGMENTS = ((0, 22), (22, 21), (43, 21))  # first bit and length
HALVES = ((0, 10), (10, 11))  # of the last segment
BUCKET = 16_384  # fingerprints of one key that a task holds
SHORT = 16  # up to so many, those of a key are compared by shifted columns
LONG_TEXT = 4 << 20  # bytes of one text that are cut into words at once
COUNT_ROWS = 100_000

# the Golay code of length 23 with 12 data bits: remainders by x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1
GENERATOR, LENGTH, DATA = 0b110001110101, 23, 12


def _remainder(word: int) -> int:
    for bit in range(LENGTH - 1, LENGTH - DATA - 1, -1):
        if word >> bit & 1:
            word ^= GENERATOR << (bit - (LENGTH - DATA))
    return word


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Remainders by the low and the high part of a word, and the flips (three at most) of every remainder."""
    low = np.array([_remainder(x) for x in range(1 << DATA)], np.int64)
    high = np.array([_remainder(x << DATA) for x in range(1 << (LENGTH - DATA))], np.int64)
    flips = np.zeros(1 << (LENGTH - DATA), np.int64)
    for weight in range(1, 4):
        for bits in combinations(range(LENGTH), weight):
            word = sum(1 << b for b in bits)
            flips[_remainder(word)] = word
    return low, high, flips


LOW, HIGH, FLIPS = _tables()


def codeword_index(words: np.ndarray) -> np.ndarray:
    """Data bits of the codeword next to each 23-bit word."""
    return (words ^ FLIPS[LOW[words & ((1 << DATA) - 1)] ^ HIGH[words >> DATA]]) >> (LENGTH - DATA)


# ------------------------------------------------------------------ fingerprints


def _shingle_hashes(text: bytes) -> Iterator[np.ndarray]:
    """Hashes of all shingles of one text, in runs; a long text is cut between words."""
    digest = xxhash.xxh64_intdigest
    carry: list[bytes] = []
    seen, at = False, 0
    while at < len(text):
        end = at + LONG_TEXT
        while end < len(text) and text[end] not in b" \t\n\r\x0b\x0c":
            end += 1
        words = carry + text[at:end].lower().split()
        at = end
        if len(words) >= SHINGLE:
            seen = True
            joined = b" ".join(words)
            ends = np.cumsum(np.fromiter(map(len, words), np.int64, count=len(words)) + 1) - 1
            starts = np.concatenate([[0], ends[:-1] + 1])
            spans = zip(starts[: 1 - SHINGLE].tolist(), ends[SHINGLE - 1 :].tolist(), strict=True)
            yield np.fromiter((digest(joined[a:b], SEED) for a, b in spans), np.uint64, count=len(words) - SHINGLE + 1)
            words = words[1 - SHINGLE :]
        carry = words
    if carry and not seen:
        yield np.array([digest(b" ".join(carry), SEED)], np.uint64)


def _majority(hashes: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Per owner (rising), the bits that over half of its hashes have."""
    ones, each = np.zeros((n, 64), np.int64), np.bincount(owner, minlength=n)
    for k in range(0, len(hashes), COUNT_ROWS):
        mine = owner[k : k + COUNT_ROWS]
        bits = np.unpackbits(hashes[k : k + COUNT_ROWS].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        first = np.flatnonzero(np.concatenate([[True], mine[1:] != mine[:-1]]))
        ones[mine[first]] += np.add.reduceat(bits, first, axis=0, dtype=np.int64)
    return np.packbits(2 * ones > each[:, None], axis=1, bitorder="little").view("<u8").ravel()


def _fingerprints(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows in text_slices(batch):
            texts = rows.column("text")
            runs, owner = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
            for k, text in enumerate(pc.fill_null(texts, "").cast(pa.binary()).to_pylist()):
                for run in _shingle_hashes(text):
                    runs.append(run)
                    owner.append(np.full(len(run), k))
            found = _majority(np.concatenate(runs), np.concatenate(owner), len(texts)) if len(runs) > 1 else np.zeros(len(texts), np.uint64)
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(found.view(np.int64))], names=["doc_id", "fp"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, fp`` of every row; ``fp`` has the 64 bits as a signed long."""
    with_package(docs)
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(_fingerprints, "doc_id bigint, fp bigint")


# ------------------------------------------------------------------ keys


def _flipped(words: np.ndarray, length: int) -> np.ndarray:
    """Codeword indices of all words one flip away, a row of ``length`` for each word, repeats as -1."""
    out = np.sort(np.stack([codeword_index(words ^ (1 << bit)) for bit in range(length)], axis=1), axis=1)
    out[:, 1:][out[:, 1:] == out[:, :-1]] = -1
    return out


def keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All keys of fingerprints, and the place of the fingerprint of each."""
    fps = fps.view(np.uint64)
    parts = [((fps >> np.uint64(first)) & np.uint64((1 << n) - 1)).astype(np.int64) for first, n in SEGMENTS]
    odd = [np.bitwise_count(p).astype(np.int64) & 1 for p in parts]
    own = [codeword_index(p) for p in parts]
    near = [_flipped(p, n) for p, (_, n) in zip(parts, SEGMENTS, strict=True)]
    out, owner = [], []

    def add(kind: int, payload: np.ndarray, whose: np.ndarray) -> None:
        out.append((kind << 48) + payload)
        owner.append(whose)

    everyone = np.arange(len(fps))
    kind = 0
    for i, j in ((0, 1), (0, 2), (1, 2)):
        add(kind, (parts[i] << 22) + parts[j], everyone)
        kind += 1
    for i in range(3):
        for j in {0, 1, 2} - {i}:
            even = np.flatnonzero(odd[j] == 0)
            add(kind, (parts[i][even] << DATA) + own[j][even], even)
            row, col = np.nonzero((near[j] >= 0) & (odd[j] == 1)[:, None])
            add(kind, (parts[i][row] << DATA) + near[j][row, col], row)
            kind += 1
    even, uneven = np.flatnonzero(odd[0] == 0), np.flatnonzero(odd[0] == 1)
    a, row = near[0][uneven], uneven
    at, c0 = np.nonzero(a >= 0)
    b = near[1][row[at]]
    at1, c1 = np.nonzero(b >= 0)
    probe, first, second = row[at][at1], a[at, c0][at1], b[at1, c1]
    for start, n in HALVES:
        half = (parts[2] >> start) & ((1 << n) - 1)
        # the other two segments have the other parity on the other side
        add(kind, (((own[0] << DATA) + own[1]) << 13 | half << 2 | odd[1] << 1 | odd[2])[even], even)
        add(kind, ((first << DATA) + second) << 13 | (half << 2 | (1 - odd[1]) << 1 | (1 - odd[2]))[probe], probe)
        kind += 1
    return np.concatenate(out), np.concatenate(owner)


def _keyed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fps = batch.column("fp").to_numpy()
        for k in range(0, len(fps), 4096):
            some = np.ascontiguousarray(fps[k : k + 4096])
            key, owner = keys(some)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(some[owner])], names=["key", "fp"])


# ------------------------------------------------------------------ comparison


def spanning_links(fps: np.ndarray) -> list[tuple[int, int]]:
    """Links that join what lies within ``DISTANCE`` flips, one for each join of two groups."""
    fps = np.unique(fps.view(np.uint64))
    group = np.arange(len(fps))
    out = []
    for x in range(len(fps) - 1):
        close = x + 1 + np.flatnonzero(np.bitwise_count(fps[x + 1 :] ^ fps[x]) <= DISTANCE)
        other, first = np.unique(group[close], return_index=True)
        for g, y in zip(other.tolist(), close[first].tolist(), strict=True):
            if g != group[x]:
                out.append((x, y))
                group[group == g] = group[x]
    signed = fps.view(np.int64)
    return [(int(signed[x]), int(signed[y])) for x, y in out]


def _compared(key: np.ndarray, fps: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links among rows sorted by key; every key is whole."""
    if len(key) < 2:
        return []
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    length = np.diff(np.append(first, len(key)))
    out = []
    small = np.repeat(length <= SHORT, length)
    bits = fps.view(np.uint64)
    for k in range(1, min(SHORT, int(length.max(initial=1)))):
        hit = (key[k:] == key[:-k]) & small[k:] & (fps[k:] != fps[:-k]) & (np.bitwise_count(bits[k:] ^ bits[:-k]) <= DISTANCE)
        out.append((fps[:-k][hit], fps[k:][hit]))
    for a, n in zip(first[length > SHORT].tolist(), length[length > SHORT].tolist(), strict=True):
        found = spanning_links(fps[a : a + n])
        out.append((np.array([x for x, _ in found], np.int64), np.array([y for _, y in found], np.int64)))
    return out


def _links(batches: Iterable[pa.RecordBatch], by: list[str], bucket: int) -> Iterator[pa.RecordBatch]:
    """Rows arrive sorted by ``by``. Links as ``(a, b)``; rows of a key that is too large as ``(key, a)``."""

    def rows(key, a, b):
        mask = None if key is None else np.ones(len(a), bool)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.zeros(len(a), np.int64) if key is None else np.full(len(a), key), mask=np.ones(len(a), bool) if key is None else None),
                pa.array(a, pa.int64()),
                pa.array(b, pa.int64(), mask=mask),
            ],
            names=["key", "a", "b"],
        )

    held_key, held = [np.zeros(0, np.int64) for _ in by], np.zeros(0, np.int64)
    large = None  # the key that is passed on
    for batch in batches:
        cols = [batch.column(c).to_numpy() for c in by]
        fps = batch.column("fp").to_numpy()
        cols = [np.concatenate([h, c]) for h, c in zip(held_key, cols, strict=True)]
        fps = np.concatenate([held, fps])
        if not len(fps):
            continue
        if large is not None:
            end = int(np.searchsorted(cols[0], large, side="right"))
            if end:
                yield rows(large, fps[:end], fps[:end])
            cols, fps = [c[end:] for c in cols], fps[end:]
            if not len(fps):
                held_key, held = cols, fps
                continue
            large = None
        # runs of equal keys, numbered; the last may go on in the next batch
        new = np.zeros(len(fps), bool)
        for c in cols:
            new[1:] |= c[1:] != c[:-1]
        number = np.cumsum(new)
        last = int(np.searchsorted(number, number[-1]))
        found = _compared(number[:last], fps[:last])
        if found:
            a, b = (np.concatenate(x) for x in zip(*found, strict=True))
            pairs = np.unique(np.stack([a, b], axis=1), axis=0)
            yield rows(None, pairs[:, 0], pairs[:, 1])
        held_key, held = [c[last:] for c in cols], fps[last:]
        if len(by) == 1 and len(held) > bucket:
            large = int(held_key[0][0])
            yield rows(large, held, held)
            held_key, held = [c[:0] for c in cols], held[:0]
    found = _compared(np.zeros(len(held), np.int64), held)
    if found:
        a, b = (np.concatenate(x) for x in zip(*found, strict=True))
        yield rows(None, a, b)


LINKS = "key bigint, a bigint, b bigint"


def links(fps: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """Links ``(a, b)`` that span all fingerprints within three flips; ``fps`` has each fingerprint once, as ``fp``."""
    keyed = fps.select("fp").mapInArrow(_keyed, "key bigint, fp bigint").repartition("key").sortWithinPartitions("key")
    found = stage(keyed.mapInArrow(lambda b: _links(b, ["key"], bucket), LINKS))
    direct = found.where("key IS NULL").select("a", "b")
    large = found.where("key IS NOT NULL").select("key", F.col("a").alias("fp"))
    if large.isEmpty():
        return direct
    # every two blocks of a large key meet once
    blocks = large.groupBy("key").agg(F.expr(f"CAST(ceil(2 * count(1) / {bucket}) AS int)").alias("blocks"))
    dealt = (
        large.join(blocks, "key")
        .withColumn("mine", F.expr("CAST(pmod(xxhash64(fp), blocks) AS int)"))
        .withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
        .selectExpr("key", "least(mine, other) AS i", "greatest(mine, other) AS j", "fp")
    )
    by = ["key", "i", "j"]
    met = dealt.repartition(*by).sortWithinPartitions(*by).mapInArrow(lambda b: _links(b, by, bucket), LINKS)
    return direct.unionByName(met.select("a", "b"))


def near_duplicates(docs: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """Per row: ``doc_id, fp, component_id``."""
    rows = stage(fingerprints(docs))
    classes = stage(rows.groupBy("fp").agg(F.min("doc_id").alias("first")))
    comps = stage(connected_components(links(classes, bucket)))
    smallest = comps.join(classes, comps["node"] == classes["fp"]).groupBy("comp").agg(F.min("first").alias("least_id"))
    named = (
        classes.join(comps, classes["fp"] == comps["node"], "left")
        .join(smallest, "comp", "left")
        .select("fp", F.when(F.col("comp").isNull(), F.col("first")).otherwise(F.col("least_id")).alias("component_id"))
    )
    return rows.join(sized(stage(named)), "fp").select("doc_id", "fp", "component_id")
