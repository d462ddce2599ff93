"""Phrase collocation mining with weighted acyclic automata.

Texts are cut into pieces and words; everything is counted per language. A shard (one
Arrow batch of texts) sorts its n-grams of up to ``WORDS`` words and builds from them,
phrase by phrase, a minimal acyclic automaton whose transitions carry counts (a count transducer): states
that no later phrase can reach are frozen and shared with equal ones. It is written in parts, one
for each prefix range (a hash range over the first two words, so that no frequent first
word gathers in one place). The parts of a range meet in one task, are united with their weights
summed, and lose all phrases under ``LEAST``.

Parts of a candidate are looked up by composition: the parts asked for are sent to
the range of their own prefix, form an automaton there, and its paths are followed
side by side with those of the count transducer. The transitions' weights are the counts, and
a phrase's parts are at least as frequent as itself, so each is found.

Most n-grams of a corpus are rare. Passes before tell which can be frequent at all: they
count hashed words, then pairs, then triples (``SIEVES``) whose parts passed before, and keep a
bitmap of fixed size (``BITS``) of those that reach ``LEAST``. An n-gram is counted exactly
only if all its parts are in the bitmaps. Hashes that meet can only let more through, so
nothing is lost, and the bitmaps never grow.

Defined cases: a NULL text is empty; a NULL language is ``und``; repeated rows count
each time; ids are not read, so NULL and repeated ones don't matter; long texts are cut between
pieces where that saves memory; an empty table and one without frequent phrases give no rows. Only ``text``
and ``lang`` are read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import mix64, stage, staged_table, text_slices, with_package

WORDS, LEAST, TOP = 5, 100, 2000
HELD_KEYS = 2_000_000  # hashes that a task holds before they go out
SIEVES = 3  # sizes of n-grams that are counted by hash before
BITS, HASH_BITS = 1 << 26, 40  # of each bitmap; of the hashes that are counted for it
SHARD_BYTES = 8 << 20  # text of one shard; a longer piece of one text is one shard
RANGE_WORDS = 4_000_000  # words of the corpus for each prefix range
FOLD = 64  # automata of one range that are held before they are united
CHUNK = 1 << 15  # bits of one row of Spark's bitmap functions

# bytes of texts: A-Z lower-cased, ends of pieces as line feeds, the blanks between words as spaces
BREAK, BLANK = b"\n", b" "
TABLE = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\x0b\x0c\x0d\t", b"abcdefghijklmnopqrstuvwxyz" + BREAK * 9 + BLANK)


# ------------------------------------------------------------------ words of a shard


@dataclass
class Shard:
    """Words of a run of texts of one language as codes; ``linked[i]``: word i + 1 stands in the same piece."""

    lang: str
    names: pa.Array  # distinct words
    codes: np.ndarray
    linked: np.ndarray

    def hashes(self) -> np.ndarray:
        """64-bit hashes of the distinct words, language included."""
        if not len(self.names):
            return np.zeros(0, np.uint64)
        words = pd.util.hash_array(self.names.cast(pa.large_string()).to_numpy(zero_copy_only=False), categorize=False)
        with np.errstate(over="ignore"):
            return mix64(words.astype(np.uint64) ^ np.uint64(crc32(self.lang.encode("utf-8")) * 0x9E3779B97F4A7C15 % 2**64))


def _shard(lang: str, data: bytes, starts: np.ndarray) -> Shard:
    """Words of translated texts that begin at ``starts``."""
    raw = np.frombuffer(data, np.uint8)
    ends_piece = raw == BREAK[0]
    gap = ends_piece | (raw == BLANK[0])
    begins = ~gap
    begins[1:] &= gap[:-1]
    heads = np.zeros(len(raw) + 1, bool)
    heads[starts] = True
    begins |= heads[:-1] & ~gap
    first = np.flatnonzero(begins)
    solid = np.concatenate([[0], np.cumsum(~gap)])
    offsets = np.append(solid[first], solid[-1])
    words = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(first), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(raw[~gap].tobytes())]
    )
    coded = words.dictionary_encode()
    piece = np.cumsum(ends_piece | heads[:-1])[first]
    linked = np.zeros(len(first), bool)
    linked[:-1] = piece[1:] == piece[:-1]
    return Shard(lang, coded.dictionary, coded.indices.to_numpy().astype(np.int64), linked)


def _shards(batches: Iterable[pa.RecordBatch]) -> Iterator[Shard]:
    """Shards of the texts, one language each; a long text is cut after the end of a piece."""
    for batch in batches:
        for rows in text_slices(batch, limit=SHARD_BYTES):
            langs = rows.column("lang")
            for lang in pc.unique(langs).to_pylist():
                texts = rows.filter(pc.equal(langs, lang)).column("text").cast(pa.large_binary())
                sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False)
                data = b"".join(texts.to_pylist()).translate(TABLE)
                starts = np.cumsum(sizes) - sizes
                at = 0
                while at < len(data):
                    end = at + SHARD_BYTES
                    end = len(data) if end >= len(data) else data.find(BREAK, end) + 1 or len(data)
                    inside = starts[(starts >= at) & (starts < end)] - at
                    yield _shard(lang, data[at:end], inside)
                    at = end


# ------------------------------------------------------------------ what can be frequent


def _bit(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - HASH_BITS)) & np.uint64(BITS - 1)


def _in(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    bit = _bit(hashes).astype(np.int64)
    return bitmap[bit >> 3] >> (bit & 7).astype(np.uint8) & 1 == 1


def _hash_counts(hashes: np.ndarray, counts: np.ndarray, lang: str | None = None) -> pa.RecordBatch:
    """Counted hashes, cut to ``HASH_BITS``, as rows ``lang, h, n`` or ``h, n``."""
    cols = [pa.array((hashes >> np.uint64(64 - HASH_BITS)).astype(np.int64)), pa.array(counts, pa.int64())]
    if lang is None:
        return pa.RecordBatch.from_arrays(cols, names=["h", "n"])
    return pa.RecordBatch.from_arrays([pa.array([lang] * len(hashes), pa.string()), *cols], names=["lang", "h", "n"])


def _grams(s: Shard, bitmaps: list[np.ndarray], most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For sizes from 1 to ``most``, where n-grams begin that may be frequent, and their hashes.

    An n-gram may be frequent if both of its parts of one word less may, and if it is in the bitmap
    of its size where there is one.
    """
    hashes = s.hashes()
    words = hashes[s.codes]
    may, grams = np.ones(len(words), bool), words
    for size in range(1, most + 1):
        if size > 1:
            may = may[:-1] & may[1:] & s.linked[size - 2 : -1] if len(may) else may
            at = np.flatnonzero(may)
            with np.errstate(over="ignore"):
                found = mix64(grams[at] * np.uint64(0xD6E8FEB86659FD93) + words[at + size - 1])
            grams = np.zeros(len(may), np.uint64)
            grams[at] = found
        if size <= len(bitmaps):
            may = _in(bitmaps[0], hashes)[s.codes] if size == 1 else may & _in(bitmaps[size - 1], grams)
        at = np.flatnonzero(may)
        yield at, grams[at]


def _words_hashed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for s in _shards(batches):
        yield _hash_counts(s.hashes(), np.bincount(s.codes, minlength=len(s.names)), s.lang)


PACKED = "bucket int, keys binary, counts binary"


def _packed(keys: np.ndarray, counts: np.ndarray, buckets: int) -> pa.RecordBatch:
    """Rising keys dealt to buckets by value, byte plane by byte plane, so that equal high bytes stand together."""
    edges = (np.arange(buckets + 1, dtype=object) * (1 << HASH_BITS) // buckets).astype(np.uint64)
    cuts = np.searchsorted(keys, edges)
    planes = keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, : HASH_BITS // 8]
    rows = [(k, a, b) for k, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)) if a < b]
    return pa.RecordBatch.from_arrays(
        [
            pa.array([k for k, _, _ in rows], pa.int32()),
            pa.array([planes[a:b].T.tobytes() for _, a, b in rows], pa.binary()),
            pa.array([counts[a:b].astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes() for _, a, b in rows], pa.binary()),
        ],
        names=["bucket", "keys", "counts"],
    )


def _unpacked(data: bytes, width: int) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(width, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :width] = planes.T
    return out.view("<u8").ravel()


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Different keys, rising, with the sums of their counts."""
    found, at = np.unique(np.concatenate(keys), return_inverse=True)
    return found, np.bincount(at, weights=np.concatenate(counts), minlength=len(found)).astype(np.int64)


def _grams_hashed(batches: Iterable[pa.RecordBatch], bitmaps, buckets: int, least: int) -> Iterator[pa.RecordBatch]:
    """Counts of the n-grams of one word more than there are bitmaps, packed; a count from ``least`` on says no more."""
    keys, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for s in _shards(batches):
        *_, (_, hashes) = _grams(s, bitmaps.value, len(bitmaps.value) + 1)
        found, n = np.unique(hashes >> np.uint64(64 - HASH_BITS), return_counts=True)
        keys.append(found)
        counts.append(n)
        if sum(map(len, keys)) > HELD_KEYS:
            found, n = _summed(keys, counts)
            yield _packed(found, np.minimum(n, least), buckets)
            keys, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    found, n = _summed(keys, counts)
    yield _packed(found, np.minimum(n, least), buckets)


def _often(batches: Iterable[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """Keys that reach ``least``; buckets arrive one after the other, one is held at a time."""
    bucket, keys, counts = None, [], []

    def flush() -> pa.RecordBatch:
        found, n = _summed(keys, counts)
        return pa.RecordBatch.from_arrays([pa.array(found[n >= least].astype(np.int64))], names=["h"])

    for batch in batches:
        for row in batch.to_pylist():
            if row["bucket"] != bucket and keys:
                yield flush()
                keys, counts = [], []
            bucket = row["bucket"]
            keys.append(_unpacked(row["keys"], HASH_BITS // 8))
            counts.append(_unpacked(row["counts"], 4).astype(np.int64))
    if keys:
        yield flush()


def _bitmap(often: DataFrame) -> np.ndarray:
    """Bitmap of hashes ``h``: ``BITS`` bits, whatever the corpus."""
    bits = often.select(F.expr(f"h & {BITS - 1}L").alias("b"))
    chunks = bits.groupBy(F.expr(f"b div {CHUNK}").alias("chunk")).agg(F.expr(f"bitmap_construct_agg(b % {CHUNK})").alias("bits"))
    out = np.zeros(BITS // 8, np.uint8)
    for row in chunks.toLocalIterator():
        part = np.frombuffer(bytes(row.bits), np.uint8)
        out[row.chunk * CHUNK // 8 :][: len(part)] = part
    return out


# ------------------------------------------------------------------ count transducers


class Automaton:
    """Minimal acyclic automaton over words; a transition ``(word, weight, state)`` ends a phrase of that weight (0: none).

    State 0 has no transitions. States are tuples of transitions in word order; ``root`` is the first state.
    Words are bytes, or codes in the order of the words (a shard's own automata).
    """

    def __init__(self):
        self.states: list[tuple] = [()]
        self.register: dict[tuple, int] = {(): 0}
        self.root = 0

    def frozen(self, arcs: tuple) -> int:
        """The state with these transitions, shared with an equal one."""
        if arcs not in self.register:
            self.register[arcs] = len(self.states)
            self.states.append(arcs)
        return self.register[arcs]

    @classmethod
    def build(cls, phrases: Iterable[tuple[tuple, int]]) -> Automaton:
        """From phrases in rising order (tuples of words) with their weights; only the last path is open."""
        self = cls()
        path: list = []  # words of the open path; arcs[k] has the finished transitions of its k-th state
        arcs: list[list] = [[]]
        weights: list[int] = []

        def close(depth: int) -> None:
            while len(path) > depth:
                done = arcs.pop()
                arcs[-1].append((path.pop(), weights.pop(), self.frozen(tuple(done)) if done else 0))

        for phrase, weight in phrases:
            same = 0
            for mine, theirs in zip(path, phrase, strict=False):
                if mine != theirs:
                    break
                same += 1
            if len(path) > same:
                close(same)
            for word in phrase[same:]:
                path.append(word)
                weights.append(0)
                arcs.append([])
            weights[-1] += weight
        close(0)
        self.root = self.frozen(tuple(arcs[0]))
        return self

    def phrases(self) -> Iterator[tuple[tuple[bytes, ...], int]]:
        """All phrases with a weight, in rising order."""

        def walk(state, head):
            for word, weight, target in self.states[state]:
                phrase = (*head, word)
                if weight:
                    yield phrase, weight
                yield from walk(target, phrase)

        yield from walk(self.root, ())

    @classmethod
    def union(cls, parts: list[Automaton], least: int = 0) -> Automaton:
        """Phrases of all parts, weights summed; those under ``least`` go.

        States are united from the end; equal sets of states only once.
        """
        self = cls()
        known: dict[tuple, int] = {}

        def join(at: tuple) -> int:
            if at not in known:
                met: dict[bytes, list] = {}
                for part, state in at:
                    for word, weight, target in parts[part].states[state]:
                        held = met.setdefault(word, [0, []])
                        held[0] += weight
                        if target:
                            held[1].append((part, target))
                arcs = []
                for word in sorted(met):
                    weight, targets = met[word]
                    state = join(tuple(targets)) if targets else 0
                    weight = weight if weight >= least else 0
                    if weight or state:
                        arcs.append((word, weight, state))
                known[at] = self.frozen(tuple(arcs))
            return known[at]

        self.root = join(tuple((k, p.root) for k, p in enumerate(parts)))
        return self

    def compose(self, other: Automaton) -> Iterator[tuple[tuple[bytes, ...], int]]:
        """Phrases of this automaton that ``other`` has, with the weights they have there."""

        def walk(mine, theirs, head):
            arcs = {word: (weight, target) for word, weight, target in other.states[theirs]}
            for word, weight, target in self.states[mine]:
                if word in arcs:
                    phrase = (*head, word)
                    if weight and arcs[word][0]:
                        yield phrase, arcs[word][0]
                    if target and arcs[word][1]:
                        yield from walk(target, arcs[word][1], phrase)

        yield from walk(self.root, other.root, ())

    def to_bytes(self, names: list[bytes] | None = None) -> bytes:
        """Sizes, transitions state by state, words (``names`` of the codes, where words are codes). Words have no blanks."""
        words = sorted({word for arcs in self.states for word, _, _ in arcs})
        code = {w: k for k, w in enumerate(words)}
        flat = [x for arcs in self.states for w, weight, target in arcs for x in (code[w], weight, target)]
        head = np.array([len(self.states), len(flat) // 3, self.root], "<i8")
        sizes = np.array([len(arcs) for arcs in self.states], "<i4")
        named = words if names is None else [names[w] for w in words]
        return head.tobytes() + sizes.tobytes() + np.array(flat, "<i8").tobytes() + BLANK.join(named)

    @classmethod
    def from_bytes(cls, data: bytes) -> Automaton:
        self = cls()
        n, m, self.root = np.frombuffer(data, "<i8", 3).tolist()
        sizes = np.frombuffer(data, "<i4", n, 24).tolist()
        at = 24 + 4 * n
        flat = np.frombuffer(data, "<i8", 3 * m, at).reshape(m, 3).tolist()
        words = data[at + 24 * m :].split(BLANK)
        arcs = iter([(words[w], weight, target) for w, weight, target in flat])
        self.states = [tuple(next(arcs) for _ in range(size)) for size in sizes]
        self.register = {}
        return self


# ------------------------------------------------------------------ counting


def _ngrams(s: Shard, bitmaps: list[np.ndarray], most: int) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Words in byte order, and of the n-grams that may be frequent the rows of codes into them (-1: shorter) and the counts."""
    names, codes, ids = [], s.codes, np.zeros(0, np.int64)
    rows, out, counted = np.zeros((1, 0), np.int32), [np.zeros((0, most), np.int32)], [np.zeros(0, np.int64)]
    for size, (at, _) in enumerate(_grams(s, bitmaps, most), 1):
        if not len(at):
            break
        if size == 1:
            used = np.unique(s.codes[at])
            words = s.names.take(pa.array(used)).to_pylist()
            order = sorted(range(len(words)), key=words.__getitem__)
            names = [words[k] for k in order]
            codes = np.zeros(len(s.names), np.int64)
            codes[used[order]] = np.arange(len(names))
            codes = codes[s.codes]
            mine = codes[at]
        else:  # by the number of the phrase without its last word
            mine = ids[at] * len(names) + codes[at + size - 1]
        found, mine, counts = np.unique(mine, return_inverse=True, return_counts=True)
        ids = np.zeros(len(codes), np.int64)
        ids[at] = mine
        heads, tails = np.divmod(found, len(names))
        rows = np.concatenate([rows[heads], tails[:, None].astype(np.int32)], axis=1)
        out.append(np.pad(rows, ((0, 0), (0, most - size)), constant_values=-1))
        counted.append(counts)
    return names, np.concatenate(out), np.concatenate(counted)


def prefix_range(phrase: tuple[bytes, ...], ranges: int) -> int:
    """Range of a phrase, by its first two words."""
    return crc32(BLANK.join(phrase[:2])) % ranges


def _ranges(rows: np.ndarray, names: list[bytes], ranges: int) -> np.ndarray:
    """Range of every n-gram; each pair of first words is looked at once."""
    second = rows[:, 1].astype(np.int64) if rows.shape[1] > 1 else np.full(len(rows), -1)
    heads, of = np.unique(rows[:, 0].astype(np.int64) * (len(names) + 1) + second + 1, return_inverse=True)
    first, then = np.divmod(heads, len(names) + 1)
    pairs = zip(first.tolist(), (then - 1).tolist(), strict=True)
    return np.array([prefix_range((names[a], names[b]) if b >= 0 else (names[a],), ranges) for a, b in pairs], np.int64)[of]


COUNTED = "lang string, part int, automaton binary"


def _parts_out(rows: list[tuple[str, int, bytes]]) -> pa.RecordBatch:
    lang, part, data = zip(*rows, strict=True) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(lang, pa.string()), pa.array(part, pa.int32()), pa.array(data, pa.binary())], names=["lang", "part", "automaton"]
    )


def _counted(batches: Iterable[pa.RecordBatch], bitmaps, ranges: int, most: int) -> Iterator[pa.RecordBatch]:
    """Count transducers of every shard, by prefix range."""
    for s in _shards(batches):
        names, rows, counts = _ngrams(s, bitmaps.value, most)
        if not len(rows):
            continue
        part = _ranges(rows, names, ranges)
        order = np.lexsort((*rows.T[::-1], part))
        rows, counts, part = rows[order], counts[order], part[order]
        sizes = (rows >= 0).sum(axis=1)
        first = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])).tolist()
        out = []
        for a, b in zip(first, [*first[1:], len(part)], strict=True):
            of_range = zip(rows[a:b].tolist(), sizes[a:b].tolist(), counts[a:b].tolist(), strict=True)
            automaton = Automaton.build((tuple(phrase[:size]), n) for phrase, size, n in of_range)
            out.append((s.lang, int(part[a]), automaton.to_bytes(names)))
        yield _parts_out(out)


def _by_range(batches: Iterable[pa.RecordBatch], fold=None) -> Iterator[tuple[tuple[str, int], list[dict]]]:
    """Rows of one range after the other; they arrive sorted by ``lang, part``. ``fold`` keeps them few."""
    key, rows = None, []
    for batch in batches:
        for row in batch.to_pylist():
            if key is not None and key != (row["lang"], row["part"]):
                yield key, rows
                rows = []
            key = (row["lang"], row["part"])
            rows.append(row)
            if fold is not None and len(rows) == FOLD:
                rows = [fold(rows)]
    if key is not None:
        yield key, rows


def _joined(rows: list[dict], least: int = 0) -> Automaton:
    return Automaton.union([Automaton.from_bytes(r["automaton"]) for r in rows], least)


def _united(batches: Iterable[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    for (lang, part), rows in _by_range(batches, lambda some: {**some[0], "automaton": _joined(some).to_bytes()}):
        whole = _joined(rows, least)
        if whole.root:
            yield _parts_out([(lang, part, whole.to_bytes())])


def _candidates(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Phrases of two or more words with their counts."""
    for batch in batches:
        for row in batch.to_pylist():
            found = [(BLANK.join(p).decode("utf-8", "surrogatepass"), len(p), a) for p, a in Automaton.from_bytes(row["automaton"]).phrases() if len(p) > 1]
            if found:
                phrase, size, a = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["lang"]] * len(found), pa.string()), pa.array(phrase, pa.string()), pa.array(size, pa.int32()), pa.array(a, pa.int64())],
                    names=["lang", "phrase", "size", "a"],
                )


def _looked_up(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Count transducers and the parts asked of them, by range: ``lang, asked, f``."""
    for (lang, _), rows in _by_range(batches):
        asked = sorted(tuple(r["asked"].encode("utf-8", "surrogatepass").split(BLANK)) for r in rows if r["asked"] is not None)
        counts = _joined([r for r in rows if r["automaton"] is not None])
        found = list(Automaton.build((p, 1) for p in asked).compose(counts))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([lang] * len(found), pa.string()),
                pa.array([BLANK.join(p).decode("utf-8", "surrogatepass") for p, _ in found], pa.string()),
                pa.array([f for _, f in found], pa.int64()),
            ],
            names=["lang", "asked", "f"],
        )


# ------------------------------------------------------------------ the operator


def collocations(docs: DataFrame, words: int = WORDS, least: int = LEAST, top: int = TOP) -> DataFrame:
    """The ``top`` phrases of each language by score: ``lang, rank, phrase, a, l, r, n, score``.

    A phrase of 2 to ``words`` words with ``a >= least`` occurrences scores
    ``floor(1000 a n / (l r))`` at its worst cut into parts of ``l`` and ``r`` occurrences;
    one that a longer phrase holds at every occurrence is left out.
    """
    with_package(docs)
    spark = docs.sparkSession
    texts = docs.select(F.coalesce("text", F.lit("")).alias("text"), F.coalesce("lang", F.lit("und")).alias("lang"))

    counted, release = staged_table(texts.mapInArrow(_words_hashed, "lang string, h bigint, n bigint").groupBy("lang", "h").agg(F.sum("n").alias("n")), "words")
    totals = stage(counted.groupBy("lang").agg(F.sum("n").alias("n")))
    sieves = [_bitmap(counted.groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") >= least))]
    release()
    total = int(totals.agg(F.sum("n")).first()[0] or 0)
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // RANGE_WORDS))
    for _ in range(1, min(SIEVES, words)):
        sent = spark.sparkContext.broadcast(sieves)
        packed = texts.mapInArrow(lambda b, sent=sent: _grams_hashed(b, sent, ranges, least), PACKED)
        met = packed.repartition("bucket").sortWithinPartitions("bucket")
        sieves = [*sieves, _bitmap(met.mapInArrow(lambda b: _often(b, least), "h bigint"))]
    sieves = spark.sparkContext.broadcast(sieves)

    shards = texts.mapInArrow(lambda b: _counted(b, sieves, ranges, words), COUNTED)
    met = shards.repartition("lang", "part").sortWithinPartitions("lang", "part")
    counts = stage(met.mapInArrow(lambda b: _united(b, least), COUNTED))

    found = stage(counts.mapInArrow(_candidates, "lang string, phrase string, size int, a bigint"))
    cuts = (
        found.withColumn("k", F.explode(F.expr("sequence(1, size - 1)")))
        .withColumn("head", F.expr("substring_index(phrase, ' ', k)"))
        .withColumn("tail", F.expr("substring_index(phrase, ' ', k - size)"))
    )
    part = F.expr(f"CAST(crc32(CAST(substring_index(asked, ' ', 2) AS binary)) % {ranges} AS int)")
    asked = cuts.selectExpr("lang", "explode(array(head, tail)) AS asked").distinct().withColumn("part", part)
    asked = asked.withColumn("automaton", F.lit(None).cast("binary"))
    both = asked.unionByName(counts.withColumn("asked", F.lit(None).cast("string")))
    both = both.repartition("lang", "part").sortWithinPartitions("lang", "part")
    parts = stage(both.mapInArrow(_looked_up, "lang string, asked string, f bigint"))

    heads = parts.select("lang", F.col("asked").alias("head"), F.col("f").alias("l"))
    tails = parts.select("lang", F.col("asked").alias("tail"), F.col("f").alias("r"))
    whole = "CAST({} AS DECIMAL(19, 0))"
    ratio = f"(CAST(1000 AS DECIMAL(4, 0)) * {whole.format('a')} * {whole.format('n')}) div ({whole.format('l')} * {whole.format('r')})"
    scored = stage(cuts.join(heads, ["lang", "head"]).join(tails, ["lang", "tail"]).join(totals, "lang").withColumn("score", F.expr(ratio)))
    # a phrase of one word more that is as frequent tells that some longer phrase always holds it
    held = scored.where("k = size - 1 AND l = a").select("lang", F.col("head").alias("phrase"))
    held = held.unionByName(scored.where("k = 1 AND r = a").select("lang", F.col("tail").alias("phrase"))).distinct()
    worst = scored.groupBy("lang", "phrase", "a", "n").agg(
        F.min_by(F.struct("l", "r", "score"), F.struct("score", "k")).alias("cut")
    )
    left = worst.join(held, ["lang", "phrase"], "left_anti").select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = left.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
