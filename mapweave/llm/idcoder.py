"""Token-id files: an adaptive context-mixing range coder over independent, checksummed blocks.

Model of a block (reset at its start). The two ids before the current one point
at the id that followed last time (order 2), the id before it likewise (order 1);
both come with a confidence. Whether a prediction holds is coded as a binary
decision whose chance is a logistic mix of what is known for either confidence and for
both with their agreement; the weights are learned as the
block goes on. An id that neither order foretold is coded as four symbols of
four bits with order-0 chances, adapted after each symbol. All arithmetic is on
integers, so any machine decodes what another has coded.

Blocks are independent, so a task codes all blocks of a chunk side by side, as
lanes of numpy arrays. The rows of chances are read and written whole, as entries of 32 bytes;
the writer, which knows its ids, adapts the four rows of an id at once.

File format: Parquet rows, one per chunk, which holds whole documents in
ascending order: ``part, chunk, doc_ids, lengths, blocks (n, bytes, crc32),
payload``. The files are written and read by Spark, so any of its stores will do
and lost executors are survived.

Defined cases: a NULL text is empty and has only the end id; NULL ids come
first; rows that share an id stand in the order of their text hash; an empty table
gives no files and no rows. A block whose ids do not have their checksum raises.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import encode_texts, tokenizer
from .common import text_slices, with_package

BITS = 16  # of an id
BLOCK = 4096  # ids of a block
LANES = 1536  # blocks worked on at once
CHUNK_BYTES = 14 << 20  # text of a chunk
ORDER1, ORDER2 = 12, 13  # bits of the tables of predicted ids
FINE = 14  # bits of a symbol's chances
RATE = 4  # shift of their adaptation
# an id is four symbols of four bits; bits of the context each of them has (the last is hashed)
CONTEXT_BITS = (0, 4, 8, 10)
EVEN = (np.arange(16) << (FINE - 4)).astype(np.int16)
# bounds to which a symbol's occurrence draws the chances; they keep every symbol possible
TOWARDS = np.array([[i if i <= s else (1 << FINE) - 16 + i for i in range(16)] for s in range(16)], np.int16)


def _squash_table() -> np.ndarray:
    x = np.arange(-2047, 2048)
    return np.clip(np.round(4096 / (1 + np.exp(-x / 256.0))), 1, 4095).astype(np.int64)


def _stretch_table(squash: np.ndarray) -> np.ndarray:
    """Inverse of the squash table on 12-bit chances, by search, so both agree on every machine."""
    return np.clip(np.searchsorted(squash, np.arange(4096)) - 2047, -2047, 2047).astype(np.int64)


SQUASH = _squash_table()
STRETCH = _stretch_table(SQUASH)


class _Lanes:
    """Range coder for many blocks at once, 48-bit registers, 24-bit words; ``data`` is given for decoding.

    A lane moves a word out when its range is below 24 bits. A carry stays in the word it
    reaches and is passed on when the blocks are finished, so reading needs no low end.
    """

    def __init__(self, n: int, data: list[bytes] | None, room: int):
        self.range, self.decoding = np.full(n, 1 << 48, np.int64), data is not None
        # the low end, or when decoding the distance of the code from it
        self.low = np.zeros(n, np.int64)
        if self.decoding:
            room = max((len(d) // 3 for d in data), default=0) + 2
        self._hold(np.zeros((n, room), np.int32))
        self.at = self.start.copy()
        if self.decoding:
            for k, d in enumerate(data):
                octets = np.frombuffer(d, np.uint8, len(d) // 3 * 3).reshape(-1, 3).astype(np.int32)
                self.words[k, : len(octets)] = octets[:, 0] | (octets[:, 1] << 8) | (octets[:, 2] << 16)
            self.low = (self.words[:, 0].astype(np.int64) << 24) | self.words[:, 1]
            self.at += 2

    def _hold(self, words: np.ndarray) -> None:
        self.words, self.flat = words, words.reshape(-1)
        self.start = np.arange(len(words), dtype=np.int64) * words.shape[1]

    def reserve(self, codings: int) -> None:
        """Make room for the words that so many codings on a lane can move out, and for the last two."""
        used = self.at - self.start
        if int(used.max(initial=0)) + codings + 2 > self.words.shape[1]:
            self._hold(np.concatenate([self.words, np.zeros((len(used), self.words.shape[1] + codings), np.int32)], axis=1))
            self.at = self.start + used

    def take(self, lanes: np.ndarray) -> list:
        """Local registers of some lanes, to be given back by :meth:`put`."""
        return [self.low.take(lanes), self.range.take(lanes), lanes]

    def put(self, regs: list) -> None:
        low, width, lanes = regs
        self.low[lanes] = low
        self.range[lanes] = width

    def flag(self, regs: list, chance: np.ndarray, y: np.ndarray | None) -> np.ndarray:
        """One yes-or-no decision on every lane; ``chance`` of yes in 12 bits."""
        low, width, _ = regs
        yes = (width >> 12) * chance
        if y is None:
            y = low < yes
            low -= yes * ~y
        else:
            low += yes * ~y
        regs[1] = np.where(y, yes, width - yes)
        self._move(regs)
        return y

    def known(self, regs: list, bottom: np.ndarray, size: np.ndarray) -> None:
        """Write one symbol on every lane, its bounds in ``FINE`` bits."""
        unit = regs[1] >> FINE
        regs[0] += unit * bottom
        regs[1] = unit * size
        self._move(regs)

    def symbol(self, regs: list, cdf: np.ndarray) -> np.ndarray:
        """Read one symbol of 16 on every lane; ``cdf`` holds the lower bounds in ``FINE`` bits."""
        unit = regs[1] >> FINE
        sym = _rank(cdf, np.minimum(regs[0] // unit, (1 << FINE) - 1).astype(np.int16))
        bottom, size = _bounds(cdf, sym)
        regs[0] -= unit * bottom
        regs[1] = unit * size
        self._move(regs)
        return sym

    def _move(self, regs: list) -> None:
        low, width, lanes = regs
        need = np.flatnonzero(width < 1 << 24)  # after one word a range is wide again: no chance is below 2^-14
        if not len(need):
            return
        out, old = lanes.take(need), low.take(need)
        at = self.at.take(out)
        if self.decoding:
            low[need] = ((old << 24) | self.flat.take(at, mode="clip")) & ((1 << 48) - 1)
        else:
            self.flat[at] = old >> 24
            low[need] = (old & 0xFFFFFF) << 24
        self.at[out] = at + 1
        width[need] = width.take(need) << 24

    def finish(self) -> list[bytes]:
        """Bytes of every lane; the last two words name the low end."""
        self.flat[self.at] = self.low >> 24
        self.flat[self.at + 1] = self.low & 0xFFFFFF
        used = self.at + 2 - self.start
        words = self.words[:, : int(used.max(initial=0))]
        while (words >> 24).any():
            over = words >> 24
            words &= 0xFFFFFF
            words[:, :-1] += over[:, 1:]
        octets = words.astype("<u4").view(np.uint8).reshape(*words.shape, 4)[:, :, :3]
        return [octets[k, :m].tobytes() for k, m in enumerate(used.tolist())]


def _rank(cdf: np.ndarray, target: np.ndarray) -> np.ndarray:
    """The last of the 16 rising bounds of each row that does not pass its target; the first bound is 0."""
    below = np.bitwise_count((cdf <= target[:, None]).view(np.uint64))  # eight truth values to a word
    return below[:, 0].astype(np.int64) + below[:, 1] - 1


def _bounds(cdf: np.ndarray, sym: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower bound and size of each row's symbol."""
    flat, at = cdf.reshape(-1), np.arange(0, len(sym) * 16, 16) + sym
    bottom = flat.take(at).astype(np.int64)
    top = flat.take(at + 1, mode="clip").astype(np.int64)
    top[sym == 15] = 1 << FINE
    return bottom, top - bottom


class _Flag:
    """A binary decision whose chance is mixed from three adaptive tables by learned weights.

    The tables of a lane stand one after the other (``TABLES`` entries), and so do the three
    weights of all lanes, so each step reads and writes them at once.
    """

    TABLES = 8 + 128 + 8

    def __init__(self, n: int):
        self.tables = np.full(n * self.TABLES, 1 << 13, np.int32)
        self.weights = np.full(3 * n, 22000, np.int64)
        self.rows = np.arange(3)[:, None] * n

    def code(self, coder: _Lanes, regs, at: np.ndarray, y: np.ndarray | None) -> np.ndarray:
        """``at``: the place of each lane's three chances in the tables."""
        p, weight = self.tables.take(at), self.rows + regs[2]
        s, w = STRETCH.take(p >> 4), self.weights.take(weight)
        mix = w * s
        chance = SQUASH.take(((mix[0] + mix[1] + mix[2]) >> 16) + 2047, mode="clip")
        y = coder.flag(regs, chance, y)
        self.weights[weight] = w + ((s * (((y.astype(np.int64) << 12) - chance) * 6) + 512) >> 10)
        self.tables[at] = p + ((y * np.int32((1 << 16) - 1) - p) >> 5)
        return y


class _Symbols:
    """Order-0 chances of the four symbols of an id, one row of 16 lower bounds to a context."""

    ROWS = sum(1 << b for b in CONTEXT_BITS)
    FIRST = np.cumsum([0, *(1 << b for b in CONTEXT_BITS[:-1])])

    def __init__(self, n: int):
        self.table = np.tile(EVEN, (n * self.ROWS, 1))
        self.whole = self.table.view("V32").reshape(-1)  # a row as one entry

    def _learn(self, at: np.ndarray, cdf: np.ndarray, sym: np.ndarray) -> None:
        new = TOWARDS.take(sym, axis=0)
        new -= cdf
        new >>= RATE
        new += cdf
        self.whole.put(at, new.view("V32").reshape(-1), mode="clip")

    def write(self, coder: _Lanes, regs, ids: np.ndarray) -> None:
        """All symbols of known ids; their rows are read and adapted at once."""
        nodes = ids >> np.array([[16], [12], [8], [4]])
        nodes[3] = (nodes[3] ^ (nodes[3] >> 2)) & ((1 << CONTEXT_BITS[3]) - 1)
        at = (nodes + self.FIRST[:, None] + regs[2] * self.ROWS).reshape(-1)
        sym = ((ids >> np.array([[12], [8], [4], [0]])) & 15).reshape(-1)
        cdf = self.table.take(at, axis=0, mode="clip")
        bottom, size = (x.reshape(4, -1) for x in _bounds(cdf, sym))
        self._learn(at, cdf, sym)
        for level in range(4):
            coder.known(regs, bottom[level], size[level])

    def read(self, coder: _Lanes, regs) -> np.ndarray:
        base, node = regs[2] * self.ROWS, 0
        for level, bits in enumerate(CONTEXT_BITS):
            context = node if level < 3 else (node ^ (node >> 2)) & ((1 << bits) - 1)
            at = base + (context + self.FIRST[level])
            cdf = self.table.take(at, axis=0, mode="clip")
            sym = coder.symbol(regs, cdf)
            self._learn(at, cdf, sym)
            node = (node << 4) | sym
        return node


def _follow(entry: np.ndarray, sure: np.ndarray, same: np.ndarray, cur: np.ndarray) -> np.ndarray:
    """Updated predicted ids: a kept prediction gains confidence, a wrong one loses it and then gives way."""
    return np.where(same, entry + (sure < 7), np.where(sure > 1, entry - sure + (sure >> 1), (cur << 3) | 1))


def _run(lengths: np.ndarray, ids: np.ndarray | None, data: list[bytes] | None):
    """Code the columns of ``ids`` (steps x lanes, lanes by falling length), or decode ``data``."""
    n, steps = len(lengths), int(lengths.max(initial=0))
    coder = _Lanes(n, data, steps // 2 + 64)
    out = np.zeros((steps, n), np.uint16) if ids is None else ids
    symbols, by_two, by_one = _Symbols(n), _Flag(n), _Flag(n)
    guesses = np.zeros(n * ((1 << ORDER1) + (1 << ORDER2)), np.int32)
    first = np.arange(n, dtype=np.int64) * ((1 << ORDER1) + (1 << ORDER2))
    second = first + (1 << ORDER1)
    flags = np.arange(n, dtype=np.int64) * _Flag.TABLES + np.array([[0], [8], [8 + 128]])
    before, earlier = np.zeros(n, np.int64), np.zeros(n, np.int64)
    active = n - np.searchsorted(lengths[::-1], np.arange(steps), side="right")
    for t in range(steps):
        k = int(active[t])
        before, earlier = before[:k], earlier[:k]
        cur = None if ids is None else ids[t, :k].astype(np.int64)
        if cur is not None and t % 64 == 0:
            coder.reserve(64 * 6)  # six codings an id, each moves out a word at most
        at = np.empty((2, k), np.int64)
        at[0] = ((before ^ (before >> 7)) & ((1 << ORDER1) - 1)) + first[:k]
        at[1] = (((before * 40503 + earlier * 30011) >> 3) & ((1 << ORDER2) - 1)) + second[:k]
        entry = guesses.take(at).astype(np.int64)
        guess, sure = entry >> 3, entry & 7
        (p1, p2), (c1, c2) = guess, sure
        agree = p1 == p2
        places = np.empty((3, k), np.int64)
        places[0], places[1], places[2] = c2, c2 * 16 + c1 * 2 + agree, c1
        places += flags[:, :k]
        got = np.zeros(k, np.int64)
        open_ = np.ones(k, bool)
        # only lanes that have a prediction are asked whether it holds
        for flag, told, asked in ((by_two, p2, c2 > 0), (by_one, p1, (c1 > 0) & (~agree | (c2 == 0)))):
            some = np.flatnonzero(open_ & asked)
            if len(some):
                regs = coder.take(some)
                told = told.take(some)
                hit = flag.code(coder, regs, places.take(some, axis=1), None if cur is None else told == cur.take(some))
                coder.put(regs)
                found = some[hit]
                got[found] = told[hit]
                open_[found] = False
        left = np.flatnonzero(open_)
        if len(left):
            regs = coder.take(left)
            if cur is None:
                got[left] = symbols.read(coder, regs)
            else:
                symbols.write(coder, regs, cur.take(left))
            coder.put(regs)
        if cur is None:
            cur = got
            out[t, :k] = cur
        guesses[at] = _follow(entry, sure, guess == cur, cur)
        before, earlier = cur, before
    return coder.finish() if ids is not None else out


def encode_blocks(ids: np.ndarray) -> list[tuple[int, bytes, int]]:
    """Blocks ``(number of ids, bytes, crc32 of the ids as little-endian unsigned 32-bit integers)``."""
    if len(ids) and (int(ids.max()) >= 1 << BITS or int(ids.min()) < 0):
        raise ValueError(f"ids must lie in 0..{(1 << BITS) - 1}")
    cuts = [ids[a : a + BLOCK] for a in range(0, len(ids), BLOCK)]
    out: list[tuple[int, bytes, int]] = []
    for g in range(0, len(cuts), LANES):
        group = cuts[g : g + LANES]
        lengths = np.array([len(c) for c in group])  # only the last block of all can be shorter
        columns = np.zeros((int(lengths.max()), len(group)), np.uint16)
        for k, c in enumerate(group):
            columns[: len(c), k] = c
        for c, payload in zip(group, _run(lengths, columns, None), strict=True):
            out.append((len(c), payload, zlib.crc32(c.astype("<u4").tobytes())))
    return out


def decode_blocks(blocks: list[tuple[int, bytes, int]]) -> np.ndarray:
    """Ids of the blocks one after the other; raises where a checksum is wrong."""
    parts = []
    for g in range(0, len(blocks), LANES):
        group = blocks[g : g + LANES]
        lengths = np.array([b[0] for b in group])
        order = np.argsort(-lengths, kind="stable")
        columns = _run(lengths[order], None, [group[i][1] for i in order])
        back = np.argsort(order)
        for k, (n, _, crc) in enumerate(group):
            ids = columns[:n, back[k]].astype(np.int32)
            if zlib.crc32(ids.astype("<u4").tobytes()) != crc:
                raise ValueError("a block of token ids does not have its checksum")
            parts.append(ids)
    return np.concatenate(parts) if parts else np.zeros(0, np.int32)


# ------------------------------------------------------------------ files

FILE = (
    "part int, chunk int, doc_ids array<bigint>, lengths array<bigint>, "
    "blocks array<struct<n:int,bytes:int,crc:bigint>>, payload binary"
)
_BLOCKS = pa.list_(pa.struct([("n", pa.int32()), ("bytes", pa.int32()), ("crc", pa.int64())]))


def _chunks(batches: Iterable[pa.RecordBatch], path: str, end_id: int) -> Iterator[pa.RecordBatch]:
    tok, part, chunk = tokenizer(path), TaskContext.get().partitionId(), 0
    for batch in batches:
        for rows in text_slices(batch, limit=CHUNK_BYTES):
            texts = rows.column("text")
            ids = encode_texts(tok, texts, keep=True)
            flat = np.concatenate([x for i in ids for x in (i, [end_id])]).astype(np.int32)
            blocks = encode_blocks(flat)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([part], pa.int32()),
                    pa.array([chunk], pa.int32()),
                    pa.array([rows.column("doc_id").to_pylist()], pa.list_(pa.int64())),
                    pa.array([[len(i) + 1 for i in ids]], pa.list_(pa.int64())),
                    pa.array([[{"n": n, "bytes": len(b), "crc": c} for n, b, c in blocks]], _BLOCKS),
                    pa.array([b"".join(b for _, b, _ in blocks)], pa.binary()),
                ],
                names=["part", "chunk", "doc_ids", "lengths", "blocks", "payload"],
            )
            chunk += 1


def write_ids(docs: DataFrame, vocabulary: str, path: str, end_id: int = 2) -> None:
    """Write the ids of all documents, each followed by ``end_id``, in ascending doc_id order."""
    with_package(docs)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.xxhash64("text").alias("h"))
    order = [F.col("doc_id").asc_nulls_first(), F.col("h")]
    sorted_rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    sorted_rows.mapInArrow(lambda b: _chunks(b, vocabulary, end_id), FILE).write.parquet(path)


def _documents(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(batch.num_rows):
            row = batch.slice(k, 1).to_pylist()[0]
            blocks, at = [], 0
            for b in row["blocks"]:
                blocks.append((b["n"], row["payload"][at : at + b["bytes"]], b["crc"]))
                at += b["bytes"]
            ids = decode_blocks(blocks)
            bounds = np.concatenate([[0], np.cumsum(row["lengths"])]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(row["doc_ids"], pa.int64()),
                    pa.array(bounds[:-1].astype(np.int64) + row["start"], pa.int64()),  # starts pass 31 bits
                    pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32())),
                ],
                names=["doc_id", "start", "ids"],
            )


def _with_starts(spark: SparkSession, path: str) -> DataFrame:
    """File rows with the number of ids before each chunk. The driver sees one sum per part."""
    files = spark.read.schema(FILE).parquet(path)
    sizes = files.selectExpr("part", "chunk", "aggregate(lengths, 0L, (a, x) -> a + x) AS n")
    total, offsets = 0, []
    for part, n in sorted((r["part"], r["n"]) for r in sizes.groupBy("part").agg(F.sum("n").alias("n")).collect()):
        offsets.append((part, total))
        total += n
    parts = spark.createDataFrame(offsets, "part int, before bigint")
    starts = sizes.join(F.broadcast(parts), "part").selectExpr(
        "part",
        "chunk",
        "before + sum(n) OVER (PARTITION BY part ORDER BY chunk ROWS UNBOUNDED PRECEDING) - n AS start",
    )
    return files.join(starts, ["part", "chunk"])


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, ids`` of every document in the files."""
    return with_package(_with_starts(spark, path)).mapInArrow(_documents, "doc_id bigint, start bigint, ids array<int>")


def digests(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` from the files; ids stay in the task that decoded them."""

    def run(batches):
        for batch in _documents(batches):
            lists = batch.column("ids")
            bounds, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
            crc = [zlib.crc32(flat[a:b].astype("<u4").tobytes()) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("start"), pa.array(np.diff(bounds), pa.int64()), pa.array(crc, pa.int64())],
                names=["doc_id", "start", "n_tokens", "ids_crc32"],
            )

    return with_package(_with_starts(spark, path)).mapInArrow(
        run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    )
