"""BPE encoding and decoding with a public vocabulary, exact on texts of any length.

Texts of up to ``LEAF`` characters are encoded by the words between ASCII white
space: no match of the vocabulary's split pattern crosses white space, so the
ids of a text are the ids of its words in order, and every distinct word of a
slice is encoded once.

Longer texts are encoded as a tree. Leaves of ``LEAF`` characters are encoded in
parallel, as rows of their own; neighbours are then joined pairwise. A leaf
knows nothing beyond its cut, so around each join a window is encoded anew and
grows until it agrees with the left part at a place before the cut and with
the right part at a place after it. Agreement is a place where both
encodings start a word (the split pattern never looks back, so all that
follows is equal), or where both have the same two tokens inside one unbroken word
(a token sequence is the encoding of a word exactly if every neighbouring pair
is; the stitched sequence only has pairs that stand in some encoding). A window
that never agrees ends up as the whole text, which is exact as well.

Defined cases: a NULL text is empty and has no ids; repeated rows are rows of
their own; NULL ids are kept; an empty table gives no rows. Extra columns are
not read.
"""

from __future__ import annotations

import hashlib
import os
import re
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WordTable, text_slices, with_package

LEAF = 32768  # characters of a leaf
FIRST_WINDOW = 64  # characters on each side of a join
WORD_END = "</w>"  # the vocabulary's mark of a word's last token
ENCODE_BATCH = 8192  # words handed to the library at once
LINE = 64  # plain words that make one line of them
MARGIN = 40  # characters before the end of a part whose tokens may still change


@lru_cache(maxsize=4)
def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task per core
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    return tok


# letters that stay single letters when lower-cased and composed; words of them are one match of the split pattern
PLAIN = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]+")

# ids of words seen before by this process, as bytes; forgotten when there are too many
_KNOWN: dict[int, dict[str, bytes]] = {}
_PLACES: dict[int, dict[str, tuple]] = {}
_SHAPES: dict[int, tuple] = {}
KNOWN_WORDS, KNOWN_PLACES = 250_000, 40_000


def _token_shapes(tok) -> tuple[np.ndarray, np.ndarray]:
    """Characters that a token stands for in ASCII text, and whether it ends a match of the split pattern."""
    if id(tok) not in _SHAPES:
        vocab = tok.get_vocab(with_added_tokens=False)
        length, ends = np.zeros(max(vocab.values()) + 1, np.int64), np.zeros(max(vocab.values()) + 1, bool)
        for token, i in vocab.items():
            ends[i] = token.endswith(WORD_END)
            length[i] = len(token) - len(WORD_END) * ends[i]
        _SHAPES[id(tok)] = (length, ends)
    return _SHAPES[id(tok)]


def _bytes_of(ids: list[int]) -> bytes:
    return np.array(ids, "<i4").tobytes()


def _split_tail(word: str) -> tuple[str, str]:
    """``(body, tail)`` whose ids are those of ``word`` one after the other.

    Plain and ASCII letters are lower-cased by the vocabulary's normaliser anyway, and a full stop
    or comma after plain letters is a match of its own; special tokens are left as they are.
    """
    if word.endswith((".", ",")) and PLAIN.fullmatch(word, 0, len(word) - 1):
        return word[:-1].lower(), word[-1]
    if PLAIN.fullmatch(word) or (word.isascii() and "<|" not in word):
        return word.lower(), ""
    return word, ""


def encode_words(tok, words: pa.Array, keep: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words one after the other, and the bounds of each word; ``keep``: a full table keeps the words in use."""
    known = _KNOWN.setdefault(id(tok), {})
    split = [_split_tail(w) for w in words.to_pylist()]
    used = {w for pair in split for w in pair}
    if len(known) > KNOWN_WORDS:
        kept = {w: known[w] for w in used if w in known} if keep else {}
        known.clear()
        known.update(kept)
    known[""] = b""
    fresh = [w for w in used if w not in known]
    del used
    # plain words are one match each, so they can go to the library by the line and come back by their word ends
    plain = [w for w in fresh if PLAIN.fullmatch(w)]
    lines = [plain[k : k + LINE] for k in range(0, len(plain), LINE)]
    _, ends = _token_shapes(tok)
    for k in range(0, len(lines), ENCODE_BATCH // LINE):
        some = lines[k : k + ENCODE_BATCH // LINE]
        for line, e in zip(some, tok.encode_batch_fast([" ".join(x) for x in some], add_special_tokens=False), strict=True):
            ids = np.array(e.ids, "<i4")
            stops = (np.flatnonzero(ends[ids]) + 1).tolist()
            raw, at = ids.tobytes(), 0
            for w, stop in zip(line, stops, strict=True):
                known[w] = raw[4 * at : 4 * stop]
                at = stop
    other = [w for w in fresh if w not in known]
    for k in range(0, len(other), ENCODE_BATCH):
        some = other[k : k + ENCODE_BATCH]
        known.update((w, _bytes_of(e.ids)) for w, e in zip(some, tok.encode_batch_fast(some, add_special_tokens=False), strict=True))
    found = [known[body] + known[tail] if tail else known[body] for body, tail in split]
    bounds = np.zeros(len(found) + 1, np.int64)
    np.cumsum([len(x) // 4 for x in found], out=bounds[1:])
    return np.frombuffer(b"".join(found), "<i4").astype(np.int32), bounds


def encode_texts(tok, texts: pa.Array, keep: bool = False) -> list[np.ndarray]:
    """Ids of every text, by its distinct white-space words."""
    table = WordTable(texts, lower=False)
    flat, bounds = encode_words(tok, table.words, keep)
    counts = (bounds[1:] - bounds[:-1])[table.codes]
    ends = np.concatenate([[0], np.cumsum(counts)])
    take = np.repeat(bounds[:-1][table.codes] - ends[:-1], counts) + np.arange(ends[-1])
    ids = flat[take]
    cuts = ends[table.bounds]
    return [ids[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


class Part:
    """The encoding of ``text[lo:hi]`` with the places of its tokens in the whole text."""

    __slots__ = ("lo", "hi", "ids", "start", "end", "word")

    def __init__(self, lo, hi, ids, start, end, word):
        self.lo, self.hi, self.ids, self.start, self.end, self.word = lo, hi, ids, start, end, word

    def rows(self, a: int, b: int) -> tuple:
        return self.ids[a:b], self.start[a:b], self.end[a:b], self.word[a:b]

    def first_word_tokens(self) -> np.ndarray:
        """True where a token starts a word of the split pattern."""
        new = np.ones(len(self.ids), bool)
        new[1:] = (self.word[1:] != self.word[:-1]) | (self.word[1:] < 0)
        return new


def encode_part(tok, text: str, lo: int) -> Part:
    e = tok.encode(text, add_special_tokens=False)
    at = np.array(e.offsets, np.int64).reshape(-1, 2) + lo
    word = np.array([-1 if w is None else w for w in e.word_ids], np.int64)
    return Part(lo, lo + len(text), np.array(e.ids, np.int32), at[:, 0], at[:, 1], word)


def encode_parts(path: str, texts: list[str]) -> list[Part]:
    """Like :func:`encode_part` for many leaves, by their distinct white-space words.

    Places inside ASCII words follow from the lengths of the tokens; other words, and words
    that may hold a special token, take theirs from the library.
    """
    tok = tokenizer(path)
    length, ends = _token_shapes(tok)
    table = WordTable(pa.array(texts, pa.string()), lower=False)
    words = table.words.to_pylist()
    flat, bounds = encode_words(tok, table.words)
    flat = flat.astype(np.int64)
    known = flat < len(length)
    size = np.where(known, length[np.where(known, flat, 0)], 0)
    stop = np.concatenate([[0], np.cumsum(size)])
    base = np.repeat(stop[bounds[:-1]], np.diff(bounds))
    start, end = stop[:-1] - base, stop[1:] - base
    flag = np.ones(len(flat), np.int8)  # 0: goes on inside a match, 1: begins one, 2: special
    flag[1:] = np.where(known, ends[np.where(known, flat, 0)], True)[:-1]
    flag[bounds[:-1][np.diff(bounds) > 0]] = 1
    total = stop[bounds[1:]] - stop[bounds[:-1]]
    places = _PLACES.setdefault(id(tok), {})
    if len(places) > KNOWN_PLACES:
        places.clear()
    for k, w in enumerate(words):
        if (not w.isascii() or "<|" in w or total[k] != len(w)) and bounds[k] < bounds[k + 1]:
            if w not in places:
                e = tok.encode(w, add_special_tokens=False)
                number = np.array([-1 if n is None else n for n in e.word_ids], np.int64)
                new = np.ones(len(number), np.int8)
                new[1:] = number[1:] != number[:-1]
                new[number < 0] = 2
                places[w] = (np.array(e.offsets, np.int32).reshape(-1, 2), new)
            at, new = places[w]
            a, b = bounds[k], bounds[k + 1]
            start[a:b], end[a:b], flag[a:b] = at[:, 0], at[:, 1], new
    out = []
    for k, text in enumerate(texts):
        codes = table.codes[table.bounds[k] : table.bounds[k + 1]]
        points = np.frombuffer(text.encode("utf-32-le"), "<u4")
        solid = ~((points == 32) | ((points >= 9) & (points <= 13)))
        place = np.flatnonzero(solid & np.concatenate([[True], ~solid[:-1]])) if len(solid) else np.zeros(0, np.int64)
        counts = bounds[codes + 1] - bounds[codes]
        done = np.cumsum(counts)
        take = np.repeat(bounds[codes] - (done - counts), counts) + np.arange(int(counts.sum()))
        shift = np.repeat(place, counts)
        out.append(Part(0, len(text), flat[take].astype(np.int32), start[take] + shift, end[take] + shift, _word_numbers(flag[take])))
    return out


def _word_numbers(flag: np.ndarray) -> np.ndarray:
    word = np.cumsum(flag > 0)
    word[flag == 2] = -1
    return word


def _agree(text: str, done: Part, later: Part, least: int) -> tuple[int, int] | None:
    """Token indexes (in ``done``, in ``later``) from which ``later`` may replace ``done``.

    ``done`` is right up to ``MARGIN`` before its end; ``later`` begins inside it.
    The place is at ``least`` or after it.
    """
    if not len(done.ids) or not len(later.ids):
        return None
    top = done.hi - MARGIN
    # places before which a token of each part ends and at which the next one starts
    ok_a = np.ones(len(done.ids), bool)
    ok_a[1:] = done.end[:-1] <= done.start[1:]
    ok_b = np.ones(len(later.ids), bool)
    ok_b[1:] = later.end[:-1] <= later.start[1:]
    ia = np.flatnonzero(ok_a & (done.start >= max(least, later.lo)) & (done.start <= top))
    ib = np.flatnonzero(ok_b & (later.start <= top))
    places, xa, xb = np.intersect1d(done.start[ia], later.start[ib], assume_unique=False, return_indices=True)
    if not len(places):
        return None
    new_a, new_b = done.first_word_tokens(), later.first_word_tokens()
    for p, i, j in zip(places[::-1], ia[xa][::-1], ib[xb][::-1], strict=True):
        if p > 0 and unicodedata.normalize("NFC", text[p - 1 : p + 1]) != (
            unicodedata.normalize("NFC", text[p - 1]) + unicodedata.normalize("NFC", text[p])
        ):
            continue
        if p > 0 and unicodedata.combining(text[p]):
            continue
        if new_a[i] and new_b[j] and (j > 0 or p == later.lo):
            return int(i), int(j)
        inside = not new_a[i] and not new_b[j] and i > 0 and j > 0
        if inside and i + 1 < len(done.ids) and j + 1 < len(later.ids):
            same_before = done.ids[i - 1] == later.ids[j - 1] and done.start[i - 1] == later.start[j - 1]
            same_after = done.ids[i] == later.ids[j] and done.end[i] == later.end[j]
            if same_before and same_after and done.end[i] <= top:
                return int(i), int(j)
    return None


def join_parts(tok, text: str, left: Part, right: Part) -> Part:
    """Exact encoding of ``text[left.lo:right.hi]`` from the encodings of its halves."""
    cut, width = left.hi, FIRST_WINDOW + MARGIN
    while True:
        a, b = max(left.lo, cut - width), min(right.hi, cut + width)
        window = encode_part(tok, text[a:b], a)
        head = (0, 0) if a == left.lo else _agree(text, left, window, a)
        tail = (len(window.ids), len(right.ids)) if b == right.hi else _agree(text, window, right, cut)
        if head is not None and tail is not None and head[1] <= tail[0]:
            i, x = head
            y, j = tail
            return _merged(left, window, right, i, x, y, j)
        width *= 4


def _merged(left: Part, window: Part, right: Part, i: int, x: int, y: int, j: int) -> Part:
    """Tokens ``left[:i] + window[x:y] + right[j:]`` with word numbers that keep stitched words whole."""
    flags = [left.first_word_tokens()[:i], window.first_word_tokens()[x:y], right.first_word_tokens()[j:]]
    special = [left.word[:i] < 0, window.word[x:y] < 0, right.word[j:] < 0]
    word = np.cumsum(np.concatenate(flags))
    word[np.concatenate(special)] = -1
    cols = [np.concatenate([getattr(left, c)[:i], getattr(window, c)[x:y], getattr(right, c)[j:]]) for c in ("ids", "start", "end")]
    return Part(left.lo, right.hi, *cols, word)


def join_tree(tok, text: str, parts: list[Part]) -> np.ndarray:
    """Join neighbouring parts pairwise, level by level, up to the whole text."""
    while len(parts) > 1:
        parts = [
            join_parts(tok, text, parts[k], parts[k + 1]) if k + 1 < len(parts) else parts[k] for k in range(0, len(parts), 2)
        ]
    return parts[0].ids if parts else np.zeros(0, np.int32)


def encode_long(tok, text: str, leaf: int = LEAF) -> np.ndarray:
    """The tree in one place, for tests and for callers without Spark."""
    return join_tree(tok, text, [encode_part(tok, text[a : a + leaf], a) for a in range(0, len(text), leaf)])


# ------------------------------------------------------------------ Spark stages

_IDS = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])
_LEAVES = "row_key bigint, doc_id bigint, leaf int, leaves int, text string"
_PARTS = "row_key bigint, doc_id bigint, leaf int, leaves int, text string, ids binary, at binary"


def _leaf_rows(batches: Iterable[pa.RecordBatch], leaf: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for key, doc, text in zip(*(batch.column(c).to_pylist() for c in ("row_key", "doc_id", "text")), strict=True):
            starts = range(0, len(text), leaf)
            for n, a in enumerate(starts):
                yield pa.RecordBatch.from_pydict(
                    {"row_key": [key], "doc_id": [doc], "leaf": [n], "leaves": [len(starts)], "text": [text[a : a + leaf]]},
                    schema=pa.schema(
                        [("row_key", pa.int64()), ("doc_id", pa.int64()), ("leaf", pa.int32()), ("leaves", pa.int32()), ("text", pa.string())]
                    ),
                )


def _encode_leaves(batches: Iterable[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    """Ids of every leaf and, packed, the places and word starts of its tokens."""
    for batch in batches:
        for rows in text_slices(batch):
            parts = encode_parts(path, rows.column("text").to_pylist())
            packed = []
            for p in parts:
                flag = np.where(p.word < 0, 2, p.first_word_tokens())
                packed.append(np.concatenate([p.start, p.end, flag]).astype("<u4" if p.hi > 0xFFFF else "<u2").tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    *rows.columns,
                    pa.array([p.ids.astype("<i4").tobytes() for p in parts], pa.binary()),
                    pa.array(packed, pa.binary()),
                ],
                names=[*rows.schema.names, "ids", "at"],
            )


def _join_leaves(batches: Iterable[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (row_key, leaf): the leaves of one text stand together; one text is held at a time."""
    tok = tokenizer(path)
    key, texts, raw, doc = None, [], [], None

    def flush():
        parts, lo = [], 0
        for text, ids, at in zip(texts, *zip(*raw, strict=True), strict=True):
            start, end, flag = np.frombuffer(at, "<u4" if len(text) > 0xFFFF else "<u2").reshape(3, -1).astype(np.int64)
            tokens = np.frombuffer(ids, "<i4").astype(np.int32)
            parts.append(Part(lo, lo + len(text), tokens, start + lo, end + lo, _word_numbers(flag)))
            lo += len(text)
        ids = join_tree(tok, "".join(texts), parts)
        return pa.RecordBatch.from_arrays([pa.array([doc], pa.int64()), pa.array([ids], pa.list_(pa.int32()))], schema=_IDS)

    for batch in batches:
        cols = [batch.column(c).to_pylist() for c in ("row_key", "doc_id", "text", "ids", "at")]
        for row_key, doc_id, text, ids, at in zip(*cols, strict=True):
            if row_key != key and key is not None:
                yield flush()
                texts, raw = [], []
            key, doc = row_key, doc_id
            texts.append(text)
            raw.append((ids, at))
    if key is not None:
        yield flush()


def _encode_short(batches: Iterable[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    tok = tokenizer(path)
    for batch in batches:
        for rows in text_slices(batch):
            ids = encode_texts(tok, rows.column("text"))
            bounds = np.zeros(len(ids) + 1, np.int32)
            np.cumsum([len(x) for x in ids], out=bounds[1:])
            flat = np.concatenate(ids) if ids else np.zeros(0, np.int32)
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(flat, pa.int32()))], schema=_IDS
            )


def _long_parts(docs: DataFrame, path: str, leaf: int) -> DataFrame:
    """Encoded leaves of the long texts, those of one text together and in order."""
    rows = docs.where(f"char_length(text) > {leaf}").selectExpr("monotonically_increasing_id() AS row_key", "doc_id", "text")
    leaves = rows.mapInArrow(lambda b: _leaf_rows(b, leaf), _LEAVES).repartition("row_key", "leaf")
    parts = leaves.mapInArrow(lambda b: _encode_leaves(b, path), _PARTS)
    return parts.repartition("row_key").sortWithinPartitions("row_key", "leaf")


def encode(docs: DataFrame, path: str, leaf: int = LEAF) -> DataFrame:
    """``doc_id, ids`` of every row of ``docs``."""
    with_package(docs)
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    short = docs.where(f"char_length(text) <= {leaf}").mapInArrow(lambda b: _encode_short(b, path), "doc_id bigint, ids array<int>")
    joined = _long_parts(docs, path, leaf).mapInArrow(lambda b: _join_leaves(b, path), "doc_id bigint, ids array<int>")
    return short.unionByName(joined)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``doc_id, text`` as the library decodes the ids, special tokens kept."""
    with_package(encoded)

    def run(batches):
        tok = tokenizer(path)
        for batch in batches:
            texts = tok.decode_batch([x or [] for x in batch.column("ids").to_pylist()], skip_special_tokens=False)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id bigint, text string")


def _digest_rows(batches: Iterable[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    """Digests of ids and of their decoded text, in the task that has the ids."""
    tok = tokenizer(path)
    for batch in batches:
        docs = batch.column("doc_id")
        lists = batch.column("ids")
        bounds = lists.offsets.to_numpy()
        flat = lists.values.to_numpy(zero_copy_only=False)
        ids = [flat[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        decoded = (tok.decode(x.tolist(), skip_special_tokens=False) for x in ids)
        yield pa.RecordBatch.from_arrays(
            [
                docs,
                pa.array([len(x) for x in ids], pa.int64()),
                pa.array([hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in ids], pa.string()),
                pa.array([hashlib.sha256(t.encode()).hexdigest() for t in decoded], pa.string()),
            ],
            names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
        )


def round_trip(docs: DataFrame, path: str, leaf: int = LEAF) -> DataFrame:
    """Digest of the ids and of the decoded text per row; ids never leave the task that made them."""
    with_package(docs)
    out = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    short = docs.where(f"char_length(text) <= {leaf}").mapInArrow(lambda b: _digest_rows(_encode_short(b, path), path), out)
    joined = _long_parts(docs, path, leaf).mapInArrow(lambda b: _digest_rows(_join_leaves(b, path), path), out)
    return short.unionByName(joined)
