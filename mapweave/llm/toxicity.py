"""Toxic spans from a linear-chain conditional random field.

Labels are given per document. Labelled tokens follow from them: words (or their
first letters) that tell toxic from clean training documents apart by their
log-likelihood ratio are labelled 1 in toxic documents, every other token is 0. They are
counted by Spark over all labelled training rows. The CRF over the two labels has the word, its
first letters and both neighbours as features and one chain per sentence, of any length. It
is fitted by full-batch gradients on a bounded sample (``TRAIN_TOXIC`` and
``TRAIN_CLEAN`` documents of up to ``TRAIN_CHARS`` characters, and ``TRAIN_CHAINS`` sentences),
chosen by hash, in one task on an executor.

Scoring runs the forward and backward pass over every token of every text. A
document's score is a logistic function of the log of the expected number of toxic
tokens (the sum of all marginals) and the log odds of its most toxic token. Its three weights are fitted on
``HEAD_TOXIC`` and ``HEAD_CLEAN`` training documents that the CRF was not fitted on, weighted
to the share of their label. Tokens with a marginal of one half or more are the offending spans.

Defined cases: NULL, empty or word-free texts score 0; without training rows of
both labels everything scores 0; a document with several labels counts as toxic if
any says so; repeated rows score equally; an empty table gives no rows. Only
``doc_id`` and ``text`` are read, and only ``text`` is an input of the score.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator
from dataclasses import asdict, dataclass, field
from math import exp, log

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WordTable, mix64, sized, stage, text_slices, with_package

TRAIN_TOXIC, TRAIN_CLEAN, TRAIN_CHARS, TRAIN_CHAINS = 1200, 2200, 20_000, 15_000
HEAD_TOXIC, HEAD_CLEAN = 300, 900
STEMS = (4, 5, 6)  # lengths of the first letters that are features of their own
PRIOR = {4: 4.0, 5: 2.0}  # how much stronger the prior holds short beginnings, which also stand in harmless words
LEAST_RATIO = 30.0  # log-likelihood ratio from which a unit tells toxicity
LEAST_ODDS = 50.0  # and how many times more often it must stand in toxic documents
COUNT_BYTES, SCORE_BYTES = 1 << 20, 2 << 20  # text that a task counts or scores at once
BITS, CHUNK = 1 << 24, 1 << 15  # of the bitmap of units that may tell, and of one row of Spark's bitmap functions
LETTERS = re.compile(r"[^\W\d_]+")
SENTENCE_END = (".", "!", "?")


@dataclass
class Model:
    """Weights of the label difference (toxic minus clean) and of the label pairs."""

    units: dict = field(default_factory=dict)
    before: dict = field(default_factory=dict)
    after: dict = field(default_factory=dict)
    bias: float = 0.0
    start: float = 0.0
    pairs: tuple = (0.0, 0.0, 0.0, 0.0)  # 00, 01, 10, 11
    head: tuple = (0.0, 0.0, 0.0)  # constant, log of the expected toxic tokens, log odds of the most toxic one

    @property
    def empty(self) -> bool:
        return not self.units


class Tokens:
    """Letter runs of a run of texts, coded, with chains that end at sentence ends."""

    def __init__(self, texts: pa.Array):
        table = WordTable(texts, lower=False)
        runs, numbers, ends = [], {}, []
        for w in table.words.to_pylist():
            found = [numbers.setdefault(x.lower(), len(numbers)) for x in LETTERS.findall(w)]
            runs.append(found)
            ends.append(w.endswith(SENTENCE_END))
        counts = np.array([len(r) for r in runs], np.int64)
        flat = np.fromiter((x for r in runs for x in r), np.int64, count=int(counts.sum()))
        first = np.concatenate([[0], np.cumsum(counts)])
        per_word = counts[table.codes] if len(table.codes) else np.zeros(0, np.int64)
        at = np.concatenate([[0], np.cumsum(per_word)])
        take = np.repeat(first[:-1][table.codes] - at[:-1], per_word) + np.arange(at[-1]) if len(table.codes) else np.zeros(0, np.int64)
        self.codes = flat[take]
        self.bounds = at[table.bounds]
        self.vocabulary = list(numbers)
        n = len(self.codes)
        # a chain starts at each text and after each sentence end
        starts = np.zeros(n + 1, bool)
        starts[self.bounds] = True
        if len(table.codes):
            starts[at[1:][np.array(ends, bool)[table.codes]]] = True
        where = np.flatnonzero(starts[:n])
        lengths = np.diff(np.append(where, n))
        self.starts, self.lengths = where, lengths
        self.is_start = np.zeros(n, bool)
        self.is_start[where] = True


def ratios(emission: np.ndarray, starts: np.ndarray, lengths: np.ndarray, start: float, pairs) -> tuple[np.ndarray, np.ndarray]:
    """Log ratios toxic : clean of the forward and of the backward messages at every token."""
    fwd, bwd = np.empty(len(emission)), np.empty(len(emission))
    order = np.argsort(-lengths, kind="stable")
    s, ln = starts[order], lengths[order]
    steps = int(ln[0]) if len(ln) else 0
    active = len(ln) - np.searchsorted(ln[::-1], np.arange(steps), side="right")  # chains longer than t
    e00, e01, e10, e11 = np.exp(pairs).tolist()
    # from the step on at which one chain is left, plain numbers are quicker than arrays of one
    alone = max(1, int(np.searchsorted(-active, -1)))
    r = np.zeros(0)
    for t in range(min(steps, alone)):
        at = s[: active[t]] + t
        if t == 0:
            r = start + emission[at]
        else:
            x = np.exp(np.clip(r[: active[t]], -60, 60))
            r = emission[at] + np.log((e01 + x * e11) / (e00 + x * e10))
        fwd[at] = r
    last = s + ln - 1
    bwd[last] = 0.0
    if alone < steps:
        first, z = int(s[0]), float(r[0])
        own, ahead = emission[first : first + steps].tolist(), []
        for t in range(alone, steps):
            x = exp(min(60.0, max(-60.0, z)))
            z = own[t] + log((e01 + x * e11) / (e00 + x * e10))
            ahead.append(z)
        fwd[first + alone : first + steps] = ahead
        z, back = 0.0, []
        for t in range(steps - 2, alone - 2, -1):
            x = exp(min(60.0, max(-60.0, z + own[t + 1])))
            z = log((e10 + x * e11) / (e00 + x * e01))
            back.append(z)
        bwd[first + alone - 1 : first + steps - 1] = back[::-1]
    for t in range(min(steps, alone) - 2, -1, -1):
        at = s[: active[t + 1]] + t
        x = np.exp(np.clip(bwd[at + 1] + emission[at + 1], -60, 60))
        bwd[at] = np.log((e10 + x * e11) / (e00 + x * e01))
    return fwd, bwd


def _neighbours(codes: np.ndarray, is_start: np.ndarray, none: int) -> tuple[np.ndarray, np.ndarray]:
    before = np.concatenate([[none], codes[:-1]]) if len(codes) else codes
    before = np.where(is_start, none, before)
    after = np.concatenate([codes[1:], [none]]) if len(codes) else codes
    after = np.where(np.concatenate([is_start[1:], [True]]) if len(codes) else is_start, none, after)
    return before, after


def log_odds(model: Model, tokens: Tokens) -> np.ndarray:
    """Log odds of the toxic label for every token."""
    v = tokens.vocabulary
    own = np.array([sum(model.units.get(u, 0.0) for u in units(w)) for w in v] + [0.0])
    left = np.array([model.before.get(w, 0.0) for w in v] + [0.0])
    right = np.array([model.after.get(w, 0.0) for w in v] + [0.0])
    before, after = _neighbours(tokens.codes, tokens.is_start, len(v))
    emission = model.bias + own[tokens.codes] + left[before] + right[after]
    fwd, bwd = ratios(emission, tokens.starts, tokens.lengths, model.start, model.pairs)
    return np.clip(fwd + bwd, -60, 60)


def _signs(odds: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts that have tokens, and per such text: 1, log of the expected toxic tokens, greatest log odds."""
    some = np.flatnonzero(np.diff(bounds))
    if not len(some):
        return some, np.zeros((0, 3))
    first = bounds[:-1][some]
    total = np.add.reduceat(1.0 / (1.0 + np.exp(-odds)), first)
    return some, np.stack([np.ones(len(some)), np.log(total), np.maximum.reduceat(odds, first)], axis=1)


def document_scores(model: Model, odds: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Score of every text of a run from the log odds of its tokens; 0 without tokens."""
    out = np.zeros(len(bounds) - 1)
    some, signs = _signs(odds, bounds)
    out[some] = 1.0 / (1.0 + np.exp(-(signs @ np.array(model.head))))
    return out


# ------------------------------------------------------------------ training


def units(word: str) -> list[str]:
    """What a word is known by: itself and its first letters (nothing for no word)."""
    return [] if not word else ["=" + word, *("^" + word[:k] for k in STEMS if len(word) >= k)]


def _unit_codes(vocabulary: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct units, and the unit codes of every word with their bounds."""
    names: dict[str, int] = {}
    per_word = [[names.setdefault(u, len(names)) for u in units(w)] for w in vocabulary]
    bounds = np.concatenate([[0], np.cumsum([len(x) for x in per_word])]).astype(np.int64)
    return list(names), np.fromiter((x for u in per_word for x in u), np.int64, count=int(bounds[-1])), bounds


def _spread(codes: np.ndarray, flat: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Units of every token in order, and the token each belongs to."""
    counts = (bounds[1:] - bounds[:-1])[codes]
    ends = np.cumsum(counts)
    take = np.repeat(bounds[:-1][codes] - (ends - counts), counts) + np.arange(int(counts.sum()))
    return flat[take], np.repeat(np.arange(len(codes)), counts)


def _unit_hashes(names: list[str]) -> np.ndarray:
    return pd.util.hash_array(np.array(names, object), categorize=False).astype(np.uint64) if names else np.zeros(0, np.uint64)


def _labelled(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[Tokens, np.ndarray]]:
    """Tokens of a run of labelled texts, and the label of the text of each."""
    for batch in batches:
        for rows in text_slices(batch, limit=COUNT_BYTES):
            tokens = Tokens(rows.column("text"))
            toxic = rows.column("toxic").to_numpy(zero_copy_only=False).astype(bool)
            yield tokens, np.repeat(toxic, np.diff(tokens.bounds))


def _plain_counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per unit (hashed) its tokens in toxic and in clean texts."""
    for tokens, bad in _labelled(batches):
        names, flat, bounds = _unit_codes(tokens.vocabulary)
        of_word = np.repeat(np.arange(len(tokens.vocabulary)), np.diff(bounds))
        x, y = (
            np.bincount(flat, weights=np.bincount(tokens.codes[some], minlength=len(tokens.vocabulary))[of_word], minlength=len(names))
            for some in (bad, ~bad)
        )
        yield pa.RecordBatch.from_arrays(
            [pa.array(_unit_hashes(names).view(np.int64)), pa.array(x.astype(np.int64)), pa.array(y.astype(np.int64))], names=["h", "x", "y"]
        )


def _places(batches: Iterable[pa.RecordBatch], bitmap) -> Iterator[pa.RecordBatch]:
    """Units that may tell toxicity at each pair of words they stand between, and whether in a toxic text."""
    for tokens, bad in _labelled(batches):
        names, flat, bounds = _unit_codes(tokens.vocabulary)
        v = len(tokens.vocabulary)
        bit = (_unit_hashes(names) >> np.uint64(16) & np.uint64(BITS - 1)).astype(np.int64)
        may = bitmap.value[bit >> 3] >> (bit & 7).astype(np.uint8) & 1 == 1
        wanted = np.zeros(v, bool)
        wanted[np.repeat(np.arange(v), np.diff(bounds))[may[flat]]] = True
        some = np.flatnonzero(wanted[tokens.codes])
        unit, token = _spread(tokens.codes[some], flat, bounds)
        token, unit = some[token][may[unit]], unit[may[unit]]
        words = np.append(_unit_hashes(tokens.vocabulary), np.uint64(0))
        before, after = _neighbours(tokens.codes, tokens.is_start, v)
        with np.errstate(over="ignore"):
            place = mix64(words[before] * np.uint64(0xD6E8FEB86659FD93) + words[after])[token].view(np.int64)
        rows = np.unique(np.stack([unit, place, bad[token].astype(np.int64)], axis=1), axis=0)
        yield pa.RecordBatch.from_arrays(
            [pa.array([names[u] for u in rows[:, 0].tolist()], pa.string()), pa.array(rows[:, 1]), pa.array(rows[:, 2])],
            names=["unit", "place", "bad"],
        )


def telling_units(labelled: DataFrame) -> DataFrame:
    """``unit`` of all units that tell toxic from clean texts apart; ``labelled`` has ``text, toxic``.

    A unit is counted once for each pair of neighbouring words it stands between, so copies of
    a text add nothing. Plain counts of hashed units settle most of them before; who may tell is
    kept in a bitmap of fixed size, in which hashes that meet only let more through.
    """
    counts = stage(labelled.mapInArrow(_plain_counts, "h bigint, x bigint, y bigint").groupBy("h").agg(F.sum("x").alias("x"), F.sum("y").alias("y")))
    total = counts.agg(F.sum("x"), F.sum("y")).first()
    n1, n0 = (float(max(1, t or 0)) for t in total)
    open_units = counts.where(f"x >= 3 AND x / {n1}D >= {0.1 * LEAST_ODDS}D * y / {n0}D").select(F.expr(f"shiftright(h, 16) & {BITS - 1}L").alias("b"))
    chunks = open_units.groupBy(F.expr(f"b div {CHUNK}").alias("chunk")).agg(F.expr(f"bitmap_construct_agg(b % {CHUNK})").alias("bits"))
    bitmap = np.zeros(BITS // 8, np.uint8)
    for row in chunks.toLocalIterator():
        part = np.frombuffer(bytes(row.bits), np.uint8)
        bitmap[row.chunk * CHUNK // 8 :][: len(part)] = part
    sent = labelled.sparkSession.sparkContext.broadcast(bitmap)
    places = labelled.mapInArrow(lambda b: _places(b, sent), "unit string, place bigint, bad bigint").groupBy("unit", "place").agg(F.max("bad").alias("bad"))
    per_unit = places.groupBy("unit").agg(F.sum("bad").cast("double").alias("x"), F.sum(1 - F.col("bad")).cast("double").alias("y"))
    part = "CASE WHEN {0} > 0 THEN {0} * ln({0} * {1}D / ({2}D * (x + y))) ELSE 0D END"
    gain = f"2 * ({part.format('x', n1 + n0, n1)} + {part.format('y', n1 + n0, n0)})"
    return per_unit.where(f"{gain} >= {LEAST_RATIO} AND x / {n1}D >= {LEAST_ODDS}D * (y + 0.5D) / {n0}D").select("unit")


def fit(texts: pa.Array, toxic: np.ndarray, telling: set[str], steps: int = 100, rate: float = 0.2, decay: float = 0.1) -> Model:
    """Fit the CRF on labelled documents: weighted full-batch gradients (Adam) with a Gaussian prior."""
    tokens = Tokens(texts)
    vocabulary, v = tokens.vocabulary, len(tokens.vocabulary)
    word_told = np.fromiter((any(u in telling for u in units(w)) for w in vocabulary), bool, count=v)
    if not word_told.any():
        return Model()
    doc = np.repeat(np.arange(len(toxic)), np.diff(tokens.bounds))
    label = word_told[tokens.codes] & toxic[doc]
    # only words that begin like a telling one have features of their own; the bias speaks for all others
    beginnings = {u for k in np.flatnonzero(word_told).tolist() for u in units(vocabulary[k])}
    word_alike = np.fromiter((any(u in beginnings for u in units(w)) for w in vocabulary), bool, count=v)
    names, flat, bounds = _unit_codes([w if like else "" for w, like in zip(vocabulary, word_alike.tolist(), strict=True)])
    # chains with a labelled token, chains with words like it, and of the others every k-th, which then weighs k
    chain = np.repeat(np.arange(len(tokens.starts)), tokens.lengths)
    hit = np.zeros(len(tokens.starts), bool)
    hit[chain[label]] = True
    close = np.zeros(len(tokens.starts), bool)
    close[chain[word_alike[tokens.codes]]] = True
    del doc, chain
    kept, weights = [], []
    for group in (np.flatnonzero(hit), np.flatnonzero(close & ~hit), np.flatnonzero(~close & ~hit)):
        step = max(1, -(-len(group) // TRAIN_CHAINS))
        kept.append(group[::step])
        weights.append(np.full(len(group[::step]), float(step)))
    keep, chain_weight = np.concatenate(kept), np.concatenate(weights)
    lengths = tokens.lengths[keep]
    ends = np.cumsum(lengths)
    starts = ends - lengths
    take = np.repeat(tokens.starts[keep] - starts, lengths) + np.arange(ends[-1])
    weight = np.repeat(chain_weight, lengths)
    codes, label = tokens.codes[take], label[take].astype(float)
    is_start = np.zeros(len(codes), bool)
    is_start[starts] = True
    before, after = _neighbours(codes, is_start, v)
    unit, token = _spread(codes, flat, bounds)

    def emissions(w):
        return w[3][0] + np.bincount(token, weights=w[0][unit], minlength=len(codes)) + w[1][before] + w[2][after]

    held = np.array([PRIOR.get(len(u) - 1, 1.0) if u[0] == "^" else 1.0 for u in names])
    theta = [np.zeros(len(names)), np.zeros(v + 1), np.zeros(v + 1), np.array([-6.0]), np.zeros(1), np.zeros(4)]
    first, second = [np.zeros_like(x) for x in theta], [np.zeros_like(x) for x in theta]
    inner = np.flatnonzero(~is_start)  # second token of every pair
    pair_weight = weight[inner]
    seen = np.bincount((label[inner - 1] * 2 + label[inner]).astype(int), weights=pair_weight, minlength=4)
    for step in range(1, steps + 1):
        emission = emissions(theta)
        fwd, bwd = ratios(emission, starts, lengths, theta[4][0], theta[5])
        off = weight * (label - 1.0 / (1.0 + np.exp(-np.clip(fwd + bwd, -60, 60))))
        i, j = fwd[inner - 1], emission[inner] + bwd[inner]
        joint = np.stack([theta[5][0] + 0 * i, theta[5][1] + j, theta[5][2] + i, theta[5][3] + i + j])
        joint = np.exp(joint - joint.max(axis=0))
        joint *= pair_weight / joint.sum(axis=0)
        grads = [
            np.bincount(unit, weights=off[token], minlength=len(names)),
            np.bincount(before, weights=off, minlength=v + 1),
            np.bincount(after, weights=off, minlength=v + 1),
            np.array([off.sum()]),
            np.array([off[is_start].sum()]),
            seen - joint.sum(axis=1),
        ]
        for k, g in enumerate(grads):
            g = g - decay * theta[k] * (held if k == 0 else 1.0)
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.99 * second[k] + 0.01 * g * g
            theta[k] = theta[k] + rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-6)
    named = lambda w, keys: {x: float(y) for x, y in zip(keys, w, strict=False) if abs(y) > 0.02}
    vocab = tokens.vocabulary
    return Model(
        named(theta[0], names), named(theta[1], vocab), named(theta[2], vocab),
        float(theta[3][0]), float(theta[4][0]), tuple(float(x) for x in theta[5]),
    )


def fit_head(model: Model, texts: pa.Array, toxic: np.ndarray, weight: np.ndarray) -> tuple[float, float, float]:
    """Weights of the document score: logistic regression by Newton's steps with a weak prior."""
    tokens = Tokens(texts)
    some, signs = _signs(log_odds(model, tokens), tokens.bounds)
    y, w, theta = toxic[some].astype(float), weight[some], np.zeros(3)
    prior = np.diag([1e-6, 1e-2, 1e-2])
    for _ in range(50):
        p = 1.0 / (1.0 + np.exp(-np.clip(signs @ theta, -30, 30)))
        slope = signs.T @ (w * (y - p)) - prior @ theta
        step = np.linalg.solve((signs * (w * p * (1 - p))[:, None]).T @ signs + prior, slope)
        theta = theta + step * min(1.0, 5.0 / max(1e-9, float(np.abs(step).max())))
        if np.abs(step).max() < 1e-10:
            break
    return tuple(float(x) for x in theta)


def _fitted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The model of the one partition that holds the sample and the units that tell."""
    held = list(batches)
    if not held:
        return
    rows = pa.Table.from_batches(held)
    telling = set(rows.filter(pa.compute.equal(rows["kind"], 2))["text"].to_pylist())
    # one order, whatever order the rows came in
    parts = [rows.filter(pa.compute.equal(rows["kind"], k)).sort_by([("doc_id", "ascending")]) for k in (0, 1)]
    texts, toxic, weight = ([p[c].combine_chunks() for p in parts] for c in ("text", "toxic", "weight"))
    toxic = [t.to_numpy(zero_copy_only=False).astype(bool) for t in toxic]
    model = Model()
    if toxic[0].any() and not toxic[0].all():
        model = fit(texts[0], toxic[0], telling)
    if not model.empty:
        k = int(toxic[1].any() and not toxic[1].all())  # a table too small for a fold of its own uses the first once more
        model.head = fit_head(model, texts[k], toxic[k], weight[k].to_numpy(zero_copy_only=False))
    yield pa.RecordBatch.from_arrays([pa.array([json.dumps(asdict(model))])], names=["model"])


def held_out(doc_id: str = "doc_id") -> str:
    """SQL text: documents whose labels are never learned from."""
    return f"{_fold(doc_id)} = 0"


def _fold(doc_id: str) -> str:
    return f"crc32(CAST(coalesce(CAST({doc_id} AS string), '') AS binary)) % 5"


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Fit on labelled rows outside the held-out fold; the document score on one more fold of its own."""
    with_package(docs)
    marked = labels.where(f"doc_id IS NOT NULL AND toxic IN (0, 1) AND NOT {held_out()}").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    marked = stage(marked.withColumn("kind", F.expr(f"CAST({_fold('doc_id')} = 1 AS int)")))
    labelled = docs.where("doc_id IS NOT NULL").select("doc_id", "text").join(sized(marked), "doc_id")
    telling = telling_units(labelled.select("text", "toxic"))
    many = {(r["kind"], r["toxic"]): r["count"] for r in marked.groupBy("kind", "toxic").count().collect()}

    fitting = docs.where(f"doc_id IS NOT NULL AND char_length(text) <= {TRAIN_CHARS}").select("doc_id", "text")
    sample = None
    for kind, toxic, most in ((0, 0, TRAIN_CLEAN), (0, 1, TRAIN_TOXIC), (1, 0, HEAD_CLEAN), (1, 1, HEAD_TOXIC)):
        # twice the number, as some labelled documents may be absent or too long
        of_kind = marked.where((F.col("kind") == kind) & (F.col("toxic") == toxic))
        picked = of_kind.orderBy(F.xxhash64("doc_id"), "doc_id").limit(2 * most)
        rows = fitting.join(F.broadcast(picked), "doc_id").groupBy("doc_id", "toxic", "kind").agg(F.min("text").alias("text"))
        share = many.get((kind, toxic), 0) / max(1, min(most, many.get((kind, toxic), 0)))
        rows = rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most).withColumn("weight", F.lit(float(share)))
        sample = rows if sample is None else sample.unionByName(rows)
    sample = stage(sample)
    known = sample.select("text", "toxic").mapInArrow(_unit_names, "unit string").distinct()
    told = telling.join(known, "unit", "left_semi").selectExpr(
        "CAST(NULL AS bigint) AS doc_id", "0 AS toxic", "2 AS kind", "unit AS text", "0D AS weight"
    )
    one = sample.select("doc_id", F.col("toxic").cast("int").alias("toxic"), "kind", "text", "weight").unionByName(told).repartition(1)
    found = one.mapInArrow(_fitted, "model string").collect()
    return Model(**json.loads(found[0].model)) if found else Model()


def _unit_names(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for tokens, _ in _labelled(batches):
        yield pa.RecordBatch.from_arrays([pa.array(_unit_codes(tokens.vocabulary)[0], pa.string())], names=["unit"])


# ------------------------------------------------------------------ scoring


def _spans(text: str, p: np.ndarray) -> list[dict]:
    """Character ranges of neighbouring tokens tagged toxic."""
    out = []
    last = None
    for k, m in enumerate(LETTERS.finditer(text)):
        if p[k] >= 0.5:
            if last == k - 1 and out:
                out[-1]["end"] = m.end()
                out[-1]["p"] = max(out[-1]["p"], float(p[k]))
            else:
                out.append({"start": m.start(), "end": m.end(), "p": float(p[k])})
            last = k
    return out


def _score(batches: Iterable[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("p", pa.float64())]))
    model = model.value
    for batch in batches:
        for rows in text_slices(batch, limit=SCORE_BYTES):
            texts = rows.column("text")
            n = len(texts)
            score, spans = np.zeros(n), [[]] * n
            if not model.empty:
                tokens = Tokens(texts)
                odds = log_odds(model, tokens)
                score = document_scores(model, odds, tokens.bounds)
                p = 1.0 / (1.0 + np.exp(-odds))
                strong = np.flatnonzero(p >= 0.5)
                doc = np.searchsorted(tokens.bounds, strong, side="right") - 1
                for d in np.unique(doc).tolist():
                    spans[d] = _spans(texts[d].as_py() or "", p[tokens.bounds[d] : tokens.bounds[d + 1]])
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), pa.array(score), pa.array(spans, span)], names=["doc_id", "score", "spans"]
            )


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score, spans`` of every row."""
    with_package(docs)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    return docs.select("doc_id", "text").mapInArrow(
        lambda b: _score(b, sent), "doc_id bigint, score double, spans array<struct<start:int,end:int,p:double>>"
    )


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the documents scored one half or more; all columns stay.

    The filter runs where the text is: whole rows pass through the scorer once,
    nothing is joined back.
    """
    with_package(docs)
    sent = docs.sparkSession.sparkContext.broadcast(train(docs, labels))

    def run(batches):
        for batch in batches:
            for rows in text_slices(batch):
                scored = pa.Table.from_batches(list(_score([rows.select(["doc_id", "text"])], sent)))
                yield rows.filter(pa.array(scored["score"].to_numpy() < 0.5))

    return docs.mapInArrow(run, docs.schema)
