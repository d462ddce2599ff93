"""Secret scans: broad candidates, then a random forest that removes false positives.

Candidates are runs of 12 or more key characters that hold a digit or stand
after an assignment, and whole values of 8 or more characters of any kind, quoted
or up to the next space, after an assignment or a secret word (:func:`announced`). A
candidate's features are its length, the share of character-class transitions,
dictionary coverage, digit, upper-case, sign and space share, distinct characters,
whether it is part of a path, and the kind of the words around it.

The forest is trained from labelled findings: a table ``value, before, after,
label`` handed in by the caller, or :func:`labelled_findings`, which draws a bounded
number (``FINDINGS``) by rule and adds prose words of the documents themselves
(``MINED``, picked by hash) as false positives. Trees are bootstrapped, split by
Gini impurity over random feature subsets, and stored as flat arrays, so a task
scores all candidates of a slice at once.

Defined cases: NULL and empty texts have no findings; candidates may overlap, findings that
do are one; repeated rows get equal results; an empty table gives no rows. Every column
of the input is kept by :func:`redact`; only ``text`` is read.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_slices, with_package

FINDINGS, MINED = 6000, 2000  # bounds of the labelled findings
TREES, DEPTH, LEAST_LEAF, SEED = 24, 8, 5, 7
MASK = "[SECRET]"
AROUND = 48  # characters looked at on each side

CANDIDATE = re.compile(r"[A-Za-z0-9_+/=\-]{12,}")
ASSIGNED = re.compile(r"[A-Za-z]\"?\s*[:=]\s*[\"']?$")
WORD = re.compile(r"[^\W\d_]+")

# fixed values: words that announce a secret, words that announce a harmless digest or name
SECRET_WORDS = frozenset("token secret password passwd pwd key apikey api auth bearer credential credentials private access session".split())
PLAIN_WORDS = frozenset("commit sha md checksum digest hash revision version uuid guid id href src url path file isbn doi build".split())
# fixed values: frequent letter groups of the languages of the corpus, the dictionary of the coverage feature
DICTIONARY = tuple(
    "tion ment heit keit lich ción ando ient ough ight ther here that with from have ding ring sion able ible ance ence "
    "the and ing ent ion her for hat his ere you are not ver ter all ith der die und ein ich sch den ung gen cht "
    "que les des est ait eur con ado los las por para una com pro pre res ous eau oir ais tre".split()
)
# what announces a value, and the value: quoted on one line, or the first 8 characters up to the next space.
# Python (ASCII) and Java read both alike
ANNOUNCE = (
    r"(?:[A-Za-z0-9_][\"']?\s*[:=]{1,2}>?\s*|(?<![A-Za-z])(?i:" + "|".join(sorted(SECRET_WORDS, key=lambda w: (-len(w), w)))
    + r")[\"']?(?=[\s\"'])(?:\s+(?i:is|was|ist|es|est)(?=\s))?\s*(?![:=]))"
)
VALUE = r"""(?:"([^"\n]{8,})"|'([^'\n]{8,})'|(?:"(?![^"\n]*")|'(?![^'\n]*'))?([^\s"']\S{7}))"""
ANNOUNCED = re.compile(f"{ANNOUNCE}(?={VALUE})", re.ASCII)
# inside a value up to the next space: the next name of a list of assignments
SPACE = re.compile(r"\s|\Z", re.ASCII)
NEXT_NAME = re.compile(r"[&;,?|](?=[\"'{\[(]*[A-Za-z_][\w.\-]*[\"']?[:=])", re.ASCII)
NAMED = re.compile(r"[A-Za-z0-9_][\w.\-]*\Z", re.ASCII)
# a text without any of these has no candidate (read by Spark)
PREFILTER = rf"[A-Za-z0-9_+/=\-]{{12,}}|{ANNOUNCE}{VALUE}"
NAMES = ("length", "transitions", "coverage", "digits", "uppers", "distinct", "path", "secret_word", "plain_word", "assigned", "hexadecimal", "signs", "spaces", "named", "marks")


def is_candidate(value: str, before: str) -> bool:
    return any(c.isdigit() for c in value) or ASSIGNED.search(before) is not None


def _kind(c: str) -> int:
    return 0 if c.isdigit() else 1 if c.islower() else 2 if c.isupper() else 3


def features(value: str, before: str, after: str) -> list[float]:
    """Feature values of one candidate in the order of ``NAMES``."""
    n = len(value)
    kinds = [_kind(c) for c in value]
    low = value.lower()
    covered = np.zeros(n, bool)
    for part in DICTIONARY:
        at = low.find(part)
        while at >= 0:
            covered[at : at + len(part)] = True
            at = low.find(part, at + 1)
    last = (WORD.findall(before)[-1:] or [""])[0].lower()
    around = {w.lower() for w in WORD.findall(before)[-4:]} | {w.lower() for w in WORD.findall(after)[:2]}
    return [
        float(n),
        sum(a != b for a, b in zip(kinds, kinds[1:], strict=False)) / max(1, n - 1),
        float(covered.mean()),
        kinds.count(0) / n,
        kinds.count(2) / n,
        len(set(value)) / n,
        float("/" in value.strip("/") or before.endswith(("/", ".", "@")) or after.startswith(("/", ".", "@")) and after[1:2].isalnum()),
        float(bool(around & SECRET_WORDS)),
        float(bool(around & PLAIN_WORDS)),
        float(ASSIGNED.search(before) is not None),
        float(all(c in "0123456789abcdefABCDEF" for c in value)),
        sum(not c.isalnum() and not c.isspace() for c in value) / n,
        sum(c.isspace() for c in value) / n,
        float((last in SECRET_WORDS) - (last in PLAIN_WORDS)),
        sum(not c.isalnum() and c not in " _-./:=+,(){}[]<>\"'" for c in value.rstrip("!?#$%&*.,;:")) / n,  # signs that names do not have, inside
    ]


def _trimmed(text: str, a: int, b: int) -> int:
    """End of ``text[a:b]`` without the marks of the sentence or list it stands in."""
    while b > a and (text[b - 1] in ",;.\"'" or text[b - 1] in ")]}>" and "([{<"[")]}>".index(text[b - 1])] not in text[a:b]):
        b -= 1
    return b


def announced(text: str) -> Iterator[tuple[int, int]]:
    """Whole values after an assignment or a secret word.

    Of a run without spaces that holds several assignments, the first one has the whole
    run; besides, each part up to the next name is a value, so a secret in a list or
    an address is looked at alone, too. All parts of a run together are no longer than the run.
    """
    run, parts = (0, 0), []

    def cut():
        ends = [a - (text[a - 1] in "&;,?|") for a, _ in parts[1:]] + [run[1]] * bool(parts)
        for (a, start), end in zip(parts, ends, strict=True):
            name = NEXT_NAME.search(text, start, end)
            yield start, _trimmed(text, start, name.start() if name else end)

    for m in ANNOUNCED.finditer(text):
        if m.group(3) is None:
            yield m.span(1) if m.group(1) is not None else m.span(2)
            continue
        a = m.start(3)
        if text.startswith("//", a) and text[m.start() + 1 : a] == ":":
            continue  # the scheme of an address
        if a >= run[1]:
            yield from cut()
            run, parts = (a, SPACE.search(text, a).start()), [(m.start(), a)]
            yield a, _trimmed(text, *run)
        else:
            name = NAMED.search(text, max(0, m.start() - AROUND), m.start() + 1)
            word = (WORD.findall(text[max(0, m.start() - AROUND) : a])[-1:] or [""])[0].lower()
            if name and (word in SECRET_WORDS or text[name.start() - 1 : name.start()] in tuple("&;,?|")):
                parts.append((name.start(), a))
    yield from cut()


def candidates(text: str) -> Iterator[tuple[int, int, list[float]]]:
    spans = {(a, b) for a, b in announced(text) if b - a >= 8} | set(runs(text))
    for a, b in sorted(spans):
        yield a, b, features(text[a:b], text[max(0, a - AROUND) : a], text[b : b + AROUND])


def runs(text: str) -> Iterator[tuple[int, int]]:
    """Runs of key characters that hold a digit or stand after an assignment."""
    for m in CANDIDATE.finditer(text):
        a, b = m.span()
        value = m.group()
        # an assignment sign glued to the name belongs to the context: name=value
        cut = max(value.find("=", 0, len(value) - 8), -1)
        if cut >= 0 and value[:cut].replace("_", "").replace("-", "").isalpha():
            a += cut + 1
        while b > a and text[b - 1] in "=-/" and text[b - 1] != "=":
            b -= 1
        value = text[a:b].strip("-/")
        a = text.index(value, a) if value else a
        b = a + len(value)
        before = text[max(0, a - AROUND) : a]
        if len(value) >= 8 and is_candidate(value, before):
            yield a, b


# ------------------------------------------------------------------ random forest


class Forest:
    """Trees as flat arrays: feature (-1: leaf), threshold, left, right, share of true findings."""

    def __init__(self, trees: list[tuple[np.ndarray, ...]]):
        self.trees = trees

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray) -> Forest:
        rng = np.random.default_rng(SEED)
        tries = max(2, int(np.sqrt(x.shape[1])) + 1)
        return cls([_grow(x, y, rng.integers(0, len(y), len(y)), rng, tries) for _ in range(TREES)])

    def chance(self, x: np.ndarray) -> np.ndarray:
        total = np.zeros(len(x))
        for feature, threshold, left, right, share in self.trees:
            at = np.zeros(len(x), np.int64)
            for _ in range(DEPTH + 1):
                f = feature[at]
                go = f >= 0
                if not go.any():
                    break
                lower = x[np.arange(len(x)), np.maximum(f, 0)] <= threshold[at]
                at = np.where(go, np.where(lower, left[at], right[at]), at)
            total += share[at]
        return total / len(self.trees)


def _grow(x, y, rows, rng, tries) -> tuple[np.ndarray, ...]:
    nodes: list[list[float]] = []

    def add(rows, depth) -> int:
        me = len(nodes)
        p = float(y[rows].mean())
        nodes.append([-1, 0.0, me, me, p])
        if depth == DEPTH or len(rows) < 2 * LEAST_LEAF or p in (0.0, 1.0):
            return me
        best = (2 * p * (1 - p), -1, 0.0)
        for tried, f in enumerate(rng.permutation(x.shape[1])):
            if tried >= tries and best[1] >= 0:  # further features only while none splits
                break
            order = np.argsort(x[rows, f], kind="stable")
            v, t = x[rows, f][order], y[rows][order]
            ones = np.cumsum(t)
            k = np.arange(1, len(v))
            ok = (v[1:] != v[:-1]) & (k >= LEAST_LEAF) & (len(v) - k >= LEAST_LEAF)
            if not ok.any():
                continue
            a, b = ones[:-1] / k, (ones[-1] - ones[:-1]) / (len(v) - k)
            impurity = np.where(ok, (k * 2 * a * (1 - a) + (len(v) - k) * 2 * b * (1 - b)) / len(v), np.inf)
            at = int(np.argmin(impurity))
            if impurity[at] < best[0] - 1e-12:
                best = (float(impurity[at]), int(f), float((v[at] + v[at + 1]) / 2))
        if best[1] >= 0:
            low = x[rows, best[1]] <= best[2]
            nodes[me][:2] = [best[1], best[2]]
            nodes[me][2] = add(rows[low], depth + 1)
            nodes[me][3] = add(rows[~low], depth + 1)
        return me

    add(rows, 0)
    table = np.array(nodes)
    return table[:, 0].astype(int), table[:, 1], table[:, 2].astype(int), table[:, 3].astype(int), table[:, 4]


# ------------------------------------------------------------------ labelled findings


def _drawn(n: int) -> list[tuple[str, str, str, int]]:
    """``n`` findings by rule, half of them secrets; the same for the same ``n``."""
    rng = np.random.default_rng(SEED)
    hexa, alnum = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    pick = lambda letters, k: "".join(letters[i] for i in rng.integers(0, len(letters), k))
    one = lambda xs: xs[int(rng.integers(0, len(xs)))]
    secret, plain, parts = sorted(SECRET_WORDS), sorted(PLAIN_WORDS), DICTIONARY
    prose = lambda k: " ".join("".join(one(parts) for _ in range(int(rng.integers(1, 4)))) for _ in range(k))
    wordy = lambda k: "".join(one(parts) for _ in range(k))
    quote = lambda: one(['"', "'", ""])
    # words that the dictionary covers, and words that it hardly does
    word = lambda k: one([wordy(k), "".join(one("bcdfghklmnprstvwz") + one("aeiou") + one(["", "", "n", "s", "l"]) for _ in range(k))])
    signs = "@!#$%.~&*^?"
    mixed = lambda k: (lambda of: pick(of, 2) + pick(of + signs * 2, k - 4) + one(signs) + pick(of, 1))(one([alnum, alnum[26:]]))
    spoken = lambda: one([word(3).title(), word(3), word(2).title()]).replace("a", one("a@")).replace("o", one("o0"))
    unannounced = lambda: one(
        ["AKIA" + pick(alnum[:26] + hexa[:10], 16), one(["ghp_", "sk-", "sk_live_", "xoxb-", "glpat-"]) + pick(alnum, int(rng.integers(20, 40))), pick(alnum, int(rng.integers(24, 48)))]
    )
    low_name = lambda: one(["_", "-", "."]).join(word(int(rng.integers(1, 3))) for _ in range(int(rng.integers(2, 4))))
    out = []
    for k in range(n):
        shape = int(rng.integers(0, 13))
        if k % 2 == 0:
            value = [
                lambda: pick(hexa, int(one([16, 18, 24, 32, 40, 64]))),
                lambda: pick(alnum, int(rng.integers(16, 48))),
                lambda: pick(alnum + "+/", int(rng.integers(20, 60))) + one(["", "=", "=="]),
                lambda: one(["sk", "ghp", "AKIA", "pk"]) + one(["_", "-", ""]) + pick(alnum, int(rng.integers(16, 36))),
                lambda: pick(hexa, 40),
                lambda: pick(alnum, 12) + pick("0123456789", 3),
                lambda: mixed(int(rng.integers(8, 24))),
                lambda: spoken() + one(signs) + pick("0123456789", int(rng.integers(2, 6))) + one(["", "!", one(alnum[26:52])]),
                lambda: pick(hexa[10:] + hexa[:10], 6) + pick("0123456789", int(rng.integers(2, 6))),
                lambda: " ".join(mixed(int(rng.integers(4, 8))) for _ in range(2)),
                *[unannounced] * 3,
            ][shape]()
            q = '"' if " " in value else quote()
            before = f"{prose(2)} {one(secret)}{one([' = ', '=', ': ', ':', ' ', ' is '])}{q}"
            if shape >= 10:  # keys that no word announces
                q, before = "", f"{prose(3)}{one([' ', ' ', ': ', ' = '])}"
            out.append((value, before, f"{q} {prose(2)}", 1))
        else:
            value, before, after = [
                lambda: (pick(hexa, int(one([32, 40, 64]))), f"{prose(2)} {one(plain)} ", f" {prose(2)}"),
                lambda: (wordy(int(rng.integers(4, 8))) + pick("0123456789", int(rng.integers(1, 4))), f"{prose(3)} ", f" {prose(2)}"),
                lambda: (f"{wordy(2)}/{wordy(2)}/{wordy(1)}{pick('0123456789', 2)}", f"{prose(2)} {one(['http://', '/', ''])}", f".{wordy(1)}"),
                lambda: (pick("0123456789", int(rng.integers(12, 20))), f"{prose(2)} ", f" {prose(2)}"),
                lambda: (f"{wordy(3)}_{wordy(2)}-{pick('0123456789', 4)}", f"{prose(1)} {one(plain)}{one([' = ', ': '])}", f" {prose(2)}"),
                lambda: (wordy(int(rng.integers(4, 9))), f"{prose(2)} {wordy(1)}{one([': ', ' = '])}", f" {prose(2)}"),
                lambda: (one([str, str.title, str.upper])(word(int(rng.integers(3, 7)))) + one(["", "", "!!", "###", "?", "!"]), f"{prose(2)} {one([wordy(1), one(secret)])}{one([': ', ' = ', ' '])}", f" {prose(2)}"),
                lambda: (" ".join(word(2) for _ in range(int(rng.integers(2, 9)))) + one(["", ".", "!"]), f"{prose(2)} {one([wordy(1), one(secret)])}{one([': ', ' = ', '='])}\"", f"\" {prose(2)}"),
                lambda: (
                    one([f"20{pick('012', 2)}-0{pick('123456789', 1)}-1{pick(hexa[:10], 1)}", f"{wordy(2)}.{wordy(1)}@{wordy(2)}.com", f"1.{pick(hexa[:10], 1)}.{pick(hexa[:10], 2)}-{wordy(1)}"]),
                    f"{prose(2)} {wordy(1)}{one([': ', ' = ', '=', ':'])}", f" {prose(2)}",
                ),
                lambda: (f"{wordy(2)}.{wordy(1)}/{wordy(2)}?{wordy(1)}={pick('0123456789', 3)}", f"{prose(2)} {one([wordy(1), one(plain)])}{one([': ', '='])}", f" {prose(2)}"),
                # harmless values after a word that announces a secret
                lambda: (low_name() + one(["_", "-", ""]) + pick("0123456789", int(rng.integers(1, 5))), f"{prose(2)} {one(secret)}{one([' = ', '=', ': ', ' '])}", f" {prose(2)}"),
                lambda: (pick("0123456789", int(rng.integers(8, 20))), f"{prose(2)} {one(['session', 'access', 'auth', 'token'])} {one(['id', 'version', 'build', 'revision'])}{one([' = ', ': ', ' '])}", f" {prose(2)}"),
                lambda: (
                    one([pick(hexa, int(one([32, 40, 64]))), "-".join(pick(hexa, j) for j in (8, 4, 4, 4, 12))]),
                    f"{prose(2)} {one(secret)}{one([' ', ' = ', ': '])}{one(plain)}{one([' ', ': ', ':', ' = '])}", f" {prose(2)}",
                ),
            ][shape]()
            out.append((value, before, after, 0))
    return out


def labelled_findings(docs: DataFrame, findings: int = FINDINGS, mined: int = MINED) -> list[tuple[str, str, str, int]]:
    """Findings drawn by rule, and long prose words of the documents as false positives."""
    words = (
        docs.where("text IS NOT NULL")
        .select(F.expr("nullif(regexp_extract(text, '(?<![^ ])[A-Za-z]{12,}(?![^ ])', 0), '')").alias("w"), F.xxhash64("text").alias("h"))
        .where("w IS NOT NULL")
        .groupBy("w")
        .agg(F.min("h").alias("h"))
        .orderBy("h", "w")
        .limit(mined)
        .collect()
    )
    out = _drawn(findings)
    for k, r in enumerate(words):
        out.append((r["w"] + str(k % 100), "and the ", " of", 0))
    return out


def train(docs: DataFrame, labelled: DataFrame | None = None) -> Forest:
    """Forest from ``labelled`` (value, before, after, label; at most ``FINDINGS + MINED`` rows are used) or from the default findings."""
    if labelled is None:
        rows = labelled_findings(docs)
    else:
        picked = labelled.where("value IS NOT NULL AND value <> '' AND label IN (0, 1)").select(
            "value", F.coalesce("before", F.lit("")), F.coalesce("after", F.lit("")), F.col("label").cast("int")
        )
        rows = [tuple(r) for r in picked.orderBy(F.xxhash64("value"), *picked.columns).limit(FINDINGS + MINED).collect()]
    x = np.array([features(v, b, a) for v, b, a, _ in rows]).reshape(len(rows), len(NAMES))
    y = np.array([label for *_, label in rows], float)
    return Forest.fit(x, y) if len(rows) else Forest([])


# ------------------------------------------------------------------ scanning


def find(texts: list[str | None], forest: Forest) -> tuple[list[list[tuple[int, int, float]]], list[int]]:
    """Findings (start, end, chance) and the number of candidates of every text."""
    where, rows, counts = [], [], []
    for k, text in enumerate(texts):
        found = list(candidates(text)) if text else []
        counts.append(len(found))
        for a, b, f in found:
            where.append((k, a, b))
            rows.append(f)
    out: list[list[tuple[int, int, float]]] = [[] for _ in texts]
    if rows and forest.trees:
        for (k, a, b), p in zip(where, forest.chance(np.array(rows)).tolist(), strict=True):
            if p >= 0.5:
                if out[k] and a < out[k][-1][1]:
                    first, end, q = out[k].pop()
                    a, b, p = first, max(end, b), max(q, p)
                out[k].append((a, b, p))
    return out, counts


def masked(text: str, found: list[tuple[int, int, float]]) -> str:
    out, last = [], 0
    for a, b, _ in found:
        out += [text[last:a], MASK]
        last = b
    return "".join([*out, text[last:]])


def scan(docs: DataFrame, forest: Forest) -> DataFrame:
    """``doc_id, n_candidates, findings, redacted`` of every row; ``redacted`` is NULL where nothing was found."""
    with_package(docs)
    sent = docs.sparkSession.sparkContext.broadcast(forest)
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("p", pa.float64())]))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in text_slices(batch):
                texts = rows.column("text").to_pylist()
                found, counts = find(texts, sent.value)
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column("doc_id"),
                        pa.array(counts, pa.int64()),
                        pa.array([[{"start": a, "end": b, "p": p} for a, b, p in f] for f in found], kind),
                        pa.array([masked(t, f) if f else None for t, f in zip(texts, found, strict=True)], pa.string()),
                    ],
                    names=["doc_id", "n_candidates", "findings", "redacted"],
                )

    ready = docs.select("doc_id", F.when(F.col("text").rlike(PREFILTER), F.col("text")).alias("text"))
    return ready.mapInArrow(
        run, "doc_id bigint, n_candidates bigint, findings array<struct<start:int,end:int,p:double>>, redacted string"
    )


def redact(docs: DataFrame, forest: Forest) -> DataFrame:
    """``docs`` with every finding replaced by ``MASK``; no row is lost."""
    with_package(docs)
    sent = docs.sparkSession.sparkContext.broadcast(forest)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in text_slices(batch):
                texts = rows.column("text").to_pylist()
                found, _ = find(texts, sent.value)
                fixed = [masked(t, f) if f else t for t, f in zip(texts, found, strict=True)]
                yield rows.set_column(rows.schema.get_field_index("text"), rows.schema.field("text"), pa.array(fixed, rows.schema.field("text").type))

    return docs.mapInArrow(run, docs.schema)
