r"""Benchmark decontamination by winnowing, in DataFrame operations only.

Words are the runs of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]`` after lower-casing A-Z.
Of every ``WINDOW - GRAM + 1`` consecutive ``GRAM``-word hashes the smallest is
kept as fingerprint, with its place. Documents and items that share
``WINDOW`` words share the fingerprint of that stretch at the same offset, so
joining fingerprints finds the pair and its alignment (guaranteed, whatever the
hash). Each alignment is then extended word by word, exactly: a hash collision
costs time, never a wrong result. Items shorter than ``WINDOW`` words are looked
up by the hash of all their words.

Fingerprints of items are broadcast only when their counted number is under
``BROADCAST_ROWS``; beyond it both sides shuffle on the hash and AQE splits hot
hashes. Document texts are never collected: only the alignments of one document
meet in one row.

Defined cases: NULL or word-free texts have no words and are clean; items
without words are no items; a NULL item id is written as ``null``; items with
equal ids count once; repeated documents each get their own row; with an empty
benchmark every document is clean; an empty table gives no rows. Only the named
columns are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import NON_ALNUM_RUN, ascii_lower, sql_words, stage

WINDOW, GRAM = 10, 5
BROADCAST_ROWS = 500_000  # of 24 bytes
BROADCAST_KEYS = 200_000  # of 24 bytes
HASH = "xxhash64(coalesce(text, ''))"
ITEM_WORDS_BROADCAST = 1_000_000  # words of all items together


def _shifted(a: str, by: int, f: str) -> str:
    """SQL text: ``f`` applied to elements ``by`` apart; empty where there are too few."""
    left = f"greatest(size({a}) - {by}, 0)"
    return f"zip_with(slice({a}, 1, {left}), slice({a}, {by + 1}, {left}), (x, y) -> {f})"


def _grams(k: int, src: DataFrame, keep: list[str]) -> DataFrame:
    """Column ``g``: 32-bit hash of every ``k`` consecutive words of ``w`` (none in rows with fewer)."""
    df = src.selectExpr(*keep, "transform(w, x -> hash(x)) AS h").selectExpr(*keep, "h", "h AS g")
    width = 1
    while width < k:
        step = min(width, k - width)
        df = df.selectExpr(*keep, "h", f"{_shifted('g', step, 'hash(x, y)')} AS g")
        width += step
    return df.selectExpr(*keep, "g")


def _fingerprints(src: DataFrame, keep: list[str], k: int, span: int) -> DataFrame:
    """Rows of ``src`` with ``fps``: packed (hash, place) of each window's minimum, none under ``span`` words.

    Staged: a later explode would otherwise push a filter on ``fps`` below, which writes the
    whole chain of expressions out once more for each time it is used.
    """
    df = _grams(k, src, keep).selectExpr(*keep, "transform(g, (x, i) -> shiftleft(CAST(x AS bigint), 32) | i) AS m")
    width, need = 1, span - k + 1
    while width < need:
        step = min(width, need - width)
        df = df.selectExpr(*keep, f"{_shifted('m', step, 'least(x, y)')} AS m")
        width += step
    return stage(df.selectExpr(*keep, "array_distinct(m) AS fps"))


def _rows(src: DataFrame, keep: list[str], tag: int) -> DataFrame:
    return src.selectExpr(*keep, "explode(fps) AS f").selectExpr(
        *keep, f"{tag} AS span", "CAST(shiftright(f, 32) AS int) AS fp", "CAST(f & 4294967295L AS int) AS at"
    )


def find_overlaps(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Per document row: ``doc_id, __h, n_words, n_hit, item_ids`` (sorted strings).

    ``__h`` is the text's 64-bit hash and tells apart rows that share an id.
    """
    spark = docs.sparkSession
    words = sql_words(ascii_lower("coalesce(text, '')"), NON_ALNUM_RUN)
    key = ["doc_id", "__h"]

    bench = (
        items.selectExpr("coalesce(CAST(item_id AS string), 'null') AS item_id", f"{words} AS v")
        .where("size(v) > 0")
        .withColumn("item", F.xxhash64("item_id", "v"))
    )
    bench = stage(bench.dropDuplicates(["item_id", "v"]))
    lengths = bench.groupBy(F.least(F.size("v"), F.lit(WINDOW)).alias("n")).agg(F.sum(F.size("v")).alias("words")).collect()
    spans = sorted(r["n"] for r in lengths)
    item_words = sum(r["words"] for r in lengths)

    base = docs.selectExpr("doc_id", f"{HASH} AS __h", f"{words} AS w")
    counted = base.selectExpr(*key, "w", "CAST(size(w) AS bigint) AS n_words")
    if not spans:
        return counted.selectExpr(*key, "n_words", "0L AS n_hit", "CAST(array() AS array<string>) AS item_ids")

    # fingerprints of all documents, one scan for all spans; kept with the word counts
    seen = _fingerprints(counted, [*key, "n_words"], GRAM, WINDOW)
    doc_rows, item_rows = [], []
    for span in spans:
        if span == WINDOW:
            part = bench.where(F.size("v") >= WINDOW).selectExpr("item", "v AS w")
            item_rows.append(_rows(_fingerprints(part, ["item"], GRAM, WINDOW), ["item"], span))
            doc_rows.append(_rows(seen, key, span))
        else:
            part = bench.where(F.size("v") == span).selectExpr("item", "v AS w")
            item_rows.append(_rows(_fingerprints(part, ["item"], span, span), ["item"], span))
            doc_rows.append(_rows(_fingerprints(counted, key, span, span), key, span))
    prints = stage(_union(item_rows).withColumnRenamed("at", "item_at"))
    n_prints = prints.count()
    right = F.broadcast(prints) if n_prints <= BROADCAST_ROWS else prints
    aligned = (
        _union(doc_rows)
        .join(right, ["span", "fp"])
        .selectExpr(*key, "item", "at - item_at AS diag")
        .distinct()
    )
    # alignments of one document with the words of their items
    side = bench.select("item", "item_id", "v")
    side = F.broadcast(side) if item_words <= ITEM_WORDS_BROADCAST else side
    per_doc = stage(
        aligned.join(side, "item").groupBy(*key).agg(F.collect_list(F.struct("item_id", "v", "diag")).alias("hits"))
    )

    n_docs = per_doc.count()
    found = F.broadcast(per_doc.select(*key)) if n_docs <= BROADCAST_KEYS else per_doc.select(*key)
    texts = docs.selectExpr("doc_id", "text", f"{HASH} AS __h")
    texts = _same_key(texts, found, "left_semi").selectExpr(*key, f"{words} AS w")
    checked = (
        _same_key(texts, per_doc, "inner")
        .selectExpr(*key, f"{_aligned_flags()} AS e")
        .selectExpr(*key, f"{_window_starts()} AS e")
    )
    result = checked.selectExpr(
        *key,
        "array_sort(array_distinct(transform(filter(e, x -> size(x.starts) > 0), x -> x.item_id))) AS item_ids",
        f"{_covered()} AS n_hit",
    ).dropDuplicates(key)
    return _same_key(seen.select(*key, "n_words"), result, "left").selectExpr(
        *key, "n_words", "coalesce(n_hit, 0L) AS n_hit", "coalesce(item_ids, CAST(array() AS array<string>)) AS item_ids"
    )


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def _same_key(a: DataFrame, b: DataFrame, how: str) -> DataFrame:
    """Join on ``doc_id`` (NULL equals NULL) and ``__h``; the right side's key columns are dropped."""
    right = b.withColumnsRenamed({"doc_id": "__r_id", "__h": "__r_h"})
    on = a["doc_id"].eqNullSafe(right["__r_id"]) & (a["__h"] == right["__r_h"])
    out = a.join(right, on, how)
    return out if how == "left_semi" else out.drop("__r_id", "__r_h")


def _aligned_flags() -> str:
    """SQL text: per alignment, which item words equal the document word they lie on."""
    same = "transform(x.v, (word, j) -> coalesce(get(w, x.diag + j) = word, false))"
    return f"transform(hits, x -> named_struct('item_id', x.item_id, 'diag', x.diag, 'n', least(size(x.v), {WINDOW}), 'same', {same}))"


def _window_starts() -> str:
    """SQL text: per alignment, the document places where a window of ``n`` words agrees throughout."""
    starts = (
        "filter(transform(slice(x.same, 1, size(x.same) - x.n + 1), (s, j) -> "
        "CASE WHEN s AND forall(slice(x.same, j + 1, x.n), z -> z) THEN x.diag + j END), z -> z IS NOT NULL)"
    )
    return f"transform(e, x -> named_struct('item_id', x.item_id, 'n', x.n, 'starts', {starts}))"


def _covered() -> str:
    """SQL text: number of words inside any of the found windows."""
    spans = "array_sort(array_distinct(flatten(transform(e, x -> transform(x.starts, s -> shiftleft(CAST(s AS bigint), 8) | x.n)))))"
    return (
        f"reduce({spans}, named_struct('c', 0L, 'to', 0L), (a, s) -> named_struct("
        "'c', a.c + greatest(0L, shiftright(s, 8) + (s & 255L) - greatest(shiftright(s, 8), a.to)), "
        "'to', greatest(a.to, shiftright(s, 8) + (s & 255L))), a -> a.c)"
    )


def contamination(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Digest per document row: hits, item list hash and verdict."""
    return find_overlaps(docs, items).selectExpr(
        "doc_id",
        "n_words",
        "n_hit",
        "CAST(size(item_ids) AS bigint) AS n_items",
        "sha2(CAST(array_join(item_ids, ',') AS binary), 256) AS items_sha256",
        "n_hit > 0 AS contaminated",
    )


def drop_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` without the rows that share a window with an item; all columns and clean rows stay."""
    dirty = find_overlaps(docs, items).where("n_hit > 0").select("doc_id", "__h")
    marked = docs.withColumn("__h", F.expr(HASH))
    right = dirty.distinct().withColumnsRenamed({"doc_id": "__r_id", "__h": "__r_h"})
    on = marked["doc_id"].eqNullSafe(right["__r_id"]) & (marked["__h"] == right["__r_h"])
    return marked.join(right, on, "left_anti").drop("__h")
