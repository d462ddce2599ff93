"""The pipeline's stages against what each may do, and its end against the library."""

import hashlib
import random
import re
from itertools import combinations

import numpy as np
import pytest

pytest.importorskip("mapweave.llm")

import corpus_pipeline
from llm_data import ROWS, benchmark, documents, labels
from mapweave.llm import bpe, jaccard
from mapweave.llm.queries import vocabulary

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_kept(rows, shingle=5, least=80):
    """Rows that the Jaccard stage keeps, from all pairs: the smallest id of each group, all without words or id."""
    docs = list(dict.fromkeys(rows))
    words = [re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER)) for _, t in docs]
    sets = [{tuple(w[k : k + shingle]) for k in range(max(1, len(w) - shingle + 1))} if w else set() for w in words]
    first = list(range(len(docs)))
    order = sorted(range(len(docs)), key=lambda k: (docs[k][0] is None, docs[k][0] or 0, k))
    place = {k: n for n, k in enumerate(order)}
    for a, b in combinations(range(len(docs)), 2):
        if docs[a][0] is not None and docs[b][0] is not None and sets[a] and 100 * len(sets[a] & sets[b]) >= least * len(sets[a] | sets[b]):
            x, y = sorted((first[a], first[b]), key=place.get)
            first = [x if f == y else f for f in first]
    kept = [docs[k] for k in range(len(docs)) if first[k] == k]
    # repeated rows without words or id stay as often as they come
    again = [r for r in rows if r[0] is None or not re.search(r"[^\x20\x09-\x0D]", r[1] or "")]
    return sorted([r for r in kept if r not in again] + again, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))


def test_stages_keep_columns_and_clean_rows(spark, tmp_path):
    sf = str(tmp_path)
    documents(spark).select("doc_id", "text", "lang").write.parquet(f"{sf}/documents.parquet")
    benchmark(spark, [(70, dict(ROWS)[7])]).write.parquet(f"{sf}/benchmark.parquet")
    labels(spark, []).write.parquet(f"{sf}/labels.parquet")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf)
        out.write.parquet(f"{sf}/{name}")
        out = spark.read.parquet(f"{sf}/{name}")
        kept[name] = sorted((r.doc_id for r in out.collect()), key=lambda i: (i is not None, i or 0))
        if name != "bpe":
            assert out.columns == docs.columns
            docs = out
    last = docs.collect()
    assert len(kept["toxicity"]) == len(ROWS)
    assert kept["ngram_jaccard"] == [i for i, _ in brute_kept(ROWS)]
    assert 3 not in kept["ngram_jaccard"] and {1, 7, 8, 15} <= set(kept["ngram_jaccard"])
    assert kept["decontamination"] == [i for i in kept["ngram_jaccard"] if i not in (7, 8)]
    assert kept["secret_scan"] == kept["decontamination"] == kept["bpe"]
    tok = bpe.tokenizer(vocabulary())
    got = {r.doc_id: r.ids_sha256 for r in corpus_pipeline.run(spark, sf).where("doc_id IS NOT NULL").collect()}
    for r in last:
        ids = tok.encode(r.text or "", add_special_tokens=False).ids
        if r.doc_id is not None:
            assert got[r.doc_id] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
    assert next(r.text for r in last if r.doc_id == 12) == 'the token = "[SECRET]" stays secret'


def test_near_copies_of_five_word_shingles_at_080_go(spark):
    rng = random.Random(4)
    rows = {}
    for family in range(12):
        base = [f"f{family}w{k}" for k in range(rng.choice([4, 6, 9, 14, 24, 30, 50, 120]))]
        for _ in range(6):
            w = list(base)
            for _ in range(rng.choice([0, 1, 1, 2])):
                w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
            rows[len(rows)] = " ".join(w[: len(w) - rng.choice([0, 1])])
    words = {i: t.split() for i, t in rows.items()}
    sets = {i: {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} for i, w in words.items()}
    first = {i: i for i in rows}
    for i, j in combinations(rows, 2):  # all pairs, smallest ids handed on
        if 10 * len(sets[i] & sets[j]) >= 8 * len(sets[i] | sets[j]):
            a, b = sorted((first[i], first[j]))
            first = {k: a if v == b else v for k, v in first.items()}
    stage = dict(corpus_pipeline.STAGES)["ngram_jaccard"]
    kept = sorted(r.doc_id for r in stage(spark, documents(spark, list(rows.items())), "").collect())
    assert kept == sorted(set(first.values()))
    assert len(kept) < jaccard.keep_one(documents(spark, list(rows.items()))).count()


def test_texts_that_share_an_id_stay_unless_they_link(spark):
    long = " ".join(f"w{k}" for k in range(60))
    rows = [
        (5, long), (5, "another text of the same id that is like no other"), (5, long + " tail"), (5, ""), (5, None),
        (7, "another text of the same id that is like no other"), (8, long.upper()), (9, "alone"), (9, "alone"), (None, long), (6, "short text"),
    ]
    stage = dict(corpus_pipeline.STAGES)["ngram_jaccard"]
    out = stage(spark, documents(spark, rows), "")
    assert out.columns == documents(spark, []).columns
    got = sorted(((r.doc_id, r.text) for r in out.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    # of each group one row; ids of one text each come first
    assert [r for r in got if r[0] is None or not r[1]] == [(None, long), (5, None), (5, "")] or [r for r in got if r[0] is None or not r[1]] == [(None, long), (5, ""), (5, None)]
    assert [r for r in got if r[0] is not None and r[1]] == [
        (6, "short text"), (7, "another text of the same id that is like no other"), (8, long.upper()), (9, "alone"),
    ]
    apart = [(5, long), (5, "another text of the same id that is like no other"), (6, "short text")]
    assert sorted(r.text for r in stage(spark, documents(spark, apart), "").collect()) == sorted(t for _, t in apart)


def test_pipeline_of_empty_tables(spark, tmp_path):
    sf = str(tmp_path)
    documents(spark, []).select("doc_id", "text", "lang").write.parquet(f"{sf}/documents.parquet")
    benchmark(spark, []).write.parquet(f"{sf}/benchmark.parquet")
    labels(spark, []).write.parquet(f"{sf}/labels.parquet")
    assert corpus_pipeline.run(spark, sf).count() == 0
