"""Whitening, SimHash near-dedup and collocations against brute force."""

import random
import re
from collections import Counter
from itertools import combinations

import numpy as np
import pytest

pytest.importorskip("mapweave.llm")

import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_data import LONG, documents, sorted_rows

from mapweave.llm import collocations, queries, simhash, whitening

# ------------------------------------------------------------------ whitening


def vectors(spark, rows):
    cols = "vec_id bigint, embedding array<float>, label int, n bigint, component string, vector string, whitened int"
    return spark.createDataFrame([(i, v, 3, 9, "c", "v", 1) for i, v in rows], cols)


def some_vectors(n=300, dim=9, seed=5):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, dim)) @ rng.standard_normal((dim, dim)) * 0.3 + 5
    return [[float(np.float32(c)) for c in v] for v in x]


def brute_whitening(rows, components):
    kept = [(i, v) for i, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    x = [[int(np.floor(64 * c)) + 1_000_000 for c in v] for _, v in kept]
    n, total = len(x), [sum(c) for c in zip(*x, strict=True)]
    centred = np.array([[(n * c - s) / n for c, s in zip(v, total, strict=True)] for v in x])
    cov = centred.T @ centred / n
    values, vecs = np.linalg.eigh(cov)
    values, vecs = values[::-1][:components], vecs[:, ::-1][:, :components]
    deviation = [sum((n * c - s) ** 2 for c, s in zip(v, total, strict=True)) for v in x]
    return kept, n, deviation, centred @ vecs / np.sqrt(values), values / np.trace(cov)


@pytest.mark.parametrize("components", [32, 4])
def test_whitening_equals_brute_force(spark, components):
    rows = list(enumerate(some_vectors()))
    rows += [(1000, None), (1001, [1.0] * 8 + [None]), (1002, [1.0] * 8 + [float("nan")]), (1003, [float("inf")] + [0.0] * 8)]
    rows += [(7, rows[7][1]), (None, rows[8][1])]
    got = whitening.whiten(vectors(spark, rows).repartition(5), components=components).collect()
    kept, n, deviation, white, explained = brute_whitening(rows, components)
    assert len(got) == len(kept) * min(components, 9)
    by_id = {}
    for r in got:
        by_id.setdefault((r.vec_id, r.component), []).append(r)
    sign = {}
    for k, (i, _) in enumerate(kept):
        for c in range(min(components, 9)):
            for r in by_id[i, c + 1]:
                sign.setdefault(c, np.sign(r.whitened) * np.sign(white[k, c]))
                assert r.n == n and int(r.deviation) == deviation[k]
                assert abs(r.whitened * sign[c] - white[k, c]) < 1e-9
                assert abs(r.explained - explained[c]) < 1e-12 and r.identity_error < 1e-10
    assert len(by_id[7, 1]) == 2 and (None, 1) in by_id


def test_whitening_of_awkward_tables(spark):
    assert whitening.whiten(vectors(spark, [])).count() == 0
    assert whitening.whiten(vectors(spark, [(1, None), (2, [])])).count() == 0
    assert whitening.whiten(vectors(spark, [(1, [1.0, 2.0])] * 5)).count() == 0  # no spread, no components
    # the covariance of three rows has rank two; other lengths and entries past 2**40 are left out
    rows = [(1, [1.0, 2.0, 3.0]), (2, [2.0, 2.0, 5.0]), (3, [-1.0, 4.0, 1.0]), (4, [1.0, 2.0]), (5, [1e30, 0.0, 0.0])]
    got = whitening.whiten(vectors(spark, rows)).collect()
    assert sorted((r.vec_id, r.component) for r in got) == [(i, c) for i in (1, 2, 3) for c in (1, 2)]
    assert all(r.n == 3 and r.identity_error < 1e-9 for r in got)
    # large entries: products leave the doubles' whole numbers, sums stay exact
    rows = [(k, [float(2**30 * k), float(-(2**31) + k), 0.5 * k]) for k in range(6)]
    got = {r.vec_id: int(r.deviation) for r in whitening.whiten(vectors(spark, rows)).collect()}
    assert got == dict(zip(range(6), brute_whitening([(i, [float(np.float32(c)) for c in v]) for i, v in rows], 1)[2], strict=True))


@settings(max_examples=40, deadline=None)
@given(st.integers(1, 24), st.integers(1, 40), st.integers(0, 2**30), st.sampled_from(["plain", "whole", "twice", "same"]))
def test_spectrum_slicing_counts_and_components(dim, n, seed, kind):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, dim)) * 10 ** rng.uniform(-2, 3, dim)
    x = {"plain": x, "whole": np.floor(x), "twice": np.hstack([x, x]), "same": x}[kind]
    cov = np.eye(dim) * 3 if kind == "same" else np.cov(x.T, bias=True).reshape(x.shape[1], x.shape[1])
    truth = np.linalg.eigvalsh(cov)[::-1]
    for shift in rng.uniform(truth[-1] - 1, truth[0] + 1, 6):
        if np.abs(truth - shift).min() > 1e-9 * max(1.0, truth[0]):
            assert whitening.above(cov, shift) == (truth > shift).sum()
    values, vecs = whitening.leading(cov, 8)
    assert np.allclose(values, truth[: len(values)], rtol=1e-11, atol=1e-12 * max(truth[0], 1e-300))
    assert np.abs(vecs.T @ vecs - np.eye(len(values))).max(initial=0) < 1e-9
    assert np.abs(cov @ vecs - vecs * values).max(initial=0) <= 1e-12 * max(truth[0], 1e-300) * len(cov)
    assert all(truth[len(values) : 8] < 1e-9 * max(truth[0], 1e-300))


def test_whitening_query_reads_the_whole_table(spark):
    got = queries.QUERIES["op11_whitening"](spark, "/root/testdata/sf0.001")
    assert dict(got.dtypes)["deviation"] == "bigint"
    rows = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").select("vec_id", "embedding").collect()
    kept, n, deviation, _, _ = brute_whitening([tuple(r) for r in rows], 32)
    first = {r.vec_id: r for r in got.where("component = 1").collect()}
    assert {i: first[i].deviation for i, _ in kept} == {i: d for (i, _), d in zip(kept, deviation, strict=True)}
    assert got.count() == 32 * len(kept) and first[0].n == n


# ------------------------------------------------------------------ SimHash


def brute_fingerprint(text):
    w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    shingles = [b" ".join(w[k : k + 3]) for k in range(len(w) - 2)] if len(w) >= 3 else [b" ".join(w)] if w else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps):
    """Smallest reachable row number for each fingerprint of a list."""
    parent = list(range(len(fps)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(range(len(fps)), 2):
        if (fps[a] ^ fps[b]).bit_count() <= 3:
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return [root(x) for x in range(len(fps))]


def test_golay_code_is_perfect():
    words = np.random.default_rng(3).integers(0, 1 << 23, 2000)
    index = simhash.codeword_index(words)
    # one codeword for each index: encode the data bits again and measure
    code = np.array([(int(i) << 11) ^ simhash._remainder(int(i) << 11) for i in index])
    assert np.bitwise_count((code ^ words).astype(np.uint64)).max() <= 3
    assert len(np.unique(simhash.FLIPS)) == 2048


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 2**64 - 1), st.lists(st.integers(0, 63), min_size=0, max_size=3, unique=True))
def test_no_pair_within_three_flips_lacks_a_key(fp, bits):
    other = fp
    for b in bits:
        other ^= 1 << b
    mine, _ = simhash.keys(np.array([fp], np.uint64))
    theirs, _ = simhash.keys(np.array([other], np.uint64))
    assert set(mine.tolist()) & set(theirs.tolist())


def planted_fingerprints(seed=2, families=40):
    rng = random.Random(seed)
    out = []
    for _ in range(families):
        base = rng.getrandbits(64)
        for _ in range(rng.choice([1, 2, 5, 30])):
            x = base
            for b in rng.sample(range(64), rng.choice([0, 1, 2, 3, 4, 5])):
                x ^= 1 << b
            out.append(x)
    return sorted(set(out))


@pytest.mark.parametrize("bucket", [simhash.BUCKET, 18])
def test_links_span_the_components(spark, bucket):
    fps = planted_fingerprints()
    rows = spark.createDataFrame([((x + 2**63) % 2**64 - 2**63,) for x in fps], "fp bigint")
    found = simhash.links(rows, bucket).distinct().collect()
    assert all(((r.a ^ r.b) % 2**64).bit_count() <= 3 for r in found)
    place = {x: k for k, x in enumerate(fps)}
    parent = list(range(len(fps)))
    for r in found:
        a, b = (parent[place[x % 2**64]] for x in (r.a, r.b))
        parent = [min(a, b) if p in (a, b) else p for p in parent]
    assert parent == brute_components(fps)


def test_simhash_of_awkward_rows(spark):
    rng = random.Random(1)
    long = " ".join(f"word{rng.randrange(300)}" for _ in range(400))
    rows = [(5, long), (3, long.upper()), (9, long + " tail"), (4, None), (6, ""), (2, " \t\x0b\r\n"), (11, "one"), (12, "One"), (13, "one two")]
    rows += [(None, long), (None, "alone without an id"), (7, long), (7, "another text under the same id"), (3, long.upper()), (20, LONG), (21, LONG)]
    got = simhash.near_duplicates(documents(spark, rows)).collect()
    assert len(got) == len(rows)
    fps = [brute_fingerprint(t) for _, t in rows]
    comps = brute_components(fps)
    least = {}
    for (i, _), c in zip(rows, comps, strict=True):
        if i is not None:
            least[c] = min(i, least.get(c, i))
    want = sorted((str(i), f, str(least.get(c))) for (i, _), f, c in zip(rows, fps, comps, strict=True))
    assert sorted((str(r.doc_id), r.fp % 2**64, str(r.component_id)) for r in got) == want
    assert simhash.near_duplicates(documents(spark, [])).count() == 0


def test_long_texts_are_hashed_in_runs(monkeypatch):
    text = ("  Lorem\tipsum dolor sit\n amet  " * 50).encode()
    whole = np.concatenate(list(simhash._shingle_hashes(text)))
    monkeypatch.setattr(simhash, "LONG_TEXT", 7)
    runs = list(simhash._shingle_hashes(text))
    assert len(runs) > 10 and (np.concatenate(runs) == whole).all()
    assert [len(x) for x in simhash._shingle_hashes(b" two words ")] == [1]


def test_simhash_query_equals_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").collect()
    got = {r.doc_id: r for r in queries.QUERIES["op12_simhash"](spark, "/root/testdata/sf0.001").collect()}
    fps = [brute_fingerprint(d.text) for d in docs]
    comps = brute_components(fps)
    assert len(got) == len(docs)
    for d, f, c in zip(docs, fps, comps, strict=True):
        assert (got[d.doc_id].fingerprint, got[d.doc_id].component_id) == (f"{f:016x}", docs[c].doc_id)


# ------------------------------------------------------------------ collocations

WORDS = [b"a", b"b", b"bb", b"c"]


def phrase_counts(draw_from):
    return st.dictionaries(st.lists(st.sampled_from(draw_from), min_size=1, max_size=4).map(tuple), st.integers(1, 3), max_size=25)


@settings(max_examples=80, deadline=None)
@given(phrase_counts(WORDS), phrase_counts(WORDS), st.integers(1, 5))
def test_automata_hold_add_and_compose_counts(x, y, least):
    a, b = (collocations.Automaton.build(sorted(d.items())) for d in (x, y))
    assert list(collocations.Automaton.from_bytes(a.to_bytes()).phrases()) == sorted(x.items())
    both = Counter(x) + Counter(y)
    assert list(collocations.Automaton.union([a, b]).phrases()) == sorted(both.items())
    assert list(collocations.Automaton.union([a, b], least).phrases()) == sorted((p, n) for p, n in both.items() if n >= least)
    assert list(a.compose(b)) == sorted((p, y[p]) for p in x if p in y)
    assert len(set(a.states)) == len(a.states)  # no two states with the same transitions


def test_equal_ends_are_one_state():
    a = collocations.Automaton.build(sorted({(w, b"x", b"y"): 1 for w in (b"a", b"b", b"c")}.items()))
    assert len(a.states) == 4


def brute_collocations(rows, least, top, words=5):
    n, f = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for m in range(1, words + 1):
                f.update((lang, tuple(w[k : k + m])) for k in range(len(w) - m + 1))
    out = {}
    for (lang, p), a in f.items():
        if len(p) < 2 or a < least:
            continue
        inside = (
            100 * b >= 100 * a and any(q[k : k + len(p)] == p for k in range(len(q) - len(p) + 1))
            for (other, q), b in f.items() if b >= least and other == lang and len(q) > len(p)
        )
        if any(inside):
            continue
        cuts = [(1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p))]
        score, _, left, right = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), left, right))
    return sorted(
        (lang, rank, p.decode(), -a, left, right, n[lang], -score)
        for lang, found in out.items()
        for rank, (score, a, p, left, right) in enumerate(sorted(found)[:top], 1)
    )


def random_text(rng, n):
    return "".join(rng.choice(["New", "york", "City", "of", "the", "é漢", "x"]) + rng.choice([" ", " ", "  ", "\t", " ", ". ", ",", "\n", " \x0b", "! "]) for _ in range(n))


@pytest.mark.parametrize("least,top,shard", [(3, 2000, 1 << 23), (5, 4, 40), (2, 50, 1)])
def test_collocations_equal_brute_force(spark, monkeypatch, least, top, shard):
    rng = random.Random(least)
    rows = [(rng.choice(["en", "de", None, "und", ""]), random_text(rng, rng.randrange(60))) for _ in range(60)]
    rows += [("en", None), ("en", ""), ("en", " .,; \t\n"), ("fr", "new york " * 40), ("fr", "new york city. " * 3), (None, "word")]
    docs = spark.createDataFrame([(1, t, lang, 5, "p", "h", 0) for lang, t in rows], "doc_id bigint, text string, lang string, n bigint, part string, h string, k int")
    got = _collocations(spark, docs.repartition(3), least, top, shard)
    assert got == brute_collocations(rows, least, top)


def _collocations(spark, docs, least, top, shard):
    # the size of a shard is read on the workers, so it goes along with the function
    import mapweave.llm.collocations as module

    kept = module.SHARD_BYTES
    module.SHARD_BYTES = shard
    try:
        shards = list(module._shards(docs.select("text", "lang").fillna({"text": "", "lang": "und"}).toArrow().to_batches()))
        want = Counter()
        for s in shards:
            for k, c in enumerate(np.bincount(s.codes, minlength=len(s.names)).tolist()):
                want[s.lang, s.names[k].as_py()] += c
        module.SHARD_BYTES = 1 << 23
        whole = Counter()
        for s in module._shards(docs.select("text", "lang").fillna({"text": "", "lang": "und"}).toArrow().to_batches()):
            for k, c in enumerate(np.bincount(s.codes, minlength=len(s.names)).tolist()):
                whole[s.lang, s.names[k].as_py()] += c
        assert +want == +whole
    finally:
        module.SHARD_BYTES = kept
    rows = module.collocations(docs, least=least, top=top).collect()
    return sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in rows)


def test_collocations_of_empty_tables(spark):
    assert collocations.collocations(documents(spark, [])).count() == 0
    assert collocations.collocations(documents(spark)).where("a < 100").count() == 0


def test_scores_past_64_bits_are_exact(spark):
    # 1000 a n leaves 64 bits; the expression is the operator's own
    row = spark.createDataFrame([(10**12, 10**13, 10**12, 10**12 + 1)], "a bigint, n bigint, l bigint, r bigint")
    whole = "CAST({} AS DECIMAL(19, 0))"
    ratio = f"(CAST(1000 AS DECIMAL(4, 0)) * {whole.format('a')} * {whole.format('n')}) div ({whole.format('l')} * {whole.format('r')})"
    assert row.selectExpr(f"{ratio} AS s").first().s == 1000 * 10**12 * 10**13 // (10**12 * (10**12 + 1))


def test_new_queries_take_the_small_tables(spark):
    for name in ("op12_simhash", "op13_collocations"):
        assert sorted_rows(queries.QUERIES[name](spark, "/root/testdata/sf0.001")) is not None
