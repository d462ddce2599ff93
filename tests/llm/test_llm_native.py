"""Sharding, decontamination, chat formatting and quality rules against plain Python."""

import hashlib
import re
import zlib
from collections import Counter

import pytest

pytest.importorskip("mapweave.llm")

from llm_data import BENCH, ROWS, benchmark, documents, sorted_rows
from mapweave.llm import chat, decontam, quality, sharding

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")


def _permuted(place, n, seed):
    """The permutation in plain Python."""
    x = place
    while True:
        for mul, off, lo, hi in sharding.round_keys(n, seed):
            kept = x & ((1 << hi) - 1)
            z = (kept % sharding.PRIME * mul + off) % sharding.PRIME
            x = kept << lo | ((x >> hi) ^ ((z ^ z >> 13) & ((1 << lo) - 1)))
        if x < n:
            return x


@pytest.mark.parametrize("n", [1, 2, 3, 17, 64, 1000])
def test_permutation_is_a_bijection_with_an_inverse(spark, n):
    df = spark.range(n).withColumnRenamed("id", "place").withColumn("p", sharding.permute("place", n, 5))
    rows = df.withColumn("back", sharding.unpermute("p", n, 5)).collect()
    assert sorted(r.p for r in rows) == list(range(n))
    assert all(r.back == r.place and r.p == _permuted(r.place, n, 5) for r in rows)


def test_shards_of_awkward_rows(spark):
    out = sharding.shard_rows(documents(spark), 4, 11).collect()
    n = len(ROWS)
    order = sorted(
        ((i is not None, i or 0), zlib.crc32((t or "").encode()), len((t or "").encode()) + 1, i) for i, t in ROWS
    )
    want = Counter()
    for place, (_, crc, size, i) in enumerate(order):
        p = _permuted(place, n, 11)
        want[(i, size, crc, p % 4, p // 4)] += 1
    assert Counter((r.doc_id, r.size, r.text_crc32, r.shard, r.slot) for r in out) == want
    sizes = Counter(r.shard for r in out)
    assert max(sizes.values()) - min(sizes.values()) <= 1
    assert sharding.shard_rows(documents(spark, []), 4, 11).count() == 0


def _overlaps(text, items):
    w = ALNUM.findall((text or "").translate(LOWER))
    hit, names = set(), set()
    for item, other in items:
        v = ALNUM.findall((other or "").translate(LOWER))
        n = min(10, len(v))
        windows = {tuple(v[k : k + n]) for k in range(len(v) - n + 1)} if n else set()
        for k in range(len(w) - n + 1):
            if n and tuple(w[k : k + n]) in windows:
                hit.update(range(k, k + n))
                names.add("null" if item is None else str(item))
    return len(w), len(hit), sorted(names)


def _digest(names):
    return hashlib.sha256(",".join(names).encode()).hexdigest()


@pytest.mark.parametrize("limits", [None, 0])
def test_contamination_of_awkward_rows(spark, monkeypatch, limits):
    if limits is not None:  # the same result when nothing may be broadcast
        for name in ("BROADCAST_ROWS", "BROADCAST_KEYS", "ITEM_WORDS_BROADCAST"):
            monkeypatch.setattr(decontam, name, limits)
    got = sorted_rows(decontam.contamination(documents(spark), benchmark(spark)))
    want = []
    for i, t in ROWS:
        n, hit, names = _overlaps(t, BENCH)
        want.append((i, n, hit, len(names), _digest(names), hit > 0))
    assert got == sorted(want, key=lambda r: tuple((x is not None, str(type(x)), str(x)) for x in r))


def test_contamination_of_empty_tables(spark):
    assert decontam.contamination(documents(spark, []), benchmark(spark)).count() == 0
    clean = decontam.contamination(documents(spark), benchmark(spark, [])).collect()
    assert len(clean) == len(ROWS) and not any(r.contaminated for r in clean)


def test_dropping_keeps_clean_rows_and_columns(spark):
    docs = documents(spark)
    kept = decontam.drop_contaminated(docs, benchmark(spark))
    assert kept.columns == docs.columns
    assert sorted_rows(kept.select("doc_id", "text")) == sorted(
        ((i, t) for i, t in ROWS if not _overlaps(t, BENCH)[1]),
        key=lambda r: tuple((x is not None, str(type(x)), str(x)) for x in r),
    )


TURNS = [
    (1, 1, "assistant", "b"), (1, 0, "user", "a [/INST] </s> \\q \\"), (1, 2, "assistant", "c[+]d"), (1, 3, "user", None),
    (2, None, None, "<s>[x]y"), (2, 0, "assistant", ""), (None, 5, "as]sis[tant", "z"), (3, 0, "user", "t"), (3, 0, "user", "t"),
]


def test_chats_come_back_exactly(spark):
    turns = spark.createDataFrame([(*t, "x", 1) for t in TURNS], "conv_id bigint, turn bigint, role string, text string, t string, pieces int")
    chats = chat.format_chats(turns)
    back = {r.conv_id: [(t.role, t.text) for t in r.turns] for r in chat.read_back(chats).collect()}
    assert back[1] == [("user", TURNS[1][3]), ("assistant", "b"), ("assistant", "c[+]d"), ("user", "")]
    assert back[2] == [("", "<s>[x]y"), ("assistant", "")]
    assert back[None] == [("as]sis[tant", "z")]
    assert back[3] == [("user", "t"), ("user", "t")]
    one = {r.conv_id: r for r in chat.digests(chats).collect()}[1]
    assert one.n_turns == 4 and one.loss_chars == len("bc[+]d")
    assert one.loss_sha256 == hashlib.sha256(b"bc[+]d").hexdigest()
    said = "".join(f"{r}\n{t}\n" for r, t in back[1])
    assert one.turns_sha256 == hashlib.sha256(said.encode()).hexdigest()
    # neighbours of one role stand in one run
    assert chats.where("conv_id = 1").first().formatted.count("<s>[") == 3
    assert chat.digests(chat.format_chats(turns.limit(0))).count() == 0


def _base(text):
    t = text or ""
    w = SPACED.findall(t)
    lines = [x for x in t.split("\n") if SPACED.search(x)]
    grams = [tuple(w[k : k + 3]) for k in range(len(w) - 2)]
    often = Counter(grams)
    again = {p for k, g in enumerate(grams) if often[g] > 1 for p in (k, k + 1, k + 2)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(again)


def test_quality_counts_of_awkward_rows(spark):
    rows = [*ROWS, (20, "a b c a b c\n\nq\nq\n q"), (21, "a a a a"), (22, "w " * 60)]
    got = sorted_rows(
        quality.judge(documents(spark, rows)).select(
            "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"
        )
    )
    want = []
    for i, t in rows:
        b = _base(t)
        want.append((i, *b, b[0] < 50 or 100 * b[4] > 50 * b[0]))
    assert got == sorted(want, key=lambda r: tuple((x is not None, str(type(x)), str(x)) for x in r))
    assert quality.judge(documents(spark, [])).count() == 0


def test_rules_run_without_python(spark):
    plan = quality.judge(documents(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_native_operators_run_without_python(spark):
    for df in (sharding.shard_rows(documents(spark)), decontam.contamination(documents(spark), benchmark(spark))):
        plan = df._jdf.queryExecution().toString()
        assert not any(word in plan for word in ("Python", "Pandas", "InArrow"))
