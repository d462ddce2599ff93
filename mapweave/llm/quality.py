"""Quality rules: a threshold table compiled into one projection of built-in expressions.

``RULES`` names a ratio over the base counts of a text and the bounds it must
keep. :func:`compile_rules` turns the table into boolean columns; nothing else
decides. Every count is over the whole text, in one row, without any shuffle.

Defined cases: a NULL text counts as empty; an empty text has no words and no
lines and fails the base rule; every row is judged by itself, so repeated rows
get equal results; an empty table gives no rows. Extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACE_RUN, sql_words

# words that running prose of the four languages cannot do without (fixed values)
STOP_WORDS = ("the", "of", "and", "to", "in", "der", "die", "und", "den", "von", "le", "la", "de", "et", "les", "el", "los", "en", "que", "y")

# name, SQL ratio over the base counts, least, most (None: open)
RULES: tuple[tuple[str, str, float | None, float | None], ...] = (
    ("length", "n_words", 50, None),
    ("word_length", "word_chars / greatest(n_words, 1)", 2.0, 15.0),
    ("symbols", "n_symbols / greatest(n_words, 1)", None, 0.1),
    ("stop_words", "n_stop / greatest(n_words, 1)", 0.01, None),
    ("dup_lines", "n_dup_lines / greatest(n_lines, 1)", None, 0.5),
    ("repeated_words", "n_repeat_words / greatest(n_words, 1)", None, 0.5),
)


def _repeat_positions(seed: int) -> str:
    """SQL text: start positions of the 3-word windows of ``g`` found twice or more.

    Window hash (upper bits) and position (the lower ``b`` bits) are packed into one
    long, so one primitive sort brings equal windows together.
    """
    packed = f"sort_array(transform(g, (x, i) -> shiftleft(xxhash64(x, {seed}), b) | CAST(i AS bigint)))"
    pairs = (
        "p -> flatten(filter(zip_with(slice(p, 1, size(p) - 1), slice(p, 2, size(p) - 1), (x, y) -> "
        "CASE WHEN shiftright(x, b) = shiftright(y, b) THEN array(x, y) END), z -> z IS NOT NULL))"
    )
    return f"CASE WHEN size(g) < 2 THEN array() ELSE array_distinct(transform(transform(array({packed}), {pairs})[0], x -> x & (shiftleft(1L, b) - 1L))) END"


def base_counts(docs: DataFrame) -> DataFrame:
    """Base counts of every text: the columns the rules read, plus ``doc_id``."""
    stops = ", ".join(f"'{w}'" for w in STOP_WORDS)
    lines = "filter(split(t, '\\n'), l -> l RLIKE '[^\\\\x20\\\\x09-\\\\x0D]')"
    split_up = docs.selectExpr("doc_id", "coalesce(text, '') AS t").selectExpr(
        "doc_id",
        f"{sql_words('t', SPACE_RUN)} AS w",
        "CAST(char_length(t) - char_length(regexp_replace(t, '[#*$%&|<>]', '')) AS bigint) AS n_symbols",
        f"transform(array({lines}), l -> struct(CAST(size(l) AS bigint) AS n, CAST(size(l) - size(array_distinct(l)) AS bigint) AS dup))[0] AS line",
    )
    hashed = split_up.selectExpr(
        "doc_id",
        "n_symbols",
        "line.n AS n_lines",
        "line.dup AS n_dup_lines",
        "CAST(size(w) AS bigint) AS n_words",
        "CAST(char_length(array_join(w, '')) AS bigint) AS word_chars",
        f"CAST(size(filter(w, x -> x IN ({stops}))) AS bigint) AS n_stop",
        "transform(w, x -> xxhash64(x)) AS h",
        "length(bin(size(w))) AS b",
    )
    kept = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines", "n_stop"]
    windows = hashed.selectExpr(
        *kept,
        "b",
        "CASE WHEN size(h) < 3 THEN array() ELSE zip_with(zip_with(slice(h, 1, size(h) - 2), slice(h, 2, size(h) - 2), (x, y) -> xxhash64(x, y)), "
        "slice(h, 3, size(h) - 2), (x, y) -> xxhash64(x, y)) END AS g",
    )
    # two independent hashes must agree that a window is repeated
    found = windows.selectExpr(*kept, f"array_intersect({_repeat_positions(1)}, {_repeat_positions(2)}) AS p")
    return found.selectExpr(
        *kept, "CAST(size(array_distinct(flatten(transform(p, x -> array(x, x + 1, x + 2))))) AS bigint) AS n_repeat_words"
    )


def compile_rules(rules=RULES) -> list:
    """One boolean column ``ok_<name>`` per row of the threshold table."""
    out = []
    for name, ratio, least, most in rules:
        tests = [f"({ratio}) >= {least}"] * (least is not None) + [f"({ratio}) <= {most}"] * (most is not None)
        out.append(F.expr(" AND ".join(tests) or "true").alias(f"ok_{name}"))
    return out


def judge(docs: DataFrame, rules=RULES) -> DataFrame:
    """Base counts, one column per rule, ``base_failed`` and ``kept``."""
    flags = compile_rules(rules)
    judged = base_counts(docs).select(
        "*", F.expr("n_words < 50 OR 100 * n_repeat_words > 50 * n_words").alias("base_failed"), *flags
    )
    passed = " AND ".join(["NOT base_failed", *(f"ok_{r[0]}" for r in rules)])
    return judged.withColumn("kept", F.expr(passed))
