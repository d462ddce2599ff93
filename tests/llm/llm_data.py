"""Small tables with the awkward rows that every operator must take."""

LONG = "The house of the quick brown fox and the lazy dog in the wide field of wheat. " * 700
PASSAGE = "one two three four five six seven eight nine ten eleven twelve"

ROWS = [
    (1, "alpha beta gamma delta epsilon zeta eta theta iota kappa"),
    (2, "alpha beta gamma delta epsilon zeta eta theta iota kappa"),
    (3, "ALPHA beta gamma delta epsilon zeta eta theta iota kappa lambda"),
    (4, None),
    (5, ""),
    (6, " \t\n\x0b\x0c\r "),
    (7, f"before {PASSAGE} after"),
    (8, f"{PASSAGE.upper()}, licensed under the MIT License.\nLicensed under CC BY-NC 4.0."),
    (9, LONG),
    (9, LONG),
    (10, "é漢字 x" * 9),
    (None, "a row without an id"),
    (None, None),
    (12, 'the token = "40ba077d62935af6fd437e967f92c02cca956b74" stays secret'),
    (13, "x"),
    (14, "x"),
    (15, "y z"),
    (2**40, "##### $$$ a|b <c> d&e %f"),
]
BENCH = [(70, PASSAGE), (71, "lambda"), (72, None), (73, "..."), (None, "eta theta iota"), (70, PASSAGE)]


def documents(spark, rows=ROWS):
    """``rows`` with further columns whose names operators use inside."""
    cols = "doc_id bigint, text string, lang string, n bigint, w string, size string, token string, h string, node int, place string, start int"
    return spark.createDataFrame([(i, t, "en", 7, "w", "s", "t", "h", 1, "p", 2) for i, t in rows], cols)


def benchmark(spark, rows=BENCH):
    return spark.createDataFrame(rows, "item_id bigint, text string")


def labels(spark, rows=((1, 0), (2, 0), (7, 1), (None, 1), (8, 1), (8, 0), (999, 1))):
    return spark.createDataFrame([(i, 1, t) for i, t in rows], "doc_id bigint, quality int, toxic int")


def sorted_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((x is not None, str(type(x)), str(x)) for x in r))
