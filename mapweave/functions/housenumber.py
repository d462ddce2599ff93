"""House-number helpers as native Column expressions (no Python UDF).

``expand_house_numbers`` turns one house-number string into every number it
stands for, followed by the normalised string itself:

* ``12-16`` -> 12, 14, 16, ``12-16`` (same parity: step 2, else step 1;
  a descending or equal pair gives both ends);
* ``13a-c`` -> 13a, 13b, 13c, ``13a-c``; ``99t-99v`` -> 99t, 99u, 99v, ``99t-99v``;
* ``11,12`` / ``11/12`` / ``11+12`` / ``11;12`` -> the trimmed pieces plus the string;
* anything else -> the string alone.

Normalisation strips all leading ``0`` characters and lower-cases. NULL input
gives a NULL array (``explode_outer`` then keeps the row with a NULL number).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns and separators that decide the expansion, in the order
# they are tried.
INT_PATTERN = r"(?U)^\s*\+?[0-9]+(_[0-9]+)*\s*$"
NUM_LETTER_RANGE = r"^([0-9]+)([a-z])-([a-z])"
NUM_LETTER_NUM_LETTER_RANGE = r"^([0-9]+)([a-z])-([0-9]+)([a-z])"
LIST_SEPARATORS = [",", "/", "+", ";"]


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is evaluated once."""
    return F.transform(F.array(value), body).getItem(0)


def _digits(s: Column) -> Column:
    """Digits without leading zeros of an integer literal of any length, else NULL."""
    bare = F.regexp_replace(F.regexp_replace(s, r"(?U)[\s_+]", ""), r"^0+(?=[0-9])", "")
    return F.when(s.rlike(INT_PATTERN), bare)


def integer_or_null(s) -> Column:
    """Value (``decimal(38)``) of a string that is an integer literal, else NULL (never an error).

    Accepts blanks around the digits, a leading ``+`` and ``_`` between digits. Literals
    that no Spark number can hold give NULL; parity and expansion work on the digits.
    """
    return _let(_digits(_c(s).cast("string")), lambda d: F.when(F.length(d) <= 38, d.cast("decimal(38,0)")))


def parity(num) -> Column:
    """0 for even, 1 for odd, -1 when the value is not an integer; fractional types are truncated first."""
    c = _c(num)
    fractional = F.typeof(c).rlike("^(double|float|decimal)")
    rest = F.floor(F.pmod(F.abs(c.try_cast("double")), F.lit(2.0))).cast("int")
    text = _let(_digits(c.cast("string")), lambda d: (F.ascii(F.substring(d, -1, 1)) % 2).cast("int"))
    finite = F.abs(c.try_cast("double")) < F.lit(float("inf"))
    return F.coalesce(F.when(fractional, F.when(finite, rest)).otherwise(text), F.lit(-1))


def normalize_house_number(s) -> Column:
    return F.regexp_replace(F.lower(_c(s)), r"^0+", "")


def _letters(h: Column, pattern: str, first: int, last: int) -> Column:
    """Number plus each letter of the range that ``pattern`` finds, plus the string; the string alone where the range is empty."""
    lo, hi = F.ascii(F.regexp_extract(h, pattern, first)), F.ascii(F.regexp_extract(h, pattern, last))
    number = F.regexp_extract(h, pattern, 1)
    named = F.transform(F.sequence(lo, hi), lambda c: F.concat(number, F.char(c)))
    return F.when(hi >= lo, F.concat(named, F.array(h))).otherwise(F.array(h))


def _trim_ws(x: Column) -> Column:
    return F.regexp_replace(x, r"(?U)^\s+|\s+$", "")


# digits of the tail that is counted as a number; what stands before it is a string
_TAIL = 18
_BORDER = 10**_TAIL


def _increment(s: Column) -> Column:
    """The digit string of the next number: the nines at the end turn to zeros and the digit before them takes the carry."""
    parts = r"^([0-9]*?)([0-8]?)(9*)$"
    digit = F.regexp_extract(s, parts, 2)
    carried = F.when(digit == "", F.lit("1")).otherwise(F.char(F.ascii(digit) + 1))
    return F.concat(F.regexp_extract(s, parts, 1), carried, F.repeat(F.lit("0"), F.length(F.regexp_extract(s, parts, 3))))


def _number_range(a: Column, b: Column, h: Column) -> Column:
    """``a < b``, digits of any length: every number, or every second one where both have one parity, plus the string.

    Numbers are counted on their last digits, behind a head that both ends share, or, where the range
    crosses a border of the counted digits, behind the head of each end in turn. A range of more
    numbers than an array holds raises, as ``sequence`` does.
    """

    def part(x: Column) -> Column:
        long = F.length(x) > _TAIL
        return F.struct(
            F.when(long, x.substr(F.lit(1), F.length(x) - _TAIL)).otherwise(F.lit("")).alias("head"),
            F.when(long, x.substr(F.length(x) - _TAIL + 1, F.lit(_TAIL))).otherwise(x).cast("bigint").alias("tail"),
        )

    def counted(ends: Column) -> Column:
        low, high = ends.getField("low"), ends.getField("high")
        odd = low["tail"] % 2
        step = F.when(odd == high["tail"] % 2, F.lit(2)).otherwise(F.lit(1)).cast("bigint")

        def run(head: Column, first: Column, last: Column) -> Column:
            padded = lambda t: F.concat(head, F.lpad(t.cast("string"), _TAIL, "0"))
            return F.transform(F.sequence(first, last, step), lambda t: F.when(head == "", t.cast("string")).otherwise(padded(t)))

        up = F.concat(
            run(low["head"], low["tail"], F.lit(_BORDER - 1).cast("bigint")),
            # the border is even, so counting by two goes on at the same parity
            run(high["head"], F.when(step == 2, odd).otherwise(F.lit(0)).cast("bigint"), high["tail"]),
        )
        return (
            F.when(low["head"] == high["head"], run(low["head"], low["tail"], high["tail"]))
            .when(_increment(low["head"]) == high["head"], up)
            .otherwise(F.raise_error(F.lit("a house-number range holds more numbers than an array")).cast("array<string>"))
        )

    return F.concat(_let(F.struct(part(a).alias("low"), part(b).alias("high")), counted), F.array(h))


def _dashed(h: Column) -> Column:
    """Expansion of a string with a dash: one of the range forms if it has exactly two parts."""

    def ranged(ends: Column) -> Column:
        a, b = ends.getField("a"), ends.getField("b")
        longer = (F.length(a) < F.length(b)) | ((F.length(a) == F.length(b)) & (a < b))
        two_letters = h.rlike(NUM_LETTER_NUM_LETTER_RANGE) & (
            F.regexp_extract(h, NUM_LETTER_NUM_LETTER_RANGE, 1) == F.regexp_extract(h, NUM_LETTER_NUM_LETTER_RANGE, 3)
        )
        return (
            F.when((a != "0") & (b != "0") & longer, _number_range(a, b, h))
            .when((a != "0") & (b != "0"), F.array(a, b, h))
            .when(h.rlike(NUM_LETTER_RANGE), _letters(h, NUM_LETTER_RANGE, 2, 3))
            .when(two_letters, _letters(h, NUM_LETTER_NUM_LETTER_RANGE, 2, 4))
            .otherwise(F.array(h))
        )

    def of_parts(parts: Column) -> Column:
        ends = F.struct(_digits(parts.getItem(0)).alias("a"), _digits(parts.getItem(1)).alias("b"))
        return F.when(F.size(parts) == 2, _let(ends, ranged)).otherwise(F.array(h))

    return _let(F.split(h, "-", -1), of_parts)


def expand_house_numbers(s) -> Column:
    """array<string> of the numbers a house-number string stands for, plus the string."""

    def expanded(h: Column) -> Column:
        result = F.when(h.contains("-"), _dashed(h))
        for sep in LIST_SEPARATORS:
            pieces = F.transform(F.split(h, "\\" + sep if sep == "+" else sep, -1), _trim_ws)
            result = result.when(h.contains(sep), F.concat(pieces, F.array(h)))
        return F.when(h.isNotNull(), result.otherwise(F.array(h)))

    return _let(normalize_house_number(s), expanded)
