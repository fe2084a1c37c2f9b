"""Safe text -> typed conversions, built from native Spark expressions.

All conversions follow the *stated* semantics (non-numeric text becomes
null) rather than a plain ``cast``, which raises under ANSI mode. Every
text-to-number conversion goes through one ASCII grammar so that Spark,
DuckDB and the canonical-text step agree on what counts as a number.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# The number grammar (optional sign, digits with optional
# fraction, optional exponent; or nan / inf / infinity in any case) and
# the integer grammar. Anything else is not a number.
FINITE_PATTERN = r"^[+-]?(([0-9]+[.]?[0-9]*)|([.][0-9]+))([eE][+-]?[0-9]+)?$"
SPECIAL_PATTERN = r"^[+-]?(?i:nan|inf|infinity)$"
NUMBER_PATTERN = f"{FINITE_PATTERN}|{SPECIAL_PATTERN}"
INTEGER_PATTERN = r"^[+-]?[0-9]+$"
ZERO_FRACTION_PATTERN = r"^[+-]?[0-9]+[.]0*$"
# Numbers whose canonical text is the text itself: integers without a plus sign or
# leading zeros, and fractions whose last digit (of 15 at most, six after the point)
# is not zero, so that their double is never whole. Possessive: digits are read once.
CANONICAL_PATTERN = r"^(?:0|-?[1-9][0-9]*+|[+-]?[0-9]{1,9}+[.][0-9]{0,5}[1-9])$"
# The same over a cell as it came, and plain decimal text: no blank or line end around either.
CANONICAL_CELL = CANONICAL_PATTERN[:-1] + r"\z"
PLAIN_CELL = r"^-?[0-9]{1,15}+(?:[.][0-9]{1,15}+)?\z"
# A canonical integer with a fraction of zeros: its canonical text ends at the point.
ZERO_FRACTION_CELL = r"^(?:0|-?[1-9][0-9]*+)[.]0*+\z"
UNKNOWN_LABEL = "DESCONOCIDO"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Fixed value: the whitespace stripped around a cell (ASCII, as str.strip).
WHITESPACE = " \t\n\r\x0b\x0c"


def apart(fn, c: str | Column) -> Column:
    """``fn`` of a cell, as a lambda over an array of one. Whole-stage code
    generation leaves a projection that holds a lambda alone, so the grammar of many
    cells never becomes one method too large to be JIT-compiled (8000 bytes),
    whatever the session's ``spark.sql.codegen.hugeMethodLimit``."""
    return F.get(F.transform(F.array(_col(c)), fn), F.lit(0))


def _one_digit(s: Column) -> Column:
    """The text is one digit, as most codes are: three comparisons of bytes."""
    return (F.octet_length(s) == 1) & (s >= F.lit("0")) & (s <= F.lit("9"))


def _few_digits(s: Column) -> Column:
    """The text is two to four digits, the first not zero: comparisons of single
    characters, about a seventh of the time of a pattern. A character of several bytes
    is above "9"; a place beyond the text is empty, below "0"."""
    n = F.octet_length(s)
    out = (n >= 2) & (n <= 4) & (s >= F.lit("1")) & (s < F.lit(":"))
    for k in (2, 3, 4):
        at = F.substring(s, k, 1)
        out = out & ((n < k) | ((at >= F.lit("0")) & (at <= F.lit("9"))))
    return out


def canonical_cell_text(c: str | Column) -> Column:
    """``canonical_text`` where many cells are read in one projection: text that is
    canonical as it came, between blanks, or but for a fraction of zeros takes a check
    or two; the rest of the grammar is apart."""
    s = _col(c)
    t = F.trim(s)
    return (F.when(s.isNull() | _one_digit(s) | _few_digits(s) | s.rlike(CANONICAL_CELL), s)
            .when(_one_digit(t) | t.rlike(CANONICAL_CELL), t)
            .when(t.rlike(ZERO_FRACTION_CELL), F.substring_index(t, ".", 1))
            .otherwise(apart(canonical_from_clean, clean_text(s))))


def cell_double(c: str | Column) -> Column:
    """``to_double`` where many cells are read in one projection: one digit and plain
    decimal text are read as they came; the rest of the grammar is apart."""
    s = _col(c)
    return (F.when(s.isNull(), F.lit(None).cast("double"))
            .when(_one_digit(s), (F.ascii(s) - F.lit(48)).cast("double"))
            .when(s.rlike(PLAIN_CELL), s.try_cast("double"))
            .otherwise(apart(parse_double, clean_text(s))))


def clean_text(c: str | Column) -> Column:
    """Strip surrounding whitespace; blank text becomes null."""
    return F.nullif(F.btrim(_col(c), F.lit(WHITESPACE)), F.lit(""))


def to_double(c: str | Column) -> Column:
    """Text -> double; non-numeric text -> null (never an error)."""
    return parse_double(clean_text(c))


def is_finite(c: str | Column) -> Column:
    """Not null, not NaN, not +/-infinity (NaN sorts above everything
    in Spark, so range predicates need this guard)."""
    # abs(NaN) is not below infinity (NaN sorts above everything), so one
    # comparison covers NaN and both infinities; null is false
    return F.coalesce(F.abs(_col(c)) < F.lit(float("inf")), F.lit(False))


def to_code(c: str | Column) -> Column:
    """Integer code only if the text is numeric, finite and whole, and
    fits an int; otherwise null."""
    d = to_double(c)
    return F.when(is_finite(d) & (d == F.rint(d)), d.try_cast("int"))


def to_id(c: str | Column) -> Column:
    """Identifier -> long; only integer text, overflow -> null."""
    s = clean_text(c)
    return F.when(s.rlike(INTEGER_PATTERN), s.try_cast("bigint"))


def lookup(key: str | Column, table: Mapping, otherwise) -> Column:
    """Value listed for a key, ``otherwise`` for a null or unlisted one: the
    key's position in a literal array picks from an array of the values (a
    projection: no join, no shuffle)."""
    place = F.array_position(F.array(*[F.lit(k) for k in table]), _col(key))
    found = F.get(F.array(*[F.lit(v) for v in table.values()]), (place - 1).cast("int"))
    return F.coalesce(found, F.lit(otherwise))


def label(code: str | Column, dictionary: Mapping[int, str], unknown: str = UNKNOWN_LABEL) -> Column:
    """Dictionary label of a code."""
    return lookup(code, dictionary, unknown)


def label_rank(lbl: str | Column, order: list[str]) -> Column:
    """Position of a label in an explicit category order (unknown last)."""
    return lookup(lbl, {name: place for place, name in enumerate(order)}, len(order))


def parse_double(s: Column) -> Column:
    """Cleaned text -> double under the number grammar. The grammar check
    comes first: a cast that fails is far slower than a regex match, so
    casts only ever see valid input."""
    return F.when(s.rlike(FINITE_PATTERN), s.try_cast("double")).when(s.rlike(SPECIAL_PATTERN), _special(s))


def _special(s: Column) -> Column:
    """nan / inf spellings, which a cast declines or reads by a failed parse."""
    low = F.lower(s)
    return (F.when(low.isin("nan", "+nan", "-nan"), F.lit(float("nan")))
            .when(low.isin("inf", "+inf", "infinity", "+infinity"), F.lit(float("inf")))
            .when(low.isin("-inf", "-infinity"), F.lit(float("-inf"))))


def canonical_from_clean(s: Column) -> Column:
    """S4 on already-cleaned text (see ``canonical_text``).

    Integer text, with or without a fraction of zeros: sign and leading zeros
    normalised, every digit kept. Other numeric text whose value is a finite
    whole number is written from the parsed double without a fraction.
    Anything else is returned as is. Every cast sees only text its grammar
    check accepted. Text that is canonical already, as most cells are, takes one
    check.
    """
    is_int = s.rlike(INTEGER_PATTERN) | s.rlike(ZERO_FRACTION_PATTERN)
    digits = F.regexp_replace(F.regexp_replace(s, r"[.]0*$", ""), r"^(-?)[+]?0*(?=[0-9])", "$1")
    # nan and inf are not whole, so no cast needs to see them; + 0.0 turns -0.0 into 0.0
    d = F.when(s.rlike(FINITE_PATTERN), s.try_cast("double"))
    # apart also names a value, so that a lambda, where nothing is shared, takes it once
    return (
        F.when(s.rlike(CANONICAL_PATTERN), s)
        .when(is_int, apart(lambda x: F.when(x == "-0", F.lit("0")).otherwise(x), digits))
        .otherwise(apart(lambda x: F.when(is_finite(x) & (x == F.rint(x)), F.format_string("%.0f", x + F.lit(0.0)))
                         .otherwise(s), d))
    )


def canonical_text(c: str | Column) -> Column:
    """Canonical text of a raw cell.

    null / blank -> null; integral numbers written any way ("3", "3.0",
    " 3 ", "1e3") -> integer text; integer text keeps all its digits
    (no float round trip); any other text is returned stripped, including
    "nan" and "Infinity" which are numbers but not finite.
    """
    return canonical_from_clean(clean_text(c))


def canonical_text_of_integral(c: str | Column) -> Column:
    """S4 for typed integers: every digit, no round trip through a double."""
    return _col(c).cast("string")


def canonical_text_of_decimal(c: str | Column) -> Column:
    """S4 for typed decimals: the digits without trailing zeros of the fraction."""
    return canonical_from_clean(F.regexp_replace(_col(c).cast("string"), r"([.][0-9]*?)0+$", "$1"))


def canonical_text_of_number(c: str | Column) -> Column:
    """S4 for typed floating input columns: NaN -> null, +/-inf ->
    "Infinity"/"-Infinity", whole numbers of any size -> integer text."""
    x = _col(c)
    d = x.cast("double")
    return (
        F.when(x.isNull() | F.isnan(d), F.lit(None).cast("string"))
        .when(d == F.lit(float("inf")), F.lit("Infinity"))
        .when(d == F.lit(float("-inf")), F.lit("-Infinity"))
        .when(d == F.rint(d), F.format_string("%.0f", d + F.lit(0.0)))
        .otherwise(d.cast("string"))
    )
