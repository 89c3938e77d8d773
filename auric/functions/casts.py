"""Lenient casts of text columns with the results an analyst's SQL expects.

Silver keeps every business column as text; gold reads dates and numbers with
``try_cast``. Spark's and DuckDB's lenient casts disagree on a few shapes
('2024' is a date to Spark only, '2024/01/15' to DuckDB only, '1d' is a double
to Spark only, ' true ' a boolean to Spark only). These helpers put a pattern
guard in front of ``try_cast`` so that what is accepted, and what it means, is what
the reference engine says. Everything stays a built-in expression inside
whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, DoubleType, NumericType, StringType

# Fixed patterns (values the results depend on).
# A calendar date, year first (1 to 7 digits), its parts separated twice by the same
# one of - / \ or a space; then nothing, or a time of day (24:00 only as such) and
# perhaps a zone: Z, an offset, or a name after a space.
_TIME = (r"(?:[01]?\d|2[0-3]):[0-5]?\d(?::[0-5]?\d(?:\.\d*)?)?|24:00(?::00(?:\.0*)?)?")
_ZONE = r"\s*Z|\s*[+-]\d{2}(?::?\d{2}(?::\d{2})?)?|\s+[A-Za-z][\w/+-]*"
_DATE_RE = (r"^\s*(\d{1,7})([-/\\ ])(\d{1,2})\2(\d{1,2})"
            rf"(?:(?:T|\s+)(?:{_TIME})(?:{_ZONE})?)?\s*$")
# A decimal or scientific number; digits may be grouped with single underscores.
_NUMBER_RE = (r"^\s*[+-]?((\d+(_\d+)*)(\.\d*)?|\.\d+)([eE][+-]?\d+)?\s*$"
              r"|^\s*[+-]?(?i:nan|inf|infinity)\s*$")
# Boolean words are accepted only without surrounding blanks.
_PADDED_RE = r"^\s|\s$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_date(c) -> Column:
    """``try_cast(text as date)`` with the shapes the reference engine reads.

    Cheap on the common shape: ten characters with dashes in their places are a
    date if Spark reads them. Any other text must match the date pattern as a whole
    (Spark alone also reads 'YYYY' and 'YYYY-MM', and times of day that do not
    exist); its parts are put together again with dashes, so '24-01-15' is the year
    24. 'epoch' is 1970-01-01.

    Left out, and NULL here: years before 1 (a sign, or BC after the date) and
    'infinity', which Spark has no date for, and times broken off after a colon.
    """
    c = _col(c)
    x = c.try_cast(DateType())
    usual = (F.length(c) == 10) & (F.substring(c, 5, 1) == "-") & (F.substring(c, 8, 1) == "-")
    year = F.regexp_extract(c, _DATE_RE, 1)
    whole = F.concat_ws("-", F.when(F.length(year) < 4, F.lpad(year, 4, "0")).otherwise(year),
                        F.regexp_extract(c, _DATE_RE, 3), F.regexp_extract(c, _DATE_RE, 4))
    return (F.when(usual & x.isNotNull(), x)
             .when(c.rlike(_DATE_RE), whole.try_cast(DateType()))
             .when(F.lower(F.trim(c)) == "epoch", F.lit("1970-01-01").cast(DateType())))


def safe_double(c) -> Column:
    """``try_cast(text as double)``: plain decimal / scientific numbers only.

    Cheap on the common shape: the plain cast, then two character checks for
    the forms only Spark reads (a d/f type suffix after a digit, hex); the
    number pattern runs only on values with underscores, which only DuckDB
    reads (digit grouping).
    """
    c = _col(c)
    x = c.try_cast(DoubleType())
    t = F.rtrim(c)
    last = F.lower(F.substring(t, -1, 1))
    before = F.substring(t, -2, 1)
    suffixed = last.isin("d", "f") & (before.between("0", "9") | (before == "."))
    hexa = F.lower(c).contains("x")
    grouped = F.when(c.rlike(_NUMBER_RE),
                     F.regexp_replace(c, "_", "").try_cast(DoubleType()))
    return (F.when(c.contains("_"), grouped)
             .when(x.isNull() | suffixed | hexa, F.lit(None).cast(DoubleType()))
             .otherwise(x))


def safe_bool(c, data_type=None) -> Column:
    """``try_cast(x as boolean)`` for a text or boolean flag column.

    Text: true/false/t/f/yes/no/y/n/1/0 in any case, unpadded; anything else
    is NULL. Booleans pass through; numbers are non-zero = true.
    """
    c = _col(c)
    if isinstance(data_type, BooleanType):
        return c
    if isinstance(data_type, NumericType):
        return c != F.lit(0)
    if data_type is not None and not isinstance(data_type, StringType):
        c = c.cast(StringType())
    return (F.when(c.rlike(_PADDED_RE), F.lit(None).cast(BooleanType()))
             .otherwise(c.try_cast(BooleanType())))


def bigint_half_even(c) -> Column:
    """``cast(double as bigint)`` rounding half to even (2.5 -> 2, 3.5 -> 4)."""
    return F.rint(_col(c)).cast("bigint")


SUM_PLACES = 9
_SUM_LIMIT = float(1 << 52)


def exact_sum(c) -> Column:
    """Sum of doubles that does not depend on the order of the rows.

    Each value counts as its whole part and its first nine decimals; both are added as
    whole numbers, so tasks and partitions may be cut in any way, and the sum is rounded to
    a double once. Values of 2**52 or more, infinite ones and NaN are added as doubles
    beside them. Like ``sum``, NULLs are left out and no value gives NULL; more than 9e9
    rows of a group or a whole part over 9e18 raise an overflow error rather than wrap.
    """
    c = _col(c).cast(DoubleType())
    unit = 10 ** SUM_PLACES
    usual = F.abs(c) < _SUM_LIMIT                # not for NaN, which is the greatest
    whole = F.floor(c)
    part = F.rint((c - whole) * F.lit(float(unit))).cast("bigint")
    units, parts = F.sum(F.when(usual, whole.cast("bigint"))), F.sum(F.when(usual, part))
    # the parts carry over first, so that one addition rounds
    exact = ((units + F.floor(parts / F.lit(unit).cast("decimal(20,0)")).cast("bigint"))
             .cast(DoubleType()) + F.pmod(parts, F.lit(unit)).cast(DoubleType()) / float(unit))
    other = F.sum(F.when(~usual, c))
    return F.coalesce(exact + other, exact, other)
