"""Cleaning and typing expressions for staged text.

All are plain Column expressions (whole-stage codegen, no UDF). Guards and
casts sit inside one ``when`` so the cast only sees text that passed the
guard. Patterns end in ``\\z``: Java's ``$`` also matches before a final
newline, the reference engine's does not.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed patterns (values that must equal the reference's rules).
NUMERIC = r"^\d+(\.\d+)?\z"                     # measures: digits, optional fraction
MONEY = r"^\d+\.?\d*\z"                          # money: also accepts '12.'
INTEGER = r"^\d+\z"
TS_PREFIX = r"^\d{4}-\d{2}-\d{2}"                # guarded timestamp prefix
FLOAT = r"^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\z"  # coordinates

MEASURE_TYPE = "decimal(38,18)"
MONEY_TYPE = "decimal(10,2)"
COORD_TYPE = "decimal(38,18)"
TS_TYPE = "timestamp_ntz"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c: Column | str) -> Column:
    """``NULLIF(trim(x), '')`` (trim strips spaces only)."""
    return F.nullif(F.trim(_c(c)), F.lit(""))


def guarded_number(c: Column | str, pattern: str = NUMERIC, dtype: str = MEASURE_TYPE) -> Column:
    """Cast only text matching ``pattern``; no trim first (``' 12 '`` -> NULL).

    A value that matches but overflows ``dtype`` raises (ANSI cast), as the
    reference engine aborts the statement: no value is lost silently.
    """
    c = _c(c)
    return F.when(c.rlike(pattern), c.cast(dtype))


def guarded_money(c: Column | str) -> Column:
    """The laxer money pattern into decimal(10,2), HALF_UP at 2 digits."""
    return guarded_number(c, MONEY, MONEY_TYPE)


def guarded_int(c: Column | str, lo: int | None = None, hi: int | None = None) -> Column:
    """``^\\d+$`` to int, optionally also range-checked (score 1..5)."""
    c = _c(c)
    v = c.cast("int")  # raises on overflow; only reached by text that passed the guard
    inside = F.lit(True)
    if lo is not None:
        inside = inside & (v >= lo)
    if hi is not None:
        inside = inside & (v <= hi)
    return F.when(c.rlike(INTEGER), v if lo is None and hi is None else F.when(inside, v))


#: A zone offset after a time of day: Z, +02, +0530 or -03:30.
OFFSET = r"\d:\d\d(?::\d\d(?:\.\d+)?)?\s*(?:(Z)|([+-])(\d\d):?(\d\d)?)$"


def instant(c: Column | str, lenient: bool = False) -> Column:
    """Timestamp text as UTC time: an offset in the text is taken off, text without one is UTC already.

    Independent of the session's time zone; a plain ``timestamp_ntz`` cast
    would ignore the offset.
    """
    c = _c(c)
    group = lambda i: F.regexp_extract(c, OFFSET, i)
    utc = lambda text: text.try_cast(TS_TYPE) if lenient else text.cast(TS_TYPE)
    plain = F.regexp_replace(c, r"(\d:\d\d(?::\d\d(?:\.\d+)?)?)\s*(?:Z|[+-]\d\d:?(?:\d\d)?)$", "$1")
    minutes = group(3).cast("int") * 60 + F.coalesce(F.nullif(group(4), F.lit("")).cast("int"), F.lit(0))
    ahead = F.when(group(2) == "-", -minutes).when(group(2) == "+", minutes).otherwise(0)
    # text without an offset is searched for one and no more
    return F.when(c.rlike(OFFSET), F.timestamp_add("MINUTE", -ahead, utc(plain))).otherwise(utc(c))


def strict_ts(c: Column | str) -> Column:
    """Blank -> NULL, otherwise the UTC time; malformed text raises (ANSI cast)."""
    v = blank_to_null(c)
    return F.when(v.isNotNull(), instant(v))


def guarded_ts(c: Column | str, lenient: bool = False) -> Column:
    """The UTC time of text starting ``YYYY-MM-DD``, else NULL.

    A matching but impossible value (month 13) raises like the reference,
    unless ``lenient`` (then NULL).
    """
    c = _c(c)
    return F.when(c.rlike(TS_PREFIX), instant(c, lenient))


def is_float_text(c: Column | str) -> Column:
    """Row filter for coordinate text."""
    return _c(c).rlike(FLOAT)


def round_coord(c: Column | str) -> Column:
    """P10: coordinate rounded HALF_UP to 6 decimals as decimal(9,6)."""
    return F.round(_c(c).cast(COORD_TYPE), 6).cast("decimal(9,6)")


def norm_key(c: Column | str) -> Column:
    """``LOWER(TRIM(x))``."""
    return F.lower(F.trim(_c(c)))
