"""Lenient text cleaning and casts, as Column expressions.

Bronze holds every source value as text.  Silver turns text into types with
"try" semantics: anything that does not parse becomes NULL instead of failing
the load.  The accepted spellings follow the reference's database, which is
more forgiving than Spark's own casts in a few places (slashes in dates,
``12.5`` as an integer, digit-group underscores, ``24:00`` as midnight of the
next day).  Each helper keeps the common, already-canonical spelling on a fast
path that is a plain ``try_cast``; the regular expressions only run for the
rest.  Everything stays inside Catalyst (no Python UDF), so whole-stage codegen
covers the Silver projection.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accepted text shapes.
# A date is year, month, day with one separator repeated ('-', '/', '\\' or ' ').
# A time is H:MM[:SS[.fraction]] after a space or 'T'; an optional zone
# (Z, UTC, +hh, +hh:mm, +hhmm) is read and ignored (timestamps carry no zone).
# A bare date may carry trailing blanks only when cast to a date.
_DATE = r"^\s*(\d{4})([-/ \\])(\d{1,2})\2(\d{1,2})"
_ZONE = r"\s*(?:[Zz]|[Uu][Tt][Cc]|[+-]\d{2}(?::?\d{2})?)?\s*$"
WITH_TIME = _DATE + r"[ T]\s*(\d{1,2}):(\d{2})(:\d{2})?(\.\d+)?" + _ZONE
MIDNIGHT_24 = _DATE + r"[ T]\s*24:00(?::00(?:\.0+)?)?" + _ZONE
BARE_DATE = _DATE + "$"
BARE_DATE_BLANKS = _DATE + r"\s*$"
CANONICAL_TS = r"^\d{4}-\d{2}-\d{2}[ T]([01]\d|2[0-3]):\d{2}:\d{2}(\.\d{1,6})?$"
PLAIN_INTEGER = r"^\s*[+-]?\d{1,18}\s*$"
HEX_INTEGER = r"^\s*0[xX]0*[0-9a-fA-F]{1,16}\s*$"
PLAIN_DECIMAL = r"^\s*([+-]?)(\d*)\.(\d)\d*\s*$"
DECIMAL_SHAPE = r"^[\x00-\x20]*[+-]?[0-9.]+([eE][+-]?[0-9]+)?[\x00-\x20]*$"
DIGIT_UNDERSCORE = r"(?<=[0-9])_(?=[0-9])"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_text(c) -> Column:
    """``NULLIF(TRIM(CAST(x AS STRING)), '')``: trims spaces only."""
    text = F.trim(_col(c).cast("string"))
    return F.when(text != "", text)


def _strip_digit_underscores(x: Column) -> Column:
    return F.when(F.instr(x, "_") > 0,
                  F.regexp_replace(x, DIGIT_UNDERSCORE, "")).otherwise(x)


def _ascii(x: Column, then: Column | None = None) -> Column:
    """The text (or ``then``) if it is plain ASCII (other scripts' digits are no numbers)."""
    return F.when(F.octet_length(x) == F.char_length(x), x if then is None else then)


def _char(x: Column, at: int) -> Column:
    return F.substring(x, at, 1)


def _is_digit(c: Column) -> Column:
    return (c >= "0") & (c <= "9")


def _same_separators(x: Column) -> Column:
    """``yyyy-mm-dd`` or ``yyyy/mm/dd`` in front, as far as its separators tell."""
    return _char(x, 5).isin("-", "/") & (_char(x, 8) == _char(x, 5))


def to_decimal(c, precision: int = 18, scale: int = 2) -> Column:
    """Text to decimal(p,s); half-away rounding, overflow and junk to NULL."""
    x = _col(c)
    return _ascii(x, _strip_digit_underscores(x)).try_cast(f"decimal({precision},{scale})")


def to_bigint(c) -> Column:
    """Text to bigint the forgiving way: ``'12.5'`` -> 13, ``'1e3'`` -> 1000,
    ``'1_000'`` -> 1000, ``'0x10'`` -> 16; anything else unparsable -> NULL.
    Rounded once: a plain decimal by its first digit behind the point."""
    given = _col(c)
    x = _ascii(given)
    plain = _ascii(given, _strip_digit_underscores(given))
    whole = F.coalesce(F.nullif(F.regexp_extract(plain, PLAIN_DECIMAL, 2), F.lit("")), F.lit("0")).try_cast("decimal(38,0)")
    up = F.when(F.regexp_extract(plain, PLAIN_DECIMAL, 3) >= "5", F.lit(1)).otherwise(F.lit(0))
    size = whole + up
    rounded = F.when(F.regexp_extract(plain, PLAIN_DECIMAL, 1) == "-", -size).otherwise(size).try_cast("bigint")
    # a failed cast to decimal is an exception inside: other texts don't come that far
    via_decimal = F.when(plain.rlike(DECIMAL_SHAPE), F.round(plain.try_cast("decimal(38,18)")).try_cast("bigint"))
    hex_value = F.conv(F.regexp_extract(x, r"0[xX]([0-9a-fA-F]+)", 1), 16, 10).try_cast("bigint")
    return (F.when(given.rlike(PLAIN_INTEGER), given.try_cast("bigint"))
            .when(x.rlike(HEX_INTEGER), hex_value)
            .when(plain.rlike(PLAIN_DECIMAL), rounded)
            .otherwise(via_decimal))


def to_int(c) -> Column:
    """Same rules as :func:`to_bigint`, NULL outside the 32-bit range."""
    return to_bigint(c).try_cast("int")


def _with_time(x: Column) -> Column:
    """Timestamp from a date-and-time text (NULL if the clock is invalid);
    ``24:00`` is midnight of the next day."""
    regular = F.regexp_replace(x, WITH_TIME, "$1-$3-$4 $5:$6$7$8").try_cast("timestamp_ntz")
    next_day = (F.regexp_replace(x, MIDNIGHT_24, "$1-$3-$4").try_cast("date")
                + F.lit(1)).cast("timestamp_ntz")
    return F.coalesce(regular, F.when(x.rlike(MIDNIGHT_24), next_day))


def to_timestamp_ntz(c) -> Column:
    """Text to timestamp without zone.  Accepts slash/space dates, a missing
    time, a trailing zone (ignored) and ``24:00[:00]`` as next-day midnight."""
    x = _col(c)
    seconds = ((F.octet_length(x) == 19) & _same_separators(x) & _char(x, 11).isin(" ", "T")
               & (_char(x, 14) == ":") & (_char(x, 17) == ":") & _is_digit(_char(x, 19)))
    return F.coalesce(
        F.when(seconds, F.replace(x, F.lit("/"), F.lit("-")).try_cast("timestamp_ntz")),
        F.when(x.rlike(CANONICAL_TS), x.try_cast("timestamp_ntz"))
        .when(x.rlike(WITH_TIME), _with_time(x))
        .when(x.rlike(BARE_DATE),
              F.regexp_replace(x, BARE_DATE, "$1-$3-$4").try_cast("timestamp_ntz")))


def to_date(c) -> Column:
    """Text to date.  A time part, when present, must itself be valid (as in
    the reference database), but only the calendar day is kept."""
    x = _col(c)
    day_of_time = F.regexp_replace(x, WITH_TIME, "$1-$3-$4").try_cast("date")
    canonical = (F.octet_length(x) == 10) & _same_separators(x) & _is_digit(_char(x, 10))
    return (F.when(canonical, F.replace(x, F.lit("/"), F.lit("-")).try_cast("date"))
            .when(x.rlike(BARE_DATE_BLANKS),
                  F.regexp_replace(x, BARE_DATE_BLANKS, "$1-$3-$4").try_cast("date"))
            .when(x.rlike(WITH_TIME), F.when(_with_time(x).isNotNull(), day_of_time)))


def to_typed(c, type_name: str, cleaned: bool = False) -> Column:
    """Dispatch used by the column specs of the Silver models: clean the text
    (unless ``cleaned``), then apply the lenient cast for ``type_name``."""
    t = type_name.lower().replace(" ", "")
    x = _col(c) if cleaned else clean_text(c)
    if t in ("string", "varchar"):
        return x
    if t.startswith("decimal"):
        p, s = t[len("decimal("):-1].split(",")
        return to_decimal(x, int(p), int(s))
    if t in ("bigint", "long"):
        return to_bigint(x)
    if t in ("int", "integer"):
        return to_int(x)
    if t == "date":
        return to_date(x)
    if t in ("timestamp", "timestamp_ntz"):
        return to_timestamp_ntz(x)
    raise ValueError(f"unsupported Silver type: {type_name}")
