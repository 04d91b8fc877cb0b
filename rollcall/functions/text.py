"""Text and number cleaners."""

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from rollcall.labels import KEYWORD_LIMIT, MISSING


#: Unicode white space and the four ASCII separators.
_BLANK = r"(?U:[\s\x1c-\x1f])"


def trim_text(c: Column) -> Column:
    """Strip surrounding whitespace; missing becomes the empty string."""
    return F.coalesce(F.regexp_replace(c, f"^{_BLANK}+|{_BLANK}+$", ""), F.lit(""))


def strip_quotes(c: Column) -> Column:
    """Remove every double quote; missing stays missing."""
    return F.replace(c, F.lit('"'), F.lit(""))


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with the value worked out once however often it is used.

    Spark does not fuse a projection with such an expression into the one method of its stage.
    Wide layers of cleaners are then many small methods, which the JVM compiles; a method of more
    than 8,000 bytes it interprets.
    """
    return F.transform(F.array(value), use)[0]


#: Text of a whole number of up to nineteen digits.
_WHOLE = r"^\s*[+-]?0*[0-9]{1,19}\s*$"


def clean_int(c: Column) -> Column:
    """Whole number written as text, quotes and outer blanks allowed; anything else is null.

    The text is checked before the cast, as a failing cast costs far more than the check.
    Numbers beyond 32 bits are null.
    """
    return once(
        clean_long(c), lambda n: F.when(n.between(-(2**31), 2**31 - 1), n.cast("int"))
    )


def clean_long(c: Column) -> Column:
    """As ``clean_int``, for 64-bit numbers; numbers beyond are null."""
    text = strip_quotes(c)
    return F.when(text.rlike(_WHOLE), text.try_cast("bigint"))


def short_code(c: Column, last: int, width: int) -> Column:
    """A whole number from 1 to ``last``, zero-padded to ``width``; else null."""
    return once(
        clean_long(c),
        lambda n: F.when(n.between(1, last), F.lpad(n.cast("string"), width, "0")),
    )


def number_text(c: Column) -> Column:
    """``'2017.0'`` -> ``'2017'``: numeric text with its fraction cut off."""
    return c.try_cast("double").try_cast("bigint").cast("string")


def left_pad(c: Column, width: int) -> Column:
    """Zero-pad to ``width`` without cutting longer values."""
    text = c.cast("string")
    return F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, "0"))


def pad_state(c: Column) -> Column:
    """Two-digit state code; missing or zero becomes the missing-value text."""
    code = F.coalesce(c.try_cast("double").try_cast("bigint"), F.lit(0))
    return F.when(code == 0, MISSING).otherwise(left_pad(code, 2))


def scrub_text(c: Column) -> Column:
    """Remove double quotes and turn no-break spaces into spaces."""
    return F.replace(strip_quotes(c), F.lit("\u00a0"), F.lit(" "))


def blank_missing(c: Column) -> Column:
    """Turn the missing-value text back into the empty string."""
    return F.when(c == MISSING, "").otherwise(c)


def keyword_field(c: Column, limit: int = KEYWORD_LIMIT) -> Column:
    """Exact-match copy of a text field, present only up to ``limit`` characters."""
    return F.when(F.char_length(c) <= limit, c)
