"""Cleaners for the registry's coded fields."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from rollcall.functions.text import clean_int, short_code, strip_quotes
from rollcall.labels import BENEFIT_NAMES, GOVERNMENT_LEVELS, NO_BENEFIT, OTHER_BENEFIT

#: Greatest code of each kind; they begin at 1.
STATES, MUNICIPALITIES, LOCALITIES = 32, 998, 9998


def state_code(c: Column) -> Column:
    """Two-digit state code, or null outside 1..32."""
    return short_code(c, STATES, 2)


def muni_code(muni: Column, state: Column) -> Column:
    """State and municipality as one five-digit code, or null when either is out of range."""
    return muni_in_state(muni, state_code(state))


def muni_in_state(muni: Column, code: Column) -> Column:
    """As ``muni_code``, for a state code that is clean already."""
    return F.concat(code, short_code(muni, MUNICIPALITIES, 3))


def loc_code(c: Column) -> Column:
    """Four-digit locality code, or null outside 1..9998."""
    return short_code(c, LOCALITIES, 4)


def gender_code(c: Column) -> Column:
    """``H`` or ``M`` by the first of the two letters looked for; null otherwise."""
    return F.when(c.contains("H"), "H").when(c.contains("M"), "M")


def origin_code(c: Column, missing: str | None = "F") -> Column:
    """``F``ederal or ``E``statal; a missing origin counts as ``missing``."""
    return (
        F.when(c.isNull(), F.lit(missing))
        .when(c.contains("F"), "F")
        .when(c.contains("E"), "E")
    )


def period_month(period: Column) -> Column:
    """Month held by the third character of the period: a digit, or a/b/c for 10/11/12."""
    mark = F.lower(F.substring(strip_quotes(period), 3, 1))
    place = F.instr(F.lit("0123456789abc"), mark)
    return F.when((F.length(mark) == 1) & (place > 0), place - 1)


def pay_month(raw: Column, month: Column) -> Column:
    """The corresponding month, where the raw payment month is a non-zero number."""
    paid = strip_quotes(raw).rlike(r"^\s*[+-]?0*[1-9][0-9]*\s*$")
    return F.when(paid & month.between(1, 12), month)


def pay_month_own(raw: Column) -> Column:
    """The payment month's own value, where it is a calendar month."""
    n = clean_int(raw)
    return F.when(n.between(1, 12), n)


def benefit_name(
    c: Column, other: str | None = OTHER_BENEFIT, missing: str | None = NO_BENEFIT
) -> Column:
    """Name of a benefit type; ``other`` for unlisted numbers, ``missing`` for non-numbers."""
    text = strip_quotes(c)
    names = F.create_map(*[F.lit(x) for pair in BENEFIT_NAMES.items() for x in pair])
    digit = F.regexp_extract(text, r"^\s*\+?0*([0-9])\s*$", 1)
    unnamed = F.when(text.rlike(r"^\s*[+-]?[0-9]+\s*$"), F.lit(other)).otherwise(F.lit(missing))
    return F.coalesce(F.element_at(names, F.nullif(digit, F.lit("")).cast("int")), unnamed)


def gov_level(c: Column) -> Column:
    """Name of the level of government; unlisted values pass as text."""
    name = F
    for code, label in GOVERNMENT_LEVELS.items():
        name = name.when(c == code, label)
    return name.otherwise(c.cast("string"))
