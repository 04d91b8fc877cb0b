"""Composite keys."""

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from rollcall.labels import NO_BENEFIT, SHARED_BUDGET_CODE, STATE_ABBREVIATIONS


def _printed(c: Column) -> Column:
    """Missing key parts are written out as ``None``."""
    return F.coalesce(c.cast("string"), F.lit("None"))


def program_type_key(program: Column, register: Column, benefit: Column) -> Column:
    """``programme_register_benefit``."""
    kind = F.when(F.length(benefit) > 0, benefit).otherwise(NO_BENEFIT)
    return F.concat_ws("_", _printed(program), _printed(register), kind)


def unified_id(
    origin: Column, agency: Column, program: Column, register: Column, year: Column
) -> Column:
    """``origin-agency-programme-register-year``, the key of the programme catalogue."""
    return F.concat_ws("-", *[_printed(c) for c in (origin, agency, program, register, year)])


def level_key(level: Column, budget_key: Column, folio: Column) -> Column:
    """Federal programmes go by budget key, state ones by survey folio, others by nothing."""
    return F.coalesce(F.when(level == 1, budget_key).when(level == 2, folio), F.lit(""))


def own_key_if_shared(key: Column, folio: Column) -> Column:
    """Budget keys shared by many programmes give way to the folio."""
    return F.when(key.contains(SHARED_BUDGET_CODE), folio).otherwise(key)


def own_key_if_blank(key: Column, folio: Column) -> Column:
    return F.coalesce(F.nullif(key, F.lit("")), folio)


def abbreviate_states(c: Column) -> Column:
    """Shorten the state names the two key systems spell differently."""
    return reduce(
        lambda text, pair: F.replace(text, F.lit(pair[0]), F.lit(pair[1])),
        STATE_ABBREVIATIONS.items(),
        c,
    )
