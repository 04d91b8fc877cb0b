"""Cleaners that depend on a beneficiary's age."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from rollcall.functions.text import strip_quotes
from rollcall.labels import AGE_LABELS

ADULT_AGE = 18


#: Eight digits that can be a date; the cast then settles the length of the month.
_DATE = r"^(?!0000)[0-9]{4}(0[1-9]|1[0-2])(0[1-9]|[12][0-9]|3[01])$"


def birth_number(c: Column) -> Column:
    """A birth date written ``yyyyMMdd`` as that number; null unless it is a date."""
    text = strip_quotes(c)
    parts = [F.substring(text, start, size) for start, size in ((1, 4), (5, 2), (7, 2))]
    day = F.concat_ws("-", *parts).try_cast("date")
    return F.when(text.rlike(_DATE) & day.isNotNull(), text.try_cast("int"))


def age_at_month(born: Column, year: Column, month: Column) -> Column:
    """Completed years on the first day of ``month``; null for any invalid part.

    ``born`` is a ``birth_number``.  Both days being numbers of the form ``yyyyMMdd``, the
    completed years are the whole ten thousands between them.  Future births are negative.
    """
    today = year * 10000 + month * 100 + 1
    age = F.floor((today - born) / 10000).cast("int")
    return F.when(month.between(1, 12) & year.between(1, 9999), age)


def age_band(age: Column, labels: dict[str, str] = AGE_LABELS) -> Column:
    """Age group name; null age has none, negative ages count as infants."""
    return (
        F.when(age <= 11, labels["infant"])
        .when(age <= 18, labels["teen"])
        .when(age <= 29, labels["young"])
        .when(age <= 60, labels["adult"])
        .when(age > 60, labels["senior"])
    )


def mask_minor_name(name: Column, age: Column) -> Column:
    """Hide the names of minors; unknown age keeps the name."""
    return F.when(F.coalesce(age >= ADULT_AGE, F.lit(True)), name)
