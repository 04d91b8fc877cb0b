"""Array-valued expressions."""

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from rollcall.labels import FOCUS_GROUPS


def dummy_label(column: str, prefix: str, labels: dict[str, str]) -> str:
    """Label of an indicator column: its name without the prefix, codes spelled out."""
    return reduce(
        lambda text, pair: text.replace(*pair), labels.items(), column.removeprefix(prefix)
    )


def dummies_to_array(columns: Iterable[str], prefix: str, labels: dict[str, str]) -> Column:
    """Labels of the indicator columns that are not zero, in column order.

    Only a zero means absent: a missing indicator counts as present.  Computed row by row,
    so it needs no melt, pivot or join.
    """
    marks = [
        F.when(~F.col(c).eqNullSafe(F.lit(0)), dummy_label(c, prefix, labels))
        for c in columns
        if c.startswith(prefix)
    ]
    return F.array_compact(F.array(*marks))


def without_blanks(items: Column) -> Column:
    return F.filter(items, lambda x: x != "")


def parse_list(c: Column) -> Column:
    """Text list literal -> array without blanks; missing text is the empty list."""
    parsed = F.from_json(c, "array<string>")
    return F.coalesce(without_blanks(parsed), F.array().cast("array<string>"))


def list_text(items: Column) -> Column:
    """Array -> text list literal."""
    return F.to_json(items)


def focus_group(code: Column) -> Column:
    """Vulnerable group a criterion code stands for; other codes lose their digits."""
    group = F
    for name, codes in FOCUS_GROUPS.items():
        group = group.when(code.isin(codes), name)
    unlisted = F.translate(code.cast("string"), "-0123456789", " ")
    return group.otherwise(F.coalesce(unlisted, F.lit("")))
