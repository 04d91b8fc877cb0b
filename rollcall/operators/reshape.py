"""Whole-table reshaping and filling."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall.functions.text import scrub_text, strip_quotes, trim_text
from rollcall.labels import MISSING


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


def _each_string(df, clean):
    return df.withColumns({c: clean(F.col(c)) for c in string_columns(df)})


def trim_strings(df: DataFrame, *names: str) -> DataFrame:
    """Trim the named columns, missing values left missing."""
    return df.withColumns(
        {c: F.when(F.col(c).isNotNull(), trim_text(F.col(c))) for c in names}
    )


def scrub_columns(df: DataFrame) -> DataFrame:
    """Remove quotes and no-break spaces from all text columns."""
    return _each_string(df, scrub_text)


def scrub_quotes_columns(df: DataFrame) -> DataFrame:
    """Remove quotes from all text columns."""
    return _each_string(df, strip_quotes)


def typed_fill(df: DataFrame) -> DataFrame:
    """Missing text becomes the missing-value text, missing numbers 0; fractions are cut."""
    filled = df.fillna(MISSING, subset=string_columns(df))
    numbers = {}
    for field in df.schema:
        if isinstance(field.dataType, T.NumericType):
            value = F.coalesce(F.col(field.name), F.lit(0).cast(field.dataType))
            if isinstance(field.dataType, (T.FractionalType, T.DecimalType)):
                value = value.try_cast("bigint")
            numbers[field.name] = value
    return filled.withColumns(numbers) if numbers else filled


def unpivot(df: DataFrame, prefix: str, ids: list[str], key: str, value: str) -> DataFrame:
    """Wide -> long: one row per id and column whose name starts with ``prefix``."""
    wide = [c for c in df.columns if c.startswith(prefix)]
    return df.unpivot(ids, wide, key, value)


def pivot_back(
    df: DataFrame, ids: list[str], key: str, value: str, labels: list[str]
) -> DataFrame:
    """Long -> wide: the inverse, for the named labels (named, so no job looks them up)."""
    return df.groupBy(*ids).pivot(key, labels).agg(F.first(value))


def dummy_sums(df: DataFrame, key: str, prefix: str) -> DataFrame:
    """Sums of the indicator columns per key."""
    marks = [c for c in df.columns if c.startswith(prefix)]
    return df.groupBy(key).agg(*[F.sum(c).alias(c) for c in marks])
