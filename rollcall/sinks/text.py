"""Pipe-separated text and search documents."""

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall.labels import DOCUMENT_TYPE, MISSING

_KEEP_NULLS = {"ignoreNullFields": "false"}
_NESTED = (T.ArrayType, T.StructType, T.MapType)


def as_text(df: DataFrame) -> DataFrame:
    """Nested columns written out as JSON text."""
    nested = [f.name for f in df.schema if isinstance(f.dataType, _NESTED)]
    return df.withColumns({c: F.to_json(c, _KEEP_NULLS) for c in nested}) if nested else df


def write_pipe_csv(
    df: DataFrame, path: str, mode: str = "overwrite", compression: str = "none"
) -> None:
    """Pipe-separated text with a header and doubled quotes; missing values are empty.

    Files that repeat long lists take a fraction of the disk with ``compression``; the same text
    is in them, and readers unpack it by their names.  A compressed file is read by one task.
    """
    (
        as_text(df)
        .write.mode(mode)
        .option("header", True)
        .option("sep", "|")
        .option("escape", '"')
        .option("compression", compression)
        .option("nullValue", "")
        .option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def action_line(index: str, doc_type: str = DOCUMENT_TYPE) -> str:
    return json.dumps({"index": {"_index": index, "_type": doc_type}})


def document_id(keys: list[str]) -> Column:
    """A fixed id of the values of ``keys``, missing ones as empty texts."""
    values = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]
    return F.substring(F.sha2(F.concat_ws("\x1f", *values).cast("binary"), 256), 1, 32)


def bulk_lines(
    df: DataFrame, index: str, doc_type: str = DOCUMENT_TYPE, keys: list[str] | None = None
) -> DataFrame:
    """One row per document: the index action, a line break, the row as JSON.

    With ``keys`` the action names the document by them, so that a repeated load replaces it;
    otherwise the index gives a new name, and a repeated load doubles it.
    """
    document = F.to_json(F.struct("*"), _KEEP_NULLS)
    action = F.lit(action_line(index, doc_type))
    if keys:
        action = F.concat(
            F.lit(action_line(index, doc_type)[:-2] + ', "_id": "'), document_id(keys), F.lit('"}}')
        )
    return df.select(F.concat_ws("\n", action, document).alias("value"))


def write_documents(
    lines: DataFrame, path: str, mode: str = "overwrite", max_bytes: int | None = None
) -> None:
    """Write bulk lines as text files, of at most ``max_bytes`` if that is given.

    The bound holds for every file: files have as many documents as fit if all are as long as
    the longest.  Only a document that is longer by itself has a longer file, its own.
    """
    writer = lines.write.mode(mode)
    if max_bytes:
        longest = lines.agg(F.max(F.octet_length("value"))).first()[0]
        # A line break behind each row.
        writer = writer.option("maxRecordsPerFile", max(1, max_bytes // ((longest or 0) + 1)))
    writer.text(path)


def without_missing_text(c: Column, data_type: T.DataType) -> Column:
    """The missing-value text as a JSON null wherever it occurs inside a nested value."""
    if isinstance(data_type, T.ArrayType):
        return F.transform(c, lambda x: without_missing_text(x, data_type.elementType))
    if isinstance(data_type, T.StructType):
        return F.struct(
            *[without_missing_text(c[f.name], f.dataType).alias(f.name) for f in data_type]
        )
    if isinstance(data_type, T.StringType):
        return F.nullif(c, F.lit(MISSING))
    return c


def nested_nulls(df: DataFrame) -> DataFrame:
    """Nested columns with their missing-value texts turned into nulls."""
    return df.withColumns(
        {
            f.name: without_missing_text(F.col(f.name), f.dataType)
            for f in df.schema
            if isinstance(f.dataType, _NESTED)
        }
    )
