"""Reading given tables, materialising intermediate ones, and column names that never clash."""

import tempfile
import zipfile
from pathlib import Path

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.scratch import materialised

_SHIPPED = set()
#: A frame written as a table in the shared folder and read again.
stored = materialised

#: White space of the contracts, as a character class for Java, Python and DuckDB patterns.
WHITE = r"\x20\x09-\x0D"


def shipped(spark: SparkSession) -> SparkSession:
    """The session with this package on its executors' path, once per application.

    The driver serves the archive to the executors; no shared folder is needed for it.
    """
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        package = Path(__file__).resolve().parents[1]
        archive = f"{tempfile.mkdtemp()}/{package.name}.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for source in sorted(package.rglob("*.py")):
                out.write(source, source.relative_to(package.parent))
        context.addPyFile(archive)
        _SHIPPED.add(context.applicationId)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have, whatever its case."""
    taken, name = {c.lower() for c in df.columns}, base
    while name.lower() in taken:
        name += "_"
    return name


def text_of(column: str) -> Column:
    """A text column with null as the empty text."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def row_number(given: str | None) -> Column:
    """The given column of unique row numbers, or numbers by place in the input."""
    return F.col(given) if given else F.monotonically_increasing_id()


def without_dropped(docs: DataFrame, groups) -> DataFrame:
    """The rows of ``docs`` that ``groups(numbered docs, number column)`` keeps, all columns.

    Rows are numbered once in a written copy, so decisions find their rows even where ids are
    null or repeated.
    """
    row = free_name(docs, "_row")
    numbered = stored(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    dropped = groups(numbered, row).where(~F.col("kept")).select(F.col("_row").alias(row))
    return numbered.join(dropped, row, "left_anti").select(*docs.columns)


def run_number() -> Column:
    """The input partition a row came from: the way hot keys are cut."""
    return F.spark_partition_id().cast("bigint").alias("_run")


def met_by_run(rows: DataFrame, found: DataFrame, keys: list[str]) -> DataFrame:
    """Left join of ``rows`` with a ``_run`` to a table with one row per (non-null) key.

    The keys of each run meet the table first, then the rows their run's answer, so a key
    with a third of all rows is met by as many tasks as there are runs.
    """
    by_run = rows.select(*keys, "_run").distinct().join(found, keys, "left")
    return rows.join(by_run, [*keys, "_run"], "left")


def batches(column, limit: int):
    """Slices ``(start, end)`` of an Arrow text column of about ``limit`` bytes each."""
    start = size = 0
    for i, text in enumerate(column):
        size += len(text.as_buffer()) if text.is_valid else 0
        if size >= limit:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(column):
        yield start, len(column)


def spans(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs in which ``inside`` holds."""
    edge = np.zeros(len(inside) + 1, dtype=bool)
    edge[:-1] = inside
    edge[1:] ^= inside
    found = np.flatnonzero(edge)
    return found[::2], found[1::2]
