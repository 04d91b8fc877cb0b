"""Cutting a table into parts by ascending id, so that order needs no single task."""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes of text of a part.
PART_BYTES = 32 << 20
#: Most parts; their lower bounds travel with the tasks.  Only beyond so many do parts grow.
MOST_PARTS = 100_000


def part_bounds(
    df: DataFrame, id_column: str, text: str, parts: int | None = None, part_bytes: int | None = None
) -> list[int]:
    """Ids that cut the table into about equal parts; the first is the smallest.

    Unless given, the number of parts is that of the table's bytes over ``part_bytes`` (else
    ``PART_BYTES``), whatever the session's settings: a part is as large in a large table as in a small one.  The cuts are
    quantiles of the ids, for which only these are read.  No ids give no bounds.
    """
    found = df.agg(
        F.min(id_column).alias("low"), F.sum(F.octet_length(text) + 16).alias("bytes")
    ).first()
    if found.low is None:
        return []
    wanted = parts or min(MOST_PARTS, found.bytes // (part_bytes or PART_BYTES) + 1)
    shares = [i / wanted for i in range(1, wanted)]
    cuts = df.agg(F.percentile_approx(id_column, shares, max(10_000, 10 * wanted))).first()[0] if shares else []
    return sorted({int(found.low), *map(int, cuts or [])})


def part_column(id_column: str, bounds: list[int]) -> Column:
    """The part of an id: 0 up to the number of bounds less 1; null ids lie in the last."""
    lows = np.array(bounds[1:], dtype=np.int64)

    @F.arrow_udf("int")
    def part(ids: pa.Array) -> pa.Array:
        known = ids.fill_null(np.iinfo(np.int64).max).to_numpy(zero_copy_only=False)
        return pa.array(np.searchsorted(lows, known, side="right").astype(np.int32))

    return part(F.col(id_column).cast("bigint"))
