"""Joins of large tables to dimensions."""

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Largest measured payload of a side that is sent to every executor.
BROADCAST_BYTES = 64 << 20
_FIELD_OVERHEAD = 16
#: Keys that one key of a large dimension is spread over.
SALTS = 64
_SALT = "_salt"
#: Most bytes of a dimension row's joined rows that ``wide_lookup`` leaves to a task.
JOINED_BYTES = 512 << 20
_ROW, _SLOT, _FIRST, _PARTS = "_row", "_slot", "_first", "_parts"


def _width(df: DataFrame) -> Column:
    """Bytes of a row's values."""
    return sum(
        (
            F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) + _FIELD_OVERHEAD
            for c in df.columns
        ),
        F.lit(0),
    ).cast("bigint")


def payload_bytes(df: DataFrame) -> int:
    """Measured size of a table's values, by one aggregate over it."""
    return df.agg(F.sum(_width(df))).first()[0] or 0


def given_lookup(
    df: DataFrame, dim: DataFrame, on: list[str], max_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Left join to a given dimension on equally named keys; repeated dimension keys fan out."""
    return given_lookups(df, [(dim, on)], max_bytes)


def given_lookups(
    df: DataFrame, dims: list[tuple[DataFrame, list[str]]], max_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Left joins to given dimensions, each on equally named keys of ``df``.

    A dimension, a given table that costs one short aggregate, is measured.  Up to ``max_bytes``
    it is broadcast, and ``df`` is not shuffled.  A larger one is merged: ``df`` is shuffled by its
    keys, with the columns that are used later and no others, and adaptive execution splits the
    partitions a hot or missing key fills.  Several larger ones are met together by
    ``spread_lookup``.  Small ones come last, so that what they add is not shuffled.
    """
    small = [(dim, on, payload_bytes(dim) <= max_bytes) for dim, on in dims]
    large = [(dim, on) for dim, on, fits in small if not fits]
    if len(large) == 1:
        df = df.join(large[0][0].hint("merge"), large[0][1], "left")
    elif large:
        df = spread_lookup(df, large)
    for dim, on, fits in small:
        if fits:
            df = df.join(F.broadcast(dim), on, "left")
    return df


def spread_lookup(df: DataFrame, dims: list[tuple[DataFrame, list[str]]]) -> DataFrame:
    """Left joins of a wide table to large dimensions, with one shuffle of its rows for all.

    A narrow table of the distinct keys meets the dimensions one after another; then the rows
    meet its answers once.  Keys are spread by a salt of each row's own values, so a key with
    much of the rows is ``SALTS`` keys, none of them met by one task alone.  The dimensions are
    merged, never broadcast: Spark estimates one that explodes its rows by what it explodes.
    """
    keys = list(dict.fromkeys(k for _, on in dims for k in on))
    salt = F.pmod(F.xxhash64(*df.columns), F.lit(SALTS)).cast("int")
    salted = df.withColumn(_SALT, salt)
    met = salted.select(*keys, _SALT).distinct()
    for dim, on in dims:
        met = met.join(dim.hint("merge"), on, "left")
    answers = met.withColumnsRenamed({k: f"{_SALT}_{k}" for k in [*keys, _SALT]})
    same = reduce(and_, (salted[k].eqNullSafe(answers[f"{_SALT}_{k}"]) for k in [*keys, _SALT]))
    joined = salted.join(answers, same, "left")
    return joined.drop(_SALT, *[f"{_SALT}_{k}" for k in [*keys, _SALT]])


def left_lookup(df: DataFrame, dim: DataFrame, on: list[str]) -> DataFrame:
    """Left join to a derived dimension on equally named keys.

    Nothing is run to plan it: adaptive execution broadcasts the dimension if its shuffled
    size allows it, and splits the partitions of ``df`` that a hot key fills by their sizes.
    """
    return df.join(dim, on, "left")


def wide_lookup(
    df: DataFrame, dim: DataFrame, on: list[str], max_bytes: int = JOINED_BYTES
) -> DataFrame:
    """Left join to a dimension with very wide rows, which many rows of ``df`` repeat.

    The joined rows hold a dimension row once for each row of its key.  Dimension rows that take
    more than ``max_bytes`` so are measured first, at most one for each ``max_bytes`` of the result.
    The rows of ``df`` that meet one, still narrow, are dealt to tasks of about ``max_bytes`` of
    joined rows, and no task gets two such dimension rows: a columnar file of its rows keeps a
    repeated value once, as long as its dictionary takes that value.  Such dimension rows are
    broadcast up to ``BROADCAST_BYTES``, else sent to each of their tasks.  All others are joined
    plainly.  Both sides are read several times, so the caller gives written tables.
    """
    known = dim.withColumn(_ROW, F.xxhash64(*dim.columns))
    rows = df.groupBy(*on).agg(F.count(F.lit(1)).alias("_rows"))
    widths = known.groupBy(*on, _ROW).agg(F.sum(_width(dim)).alias("_bytes"))
    joined = F.col("_rows").cast("double") * F.col("_bytes")
    hot = widths.join(rows, on).where(joined > max_bytes).collect()
    if not hot:
        return left_lookup(df, dim, on)
    slots, total = [], 0
    for r in sorted(hot, key=lambda r: (*(str(r[c]) for c in on), r[_ROW])):
        parts = min(r["_rows"], -(-r["_rows"] * r["_bytes"] // max_bytes))
        slots.append((*(r[c] for c in on), r[_ROW], total, parts))
        total += parts
    types = [f"`{c}` {df.schema[c].dataType.simpleString()}" for c in on]
    schema = ", ".join([*types, f"{_ROW} bigint", f"{_FIRST} int", f"{_PARTS} int"])
    dealt = F.broadcast(df.sparkSession.createDataFrame(slots, schema))
    keys = F.broadcast(dealt.select(*on).distinct())
    place = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.col(_PARTS)).cast("int")
    mine = df.join(dealt, on).withColumn(_SLOT, F.col(_FIRST) + place).drop(_FIRST, _PARTS)
    mine = mine.repartitionById(total, F.col(_SLOT))
    wide = known.join(dealt, [*on, _ROW])
    if sum(r["_bytes"] for r in hot) <= BROADCAST_BYTES:
        met = mine.join(F.broadcast(wide.drop(_FIRST, _PARTS)), [*on, _ROW])
    else:
        places = F.sequence(F.col(_FIRST), F.col(_FIRST) + F.col(_PARTS) - 1)
        copies = wide.withColumn(_SLOT, F.explode(places)).drop(_FIRST, _PARTS)
        copies = copies.repartitionById(total, F.col(_SLOT))
        met = mine.join(copies.hint("merge"), [*on, _ROW, _SLOT])
    narrow = known.join(keys, on, "left_semi").join(dealt, [*on, _ROW], "left_anti").drop(_ROW)
    light = df.join(keys, on, "left_semi").join(narrow, on)
    others = left_lookup(df.join(keys, on, "left_anti"), dim, on)
    return others.unionByName(light).unionByName(met.drop(_ROW, _SLOT))


def membership(df: DataFrame, keys: DataFrame, on: list[str], flag: str) -> DataFrame:
    """Add ``flag``: 1 where the row's key is among ``keys``, else 0."""
    known = keys.select(*on).dropna().distinct().withColumn(flag, F.lit(1))
    return left_lookup(df, known, on).withColumn(flag, F.coalesce(F.col(flag), F.lit(0)))


def without_match(df: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """Anti join: the rows whose key is not among ``keys``; a missing key never is."""
    return df.join(keys.select(*on).dropna().distinct(), on, "left_anti")


def outer_lookup(
    df: DataFrame, dim: DataFrame, on: list[str], max_bytes: int | None = None
) -> DataFrame:
    """Full outer join of a table with hot keys to a dimension without them.

    A full outer join can be neither broadcast nor split by key, so it is taken apart: every
    row of ``df`` with its dimension rows, then the dimension rows no row of ``df`` has.  Both
    sides are read twice, so the caller gives written tables.  With ``max_bytes`` the dimension
    has very wide rows and is met by ``wide_lookup``.
    """
    met = wide_lookup(df, dim, on, max_bytes) if max_bytes else left_lookup(df, dim, on)
    return met.unionByName(without_match(dim, df, on), allowMissingColumns=True)
