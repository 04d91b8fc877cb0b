"""Grouping of rows into list columns."""

from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F

#: Shares by hash of a key's distinct entries; each is sorted by itself.
SHARES = 64
#: Partitions that mostly distinct entries are dealt to; adaptive execution puts small ones together.
PARTS = 1024
#: Counts that the copies of a mostly distinct entry are spread over.
SALTS = 16
_COPIES, _SHARE, _SALT = "_copies", "_share", "_salt"


def dealt_by(df: DataFrame, *names: str) -> DataFrame:
    """Rows dealt by ``names`` to ``PARTS`` partitions, whatever the session's number is.

    Partitions are put together up to the session's advisory size, so a task's memory does not
    grow with the input until there are ``PARTS`` of that size.  Runs no job.
    """
    return df.hint("rebalance", PARTS, *[F.col(n) for n in names])


def _grouped(df: DataFrame, distinct: bool, *names: str) -> GroupedData:
    return (dealt_by(df, *names) if distinct else df).groupBy(*names)


def nest(
    df: DataFrame,
    keys: list[str],
    lists: dict[str, Column],
    least: dict[str, Column] | None = None,
    distinct: bool = False,
) -> DataFrame:
    """One row per key with each of ``lists`` gathered, copies included, nulls left out, sorted.

    ``least`` adds the smallest value of an expression in each group.  Three fixed steps, at every
    size: equal entries of a key are counted, with partial counts before a shuffle by key and
    entry; the distinct entries of each key are sorted in ``SHARES`` shares by hash, each a group
    of its own; then the sorted shares of each key are merged and every entry is written out as
    often as it was counted.  So neither a hot key nor a hot entry is sorted, or expanded, before
    the last step, which only merges.  A list is one value of one row: that step needs room for
    the longest list.  Rows of one entry each are the operators' inputs themselves.

    ``distinct`` says that entries are mostly distinct, copies allowed: counting them before the
    shuffle would only hold them all in memory.  They are dealt first (``dealt_by``) in every step.
    """
    extra = list(least or {})
    runs = sorted_shares(df, keys, lists, least, distinct)
    return _grouped(runs, distinct, *keys).agg(
        *[_merged(name).alias(name) for name in lists], *[F.min(name).alias(name) for name in extra]
    )


def sorted_shares(
    df: DataFrame,
    keys: list[str],
    lists: dict[str, Column],
    least: dict[str, Column] | None = None,
    distinct: bool = False,
) -> DataFrame:
    """For each key and share, the sorted distinct entries of each list with their counts.

    With ``distinct`` an entry may come up to ``SALTS`` times, with a count each: no task gets all
    copies of a hot entry.
    """
    extra = least or {}
    salts = [_SALT] if distinct else []
    entries = df.select(
        *keys, *[c.alias(name) for name, c in lists.items()], *[c.alias(name) for name, c in extra.items()]
    )
    salted = entries.withColumns({name: F.spark_partition_id() % SALTS for name in salts})
    counted = _grouped(salted, distinct, *keys, *lists, *salts).agg(
        F.count(F.lit(1)).alias(_COPIES), *[F.min(name).alias(name) for name in extra]
    )
    share = F.pmod(F.xxhash64(*lists), F.lit(SHARES)).cast("int")
    return _grouped(counted.withColumn(_SHARE, share), distinct, *keys, _SHARE).agg(
        *[_sorted(name).alias(name) for name in lists], *[F.min(name).alias(name) for name in extra]
    )


def _sorted(name: str) -> Column:
    """The entries of a share that are not null, with their counts, in order."""
    pair = F.struct(F.col(name).alias("entry"), F.col(_COPIES).cast("int").alias("n"))
    return F.sort_array(F.collect_list(F.when(F.col(name).isNotNull(), pair)))


def _merged(name: str) -> Column:
    """The shares of a list as one, each entry as often as it was counted.

    Sorting finds the runs that are in order already and merges them.
    """
    pairs = F.sort_array(F.flatten(F.collect_list(name)))
    return F.flatten(F.transform(pairs, lambda x: F.array_repeat(x["entry"], x["n"])))
