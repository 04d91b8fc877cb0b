"""Exact deduplication by a tree of merges over runs of digests."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import WHITE, row_number, run_number, stored, text_of

#: Runs that one merge brings together.
FAN_IN = 16
#: White space that is not yet a single space; the other runs need no replacement.
_UNEVEN = rf"\x20[{WHITE}]+|[\x09-\x0D][{WHITE}]*"
_KEY = ["_digest", "_size", "_sha"]


def normalised(text: str) -> Column:
    """A text column with each run of white space as one space; null is the empty text."""
    return F.regexp_replace(text_of(text), _UNEVEN, " ")


def digest_rows(docs: DataFrame, id_column: str, text: str, row: Column) -> DataFrame:
    """One narrow row per document, written once: its id, a row number, digests, its run.

    A run is the input partition the row came from.  Rows are keyed by a 64-bit digest;
    SHA-256 and length verify it wherever two entries meet.
    """
    narrow = docs.select(
        F.col(id_column).alias("_id"), row.alias("_row"), normalised(text).alias("_text")
    )
    return stored(
        narrow.select(
            "_id",
            "_row",
            F.xxhash64("_text").alias("_digest"),
            F.octet_length("_text").alias("_size"),
            F.unhex(F.sha2(F.col("_text").cast("binary"), 256)).alias("_sha"),
            run_number(),
        ),
        "digests",
    )


def sorted_runs(rows: DataFrame, slices: int) -> DataFrame:
    """The leaves of the merge tree: each run's distinct texts in order of digest, written.

    An entry holds the smallest (id, row) of its text in the run and the number of its rows.
    Slices by digest let a long run be many tasks' work.
    """
    own = rows.withColumn("_slice", F.pmod("_digest", F.lit(slices)))
    return stored(
        own.groupBy("_run", "_slice", *_KEY).agg(
            F.min(F.struct(F.isnull("_id").alias("none"), "_id", "_row")).alias("_first"),
            F.count(F.lit(1)).alias("_n"),
        ),
        "run",
    )


def merge_round(level: DataFrame, fan_in: int) -> DataFrame:
    """One level of the tree: ``fan_in`` neighbouring runs become one, in order of digest again.

    The runs of a slice meet in one exchange and are merged in order; where digest, length and
    SHA-256 agree the smaller identifier stays.  A run has a text once, so however often it
    occurs a merge meets at most ``fan_in`` rows of it.
    """
    upper = level.withColumn("_run", F.floor(F.col("_run") / fan_in)).repartition("_run", "_slice")
    in_order = upper.sortWithinPartitions("_run", "_slice", *_KEY)
    return in_order.groupBy("_run", "_slice", *_KEY).agg(
        F.min("_first").alias("_first"), F.sum("_n").alias("_n")
    )


def merged_runs(leaves: DataFrame, runs: int, fan_in: int = FAN_IN) -> DataFrame:
    """The merge tree: per text the smallest (id, row) and the number of rows.

    A round of ``fan_in`` 16 does what four binomial rounds of pairs do; each level's runs are
    written in order of digest, so a lost executor repeats at most a round.  Slices by digest
    spread the last round like the first.
    """
    level = leaves
    while runs > 1:
        runs = -(-runs // fan_in)
        level = stored(merge_round(level, fan_in), "run")
    return level.drop("_run", "_slice")


def exact_groups(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    row: str | None = None,
    fan_in: int = FAN_IN,
) -> DataFrame:
    """One row per document: ``_row``, id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Equal texts form a group; its row with the smallest id stays.  Rows with the same id and
    text are ordered by their place in the input (or the unique numbers in ``row``), so exactly
    one row of each group is kept.  A null id comes after all others; a group of null ids has a
    null ``keep_id``.  Null and empty texts are equal, and equal to no other.  Texts of any length
    are read whole, ids may have any type that has an order.  An empty table gives an empty
    result; other columns, whatever their names, do not matter.
    """
    rows = digest_rows(docs, id_column, text, row_number(row))
    last = rows.agg(F.max("_run")).first()[0]
    runs = 1 if last is None else last + 1
    leaves = sorted_runs(rows, runs)
    top = merged_runs(leaves, runs, fan_in)
    # Down again in two steps: a frequent text meets the result once per run, then its rows
    # meet it run by run.
    by_run = leaves.select(*_KEY, "_run").join(top, _KEY)
    return rows.join(by_run, [*_KEY, "_run"]).select(
        "_row",
        F.col("_id").alias(id_column),
        F.col("_first._id").alias("keep_id"),
        F.col("_n").alias("group_size"),
        (F.col("_row") == F.col("_first._row")).alias("kept"),
        F.lower(F.hex("_sha")).alias("text_sha256"),
    )
