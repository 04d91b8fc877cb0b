"""Mixing sources to target weights by systematic sampling, in built-in functions only."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rollcall.llm.common import (
    WHITE,
    free_name,
    met_by_run,
    row_number,
    run_number,
    stored,
    text_of,
)

#: Weights of the sources in their order, repeating.
WEIGHTS = (3, 1, 2)
#: Hexadecimal digits of a digest that slice the documents of a source and size; each slice is
#: put in order by itself.
SLICE_DIGITS = 3
#: Hexadecimal digits of a source's random offset: below 2**52, so exact as a double.
_DIGITS = 13


def word_count(text: str) -> Column:
    """The number of runs of anything but white space; null texts have none."""
    return F.regexp_count(text_of(text), F.lit(rf"[^{WHITE}]++")).cast("bigint")


def offset(source: str, seed: int) -> Column:
    """A fixed number from 0 up to 1 for each source."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.col(source)).cast("binary"))
    return F.conv(F.substring(digest, 1, _DIGITS), 16, 10).cast("double") / F.lit(float(1 << (4 * _DIGITS)))


def weighed(sources: DataFrame, weights=WEIGHTS) -> DataFrame:
    """``sources`` with a ``_weight`` by their place in the order of code points, null last.

    Names have a mark before them, so that the empty text is that of null.

    The order is put together from sorted parts and the numbers of rows before them, so no task
    sees all sources.
    """
    part, place = F.spark_partition_id(), F.monotonically_increasing_id()
    order = [F.col("_source") == "", F.col("_source")]
    ranged = sources.repartitionByRange(*order).sortWithinPartitions(*order)
    # The low 33 bits number the rows of a part.
    numbered = stored(ranged.withColumns({"_part": part, "_place": place}), "sources")
    numbered = numbered.withColumn("_place", F.col("_place").bitwiseAND(F.lit((1 << 33) - 1)))
    sizes = {r._part: r.n for r in numbered.groupBy("_part").agg(F.count(F.lit(1)).alias("n")).collect()}
    before, at = [], 0
    for k in sorted(sizes):
        before.append((k, at))
        at += sizes[k]
    starts = sources.sparkSession.createDataFrame(before, "_part int, _start bigint")
    kind = F.pmod(F.col("_start") + F.col("_place"), F.lit(len(weights))) + 1
    return numbered.join(F.broadcast(starts), "_part").select(
        "_source", "_size", F.element_at(F.array(*map(F.lit, weights)), kind.cast("int")).cast("bigint").alias("_weight")
    )


def targets(sources: DataFrame, percent: int, most: int) -> DataFrame:
    """``sources`` (``_source``, ``_size``, ``_weight``) with a ``_target``.

    ``percent`` of all sizes is shared by weight.  A target stops at ``most`` times the size of
    its source; what is over is shared anew by the others, round by round, until none is above.
    Each round is one sum over the sources.  All shares are fractions of whole numbers.
    """
    full = F.lit(False)
    share = F.col("_size") * most * 100
    whole = sources.agg(F.sum("_size").alias("s"), F.sum("_weight").alias("w")).first()
    left, weight = (whole.s or 0) * percent, whole.w or 0
    found = 0
    while weight:
        # At or above its level: share <= level * weight, as products of whole numbers.
        wide = lambda x: F.lit(str(x)).cast("decimal(38,0)")
        full = share.cast("decimal(19,0)") * wide(weight).cast("decimal(19,0)") <= (
            F.col("_weight").cast("decimal(10,0)") * wide(left).cast("decimal(28,0)")
        )
        now = sources.agg(
            F.count_if(full).alias("n"), F.sum(F.when(full, F.col("_size"))).alias("s"),
            F.sum(F.when(full, F.col("_weight"))).alias("w"),
        ).first()
        if now.n == found:
            break
        found = now.n
        left = (whole.s or 0) * percent - (now.s or 0) * most * 100
        weight = whole.w - (now.w or 0)
    if not weight:
        full = F.lit(True)
    level = F.col("_weight") * F.lit(float(left)) / F.lit(float(max(weight, 1) * 100))
    return sources.withColumn("_target", F.when(full, F.col("_size") * F.lit(float(most))).otherwise(level))


def _placed(rows: DataFrame) -> DataFrame:
    """``rows`` with ``_before``: how many documents of their source come first.

    Documents are in order of size, then of a digest of id and text.  Counts by size, and by
    slices of the digests, give most of the place; what is left, equal rows included, is counted
    by run.  So no window holds more than a slice's distinct documents, the equal ones of a run,
    or a source's sizes.
    """
    entry, cell, size = ["_source", "_size", "_entry"], ["_source", "_size", "_slice"], ["_source", "_size"]

    def sum_before(keys, *order):
        window = W.partitionBy(*keys).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
        return F.coalesce(F.sum("_n").over(window), F.lit(0))

    runs = rows.groupBy(*entry, "_run").agg(F.count(F.lit(1)).alias("_n"))
    runs = stored(runs.withColumn("_slice", F.substring("_entry", 1, SLICE_DIGITS)), "runs-of-documents")
    cells = runs.groupBy(*cell).agg(F.sum("_n").alias("_n"))
    sizes = cells.groupBy(*size).agg(F.sum("_n").alias("_n"))
    sizes = sizes.select(*size, sum_before(["_source"], "_size").alias("_smaller"))
    cells = cells.select(*cell, sum_before(size, "_slice").alias("_sliced")).join(sizes, size)
    counted = runs.withColumn("_earlier", sum_before(cell, "_entry", "_run")).join(cells, cell)
    found = counted.select(*entry, "_run", (F.col("_smaller") + F.col("_sliced") + F.col("_earlier")).alias("_begin"))
    inner = F.row_number().over(W.partitionBy(*entry, "_run").orderBy("_row")) - 1
    own = rows.withColumn("_inner", inner).join(found, [*entry, "_run"])
    return own.withColumn("_before", F.col("_begin") + F.col("_inner"))


def copies(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights=WEIGHTS,
    percent: int = 150,
    most: int = 2,
    seed: int = 0,
    row: str | None = None,
) -> DataFrame:
    """One row per document: ``_row``, id, ``size``, ``source_size``, ``target``, ``copies``, ``taken``.

    Sizes are words.  Each source, in the order of code points, null last, has the next of the
    repeating ``weights``; by weight they share ``percent`` of all sizes, ``most`` times their
    own at most.  All documents of a source expect ``target / source_size`` copies; along the
    source's order, plus one offset of the source, a document has a copy for each whole number
    its share of the sum crosses.  Within a source documents are in order of size, so the words
    taken miss the target by about its longest document at most, and by chance only.

    A null text has no words; null sources are one source; a source without words has target 0
    and no copies.  Equal rows are documents of their own.  The order depends on the documents
    alone, not on how they are split or stored, so reruns agree (equal rows may swap).  No
    documents give an empty result.  ``row`` names a column of unique row numbers.
    """
    name = F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit(""))
    digest = F.md5(text_of(text).cast("binary"))
    rows = stored(
        docs.select(
            F.col(id_column).alias("_id"), name.alias("_source"), row_number(row).alias("_row"),
            word_count(text).alias("_size"),
            F.md5(F.concat_ws(":", F.col(id_column).cast("string"), digest).cast("binary")).alias("_entry"),
            run_number(),
        ),
        "sizes",
    )
    sources = rows.groupBy("_source").agg(F.sum("_size").alias("_size"))
    shared = stored(targets(stored(weighed(sources, weights), "weights"), percent, most), "targets")
    shared = shared.select(
        "_source", F.col("_size").alias("source_size"), F.col("_target").alias("target"),
        F.when(F.col("_size") > 0, F.col("_target") / F.col("_size")).otherwise(F.lit(0.0)).alias("_rate"),
        offset("_source", seed).alias("_offset"),
    )
    # A source meets its target once per run, so one with much of the rows is met by many tasks.
    met = met_by_run(_placed(rows), shared, ["_source"])
    crossed = lambda k: F.floor(k.cast("double") * F.col("_rate") + F.col("_offset"))
    times = (crossed(F.col("_before") + 1) - crossed(F.col("_before"))).cast("bigint")
    return met.select(
        "_row", F.col("_id").alias(id_column), F.col("_size").alias("size"), "source_size", "target",
        times.alias("copies"), (times * F.col("_size")).alias("taken"),
    )


def mixed(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", source: str = "source", **how
) -> DataFrame:
    """The mix itself: every document as often as ``copies`` tells, all its columns.

    Documents without a copy are left out.  See ``copies`` for the rest.
    """
    row = free_name(docs, "_row")
    numbered = stored(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    found = copies(numbered, id_column, text, source, row=row, **how)
    times = free_name(numbered, "_times")
    taken = found.where("copies > 0").select(F.col("_row").alias(row), F.col("copies").alias(times))
    return numbered.join(taken, row).withColumn(
        times, F.explode(F.sequence(F.lit(1).cast("bigint"), F.col(times)))
    ).select(*docs.columns)
