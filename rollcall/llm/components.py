"""Connected components of a table of links."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import stored


def component_roots(links: DataFrame, a: str, b: str) -> DataFrame:
    """``node``, ``root`` for every node of the links: equal roots are connected.

    In each round every node follows the neighbour whose hash is smallest, twice, and links
    shrink to links between the nodes followed; the hash changes with the round, so chains
    shrink by a constant factor too.  A node with many links is one row per task before the
    shuffle.  Rounds end when no link is left; each is written, so a lost executor repeats at
    most one.  No links give an empty table.
    """
    edges = stored(
        links.where(F.col(a) != F.col(b)).select(
            F.least(a, b).alias("a"), F.greatest(a, b).alias("b")
        ).distinct(),
        "links",
    )
    steps, turn = [], 0
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        rank = lambda c: F.struct(F.xxhash64(F.col(c), F.lit(turn)).alias("h"), F.col(c).alias("n"))  # noqa: E731, B023
        nearest = both.groupBy("a").agg(F.least(F.min(rank("b")), F.first(rank("a"))).alias("r"))
        step = stored(nearest.select(F.col("a").alias("node"), F.col("r.n").alias("to")), "step")
        onward = step.select(F.col("node").alias("to"), F.col("to").alias("root"))
        step = stored(step.join(onward, "to").select("node", "root"), "step")
        steps.append(step)
        ends = step.select(F.col("node").alias("a"), F.col("root").alias("ra")), step.select(
            F.col("node").alias("b"), F.col("root").alias("rb")
        )
        moved = edges.join(ends[0], "a").join(ends[1], "b").where("ra != rb")
        edges = stored(
            moved.select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(),
            "links",
        )
        turn += 1
    if not steps:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = steps[0]
    for step in steps[1:]:
        later = step.select(F.col("node").alias("root"), F.col("root").alias("next"))
        roots = roots.join(later, "root", "left").select("node", F.coalesce("next", "root").alias("root"))
    return stored(roots, "roots")
