"""Operators on small fixtures: each large-data path must give what the plain path gives."""

import random
import re

import pytest
from pyspark.sql import functions as F

from rollcall.operators import dimensions
from rollcall.operators.checks import assert_columns
from rollcall.operators.dedupe import latest_per_key
from rollcall.operators.dimensions import (
    given_lookup,
    given_lookups,
    left_lookup,
    membership,
    outer_lookup,
    payload_bytes,
    wide_lookup,
    without_match,
)
from rollcall.operators.nesting import PARTS, SHARES, nest, sorted_shares
from rollcall.operators.reshape import typed_fill
from rollcall.operators.rules import amount_rules, exclude_rule


def rows(df):
    return sorted(map(repr, (tuple(r) for r in df.select(sorted(df.columns)).collect())))


@pytest.fixture(scope="module")
def hot(spark):
    """A third of the rows under one key, some without a key."""
    cells = [("hot" if i % 3 == 0 else None if i % 11 == 0 else f"k{i % 7}", i) for i in range(600)]
    return spark.createDataFrame(cells, "k string, id int")


@pytest.fixture(scope="module")
def dim(spark):
    cells = [("hot", "x"), ("k1", "y"), ("k1", "z"), ("k9", "w"), (None, "n")]
    return spark.createDataFrame(cells, "k string, v string")


def test_given_lookup_is_measured(hot, dim):
    small, large = given_lookup(hot, dim, ["k"]), given_lookup(hot, dim, ["k"], max_bytes=0)
    assert rows(small) == rows(large) == rows(left_lookup(hot, dim, ["k"]))
    assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()


def test_exploded_dimension_is_not_broadcast(spark):
    """Spark estimates it by the few rows it explodes."""
    df = spark.range(20_000_000).selectExpr("id", "id % 9 AS k")
    dim = spark.range(20).selectExpr("id AS k", "explode(sequence(1, 5000)) AS v")
    joined = given_lookup(df, dim, ["k"], max_bytes=0)
    assert "Broadcast" not in joined._jdf.queryExecution().executedPlan().toString()


def test_hot_key_is_split(spark):
    """Adaptive execution splits the partition of a key with a third of the rows, null ids included."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        big = spark.range(0, 120_000, 1, 8).selectExpr(
            "IF(id % 3 = 0, 0, id) AS k", "IF(id % 3 = 0, NULL, id) AS newid", "repeat('x', 40) AS v"
        )
        dim = spark.range(50_000).selectExpr("id AS k", "id * 2 AS w")
        joined = left_lookup(big, dim, ["k"])
        assert joined.count() == 120_000
        joined.collect()
        assert "skewed" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_outer_lookup_is_a_full_outer_join(hot, dim):
    assert rows(outer_lookup(hot, dim, ["k"])) == rows(hot.join(dim, "k", "full_outer"))


@pytest.mark.parametrize("broadcast_bytes", [0, 64 << 20])
def test_wide_rows_are_dealt_by_joined_bytes(spark, monkeypatch, broadcast_bytes):
    """No task gets two hot dimension rows or much more than ``max_bytes`` of joined rows."""
    monkeypatch.setattr(dimensions, "BROADCAST_BYTES", broadcast_bytes)
    cells = [(None if i % 11 == 0 else f"k{i % 7}", i) for i in range(700)]
    df = spark.createDataFrame(cells, "k string, id int")
    wide = [("k1", "x" * 5000), ("k1", "y" * 5000), ("k2", "z" * 9000), ("k2", "z" * 9000)]
    light = [("k2", "z"), ("k3", "w"), (None, "n"), ("k9", "v" * 9000)]
    dim = spark.createDataFrame([*wide, *light], "k string, v string")
    met = wide_lookup(df, dim, ["k"], max_bytes=100_000)
    assert rows(met) == rows(left_lookup(df, dim, ["k"]))
    hot = met.where("length(v) > 1").groupBy(F.spark_partition_id().alias("task"))
    tasks = hot.agg(F.collect_set("v").alias("rows"), F.sum(F.length("v")).alias("bytes")).collect()
    assert all(len(t["rows"]) == 1 and t["bytes"] <= 250_000 for t in tasks)
    assert len(tasks) >= 20
    assert rows(outer_lookup(df, dim, ["k"], 100_000)) == rows(df.join(dim, "k", "full_outer"))


def test_membership_and_anti_join(hot, dim):
    flagged = membership(hot, dim, ["k"], "known")
    assert flagged.where("known = 1").count() == hot.where("k in ('hot', 'k1')").count()
    assert flagged.count() == hot.count()
    rest = without_match(hot, dim, ["k"])
    assert rows(rest) == rows(hot.where("k is null or k not in ('hot', 'k1')"))


def test_payload_bytes(spark, dim):
    assert payload_bytes(dim.where("false")) == 0
    assert payload_bytes(dim) > 16 * 10


def test_nest(spark):
    rng = random.Random(7)
    cells = [("hot", None if i % 5 == 0 else "same" if i % 2 else f"v{i}", i % 3) for i in range(900)]
    cells += [(None, f"n{i}", 0) for i in range(90)]
    cells += [(f"k{i % 9}", "v", i) for i in range(90)]
    rng.shuffle(cells)
    df = spark.createDataFrame(cells, "k string, v string, x int").repartition(7)
    nested = nest(df, ["k"], {"vs": F.col("v"), "xs": F.struct("x")}, {"least": F.col("x")})
    got = {r.k: r for r in nested.collect()}
    assert nested.count() == len(got) == len({k for k, _, _ in cells})
    for key, row in got.items():
        mine = [c for c in cells if c[0] == key]
        assert row.vs == sorted(v for _, v, _ in mine if v is not None)
        assert [x.x for x in row.xs] == sorted(x for _, _, x in mine)
        assert row.least == min(x for _, _, x in mine)


def test_nest_counts_equal_entries_before_it_shuffles(spark):
    """One key with most rows, all of one value: each task sends one row of it."""
    df = spark.range(0, 50_000, 1, 8).selectExpr("IF(id % 10 = 0, id, 0) AS k", "'same' AS v")
    nested = nest(df, ["k"], {"vs": F.col("v")})
    assert nested.count() == df.select("k").distinct().count()
    assert nested.where("k = 0").first().vs == ["same"] * 45_001
    assert "partial_count" in nested._jdf.queryExecution().toString()


def test_latest_per_key(spark):
    df = spark.createDataFrame(
        [("a", "2001.0", "q"), ("a", "2003", "z"), ("a", "2003.0", "b"), ("b", None, "c")],
        "k string, anio string, id string",
    )
    latest = latest_per_key(df, ["k"], F.col("anio").try_cast("double"))
    assert rows(latest) == rows(df.where("id in ('c') or anio = '2003'"))
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_rules(spark):
    cells = [
        ("S072", "S072", "60", "6", 5), ("S072", "0377", "60", "1", 5), ("S174", "1", "1", "3", 5),
        ("S241", "1", "1", "1", 5), ("S241", "0567", "2", "1", 5), ("S241", "0568", None, "1", 5),
        (None, "0377", "60", "3", 5), ("S072", None, "60", "6", 5),
    ]
    schema = "cdprograma string, cdpadron string, cdbeneficio string, cdtipobeneficio string, nuimpmonetario int"
    df = spark.createDataFrame(cells, schema).coalesce(1)
    assert [r.nuimpmonetario for r in amount_rules(df).collect()] == [0, 0, 0, 0, 5, 5, 5, 5]
    both = [("cdprograma", "S241"), ("cdpadron", "0567"), ("cdpadron", "0568")]
    from rollcall.operators.rules import zero_amount

    assert df.where(zero_amount([both])).count() == 0


def test_exclusion(spark):
    cells = [("S052", "60"), ("S052", "1"), ("S052", None), (None, "1"), ("S072", "60"), ("S072", None)]
    kept = exclude_rule(spark.createDataFrame(cells, "cdprograma string, cdbeneficio string"))
    assert rows(kept) == sorted(map(repr, [("1", "S052"), ("60", "S072"), (None, "S072")]))


def test_typed_fill(spark):
    df = spark.createDataFrame([(None, None, None), ("a", 1, 2.9)], "s string, i int, d double")
    filled = typed_fill(df)
    assert filled.dtypes == [("s", "string"), ("i", "int"), ("d", "bigint")]
    assert rows(filled) == sorted([repr((0, 0, "null")), repr((2, 1, "a"))])


def test_checks(dim):
    with pytest.raises(ValueError):
        assert_columns(dim, ["v", "k"])
    assert assert_columns(dim, ["k", "v"]) is dim


def test_a_hot_key_is_sorted_in_shares(spark):
    """A third of the rows and many distinct entries under one key: many tasks sort them."""
    df = spark.range(0, 90_000, 1, 8).selectExpr("IF(id % 3 = 0, -1, id % 500) AS k", "concat('v', id) AS v")
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "false")
    try:
        shares = sorted_shares(df, ["k"], {"vs": F.col("v")}).withColumn("part", F.spark_partition_id())
        hot = shares.where("k = -1").collect()
        assert len(hot) == SHARES and len({r.part for r in hot}) >= int(spark.conf.get("spark.sql.shuffle.partitions")) - 1
        assert sum(len(r.vs) for r in hot) == 30_000 and max(len(r.vs) for r in hot) < 1000
        assert all(list(r.vs) == sorted(r.vs) for r in hot)
        longest = nest(df, ["k"], {"vs": F.col("v")}).where("k = -1").first().vs
        assert longest == sorted(f"v{i}" for i in range(0, 90_000, 3))
    finally:
        spark.conf.set(setting, before)


def test_large_dimensions_shuffle_wide_rows_once(spark, hot, dim):
    places = spark.createDataFrame([(1, "p"), (4, "q"), (4, "r"), (None, "n")], "id int, place string")
    wide = hot.withColumn("wide", F.concat(F.lit("w"), "id"))
    dims = [(dim, ["k"]), (places, ["id"])]
    large = given_lookups(wide, dims, max_bytes=0)
    assert rows(large) == rows(wide.join(dim, "k", "left").join(places, "id", "left"))
    assert rows(given_lookups(wide, dims)) == rows(large)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = given_lookups(wide, dims, max_bytes=0)._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
        )
        inputs = re.findall(r"\) Exchange\nInput \[\d+\]: (.*)", text)
        assert sum("wide#" in x for x in inputs) == 1 and len(inputs) > 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_one_large_dimension_reads_rows_once(spark, dim):
    """Its rows are neither read a second time for their keys nor computed in columns nobody uses."""
    wide = spark.range(0, 600, 1, 4).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 11 > 0 THEN concat('k', id % 7) END AS k", "id",
        "concat('w', id) AS wide",
    )
    places = spark.createDataFrame([(1, "p"), (4, "q"), (4, "r"), (None, "n")], "id long, place string")
    bound = payload_bytes(places)
    assert payload_bytes(dim) > bound
    joined = given_lookups(wide, [(places, ["id"]), (dim, ["k"])], max_bytes=bound)
    assert rows(joined) == rows(wide.join(dim, "k", "left").join(places, "id", "left"))
    plan = joined.select("id", "v", "place")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Range (") == 1 and plan.count("concat(w") == 0 and plan.count("SortMergeJoin") == 1
    assert plan.index("BroadcastHashJoin") < plan.index("SortMergeJoin")


def test_distinct_entries_are_dealt_whatever_the_session_has(spark):
    """Every step of nest goes to many partitions, without a job; the lists are the same."""
    df = spark.range(0, 60_000, 1, 8).selectExpr(
        "IF(id % 3 = 0, -1, id % 50) AS k", "IF(id % 4 = 0, 'same', concat('v', id)) AS v", "id % 7 AS x"
    )
    lists, least = {"vs": F.col("v"), "xs": F.struct("x")}, {"least": F.col("x")}
    dealt = nest(df, ["k"], lists, least, distinct=True)
    plan = dealt._jdf.queryExecution().executedPlan().toString()
    assert re.findall(r"Exchange hashpartitioning\(.*, (\d+)\), REBALANCE", plan) == [str(PARTS)] * 3
    assert plan.count("Exchange") == 3
    assert rows(dealt) == rows(nest(df, ["k"], lists, least))
    shares = sorted_shares(df, ["k"], {"vs": F.col("v")}, distinct=True)
    hot = [x.n for r in shares.where("k = -1").collect() for x in r.vs if x.entry == "same"]
    assert sum(hot) == 5_000 and len(hot) > 1
