import hashlib
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from rollcall.llm import exact, queries, urls
from tests.compare import difference, duckdb_tables
from tests.llm.conftest import TEXTS

SMALL = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().toString()


@pytest.mark.parametrize("name", sorted(queries.statements()))
def test_same_as_sql(spark, name):
    run = queries.registered()[name]
    assert difference(run(spark, SMALL), duckdb_tables(SMALL), queries.statements()[name]) is None


@pytest.mark.parametrize("name", ["op3_exact_dedup", "op5_url_filters", "op10_pii"])
def test_native(spark, name):
    text = plan(queries.registered()[name](spark, SMALL))
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", text)


@pytest.mark.parametrize("fan_in", [2, 16])
def test_awkward_groups(awkward, fan_in):
    rows = exact.exact_groups(awkward.repartition(5), fan_in=fan_in).collect()
    groups = defaultdict(list)
    for i, text in TEXTS:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", text or "")].append(i)
    assert len(rows) == len(TEXTS)
    by_hash = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in groups.items()}
    kept = defaultdict(int)
    for row in rows:
        ids = by_hash[row.text_sha256]
        assert row.group_size == len(ids)
        assert row.keep_id == min((i for i in ids if i is not None), default=None)
        kept[row.text_sha256] += row.kept
        assert not row.kept or row.doc_id == row.keep_id
    assert set(kept.values()) == {1}


def test_runs_merge_in_order(spark):
    """A round is one exchange, behind which sorted entries are merged; the result is sorted."""
    df = spark.range(4000, numPartitions=40).selectExpr("id AS doc_id", "concat('t', id % 900) AS text")
    rows = exact.digest_rows(df, "doc_id", "text", F.col("doc_id"))
    leaves = exact.sorted_runs(rows, 40)
    level = exact.merge_round(leaves, 16)
    text = level._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 1 and "SortAggregate" in text and "HashAggregate" not in text
    assert text.index("SortAggregate") < text.index("Sort [") < text.index("Exchange hashpartitioning")
    parts = level.withColumn("part", F.spark_partition_id()).collect()
    for part in {r.part for r in parts}:
        keys = [(r._run, r._slice, r._digest) for r in parts if r.part == part]
        assert keys == sorted(keys)
    assert {r._run for r in parts} == {0, 1, 2}
    assert exact.merged_runs(leaves, 40).count() == 900


def test_one_text_holds_most_rows(spark):
    df = spark.range(4000, numPartitions=40).selectExpr(
        "id AS doc_id", "IF(id % 3 = 0, 'hot', concat('t', id)) AS text"
    )
    rows = exact.exact_groups(df)
    assert rows.count() == 4000
    assert rows.where("kept").count() == 4000 - 1334 + 1
    assert {r.group_size for r in rows.where("keep_id = 0").collect()} == {1334}


def test_nothing(nothing, spark):
    assert exact.exact_groups(nothing).collect() == []
    rules = spark.createDataFrame(queries.URL_RULES, urls.RULES)
    pages = nothing.selectExpr("doc_id AS page_id", "text AS url")
    assert urls.judged(pages, rules).collect() == []


def brute_verdict(url, rules):
    match = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (match[1], match[2]) if match else ("", "")
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fitting = [
        (len(h + p), len(h), h + p, v) for h, p, v in rules
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    best = max(fitting, default=(0, 0, None, "allow"))
    return host, path, best[2], best[3]


@pytest.fixture(params=["true", "false"])
def ranges(spark, request):
    """Hosts in one range, or in as many as there are shuffle partitions."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, request.param)
    yield
    spark.conf.set(name, before)


def test_hosts_under_rules(spark, ranges):
    rnd = random.Random(5)
    name = lambda n: ".".join(rnd.choice("abcde") for _ in range(rnd.randint(1, n))) + "."
    rules, hosts = {name(3) for _ in range(25)}, {name(5) for _ in range(400)} | {"."}
    found = urls.rules_over(
        spark.createDataFrame([(h,) for h in hosts], "_host string"),
        spark.createDataFrame([(r,) for r in rules], "_key string"),
    )
    want = {h: sorted(r for r in rules if h.startswith(r)) for h in hosts}
    assert {r._host: sorted(r._keys) for r in found.collect()} == {h: k for h, k in want.items() if k}


def test_rules_against_brute_force(spark, ranges):
    rnd = random.Random(3)
    labels, steps = ["a", "b", "net", "org", "example"], ["", "en", "en/x", "de", "en/x/y"]
    host = lambda: ".".join(rnd.choice(labels) for _ in range(rnd.randint(1, 4)))
    rules = {(host(), "/" + rnd.choice(steps)): rnd.choice(["allow", "block"]) for _ in range(60)}
    rules = [(h, p, v) for (h, p), v in rules.items()] + [(None, "/", "block"), ("a", None, "block")]
    addresses = [f"http://{host()}/{rnd.choice(steps)}{rnd.choice(['', '?q=://x/', '#t'])}" for _ in range(900)]
    addresses += [None, "", "no scheme", "x://", "://A.NET/en", "http://h\n/en", *addresses[:40], "u://net?x"] * 2
    pages = spark.createDataFrame(
        [(None if i % 50 == 0 else i % 300, u, "x", "y") for i, u in enumerate(addresses)],
        "page_id long, url string, host string, _key string",
    )
    got = urls.judged(pages, spark.createDataFrame(rules, urls.RULES), sweep_rows=7)
    good = [r for r in rules if None not in r]
    want = [(r.page_id, *brute_verdict(r.url, good)) for r in pages.collect()]
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)


def test_no_rules(spark):
    pages = spark.createDataFrame([(1, "http://a.net/x")], "page_id long, url string")
    got = urls.judged(pages, spark.createDataFrame([], urls.RULES)).collect()
    assert [tuple(r) for r in got] == [(1, "a.net", "/x", None, "allow")]


