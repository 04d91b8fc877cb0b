import random
import re

import pytest
import xxhash

from rollcall.llm import queries, simhash
from rollcall.llm.components import component_roots
from tests.compare import duckdb_tables
from tests.llm.conftest import TEXTS

SMALL = "/root/testdata/sf0.001"


def brute_print(text, words=3):
    tokens = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(tokens[i : i + words]) for i in range(len(tokens) - words + 1)]
    if len(tokens) < words:
        shingles = [" ".join(tokens)] if tokens else []
    hashes = [xxhash.xxh64(s.encode(), 42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_roots(prints, bits):
    """Smallest node reachable over links of ``bits`` or fewer."""
    nodes = sorted(set(prints))
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for i, a in enumerate(nodes):
        for b in nodes[:i]:
            if (a ^ b).bit_count() <= bits:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {n: find(n) for n in nodes}


def check(rows, docs, bits=2):
    """``rows``: id, fingerprint, component; ``docs``: id, text."""
    prints = [(i, brute_print(t)) for i, t in docs]
    roots = brute_roots([p for _, p in prints], bits)
    first = {}
    for i, p in prints:
        if i is not None:
            first[roots[p]] = min(first.get(roots[p], i), i)
    want = [(i, f"{p:016x}", first.get(roots[p])) for i, p in prints]
    assert sorted(map(str, rows)) == sorted(map(str, want))


def test_against_brute_force(spark):
    docs = duckdb_tables(SMALL).execute("SELECT doc_id, text FROM documents").fetchall()
    check([tuple(r) for r in queries.registered()["op2_simhash_dedup"](spark, SMALL).collect()], docs)


def test_awkward(awkward):
    rows = simhash.near_groups(awkward.repartition(3)).collect()
    check([(r.doc_id, r.fingerprint, r.component_id) for r in rows], TEXTS)
    kept = {}
    for r in rows:
        kept.setdefault(r.fingerprint, []).append(r.kept)
    assert sum(r.kept for r in rows) == len({brute_roots([brute_print(t) for _, t in TEXTS], 2)[brute_print(t)] for _, t in TEXTS})


def test_nothing(nothing):
    assert simhash.near_groups(nothing).collect() == []


@pytest.mark.parametrize("bits", [1, 2])
@pytest.mark.parametrize("bucket", [2, 32])
def test_crowded_prints(spark, bits, bucket):
    """Hundreds of prints around a few centres: buckets beyond any limit, no link lost."""
    rnd = random.Random(bits)
    prints = set()
    for _ in range(6):
        centre = rnd.getrandbits(64)
        for _ in range(120):
            value = centre
            for _ in range(rnd.randint(0, 4)):
                value ^= 1 << rnd.choice([rnd.randrange(64), rnd.randrange(6)])
            prints.add(value)
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    df = spark.createDataFrame(signed, "_print long")
    roots = component_roots(simhash.links(df, bits, bucket), "a", "b")
    groups = {}
    for r in roots.collect():
        groups.setdefault(r.root, set()).add(r.node % (1 << 64))
    brute = {}
    for node, root in brute_roots(prints, bits).items():
        brute.setdefault(root, set()).add(node)
    assert sorted(map(sorted, groups.values())) == sorted(sorted(g) for g in brute.values() if len(g) > 1)


def test_other_distances_are_refused(spark):
    with pytest.raises(ValueError, match="two segments"):
        simhash.links(spark.createDataFrame([(1,)], "_print long"), 3)


def test_chain_and_star(spark):
    chain = [(i, i + 1) for i in range(300)]
    star = [(1000, 1000 + i) for i in range(1, 300)]
    df = spark.createDataFrame([*chain, *star, (5000, 5000)], "a long, b long")
    rows = component_roots(df, "a", "b").collect()
    assert len(rows) == 301 + 300
    assert len({r.root for r in rows if r.node <= 300}) == 1
    assert len({r.root for r in rows}) == 2
    assert component_roots(df.limit(0), "a", "b").collect() == []


def test_one_bit_in_a_large_bucket(spark):
    """Dense codes share one segment, so their bucket is over the limit; all one-bit links count."""
    rnd = random.Random(8)
    for _ in range(2):
        codes = rnd.sample(range(1 << 10), 250)
        found = simhash.links(spark.createDataFrame([(x,) for x in codes], "_print long"), 1).collect()
        have = {frozenset((r.a, r.b)) for r in found}
        assert have == {frozenset((x, y)) for x in codes for y in codes if (x ^ y).bit_count() == 1}


def test_signatures_are_never_broadcast(spark, tmp_path, monkeypatch):
    """Spark takes the exploded signatures for as small as the fingerprints, and would broadcast them."""
    rnd = random.Random(4)
    near = [rnd.getrandbits(62) ^ (1 << b) for _ in range(20) for b in range(2)]
    spark.createDataFrame([(x,) for x in {*near, *range(100)}], "_print long").write.parquet(f"{tmp_path}/prints")
    plans, stored = [], simhash.stored

    def seen(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return stored(df, name)

    monkeypatch.setattr(simhash, "stored", seen)
    for bits in (1, 2):
        found = simhash.links(spark.read.parquet(f"{tmp_path}/prints"), bits)
        plans.append(found._jdf.queryExecution().executedPlan().toString())
    assert len(plans) == 4
    assert all("SortMergeJoin" in p and "BroadcastExchange" not in p for p in plans)
