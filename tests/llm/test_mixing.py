import re
from collections import Counter, defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from rollcall.llm import mixing, queries
from tests.llm.conftest import TEXTS


def shares(sizes, weights=(3, 1, 2), percent=150, most=2):
    """Targets by sharing anew until none is above its bound."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    targets, free = {}, set(order)
    rest = Fraction(sum(sizes.values()) * percent, 100)
    while free:
        level = rest / sum(weight[s] for s in free)
        full = {s for s in free if weight[s] * level >= most * sizes[s]}
        if not full:
            return targets | {s: weight[s] * level for s in free}
        targets |= {s: Fraction(most * sizes[s]) for s in full}
        rest -= sum(most * sizes[s] for s in full)
        free -= full
    return targets


def checked(rows, found, **how):
    """Contract of ``found`` rows of ``(doc_id, source, text)`` documents."""
    count = lambda text: len(re.findall("[^ \t-\r]+", text or ""))
    sizes, longest = Counter(), Counter()
    for _, source, text in rows:
        sizes[source] += count(text)
        longest[source] = max(longest[source], count(text))
    targets = shares(sizes, **how)
    assert sorted((r.doc_id or -1, r.size) for r in found) == sorted((i or -1, count(t)) for i, _, t in rows)
    owner = defaultdict(set)
    for i, source, text in rows:
        owner[i, count(text)].add(source)
    taken = Counter()
    for r in found:
        assert 0 <= r.taken <= how.get("most", 2) * r.size
        assert any(
            sizes[s] == r.source_size and r.target == pytest.approx(float(targets[s]), rel=1e-12, abs=1e-9)
            for s in owner[r.doc_id, r.size]
        )
        taken[r.source_size, round(r.target, 6)] += r.taken
    for s, size in sizes.items():
        same = [x for x in sizes if sizes[x] == size and targets[x] == targets[s]]
        want = float(targets[s]) * len(same)
        assert abs(taken[size, round(float(targets[s]), 6)] - want) <= len(same) * (longest[s] + 1)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_contract(shipping, sf):
    folder = f"/root/testdata/{sf}"
    rows = [tuple(r) for r in shipping.read.parquet(f"{folder}/documents.parquet").select("doc_id", "source", "text").collect()]
    found = queries.registered()["op13_mixing"](shipping, folder).collect()
    checked(rows, found)


def test_awkward_documents(awkward):
    found = mixing.copies(awkward).collect()
    rows = [(i, None if i == 7 else f"s{(i or 0) % 2}", t) for i, t in TEXTS]
    checked(rows, found)


def test_layout_does_not_matter(shipping):
    rows = [(i, f"s{i % 7 if i % 3 else 0}", "w " * (i % 50)) for i in range(2000)] + [(5, "s5", "w " * 5)] * 40
    df = shipping.createDataFrame(rows, "doc_id long, source string, text string")
    found = [
        sorted(map(tuple, mixing.copies(part).drop("_row").collect()))
        for part in (df.repartition(1), df.repartition(9), df.repartition(4, "text"))
    ]
    assert found[0] == found[1] == found[2]
    checked([(i, s, t) for i, s, t in rows], mixing.copies(df).collect())


def test_one_row_many_times(shipping):
    df = shipping.range(3000, numPartitions=7).selectExpr(
        "CAST(NULL AS bigint) AS doc_id", "IF(id % 3 = 0, 'hot', concat('s', id % 5)) AS source", "'a b c' AS text"
    )
    rows = [tuple(r) for r in df.select("doc_id", "source", "text").collect()]
    checked(rows, mixing.copies(df).collect())


def test_mix_holds_the_copies(awkward):
    took = {(r.doc_id, r.size): r.copies for r in mixing.copies(awkward).collect() if r.size}
    mix = mixing.mixed(awkward)
    assert mix.columns == awkward.columns
    assert mix.where("doc_id = 10").count() == took[10, 60001 if (10, 60001) in took else max(s for i, s in took if i == 10)]


@pytest.mark.parametrize("sizes", [{"a": 0, "b": 0}, {"a": 10, "b": 0, None: 1}, {"a": 1, "b": 1000, "c": 10, "d": 7}])
def test_targets(shipping, sizes):
    rows = [(i, s, "w " * n) for i, (s, n) in enumerate(sizes.items())]
    df = shipping.createDataFrame(rows, "doc_id long, source string, text string")
    got = {r.doc_id: r.target for r in mixing.copies(df).collect()}
    want = shares(sizes)
    assert got == {i: pytest.approx(float(want[s])) for i, s, _ in rows}


def test_many_sources(shipping):
    df = shipping.range(5000, numPartitions=5).selectExpr(
        "id AS doc_id", "concat('s', id % 1700) AS source", "repeat('w ', cast(id % 13 as int)) AS text"
    )
    rows = [tuple(r) for r in df.collect()]
    checked(rows, mixing.copies(df).collect())


def test_no_documents(nothing):
    assert mixing.copies(nothing).collect() == []
    assert mixing.mixed(nothing).collect() == []
