import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from rollcall.llm import prefix_trie

COLUMNS = [
    "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256",
]
SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows, family=100):
    """The contract, by dictionaries of whole paths."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            said = (role or "", text or "")
            digest = hashlib.sha256(f"{len(said[0].encode())}:{said[0]}{said[1]}".encode()).digest()[:16]
            own[conv].append((turn is not None, turn or 0, said[0], digest, said))
    own = {c: [t[-1] for t in sorted(turns)] for c, turns in own.items()}
    paths = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6 if family else 0
        paths[c] = (own.get(c - c % family, [])[:h] if family else []) + turns[h:]
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(paths):
        for d in range(len(paths[c]) + 1):
            members[tuple(paths[c][:d])].append(c)
        ends[tuple(paths[c])].append(c)
    children = defaultdict(int)
    leaves, saved = defaultdict(int), defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, convs in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += (len(convs) - 1) * (len(node[-1][1]) if node else 0)
    return sorted(
        (
            convs[0], len(node), members[node[:-1]][0] if node else -1, len(convs), children[node], leaves[node],
            saved[node], hashlib.sha256(",".join(map(str, ends[node])).encode()).hexdigest(),
        )
        for node, convs in members.items()
    )


def nodes(df, **how):
    rows = prefix_trie.prefix_trie(df, **how).select(COLUMNS).collect()
    return sorted(tuple(-1 if v is None else v for v in r) for r in rows)


@pytest.mark.parametrize("shard_turns", [3, 40, 10_000])
def test_against_brute_force(shipping, shard_turns):
    df = shipping.read.parquet("/root/testdata/sf0.001/conversations.parquet").select("conv_id", "turn", "role", "text")
    rows = [tuple(r) for r in df.collect()]
    assert nodes(df, family=100, shard_turns=shard_turns) == brute(rows)


@pytest.mark.parametrize("shard_turns", [2, 7, 50])
@pytest.mark.parametrize("family", [None, 100])
def test_few_texts_many_copies(shipping, shard_turns, family, monkeypatch):
    monkeypatch.setattr(prefix_trie, "ENDS", 3)
    monkeypatch.setattr(prefix_trie, "ROWS", 5)
    random.seed(shard_turns)
    rows = []
    for c in range(250):
        # A third of the conversations are the same; others share their beginnings.
        length = 3 if c % 3 == 0 else random.randrange(1, 7)
        rows += [(c * 7, t, "user", "same" if c % 3 == 0 else random.choice("abé")) for t in range(length)]
    df = shipping.createDataFrame(rows, SCHEMA).repartition(5)
    assert nodes(df, family=family, shard_turns=shard_turns) == brute(rows, family)


def test_awkward_turns(shipping, monkeypatch):
    monkeypatch.setattr(prefix_trie, "SPLITTER_TURNS", 2)
    rows = [
        (None, 1, "user", "x"), (0, None, None, None), (0, 1, "user", "hello"), (0, 1, "user", "hello"),
        (0, 1, "a", "z"), (1, 3, "user", ""), (1, None, "user", "x" * 100_000), (2, 0, "us", "er"), (3, 0, "user", ""),
        (-5, 1, "user", "hello"), (-5, 2, None, "日本"), (150, 1, "user", "only"),
        *[(7, t, "user", f"{t}") for t in range(300)], *[(8, t, "user", f"{t}") for t in range(299)],
    ]
    df = shipping.createDataFrame(rows, SCHEMA).withColumns(
        {c: F.lit("x") for c in ("_conv", "_path", "_shard", "key", "depth", "ends")}
    )
    for shard_turns in (1, 5, 1000):
        assert nodes(df, shard_turns=shard_turns) == brute(rows, None)


def test_no_conversations(shipping):
    assert nodes(shipping.createDataFrame([], SCHEMA), family=100) == []
