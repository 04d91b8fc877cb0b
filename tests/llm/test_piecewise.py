import hashlib
import random

import pytest

from rollcall.llm import ordering, piecewise, queries
from tests.compare import duckdb_tables
from tests.llm.conftest import LONG, TEXTS

SMALL = "/root/testdata/sf0.001"


def brute_print(text):
    octets, window, found = text.encode(), [0] * 7, []
    for i, octet in enumerate(octets):
        window = [*window[1:], octet]
        value = 0
        for x in window:
            value = (value * 0x01000193 + x + 1) & 0xFFFFFFFF
        value ^= value >> 15
        value = value * 0x2C1B3C6D & 0xFFFFFFFF
        value = (value ^ value >> 13) + 1 & 0xFFFFFFFF
        if value % 3 == 0:
            found.append((i + 1, 32 if value == 0 else (value & -value).bit_length() - 1))
    level = 0
    while sum(k >= level for _, k in found) >= 64:
        level += 1
    parts = [piecewise._signature(octets, [e for e, k in found if k >= level + more]) for more in (0, 1)]
    return f"{3 << level}:{parts[0]}:{parts[1]}"


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def walk(docs):
    """``(id, text, edited, next)`` by ascending id, then text; null ids last."""
    docs = sorted(docs, key=lambda d: (d[0] is None, d[0] or 0, (d[1] or "").encode()))
    texts = [t or "" for _, t in docs]
    for i, (name, _) in enumerate(docs):
        text, after = texts[i], texts[(i + 1) % len(docs)]
        quarter = len(text) // 4
        yield name, text, text[: len(text) - quarter] + after[:quarter], after


def test_against_brute_force(spark):
    docs = duckdb_tables(SMALL).execute("SELECT doc_id, text FROM documents").fetchall()
    rows = {r.doc_id: r for r in queries.registered()["op4_piecewise"](spark, SMALL).collect()}
    assert len(rows) == len(docs)
    for name, text, edited, after in walk(docs):
        r = rows[name]
        assert r.n_chars == len(text)
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert (r.fingerprint, r.edited_fingerprint) == (brute_print(text), brute_print(edited))
        assert r.near_next == piecewise.likeness([(r.fingerprint, brute_print(after))])[0]
    near = [r.near_edited for r in rows.values() if r.n_chars > 200]
    assert sum(near) / len(near) > 0.6 and sum(r.near_next for r in rows.values()) / len(rows) < 0.1


@pytest.mark.parametrize("size", [32 << 20, 100_000, 40])
def test_awkward(awkward, nothing, size, monkeypatch):
    # One part, some, or as many as there are ids.
    monkeypatch.setattr(ordering, "PART_BYTES", size)
    rows = piecewise.compared(awkward).collect()
    got = sorted((str(r.doc_id), r.n_chars, r.edited_sha256) for r in rows)
    want = sorted((str(n), len(t), hashlib.sha256(e.encode()).hexdigest()) for n, t, e, _ in walk(TEXTS))
    assert got == want
    assert piecewise.compared(nothing).collect() == []


def test_single_and_nameless_documents(spark):
    for rows in ([(1, "abcdefgh")], [(None, "abcdefgh")], [(None, "abcdefgh"), (None, "b")]):
        got = piecewise.compared(spark.createDataFrame(rows, "doc_id long, text string")).collect()
        want = {hashlib.sha256(e.encode()).hexdigest() for _, _, e, _ in walk(rows)}
        assert {r.edited_sha256 for r in got} == want and len(got) == len(rows)


def test_texts_longer_than_a_block():
    text = LONG * 6
    assert len(text) > piecewise._BLOCK
    assert piecewise.fingerprints(["", text, "x", "a" * 9000]) == [brute_print(t) for t in ("", text, "x", "a" * 9000)]


def test_edit_distances():
    rnd = random.Random(0)
    letters = piecewise.ALPHABET
    pairs = []
    for _ in range(300):
        a = "".join(rnd.choice(letters[: rnd.choice([2, 64])]) for _ in range(rnd.randint(0, 64)))
        b = "".join(c for c in a if rnd.random() < 0.8) + "".join(rnd.choice("ABC") for _ in range(rnd.randint(0, 9)))
        pairs.append((a, b[:64]))
    assert list(piecewise.edit_distances(*zip(*pairs, strict=True))) == [edit_distance(a, b) for a, b in pairs]


def test_parts_follow_the_bytes(spark):
    df = spark.range(0, 4000, 1, 8).selectExpr("id AS _id", "repeat('x', 84) AS _text")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for partitions in ("2", "64"):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            assert abs(len(ordering.part_bounds(df, "_id", "_text", part_bytes=10_000)) - 41) <= 1
            assert len(ordering.part_bounds(df.where("_id < 2000"), "_id", "_text", part_bytes=10_000)) <= 21
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_short_texts_are_alike():
    rnd = random.Random(9)
    texts = ["".join(rnd.choice("abcdefghij klmno") for _ in range(rnd.randint(12, 50))) for _ in range(400)]
    others = ["".join(rnd.choice("abcdefghij klmno") for _ in range(50)) for _ in texts]
    edited = [t[: len(t) - len(t) // 4] + o[: len(t) // 4] for t, o in zip(texts, others, strict=True)]
    prints, edited_prints, other_prints = map(piecewise.fingerprints, (texts, edited, others))
    near = piecewise.likeness(list(zip(prints, edited_prints, strict=True)))
    apart = piecewise.likeness(list(zip(prints, other_prints, strict=True)))
    assert (near > 0).mean() > 0.9 and near.mean() > 0.5
    assert apart.mean() < 0.15
