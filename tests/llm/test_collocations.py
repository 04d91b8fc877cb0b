from collections import Counter, defaultdict

import re

import pytest
from pyspark.sql import functions as F

from rollcall.llm import collocations
from tests.llm.conftest import LONG, TEXTS


def brute(rows, least, top, percent=100):
    """The contract, word by word."""
    counts = defaultdict(Counter)
    for lang, text in rows:
        low = "".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in text or "")
        for piece in re.split("[.,;:!?\n-\r]", low):
            words = re.findall("[^ \t]+", piece)
            for i in range(len(words)):
                for m in range(1, min(5, len(words) - i) + 1):
                    counts[lang or "und"][tuple(words[i : i + m])] += 1
    found = []
    for lang, f in counts.items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        many = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        around = Counter()
        for p, a in many.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    around[p[i : i + m]] = max(around[p[i : i + m]], a)
        kept = []
        for p, a in many.items():
            if around[p] and 100 * around[p] >= percent * a:
                continue
            cuts = [(1000 * a * n // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            kept.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(kept)[:top], 1):
            found.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(found)


def mined(df, **how):
    columns = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(map(tuple, collocations.collocations(df, **how).select(columns).collect()))


@pytest.mark.parametrize("budget", [10, 60, 1 << 20])
def test_against_brute_force(shipping, budget, monkeypatch):
    # Prefixes are extended to all lengths, or not at all.
    df = shipping.read.parquet("/root/testdata/sf0.001/documents.parquet").select("lang", "text")
    rows = [tuple(r) for r in df.collect()]
    assert mined(df.repartition(3), least=5, top=300, budget=budget) == brute(rows, 5, 300)


def test_awkward_texts(awkward):
    df = awkward.withColumn("lang", F.when(F.col("doc_id") > 3, "de"))
    rows = [("de" if (i or 0) > 3 else None, t) for i, t in TEXTS]
    assert mined(df, least=2, top=100) == brute(rows, 2, 100)


def test_segments_share_words(shipping, monkeypatch):
    monkeypatch.setattr(collocations, "CHUNK", 100)
    parts = list(collocations._segments(LONG.encode()))
    assert b"".join(p[:own] for p, own in parts) == LONG.encode()
    counts = Counter()
    for batch in collocations._gathered([one_row("x", LONG)]):
        cut = collocations.Cut(*batch)
        left = [min(5, n) for n in cut.left]
        for i in cut.owned.nonzero()[0]:
            counts[tuple(cut.dictionary[w].as_py() for w in cut.word[i : i + left[i]])] += 1
    monkeypatch.setattr(collocations, "CHUNK", 1 << 30)
    whole = Counter()
    for batch in collocations._gathered([one_row("x", LONG)]):
        cut = collocations.Cut(*batch)
        for i in range(len(cut.word)):
            whole[tuple(cut.dictionary[w].as_py() for w in cut.word[i : i + min(5, cut.left[i])])] += 1
    assert counts == whole


def one_row(lang, text):
    import pyarrow as pa

    return pa.RecordBatch.from_pydict({"_lang": [lang], "_text": [text]})


def test_hot_phrase_and_long_words(shipping):
    rows = [("en", "of the same kind of the same kind")] * 400 + [("en", "w" * 100_000 + " x")] * 3
    rows += [("en", f"of the {i} same") for i in range(200)]
    df = shipping.createDataFrame(rows, "lang string, text string").repartition(4)
    assert mined(df, least=3, top=50, budget=50) == brute(rows, 3, 50)


def test_percent(shipping):
    rows = [("en", "a b c")] * 90 + [("en", "a b")] * 10
    df = shipping.createDataFrame(rows, "lang string, text string")
    for percent in (100, 90, 91):
        assert mined(df, least=2, percent=percent) == brute(rows, 2, 2000, percent)


def test_no_documents(nothing):
    assert mined(nothing.withColumn("lang", F.lit("en"))) == []
