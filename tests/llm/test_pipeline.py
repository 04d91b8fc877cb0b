import re
import zlib
from collections import defaultdict

import numpy as np
from tokenizers import Tokenizer

import corpus_pipeline
from rollcall.llm import leaks, quality, queries, simhash
from rollcall.llm.common import stored, table
from tests.llm.test_simhash import brute_print, brute_roots

SMALL = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = table(spark, SMALL, "documents")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stored(stage(spark, docs, SMALL), f"test-{name}")
        seen[name] = before, docs
        if name != "packing":
            assert docs.columns == before.columns
    before, after = seen["quality"]
    scores = {r.doc_id: r.predicted for r in quality.scored(before, table(spark, SMALL, "labels")).collect()}
    assert {r.doc_id for r in after.collect()} == {i for i, p in scores.items() if p}
    before, after = seen["exact_dedup"]
    same = defaultdict(list)
    for r in before.select("doc_id", "text").collect():
        same[re.sub(r"[\x20\x09-\x0D]+", " ", r.text or "")].append(r.doc_id)
    assert {r.doc_id for r in after.collect()} == {min(g) for g in same.values()}
    before, after = seen["simhash_dedup"]
    rows = before.select("doc_id", "text").collect()
    roots = brute_roots([brute_print(r.text) for r in rows], 2)
    groups = defaultdict(list)
    for r in rows:
        groups[roots[brute_print(r.text)]].append(r.doc_id)
    assert {r.doc_id for r in after.collect()} == {min(g) for g in groups.values()}
    before, after = seen["secrets"]
    texts = {r.doc_id: r.text for r in before.collect()}
    assert all(r.text == leaks.masked(texts[r.doc_id]) and r.n_chars == len(r.text) for r in after.collect())
    before, after = seen["packing"]
    assert {r.doc_id for r in after.collect()} == {r.doc_id for r in before.collect()}
    check_pieces(before.collect(), after.collect())
    rows = corpus_pipeline.run(spark, SMALL)
    assert sorted(rows.collect()) == sorted(after.collect())


def check_pieces(docs, pieces):
    """Every id of every document lies in one piece, and sequences have no gaps."""
    tokenizer = Tokenizer.from_file(queries.WORD_VOCABULARY)
    tokenizer.encode_special_tokens = True
    ids = {d.doc_id: np.array([*tokenizer.encode(d.text or "", add_special_tokens=False).ids, 2], "<u4") for d in docs}
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append((p.offset, p.length))
        part = ids[p.doc_id][p.start : p.start + p.length].tobytes()
        assert (zlib.crc32(part), part, p.doc_tokens) == (p.ids_crc32, p.ids, len(ids[p.doc_id]))
    assert by_doc.keys() == ids.keys()
    for name, found in by_doc.items():
        at = 0
        for p in sorted(found, key=lambda p: p.start):
            assert p.start == at
            at += p.length
        assert at == len(ids[name])
    padding = 0
    for found in by_sequence.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at
            at += length
        padding += 0 if at & (at - 1) == 0 else 4096 - at
        assert at <= 4096
    assert padding == 0


def test_awkward_rows_go_through(awkward, nothing, spark):
    labels = f"{SMALL}"
    for docs in (awkward, nothing):
        for _, stage in corpus_pipeline.STAGES:
            docs = stored(stage(spark, docs, labels), "test-awkward")
        assert docs.count() >= 0


def test_copies_without_ids(spark):
    rows = [(None, "same text here now"), (None, "same text here now"), (2, "same text here now"), (2, "same text here now")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert [r.doc_id for r in corpus_pipeline.exact_dedup(spark, docs, SMALL).collect()] == [2]
    assert [r.doc_id for r in corpus_pipeline.simhash_dedup(spark, docs, SMALL).collect()] == [2]
    assert simhash.near_groups(docs).where("kept").count() == 1


def test_signatures_stay_off_the_driver(spark, monkeypatch):
    """No table of the near-copy stage that is made of exploded rows is broadcast."""
    docs = stored(table(spark, SMALL, "documents"), "test-docs")
    plans, kept = [], simhash.stored

    def seen(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return kept(df, name)

    monkeypatch.setattr(simhash, "stored", seen)
    corpus_pipeline.simhash_dedup(spark, docs, SMALL)
    exploded = [p for p in plans if "Generate explode" in p]
    assert exploded and not any("BroadcastExchange" in p for p in exploded)
