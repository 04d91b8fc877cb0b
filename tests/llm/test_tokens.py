import base64
import hashlib
import heapq
import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from rollcall.llm import bpe, huffman, packing, queries, tokens
from tests.compare import duckdb_tables
from tests.llm.conftest import TEXTS

SMALL = "/root/testdata/sf0.001"
ODD = [
    "", "  ", " \n", "a\x1cb c", "é\u00a0x", "İstanbul ΣΑΣ", "<|endoftext|> x<|startoftext|>", "x" * 300,
    "it's we're 12 34", "A\u0301 b\u0301", "ſK", "a\u00a0  b", "\x85 x", "\u3000日本 語", "\r\n\t x\v\f",
]


@pytest.fixture(scope="module")
def words():
    tokenizer = Tokenizer.from_file(queries.WORD_VOCABULARY)
    tokenizer.encode_special_tokens = True
    return lambda t: np.array(tokenizer.encode(t or "", add_special_tokens=False).ids, "<u4")


@pytest.fixture(scope="module")
def ranked():
    ranks = {}
    for line in open(queries.RANKS, "rb"):
        token, rank = line.split()
        ranks[base64.b64decode(token)] = int(rank)
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return own.encode_ordinary


def documents():
    return duckdb_tables(SMALL).execute("SELECT doc_id, text FROM documents ORDER BY 1").fetchall()


def tree():
    return bpe.tree_encoder(queries.RANKS, public_tokenizers.PATTERN)


def test_bpe_against_tiktoken(spark, ranked):
    texts = dict(documents())
    rows = queries.registered()["op7_byte_bpe"](spark, SMALL).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = ranked(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(["a", "aa", "the ", " the", "  ", "\n", " \n ", "é", "日本", "\u00a0", "\x1c", "\x85",
                                 "12", "!!", "'s", "hahaha", "THE", "😀", "\u0301", "ab" * 20, "x" * 31]), max_size=30))
def test_bpe_of_mixes(ranked, parts):
    text = "".join(parts)
    ids = np.frombuffer(tree().encode([text])[0], "<i4").tolist()
    assert ids == ranked(text) and tree().decode(ids) == text.encode()


def test_bpe_of_long_pieces(ranked):
    rnd = random.Random(4)
    for letters in ("a", "ab", "abcdehilnorst"):
        for size in (25, 200, 3000):
            text = "".join(rnd.choice(letters) for _ in range(size))
            assert tree().piece(text.encode()) == tree().merged(text.encode()) == ranked(text)
    assert np.frombuffer(tree().encode(["a" * 30_000])[0], "<i4").tolist() == ranked("a" * 30_000)


def test_bpe_awkward(awkward, nothing, ranked):
    rows = bpe.tokenised(awkward, queries.RANKS).collect()
    assert sorted((str(r.doc_id), bytes(r.decoded)) for r in rows) == sorted((str(i), (t or "").encode()) for i, t in TEXTS)
    assert bpe.tokenised(nothing, queries.RANKS).collect() == []


def test_words(words):
    encoder = tokens.WordEncoder(queries.WORD_VOCABULARY)
    texts = ODD + [t or "" for _, t in TEXTS]
    for _ in range(2):
        assert encoded(encoder, texts) == [words(t).tobytes() for t in texts]
    with pytest.raises(ValueError, match="white space"):
        tokens.WordEncoder(public_tokenizers.path("byte_bpe_50k.json"))


def encoded(encoder, texts):
    found = []
    for count, ids, sizes in encoder.encode(pa.array(texts, pa.string())):
        assert count == len(sizes)
        found += [part.tobytes() for part in np.split(ids, np.cumsum(sizes))[:-1]]
    return found


def test_letters_before_marks(words):
    # Lower case of U+0130 is two characters, the second of which joins a mark.
    encoder = tokens.WordEncoder(queries.WORD_VOCABULARY)
    texts = [a + chr(code) + b for code in range(1, 0x180) for a in ("", "a", "Q") for b in (".", ",", "a.", ".,", "")]
    assert encoded(encoder, texts) == [words(t).tobytes() for t in texts]


@settings(max_examples=500, deadline=None)
@given(st.lists(st.sampled_from([*"aAzé\u0130ıŉſ.,!'-12 \n\t\u00a0\u0301日", "'s", "'LL", "<|endoftext|>", "the", "ÀÉ", "😀"]), max_size=20))
def test_words_of_mixes(words, parts):
    assert encoded(tokens.word_encoder(queries.WORD_VOCABULARY), ["".join(parts)]) == [words("".join(parts)).tobytes()]


def test_words_in_parts(words, monkeypatch):
    monkeypatch.setattr(tokens, "CHUNK", 64)
    encoder = tokens.WordEncoder(queries.WORD_VOCABULARY)
    texts = ODD + [t or "" for _, t in TEXTS] + ["a b " * 40, "", "end"]
    assert encoded(encoder, texts) == [words(t).tobytes() for t in texts]


def check_files(rows, docs, words):
    start = 0
    for r, (i, text) in zip(sorted(rows, key=lambda r: r[1]), docs, strict=True):
        ids = np.append(words(text), 1).astype("<u4")
        assert tuple(r) == (i, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_files(spark, words):
    check_files(queries.registered()["op8_token_files"](spark, SMALL).collect(), documents(), words)


def test_files_awkward(awkward, nothing, spark, words, tmp_path):
    docs = sorted(TEXTS, key=lambda d: (d[0] is None, d[0] or 0, (d[1] or "").encode()))
    for name, df, want in (("full", awkward, docs), ("empty", nothing, [])):
        huffman.write_ids(df, f"{tmp_path}/{name}", queries.WORD_VOCABULARY, 1)
        rows = huffman.read_ids(spark, f"{tmp_path}/{name}").collect()
        check_files([(r._id, r.start, r.n_tokens, zlib.crc32(r.ids)) for r in rows], want, words)


def test_code_lengths():
    rng = np.random.default_rng(0)
    for n, limit in ((1, 18), (2, 18), (50, 6), (300, 9), (1000, 12), (300, 2)):
        counts = (rng.pareto(0.5, n) * 10).astype(np.int64) + 1
        lengths = huffman.code_lengths(counts, limit)
        assert n == 1 or (0.5**lengths).sum() == 1
        assert lengths.max() <= max(limit, int(n - 1).bit_length())
    counts = rng.integers(1, 100, 200)
    heap, cost = [int(c) for c in counts], 0
    heapq.heapify(heap)
    while len(heap) > 1:
        both = heapq.heappop(heap) + heapq.heappop(heap)
        cost += both
        heapq.heappush(heap, both)
    assert (counts * huffman.code_lengths(counts, 30)).sum() == cost


@pytest.mark.parametrize("n", [0, 1, 255, 256, 257, 5000])
def test_block_round_trip(n):
    rng = np.random.default_rng(n)
    ids = rng.zipf(1.4, n) % 700
    coder = huffman.Coder(huffman.code_lengths(np.bincount(ids, minlength=1), 12))
    names, sizes, start, found = coder.ids(coder.block(ids, [5, None], [min(1, n), max(0, n - 1)], 77))
    assert (names, list(sizes)[:1], start, found.tolist()) == ([5, None], [min(1, n)], 77, ids.tolist())
    with pytest.raises(ValueError, match="block"):
        coder.ids(b"x" * 100)


def check_pieces(rows, docs, words, size=4096):
    """Every id once; sequences without gaps, full or a power of two long."""
    sequences, whole = defaultdict(list), []
    for i, text in docs:
        whole.append((i, np.append(words(text), 2).astype("<u4")))
    by_doc = defaultdict(list)
    for r in rows:
        by_doc[r.doc_id, r.doc_tokens].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    assert sum(r.length for r in rows) == sum(len(ids) for _, ids in whole)
    for i, ids in whole:
        assert {
            (r.start, r.length, r.ids_crc32) for r in by_doc[i, len(ids)]
        } >= set() and all(
            any(r.ids_crc32 == zlib.crc32(x[r.start : r.start + r.length].tobytes()) for j, x in whole if j == i and len(x) == len(ids))
            for r in by_doc[i, len(ids)]
        )
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end == size or (end < size and end & (end - 1) == 0)
    assert sorted(sequences) == list(range(len(sequences)))


def test_packing(spark, words):
    rows = queries.registered()["op9_packing"](spark, SMALL).collect()
    check_pieces(rows, documents(), words)
    docs = duckdb_tables(SMALL).execute("SELECT doc_id, source FROM documents").fetchall()
    source = dict(docs)
    total, share, seen = defaultdict(int), defaultdict(int), 0
    for r in rows:
        total[source[r.doc_id]] += r.length
    full = sum(r.length for r in rows) // 4096
    for r in sorted(rows, key=lambda r: r.sequence_id):
        if r.sequence_id < full // 2:
            share[source[r.doc_id]] += r.length
            seen += r.length
    # After any number of sequences every queue has given its share, to a few tokens.
    for name, tokens_ in total.items():
        assert abs(share[name] - seen * tokens_ / sum(total.values())) <= len(total)


@pytest.mark.parametrize("targets", [None, {"s1": 3, "s0": 1}, {"none": 1}])
def test_packing_awkward(awkward, nothing, words, targets):
    rows = packing.packed(awkward.repartition(3), queries.WORD_VOCABULARY, 2, targets=targets, size=512).collect()
    check_pieces(rows, TEXTS, words, 512)
    assert all(zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length for r in rows)
    assert packing.packed(nothing, queries.WORD_VOCABULARY, 2).collect() == []


@pytest.mark.parametrize("kind", ["none", "targets", "some", "single"])
def test_packing_of_many_sources(spark, shipping, words, kind):
    """Each of 100 sources stays near its share; targets are fractions, the largest come last."""
    rnd = random.Random(3)
    names = [f"n{k:02d}" for k in range(100)]
    own = {n: 1 if kind == "single" else 12 for n in names}
    docs, source = [], {}
    for n in names:
        for _ in range(own[n]):
            source[len(docs)] = n
            docs.append((len(docs), "word " * rnd.randint(5, 25), n))
    targets = {"targets": {n: 0.25 * (k // 10 + 1) for k, n in enumerate(names)}, "some": {n: k + 1 for k, n in enumerate(names[:80])}}.get(kind)
    df = spark.createDataFrame(docs, "doc_id long, text string, source string").repartition(3)
    rows = packing.packed(df, queries.WORD_VOCABULARY, 2, targets=targets, size=256).collect()
    check_pieces(rows, [(i, t) for i, t, _ in docs], words, 256)
    totals = defaultdict(int)
    for r in rows:
        totals[source[r.doc_id]] += r.length
    given, seen, longest = defaultdict(int), 0, max(r.doc_tokens for r in rows)
    weights = targets or totals

    def fluid(time):
        return {n: min(totals[n], time * weights.get(n, 0)) for n in names}

    pieces = sorted(rows, key=lambda r: (r.sequence_id, r.offset))
    for at, r in enumerate(pieces):
        given[source[r.doc_id]] += r.length
        seen += r.length
        if at + 1 < len(pieces) and pieces[at + 1].sequence_id == r.sequence_id:
            continue
        if seen > sum(totals[n] for n in names if weights.get(n)):
            assert all(given[n] == totals[n] for n in names if weights.get(n))
            continue
        low, high = 0.0, max(totals[n] / weights[n] for n in names if weights.get(n))
        for _ in range(60):
            middle = (low + high) / 2
            low, high = (middle, high) if sum(fluid(middle).values()) < seen else (low, middle)
        for n, want in fluid(low).items():
            assert abs(given[n] - want) <= 1.5 * longest + 8, (r.sequence_id, n)


def test_phases_are_bounded():
    totals, weights = list(range(1, 5001)), [k % 7 + 1 for k in range(5000)]
    phases, times = packing.shared_phases(totals, weights)
    assert len(phases) == len(times) <= packing.PHASES and phases[-1][0] == sum(totals)
    assert packing.whole_weights({"a": 0.1, "b": 0.25, "c": 0}) == {"a": 2, "b": 5}


def test_mixtures():
    rnd = random.Random(1)
    for _ in range(200):
        queues = rnd.randint(1, 64 if rnd.random() < 0.1 else 12)
        totals = [rnd.choice([0, rnd.randint(0, 50), rnd.randint(0, 3000)]) for _ in range(queues)]
        targets = None if rnd.random() < 0.5 else [rnd.randint(0, 9) for _ in range(queues)]
        size = 4096 if queues > 12 else 256
        cutter = packing.Cutter(packing.mixture(totals, targets, size))
        sequences = defaultdict(set)
        for queue, total in enumerate(totals):
            place = 0
            while place < total:
                n = min(total - place, rnd.randint(1, 400))
                end = 0
                for start, length, sequence, offset in cutter.pieces(queue, place, n):
                    assert start == end and length > 0
                    end += length
                    taken = set(range(offset, offset + length))
                    assert not taken & sequences[sequence]
                    sequences[sequence] |= taken
                assert end == n
                place += n
        for taken in sequences.values():
            assert max(taken) == len(taken) - 1
            assert len(taken) == size or len(taken) & (len(taken) - 1) == 0
        assert sum(map(len, sequences.values())) == sum(totals)
