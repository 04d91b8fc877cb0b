import base64
import hashlib
import json
import random
import re
import zlib

import pytest

from rollcall.llm import leaks, queries
from tests.compare import duckdb_tables
from tests.llm.conftest import TEXTS

SMALL = "/root/testdata/sf0.01"


def brute(text):
    found = []
    pattern = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    for m in re.finditer(pattern, text, re.I | re.A):
        if len(m[2]) >= 6:
            found.append((m.start(), 0, "assign", m.end()))
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return [(kind, start, end) for start, _, kind, end in sorted(found)]


def test_against_brute_force(spark):
    docs = dict(duckdb_tables(SMALL).execute("SELECT doc_id, text FROM documents").fetchall())
    rows = queries.registered()["op6_secret_scans"](spark, SMALL).collect()
    assert len(rows) == len(docs)
    for r in rows:
        spans = brute(docs[r.doc_id])
        listed = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert r.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(k == x for k, _, _ in spans) for x in leaks.BASE_KINDS]
        assert set(filter(None, listed.split(","))) <= set(r.spans.split(","))


def test_random_mixes():
    rnd = random.Random(1)
    parts = [
        "password", "passwd", "Secret", "TOKEN", "api_key", "apikey", "api", "=", ":", " ", '"', "'", "é", "ſ",
        "K", "abc", "deadbeef", "0123456789abcdef", "AKIA", "ABCDEFGH12345678", "akia", "-", "\n", "xxxxx", "=token=",
    ]
    for _ in range(5000):
        text = "".join(rnd.choice(parts) for _ in range(rnd.randint(1, 25)))
        assert [s for s in leaks.spans_of(text) if s[0] in leaks.BASE_KINDS] == brute(text), text


def forge(body="A" * 30, wrong=0):
    value, digits = zlib.crc32(body.encode()) + wrong, ""
    for _ in range(6):
        value, digit = divmod(value, 62)
        digits = chr(leaks.BASE62[digit]) + digits
    return body + digits


def bech32_key(wrong=False):
    data = [i % 32 for i in range(52)]
    for last in range(1 << 30):
        # The checksum is what makes the polynomial one; it is computed, not searched for.
        values = [ord(c) >> 5 for c in "age-secret-key-"] + [0] + [ord(c) & 31 for c in "age-secret-key-"] + data + [0] * 6
        check = 1
        for v in values:
            top = check >> 25
            check = (check & 0x1FFFFFF) << 5 ^ v
            for i, step in enumerate(leaks.BECH32_STEPS):
                check ^= step if top >> i & 1 else 0
        check ^= 1
        data += [check >> 5 * (5 - i) & 31 for i in range(6)]
        break
    if wrong:
        data[3] ^= 1
    return "AGE-SECRET-KEY-1" + "".join(leaks.BECH32[d] for d in data).upper()


@pytest.mark.parametrize(
    "kind, good, bad",
    [
        ("forge", "ghp_" + forge(), "ghp_" + forge(wrong=1)),
        ("package", "npm_" + forge("Zz" * 15), "npm_" + forge("Zz" * 15, wrong=1)),
        ("age", bech32_key(), bech32_key(wrong=True)),
        ("signed", base64.urlsafe_b64encode(json.dumps({"alg": "none"}).encode()).decode().rstrip("=") + ".abcdefgh.12345678",
         "eyJhbGciOiJub25l.abcdefgh.12345678"),
    ],
)
def test_checksums(kind, good, bad):
    assert (kind, 2, 2 + len(good)) in leaks.spans_of(f"é {good} x")
    assert kind not in [k for k, _, _ in leaks.spans_of(f"é {bad} x")]


def test_awkward(awkward, nothing):
    rows = leaks.scanned(awkward).collect()
    assert len(rows) == len(TEXTS) and sum(len(r.spans) for r in rows) == 2
    assert leaks.scanned(nothing).collect() == []
    clean = leaks.redacted(awkward)
    assert clean.columns == awkward.columns
    by_id = {r.doc_id: r for r in clean.collect()}
    assert by_id[12].text == '[secret]" and 4111 1111 1111 1111' and by_id[12].n_chars == len(by_id[12].text)
    assert by_id[4].text is None and by_id[5].text == ""
    assert leaks.redacted(awkward.drop("n_chars")).count() == len(TEXTS)
