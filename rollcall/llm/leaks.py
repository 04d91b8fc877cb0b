"""Secret scans: keyword prefilter, anchored patterns near hits, embedded checksums."""

import base64
import binascii
import json
import re
import string
import zlib
from functools import cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import free_name, text_of

#: Kinds whose spans the pattern alone decides, in the order that breaks ties of position.
BASE_KINDS = ["assign", "access", "hex"]
#: Kinds that a checksum or a readable header proves.
PROVEN_KINDS = ["forge", "package", "age", "signed"]
KINDS = BASE_KINDS + PROVEN_KINDS

# Keywords, patterns and least lengths of the kinds.
ASSIGN_WORDS = [b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key"]
ASSIGN = re.compile(
    rb"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I
)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]+")
FORGE_WORDS = [b"ghp_", b"gho_", b"ghu_", b"ghs_", b"ghr_"]
FORGE = re.compile(rb"gh[pousr]_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
PACKAGE = re.compile(rb"npm_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
AGE = re.compile(rb"AGE-SECRET-KEY-1([02-9AC-HJ-NP-Z]{58})(?![A-Z0-9])")
SIGNED = re.compile(rb"(eyJ[A-Za-z0-9_-]{8,})\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}")
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 6, 20, 24
BASE62 = (string.digits + string.ascii_uppercase + string.ascii_lowercase).encode()
BECH32 = "qpzry9x8gf2tvdw0s3jn54khce6mua7l"
BECH32_STEPS = (0x3B6A57B2, 0x26508E6D, 0x1EA119FA, 0x3D4233DD, 0x2A1462B3)

_HEX_CLASS = bytes(104 if b in b"0123456789abcdef" else 32 for b in range(256))
_RUN = b"h" * HEX_LEAST


def crc_proves(match: re.Match) -> bool:
    """The last six base-62 digits are the CRC-32 of the thirty letters before them."""
    value = 0
    for digit in match[2]:
        value = value * 62 + BASE62.index(digit)
    return value == zlib.crc32(match[1])


def bech32_proves(match: re.Match) -> bool:
    """The checksum of a Bech32 string over its prefix and data is one."""
    prefix, data = "age-secret-key-", match[1].decode().lower()
    values = [ord(c) >> 5 for c in prefix] + [0] + [ord(c) & 31 for c in prefix]
    values += [BECH32.index(c) for c in data]
    check = 1
    for value in values:
        top = check >> 25
        check = (check & 0x1FFFFFF) << 5 ^ value
        for i, step in enumerate(BECH32_STEPS):
            check ^= step if top >> i & 1 else 0
    return check == 1


def header_proves(match: re.Match) -> bool:
    """The first part of a signed token is a JSON object that names its algorithm."""
    try:
        header = json.loads(base64.urlsafe_b64decode(match[1] + b"=" * (-len(match[1]) % 4)))
    except (ValueError, binascii.Error):
        return False
    return isinstance(header, dict) and "alg" in header


def long_enough(match: re.Match) -> bool:
    return len(match[2]) >= ASSIGN_LEAST


# kind, its keywords as they look in lower case, the pattern anchored at them, what proves it.
RULES = [
    ("assign", ASSIGN_WORDS, ASSIGN, long_enough),
    ("access", [b"akia"], ACCESS, lambda m: len(m[0]) >= ACCESS_LEAST),
    ("forge", FORGE_WORDS, FORGE, crc_proves),
    ("package", [b"npm_"], PACKAGE, crc_proves),
    ("age", [b"age-secret-key-1"], AGE, bech32_proves),
    ("signed", [b"eyj"], SIGNED, header_proves),
]


@cache
def keyword_automaton():
    found = {}
    for rule, (_, words, _, _) in enumerate(RULES):
        for word in words:
            found.setdefault(word.decode("latin-1"), (len(word), []))[1].append(rule)
    automaton = ahocorasick.Automaton()
    for word, value in found.items():
        automaton.add_word(word, value)
    automaton.make_automaton()
    return automaton


def spans_of(text: str) -> list[tuple[str, int, int]]:
    """``(kind, start, end)`` in code points, by start and then the order of kinds.

    Per kind, matches are leftmost and do not overlap; a match that its rule does not prove
    is dropped, and the scan goes on behind it.
    """
    octets = text.encode("utf-8", "surrogatepass")
    found, behind = [], [0] * len(RULES)
    for last, (size, rules) in keyword_automaton().iter(octets.lower().decode("latin-1")):
        start = last - size + 1
        for rule in rules:
            kind, _, pattern, proves = RULES[rule]
            if start < behind[rule] or not (match := pattern.match(octets, start)):
                continue
            behind[rule] = match.end()
            if proves(match):
                found.append((start, KINDS.index(kind), match.end()))
    runs, at = octets.translate(_HEX_CLASS), 0
    while (at := runs.find(_RUN, at)) >= 0:
        end = HEX.match(octets, at).end()
        found.append((at, KINDS.index("hex"), end))
        at = end
    if not found:
        return []
    found.sort()
    place = {0: 0}
    at = points = 0
    for offset in sorted({x for start, _, end in found for x in (start, end)}):
        points += len(octets[at:offset].decode("utf-8", "surrogatepass"))
        place[offset], at = points, offset
    return [(KINDS[kind], place[start], place[end]) for start, kind, end in found]


def span_column(text: str) -> Column:
    """The spans of a text column."""

    kind = pa.list_(
        pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
    )

    @F.arrow_udf("array<struct<kind:string,start:bigint,end:bigint>>")
    def scan(texts: pa.Array) -> pa.Array:
        found = (spans_of(text.as_py()) for text in texts)
        return pa.array([[dict(zip(("kind", "start", "end"), s, strict=True)) for s in f] for f in found], kind)

    return scan(text_of(text))


def span_text(spans: str) -> Column:
    """Spans as ``kind:start:end``, joined by commas."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def scanned(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: its id, ``base`` and all ``spans`` as arrays.

    Null and empty texts have empty arrays.  Repeated rows, null ids and other columns do not
    matter.
    """
    found = docs.select(F.col(id_column), span_column(text).alias("spans"))
    return found.select(
        id_column,
        F.filter("spans", lambda s: s["kind"].isin(BASE_KINDS)).alias("base"),
        "spans",
    )


def masked(text: str, mark: str = "[secret]") -> str:
    """The text with every span, or union of overlapping ones, replaced by a mark."""
    parts, at = [], 0
    for _, start, end in spans_of(text):
        if start >= at:
            parts += [text[at:start], mark]
        at = max(at, end)
    return "".join(parts) + text[at:]


def redacted(docs: DataFrame, text: str = "text", size: str = "n_chars") -> DataFrame:
    """The rows with every secret in the text masked; a column ``size`` counts anew.

    Rows without a secret stay as they are, null texts included.
    """

    @F.arrow_udf("string")
    def clean(texts: pa.Array) -> pa.Array:
        return pa.array([masked(t.as_py()) if t.is_valid else None for t in texts], pa.string())

    name = free_name(docs, "_clean")
    found = docs.withColumn(name, clean(F.col(text).cast("string")))
    changed = F.col(text) != F.col(name)
    anew = {text: F.col(name)}
    if size in docs.columns:
        count = F.length(name).cast(docs.schema[size].dataType)
        anew[size] = F.when(changed, count).otherwise(F.col(size))
    return found.select([anew.get(c, F.col(c)).alias(c) for c in docs.columns])
