"""Document fingerprints by context-triggered piecewise hashing."""

import hashlib
import string
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import batches, text_of
from rollcall.llm.ordering import part_bounds, part_column

#: Most letters of the finer signature; block sizes are the least times powers of two.
LETTERS, LEAST_BLOCK = 64, 3
#: Signatures are alike only if they share a run of so many letters, short ones of fewer.
RUN = 4
ALPHABET = string.ascii_uppercase + string.ascii_lowercase + string.digits + "+/"
_WINDOW, _FACTOR, _MIX = 7, np.uint32(0x01000193), np.uint32(0x2C1B3C6D)
_BLOCK = 1 << 20
_LEVELS = 33
#: Bytes of text that a task fingerprints together.
CHUNK = 1 << 20


def _rolling(octets: np.ndarray) -> np.ndarray:
    """A mixed hash of the last seven bytes, from the seventh byte on."""
    values = octets.astype(np.uint32) + np.uint32(1)
    total = values[: len(values) - _WINDOW + 1].copy()
    for i in range(1, _WINDOW):
        total *= _FACTOR
        total += values[i : len(values) - _WINDOW + 1 + i]
    total ^= total >> np.uint32(15)
    total *= _MIX
    total ^= total >> np.uint32(13)
    return total


def _triggers(buffer: np.ndarray):
    """Positions whose rolling hash ends a chunk, with the largest block size it ends.

    Position ``p`` ends a chunk of block size ``3 * 2**level`` if its hash plus one is a
    multiple of it, so chunks of larger blocks are joined chunks of smaller ones.
    """
    at, levels = [], []
    for start in range(0, len(buffer), _BLOCK):
        piece = buffer[max(0, start - _WINDOW + 1) : start + _BLOCK]
        if start == 0:
            piece = np.concatenate((np.zeros(_WINDOW - 1, np.uint8), piece))
        value = _rolling(piece) + np.uint32(1)
        hits = np.flatnonzero(value % np.uint32(LEAST_BLOCK) == 0)
        value = value[hits]
        lowest = (value & (~value + np.uint32(1))).astype(np.float64)
        at.append(hits + start)
        levels.append(np.where(value == 0, _LEVELS - 1, np.log2(np.maximum(lowest, 1))).astype(np.int64))
    return np.concatenate(at), np.concatenate(levels)


def _signature(octets: bytes, ends) -> str:
    """One letter for each chunk: six bits of its checksum."""
    letters, start = [], 0
    for end in ends:
        letters.append(ALPHABET[zlib.crc32(octets[start:end]) >> 13 & 63])
        start = end
    if start < len(octets):
        letters.append(ALPHABET[zlib.crc32(octets[start:]) >> 13 & 63])
    return "".join(letters)


def fingerprints(texts: list[str]) -> list[str]:
    """``block:signature:signature`` of whole texts, at a block size and at twice that.

    The block size is the smallest at which the signature has at most 64 letters, so no chunk
    is merged or left out.  An empty text has empty signatures.
    """
    parts = [t.encode("utf-8", "surrogatepass") for t in texts]
    pad = bytes(_WINDOW)
    # Zeros before each text: its windows never see the text before.
    buffer = np.frombuffer(b"".join(x for p in parts for x in (pad, p)) or pad, dtype=np.uint8)
    size = np.array([len(p) + _WINDOW for p in parts], dtype=np.int64)
    stops = np.cumsum(size)
    starts = stops - size + _WINDOW
    at, levels = _triggers(buffer)
    own = np.searchsorted(stops, at, side="right")
    inside = at >= starts[own]
    at, levels, own = at[inside], levels[inside], own[inside]
    table = np.bincount(own * _LEVELS + levels, minlength=len(parts) * _LEVELS).reshape(-1, _LEVELS)
    counts = table[:, ::-1].cumsum(axis=1)[:, ::-1]
    level = np.argmax(counts < LETTERS, axis=1)
    edges = np.searchsorted(own, np.arange(len(parts) + 1))
    found = []
    for i, octets in enumerate(parts):
        ends = at[edges[i] : edges[i + 1]] - starts[i] + 1
        high = levels[edges[i] : edges[i + 1]]
        fine, coarse = (_signature(octets, ends[high >= level[i] + k].tolist()) for k in (0, 1))
        found.append(f"{LEAST_BLOCK << int(level[i])}:{fine}:{coarse}")
    return found


def edit_distances(first: list[str], second: list[str]) -> np.ndarray:
    """Levenshtein distances of pairs of signatures of up to 64 letters, bit-parallel."""
    n = len(first)
    rows = np.arange(n)
    sizes = [np.array([len(s) for s in side], dtype=np.int64) for side in (first, second)]
    place = {c: i for i, c in enumerate(ALPHABET)}
    codes = [np.full((n, LETTERS), len(ALPHABET), dtype=np.int64) for _ in sizes]
    for side, grid in zip((first, second), codes, strict=True):
        for i, text in enumerate(side):
            grid[i, : len(text)] = [place[c] for c in text]
    one = np.uint64(1)
    masks = np.zeros((n, len(ALPHABET) + 1), dtype=np.uint64)
    for i in range(LETTERS):
        masks[rows, codes[0][:, i]] |= one << np.uint64(i)
    masks[:, -1] = 0
    last = one << np.maximum(sizes[0] - 1, 0).astype(np.uint64)
    plus, minus = np.full(n, ~np.uint64(0)), np.zeros(n, dtype=np.uint64)
    score = sizes[0].copy()
    for j in range(int(sizes[1].max(initial=0))):
        active = j < sizes[1]
        same = masks[rows, codes[1][:, j]]
        vertical = same | minus
        across = (((same & plus) + plus) ^ plus) | same
        up, down = minus | ~(across | plus), plus & across
        score += active & ((up & last) != 0)
        score -= active & ((down & last) != 0)
        up, down = (up << one) | one, down << one
        plus = np.where(active, down | ~(vertical | up), plus)
        minus = np.where(active, up & vertical, minus)
    return np.where(sizes[0] == 0, sizes[1], score)


def _share_run(a: str, b: str) -> bool:
    """Whether both have a run of ``RUN`` letters; of short ones, of all letters but one."""
    run = min(RUN, max(1, min(len(a), len(b)) - 1))
    runs = {a[i : i + run] for i in range(len(a) - run + 1)}
    return any(b[i : i + run] in runs for i in range(len(b) - run + 1))


def likeness(pairs: list[tuple[str, str]]) -> np.ndarray:
    """How alike two fingerprints are, 0 to 1.

    Signatures at the same block size are compared by edit distance; the better of the two
    sizes they share counts, and block sizes further apart than twice have none.  Equal
    fingerprints are 1, signatures without a common run of letters 0.
    """
    result = np.array([float(a == b) for a, b in pairs])
    rows, left, right = [], [], []
    for i, (a, b) in enumerate(pairs):
        if a == b:
            continue
        block_a, fine_a, coarse_a = a.split(":")
        block_b, fine_b, coarse_b = b.split(":")
        block_a, block_b = int(block_a), int(block_b)
        if block_a == block_b:
            sides = [(fine_a, fine_b), (coarse_a, coarse_b)]
        elif block_a == 2 * block_b:
            sides = [(fine_a, coarse_b)]
        else:
            sides = [(coarse_a, fine_b)] if block_b == 2 * block_a else []
        for x, y in sides:
            if x and y and _share_run(x, y):
                rows.append(i)
                left.append(x)
                right.append(y)
    if rows:
        longest = np.array([max(len(x), len(y)) for x, y in zip(left, right, strict=True)])
        np.maximum.at(result, rows, 1 - edit_distances(left, right) / longest)
    return result


_OUT = pa.schema(
    [("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
     ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())]
)


def _compared(ids, texts, following, prints, next_prints):
    """Output columns of rows whose next texts are known."""
    edited = [t[: len(t) - len(t) // 4] + f[: len(t) // 4] for t, f in zip(texts, following, strict=True)]
    edited_prints = fingerprints(edited)
    columns = [
        pa.array([len(t) for t in texts], pa.int64()),
        pa.array([hashlib.sha256(e.encode("utf-8", "surrogatepass")).hexdigest() for e in edited]),
        pa.array(prints, pa.string()), pa.array(edited_prints, pa.string()),
        pa.array(likeness(list(zip(prints, edited_prints, strict=True)))),
        pa.array(likeness(list(zip(prints, next_prints, strict=True)))),
    ]
    return pa.RecordBatch.from_arrays([pa.array(ids), *columns], ["_id", *_OUT.names])


def compared(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document its fingerprint, that of its edited text, and their likeness.

    The edited text has its last quarter (of code points, rounded down) replaced by as many
    first ones of the next document by ascending id, or all it has; after the last comes the
    first.  Rows of one id are ordered by their texts, null ids come last.  Null and empty
    texts are equal: their edited text is empty too.  A single document is its own next; an
    empty table gives an empty result.  Ids are whole numbers.  Texts of any length are read
    whole; one task holds two at a time.  Other columns, whatever their names, do not matter.

    Documents are cut into parts by id, each with a copy of the row the next part begins with,
    so that texts are shuffled once and every part is read in order by itself.
    """
    kind = dict(docs.dtypes)[id_column]
    rows = docs.select(F.col(id_column).alias("_id"), text_of(text).alias("_text"))
    bounds = part_bounds(rows, "_id", "_text") or [0]
    last = len(bounds) - 1
    starts = F.col("_id").isin(bounds[1:]) if last else F.lit(False)
    own = F.struct(F.col("_part").alias("part"), F.lit(0).alias("ahead"))
    copy = lambda part: F.struct(part.alias("part"), F.lit(1).alias("ahead"))
    first = F.coalesce(F.col("_id") == bounds[0], F.lit(False)) | (
        F.col("_id").isNull() & F.lit(bounds == [0])
    )
    placed = rows.withColumn("_part", part_column("_id", bounds))
    places = F.concat(
        F.array(own),
        F.when(starts, F.array(copy(F.col("_part") - 1))).otherwise(F.array().cast("array<struct<part:int,ahead:int>>")),
        F.when(first, F.array(copy(F.lit(last)))).otherwise(F.array().cast("array<struct<part:int,ahead:int>>")),
    )
    dealt = (
        placed.withColumn("_place", F.explode(places))
        .select("_place.part", "_place.ahead", "_id", "_text")
        .repartitionById(len(bounds), F.col("part"))
        .sortWithinPartitions("part", "ahead", F.col("_id").asc_nulls_last(), "_text")
    )

    def walked(parts):
        held = None
        for batch in parts:
            for a, b in batches(batch.column("_text"), CHUNK):
                piece = batch.slice(a, b - a)
                part, ahead, ids, texts = (c.to_pylist() for c in piece.columns)
                prints = fingerprints(texts)
                if held is not None:
                    part, ahead, ids, texts, prints = (
                        [h, *c] for h, c in zip(held, (part, ahead, ids, texts, prints), strict=True)
                    )
                held = tuple(c[-1] for c in (part, ahead, ids, texts, prints))
                own = [i for i in range(len(part) - 1) if not ahead[i]]
                if own:
                    pick = lambda c, k=0: [c[i + k] for i in own]  # noqa: E731, B023
                    out = _compared(pick(ids), pick(texts), pick(texts, 1), pick(prints), pick(prints, 1))
                    yield out.set_column(0, "_id", out.column(0).cast(piece.schema.field("_id").type))

    schema = (
        f"_id {kind}, n_chars bigint, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double"
    )
    return dealt.mapInArrow(walked, schema).withColumnRenamed("_id", id_column)
