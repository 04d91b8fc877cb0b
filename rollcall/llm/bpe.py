"""Byte-level BPE by tree reduction: halves are encoded apart and joined at their boundary."""

import base64
import re
from array import array
from functools import cache
from heapq import heapify, heappop, heappush

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import batches, text_of
from rollcall.llm.tokens import LONG, Remembered

#: Bytes that are merged directly; longer pieces are halved.  The encodings of so few bytes, and
#: of windows of twice as many, recur and are remembered.
LEAF = 6
#: Bytes up to which the lowest rank is looked for by a plain scan.
DIRECT = 64
#: Segments of texts that a worker remembers: so many recent ones, and as many before them.
REMEMBERED = 500_000
#: Matches of the pattern, and short byte strings and pairs of tokens, that a worker remembers.
PIECES, LEAVES = 100_000, 200_000
#: Ids that are decoded directly; longer lists are halved.
LEAF_IDS = 1 << 14
CHUNK = 2 << 20

_SEGMENT = re.compile(r"[ \t-\r]*[^ \t-\r]+|[ \t-\r]+")
_OTHER_SPACE = re.compile("[\x85\xa0  -     　]")


class TreeEncoder:
    """Encodes by ranks; each match of the pattern is a piece of its own.

    A list of tokens is the encoding of its bytes exactly if each two neighbours are the
    encoding of theirs.  So two encodings may be joined at any place where the tokens on both
    sides are compatible, and nothing further away can change.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pattern = ranks, regex.compile(pattern)
        self.octets = [b""] * (max(ranks.values(), default=-1) + 1)
        for octets, rank in ranks.items():
            self.octets[rank] = octets
        #: The token that two neighbours become, by their ids.
        self.width = len(self.octets)
        self.merges = {
            ranks[octets[:i]] * self.width + ranks[octets[i:]]: rank
            for octets, rank in ranks.items()
            for i in range(1, len(octets))
            if octets[:i] in ranks and octets[i:] in ranks
        }
        self.single = [ranks.get(bytes([o]), -1) for o in range(256)]
        if -1 in self.single:
            raise ValueError("the ranks lack a byte")
        self.recent, self.before = Remembered(self._segment), {}
        self.pieces, self.pairs, self.leaves = {}, {}, {}

    def merged(self, octets: bytes) -> list[int]:
        """The encoding of a few bytes: the neighbours of lowest rank are merged, leftmost first."""
        if len(octets) > DIRECT:
            return self._merged_by_heap(octets)
        get, width, none = self.merges.get, self.width, self.width
        parts = [self.single[o] for o in octets]
        costs = [get(a * width + b, none) for a, b in zip(parts, parts[1:], strict=False)]
        while costs and (least := min(costs)) < none:
            i = costs.index(least)
            parts[i] = least
            del parts[i + 1], costs[i]
            if i < len(costs):
                costs[i] = get(least * width + parts[i + 1], none)
            if i:
                costs[i - 1] = get(parts[i - 1] * width + least, none)
        return parts

    def _merged_by_heap(self, octets: bytes) -> list[int]:
        """The same for many bytes, with the neighbours in a heap by rank and place."""
        get, width = self.merges.get, self.width
        parts = [self.single[o] for o in octets]
        after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
        heap = [
            (rank, i) for i in range(len(parts) - 1)
            if (rank := get(parts[i] * width + parts[i + 1])) is not None
        ]
        heapify(heap)
        while heap:
            rank, i = heappop(heap)
            j = after[i]
            if parts[i] < 0 or j >= len(parts) or get(parts[i] * width + parts[j]) != rank:
                continue
            parts[i], parts[j], after[i] = rank, -1, after[j]
            if after[i] < len(parts):
                before[after[i]] = i
            for left in (before[i], i):
                right = after[left] if left >= 0 else len(parts)
                if right < len(parts) and (found := get(parts[left] * width + parts[right])) is not None:
                    heappush(heap, (found, left))
        return [p for p in parts if p >= 0]

    def few(self, octets: bytes) -> list[int]:
        """The encoding of a few bytes, remembered."""
        known = self.leaves.get(octets)
        if known is None:
            if len(self.leaves) >= LEAVES:
                self.leaves.clear()
            known = self.leaves[octets] = self.merged(octets)
        return known

    def compatible(self, left: int, right: int) -> bool:
        """Whether two tokens side by side are the encoding of their bytes."""
        key = left * self.width + right
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= LEAVES:
                self.pairs.clear()
            known = self.merged(self.octets[left] + self.octets[right]) == [left, right]
            self.pairs[key] = known
        return known

    def joined(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of both sides' bytes.

        The tokens at the boundary are encoded anew in a window that grows to the side where
        its outer token is not compatible with the one beyond; once it is, or nothing is
        beyond, the tokens outside are proved to stay.
        """
        if not left or not right or self.compatible(left[-1], right[0]):
            return left + right
        a = b = 1
        while True:
            window = b"".join([self.octets[t] for t in left[-a:] + right[:b]])
            inner = self.few(window) if len(window) <= 2 * LEAF else self.merged(window)
            open_left = a < len(left) and not self.compatible(left[-a - 1], inner[0])
            open_right = b < len(right) and not self.compatible(inner[-1], right[b])
            if not open_left and not open_right:
                return left[:-a] + inner + right[b:]
            a = min(len(left), a * 2) if open_left else a
            b = min(len(right), b * 2) if open_right else b

    def piece(self, octets: bytes) -> list[int]:
        """The encoding of a piece by halves."""
        if len(octets) <= LEAF:
            return self.few(octets)
        half = len(octets) // 2
        return self.joined(self.piece(octets[:half]), self.piece(octets[half:]))

    def _match(self, match: str) -> bytes:
        """The ids of one match of the pattern."""
        octets = match.encode("utf-8", "surrogatepass")
        whole = self.ranks.get(octets)
        return array("i", self.piece(octets) if whole is None else [whole]).tobytes()

    def _held(self, match: str) -> bytes:
        ids = self.pieces.get(match)
        if ids is None:
            if len(self.pieces) >= PIECES:
                self.pieces.clear()
            ids = self._match(match)
            if len(match) <= LONG:
                self.pieces[match] = ids
        return ids

    def _segment(self, segment: str) -> bytes:
        known = self.before.get(segment)
        if known is not None:
            return known
        last, own = segment[-1], segment[1:] if segment[0] == " " else segment
        if last in ",." and segment[-2:-1].isalpha():
            # A match never goes from a letter on to a mark.
            return self.recent[segment[:-1]] + self.recent[last]
        if own.isalpha():
            return self._match(segment)
        return b"".join(map(self._held, self.pattern.findall(segment)))

    def _segments(self, text: str) -> list[str]:
        """Cuts at which a match of the pattern always ends, whatever stands beside them.

        No match goes from a visible character on to white space, and none looks back.  With
        other white space than the ASCII kind the text stays whole.
        """
        if not text.isascii() and _OTHER_SPACE.search(text):
            return [text]
        return _SEGMENT.findall(text)

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as 32-bit integers; a segment is encoded once while remembered."""
        if len(self.recent) > REMEMBERED:
            self.recent, self.before = Remembered(self._segment), self.recent
        ids = self.recent.__getitem__
        return [b"".join(map(ids, self._segments(t))) for t in texts]

    def decode(self, ids: list[int]) -> bytes:
        """The bytes of a list of ids, put together up the tree."""
        if len(ids) <= LEAF_IDS:
            return b"".join(map(self.octets.__getitem__, ids))
        half = len(ids) // 2
        return self.decode(ids[:half]) + self.decode(ids[half:])


@cache
def tree_encoder(ranks_path: str, pattern: str) -> TreeEncoder:
    """One encoder for each worker, vocabulary and pattern."""
    ranks = {}
    with open(ranks_path, "rb") as lines:
        for line in lines:
            token, rank = line.split()
            ranks[base64.b64decode(token)] = int(rank)
    return TreeEncoder(ranks, pattern)


def encoded(text: str, ranks_path: str, pattern: str = public_tokenizers.PATTERN) -> Column:
    """The ids of a text column; null texts count as empty, empty ones have no ids."""

    @F.arrow_udf("array<int>")
    def encode(column: pa.Array) -> pa.Array:
        encoder, sizes, found = tree_encoder(ranks_path, pattern), [0], []
        for a, b in batches(column, CHUNK):
            part = encoder.encode(column.slice(a, b - a).to_pylist())
            sizes += [len(ids) // 4 for ids in part]
            found.append(b"".join(part))
        ids = pa.array(np.frombuffer(b"".join(found), dtype="<i4"), pa.int32())
        return pa.ListArray.from_arrays(pa.array(np.cumsum(sizes), pa.int32()), ids)

    return encode(text_of(text))


def decoded(ids: str, ranks_path: str, pattern: str = public_tokenizers.PATTERN) -> Column:
    """The bytes of a column of ids; null ids are no bytes."""

    @F.arrow_udf("binary")
    def decode(column: pa.Array) -> pa.Array:
        encoder = tree_encoder(ranks_path, pattern)
        column = column.fill_null(pa.scalar([], column.type))
        values, ends = column.values.to_numpy(), column.offsets.to_numpy()
        found = [
            encoder.decode(values[a:b].tolist()) for a, b in zip(ends[:-1], ends[1:], strict=True)
        ]
        return pa.array(found, pa.binary())

    return decode(F.col(ids))


def tokenised(
    docs: DataFrame, ranks_path: str, id_column: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per document: its id, ``ids``, and the bytes ``decoded`` from them.

    Null and empty texts have no ids and no bytes.  Repeated rows, null ids and other columns
    do not matter; texts are not moved.
    """
    rows = docs.select(F.col(id_column), encoded(text, ranks_path).alias("ids"))
    return rows.withColumn("decoded", decoded("ids", ranks_path))
