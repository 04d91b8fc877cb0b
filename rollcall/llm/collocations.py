"""Collocations: exact phrase counts from depth-truncated suffix subtrees, one group at a time."""

import re
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rollcall.llm.common import met_by_run, run_number, spans, stored, text_of

#: Words of the longest phrase, and the fewest occurrences of one.
WORDS, LEAST = 5, 100
#: Suffixes that a group of subtrees holds: its memory budget, about 60 bytes each.
BUDGET = 1 << 20
#: A prefix is extended beyond the budget, or beyond this share of all words if that is more, so
#: at most so many prefixes of a length are extended.
EXTENDED = 1 << 20
#: Most cells of the histogram of hashes by which prefixes are grouped.
MOST_CELLS = 1 << 20
#: Pairs of words are counted by this many bits of their hash, in parts of so much text each.
PAIR_BITS, PART_BYTES, MOST_PARTS = 44, 64 << 20, 1 << 16
#: Pairs that a task counts before they travel.
PAIRS = 2 << 20
#: Bits of the filter of frequent pairs.
FILTER_BITS = 1 << 26
#: Bytes of text that are cut together.
CHUNK = 2 << 20
_END = -1
_MIX = np.uint64(0x9E3779B97F4A7C15)
_KIND = np.zeros(256, dtype=np.uint8)
_KIND[[0x20, 0x09]] = 1
_KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = 2
_LOW = np.arange(256, dtype=np.uint8)
_LOW[65:91] += 32
_SEPARATOR = re.compile(rb"[\x20\x09-\x0D.,;:!?]")
_AHEAD = re.compile(rb"[\x20\x09]*(?:[^\x20\x09-\x0D.,;:!?]+[\x20\x09]+){0,%d}[^\x20\x09-\x0D.,;:!?]*" % (WORDS - 1))


def _segments(text: bytes):
    """Parts of a text, and how many of their bytes are theirs: the rest is words that follow."""
    at = 0
    while len(text) - at > CHUNK:
        found = _SEPARATOR.search(text, at + CHUNK)
        if not found:
            break
        yield text[at : _AHEAD.match(text, found.start()).end()], found.start() - at
        at = found.start()
    yield text[at:], len(text) - at


def _gathered(batches):
    """Languages, segments and owned sizes, about ``CHUNK`` bytes at a time."""
    langs, parts, owned, size = [], [], [], 0
    for batch in batches:
        for lang, text in zip(batch.column("_lang"), batch.column("_text"), strict=True):
            for part, own in _segments(text.as_buffer().to_pybytes()):
                langs.append(lang.as_py())
                parts.append(part)
                owned.append(own)
                size += len(part)
                if size >= CHUNK:
                    yield langs, parts, owned
                    langs, parts, owned, size = [], [], [], 0
    if parts:
        yield langs, parts, owned


class Cut:
    """The words of some texts: numbers of words, of languages, and how far each piece goes on.

    ``dictionary`` holds the words and then the languages; ``word`` and ``lang`` are numbers in
    it.  ``left`` is the number of words from a place to the end of its piece.
    """

    def __init__(self, langs: list[str], parts: list[bytes], owned: list[int]):
        # A line break behind each text ends its last piece.
        data = np.frombuffer(b"\n".join(parts) + b"\n", dtype=np.uint8)
        sizes = np.array([len(p) for p in parts], dtype=np.int64)
        begins = np.concatenate(([0], np.cumsum(sizes + 1)[:-1]))
        kind = _KIND[data]
        inside = kind == 0
        starts, ends = spans(inside)
        offsets = np.concatenate(([0], np.cumsum(ends - starts))).astype(np.int32)
        flat = pa.Array.from_buffers(
            pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(_LOW[data[inside]])]
        )
        coded = flat.dictionary_encode()
        words = coded.dictionary.cast(pa.string())
        text = (np.searchsorted(begins, starts, side="right") - 1).astype(np.int32)
        names = sorted(set(langs))
        number = {name: len(words) + i for i, name in enumerate(names)}
        self.dictionary = pa.concat_arrays([words, pa.array(names, pa.string())])
        self.word = coded.indices.to_numpy()
        self.lang = np.array([number[x] for x in langs], dtype=np.int32)[text]
        self.owned = starts < (begins + np.array(owned, dtype=np.int64))[text]
        # A piece ends with its last word: breaks that come before the next word.
        piece = np.searchsorted(np.flatnonzero(kind == 2), starts)
        last = np.zeros(len(piece), dtype=bool)
        last[:-1] = piece[1:] != piece[:-1]
        last[-1:] = True
        self.left = _ahead(last) + 1
        hashes = [xxhash.xxh64_intdigest(w.as_buffer()) for w in self.dictionary]
        self.hash = np.array(hashes, dtype=np.uint64)

    def first(self):
        """The hash of each place's first word in its language."""
        return _mixed(self.hash[self.lang], self.hash[self.word])

    def pair(self, place):
        """The hash of the two words from each place on, cut to ``PAIR_BITS`` bits."""
        state = _mixed(self.first()[place], self.hash[self.word[place + 1]])
        return state >> np.uint64(64 - PAIR_BITS) << np.uint64(64 - PAIR_BITS)

    def linked(self, frequent: np.ndarray):
        """``left`` if rare pairs end pieces too: words from a place on whose pairs are frequent."""
        place = np.flatnonzero(self.left > 1)
        slot = _slot(self.pair(place))
        known = (frequent[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 == 1
        broken = np.ones(len(self.word), dtype=bool)
        broken[place[known]] = False
        return _ahead(broken) + 1


def _slot(pair: np.ndarray) -> np.ndarray:
    """The place of a pair in the filter: the lowest bits of its hash that are kept."""
    return (pair >> np.uint64(64 - PAIR_BITS)) % np.uint64(FILTER_BITS)


def _ahead(marked: np.ndarray) -> np.ndarray:
    """How far ahead of each place the next marked one is, or the end."""
    at = np.append(np.flatnonzero(marked), len(marked))
    place = np.arange(len(marked))
    return (at[np.searchsorted(at, place)] - place).astype(np.int32)


def _mixed(state, value):
    """A hash of a sequence from that of all but the last, and the last."""
    with np.errstate(over="ignore"):
        h = (state ^ (value * _MIX)) * np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(29)
        return h * np.uint64(0x94D049BB133111EB) ^ (h >> np.uint64(32))


class Front:
    """The prefixes that groups are made of: two words, and more where those are too many."""

    def __init__(self, frequent: np.ndarray):
        self.frequent = frequent
        #: From two words on, the sorted hashes of the prefixes that are extended.
        self.extended: list[np.ndarray] = []

    def routes(self, cut: Cut):
        """Places of suffixes, their lengths, the hash and length of the prefix each belongs to."""
        left = np.minimum(cut.linked(self.frequent), WORDS)
        place = np.flatnonzero(cut.owned & (left > 1))
        left, state = left[place], cut.pair(place)
        depth = np.full(len(place), 2, dtype=np.int32)
        for length, known in enumerate(self.extended, 2):
            at = np.minimum(np.searchsorted(known, state), len(known) - 1)
            more = (depth == length) & (known[at] == state)
            depth[more] += 1
            ahead = np.minimum(place[more] + depth[more] - 1, len(cut.word) - 1)
            # Behind the end of a piece comes a word that no text has.
            value = np.where(depth[more] <= left[more], cut.hash[cut.word[ahead]], np.uint64(0))
            state[more] = _mixed(state[more], value)
        return place, left, state, depth


def _sequences(cut: Cut, place, left, width: int):
    """The words from each place on, as numbers; ``_END`` behind the last."""
    rows = np.empty((len(place), width + 1), dtype=np.int32)
    rows[:, 0] = cut.lang[place]
    for j in range(width):
        rows[:, j + 1] = np.where(j < left, cut.word[np.minimum(place + j, len(cut.word) - 1)], _END)
    return rows


def _order(matrix: np.ndarray, size: int) -> np.ndarray:
    """The order of rows of numbers below ``size``, as many columns compared at once as fit."""
    each = max(1, 62 // int(size + 1).bit_length())
    keys = []
    for start in range(0, matrix.shape[1], each):
        key = np.zeros(len(matrix), dtype=np.int64)
        for column in range(start, min(start + each, matrix.shape[1])):
            key = key * (size + 1) + (matrix[:, column] + 1)
        keys.append(key)
    return np.lexsort(keys[::-1])


def _runs(matrix: np.ndarray) -> np.ndarray:
    """Where a sorted matrix has a row unlike the one before."""
    if not len(matrix):
        return np.zeros(0, dtype=np.int64)
    return np.flatnonzero(np.concatenate(([True], (matrix[1:] != matrix[:-1]).any(axis=1))))


def _joined(dictionary, numbers: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """Texts of ``lengths`` numbers each, joined by a space."""
    offsets = pa.array(np.concatenate(([0], np.cumsum(lengths))).astype(np.int32))
    return pc.binary_join(pa.ListArray.from_arrays(offsets, dictionary.take(pa.array(numbers))), " ")


def _words(batches):
    """Counts of the words of each language, per some texts."""
    for part in _gathered(batches):
        cut = Cut(*part)
        pair = cut.lang[cut.owned].astype(np.int64) * len(cut.dictionary) + cut.word[cut.owned]
        used, n = np.unique(pair, return_counts=True)
        take = lambda numbers: cut.dictionary.take(pa.array(numbers))  # noqa: E731, B023
        yield pa.RecordBatch.from_arrays(
            [take(used // len(cut.dictionary)), take(used % len(cut.dictionary)), pa.array(n)],
            ["lang", "phrase", "n"],
        )


def _pairs(part_bits: int):
    """Hashes and counts of the pairs of ``PAIRS`` places at a time, by the first bits."""

    def counted(held):
        used, n = np.unique(np.concatenate(held), return_counts=True)
        part = (used >> np.uint64(64 - part_bits)).astype(np.int32)
        first = _runs(part[:, None])
        bounds = np.append(first, len(part))
        low = (used >> np.uint64(64 - PAIR_BITS)) & np.uint64((1 << 32) - 1)
        # Counts are bytes; what is more comes again.
        full = n // 255
        again = np.repeat(np.arange(len(n)), full)
        for numbers, counts in ((np.arange(len(n)), n % 255), (again, np.full(len(again), 255))):
            kept = numbers[counts > 0]
            at = np.searchsorted(kept, bounds)
            some = np.flatnonzero(np.diff(at))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(part[first[some]]),
                    _slices(low[kept].astype("<u4"), at).take(pa.array(some)),
                    _slices(counts[counts > 0].astype(np.uint8), at).take(pa.array(some)),
                ],
                ["part", "pairs", "n"],
            )

    def read(batches):
        held, size = [], 0
        for part in _gathered(batches):
            cut = Cut(*part)
            held.append(cut.pair(np.flatnonzero(cut.owned & (cut.left > 1))))
            size += len(held[-1])
            if size >= PAIRS:
                yield from counted(held)
                held, size = [], 0
        if size:
            yield from counted(held)

    return read


def _frequent(part_bits: int, least: int):
    """The pairs of a part whose counts add up to ``least`` or more."""

    def read(table: pa.Table) -> pa.Table:
        pairs = np.concatenate([np.frombuffer(x.as_buffer(), "<u4") for x in table.column("pairs")])
        n = np.concatenate([np.frombuffer(x.as_buffer(), np.uint8) for x in table.column("n")])
        order = np.argsort(pairs, kind="stable")
        pairs, first = pairs[order], None
        first = _runs(pairs[:, None])
        total = np.add.reduceat(n[order].astype(np.int64), first) if len(first) else n.astype(np.int64)
        kept = total >= least
        # The first bits, which name the part, may overlap with those that are kept.
        part = np.uint64(table.column("part")[0].as_py())
        high = part << np.uint64(PAIR_BITS - part_bits)
        value = (high >> np.uint64(32) << np.uint64(32)) | pairs[first][kept].astype(np.uint64)
        state = value << np.uint64(64 - PAIR_BITS)
        return pa.table({"hash": state.view(np.int64), "slot": _slot(state).view(np.int64), "n": total[kept]})

    return read


def _extended(front: Front, depth: int):
    """Counts, per some texts, of the prefixes of ``depth`` words whose shorter ones are extended."""

    def counted(batches):
        for part in _gathered(batches):
            cut = Cut(*part)
            place, left, state, at = front.routes(cut)
            here = at == depth
            place, left, state = place[here], left[here], state[here]
            rows = _sequences(cut, place, left, depth)
            order = _order(rows, len(cut.dictionary))
            rows, state = rows[order], state[order]
            first = _runs(rows)
            used = rows[first, 1:]
            text = lambda part: _joined(cut.dictionary, part[part != _END], (part != _END).sum(axis=1))  # noqa: E731, B023
            yield pa.RecordBatch.from_arrays(
                [
                    cut.dictionary.take(pa.array(rows[first, 0])),
                    text(used), text(used[:, :-1]),
                    pa.array(used[:, -1] != _END),
                    pa.array(state[first].view(np.int64)),
                    pa.array(np.diff(np.append(first, len(rows)))),
                ],
                ["lang", "phrase", "above", "whole", "hash", "n"],
            )

    return counted


def _bits(pairs: DataFrame) -> np.ndarray:
    """A filter that holds every frequent pair; it has one size, others may pass it."""
    cells = pairs.groupBy(F.floor(F.col("slot") / 32768).alias("cell")).agg(
        F.bitmap_construct_agg(F.col("slot") % 32768).alias("bits")
    )
    found = np.zeros(FILTER_BITS // 8, dtype=np.uint8)
    for row in cells.collect():
        found[row.cell * 4096 : row.cell * 4096 + 4096] = np.frombuffer(row.bits, np.uint8)
    return found


class Groups:
    """Groups of prefixes with about equal numbers of suffixes, by ranges of their hash."""

    def __init__(self, prefixes: DataFrame, total: int, budget: int):
        wanted = max(2, 8 * total // budget)
        self.bits = min((wanted - 1).bit_length(), MOST_CELLS.bit_length() - 1)
        cell = F.shiftrightunsigned("hash", 64 - self.bits)
        # At most ``MOST_CELLS`` sums.
        found = prefixes.groupBy(cell.alias("cell")).agg(F.sum("n").alias("n")).toArrow()
        sums = np.zeros(1 << self.bits, dtype=np.int64)
        sums[found.column("cell").to_numpy()] = found.column("n").to_numpy()
        # A cell beyond the budget is cut by further bits of the hash.
        over = np.maximum(1, -(-sums // budget))
        self.more = np.ceil(np.log2(over)).astype(np.uint64)
        self.first = np.zeros(len(sums), dtype=np.int64)
        group, held = 0, 0
        for i, n in enumerate(sums.tolist()):
            if held and held + n > budget:
                group, held = group + 1, 0
            self.first[i] = group
            held += n
            if self.more[i]:
                group, held = group + (1 << int(self.more[i])), 0

    def of(self, state: np.ndarray) -> np.ndarray:
        cell = state >> np.uint64(64 - self.bits)
        more = self.more[cell]
        rest = state << np.uint64(self.bits)
        inner = np.where(more > 0, rest >> (np.uint64(64) - np.maximum(more, 1)), 0)
        return self.first[cell] + inner.astype(np.int64)


def _dealt(front: Front, groups: Groups):
    """The suffixes of some texts, packed by group: equal ones once, with their number."""

    def dealt(batches):
        for part in _gathered(batches):
            cut = Cut(*part)
            place, left, state, depth = front.routes(cut)
            if not len(place):
                continue
            rows, size = _sequences(cut, place, left, WORDS), len(cut.dictionary)
            order = _order(rows, size)
            first = _runs(rows[order])
            n = np.diff(np.append(first, len(rows))).astype("<u4")
            kept = order[first]
            group = groups.of(state[kept])
            by_group = np.argsort(group, kind="stable")
            kept, group, n = kept[by_group], group[by_group], n[by_group]
            rows, depth = rows[kept], depth[kept].astype(np.uint8)
            begin = _runs(group[:, None])
            rank = np.repeat(np.arange(len(begin)), np.diff(np.append(begin, len(group))))
            # The words of each group are numbered anew, in the order in which they come.
            local, used = pd.factorize((rank[:, None] * (size + 1) + rows + 1).ravel())
            word = used % (size + 1) - 1
            own = np.searchsorted(used // (size + 1), np.arange(len(begin)))
            local = local.reshape(rows.shape) - own[rank][:, None]
            words = cut.dictionary.take(pa.array(word, mask=word < 0))
            bounds = np.append(begin, len(group))
            kind = np.dtype("<u2" if local.max() < 1 << 16 else "<u4")
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(group[begin]),
                    pa.ListArray.from_arrays(pa.array(np.append(own, len(word)).astype(np.int32)), words),
                    pa.array(np.full(len(begin), kind.itemsize, dtype=np.int32)),
                    _slices(local.astype(kind), bounds),
                    _slices(n, bounds),
                    _slices(depth, bounds),
                ],
                ["group", "words", "wide", "ids", "n", "depth"],
            )

    return dealt


def _slices(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """The bytes of the rows between bounds."""
    offsets = (bounds * values.itemsize * (values.shape[1] if values.ndim > 1 else 1)).astype(np.int32)
    data = np.ascontiguousarray(values)
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def _subtrees(least: int):
    """The frequent nodes of a group's subtrees.

    Sorted, the suffixes are the leaves of the subtrees in order; a node is a run of leaves that
    begin alike, and its count is their total.  Nodes above the prefixes a group is made of are
    left to the counts of prefixes.
    """

    def read(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        lists = table.column("words").combine_chunks()
        flat = lists.flatten()
        coded = flat.dictionary_encode()
        number = coded.indices.fill_null(_END).to_numpy(zero_copy_only=False).astype(np.int64)
        begins = np.concatenate(([0], np.cumsum(pc.list_value_length(lists).to_numpy())[:-1]))
        parts, counts, depths = [], [], []
        for begin, wide, ids, n, depth in zip(
            begins, table.column("wide").to_pylist(), table.column("ids"), table.column("n"),
            table.column("depth"), strict=True,
        ):
            parts.append(number[begin + np.frombuffer(ids.as_buffer(), f"<u{wide}")].astype(np.int32))
            counts.append(np.frombuffer(n.as_buffer(), "<u4"))
            depths.append(np.frombuffer(depth.as_buffer(), np.uint8))
        rows = np.concatenate(parts).reshape(-1, WORDS + 1)
        del parts
        order = _order(rows, len(coded.dictionary))
        rows = rows[order]
        n, depth = np.concatenate(counts)[order].astype(np.int64), np.concatenate(depths)[order]
        langs, phrases, lengths, totals = [], [], [], []
        changed = np.zeros(len(rows), dtype=bool)
        changed[0] = True
        changed[1:] = (rows[1:, :2] != rows[:-1, :2]).any(axis=1)
        for length in range(2, WORDS + 1):
            changed[1:] |= rows[1:, length] != rows[:-1, length]
            first = np.flatnonzero(changed)
            total = np.add.reduceat(n, first)
            kept = (total >= least) & (depth[first] <= length) & (rows[first, length] != _END)
            first, total = first[kept], total[kept]
            langs.append(coded.dictionary.take(pa.array(rows[first, 0])))
            phrases.append(_joined(coded.dictionary, rows[first, 1 : length + 1].ravel(), np.full(len(first), length)))
            lengths.append(np.full(len(first), length, dtype=np.int32))
            totals.append(total)
        return pa.table({
            "lang": pa.concat_arrays(langs), "phrase": pa.concat_arrays(phrases),
            "words": np.concatenate(lengths), "n": np.concatenate(totals),
        })

    return read


def phrase_counts(
    docs: DataFrame,
    lang: str = "lang",
    text: str = "text",
    least: int = LEAST,
    budget: int = BUDGET,
) -> tuple[DataFrame, DataFrame]:
    """The phrases of 1 to 5 words with ``least`` or more occurrences (``lang``, ``phrase``,
    ``words``, ``n``), and the number of all words of each language (``lang``, ``n``).

    A phrase is as frequent as its pairs of words at least, so pairs are counted first, by hash:
    a pair with fewer occurrences than ``least`` ends a piece.  A filter of fixed size tells
    those pairs, and what passes it wrongly only costs time.

    Then prefixes are found by their numbers of suffixes: frequent pairs, and those that have
    more than the ``budget`` extended by the word behind them, and so on, one scan for each
    length, until every prefix fits.  Prefixes are put into groups of about the budget by ranges
    of their hash.  Each suffix (the five words from a place on, less at the end of a piece) goes
    to the group of its prefix, equal ones once per some megabytes of text, and every group
    builds its subtrees by itself.
    """
    rows = docs.select(
        F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("_lang"), text_of(text).alias("_text")
    )
    words = stored(
        rows.mapInArrow(_words, "lang string, phrase string, n bigint")
        .groupBy("lang", "phrase").agg(F.sum("n").alias("n")),
        "words",
    )
    totals = stored(words.groupBy("lang").agg(F.sum("n").alias("n")), "words-of-languages")
    total = totals.agg(F.sum("n")).first()[0] or 0
    limit = max(budget, total // EXTENDED)
    # About six bytes of text a word.
    part_bits = max(12, min(MOST_PARTS, 6 * total // PART_BYTES).bit_length())
    pairs = rows.mapInArrow(_pairs(part_bits), "part int, pairs binary, n binary")
    pairs = stored(
        pairs.groupBy("part").applyInArrow(_frequent(part_bits, least), "hash bigint, slot bigint, n bigint"),
        "pairs",
    )
    front = Front(_bits(pairs))
    prefixes, level, nodes = pairs.select("hash", "n"), pairs, [_nodes(words, "phrase", 1, least)]
    for length in range(2, WORDS):
        # Fewer than total / limit: their counts add up to the total at most.
        hashes = level.where(F.col("n") > limit).select("hash").toArrow()
        if not hashes.num_rows:
            break
        front.extended.append(np.unique(hashes.column("hash").to_numpy().view(np.uint64)))
        found = rows.mapInArrow(
            _extended(front, length + 1),
            "lang string, phrase string, above string, whole boolean, hash bigint, n bigint",
        )
        keys = ["lang", "phrase", "above", "whole", "hash"]
        level = stored(found.groupBy(*keys).agg(F.sum("n").alias("n")), f"prefixes-{length + 1}")
        prefixes = prefixes.unionByName(level.select("hash", "n"))
        # What goes on from an extended prefix, or ends with it, adds up to it.
        nodes.append(_nodes(level.groupBy("lang", "above").agg(F.sum("n").alias("n")), "above", length, least))
        level = level.where("whole")
    groups = Groups(prefixes.where(F.col("n") <= limit), total, budget)
    dealt = rows.mapInArrow(
        _dealt(front, groups), "group bigint, words array<string>, wide int, ids binary, n binary, depth binary"
    )
    read = _subtrees(least)
    found = dealt.groupBy("group").applyInArrow(read, "lang string, phrase string, words int, n bigint")
    return stored(reduce(DataFrame.unionByName, [*nodes, found]), "phrases"), totals


def _nodes(counts: DataFrame, phrase: str, length: int, least: int) -> DataFrame:
    """The frequent ones of counted prefixes of a length, as phrases."""
    return counts.where(F.col("n") >= least).select(
        "lang", F.col(phrase).alias("phrase"), F.lit(length).alias("words"), "n"
    )


def collocations(
    docs: DataFrame,
    lang: str = "lang",
    text: str = "text",
    least: int = LEAST,
    top: int = 2000,
    percent: int = 100,
    budget: int = BUDGET,
) -> DataFrame:
    """The ``top`` phrases of each language: ``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``,
    ``n``, ``score``.

    Letters A-Z are lowered; sentence marks and line breaks cut texts into pieces, spaces and
    tabs pieces into words.  A phrase of 2 to 5 words with ``a >= least`` occurrences, cut after
    its first words into parts with ``l`` and ``r``, scores ``floor(1000 * a * n / (l * r))``;
    the cut with the lowest score counts, of equal ones the first.  A phrase is dropped if a
    longer one that holds it has at least ``percent`` of its occurrences; a longer one has no
    more than any phrase between the two, so those with one more word tell.

    Null texts are empty, a null language is ``und``; repeated rows count as often as they come;
    ids are not used; an empty table has no phrases.  Texts of any length are cut into segments
    that share four words, and words of any length are whole.  Other columns do not matter.
    """
    phrases, totals = phrase_counts(docs, lang, text, least, budget)
    long = phrases.where(F.col("words") > 1).select("lang", "phrase", "words", F.col("n").alias("a"), run_number())
    long = long.withColumn("_words", F.split("phrase", " "))
    cuts = long.select("lang", "phrase", "a", "_words", "_run", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cuts = cuts.select(
        "lang", "phrase", "a", "_run", "k",
        F.array_join(F.slice("_words", F.lit(1), F.col("k")), " ").alias("_first"),
        F.array_join(F.slice("_words", F.col("k") + 1, F.size("_words")), " ").alias("_rest"),
    )
    part = lambda key, count: phrases.select("lang", F.col("phrase").alias(key), F.col("n").alias(count))
    cuts = met_by_run(cuts, part("_first", "l"), ["lang", "_first"])
    cuts = met_by_run(cuts, part("_rest", "r"), ["lang", "_rest"])
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    exact = cuts.join(totals, "lang").withColumn("_over", F.lit(1000).cast("decimal(4,0)") * wide("a") * wide("n"))
    scored = exact.withColumn("_by", wide("l") * wide("r")).withColumn("_score", F.expr("_over div _by"))
    lowest = scored.groupBy("lang", "phrase").agg(
        F.min("a").alias("a"), F.min("n").alias("n"), F.min(F.struct("_score", "k", "l", "r")).alias("_cut")
    )
    inner = F.array(
        F.array_join(F.slice("_words", F.lit(1), F.col("words") - 1), " "),
        F.array_join(F.slice("_words", F.lit(2), F.col("words") - 1), " "),
    )
    around = (
        long.where("words > 2").select("lang", F.explode(inner).alias("phrase"), "a")
        .groupBy("lang", "phrase").agg(F.max("a").alias("_around"))
    )
    left = lowest.join(around, ["lang", "phrase"], "left").where(
        F.col("_around").isNull() | (F.col("_around") * 100 < F.col("a") * percent)
    )
    place = F.row_number().over(
        W.partitionBy("lang").orderBy(F.desc("_cut._score"), F.desc("a"), F.asc("phrase"))
    )
    return left.withColumn("rank", place).where(F.col("rank") <= top).select(
        "lang", F.col("rank").cast("bigint"), "phrase", "a", F.col("_cut.l").alias("l"),
        F.col("_cut.r").alias("r"), "n", F.col("_cut._score").alias("score"),
    )
