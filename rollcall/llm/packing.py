"""Mixture-controlled packing of tokenised documents into sequences."""

import zlib
from bisect import bisect_right
from dataclasses import dataclass
from fractions import Fraction
from functools import lru_cache
from math import isqrt, lcm

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rollcall.llm.common import batches, run_number, stored, text_of
from rollcall.llm.tokens import forget, id_slices, id_type, word_encoder

#: Tokens of a sequence.
SEQUENCE = 4096
#: Sources with a queue of their own; the others share one more, in which they take turns.
QUEUES = 63
#: Changes of the shared queue's weight that are told apart.
PHASES = 1000
#: Tokens of the shared queue that are put in order together, and the most such parts.
PART, MOST_PARTS = 1 << 20, 20_000
#: Fractions of a token that count as none.
_LEAST = 1e-6
CHUNK = 2 << 20


@dataclass(frozen=True)
class Stretch:
    """Windows ``first`` to ``first + windows - 1``, filled by one rule.

    ``taken[k]`` tokens of queue ``k`` lie before.  With ``shares``, queue ``k`` may give
    ``size * shares[k] / total`` tokens a window: after ``i`` windows it has given the whole
    part of ``i`` times that, so the fraction a window leaves over is carried to the next,
    whichever task fills it; the ``filler`` queue gives what is missing.  ``owed[k]``, below
    ``total``, is the fraction the stretches before left over.  Without shares there is one
    window, and ``gives`` tells what each queue gives.
    """

    first: int
    windows: int
    taken: tuple[int, ...]
    shares: tuple[int, ...] = ()
    total: int = 0
    filler: int = 0
    size: int = SEQUENCE
    gives: tuple[int, ...] = ()
    owed: tuple[int, ...] = ()

    def given(self, queue: int, i: int) -> int:
        """Tokens a queue has given in the first ``i`` windows of the stretch."""
        if not self.shares:
            return self.gives[queue] if i else 0
        if queue != self.filler:
            return (i * self.size * self.shares[queue] + self.owed[queue]) // self.total
        others = sum(
            (i * self.size * s + o) // self.total
            for k, (s, o) in enumerate(zip(self.shares, self.owed, strict=True)) if k != queue
        )
        return i * self.size - others

    def window_of(self, queue: int, position: int) -> int:
        """The window of the stretch a queue's token lies in, counted from its first."""
        if not self.shares:
            return 0
        step = self.size * self.shares[queue]
        i = max(0, -(-(position + 1) * self.total // step) - 1)
        while i and self.given(queue, i) > position:
            i -= 1
        while self.given(queue, i + 1) <= position:
            i += 1
        return i


def mixture(
    totals: list[int],
    targets: list[int] | None = None,
    size: int = SEQUENCE,
    phases: list[tuple[int, int]] = (),
) -> list[Stretch]:
    """Stretches that take every token of the queues, in their target proportions.

    Targets are weights, by default the totals, so that all queues end together.  When a
    queue runs dry the others go on in their proportions, and those without a weight come
    last, in proportion to their tokens.  ``phases`` are ends and weights for the last queue:
    its weight until it has given so many tokens, then none.  The last stretch holds the
    rest, less than a sequence.
    """
    weights = list(targets or totals)
    left, done, first, found = list(totals), [0] * len(totals), 0, []
    # Fractions of tokens that queues are behind their shares.
    behind = [0.0] * len(totals)
    ends = [end for end, _ in phases]

    def shares_after(given):
        if phases:
            phase = bisect_right(ends, done[-1] + given[-1] + _LEAST)
            weights[-1] = phases[phase][1] if phase < len(phases) else 0
        have = [n - g for n, g in zip(left, given, strict=True)]
        shares = [w if h > _LEAST else 0 for w, h in zip(weights, have, strict=True)]
        return shares if any(shares) else [n if h > _LEAST else 0 for n, h in zip(left, have, strict=True)]

    def to_phase_end(given):
        phase = bisect_right(ends, done[-1] + given[-1] + _LEAST)
        return ends[phase] - done[-1] - given[-1] if phase < len(ends) else None

    while sum(left) >= size:
        none = [0] * len(left)
        shares, until = shares_after(none), to_phase_end(none)
        total, filler = sum(shares), max(range(len(left)), key=lambda k: shares[k])
        windows = min(
            max(0, left[k] - (len(left) if k == filler else 0)) * total // (size * s)
            for k, s in enumerate(shares)
            if s
        )
        if until is not None and shares[-1]:
            windows = min(windows, until * total // (size * shares[-1]))
        if windows:
            owed = [
                min(int(x * total), total - 1) if s and k != filler else 0
                for k, (x, s) in enumerate(zip(behind, shares, strict=True))
            ]
            part = Stretch(first, windows, tuple(done), tuple(shares), total, filler, size, owed=tuple(owed))
            gives = [part.given(k, windows) if s else 0 for k, s in enumerate(shares)]
            behind = [
                (windows * size * s + o) % total / total if k != filler else 0.0
                for k, (s, o) in enumerate(zip(shares, owed, strict=True))
            ]
        else:
            # A queue or a phase ends in this window: from one end to the next.
            windows, want = 1, [min(x, have) for x, have in zip(behind, left, strict=True)]
            room = size - sum(want)
            while room > _LEAST and any(now := shares_after(want)):
                steps = [(have - x) / s for have, x, s in zip(left, want, now, strict=True) if s]
                until = to_phase_end(want)
                if until is not None and now[-1]:
                    steps.append(until / now[-1])
                step = min(room / sum(now), *steps)
                want = [min(have, x + step * s) for have, x, s in zip(left, want, now, strict=True)]
                room = size - sum(want)
            gives = [min(have, int(x + _LEAST)) for have, x in zip(left, want, strict=True)]
            for k in sorted(range(len(left)), key=lambda k: (k != filler, -shares[k])):
                gives[k] += min(left[k] - gives[k], size - sum(gives))
            behind = [min(max(x - g, 0.0), 1 - _LEAST) for x, g in zip(want, gives, strict=True)]
            part = Stretch(first, 1, tuple(done), size=size, gives=tuple(gives))
        found.append(part)
        first += windows
        done = [d + g for d, g in zip(done, gives, strict=True)]
        left = [have - g for have, g in zip(left, gives, strict=True)]
    if sum(left):
        found.append(Stretch(first, 1, tuple(done), size=size, gives=tuple(left)))
    return found


def whole_weights(targets: dict) -> dict[str, int]:
    """Positive targets as whole numbers in the same proportions."""
    exact = {name: Fraction(str(t)) for name, t in targets.items()}
    scale = lcm(*(t.denominator for t in exact.values()))
    return {name: int(t * scale) for name, t in exact.items() if t > 0}


def shared_phases(totals: list[int], weights: list[int]) -> tuple[list[tuple[int, int]], list[float]]:
    """The phases of a queue that sources with these totals and weights share, and their times.

    A source gives its weight a unit of time and is dry at total / weight; then the weight of
    the queue is that of the others.  Beyond ``PHASES`` changes, neighbouring ones are taken
    together at their mean weight.
    """
    dry = sorted((n / w, w, n) for n, w in zip(totals, weights, strict=True))
    active, at, given, ends = sum(weights), 0.0, 0.0, []
    for time, weight, _ in dry:
        given += active * (time - at)
        ends.append((time, given, active))
        active, at = active - weight, time
    step, phases, times, since = -(-len(ends) // PHASES), [], [], (0.0, 0.0)
    for k in range(len(ends)):
        time, given, active = ends[k]
        if (k + 1) % step and k + 1 < len(ends):
            continue
        end = sum(totals) if k + 1 == len(ends) else round(given)
        if time > since[0] and end > (phases[-1][0] if phases else 0):
            mean = active if step == 1 else max(1, round((given - since[1]) / (time - since[0])))
            phases.append((end, mean))
            times.append(time)
            since = (time, given)
    if phases:
        phases[-1] = (sum(totals), phases[-1][1])
    return phases, times


class Cutter:
    """Cuts documents of a queue into pieces, given the stretches."""

    def __init__(self, stretches: list[Stretch]):
        self.stretches = stretches
        queues = range(len(stretches[0].taken)) if stretches else ()
        self.starts = [[s.taken[k] for s in stretches] for k in queues]
        self.layout = lru_cache(4096)(self._layout)
        last = stretches[-1] if stretches else None
        # The rest is laid out in sequences of powers of two: no padding.
        self.rest = []
        if last and not last.shares and sum(last.gives) < last.size:
            at, left = 0, sum(last.gives)
            while left:
                power = 1 << (left.bit_length() - 1)
                self.rest.append(at)
                at, left = at + power, left - power

    def _layout(self, stretch: int, i: int):
        """For each queue the tokens given before a window, and where in the window it begins."""
        part = self.stretches[stretch]
        before = [part.given(k, i) if part.gives or part.shares[k] else 0 for k in range(len(part.taken))]
        after = [part.given(k, i + 1) if part.gives or part.shares[k] else 0 for k in range(len(part.taken))]
        begins = np.concatenate(([0], np.cumsum(np.array(after) - np.array(before)))).tolist()
        return before, after, begins

    def pieces(self, queue: int, position: int, length: int):
        """``(start, length, sequence, offset)`` of a document at a place in its queue."""
        start = 0
        while start < length:
            at = position + start
            # The last stretch that begins at or before the token: later ones give none of it.
            stretch = bisect_right(self.starts[queue], at) - 1
            part = self.stretches[stretch]
            inside = at - part.taken[queue]
            i = part.window_of(queue, inside)
            before, after, begins = self.layout(stretch, i)
            size = min(length - start, after[queue] - inside)
            sequence, offset = part.first + i, begins[queue] + inside - before[queue]
            if self.rest and stretch == len(self.stretches) - 1:
                cut = bisect_right(self.rest, offset) - 1
                if cut + 1 < len(self.rest):
                    size = min(size, self.rest[cut + 1] - offset)
                sequence, offset = sequence + cut, offset - self.rest[cut]
            yield start, size, sequence, offset
            start += size


def _tokenised(docs, id_column, text, source, vocabulary, end_id):
    """Each document's ids, and where they begin among those of its source in its run."""
    kind = dict(docs.dtypes)[id_column]

    def encoded(parts):
        encoder, narrow = word_encoder(vocabulary), id_type(vocabulary)
        totals = {}
        for batch in parts:
            first = 0
            for count, flat, sizes in encoder.encode(batch.column("_text")):
                piece, first = batch.slice(first, count), first + count
                ends = np.cumsum(sizes)
                # The end id comes behind the ids of each document.
                ids, sizes, at = np.insert(flat, ends, end_id).astype(narrow), sizes + 1, []
                for own, size in zip(piece.column("_source").to_pylist(), sizes.tolist(), strict=True):
                    at.append(totals.get(own, 0))
                    totals[own] = at[-1] + size
                yield pa.RecordBatch.from_arrays(
                    [piece.column("_id"), piece.column("_source"), piece.column("_run"),
                     pa.array(at, pa.int64()), pa.array(sizes, pa.int64()), id_slices(ids, sizes)],
                    ["_id", "_source", "_run", "_at", "_n", "_ids"],
                )

    rows = docs.select(
        F.col(id_column).alias("_id"),
        # A text that tells a missing source from every name.
        F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit("")).alias("_source"),
        run_number(), text_of(text).alias("_text"),
    )
    schema = f"_id {kind}, _source string, _run bigint, _at bigint, _n bigint, _ids binary"
    return stored(rows.mapInArrow(encoded, schema), "tokens", "zstd")


def _taking_turns(met: DataFrame, targets: bool, times: list[float], given: list[int]) -> DataFrame:
    """``_id``, ``_queue``, ``_ids`` of the shared queue's documents and their place ``_at`` in it.

    ``given`` are the tokens the queue has given at ``times``, between which it is linear: the
    parts it is cut into hold about equal numbers of tokens, are ordered on their own, and
    begin where those before them end.
    """
    parts = min(MOST_PARTS, given[-1] // PART + 1)

    @F.arrow_udf("int")
    def part(moments: pa.Array) -> pa.Array:
        about = np.interp(moments.to_numpy(zero_copy_only=False), times, given)
        return pa.array(np.minimum(about * (parts / given[-1]), parts - 1).astype(np.int32))

    phase = F.shiftrightunsigned(F.xxhash64("_source"), 11) / float(1 << 53)
    inside = F.col("_at") + phase * F.col("_n")
    last = F.lit(times[-2] if targets else 0.0)
    moment = F.when(F.col("_weight") > 0, inside / F.col("_weight")).otherwise(last + inside / F.col("_total"))
    timed = met.withColumn("_time", moment).withColumn("_part", part("_time"))
    sums = {r._part: r.n for r in timed.groupBy("_part").agg(F.sum("_n").alias("n")).collect()}
    begins, at = [], 0
    for k in sorted(sums):
        begins.append((k, at))
        at += sums[k]
    starts = met.sparkSession.createDataFrame(begins, "_part int, _start bigint")
    before = (
        W.partitionBy("_part").orderBy("_time", "_source", "_run", "_at").rowsBetween(W.unboundedPreceding, -1)
    )
    return (
        timed.withColumn("_inside", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .join(F.broadcast(starts), "_part")
        .select("_id", "_queue", (F.col("_start") + F.col("_inside")).alias("_at"), "_ids")
    )


def packed(
    docs: DataFrame,
    vocabulary: str,
    end_id: int,
    id_column: str = "doc_id",
    text: str = "text",
    source: str = "source",
    targets: dict[str, int] | None = None,
    size: int = SEQUENCE,
) -> DataFrame:
    """One row per piece: id, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``,
    ``sequence_id``, ``offset``, and the piece's ``ids`` (32-bit, little-endian).

    Each source is a queue of its documents in the order of the input.  Every sequence takes
    from each queue its target share of tokens, by default the source's share of all tokens
    (``targets`` maps sources to weights, which may be fractions; sources it lacks weigh
    nothing until the others are empty, then what they have).  Documents are cut where a share
    ends.  The fractions of tokens a sequence cannot hold are carried on, so after any number
    of sequences a queue is less than a token behind its share.

    The 63 sources with the largest targets, then the most tokens, have queues of their own
    (fewer where a sequence has less than 4,096 tokens: a queue's share fills what the others
    round off), so the state of the mixture is bounded however many sources there are.  The others share
    one more with the sum of their weights, in which whole documents take turns: they are
    ordered by the time at which their source, giving its weight a unit of time, comes to
    them, so each source stays about a document from its share.  A fixed phase by the
    source's name keeps sources of one document from meeting at one time.

    Sequences are full; the rest is laid out in sequences of powers of two.  A null text counts
    as empty: its document is ``end_id`` alone.  Null sources are one source.  Repeated rows
    and null ids are documents like others, ids of any type; an empty table has no pieces.
    Texts of any length are encoded whole and cut; other columns, whatever their names, do not
    matter.

    Documents of a queue of their own never move: each task computes the windows of its
    documents from the number of tokens before them, which is summed up by run and source.
    Those of the shared queue move once, to parts of about equal numbers of tokens by time.
    """
    kind = dict(docs.dtypes)[id_column]
    tokens = _tokenised(docs, id_column, text, source, vocabulary, end_id)
    sums = stored(
        tokens.groupBy("_run", "_source").agg(F.sum("_n").alias("_n")), "run-totals"
    )
    by_source = sums.groupBy("_source").agg(F.sum("_n").alias("_total"))
    wanted = {f"={name}": w for name, w in whole_weights(targets or {}).items()}
    if targets:
        listed = docs.sparkSession.createDataFrame(
            [(name, float(w)) for name, w in wanted.items()], "_source string, _weight double"
        )
        known = stored(by_source.join(listed, "_source", "left"), "source-totals")
        having = {r._source: r._total for r in known.where("_weight > 0").collect()}
    else:
        known = stored(by_source.withColumn("_weight", F.col("_total").cast("double")), "source-totals")
        having = {}
    queues = min(QUEUES, isqrt(size) - 1)
    top = sorted(having, key=lambda name: (-wanted[name], name))[:queues]
    free = known if not targets else known.where("_weight IS NULL")
    if len(top) < queues:
        top += [r._source for r in free.orderBy(F.desc("_total"), "_source").limit(queues - len(top)).collect()]
    places = F.create_map(*[F.lit(x) for k, name in enumerate(top) for x in (name, k)]) if top else None
    queue = F.coalesce(F.try_element_at(places, F.col("_source")), F.lit(len(top))) if top else F.lit(0)
    queued = known.withColumn("_queue", queue.cast("int"))
    by_queue = {r._queue: r.n for r in queued.groupBy("_queue").agg(F.sum("_total").alias("n")).collect()}
    totals = [by_queue.get(k, 0) for k in range(len(top) + 1)]
    shared = sorted(set(having) - set(top))
    phases, times = shared_phases([having[n] for n in shared], [wanted[n] for n in shared])
    weights = [*(wanted.get(n, 0) for n in top), 0] if targets else None
    stretches = mixture(totals, weights, size, phases)

    # Tokens of the source before each run.
    before = W.partitionBy("_source").orderBy("_run").rowsBetween(W.unboundedPreceding, -1)
    begin = stored(
        sums.withColumn("_begin", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .drop("_n").join(queued, "_source"),
        "begins",
    )
    met = tokens.join(begin, ["_run", "_source"]).withColumn("_at", F.col("_begin") + F.col("_at"))
    placed = met.where(F.col("_queue") < len(top)).select("_id", "_queue", "_at", "_ids")
    if totals[-1]:
        # Points of time, and the tokens the queue has given about then.
        points = ([0.0, *times], [0, *(end for end, _ in phases)]) if phases else ([0.0], [0])
        if points[1][-1] < totals[-1]:
            points = ([*points[0], points[0][-1] + 1], [*points[1], totals[-1]])
        turns = _taking_turns(met.where(F.col("_queue") == len(top)), bool(targets), *points)
        placed = placed.unionByName(turns)

    def cut(parts):
        forget()
        cutter, narrow = Cutter(stretches), id_type(vocabulary)
        for batch in parts:
            for first, end in batches(batch.column("_ids"), CHUNK):
                piece = batch.slice(first, end - first)
                rows = []
                owners = []
                for row, (own, at, ids) in enumerate(zip(
                    piece.column("_queue").to_pylist(), piece.column("_at").to_pylist(),
                    piece.column("_ids").to_pylist(), strict=True,
                )):
                    wide = np.frombuffer(ids, narrow).astype("<u4").tobytes()
                    n = len(wide) // 4
                    for start, length, sequence, offset in cutter.pieces(own, at, n):
                        part = wide[4 * start : 4 * (start + length)]
                        owners.append(row)
                        rows.append((start, length, zlib.crc32(part), n, sequence, offset, part))
                if rows:
                    columns = list(zip(*rows, strict=True))
                    yield pa.RecordBatch.from_arrays(
                        [piece.column("_id").take(pa.array(owners)),
                         *[pa.array(c, pa.int64()) for c in columns[:-1]], pa.array(columns[-1], pa.binary())],
                        ["_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"],
                    )

    schema = (
        f"_id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
        "sequence_id bigint, offset bigint, ids binary"
    )
    return placed.mapInArrow(cut, schema).withColumnRenamed("_id", id_column)
