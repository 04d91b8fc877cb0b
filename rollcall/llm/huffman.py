"""Token ids as files of Huffman-coded blocks, and their reading."""

import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.llm.common import stored, text_of
from rollcall.llm.ordering import part_bounds, part_column
from rollcall.llm.tokens import forget, id_type, word_encoder

#: Longest code, in bits: the decoding table has two to this power entries.
LIMIT = 18
#: Ids after which a block ends, at the next end of a document; ids between checkpoints.
BLOCK_IDS, STRIDE = 1 << 16, 128
_HEAD = struct.Struct("<4sIQQI")
_MAGIC = b"IDS1"


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Lengths of an optimal prefix code none of whose codes is longer than ``limit``.

    Package-merge: on each level the packages of the one below, paired, are merged with the
    single symbols.  Going back from the top, the cheapest entries that are needed tell how
    many of the lightest symbols get one more bit.  Symbols with count 0 have length 0.
    """
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), dtype=np.int64)
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    limit = max(limit, int(len(used) - 1).bit_length())
    order = used[np.argsort(counts[used], kind="stable")]
    single = counts[order].astype(np.float64)
    packages, levels = np.zeros(0), []
    for _ in range(limit):
        merged = np.concatenate((single, packages))
        sort = np.argsort(merged, kind="stable")
        levels.append(sort < len(single))
        merged = merged[sort][: len(merged) // 2 * 2]
        packages = merged[::2] + merged[1::2]
    needed = 2 * len(single) - 2
    for leaf in reversed(levels):
        symbols = int(leaf[:needed].sum())
        lengths[order[:symbols]] += 1
        needed = 2 * (needed - symbols)
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes in the order of length and symbol; the lengths alone tell them."""
    codes = np.zeros(len(lengths), dtype=np.uint64)
    code = last = 0
    for symbol in np.lexsort((np.arange(len(lengths)), lengths)):
        if lengths[symbol]:
            code <<= int(lengths[symbol]) - last
            last = int(lengths[symbol])
            codes[symbol] = code
            code += 1
    return codes


class Coder:
    """Encodes and decodes blocks by code lengths."""

    def __init__(self, lengths: np.ndarray):
        self.lengths, self.codes = lengths.astype(np.int64), canonical_codes(lengths)
        self.width = max(int(lengths.max(initial=0)), 1)
        used = np.flatnonzero(lengths)
        ordered = used[np.lexsort((used, lengths[used]))]
        repeats = 1 << (self.width - self.lengths[ordered])
        self.symbols = np.zeros(1 << self.width, dtype=np.uint32)
        self.sizes = np.ones(1 << self.width, dtype=np.int64)
        filled = int(repeats.sum())
        self.symbols[:filled] = np.repeat(ordered, repeats)
        self.sizes[:filled] = np.repeat(self.lengths[ordered], repeats)

    def block(self, ids: np.ndarray, docs: list, sizes: list[int], start: int) -> bytes:
        """A block that decodes by itself.

        Its parts: head (magic, documents, ids, start, stride), which documents have an id,
        their ids, their numbers of tokens, a bit offset for every stride of ids, the codes.
        """
        lengths = self.lengths[ids]
        offsets = np.cumsum(lengths) - lengths
        total = int(lengths.sum())
        if total >= 1 << 32:
            raise ValueError("a block's offsets are 32-bit: end blocks earlier")
        shift = (64 - (offsets & 31) - lengths).astype(np.uint64)
        value = self.codes[ids] << shift
        word, n = offsets >> 5, total // 32 + 2
        # Codes share no bit, so sums are unions, and all are below 2**32: exact as floats.
        bits = np.bincount(word, (value >> np.uint64(32)).astype(np.float64), n)
        bits += np.bincount(word + 1, (value & np.uint64(0xFFFFFFFF)).astype(np.float64), n)
        known = np.array([d is not None for d in docs], dtype=np.uint8)
        names = np.array([d or 0 for d in docs], dtype="<i8")
        return b"".join((
            _HEAD.pack(_MAGIC, len(docs), len(ids), start, STRIDE), known.tobytes(), names.tobytes(),
            np.array(sizes, dtype="<u4").tobytes(), offsets[::STRIDE].astype("<u4").tobytes(),
            bits.astype(">u4").tobytes(),
        ))

    def ids(self, block: bytes):
        """Documents, numbers of tokens, start and ids of a block."""
        magic, n_docs, n_ids, start, stride = _HEAD.unpack_from(block)
        if magic != _MAGIC:
            raise ValueError("not a block of token ids")
        at = _HEAD.size

        def take(kind, n):
            nonlocal at
            part = np.frombuffer(block, kind, n, at)
            at += part.nbytes
            return part

        known, names, sizes = take(np.uint8, n_docs), take("<i8", n_docs), take("<u4", n_docs)
        lanes = take("<u4", -(-n_ids // stride)).astype(np.int64)
        octets = np.frombuffer(block, np.uint8, offset=at).astype(np.uint32)
        octets = np.concatenate((octets, np.zeros(4, np.uint32)))
        windows = octets[:-3] << 24 | octets[1:-2] << 16 | octets[2:-1] << 8 | octets[3:]
        out = np.zeros((len(lanes), stride), dtype=np.uint32)
        # All strides at once: each step looks up the next id of every one of them.  The last
        # stride may be short; what it reads beyond its end is zeros, and is cut off.
        limit = len(windows) - 1
        for step in range(min(stride, n_ids)):
            bits = windows[np.minimum(lanes >> 3, limit)] << (lanes & 7).astype(np.uint32)
            code = bits >> np.uint32(32 - self.width)
            out[:, step] = self.symbols[code]
            lanes += self.sizes[code]
        docs = [int(name) if k else None for name, k in zip(names, known, strict=True)]
        return docs, sizes.astype(np.int64), start, out.ravel()[:n_ids]


def _raw_blocks(docs: DataFrame, id_column: str, text: str, vocabulary: str, end_id: int) -> DataFrame:
    """Tokenised documents in ascending order of id, gathered into blocks of raw ids."""
    narrow = docs.select(F.col(id_column).cast("bigint").alias("_id"), text_of(text).alias("_text"))
    bounds = part_bounds(narrow, "_id", "_text")
    dealt = (
        narrow.withColumn("_part", part_column("_id", bounds))
        .repartitionById(max(1, len(bounds)), F.col("_part"))
        .sortWithinPartitions("_part", F.col("_id").asc_nulls_last(), "_text")
    )

    def gathered(parts):
        encoder, kind = word_encoder(vocabulary), id_type(vocabulary)
        part, at, held = None, 0, []

        def block():
            nonlocal at, held
            ids = np.concatenate([h[1] for h in held])
            row = {
                "part": part, "at": at, "n": len(ids), "docs": [h[0] for h in held],
                "sizes": [len(h[1]) for h in held], "ids": ids.tobytes(),
            }
            at, held = at + len(ids), []
            return pa.RecordBatch.from_pylist([row], _RAW)

        size = 0
        for batch in parts:
            first = 0
            for count, flat, sizes in encoder.encode(batch.column("_text")):
                piece, first = batch.slice(first, count), first + count
                ends = np.cumsum(sizes)
                ids = np.insert(flat, ends, end_id).astype(kind)
                ends = (ends + np.arange(1, count + 1)).tolist()
                for own, name, a, b in zip(
                    piece.column("_part").to_pylist(), piece.column("_id").to_pylist(),
                    [0, *ends], ends, strict=False,
                ):
                    if own != part:
                        if held:
                            yield block()
                        part, at, size = own, 0, 0
                    # A copy, so that a block holds its own ids only.
                    held.append((name, ids[a:b].copy()))
                    size += b - a
                    if size >= BLOCK_IDS:
                        yield block()
                        size = 0
        if held:
            yield block()

    schema = "part int, at bigint, n bigint, docs array<bigint>, sizes array<int>, ids binary"
    return stored(dealt.mapInArrow(gathered, schema), "raw-ids", "zstd")


_RAW = pa.schema(
    [("part", pa.int32()), ("at", pa.int64()), ("n", pa.int64()), ("docs", pa.list_(pa.int64())),
     ("sizes", pa.list_(pa.int32())), ("ids", pa.binary())]
)


def id_counts(blocks: DataFrame, kind: str) -> np.ndarray:
    """How often each id occurs; one sum per id and task travels."""

    def counted(parts):
        forget()
        total = np.zeros(0, dtype=np.int64)
        for batch in parts:
            for ids in batch.column("ids"):
                found = np.bincount(np.frombuffer(ids.as_buffer(), kind))
                if len(found) > len(total):
                    total, found = found.astype(np.int64), total
                total[: len(found)] += found
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["id", "n"])

    sums = blocks.select("ids").mapInArrow(counted, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n"))
    # At most one row for each id of the vocabulary.
    rows = sums.toArrow()
    ids, n = (rows.column(c).to_numpy() for c in ("id", "n"))
    counts = np.zeros(int(ids.max(initial=-1)) + 1, dtype=np.int64)
    counts[ids] = n
    return counts


def write_ids(
    docs: DataFrame,
    folder: str,
    vocabulary: str,
    end_id: int,
    id_column: str = "doc_id",
    text: str = "text",
) -> None:
    """Write the token ids of all documents, each with ``end_id`` behind it, in order of id.

    ``folder/codes`` holds the code length of each id, ``folder/blocks`` the blocks, in
    Parquet files as binary values beside their place.  Texts are tokenised once, after the
    one shuffle that sorts them by part; parts of ids are cut by quantiles of the id.  Null
    ids come last, rows of one id in the order of their texts; a null text counts as empty.
    """
    spark = docs.sparkSession
    kind = id_type(vocabulary)
    raw = _raw_blocks(docs, id_column, text, vocabulary, end_id)
    lengths = code_lengths(id_counts(raw, kind))
    # One row for each part; their number is bounded.
    totals = raw.groupBy("part").agg(F.sum("n").alias("n")).orderBy("part").collect()
    bases = dict(zip(
        [r.part for r in totals], np.concatenate(([0], np.cumsum([r.n for r in totals])))[:-1].tolist()
        if totals else [], strict=True,
    ))

    def coded(parts):
        coder = Coder(lengths)
        for batch in parts:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                ids = np.frombuffer(row["ids"], kind)
                block = coder.block(ids, row["docs"], row["sizes"], bases[row["part"]] + row["at"])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([bases[row["part"]] + row["at"]], pa.int64()), pa.array([block], pa.binary())],
                    ["start", "block"],
                )

    raw.mapInArrow(coded, "start bigint, block binary").write.parquet(f"{folder}/blocks")
    used = np.flatnonzero(lengths)
    book = [(int(i), int(lengths[i])) for i in used]
    spark.createDataFrame(book, "id bigint, bits int").coalesce(1).write.parquet(f"{folder}/codes")


def read_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Documents read back: ``_id``, ``start``, ``n_tokens``, ``ids`` as 32-bit integers."""
    book = spark.read.parquet(f"{folder}/codes").toArrow()
    ids, bits = (book.column(c).to_numpy() for c in ("id", "bits"))
    lengths = np.zeros(int(ids.max(initial=-1)) + 1, dtype=np.int64)
    lengths[ids] = bits

    def decoded(parts):
        coder = Coder(lengths)
        for batch in parts:
            for block in batch.column("block"):
                names, sizes, start, found = coder.ids(block.as_py())
                octets = found.astype("<u4").tobytes()
                ends = np.cumsum(sizes)
                begins = ends - sizes
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(names, pa.int64()), pa.array(begins + start), pa.array(sizes),
                        pa.array([octets[4 * a : 4 * b] for a, b in zip(begins, ends, strict=True)], pa.binary()),
                    ],
                    ["_id", "start", "n_tokens", "ids"],
                )

    schema = "_id bigint, start bigint, n_tokens bigint, ids binary"
    return spark.read.parquet(f"{folder}/blocks").select("block").mapInArrow(decoded, schema)
