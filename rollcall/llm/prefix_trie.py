"""The prefix trie of conversations: sorted shards, and a skeleton of their splitters' paths."""

import hashlib
from bisect import bisect_right
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import met_by_run, run_number, stored, text_of

#: Bytes of a turn in a path: the first of a SHA-256.
STEP = 16
#: Turns of a shard, about, and the most shards.
SHARD_TURNS, MOST_SHARDS = 200_000, 4096
#: Sampled rows for each shard, and the bytes that all of them may have.
SAMPLED, SAMPLE_BYTES = 16, 32 << 20
#: Turns of a splitter's path; longer ones are cut there.
SPLITTER_TURNS = 4096
#: Ids of ends that travel as one text, and output rows that are put out together.
ENDS, ROWS = 4096, 8192
_OUT = [
    ("key", pa.binary()), ("parent_key", pa.binary()), ("skeleton", pa.bool_()), ("conv_id", pa.int64()),
    ("depth", pa.int64()), ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()),
    ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()),
    ("ends_sha256", pa.string()), ("part", pa.int64()), ("ends", pa.string()),
]
_NO_ENDS = hashlib.sha256(b"").hexdigest()


def paths(conversations: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """``_conv`` and ``_turns``, in order: a digest of role and text, and the text's code points."""
    said = F.concat(
        F.octet_length(text_of(role)).cast("string"), F.lit(":"), text_of(role), text_of(text)
    )
    turns = conversations.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("bigint").alias("_conv"),
        F.struct(
            F.col(turn).alias("turn"), text_of(role).alias("role"),
            F.substring(F.unhex(F.sha2(said.cast("binary"), 256)), 1, STEP).alias("digest"),
            F.length(text_of(text)).cast("bigint").alias("size"),
        ).alias("_turn"),
    )
    ordered = turns.groupBy("_conv").agg(F.sort_array(F.collect_list("_turn")).alias("_turns"))
    return ordered.withColumn(
        "_turns", F.transform("_turns", lambda t: F.struct(t["digest"].alias("digest"), t["size"].alias("size")))
    )


def rebuilt(own: DataFrame, family: int = 100, most: int = 5) -> DataFrame:
    """Each conversation with its first turns from the first of its family.

    Of conversation ``c`` the first ``crc32(c) % (most + 1)`` turns are those of conversation
    ``c - c % family``, as far as there are any.
    """
    head = F.pmod(F.crc32(F.col("_conv").cast("string").cast("binary")), F.lit(most + 1)).cast("int")
    first = own.where(F.col("_conv") % family == 0).select(
        F.col("_conv").alias("_base"), F.slice("_turns", 1, most).alias("_head")
    )
    met = own.withColumn("_base", F.col("_conv") - F.col("_conv") % family).join(first, "_base", "left")
    mixed = F.concat(
        F.coalesce(F.slice("_head", F.lit(1), head), F.slice("_turns", 1, 0)),
        F.slice("_turns", head + 1, F.size("_turns")),
    )
    return met.select("_conv", mixed.alias("_turns"))


def _splitters(rows: DataFrame, shard_turns: int) -> list[tuple[bytes, int]]:
    """Paths and ids that cut the sorted rows into shards of about equal numbers of turns.

    They come from a sample by hash of bounded size.  A path that is cut short begins its
    shard with no id: whatever goes on from it comes behind.
    """
    short = F.least(F.octet_length("_path"), F.lit(STEP * SPLITTER_TURNS))
    whole = rows.agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("_path") / STEP + 1).alias("turns"),
        F.sum(short).alias("bytes"),
    ).first()
    shards = min(MOST_SHARDS, int((whole.turns or 0) // shard_turns) + 1)
    if shards == 1:
        return []
    share = min(1.0, SAMPLED * shards / whole.n, SAMPLE_BYTES / max(1, whole.bytes))
    taken = rows.where(F.pmod(F.xxhash64("_conv"), F.lit(1 << 20)) < max(1, int(share * (1 << 20)))).select(
        F.substring("_path", 1, STEP * SPLITTER_TURNS).alias("path"), "_conv",
        (F.octet_length("_path") <= STEP * SPLITTER_TURNS).alias("whole"),
        (F.octet_length("_path") / STEP + 1).alias("turns"),
    ).collect()
    sample = sorted((bytes(r.path), r._conv if r.whole else -(1 << 63), r.turns) for r in taken)
    step, held, found = sum(s[2] for s in sample) / shards, 0.0, []
    for path, conv, turns in sample:
        if held >= step * (len(found) + 1) and (not found or found[-1] < (path, conv)):
            found.append((path, conv))
        held += turns
    return found


def _shared(a: bytes, b: bytes | None) -> int:
    """Turns that two paths begin with alike; -1 without a path."""
    if b is None:
        return -1
    low, high = 0, min(len(a), len(b)) // STEP
    while low < high:
        half = (low + high + 1) // 2
        if a[STEP * low : STEP * half] == b[STEP * low : STEP * half]:
            low = half
        else:
            high = half - 1
    return low


class _Node:
    __slots__ = ("size", "key", "owner", "last", "conv", "n", "grown", "children", "leaves", "saved", "ends", "pending", "parts")

    def __init__(self, size, key=None, owner=True, last=True):
        self.size, self.key, self.owner, self.last = size, key, owner, last
        self.conv, self.n, self.children, self.leaves, self.saved = None, 0, 0, 0, 0
        # Whether a child was seen here, counted or not.
        self.grown, self.ends, self.pending, self.parts = False, [], [], None


class Shard:
    """One sorted shard: paths come in order, nodes are put out as they end.

    A node that begins a splitter's path is of the skeleton: other shards may hold parts of it.
    Of its parts, the one of the first splitter with its path owns it, so that it counts once as
    a child and once in the tokens; whether it has children shows in the last of them.  So the
    sums of a skeleton node are the sums over its parts.  All other nodes are whole here.
    """

    def __init__(self, number: int, splitters: list[tuple[bytes, int]]):
        self.number = number
        self.left = splitters[number - 1][0] if number else None
        self.right = splitters[number][0] if number < len(splitters) else None
        # Depths up to this one belong to an earlier splitter.
        self.earlier = _shared(self.left, splitters[number - 2][0]) if number > 1 else -1
        self.path, self.stack, self.out, self.marks = b"", [], [], 0

    def _push(self, depth: int, size: int, piece: bytes, left: int, right: int) -> None:
        if depth > left and depth > right:
            self.stack.append(_Node(size))
            return
        key = self.stack[-1].key.copy() if depth else hashlib.blake2b(digest_size=STEP)
        key.update(piece)
        self.stack.append(
            _Node(size, key, self.earlier < depth <= left, depth <= left and depth > right)
        )

    def add(self, conv: int, path: bytes, sizes: list[int]) -> None:
        same = _shared(path, self.path) if self.stack else -1
        while len(self.stack) - 1 > same:
            self._pop()
        if same < len(sizes):
            left, right = _shared(path, self.left), _shared(path, self.right)
            if not self.stack:
                self._push(0, 0, b"", left, right)
            for depth in range(len(self.stack), len(sizes) + 1):
                self._push(depth, sizes[depth - 1], path[STEP * (depth - 1) : STEP * depth], left, right)
        self.path = path
        node = self.stack[-1]
        node.n += 1
        node.conv = conv if node.conv is None else min(node.conv, conv)
        node.ends.append(str(conv))
        if len(node.ends) == ENDS:
            self._close_ends(node)

    def _close_ends(self, node: _Node) -> None:
        """Ends so far: hashed on where the node is whole, else put out in their order."""
        if not node.ends:
            return
        text = ",".join(node.ends)
        node.ends = []
        if node.key is not None:
            self.marks += 1
            part = (self.number << 32) + self.marks
            self.out.append((node.key.digest(), None, True, *[None] * 8, part, text))
            return
        if node.parts is None:
            node.parts = hashlib.sha256()
        else:
            text = "," + text
        node.parts.update(text.encode())

    def _pop(self) -> None:
        node, depth = self.stack.pop(), len(self.stack)
        self._close_ends(node)
        skeleton = node.key is not None
        if not skeleton:
            node.leaves += not node.grown
            node.saved += (node.n - 1) * node.size
        else:
            node.leaves += node.last and not node.grown
            node.saved += (node.n - node.owner) * node.size
        parent = self.stack[-1] if self.stack else None
        sha = _NO_ENDS if node.parts is None else node.parts.hexdigest()
        row = [
            node.key.digest() if skeleton else None,
            parent.key.digest() if parent and parent.key is not None else None,
            skeleton, node.conv, depth, None, node.n, node.children, node.leaves, node.saved,
            None if skeleton else sha, None, None,
        ]
        for child in node.pending:
            child[5] = node.conv
            self.out.append(child)
        if parent is None:
            self.out.append(row)
            return
        parent.grown = True
        parent.n += node.n
        parent.conv = node.conv if parent.conv is None else min(parent.conv, node.conv)
        parent.children += node.owner if skeleton else 1
        parent.leaves += node.leaves
        parent.saved += node.saved
        if parent.key is None:
            parent.pending.append(row)
        else:
            # The ids of the parent's other parts are not known here.
            self.out.append(row)

    def finish(self) -> None:
        while self.stack:
            self._pop()


def _read(splitters: list[tuple[bytes, int]]):
    """The nodes of sorted shards, one after another."""

    def read(batches):
        shard = None
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("_shard", "_conv", "_path", "_sizes"))
            for number, conv, path, sizes in zip(*columns, strict=True):
                if shard is None or shard.number != number:
                    if shard:
                        shard.finish()
                        yield from _rows(shard, 0)
                    shard = Shard(number, splitters)
                shard.add(conv, path, sizes)
                if len(shard.out) >= ROWS:
                    yield from _rows(shard, ROWS)
        if shard:
            shard.finish()
            yield from _rows(shard, 0)

    return read


def _rows(shard: Shard, least: int):
    while len(shard.out) > least or (shard.out and not least):
        part, shard.out = shard.out[:ROWS], shard.out[ROWS:]
        columns = zip(*part, strict=True)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, kind) for c, (_, kind) in zip(columns, _OUT, strict=True)], [n for n, _ in _OUT]
        )


def _numbered(splitters: list[tuple[bytes, int]]):
    """The shard of each row: how many splitters come at or before it."""

    def numbered(batches):
        for batch in batches:
            rows = zip(batch.column("_path").to_pylist(), batch.column("_conv").to_pylist(), strict=True)
            found = pa.array([bisect_right(splitters, row) for row in rows], pa.int32())
            yield batch.append_column("_shard", found)

    return numbered


def _hashed(batches):
    """SHA-256 of the ends of each node, whose texts come in order."""
    key, state = None, None
    for batch in batches:
        for own, text in zip(batch.column("key").to_pylist(), batch.column("ends").to_pylist(), strict=True):
            if own != key:
                if key is not None:
                    yield _digest(key, state)
                key, state = own, hashlib.sha256(text.encode())
            else:
                state.update(b"," + text.encode())
    if key is not None:
        yield _digest(key, state)


def _digest(key, state):
    return pa.RecordBatch.from_pydict({"key": [key], "sha": [state.hexdigest()]})


def trie(rows: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """The nodes of the trie of ``_conv`` (unique) and ``_turns``, as in ``prefix_trie``."""
    steps = F.array_join(F.transform("_turns", lambda t: F.hex(t["digest"])), "")
    flat = stored(
        rows.select(
            "_conv", F.unhex(steps).alias("_path"), F.transform("_turns", lambda t: t["size"]).alias("_sizes")
        ),
        "trie-paths",
    )
    splitters = _splitters(flat, shard_turns)
    dealt = flat.mapInArrow(_numbered(splitters), "_conv bigint, _path binary, _sizes array<bigint>, _shard int")
    sorted_shards = dealt.repartition(len(splitters) + 1, "_shard").sortWithinPartitions("_shard", "_path", "_conv")
    kinds = {"binary": "binary", "bool": "boolean", "int64": "bigint", "string": "string"}
    schema = ", ".join(f"{name} {kinds[str(kind)]}" for name, kind in _OUT)
    found = stored(sorted_shards.mapInArrow(_read(splitters), schema), "trie-nodes")
    nodes = found.where(F.col("ends").isNull())
    # Parts of skeleton nodes meet; ends of one node are hashed in their order, as texts of many.
    texts = found.where(F.col("ends").isNotNull()).select("key", "part", "ends")
    hashes = texts.repartition("key").sortWithinPartitions("key", "part").mapInArrow(_hashed, "key binary, sha string")
    skeleton = stored(
        nodes.where("skeleton").groupBy("key", "parent_key", "depth").agg(
            F.min("conv_id").alias("conv_id"),
            *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
        ).join(hashes, "key", "left"),
        "skeleton",
    )
    above = skeleton.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("_above"))
    names = [n for n, _ in _OUT[3:11]]
    inner = nodes.where("NOT skeleton AND parent_key IS NULL").select(names)
    edge = met_by_run(
        nodes.where("NOT skeleton AND parent_key IS NOT NULL").withColumn("_run", run_number()), above, ["parent_key"]
    ).withColumn("parent_conv_id", F.col("_above"))
    bones = skeleton.join(above, "parent_key", "left").withColumns(
        {"parent_conv_id": F.col("_above"), "ends_sha256": F.coalesce("sha", F.lit(_NO_ENDS))}
    )
    return inner.unionByName(edge.select(names)).unionByName(bones.select(names))


def prefix_trie(
    conversations: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    family: int | None = None,
    most: int = 5,
    shard_turns: int = SHARD_TURNS,
) -> DataFrame:
    """One row per distinct beginning of a conversation: ``conv_id`` (the smallest member),
    ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens``,
    ``ends_sha256``.

    Turns are ordered by ``turn``, null first, equal ones by role and then by a digest of the
    text; repeated rows are turns of their own.  A null role or text is empty.  Ids are whole
    numbers; rows without one belong to no conversation.  With a ``family``, conversations are
    rebuilt first (see ``rebuilt``); one may be left without turns, and is then a member of the
    root alone.  The root has depth 0 and no parent.  Conversations are never paired, and equal
    ones share a path.  No conversations, no nodes.  Other columns do not matter.

    Conversations travel as paths of 16 bytes a turn, never as texts: a conversation's path is
    one value.  They are sorted into shards; the splitters' paths, cut at 4,096 turns, form the
    skeleton that every task knows.  A shard puts out all nodes that begin no splitter; parts of
    the others are summed up, and their members' ids are hashed from texts of 4,096 ids each.
    """
    own = paths(conversations, conv, turn, role, text)
    if family:
        own = rebuilt(stored(own, "conversations"), family, most)
    return trie(own, shard_turns)
