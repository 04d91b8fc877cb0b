"""Near-duplicate groups by SimHash, searched with deletion-variant signatures."""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import met_by_run, row_number, run_number, stored, text_of
from rollcall.llm.components import component_roots

BITS, SEGMENTS = 64, 2
WIDTH = BITS // SEGMENTS
SEED = 42
#: Fingerprints in a bucket that are compared one by one; larger buckets are split by a
#: second signature.
BUCKET = 32
_STEP = 1 << 16


def fingerprint(text: str, words: int) -> int:
    """The SimHash of a text's word shingles: bits set in over half of their hashes."""
    tokens = text.encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return 0
    if len(tokens) < words:
        return xxhash.xxh64_intdigest(b" ".join(tokens), SEED)
    hashed = xxhash.xxh64_intdigest
    shingles = map(b" ".join, zip(*(tokens[i:] for i in range(words)), strict=False))
    hashes = np.array([hashed(s, SEED) for s in shingles], dtype="<u8")
    counts = np.zeros(BITS, dtype=np.int64)
    for start in range(0, len(hashes), _STEP):
        octets = hashes[start : start + _STEP].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * counts > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_column: str, text: str, words: int, row: Column) -> DataFrame:
    """``_id``, ``_row``, ``_run`` and the fingerprint ``_print`` of each row, written once."""

    def hashed(parts):
        for part in parts:
            prints = [fingerprint(t.as_py(), words) for t in part.column("_text")]
            signed = pa.array(np.array(prints, dtype=np.uint64).view(np.int64))
            yield part.drop_columns(["_text"]).append_column("_print", signed)

    rows = docs.select(
        F.col(id_column).alias("_id"), row.alias("_row"),
        run_number(), text_of(text).alias("_text"),
    )
    kind = dict(docs.dtypes)[id_column]
    schema = f"_id {kind}, _row bigint, _run bigint, _print bigint"
    return stored(rows.mapInArrow(hashed, schema), "fingerprints")


def _segment(bits: str, segment: str) -> str:
    return f"shiftrightunsigned({bits}, {WIDTH} * {segment}) & {2**WIDTH - 1}"


def signatures(prints: DataFrame) -> DataFrame:
    """The keys of each fingerprint: both segments whole, and with each bit as a wildcard.

    Two fingerprints at two bits differ by at most one bit in one of two segments: there they
    share the whole segment or the variant whose wildcard is that bit, on different ``_side``.
    """
    keys = prints.select("_print", F.explode(F.sequence(F.lit(0), F.lit(SEGMENTS * (WIDTH + 1) - 1))).alias("_tag"))
    cut = keys.selectExpr(
        "_print", "_tag", f"_tag % {WIDTH + 1} AS _wild",
        f"{_segment('_print', f'cast(_tag div {WIDTH + 1} as int)')} AS _bits",
    )
    whole = F.col("_wild") == WIDTH
    return cut.select(
        "_print", "_tag",
        F.when(whole, F.col("_bits")).otherwise(
            F.expr("_bits & ~shiftleft(1L, _wild)")
        ).alias("_rest"),
        F.when(whole, F.lit(0)).otherwise(
            F.expr("cast(shiftright(_bits, _wild) & 1 as int)")
        ).alias("_side"),
        whole.alias("_whole"),
    )


def _distance(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def _followed(alike: DataFrame, key: list[str]) -> DataFrame:
    """Links of the sharers of each variant to the smallest of them."""
    hubs = alike.groupBy(*key, "_near").agg(F.min("_print").alias("_hub"), F.count(F.lit(1)).alias("_m"))
    return alike.join(hubs.where("_m > 1").hint("merge"), [*key, "_near"]).select(
        F.col("_print").alias("a"), F.col("_hub").alias("b")
    )


def links(prints: DataFrame, bits: int, bucket: int = BUCKET) -> DataFrame:
    """Links ``a``, ``b`` that connect whatever distinct fingerprints differ in ``bits`` or fewer.

    Buckets are counted first; those in which nothing can meet drop out.  In small ones each
    pair is compared.  In a large one the other segment is signed too, by its variants with one
    bit turned: sharers of such a variant are two bits apart at most, and follow its smallest;
    for one bit, a variant meets the fingerprint that equals it instead.
    Every link is verified; none is lost and no large bucket is paired.  Joins here are merged,
    never broadcast: Spark estimates signatures by the fingerprints they are exploded from.
    """
    if not 1 <= bits <= 2:
        raise ValueError("two segments with one wildcard find fingerprints one or two bits apart")
    signed = signatures(prints)
    key = ["_tag", "_rest"]
    sizes = signed.groupBy(*key).agg(
        F.count(F.lit(1)).alias("_n"), F.sum("_side").alias("_ones"), F.first("_whole").alias("_w")
    )
    live = sizes.where("IF(_w, _n > 1, _ones > 0 AND _ones < _n)").select(*key, "_n")
    members = stored(signed.join(live.hint("merge"), key), "buckets")
    small = members.where(F.col("_n") <= bucket)
    other = small.select(*key, F.col("_print").alias("_other"), F.col("_side").alias("_other_side"))
    pairs = small.join(other.hint("merge"), key).where(
        "IF(_whole, _print < _other, _side < _other_side)"
    ).where(_distance("_print", "_other") <= bits).select(
        F.col("_print").alias("a"), F.col("_other").alias("b")
    )
    large = members.where(F.col("_n") > bucket).withColumn(
        "_far", F.expr(_segment("_print", f"cast(1 - _tag div {WIDTH + 1} as int)"))
    )
    turned = F.explode(
        F.transform(F.sequence(F.lit(-1), F.lit(WIDTH - 1)), lambda i: F.when(i < 0, F.col("_far")).otherwise(
            F.col("_far").bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), i))
        ))
    ).alias("_near")
    # Same segment: sharers of a variant are at most two bits apart.
    alike = large.where("_whole").select(*key, "_print", turned)
    if bits == 1:
        equal = large.where("_whole").select(
            *key, F.col("_print").alias("_other"), F.col("_far").alias("_near")
        )
        follow = alike.join(equal.hint("merge"), [*key, "_near"]).select(
            F.col("_print").alias("a"), F.col("_other").alias("b")
        )
    else:
        follow = _followed(alike, key)
    # One bit apart in the segment: at most one more in the other.
    ones = large.where("NOT _whole AND _side = 1").select(*key, "_print", turned)
    zeros = large.where("NOT _whole AND _side = 0").select(
        *key, F.col("_print").alias("_zero"), F.col("_far").alias("_near")
    )
    across = ones.join(zeros.hint("merge"), [*key, "_near"]).select(F.col("_print").alias("a"), F.col("_zero").alias("b"))
    found = pairs.unionByName(follow).unionByName(across)
    return found.where((F.col("a") != F.col("b")) & (_distance("a", "b") <= bits))


def near_groups(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    words: int = 3,
    bits: int = 2,
    row: str | None = None,
) -> DataFrame:
    """One row per document: ``_row``, id, ``fingerprint``, ``component_id``, ``kept``.

    Letters A-Z are lowered and words cut at white space; a text with fewer words than a
    shingle hashes them all, one without words (null or empty) has fingerprint zero and is
    linked like any other.  Documents whose fingerprints differ in ``bits`` or fewer are
    linked; the smallest id reachable is the component's, and its row is kept.  Rows of one id
    are ordered by their place in the input (or the unique numbers in ``row``); null ids come last, and a component of null ids
null ids come last, and a component of null ids
    has a null id.  Texts of any length are hashed whole; ids may have any type that has an
    order.  An empty table gives an empty result; other columns, whatever their names, do not
    matter.
    Equal fingerprints are one node, so copies cost nothing in the search.
    """
    rows = fingerprints(docs, id_column, text, words, row_number(row))
    nodes = stored(
        rows.groupBy("_print").agg(
            F.min(F.struct(F.isnull("_id").alias("none"), "_id", "_row")).alias("_first")
        ),
        "nodes",
    )
    roots = component_roots(links(nodes.select("_print"), bits), "a", "b")
    placed = nodes.join(roots.withColumnRenamed("node", "_print"), "_print", "left").withColumn(
        "_root", F.coalesce("root", "_print")
    )
    firsts = placed.groupBy("_root").agg(F.min("_first").alias("_found"))
    found = placed.select("_print", "_root").join(firsts, "_root").select("_print", "_found")
    return met_by_run(rows, found, ["_print"]).select(
        "_row",
        F.col("_id").alias(id_column),
        F.lower(F.lpad(F.hex("_print"), 16, "0")).alias("fingerprint"),
        F.col("_found._id").alias("component_id"),
        (F.col("_row") == F.col("_found._row")).alias("kept"),
    )
