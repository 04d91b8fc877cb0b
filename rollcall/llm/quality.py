"""Quality scores of texts: features by vectorised byte classes, an additive model over them."""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.llm import gam
from rollcall.llm.common import batches, free_name, spans, text_of

#: Labelled rows the model is fitted to: all up to this many, else about as many by a hash.
FIT_ROWS = 50_000
#: Bytes of text whose classes are computed together.
CHUNK = 1 << 20

_CLASSES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "lower": b"abcdefghijklmnopqrstuvwxyz",
    "digit": b"0123456789",
    "blank": b" \t\r\v\f",
    "newline": b"\n",
    "stop": b".?:;",
    "comma": b",",
    "shout": b"!",
    "bar": b"|",
    "mark": b"#$%&*+<=>@\\^_`{}~/[]",
    "quote": b"\"'()-",
    "other": b"",
    "wide": bytes(range(192, 256)),
    "tail": bytes(range(128, 192)),
}
_CODE = np.full(256, list(_CLASSES).index("other"), dtype=np.uint8)
for _i, _octets in enumerate(_CLASSES.values()):
    _CODE[list(_octets)] = _i
_NAMES = list(_CLASSES)
FEATURES = [
    "log_chars", "log_words", "log_lines", *[f"{n}_share" for n in _NAMES if n != "tail"],
    "word_mean", "word_spread", "short_words", "long_words", "line_mean", "line_spread",
    "marked_words", "capital_words", "distinct_words", "distinct_lines", "commonest_line",
    "longest_line", "stopped_lines",
]


def _sums(values, starts, ends):
    """Sums of ``values[start:end]`` for each document."""
    total = np.zeros(len(values) + 1)
    np.cumsum(values, out=total[1:])
    return total[ends] - total[starts]


def _by_text(begins, values, starts, ends):
    """Sum of a value of each span, by the document its start lies in."""
    first, last = np.searchsorted(begins, starts), np.searchsorted(begins, ends)
    return _sums(values, first, last)


def features(texts: list[str]) -> np.ndarray:
    """The features of whole texts, one row each; an empty text has zeros."""
    parts = [t.encode("utf-8", "surrogatepass") for t in texts]
    # One line break after each text, so that no word or line reaches into the next.
    buffer = np.frombuffer(b"\n".join(parts) + b"\n", dtype=np.uint8)
    size = np.array([len(p) for p in parts], dtype=np.int64)
    starts = np.concatenate(([0], np.cumsum(size + 1)[:-1]))
    ends = starts + size
    code = _CODE[buffer]
    count = {n: _sums(code == i, starts, ends) for i, n in enumerate(_NAMES)}
    chars = np.maximum(size - count["tail"], 1)
    words, stops = spans((code != _NAMES.index("blank")) & (code != _NAMES.index("newline")))
    n_words = _by_text(words, np.ones(len(words)), starts, ends)
    some = np.maximum(n_words, 1)
    long = (stops - words).astype(float)
    mean = _by_text(words, long, starts, ends) / some
    spread = np.sqrt(np.maximum(_by_text(words, long * long, starts, ends) / some - mean**2, 0))
    last = code[stops - 1]
    marked = np.isin(last, [_NAMES.index(n) for n in ("mark", "shout", "bar")])
    capital = (code[words] == 0) & (code[np.minimum(words + 1, len(code) - 1)] == 0) & (long > 1)
    lines = np.flatnonzero(code == _NAMES.index("newline"))
    begins = np.concatenate(([0], lines[:-1] + 1))
    width = (lines - begins).astype(float)
    n_lines = np.maximum(_by_text(begins, np.ones(len(begins)), starts, ends + 1), 1)
    line_mean = _by_text(begins, width, starts, ends + 1) / n_lines
    line_spread = np.sqrt(
        np.maximum(_by_text(begins, width**2, starts, ends + 1) / n_lines - line_mean**2, 0)
    )
    before = code[np.maximum(lines - 1, 0)]
    stopped = (before == _NAMES.index("stop")) & (width > 0)
    split = [t.split("\n") for t in texts]
    distinct_words = np.array([len(set(t.split())) for t in texts]) / some
    distinct_lines = np.array([len(set(s)) / len(s) for s in split])
    common = np.array([max(map(s.count, set(s))) / len(s) if len(s) <= 40 else _commonest(s) for s in split])
    longest = np.array([max(map(len, s)) for s in split]) / chars
    columns = [
        np.log1p(chars), np.log1p(n_words), np.log1p(n_lines),
        *[count[n] / chars for n in _NAMES if n != "tail"],
        mean, spread, _by_text(words, long <= 2, starts, ends) / some,
        _by_text(words, long >= 12, starts, ends) / some, line_mean, line_spread,
        _by_text(words, marked, starts, ends) / some, _by_text(words, capital, starts, ends) / some,
        distinct_words, distinct_lines, common, longest,
        _by_text(lines, stopped, starts, ends + 1) / n_lines,
    ]
    return np.where((size > 0)[:, None], np.stack(columns, axis=1), 0.0)


def _commonest(lines):
    counts = {}
    for line in lines:
        counts[line] = counts.get(line, 0) + 1
    return max(counts.values()) / len(lines)


def _in_chunks(column: pa.Array, each):
    """``each`` applied to lists of texts of bounded size, results put together."""
    parts = [each(column.slice(a, b - a).to_pylist()) for a, b in batches(column, CHUNK)]
    return np.concatenate(parts) if parts else np.zeros((0,))


def feature_column(text: str) -> Column:
    """The features of a text column as an array."""

    @F.arrow_udf("array<double>")
    def measured(column: pa.Array) -> pa.Array:
        rows = _in_chunks(column, features).reshape(len(column), len(FEATURES))
        offsets = np.arange(len(column) + 1, dtype=np.int32) * len(FEATURES)
        return pa.ListArray.from_arrays(offsets, pa.array(rows.ravel()))

    return measured(text_of(text))


def score_column(model: gam.AdditiveModel, text: str) -> Column:
    """The score of a text column, 0 to 1."""

    @F.arrow_udf("double")
    def scored(column: pa.Array) -> pa.Array:
        return pa.array(_in_chunks(column, lambda texts: model.scores(features(texts))), pa.float64())

    return scored(text_of(text))


def held_out(id_column: str) -> Column:
    """Whether a row is kept from training: crc32 of its id as text leaves 1 by 3."""
    crc = F.crc32(F.col(id_column).cast("string").cast("binary"))
    return F.coalesce(F.pmod(crc, F.lit(3)) == 1, F.lit(False))


def fitted(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    fit_rows: int = FIT_ROWS,
) -> gam.AdditiveModel:
    """The model of the labelled rows that are not held out.

    Of repeated labels of an id the smallest counts; null ids and labels are left out.  With
    more than ``fit_rows`` labelled rows, those with the smallest hashes of the id are taken,
    about as many.  Of the texts of a repeated id the one with the smallest features counts, so
    the sample, the broadcast of its ids and the rows fitted to are bounded at every size.
    """
    known = (
        labels.where(F.col(id_column).isNotNull() & F.col(label).isNotNull() & ~held_out(id_column))
        .groupBy(F.col(id_column).alias("_id"))
        .agg(F.min(label).cast("double").alias("_label"))
    )
    share = min(1.0, fit_rows / max(known.count(), 1))
    sample = known.where(F.pmod(F.xxhash64("_id"), F.lit(1 << 20)) < int(share * (1 << 20)))
    rows = docs.select(F.col(id_column).alias("_id"), F.col(text).alias("_text"))
    measured = (
        rows.join(F.broadcast(sample), "_id")
        .select("_id", "_label", feature_column("_text").alias("_features"))
        .groupBy("_id")
        .agg(F.min("_label").alias("_label"), F.min("_features").alias("_features"))
        .toArrow()
    )
    found = measured.column("_features").combine_chunks()
    matrix = found.flatten().to_numpy().reshape(-1, len(FEATURES))
    order = np.argsort(measured.column("_id").to_numpy(), kind="stable")
    return gam.fit(matrix[order], measured.column("_label").to_numpy()[order])


def scored(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per document: its id, ``held_out``, ``score``, ``predicted``.

    The score depends on the text alone.  Null texts score as empty ones do, and a table
    without labels gives 0.5 for every text.  Repeated rows and null ids stay as they are; ids
    may have any type.  Texts of any length are measured whole, one task holding about 100 bytes
    for each of one text.  No documents give no rows; other columns, whatever their names, do
    not matter.
    """
    score = score_column(fitted(docs, labels, id_column, text), text)
    rows = docs.select(
        F.col(id_column), held_out(id_column).alias("held_out"), score.alias("score")
    )
    return rows.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def accepted(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The rows whose score is at least one half, with all their columns, whatever their names."""
    name = free_name(docs, "_score")
    score = score_column(fitted(docs, labels, id_column, text), text)
    return docs.withColumn(name, score).where(F.col(name) >= 0.5).select(*docs.columns)
