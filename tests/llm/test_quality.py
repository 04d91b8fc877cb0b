import zlib

import numpy as np
import pytest

from rollcall.llm import gam, quality, queries
from tests.compare import duckdb_tables
from tests.llm.conftest import TEXTS

SMALL = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    rows = {r.doc_id: r for r in queries.registered()["op1_quality"](spark, SMALL).collect()}
    labels = duckdb_tables(SMALL).execute("SELECT doc_id, quality FROM labels").fetchall()
    held = [(i, y) for i, y in labels if zlib.crc32(str(i).encode()) % 3 == 1]
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in rows.items())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows.values())
    assert np.mean([rows[i].predicted == y for i, y in held]) > 0.97
    assert np.mean([rows[i].predicted for i, y in held if y == 1]) > 0.97


def test_awkward(awkward, nothing, spark):
    labels = spark.createDataFrame(
        [(1, 1), (1, 0), (9, 0), (10, 0), (11, 1), (12, 1), (None, 1), (13, None)], "doc_id long, quality int"
    )
    rows = quality.scored(awkward, labels).collect()
    assert len(rows) == len(TEXTS)
    assert len({r.score for r in rows if r.doc_id in (4, 5) or r.doc_id is None and r.score}) <= 3
    assert {r.score for r in rows if r.doc_id == 4} == {r.score for r in rows if r.doc_id == 5}
    assert quality.scored(nothing, labels).collect() == []
    assert {r.score for r in quality.scored(awkward, labels.limit(0)).collect()} == {0.5}
    kept = quality.accepted(awkward, labels)
    assert kept.columns == awkward.columns and kept.count() == sum(r.predicted for r in rows)


def test_fit_is_bounded(spark):
    docs = spark.range(3000).selectExpr("id AS doc_id", "repeat('a ', int(id % 7)) AS text")
    labels = docs.selectExpr("doc_id", "int(doc_id % 7 > 3) AS quality")
    model = quality.fitted(docs, labels, fit_rows=300)
    assert np.isfinite(model.base)


def test_features_do_not_reach_into_neighbours():
    texts = [t or "" for _, t in TEXTS]
    together = quality.features(texts)
    apart = np.concatenate([quality.features([t]) for t in texts])
    assert np.allclose(together, apart)
    assert together.shape[1] == len(quality.FEATURES)


def test_pairs_are_learned():
    rng = np.random.default_rng(0)
    rows = rng.uniform(size=(4000, 3))
    labels = ((rows[:, 0] > 0.5) ^ (rows[:, 1] > 0.5)).astype(float)
    model = gam.fit(rows[:3000], labels[:3000])
    assert (0, 1) in model.pairs
    assert np.mean((model.scores(rows[3000:]) >= 0.5) == labels[3000:]) > 0.95


@pytest.mark.parametrize("labels", [[], [1.0, 1.0], [0.0]])
def test_one_label_only(labels):
    model = gam.fit(np.zeros((len(labels), 2)), np.array(labels))
    score = model.scores(np.zeros((1, 2)))[0]
    assert (score >= 0.5) == (not labels or labels[0] == 1)


def test_repeated_ids_are_fitted_once(spark, shipping, monkeypatch):
    """However many rows a labelled id has, the driver gets one of them."""
    ids = [i for i in range(60) if zlib.crc32(str(i).encode()) % 3 != 1]
    rows = [(i, f"text {i} of some words") for i in ids] + [(ids[0], "again " * k) for k in range(1, 500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(i, i % 2) for i in ids], "doc_id long, quality int")
    seen = []
    monkeypatch.setattr(quality.gam, "fit", lambda matrix, label: seen.append((matrix, label)))
    quality.fitted(docs, labels)
    matrix, label = seen[0]
    assert len(matrix) == len(label) == len(ids) and label.tolist() == [i % 2 for i in ids]
    first = [t for i, t in rows if i == ids[0]]
    assert matrix[0].tolist() == min(quality.features(first).tolist())
