"""Quality: held-out accuracy, the risk and the prior on data with known classes."""

import zlib

import numpy as np
import pyarrow as pa
import pytest

from prefloom.llm import quality
from prefloom.llm.queries import QUERIES


@pytest.mark.parametrize("size,least", [("sf0.001", 0.8), ("sf0.01", 0.97)])
def test_held_out_labels(spark, size, least):
    folder = f"/root/testdata/{size}"
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    got = QUERIES["op4_classify_quality"](spark, folder).collect()
    assert len(got) == spark.read.parquet(f"{folder}/documents.parquet").count()
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    held = [r for r in got if r.held_out and r.doc_id in label]
    assert sum(r.predicted == label[r.doc_id] for r in held) / len(held) >= least
    if len(held) < 50:
        return
    good, bad = ([r.score for r in held if label[r.doc_id] == k] for k in (1, 0))
    assert np.mean([g > b for g in good for b in bad]) > 0.97


def test_prior_and_risk():
    rng = np.random.default_rng(1)

    def rows(n, good):
        middle = np.where(np.arange(n) < n * good, 1.0, -1.0)
        return np.concatenate([rng.normal(middle[:, None] * [1.5, 0, -1], 0.7), np.ones((n, 1))], axis=1), middle

    p, _ = rows(4000, 1.0)
    u, truth = rows(8000, 0.6)
    shuffled = rng.permutation(len(u))
    prior = quality.estimate_prior(p, u[shuffled])
    assert prior == pytest.approx(0.6, abs=0.06)
    w = quality.fit(p, u, prior)
    assert ((u @ w > 0) == (truth > 0)).mean() > 0.97
    assert quality.sigmoid(u @ w).mean() == pytest.approx(0.6, abs=0.08)


def test_defined_results(spark):
    rows = [(1, None, 9.0), (2, "", 9.0), (None, "a b c", 9.0), (4, "word " * 300_000, 9.0), (4, "x", 9.0), (4, "x", 9.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score double")
    labels = spark.createDataFrame([(2, 1), (4, 1), (4, 0), (None, 1), (77, 1), (1, None)], "doc_id long, quality int")
    got = quality.classify(docs, labels).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    scores = {r.score for r in got if r.doc_id in (1, 2)}
    assert len(scores) == 1
    assert {r.score for r in quality.classify(docs, labels.limit(0)).collect()} == {0.5}
    assert quality.classify(docs.limit(0), labels).count() == 0
    kept = quality.keep_good(docs, labels.limit(0))
    assert kept.columns == docs.columns and kept.count() == len(rows)


def test_features_of_known_texts():
    x = quality.features(pa.array(["", None, "To To To To", "AB!! CD!!", "ab, cd"]))
    assert np.isfinite(x).all() and (x[0] == x[1]).all()
    same = 2 * quality.CLASSES
    assert x[2, same] == pytest.approx(np.sqrt(0.75))
    assert x[3, same + 4] == 1 and x[4, same + 4] == 0
    assert x[3, 0] == pytest.approx(np.sqrt(4 / 9))
