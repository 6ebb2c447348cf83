import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from snapsync.llm import common
from snapsync.llm import quality_classifier as qc

LABELS = "doc_id long, quality int, toxic int"


def brute(docs, labels):
    """Scores by plain class covariances and inverses."""
    x = {d: np.array(qc.features(t or "")) for d, t in docs}
    known = [(x[d], y) for d, y in labels.items() if d in x and zlib.crc32(str(d).encode()) % 3 != 1]
    densities = []
    for y in (1, 0):
        own = np.array([v for v, q in known if q == y])
        mean, cov = own.mean(0), np.cov(own.T, bias=True)
        spread = np.diag(np.maximum(np.diag(cov), qc.LEAST_VARIANCE))
        cov = 0.9 * cov + 0.1 * spread + qc.LEAST_VARIANCE * np.eye(len(cov))
        prior = len(own) / len(known)
        inverse, det = np.linalg.inv(cov), np.linalg.slogdet(cov)[1]
        densities.append(
            {d: np.log(prior) - (det + (v - mean) @ inverse @ (v - mean)) / 2 for d, v in x.items()}
        )
    return {d: 1 / (1 + np.exp(-np.clip(densities[0][d] - densities[1][d], -700, 700))) for d in x}


def test_scores_equal_the_formula_and_hold_out(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    got = {r.doc_id: r for r in qc.classified(docs, labels).collect()}
    truth = {r.doc_id: r.quality for r in labels.collect()}
    expected = brute([(r.doc_id, r.text) for r in docs.collect()], truth)
    assert got.keys() == expected.keys()
    for d, r in got.items():
        assert r.held_out == (zlib.crc32(str(d).encode()) % 3 == 1)
        assert r.score == pytest.approx(expected[d], abs=1e-6)
    held = [(got[d].score >= 0.5) == (y == 1) for d, y in truth.items() if got[d].held_out]
    assert np.mean(held) >= 0.95


def test_features_of_odd_texts():
    for text in ["", " ", "one", "word " * 50_000, "\x00", "a\n" * 9, "é" * 100_000]:
        found = qc.features(text)
        assert len(found) == len(qc.FEATURES) and np.isfinite(found).all()


def test_nulls_repeats_and_missing_labels(spark):
    rows = [(1, "good words here"), (1, "good words here"), (None, None), (2, ""), (3, "# # # #")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs = docs.withColumns({"score": F.lit("s"), "held_out": F.lit(3), "x": F.lit(1)})
    none = spark.createDataFrame([], LABELS)
    assert {r.score for r in qc.classified(docs, none).collect()} == {1.0}
    odd = spark.createDataFrame(
        [(1, 1, 0), (1, 1, 0), (None, 0, 0), (2, None, 0), (77, 0, 1), (3, 0, 0), (0, 1, 0)], LABELS
    )
    found = qc.classified(docs, odd)
    assert found.count() == len(rows)
    assert all(0 <= r.score <= 1 for r in found.collect())
    kept = qc.kept(docs, odd)
    assert kept.columns == docs.columns and kept.filter("doc_id IS NULL OR doc_id = 1").count() == 3
    assert qc.classified(docs.limit(0), odd).count() == 0
    assert qc.kept(docs.limit(0), none).count() == 0


def test_many_labels_and_many_rejected_rows_are_not_broadcast(spark, monkeypatch):
    rows = [(i, f"good words here {i}" if i % 2 else f"# {i} # !") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(40)], LABELS)
    kept = {r.doc_id for r in qc.kept(docs, labels).collect()}
    assert kept == {i for i in range(40) if i % 2}
    plans = []

    def noted(joined, fit=qc.fit):
        plans.append(joined._jdf.queryExecution().executedPlan().toString())
        return fit(joined)

    monkeypatch.setattr(qc, "fit", noted)
    monkeypatch.setattr(common, "BROADCAST_ROWS", 10)
    found = qc.kept(docs, labels)
    plans.append(found._jdf.queryExecution().executedPlan().toString())
    assert len(plans) == 2 and all("SortMergeJoin" in p and "Broadcast" not in p for p in plans)
    assert {r.doc_id for r in found.collect()} == kept
