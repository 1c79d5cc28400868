import numpy as np
import pyarrow as pa
import pytest

from marquee.llm import quality
from marquee.llm.quality import SCORES, fit_logistic, known_labels, score_documents
from marquee.llm.words import words_of

SCHEMA = "doc_id long, text string, source string, lang string, p_bad string, bad int"


def test_held_out_accuracy(spark, sf_dir):
    """Half of the labels are kept from training; they must be told by the scores."""
    path = sf_dir.replace("sf0.001", "sf0.1")
    docs = spark.read.parquet(f"{path}/documents.parquet")
    labels = spark.read.parquet(f"{path}/labels.parquet")
    scored = score_documents(docs, labels.where("doc_id % 2 = 0"))
    told = scored.join(known_labels(labels).where("doc_id % 2 = 1"), "doc_id").toPandas()
    right = ((told["p_bad"] >= 0.5) == (told["bad"] == 1)).mean()
    kept = (told[told["bad"] == 0]["p_bad"] < 0.5).mean()
    assert len(told) > 1000 and right > 0.9 and kept > 0.95


def test_edges(spark, sf_dir):
    rows = [(i, ("fine words here " if i % 2 else "%%% !!! ### ") * 20, f"s{i % 3}", "en", "old", 1) for i in range(60)]
    rows += [(100, None, None, None, None, None), (101, "", "s1", "en", "", 0), (None, "fine words", "s1", "en", "", 0)]
    rows += [rows[0], (0, "other text", "s1", "en", "", 0), (102, "x" * 10**6, "s0", "en", "", 0)]
    docs = spark.createDataFrame(rows, SCHEMA)
    marks = [(i, i % 2, 0) for i in range(50)] + [(1, 1, 0), (None, 0, 1), (2, None, None), (5, 1, None), (999, 1, 1)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    got = score_documents(docs, labels)
    assert set(got.columns) == set(docs.columns) | set(SCORES)
    found = got.collect()
    assert len(found) == len(rows) and all(0 <= g.p_bad <= 1 for g in found)
    p = {g.doc_id: g.p_bad for g in found if g.doc_id is not None}
    assert p[57] < 0.5 < p[58]
    assert score_documents(docs.limit(0), labels).collect() == []
    assert {g.p_bad for g in score_documents(docs, labels.limit(0)).collect()} == {0.0}


def test_known_labels(spark):
    rows = [(1, 1, 0), (1, 0, 0), (2, 1, 1), (3, None, None), (4, None, 1), (5, 1, None), (None, 0, 0)]
    got = known_labels(spark.createDataFrame(rows, "doc_id long, quality int, toxic int"))
    assert sorted(map(tuple, got.collect())) == [(1, 1.0), (2, 1.0), (4, 1.0), (5, 0.0)]


def test_features_do_not_depend_on_chunks():
    texts = ["a a a | | B!", "", None, "one.\ntwo.\nthree", "x " * 500]
    whole = [quality.content_features(w) for w in words_of(pa.array(texts))]
    parts = [quality.content_features(w) for w in words_of(pa.array(texts), chunk_bytes=1)]
    assert np.allclose(np.concatenate([w[1] for w in whole]), np.concatenate([p[1] for p in parts]))
    assert whole[0][1][0][0] == pytest.approx(3 / 6)


def test_calibration():
    r = np.random.default_rng(0)
    x = r.normal(size=(4000, 1))
    y = (r.random(4000) < 1 / (1 + np.exp(-(2 * x[:, 0] - 1)))).astype(float)
    assert fit_logistic(x, y, (0, 1)) == pytest.approx([-1, 2], abs=0.25)
    few = fit_logistic(np.array([[3.0], [-3.0]]), np.array([0.0, 1.0]), (0, 1))
    assert few[1] > 0
