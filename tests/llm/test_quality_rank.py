"""Ranking on held-out labels, and odd rows."""

import zlib

import numpy as np
from conftest import SF_DIR

from tidemark.llm.common import documents, labels
from tidemark.llm.quality_rank import FEATURES, features, fit, good_documents, quality_scores

DOCS = "doc_id bigint, text string, score string, features int"
LABELS = "doc_id bigint, quality int, toxic int, text string"


def test_held_out_accuracy_and_columns(spark):
    docs, marks = documents(spark, SF_DIR), labels(spark, SF_DIR)
    rows = quality_scores(docs, marks).collect()
    truth = {r.doc_id: r.quality for r in marks.collect()}
    assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in docs.collect())
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
    held = [(r.predicted, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    assert np.mean([p == t for p, t in held]) >= 0.9
    kept = {r.doc_id for r in good_documents(docs, marks).collect()}
    assert kept == {r.doc_id for r in rows if r.predicted}


def test_held_out_labels_are_not_read(spark):
    docs, marks = documents(spark, SF_DIR), labels(spark, SF_DIR)
    turned = marks.selectExpr(
        "doc_id",
        "if(crc32(cast(doc_id as string)) % 4 = 2, 1 - quality, quality) as quality",
        "toxic",
    )
    first = {r.doc_id: r.score for r in quality_scores(docs, marks).collect()}
    assert first == {r.doc_id: r.score for r in quality_scores(docs, turned).collect()}


def test_odd_rows(spark):
    odd = [(None, "a b c", None, 1), (1, None, "x", None), (2, "", None, None), (3, " \n ", None, 2)]
    odd += [(4, "same words here", None, None)] * 2 + [(5, "x" * 200_000, None, None)]
    marks = [(4, 1, None, "t"), (5, 0, 0, None), (None, 1, 0, None), (2, None, 1, None)]
    docs, marks = spark.createDataFrame(odd, DOCS), spark.createDataFrame(marks, LABELS)
    rows = quality_scores(docs, marks).collect()
    assert len(rows) == len(odd) and all(0 <= r.score <= 1 for r in rows)
    assert good_documents(docs, marks).columns == docs.columns
    nothing = quality_scores(docs, marks.limit(0)).collect()
    assert all(r.predicted == 1 for r in nothing)
    assert quality_scores(docs.limit(0), marks).count() == 0


def test_ties_and_features():
    x = np.array([features(b"one two three"), features(b"one two three")])
    assert (fit(x, np.array([True, False])).score(x) >= 0.69).all()
    assert len(features(b"a")) == len(features(b"")) == len(FEATURES)
