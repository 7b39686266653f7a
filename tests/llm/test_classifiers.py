"""Classifiers: held-out accuracy on the given tables, exact neighbours, odd input."""

from __future__ import annotations

import zlib

import numpy as np
import pytest
from small_corpus import frame, texts

from tablesync.llm import quality_knn, toxicity
from tablesync.llm.common import documents, labels

CASES = [(quality_knn, "quality", 4, 2), (toxicity, "toxic", 3, 1)]


def auc(scores: np.ndarray, truth: np.ndarray) -> float:
    above = scores[truth == 1][:, None] - scores[truth == 0][None, :]
    return float(np.mean((above > 0) + 0.5 * (above == 0)))


@pytest.mark.parametrize(("module", "label", "modulus", "rest"), CASES)
def test_held_out_accuracy(spark, module, label, modulus, rest):
    sf = "/root/testdata/sf0.1"
    got = module.report(documents(spark, sf), labels(spark, sf)).toPandas()
    assert len(got) == documents(spark, sf).count() and got["score"].between(0, 1).all()
    assert (got["predicted"] == (got["score"] >= 0.7)).all()
    held = [zlib.crc32(str(i).encode()) % modulus == rest for i in got["doc_id"]]
    assert (got["held_out"] == held).all()
    known = got[got["held_out"]].merge(labels(spark, sf).toPandas(), on="doc_id")
    truth, scores = known[label].to_numpy(), known["score"].to_numpy()
    assert auc(scores, truth) >= 0.97
    assert np.mean(known["predicted"] == truth) >= 0.96


@pytest.mark.parametrize(("module", "label", "modulus", "rest"), CASES)
def test_odd_input(spark, module, label, modulus, rest):
    given = texts() + ["bad $$$ %%%"] * 20
    docs = frame(spark, given, [*range(len(given) - 2), None, 3])
    rows = [(i, i % 2, (i + 1) % 2) for i in range(0, len(given), 2)] + [(None, 1, 0), (1, None, 7), (999, 0, 1)]
    known = spark.createDataFrame(rows + rows[:3], "doc_id long, quality int, toxic int")
    known = known.selectExpr("*", "'x' AS text", "1 AS label")
    got = module.report(docs, known).collect()
    assert len(got) == len(given) and all(0 <= r.score <= 1 for r in got)
    assert all(not r.held_out for r in got if r.doc_id is None)
    empty = [r.score for r in got if r.doc_id in (0, 1)]
    assert len(set(empty)) == 1, "NULL and empty texts score alike"
    assert module.report(docs.limit(0), known).collect() == []
    none = module.report(docs, known.limit(0)).collect()
    assert {r.score for r in none} == {0.5} and {r.predicted for r in none} == {0}


def test_labels_of_held_out_rows_teach_nothing(spark):
    given = [f"{'bad ***' if i % 2 else 'good one'} {i} text of some words" for i in range(80)]
    docs = frame(spark, given)
    rows = [(i, i % 2, i % 2) for i in range(80)]
    for module, _, modulus, rest in CASES:
        turned = [
            (i, 1 - q, 1 - t) if zlib.crc32(str(i).encode()) % modulus == rest else (i, q, t) for i, q, t in rows
        ]
        scores = [
            {r.doc_id: r.score for r in module.report(docs, spark.createDataFrame(k, "doc_id long, quality int, toxic int")).collect()}
            for k in (rows, turned)
        ]
        assert scores[0] == scores[1]


def test_votes_equal_all_cosines(spark):
    """Blocks and partial sorting give the votes of the nearest neighbours by plain sorting."""
    sf = "/root/testdata/sf0.01"
    voters = quality_knn.fit(documents(spark, sf), labels(spark, sf))
    given = [r.text for r in documents(spark, sf).limit(300).collect()]
    own = quality_knn.NEIGHBOURS * quality_knn.PRIOR_COSINE**quality_knn.POWER * voters.stands_for.mean()
    for text, score in zip(given, voters.score(given)):
        cosine = voters.vectors.astype(float) @ voters.latent([text])[0].astype(float)
        near = np.argsort(-cosine)[: quality_knn.NEIGHBOURS]
        weight = np.maximum(cosine[near], 0) ** quality_knn.POWER * voters.stands_for[near]
        want = (weight @ voters.labels[near] + own * voters.prior) / (weight.sum() + own)
        assert abs(want - score) < 1e-3


def test_frequencies_cover_all_documents(spark):
    given = texts()
    seen, rows = quality_knn.document_frequencies(frame(spark, given).repartition(5))
    want = sum((quality_knn.term_counts(t or "") > 0).astype(int) for t in given)
    assert rows == len(given) and (seen == want).all()


def test_ratio_and_ngrams():
    assert toxicity.ngrams("abc").size == 0 and toxicity.ngrams("ABCD").tolist() == toxicity.ngrams("abcd").tolist()
    whole = toxicity.ngrams("some text of words")
    assert len(whole) == 15 + 14 + 13 + 12
    positive, negative = np.array([30.0, 0, 5]), np.array([0.0, 30, 5])
    ratio = toxicity.log_count_ratio(positive, negative)
    assert ratio[0] == pytest.approx(np.log(31)) and ratio[1] == pytest.approx(-np.log(31)) and ratio[2] == 0
