"""Logistic regression in numbers per training row: Spark ML's path and predictions, no vector of coefficients on the driver."""

import random

import numpy as np
import pytest
from pyspark.ml.linalg import SparseVector, VectorUDT
from pyspark.sql import types as T

from cohortkit.operators import logistic
from cohortkit.operators import models as ML

SCHEMA = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("features", VectorUDT()), T.StructField("label", T.IntegerType())])


def _rows(spark, n, terms, seed, per=8):
    """Few frequent and many rare terms; term 0 has the same weight in every row."""
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        idx = {0: 0.7} | {min(int(rnd.paretovariate(0.5)), terms - 1): rnd.choice([0.5, 1.5, 2.25]) for _ in range(per)}
        rows.append((i, SparseVector(terms, idx), int(rnd.random() < (0.7 if 1 in idx else 0.2))))
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.mark.parametrize("balanced", [True, False])
def test_same_path_and_predictions_as_spark_ml(spark, monkeypatch, balanced):
    monkeypatch.setattr(logistic, "GROUP_ENTRIES", 100)
    monkeypatch.setattr(logistic, "CHUNK_ROWS", 64)
    train, test = _rows(spark, 300, 900, 1), _rows(spark, 90, 900, 2)
    if not balanced:        # weighted, Spark's deviation of the constant term 0 is some 1e-17 and not 0, which only rows without it show
        test = test.union(spark.createDataFrame([(1000, SparseVector(900, {}), 0), (1000, SparseVector(900, {}), 1)], SCHEMA))
    got, history = logistic.logistic_scores(train, test, "label", max_iter=30, reg=0.001, balanced=balanced)
    model = ML.fit("logreg", train, "label", balanced=balanced, maxIter=30, regParam=0.001)
    assert np.allclose(history, model.summary.objectiveHistory, rtol=1e-6)
    want = ML.score(model, test, ["id"], "label")
    key = lambda r: (r["id"], r["label"])                                                           # noqa: E731
    pairs = list(zip(sorted(got.collect(), key=key), sorted(want.collect(), key=key), strict=True))
    assert len(pairs) == (90 if balanced else 92)
    assert all(a["prediction"] == b["prediction"] and abs(a["p_last"] - b["p_last"]) < 1e-4 for a, b in pairs)


def test_what_is_sent_does_not_grow_with_the_terms(spark, monkeypatch):
    sent = []
    fetch = logistic._Table.train_scores
    monkeypatch.setattr(logistic._Table, "train_scores", lambda self, numbers: sent.append(fetch(self, numbers)) or sent[-1])
    train = _rows(spark, 40, 200_000, 3)
    logistic.logistic_scores(train, train, "label", max_iter=3, reg=0.001)
    assert sent and all(s.shape == (40,) for s in sent)


def test_no_terms_at_all(spark):
    rows = spark.createDataFrame([(i, SparseVector(5, {}), i % 2) for i in range(6)], SCHEMA)
    got, history = logistic.logistic_scores(rows, rows, "label", max_iter=3, reg=0.001)
    assert len(history) == 1 and {r["p_last"] for r in got.collect()} == {0.5}
