"""Sparse note vectors over the whole vocabulary, against dictionaries."""

import math
import re
from collections import Counter

import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from cohortkit.operators import lists as L
from cohortkit.operators import text as T


def notes():
    rows = [(i, f"common word{i % 13} word{i % 7} word{i % 7} " + "good " * (i % 2)) for i in range(120)]
    return rows + [(500, None), (501, ""), (502, "?!"), (503, "once only")]


def brute(rows):
    words = {i: Counter(w for w in re.split("[^a-z0-9]+", (t or "").lower()) if w) for i, t in rows}
    df = Counter(w for c in words.values() for w in c)
    vocab = {w: k for k, w in enumerate(sorted(df))}
    return vocab, {i: sorted((vocab[w], round(n * math.log((len(rows) + 1) / (df[w] + 1)), 6)) for w, n in c.items()) for i, c in words.items()}


def test_vectors_equal_dictionaries(spark):
    rows = notes()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    vectors, vocabulary = T.sparse_vectors(docs, "doc_id", T.tfidf_terms(docs, "doc_id", "text"))
    vocab, want = brute(rows)
    assert {r["term"]: r["idx"] for r in vocabulary.collect()} == vocab
    got = {r["doc_id"]: r["features"] for r in vectors.collect()}
    assert set(got) == set(want) and all(v.size == len(vocab) for v in got.values())
    for i, v in got.items():
        assert v.indices.tolist() == [k for k, _ in want[i]]
        assert v.values.tolist() == pytest.approx([w for _, w in want[i]])


def test_an_earlier_vocabulary_leaves_unknown_terms_out(spark):
    old = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    new = spark.createDataFrame([(7, "c d a"), (8, "d"), (9, None)], "doc_id long, text string")
    _, vocabulary = T.sparse_vectors(old, "doc_id", T.tfidf_terms(old, "doc_id", "text"))
    vectors, _ = T.sparse_vectors(new, "doc_id", T.tfidf_terms(new, "doc_id", "text"), vocabulary=vocabulary)
    assert {r["doc_id"]: (r["features"].size, r["features"].indices.tolist()) for r in vectors.collect()} == {7: (3, [0, 2]), 8: (3, []), 9: (3, [])}


def test_a_classifier_learns_from_the_vectors(spark):
    docs = spark.createDataFrame([r for r in notes() if r[0] < 200], "doc_id long, text string")
    vectors, _ = T.sparse_vectors(docs, "doc_id", T.tfidf_terms(docs, "doc_id", "text"))
    rows = vectors.withColumn("label", (F.col("doc_id") % 2).cast("double"))
    out = LogisticRegression(maxIter=20, regParam=0.01).fit(rows).transform(rows)
    assert out.where("label = prediction").count() == 120


def test_no_documents(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    vectors, vocabulary = T.sparse_vectors(docs, "doc_id", T.tfidf_terms(docs, "doc_id", "text"))
    assert vectors.count() == vocabulary.count() == 0


def test_multi_hot_inverse_names_what_is_set(spark):
    df = spark.createDataFrame([(1, 1, 0, 2), (2, 0, 0, 0), (3, None, 1, None)], "id int, a int, b int, c int")
    got = {r["id"]: r["items"] for r in L.multi_hot_inverse(df, "id", {"a": "x", "b": "y", "c": "z"}).collect()}
    assert got == {1: ["x", "z"], 2: [], 3: ["y"]}


def test_terms_counted_in_blocks_equal_dictionaries(spark, monkeypatch):
    from cohortkit.operators import termblocks

    monkeypatch.setattr(termblocks.TermBlocks.__init__, "__defaults__", (300,))     # many blocks
    rows = [*notes(), (3, "again once"), (3, "again"), (None, "nobody good"), (None, "nobody")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    merged = {}
    for i, t in rows:
        merged[i] = f"{merged.get(i, '')} {t or ''}"
    vocab, want = brute(list(merged.items()))
    freq = Counter(k for v in want.values() for k, _ in v)
    names = {k: w for w, k in vocab.items()}

    def weight(tf, k):
        return round(tf * math.log((len(rows) + 1) / (freq[k] + 1)), 6)

    counts = {(i, w): n for i, t in merged.items() for w, n in Counter(t.lower().replace("?!", "").split()).items()}
    got = T.tfidf_terms(docs, "doc_id", "text").collect()
    assert len(got) == len(counts)
    for r in got:
        assert (r.tf, r.df) == (counts[r.doc_id, r.term], freq[vocab[r.term]])
        assert r.weight == pytest.approx(weight(r.tf, vocab[r.term]), abs=2e-6)
    lists, vocabulary = T.tfidf_terms(docs, "doc_id", "text", listed=True)
    assert {r.term: (r.idx, r.df) for r in vocabulary.collect()} == {w: (k, freq[k]) for w, k in vocab.items()}
    vectors, _ = T.sparse_vectors(docs, "doc_id", lists, vocabulary=vocabulary, listed="entries")
    found = vectors.collect()
    assert Counter(r.doc_id for r in found) == Counter(i for i, _ in rows)
    for r in found:
        terms = [] if r.doc_id is None else [k for k, _ in want[r.doc_id]]
        assert r.features.indices.tolist() == terms and r.features.size == len(vocab)
        assert r.features.values.tolist() == pytest.approx([weight(counts[r.doc_id, names[k]], k) for k in terms], abs=2e-6)


def test_no_document_term_row_is_shuffled(spark):
    docs = spark.createDataFrame(notes(), "doc_id long, text string")
    plan = T.tfidf_terms(docs, "doc_id", "text")._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan and "Generate" not in plan
