"""Word vectors: lookup, blocked neighbours and landmark projections against dense numpy versions."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortkit.operators import wordspace as W


def table(spark, n=300, dims=5, seed=3):
    rng = np.random.default_rng(seed)
    v = rng.integers(-9, 10, size=(n, dims)).astype(float)
    v[7] = v[8] = v[9]                              # ties
    v[11] = 0                                       # a zero vector
    words = [f"w{k:03d}" for k in range(n)]
    df = spark.createDataFrame([(w, x.tolist()) for w, x in zip(words, v)] + [("empty", None)], "word string, vector array<double>")
    return words, v, df.repartition(4)


def brute(words, v, query, k):
    q = v[words.index(query)]
    out = []
    for w, x in zip(words, v):
        if w != query:
            norm = np.sqrt((q * q).sum()) * np.sqrt((x * x).sum())
            out.append((-round(float(q @ x / norm), 6) if norm else -0.0, w))
    return [(query, r + 1, w, -s) for r, (s, w) in enumerate(sorted(out)[:k])]


@pytest.mark.parametrize("block", [(8192, 512), (37, 2)])
def test_neighbours_equal_brute_force(spark, block):
    words, v, df = table(spark)
    asked = ["w007", "w009", "w011", "w100", "w299", "w100"]
    queries = spark.createDataFrame([(w,) for w in [*asked, "absent", "empty", None]], "word string")
    got = W.neighbours(df, queries, 8, block=block).collect()
    want = [r for q in sorted(set(asked)) for r in brute(words, v, q, 8)]
    assert sorted((r["query"], r["rank"], r["word"], r["similarity"]) for r in got if r["rank"]) == want
    assert sorted(r["query"] for r in got if r["rank"] is None) == ["absent", "empty"]


def test_lookup_marks_words_without_a_vector(spark):
    words, v, df = table(spark, 20)
    got = W.lookup(df, spark.createDataFrame([("w003",), ("absent",), ("empty",), ("w003",)], "word string")).collect()
    assert sorted((r["word"], r["found"], r["vector"]) for r in got if r["found"]) == [("w003", True, v[3].tolist())] * 2
    assert sorted((r["word"], r["vector"]) for r in got if not r["found"]) == [("absent", None), ("empty", None)]


def dense(v, k):
    """Classical scaling of all points."""
    c = v - v.mean(axis=0)
    u, s, _ = np.linalg.svd(c, full_matrices=False)
    return np.stack([u[:, i] * s[i] * np.sign(u[np.abs(u[:, i]).argmax(), i]) for i in range(k)], axis=1)


@pytest.mark.parametrize("k", [2, 3])
def test_all_points_as_landmarks_give_classical_scaling(spark, k):
    words, v, df = table(spark, 80)
    got = {r["word"]: r for r in W.landmark_projection(df, "word", "vector", k, landmarks=80).collect()}
    assert np.allclose([[got[w][f"x{i + 1}"] for i in range(k)] for w in words], dense(v, k), atol=1e-5)
    assert got["empty"]["x1"] is None


def test_few_landmarks_place_a_plane_exactly(spark):
    rng = np.random.default_rng(8)
    flat = rng.normal(size=(400, 2)) * [5.0, 2.0]
    v = np.concatenate([flat, flat @ rng.normal(size=(2, 3))], axis=1)            # a plane in five dimensions
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "id long, v array<double>").repartition(3)
    got = {r["id"]: (r["x1"], r["x2"], r["x3"]) for r in W.landmark_projection(df, "id", "v", 3, landmarks=20).collect()}
    x = np.array([got[i] for i in range(400)])
    apart = lambda m: np.sqrt(((m[:, None] - m[None]) ** 2).sum(axis=2))
    assert np.allclose(apart(x[:, :2]), apart(v), atol=1e-4) and np.all(x[:, 2] == 0)


def test_no_vectors(spark):
    _, _, df = table(spark, 20)
    none = df.where(F.lit(False))
    assert W.landmark_projection(none, "word", "vector", 2).collect() == []
    got = W.neighbours(none, df.select("word").limit(1)).collect()
    assert [(r["rank"], r["word"]) for r in got] == [(None, None)]
