"""Hard-negative mining against a brute-force version."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortkit.llm import hard_negatives as HN
from cohortkit.llm.queries import QUERIES

SCHEMA = "vec_id bigint, embedding array<float>, label int, rid string, q string, id string, planes string, p string"


def brute(rows, is_anchor, n_pos=5, n_neg=3, low=50, high=95):
    """rows: (id, vector, label), each once."""
    good = [(i, [math.floor(256 * float(np.float32(x))) for x in v], y) for i, v, y in rows
            if v is not None and y is not None and all(x is not None and math.isfinite(x) for x in v)]
    good = list({(i, tuple(q), y): (i, q, y) for i, q, y in good}.values())
    order = lambda s, i: (-s, i is None, i or 0)
    out = []
    for k, (i, q, y) in enumerate(good):
        if not is_anchor(i):
            continue
        s = [(sum(a * b for a, b in zip(q, w)), j, z, m) for m, (j, w, z) in enumerate(good)]
        positives = sorted((x for x in s if x[2] == y and x[3] != k), key=lambda x: order(*x[:2]))[:n_pos]
        for ps, j, _, _ in positives:
            fit = sorted((x for x in s if x[2] != y and low * ps <= 100 * x[0] <= high * ps), key=lambda x: order(*x[:2]))[:n_neg]
            out += [(i, j, r + 1, x[1], ps, x[0]) for r, x in enumerate(fit)]
    return sorted(out, key=repr)


def vectors(n=260, dims=20, seed=2):
    rnd = random.Random(seed)
    rows = [(i, [round(rnd.gauss(0.2, 0.6), 2) for _ in range(dims)], rnd.randrange(3) if i % 4 else 0) for i in range(n)]
    rows += [(n + k, list(rows[5][1]), rnd.randrange(3)) for k in range(20)]                 # ties of one common vector
    rows += [(400, None, 1), (401, [0.5] * dims, None), (402, [float("nan")] * dims, 1), (403, [float("inf")] + [0.1] * (dims - 1), 1),
             (404, [None] + [0.1] * (dims - 1), 2), (405, [], 1), (406, [3.0, -2.5], 2), (407, [0.0] * dims, 0), (450, [1.5] * (dims + 3), 1)]
    return rows


@pytest.mark.parametrize("block", [(4096, 1024), (40, 3)])
def test_negatives_equal_brute_force(spark, block):
    rows = vectors()
    df = spark.createDataFrame([(*r, *["x"] * 5) for r in rows + rows[:30]], SCHEMA).repartition(5)   # repeated rows too
    got = HN.mine_negatives(df, F.col("vec_id") % 10 == 0, block=block)
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows, lambda i: i % 10 == 0)


def test_negatives_without_ids_and_with_repeated_ids(spark):
    rows = vectors(80)
    rows += [(None, [0.1 * k] * 20, k % 3) for k in range(10)] + [(10, [0.3] * 20, 1), (10, [0.4] * 20, 0)]
    df = spark.createDataFrame([(*r, *["x"] * 5) for r in rows], SCHEMA)
    got = HN.mine_negatives(df, F.col("vec_id") % 10 == 0)
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows, lambda i: i is not None and i % 10 == 0)


def test_no_rows_no_anchors(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert HN.mine_negatives(empty, F.col("vec_id") % 50 == 0).collect() == []
    some = spark.createDataFrame([(1, [0.5], 1, *["x"] * 5)], SCHEMA)
    assert HN.mine_negatives(some, F.col("vec_id") % 50 == 0).collect() == []
    assert HN.mine_negatives(some, F.lit(True)).collect() == []


@pytest.mark.parametrize("top", [1, 7, 300, 1 << 22])
def test_four_russians_scores_are_inner_products(top):
    rng = np.random.default_rng(4)
    a, c = (rng.integers(-top, top + 1, size=(n, 24)) for n in (150, 2100))
    bits = max(int(x.max()).bit_length() for x in (abs(a), abs(c))) + 1
    assert np.array_equal(HN.scores(HN.planes(c, bits), a), a @ c.T)
    low = np.full((1, 24), -top)
    assert np.array_equal(HN.scores(HN.planes(low, bits), low), low @ low.T)


def test_registered_query_on_a_small_folder(spark, tmp_path):
    rows = [(i, v, y) for i, v, y in vectors(150) if i is not None]
    spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int").write.parquet(str(tmp_path / "embeddings.parquet"))
    moved = [(i, v, None if y is None else (y + 1) % 10 if i % 7 == 0 else y) for i, v, y in rows]
    got = QUERIES["op12_hard_negatives"](spark, str(tmp_path))
    assert sorted(map(tuple, got.collect()), key=repr) == brute(moved, lambda i: i % 50 == 0)
