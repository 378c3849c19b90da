"""Long boosting: trees against a plain version, resumed runs, early stop."""

import os
import shutil

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortkit.operators import boosting as B


def table(spark, n=600, seed=4):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, 3)), 3)
    y = ((x[:, 0] > 0.2) ^ (x[:, 1] > 0) | (rng.random(n) < 0.05)).astype(int)
    rows = [(i, [None if (i % 17 == 0 and j == 2) else float(v) for j, v in enumerate(x[i])], int(y[i]), i % 5 == 0) for i in range(n)]
    return spark.createDataFrame(rows + [(n, None, 1, False), (n + 1, [0.0, 0.0, 0.0], None, False)], "id long, x array<double>, y int, test boolean").repartition(4)


def plain(rows, cuts, rounds, depth, rate, n_bins, lam=1.0, least=1.0):
    """Boosting over rows in memory by explicit sums."""
    bins = np.array([[0 if v is None else 1 + sum(c < v for c in own) for v, own in zip(x, cuts)] for _, x, _, _ in rows])
    y, train = np.array([r[2] for r in rows], float), np.array([not r[3] for r in rows])
    margin, curve = np.zeros(len(rows)), []
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        g, h = np.rint((p - y) * 2 ** 24) / 2 ** 24, np.rint(p * (1 - p) * 2 ** 24) / 2 ** 24
        step = np.zeros(len(rows))
        todo = [(np.arange(len(rows)), 0)]
        while todo:
            own, level = todo.pop()
            t = own[train[own]]
            G, H, best = g[t].sum(), h[t].sum(), (1e-9, None)
            if level < depth:
                for f in range(bins.shape[1]):
                    for c in range(n_bins - 1):
                        left = t[bins[t, f] <= c]
                        gl, hl = g[left].sum(), h[left].sum()
                        if hl >= least and H - hl >= least:
                            gain = gl ** 2 / (hl + lam) + (G - gl) ** 2 / (H - hl + lam) - G ** 2 / (H + lam)
                            if gain > best[0] + 1e-12:
                                best = (gain, (f, c))
            if best[1]:
                f, c = best[1]
                todo += [(own[bins[own, f] <= c], level + 1), (own[bins[own, f] > c], level + 1)]
            else:
                step[own] = -rate * G / (H + lam) if H > 0 else 0.0
        margin = margin + step
        wrong = (margin > 0) != (y > 0)
        curve.append((wrong[train].mean(), wrong[~train].mean()))
    return margin, curve


def test_boosting_equals_the_plain_version(spark, scratch):
    df = table(spark)
    model, history = B.fit_boosted(df, "x", "y", "test", 3, rounds=5, depth=2, bins=9, interval=2, path=f"{scratch}/b")
    rows = [(r.id, r.x, r.y, r.test) for r in df.where("x is not null and y is not null").collect()]
    margin, curve = plain(rows, model["cuts"], 5, 2, 0.1, 9)
    assert np.allclose([(h["train_error"], h["test_error"]) for h in history], curve) and [h["round"] for h in history] == [1, 2, 3, 4, 5]
    got = {r["id"]: r["p_last"] for r in B.predict_boosted(df, model, "x").collect()}
    assert [got[r[0]] for r in rows] == pytest.approx((1 / (1 + np.exp(-margin))).tolist(), abs=2e-6)
    assert got[600] is None


def test_a_resumed_run_equals_an_unbroken_one(spark, scratch):
    df = table(spark)
    fit = lambda rounds, where: B.fit_boosted(df, "x", "y", "test", 3, rounds=rounds, depth=2, bins=9, interval=3, path=f"{scratch}/{where}")
    whole, curve = fit(8, "whole")
    fit(5, "parts")                                          # ends two rounds behind its last checkpoint
    assert sorted(os.listdir(f"{scratch}/parts")) == ["round-3"]
    shutil.copytree(f"{scratch}/parts/round-3", f"{scratch}/parts/round-9")
    os.remove(f"{scratch}/parts/round-9/model/_SUCCESS")     # an unfinished checkpoint is ignored
    again, rest = fit(8, "parts")
    assert again == whole and rest == curve


def test_learns_and_stops_early(spark, scratch):
    df = table(spark, 900)
    _, history = B.fit_boosted(df, "x", "y", "test", 3, rounds=40, depth=2, bins=17, interval=10, rate=0.5, patience=4, path=f"{scratch}/b")
    assert min(h["test_error"] for h in history) < 0.15 and len(history) < 40
    best = min(h["test_error"] for h in history[:-4])
    assert min(h["test_error"] for h in history[-4:]) >= best


def test_other_parameters_start_anew_and_no_rows(spark, scratch):
    df = table(spark, 200)
    B.fit_boosted(df, "x", "y", "test", 3, rounds=2, depth=1, bins=9, interval=2, path=f"{scratch}/b")
    model, _ = B.fit_boosted(df, "x", "y", "test", 3, rounds=1, depth=2, bins=9, interval=2, path=f"{scratch}/b")
    assert len(model["trees"]) == 1 and len(model["trees"][0]["value"]) == 7
    none, history = B.fit_boosted(df.where(F.lit(False)), "x", "y", "test", 3, rounds=1, depth=1, path=f"{scratch}/none")
    assert history == [{"round": 1, "train_error": None, "test_error": None}] and set(none["trees"][0]["value"]) == {0.0}
