"""Mini-batch gradient learners against a plain numpy version."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortkit.operators import gradient as G


def table(spark, n=400):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(n, 4))
    y = ((x[:, 0] + x[:, 1] ** 2 + 0.3 * rng.normal(size=n)) > 1.2).astype(int)
    rows = [(i, [float(v) for v in x[i]], int(y[i])) for i in range(n)] + [(n, None, 1), (n + 1, [0.0] * 4, None)]
    return spark.createDataFrame(rows, "id long, f array<double>, y int").repartition(5)


def plain(rows, net, epochs, batches, rate, method):
    """The same steps over rows held in memory, one row's gradient after the other."""
    w, m, v, t, losses = net.weights.copy(), net.first.copy(), net.second.copy(), net.steps, []
    for _ in range(epochs):
        total = weight = 0.0
        for b in range(batches):
            own = [r for r in rows if r["batch"] == b]
            grad, mass = np.zeros_like(w), 0.0
            for r in own:
                loss, _, g = G.loss_and_gradient(w, net.sizes, np.array([r["x"]]), np.array([r["y"]]), np.array([r["w"]]))
                grad, mass, total = grad + g, mass + r["w"], total + loss
            weight += mass
            t += 1
            g = grad / mass
            if method == "adam":
                m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g ** 2
                w = w - rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
            else:
                w = w - rate * g
        losses.append(total / weight)
    return w, losses


def test_gradient_against_finite_differences():
    rng = np.random.default_rng(1)
    net = G.new_net((3, 5, 4, 3), seed=2)
    x, y, w = rng.normal(size=(7, 3)), rng.integers(0, 3, 7), rng.uniform(0.5, 2, 7)
    _, _, grad = G.loss_and_gradient(net.weights, net.sizes, x, y, w)
    for i in range(len(net.weights)):
        up, down = net.weights.copy(), net.weights.copy()
        up[i] += 1e-6
        down[i] -= 1e-6
        slope = (G.loss_and_gradient(up, net.sizes, x, y, w)[0] - G.loss_and_gradient(down, net.sizes, x, y, w)[0]) / 2e-6
        assert grad[i] == pytest.approx(slope, abs=1e-5)


def test_gradient_of_many_labels_against_finite_differences():
    rng = np.random.default_rng(1)
    net = G.new_net((3, 5, 4), seed=2, multi=True)
    x, y, w = rng.normal(size=(7, 3)), rng.integers(0, 2, (7, 4)).astype(float), rng.uniform(0.5, 2, 7)
    loss, _, grad = G.loss_and_gradient(net.weights, net.sizes, x, y, w, multi=True)
    p = G.probabilities(net.weights, net.sizes, x, multi=True)[-1]
    assert loss == pytest.approx(-(w[:, None] * (y * np.log(p) + (1 - y) * np.log(1 - p))).sum())
    for i in range(len(net.weights)):
        step = np.zeros_like(net.weights)
        step[i] = 1e-6
        slope = (G.loss_and_gradient(net.weights + step, net.sizes, x, y, w, True)[0] - G.loss_and_gradient(net.weights - step, net.sizes, x, y, w, True)[0]) / 2e-6
        assert grad[i] == pytest.approx(slope, abs=1e-5)


def test_one_pass_fits_each_label_as_on_its_own(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 3))
    have = np.stack([x[:, 0] > 0, x[:, 1] + x[:, 2] > 0.5, x[:, 2] < -0.2, np.zeros(300, bool)], axis=1)
    df = spark.createDataFrame([(i, [float(v) for v in x[i]], np.flatnonzero(have[i]).tolist() + [None]) for i in range(300)] + [(300, None, [1])],
                               "id long, f array<double>, y array<int>").repartition(3)
    rows = G.training_rows(df, "id", "f", "y", batches=2)
    net, history = G.fit_net(rows, G.new_net((3, 4), multi=True), 40, 2, 0.5, "sgd")
    w, b = G.layers(net.weights, net.sizes)[0]
    start_w, start_b = G.layers(G.new_net((3, 4), multi=True).weights, (3, 4))[0]
    held = [r.asDict() for r in rows.collect()]
    for label in range(4):                               # plain one-label descent over the same batches
        v, c = start_w[:, label].copy(), start_b[label]
        for _ in range(40):
            for batch in range(2):
                own = [r for r in held if r["batch"] == batch]
                X, Y = np.array([r["x"] for r in own]), np.array([label in r["y"] for r in own], float)
                p = 1 / (1 + np.exp(-(X @ v + c)))
                v, c = v - 0.5 * X.T @ (p - Y) / len(own), c - 0.5 * (p - Y).sum() / len(own)
        assert np.allclose(w[:, label], v, atol=1e-9) and b[label] == pytest.approx(c, abs=1e-9)
    assert history[-1]["loss"] < history[0]["loss"]
    out = {r["id"]: r["predicted"] for r in G.predict_labels(df, net, "f").collect()}
    assert out[300] is None and all(3 not in v for k, v in out.items() if k < 300)
    assert np.mean([(0 in out[i]) == have[i, 0] for i in range(300)]) > 0.95


@pytest.mark.parametrize("method,sizes,rate", [("adam", (4, 8, 8, 2), 0.01), ("sgd", (4, 2), 0.5)])
def test_fit_equals_the_plain_version(spark, method, sizes, rate):
    rows = G.training_rows(table(spark), "id", "f", "y", batches=3, balanced=True)
    held = [r.asDict() for r in rows.collect()]
    assert len(held) == 400
    counts = np.bincount([r["y"] for r in held])
    assert {r["y"]: r["w"] for r in held} == pytest.approx({c: 400 / (2 * n) for c, n in enumerate(counts)})
    net, history = G.fit_net(rows, G.new_net(sizes), 3, 3, rate, method)
    want, losses = plain(held, G.new_net(sizes), 3, 3, rate, method)
    assert np.allclose(net.weights, want, atol=1e-10)
    assert [h["loss"] for h in history] == pytest.approx(losses)


def test_warm_start_equals_an_unbroken_fit(spark):
    rows = G.training_rows(table(spark), "id", "f", "y", batches=2)
    whole, both = G.fit_net(rows, G.new_net((4, 6, 2)), 4, 2, 0.01)
    part, first = G.fit_net(rows, G.new_net((4, 6, 2)), 1, 2, 0.01)
    part, rest = G.fit_net(rows, part, 3, 2, 0.01)
    assert np.allclose(whole.weights, part.weights, atol=1e-12) and [h["epoch"] for h in first + rest] == [1, 2, 3, 4]
    assert [h["loss"] for h in both] == pytest.approx([h["loss"] for h in first + rest])


def test_learns_stops_and_predicts(spark):
    df = table(spark, 900)
    rows = G.training_rows(df, "id", "f", "y", batches=4)
    net, history = G.fit_net(rows, G.new_net((4, 16, 2)), 25, 4, 0.02, test=G.scored_rows(df, "f", "y"))
    assert history[-1]["loss"] < 0.6 * history[0]["loss"] and history[-1]["test_accuracy"] > 0.88
    out = G.predict_net(df, net, "f")
    right = out.where("f is not null and y is not null").agg(F.avg((F.col("prediction") == F.col("y")).cast("int"))).first()[0]
    assert right == pytest.approx(history[-1]["test_accuracy"])
    assert out.where("f is null").first()["prediction"] is None
    _, short = G.fit_net(rows, G.new_net((4, 2)), 50, 4, 0.1, "sgd", tol=10.0, patience=2)
    assert len(short) == 3              # the first epoch sets the best, two more do not fall by ten


def test_no_rows(spark):
    rows = G.training_rows(table(spark).limit(0), "id", "f", "y", batches=2, balanced=True)
    net, history = G.fit_net(rows, G.new_net((4, 2)), 2, 2, 0.1)
    assert net.steps == 0 and [h["loss"] for h in history] == [None, None]
