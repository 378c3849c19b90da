"""Mini-batch gradient learners: log-loss regression, perceptrons and multi-label scorers, with a loss per epoch.

Rows are dealt to mini-batches by a hash of their key and written once,
partitioned by batch, so a step reads one batch's files. In a step every task
turns its rows into one partial gradient (numpy over Arrow batches); partial
gradients are added up in two levels, so the driver gets at most ``FAN`` of
them whatever the number of tasks. The driver keeps the weights and the
optimiser's two moments, nothing of the data. A multi-label net fits all its
labels in the same pass: one weight matrix, one gradient.

A fit can go on from where another one ended (``start``): weights, moments
and step count are carried over, so epochs fitted in two parts equal epochs
fitted in one.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortkit.sources.io import materialize, stage_path

# Functions sent to tasks travel by value: executors need no installed copy of this module.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Partial gradients that reach the driver in a step.
FAN = 8


@dataclass(frozen=True)
class Net:
    """Layer sizes (inputs, hidden layers, classes or labels), all weights in a row, and the optimiser's state.

    ``multi``: the last layer has independent labels (a sigmoid each), not classes (a softmax).
    """

    sizes: tuple[int, ...]
    weights: np.ndarray
    first: np.ndarray = field(default=None)
    second: np.ndarray = field(default=None)
    steps: int = 0
    epochs: int = 0
    multi: bool = False


def new_net(sizes: Sequence[int], seed: int = 42, multi: bool = False) -> Net:
    """A net with uniform weights within sqrt(6 / (inputs + outputs)) per layer and zero offsets; ReLU between layers."""
    rng = np.random.default_rng(seed)
    parts = []
    for a, b in zip(sizes, sizes[1:], strict=False):
        bound = np.sqrt(6.0 / (a + b))
        parts += [rng.uniform(-bound, bound, a * b), np.zeros(b)]
    w = np.concatenate(parts)
    return Net(tuple(sizes), w, np.zeros_like(w), np.zeros_like(w), multi=multi)


def layers(weights: np.ndarray, sizes: Sequence[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Views of the weight matrix and the offsets of each layer."""
    out, at = [], 0
    for a, b in zip(sizes, sizes[1:], strict=False):
        out.append((weights[at:at + a * b].reshape(a, b), weights[at + a * b:at + a * b + b]))
        at += a * b + b
    return out


def probabilities(weights: np.ndarray, sizes: Sequence[int], x: np.ndarray, multi: bool = False) -> list[np.ndarray]:
    """The values of every layer; the last ones are probabilities of classes, or of each label."""
    values = [x]
    parts = layers(weights, sizes)
    for k, (w, b) in enumerate(parts):
        z = values[-1] @ w + b
        if k < len(parts) - 1:
            values.append(np.maximum(z, 0.0))
        elif multi:
            values.append(1.0 / (1.0 + np.exp(-np.clip(z, -500, 500))))
        else:
            e = np.exp(z - z.max(axis=1, keepdims=True))
            values.append(e / e.sum(axis=1, keepdims=True))
    return values


def loss_and_gradient(weights: np.ndarray, sizes: Sequence[int], x: np.ndarray, y: np.ndarray, row_weight: np.ndarray,
                      multi: bool = False) -> tuple[float, int, np.ndarray]:
    """(sum of weighted log-losses, rows predicted right, gradient of that sum).

    ``y`` holds class numbers, or a 0/1 row per label, whose losses are added
    up; then a row is right if every label is at 0.5.
    """
    values = probabilities(weights, sizes, x, multi)
    p = values[-1]
    if multi:
        each = np.where(y > 0, p, 1.0 - p)
        loss = float(-(row_weight[:, None] * np.log(np.maximum(each, 1e-300))).sum())
        right = int(((p > 0.5) == (y > 0)).all(axis=1).sum())
        slope = (p - y) * row_weight[:, None]
    else:
        at = np.arange(len(y))
        loss = float(-(row_weight * np.log(np.maximum(p[at, y], 1e-300))).sum())
        right = int((p.argmax(axis=1) == y).sum())
        slope = p.copy()
        slope[at, y] -= 1.0
        slope *= row_weight[:, None]
    grads: list[np.ndarray] = []
    parts = layers(weights, sizes)
    for k in reversed(range(len(parts))):
        grads = [(values[k].T @ slope).ravel(), slope.sum(axis=0), *grads]
        if k:
            slope = (slope @ parts[k][0].T) * (values[k] > 0)
    return loss, right, np.concatenate(grads)


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten(), dtype=np.float64).reshape(len(column), -1)


def _targets(column: pa.Array, sizes: Sequence[int], multi: bool) -> np.ndarray:
    """Class numbers, or lists of label numbers as 0/1 rows."""
    if not multi:
        return np.asarray(column)
    out = np.zeros((len(column), sizes[-1]))
    out[np.repeat(np.arange(len(column)), np.diff(np.asarray(column.offsets))), np.asarray(column.flatten())] = 1.0
    return out


def _summed(rows: DataFrame, net: Net, gradient: bool) -> tuple[float, float, int, int, np.ndarray]:
    """(loss, weight, rows, right, gradient) over ``rows`` (x, y, w), added up in two levels."""
    sent = rows.sparkSession.sparkContext.broadcast(net.weights)
    sizes, multi = net.sizes, net.multi
    kinds = "loss double, weight double, n bigint, right bigint, grad binary"
    names = ["loss", "weight", "n", "right", "grad"]

    def one(total: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([v]) for v in (*total[:4], total[4].tobytes())], names)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            if b.num_rows:
                x, y, w = _matrix(b.column(0)), _targets(b.column(1), sizes, multi), np.asarray(b.column(2))
                loss, right, grad = loss_and_gradient(sent.value, sizes, x, y, w, multi)
                part = [loss, float(w.sum()), len(y), right, grad if gradient else np.zeros(0)]
                total = part if total is None else [a + c for a, c in zip(total, part, strict=True)]
        if total is not None:
            yield one(total)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            for r in b.to_pylist():
                part = [r["loss"], r["weight"], r["n"], r["right"], np.frombuffer(r["grad"])]
                total = part if total is None else [a + c for a, c in zip(total, part, strict=True)]
        if total is not None:
            yield one(total)

    parts = rows.select("x", "y", "w").mapInArrow(partial, kinds).repartition(FAN).mapInArrow(add, kinds).collect()
    sent.unpersist()
    total = [0.0, 0.0, 0, 0, np.zeros(len(net.weights) if gradient else 0)]
    for r in sorted(parts, key=lambda r: (r["n"], r["loss"])):
        part = [r["loss"], r["weight"], r["n"], r["right"], np.frombuffer(r["grad"])]
        total = [a + c for a, c in zip(total, part, strict=True)]
    return tuple(total)


def balanced_weights(df: DataFrame, label: str) -> dict[int, float]:
    """Rows / (classes × rows of the class); the driver gets one row per class."""
    counts = {int(r[0]): r[1] for r in df.where(F.col(label).isNotNull()).groupBy(label).count().collect()}
    return {c: sum(counts.values()) / (len(counts) * n) for c, n in counts.items()}


def _label(df: DataFrame, label: str):
    lists = df.schema[label].dataType.typeName() == "array"
    return (F.array_distinct(F.array_compact(label)).cast("array<int>") if lists else F.col(label).cast("bigint")).alias("y")


def training_rows(df: DataFrame, key: str, features: str, label: str, batches: int, balanced: bool = False) -> DataFrame:
    """(x, y, w, batch) of ``df``, written once by batch; rows without features or label are left out.

    ``label`` is a class number, or a list of label numbers (not to be balanced).
    """
    df = df.where(F.col(features).isNotNull() & F.col(label).isNotNull())
    weight = F.lit(1.0)
    if balanced:
        pairs = [F.lit(v) for c, w in sorted(balanced_weights(df, label).items()) for v in (c, w)]
        weight = F.create_map(*pairs)[F.col(label).cast("int")] if pairs else weight
    rows = df.select(
        F.col(features).cast("array<double>").alias("x"), _label(df, label), weight.alias("w"),
        F.pmod(F.xxhash64(key), F.lit(batches)).cast("int").alias("batch"))
    path = stage_path(df.sparkSession, "training-rows")
    rows.write.partitionBy("batch").parquet(path)
    return df.sparkSession.read.schema(rows.schema).parquet(path)


def fit_net(rows: DataFrame, net: Net, epochs: int, batches: int, rate: float, method: str = "adam", tol: float | None = None,
            patience: int = 5, test: DataFrame | None = None) -> tuple[Net, list[dict]]:
    """(the fitted net, one entry per epoch: epoch, loss, train_accuracy, test_accuracy).

    ``rows`` come from :func:`training_rows`. An epoch takes the mini-batches
    in order; its loss and training accuracy are those met on the way, as each
    batch was before its step. ``method`` is ``"adam"`` or ``"sgd"`` (constant
    ``rate``). With ``tol`` the fit ends when the loss has not fallen by
    ``tol`` below the best for ``patience`` epochs. ``net`` may come from an
    earlier fit and goes on from there. Empty batches make no step.
    """
    history, best, idle = [], np.inf, 0
    for _ in range(epochs):
        seen = np.zeros(4)
        for b in range(batches):
            loss, weight, n, right, grad = _summed(rows.where(F.col("batch") == b), net, gradient=True)
            if not n:
                continue
            seen += (loss, weight, n, right)
            g = grad / weight
            steps = net.steps + 1
            if method == "adam":
                first, second = 0.9 * net.first + 0.1 * g, 0.999 * net.second + 0.001 * g * g
                move = (first / (1 - 0.9 ** steps)) / (np.sqrt(second / (1 - 0.999 ** steps)) + 1e-8)
            else:
                first, second, move = net.first, net.second, g
            net = replace(net, weights=net.weights - rate * move, first=first, second=second, steps=steps)
        net = replace(net, epochs=net.epochs + 1)
        loss, weight, n, right = seen
        entry = {"epoch": net.epochs, "loss": loss / weight if n else None, "train_accuracy": right / n if n else None, "test_accuracy": None}
        if test is not None:
            _, _, m, hit, _ = _summed(test, net, gradient=False)
            entry["test_accuracy"] = hit / m if m else None
        history.append(entry)
        if tol is not None and n:
            idle = idle + 1 if entry["loss"] > best - tol else 0
            best = min(best, entry["loss"])
            if idle >= patience:
                break
    return net, history


def predict_net(df: DataFrame, net: Net, features: str, name: str = "prediction") -> DataFrame:
    """``df`` with the likeliest class and ``p_last``, the probability of the last class; null features give null."""
    sent = df.sparkSession.sparkContext.broadcast(net.weights)
    sizes = net.sizes

    @F.arrow_udf("struct<c: int, p: double>")
    def classes(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in parts:
            here = np.asarray(part.is_valid())
            c, p = np.zeros(len(part), np.int32), np.zeros(len(part))
            if here.any():
                found = probabilities(sent.value, sizes, _matrix(part.drop_null()))[-1]
                c[here], p[here] = found.argmax(axis=1), found[:, -1]
            yield pa.StructArray.from_arrays([pa.array(c, mask=~here), pa.array(p, mask=~here)], ["c", "p"])

    out = df.withColumn("__c", classes(F.col(features).cast("array<double>")))
    return out.withColumn(name, F.col("__c.c")).withColumn("p_last", F.round("__c.p", 6)).drop("__c")


def predict_labels(df: DataFrame, net: Net, features: str, name: str = "predicted", threshold: float = 0.5) -> DataFrame:
    """``df`` with the numbers of the labels above ``threshold`` of a multi-label net, ascending; null features give null."""
    sent = df.sparkSession.sparkContext.broadcast(net.weights)
    sizes = net.sizes

    @F.arrow_udf("array<int>")
    def labels(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in parts:
            here = np.flatnonzero(np.asarray(part.is_valid()))
            out: list = [None] * len(part)
            if len(here):
                over = probabilities(sent.value, sizes, _matrix(part.drop_null()), multi=True)[-1] > threshold
                for i, row in zip(here.tolist(), over, strict=True):
                    out[i] = np.flatnonzero(row).tolist()
            yield pa.array(out, pa.list_(pa.int32()))

    return df.withColumn(name, labels(F.col(features).cast("array<double>")))


def scored_rows(df: DataFrame, features: str, label: str) -> DataFrame:
    """(x, y, w) of rows to measure a net on, each of weight 1; written once."""
    return materialize(df.where(F.col(features).isNotNull() & F.col(label).isNotNull()).select(
        F.col(features).cast("array<double>").alias("x"), _label(df, label), F.lit(1.0).alias("w")), name="scored-rows")
