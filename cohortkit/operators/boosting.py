"""Gradient boosting over many rounds: error curve, early stop, checkpoints and resume.

Trees grow level by level. For a level every task bins its rows' gradients by
(node, feature, bin) and the histograms, whose size is fixed by depth, features
and bins, are added up in two levels; the driver picks the splits. Gradients
are rounded to multiples of 2^-24, so their sums are exact and do not depend
on the order of tasks: a run gives the same trees on any layout.

Every ``interval`` rounds the rows are written with their margins so far, and
the model beside them, in a shared folder. Between two checkpoints only the
trees since the last one are evaluated, so a round costs the same at 30 and at
3,000 rounds. A run that finds finished checkpoints goes on from the last one
and ends with the same model as an unbroken run.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortkit.sources.io import _exists, _folder, stage_path

# Functions sent to tasks travel by value: executors need no installed copy of this module.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

UNIT = float(1 << 24)
FAN = 8


def leaf_of(bins: np.ndarray, tree: dict) -> np.ndarray:
    """The node that each row (its bin numbers) reaches; nodes lie in heap order, feature -1 ends a path."""
    feature, cut = np.asarray(tree["feature"]), np.asarray(tree["cut"])
    at = np.zeros(len(bins), dtype=np.int64)
    rows = np.arange(len(bins))
    for _ in range(tree["depth"]):
        f = feature[at]
        right = bins[rows, np.maximum(f, 0)] > cut[at]
        at = np.where(f >= 0, 2 * at + 1 + right, at)
    return at


def margins(bins: np.ndarray, start: np.ndarray, trees: list[dict]) -> np.ndarray:
    for tree in trees:
        start = start + np.asarray(tree["value"])[leaf_of(bins, tree)]
    return start


def gradients(margin: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and second derivative of the weighted log-loss, in whole units of 2^-24."""
    p = 1.0 / (1.0 + np.exp(-margin))
    return np.rint((p - y) * w * UNIT), np.rint(p * (1 - p) * w * UNIT)


def best_splits(hist: np.ndarray, lam: float, least: float) -> list[tuple[int, int] | None]:
    """Per node the (feature, bin) after which to cut, by the loss that it saves; None if no cut saves any.

    ``hist``: nodes × features × bins × 2 sums. Equal savings go to the first feature and bin.
    """
    g, h = (hist[..., i].astype(np.float64) / UNIT for i in (0, 1))
    left_g, left_h = np.cumsum(g, axis=2)[:, :, :-1], np.cumsum(h, axis=2)[:, :, :-1]
    all_g, all_h = g.sum(axis=2)[:, :, None], h.sum(axis=2)[:, :, None]
    part = lambda a, b: a * a / (b + lam)
    gain = part(left_g, left_h) + part(all_g - left_g, all_h - left_h) - part(all_g, all_h)
    gain = np.where((left_h >= least) & (all_h - left_h >= least), gain, 0.0)
    out: list[tuple[int, int] | None] = []
    for node in gain.reshape(len(gain), -1):
        at = int(node.argmax()) if node.size else 0
        out.append(divmod(at, gain.shape[2]) if node.size and node[at] > 1e-9 else None)
    return out


def _matrix(column: pa.Array, kind) -> np.ndarray:
    return np.asarray(column.flatten(), dtype=kind).reshape(len(column), -1)


def _pass(rows: DataFrame, trees: list[dict], tree: dict, level: int, n_features: int, n_bins: int) -> tuple[np.ndarray, np.ndarray]:
    """(histograms of the level's nodes, [n, wrong] of training and test rows) after ``trees``, inside ``tree`` so far."""
    sent = rows.sparkSession.sparkContext.broadcast((trees, tree))
    nodes = 1 << level
    shape = (nodes, n_features, n_bins, 2)
    names, kinds = ["hist", "seen"], "hist binary, seen array<bigint>"

    def record(hist: np.ndarray, seen: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([hist.astype(np.int64).tobytes()], pa.binary()), pa.array([seen.tolist()], pa.list_(pa.int64()))], names)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees, tree = sent.value
        hist, seen = np.zeros(shape, dtype=np.int64), np.zeros(4, dtype=np.int64)
        for b in batches:
            if not b.num_rows:
                continue
            bins, start = _matrix(b.column(0), np.int64), np.asarray(b.column(1))
            y, w, test = np.asarray(b.column(2)).astype(float), np.asarray(b.column(3)), np.asarray(b.column(4).to_numpy(zero_copy_only=False), dtype=bool)
            margin = margins(bins, start, trees)
            wrong = (margin > 0) != (y > 0)
            seen += [int((~test).sum()), int((wrong & ~test).sum()), int(test.sum()), int((wrong & test).sum())]
            at = leaf_of(bins, tree) - (nodes - 1)
            use = ~test & (at >= 0)
            for i, part in enumerate(gradients(margin, y, w)):
                for f in range(n_features):
                    cell = at[use] * n_bins + bins[use, f]
                    hist[:, f, :, i] += np.bincount(cell, weights=part[use], minlength=nodes * n_bins).astype(np.int64).reshape(nodes, n_bins)
        yield record(hist, seen)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hist, seen = np.zeros(shape, dtype=np.int64), np.zeros(4, dtype=np.int64)
        for b in batches:
            for r in b.to_pylist():
                hist += np.frombuffer(r["hist"], dtype=np.int64).reshape(shape)
                seen += r["seen"]
        yield record(hist, seen)

    hist, seen = np.zeros(shape, dtype=np.int64), np.zeros(4, dtype=np.int64)
    for r in rows.select("bins", "margin", "y", "w", "test").mapInArrow(count, kinds).repartition(FAN).mapInArrow(add, kinds).collect():
        hist += np.frombuffer(r["hist"], dtype=np.int64).reshape(shape)
        seen += r["seen"]
    sent.unpersist()
    return hist, seen


def grow(rows: DataFrame, trees: list[dict], depth: int, n_features: int, n_bins: int, rate: float, lam: float, least: float) -> tuple[dict, np.ndarray]:
    """(the next tree, errors of the model before it)."""
    size = (2 << depth) - 1
    tree = {"depth": 0, "feature": [-1] * size, "cut": [0] * size, "value": [0.0] * size}
    errors = None
    for level in range(depth + 1):
        hist, seen = _pass(rows, trees, tree, level, n_features, n_bins)
        errors = seen if errors is None else errors
        splits = best_splits(hist, lam, least) if level < depth else [None] * (1 << level)
        sums = hist[:, 0].sum(axis=1) / UNIT if n_features else np.zeros((1 << level, 2))
        for i, split in enumerate(splits):
            node = (1 << level) - 1 + i
            if split:
                tree["feature"][node], tree["cut"][node] = split
            else:
                tree["value"][node] = float(-rate * sums[i, 0] / (sums[i, 1] + lam)) if sums[i, 1] > 0 else 0.0
        if not any(splits):
            break
        tree["depth"] = level + 1
    return tree, errors


def bin_columns(features: str, cuts: list[list[float]]):
    """Bin numbers: 0 for a missing value, else 1 + the number of cuts below it."""
    def bin_of(i: int, own: list[float]):
        v = F.get(F.col(features), F.lit(i)).cast("double")
        points = F.array(*map(F.lit, own)) if own else F.array().cast("array<double>")
        return F.when(v.isNull() | F.isnan(v), F.lit(0)).otherwise(F.size(F.filter(points, lambda c: c < v)) + 1)

    return F.array(*[bin_of(i, own) for i, own in enumerate(cuts)]).cast("array<int>")


def quantile_cuts(df: DataFrame, features: str, n_features: int, bins: int) -> list[list[float]]:
    """Up to ``bins`` - 2 cut points per feature at its quantiles; the driver gets those numbers only."""
    probs = [k / (bins - 1) for k in range(1, bins - 1)]
    found = df.agg(*[F.percentile_approx(F.get(F.col(features), F.lit(i)).cast("double"), probs, 10000).alias(f"c{i}") for i in range(n_features)]).first()
    return [sorted({float(v) for v in own}) if own else [] for own in found]


def _last_checkpoint(spark: SparkSession, path: str, params: dict) -> dict | None:
    fs, folder = _folder(spark, path)
    if not fs.exists(folder):
        return None
    rounds = sorted((int(c.getPath().getName()[6:]) for c in fs.listStatus(folder) if c.getPath().getName().startswith("round-")), reverse=True)
    for r in rounds:
        if _exists(spark, f"{path}/round-{r}/model"):
            state = json.loads(spark.read.text(f"{path}/round-{r}/model", wholetext=True).first()[0])
            if state["params"] == params:
                return state | {"round": r}
    return None


def _checkpoint(rows: DataFrame, state: dict, path: str, fresh: list[dict]) -> DataFrame:
    """Write the rows with their margins after ``fresh`` trees, then the model (whose marker finishes the checkpoint), drop older ones."""
    spark, here = rows.sparkSession, f"{path}/round-{len(state['trees'])}"
    sent = spark.sparkContext.broadcast(fresh)

    @F.arrow_udf("double")
    def moved(bins: pa.Array, margin: pa.Array) -> pa.Array:
        return pa.array(margins(_matrix(bins, np.int64), np.asarray(margin), sent.value)) if len(bins) else margin

    rows.withColumn("margin", moved("bins", "margin")).write.mode("overwrite").parquet(f"{here}/rows")
    spark.createDataFrame([(json.dumps(state),)], "value string").coalesce(1).write.mode("overwrite").text(f"{here}/model")
    fs, folder = _folder(spark, path)
    for child in fs.listStatus(folder):
        if child.getPath().getName() != here.rsplit("/", 1)[1]:
            fs.delete(child.getPath(), True)
    return spark.read.schema(rows.schema).parquet(f"{here}/rows")


def fit_boosted(df: DataFrame, features: str, label: str, test: str, n_features: int, rounds: int = 3000, rate: float = 0.1, depth: int = 3,
                bins: int = 64, lam: float = 1.0, least: float = 1.0, positive_weight: float = 1.0, interval: int = 25,
                patience: int | None = None, path: str | None = None) -> tuple[dict, list[dict]]:
    """(model, one entry per round: round, train_error, test_error).

    ``features`` is an array of ``n_features`` numbers (null and NaN are
    missing and go left at every cut), ``label`` 0 or 1, ``test`` a boolean
    column: rows of the evaluation set, which no tree sees. Rows without
    features or label are left out. With ``patience`` the fit ends when the
    test error has not fallen for so many rounds. ``path`` names the shared
    folder of the checkpoints; a run that finds one made with the same
    parameters goes on from it. The model: cuts per feature, trees.
    """
    spark = df.sparkSession
    path = (path or stage_path(spark, "boosting")).rstrip("/")
    params = {"n_features": n_features, "rate": rate, "depth": depth, "bins": bins, "lam": lam, "least": least, "positive_weight": positive_weight, "interval": interval}
    state = _last_checkpoint(spark, path, params)
    if state:
        rows = spark.read.parquet(f"{path}/round-{state['round']}/rows")
    else:
        kept = df.where(F.col(features).isNotNull() & F.col(label).isNotNull())
        cuts = quantile_cuts(kept.where(~F.col(test)), features, n_features, bins)
        state = {"params": params, "cuts": cuts, "trees": [], "history": []}
        raw = kept.select(bin_columns(features, cuts).alias("bins"), F.lit(0.0).alias("margin"), F.col(label).cast("int").alias("y"),
                          F.when(F.col(label) > 0, F.lit(float(positive_weight))).otherwise(F.lit(1.0)).alias("w"), F.col(test).alias("test"))
        rows = _checkpoint(raw, state, path, [])
    state = {k: state[k] for k in ("params", "cuts", "trees", "history")}
    held = len(state["trees"])

    def note(errors: np.ndarray) -> None:
        n, wrong, m, missed = (int(x) for x in errors)
        state["history"].append({"round": len(state["trees"]), "train_error": wrong / n if n else None, "test_error": missed / m if m else None})

    def stale() -> bool:
        curve = [h["test_error"] for h in state["history"] if h["test_error"] is not None]
        return patience is not None and len(curve) > patience and min(curve[-patience:]) >= min(curve[:-patience])

    while len(state["trees"]) < rounds and not stale():
        tree, errors = grow(rows, state["trees"][held:], depth, n_features, bins, rate, lam, least)
        if state["trees"] and len(state["history"]) < len(state["trees"]):
            note(errors)
            if stale():
                break
        state["trees"].append(tree)
        if len(state["trees"]) % interval == 0:
            rows = _checkpoint(rows, state, path, state["trees"][held:])
            held = len(state["trees"])
    if len(state["history"]) < len(state["trees"]):
        blank = {"depth": 0, "feature": [-1], "cut": [0], "value": [0.0]}
        note(_pass(rows, state["trees"][held:], blank, 0, 0, 1)[1])
    return {"cuts": state["cuts"], "trees": state["trees"]}, state["history"]


def predict_boosted(df: DataFrame, model: dict, features: str, name: str = "prediction") -> DataFrame:
    """``df`` with the predicted class and ``p_last``, the probability of 1; null features give null."""
    sent = df.sparkSession.sparkContext.broadcast(model["trees"])

    @F.arrow_udf("double")
    def margin(bins: pa.Array) -> pa.Array:
        return pa.array(margins(_matrix(bins, np.int64), np.zeros(len(bins)), sent.value)) if len(bins) else pa.array([], pa.float64())

    out = df.withColumn("__m", margin(bin_columns(features, model["cuts"])))
    m = F.when(F.col(features).isNotNull(), F.col("__m"))
    return out.withColumn(name, (m > 0).cast("int")).withColumn("p_last", F.round(1 / (1 + F.exp(-m)), 6)).drop("__m")
