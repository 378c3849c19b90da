"""Binary logistic regression whose coefficients never leave the executors.

A model over a whole vocabulary has a coefficient per term, and a solver on
the driver would fetch a gradient of that length in each evaluation. The
coefficients, gradients and steps of L-BFGS from zero are all combinations of
the standardised training rows, so here each of them is a number per training
row, with its scores (the standardised table times its transpose times these
numbers). The table is cut by columns: a task makes the coefficients of its
own columns and adds their share of every score; the shares are summed in
chunks of rows. One such pass per iteration gives all that the line search
needs. The driver gets one number per training row and iteration, whatever
the number of terms.

The problem and the path to its solution are those of
``LogisticRegression(maxIter, regParam, weightCol)``: columns divided by their
weighted deviation, an L2 penalty on their coefficients, an intercept that
starts at the log odds, L-BFGS of ten pairs with strong Wolfe steps.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortkit.operators.features import class_weights
from cohortkit.sources.io import materialize

# Functions sent to tasks travel by value: executors need no installed copy of this module.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Entries of a block of columns, of a written group of whole columns, and rows of a chunk of scores.
BLOCK_ENTRIES, GROUP_ENTRIES, CHUNK_ROWS = 1 << 22, 1 << 18, 1 << 16
HISTORY, TOLERANCE, MEMORY = 10, 1e-6, 20

_GROUPS = "mu array<double>, row array<int>, col array<int>, val array<double>, trow array<int>, tcol array<int>, tval array<double>"
_PARTS = "chunk int, part array<double>"


class _Failed(Exception):
    """A line search without a step."""


def _flat(column) -> np.ndarray:
    col = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(col.flatten())


def _numbered(df: DataFrame) -> tuple[DataFrame, int]:
    """(``df`` written once, with its row number ``pos`` from 0; the number of rows)."""
    part = F.shiftright("__mid", 33)
    rows = materialize(df.withColumn("__mid", F.monotonically_increasing_id()), name="logistic-rows").withColumn("__part", part)
    sizes = sorted(tuple(r) for r in rows.groupBy("__part").agg(F.count(F.lit(1))).collect())
    ends = np.cumsum([0, *(n for _, n in sizes)]).tolist()
    starts = df.sparkSession.createDataFrame([(p, at) for (p, _), at in zip(sizes, ends, strict=False)], "__part bigint, __first bigint")
    local = F.col("__mid").bitwiseAND(F.lit((1 << 33) - 1))
    numbered = rows.join(F.broadcast(starts), "__part").withColumn("pos", (F.col("__first") + local).cast("int"))
    return numbered.drop("__mid", "__part", "__first"), ends[-1]


def _cut(n_blocks: int):
    """Batches of (pos, features) as (block, row, col, val): one row per block and batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column("indices")
            sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
            row, col, val = np.repeat(b.column("pos").to_numpy(), sizes), _flat(lists), _flat(b.column("values"))
            order = np.argsort(col % n_blocks, kind="stable")
            row, col, val = row[order], col[order], val[order]
            blocks, at = np.unique(col % n_blocks, return_index=True)
            for k, (start, end) in enumerate(zip(at, [*at[1:], len(col)], strict=False)):
                yield pa.RecordBatch.from_pydict({"block": pa.array(blocks[k:k + 1], pa.int32()), **{
                    c: pa.array([x[start:end]], pa.list_(t)) for c, x, t in (("row", row, pa.int32()), ("col", col, pa.int32()), ("val", val, pa.float64()))}})
    return run


def _standardise(weights, n_train: int):
    """A block as groups of whole columns, scaled by their deviation over the training rows; ``mu`` are the scaled means."""
    def run(table: pa.Table) -> pa.Table:
        row, col, val = (_flat(table[c]) for c in ("row", "col", "val"))
        w, (names, col) = weights.value, np.unique(col, return_inverse=True)
        total, k, fits = w.sum(), len(names), row < n_train
        r, c, x = row[fits], col[fits], val[fits]
        mean = np.bincount(c, w[r] * x, k) / total
        spread = np.bincount(c, w[r] * (x - mean[c]) ** 2, k) + (total - np.bincount(c, w[r], k)).clip(0) * mean * mean
        dev = np.sqrt(spread / (total - (w * w).sum() / total))
        scale = np.divide(1.0, dev, out=np.zeros(k), where=dev > 1e-12 * np.abs(mean))
        order = np.argsort(col, kind="stable")
        row, col, val, fits = row[order], col[order], (val * scale[col])[order], fits[order]
        starts = np.searchsorted(col, np.arange(k))
        firsts = np.flatnonzero(np.diff(starts // GROUP_ENTRIES, prepend=-1))
        out: dict[str, list] = {n.split()[0]: [] for n in _GROUPS.split(", ")}
        for lo, hi in zip(firsts, [*firsts[1:], k], strict=True):
            here = slice(starts[lo], starts[hi] if hi < k else len(col))
            fit, held = fits[here], ~fits[here]
            out["mu"].append((mean * scale)[lo:hi])
            for name, x in (("row", row), ("col", col - lo), ("val", val)):
                out[name].append(x[here][fit])
                out[f"t{name}"].append(x[here][held] - (n_train if name == "row" else 0))
        kinds = {"array<int>": pa.int32(), "array<double>": pa.float64()}
        return pa.table({n: pa.array(out[n], pa.list_(kinds[t])) for n, t in (f.split() for f in _GROUPS.split(", "))})
    return run


def _shares(numbers, n_rows: int, held: bool):
    """Chunks of a task's share of the scores of the training (or the ``held``) rows, its columns' coefficients being made of ``numbers``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given, out, shift = numbers.value, np.zeros(n_rows), 0.0
        total = given.sum()
        for b in batches:
            for i in range(len(b)):
                get = lambda n: b.column(n)[i].values.to_numpy(zero_copy_only=False)                # noqa: E731, B023
                mu, row, col = get("mu"), get("row"), get("col")
                coef = np.bincount(col, get("val") * given[row], len(mu)) - mu * total
                row, col, val = (get(n) for n in (("trow", "tcol", "tval") if held else ("row", "col", "val")))
                out += np.bincount(row, val * coef[col], n_rows)
                shift += float(mu @ coef)
        for k in range(0, n_rows, CHUNK_ROWS):
            yield pa.RecordBatch.from_pydict({"chunk": pa.array([k // CHUNK_ROWS], pa.int32()), "part": pa.array([out[k:k + CHUNK_ROWS] - shift], pa.list_(pa.float64()))})
    return run


def _summed(table: pa.Table) -> pa.Table:
    parts = _flat(table["part"]).reshape(len(table), -1)
    return pa.table({"chunk": table["chunk"][:1], "part": pa.array([parts.sum(axis=0)], pa.list_(pa.float64()))})


class _Table:
    """The standardised rows in groups of columns."""

    def __init__(self, train: DataFrame, test: DataFrame, weights: np.ndarray, n_test: int):
        self.spark, self.n, self.n_test = train.sparkSession, len(weights), n_test
        parts = [df.select("pos", F.unwrap_udt("features").alias("f")).select("pos", "f.indices", "f.values") for df in (train, test)]
        rows = parts[0].unionByName(parts[1].withColumn("pos", F.col("pos") + F.lit(self.n)))
        entries = rows.agg(F.sum(F.size("indices"))).first()[0] or 0
        blocks = max(self.spark.sparkContext.defaultParallelism, -(-entries // BLOCK_ENTRIES))
        cut = rows.mapInArrow(_cut(blocks), "block int, row array<int>, col array<int>, val array<double>")
        standardise = _standardise(self.spark.sparkContext.broadcast(weights), self.n)
        self.groups = materialize(cut.groupBy("block").applyInArrow(standardise, _GROUPS), name="logistic-columns")

    def scores(self, numbers: np.ndarray, held: bool = False) -> DataFrame:
        """(chunk, part): scores, without the intercept, by the coefficients that ``numbers``, one per training row, make."""
        columns = ["mu", "row", "col", "val", *(["trow", "tcol", "tval"] if held else [])]
        shares = _shares(self.spark.sparkContext.broadcast(numbers), self.n_test if held else self.n, held)
        return self.groups.select(*columns).mapInArrow(shares, _PARTS).groupBy("chunk").applyInArrow(_summed, _PARTS)

    def train_scores(self, numbers: np.ndarray) -> np.ndarray:
        found = self.scores(numbers).toArrow().sort_by("chunk")
        return _flat(found["part"]) if len(found) else np.zeros(self.n)


class _Point:
    """Coefficients, a gradient or a step: a number per training row, the scores these give, and the intercept's entry."""

    def __init__(self, a: np.ndarray, m: np.ndarray, b: float):
        self.a, self.m, self.b = a, m, b

    def plus(self, x: float, other: _Point) -> _Point:
        return _Point(self.a + x * other.a, self.m + x * other.m, self.b + x * other.b)

    def times(self, x: float) -> _Point:
        return _Point(x * self.a, x * self.m, x * self.b)

    def coefs(self, other: _Point) -> float:
        return float(self.a @ other.m)

    def dot(self, other: _Point) -> float:
        return self.coefs(other) + self.b * other.b


def _direction(grad: _Point, pairs: list[tuple[_Point, _Point]]) -> _Point:
    """Minus the gradient times the inverse Hessian of the (step, change of gradient) ``pairs``, the latest first."""
    d, alphas = grad, []
    for s, y in pairs:
        alphas.append(s.dot(d) / s.dot(y))
        d = d.plus(-alphas[-1], y)
    if pairs:
        s, y = pairs[0]
        d = d.times(s.dot(y) / y.dot(y))
    for (s, y), alpha in zip(reversed(pairs), reversed(alphas), strict=True):
        d = d.plus(alpha - y.dot(d) / s.dot(y), s)
    return d.times(-1.0)


def _between(low: tuple, high: tuple) -> float:
    """The minimum of the cubic through two (t, value, slope), a tenth of the bracket off its ends at least."""
    (lt, lf, ld), (rt, rf, rd) = low, high
    d1 = ld + rd - 3 * (lf - rf) / (lt - rt)
    d2 = np.sqrt(d1 * d1 - ld * rd)
    t = rt - (rt - lt) * (rd + d2 - d1) / (rd - ld + 2 * d2)
    return lt + 0.1 * (rt - lt) if t < lt + 0.1 * (rt - lt) else lt + 0.9 * (rt - lt) if t > lt + 0.9 * (rt - lt) else t


def _wolfe_step(phi, t: float, tries: int = 10, c1: float = 1e-4, c2: float = 0.9) -> float:
    """A step that meets the strong Wolfe conditions; ``phi`` gives (t, value, slope)."""
    low = start = phi(0.0)
    if start[2] > 0:
        raise _Failed
    too_high = lambda c: c[1] > start[1] + c1 * c[0] * start[2]                                     # noqa: E731
    flat = lambda c: abs(c[2]) <= c2 * abs(start[2])                                                # noqa: E731

    def zoom(low: tuple, high: tuple) -> float:
        for _ in range(tries):
            c = phi(_between(high, low) if low[0] > high[0] else _between(low, high))
            if too_high(c) or c[1] >= low[1]:
                high = c
                continue
            if flat(c):
                return c[0]
            if c[2] * (high[0] - low[0]) >= 0:
                high = low
            low = c
        raise _Failed

    for i in range(tries):
        c = phi(t)
        if not np.isfinite(c[1]):
            t /= 2
            continue
        if too_high(c) or (c[1] >= low[1] and i > 0):
            return zoom(low, c)
        if flat(c):
            return t
        if c[2] >= 0:
            return zoom(c, low)
        low, t = c, t * 1.5
    raise _Failed


def _minimise(table: _Table, y: np.ndarray, w: np.ndarray, reg: float, max_iter: int) -> tuple[_Point, list[float]]:
    """(the coefficients, the objective at the start and after each iteration)."""
    total = w.sum()

    def value(m: np.ndarray) -> float:
        return float((w * (np.logaddexp(0.0, m) - y * m)).sum() / total)

    def residuals(m: np.ndarray) -> np.ndarray:
        return w * (1.0 / (1.0 + np.exp(-np.clip(m, -700, 700))) - y) / total

    def gradient(x: _Point) -> _Point:
        r = residuals(x.m + x.b)
        return _Point(r + reg * x.a, table.train_scores(r) + reg * x.m, float(r.sum()))

    x = _Point(np.zeros(len(y)), np.zeros(len(y)), float(np.log((w * y).sum() / (w * (1 - y)).sum())))
    f, g, pairs, failed = value(x.m + x.b), gradient(x), [], False
    history = [f]
    while len(history) <= max_iter and np.sqrt(g.dot(g)) > max(TOLERANCE * f, 1e-8):
        d = _direction(g, pairs)
        base, own, step = x.m + x.b, d.m + d.b, (x.coefs(x), x.coefs(d), d.coefs(d))

        def phi(t: float) -> tuple[float, float, float]:
            m = base + t * own                                                                      # noqa: B023
            xx, xd, dd = step                                                                       # noqa: B023
            return t, value(m) + reg / 2 * (xx + 2 * t * xd + t * t * dd), float(residuals(m) @ own) + reg * (xd + t * dd)      # noqa: B023

        try:
            t = _wolfe_step(phi, 1.0 / np.sqrt(d.dot(d)) if len(history) == 1 else 1.0)
            if t * np.sqrt(g.dot(g)) < 1e-10:
                raise _Failed
        except _Failed:
            if failed:
                break
            pairs, failed = [], True
            continue
        failed = False
        moved, f = x.plus(t, d), phi(t)[1]
        g_new = gradient(moved)
        pairs = [(moved.plus(-1.0, x), g_new.plus(-1.0, g)), *pairs][:HISTORY]
        x, g = moved, g_new
        history.append(f)
        if len(history) > MEMORY and abs(f - max(history[-MEMORY:])) <= TOLERANCE * history[0]:
            break
    return x, history


def logistic_scores(train: DataFrame, test: DataFrame, label: str, max_iter: int = 100, reg: float = 0.0,
                    balanced: bool = False) -> tuple[DataFrame, list[float]]:
    """(``test`` with ``prediction`` (int) and ``p_last`` (probability of 1), objective history) of a model fitted on ``train``.

    Both have a ``features`` vector column; ``label`` must be 0 or 1, both
    occurring in ``train``. ``balanced`` weighs rows by their class.
    """
    fitted, _ = _numbered(train.select("features", F.col(label).cast("double").alias("__y")))
    asked, n_test = _numbered(test)
    labels = fitted.select("pos", F.col("__y").cast("tinyint").alias("y")).toArrow().sort_by("pos")
    y = labels["y"].to_numpy().astype(np.float64)
    w = np.ones(len(y))
    if balanced:
        by_class = {int(r["__y"]): r["weight"] for r in class_weights(fitted, "__y").collect()}
        w = np.where(y == 1, by_class[1], by_class[0])
    table = _Table(fitted, asked, w, n_test)
    x, history = _minimise(table, y, w, reg, max_iter)
    scores = table.scores(x.a, held=True).select("chunk", F.posexplode("part").alias("__at", "__m"))
    scores = scores.select((F.col("chunk") * CHUNK_ROWS + F.col("__at")).alias("pos"), "__m")
    p = 1.0 / (1.0 + F.exp(-(F.coalesce("__m", F.lit(0.0)) + x.b)))
    out = asked.join(scores, "pos", "left").withColumn("p_last", p).withColumn("prediction", (F.col("p_last") > 0.5).cast("int"))
    return out.select(*test.columns, "prediction", "p_last"), history
