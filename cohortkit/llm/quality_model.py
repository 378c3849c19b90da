"""Quality classifier: attention-based multiple-instance learning.

A document is a bag of passages of ``passage_words`` words. Every passage is
encoded (a layer over its character-class and word statistics), gated
attention weighs the passages, and the weighted sum is scored. Only document
labels are used: the attention learns which passages matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortkit.llm.common import text_chunks
from cohortkit.llm.labelled import fold_of, labelled_sample
from cohortkit.llm.words import find_words, mix, shingle_hashes

# Byte classes of the passage histogram: one for each ASCII mark, one for each kind of the rest.
_CLASS = np.zeros(256, dtype=np.int64)
_CLASS[0x80:0xC0] = 1
_CLASS[0xC0:] = 2
_CLASS[ord("a"):ord("z") + 1] = 3
_CLASS[ord("A"):ord("Z") + 1] = 4
_CLASS[ord("0"):ord("9") + 1] = 5
_CLASS[0x20] = 6
_CLASS[0x0A] = 7
for _i, _c in enumerate("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"):
    _CLASS[ord(_c)] = 8 + _i
N_CLASSES = 8 + 32
N_FEATURES = N_CLASSES + 6


def encode_passages(texts: list[str], passage_words: int) -> tuple[np.ndarray, np.ndarray]:
    """(text of each passage, features of each passage); a text without words is one passage of zeros."""
    w = find_words(texts)
    n = len(texts)
    counts = np.diff(w.first)
    per_text = np.maximum(1, -(-counts // passage_words))
    base = np.concatenate(([0], np.cumsum(per_text)))
    bag = np.repeat(np.arange(n), per_text)
    x = np.zeros((base[-1], N_FEATURES))
    if not len(w.hash):
        return bag, x
    place = np.arange(len(w.hash)) - w.first[w.doc]
    passage = base[w.doc] + place // passage_words
    size = np.bincount(passage, minlength=base[-1]).astype(float)
    one = np.maximum(size, 1)
    # the bytes from a passage's first word up to the next passage's first word belong to it, up to its own text's end:
    # what lies between two texts of a batch is nobody's
    heads = np.flatnonzero(np.diff(np.concatenate(([-1], passage))))
    begin = w.start[heads]
    end = np.minimum(np.concatenate((begin[1:], [len(w.buf)])), w.text_end[bag[passage[heads]]])
    owner = np.repeat(passage[heads], end - begin)
    seen = w.buf[np.repeat(begin - np.concatenate(([0], np.cumsum(end - begin)[:-1])), end - begin) + np.arange(len(owner))]
    hist = np.bincount(owner * N_CLASSES + _CLASS[seen], minlength=base[-1] * N_CLASSES).reshape(-1, N_CLASSES)
    x[:, :N_CLASSES] = np.sqrt(hist / one[:, None])
    length = (w.end - w.start).astype(float)
    mean = np.bincount(passage, weights=length, minlength=base[-1]) / one
    x[:, N_CLASSES] = np.log1p(mean)
    again = np.concatenate(([False], (w.hash[1:] == w.hash[:-1]) & (passage[1:] == passage[:-1])))
    x[:, N_CLASSES + 1] = np.bincount(passage[again], minlength=base[-1]) / one
    kinds = np.unique(mix(w.hash + mix(passage.astype(np.uint64))), return_index=True)[1]
    x[:, N_CLASSES + 2] = np.bincount(passage[kinds], minlength=base[-1]) / one
    x[:, N_CLASSES + 3] = np.log1p(size)
    doc, h = shingle_hashes(w, 3)
    if len(h):
        at = np.flatnonzero(w.doc[:-2] == w.doc[2:])
        _, inverse, times = np.unique(mix(h + mix(doc.astype(np.uint64))), return_inverse=True, return_counts=True)
        x[:, N_CLASSES + 4] = np.bincount(passage[at[times[inverse] > 1]], minlength=base[-1]) / one
    x[:, N_CLASSES + 5] = np.bincount(passage[length > 20], minlength=base[-1]) / one
    return bag, x


class AttentionModel:
    """Gated-attention pooling over encoded passages, trained by Adam on document labels."""

    def __init__(self, hidden: int = 24, gate: int = 12, seed: int = 7) -> None:
        rng = np.random.default_rng(seed)
        init = lambda *s: rng.normal(0, 1 / np.sqrt(s[0]), s)
        self.mean, self.scale = np.zeros(N_FEATURES), np.ones(N_FEATURES)
        self.p = {"W": init(N_FEATURES, hidden), "b": np.zeros(hidden), "V": init(hidden, gate), "U": init(hidden, gate),
                  "a": init(gate), "c": init(hidden), "d": np.zeros(1)}

    def forward(self, bag: np.ndarray, x: np.ndarray, n: int) -> tuple:
        p = self.p
        x = np.clip((x - self.mean) / self.scale, -8, 8)
        h = np.tanh(x @ p["W"] + p["b"])
        t, g = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-(h @ p["U"])))
        e = (t * g) @ p["a"]
        top = np.full(n, -np.inf)
        np.maximum.at(top, bag, e)
        w = np.exp(e - top[bag])
        w /= np.bincount(bag, weights=w, minlength=n)[bag]
        z = np.zeros((n, h.shape[1]))
        np.add.at(z, bag, w[:, None] * h)
        s = z @ p["c"] + p["d"][0]
        return x, h, t, g, w, z, s

    def score(self, bag: np.ndarray, x: np.ndarray, n: int) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.forward(bag, x, n)[-1], -30, 30)))

    def gradient(self, bag: np.ndarray, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Slope of the mean log-loss of documents (passages ``x`` of document ``bag``, labels ``y``) in each parameter."""
        p, n = self.p, len(y)
        x, h, t, g, w, z, s = self.forward(bag, x, n)
        ds = (1 / (1 + np.exp(-np.clip(s, -30, 30))) - y) / n
        dz = ds[:, None] * p["c"]
        dw = (dz[bag] * h).sum(1)
        de = w * (dw - np.bincount(bag, weights=w * dw, minlength=n)[bag])
        dtg = de[:, None] * p["a"]
        dt, dg = dtg * g * (1 - t * t), dtg * t * g * (1 - g)
        dh = (w[:, None] * dz[bag] + dt @ p["V"].T + dg @ p["U"].T) * (1 - h * h)
        return {"W": x.T @ dh, "b": dh.sum(0), "V": h.T @ dt, "U": h.T @ dg, "a": ((t * g) * de[:, None]).sum(0),
                "c": z.T @ ds, "d": ds.sum(keepdims=True)}

    def fit(self, bags: list[np.ndarray], y: np.ndarray, epochs: int = 20, size: int = 64, rate: float = 3e-3,
            decay: float = 1e-4, seed: int = 11) -> AttentionModel:
        every = np.concatenate(bags)
        self.mean, self.scale = every.mean(0), every.std(0) + 0.05
        rng, p = np.random.default_rng(seed), self.p
        m, v, step = {k: np.zeros_like(a) for k, a in p.items()}, {k: np.zeros_like(a) for k, a in p.items()}, 0
        for _ in range(epochs):
            order = rng.permutation(len(y))
            for lo in range(0, len(y), size):
                pick = order[lo:lo + size]
                bag = np.repeat(np.arange(len(pick)), [len(bags[i]) for i in pick])
                grad = self.gradient(bag, np.concatenate([bags[i] for i in pick]), y[pick])
                step += 1
                for k in p:
                    dk = grad[k] + decay * p[k]
                    m[k] = 0.9 * m[k] + 0.1 * dk
                    v[k] = 0.999 * v[k] + 0.001 * dk * dk
                    p[k] -= rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)
        return self


def fit_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                label: str = "quality", folds: int = 5, held_out: int = 0, max_rows: int = 4000,
                passage_words: int = 48) -> AttentionModel:
    """Fit on at most ``max_rows`` labelled documents outside the held-out fold (all passages of each).

    The tasks encode; the driver gets the sample's passage features. Without a
    labelled row, or with one class only, the model scores that class's share.
    """
    rows = labelled_sample(docs, labels, label, folds, held_out, max_rows, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, ys, ids = b.schema.get_field_index("text"), b.column("y").to_pylist(), b.column("id").cast(pa.string()).to_pylist()
            for lo, hi, texts in text_chunks(b, at):
                bag, x = encode_passages(texts, passage_words)
                edge = np.searchsorted(bag, np.arange(hi - lo + 1))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[lo:hi]), pa.array(ys[lo:hi], pa.int32()),
                     pa.array([x[edge[i]:edge[i + 1]].astype("<f4").tobytes() for i in range(hi - lo)], pa.binary())],
                    ["id", "y", "x"])

    got = sorted(rows.mapInArrow(run, "id string, y int, x binary").collect(), key=lambda r: (r["id"], r["y"], bytes(r["x"])))
    model = AttentionModel()
    y = np.array([float(r["y"] > 0) for r in got])
    if len(set(y)) < 2:
        share = min(max(y.mean() if len(y) else 0.5, 0.01), 0.99)
        model.p["c"][:] = 0
        model.p["d"][:] = np.log(share / (1 - share))
        return model
    return model.fit([np.frombuffer(r["x"], "<f4").reshape(-1, N_FEATURES).astype(float) for r in got], y)


def quality_score(model: AttentionModel, text, passage_words: int = 48):
    """Score column (0 to 1) of a text column; null and empty texts are one passage without words."""
    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        out = np.zeros(len(texts))
        batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string(), from_pandas=True)], ["text"])
        for lo, hi, chunk in text_chunks(batch, 0):
            bag, x = encode_passages(chunk, passage_words)
            out[lo:hi] = model.score(bag, x, hi - lo)
        return pd.Series(out)

    return score(text.cast("string"))


def quality_of(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, id_col: str = "doc_id",
               text_col: str = "text", folds: int = 5, held_out: int = 0, **fit) -> DataFrame:
    """``id_col``, held_out, score, predicted: the model fitted outside the held-out fold, over all rows.

    Texts of any length are read whole. Repeated rows get equal scores; labels
    of absent documents and documents without labels are fine; a null id is
    not held out; other columns are ignored; an empty table gives no rows.
    """
    model = fit_quality(docs, labels, id_col, text_col, folds=folds, held_out=held_out, **fit)
    scored = docs.select(F.col(id_col).alias("id"), quality_score(model, F.col(text_col)).alias("score"))
    return scored.select(F.col("id").alias(id_col), F.coalesce(fold_of("id", folds) == held_out, F.lit(False)).alias("held_out"),
                         "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
