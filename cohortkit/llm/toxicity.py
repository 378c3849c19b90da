"""Toxic passages by maximum-scoring segment search.

Token scores are log-odds of toxic against clean training documents with an
informative Dirichlet prior (the counts over the whole corpus); tokens that do not
stand out cost a small amount each. Every use of a token scores the same. A linear-time scan finds all maximal
scoring segments of a text; Karlin-Altschul statistics fitted on clean
training text turn a segment's score into an expected count of chance
segments, and a logistic link over the extreme-value quantities of a document
gives its score.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortkit.llm.common import text_chunks
from cohortkit.llm.labelled import fold_of, labelled_sample

TOKEN = re.compile(r"[^\W\d_]+")
#: Distinct tokens after which a task hands its counts on.
TOKENS_HELD = 1 << 16


def maximal_segments(at: list[int], gain: list[float], cost: float) -> list[tuple[float, int, int]]:
    """All maximal scoring segments (score, first token, last token), in order.

    ``at`` holds the positions of the tokens with a score of their own, every
    other token costs ``cost``. One pass with a stack of candidate segments:
    a segment that gains joins the last candidate that starts lower and ends
    no higher, together with what lies between (Ruzzo and Tompa, 1999).
    """
    done: list[tuple[float, float, int, int, int]] = []
    # total before, total after, first, last, the last candidate below that starts lower (-1: none)
    stack: list[tuple[float, float, int, int, int]] = []
    total, last = 0.0, -1
    for p, g in zip(at, gain, strict=True):
        total -= cost * (p - last - 1)
        last = p
        if g <= 0:
            total += g
            continue
        left, right, first = total, total + g, p
        total = right
        k = len(stack) - 1
        while True:
            while k >= 0 and stack[k][0] >= left:
                k = stack[k][4]
            if k < 0:
                done += stack       # no later segment can join these
                stack = []
            if k < 0 or stack[k][1] >= right:
                break
            left, _, first, _, below = stack[k]
            del stack[k:]
            k = below
        stack.append((left, right, first, p, k))
    return [(r - lo, a, b) for lo, r, a, b, _ in done + stack]


@dataclass
class ToxicModel:
    """Token scores, the cost of other tokens, the extreme-value constants and the logistic link."""

    scores: dict[str, float] = field(default_factory=dict)
    cost: float = 0.1
    lam: float = 1.0
    k: float = 0.1
    link: np.ndarray = field(default_factory=lambda: np.zeros(4))

    def segments(self, text: str) -> tuple[int, list[tuple[float, int, int]]]:
        """(number of tokens, maximal segments) of a text."""
        tokens, get = TOKEN.findall(text.lower()), self.scores.get
        hits = [(i, t) for i, t in enumerate(tokens) if get(t) is not None]
        # every use counts whole: a segment's score is that of its tokens, whatever stands before it
        return len(tokens), maximal_segments([i for i, _ in hits], [get(t) - self.cost for _, t in hits], self.cost)

    def expected(self, score: float, n: int) -> float:
        """Segments of at least this score that a clean text of ``n`` tokens has by chance (E-value)."""
        return self.k * max(n, 1) * float(np.exp(-self.lam * score))

    def features(self, text: str) -> np.ndarray:
        """Bias, surprise of the best segment, number of significant segments (log), their surprise together."""
        n, found = self.segments(text)
        surprise = [-np.log(max(self.expected(s, n), 1e-30)) for s, _, _ in found]
        real = [x for x in surprise if x > 0]
        return np.array([1.0, max(real, default=0.0), np.log1p(len(real)), np.log1p(sum(real))])

    def score(self, text: str) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.features(text) @ self.link, -30, 30))))

    def passages(self, text: str, max_expected: float = 0.05) -> list[tuple[int, int, float, float]]:
        """Significant passages: (from character, to character, score, E-value), in text order."""
        n, found = self.segments(text)
        real = [(s, a, b, e) for s, a, b in found if (e := self.expected(s, n)) <= max_expected]
        if not real:
            return []
        spans = [m.span() for m in TOKEN.finditer(text.lower())]
        return [(spans[a][0], spans[b][1], s, e) for s, a, b, e in real]


def token_scores(counts: pd.DataFrame, n_docs: float, n_toxic: float, n_clean: float, prior: float, min_z: float,
                 min_odds: float) -> dict[str, float]:
    """Log-odds with an informative Dirichlet prior for tokens whose z-score stands out (Monroe and others, 2008).

    ``counts``: token, toxic and clean (sampled documents that hold it) and
    docs (of the ``n_docs`` documents of the corpus). The prior is each token's
    rate in the corpus, worth ``prior`` documents a class.
    """
    pooled = prior * counts["docs"] / max(n_docs, 1)
    a, b = counts["toxic"] + pooled, counts["clean"] + pooled
    odds = np.log(a / (n_toxic + prior - a).clip(lower=0.5)) - np.log(b / (n_clean + prior - b).clip(lower=0.5))
    z = odds / np.sqrt(1 / a + 1 / b)
    out = counts["token"][(z.abs() >= min_z) & (odds.abs() >= min_odds)]
    return dict(zip(out, odds[out.index].round(6), strict=True))


def fit_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 label: str = "toxic", folds: int = 4, held_out: int = 2, max_rows: int = 16000,
                 prior: float = 0.0625, min_z: float = 3.0, min_odds: float = 1.0,
                 min_docs: int = 5) -> ToxicModel:
    """Fit on at most ``max_rows`` labelled documents outside the held-out fold.

    ``prior`` is the prior's weight as a share of the sample; its token rates
    are counted over all rows of ``docs``, copies and unlabelled ones too.
    Token counts are aggregated by Spark, joined to the sample's tokens and
    filtered to ``min_docs`` documents of the corpus there; the driver gets the
    remaining vocabulary of the sample, then four numbers per sampled document for the link. Without rows of both
    classes no token scores and every document gets the class share.
    """
    rows = labelled_sample(docs, labels, label, folds, held_out, max_rows, id_col, text_col)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(token, toxic, clean) summed over runs of texts with some TOKENS_HELD tokens; the row without a token counts documents."""
        by: dict[str, list[int]] = {}

        def summed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(by), pa.string()), pa.array([v[0] for v in by.values()], pa.int64()),
                                               pa.array([v[1] for v in by.values()], pa.int64())], ["token", "toxic", "clean"])

        for b in batches:
            ys = b.column("y").to_pylist()
            for lo, _, texts in text_chunks(b, b.schema.get_field_index("text")):
                for i, text in enumerate(texts):
                    for t in {"", *TOKEN.findall(text.lower())}:
                        by.setdefault(t, [0, 0])[ys[lo + i] <= 0] += 1
                if len(by) > TOKENS_HELD:
                    yield summed()
                    by.clear()
        yield summed()

    schema = "token string, toxic bigint, clean bigint"
    everywhere = (docs.select(F.col(text_col).cast("string").alias("text"), F.lit(0).alias("y")).mapInArrow(count, schema)
                  .groupBy("token").agg(F.sum("clean").alias("docs")))
    counted = (rows.mapInArrow(count, schema).groupBy("token")
               .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).join(everywhere, "token")
               .where((F.col("docs") >= min_docs) | (F.col("token") == "")).toPandas())
    sizes = counted[counted["token"] == ""]
    n_toxic, n_clean = (float(sizes["toxic"].sum()), float(sizes["clean"].sum()))
    model = ToxicModel()
    share = min(max(n_toxic / max(n_toxic + n_clean, 1), 0.001), 0.999)
    model.link = np.array([np.log(share / (1 - share)), 0.0, 0.0, 0.0])
    if not n_toxic or not n_clean:
        return model
    tokens = counted[counted["token"] != ""].sort_values("token").reset_index(drop=True)
    model.scores = token_scores(tokens, float(sizes["docs"].sum()), n_toxic, n_clean, prior * (n_toxic + n_clean), min_z, min_odds)

    # scores of clean text: how often each scoring token comes, per token of text
    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out, ys = [], b.column("y").to_pylist()
            for lo, _, texts in text_chunks(b, b.schema.get_field_index("text")):
                for i, text in enumerate(texts):
                    n, found = model.segments(text)
                    out.append((int(ys[lo + i] > 0), n, [s for s, _, _ in found]))
            yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int32()), pa.array([o[1] for o in out], pa.int64()),
                                              pa.array([o[2] for o in out], pa.list_(pa.float64()))], ["y", "n", "segments"])

    got = sorted(rows.mapInArrow(sample, "y int, n bigint, segments array<double>").collect(),
                 key=lambda r: (r["y"], r["n"], r["segments"]))
    clean = [r for r in got if not r["y"]]
    length = max(sum(r["n"] for r in clean), 1)
    chance = np.sort(np.array([s for r in clean for s in r["segments"]]))
    # tail of chance segments: count above s is k·n·exp(-λ s); λ by maximum likelihood over the upper half
    if len(chance) >= 20:
        floor = np.median(chance)
        over = chance[chance > floor] - floor
        model.lam = float(np.clip(1 / max(over.mean(), 1e-6) if len(over) else 1.0, 0.2, 3.0))
        model.k = float(np.clip(len(over) / length * np.exp(model.lam * floor), 1e-9, 1.0))
    else:
        model.lam, model.k = 1.0, max(1.0, len(chance)) / length
    x, y = [], np.array([float(r["y"]) for r in got])
    for r in got:
        real = [v for v in (-np.log(max(model.expected(s, r["n"]), 1e-30)) for s in r["segments"]) if v > 0]
        x.append([1.0, max(real, default=0.0), np.log1p(len(real)), np.log1p(sum(real))])
    model.link = logistic(np.array(x), y)
    return model


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.5, rounds: int = 50) -> np.ndarray:
    """Ridge logistic regression by Newton steps; the first column is the bias (not shrunk)."""
    w = np.zeros(x.shape[1])
    shrink = np.full(x.shape[1], ridge)
    shrink[0] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hess = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(shrink)
        step = np.linalg.solve(hess, x.T @ (p - y) + shrink * w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def toxic_score(model: ToxicModel, text):
    """Score column (0 to 1) of a text column; null and empty texts have no segment and score as such."""
    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series([model.score(t or "") for t in texts], dtype=float)

    return score(text.cast("string"))


def toxic_passages(model: ToxicModel, text):
    """Column of the significant passages: array of start, end (characters from 0, end exclusive, of the
    lower-cased text), score and expected (E-value)."""
    names = ("start", "end", "score", "expected")

    @F.pandas_udf("array<struct<start:int,end:int,score:double,expected:double>>")
    def found(texts: pd.Series) -> pd.Series:
        return pd.Series([[dict(zip(names, p, strict=True)) for p in model.passages(t or "")] for t in texts], dtype=object)

    return found(text.cast("string"))


def toxicity_of(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, id_col: str = "doc_id",
                text_col: str = "text", folds: int = 4, held_out: int = 2, **fit) -> DataFrame:
    """``id_col``, held_out, score, predicted: the model fitted outside the held-out fold, over all rows.

    Whole texts are scanned. Repeated rows get equal scores; labels of absent
    documents and documents without labels are fine; a null id is not held
    out; other columns are ignored; an empty table gives no rows.
    """
    model = fit_toxicity(docs, labels, id_col, text_col, folds=folds, held_out=held_out, **fit)
    scored = docs.select(F.col(id_col).alias("id"), toxic_score(model, F.col(text_col)).alias("score"))
    return scored.select(F.col("id").alias(id_col), F.coalesce(fold_of("id", folds) == held_out, F.lit(False)).alias("held_out"),
                         "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
