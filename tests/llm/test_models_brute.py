"""The classifiers' parts against plain versions: segments, odds, calibration; attention scores and gradients."""

import math
import random
import re
import zlib

import numpy as np
import pytest

from cohortkit.llm import quality_model as Q
from cohortkit.llm import toxicity as X


def all_maximal(scores):
    """Best segment first, then left and right of it; longer ones lose ties (they cannot arise with these scores)."""
    def part(lo, hi):
        best = None
        for a in range(lo, hi):
            total = 0.0
            for b in range(a, hi):
                total += scores[b]
                if total > 0 and (best is None or total > best[0] + 1e-12):
                    best = (total, a, b)
        return [] if best is None else [*part(lo, best[1]), best, *part(best[2] + 1, hi)]

    return part(0, len(scores))


def test_every_maximal_segment_is_found():
    rnd = random.Random(5)
    for _ in range(400):
        n, cost = rnd.randrange(1, 40), rnd.uniform(0.05, 0.8)
        score = [rnd.uniform(-3, 3) if rnd.random() < 0.5 else None for _ in range(n)]
        at = [i for i, s in enumerate(score) if s is not None]
        got = X.maximal_segments(at, [score[i] for i in at], cost)
        want = all_maximal([-cost if s is None else s for s in score])
        assert [(a, b) for _, a, b in got] == [(a, b) for _, a, b in want]
        assert [s for s, _, _ in got] == pytest.approx([s for s, _, _ in want])


def corpus():
    rnd = random.Random(8)
    calm, bad = [f"calm{k}" for k in range(40)], ["vile", "nasty", "awful"]
    rows, labels = [], []
    for i in range(160):
        words = [rnd.choice(calm) for _ in range(rnd.randrange(20, 60))]
        toxic = i % 4 == 0
        for _ in range(4 if toxic else int(rnd.random() < 0.2)):
            words.insert(rnd.randrange(len(words)), rnd.choice(bad))
        rows.append((i, " ".join(words)))
        labels.append((i, int(not toxic), int(toxic)))
    return rows + [(500, None), (501, "vile nasty awful calm1"), (502, "")], labels


@pytest.mark.parametrize("held_tokens", [X.TOKENS_HELD, 7])
def test_toxicity_equals_a_plain_version(spark, monkeypatch, held_tokens):
    monkeypatch.setattr(X, "TOKENS_HELD", held_tokens)
    rows, labels = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = X.fit_toxicity(docs, marks)
    train = [(i, t, y) for (i, t), (_, _, y) in zip(rows, labels) if zlib.crc32(str(i).encode()) % 4 != 2]
    held = lambda t: set(re.findall(X.TOKEN, (t or "").lower()))
    n_toxic, n_clean = sum(y for *_, y in train), sum(1 - y for *_, y in train)
    everywhere, prior = {}, 0.0625 * len(train)
    for _, t in rows:
        for w in held(t):
            everywhere[w] = everywhere.get(w, 0) + 1
    want = {}
    for w in {w for _, t, _ in train for w in held(t)}:
        if everywhere[w] < 5:
            continue
        pooled = prior * everywhere[w] / len(rows)
        a, b = (sum(w in held(t) for _, t, y in train if y == c) + pooled for c in (1, 0))
        odds = math.log(a / max(n_toxic + prior - a, 0.5)) - math.log(b / max(n_clean + prior - b, 0.5))
        if abs(odds) >= 1.0 and abs(odds / math.sqrt(1 / a + 1 / b)) >= 3.0:
            want[w] = odds
    assert set(model.scores) == set(want) >= {"vile", "nasty", "awful"}
    assert all(model.scores[w] == pytest.approx(want[w], abs=1e-5) for w in want)

    # segments, surprises and the link of every text, from the definitions
    def features(t):
        tokens = re.findall(X.TOKEN, (t or "").lower())
        found = all_maximal([model.scores[w] - model.cost if w in model.scores else -model.cost for w in tokens])
        surprise = [math.log(max(math.exp(model.lam * s) / (model.k * max(len(tokens), 1)), 1e-300)) for s, _, _ in found]
        real = [x for x in surprise if x > 0]
        return np.array([1.0, max(real, default=0.0), math.log1p(len(real)), math.log1p(sum(real))])

    got = {r["doc_id"]: r for r in X.toxicity_of(docs, marks).collect()}
    for i, t in rows:
        score = 1 / (1 + math.exp(-float(np.clip(features(t) @ model.link, -30, 30))))
        assert got[i]["score"] == pytest.approx(score, abs=1e-9)
        assert got[i]["predicted"] == int(score >= 0.3) and got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2)
    assert got[501]["predicted"] == 1 and got[500]["score"] == got[502]["score"]

    # the link is where the penalised likelihood has no slope; chance segments give the tail's constants
    x, y = np.array([features(t) for _, t, _ in train]), np.array([y for *_, y in train], float)
    slope = x.T @ (1 / (1 + np.exp(-(x @ model.link))) - y) + np.array([1e-6, 0.5, 0.5, 0.5]) * model.link
    assert np.abs(slope).max() < 1e-5
    chance = sorted(s for _, t, c in train if not c for s, _, _ in
                    all_maximal([model.scores[w] - model.cost if w in model.scores else -model.cost for w in re.findall(X.TOKEN, t.lower())]))
    length = sum(len(re.findall(X.TOKEN, t.lower())) for _, t, c in train if not c)
    if len(chance) >= 20:
        floor = float(np.median(chance))
        over = [s - floor for s in chance if s > floor]
        assert model.lam == pytest.approx(np.clip(len(over) / max(sum(over), 1e-6 * len(over)), 0.2, 3.0))
    else:
        assert (model.lam, model.k) == (1.0, pytest.approx(max(1.0, len(chance)) / length))


def bags(rng, sizes):
    bag = np.repeat(np.arange(len(sizes)), sizes)
    return bag, rng.normal(size=(len(bag), Q.N_FEATURES))


def plain_scores(model, bag, x, n):
    out = []
    for d in range(n):
        rows = []
        for v in x[bag == d]:
            h = np.tanh(np.clip((v - model.mean) / model.scale, -8, 8) @ model.p["W"] + model.p["b"])
            rows.append((float((np.tanh(h @ model.p["V"]) / (1 + np.exp(-(h @ model.p["U"])))) @ model.p["a"]), h))
        total = sum(math.exp(e) for e, _ in rows)
        z = sum(math.exp(e) / total * h for e, h in rows)
        out.append(1 / (1 + math.exp(-float(z @ model.p["c"] + model.p["d"][0]))))
    return out


def test_attention_scores_and_gradients():
    rng = np.random.default_rng(4)
    bag, x = bags(rng, [1, 3, 2, 5])
    y = np.array([0.0, 1.0, 1.0, 0.0])
    model = Q.AttentionModel(hidden=5, gate=3)
    model.mean, model.scale = rng.normal(size=Q.N_FEATURES), rng.uniform(0.5, 2, Q.N_FEATURES)
    assert model.score(bag, x, 4) == pytest.approx(plain_scores(model, bag, x, 4))

    def loss():
        s = model.score(bag, x, 4)
        return float(-(y * np.log(s) + (1 - y) * np.log(1 - s)).mean())

    grad = model.gradient(bag, x, y)
    for name, p in model.p.items():
        flat, g = p.reshape(-1), grad[name].reshape(-1)
        for i in range(0, len(flat), max(1, len(flat) // 12)):
            keep = flat[i]
            flat[i] = keep + 1e-6
            up = loss()
            flat[i] = keep - 1e-6
            down = loss()
            flat[i] = keep
            assert g[i] == pytest.approx((up - down) / 2e-6, abs=1e-6), name


def test_quality_scores_every_passage_of_every_text(spark):
    rows, labels = corpus()
    rows.append((600, " ".join(f"word{k}" for k in range(400))))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = Q.fit_quality(docs, marks)
    got = {r["doc_id"]: r for r in Q.quality_of(docs, marks).collect()}
    for i, t in rows:
        bag, x = Q.encode_passages([t or ""], 48)
        assert len(x) == max(1, -(-len((t or "").split()) // 48))
        assert got[i]["score"] == pytest.approx(plain_scores(model, bag, x, 1)[0], abs=1e-9)
        assert got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0)


def test_passages_do_not_depend_on_the_texts_beside_them():
    texts = ["a b c \n\n ", "", "  \n lead", "x y z", "one " * 100, ""]
    bag, x = Q.encode_passages(texts, 48)
    for i, t in enumerate(texts):
        assert np.array_equal(x[bag == i], Q.encode_passages([t], 48)[1])
        assert np.array_equal(x[bag == i], Q.encode_passages(["zz ", t, " \n\n"], 48)[1][Q.encode_passages(["zz ", t, " \n\n"], 48)[0] == 1])
