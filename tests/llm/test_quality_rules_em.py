"""Weak supervision against a plain expectation maximisation, text by text."""

import math
import random

import numpy as np
import pytest

from cohortkit.llm import quality_rules as Q


def plain(votes, pseudo, prior=0.85, rounds=100):
    """Posterior of each text; a loop over texts, rules and votes."""
    n_rules = len(votes[0])
    rate = [[[Q.START[c][v] for v in range(3)] for _ in range(n_rules)] for c in range(2)]
    share, post = prior, [prior] * len(votes)
    for _ in range(rounds):
        new = []
        for v in votes:
            bad, good = (math.log(s) + sum(math.log(rate[c][k][x + 1]) for k, x in enumerate(v)) for c, s in ((0, 1 - share), (1, share)))
            new.append(1 / (1 + math.exp(max(-700, min(700, bad - good)))))
        for c in range(2):
            mass = [p if c else 1 - p for p in new]
            for k in range(n_rules):
                for x in range(3):
                    seen = sum(m for m, v in zip(mass, votes) if v[k] + 1 == x)
                    rate[c][k][x] = (seen + pseudo * Q.START[c][x]) / (sum(mass) + pseudo)
        share = min(max(sum(new) / len(new), 0.05), 0.99)
        done = max(abs(a - b) for a, b in zip(new, post)) < 1e-9
        post = new
        if done:
            break
    return post, rate


def corpus():
    rnd = random.Random(3)
    calm = [f"calmword{k}" for k in range(200)]
    out = [(i, " ".join(rnd.choice(calm) for _ in range(rnd.choice([30, 60, 150])))) for i in range(120)]
    out += [(200 + i, "#$%& || <<>> 12 !! " * rnd.randrange(1, 40)) for i in range(30)]
    out += [(300 + i, "SAME LINE here\n" * 40) for i in range(12)]
    return out + [(400, None), (401, ""), (402, "one"), (3, "repeated row"), (3, "repeated row")]


@pytest.mark.parametrize("pseudo", [1000.0, 5.0])
def test_posterior_and_kept_equal_plain_estimation(spark, pseudo):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    out = Q.judge_quality(docs, pseudo=pseudo).collect()
    names = [c for c in out[0].asDict() if c.startswith("vote_")]
    some = [r for r in out if r["n_words"] > 0]
    post, rate = plain([[r[c] for c in names] for r in some], pseudo)
    assert [r["posterior"] for r in some] == pytest.approx(post, abs=1e-8)
    assert all(r["posterior"] == 0.0 and not r["kept"] for r in out if r["n_words"] == 0)
    assert all(r["kept"] == (not r["base_failed"] and r["posterior"] >= 0.5) for r in out)
    got = {(r["rule"], r["vote"]): r for r in Q.rule_rates(docs, pseudo=pseudo).collect()}
    for k, c in enumerate(names):
        for x in range(3):
            r = got[(c[5:], x - 1)]
            assert (r["bad"], r["good"]) == pytest.approx((rate[0][k][x], rate[1][k][x]), abs=1e-8)
            assert (r["start_bad"], r["start_good"]) == (Q.START[0][x], Q.START[1][x])


def test_the_start_gives_way_as_the_table_grows():
    rng = np.random.default_rng(1)
    true = np.array([[0.7, 0.2, 0.1], [0.01, 0.09, 0.9]])
    for n, near in ((300, 0.45), (300_000, 0.02)):
        good = rng.random(n) < 0.8
        votes = np.stack([np.where(good, rng.choice(3, n, p=true[1]), rng.choice(3, n, p=true[0])) - 1 for _ in range(6)], axis=1)
        patterns, counts = np.unique(votes, axis=0, return_counts=True)
        _, rates, share = Q.estimate(patterns, counts.astype(float))
        assert np.abs(rates - true[:, None, :]).max() < near
    assert share == pytest.approx(0.8, abs=0.01)


def test_no_texts(spark):
    assert Q.judge_quality(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    rates = Q.rule_rates(spark.createDataFrame([], "doc_id long, text string")).collect()
    assert all(r["bad"] == r["start_bad"] and r["good"] == r["start_good"] for r in rates)
