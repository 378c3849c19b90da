"""Licence scans against a plain search of every target at every place."""

import math
import random
import re
from collections import Counter

import pytest

from cohortkit.llm import licenses as LI

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def corpus():
    rnd = random.Random(6)
    fill = ["und", "the", "of", "license", "public", "software", "is", "granted", "ête", "x1", "mit", "general"]
    rows = []
    for i, t in enumerate([*LI.TEMPLATES, *LI.WHOLE_TEXTS] * 3):
        own = t.text.split()
        for _ in range(rnd.choice([0, 0, 1, 3, 8, 25])):                     # changed words, some in the key phrase
            own[rnd.randrange(len(own))] = rnd.choice(fill)
        if rnd.random() < 0.3:
            own = own[:rnd.randrange(3, len(own) + 1)]
        before = [rnd.choice(fill) for _ in range(rnd.randrange(30))]
        rows.append((i, " ".join([*before, *own, *before[:5], *(own if rnd.random() < 0.2 else [])])))
    rows += [(900 + k, " ".join(rnd.choice(fill) for _ in range(400))) for k in range(10)]
    return rows + [(950, None), (951, ""), (952, "MIT   License MIT License"), (952, "MIT   License MIT License"), (None, "general public license"),
                   (953, "mit license " * 3000), (954, "free of charge is hereby granted permission")]


def brute(rows, min_share=0.7):
    postings, targets = LI.build_index(LI.BASE_PHRASES, [*LI.TEMPLATES, *LI.WHOLE_TEXTS], 12)
    held = [set(words(t)) for _, t in rows]
    n = {w: sum(w in h for h in held) for w in {p.word for p in postings}}
    idf = {w: math.log(1 + len(rows) / k) if k else 1.0 for w, k in n.items()}
    out = Counter()
    for i, text in rows:
        w, base, labels, score = words(text), [], set(), 0.0
        for t in targets:
            own = [p for p in postings if p.target == t["target"]]
            for start in range(len(w)):
                at = lambda p: start + p.rel < len(w) and w[start + p.rel] == p.word  # noqa: B023, E731
                if not all(at(p) for p in own if p.key):
                    continue
                share = sum(idf[p.word] for p in own if at(p)) / sum(idf[p.word] for p in own)
                if t["base"]:
                    base.append((start, t["label"]))
                    labels.add(t["label"])
                    score = 1.0
                elif share >= min_share:
                    labels.add(t["label"])
                    score = max(score, min(1.0, share))
        out[(i, len(w), len(base), min((s for s, _ in base), default=None), max((s for s, _ in base), default=None),
             ",".join(sorted({x for _, x in base})), ",".join(sorted(labels)), round(score, 9))] += 1
    return out


@pytest.mark.parametrize("parts", [1, 5])
def test_scan_equals_a_search_of_every_place(spark, parts):
    rows = corpus()
    out = LI.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)).collect()
    names = ("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels")
    assert Counter((*(r[c] for c in names), round(r["score"], 9)) for r in out) == brute(rows)


def test_whole_texts_are_told(spark):
    rows = [(i, f"Some head. {t.text} Some tail.") for i, t in enumerate(LI.WHOLE_TEXTS)]
    out = {r["doc_id"]: r for r in LI.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, t in enumerate(LI.WHOLE_TEXTS):
        assert t.label in out[i]["labels"].split(",") and out[i]["score"] == pytest.approx(1.0)
