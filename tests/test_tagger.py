"""Dictionary tagging against a plain loop, compiled and joined."""

import random
import re
from collections import Counter

import pytest

from cohortkit.operators import tagger


def words_of(text):
    return [w for w in re.split("[^a-z0-9]+", (text or "").lower()) if w]


def brute(docs, entries):
    """(key, tag_set, idx, label, start, n_words, entity) of each match."""
    sets = {}
    for s, p, lab in entries:
        w = tuple(words_of(p))
        if w and s is not None and lab is not None:
            sets.setdefault(s, {})
            sets[s][w] = min(lab, sets[s].get(w, lab))
    out = Counter()
    for k, t in docs:
        w = words_of(t)
        for s, phrases in sets.items():
            i = idx = 0
            while i < len(w):
                n = max((len(p) for p in phrases if tuple(w[i:i + len(p)]) == p), default=0)
                if n:
                    out[(k, s, idx, phrases[tuple(w[i:i + n])], i, n, " ".join(w[i:i + n]))] += 1
                    idx += 1
                i += n or 1
    return out


def table():
    rnd = random.Random(6)
    vocab = [f"w{k}" for k in range(30)]
    docs = [(k, rnd.choice([" ", ", ", "\n"]).join(rnd.choice(vocab) for _ in range(rnd.randrange(60)))) for k in range(80)]
    docs += [(90, None), (91, ""), (92, "?!"), (5, "w1 w2 w3 W4"), (5, "w1 w2 w3 W4"), (None, "w1 w1 w1"), (93, "w1 w2 " * 4000)]
    entries = [(rnd.choice("abc"), " ".join(rnd.choice(vocab) for _ in range(rnd.choice([1, 2, 2, 3, 4]))), rnd.choice(["X", "Y"])) for _ in range(150)]
    entries += [("a", "w1", "Y"), ("a", "W1 ", "X"), ("a", "w1 w2", "Z"), ("a", "w2 w3 w4", "Z"), ("b", "", "X"), (None, "w1", "X"), ("b", "w1", None), ("d", "w1 w1", "X")]
    return docs, entries


def frames(spark):
    docs, entries = table()
    return (spark.createDataFrame(docs, "id long, text string").repartition(4),
            spark.createDataFrame(entries, "tag_set string, phrase string, label string"), docs, entries)


@pytest.mark.parametrize("compiled", [tagger.COMPILED, 3])
def test_matches_equal_a_loop(spark, compiled):
    df, dictionary, docs, entries = frames(spark)
    want = brute(docs, entries)
    assert Counter(map(tuple, tagger.tag_phrases(df, "id", "text", dictionary, compiled).collect())) == want
    counts = Counter()
    for (_, s, _, lab, *_), n in want.items():
        counts[(s, lab)] += n
    assert {(r.tag_set, r.label): r.n for r in tagger.label_counts(df, "text", dictionary, compiled).collect()} == counts
    lists = tagger.phrase_lists(df, "id", "text", dictionary, "a", compiled).collect()
    assert len(lists) == len(docs)
    assert Counter((r.id, e) for r in lists for e in r.entities) == Counter({(k, e): 0 for k, e in []}) + sum(
        (Counter({(k, e): n}) for (k, s, _, _, _, _, e), n in want.items() if s == "a"), Counter())


@pytest.mark.parametrize("compiled", [tagger.COMPILED, 0])
def test_empty_dictionary_and_empty_table(spark, compiled):
    df, dictionary, _, _ = frames(spark)
    assert tagger.tag_phrases(df, "id", "text", dictionary.limit(0), compiled).collect() == []
    assert tagger.label_counts(df.limit(0), "text", dictionary, compiled).collect() == []
    assert all(r.entities == [] for r in tagger.phrase_lists(df, "id", "text", dictionary, "none", compiled).collect())


def test_a_task_looks_at_a_bounded_number_of_words(spark):
    import pyarrow as pa

    lists = pa.array([["a"] * 5, None, [], ["b"] * 3, ["c"] * 40, ["d"], []], pa.list_(pa.string()))
    for part in (lists, lists.slice(1, 5)):
        slices = list(tagger._slices(part, 8))
        assert pa.concat_arrays(slices).equals(part)
        assert all(len(s.flatten()) <= 8 or len(s) == 1 for s in slices)
    assert list(tagger._slices(lists.slice(0, 0), 8)) == []
    long = [(k, "w1 w2 x " * 1500) for k in range(300)]     # 1,350,000 words: several slices of one batch
    df = spark.createDataFrame(long, "id long, text string").coalesce(1)
    dictionary = spark.createDataFrame([("a", "w1 w2", "X"), ("b", "x", "Y")], "tag_set string, phrase string, label string")
    assert {(r.tag_set, r.label): r.n for r in tagger.label_counts(df, "text", dictionary).collect()} == {("a", "X"): 450_000, ("b", "Y"): 450_000}
