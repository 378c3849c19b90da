"""Word2Vec on the executors: Spark's tree and steps, and nothing as long as the vocabulary on the driver."""

import numpy as np
import pytest
from pyspark.ml import feature
from pyspark.sql import functions as F

from cohortkit.operators import models, skipgram


def plain_tree(counts):
    """Spark's createBinaryTree over falling counts: word -> {inner node: bit}."""
    size = len(counts)
    count = list(counts) + [float("inf")] * size
    parent, bit = [0] * 2 * size, [0] * 2 * size
    leaf, inner = size - 1, size
    for a in range(size - 1):
        pair = []
        for _ in range(2):
            if leaf >= 0 and count[leaf] < count[inner]:
                pair.append(leaf)
                leaf -= 1
            else:
                pair.append(inner)
                inner += 1
        count[size + a] = count[pair[0]] + count[pair[1]]
        parent[pair[0]] = parent[pair[1]] = size + a
        bit[pair[1]] = 1
    paths = []
    for b in range(size):
        path = {}
        while b != 2 * size - 2:
            path[parent[b] - size] = bit[b]
            b = parent[b]
        paths.append(path)
    return paths


@pytest.mark.parametrize("counts", [[5], [3, 3], [7, 4, 2, 2, 1, 1, 1], [1] * 13, [40, 9, 9, 8, 4, 4, 4, 4, 2, 2, 2, 1, 1, 1, 1, 1, 1],
                                    sorted(np.random.default_rng(3).zipf(1.5, 400).tolist(), reverse=True)])
def test_the_tree_of_runs_is_sparks_tree(counts):
    tree = skipgram.Huffman({c: counts.count(c) for c in counts})
    got = [{} for _ in counts]
    for at, node, bit in tree.paths(np.arange(len(counts))):
        for a, j, b in zip(at.tolist(), node.tolist(), bit.tolist(), strict=True):
            got[a][j] = b
    assert got == plain_tree(counts)


def test_a_pass_takes_the_plain_steps():
    counts, size, window, rate = [6, 4, 3, 3, 2, 1], 4, 2, 0.1
    tree, random = skipgram.Huffman({6: 1, 4: 1, 3: 2, 2: 1, 1: 1}), np.random.default_rng(5)
    words, nodes = random.normal(size=(6, size)).astype("float32"), random.normal(size=(5, size)).astype("float32")
    model = skipgram.PartModel(tree, np.arange(11), np.concatenate([words, nodes]))
    sentence, narrower = np.array([0, 3, 1, 0, 5, 2, 0, 4, 1, 1, 2]), np.array([0, 1, 0, 1, 1, 0, 0, 1, 0, 0, 1])
    model.learn(sentence, narrower, window, rate)
    paths = plain_tree(counts)
    for block in (range(8), range(8, 11)):
        new_words, new_nodes = words.copy(), nodes.copy()
        for at in block:
            for c in range(max(0, at - window + narrower[at]), min(11, at + window - narrower[at] + 1)):
                for node, bit in paths[sentence[at]].items() if c != at else ():
                    f = float(words[sentence[c]] @ nodes[node])
                    if -6 < f < 6:
                        g = (1 - bit - 1 / (1 + np.exp(-f))) * rate
                        new_words[sentence[c]] += g * nodes[node]
                        new_nodes[node] += g * words[sentence[c]]
        words, nodes = new_words, new_nodes
    assert np.allclose(model.word_vectors, words, atol=1e-5) and np.allclose(model.node_vectors, nodes, atol=1e-5)


def _topics(spark, rows=400):
    random = np.random.default_rng(1)
    data = [([f"{t}{j}" for j in random.integers(8, size=30)],) for t in random.choice(list("ab"), size=rows)]
    return spark.createDataFrame(data, "words array<string>").repartition(4).cache()


def test_words_of_a_topic_are_alike_as_with_spark(spark):
    corpus = _topics(spark)
    ours = models.word2vec(corpus, "words", partitions=2)
    sparks = feature.Word2Vec(vectorSize=16, minCount=1, seed=42, maxIter=5, numPartitions=1, inputCol="words", outputCol="w").fit(corpus)
    for model in (ours, sparks):
        assert model.getVectors().count() == 16
        near = model.findSynonyms("a0", 7)
        assert near.columns == ["word", "similarity"] and {r[0][0] for r in near.collect()} == {"a"}
    again = models.word2vec(corpus, "words", partitions=2)
    assert sorted(map(str, again.getVectors().collect())) == sorted(map(str, ours.getVectors().collect()))
    means = ours.transform(spark.createDataFrame([(["a0", "new"],), ([],)], "words array<string>")).collect()
    a0 = ours.vectors.where("word = 'a0'").first()["vector"]
    assert {tuple(r["w2v"].toArray().round(6)) for r in means} == {tuple((np.array(a0) / 2).round(6)), (0.0,) * 16}


def test_rare_words_are_left_out_and_long_sentences_cut(spark):
    corpus = spark.createDataFrame([(["a", "b"] * 700 + ["c"],), (["d"],), (["d"],)], "words array<string>")
    found = models.word2vec(corpus, "words", min_count=2, max_iter=1, partitions=2).getVectors()
    assert {r[0] for r in found.collect()} == {"a", "b", "d"}
    with pytest.raises(ValueError, match="vocabulary size"):
        models.word2vec(corpus, "words", min_count=10_000)


def test_the_driver_gets_no_row_per_word(spark, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame

    fetched, collect = [], DataFrame.collect
    monkeypatch.setattr(DataFrame, "collect", lambda self: fetched.append(collect(self)) or fetched[-1])
    monkeypatch.setattr(feature.Word2Vec, "_fit", lambda *_: pytest.fail("Spark's Word2Vec takes all vectors to the driver"))
    corpus = spark.range(500).select(F.array(*[F.concat(F.lit(f"w{i}_"), "id") for i in range(4)]).alias("words"))
    assert models.word2vec(corpus, "words", max_iter=2, partitions=2).getVectors().count() == 2000
    assert sum(map(len, fetched)) < 10
