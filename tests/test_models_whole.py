"""Models use the whole cluster and every pass they are given."""

from cohortkit.operators import models


def test_word2vec_is_trained_in_parallel(spark, monkeypatch):
    got = {}

    class Seen(models.Word2Vec):
        def fit(self, corpus):
            got.update({p.name: v for p, v in self.extractParamMap().items()})
            return super().fit(corpus)

    monkeypatch.setattr(models, "Word2Vec", Seen)
    corpus = spark.createDataFrame([(["a", "b", "c"],)] * 40, "words array<string>")
    assert models.word2vec(corpus, "words").getVectors().count() == 3
    assert got["numPartitions"] == spark.sparkContext.defaultParallelism and got["maxIter"] == 5
    models.word2vec(corpus, "words", max_iter=2, partitions=3)
    assert (got["numPartitions"], got["maxIter"]) == (3, 2)
