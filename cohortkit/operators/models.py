"""Spark ML wrappers: assemble features, fit with class weights, score, report.

Training runs on Spark ML's distributed solvers (tree aggregation over
partitions); only model coefficients and per-iteration losses — bounded by
the model size and the iteration count — come back to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import (GBTClassifier, LogisticRegression, MultilayerPerceptronClassifier,
                                       RandomForestClassifier)
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortkit.operators.features import weight_column
from cohortkit.operators.skipgram import Word2Vec

LEARNERS = {
    "logreg": lambda **kw: LogisticRegression(**kw),
    "forest": lambda **kw: RandomForestClassifier(**kw),
    "gbt": lambda **kw: GBTClassifier(**kw),
    "mlp": lambda **kw: MultilayerPerceptronClassifier(**kw),
}
WEIGHTED = {"logreg", "forest", "gbt"}


def with_features(df: DataFrame, columns: Sequence[str] | None = None, array_col: str | None = None,
                  name: str = "features") -> DataFrame:
    """A vector column from numeric columns or from an array column."""
    if array_col is not None:
        return df.withColumn(name, array_to_vector(F.col(array_col).cast("array<double>")))
    return VectorAssembler(inputCols=list(columns), outputCol=name, handleInvalid="skip").transform(df)


def fit(kind: str, train: DataFrame, label: str, balanced: bool = False, **params):
    """Fit a learner on ``train`` (label cast to double); ``balanced`` adds 'balanced' row weights."""
    data = train.withColumn("__label", F.col(label).cast("double"))
    kw = dict(featuresCol="features", labelCol="__label", **params)
    if balanced and kind in WEIGHTED:
        data = weight_column(data, "__label", "__w")
        kw["weightCol"] = "__w"
    return LEARNERS[kind](**kw).fit(data)


def score(model, df: DataFrame, keys: Sequence[str], label: str | None = None) -> DataFrame:
    """Predictions (and the positive-class probability when there are two classes)."""
    out = model.transform(df)
    cols = [*keys, F.col("prediction").cast("int").alias("prediction")]
    if label is not None:
        cols.insert(len(keys), F.col(label).cast("int").alias("label"))
    if "probability" in out.columns:
        prob = vector_to_array("probability")
        cols.append(F.round(F.element_at(prob, F.size(prob)), 6).alias("p_last"))
    return out.select(*cols)


def loss_curve(spark: SparkSession, name: str, losses: Sequence[float]) -> DataFrame:
    """A (model, iteration, loss) table from a per-iteration loss list."""
    return spark.createDataFrame([(name, i + 1, float(v)) for i, v in enumerate(losses)],
                                 "model string, iteration int, loss double")


def word2vec(corpus: DataFrame, tokens_col: str, size: int = 16, seed: int = 42, min_count: int = 1,
             max_iter: int = 5, partitions: int | None = None):
    """Word2Vec in ``partitions`` tasks (the cluster's parallelism when not given) and ``max_iter`` passes."""
    partitions = partitions or corpus.sparkSession.sparkContext.defaultParallelism
    return Word2Vec(vectorSize=size, minCount=min_count, seed=seed, maxIter=max_iter, numPartitions=partitions,
                    inputCol=tokens_col, outputCol="w2v").fit(corpus)


def pca(df: DataFrame, k: int) -> tuple:
    model = PCA(k=k, inputCol="features", outputCol="pc").fit(df)
    return model, model.transform(df)
