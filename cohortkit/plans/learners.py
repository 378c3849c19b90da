"""Model keys: classifiers, learning curves, scoring, gradient learners, Word2Vec, PCA (rows only) and TF-IDF (with an oracle).

Train/test rows come from the md5 split, so every run trains on the same rows;
all learners get a fixed seed.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortkit.operators import boosting
from cohortkit.operators import gradient as G
from cohortkit.operators import models as ML
from cohortkit.operators import text as T
from cohortkit.operators.cohort import top_k_keys
from cohortkit.operators.features import global_index, hash_split, per_class, standard_scale
from cohortkit.operators.logistic import logistic_scores
from cohortkit.operators.metrics import classification_report, prf
from cohortkit.plans import extracts, sequences
from cohortkit.plans.notes import _TOKENS_SQL
from cohortkit.plans.standins import StandIns
from cohortkit.sources.io import materialize

SQL: dict[str, str] = {}

SEED = 42
STAY_COLUMNS = ("los", "age", "gender", "seq_num")
FOREST_TREES = 100
GBT_ROUNDS = 30
GBT_STEP = 0.1
MLP_LAYERS = (64, 64, 64, 10)
# gradient learners: rows of an epoch come in BATCHES mini-batches
BATCHES = 4
LOG_STEP, LOG_TOL, LOG_EPOCHS = 1.0, 1e-3, 2000
CURVE_HIDDEN, CURVE_STEP, CURVE_EPOCHS = (64, 64), 0.005, 10
LABEL_STEP, LABEL_EPOCHS = 0.05, 10
# long boosting: rounds of the registered keys, rounds between checkpoints, rounds without a better test error
BOOST_ROUNDS, BOOST_INTERVAL, BOOST_PATIENCE = 10, 5, 500


def _embeddings(spark: SparkSession, base: str):
    e = StandIns(spark, base).t("embeddings", "vec_id", "embedding", "label")
    e = hash_split(ML.with_features(e, array_col="embedding"), "vec_id", 0.2)
    return e.where(F.col("split") == "train"), e.where(F.col("split") == "test")


def _stays(spark: SparkSession, base: str):
    s = hash_split(extracts.stay_features(spark, base), "l_orderkey", 0.2)
    s = ML.with_features(s, STAY_COLUMNS)
    return s.where(F.col("split") == "train"), s.where(F.col("split") == "test")


def _report(model, test: DataFrame, keys) -> DataFrame:
    return classification_report(ML.score(model, test, keys, "label"), "label", "prediction")


def clf_logreg(spark: SparkSession, base: str) -> DataFrame:
    train, test = _embeddings(spark, base)
    return _report(ML.fit("logreg", train, "label", maxIter=50), test, ["vec_id"])


def clf_forest(spark: SparkSession, base: str) -> DataFrame:
    train, test = _stays(spark, base)
    m = ML.fit("forest", train, "label", balanced=True, numTrees=FOREST_TREES, seed=SEED)
    return _report(m, test, ["l_orderkey", "l_linenumber"])


def clf_gbt(spark: SparkSession, base: str) -> DataFrame:
    train, test = _stays(spark, base)
    m = ML.fit("gbt", train, "label", balanced=True, maxIter=GBT_ROUNDS, stepSize=GBT_STEP, seed=SEED)
    return _report(m, test, ["l_orderkey", "l_linenumber"])


def clf_mlp(spark: SparkSession, base: str) -> DataFrame:
    train, test = _embeddings(spark, base)
    m = ML.fit("mlp", train, "label", layers=list(MLP_LAYERS), maxIter=100, seed=SEED)
    return _report(m, test, ["vec_id"])


def learning_curve(spark: SparkSession, base: str) -> DataFrame:
    """Test log-loss after each boosting round, and the logistic model's objective per iteration."""
    train, test = _stays(spark, base)
    gbt = ML.fit("gbt", train, "label", balanced=True, maxIter=GBT_ROUNDS, stepSize=GBT_STEP, seed=SEED)
    g = gbt.evaluateEachIteration(test.withColumn("__label", F.col("label").cast("double"))
                                  .withColumn("__w", F.lit(1.0)))
    etrain, _ = _embeddings(spark, base)
    lr = ML.fit("logreg", etrain, "label", maxIter=50)
    return ML.loss_curve(spark, "gbt_test_logloss", g).unionByName(
        ML.loss_curve(spark, "logreg_objective", lr.summary.objectiveHistory))


def _scaled_stays(spark: SparkSession, base: str):
    """Stay features scaled by the training rows' mean and deviation, as arrays, written once; (train, test)."""
    s = materialize(hash_split(extracts.stay_features(spark, base), "l_orderkey", 0.2), name="stays")
    fitted = s.where(F.col("split") == "train")
    for c in STAY_COLUMNS:
        s = standard_scale(s, c, fitted, f"{c}_scaled", digits=None)
    s = s.withColumn("features", F.array(*[F.col(f"{c}_scaled") for c in STAY_COLUMNS]))
    complete = s.na.drop(subset=[*STAY_COLUMNS, "label"])
    return complete.where(F.col("split") == "train"), complete.where(F.col("split") == "test")


def _log_fit(spark: SparkSession, base: str):
    train, test = _scaled_stays(spark, base)
    rows = G.training_rows(train, "l_orderkey", "features", "label", BATCHES, balanced=True)
    net, history = G.fit_net(rows, G.new_net((len(STAY_COLUMNS), 2), SEED), LOG_EPOCHS, BATCHES, LOG_STEP, "sgd", tol=LOG_TOL)
    return test, net, history


def clf_logreg_balanced(spark: SparkSession, base: str) -> DataFrame:
    """Report on held-out rows of log-loss regression by constant gradient steps with balanced class weights."""
    test, net, _ = _log_fit(spark, base)
    return classification_report(G.predict_net(test, net, "features"), "label", "prediction")


def _curve(spark: SparkSession, history: list[dict]) -> DataFrame:
    return spark.createDataFrame([(h["epoch"], *(None if h[c] is None else round(float(h[c]), 6) for c in ("loss", "train_accuracy", "test_accuracy")))
                                  for h in history], "epoch int, loss double, train_accuracy double, test_accuracy double")


def logreg_loss_curve(spark: SparkSession, base: str) -> DataFrame:
    """Loss and training accuracy of each epoch of the balanced log-loss regression, until the loss stops falling."""
    return _curve(spark, _log_fit(spark, base)[2])


def mlp_loss_curve(spark: SparkSession, base: str) -> DataFrame:
    """Loss, training and held-out accuracy of each epoch of a perceptron with two hidden layers of 64, gone on with epoch by epoch."""
    train, test = _scaled_stays(spark, base)
    rows = G.training_rows(train, "l_orderkey", "features", "label", BATCHES)
    held = G.scored_rows(test, "features", "label")
    net, history = G.new_net((len(STAY_COLUMNS), *CURVE_HIDDEN, 2), SEED), []
    for _ in range(CURVE_EPOCHS):
        net, entry = G.fit_net(rows, net, 1, BATCHES, CURVE_STEP, "adam", test=held)
        history += entry
    return _curve(spark, history)


def _boosted(spark: SparkSession, base: str, rounds: int):
    train, test = _scaled_stays(spark, base)
    rows = train.unionByName(test).withColumn("held", F.col("split") == "test")
    weights = {r[0]: r[1] for r in train.groupBy("label").count().collect()}
    positive = weights.get(0, 0) / weights[1] if weights.get(1) else 1.0
    return rows, *boosting.fit_boosted(rows, "features", "label", "held", len(STAY_COLUMNS), rounds=rounds, rate=GBT_STEP,
                                       positive_weight=positive, interval=BOOST_INTERVAL, patience=BOOST_PATIENCE)


def boost_error_curve(spark: SparkSession, base: str, rounds: int = BOOST_ROUNDS) -> DataFrame:
    """Training and held-out error after each boosting round, checkpointed on the way; ``rounds`` may be thousands."""
    _, _, history = _boosted(spark, base, rounds)
    return spark.createDataFrame([(h["round"], *(None if h[c] is None else round(h[c], 6) for c in ("train_error", "test_error"))) for h in history],
                                 "round int, train_error double, test_error double")


def clf_boosted(spark: SparkSession, base: str, rounds: int = BOOST_ROUNDS) -> DataFrame:
    """Report on held-out rows of the boosted trees, positives weighted by negatives / positives."""
    rows, model, _ = _boosted(spark, base, rounds)
    return classification_report(boosting.predict_boosted(rows.where("held"), model, "features"), "label", "prediction")


def score_rows(spark: SparkSession, base: str) -> DataFrame:
    """Forest scores for the held-out rows, written once as a stage and read back."""
    train, test = _stays(spark, base)
    m = ML.fit("forest", train, "label", balanced=True, numTrees=FOREST_TREES, seed=SEED)
    return materialize(ML.score(m, test, ["l_orderkey", "l_linenumber"]), name="scores")


def _corpus(spark: SparkSession, base: str) -> DataFrame:
    docs = StandIns(spark, base).t("documents", "doc_id", "text")
    return T.entity_corpus(docs, "doc_id", "text").where(F.size("entities") > 0)


def word2vec_vectors(spark: SparkSession, base: str) -> DataFrame:
    """Word2Vec (min count 1) on the entity corpus: one vector per entity string."""
    model = ML.word2vec(_corpus(spark, base), "entities", seed=SEED)
    return model.getVectors().select("word", vector_to_array("vector").alias("vector"))


def word2vec_similar(spark: SparkSession, base: str) -> DataFrame:
    """Ten nearest words to the corpus' most frequent entity."""
    corpus = _corpus(spark, base)
    model = ML.word2vec(corpus, "entities", seed=SEED)
    words = corpus.select(F.explode("entities").alias("w"))
    query = top_k_keys(words, "w", 1).first()[0]
    return model.findSynonyms(query, 10).select(F.lit(query).alias("query"), "word",
                                                F.round("similarity", 6).alias("similarity"))


def pca_projection(spark: SparkSession, base: str) -> DataFrame:
    """2-D projection of the embeddings (the t-SNE plots' re-aim)."""
    e = ML.with_features(StandIns(spark, base).t("embeddings", "vec_id", "embedding", "label"), array_col="embedding")
    _, out = ML.pca(e, 2)
    arr = vector_to_array("pc")
    return out.select("vec_id", "label", F.round(arr[0], 6).alias("x"), F.round(arr[1], 6).alias("y"))


def note_features(spark: SparkSession, base: str) -> DataFrame:
    """TF-IDF note features over all terms — the classifier inputs in place of transformer states."""
    return T.tfidf_terms(StandIns(spark, base).t("documents", "doc_id", "text"), "doc_id", "text")


SQL["note_features"] = f"""
WITH tf AS (SELECT doc_id, term, count(*) AS tf
            FROM (SELECT doc_id, unnest({_TOKENS_SQL}) AS term FROM documents) GROUP BY doc_id, term),
     f AS (SELECT term, count(*) AS df FROM tf GROUP BY term), n AS (SELECT count(*) AS total FROM documents)
SELECT doc_id, tf.term, tf, df, round(tf * ln((total + 1) / (df + 1)), 6) AS weight
FROM tf JOIN f ON tf.term = f.term, n
"""

def _note_weights(spark: SparkSession, base: str):
    docs = StandIns(spark, base).t("documents", "doc_id", "text")
    return docs, *T.tfidf_terms(docs, "doc_id", "text", listed=True)


def note_vectors(spark: SparkSession, base: str) -> DataFrame:
    """Each note's sparse TF-IDF vector over the whole vocabulary: its size, term numbers and weights."""
    docs, weights, vocabulary = _note_weights(spark, base)
    vectors, _ = T.sparse_vectors(docs, "doc_id", weights, vocabulary=vocabulary, listed="entries")
    v = F.unwrap_udt("features")
    return vectors.select("doc_id", v["size"].alias("size"), v["indices"].alias("indices"), v["values"].alias("values"))


SQL["note_vectors"] = f"""
WITH w AS ({SQL["note_features"]}),
     v AS (SELECT term, CAST(row_number() OVER (ORDER BY term) - 1 AS INTEGER) AS idx FROM (SELECT DISTINCT term FROM w)),
     l AS (SELECT doc_id, list(idx ORDER BY idx) AS i, list(weight ORDER BY idx) AS x FROM w JOIN v ON w.term = v.term GROUP BY doc_id)
SELECT d.doc_id, CAST((SELECT count(*) FROM v) AS INTEGER) AS size, coalesce(i, []) AS indices, coalesce(x, []) AS values
FROM documents d LEFT JOIN l ON d.doc_id = l.doc_id"""


def clf_notes(spark: SparkSession, base: str) -> DataFrame:
    """Report on held-out notes of a balanced logistic regression on their sparse TF-IDF vectors (whole vocabulary)."""
    docs, weights, vocabulary = _note_weights(spark, base)
    vectors, _ = T.sparse_vectors(docs, "doc_id", weights, vocabulary=vocabulary, listed="entries")
    labels = StandIns(spark, base).t("labels", "doc_id", F.col("quality").alias("label")).where(F.col("label").isNotNull())
    rows = hash_split(vectors.join(labels, "doc_id"), "doc_id", 0.2)
    train, test = (rows.where(F.col("split") == s) for s in ("train", "test"))
    if sorted(r[0] for r in train.select("label").distinct().limit(3).collect()) == [0, 1]:
        scored, _ = logistic_scores(train, test, "label", max_iter=30, reg=0.001, balanced=True)
        return classification_report(scored, "label", "prediction")
    model = ML.fit("logreg", train, "label", balanced=True, maxIter=30, regParam=0.001)
    return _report(model, test, ["doc_id"])


def _basket_rows(spark: SparkSession, base: str):
    """((patient, x, y): features and item numbers, (item, idx)): every item is a label."""
    st = StandIns(spark, base)
    items = materialize(sequences._patient_items(st).select("o_custkey", "p_name").where("p_name IS NOT NULL"), name="basket-items")
    vocab = materialize(global_index(items.select("p_name").distinct(), ["p_name"], "idx"), name="basket-vocabulary")
    coded = items.withColumn("idx", per_class(vocab, "p_name", "idx").cast("int"))
    per = coded.groupBy("o_custkey").agg(F.sort_array(F.collect_set("idx")).alias("y"), F.count(F.lit(1)).alias("n"))
    people = st.t("customer", F.col("c_custkey").alias("o_custkey"), "c_acctbal", "c_mktsegment")
    segments = [F.coalesce((F.col("c_mktsegment") == s).cast("double"), F.lit(0.0)) for s in extracts.SEGMENTS]
    x = F.array(F.log1p("n"), F.coalesce(F.col("c_acctbal") / 10000.0, F.lit(0.0)), *segments)
    return materialize(per.join(people, "o_custkey").select("o_custkey", x.alias("x"), "y"), name="basket-rows"), vocab


def _basket_fit(spark: SparkSession, base: str):
    rows, vocab = _basket_rows(spark, base)
    split = hash_split(rows, "o_custkey", 0.2)
    n_labels = vocab.count()
    train = G.training_rows(split.where(F.col("split") == "train"), "o_custkey", "x", "y", BATCHES)
    net = G.new_net((2 + len(extracts.SEGMENTS), n_labels), SEED, multi=True)
    return (split, vocab, *G.fit_net(train, net, LABEL_EPOCHS, BATCHES, LABEL_STEP))


def multilabel_loss_curve(spark: SparkSession, base: str) -> DataFrame:
    """Loss (summed over all items) and exact matches of each epoch of the scorer that fits every item in one pass."""
    return _curve(spark, _basket_fit(spark, base)[3])


def _basket_predictions(spark: SparkSession, base: str):
    split, vocab, net, _ = _basket_fit(spark, base)
    return materialize(G.predict_labels(split, net, "x"), name="basket-predictions"), vocab


def multilabel_learned(spark: SparkSession, base: str) -> DataFrame:
    """Micro precision, recall and F1 over all (patient, item) cells of the learned scorer, by split."""
    out, _ = _basket_predictions(spark, base)
    hits, said, held = (F.sum(F.size(c)) for c in (F.array_intersect("y", "predicted"), F.col("predicted"), F.col("y")))
    counts = out.groupBy("split").agg(hits.alias("tp"), (said - hits).alias("fp"), (held - hits).alias("fn"), held.alias("support"))
    return prf(counts, keep=["split"])


def rank_compare_learned(spark: SparkSession, base: str) -> DataFrame:
    """The 20 items with most patients and the 20 most often predicted over all items, ranks joined in full."""
    out, vocab = _basket_predictions(spark, base)

    def ranked(column: str, what: str) -> DataFrame:
        counts = out.select(F.explode(column).alias("idx")).groupBy("idx").agg(F.count(F.lit(1)).alias(f"{what}_n"))
        top = counts.join(vocab.withColumnRenamed("p_name", "item"), "idx").orderBy(F.desc(f"{what}_n"), "item").limit(sequences.N_TARGETS)
        return top.select("item", f"{what}_n", F.row_number().over(Window.orderBy(F.desc(f"{what}_n"), "item")).alias(f"{what}_rank"))

    return ranked("y", "actual").join(ranked("predicted", "predicted"), "item", "full")


QUERIES = {
    "clf_logreg": clf_logreg,
    "clf_forest": clf_forest,
    "clf_gbt": clf_gbt,
    "clf_mlp": clf_mlp,
    "learning_curve": learning_curve,
    "clf_logreg_balanced": clf_logreg_balanced,
    "logreg_loss_curve": logreg_loss_curve,
    "mlp_loss_curve": mlp_loss_curve,
    "boost_error_curve": boost_error_curve,
    "clf_boosted": clf_boosted,
    "score_rows": score_rows,
    "word2vec_vectors": word2vec_vectors,
    "word2vec_similar": word2vec_similar,
    "pca_projection": pca_projection,
    "note_features": note_features,
    "note_vectors": note_vectors,
    "clf_notes": clf_notes,
    "multilabel_loss_curve": multilabel_loss_curve,
    "multilabel_learned": multilabel_learned,
    "rank_compare_learned": rank_compare_learned,
}

#: Keys that fit no model.
UNFITTED = {"note_features", "note_vectors"}
