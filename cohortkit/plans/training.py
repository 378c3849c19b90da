"""Training-set preparation and evaluation keys.

Samples and splits hash the key (md5), so they are reproducible across runs,
partitionings and engines. Fake predictions for the metric keys are also
md5-derived, so the metric arithmetic can be checked exactly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortkit.functions.rules import value_map
from cohortkit.functions.scalar import hash_fraction
from cohortkit.operators import features as FE
from cohortkit.operators import metrics as M
from cohortkit.plans import extracts
from cohortkit.plans.sequences import N_TARGETS, _patient_items, _top_items
from cohortkit.plans.standins import StandIns

SQL: dict[str, str] = {}

SAMPLE_N = 1000
N_BATCHES = 20
SAMPLE_FRACTION = 0.1
TEST_FRACTION = 0.2
KEEP_MAJORITY = 0.25
PER_CLASS = 2100
QUALITY_NAMES = {1: "high", 0: "low"}
PRED_CORRECT = 0.8
POS_BOOST = 0.35


def _hf_sql(key: str, seed: str = "42") -> str:
    return f"((('0x' || substr(md5('{seed}:' || CAST({key} AS VARCHAR)), 1, 8))::BIGINT) / 4294967296.0)"


# ----------------------------------------------------------------- sampling and splits
def sample_first_n(spark: SparkSession, base: str) -> DataFrame:
    """First ``SAMPLE_N`` notes by id, cut into ``N_BATCHES`` equal batches (remainder dropped).

    The window numbers at most ``SAMPLE_N`` rows (after the limit), so it
    is bounded whatever the table size.
    """
    d = StandIns(spark, base).t("documents", "doc_id")
    taken = d.orderBy("doc_id").limit(SAMPLE_N)
    size = F.floor(taken.agg(F.count(F.lit(1))).scalar() / N_BATCHES)
    rn = F.row_number().over(Window.orderBy("doc_id")) - 1
    out = taken.withColumn("_rn", rn)
    return out.where((size > 0) & (F.col("_rn") < size * N_BATCHES)) \
        .select("doc_id", F.floor(F.col("_rn") / size).cast("int").alias("batch"))


SQL["sample_first_n"] = f"""
WITH t AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS rn FROM (SELECT doc_id FROM documents ORDER BY doc_id LIMIT {SAMPLE_N})),
     s AS (SELECT floor(count(*) / {N_BATCHES}) AS size FROM t)
SELECT doc_id, CAST(floor(rn / size) AS INTEGER) AS batch FROM t, s WHERE size > 0 AND rn < size * {N_BATCHES}
"""


def sample_fraction(spark: SparkSession, base: str) -> DataFrame:
    return FE.hash_sample(StandIns(spark, base).t("documents", "doc_id"), "doc_id", SAMPLE_FRACTION)


SQL["sample_fraction"] = f"SELECT doc_id FROM documents WHERE {_hf_sql('doc_id')} < {SAMPLE_FRACTION}"


def hash_split(spark: SparkSession, base: str) -> DataFrame:
    return FE.hash_split(StandIns(spark, base).t("documents", "doc_id"), "doc_id", TEST_FRACTION)


SQL["hash_split"] = f"""SELECT doc_id, CASE WHEN {_hf_sql('doc_id')} < {TEST_FRACTION} THEN 'test' ELSE 'train' END AS split
FROM documents"""


def downsample_majority(spark: SparkSession, base: str) -> DataFrame:
    lab = StandIns(spark, base).t("labels", "doc_id", "quality")
    return FE.downsample_majority(lab, "quality", "doc_id", KEEP_MAJORITY)


SQL["downsample_majority"] = f"""
WITH m AS (SELECT quality FROM labels GROUP BY quality ORDER BY count(*) DESC, quality LIMIT 1)
SELECT doc_id, quality FROM labels
WHERE quality IS DISTINCT FROM (SELECT quality FROM m) OR {_hf_sql('doc_id')} < {KEEP_MAJORITY}
"""


def balance_classes(spark: SparkSession, base: str) -> DataFrame:
    e = StandIns(spark, base).t("events", "event_id", "event_type")
    return FE.balance_classes(e, "event_type", "event_id", PER_CLASS)


SQL["balance_classes"] = f"""
WITH c AS (SELECT event_type, count(*) AS cnt FROM events GROUP BY event_type),
     x AS (SELECT e.event_id, e.event_type, {_hf_sql('e.event_id')} AS hf,
                  unnest(range(0, greatest(1, CAST(ceil({PER_CLASS} / c.cnt) AS BIGINT)))) AS copy
           FROM events e JOIN c ON e.event_type = c.event_type),
     r AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY copy, hf, event_id) AS rn FROM x)
SELECT event_id, event_type, CAST(copy AS INTEGER) AS copy FROM r WHERE rn <= {PER_CLASS}
"""


def class_weights(spark: SparkSession, base: str) -> DataFrame:
    return FE.class_weights(StandIns(spark, base).t("labels", "quality"), "quality")


SQL["class_weights"] = """
WITH c AS (SELECT quality, count(*) AS n FROM labels WHERE quality IS NOT NULL GROUP BY quality)
SELECT quality, n, round((SELECT sum(n) FROM c) / ((SELECT count(*) FROM c) * n), 6) AS weight,
       round((SELECT sum(n) FROM c WHERE quality = 0) / (SELECT sum(n) FROM c WHERE quality = 1), 6) AS pos_weight
FROM c
"""


def label_dataset(spark: SparkSession, base: str) -> DataFrame:
    """Notes joined to labels, unlabelled dropped, label mapped to a name, counted per class."""
    st = StandIns(spark, base)
    j = st.t("documents", "doc_id").join(st.t("labels", "doc_id", "quality"), "doc_id").na.drop(subset=["quality"])
    j = j.withColumn("label", value_map(QUALITY_NAMES, "quality")).na.drop(subset=["label"])
    return j.groupBy("label").agg(F.count(F.lit(1)).alias("n"))


SQL["label_dataset"] = """
SELECT CASE WHEN l.quality = 1 THEN 'high' WHEN l.quality = 0 THEN 'low' END AS label, count(*) AS n
FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE l.quality IN (0, 1) GROUP BY ALL
"""


# ----------------------------------------------------------------- encoding and scaling
def label_encode(spark: SparkSession, base: str) -> DataFrame:
    e = StandIns(spark, base).t("events", "event_id", "event_type")
    return FE.label_encode(e, "event_type").select("event_id", "event_type", "label_index")


SQL["label_encode"] = """
WITH v AS (SELECT event_type, CAST(row_number() OVER (ORDER BY event_type) - 1 AS INTEGER) AS label_index
           FROM (SELECT DISTINCT event_type FROM events WHERE event_type IS NOT NULL))
SELECT e.event_id, e.event_type, v.label_index FROM events e LEFT JOIN v ON e.event_type = v.event_type
"""


def minmax_scale(spark: SparkSession, base: str) -> DataFrame:
    e = StandIns(spark, base).t("events", "event_id", "value")
    return FE.minmax_scale(e, "value").select("event_id", "scaled")


SQL["minmax_scale"] = """
WITH m AS (SELECT min(value) AS mn, max(value) AS mx FROM events)
SELECT event_id, round(CASE WHEN mx > mn THEN (value - mn) / (mx - mn) ELSE 0.0 END, 6) AS scaled FROM events, m
"""


def standard_scale(spark: SparkSession, base: str) -> DataFrame:
    """Scale every row with the mean and population std of the training rows only."""
    e = FE.hash_split(StandIns(spark, base).t("events", "event_id", "value"), "event_id", TEST_FRACTION)
    return FE.standard_scale(e, "value", e.where(F.col("split") == "train")).select("event_id", "split", "scaled")


SQL["standard_scale"] = f"""
WITH e AS (SELECT event_id, value, CASE WHEN {_hf_sql('event_id')} < {TEST_FRACTION} THEN 'test' ELSE 'train' END AS split FROM events),
     s AS (SELECT avg(value) AS mu, stddev_pop(value) AS sd FROM e WHERE split = 'train')
SELECT event_id, split, round(CASE WHEN sd > 0 THEN (value - mu) / sd ELSE 0.0 END, 6) AS scaled FROM e, s
"""


# ----------------------------------------------------------------- evaluation
def _scored_notes(spark: SparkSession, base: str) -> DataFrame:
    st = StandIns(spark, base)
    j = st.t("documents", "doc_id").join(st.t("labels", "doc_id", "quality"), "doc_id").na.drop(subset=["quality"])
    pred = F.when(hash_fraction("doc_id", "pred") < PRED_CORRECT, F.col("quality")).otherwise(1 - F.col("quality"))
    return j.select("doc_id", F.col("quality").alias("y"), pred.alias("p"))


def classification_report(spark: SparkSession, base: str) -> DataFrame:
    return M.classification_report(_scored_notes(spark, base), "y", "p")


SQL["classification_report"] = f"""
WITH s AS (SELECT l.quality AS y, CASE WHEN {_hf_sql('d.doc_id', 'pred')} < {PRED_CORRECT} THEN l.quality ELSE 1 - l.quality END AS p
           FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE l.quality IS NOT NULL),
     cls AS (SELECT y AS c FROM s UNION SELECT p FROM s),
     per AS (SELECT c, (SELECT count(*) FROM s WHERE y = c) AS support, (SELECT count(*) FROM s WHERE p = c) AS npred,
                    (SELECT count(*) FROM s WHERE y = c AND p = c) AS tp FROM cls),
     m AS (SELECT c, support, tp, coalesce(tp / nullif(npred, 0), 0.0) AS pr, coalesce(tp / nullif(support, 0), 0.0) AS rc FROM per),
     f AS (SELECT *, coalesce(2 * pr * rc / nullif(pr + rc, 0), 0.0) AS f1 FROM m),
     t AS (SELECT CAST(sum(support) AS BIGINT) AS total, sum(tp) AS correct, count(*) AS k FROM f)
SELECT CAST(c AS VARCHAR) AS cls, round(pr, 6) AS precision, round(rc, 6) AS recall, round(f1, 6) AS f1, support FROM f
UNION ALL SELECT 'accuracy', NULL, NULL, round(correct / total, 6), total FROM t
UNION ALL SELECT 'macro avg', round(sum(pr) / k, 6), round(sum(rc) / k, 6), round(sum(f1) / k, 6), CAST(sum(support) AS BIGINT) FROM f, t GROUP BY k
UNION ALL SELECT 'weighted avg', round(sum(pr * support) / total, 6), round(sum(rc * support) / total, 6),
                 round(sum(f1 * support) / total, 6), CAST(sum(support) AS BIGINT) FROM f, t GROUP BY total
"""


def _multilabel(spark: SparkSession, base: str) -> DataFrame:
    """(patient, target) cells for the top-20 items: actual presence, a fake score, the prediction.

    Cells are generated per patient with ``explode(sequence(0, 19))`` — a
    generator over a fixed 20 — and matched to the patient's items by an
    equi-join; no cross product.
    """
    st = StandIns(spark, base)
    top = _top_items(st)
    items = _patient_items(st).select("o_custkey", "p_name")
    have = items.join(F.broadcast(top), "p_name").select("o_custkey", "target").distinct() \
        .withColumn("actual", F.lit(1))
    pats = items.select("o_custkey").distinct()
    cells = pats.select("o_custkey", F.explode(F.sequence(F.lit(0), F.lit(N_TARGETS - 1))).alias("target"))
    c = cells.join(have, ["o_custkey", "target"], "left").na.fill(0, ["actual"])
    key = F.concat_ws(":", F.col("o_custkey").cast("string"), F.col("target").cast("string"))
    score = F.round(F.lit(POS_BOOST) * F.col("actual") + F.lit(1 - POS_BOOST) * hash_fraction(key, "score"), 6)
    c = c.withColumn("score", score)
    return c.withColumn("predicted", (F.col("score") > 0.5).cast("int"))


_ML_SQL = f"""
WITH r AS (SELECT o.o_custkey, p.p_name FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
           JOIN orders o ON l.l_orderkey = o.o_orderkey),
  top AS (SELECT p_name, CAST(row_number() OVER (ORDER BY n DESC, p_name) - 1 AS INTEGER) AS target
          FROM (SELECT p_name, count(*) AS n FROM r GROUP BY p_name ORDER BY n DESC, p_name LIMIT {N_TARGETS})),
  h AS (SELECT DISTINCT r.o_custkey, top.target FROM r JOIN top ON r.p_name = top.p_name),
  pats AS (SELECT DISTINCT o_custkey FROM r),
  cells AS (SELECT o_custkey, CAST(unnest(range(0, {N_TARGETS})) AS INTEGER) AS target FROM pats),
  a AS (SELECT c.o_custkey, c.target, CAST(CASE WHEN h.target IS NULL THEN 0 ELSE 1 END AS INTEGER) AS actual
        FROM cells c LEFT JOIN h ON c.o_custkey = h.o_custkey AND c.target = h.target),
  sc AS (SELECT *, round({POS_BOOST} * actual + {1 - POS_BOOST} *
                 ((('0x' || substr(md5('score:' || CAST(o_custkey AS VARCHAR) || ':' || CAST(target AS VARCHAR)), 1, 8))::BIGINT) / 4294967296.0), 6) AS score FROM a),
  ml AS (SELECT *, CAST(score > 0.5 AS INTEGER) AS predicted FROM sc)
"""


def multilabel_threshold(spark: SparkSession, base: str) -> DataFrame:
    return _multilabel(spark, base).select("o_custkey", "target", "actual", "score", "predicted")


SQL["multilabel_threshold"] = _ML_SQL + "SELECT o_custkey, target, actual, score, predicted FROM ml"

_PRF_SQL = """count(*) FILTER (WHERE actual = 1 AND predicted = 1) AS tp, count(*) FILTER (WHERE actual = 0 AND predicted = 1) AS fp,
    count(*) FILTER (WHERE actual = 1 AND predicted = 0) AS fn, count(*) FILTER (WHERE actual = 1) AS support"""
_PRF_OUT = """tp, fp, fn, support, round(coalesce(tp / nullif(tp + fp, 0), 0.0), 6) AS precision,
    round(coalesce(tp / nullif(tp + fn, 0), 0.0), 6) AS recall,
    round(coalesce(2 * (tp / nullif(tp + fp, 0)) * (tp / nullif(tp + fn, 0))
                   / nullif(tp / nullif(tp + fp, 0) + tp / nullif(tp + fn, 0), 0), 0.0), 6) AS f1"""


def multilabel_micro(spark: SparkSession, base: str) -> DataFrame:
    return M.prf(M.multilabel_counts(_multilabel(spark, base), "actual", "predicted"))


SQL["multilabel_micro"] = _ML_SQL + f", t AS (SELECT {_PRF_SQL} FROM ml) SELECT {_PRF_OUT} FROM t"


def multilabel_per_label(spark: SparkSession, base: str) -> DataFrame:
    c = M.multilabel_counts(_multilabel(spark, base), "actual", "predicted", by=["target"])
    return M.prf(c, keep=["target"])


SQL["multilabel_per_label"] = _ML_SQL + f", t AS (SELECT target, {_PRF_SQL} FROM ml GROUP BY target) SELECT target, {_PRF_OUT} FROM t"


def multilabel_exact(spark: SparkSession, base: str) -> DataFrame:
    return M.subset_accuracy(_multilabel(spark, base), "o_custkey", "actual", "predicted")


SQL["multilabel_exact"] = _ML_SQL + """,
  p AS (SELECT o_custkey, bool_and(actual = predicted) AS exact FROM ml GROUP BY o_custkey),
  t AS (SELECT count(*) AS n_rows, count(*) FILTER (WHERE exact) AS n_exact FROM p)
SELECT n_rows, n_exact, round(coalesce(n_exact / nullif(n_rows, 0), 0.0), 6) AS subset_accuracy FROM t"""


def multilabel_means(spark: SparkSession, base: str) -> DataFrame:
    return M.label_means(multilabel_per_label(spark, base))


SQL["multilabel_means"] = _ML_SQL + f""", t AS (SELECT target, {_PRF_SQL} FROM ml GROUP BY target),
  per AS (SELECT target, {_PRF_OUT} FROM t)
SELECT count(*) AS n_labels, round(avg(precision), 6) AS mean_precision, round(avg(recall), 6) AS mean_recall,
       round(avg(f1), 6) AS mean_f1 FROM per"""


def label_roundtrip(spark: SparkSession, base: str) -> DataFrame:
    """Event classes as indices and back from the fitted vocabulary."""
    e = StandIns(spark, base).t("events", "event_id", "event_type")
    vocab = FE.label_index(e, "event_type", "idx")
    coded = e.withColumn("idx", FE.per_class(vocab, "event_type", "idx")).drop("event_type")
    return FE.label_decode(coded, vocab, "idx", "event_type")


SQL["label_roundtrip"] = """
WITH v AS (SELECT event_type, CAST(row_number() OVER (ORDER BY event_type) - 1 AS INTEGER) AS idx
           FROM (SELECT DISTINCT event_type FROM events WHERE event_type IS NOT NULL))
SELECT e.event_id, v.idx, v.event_type FROM events e LEFT JOIN v ON e.event_type = v.event_type"""


def demographics_scaled(spark: SparkSession, base: str) -> DataFrame:
    """Demographic model inputs of the cohort's rows: age scaled to 0..1 and the encoded gender."""
    s = extracts.stay_features(spark, base).select("l_orderkey", "l_linenumber", "age", "gender")
    return FE.minmax_scale(s, "age", "age_scaled")


SQL["demographics_scaled"] = f"""
WITH s AS ({extracts.SQL["stay_features"]}), r AS (SELECT min(age) AS mn, max(age) AS mx FROM s)
SELECT l_orderkey, l_linenumber, age, gender,
       CASE WHEN mx > mn THEN round((age - mn) / (mx - mn), 6) ELSE 0.0 END AS age_scaled FROM s, r"""


def rank_compare(spark: SparkSession, base: str) -> DataFrame:
    """Rank of each top item by actual vs predicted patient counts (window over ≤ 20 rows)."""
    st = StandIns(spark, base)
    ml = _multilabel(spark, base)
    per = ml.groupBy("target").agg(F.sum("actual").cast("bigint").alias("actual_n"),
                                   F.sum("predicted").cast("bigint").alias("predicted_n"))
    a = per.select("target", "actual_n",
                   F.row_number().over(Window.orderBy(F.desc("actual_n"), "target")).alias("actual_rank"))
    p = per.select("target", "predicted_n",
                   F.row_number().over(Window.orderBy(F.desc("predicted_n"), "target")).alias("predicted_rank"))
    j = a.join(p, "target", "full").join(F.broadcast(_top_items(st)), "target", "left")
    return j.select("target", F.col("p_name").alias("item"), "actual_n", "predicted_n", "actual_rank", "predicted_rank")


SQL["rank_compare"] = _ML_SQL + """,
  per AS (SELECT target, CAST(sum(actual) AS BIGINT) AS actual_n, CAST(sum(predicted) AS BIGINT) AS predicted_n FROM ml GROUP BY target),
  ra AS (SELECT target, actual_n, CAST(row_number() OVER (ORDER BY actual_n DESC, target) AS INTEGER) AS actual_rank FROM per),
  rp AS (SELECT target, predicted_n, CAST(row_number() OVER (ORDER BY predicted_n DESC, target) AS INTEGER) AS predicted_rank FROM per)
SELECT coalesce(ra.target, rp.target) AS target, top.p_name AS item, ra.actual_n, rp.predicted_n, ra.actual_rank, rp.predicted_rank
FROM ra FULL JOIN rp ON ra.target = rp.target LEFT JOIN top ON coalesce(ra.target, rp.target) = top.target
"""

QUERIES = {
    "sample_first_n": sample_first_n,
    "sample_fraction": sample_fraction,
    "hash_split": hash_split,
    "downsample_majority": downsample_majority,
    "balance_classes": balance_classes,
    "class_weights": class_weights,
    "label_dataset": label_dataset,
    "label_encode": label_encode,
    "minmax_scale": minmax_scale,
    "standard_scale": standard_scale,
    "classification_report": classification_report,
    "multilabel_threshold": multilabel_threshold,
    "multilabel_micro": multilabel_micro,
    "multilabel_per_label": multilabel_per_label,
    "multilabel_exact": multilabel_exact,
    "multilabel_means": multilabel_means,
    "label_roundtrip": label_roundtrip,
    "demographics_scaled": demographics_scaled,
    "rank_compare": rank_compare,
}
