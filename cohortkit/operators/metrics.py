"""Classification metrics from confusion counts.

All metrics reduce the scored rows once — ``groupBy(label, prediction)`` or
sums of tp/fp/fn — and then do arithmetic on a table of at most
classes² rows. Zero divisions give 0 (``zero_division=0``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _safe_div(a, b) -> Column:
    return F.coalesce(a / F.nullif(b, F.lit(0)), F.lit(0.0))


def _f1(p, r) -> Column:
    return _safe_div(2.0 * p * r, p + r)


def confusion(df: DataFrame, label: str, pred: str) -> DataFrame:
    return df.groupBy(F.col(label).alias("label"), F.col(pred).alias("pred")).agg(F.count(F.lit(1)).alias("n"))


def classification_report(df: DataFrame, label: str, pred: str, digits: int = 6) -> DataFrame:
    """Per class precision, recall, f1, support; plus accuracy, macro and weighted averages.

    Rows: one per class (``cls`` as text), then 'accuracy' (its value in
    ``f1``, precision/recall null), 'macro avg' and 'weighted avg'.

    The scored rows are reduced once to the confusion table (≤ classes²
    rows). Each confusion cell contributes to its actual class (support), its
    predicted class and, on the diagonal, to tp — one exploded aggregation
    gives the per-class counts; one more aggregation gives all summary values.
    """
    c = confusion(df, label, pred)
    contrib = F.explode(F.array(
        F.struct(F.col("label").alias("cls"), F.col("n").alias("support"), F.lit(0).cast("bigint").alias("npred"),
                 F.when(F.col("label") == F.col("pred"), F.col("n")).otherwise(0).cast("bigint").alias("tp")),
        F.struct(F.col("pred").alias("cls"), F.lit(0).cast("bigint").alias("support"), F.col("n").alias("npred"),
                 F.lit(0).cast("bigint").alias("tp"))))
    counts = c.select(contrib.alias("x")).groupBy(F.col("x.cls").alias("cls")).agg(
        F.sum("x.support").alias("support"), F.sum("x.npred").alias("npred"), F.sum("x.tp").alias("tp"))
    per = counts.select("cls", "support", "tp",
                        _safe_div(F.col("tp"), F.col("npred")).alias("precision"),
                        _safe_div(F.col("tp"), F.col("support")).alias("recall"))
    per = per.withColumn("f1", _f1(F.col("precision"), F.col("recall")))
    r = lambda x: F.round(x, digits)
    classes = per.select(F.col("cls").cast("string").alias("cls"), r(F.col("precision")).alias("precision"),
                         r(F.col("recall")).alias("recall"), r(F.col("f1")).alias("f1"),
                         F.col("support").cast("bigint").alias("support"))
    t = per.agg(F.sum("support").alias("total"), F.sum("tp").alias("correct"), F.count(F.lit(1)).alias("k"),
                F.sum("precision").alias("sp"), F.sum("recall").alias("sr"), F.sum("f1").alias("sf"),
                F.sum(F.col("precision") * F.col("support")).alias("wp"),
                F.sum(F.col("recall") * F.col("support")).alias("wr"),
                F.sum(F.col("f1") * F.col("support")).alias("wf"))
    tot = F.col("total")
    none = F.lit(None).cast("double")
    summary = F.explode(F.array(
        F.struct(F.lit("accuracy").alias("cls"), none.alias("precision"), none.alias("recall"),
                 r(F.col("correct") / tot).alias("f1")),
        F.struct(F.lit("macro avg").alias("cls"), r(F.col("sp") / F.col("k")).alias("precision"),
                 r(F.col("sr") / F.col("k")).alias("recall"), r(F.col("sf") / F.col("k")).alias("f1")),
        F.struct(F.lit("weighted avg").alias("cls"), r(F.col("wp") / tot).alias("precision"),
                 r(F.col("wr") / tot).alias("recall"), r(F.col("wf") / tot).alias("f1"))))
    rows = t.select(summary.alias("s"), tot.cast("bigint").alias("support")) \
        .select("s.cls", "s.precision", "s.recall", "s.f1", "support")
    return classes.unionByName(rows)


def multilabel_counts(df: DataFrame, actual: str, pred: str, by: list[str] | None = None) -> DataFrame:
    """tp, fp, fn (and support) over (row, label) cells, optionally per label."""
    a, p = F.col(actual) == 1, F.col(pred) == 1
    aggs = [F.count_if(a & p).alias("tp"), F.count_if(~a & p).alias("fp"),
            F.count_if(a & ~p).alias("fn"), F.count_if(a).alias("support")]
    return df.groupBy(*(by or [])).agg(*aggs)


def prf(counts: DataFrame, digits: int = 6, keep: list[str] | None = None) -> DataFrame:
    """Precision, recall and F1 from tp/fp/fn columns."""
    p = _safe_div(F.col("tp"), F.col("tp") + F.col("fp"))
    r = _safe_div(F.col("tp"), F.col("tp") + F.col("fn"))
    return counts.select(*(keep or []), "tp", "fp", "fn", "support",
                         F.round(p, digits).alias("precision"), F.round(r, digits).alias("recall"),
                         F.round(_f1(p, r), digits).alias("f1"))


def subset_accuracy(df: DataFrame, key: str, actual: str, pred: str, digits: int = 6) -> DataFrame:
    """Exact match of all labels: rows (``key``) whose labels are all predicted right, and their share.

    One row: n_rows, n_exact, subset_accuracy (0 for an empty input). Two null
    labels count as equal.
    """
    per = df.groupBy(key).agg(F.min(F.col(actual).eqNullSafe(F.col(pred))).alias("exact"))
    t = per.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if("exact").alias("n_exact"))
    return t.withColumn("subset_accuracy", F.round(_safe_div(F.col("n_exact"), F.col("n_rows")), digits))


def label_means(per_label: DataFrame, digits: int = 6) -> DataFrame:
    """Unweighted means over labels of the precision, recall and F1 of :func:`prf` rows."""
    return per_label.agg(F.count(F.lit(1)).alias("n_labels"),
                         *[F.round(F.avg(c), digits).alias(f"mean_{c}") for c in ("precision", "recall", "f1")])
