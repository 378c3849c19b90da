"""Feature preparation: encoding, scaling, deterministic splits and sampling.

* Splits and samples hash the row key (md5), so the same rows are chosen
  whatever the partitioning, after a retry, and in DuckDB.
* Statistics for scaling are scalar subqueries (one-row aggregates that
  Spark evaluates once and inlines) — never an unpartitioned window and
  never a join.
* Class balancing keeps ``row_number() <= n`` per class, which Spark plans
  with a partial ``WindowGroupLimit`` before the shuffle: each task forwards at
  most ``n`` rows per class, so a class holding a third of the data is cut
  map-side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortkit.functions.scalar import col_of, hash_fraction
from cohortkit.sources.io import materialize


def label_index(df: DataFrame, column: str, name: str = "label_index", start: int = 0) -> DataFrame:
    """Vocabulary of ``column`` in sorted order → index ``start``..; one row per distinct value.

    The window runs over the distinct values only (vocabulary-sized, like a
    fitted ``StringIndexer(stringOrderType='alphabetAsc')``).
    """
    vocab = df.select(column).where(F.col(column).isNotNull()).distinct()
    return vocab.withColumn(name, F.row_number().over(Window.orderBy(column)) - 1 + start)


def label_encode(df: DataFrame, column: str, name: str = "label_index", start: int = 0) -> DataFrame:
    """Add the sorted-vocabulary index of ``column`` (null stays null).

    For labels (few classes): the index comes from the class table as one
    map, so detail rows are not shuffled on a handful of values.
    """
    return df.withColumn(name, per_class(label_index(df, column, name, start), column, name))


def label_decode(df: DataFrame, vocab: DataFrame, index: str, column: str) -> DataFrame:
    """Inverse of :func:`label_encode`: add ``column`` from the fitted ``vocab`` (``column``, ``index``).

    ``vocab`` holds the classes of a label (one row each); detail rows are not
    shuffled. An index that is null or not in ``vocab`` gives null.
    """
    return df.withColumn(column, per_class(vocab, index, column))


def minmax_scale(df: DataFrame, column: str, name: str = "scaled", digits: int | None = 6,
                 fit_on: DataFrame | None = None) -> DataFrame:
    """(x − min) / (max − min) with statistics from ``fit_on`` (default ``df``); constant → 0."""
    src = fit_on if fit_on is not None else df
    mn, mx = src.agg(F.min(column)).scalar(), src.agg(F.max(column)).scalar()
    span = mx - mn
    v = F.when(span > 0, (F.col(column) - mn) / span).otherwise(F.lit(0.0))
    v = F.round(v, digits) if digits is not None else v
    return df.withColumn(name, v)


def standard_scale(df: DataFrame, column: str, fit_on: DataFrame, name: str = "scaled",
                   digits: int | None = 6) -> DataFrame:
    """(x − mean) / population std, both fitted on ``fit_on`` (the training rows)."""
    mu, sd = fit_on.agg(F.avg(column)).scalar(), fit_on.agg(F.stddev_pop(column)).scalar()
    v = F.when(sd > 0, (F.col(column) - mu) / sd).otherwise(F.lit(0.0))
    v = F.round(v, digits) if digits is not None else v
    return df.withColumn(name, v)


def hash_split(df: DataFrame, key: str, test_fraction: float = 0.2, seed: str = "42",
               name: str = "split") -> DataFrame:
    """'test' for rows whose key hashes below ``test_fraction``, else 'train'."""
    return df.withColumn(name, F.when(hash_fraction(key, seed) < test_fraction, "test").otherwise("train"))


def hash_sample(df: DataFrame, key: str, fraction: float, seed: str = "42") -> DataFrame:
    """Reproducible Bernoulli-like sample: keys hashing below ``fraction``."""
    return df.where(hash_fraction(key, seed) < fraction)


def downsample_majority(df: DataFrame, label: str, key: str, keep: float = 0.25,
                        seed: str = "42") -> DataFrame:
    """Keep ``keep`` of the most frequent class (by key hash) and all other rows."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("__n"))
    major = counts.orderBy(F.desc("__n"), F.asc(label)).limit(1).select(label).scalar()
    is_major = F.col(label).eqNullSafe(major)
    return df.where(~is_major | (hash_fraction(key, seed) < keep))


def per_class(stats: DataFrame, label: str, value: str) -> Column:
    """The ``value`` of each row's class: ``stats`` (one row per class) as a scalar-subquery map.

    Detail rows are not shuffled on a label with a handful of values; a label
    that is null or not in ``stats`` gives null.
    """
    entries = F.map_from_entries(F.collect_list(F.struct(label, value)))
    return stats.agg(entries.alias("m")).scalar()[F.col(label)]


def balance_classes(df: DataFrame, label: str, key: str, n: int, seed: str = "42") -> DataFrame:
    """``n`` rows per class, in key-hash order; short classes repeat their rows.

    A class with c < n rows is replicated ceil(n / c) times (``copy`` column)
    before the cut, which reproduces sampling with replacement
    deterministically. Classes with c ≥ n are never replicated.
    """
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("__c"))
    j = df.where(F.col(label).isNotNull()).withColumn("__c", per_class(counts, label, "__c"))
    copies = F.greatest(F.lit(1), F.ceil(F.lit(n) / F.col("__c")).cast("int"))
    j = j.withColumn("copy", F.explode(F.sequence(F.lit(0), copies - 1)))
    w = Window.partitionBy(label).orderBy(F.col("copy"), hash_fraction(key, seed), F.col(key))
    return j.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= n).drop("__rn", "__c")


def class_weights(df: DataFrame, label: str, digits: int = 6) -> DataFrame:
    """'balanced' weights total / (k · n_class), and the negative/positive ratio for 0/1 labels."""
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    k = counts.agg(F.count(F.lit(1))).scalar()
    pos = counts.agg(F.sum(F.when(F.col(label) == 1, F.col("n")))).scalar()
    neg = counts.agg(F.sum(F.when(F.col(label) == 0, F.col("n")))).scalar()
    return counts.select(label, "n",
                         F.round(total / (k * F.col("n")), digits).alias("weight"),
                         F.round(neg / pos, digits).alias("pos_weight"))


def weight_column(df: DataFrame, label: str, name: str = "weight") -> DataFrame:
    """Attach the balanced class weight to every row (for ``weightCol``)."""
    w = class_weights(df, label).select(label, F.col("weight").alias(name))
    return df.withColumn(name, per_class(w, label, name))


def global_index(df: DataFrame, order: list[str], name: str = "pos") -> DataFrame:
    """Consecutive 0-based position in ``order`` without a single-partition window.

    Range-partition and sort by ``order`` (a hot key is split across range
    partitions by the later order columns); within a partition
    ``monotonically_increasing_id`` counts rows in sorted order. The numbered
    rows are written once as a stage under ``spark.checkpoint.dir``: the
    per-partition row counts (one row per partition, giving each partition's
    offset) and the rows themselves both come from that stage, so they cannot
    stem from two different range samples. ``order`` must be a total order
    (unique key) for a stable result.
    """
    # partition count from spark.sql.shuffle.partitions (sized for the cluster),
    # coalescable by AQE; each range partition is sorted locally
    sorted_df = df.repartitionByRange(*order).sortWithinPartitions(*order)
    tagged = sorted_df.withColumn("__mid", F.monotonically_increasing_id()) \
        .withColumn("__pid", F.shiftright("__mid", 33)) \
        .withColumn("__local", F.col("__mid").bitwiseAND(F.lit((1 << 33) - 1)))
    tagged = materialize(tagged.drop("__mid"), name="global-index")
    sizes = tagged.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    offsets = sizes.withColumn("__off", F.coalesce(F.sum("__n").over(
        Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    out = tagged.join(F.broadcast(offsets.select("__pid", "__off")), "__pid")
    return out.withColumn(name, F.col("__off") + F.col("__local")).drop("__pid", "__local", "__off")


def as_double_array(c) -> Column:
    return col_of(c).cast("array<double>")
