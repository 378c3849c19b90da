"""Vector operators over an embeddings table.

* nearest neighbours of one query vector: the query row (d numbers) is
  fetched once and becomes a literal, so scoring is a pure map; similarities are a per-row expression, the answer a top-k;
* label cohesion (the all-pairs contrastive loss) is computed exactly from
  per-label sums instead of pairs: for unit vectors u and a label with m rows,
  Σ_{i,j} (1 − u_i·u_j)² = m² − 2‖Σu‖² + ‖Σ u uᵀ‖²_F, an O(m·d²/2) aggregate
  (``Summarizer.sum`` of the upper triangle of each outer product) — no pair
  is emitted;
* adjacent-row agreement joins each row to the next one in key order through
  a global position (no single-partition window).
"""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortkit.functions.scalar import cosine, euclidean, norm2
from cohortkit.operators.features import global_index


def nearest(df: DataFrame, key: str, vec: str, query_key, k: int, digits: int = 6) -> DataFrame:
    """The ``k`` rows most cosine-similar to the row ``key == query_key`` (itself excluded)."""
    row = df.where(F.col(key) == F.lit(query_key)).select(F.col(vec).cast("array<double>")).first()
    if row is None or row[0] is None:
        raise ValueError(f"no vector with {key} = {query_key!r}")
    q = F.array(*[F.lit(float(x)) for x in row[0]])   # one d-sized row: the query is a parameter
    cand = df.where(F.col(key) != F.lit(query_key))
    scored = cand.select(key, F.round(cosine(F.col(vec).cast("array<double>"), q), digits).alias("similarity"))
    return scored.orderBy(F.desc("similarity"), F.asc(key)).limit(k)


def label_cohesion(df: DataFrame, label: str, vec: str, digits: int = 6) -> DataFrame:
    """Mean over all ordered pairs of one label of (1 − cos)², per label."""
    v = F.col(vec).cast("array<double>")
    n = norm2(v)
    unit = F.transform(v, lambda x: x / n)
    rows = df.where(n > 0).select(label, unit.alias("u"))
    # upper triangle of u uᵀ only (the Gram sum is symmetric): off-diagonal products
    # are scaled by √2 so that the sum of squares still equals ‖Σ u uᵀ‖²_F
    dims = F.size("u")
    root2 = F.lit(2.0 ** 0.5)
    outer = F.flatten(F.transform(F.sequence(F.lit(0), dims - 1), lambda i: F.transform(
        F.slice("u", i + 1, dims - i),
        lambda b, k: F.when(k == 0, F.col("u")[i] * b).otherwise(root2 * F.col("u")[i] * b))))
    sums = rows.groupBy(label).agg(
        F.count(F.lit(1)).alias("n"),
        Summarizer.sum(array_to_vector("u")).alias("_s"),
        Summarizer.sum(array_to_vector(outer)).alias("_g"))
    sq = lambda c: F.aggregate(vector_to_array(c), F.lit(0.0), lambda acc, x: acc + x * x)
    m = F.col("n").cast("double")
    pair_sum = m * m - 2.0 * sq("_s") + sq("_g")
    return sums.select(label, "n", F.round(pair_sum / (m * m), digits).alias("cohesion"))


def adjacent_pairs(df: DataFrame, key: str, label: str, vec: str, margin: float = 1.0,
                   digits: int = 6) -> DataFrame:
    """Each row with the next row in ``key`` order: same-label flag and the margin loss term."""
    idx = global_index(df.select(key, label, vec), [key])
    a = idx.select(F.col("pos"), F.col(key).alias("key_a"), F.col(label).alias("label_a"), F.col(vec).alias("va"))
    b = idx.select((F.col("pos") - 1).alias("pos"), F.col(key).alias("key_b"), F.col(label).alias("label_b"),
                   F.col(vec).alias("vb"))
    j = a.join(b, "pos")
    d = euclidean(F.col("va").cast("array<double>"), F.col("vb").cast("array<double>"))
    same = (F.col("label_a") == F.col("label_b")).cast("int")
    loss = same * d * d + (1 - same) * F.pow(F.greatest(F.lit(margin) - d, F.lit(0.0)), 2)
    return j.select("key_a", "key_b", same.alias("same"), F.round(loss, digits).alias("loss"))
