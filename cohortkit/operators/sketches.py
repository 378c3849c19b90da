"""Mergeable sketches: distinct counts and quantiles kept per fine group, merged later.

A table of sketches has one row per group and a few binary columns of bounded
size, so a period is counted once, when it arrives: coarser groups, longer
periods and unions come from merging rows of that table, never from the detail
rows again. Distinct counts are HyperLogLog sketches (``lg_k`` address bits:
standard error about 1.04 / sqrt(2^lg_k), 0.8 % at 14), quantiles are KLL
sketches (``k``: rank error about 2.3 / k^0.9, 1.1 % at 400, in 99 of 100 cases).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LG_K, KLL_K = 14, 400


def hll_error(lg_k: int = LG_K) -> float:
    """Relative standard error of a distinct count."""
    return 1.04 / (1 << lg_k) ** 0.5


def kll_error(k: int = KLL_K) -> float:
    """Rank error that a quantile keeps within, in 99 of 100 cases."""
    return 2.296 / k ** 0.9021


def sketch_groups(df: DataFrame, groups: Sequence[str], distinct: Sequence[str] = (), values: Sequence[str] = (),
                  lg_k: int = LG_K, k: int = KLL_K) -> DataFrame:
    """One row per group: ``groups``, n, ``<c>_hll`` of each column in ``distinct``, ``<c>_kll`` of each in ``values``.

    Sketches are built before the shuffle, so a group with a third of all rows
    is a row per task. Null values are not counted by the sketches (n counts
    every row); a group without values has a sketch of none. ``distinct``
    columns are strings, whole numbers or binary; ``values`` numbers.
    """
    return df.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("n"), *[F.hll_sketch_agg(c, lg_k).alias(f"{c}_hll") for c in distinct],
        *[F.kll_sketch_agg_double(F.col(c).cast("double"), k).alias(f"{c}_kll") for c in values])


def merge_groups(sketches: DataFrame, groups: Sequence[str]) -> DataFrame:
    """The sketch table of coarser ``groups`` (a subset of the table's, or columns derived from them)."""
    merged = []
    for c in sketches.columns:
        if c.endswith("_hll"):
            merged.append(F.hll_union_agg(c).alias(c))
        elif c.endswith("_kll"):
            merged.append(F.kll_merge_agg_double(c).alias(c))
    return sketches.groupBy(*groups).agg(F.sum("n").alias("n"), *merged)


def estimated(sketches: DataFrame, groups: Sequence[str], probs: Mapping[str, float] | None = None) -> DataFrame:
    """``groups``, n, each ``<c>_distinct`` and, per quantile name, ``<c>_<name>`` (null where no value was seen)."""
    cols = []
    for c in sketches.columns:
        if c.endswith("_hll"):
            cols.append(F.hll_sketch_estimate(c).alias(f"{c[:-4]}_distinct"))
        elif c.endswith("_kll"):
            seen = F.kll_sketch_get_n_double(c) > 0
            cols += [F.when(seen, F.kll_sketch_get_quantile_double(F.when(seen, F.col(c)), F.lit(p))).alias(f"{c[:-4]}_{name}")
                     for name, p in (probs or {}).items()]
    return sketches.select(*groups, "n", *cols)


def distinct_within(found: DataFrame, exact: DataFrame, groups: Sequence[str], estimate: str, count: str, errors: float = 4.0,
                    lg_k: int = LG_K) -> DataFrame:
    """``groups``, the exact ``count`` and whether the estimate lies within ``errors`` standard errors of it."""
    j = exact.join(found.select(*groups, estimate), list(groups), "left")
    room = F.greatest(F.lit(0.5), F.col(count) * errors * hll_error(lg_k))
    return j.select(*groups, count, F.coalesce(F.abs(F.col(estimate) - F.col(count)) <= room, F.lit(False)).alias("within"))


def quantiles_within(df: DataFrame, value: str, found: DataFrame, groups: Sequence[str], probs: Mapping[str, float], errors: float = 2.0,
                     k: int = KLL_K) -> DataFrame:
    """``groups``, quantile, n and whether the estimate's exact ranks reach the asked one within ``errors`` rank errors.

    The share of values below the estimate and the share up to it are counted
    in one aggregation over ``df``; the estimates (a row per group) join it.
    """
    room = errors * kll_error(k)
    names = list(probs)
    est = found.select(*[F.col(g).alias(f"__g{i}") for i, g in enumerate(groups)], *[F.col(f"{value}_{q}").alias(f"__q_{q}") for q in names])
    same = [df[g].eqNullSafe(F.col(f"__g{i}")) for i, g in enumerate(groups)]
    cond = same[0]
    for s in same[1:]:
        cond = cond & s
    v = F.col(value).cast("double")
    counted = df.where(F.col(value).isNotNull()).join(est, cond).groupBy(*groups).agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(v < F.col(f"__q_{q}")).alias(f"__below_{q}") for q in names],
        *[F.count_if(v <= F.col(f"__q_{q}")).alias(f"__upto_{q}") for q in names])
    ok = lambda q: (F.col(f"__below_{q}") / F.col("n") <= probs[q] + room) & (F.col(f"__upto_{q}") / F.col("n") >= probs[q] - room)
    rows = F.array(*[F.struct(F.lit(q).alias("quantile"), ok(q).alias("within")) for q in names])
    return counted.select(*groups, "n", F.explode(rows).alias("r")).select(*groups, "r.quantile", "n", "r.within")
