"""Cross-tabs, conditional counts, rates, quantiles and distinct-patient buckets.

All operators aggregate with Spark's partial + final hash aggregation, so a
hot group key is combined map-side before the shuffle and never lands in one
task as raw rows. Pivots always get their value list up front (no extra job
to discover the values, and a fixed output schema).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortkit.functions.scalar import col_of
from cohortkit.sources.io import materialize


def rate(num, den, percent: bool = True, digits: int | None = None) -> Column:
    """``100.0 * num / den`` as a double; null when ``den`` is 0 or null."""
    scale = 100.0 if percent else 1.0
    out = F.lit(scale) * col_of(num).cast("double") / F.nullif(col_of(den).cast("double"), F.lit(0.0))
    return F.round(out, digits) if digits is not None else out


def conditional_counts(df: DataFrame, group: Sequence[Column | str], by,
                       categories: Mapping[str, object], rollup: bool = False,
                       total_flag: str | None = "is_total") -> DataFrame:
    """One count column per category value (``COUNT(CASE WHEN by = v ...)``).

    With ``rollup=True`` a grand-total row is added (``GROUP BY ROLLUP``);
    ``total_flag`` tells it apart from a real null group.
    """
    by = col_of(by)
    aggs = [F.count_if(by == F.lit(v)).alias(name) for name, v in categories.items()]
    gcols = [col_of(g) for g in group]
    if rollup:
        # Aggregate first, then roll up the (small) per-group result: the
        # rollup's Expand then multiplies groups, not input rows.
        names = [g for g in group if isinstance(g, str)]
        if len(names) != len(group):
            raise ValueError("rollup needs column names as group keys")
        per_group = df.groupBy(*gcols).agg(*aggs)
        flag = [F.grouping(names[0]).cast("int").alias(total_flag)] if total_flag else []
        return per_group.rollup(*names).agg(*[F.sum(n).cast("bigint").alias(n) for n in categories], *flag)
    return df.groupBy(*gcols).agg(*aggs)


def pivot_counts(df: DataFrame, group: Sequence[str], pivot_col: str,
                 values: Sequence, names: Sequence[str] | None = None) -> DataFrame:
    """Count rows per group for each listed pivot value; absent cells are 0."""
    out = df.groupBy(*group).pivot(pivot_col, list(values)).count()
    renamed = [F.coalesce(F.col(f"`{v}`"), F.lit(0)).alias(n)
               for v, n in zip(values, names or [str(v) for v in values])]
    return out.select(*[F.col(g) for g in group], *renamed)


def distinct_pivot_counts(df: DataFrame, group: Sequence[str], pivot_col: str,
                          values: Sequence, key: str,
                          names: Sequence[str] | None = None,
                          already_distinct: bool = False) -> DataFrame:
    """``COUNT(DISTINCT CASE WHEN pivot = v THEN key END)`` for every v, without ``Expand``.

    The direct form plans an ``Expand`` that multiplies rows by the number of
    distinct aggregates. Deduplicating (group, key, pivot) first and then
    counting per pivot value gives the same numbers in two plain aggregations.
    """
    slim = df.select(*group, key, pivot_col).where(F.col(key).isNotNull() & F.col(pivot_col).isNotNull())
    if not already_distinct:      # callers that built distinct triples skip a shuffle
        slim = slim.distinct()
    return pivot_counts(slim, group, pivot_col, values, names)


def group_stats(df: DataFrame, group: Sequence[str | Column], value,
                stats: Mapping[str, str], digits: int | None = None) -> DataFrame:
    """Named statistics of ``value`` per group: avg, stddev, min, max, count, sum, median."""
    v = col_of(value)
    fns = {
        "avg": lambda: F.avg(v), "stddev": lambda: F.stddev_samp(v), "min": lambda: F.min(v),
        "max": lambda: F.max(v), "count": lambda: F.count(v), "sum": lambda: F.sum(v),
        "median": lambda: F.percentile(v, 0.5), "stddev_pop": lambda: F.stddev_pop(v),
    }
    aggs = []
    for name, fn in stats.items():
        e = fns[fn]()
        if digits is not None and fn in ("avg", "stddev", "median", "stddev_pop"):
            e = F.round(e, digits)
        aggs.append(e.alias(name))
    return df.groupBy(*[col_of(g) for g in group]).agg(*aggs)


def exact_quantiles(value, probs: Mapping[str, float]) -> list[Column]:
    """Exact linear-interpolation quantiles (``PERCENTILE_CONT``) as aggregate columns."""
    v = col_of(value)
    return [F.percentile(v, p).alias(name) for name, p in probs.items()]


def value_counts(df: DataFrame, column: str, k: int | None = None, name: str = "n") -> DataFrame:
    """Frequency table, most frequent first, ties by value; top ``k`` if given."""
    out = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias(name))
    if k is not None:
        out = out.orderBy(F.desc(name), F.asc(column)).limit(k)
    return out


def share_of_total(counts: DataFrame, count_col: str, name: str = "share_pct",
                   digits: int | None = 6) -> DataFrame:
    """Each row's count as a percentage of the column total.

    The total is a scalar subquery (evaluated once, inlined) — never an
    unpartitioned window, which would pull every row into one task.
    """
    total = counts.agg(F.sum(count_col)).scalar()
    return counts.withColumn(name, rate(F.col(count_col), total, digits=digits))


def value_ranks(df: DataFrame, group: Sequence[str], value: str) -> tuple[DataFrame, DataFrame]:
    """Per (group, value) counts in global order, for exact quantiles without per-group state.

    Returns two frames. ``cells``: group, value (double), ``rows`` (all rows),
    ``n`` (rows with a value), range partition ``__pid``, and ``__upto``, the
    running count of values inside (partition, group). ``spans``: one row per
    (partition, group) with ``__off``, the values of the group in earlier
    partitions, and ``__total``, all its values. The counts are
    range-partitioned by (group, value) and written once, so a hot group
    spreads over many partitions and only one row per partition and group
    meets the window over a group. Null values and null groups are kept
    (a null value has n = 0).
    """
    cells = df.groupBy(*group, F.col(value).cast("double").alias("value")).agg(
        F.count(F.lit(1)).alias("rows"), F.count(value).alias("n"))
    order = [*group, "value"]
    cells = materialize(cells.repartitionByRange(*order).withColumn("__pid", F.spark_partition_id()), name="value-ranks")
    inside = Window.partitionBy("__pid", *group).orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    held = cells.groupBy("__pid", *group).agg(F.sum("n").alias("__held"))
    of_group = Window.partitionBy(*group)
    before = of_group.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    spans = held.select("__pid", *group, F.coalesce(F.sum("__held").over(before), F.lit(0)).alias("__off"),
                        F.sum("__held").over(of_group).alias("__total"))
    return cells.withColumn("__upto", F.sum("n").over(inside)), spans


def on_span(cells: DataFrame, spans: DataFrame, group: Sequence[str]) -> DataFrame:
    """``cells`` with the columns of their (partition, group) row of ``spans``; groups match null-safely."""
    named = spans.select(F.col("__pid").alias("__pid_s"), *[F.col(g).alias(f"__s_{g}") for g in group],
                         *[c for c in spans.columns if c not in ("__pid", *group)])
    met = F.col("__pid") == F.col("__pid_s")
    for g in group:
        met = met & F.col(g).eqNullSafe(F.col(f"__s_{g}"))
    return cells.join(named, met).drop("__pid_s", *[f"__s_{g}" for g in group])


def ranked_quantiles(cells: DataFrame, spans: DataFrame, group: Sequence[str], probs: Mapping[str, float],
                     *extra: Column) -> DataFrame:
    """Exact linear-interpolation quantiles (``PERCENTILE_CONT``) per group from :func:`value_ranks`.

    For each probability the two neighbouring ranks are picked by a plain
    aggregate and interpolated; a group without values gets nulls. ``extra``
    are further aggregates over the cells (group, value, rows, n).
    """
    at = on_span(cells, spans, group)
    first, end = F.col("__off") + F.col("__upto") - F.col("n"), F.col("__off") + F.col("__upto")
    holds = lambda rank: (first <= rank) & (rank < end)
    picks = []
    for name, p in probs.items():
        pos = F.lit(float(p)) * (F.col("__total") - 1)
        picks += [F.max(F.when(holds(F.floor(pos)), F.col("value"))).alias(f"__lo_{name}"),
                  F.max(F.when(holds(F.ceil(pos)), F.col("value"))).alias(f"__hi_{name}"),
                  F.max(pos - F.floor(pos)).alias(f"__part_{name}")]
    out = at.groupBy(*group).agg(*picks, *extra)

    def between(name: str) -> Column:
        lo, hi, part = (F.col(f"__{c}_{name}") for c in ("lo", "hi", "part"))
        return F.when(lo == hi, lo).otherwise(lo * (1 - part) + hi * part).alias(name)

    kept = [c for c in out.columns if not c.startswith(("__lo_", "__hi_", "__part_")) and c not in group]
    return out.select(*group, *[between(n) for n in probs], *kept)


def box_stats(df: DataFrame, group: Sequence[str], value: str, digits: int = 6) -> DataFrame:
    """Quartiles, and whiskers: the most extreme values within 1.5 IQR of the box.

    The input is reduced once to counts per (group, value); quartiles and
    whiskers both come from those. The fences reach the counts with the one
    row per (range partition, group), so nothing is shuffled on a hot group.
    """
    cells, spans = value_ranks(df, group, value)
    q = ranked_quantiles(cells, spans, group, {"q1": 0.25, "median": 0.5, "q3": 0.75})
    same = [F.col(g).eqNullSafe(F.col(f"__q_{g}")) for g in group]
    fences = spans.join(q.select(*[F.col(g).alias(f"__q_{g}") for g in group], "q1", "median", "q3"),
                        reduce(and_, same)).drop(*[f"__q_{g}" for g in group], "__off", "__total")
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    inside = F.when((F.col("value") >= F.col("q1") - reach) & (F.col("value") <= F.col("q3") + reach), F.col("value"))
    out = on_span(cells.drop("__upto"), fences, group).groupBy(*group).agg(
        *[F.max(c).alias(c) for c in ("q1", "median", "q3")],
        F.min(inside).alias("whisker_low"), F.max(inside).alias("whisker_high"))
    return out.select(*group, *[F.round(c, digits).alias(c) for c in
                                ("q1", "median", "q3", "whisker_low", "whisker_high")])


def columns_by_total(wide: DataFrame, keys: Sequence[str], value_cols: Sequence[str]) -> DataFrame:
    """Reorder value columns by their column totals, largest first (ties by name).

    Reads one row of k totals to the driver — bounded by the number of
    columns — and selects in that order.
    """
    totals = wide.agg(*[F.sum(F.col(f"`{c}`")).alias(c) for c in value_cols]).first()
    order = sorted(value_cols, key=lambda c: (-(totals[c] or 0), c))
    return wide.select(*keys, *[F.col(f"`{c}`") for c in order])


def approx_quantiles(value, probs: Mapping[str, float], accuracy: int = 10000) -> list[Column]:
    """Approximate quantiles (``percentile_approx``) with a bounded per-group sketch.

    The exact form keeps a value → count map per group, sized by the group's
    distinct values; for continuous values on very large groups use this one.
    """
    v = col_of(value)
    return [F.percentile_approx(v, p, accuracy).alias(name) for name, p in probs.items()]
