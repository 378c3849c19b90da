"""Positions and running totals inside each key, without an exchange on the key.

``running`` numbers the rows of every key and carries running sums along them
even when one key holds a third of all rows:

1. rows are range-partitioned and sorted by (keys, order), so a hot key spans
   several range partitions; the sorted rows are written once as a stage with
   their partition and their place in it;
2. only the first and the last key of a range partition can reach beyond it.
   Their per-partition totals — at most two rows per range partition — give
   each partition's offsets and are the only table that is broadcast;
3. inside a (range partition, key) group a window counts on from the offset.
   The largest group is one range partition, whatever the key's size.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortkit.sources.io import materialize

#: How a running total is folded: aggregate, its value over no row, and the way two totals combine.
FOLDS = {
    "sum": (F.sum, 0, lambda a, b: a + b),
    "xor": (F.bit_xor, 0, lambda a, b: a.bitwiseXOR(b)),
}


def sorted_stage(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], name: str = "running") -> DataFrame:
    """``df`` range-partitioned and sorted by (keys, order), written once; ``__part`` and ``__at`` say where a row stands.

    Rows equal in keys and order may fall into different partitions too, so
    no number of ties lands in one task. ``order`` takes columns or sort
    expressions (``F.desc``).
    """
    tied = df.withColumn("__tie", F.monotonically_increasing_id())
    by = [*keys, *order, "__tie"]
    spot = F.monotonically_increasing_id()
    placed = (tied.repartitionByRange(*by).sortWithinPartitions(*by)
              .withColumn("__part", F.shiftright(spot, 33)).withColumn("__at", spot.bitwiseAND(F.lit((1 << 33) - 1))))
    return materialize(placed.drop("__tie"), name=name)


def running(df: DataFrame, keys: Sequence[str] | str, order: Sequence[str | Column], position: str = "position",
            size: str | None = None, totals: Mapping[str, tuple[str, str]] | None = None) -> DataFrame:
    """``df`` with the 1-based ``position`` of each row in its key's order.

    ``size`` names a column for the number of the key's rows. ``totals`` maps
    new columns to (``"sum"`` or ``"xor"``, column): the total over the key's
    rows up to and including this one (null values count as 0). Null keys form
    one group. Rows equal in ``order`` get positions in an arbitrary order;
    name a total order for a stable result. Every row is returned once.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    totals = dict(totals or {})
    rows = sorted_stage(df, keys, order)
    key = F.struct(*keys)
    ends = (rows.groupBy("__part").agg(F.min_by(key, "__at").alias("a"), F.max_by(key, "__at").alias("b"))
            .select(F.col("__part").alias("__p"), F.explode(F.array_distinct(F.array("a", "b"))).alias("__key")))

    def at_end(table: DataFrame, how: str) -> DataFrame:
        return rows.join(F.broadcast(table), (rows["__part"] == table["__p"]) & F.struct(*[rows[k] for k in keys]).eqNullSafe(table["__key"]), how)

    value = {c: F.coalesce(F.col(v), F.lit(FOLDS[f][1])) for c, (f, v) in totals.items()}
    per = at_end(ends, "inner").groupBy("__p", "__key").agg(
        F.count(F.lit(1)).alias("__n"), *[FOLDS[f][0](value[c]).alias(f"__t_{c}") for c, (f, _) in totals.items()])
    whole = Window.partitionBy("__key")
    earlier = whole.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per.select(
        "__p", "__key", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"), F.sum("__n").over(whole).alias("__all"),
        *[F.coalesce(FOLDS[f][0](f"__t_{c}").over(earlier), F.lit(FOLDS[f][1])).alias(f"__b_{c}") for c, (f, _) in totals.items()])

    group = Window.partitionBy("__part", *keys)
    along = group.orderBy("__at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = at_end(offsets, "left")
    new = {position: F.coalesce("__before", F.lit(0)) + F.row_number().over(group.orderBy("__at"))}
    if size:
        new[size] = F.coalesce("__all", F.count(F.lit(1)).over(group))
    for c, (f, _) in totals.items():
        fold, none, both = FOLDS[f]
        new[c] = both(F.coalesce(f"__b_{c}", F.lit(none)), fold(value[c]).over(along))
    return out.select(*df.columns, *[v.alias(c) for c, v in new.items()])
