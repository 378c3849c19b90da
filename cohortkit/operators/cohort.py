"""Cohort selection, membership, first rows and top-k.

Design rules (scale):

* membership is a ``left_semi`` join — no driver-side ``collect`` of key sets;
* a top-k set is ``orderBy(...).limit(k)`` (``TakeOrderedAndProject``: each
  task keeps k rows, one task merges k × tasks) and is therefore bounded by
  ``k`` — the only kind of computed frame this module broadcasts;
* "first row per key" is an aggregate with a map-side partial step (``min_by``
  over a packed fixed-width order key, or ``min`` over a struct), so a key
  holding a third of all rows is reduced before the shuffle instead of being
  sorted in one task;
* every top-k and first-row carries a total order (explicit tie-breakers).
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortkit.functions.rules import RuleTable
from cohortkit.functions.scalar import col_of


def prefix_filter(df: DataFrame, code_col: str, prefixes: Sequence[str] | str,
                  negate: bool = False) -> DataFrame:
    """Rows whose code starts with any prefix (null codes never match)."""
    prefixes = [prefixes] if isinstance(prefixes, str) else list(prefixes)
    cond = RuleTable.prefixes([("x", prefixes)]).matches(code_col)
    # A bare StartsWith (null → row dropped) is what Parquet receives as a pushed
    # StringStartsWith filter; wrapping it (e.g. in coalesce) would block pushdown.
    return df.where(F.col(code_col).isNotNull() & ~cond if negate else cond)


def semi_join(df: DataFrame, keys: DataFrame, on: Sequence[str] | str,
              anti: bool = False) -> DataFrame:
    """Rows of ``df`` whose key appears (``anti``: does not appear) in ``keys``.

    The key side is de-duplicated first (a partial aggregate, combined
    map-side), so a key repeated in a third of its rows enters the join once.
    """
    on = [on] if isinstance(on, str) else list(on)
    return df.join(keys.select(*on).distinct(), on, "left_anti" if anti else "left_semi")


def top_k_keys(df: DataFrame, key: str | Sequence[str], k: int, weight: str | None = None,
               name: str = "n") -> DataFrame:
    """The ``k`` most frequent keys (or heaviest by ``weight``), ties by key ascending."""
    keys = [key] if isinstance(key, str) else list(key)
    agg = F.sum(weight) if weight else F.count(F.lit(1))
    counted = df.dropna(how="any", subset=keys) \
        .groupBy(*keys).agg(agg.alias(name))
    return counted.orderBy(F.desc(name), *[F.asc(c) for c in keys]).limit(k)


def restrict_to_top_k(df: DataFrame, key: str, k: int, weight: str | None = None,
                      ranked_by: DataFrame | None = None) -> DataFrame:
    """Rows whose ``key`` is among the top ``k`` (of ``ranked_by``, default ``df``).

    The top-k frame holds at most ``k`` rows, so broadcasting it is safe.
    """
    top = top_k_keys(ranked_by if ranked_by is not None else df, key, k, weight).select(key)
    return df.join(F.broadcast(top), key, "left_semi")


_MAJOR_TYPES = ("TimestampType", "TimestampNTZType", "DateType", "IntegerType", "ShortType", "ByteType")
_MINOR_TYPES = ("LongType", "IntegerType", "ShortType", "ByteType")
_PACKED = "decimal(38,0)"


def _packed_order(df: DataFrame, order: Sequence[str]) -> Column | None:
    """One ``decimal(38,0)`` sorting like (major, minor), or None when the types do not allow it.

    major (a timestamp in microseconds, a date in days, or an int) is scaled by
    10^20 and minor (an integer id, shifted by 2^63 to be non-negative) added:
    |major| < 2.6·10^17 and 0 ≤ minor' < 10^20 keep the pair's order and fit.
    """
    if len(order) != 2:
        return None
    types = {f.name: type(f.dataType).__name__ for f in df.schema.fields}
    major, minor = order
    if types.get(major) not in _MAJOR_TYPES or types.get(minor) not in _MINOR_TYPES:
        return None
    m = F.col(major)
    if types[major] == "TimestampType":
        m = F.unix_micros(m)
    elif types[major] == "TimestampNTZType":
        # micros from the wall-clock fields themselves: no session time zone involved
        days = F.datediff(m.cast("date"), F.lit("1970-01-01").cast("date")).cast(_PACKED)
        minutes = (F.hour(m) * 60 + F.minute(m)).cast(_PACKED)
        micros = (F.date_part(F.lit("SECOND"), m) * F.lit(Decimal(1_000_000))).cast(_PACKED)
        m = days * F.lit(Decimal(86_400_000_000)).cast(_PACKED) \
            + minutes * F.lit(Decimal(60_000_000)).cast(_PACKED) + micros
    elif types[major] == "DateType":
        m = F.unix_date(m)
    shifted = F.col(minor).cast(_PACKED) + F.lit(Decimal(2 ** 63)).cast(_PACKED)
    return (m.cast(_PACKED) * F.lit(Decimal(10 ** 20)).cast(_PACKED) + shifted).cast(_PACKED)


def first_per_key(df: DataFrame, keys: Sequence[str] | str, order: Sequence[str],
                  payload: Sequence[str]) -> DataFrame:
    """Earliest row per key by ``order`` (ascending); returns keys + order + payload.

    An aggregate, never a sort of whole groups, so a key holding a third of
    all rows is reduced map-side before the shuffle:

    * order = (timestamp/date/int, integer id): the pair is packed into one
      fixed-width decimal and every output column is ``min_by(col, packed)`` —
      a hash aggregate with a partial step; the id makes the pick unique;
    * otherwise ``min(struct(order..., payload...))`` (a sort-based aggregate,
      still partial), where ties in ``order`` fall to the payload fields.

    Rows with a null order field are dropped (they cannot be "earliest").
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    fields = list(order) + [p for p in payload if p not in order]
    cond = F.lit(True)
    for o in order:
        cond = cond & F.col(o).isNotNull()
    rows = df.where(cond)
    packed = _packed_order(rows, list(order))
    if packed is not None:
        return rows.groupBy(*keys).agg(*[F.min_by(f, packed).alias(f) for f in fields])
    picked = rows.groupBy(*keys).agg(F.min(F.struct(*[F.col(f) for f in fields])).alias("__first"))
    return picked.select(*keys, *[F.col(f"__first.{f}").alias(f) for f in fields])


def top_k_per_group(counts: DataFrame, group: Sequence[str] | str, score: str, k: int,
                    tie: Sequence[str], rank_name: str = "rank") -> DataFrame:
    """Top ``k`` rows per group by ``score`` desc, ties by ``tie`` asc.

    Meant for already aggregated input (one row per group × item), where the
    rows per group are bounded by the item domain; Spark adds a partial
    ``WindowGroupLimit`` before the shuffle, so each task forwards ≤ k rows
    per group.
    """
    group = [group] if isinstance(group, str) else list(group)
    w = Window.partitionBy(*group).orderBy(F.desc(score), *[F.asc(t) for t in tie])
    return counts.withColumn(rank_name, F.row_number().over(w)).where(F.col(rank_name) <= k)


def first_n_per_key(df: DataFrame, keys: Sequence[str] | str, order: Sequence[Column | str],
                    n: int, position: str = "pos") -> DataFrame:
    """First ``n`` rows per key in ``order`` with their 1-based position.

    ``row_number() <= n`` is planned with a partial ``WindowGroupLimit`` ahead
    of the shuffle: every map task forwards at most ``n`` rows per key, which
    bounds what a hot key sends to its reducer.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    w = Window.partitionBy(*keys).orderBy(*[col_of(o) for o in order])
    return df.withColumn(position, F.row_number().over(w)).where(F.col(position) <= n)


def join_with_suffix(left: DataFrame, right: DataFrame, on: Sequence[str] | str, how: str = "inner",
                     suffix: str = "_right") -> DataFrame:
    """Join keeping both copies of overlapping non-key columns; the right ones get ``suffix``."""
    on = [on] if isinstance(on, str) else list(on)
    clash = (set(left.columns) & set(right.columns)) - set(on)
    renamed = right.select(*[F.col(c).alias(c + suffix) if c in clash else F.col(c) for c in right.columns])
    return left.join(renamed, on, how)
