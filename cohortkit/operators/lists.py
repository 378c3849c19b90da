"""Lists, sequences, concatenated text and count vectors per key.

Per-key lists are built with ``collect_list`` over structs that carry the
sort key, then ``array_sort`` — the order is a total order of the data, not
of partition layout. ``collect_list`` aggregates partially on the map side,
so the rows of a hot key are pre-combined by every task before the shuffle.
A list is by definition one row per key; where its length must be bounded
(model inputs), cut with ``first_n_per_key`` *before* collecting.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortkit.functions.scalar import col_of
from cohortkit.operators.running import running


def ordered_list(df: DataFrame, keys: Sequence[str] | str, value: str | Column,
                 order: Sequence[str], name: str = "items") -> DataFrame:
    """All values per key, ordered by ``order`` (ties by the value itself)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    v = col_of(value)
    packed = F.struct(*[F.col(o).alias(f"_o{i}") for i, o in enumerate(order)], v.alias("_v"))
    agg = df.groupBy(*keys).agg(F.array_sort(F.collect_list(packed)).alias("_l"))
    return agg.select(*keys, F.transform("_l", lambda s: s["_v"]).alias(name))


def distinct_sorted_list(df: DataFrame, keys: Sequence[str] | str, value: str,
                         name: str = "items") -> DataFrame:
    """Distinct non-null values per key, sorted ascending."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.where(F.col(value).isNotNull()).groupBy(*keys) \
        .agg(F.array_sort(F.collect_set(value)).alias(name))


def concat_text(df: DataFrame, keys: Sequence[str] | str, text: str, order: Sequence[str],
                sep: str = " ", name: str = "text") -> DataFrame:
    """Non-null texts per key joined by ``sep`` in ``order`` (``" ".join(texts.dropna())``)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    listed = ordered_list(df.where(F.col(text).isNotNull()), keys, text, order, "_parts")
    return listed.select(*keys, F.array_join("_parts", sep).alias(name))


def explode_counts(df: DataFrame, array_col: str, name: str = "item", count: str = "n") -> DataFrame:
    """Flatten a list column and count every element (``Counter`` over lists)."""
    return df.select(F.explode(array_col).alias(name)).where(F.col(name).isNotNull()) \
        .groupBy(name).agg(F.count(F.lit(1)).alias(count))


def count_vector(df: DataFrame, keys: Sequence[str] | str, index: str, size: int,
                 prefix: str = "item_", binary: bool = False) -> DataFrame:
    """Per key, counts of ``index`` values 0..size-1 as columns (``bincount(minlength)``).

    ``binary=True`` clips counts to 0/1 (multi-hot).
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    wide = df.groupBy(*keys).pivot(index, list(range(size))).count()
    cols = []
    for i in range(size):
        c = F.coalesce(F.col(f"`{i}`"), F.lit(0))
        cols.append((F.least(c, F.lit(1)) if binary else c).cast("bigint").alias(f"{prefix}{i}"))
    return wide.select(*keys, *cols)


def multi_hot_inverse(df: DataFrame, keys: Sequence[str] | str, columns: dict[str, str | Column], name: str = "items") -> DataFrame:
    """Per row the names of the indicator ``columns`` (column → name) that are above 0, in their order.

    The inverse of :func:`count_vector` with ``binary=True``; null indicators count as 0.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    held = [F.when(F.col(c) > 0, n if isinstance(n, Column) else F.lit(n)) for c, n in columns.items()]
    return df.select(*keys, F.array_compact(F.array(*held)).alias(name))


def explode_vector(df: DataFrame, array_col: str, size: int, prefix: str | None = None) -> DataFrame:
    """One column per position of a fixed-length array (``apply(pd.Series)``)."""
    prefix = prefix if prefix is not None else f"{array_col}_"
    others = [c for c in df.columns if c != array_col]
    return df.select(*others, *[F.col(array_col)[i].alias(f"{prefix}{i}") for i in range(size)])


def ordered_chunks(df: DataFrame, keys: Sequence[str] | str, value: str, order: Sequence[str],
                   size: int, name: str = "items") -> DataFrame:
    """All values per key in ``order`` as consecutive lists of at most ``size`` values.

    Output rows: keys, ``chunk`` (0, 1, ...), ``name`` — concatenating a key's
    chunks in chunk order gives its whole ordered list. No task ever holds more
    than a range partition's rows of one key, even when a key has a third of
    all rows: positions are counted inside (range partition, key) groups from
    carried offsets (:func:`~cohortkit.operators.running.running`), and only
    (key, chunk) groups are collected. No exchange is on the key alone.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    rows = df.where(F.col(value).isNotNull()).select(*dict.fromkeys([*keys, *order, value]))
    placed = running(rows, keys, [*order, value], "__g").withColumn("chunk", F.floor((F.col("__g") - 1) / size))
    grouped = placed.groupBy(*keys, "chunk").agg(F.array_sort(F.collect_list(F.struct("__g", value))).alias("__l"))
    return grouped.select(*keys, "chunk", F.transform("__l", lambda x: x[value]).alias(name))


def distinct_chunks(df: DataFrame, keys: Sequence[str] | str, value: str, size: int, name: str = "items") -> DataFrame:
    """Distinct non-null values per key, sorted, as consecutive lists of at most ``size`` values.

    :func:`distinct_sorted_list` without an unbounded row: pairs are made
    distinct by a partial aggregate, then cut as in :func:`ordered_chunks`.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    return ordered_chunks(df.where(F.col(value).isNotNull()).select(*keys, value).distinct(), keys, value, [], size, name)


def chunked_text(df: DataFrame, keys: Sequence[str] | str, text: str, order: Sequence[str], size: int,
                 sep: str = " ", name: str = "text") -> DataFrame:
    """Texts per key joined by ``sep`` in ``order``, ``size`` texts per output row (see ``ordered_chunks``)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    parts = ordered_chunks(df, keys, text, order, size, "__parts")
    return parts.select(*keys, "chunk", F.array_join("__parts", sep).alias(name))
