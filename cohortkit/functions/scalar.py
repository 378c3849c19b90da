"""Scalar column helpers: codes, text cleanup, arrays, hashing.

Everything here is a built-in Spark expression; no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_of(c) -> Column:
    """Accept a column name or a Column."""
    return F.col(c) if isinstance(c, str) else c


def code_truncate(code, digits: int = 3) -> Column:
    """Leading ``digits`` of a code read as an integer.

    Leading zeros disappear ('00845' → '845') and non-numeric codes
    ('V4581') become null, as integer parsing does.
    """
    as_int = F.expr(f"try_cast({_sql(code)} AS BIGINT)")
    return F.left(as_int.cast("string"), F.lit(digits))


def _sql(c) -> str:
    if isinstance(c, str):
        return f"`{c}`"
    raise TypeError("pass a column name")


def coerce_numeric(c, to: str = "double") -> Column:
    """Numeric parse that yields null instead of failing (ANSI-safe)."""
    return col_of(c).try_cast(to)


def clean_text(c) -> Column:
    """Trimmed text; empty strings stay empty, nulls stay null."""
    return F.trim(col_of(c))


def hash_fraction(key, seed: str = "42", digits: int = 8) -> Column:
    """Deterministic value in [0, 1) from md5(seed:key).

    Independent of partitioning and executor layout, so splits and samples are
    reproducible after a retry; DuckDB computes the same number.
    """
    h = F.md5(F.concat(F.lit(f"{seed}:"), col_of(key).cast("string")))
    top = F.conv(F.substring(h, 1, digits), 16, 10).cast("bigint")
    return top / F.lit(float(16 ** digits))


def hash_bucket(key, buckets: int = 100, seed: str = "42") -> Column:
    """Deterministic bucket 0..buckets-1 from md5(seed:key)."""
    h = F.md5(F.concat(F.lit(f"{seed}:"), col_of(key).cast("string")))
    return F.pmod(F.conv(F.substring(h, 1, 8), 16, 10).cast("bigint"), F.lit(buckets))


def pad_array(arr, length: int, fill=0) -> Column:
    """First ``length`` elements, right-padded with ``fill``."""
    a = col_of(arr)
    filler = F.array_repeat(F.lit(fill).cast(_elem_type_sql(fill)), length)
    return F.slice(F.concat(a, filler), 1, length)


def _elem_type_sql(fill) -> str:
    if isinstance(fill, bool):
        return "boolean"
    if isinstance(fill, int):
        return "bigint"
    if isinstance(fill, float):
        return "double"
    return "string"


def mask_of(arr, length: int) -> Column:
    """Attention-style mask: 1 for real positions, 0 for padding."""
    n = F.least(F.size(col_of(arr)), F.lit(length))
    return F.transform(F.sequence(F.lit(1), F.lit(length)), lambda i: F.when(i <= n, 1).otherwise(0))


def dot(a, b) -> Column:
    """Dot product of two numeric arrays of equal length."""
    return F.aggregate(F.zip_with(col_of(a), col_of(b), lambda x, y: x * y),
                       F.lit(0.0).cast("double"), lambda acc, v: acc + v)


def norm2(a) -> Column:
    return F.sqrt(F.aggregate(col_of(a), F.lit(0.0).cast("double"), lambda acc, v: acc + v * v))


def cosine(a, b) -> Column:
    """Cosine similarity of two arrays; null when either has zero length."""
    den = norm2(a) * norm2(b)
    return F.when(den > 0, dot(a, b) / den)


def euclidean(a, b) -> Column:
    diff = F.zip_with(col_of(a), col_of(b), lambda x, y: (x - y) * (x - y))
    return F.sqrt(F.aggregate(diff, F.lit(0.0).cast("double"), lambda acc, v: acc + v))


def argmax(arr) -> Column:
    """0-based position of the first maximum."""
    a = col_of(arr)
    return F.array_position(a, F.array_max(a)) - 1


def clip(c, low: float = 0.0, high: float = 1.0) -> Column:
    return F.least(F.greatest(col_of(c), F.lit(low)), F.lit(high))
