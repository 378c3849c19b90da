"""Date and time expressions (all JVM-side, codegen-friendly).

Semantics follow SQL rather than pandas where the two differ:

* completed years count whole years with time of day included and truncate
  toward zero (``timestampdiff(YEAR, start, end)``);
* whole days truncate toward zero (``timestampdiff(DAY, start, end)``);
* "now" is never implicit — callers pass ``as_of``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from cohortkit.functions.scalar import col_of

# The two timestamp layouts the source extracts use.
DEFAULT_TIMESTAMP_FORMATS = ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd")


def completed_years(start, end) -> Column:
    """Whole years from ``start`` to ``end`` (negative when end precedes start)."""
    return F.timestamp_diff("YEAR", col_of(start), col_of(end))


def whole_days(start, end) -> Column:
    """Whole days from ``start`` to ``end``, truncated toward zero."""
    return F.timestamp_diff("DAY", col_of(start), col_of(end))


def age_at(birth, end=None, as_of=None) -> Column:
    """Completed years at ``end``; where ``end`` is null, at the explicit ``as_of``."""
    stop = col_of(end) if end is not None else None
    if as_of is not None:
        fallback = F.lit(as_of).cast("timestamp_ntz")
        stop = fallback if stop is None else F.coalesce(stop, fallback)
    if stop is None:
        raise ValueError("age_at needs an end column or an explicit as_of")
    return completed_years(birth, stop)


def parse_timestamp(text, formats: Sequence[str] = DEFAULT_TIMESTAMP_FORMATS) -> Column:
    """Parse text trying each layout in turn; unparsable text becomes null.

    Returns the wall-clock value as ``timestamp_ntz`` whatever the session
    time zone: the text is parsed with an explicit UTC offset and the instant's
    microseconds are added to the zone-free epoch (a plain cast would move
    wall-clock times that fall in a daylight-saving gap).
    """
    c = col_of(text)
    tried = [F.try_to_timestamp(F.concat(c, F.lit(" +00:00")), F.lit(f"{fmt} XXX")) for fmt in formats]
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_add("MICROSECOND", F.unix_micros(F.coalesce(*tried)), epoch)


def decimal_hour(ts) -> Column:
    """Time of day as hours with a fraction: 14:30 → 14.5."""
    c = col_of(ts)
    return F.hour(c) + F.minute(c) / F.lit(60.0)


def month_abbrev(ts) -> Column:
    """English three-letter month name (Jan … Dec)."""
    return F.date_format(col_of(ts), "MMM")


def bucket_floor(x, width: float) -> Column:
    """Lower edge of the ``width``-wide bucket holding ``x``: floor(x / w) * w."""
    return F.floor(col_of(x) / F.lit(width)) * F.lit(width)


def within(x, low, high) -> Column:
    """Inclusive range test; null when ``x`` is null."""
    return col_of(x).between(low, high)


def flag_between(x, low, high) -> Column:
    """1 when low ≤ x ≤ high, else 0; a null anywhere counts as 0."""
    return F.coalesce(col_of(x).between(col_of(low), col_of(high)), F.lit(False)).cast("int")
