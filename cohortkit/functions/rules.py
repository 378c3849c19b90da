"""Ordered rule tables: one definition drives both a filter and a label.

A rule says "a value matching *this* gets *that* label". Rules are tried in
order and the first match wins, exactly like a SQL ``CASE WHEN ... LIKE 'p%'``
chain. The same table yields the OR-predicate used to select the cohort, so
a code can never be labelled without being selected (or the other way
round) unless ``strict_filter`` reproduces such a mismatch on purpose.

Rules compile to plain Catalyst expressions: ``startswith`` on a scan column
is pushed into the Parquet reader as ``StringStartsWith``.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortkit.functions.scalar import col_of


@dataclass(frozen=True)
class Rule:
    label: str
    prefixes: tuple[str, ...] = ()
    equals: tuple[str, ...] = ()
    low: float | None = None       # inclusive
    high: float | None = None      # exclusive, or inclusive with high_inclusive
    high_inclusive: bool = False   # SQL BETWEEN bounds (legacy bands may leave gaps)

    def predicate(self, c: Column) -> Column:
        parts: list[Column] = [c.startswith(p) for p in self.prefixes]
        if self.equals:
            parts.append(c.isin(list(self.equals)))
        if self.low is not None or self.high is not None:
            cond = F.lit(True)
            if self.low is not None:
                cond = cond & (c >= F.lit(self.low))
            if self.high is not None:
                cond = cond & ((c <= F.lit(self.high)) if self.high_inclusive else (c < F.lit(self.high)))
            parts.append(cond)
        if not parts:
            return F.lit(False)
        out = parts[0]
        for p in parts[1:]:
            out = out | p
        return out


@dataclass
class RuleTable:
    rules: Sequence[Rule]
    default: str | None = None
    ordinal_name: str = "ordinal"
    extra: dict = field(default_factory=dict)

    @staticmethod
    def prefixes(mapping: Iterable[tuple[str, Sequence[str] | str]], default=None) -> RuleTable:
        """Build from ``[(label, prefix-or-prefixes), ...]`` in priority order."""
        rules = []
        for label, pre in mapping:
            pre = (pre,) if isinstance(pre, str) else tuple(pre)
            rules.append(Rule(label, prefixes=pre))
        return RuleTable(rules, default)

    @staticmethod
    def bands(edges: Sequence[float], labels: Sequence[str]) -> RuleTable:
        """Half-open bands ``[e_i, e_{i+1})``; first band open below, last open above."""
        if len(labels) != len(edges) + 1:
            raise ValueError("need one more label than edges")
        rules = []
        for i, lab in enumerate(labels):
            low = edges[i - 1] if i > 0 else None
            high = edges[i] if i < len(edges) else None
            rules.append(Rule(lab, low=low, high=high))
        return RuleTable(rules)

    @staticmethod
    def between(bounds: Sequence[tuple[str, float | None, float | None]], default=None) -> RuleTable:
        """Bands written as inclusive ``BETWEEN low AND high`` (legacy form).

        Values between one band's ``high`` and the next band's ``low`` (e.g.
        49.95 between 40–49.9 and 50–59.9) match no band and get ``default``.
        """
        return RuleTable([Rule(lab, low=lo, high=hi, high_inclusive=True) for lab, lo, hi in bounds], default)

    @property
    def labels(self) -> list[str]:
        out: list[str] = []
        for r in self.rules:
            if r.label not in out:
                out.append(r.label)
        return out

    def label(self, c) -> Column:
        """First matching rule's label, else ``default`` (null when unset)."""
        c = col_of(c)
        expr = None
        for r in self.rules:
            expr = F.when(r.predicate(c), F.lit(r.label)) if expr is None \
                else expr.when(r.predicate(c), F.lit(r.label))
        if expr is None:
            return F.lit(self.default)
        return expr.otherwise(F.lit(self.default)) if self.default is not None else expr

    def ordinal(self, c) -> Column:
        """0-based position of the first matching rule (for explicit ordering)."""
        c = col_of(c)
        expr = None
        for i, r in enumerate(self.rules):
            expr = F.when(r.predicate(c), F.lit(i)) if expr is None else expr.when(r.predicate(c), F.lit(i))
        return expr.otherwise(F.lit(len(self.rules))) if expr is not None else F.lit(0)

    def select_labelled(self, df: DataFrame, c: str, out: str = "label",
                        strict_filter: RuleTable | None = None) -> DataFrame:
        """Rows matching the table, labelled by it (filter and label from one definition).

        ``strict_filter`` selects rows with a different (narrower) table while
        labels still come from this one — the reference's mismatch where some
        labelled codes can never pass its WHERE clause.
        """
        keep = (strict_filter or self).matches(c)
        return df.where(keep).withColumn(out, self.label(c))

    def matches(self, c) -> Column:
        """True when any rule matches — the cohort filter."""
        c = col_of(c)
        preds = [r.predicate(c) for r in self.rules]
        if not preds:
            return F.lit(False)
        out = preds[0]
        for p in preds[1:]:
            out = out | p
        return out

    def as_frame(self, spark: SparkSession, label_col: str = "label") -> DataFrame:
        """The label list with its ordinal, as a tiny DataFrame (fixed size → safe to broadcast)."""
        rows = [(lab, i) for i, lab in enumerate(self.labels)]
        schema = T.StructType([T.StructField(label_col, T.StringType()),
                               T.StructField(self.ordinal_name, T.IntegerType())])
        return spark.createDataFrame(rows, schema)


def value_map(mapping: dict, c, default=None) -> Column:
    """Dictionary lookup as a literal map; null key or miss → ``default``.

    ``try_element_at`` keeps misses null under ANSI mode; a null input key is
    matched only when ``None`` is in the mapping (handled by an explicit test,
    since map keys cannot be null).
    """
    c = col_of(c)
    plain = {k: v for k, v in mapping.items() if k is not None}
    m = F.create_map(*[x for kv in plain.items() for x in (F.lit(kv[0]), F.lit(kv[1]))])
    out = F.try_element_at(m, c)
    if None in mapping:
        out = F.when(c.isNull(), F.lit(mapping[None])).otherwise(out)
    if default is not None:
        out = F.coalesce(out, F.lit(default))
    return out


def lookup_frame(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType) -> DataFrame:
    """A fixed rule/lookup table as a DataFrame (bounded by construction)."""
    return spark.createDataFrame(list(rows), schema)
