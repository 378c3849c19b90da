"""The clinical roles mapped onto the driver's tables.

| role                                   | stand-in                                   |
|----------------------------------------|--------------------------------------------|
| patient (subject, gender)              | customer (c_custkey, c_mktsegment)         |
| ethnicity                              | nation.n_name through c_nationkey          |
| admission (id, subject, time, type)    | orders (o_orderkey, o_custkey, o_orderdate,|
|                                        | o_orderpriority); expired = status 'F'     |
| discharge                              | lineitem.l_shipdate                        |
| diagnosis / procedure / drug rows      | lineitem (l_linenumber = sequence number)  |
| code dictionary, drug name, weight     | part (p_name, p_type, p_size)              |
| lab / chart events                     | events (user_id, event_type, value, ts)    |
| notes                                  | documents, conversations                   |

"Cohort" = diagnosis rows (lineitem) whose code (p_name) starts with the
cohort prefix. Every accessor prunes columns at the scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortkit.operators.cohort import prefix_filter
from cohortkit.sources.io import read_table

# Fixed values of the stand-in mapping.
COHORT_PREFIX = "blue"
DISEASE_PREFIXES = ("blue", "red", "hot", "cold", "small", "large", "new", "old")
PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
EXPIRED_STATUS = "F"


class StandIns:
    """Column-pruned accessors for the driver's tables under ``base``."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark = spark
        self.base = base.rstrip("/")

    def t(self, name: str, *columns: str) -> DataFrame:
        return read_table(self.spark, self.base, name, list(columns) or None)

    # --- cohort building blocks -------------------------------------------------
    def diagnoses(self, *extra: str) -> DataFrame:
        """Diagnosis rows: (l_orderkey, l_partkey, ...) joined to their code name."""
        cols = ["l_orderkey", "l_partkey", *extra]
        lines = self.t("lineitem", *dict.fromkeys(cols))
        codes = self.t("part", "p_partkey", "p_name")
        return lines.join(codes, lines.l_partkey == codes.p_partkey).drop("p_partkey")

    def cohort_lines(self, *extra: str, prefixes: Sequence[str] | str = COHORT_PREFIX) -> DataFrame:
        """Diagnosis rows of the cohort: code name starts with the prefix(es).

        The prefix filter is applied to the ``part`` scan (pushed into Parquet
        as ``StringStartsWith``) before the join, so only matching codes meet
        the large table.
        """
        cols = ["l_orderkey", "l_partkey", *extra]
        lines = self.t("lineitem", *dict.fromkeys(cols))
        codes = prefix_filter(self.t("part", "p_partkey", "p_name"), "p_name", prefixes)
        return lines.join(codes, lines.l_partkey == codes.p_partkey).drop("p_partkey")

    def admissions(self, *cols: str) -> DataFrame:
        return self.t("orders", *(cols or ("o_orderkey", "o_custkey", "o_orderdate",
                                            "o_orderpriority", "o_orderstatus")))

    def patients(self, *cols: str) -> DataFrame:
        return self.t("customer", *(cols or ("c_custkey", "c_mktsegment", "c_nationkey")))

    def patients_with_group(self) -> DataFrame:
        """customer + nation name (the 'ethnicity' role)."""
        c = self.patients("c_custkey", "c_mktsegment", "c_nationkey")
        n = self.t("nation", "n_nationkey", "n_name")
        return c.join(n, c.c_nationkey == n.n_nationkey).drop("n_nationkey", "c_nationkey")

    def cohort_stays(self, *extra: str) -> DataFrame:
        """Cohort rows ⋈ admission ⋈ patient, discharge on or after admission."""
        lines = self.cohort_lines("l_shipdate", *extra)
        adm = self.admissions("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", "o_orderstatus")
        pat = self.patients("c_custkey", "c_mktsegment", "c_nationkey")
        j = lines.join(adm, lines.l_orderkey == adm.o_orderkey).drop("o_orderkey")
        j = j.join(pat, j.o_custkey == pat.c_custkey).drop("c_custkey")
        return j.where(F.col("l_shipdate") >= F.col("o_orderdate"))
