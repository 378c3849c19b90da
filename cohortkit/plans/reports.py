"""Report tables 1–10: cohort cross-tabs on the stand-in tables.

Each function takes ``(spark, base)`` and returns a DataFrame; ``SQL`` holds
the equivalent DuckDB text used as the correctness oracle. Joins are written
as plain equi-joins — Catalyst prunes columns, pushes the code-prefix filter
into the ``part`` scan and AQE picks broadcast or sort-merge from runtime
sizes (dimension sides are only broadcast when their measured size is under
``spark.sql.autoBroadcastJoinThreshold``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortkit.functions.rules import Rule, RuleTable
from cohortkit.functions.temporal import bucket_floor, completed_years, whole_days
from cohortkit.operators.cohort import semi_join, top_k_keys
from cohortkit.operators.crosstab import (conditional_counts, distinct_pivot_counts, pivot_counts,
                                          ranked_quantiles, rate, value_ranks)
from cohortkit.plans.standins import (COHORT_PREFIX, DISEASE_PREFIXES, EXPIRED_STATUS,
                                      PRIORITIES, SEGMENTS, StandIns)
from cohortkit.sources.io import materialize

# Stand-in parameters of the report tables.
GENDER_SEGMENTS = {"male_count": "BUILDING", "female_count": "MACHINERY"}
AGE_WIDTH = 1            # completed years span 0..6 on the stand-ins
SIZE_WIDTH = 10          # "age band" of table 3 = p_size decade
PRIORITY_NAMES = ("urgent", "high", "medium", "not_specified", "low")
DISEASE_RULES = RuleTable.prefixes([(p, p) for p in DISEASE_PREFIXES])
LAB_ITEMS = (            # event_type, label, fluid
    ("click", "Potassium", "Blood"),
    ("view", "Hematocrit", "Blood"),
    ("purchase", "Sodium", "Blood"),
    ("signup", "Creatinine", "Blood"),
    ("error", "Protein", "Urine"),
)
ABNORMAL_ABOVE = 50.0
INFECTION_RULES = RuleTable([
    Rule("Sepsis", equals=("ring",)),
    Rule("Pneumonia", equals=("widget",)),
    Rule("Urinary Tract Infection", equals=("bolt",)),
    Rule("Skin Infection", equals=("gear", "gizmo")),
])
LOS_EDGES = (500, 1000, 1500)
LOS_LABELS = ("0-499", "500-999", "1000-1499", "1500+")


def _lab_items(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(LAB_ITEMS), "event_type string, label string, fluid string")


def _values_sql(rows) -> str:
    return ", ".join("(" + ", ".join(f"'{v}'" for v in r) + ")" for r in rows)


# ---------------------------------------------------------------- table 1
def rollup_age_gender(spark: SparkSession, base: str) -> DataFrame:
    s = StandIns(spark, base).cohort_stays()
    s = s.withColumn("age_group", bucket_floor(completed_years("o_orderdate", "l_shipdate"), AGE_WIDTH))
    return conditional_counts(s, ["age_group"], "c_mktsegment", GENDER_SEGMENTS, rollup=True)


_STAYS_SQL = """
    FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
    JOIN orders o ON l.l_orderkey = o.o_orderkey
    JOIN customer c ON o.o_custkey = c.c_custkey
    WHERE p.p_name LIKE 'blue%' AND l.l_shipdate >= o.o_orderdate
"""

SQL = {}
SQL["rollup_age_gender"] = f"""
WITH s AS (SELECT CAST(floor(extract(year from age(l.l_shipdate, o.o_orderdate)) / {AGE_WIDTH}) * {AGE_WIDTH} AS BIGINT) AS age_group,
                  c.c_mktsegment AS seg {_STAYS_SQL})
SELECT age_group,
       CAST(count_if(seg = 'BUILDING') AS BIGINT) AS male_count,
       CAST(count_if(seg = 'MACHINERY') AS BIGINT) AS female_count,
       CAST(GROUPING(age_group) AS INTEGER) AS is_total
FROM s GROUP BY ROLLUP(age_group) ORDER BY age_group NULLS LAST
"""


# ---------------------------------------------------------------- table 2
def group_count_topk(spark: SparkSession, base: str, k: int = 8) -> DataFrame:
    st = StandIns(spark, base)
    lines = st.cohort_lines()
    adm = st.admissions("o_orderkey", "o_custkey")
    j = lines.join(adm, lines.l_orderkey == adm.o_orderkey).join(
        st.patients_with_group(), F.col("o_custkey") == F.col("c_custkey"))
    top = top_k_keys(j.select(F.col("n_name").alias("ethnicity")), "ethnicity", k, name="patient_count")
    return top


SQL["group_count_topk"] = """
SELECT n.n_name AS ethnicity, count(*) AS patient_count
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
WHERE p.p_name LIKE 'blue%'
GROUP BY n.n_name ORDER BY patient_count DESC, ethnicity LIMIT 8
"""


def age_by_category(spark: SparkSession, base: str) -> DataFrame:
    s = StandIns(spark, base).cohort_stays()
    s = s.withColumn("age_group", bucket_floor(completed_years("o_orderdate", "l_shipdate"), AGE_WIDTH))
    cats = {seg.lower(): seg for seg in SEGMENTS}
    return conditional_counts(s, ["age_group"], "c_mktsegment", cats)


SQL["age_by_category"] = f"""
WITH s AS (SELECT CAST(floor(extract(year from age(l.l_shipdate, o.o_orderdate)) / {AGE_WIDTH}) * {AGE_WIDTH} AS BIGINT) AS age_group,
                  c.c_mktsegment AS seg {_STAYS_SQL})
SELECT age_group, {", ".join(f"CAST(count_if(seg = '{x}') AS BIGINT) AS {x.lower()}" for x in SEGMENTS)}
FROM s GROUP BY age_group
"""


# ---------------------------------------------------------------- table 3
def los_by_age_stats(spark: SparkSession, base: str) -> DataFrame:
    st = StandIns(spark, base)
    s = st.cohort_stays()
    sizes = st.t("part", "p_partkey", "p_size")
    s = s.join(sizes, s.l_partkey == sizes.p_partkey)
    s = s.select(bucket_floor("p_size", SIZE_WIDTH).alias("size_group"),
                 whole_days("o_orderdate", "l_shipdate").alias("los"))
    return s.groupBy("size_group").agg(
        F.round(F.avg("los"), 6).alias("avg_los"),
        F.round(F.stddev_samp("los"), 6).alias("stddev_los"),
        F.max("los").alias("max_los"),
        F.count(F.lit(1)).alias("patient_count"))


SQL["los_by_age_stats"] = f"""
WITH s AS (SELECT CAST(floor(p.p_size / {SIZE_WIDTH}) * {SIZE_WIDTH} AS BIGINT) AS size_group,
                  date_sub('day', o.o_orderdate, l.l_shipdate) AS los {_STAYS_SQL})
SELECT size_group, round(avg(los), 6) AS avg_los, round(stddev_samp(los), 6) AS stddev_los,
       max(los) AS max_los, count(*) AS patient_count
FROM s GROUP BY size_group
"""


# ---------------------------------------------------------------- table 4
def item_by_disease(spark: SparkSession, base: str) -> DataFrame:
    """Drug (p_type) × disease counts over diagnosis–prescription pairs of one admission.

    The pair count per (type, disease) is the reference's fan-out join count.
    It is computed without emitting the pairs: both sides are first reduced to
    (order, label, n) and the join multiplies the counts, so an admission
    contributes at most |diseases| × |types| rows whatever its size.
    """
    st = StandIns(spark, base)
    diag = st.diagnoses().where(DISEASE_RULES.matches("p_name")) \
        .select("l_orderkey", DISEASE_RULES.label("p_name").alias("disease")) \
        .groupBy("l_orderkey", "disease").agg(F.count(F.lit(1)).alias("nd"))
    lines = st.t("lineitem", "l_orderkey", "l_partkey")
    types = st.t("part", "p_partkey", "p_type")
    drugs = lines.join(types, lines.l_partkey == types.p_partkey) \
        .groupBy("l_orderkey", F.col("p_type").alias("item")).agg(F.count(F.lit(1)).alias("np"))
    pairs = diag.join(drugs, "l_orderkey").groupBy("item", "disease") \
        .agg(F.sum(F.col("nd") * F.col("np")).alias("n"))
    out = pairs.groupBy("item").pivot("disease", list(DISEASE_PREFIXES)).agg(F.first("n"))
    return out.select("item", *[F.coalesce(F.col(d), F.lit(0)).cast("bigint").alias(f"{d}_count")
                                for d in DISEASE_PREFIXES])


SQL["item_by_disease"] = """
WITH d AS (SELECT l.l_orderkey, CASE """ + " ".join(
    f"WHEN p.p_name LIKE '{x}%' THEN '{x}'" for x in DISEASE_PREFIXES) + """ END AS disease
           FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
           WHERE """ + " OR ".join(f"p.p_name LIKE '{x}%'" for x in DISEASE_PREFIXES) + """),
     r AS (SELECT l.l_orderkey, p.p_type AS item FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey)
SELECT item, """ + ", ".join(f"CAST(count_if(disease = '{x}') AS BIGINT) AS {x}_count" for x in DISEASE_PREFIXES) + """
FROM d JOIN r ON d.l_orderkey = r.l_orderkey GROUP BY item
"""


# ---------------------------------------------------------------- table 5
def procedure_by_type(spark: SparkSession, base: str, k: int = 20) -> DataFrame:
    st = StandIns(spark, base)
    cohort_adm = semi_join(st.admissions("o_orderkey", "o_orderpriority"),
                           st.cohort_lines().select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey")
    lines = st.t("lineitem", "l_orderkey", "l_partkey")
    names = st.t("part", "p_partkey", "p_name")
    proc = lines.join(cohort_adm, lines.l_orderkey == cohort_adm.o_orderkey) \
        .join(names, F.col("l_partkey") == F.col("p_partkey")) \
        .select(F.col("p_name").alias("procedure"), "o_orderpriority")
    wide = pivot_counts(proc, ["procedure"], "o_orderpriority", PRIORITIES, PRIORITY_NAMES)
    wide = wide.withColumn("total", sum((F.col(n) for n in PRIORITY_NAMES), F.lit(0)).cast("bigint"))
    return wide.orderBy(F.desc("total"), F.asc("procedure")).limit(k)


SQL["procedure_by_type"] = """
WITH a AS (SELECT DISTINCT o.o_orderkey, o.o_orderpriority FROM orders o
           WHERE o.o_orderkey IN (SELECT l.l_orderkey FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
                                  WHERE p.p_name LIKE 'blue%'))
SELECT p.p_name AS procedure, """ + ", ".join(
    f"CAST(count_if(a.o_orderpriority = '{v}') AS BIGINT) AS {n}" for v, n in zip(PRIORITIES, PRIORITY_NAMES)) + """,
       count(*) AS total
FROM lineitem l JOIN a ON l.l_orderkey = a.o_orderkey JOIN part p ON l.l_partkey = p.p_partkey
GROUP BY p.p_name ORDER BY total DESC, procedure LIMIT 20
"""


# ---------------------------------------------------------------- table 6
def lab_abnormal_stats(spark: SparkSession, base: str, k: int = 20) -> DataFrame:
    """Per lab item of cohort patients: totals, abnormal share, abnormal-value quantiles.

    The cohort's events are written once as (item, value). Totals come from
    them and are cut to the top ``k`` items, before the dictionary join and
    before the quantiles, whose cells are made for those items only.
    """
    st = StandIns(spark, base)
    items = _lab_items(spark)
    cohort_pat = st.cohort_lines().join(st.admissions("o_orderkey", "o_custkey"),
                                        F.col("l_orderkey") == F.col("o_orderkey")) \
        .select(F.col("o_custkey").alias("user_id"))
    ev = semi_join(st.t("events", "user_id", "event_type", "value"), cohort_pat, "user_id")
    ev = materialize(ev.select("event_type", "value"), name="lab-events")
    ev = ev.join(F.broadcast(items.where(F.col("fluid") == "Blood").select("event_type")),
                 "event_type", "left_semi")
    ab = F.col("value") > F.lit(ABNORMAL_ABOVE)
    abv = F.when(ab, F.col("value"))
    stats = ev.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("total_test_count"),
        F.count_if(ab).alias("abnormal_test_count"),
        F.min(abv).alias("min_abnormal_value"),
        F.max(abv).alias("max_abnormal_value"))
    top = stats.orderBy(F.desc("total_test_count"), F.asc("event_type")).limit(k)
    # the quantiles need the abnormal values of the top items only, counted per (item, value)
    abnormal = ev.where(ab).join(F.broadcast(top.select("event_type")), "event_type", "left_semi")
    cells, spans = value_ranks(abnormal, ["event_type"], "value")
    top = top.join(ranked_quantiles(cells, spans, ["event_type"], {
        "median_abnormal_value": 0.5, "first_quartile": 0.25, "third_quartile": 0.75}), "event_type", "left")
    out = top.join(F.broadcast(items.select("event_type", "label")), "event_type")
    return out.select(
        F.col("label").alias("electrolyte"), "total_test_count", "abnormal_test_count",
        rate("abnormal_test_count", "total_test_count", digits=6).alias("abnormal_rate"),
        *[F.round(c, 6).alias(c) for c in ("median_abnormal_value", "first_quartile", "third_quartile")],
        "min_abnormal_value", "max_abnormal_value")


SQL["lab_abnormal_stats"] = f"""
WITH d(event_type, label, fluid) AS (VALUES {_values_sql(LAB_ITEMS)}),
     coh AS (SELECT DISTINCT o.o_custkey FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
             JOIN orders o ON l.l_orderkey = o.o_orderkey WHERE p.p_name LIKE 'blue%'),
     e AS (SELECT * FROM events WHERE user_id IN (SELECT o_custkey FROM coh)
             AND event_type IN (SELECT event_type FROM d WHERE fluid = 'Blood')),
     t AS (SELECT event_type, count(*) AS total_test_count,
                  count(*) FILTER (WHERE value > {ABNORMAL_ABOVE}) AS abnormal_test_count,
                  percentile_cont(0.5) WITHIN GROUP (ORDER BY value) FILTER (WHERE value > {ABNORMAL_ABOVE}) AS med,
                  percentile_cont(0.25) WITHIN GROUP (ORDER BY value) FILTER (WHERE value > {ABNORMAL_ABOVE}) AS q1,
                  percentile_cont(0.75) WITHIN GROUP (ORDER BY value) FILTER (WHERE value > {ABNORMAL_ABOVE}) AS q3,
                  min(value) FILTER (WHERE value > {ABNORMAL_ABOVE}) AS mn,
                  max(value) FILTER (WHERE value > {ABNORMAL_ABOVE}) AS mx
           FROM e GROUP BY event_type ORDER BY total_test_count DESC, event_type LIMIT 20)
SELECT d.label AS electrolyte, t.total_test_count, t.abnormal_test_count,
       round(t.abnormal_test_count * 100.0 / t.total_test_count, 6) AS abnormal_rate,
       round(med, 6) AS median_abnormal_value, round(q1, 6) AS first_quartile, round(q3, 6) AS third_quartile,
       mn AS min_abnormal_value, mx AS max_abnormal_value
FROM t JOIN d ON t.event_type = d.event_type
"""


# ---------------------------------------------------------------- table 7
def insurance_outcomes(spark: SparkSession, base: str) -> DataFrame:
    """Mortality and readmission by insurance (= order priority) for cohort admissions.

    Readmission counts *distinct* admissions per patient (the reference's
    subject join multiplied them; the ``> 1`` flag is unaffected). Both the
    reference's row rate (admission rows ÷ distinct patients) and a patient
    rate (readmitted patients ÷ patients) are returned.
    """
    st = StandIns(spark, base)
    adm_all = st.admissions("o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus")
    cohort = semi_join(adm_all, st.cohort_lines().select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey")
    per_patient = adm_all.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("admission_count"))
    c = cohort.join(per_patient, "o_custkey", "left")
    died = F.col("o_orderstatus") == EXPIRED_STATUS
    readm = F.col("admission_count") > 1
    rows = c.groupBy(F.col("o_orderpriority").alias("insurance_type")).agg(
        F.count_if(died).alias("died_count"),
        F.count_if(~died).alias("survived_count"),
        F.count(F.lit(1)).alias("total_patients_mortality"),
        F.count_if(readm).alias("readmission_count"),
        F.count_if(F.col("admission_count") == 1).alias("not_readmission_count"))
    # Distinct patients per insurance, and how many of them were readmitted: the
    # readmission flag is a per-patient value, so one distinct (insurance,
    # patient, flag) pass replaces two COUNT(DISTINCT) aggregates (which Spark
    # would plan with an Expand over every admission row).
    pats = c.select(F.col("o_orderpriority").alias("insurance_type"), "o_custkey", readm.alias("readm")).distinct() \
        .groupBy("insurance_type").agg(F.count(F.lit(1)).alias("total_patients_readmission"),
                                       F.count_if("readm").alias("readmitted_patients"))
    out = rows.join(pats, "insurance_type")
    return out.select(
        "insurance_type", "died_count", "survived_count", "total_patients_mortality",
        rate("survived_count", "total_patients_mortality", digits=6).alias("survival_rate"),
        "readmission_count", "not_readmission_count", "total_patients_readmission",
        rate("readmission_count", "total_patients_readmission", digits=6).alias("readmission_percentage"),
        rate("readmitted_patients", "total_patients_readmission", digits=6).alias("patient_readmission_rate"))


SQL["insurance_outcomes"] = f"""
WITH coh AS (SELECT * FROM orders WHERE o_orderkey IN (
               SELECT l.l_orderkey FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey WHERE p.p_name LIKE 'blue%')),
     r AS (SELECT o_custkey, count(*) AS admission_count FROM orders GROUP BY o_custkey),
     c AS (SELECT coh.*, r.admission_count FROM coh LEFT JOIN r ON coh.o_custkey = r.o_custkey),
     g AS (SELECT o_orderpriority AS insurance_type,
                  count(*) FILTER (WHERE o_orderstatus = '{EXPIRED_STATUS}') AS died_count,
                  count(*) FILTER (WHERE o_orderstatus <> '{EXPIRED_STATUS}') AS survived_count,
                  count(*) AS total_patients_mortality,
                  count(*) FILTER (WHERE admission_count > 1) AS readmission_count,
                  count(*) FILTER (WHERE admission_count = 1) AS not_readmission_count,
                  count(DISTINCT o_custkey) AS total_patients_readmission,
                  count(DISTINCT CASE WHEN admission_count > 1 THEN o_custkey END) AS readmitted_patients
           FROM c GROUP BY o_orderpriority)
SELECT insurance_type, died_count, survived_count, total_patients_mortality,
       round(survived_count * 100.0 / total_patients_mortality, 6) AS survival_rate,
       readmission_count, not_readmission_count, total_patients_readmission,
       round(readmission_count * 100.0 / total_patients_readmission, 6) AS readmission_percentage,
       round(readmitted_patients * 100.0 / total_patients_readmission, 6) AS patient_readmission_rate
FROM g
"""


# ---------------------------------------------------------------- table 8
def infection_by_disease(spark: SparkSession, base: str) -> DataFrame:
    """Distinct patients per (infection, disease), diseases as columns.

    Both sides are reduced to distinct (patient, label) before the patient
    join, so a patient contributes at most |infections| × |diseases| rows.
    """
    st = StandIns(spark, base)
    lines = st.diagnoses().join(st.admissions("o_orderkey", "o_custkey"),
                                F.col("l_orderkey") == F.col("o_orderkey"))
    noun = F.split_part(F.col("p_name"), F.lit(" "), F.lit(2))
    inf = lines.select("o_custkey", noun.alias("noun")).where(INFECTION_RULES.matches("noun")) \
        .select("o_custkey", INFECTION_RULES.label("noun").alias("infection_type")).distinct()
    dis = lines.where(DISEASE_RULES.matches("p_name")) \
        .select("o_custkey", DISEASE_RULES.label("p_name").alias("disease")).distinct()
    both = inf.join(dis, "o_custkey")     # distinct (patient, infection, disease) by construction
    return distinct_pivot_counts(both, ["infection_type"], "disease", list(DISEASE_PREFIXES), "o_custkey",
                                 [f"{d}_patients" for d in DISEASE_PREFIXES], already_distinct=True)


SQL["infection_by_disease"] = """
WITH x AS (SELECT o.o_custkey, p.p_name, split_part(p.p_name, ' ', 2) AS noun
           FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey JOIN orders o ON l.l_orderkey = o.o_orderkey),
     i AS (SELECT DISTINCT o_custkey, CASE """ + " ".join(
    "WHEN noun IN (" + ", ".join(f"'{e}'" for e in r.equals) + f") THEN '{r.label}'" for r in INFECTION_RULES.rules) + """ END AS infection_type
           FROM x WHERE noun IN (""" + ", ".join(f"'{e}'" for r in INFECTION_RULES.rules for e in r.equals) + """)),
     d AS (SELECT DISTINCT o_custkey, CASE """ + " ".join(f"WHEN p_name LIKE '{x}%' THEN '{x}'" for x in DISEASE_PREFIXES) + """ END AS disease
           FROM x WHERE """ + " OR ".join(f"p_name LIKE '{x}%'" for x in DISEASE_PREFIXES) + """)
SELECT infection_type, """ + ", ".join(
    f"count(DISTINCT CASE WHEN disease = '{x}' THEN i.o_custkey END) AS {x}_patients" for x in DISEASE_PREFIXES) + """
FROM i JOIN d ON i.o_custkey = d.o_custkey GROUP BY infection_type
"""


# ---------------------------------------------------------------- table 9
WEIGHT_BANDS = (0, 10, 20, 30, 40, 50)      # the first also holds what lies below, the last all above


def comorbidity_buckets(spark: SparkSession, base: str, k: int = 10) -> DataFrame:
    """Top ``k`` other codes of cohort patients: distinct patients, total and per size band."""
    st = StandIns(spark, base)
    adm = st.admissions("o_orderkey", "o_custkey")
    cohort_pat = st.cohort_lines().join(adm, F.col("l_orderkey") == F.col("o_orderkey")).select("o_custkey")
    lines = st.t("lineitem", "l_orderkey", "l_partkey")
    parts = st.t("part", "p_partkey", "p_name", "p_size")
    other = lines.join(parts, F.col("l_partkey") == F.col("p_partkey")) \
        .where(~F.col("p_name").startswith(COHORT_PREFIX)) \
        .join(adm, F.col("l_orderkey") == F.col("o_orderkey"))
    size = F.col("p_size")
    inside = [(size < hi if lo == WEIGHT_BANDS[0] else size >= lo) & (F.lit(True) if hi is None else size < hi)
              for lo, hi in zip(WEIGHT_BANDS, (*WEIGHT_BANDS[1:], None), strict=True)]
    # one row per patient and code, with a bit for each band met: patients and bands are counted in one pass
    held = sum((F.when(c, F.lit(1 << i)).otherwise(F.lit(0)) for i, c in enumerate(inside)), F.lit(0))
    per = (semi_join(other, cohort_pat, "o_custkey").groupBy(F.col("p_name").alias("comorbidity"), "o_custkey")
           .agg(F.bit_or(held).alias("bands")))
    return per.groupBy("comorbidity").agg(
        F.count("o_custkey").alias("patient_count"),
        *[F.count_if(F.col("bands").bitwiseAND(F.lit(1 << i)) != 0).alias(f"band_{b}") for i, b in enumerate(WEIGHT_BANDS)]) \
        .orderBy(F.desc("patient_count"), F.asc("comorbidity")).limit(k)


SQL["comorbidity_buckets"] = """
WITH coh AS (SELECT DISTINCT o.o_custkey FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
             JOIN orders o ON l.l_orderkey = o.o_orderkey WHERE p.p_name LIKE 'blue%'),
     x AS (SELECT p.p_name AS comorbidity, o.o_custkey, CASE WHEN p.p_size < 10 THEN 0 WHEN p.p_size >= 50 THEN 50
                                                               ELSE CAST(floor(p.p_size / 10) * 10 AS BIGINT) END AS band
           FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey JOIN orders o ON l.l_orderkey = o.o_orderkey
           WHERE p.p_name NOT LIKE 'blue%' AND o.o_custkey IN (SELECT o_custkey FROM coh))
SELECT comorbidity, count(DISTINCT o_custkey) AS patient_count, """ + ", ".join(
    f"count(DISTINCT CASE WHEN band = {b} THEN o_custkey END) AS band_{b}" for b in WEIGHT_BANDS) + """
FROM x GROUP BY comorbidity ORDER BY patient_count DESC, comorbidity LIMIT 10
"""


# ---------------------------------------------------------------- table 10
LOS_RULES = RuleTable.bands(LOS_EDGES, LOS_LABELS)


def los_mortality(spark: SparkSession, base: str) -> DataFrame:
    """Deaths and rates per stay-length band of distinct cohort admissions.

    Stay = admission to the last discharge row of the admission.
    """
    st = StandIns(spark, base)
    adm = semi_join(st.admissions("o_orderkey", "o_orderdate", "o_orderstatus"),
                    st.cohort_lines().select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey")
    last = st.t("lineitem", "l_orderkey", "l_shipdate").groupBy("l_orderkey") \
        .agg(F.max("l_shipdate").alias("discharge"))
    stays = adm.join(last, F.col("o_orderkey") == F.col("l_orderkey")) \
        .select("o_orderstatus", whole_days("o_orderdate", "discharge").alias("los")) \
        .where(F.col("los") >= 0)
    died = F.col("o_orderstatus") == EXPIRED_STATUS
    g = stays.groupBy(LOS_RULES.label("los").alias("los_category"),
                      LOS_RULES.ordinal("los").alias("ordinal")).agg(
        F.count_if(died).alias("died"), F.count_if(~died).alias("survived"),
        F.count(F.lit(1)).alias("total"))
    return g.select("los_category", "ordinal", "died", "survived", "total",
                    rate("survived", "total", digits=6).alias("survival_rate"),
                    rate("died", "total", digits=6).alias("mortality_rate"))


SQL["los_mortality"] = f"""
WITH a AS (SELECT * FROM orders WHERE o_orderkey IN (
             SELECT l.l_orderkey FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey WHERE p.p_name LIKE 'blue%')),
     d AS (SELECT l_orderkey, max(l_shipdate) AS discharge FROM lineitem GROUP BY l_orderkey),
     s AS (SELECT a.o_orderstatus, date_sub('day', a.o_orderdate, d.discharge) AS los
           FROM a JOIN d ON a.o_orderkey = d.l_orderkey WHERE date_sub('day', a.o_orderdate, d.discharge) >= 0),
     b AS (SELECT *, CASE WHEN los < {LOS_EDGES[0]} THEN '{LOS_LABELS[0]}' WHEN los < {LOS_EDGES[1]} THEN '{LOS_LABELS[1]}'
                          WHEN los < {LOS_EDGES[2]} THEN '{LOS_LABELS[2]}' ELSE '{LOS_LABELS[3]}' END AS los_category,
                     CASE WHEN los < {LOS_EDGES[0]} THEN 0 WHEN los < {LOS_EDGES[1]} THEN 1
                          WHEN los < {LOS_EDGES[2]} THEN 2 ELSE 3 END AS ordinal FROM s)
SELECT los_category, ordinal, count(*) FILTER (WHERE o_orderstatus = '{EXPIRED_STATUS}') AS died,
       count(*) FILTER (WHERE o_orderstatus <> '{EXPIRED_STATUS}') AS survived, count(*) AS total,
       round(count(*) FILTER (WHERE o_orderstatus <> '{EXPIRED_STATUS}') * 100.0 / count(*), 6) AS survival_rate,
       round(count(*) FILTER (WHERE o_orderstatus = '{EXPIRED_STATUS}') * 100.0 / count(*), 6) AS mortality_rate
FROM b GROUP BY los_category, ordinal ORDER BY ordinal
"""

QUERIES = {
    "rollup_age_gender": rollup_age_gender,
    "group_count_topk": group_count_topk,
    "age_by_category": age_by_category,
    "los_by_age_stats": los_by_age_stats,
    "item_by_disease": item_by_disease,
    "procedure_by_type": procedure_by_type,
    "lab_abnormal_stats": lab_abnormal_stats,
    "insurance_outcomes": insurance_outcomes,
    "infection_by_disease": infection_by_disease,
    "comorbidity_buckets": comorbidity_buckets,
    "los_mortality": los_mortality,
}
