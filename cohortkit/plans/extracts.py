"""Cohort extracts, per-row features, parsing, bands and lookups.

Row-level keys (ages, stay lengths, flags, parsed values) are narrow
projections over whole tables: one scan, one or two joins, no shuffle beyond
the joins. Explicit broadcasts are limited to fixed literal lookup frames and
top-k sets (both bounded by construction).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortkit.functions.rules import Rule, RuleTable, value_map
from cohortkit.functions.scalar import code_truncate as truncate_code
from cohortkit.functions.scalar import coerce_numeric as to_number
from cohortkit.functions.temporal import completed_years, flag_between, parse_timestamp, whole_days
from cohortkit.operators.cohort import restrict_to_top_k, semi_join, top_k_keys
from cohortkit.operators.crosstab import box_stats as box_stats_op
from cohortkit.operators.crosstab import ranked_quantiles, share_of_total, value_ranks
from cohortkit.operators.crosstab import value_counts as value_counts_op
from cohortkit.plans.standins import SEGMENTS, StandIns

SQL: dict[str, str] = {}

# Stand-in rule tables and lookups.
MULTI_PREFIXES = ("blue b", "red", "hot g", "cold s", "small", "large r", "new", "old w")
CASE_RULES = RuleTable([
    Rule("Sepsis", prefixes=("blue r",)),
    Rule("Pneumonia", prefixes=("red",)),
    Rule("Urinary Tract Infection", equals=("hot gear", "cold bolt")),
    Rule("Skin Infection", prefixes=("small g", "large g")),
    Rule("Osteomyelitis", equals=("new ring",)),
], default="Other")
AGE_RANGE = (1, 4)
DEATH_WINDOW_DAYS = 30
SEGMENT_CODES = {s: i for i, s in enumerate(SEGMENTS)}
GLUCOSE_BANDS = RuleTable.bands((140, 200), ("Low Risk", "Risk", "High Risk"))
STATED_CLASS = {"view": "Low Risk", "click": "Low Risk", "purchase": "Risk", "signup": "High Risk", "error": "Risk"}
LAB_LABELS = (("click", "Potassium"), ("view", "Hematocrit"), ("purchase", "Glucose"), ("signup", "Creatinine"))
GLUCOSE_ITEMS = ("click", "purchase")
HEART_PREFIXES = ("red", "hot", "cold w", "old")
RHYTHM_ITEM = "view"
RHYTHM_BANDS = RuleTable.bands((10, 20, 40, 80, 160), (
    "Asystole", "Sinus Bradycardia", "Sinus Rhythm", "Sinus Tachycardia", "Atrial Fibrillation",
    "Ventricular Tachycardia"))
RHYTHM_CODES = {"Sinus Rhythm": 1, "Sinus Bradycardia": 2, "Sinus Tachycardia": 3,
                "Atrial Fibrillation": 4, "Ventricular Tachycardia": 5}
PRIORITY_CODES = {"1-URGENT": 0, "2-HIGH": 1, "3-MEDIUM": 2, "4-NOT SPECIFIED": 3}
RISK_TABLE = (
    (0, "Emergency", 4, "Needs immediate care"),
    (1, "Urgent", 3, "Needs care within hours"),
    (2, "Elective", 2, "Planned in advance"),
    (3, "Routine", 1, "No time constraint"),
)
RISK_DEFAULT = ("Unknown", 0, "No description available")


def _sql_case(rules: RuleTable, col: str) -> str:
    parts = []
    for r in rules.rules:
        conds = [f"{col} LIKE '{p}%'" for p in r.prefixes]
        if r.equals:
            conds.append(f"{col} IN (" + ", ".join(f"'{e}'" for e in r.equals) + ")")
        if r.low is not None or r.high is not None:
            rng = []
            if r.low is not None:
                rng.append(f"{col} >= {r.low}")
            if r.high is not None:
                rng.append(f"{col} < {r.high}")
            conds.append("(" + " AND ".join(rng) + ")")
        parts.append(f"WHEN {' OR '.join(conds)} THEN '{r.label}'")
    default = f" ELSE '{rules.default}'" if rules.default is not None else ""
    return "CASE " + " ".join(parts) + default + " END"


def _map_sql(mapping: dict, col: str) -> str:
    return "CASE " + " ".join(f"WHEN {col} = '{k}' THEN {v!r}" if not isinstance(v, str)
                              else f"WHEN {col} = '{k}' THEN '{v}'" for k, v in mapping.items()) + " END"


_COHORT_SQL = """SELECT DISTINCT o.o_custkey, o.o_orderkey FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
    JOIN orders o ON l.l_orderkey = o.o_orderkey WHERE {cond}"""


# ----------------------------------------------------------------- cohorts
def _cohort(st: StandIns, prefixes) -> DataFrame:
    lines = st.cohort_lines(prefixes=prefixes)
    adm = st.admissions("o_orderkey", "o_custkey")
    return lines.join(adm, F.col("l_orderkey") == F.col("o_orderkey")).select("o_custkey", "o_orderkey").distinct()


def cohort_prefix(spark: SparkSession, base: str) -> DataFrame:
    """Distinct (patient, admission) with a diagnosis code under the cohort prefix."""
    return _cohort(StandIns(spark, base), "blue")


SQL["cohort_prefix"] = _COHORT_SQL.format(cond="p.p_name LIKE 'blue%'")


def cohort_multi_prefix(spark: SparkSession, base: str) -> DataFrame:
    """Same for any of eight prefixes (an OR of ``startswith``, pushed to the scan)."""
    return _cohort(StandIns(spark, base), MULTI_PREFIXES)


SQL["cohort_multi_prefix"] = _COHORT_SQL.format(cond=" OR ".join(f"p.p_name LIKE '{p}%'" for p in MULTI_PREFIXES))


def prefix_case_labels(spark: SparkSession, base: str) -> DataFrame:
    """Ordered prefix / equality rules → label (first match wins), rows per label."""
    d = StandIns(spark, base).diagnoses()
    return d.groupBy(CASE_RULES.label("p_name").alias("label")).agg(F.count(F.lit(1)).alias("n"))


SQL["prefix_case_labels"] = f"""
SELECT {_sql_case(CASE_RULES, 'p.p_name')} AS label, count(*) AS n
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey GROUP BY ALL
"""


# ----------------------------------------------------------------- per-row temporal features
def _line_stays(st: StandIns) -> DataFrame:
    lines = st.t("lineitem", "l_orderkey", "l_linenumber", "l_shipdate")
    adm = st.admissions("o_orderkey", "o_orderdate")
    return lines.join(adm, F.col("l_orderkey") == F.col("o_orderkey"))


_LINE_SQL = "FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey"


def age_years(spark: SparkSession, base: str) -> DataFrame:
    s = _line_stays(StandIns(spark, base))
    return s.select("l_orderkey", "l_linenumber", completed_years("o_orderdate", "l_shipdate").alias("age_years"))


SQL["age_years"] = f"""SELECT l.l_orderkey, l.l_linenumber,
    extract(year from age(l.l_shipdate, o.o_orderdate)) AS age_years {_LINE_SQL}"""


def age_range_filter(spark: SparkSession, base: str) -> DataFrame:
    a = age_years(spark, base)
    return a.where(F.col("age_years").between(*AGE_RANGE))


SQL["age_range_filter"] = f"""SELECT * FROM ({SQL['age_years']}) WHERE age_years BETWEEN {AGE_RANGE[0]} AND {AGE_RANGE[1]}"""


def los_days(spark: SparkSession, base: str) -> DataFrame:
    s = _line_stays(StandIns(spark, base))
    return s.select("l_orderkey", "l_linenumber", whole_days("o_orderdate", "l_shipdate").alias("los_days"))


SQL["los_days"] = f"""SELECT l.l_orderkey, l.l_linenumber,
    date_sub('day', o.o_orderdate, l.l_shipdate) AS los_days {_LINE_SQL}"""


def died_during_stay(spark: SparkSession, base: str) -> DataFrame:
    """1 when the event time falls inside [admission, admission + 30 days]; null → 0."""
    s = _line_stays(StandIns(spark, base))
    end = F.timestamp_add("DAY", F.lit(DEATH_WINDOW_DAYS), F.col("o_orderdate"))
    return s.select("l_orderkey", "l_linenumber",
                    flag_between("l_shipdate", "o_orderdate", end).alias("died"))


SQL["died_during_stay"] = f"""SELECT l.l_orderkey, l.l_linenumber,
    CAST(coalesce(l.l_shipdate BETWEEN o.o_orderdate AND o.o_orderdate + INTERVAL {DEATH_WINDOW_DAYS} DAY, false) AS INTEGER) AS died
    {_LINE_SQL}"""


def stay_features(spark: SparkSession, base: str) -> DataFrame:
    """Tabular model input per cohort diagnosis row: stay days, age, encoded gender, sequence, label."""
    s = StandIns(spark, base).cohort_stays("l_linenumber")
    return s.select(
        "l_orderkey", "l_linenumber",
        whole_days("o_orderdate", "l_shipdate").alias("los"),
        completed_years("o_orderdate", "l_shipdate").alias("age"),
        value_map(SEGMENT_CODES, "c_mktsegment").cast("int").alias("gender"),
        F.col("l_linenumber").alias("seq_num"),
        (F.col("o_orderstatus") == "F").cast("int").alias("label"))


SQL["stay_features"] = f"""
SELECT l.l_orderkey, l.l_linenumber, date_sub('day', o.o_orderdate, l.l_shipdate) AS los,
       extract(year from age(l.l_shipdate, o.o_orderdate)) AS age,
       CAST({_map_sql(SEGMENT_CODES, 'c.c_mktsegment')} AS INTEGER) AS gender,
       l.l_linenumber AS seq_num, CAST(o.o_orderstatus = 'F' AS INTEGER) AS label
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey
WHERE p.p_name LIKE 'blue%' AND l.l_shipdate >= o.o_orderdate
"""


# ----------------------------------------------------------------- membership
TOP_SOURCES = 5


def semi_notes(spark: SparkSession, base: str) -> DataFrame:
    """Notes whose source is among the top sources by number of labelled notes."""
    st = StandIns(spark, base)
    docs = st.t("documents", "doc_id", "source", "lang")
    labelled = semi_join(docs, st.t("labels", "doc_id"), "doc_id")
    top = top_k_keys(labelled, "source", TOP_SOURCES).select("source")
    return docs.join(F.broadcast(top), "source", "left_semi")


SQL["semi_notes"] = f"""
WITH t AS (SELECT source FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)
           GROUP BY source ORDER BY count(*) DESC, source LIMIT {TOP_SOURCES})
SELECT doc_id, source, lang FROM documents WHERE source IN (SELECT source FROM t)
"""

TOP_PARTS = 10


def topk_semi(spark: SparkSession, base: str) -> DataFrame:
    """Rows whose item is among the ten most frequent (semi-join to a 10-row frame)."""
    lines = StandIns(spark, base).t("lineitem", "l_orderkey", "l_linenumber", "l_partkey")
    return restrict_to_top_k(lines, "l_partkey", TOP_PARTS)


SQL["topk_semi"] = f"""
SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_partkey IN (
  SELECT l_partkey FROM lineitem GROUP BY l_partkey ORDER BY count(*) DESC, l_partkey LIMIT {TOP_PARTS})
"""


# ----------------------------------------------------------------- parsing / coercion
def coerce_numeric(spark: SparkSession, base: str) -> DataFrame:
    """Numeric parse of a text field; text that is not a number becomes null."""
    e = StandIns(spark, base).t("events", "event_id", "props")
    return e.select("event_id", to_number(F.get_json_object("props", "$.k"), "int").alias("k"))


SQL["coerce_numeric"] = "SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events"


def dropna_subset(spark: SparkSession, base: str) -> DataFrame:
    return coerce_numeric(spark, base).na.drop(subset=["k"])


SQL["dropna_subset"] = f"SELECT * FROM ({SQL['coerce_numeric']}) WHERE k IS NOT NULL"


def _date_text(ts, event_id):
    return (F.when(event_id % 3 == 0, F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
            .when(event_id % 3 == 1, F.date_format(ts, "yyyy-MM-dd"))
            .otherwise(F.concat(F.lit("n/a "), F.date_format(ts, "yyyy-MM-dd"))))


def parse_dates(spark: SparkSession, base: str) -> DataFrame:
    """Timestamps from text in either of two layouts; anything else → null."""
    e = StandIns(spark, base).t("events", "event_id", "ts")
    t = e.select("event_id", _date_text(F.col("ts"), F.col("event_id")).alias("text"))
    return t.withColumn("parsed", parse_timestamp("text"))


SQL["parse_dates"] = """
WITH t AS (SELECT event_id, CASE WHEN event_id % 3 = 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
                                 WHEN event_id % 3 = 1 THEN strftime(ts, '%Y-%m-%d')
                                 ELSE 'n/a ' || strftime(ts, '%Y-%m-%d') END AS text FROM events)
SELECT event_id, text, coalesce(try_strptime(text, '%Y-%m-%d %H:%M:%S'), try_strptime(text, '%Y-%m-%d')) AS parsed FROM t
"""


# ----------------------------------------------------------------- value bands
def _banded(spark: SparkSession, base: str) -> DataFrame:
    e = StandIns(spark, base).t("events", "event_id", "event_type", "value")
    return e.withColumn("band", GLUCOSE_BANDS.label("value"))


_BAND_SQL = f"WITH b AS (SELECT event_id, event_type, value, {_sql_case(GLUCOSE_BANDS, 'value')} AS band FROM events)\n"


def risk_bands(spark: SparkSession, base: str) -> DataFrame:
    return _banded(spark, base).select("event_id", "value", "band")


SQL["risk_bands"] = _BAND_SQL + "SELECT event_id, value, band FROM b"


def consistency_filter(spark: SparkSession, base: str) -> DataFrame:
    """Rows whose stated class agrees with the band of their own value."""
    e = _banded(spark, base).withColumn("stated", value_map(STATED_CLASS, "event_type"))
    ok = ((F.col("stated") == "Low Risk") & (F.col("value") < 140)) \
        | ((F.col("stated") == "Risk") & (F.col("value") >= 140) & (F.col("value") < 200)) \
        | ((F.col("stated") == "High Risk") & (F.col("value") >= 200))
    return e.where(ok).select("event_id", "value", "stated")


SQL["consistency_filter"] = f"""
WITH s AS (SELECT event_id, value, {_map_sql(STATED_CLASS, 'event_type')} AS stated FROM events)
SELECT * FROM s WHERE (stated = 'Low Risk' AND value < 140) OR (stated = 'Risk' AND value >= 140 AND value < 200)
   OR (stated = 'High Risk' AND value >= 200)
"""


def class_share(spark: SparkSession, base: str) -> DataFrame:
    counts = _banded(spark, base).groupBy("band").agg(F.count(F.lit(1)).alias("n"))
    return share_of_total(counts, "n", "share_pct", digits=6)


SQL["class_share"] = _BAND_SQL + """SELECT band, count(*) AS n,
    round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS share_pct FROM b GROUP BY band"""


def box_stats(spark: SparkSession, base: str) -> DataFrame:
    return box_stats_op(_banded(spark, base), ["band"], "value")


SQL["box_stats"] = _BAND_SQL + """,
q AS (SELECT band, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
             quantile_cont(value, 0.75) AS q3 FROM b GROUP BY band)
SELECT q.band, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
       round(min(value), 6) AS whisker_low, round(max(value), 6) AS whisker_high
FROM q JOIN b ON q.band = b.band
WHERE value >= q1 - 1.5 * (q3 - q1) AND value <= q3 + 1.5 * (q3 - q1)
GROUP BY q.band, q1, median, q3
"""


def value_quartiles(spark: SparkSession, base: str) -> DataFrame:
    cells, spans = value_ranks(_banded(spark, base), ["band"], "value")
    q = ranked_quantiles(cells, spans, ["band"], {"median": 0.5, "first_quartile": 0.25, "third_quartile": 0.75},
                         (F.sum(F.col("value") * F.col("n")) / F.sum("n")).alias("mean"))
    return q.select("band", *[F.round(c, 6).alias(c) for c in ("mean", "median", "first_quartile", "third_quartile")])


SQL["value_quartiles"] = _BAND_SQL + """SELECT band, round(avg(value), 6) AS mean,
    round(quantile_cont(value, 0.5), 6) AS median, round(quantile_cont(value, 0.25), 6) AS first_quartile,
    round(quantile_cont(value, 0.75), 6) AS third_quartile FROM b GROUP BY band"""


# ----------------------------------------------------------------- frequencies
def value_counts(spark: SparkSession, base: str) -> DataFrame:
    e = StandIns(spark, base).t("events", "event_type")
    return value_counts_op(e, "event_type")


SQL["value_counts"] = "SELECT event_type, count(*) AS n FROM events WHERE event_type IS NOT NULL GROUP BY event_type"


def distinct_values(spark: SparkSession, base: str) -> DataFrame:
    c = StandIns(spark, base).t("customer", "c_mktsegment")
    return c.select(F.col("c_mktsegment").alias("segment")).distinct()


SQL["distinct_values"] = "SELECT DISTINCT c_mktsegment AS segment FROM customer"


# ----------------------------------------------------------------- joins and scans
def two_key_join(spark: SparkSession, base: str) -> DataFrame:
    """Rows joined to a distinct cohort on two keys at once."""
    st = StandIns(spark, base)
    cohort = st.cohort_lines().select("l_orderkey", "l_partkey").distinct()
    lines = st.t("lineitem", "l_orderkey", "l_partkey", "l_linenumber", "l_quantity")
    return lines.join(cohort, ["l_orderkey", "l_partkey"])


SQL["two_key_join"] = """
WITH c AS (SELECT DISTINCT l.l_orderkey, l.l_partkey FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
           WHERE p.p_name LIKE 'blue%')
SELECT l.l_orderkey, l.l_partkey, l.l_linenumber, l.l_quantity
FROM lineitem l JOIN c ON l.l_orderkey = c.l_orderkey AND l.l_partkey = c.l_partkey
"""


def _lab_labels(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(LAB_LABELS), "event_type string, label string")


def lab_label_left(spark: SparkSession, base: str) -> DataFrame:
    """Every event with its item label; items missing from the dictionary keep a null label."""
    e = StandIns(spark, base).t("events", "event_id", "event_type")
    return e.join(F.broadcast(_lab_labels(spark)), "event_type", "left").select("event_id", "event_type", "label")


_LABELS_SQL = "d(event_type, label) AS (VALUES " + ", ".join(f"('{a}', '{b}')" for a, b in LAB_LABELS) + ")"
SQL["lab_label_left"] = f"""WITH {_LABELS_SQL}
SELECT e.event_id, e.event_type, d.label FROM events e LEFT JOIN d ON e.event_type = d.event_type"""

FILTER_ITEMS = ("click", "view")


def item_event_filter(spark: SparkSession, base: str) -> DataFrame:
    """Events of two items, three columns (the chunked scan + filter, as one scan)."""
    e = StandIns(spark, base).t("events", "event_id", "user_id", "value", "event_type")
    return e.where(F.col("event_type").isin(list(FILTER_ITEMS))).select("event_id", "user_id", "value")


SQL["item_event_filter"] = f"""SELECT event_id, user_id, value FROM events
WHERE event_type IN ({', '.join(f"'{x}'" for x in FILTER_ITEMS)})"""


def scan_pruned(spark: SparkSession, base: str) -> DataFrame:
    return StandIns(spark, base).t("events", "user_id", "event_type", "value")


SQL["scan_pruned"] = "SELECT user_id, event_type, value FROM events"


# ----------------------------------------------------------------- cohort extracts
def glucose_tests(spark: SparkSession, base: str) -> DataFrame:
    """Cohort patients' glucose-type tests, labelled and banded."""
    st = StandIns(spark, base)
    pats = _cohort(st, "blue").select(F.col("o_custkey").alias("user_id")).distinct()
    e = st.t("events", "event_id", "user_id", "event_type", "value") \
        .where(F.col("event_type").isin(list(GLUCOSE_ITEMS)))
    e = e.join(pats, "user_id").join(F.broadcast(_lab_labels(spark)), "event_type")
    return e.select("user_id", "event_id", "label", "value", GLUCOSE_BANDS.label("value").alias("band"))


SQL["glucose_tests"] = f"""WITH {_LABELS_SQL},
  c AS ({_COHORT_SQL.format(cond="p.p_name LIKE 'blue%'")}),
  u AS (SELECT DISTINCT o_custkey FROM c)
SELECT e.user_id, e.event_id, d.label, e.value, {_sql_case(GLUCOSE_BANDS, 'e.value')} AS band
FROM events e JOIN u ON e.user_id = u.o_custkey JOIN d ON e.event_type = d.event_type
WHERE e.event_type IN ({', '.join(f"'{x}'" for x in GLUCOSE_ITEMS)})
"""


def rhythm_events(spark: SparkSession, base: str) -> DataFrame:
    """Heart-cohort patients' rhythm readings with the rhythm name mapped to a code."""
    st = StandIns(spark, base)
    pats = _cohort(st, HEART_PREFIXES).select(F.col("o_custkey").alias("user_id"))
    e = semi_join(st.t("events", "event_id", "user_id", "event_type", "value")
                  .where(F.col("event_type") == RHYTHM_ITEM), pats, "user_id")
    rhythm = RHYTHM_BANDS.label("value")
    return e.select("user_id", "event_id", rhythm.alias("rhythm"),
                    value_map(RHYTHM_CODES, rhythm).cast("int").alias("code"))


SQL["rhythm_events"] = f"""
WITH c AS ({_COHORT_SQL.format(cond=" OR ".join(f"p.p_name LIKE '{p}%'" for p in HEART_PREFIXES))}),
  r AS (SELECT user_id, event_id, {_sql_case(RHYTHM_BANDS, 'value')} AS rhythm FROM events
        WHERE event_type = '{RHYTHM_ITEM}' AND user_id IN (SELECT o_custkey FROM c))
SELECT user_id, event_id, rhythm, CAST({_map_sql(RHYTHM_CODES, 'rhythm')} AS INTEGER) AS code FROM r
"""


def kidney_extract(spark: SparkSession, base: str) -> DataFrame:
    """Cohort rows joined on (patient, admission), with a left-joined code label."""
    st = StandIns(spark, base)
    cohort = _cohort(st, "blue")
    lines = st.t("lineitem", "l_orderkey", "l_linenumber", "l_partkey")
    adm = st.admissions("o_orderkey", "o_custkey")
    rows = lines.join(adm, F.col("l_orderkey") == F.col("o_orderkey")).drop("l_orderkey")
    j = rows.join(cohort, ["o_custkey", "o_orderkey"])
    names = st.t("part", "p_partkey", "p_name")
    return j.join(names, F.col("l_partkey") == F.col("p_partkey"), "left") \
        .select("o_custkey", "o_orderkey", "l_linenumber", "p_name")


SQL["kidney_extract"] = f"""
WITH c AS ({_COHORT_SQL.format(cond="p.p_name LIKE 'blue%'")})
SELECT o.o_custkey, o.o_orderkey, l.l_linenumber, p.p_name
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN c ON o.o_custkey = c.o_custkey AND o.o_orderkey = c.o_orderkey
LEFT JOIN part p ON l.l_partkey = p.p_partkey
"""


# ----------------------------------------------------------------- codes and lookups
def _codes(spark: SparkSession, base: str) -> DataFrame:
    p = StandIns(spark, base).t("part", "p_partkey")
    code = F.when(F.col("p_partkey") % 10 == 0,
                  F.concat(F.lit("V"), F.lpad((F.col("p_partkey") % 10000).cast("string"), 4, "0"))) \
        .otherwise(F.lpad(F.col("p_partkey").cast("string"), 5, "0"))
    return p.select("p_partkey", code.alias("code"))


def code_truncate(spark: SparkSession, base: str) -> DataFrame:
    """Codes cut to three digits through an integer parse: '00845' → '845', 'V0010' → null."""
    c = _codes(spark, base)
    return c.withColumn("code3", truncate_code("code"))


SQL["code_truncate"] = """
WITH c AS (SELECT p_partkey, CASE WHEN p_partkey % 10 = 0 THEN 'V' || lpad(CAST(p_partkey % 10000 AS VARCHAR), 4, '0')
                                  ELSE lpad(CAST(p_partkey AS VARCHAR), 5, '0') END AS code FROM part)
SELECT p_partkey, code, left(CAST(TRY_CAST(code AS BIGINT) AS VARCHAR), 3) AS code3 FROM c
"""


def map_values(spark: SparkSession, base: str) -> DataFrame:
    """Dictionary mapping of a text column; unmapped values → null."""
    o = StandIns(spark, base).t("orders", "o_orderkey", "o_orderpriority")
    return o.withColumn("code", value_map(PRIORITY_CODES, "o_orderpriority").cast("int"))


SQL["map_values"] = f"""SELECT o_orderkey, o_orderpriority,
    CAST({_map_sql(PRIORITY_CODES, 'o_orderpriority')} AS INTEGER) AS code FROM orders"""


def risk_lookup(spark: SparkSession, base: str) -> DataFrame:
    """Code → (name, risk, description) from a fixed table, with a default for misses."""
    m = map_values(spark, base)
    table = spark.createDataFrame(list(RISK_TABLE), "code int, name string, risk int, description string")
    j = m.join(F.broadcast(table), "code", "left")
    n, r, d = RISK_DEFAULT
    return j.select("o_orderkey", "code",
                    F.coalesce("name", F.lit(n)).alias("name"),
                    F.coalesce("risk", F.lit(r)).alias("risk"),
                    F.coalesce("description", F.lit(d)).alias("description"))


SQL["risk_lookup"] = f"""
WITH m AS ({SQL['map_values']}),
     t(code, name, risk, description) AS (VALUES {', '.join(f"({a}, '{b}', {c}, '{d}')" for a, b, c, d in RISK_TABLE)})
SELECT m.o_orderkey, m.code, coalesce(t.name, '{RISK_DEFAULT[0]}') AS name,
       CAST(coalesce(t.risk, {RISK_DEFAULT[1]}) AS INTEGER) AS risk,
       coalesce(t.description, '{RISK_DEFAULT[2]}') AS description
FROM m LEFT JOIN t ON m.code = t.code
"""

QUERIES = {
    "cohort_prefix": cohort_prefix,
    "cohort_multi_prefix": cohort_multi_prefix,
    "prefix_case_labels": prefix_case_labels,
    "age_years": age_years,
    "age_range_filter": age_range_filter,
    "los_days": los_days,
    "died_during_stay": died_during_stay,
    "stay_features": stay_features,
    "semi_notes": semi_notes,
    "topk_semi": topk_semi,
    "coerce_numeric": coerce_numeric,
    "dropna_subset": dropna_subset,
    "parse_dates": parse_dates,
    "risk_bands": risk_bands,
    "consistency_filter": consistency_filter,
    "class_share": class_share,
    "box_stats": box_stats,
    "value_quartiles": value_quartiles,
    "value_counts": value_counts,
    "distinct_values": distinct_values,
    "two_key_join": two_key_join,
    "lab_label_left": lab_label_left,
    "item_event_filter": item_event_filter,
    "scan_pruned": scan_pruned,
    "glucose_tests": glucose_tests,
    "rhythm_events": rhythm_events,
    "kidney_extract": kidney_extract,
    "code_truncate": code_truncate,
    "map_values": map_values,
    "risk_lookup": risk_lookup,
}
