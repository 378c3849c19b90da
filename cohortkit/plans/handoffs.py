"""Prompt templates, table generators, profiling and file hand-offs.

Generators derive their rows from a given table (one synthetic row per
patient), so their work grows with the data; random draws are md5 of the
key, reproducible on any layout. Round-trip keys write to a fresh folder
under the shared ``spark.checkpoint.dir`` and read the files back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortkit.functions.scalar import hash_bucket, hash_fraction
from cohortkit.plans import extracts
from cohortkit.plans.extracts import GLUCOSE_BANDS, _sql_case
from cohortkit.sources.io import materialize, read_csv, read_jsonl, stage_path, write_csv, write_jsonl
from cohortkit.session import ensure_checkpoint_dir
from cohortkit.plans.standins import StandIns

SQL: dict[str, str] = {}

# Prompt templates and the rhythm explanation table.
PROMPT_TEMPLATE = "Patient %d had a random blood sugar of %.2f mg/dL, classified as %s."
RHYTHM_INFO = (
    (1, "Sinus Rhythm", 1, "Normal electrical activity of the heart."),
    (2, "Sinus Bradycardia", 2, "Slow but regular heart rate."),
    (3, "Sinus Tachycardia", 2, "Fast but regular heart rate."),
    (4, "Atrial Fibrillation", 3, "Irregular rhythm with a risk of clots."),
)
RHYTHM_DEFAULT = ("Unknown", 0, "No reference information.")
COT_TEMPLATE = "Reading %s: rhythm %s, risk level %d. %s"
ICL_EXAMPLES = 5
ICL_SEP = "\n"
SYMPTOMS = ("chest pain", "palpitations", "shortness of breath", "dizziness", "fatigue")
SUGAR_LOW, SUGAR_HIGH = 50, 350
RHYTHM_ITEMID = 211


def _hash_int_sql(key: str, seed: str, mod: int) -> str:
    return f"((('0x' || substr(md5('{seed}:' || CAST({key} AS VARCHAR)), 1, 8))::BIGINT) % {mod})"


# ----------------------------------------------------------------- templates
def prompt_rows(spark: SparkSession, base: str) -> DataFrame:
    e = StandIns(spark, base).t("events", "event_id", "user_id", "value")
    band = GLUCOSE_BANDS.label("value")
    return e.select("event_id", F.format_string(PROMPT_TEMPLATE, "user_id", "value", band).alias("prompt"))


SQL["prompt_rows"] = f"""SELECT event_id, printf('{PROMPT_TEMPLATE}', user_id, value, {_sql_case(GLUCOSE_BANDS, 'value')}) AS prompt
FROM events"""


def _cot(spark: SparkSession, base: str) -> DataFrame:
    r = extracts.rhythm_events(spark, base)
    e = StandIns(spark, base).t("events", "event_id", "value")
    info = spark.createDataFrame(list(RHYTHM_INFO), "code int, name string, risk int, info string")
    j = r.join(e, "event_id").join(F.broadcast(info), "code", "left")
    n, k, t = RHYTHM_DEFAULT
    return j.select("user_id", "event_id", F.format_string(
        COT_TEMPLATE, F.format_string("%.2f", "value"), F.coalesce("name", F.lit(n)),
        F.coalesce("risk", F.lit(k)), F.coalesce("info", F.lit(t))).alias("prompt"))


def cot_prompts(spark: SparkSession, base: str) -> DataFrame:
    """Reasoning text per rhythm reading from a code → (name, risk, explanation) table with a default."""
    return _cot(spark, base)


_COT_SQL = f"""
WITH r AS ({extracts.SQL['rhythm_events']}),
     info(code, name, risk, info) AS (VALUES {', '.join(f"({a}, '{b}', {c}, '{d}')" for a, b, c, d in RHYTHM_INFO)}),
     cot AS (SELECT r.user_id, r.event_id,
                    printf('{COT_TEMPLATE}', printf('%.2f', e.value), coalesce(info.name, '{RHYTHM_DEFAULT[0]}'),
                           coalesce(info.risk, {RHYTHM_DEFAULT[1]}), coalesce(info.info, '{RHYTHM_DEFAULT[2]}')) AS prompt
             FROM r JOIN events e ON r.event_id = e.event_id LEFT JOIN info ON r.code = info.code)
"""
SQL["cot_prompts"] = _COT_SQL + "SELECT user_id, event_id, prompt FROM cot"


def icl_sample(spark: SparkSession, base: str) -> DataFrame:
    """Five reproducibly sampled examples joined into a few-shot block, prefixed to every other case.

    The block is built from a 5-row frame and attached as a scalar subquery.
    """
    cot = _cot(spark, base).withColumn("_h", hash_fraction("event_id", "icl"))
    examples = cot.orderBy("_h", "event_id").limit(ICL_EXAMPLES)
    block = examples.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_h", "event_id", "prompt"))),
                                                  lambda s: s["prompt"]), ICL_SEP)).scalar()
    cases = cot.join(examples.select("event_id"), "event_id", "left_anti")
    return cases.select("event_id", F.concat(block, F.lit(ICL_SEP + ICL_SEP + "New case: "), F.col("prompt")).alias("prompt"))


SQL["icl_sample"] = _COT_SQL + f""",
  h AS (SELECT *, ((('0x' || substr(md5('icl:' || CAST(event_id AS VARCHAR)), 1, 8))::BIGINT) / 4294967296.0) AS hf FROM cot),
  ex AS (SELECT * FROM h ORDER BY hf, event_id LIMIT {ICL_EXAMPLES}),
  blk AS (SELECT string_agg(prompt, chr(10) ORDER BY hf, event_id) AS b FROM ex)
SELECT event_id, blk.b || chr(10) || chr(10) || 'New case: ' || prompt AS prompt
FROM h, blk WHERE event_id NOT IN (SELECT event_id FROM ex)
"""


# ----------------------------------------------------------------- generators
def synth_values(spark: SparkSession, base: str) -> DataFrame:
    """One synthetic blood-sugar reading per patient, uniform 50..350 by key hash, banded."""
    c = StandIns(spark, base).t("customer", "c_custkey")
    v = hash_bucket("c_custkey", SUGAR_HIGH - SUGAR_LOW + 1, "sugar") + SUGAR_LOW
    out = c.select(F.col("c_custkey").alias("subject_id"), v.cast("int").alias("random_blood_sugar"))
    return out.withColumn("classification", GLUCOSE_BANDS.label("random_blood_sugar"))


SQL["synth_values"] = f"""
WITH s AS (SELECT c_custkey AS subject_id, CAST({_hash_int_sql('c_custkey', 'sugar', SUGAR_HIGH - SUGAR_LOW + 1)} + {SUGAR_LOW} AS INTEGER)
                  AS random_blood_sugar FROM customer)
SELECT subject_id, random_blood_sugar, {_sql_case(GLUCOSE_BANDS, 'random_blood_sugar')} AS classification FROM s
"""


def synth_symptoms(spark: SparkSession, base: str) -> DataFrame:
    """One synthetic rhythm record per patient: constant item, code 1..25, risk 1..4, templated text."""
    c = StandIns(spark, base).t("customer", "c_custkey")
    symptoms = F.array(*[F.lit(s) for s in SYMPTOMS])
    idx = hash_bucket("c_custkey", len(SYMPTOMS), "symptom")
    return c.select(
        F.col("c_custkey").alias("subject_id"), F.lit(RHYTHM_ITEMID).alias("itemid"),
        (hash_bucket("c_custkey", 25, "value") + 1).cast("int").alias("value"),
        (hash_bucket("c_custkey", 4, "risk") + 1).cast("int").alias("risk_class"),
        F.concat(F.lit("Patient reports "), F.element_at(symptoms, (idx + 1).cast("int")), F.lit(".")).alias("text"))


SQL["synth_symptoms"] = f"""
SELECT c_custkey AS subject_id, {RHYTHM_ITEMID} AS itemid,
       CAST({_hash_int_sql('c_custkey', 'value', 25)} + 1 AS INTEGER) AS value,
       CAST({_hash_int_sql('c_custkey', 'risk', 4)} + 1 AS INTEGER) AS risk_class,
       'Patient reports ' || [{', '.join(f"'{s}'" for s in SYMPTOMS)}][{_hash_int_sql('c_custkey', 'symptom', len(SYMPTOMS))} + 1] || '.' AS text
FROM customer
"""


# ----------------------------------------------------------------- profile
def profile_nulls(spark: SparkSession, base: str) -> DataFrame:
    """Per column of ``orders``: type, non-null count and row count, in one aggregation pass."""
    o = StandIns(spark, base).t("orders")
    counts = o.agg(F.count(F.lit(1)).alias("__rows"), *[F.count(c).alias(c) for c in o.columns])
    stack = ", ".join(f"'{f.name}', '{f.dataType.simpleString()}', `{f.name}`" for f in o.schema.fields)
    return counts.selectExpr("__rows AS rows", f"stack({len(o.columns)}, {stack}) AS (column_name, type, non_null)") \
        .select("column_name", "type", "non_null", "rows")


_ORDERS_TYPES = (("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"),
                 ("o_totalprice", "double"), ("o_orderdate", "timestamp_ntz"), ("o_orderpriority", "string"))
SQL["profile_nulls"] = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, '{t}' AS type, count({c}) AS non_null, count(*) AS rows FROM orders"
    for c, t in _ORDERS_TYPES)


# ----------------------------------------------------------------- hand-offs
ORDERS_SCHEMA = T.StructType([
    T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.LongType()),
    T.StructField("o_orderstatus", T.StringType()), T.StructField("o_totalprice", T.DoubleType()),
    T.StructField("o_orderdate", T.TimestampNTZType()), T.StructField("o_orderpriority", T.StringType())])
EVENTS_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType())])


def roundtrip_csv(spark: SparkSession, base: str) -> DataFrame:
    """``orders`` exported as CSV (header, quoted) and read back with its schema."""
    path = write_csv(StandIns(spark, base).t("orders"), stage_path(spark, "orders-csv"))
    return read_csv(spark, path, ORDERS_SCHEMA)


SQL["roundtrip_csv"] = "SELECT * FROM orders"


def roundtrip_jsonl(spark: SparkSession, base: str) -> DataFrame:
    """``events`` written as JSON lines and read back with its schema."""
    path = write_jsonl(StandIns(spark, base).t("events"), stage_path(spark, "events-jsonl"))
    return read_jsonl(spark, path, EVENTS_SCHEMA)


SQL["roundtrip_jsonl"] = "SELECT * FROM events"


def materialize_stage(spark: SparkSession, base: str) -> DataFrame:
    """The stay-feature stage written once as Parquet; the result scans the stage (lineage cut).

    The stage has a name under the shared checkpoint folder: a second call on untouched tables loads it.
    """
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/cohortkit-stages/stay-features"
    return materialize(extracts.stay_features(spark, base), folder)


SQL["materialize_stage"] = extracts.SQL["stay_features"]

QUERIES = {
    "prompt_rows": prompt_rows,
    "cot_prompts": cot_prompts,
    "icl_sample": icl_sample,
    "synth_values": synth_values,
    "synth_symptoms": synth_symptoms,
    "profile_nulls": profile_nulls,
    "roundtrip_csv": roundtrip_csv,
    "roundtrip_jsonl": roundtrip_jsonl,
    "materialize_stage": materialize_stage,
}
