"""Heart-rhythm keys over the whole code lists: names to codes, explanations by code, symptom records by value."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortkit.functions.rules import value_map
from cohortkit.functions.scalar import hash_bucket
from cohortkit.plans.handoffs import RHYTHM_ITEMID, _hash_int_sql
from cohortkit.plans.standins import StandIns

SQL: dict[str, str] = {}

# The chart's rhythm names and their codes (a missing name is 15).
RHYTHM_NAMES = {
    "Normal Sinus": 1, "AV Paced": 2, "Vent. Tachy": 3, "Atrial Fib": 4, "Sinus Tachy": 5, "V Paced": 6, "Sinus Brady": 7,
    "Supravent Tachy": 8, "Ventricular Fib": 9, "A Paced": 10, "1st Deg AV Block": 11, "2nd AVB/Mobitz I": 12, "Atrial Flutter": 13,
    "Sinus Arrhythmia": 14, None: 15, "Other/Remarks": 16, "MultFocalAtrTach": 17, "Junctional": 18, "Asystole": 19,
    "Idioventricular": 20, "Comp Heart Block": 21, "Wand.Atrial Pace": 22, "Parox Atr Tachy": 23, "Paced": 24,
    "2nd AVB Mobitz 2": 25, "Zoll Paced": 26,
}
UNLISTED = "Artifact"

# Rhythm and risk class of each value of the prompt table; the explanations are this library's own.
LOW, MILD, SEVERE, CRITICAL = "Low Risk", "Mild Symptoms", "Severe Symptoms", "Critical Condition"
EXPLANATIONS = (
    (1, "Normal Sinus", LOW, "The sinus node sets a regular beat."),
    (2, "AV Paced", MILD, "A device paces both chambers; check that it captures."),
    (3, "Vent. Tachy", SEVERE, "A fast ventricular focus can end in arrest."),
    (4, "Atrial Fib", SEVERE, "Disordered atria let clots form and tire the heart."),
    (5, "Sinus Tachy", MILD, "A quick sinus beat, from strain, fever or early illness."),
    (6, "V Paced", MILD, "A device paces the ventricle; watch the leads."),
    (7, "Sinus Brady", MILD, "A slow sinus beat, often from drugs or training."),
    (8, "Supravent Tachy", SEVERE, "A fast focus above the ventricles has to be slowed."),
    (9, "Ventricular Fib", CRITICAL, "The ventricles quiver without output; defibrillate now."),
    (10, "A Paced", MILD, "A device paces the atrium; watch for lost conduction."),
    (11, "1st Deg AV Block", LOW, "Conduction is late but complete, mostly unnoticed."),
    (12, "2nd AVB/Mobitz I", MILD, "Conduction lengthens until a beat drops; keep on the monitor."),
    (13, "Atrial Flutter", SEVERE, "Atria circle at speed; stroke and failure threaten."),
    (14, "Sinus Arrhythmia", LOW, "The beat follows the breath, a harmless variant."),
    (15, "Other/Remarks", LOW, "A remark without a finding of weight."),
    (16, "Multifocal Atr Tachy", SEVERE, "Several atrial foci compete at speed; look for the cause."),
    (17, "Junctional", SEVERE, "The junction leads the beat; find out why the sinus fails."),
    (18, "Asystole", CRITICAL, "No electrical activity at all; resuscitate."),
    (19, "Idioventricular", SEVERE, "A slow ventricular escape carries the beat alone."),
    (20, "Comp Heart Block", CRITICAL, "Nothing conducts to the ventricles; pace at once."),
    (21, "Wandering Atrial Pace", MILD, "The leading focus moves about; observe."),
    (22, "Paroxysmal Atr Tachy", SEVERE, "Fast atrial runs start and stop suddenly; treat the symptoms."),
    (23, "Paced", LOW, "A stable paced beat."),
    (24, "2nd AVB Mobitz II", CRITICAL, "Beats drop without warning; complete block may follow."),
    (25, "Zoll Paced", MILD, "Pads pace from outside until a lead is placed."),
)
NO_EXPLANATION = ("Unknown", "Unknown", "The value is not in the table.")
COT = "Value %d is read as %s (%s). %s"

# The symptom text of each value, in this library's own words.
SYMPTOMS_OF = (
    "nothing out of the ordinary", "slight tiredness and breathlessness at times", "a racing heart and giddiness",
    "an uneven beat and a tight chest", "a fast pulse on light exertion", "a known arrhythmia kept in check by tablets",
    "a slow pulse and faintness", "bouts of racing with unease", "loss of pulse with ventricular quivering", "fluttering under atrial pacing",
    "a late conduction without complaint", "tiredness and fainting from dropped beats", "breathlessness with atrial flutter",
    "an uneven sinus beat found on examination", "no clear complaint of the heart", "an odd arrhythmia noted in passing",
    "giddiness with many atrial foci", "moderate tiredness with a junctional beat", "collapse without any beat",
    "mild complaints with a ventricular escape", "complete block that calls for a pacemaker", "a wandering atrial pacemaker",
    "sudden runs of fast atrial beats", "a paced beat after surgery", "fainting with a block of the second kind",
)
RISKS = 4


def _text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _rhythm_name():
    """The name charted for an event: every listed one, none, and one that the list lacks."""
    names = [n for n in RHYTHM_NAMES if n is not None]
    return F.get(F.array(*map(F.lit, [*names, None, UNLISTED])), F.pmod("event_id", F.lit(len(names) + 2)).cast("int"))


def rhythm_code_map(spark: SparkSession, base: str) -> DataFrame:
    """Each event's rhythm name and its code; a missing name has a code, an unlisted one has none."""
    e = StandIns(spark, base).t("events", "event_id").select("event_id", _rhythm_name().alias("rhythm"))
    return e.withColumn("code", value_map(RHYTHM_NAMES, "rhythm").cast("int"))


_NAMES = [n for n in RHYTHM_NAMES if n is not None]
SQL["rhythm_code_map"] = f"""
WITH n(i, rhythm, code) AS (VALUES {", ".join(f"({i}, {_text(n)}, {RHYTHM_NAMES[n]})" for i, n in enumerate(_NAMES))},
     ({len(_NAMES)}, NULL, {RHYTHM_NAMES[None]}), ({len(_NAMES) + 1}, '{UNLISTED}', NULL))
SELECT event_id, rhythm, CAST(code AS INTEGER) AS code FROM events JOIN n ON event_id % {len(_NAMES) + 2} = i"""


def synth_symptom_records(spark: SparkSession, base: str) -> DataFrame:
    """One synthetic rhythm record per patient: constant item, value 1..25, the symptom text of that value, risk 1..4."""
    c = StandIns(spark, base).t("customer", "c_custkey")
    value = (hash_bucket("c_custkey", len(SYMPTOMS_OF), "value") + 1).cast("int")
    text = F.element_at(F.array(*map(F.lit, SYMPTOMS_OF)), F.col("value"))
    return c.select(F.col("c_custkey").alias("subject_id"), F.lit(RHYTHM_ITEMID).alias("itemid"), value.alias("value")).select(
        "*", F.concat(F.lit("Patient "), F.col("subject_id").cast("string"), F.lit(" shows "), text, F.lit(".")).alias("text"),
        (hash_bucket("subject_id", RISKS, "risk") + 1).cast("int").alias("risk_class"))


SQL["synth_symptom_records"] = f"""
WITH c AS (SELECT c_custkey AS subject_id, CAST({_hash_int_sql("c_custkey", "value", len(SYMPTOMS_OF))} + 1 AS INTEGER) AS value FROM customer)
SELECT subject_id, {RHYTHM_ITEMID} AS itemid, value,
       'Patient ' || subject_id || ' shows ' || [{", ".join(map(_text, SYMPTOMS_OF))}][value] || '.' AS text,
       CAST({_hash_int_sql("subject_id", "risk", RISKS)} + 1 AS INTEGER) AS risk_class
FROM c"""


def rhythm_explanations(spark: SparkSession, base: str) -> DataFrame:
    """Reasoning text of each synthetic record from the whole explanation table, with a default for values it lacks.

    The table is a literal map of 25 entries, so records are not joined. A
    value beyond the table comes from every tenth patient.
    """
    r = synth_symptom_records(spark, base)
    value = F.when(F.col("subject_id") % 10 == 0, F.col("value") + len(EXPLANATIONS)).otherwise(F.col("value"))
    parts = [value_map({e[0]: e[k] for e in EXPLANATIONS}, "value", NO_EXPLANATION[k - 1]) for k in (1, 2, 3)]
    return r.withColumn("value", value).select("subject_id", "value", F.format_string(COT, "value", *parts).alias("prompt"))


SQL["rhythm_explanations"] = f"""
WITH r AS ({SQL["synth_symptom_records"]}),
     v AS (SELECT subject_id, CAST(value + CASE WHEN subject_id % 10 = 0 THEN {len(EXPLANATIONS)} ELSE 0 END AS INTEGER) AS value FROM r),
     t(code, name, risk, info) AS (VALUES {", ".join(f"({a}, {_text(b)}, {_text(c)}, {_text(d)})" for a, b, c, d in EXPLANATIONS)})
SELECT subject_id, value, printf('{COT}', value, {", ".join(f"coalesce({c}, {_text(d)})" for c, d in zip(("name", "risk", "info"), NO_EXPLANATION, strict=True))}) AS prompt
FROM v LEFT JOIN t ON value = code"""

QUERIES = {
    "rhythm_code_map": rhythm_code_map,
    "synth_symptom_records": synth_symptom_records,
    "rhythm_explanations": rhythm_explanations,
}
