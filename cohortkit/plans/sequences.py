"""Per-patient lists, notes, sequences and count vectors.

Distinct lists are one row per key. Ordered lists, notes and model sequences
come as consecutive chunks of bounded length, so nothing is cut off and no
task holds all of a hot key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortkit.functions.scalar import pad_array
from cohortkit.operators.cohort import first_per_key, top_k_keys
from cohortkit.operators.features import global_index, label_index, minmax_scale, per_class
from cohortkit.operators.lists import (chunked_text, count_vector, distinct_chunks, distinct_sorted_list, multi_hot_inverse as multi_hot_lists,
                                       ordered_chunks)
from cohortkit.plans.standins import StandIns

SQL: dict[str, str] = {}

SEQ_LEN = 100
N_TARGETS = 20
TOP_EXPLODED = 20
LIST_CHUNK = 1000        # values per output row of a per-patient list
NOTE_CHUNK = 100         # turns per output row of a concatenated note


def _patient_items(st: StandIns) -> DataFrame:
    lines = st.t("lineitem", "l_orderkey", "l_linenumber", "l_partkey")
    names = st.t("part", "p_partkey", "p_name")
    adm = st.admissions("o_orderkey", "o_custkey", "o_orderdate")
    return lines.join(names, F.col("l_partkey") == F.col("p_partkey")) \
        .join(adm, F.col("l_orderkey") == F.col("o_orderkey"))


_ITEMS_SQL = """r AS (SELECT o.o_custkey, o.o_orderdate, l.l_orderkey, l.l_linenumber, p.p_name
           FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey JOIN orders o ON l.l_orderkey = o.o_orderkey)"""


def collect_sequences(spark: SparkSession, base: str) -> DataFrame:
    """Every item of a patient in admission order (date, admission, line), in chunks of LIST_CHUNK."""
    r = _patient_items(StandIns(spark, base))
    return ordered_chunks(r, "o_custkey", "p_name", ["o_orderdate", "l_orderkey", "l_linenumber"], LIST_CHUNK)


SQL["collect_sequences"] = f"""WITH {_ITEMS_SQL},
  n AS (SELECT o_custkey, p_name, row_number() OVER (PARTITION BY o_custkey
               ORDER BY o_orderdate, l_orderkey, l_linenumber, p_name) - 1 AS pos FROM r WHERE p_name IS NOT NULL)
SELECT o_custkey, CAST(floor(pos / {LIST_CHUNK}) AS BIGINT) AS chunk, list(p_name ORDER BY pos) AS items
FROM n GROUP BY o_custkey, chunk"""


def items_per_patient(spark: SparkSession, base: str) -> DataFrame:
    """Distinct non-null items per patient, sorted."""
    r = _patient_items(StandIns(spark, base))
    return distinct_sorted_list(r, "o_custkey", "p_name")


SQL["items_per_patient"] = f"""WITH {_ITEMS_SQL}
SELECT o_custkey, list_sort(list_distinct(list(p_name))) AS items FROM r WHERE p_name IS NOT NULL GROUP BY o_custkey"""


DISTINCT_CHUNK = 16


def distinct_item_chunks(spark: SparkSession, base: str) -> DataFrame:
    """Distinct items per patient, sorted, in chunks of DISTINCT_CHUNK (no row grows with the item vocabulary)."""
    r = _patient_items(StandIns(spark, base))
    return distinct_chunks(r, "o_custkey", "p_name", DISTINCT_CHUNK)


SQL["distinct_item_chunks"] = f"""WITH {_ITEMS_SQL},
  d AS (SELECT DISTINCT o_custkey, p_name FROM r WHERE p_name IS NOT NULL),
  n AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY p_name) - 1 AS pos FROM d)
SELECT o_custkey, CAST(floor(pos / {DISTINCT_CHUNK}) AS BIGINT) AS chunk, list(p_name ORDER BY pos) AS items FROM n GROUP BY o_custkey, chunk"""


def exploded_topk(spark: SparkSession, base: str) -> DataFrame:
    """The 20 most frequent items over all patients' lists (counted as rows: a list holds each of its rows once)."""
    items = _patient_items(StandIns(spark, base)).where("p_name IS NOT NULL")
    counts = items.groupBy(F.col("p_name").alias("item")).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), F.asc("item")).limit(TOP_EXPLODED)


SQL["exploded_topk"] = f"""WITH {_ITEMS_SQL}
SELECT p_name AS item, count(*) AS n FROM r GROUP BY p_name ORDER BY n DESC, item LIMIT {TOP_EXPLODED}"""


def concat_notes(spark: SparkSession, base: str) -> DataFrame:
    """All turns of a conversation joined by a space, in turn order, NOTE_CHUNK turns per row."""
    c = StandIns(spark, base).t("conversations", "conv_id", "turn", "text")
    return chunked_text(c, "conv_id", "text", ["turn"], NOTE_CHUNK)


_NOTES_SQL = f"""nn AS (SELECT conv_id, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn, text) - 1 AS pos
                FROM conversations WHERE text IS NOT NULL),
  notes AS (SELECT conv_id, CAST(floor(pos / {NOTE_CHUNK}) AS BIGINT) AS chunk, string_agg(text, ' ' ORDER BY pos) AS text
            FROM nn GROUP BY conv_id, chunk)"""
SQL["concat_notes"] = f"WITH {_NOTES_SQL} SELECT conv_id, chunk, text FROM notes"


def first_admission(spark: SparkSession, base: str) -> DataFrame:
    """Earliest admission per patient, ties by admission id."""
    o = StandIns(spark, base).admissions("o_custkey", "o_orderdate", "o_orderkey")
    return first_per_key(o, "o_custkey", ["o_orderdate", "o_orderkey"], [])


SQL["first_admission"] = """SELECT o_custkey, min(o_orderdate) AS o_orderdate,
    arg_min(o_orderkey, (o_orderdate, o_orderkey)) AS o_orderkey FROM orders WHERE o_orderdate IS NOT NULL GROUP BY o_custkey"""


def patient_note_items(spark: SparkSession, base: str) -> DataFrame:
    """First admission + concatenated note (per note chunk) + item list per patient (shared id)."""
    first = first_admission(spark, base)
    notes = concat_notes(spark, base).withColumnRenamed("conv_id", "o_custkey").withColumnRenamed("text", "note")
    items = items_per_patient(spark, base)
    return first.join(notes, "o_custkey").join(items, "o_custkey")


SQL["patient_note_items"] = f"""
WITH {_ITEMS_SQL},
  f AS ({SQL['first_admission']}),
  {_NOTES_SQL},
  i AS (SELECT o_custkey, list_sort(list_distinct(list(p_name))) AS items FROM r WHERE p_name IS NOT NULL GROUP BY o_custkey)
SELECT f.o_custkey, f.o_orderdate, f.o_orderkey, notes.chunk, notes.text AS note, i.items
FROM f JOIN notes ON f.o_custkey = notes.conv_id JOIN i ON f.o_custkey = i.o_custkey
"""


def _top_items(st: StandIns) -> DataFrame:
    r = _patient_items(st)
    top = top_k_keys(r, "p_name", N_TARGETS)
    from pyspark.sql import Window
    return top.withColumn("target", F.row_number().over(Window.orderBy(F.desc("n"), F.asc("p_name"))) - 1) \
        .select("p_name", "target")


def patient_sequences(spark: SparkSession, base: str) -> DataFrame:
    """Per user: all events as windows of 100 (item index, scaled value), zero-padded, and 20 targets.

    ``chunk`` numbers a user's windows from 0. Item index = sorted event-type
    vocabulary + 1 (0 is padding); values are min–max scaled over all events;
    targets = whether the patient has each of the 20 most frequent items
    (multi-hot, in frequency order).
    """
    st = StandIns(spark, base)
    ev = st.t("events", "event_id", "user_id", "ts", "event_type", "value")
    ev = minmax_scale(ev, "value", "sv")      # statistics over the plain scan
    ev = ev.where("event_type IS NOT NULL").withColumn(
        "item_idx", per_class(label_index(ev, "event_type", "item_idx", start=1), "event_type", "item_idx"))
    steps = ev.select("user_id", "ts", "event_id", F.struct("item_idx", "sv").alias("step"))
    packed = ordered_chunks(steps, "user_id", "step", ["ts", "event_id"], SEQ_LEN, "_s")
    seqs = packed.select(
        "user_id", "chunk",
        pad_array(F.transform("_s", lambda s: s["item_idx"].cast("bigint")), SEQ_LEN, 0).alias("item_seq"),
        pad_array(F.transform("_s", lambda s: s["sv"]), SEQ_LEN, 0.0).alias("value_seq"),
        F.size("_s").alias("seq_len"))
    top = _top_items(st)
    have = _patient_items(st).select(F.col("o_custkey").alias("user_id"), "p_name") \
        .join(F.broadcast(top), "p_name").groupBy("user_id").agg(F.collect_set("target").alias("_t"))
    targets = F.transform(F.sequence(F.lit(0), F.lit(N_TARGETS - 1)),
                          lambda i: F.when(F.array_contains(F.coalesce("_t", F.array().cast("array<int>")), i), 1)
                          .otherwise(0))
    return seqs.join(have, "user_id", "left").select("user_id", "chunk", "item_seq", "value_seq", "seq_len",
                                                     targets.alias("targets"))


SQL["patient_sequences"] = f"""
WITH {_ITEMS_SQL},
  mm AS (SELECT min(value) AS mn, max(value) AS mx FROM events),
  idx AS (SELECT event_type, row_number() OVER (ORDER BY event_type) AS item_idx
          FROM (SELECT DISTINCT event_type FROM events WHERE event_type IS NOT NULL)),
  e AS (SELECT user_id, item_idx,
               round(CASE WHEN mx > mn THEN (value - mn) / (mx - mn) ELSE 0.0 END, 6) AS sv,
               row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pos
        FROM events JOIN idx USING (event_type) CROSS JOIN mm),
  s AS (SELECT user_id, (pos - 1) // {SEQ_LEN} AS chunk, list(item_idx ORDER BY pos) AS it, list(sv ORDER BY pos) AS vs, count(*) AS n
        FROM e GROUP BY ALL),
  top AS (SELECT p_name, row_number() OVER (ORDER BY n DESC, p_name) - 1 AS target
          FROM (SELECT p_name, count(*) AS n FROM r GROUP BY p_name ORDER BY n DESC, p_name LIMIT {N_TARGETS})),
  h AS (SELECT r.o_custkey AS user_id, list(DISTINCT top.target) AS t FROM r JOIN top ON r.p_name = top.p_name GROUP BY r.o_custkey)
SELECT s.user_id, s.chunk,
       list_transform(range(1, {SEQ_LEN + 1}), lambda i: CAST(coalesce(it[i], 0) AS BIGINT)) AS item_seq,
       list_transform(range(1, {SEQ_LEN + 1}), lambda i: coalesce(vs[i], 0.0)) AS value_seq,
       CAST(n AS INTEGER) AS seq_len,
       list_transform(range(0, {N_TARGETS}), lambda i: CASE WHEN list_contains(coalesce(h.t, []), i) THEN 1 ELSE 0 END) AS targets
FROM s LEFT JOIN h ON s.user_id = h.user_id
"""


def _matrix(spark: SparkSession, base: str, binary: bool) -> DataFrame:
    st = StandIns(spark, base)
    r = _patient_items(st).join(F.broadcast(_top_items(st)), "p_name")
    return count_vector(r, "o_custkey", "target", N_TARGETS, "item_", binary=binary)


def count_matrix(spark: SparkSession, base: str) -> DataFrame:
    """Patient × top-20 item counts (``bincount``), one column per item rank."""
    return _matrix(spark, base, False)


def multi_hot(spark: SparkSession, base: str) -> DataFrame:
    """Patient × top-20 item presence (0/1)."""
    return _matrix(spark, base, True)


def multi_hot_inverse(spark: SparkSession, base: str) -> DataFrame:
    """The item names of each row of ``multi_hot``, most frequent item first."""
    names = _top_items(StandIns(spark, base)).agg(F.transform(F.array_sort(F.collect_list(F.struct("target", "p_name"))), lambda t: t["p_name"])).scalar()
    return multi_hot_lists(multi_hot(spark, base), "o_custkey", {f"item_{i}": F.get(names, i) for i in range(N_TARGETS)})


_MATRIX_SQL = f"""WITH {_ITEMS_SQL},
  top AS (SELECT p_name, row_number() OVER (ORDER BY n DESC, p_name) - 1 AS target
          FROM (SELECT p_name, count(*) AS n FROM r GROUP BY p_name ORDER BY n DESC, p_name LIMIT {N_TARGETS}))
SELECT r.o_custkey, {{cols}} FROM r JOIN top ON r.p_name = top.p_name GROUP BY r.o_custkey"""
SQL["count_matrix"] = _MATRIX_SQL.format(cols=", ".join(
    f"count(*) FILTER (WHERE target = {i}) AS item_{i}" for i in range(N_TARGETS)))
SQL["multi_hot"] = _MATRIX_SQL.format(cols=", ".join(
    f"CAST(least(count(*) FILTER (WHERE target = {i}), 1) AS BIGINT) AS item_{i}" for i in range(N_TARGETS)))
SQL["multi_hot_inverse"] = f"""WITH {_ITEMS_SQL},
  top AS (SELECT p_name, row_number() OVER (ORDER BY n DESC, p_name) - 1 AS target
          FROM (SELECT p_name, count(*) AS n FROM r GROUP BY p_name ORDER BY n DESC, p_name LIMIT {N_TARGETS})),
  h AS (SELECT DISTINCT r.o_custkey, top.p_name, target FROM r JOIN top ON r.p_name = top.p_name)
SELECT o_custkey, list(p_name ORDER BY target) AS items FROM h GROUP BY o_custkey"""


def first_match_concat(spark: SparkSession, base: str) -> DataFrame:
    """Each vector extended with the value of the first matching event (first match per id)."""
    st = StandIns(spark, base)
    first = first_per_key(st.t("events", "user_id", "ts", "event_id", "value"), "user_id",
                          ["ts", "event_id"], ["value"])
    emb = st.t("embeddings", "vec_id", "embedding")
    j = emb.join(first, F.col("vec_id") == F.col("user_id"))
    return j.select("vec_id", F.concat(F.col("embedding").cast("array<double>"),
                                       F.array(F.col("value"))).alias("features"))


SQL["first_match_concat"] = """
WITH f AS (SELECT user_id, arg_min(value, (ts, event_id)) AS value FROM events
           WHERE ts IS NOT NULL AND event_id IS NOT NULL GROUP BY user_id)
SELECT e.vec_id, list_concat(CAST(e.embedding AS DOUBLE[]), [f.value]) AS features
FROM embeddings e JOIN f ON e.vec_id = f.user_id
"""


def align_by_position(spark: SparkSession, base: str) -> DataFrame:
    """Pair two tables row by row in key order; the shorter one decides the length."""
    st = StandIns(spark, base)
    a = global_index(st.t("embeddings", "vec_id"), ["vec_id"])
    b = global_index(st.t("documents", "doc_id"), ["doc_id"])
    return a.join(b, "pos").select("pos", "vec_id", "doc_id")


SQL["align_by_position"] = """
WITH a AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS pos FROM embeddings),
     b AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS pos FROM documents)
SELECT a.pos, a.vec_id, b.doc_id FROM a JOIN b ON a.pos = b.pos
"""


def parse_list_text(spark: SparkSession, base: str) -> DataFrame:
    """Lists serialised as JSON text (as a CSV hand-off stores them) and parsed back."""
    items = items_per_patient(spark, base)
    text = items.select("o_custkey", F.to_json("items").alias("text"))
    return text.withColumn("items", F.from_json("text", "array<string>"))


SQL["parse_list_text"] = f"""WITH {_ITEMS_SQL},
  i AS (SELECT o_custkey, list_sort(list_distinct(list(p_name))) AS items FROM r WHERE p_name IS NOT NULL GROUP BY o_custkey),
  t AS (SELECT o_custkey, CAST(to_json(items) AS VARCHAR) AS text FROM i)
SELECT o_custkey, text, from_json(text, '["VARCHAR"]') AS items FROM t
"""


def clean_item_names(spark: SparkSession, base: str) -> DataFrame:
    """Trim padded names; missing names stay missing."""
    p = StandIns(spark, base).t("part", "p_partkey", "p_name")
    raw = F.when(F.col("p_partkey") % 13 == 0, F.lit(None).cast("string")) \
        .otherwise(F.concat(F.lit("  "), F.col("p_name"), F.lit(" ")))
    return p.select("p_partkey", raw.alias("raw")).withColumn("name", F.trim("raw"))


SQL["clean_item_names"] = """
WITH p AS (SELECT p_partkey, CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE '  ' || p_name || ' ' END AS raw FROM part)
SELECT p_partkey, raw, trim(raw) AS name FROM p
"""

QUERIES = {
    "collect_sequences": collect_sequences,
    "items_per_patient": items_per_patient,
    "distinct_item_chunks": distinct_item_chunks,
    "exploded_topk": exploded_topk,
    "concat_notes": concat_notes,
    "first_admission": first_admission,
    "patient_note_items": patient_note_items,
    "patient_sequences": patient_sequences,
    "count_matrix": count_matrix,
    "multi_hot": multi_hot,
    "multi_hot_inverse": multi_hot_inverse,
    "first_match_concat": first_match_concat,
    "align_by_position": align_by_position,
    "parse_list_text": parse_list_text,
    "clean_item_names": clean_item_names,
}
