"""Keys of sources, sinks and helpers: SQL text over views, file round trips, streamed extracts, first rows, suffixed joins."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortkit.functions.scalar import argmax, clip
from cohortkit.operators import text as T
from cohortkit.operators.cohort import first_n_per_key, first_per_key, join_with_suffix
from cohortkit.plans import reports
from cohortkit.plans.standins import StandIns
from cohortkit.sources import io
from cohortkit.streaming.incremental import append_filtered

SQL: dict[str, str] = {}

FIRST_EVENTS = 3
STREAMED_TYPES = ("click", "view", "purchase")
STREAM_FILES = 8
NUMBER = re.compile("[0-9]+")

# One text for both engines: stays, patients and mean price by group and status.
REPORT_TEXT = """
WITH stays AS (
  SELECT n.n_name AS ethnicity, o.o_orderstatus AS status, o.o_custkey, o.o_totalprice
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey)
SELECT ethnicity, status, count(*) AS n_stays, count(DISTINCT o_custkey) AS n_patients, round(avg(o_totalprice), 4) AS mean_price
FROM stays GROUP BY ethnicity, status"""


def sql_report(spark: SparkSession, base: str) -> DataFrame:
    """A report written as SQL text over the registered tables."""
    io.register_tables(spark, base, ["orders", "customer", "nation"])
    return spark.sql(REPORT_TEXT)


SQL["sql_report"] = REPORT_TEXT


def roundtrip_single_csv(spark: SparkSession, base: str) -> DataFrame:
    """A small report exported as one CSV file with a header and read back."""
    path = io.write_csv(reports.group_count_topk(spark, base), io.stage_path(spark, "report-csv"), single_file=True)
    return io.read_csv(spark, path, "ethnicity string, patient_count bigint")


SQL["roundtrip_single_csv"] = reports.SQL["group_count_topk"]


def roundtrip_json_array(spark: SparkSession, base: str) -> DataFrame:
    """The groups written as files that hold one JSON array of records each (one per region), read back a row per element."""
    n = StandIns(spark, base).t("nation")
    arrays = n.groupBy("n_regionkey").agg(F.to_json(F.array_sort(F.collect_list(F.struct(*n.columns)))).alias("json"))
    # a file per region: an array is one record, so it must not share its file
    path = io.stage_path(spark, "groups-json")
    arrays.write.partitionBy("n_regionkey").text(path)
    return io.read_json_array(spark, path, n.schema)


SQL["roundtrip_json_array"] = "SELECT * FROM nation"


def roundtrip_text(spark: SparkSession, base: str) -> DataFrame:
    """Event types written as plain text lines, read back and counted."""
    path = io.write_text(StandIns(spark, base).t("events", "event_type"), io.stage_path(spark, "types-text"), "event_type")
    return io.read_text(spark, path).groupBy("value").agg(F.count(F.lit(1)).alias("n"))


SQL["roundtrip_text"] = "SELECT event_type AS value, count(*) AS n FROM events GROUP BY event_type"


def stream_item_events(spark: SparkSession, base: str) -> DataFrame:
    """Events of three types, filtered and appended file by file as a stream, then read from its sink."""
    events = StandIns(spark, base).t("events", "event_id", "user_id", "event_type", "value")
    incoming = io.stage_path(spark, "stream-in")
    events.repartition(STREAM_FILES, "event_id").write.parquet(incoming)
    sink = io.stage_path(spark, "stream-out")
    append_filtered(spark, incoming, events.schema, F.col("event_type").isin(*STREAMED_TYPES), ["event_id", "user_id", "value"], sink,
                    io.stage_path(spark, "stream-log"), files_per_batch=STREAM_FILES // 2)
    return spark.read.parquet(sink)


SQL["stream_item_events"] = f"SELECT event_id, user_id, value FROM events WHERE event_type IN {STREAMED_TYPES}"


def first_events(spark: SparkSession, base: str) -> DataFrame:
    """The first three events of each user by time, with their position."""
    e = StandIns(spark, base).t("events", "user_id", "ts", "event_id", "event_type")
    return first_n_per_key(e, "user_id", ["ts", "event_id"], FIRST_EVENTS)


SQL["first_events"] = f"""
SELECT user_id, ts, event_id, event_type, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS INTEGER) AS pos
FROM events QUALIFY pos <= {FIRST_EVENTS}"""


def join_suffixed(spark: SparkSession, base: str) -> DataFrame:
    """First view beside first click of each user; columns that both sides have get a suffix."""
    e = StandIns(spark, base).t("events", "user_id", "ts", "event_id", "event_type", "value")
    view, click = (first_per_key(e.where(F.col("event_type") == kind), "user_id", ["ts", "event_id"], ["value"]) for kind in ("view", "click"))
    return join_with_suffix(view, click, "user_id", suffix="_click")


SQL["join_suffixed"] = """
WITH f AS (SELECT event_type, user_id, ts, event_id, value FROM events WHERE ts IS NOT NULL
           QUALIFY row_number() OVER (PARTITION BY event_type, user_id ORDER BY ts, event_id) = 1)
SELECT v.user_id, v.ts, v.event_id, v.value, c.ts AS ts_click, c.event_id AS event_id_click, c.value AS value_click
FROM f v JOIN f c ON v.user_id = c.user_id WHERE v.event_type = 'view' AND c.event_type = 'click'"""


def custom_tagger(spark: SparkSession, base: str) -> DataFrame:
    """Numbers in each note found by a user's own tagger over batches: how many, and the longest one's digits."""
    def tagger(batch):
        found = batch["text"].fillna("").map(NUMBER.findall)
        return batch[["doc_id"]].assign(n=found.map(len), longest=found.map(lambda m: max(map(len, m), default=0)))

    docs = StandIns(spark, base).t("documents", "doc_id", "text")
    return T.tag_with(docs, tagger, "doc_id bigint, n bigint, longest bigint")


SQL["custom_tagger"] = """
WITH m AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[0-9]+') AS m FROM documents)
SELECT doc_id, len(m) AS n, coalesce(list_max(list_transform(m, lambda x: length(x))), 0) AS longest FROM m"""


def vector_argmax(spark: SparkSession, base: str) -> DataFrame:
    """Position of each embedding's largest component, and its first one clipped to 0..0.1."""
    e = StandIns(spark, base).t("embeddings", "vec_id", "embedding")
    return e.select("vec_id", argmax("embedding").cast("bigint").alias("largest"),
                    F.round(clip(F.get("embedding", F.lit(0)).cast("double"), 0.0, 0.1), 6).alias("clipped"))


SQL["vector_argmax"] = """
SELECT vec_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS BIGINT) AS largest,
       round(least(greatest(CAST(embedding[1] AS DOUBLE), 0.0), 0.1), 6) AS clipped FROM embeddings"""

QUERIES = {
    "sql_report": sql_report,
    "roundtrip_single_csv": roundtrip_single_csv,
    "roundtrip_json_array": roundtrip_json_array,
    "roundtrip_text": roundtrip_text,
    "stream_item_events": stream_item_events,
    "first_events": first_events,
    "join_suffixed": join_suffixed,
    "custom_tagger": custom_tagger,
    "vector_argmax": vector_argmax,
}
