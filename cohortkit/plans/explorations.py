"""Exploratory aggregates (length of stay, ages, first chart time, drug use).

Top-k group sets are DataFrames of at most k rows, applied with a broadcast
``left_semi`` join — never collected to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortkit.functions.temporal import bucket_floor, completed_years, decimal_hour, whole_days
from cohortkit.operators import sketches
from cohortkit.operators.cohort import first_per_key, restrict_to_top_k, top_k_keys, top_k_per_group
from cohortkit.plans.standins import StandIns
from cohortkit.sources.io import materialize

# Month order for the monthly table.
MONTHS = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")
PERIOD_WIDTH = 2
PERIODS = tuple(range(1992, 2002, PERIOD_WIDTH))    # columns of the wide table
TOP_GROUPS = 6
TOP_ITEMS = 10
BIN_MINUTES = 5
TOP_SEGMENTS = 3

SQL: dict[str, str] = {}


def _stays_by_group(st: StandIns) -> DataFrame:
    lines = st.t("lineitem", "l_orderkey", "l_partkey", "l_shipdate")
    adm = st.admissions("o_orderkey", "o_custkey", "o_orderdate")
    j = lines.join(adm, F.col("l_orderkey") == F.col("o_orderkey"))
    return j.join(st.patients_with_group(), F.col("o_custkey") == F.col("c_custkey"))


_STAYS_SQL = """lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
    JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey"""


# ------------------------------------------------------------ mean LOS by period
def _los_rows(spark: SparkSession, base: str) -> DataFrame:
    st = StandIns(spark, base)
    s = _stays_by_group(st).select(
        F.col("n_name").alias("ethnicity"),
        bucket_floor(F.year("o_orderdate"), PERIOD_WIDTH).alias("period"),
        whole_days("o_orderdate", "l_shipdate").alias("los")).where(F.col("los") >= 0)
    return restrict_to_top_k(s, "ethnicity", TOP_GROUPS)


def mean_los_by_period(spark: SparkSession, base: str) -> DataFrame:
    s = _los_rows(spark, base)
    return s.groupBy("ethnicity", "period").agg(F.round(F.avg("los"), 6).alias("mean_los"))


_LOS_SQL = f"""
WITH s AS (SELECT n.n_name AS ethnicity, CAST(floor(year(o.o_orderdate) / {PERIOD_WIDTH}) * {PERIOD_WIDTH} AS BIGINT) AS period,
                  date_sub('day', o.o_orderdate, l.l_shipdate) AS los
           FROM {_STAYS_SQL} WHERE l.l_shipdate >= o.o_orderdate),
     t AS (SELECT ethnicity FROM s GROUP BY ethnicity ORDER BY count(*) DESC, ethnicity LIMIT {TOP_GROUPS}),
     m AS (SELECT ethnicity, period, round(avg(los), 6) AS mean_los FROM s
           WHERE ethnicity IN (SELECT ethnicity FROM t) GROUP BY ethnicity, period)
"""
SQL["mean_los_by_period"] = _LOS_SQL + "SELECT * FROM m"


def mean_los_pivot(spark: SparkSession, base: str, periods: Sequence[int] = PERIODS) -> DataFrame:
    """Wide form: one row per group, one column per period and one for all others (absent cells 0)."""
    s = _los_rows(spark, base)

    def cell(inside):
        return F.coalesce(F.round(F.avg(F.when(inside, F.col("los"))), 6), F.lit(0.0))

    return s.groupBy("ethnicity").agg(*[cell(F.col("period") == p).alias(f"p{p}") for p in periods],
                                      cell(~F.col("period").isin(*periods)).alias("p_other"))


SQL["mean_los_pivot"] = _LOS_SQL + "SELECT ethnicity, " + ", ".join(
    f"coalesce(round(avg(los) FILTER (WHERE period = {p}), 6), 0.0) AS p{p}" for p in PERIODS) + f""",
    coalesce(round(avg(los) FILTER (WHERE period NOT IN ({", ".join(map(str, PERIODS))})), 6), 0.0) AS p_other
FROM s WHERE ethnicity IN (SELECT ethnicity FROM t) GROUP BY ethnicity
"""


# ------------------------------------------------------------ age histogram
AGE_BIN = 1


def age_histogram(spark: SparkSession, base: str) -> DataFrame:
    st = StandIns(spark, base)
    s = _stays_by_group(st).select(
        F.col("n_name").alias("ethnicity"),
        completed_years("o_orderdate", "l_shipdate").alias("age")).where(F.col("age").between(0, 120))
    s = restrict_to_top_k(s, "ethnicity", TOP_GROUPS)
    return s.groupBy("ethnicity", bucket_floor("age", AGE_BIN).alias("age_bin")) \
        .agg(F.count(F.lit(1)).alias("n"))


SQL["age_histogram"] = f"""
WITH s AS (SELECT n.n_name AS ethnicity, extract(year from age(l.l_shipdate, o.o_orderdate)) AS age FROM {_STAYS_SQL}),
     f AS (SELECT * FROM s WHERE age BETWEEN 0 AND 120),
     t AS (SELECT ethnicity FROM f GROUP BY ethnicity ORDER BY count(*) DESC, ethnicity LIMIT {TOP_GROUPS})
SELECT ethnicity, CAST(floor(age / {AGE_BIN}) * {AGE_BIN} AS BIGINT) AS age_bin, count(*) AS n
FROM f WHERE ethnicity IN (SELECT ethnicity FROM t) GROUP BY ALL
"""


# ------------------------------------------------------------ first chart time
def first_event_time(spark: SparkSession, base: str) -> DataFrame:
    """Earliest event per user (ties by event id), its decimal hour and the user's segment."""
    st = StandIns(spark, base)
    first = first_per_key(st.t("events", "user_id", "ts", "event_id"), "user_id", ["ts", "event_id"], [])
    seg = st.patients("c_custkey", "c_mktsegment")
    return first.join(seg, F.col("user_id") == F.col("c_custkey")).select(
        "user_id", "event_id", "ts", F.round(decimal_hour("ts"), 6).alias("hour"),
        F.col("c_mktsegment").alias("segment"))


_FIRST_SQL = """
WITH f AS (SELECT user_id, arg_min(event_id, (ts, event_id)) AS event_id, min(ts) AS ts FROM events GROUP BY user_id),
     g AS (SELECT f.user_id, f.event_id, f.ts, round(hour(f.ts) + minute(f.ts) / 60.0, 6) AS hour, c.c_mktsegment AS segment
           FROM f JOIN customer c ON f.user_id = c.c_custkey)
"""
SQL["first_event_time"] = _FIRST_SQL + "SELECT * FROM g"


def time_of_day_histogram(spark: SparkSession, base: str) -> DataFrame:
    """5-minute bins of the first event's time of day, for the top segments."""
    g = first_event_time(spark, base)
    g = restrict_to_top_k(g, "segment", TOP_SEGMENTS)
    minute_of_day = F.hour("ts") * 60 + F.minute("ts")
    return g.groupBy("segment", bucket_floor(minute_of_day, BIN_MINUTES).alias("minute_bin")) \
        .agg(F.count(F.lit(1)).alias("n"))


SQL["time_of_day_histogram"] = _FIRST_SQL + f"""
, t AS (SELECT segment FROM g GROUP BY segment ORDER BY count(*) DESC, segment LIMIT {TOP_SEGMENTS})
SELECT segment, CAST(floor((hour(ts) * 60 + minute(ts)) / {BIN_MINUTES}) * {BIN_MINUTES} AS BIGINT) AS minute_bin, count(*) AS n
FROM g WHERE segment IN (SELECT segment FROM t) GROUP BY ALL
"""


# ------------------------------------------------------------ drug use by group
def _item_rows(st: StandIns) -> DataFrame:
    lines = st.t("lineitem", "l_orderkey", "l_partkey")
    names = st.t("part", "p_partkey", "p_name")
    adm = st.admissions("o_orderkey", "o_custkey")
    j = lines.join(names, F.col("l_partkey") == F.col("p_partkey")) \
        .join(adm, F.col("l_orderkey") == F.col("o_orderkey"))
    return j.join(st.patients_with_group(), F.col("o_custkey") == F.col("c_custkey")) \
        .select(F.col("n_name").alias("ethnicity"), F.col("p_name").alias("item"),
                F.col("o_custkey"), F.col("c_mktsegment").alias("segment"))


def _group_item_counts(st: StandIns) -> DataFrame:
    counts = _item_rows(st).groupBy("ethnicity", "item").agg(F.count(F.lit(1)).alias("n"))
    top_groups = top_k_keys(counts, "ethnicity", TOP_GROUPS, weight="n", name="group_total")
    in_groups = counts.join(F.broadcast(top_groups.select("ethnicity")), "ethnicity", "left_semi")
    top_items = top_k_keys(in_groups, "item", TOP_ITEMS, weight="n", name="item_total").select("item")
    return in_groups.join(F.broadcast(top_items), "item", "left_semi"), top_groups


def group_item_counts(spark: SparkSession, base: str) -> DataFrame:
    """(group, item) counts for the top groups and the top items inside them."""
    out, _ = _group_item_counts(StandIns(spark, base))
    return out.select("ethnicity", "item", "n")


_ITEMS_SQL = f"""
WITH r AS (SELECT n.n_name AS ethnicity, p.p_name AS item, c.c_custkey, c.c_mktsegment AS segment
           FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey JOIN orders o ON l.l_orderkey = o.o_orderkey
           JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey),
     cnt AS (SELECT ethnicity, item, count(*) AS n FROM r GROUP BY ALL),
     tg AS (SELECT ethnicity, sum(n) AS group_total FROM cnt GROUP BY ethnicity ORDER BY group_total DESC, ethnicity LIMIT {TOP_GROUPS}),
     ig AS (SELECT * FROM cnt WHERE ethnicity IN (SELECT ethnicity FROM tg)),
     ti AS (SELECT item FROM ig GROUP BY item ORDER BY sum(n) DESC, item LIMIT {TOP_ITEMS}),
     gi AS (SELECT * FROM ig WHERE item IN (SELECT item FROM ti))
"""
SQL["group_item_counts"] = _ITEMS_SQL + "SELECT ethnicity, item, n FROM gi"

NAMED_GROUPS = 2


def two_way_stack(spark: SparkSession, base: str) -> DataFrame:
    """Split the top groups into the first ``NAMED_GROUPS`` by total and the rest.

    Long form: each (item, group) cell with its stack ('named' / 'other') and
    the group's rank by total, which is the column order of the stacked chart.
    """
    out, top_groups = _group_item_counts(StandIns(spark, base))
    ranked = top_k_per_group(top_groups.withColumn("_all", F.lit(1)), "_all", "group_total",
                             TOP_GROUPS, ["ethnicity"], "group_rank").drop("_all")
    j = out.join(F.broadcast(ranked.select("ethnicity", "group_rank")), "ethnicity")
    return j.select("item", "ethnicity", "group_rank",
                    F.when(F.col("group_rank") <= NAMED_GROUPS, "named").otherwise("other").alias("stack"), "n")


SQL["two_way_stack"] = _ITEMS_SQL + f"""
, rk AS (SELECT ethnicity, CAST(row_number() OVER (ORDER BY group_total DESC, ethnicity) AS INTEGER) AS group_rank FROM tg)
SELECT gi.item, gi.ethnicity, rk.group_rank, CASE WHEN rk.group_rank <= {NAMED_GROUPS} THEN 'named' ELSE 'other' END AS stack, gi.n
FROM gi JOIN rk ON gi.ethnicity = rk.ethnicity
"""


def usage_per_person(spark: SparkSession, base: str) -> DataFrame:
    """Items per distinct patient in each group (count joined to its normaliser)."""
    r = _item_rows(StandIns(spark, base))
    counts = r.groupBy("ethnicity").agg(F.count(F.lit(1)).alias("n_items"))
    persons = r.select("ethnicity", "o_custkey").distinct().groupBy("ethnicity") \
        .agg(F.count(F.lit(1)).alias("n_patients"))
    j = counts.join(persons, "ethnicity")
    return j.withColumn("per_person", F.round(F.col("n_items") / F.col("n_patients"), 6))


SQL["usage_per_person"] = _ITEMS_SQL + """
SELECT ethnicity, count(*) AS n_items, count(DISTINCT c_custkey) AS n_patients,
       round(count(*) / count(DISTINCT c_custkey), 6) AS per_person FROM r GROUP BY ethnicity
"""


SKETCH_QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def _event_sketches(spark: SparkSession, base: str) -> DataFrame:
    """One row per event type and day: rows, distinct users and values as sketches; written once."""
    e = StandIns(spark, base).t("events", "event_type", "ts", "user_id", "value")
    daily = e.select("event_type", F.to_date("ts").alias("day"), "user_id", "value")
    return materialize(sketches.sketch_groups(daily, ["event_type", "day"], ["user_id"], ["value"]), name="event-sketches")


def sketch_distinct_users(spark: SparkSession, base: str) -> DataFrame:
    """Users per event type and month from merged daily sketches: the exact number, and whether the estimate is near it.

    Near: within four standard errors (3.3 %).
    """
    daily = _event_sketches(spark, base).withColumn("month", F.month("day"))
    found = sketches.estimated(sketches.merge_groups(daily, ["event_type", "month"]), ["event_type", "month"])
    exact = (StandIns(spark, base).t("events", "event_type", "ts", "user_id").select("event_type", F.month("ts").alias("month"), "user_id").distinct()
             .groupBy("event_type", "month").agg(F.count("user_id").alias("users")))
    return sketches.distinct_within(found, exact, ["event_type", "month"], "user_id_distinct", "users")


SQL["sketch_distinct_users"] = """
SELECT event_type, CAST(month(ts) AS INTEGER) AS month, count(DISTINCT user_id) AS users, true AS within FROM events GROUP BY ALL"""


def sketch_value_quartiles(spark: SparkSession, base: str) -> DataFrame:
    """Quartiles per event type from merged daily sketches: whether their exact ranks are near the asked ones (within 2.1 %)."""
    found = sketches.estimated(sketches.merge_groups(_event_sketches(spark, base), ["event_type"]), ["event_type"], SKETCH_QUARTILES)
    events = StandIns(spark, base).t("events", "event_type", "value")
    return sketches.quantiles_within(events, "value", found, ["event_type"], SKETCH_QUARTILES)


SQL["sketch_value_quartiles"] = """
WITH e AS (SELECT event_type, count(value) AS n FROM events WHERE value IS NOT NULL GROUP BY event_type)
SELECT event_type, quantile, n, true AS within FROM e, (VALUES ('q1'), ('median'), ('q3')) q(quantile)"""


def top_items_per_group(spark: SparkSession, base: str) -> DataFrame:
    """Ten most used items for each segment (the reference: per gender)."""
    r = _item_rows(StandIns(spark, base))
    counts = r.groupBy("segment", "item").agg(F.count(F.lit(1)).alias("n"))
    return top_k_per_group(counts, "segment", "n", TOP_ITEMS, ["item"])


SQL["top_items_per_group"] = _ITEMS_SQL + f"""
, sc AS (SELECT segment, item, count(*) AS n FROM r GROUP BY ALL),
  rk AS (SELECT *, row_number() OVER (PARTITION BY segment ORDER BY n DESC, item) AS rank FROM sc)
SELECT segment, item, n, CAST(rank AS INTEGER) AS rank FROM rk WHERE rank <= {TOP_ITEMS}
"""


def monthly_item_usage(spark: SparkSession, base: str) -> DataFrame:
    """12 months × top items, zero-filled, with the month ordinal for ordering.

    The grid is 12 × k rows: each of the k top items is expanded to its 12
    months by a generator, then left-joined to the counts.
    """
    st = StandIns(spark, base)
    lines = st.t("lineitem", "l_partkey", "l_shipdate").where(F.col("l_shipdate").isNotNull())
    names = st.t("part", "p_partkey", "p_name")
    r = lines.join(names, F.col("l_partkey") == F.col("p_partkey")) \
        .select(F.trim("p_name").alias("item"), F.month("l_shipdate").alias("month_no"))
    r = r.where(F.col("item").isNotNull())
    top = top_k_keys(r, "item", TOP_ITEMS).select("item")
    counts = r.join(F.broadcast(top), "item", "left_semi").groupBy("month_no", "item") \
        .agg(F.count(F.lit(1)).alias("n"))
    month_names = F.array(*[F.lit(m) for m in MONTHS])
    grid = top.select("item", F.explode(F.sequence(F.lit(1), F.lit(12))).alias("month_no")) \
        .withColumn("month", F.element_at(month_names, F.col("month_no")))
    return grid.join(counts, ["month_no", "item"], "left") \
        .select("month_no", "month", "item", F.coalesce("n", F.lit(0)).alias("n"))


SQL["monthly_item_usage"] = f"""
WITH r AS (SELECT trim(p.p_name) AS item, month(l.l_shipdate) AS month_no, strftime(l.l_shipdate, '%b') AS month
           FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey WHERE l.l_shipdate IS NOT NULL),
     t AS (SELECT item FROM r GROUP BY item ORDER BY count(*) DESC, item LIMIT {TOP_ITEMS}),
     m(month_no, month) AS (VALUES """ + ", ".join(f"({i + 1}, '{m}')" for i, m in enumerate(MONTHS)) + """)
SELECT CAST(m.month_no AS INTEGER) AS month_no, m.month, t.item,
       (SELECT count(*) FROM r WHERE r.item = t.item AND r.month_no = m.month_no) AS n
FROM m CROSS JOIN t
"""

QUERIES = {
    "mean_los_by_period": mean_los_by_period,
    "mean_los_pivot": mean_los_pivot,
    "age_histogram": age_histogram,
    "first_event_time": first_event_time,
    "time_of_day_histogram": time_of_day_histogram,
    "group_item_counts": group_item_counts,
    "two_way_stack": two_way_stack,
    "usage_per_person": usage_per_person,
    "sketch_distinct_users": sketch_distinct_users,
    "sketch_value_quartiles": sketch_value_quartiles,
    "top_items_per_group": top_items_per_group,
    "monthly_item_usage": monthly_item_usage,
}
