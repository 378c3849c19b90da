"""Scalar semantics from the survey's edge-case list (§1.4, §5)."""

import datetime as dt

from pyspark.sql import functions as F

from cohortkit.functions.rules import Rule, RuleTable, value_map
from cohortkit.functions.scalar import code_truncate, hash_bucket, hash_fraction, pad_array
from cohortkit.functions.temporal import (age_at, bucket_floor, completed_years, decimal_hour,
                                          flag_between, parse_timestamp, whole_days)


def ts(*a):
    return dt.datetime(*a)


def test_completed_years_sql_semantics(spark):
    rows = [
        (ts(1996, 2, 29), ts(1998, 2, 28), 1),      # 29 Feb: SQL/PostgreSQL count, not month-end rounding
        (ts(1996, 2, 29), ts(1997, 2, 28), 0),
        (ts(2000, 5, 1, 12), ts(2001, 5, 1, 11), 0),  # time of day counts
        (ts(2000, 5, 1, 12), ts(2001, 5, 1, 12), 1),
        (ts(2005, 1, 1), ts(1999, 6, 1), -5),         # birth after end: negative, truncated toward zero
        (None, ts(2001, 1, 1), None),
    ]
    df = spark.createDataFrame(rows, "a timestamp_ntz, b timestamp_ntz, want int")
    got = df.select(completed_years("a", "b").alias("y"), "want").collect()
    assert [r.y for r in got] == [r.want for r in got]


def test_whole_days_truncates_toward_zero(spark):
    df = spark.createDataFrame([(ts(2000, 1, 2), ts(2000, 1, 1, 23)), (ts(2000, 1, 1), ts(2000, 1, 3, 1))],
                               "a timestamp_ntz, b timestamp_ntz")
    assert [r.d for r in df.select(whole_days("a", "b").alias("d")).collect()] == [0, 2]


def test_age_needs_explicit_as_of(spark):
    df = spark.createDataFrame([(ts(1990, 6, 1), None)], "dob timestamp_ntz, dod timestamp_ntz")
    assert df.select(age_at("dob", "dod", as_of="2020-06-01").alias("a")).first().a == 30
    try:
        age_at("dob")
    except ValueError:
        pass
    else:
        raise AssertionError("age without an end date must require as_of")


def test_parse_two_formats_and_garbage(spark):
    df = spark.createDataFrame([("2020-01-02 03:04:05",), ("2020-01-02",), ("abc",), (None,), ("2020-02-30",)], "s string")
    got = [r.t for r in df.select(parse_timestamp("s").alias("t")).collect()]
    assert got == [ts(2020, 1, 2, 3, 4, 5), ts(2020, 1, 2), None, None, None]


def test_decimal_hour_and_buckets(spark):
    df = spark.createDataFrame([(ts(2020, 1, 1, 14, 30), 49.95, -3)], "t timestamp_ntz, w double, n int")
    r = df.select(decimal_hour("t").alias("h"), bucket_floor("w", 10).alias("b"), bucket_floor("n", 10).alias("nb")).first()
    assert (r.h, r.b, r.nb) == (14.5, 40, -10)


def test_flag_between_null_is_zero(spark):
    df = spark.createDataFrame([(ts(2020, 1, 5), ts(2020, 1, 1), ts(2020, 1, 9)), (None, ts(2020, 1, 1), ts(2020, 1, 9)),
                                (ts(2020, 1, 10), ts(2020, 1, 1), ts(2020, 1, 9))], "d timestamp_ntz, a timestamp_ntz, b timestamp_ntz")
    assert [r.f for r in df.select(flag_between("d", "a", "b").alias("f")).collect()] == [1, 0, 0]


def test_rule_table_first_match_default_and_filter(spark):
    rules = RuleTable([Rule("A", prefixes=("038",)), Rule("B", equals=("5990", "00845")), Rule("C", prefixes=("03",))],
                      default="Other")
    df = spark.createDataFrame([("0381",), ("00845",), ("0399",), ("V4581",), (None,)], "c string")
    got = df.select(rules.label("c").alias("l"), rules.matches("c").alias("m")).collect()
    assert [r.l for r in got] == ["A", "B", "C", "Other", "Other"]
    assert [r.m for r in got] == [True, True, True, False, None]
    assert df.where(rules.matches("c")).count() == 3


def test_half_open_bands_have_no_gaps(spark):
    bands = RuleTable.bands((40, 50, 60), ("<40", "40-49", "50-59", "60+"))
    df = spark.createDataFrame([(39.99,), (40.0,), (49.95,), (50.0,), (1e9,)], "w double")
    assert [r.b for r in df.select(bands.label("w").alias("b")).collect()] == ["<40", "40-49", "40-49", "50-59", "60+"]


def test_value_map_null_key_and_miss(spark):
    df = spark.createDataFrame([("a",), ("zz",), (None,)], "k string")
    got = df.select(value_map({"a": 1, None: 15}, "k").alias("v"), value_map({"a": 1}, "k", default=0).alias("d")).collect()
    assert [r.v for r in got] == [1, None, 15]
    assert [r.d for r in got] == [1, 0, 0]


def test_code_truncate_drops_leading_zeros_and_letters(spark):
    df = spark.createDataFrame([("00845",), ("58489",), ("V4581",), (None,)], "code string")
    assert [r.t for r in df.select(code_truncate("code").alias("t")).collect()] == ["845", "584", None, None]


def test_hash_fraction_is_stable_and_matches_duckdb(spark):
    import duckdb

    df = spark.range(50).select(F.col("id"), hash_fraction("id").alias("f"), hash_bucket("id", 100).alias("b"))
    got = {r.id: (r.f, r.b) for r in df.collect()}
    want = duckdb.sql("SELECT i, (('0x' || substr(md5('42:' || CAST(i AS VARCHAR)), 1, 8))::BIGINT) / 4294967296.0, "
                      "(('0x' || substr(md5('42:' || CAST(i AS VARCHAR)), 1, 8))::BIGINT) % 100 FROM range(50) t(i)").fetchall()
    for i, f, b in want:
        assert got[i] == (f, b)


def test_pad_array(spark):
    df = spark.createDataFrame([([1, 2, 3],), ([],)], "a array<bigint>")
    assert [r.p for r in df.select(pad_array("a", 4, 0).alias("p")).collect()] == [[1, 2, 3, 0], [0, 0, 0, 0]]


def test_parse_is_independent_of_session_time_zone(spark):
    df = spark.createDataFrame([("2021-03-14 02:30:00",), ("1969-07-20",)], "s string")
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        got = [r.t for r in df.select(parse_timestamp("s").alias("t")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == [ts(2021, 3, 14, 2, 30), ts(1969, 7, 20)]


def test_legacy_between_bands_leave_gaps(spark):
    legacy = RuleTable.between([("40-49", 40, 49.9), ("50-59", 50, 59.9)], default="none")
    df = spark.createDataFrame([(45.0,), (49.95,), (50.0,), (59.9,)], "w double")
    assert [r.b for r in df.select(legacy.label("w").alias("b")).collect()] == ["40-49", "none", "50-59", "50-59"]


def test_strict_filter_reproduces_unreachable_labels(spark):
    labels = RuleTable([Rule("Sepsis", prefixes=("038",)), Rule("Skin", prefixes=("680", "681", "682"))],
                       default="Other")
    narrow = RuleTable([Rule("Sepsis", prefixes=("038",)), Rule("Skin", prefixes=("680",))])
    df = spark.createDataFrame([("0381",), ("6801",), ("6811",), ("4010",)], "c string")
    full = sorted((r.c, r.label) for r in labels.select_labelled(df, "c").collect())
    legacy = sorted((r.c, r.label) for r in labels.select_labelled(df, "c", strict_filter=narrow).collect())
    assert full == [("0381", "Sepsis"), ("6801", "Skin"), ("6811", "Skin")]
    assert legacy == [("0381", "Sepsis"), ("6801", "Skin")]
