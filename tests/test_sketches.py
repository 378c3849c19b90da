"""Mergeable sketches against exact counts."""

import pytest
from pyspark.sql import functions as F

from cohortkit.operators import sketches as S

PROBS = {"q1": 0.25, "median": 0.5, "p99": 0.99}


def table(spark, n=60_000):
    """A third of the rows lie in one group; keys repeat across days."""
    r = spark.range(n).withColumn("g", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), (F.col("id") % 7).cast("string"))))
    return r.select("g", (F.col("id") % 10).cast("int").alias("day"), (F.col("id") % 9001).alias("u"),
                    F.when(F.col("id") % 11 == 0, None).otherwise(F.pow(F.pmod(F.xxhash64("id"), F.lit(5000)), 2)).alias("v"))


def test_merged_days_stay_within_the_stated_errors(spark):
    df = table(spark)
    daily = S.sketch_groups(df, ["g", "day"], ["u"], ["v"]).cache()
    for groups in (["g"], ["day"], ["g", "day"]):
        merged = S.estimated(S.merge_groups(daily, groups), groups, PROBS)
        exact = df.groupBy(*groups).agg(F.countDistinct("u").alias("users"), F.count(F.lit(1)).alias("rows"))
        out = S.distinct_within(merged, exact, groups, "u_distinct", "users").collect()
        assert out and all(r["within"] for r in out)
        assert {tuple(r[g] for g in groups): r["n"] for r in merged.collect()} == {tuple(r[g] for g in groups): r["rows"] for r in exact.collect()}
        ranks = S.quantiles_within(df, "v", merged, groups, PROBS).collect()
        assert len(ranks) == len(PROBS) * len(out) and all(r["within"] for r in ranks)


def test_merging_counts_as_one_pass_would(spark):
    df = table(spark, 5000)
    merged = S.estimated(S.merge_groups(S.sketch_groups(df, ["g", "day"], ["u"]), ["g"]), ["g"])
    whole = S.estimated(S.sketch_groups(df, ["g"], ["u"]), ["g"])
    got, want = ({r["g"]: r["u_distinct"] for r in x.collect()} for x in (merged, whole))
    assert got == pytest.approx(want, rel=0.01)


def test_groups_without_values_and_no_rows(spark):
    df = spark.createDataFrame([("a", 1, None, None), ("b", 1, 5, 2.5), ("b", 2, 5, 2.5), (None, 1, 6, 1.0)], "g string, day int, u long, v double")
    out = {r["g"]: r.asDict() for r in S.estimated(S.merge_groups(S.sketch_groups(df, ["g", "day"], ["u"], ["v"]), ["g"]), ["g"], PROBS).collect()}
    assert out["a"]["u_distinct"] == 0 and out["a"]["v_median"] is None and out["a"]["n"] == 1
    assert out["b"]["u_distinct"] == 1 and out["b"]["v_p99"] == 2.5 and out[None]["v_q1"] == 1.0
    assert S.sketch_groups(df.limit(0), ["g"], ["u"], ["v"]).collect() == []


def test_a_wrong_estimate_is_told(spark):
    df = table(spark, 3000)
    found = S.estimated(S.sketch_groups(df, ["g"], ["u"], ["v"]), ["g"], PROBS)
    bad = found.withColumns({"u_distinct": F.col("u_distinct") * 2, "v_median": F.col("v_q1")})
    exact = df.groupBy("g").agg(F.countDistinct("u").alias("users"))
    assert not any(r["within"] for r in S.distinct_within(bad, exact, ["g"], "u_distinct", "users").collect())
    told = S.quantiles_within(df, "v", bad, ["g"], PROBS).collect()
    assert not any(r["within"] for r in told if r["quantile"] == "median") and all(r["within"] for r in told if r["quantile"] == "q1")
