"""Named stages follow their input."""

import os
import time

from pyspark.sql import functions as F

from cohortkit.sources import io


def folders(path):
    return sorted(f for f in os.listdir(path) if not f.startswith("."))


def written(path):
    return {f: os.path.getmtime(os.path.join(path, f, "_SUCCESS")) for f in folders(path)}


def totals(spark, src):
    return spark.read.parquet(src).groupBy("k").agg(F.sum("v").alias("v")).withColumn("w", F.col("v") * 2)


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_a_stage_is_loaded_while_its_input_stands_and_rebuilt_when_it_changes(spark, scratch):
    src, stage = f"{scratch}/in", f"{scratch}/stage"
    spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").alias("v")).write.parquet(src)
    first = rows(io.materialize(totals(spark, src), stage))
    made = written(stage)
    assert len(made) == 1
    time.sleep(0.05)
    assert rows(io.materialize(totals(spark, src), stage)) == first
    assert written(stage) == made                                   # loaded, not written again
    spark.createDataFrame([(9, 5)], "k long, v long").write.mode("append").parquet(src)
    spark.catalog.refreshByPath(src)
    again = rows(io.materialize(totals(spark, src), stage))
    assert (9, 5, 10) in again and len(again) == len(first) + 1
    assert len(folders(stage)) == 1 and folders(stage) != list(made)     # the old one is gone
    assert "in" in os.listdir(scratch)


def test_another_query_or_version_is_another_stage(spark, scratch):
    src, stage = f"{scratch}/in", f"{scratch}/stage"
    spark.range(10).select((F.col("id") % 3).alias("k"), F.col("id").alias("v")).write.parquet(src)
    io.materialize(totals(spark, src), stage)
    one = folders(stage)
    got = rows(io.materialize(totals(spark, src).where("k > 0"), stage))
    assert folders(stage) != one and all(r[0] > 0 for r in got)
    two = folders(stage)
    io.materialize(totals(spark, src).where("k > 0"), stage, version="2")
    assert folders(stage) != two and len(folders(stage)) == 1


def test_an_unfinished_stage_is_ignored(spark, scratch):
    src, stage = f"{scratch}/in", f"{scratch}/stage"
    spark.range(10).select((F.col("id") % 3).alias("k"), F.col("id").alias("v")).write.parquet(src)
    want = rows(io.materialize(totals(spark, src), stage))
    own = f"{stage}/{folders(stage)[0]}"
    os.remove(f"{own}/_SUCCESS")
    for f in os.listdir(own):
        if f.endswith(".parquet"):
            os.remove(f"{own}/{f}")
    assert rows(io.materialize(totals(spark, src), stage)) == want
    assert os.path.exists(f"{own}/_SUCCESS")


def test_rows_of_the_session_have_no_fingerprint(spark, scratch):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert io.fingerprint(df) is None
    assert rows(io.materialize(df, f"{scratch}/stage")) == [(1, 2)]
    assert rows(io.materialize(df.withColumn("b", F.lit(3)), f"{scratch}/stage")) == [(1, 3)]
    assert len(folders(f"{scratch}/stage")) == 1


def test_fingerprints_agree_for_equal_queries(spark, scratch):
    src = f"{scratch}/in"
    spark.range(10).select((F.col("id") % 3).alias("k"), F.col("id").alias("v")).write.parquet(src)
    assert io.fingerprint(totals(spark, src)) == io.fingerprint(totals(spark, src)) is not None
    wide = spark.read.parquet(src).select(*[(F.col("v") + k).alias(f"c{k}") for k in range(60)])
    other = spark.read.parquet(src).select(*[(F.col("v") + (k if k < 59 else 7)).alias(f"c{k}") for k in range(60)])
    assert io.fingerprint(wide) != io.fingerprint(other)


def test_the_key_loads_its_stage(spark):
    from cohortkit.plans.handoffs import materialize_stage

    base = "/root/testdata/sf0.001"
    first = materialize_stage(spark, base).inputFiles()
    assert sorted(materialize_stage(spark, base).inputFiles()) == sorted(first)


def test_old_unnamed_stages_are_dropped(spark):
    kept = io.materialize(spark.range(3).toDF("a"), name="young")
    old = io.materialize(spark.range(3).toDF("a"), name="old")
    path = os.path.dirname(old.inputFiles()[0].removeprefix("file://"))
    past = time.time() - 100 * 3600
    os.utime(path, (past, past))
    assert io.drop_old_stages(spark, hours=48) >= 1
    assert not os.path.exists(path) and kept.count() == 3
