"""Positions and running totals inside each key (cohortkit.operators.running)."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cohortkit.operators.lists import chunked_text, ordered_chunks
from cohortkit.operators.running import running


def rows_of(n=4000, seed=5):
    """One key holds about a third of the rows, null keys another part; the order column has nulls and ties."""
    rnd = random.Random(seed)
    keys = ["hot"] * 3 + [None] + [f"k{i}" for i in range(60)]
    weights = [n // 9] * 3 + [n // 20] + [n // 200] * 60
    return [(rnd.choices(keys, weights)[0], rnd.choice([None, *range(40)]), i, rnd.choice([None, *range(-9, 9)])) for i in range(n)]


def brute(rows):
    out, at, total, folded = Counter(), Counter(), Counter(), Counter()
    size = Counter(r[0] for r in rows)
    for k, o, i, v in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2])):
        at[k] += 1
        total[k] += v or 0
        folded[k] ^= v or 0
        out[(k, i, at[k], size[k], total[k], folded[k])] += 1
    return out


@pytest.fixture
def many_partitions(spark):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.set("spark.sql.shuffle.partitions", old)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


SCHEMA = "k string, o int, i int, v long"
TOTALS = {"total": ("sum", "v"), "folded": ("xor", "v")}


def test_running_equals_a_loop_with_a_hot_key_over_many_partitions(many_partitions):
    rows = rows_of()
    df = many_partitions.createDataFrame(rows, SCHEMA).repartition(7)
    got = running(df, "k", ["o", "i"], size="n", totals=TOTALS)
    assert Counter((r.k, r.i, r.position, r.n, r.total, r.folded) for r in got.collect()) == brute(rows)


def test_running_one_key_repeats_and_an_empty_table(many_partitions):
    spark = many_partitions
    same = spark.range(500).select(F.lit("a").alias("k"), F.lit(1).alias("o"), F.lit(2).alias("i"), F.lit(3).cast("long").alias("v"))
    got = running(same, ["k"], ["o"], size="n", totals={"total": ("sum", "v")}).collect()
    assert sorted(r.position for r in got) == list(range(1, 501))
    assert all(r.n == 500 and r.total == 3 * r.position for r in got)
    assert running(same.limit(0), "k", ["o"], size="n", totals=TOTALS).collect() == []


def test_running_takes_descending_order_and_two_keys(many_partitions):
    rows = [(f"a{i % 2}", i % 3, i, i) for i in range(300)]
    df = many_partitions.createDataFrame(rows, SCHEMA)
    got = {r.i: r.position for r in running(df, ["k", "o"], [F.desc("i")]).collect()}
    for k in {r[:2] for r in rows}:
        mine = sorted((r[2] for r in rows if r[:2] == k), reverse=True)
        assert [got[i] for i in mine] == list(range(1, len(mine) + 1))


def exchanges(df):
    plan = df._jdf.queryExecution().sparkPlan().toString(), df._jdf.queryExecution().executedPlan().toString()
    return [line.strip() for line in plan[1].splitlines() if "Exchange hashpartitioning(" in line]


def test_chunks_meet_no_exchange_on_the_bare_key(many_partitions):
    rows = rows_of()
    df = many_partitions.createDataFrame(rows, SCHEMA).repartition(7)
    out = ordered_chunks(df, "k", "i", ["o"], 16)
    plan = exchanges(out)
    assert plan and all("__part" in x or "chunk" in x or "__key" in x for x in plan), plan
    assert not any(x.split("hashpartitioning(")[1].startswith("k#") and "chunk" not in x and "__part" not in x for x in plan)
    per = {}
    for r in out.collect():
        assert len(r["items"]) <= 16
        per.setdefault(r.k, []).append((r.chunk, r["items"]))
    for k in {r[0] for r in rows}:
        mine = [r[2] for r in sorted((r for r in rows if r[0] == k), key=lambda r: (r[1] is not None, r[1] or 0, r[2]))]
        assert [x for _, items in sorted(per[k]) for x in items] == mine


def test_chunked_text_of_a_hot_key_is_its_whole_text(many_partitions):
    rows = rows_of(1500)
    df = many_partitions.createDataFrame(rows, SCHEMA).withColumn("t", F.concat(F.lit("t"), "i"))
    got = {}
    for r in chunked_text(df, "k", "t", ["o", "i"], 10).collect():
        got.setdefault(r.k, []).append((r.chunk, r.text))
    for k in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == k), key=lambda r: (r[1] is not None, r[1] or 0, r[2]))
        assert " ".join(t for _, t in sorted(got[k])) == " ".join(f"t{r[2]}" for r in mine)
