"""Operator properties on hand-made frames, including skew and tie cases."""

import itertools
import math

from pyspark.sql import functions as F

from cohortkit.operators import cohort as C
from cohortkit.operators import crosstab as X
from cohortkit.operators import features as FE
from cohortkit.operators import lists as L
from cohortkit.operators import metrics as M
from cohortkit.operators import text as T
from cohortkit.operators import vectors as V


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rollup_total_row_and_null_group(spark):
    df = spark.createDataFrame([(1, "M"), (1, "F"), (None, "M"), (2, "M")], "g int, s string")
    out = X.conditional_counts(df, ["g"], "s", {"m": "M", "f": "F"}, rollup=True).collect()
    rows = {(r.g, r.is_total): (r.m, r.f) for r in out}
    assert rows[(None, 1)] == (3, 1)          # grand total
    assert rows[(None, 0)] == (1, 0)          # a real null group is not the total
    assert rows[(1, 0)] == (1, 1)


def test_distinct_pivot_matches_direct_count_distinct_without_expand(spark):
    rows = [(g, k, b) for g in ("x", "y") for k in range(20) for b in (0, 10, 10, 20) if (k + len(g)) % 3]
    df = spark.createDataFrame(rows, "g string, k int, b int")
    ours = X.distinct_pivot_counts(df, ["g"], "b", [0, 10, 20], "k", ["b0", "b10", "b20"])
    direct = df.groupBy("g").agg(*[F.countDistinct(F.when(F.col("b") == v, F.col("k"))).alias(f"b{v}") for v in (0, 10, 20)])
    assert sorted(map(tuple, ours.collect())) == sorted(map(tuple, direct.select("g", "b0", "b10", "b20").collect()))
    assert "Expand" not in plan_of(ours)
    assert "Expand" in plan_of(direct)


def test_first_per_key_ties_and_skew(spark):
    # one hot key holds most rows; ties on the timestamp are broken by the id
    rows = [(1, 5, i) for i in range(1000)] + [(1, 3, 7), (1, 3, 2), (2, 9, 1), (2, None, 0)]
    df = spark.createDataFrame(rows, "k int, t int, id int")
    got = {r.k: (r.t, r.id) for r in C.first_per_key(df, "k", ["t", "id"], []).collect()}
    assert got == {1: (3, 2), 2: (9, 1)}


def test_top_k_keys_and_per_group_ties(spark):
    df = spark.createDataFrame([("a", "x")] * 3 + [("a", "y")] * 3 + [("a", "z")] + [("b", "z")] * 2, "g string, i string")
    top = C.top_k_keys(df, "i", 2).collect()
    assert [(r.i, r.n) for r in top] == [("x", 3), ("y", 3)]
    counts = df.groupBy("g", "i").count()
    per = C.top_k_per_group(counts, "g", "count", 1, ["i"]).collect()
    assert sorted((r.g, r.i) for r in per) == [("a", "x"), ("b", "z")]


def test_restrict_to_top_k_is_a_broadcast_semi_join(spark):
    df = spark.createDataFrame([(i % 7, i) for i in range(100)], "k int, v int")
    out = C.restrict_to_top_k(df, "k", 3)
    assert out.select("k").distinct().count() == 3
    p = plan_of(out)
    assert "LeftSemi" in p and "Broadcast" in p


def test_first_n_per_key_plans_group_limit(spark):
    df = spark.createDataFrame([(k, t) for k in range(3) for t in range(50)], "k int, t int")
    out = C.first_n_per_key(df, "k", ["t"], 5)
    assert out.count() == 15
    assert "WindowGroupLimit" in plan_of(out)


def test_ordered_list_and_concat_text(spark):
    df = spark.createDataFrame([(1, 2, "b"), (1, 1, "a"), (1, 3, None), (2, 1, "c")], "k int, o int, t string")
    lists = {r.k: r.items for r in L.ordered_list(df.where(F.col("t").isNotNull()), "k", "t", ["o"]).collect()}
    assert lists == {1: ["a", "b"], 2: ["c"]}
    text = {r.k: r.text for r in L.concat_text(df, "k", "t", ["o"]).collect()}
    assert text == {1: "a b", 2: "c"}


def test_count_vector_and_multi_hot(spark):
    df = spark.createDataFrame([(1, 0), (1, 0), (1, 2), (2, 1)], "k int, idx int")
    cv = {r.k: [r.item_0, r.item_1, r.item_2] for r in L.count_vector(df, "k", "idx", 3).collect()}
    mh = {r.k: [r.item_0, r.item_1, r.item_2] for r in L.count_vector(df, "k", "idx", 3, binary=True).collect()}
    assert cv == {1: [2, 0, 1], 2: [0, 1, 0]}
    assert mh == {1: [1, 0, 1], 2: [0, 1, 0]}


def test_global_index_keeps_rows_with_a_payload_over_many_partitions(spark):
    conf = {"spark.sql.shuffle.partitions": "16", "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1m",
            "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false"}
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        n = 600_000
        df = spark.range(n).select(F.xxhash64("id").alias("key"), F.array_repeat(F.rand(1), 16).alias("payload"))
        got = FE.global_index(df, ["key"]).agg(F.count(F.lit(1)), F.countDistinct("pos"), F.max("pos")).first()
        assert tuple(got) == (n, n, n - 1)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_global_index_is_consecutive(spark):
    df = spark.range(0, 5000, 3).withColumnRenamed("id", "key").repartition(7)
    got = sorted((r.pos, r.key) for r in FE.global_index(df, ["key"]).collect())
    assert [p for p, _ in got] == list(range(len(got)))
    assert [k for _, k in got] == list(range(0, 5000, 3))


def test_scaling_and_constant_column(spark):
    df = spark.createDataFrame([(1, 2.0), (2, 4.0), (3, 6.0)], "id int, v double")
    assert [r.scaled for r in FE.minmax_scale(df, "v").orderBy("id").collect()] == [0.0, 0.5, 1.0]
    const = spark.createDataFrame([(1, 5.0), (2, 5.0)], "id int, v double")
    assert [r.scaled for r in FE.minmax_scale(const, "v").collect()] == [0.0, 0.0]
    std = FE.standard_scale(df, "v", df).orderBy("id").collect()
    sd = math.sqrt(8 / 3)
    assert [r.scaled for r in std] == [round(-2 / sd, 6), 0.0, round(2 / sd, 6)]


def test_balance_classes_with_replacement(spark):
    rows = [(i, "big") for i in range(30)] + [(100 + i, "small") for i in range(4)]
    out = FE.balance_classes(spark.createDataFrame(rows, "id int, c string"), "c", "id", 10).collect()
    per = {c: [r for r in out if r.c == c] for c in ("big", "small")}
    assert len(per["big"]) == 10 and len(per["small"]) == 10
    assert {r.copy for r in per["big"]} == {0}
    assert {r.id for r in per["small"]} == {100, 101, 102, 103}


def test_downsample_majority_and_weights(spark):
    rows = [(i, 1) for i in range(400)] + [(1000 + i, 0) for i in range(50)]
    df = spark.createDataFrame(rows, "id int, y int")
    out = FE.downsample_majority(df, "y", "id", 0.25)
    n1 = out.where("y = 1").count()
    assert out.where("y = 0").count() == 50 and 60 < n1 < 140
    w = {r.y: (r.weight, r.pos_weight) for r in FE.class_weights(df, "y").collect()}
    assert w[1] == (round(450 / (2 * 400), 6), round(50 / 400, 6))
    assert w[0][0] == round(450 / (2 * 50), 6)


def test_classification_report_against_hand_counts(spark):
    y = [0, 0, 0, 1, 1, 1, 1, 2]
    p = [0, 1, 0, 1, 1, 0, 1, 0]
    df = spark.createDataFrame(list(zip(y, p)), "y int, p int")
    rep = {r.cls: r for r in M.classification_report(df, "y", "p").collect()}
    assert (rep["0"].precision, rep["0"].recall) == (round(2 / 4, 6), round(2 / 3, 6))
    assert (rep["1"].precision, rep["1"].recall) == (0.75, 0.75)
    assert (rep["2"].precision, rep["2"].recall, rep["2"].f1) == (0.0, 0.0, 0.0)   # zero division → 0
    assert rep["accuracy"].f1 == round(5 / 8, 6) and rep["accuracy"].support == 8


def test_multilabel_counts(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (0, 1), (0, 0), (1, 1)], "a int, p int")
    r = M.prf(M.multilabel_counts(df, "a", "p")).first()
    assert (r.tp, r.fp, r.fn) == (2, 1, 1)
    assert (r.precision, r.recall) == (round(2 / 3, 6), round(2 / 3, 6))


def test_tokens_entities_and_windows(spark):
    df = spark.createDataFrame([(1, "Call 555-1234 or mail Ann.Lee@example.com, Dr. Smith! 42"), (2, "")], "id int, text string")
    toks = df.select(T.tokens("text").alias("t")).first().t
    assert toks == ["call", "555", "1234", "or", "mail", "ann", "lee", "example", "com", "dr", "smith", "42"]
    counts = {r.label: r.n for r in T.entity_label_counts(df, "text").collect()}
    assert counts["PHONE"] == 1 and counts["EMAIL"] == 1
    corpus = {r.id: r.entities for r in T.entity_corpus(df, "id", "text").collect()}
    assert corpus[1][:2] == ["Call", "555-1234"] and corpus[2] == []
    w = T.token_windows(df, "id", "text", 5, 1000).orderBy("chunk").collect()
    assert [r.n_tokens for r in w] == [5, 5, 2]          # the whole text, in windows
    assert w[2].mask == [1, 1, 0, 0, 0] and w[2].ids[2:] == [0, 0, 0]


def test_mean_word_vectors_unknown_and_empty_are_zero(spark):
    docs = spark.createDataFrame([(1, "a b zz"), (2, "")], "id int, text string")
    table = spark.createDataFrame([("a", [1.0, 2.0]), ("b", [3.0, 4.0])], "word string, vector array<double>")
    got = {r.id: r.mean_vector for r in T.mean_word_vectors(docs, "id", "text", table, 2).collect()}
    assert got == {1: [round(4 / 3, 6), 2.0], 2: [0.0, 0.0]}


def test_label_cohesion_equals_all_pairs_brute_force(spark):
    import random

    rnd = random.Random(3)
    rows = [(i, i % 3, [rnd.uniform(-1, 1) for _ in range(6)]) for i in range(40)]
    df = spark.createDataFrame(rows, "id int, label int, v array<double>")
    got = {r.label: r.cohesion for r in V.label_cohesion(df, "label", "v").collect()}

    def cos(a, b):
        return sum(x * y for x, y in zip(a, b)) / math.sqrt(sum(x * x for x in a) * sum(y * y for y in b))

    for lab in range(3):
        vs = [v for _, l_, v in rows if l_ == lab]
        s = sum((1 - cos(a, b)) ** 2 for a, b in itertools.product(vs, vs))
        assert abs(got[lab] - s / len(vs) ** 2) < 1e-6


def test_nearest_and_adjacent_pairs(spark):
    df = spark.createDataFrame([(0, 0, [1.0, 0.0]), (1, 0, [0.9, 0.1]), (2, 1, [0.0, 1.0]), (3, 1, [-1.0, 0.0])],
                               "id int, label int, v array<double>")
    near = V.nearest(df, "id", "v", 0, 2).collect()
    assert [r.id for r in near] == [1, 2]
    pairs = sorted((r.key_a, r.key_b, r.same) for r in V.adjacent_pairs(df, "id", "label", "v").collect())
    assert pairs == [(0, 1, 1), (1, 2, 0), (2, 3, 1)]


def test_box_stats_whiskers(spark):
    df = spark.createDataFrame([("a", float(v)) for v in [1, 2, 3, 4, 5, 6, 7, 8, 100]], "g string, v double")
    r = X.box_stats(df, ["g"], "v").first()
    assert (r.q1, r.median, r.q3) == (3.0, 5.0, 7.0)
    assert (r.whisker_low, r.whisker_high) == (1.0, 8.0)     # 100 is beyond q3 + 1.5 IQR


def test_helpers_suffix_vector_columns_and_order(spark):
    from cohortkit.operators.cohort import join_with_suffix

    a = spark.createDataFrame([(1, "x", 5)], "k int, name string, v int")
    b = spark.createDataFrame([(1, "y", 7)], "k int, name string, w int")
    j = join_with_suffix(a, b, "k", suffix="_adm")
    assert j.columns == ["k", "name", "v", "name_adm", "w"]
    v = spark.createDataFrame([(1, [0.5, 1.5, 2.5])], "id int, e array<double>")
    assert L.explode_vector(v, "e", 3).first().asDict() == {"id": 1, "e_0": 0.5, "e_1": 1.5, "e_2": 2.5}
    wide = spark.createDataFrame([("i", 1, 9, 3), ("j", 2, 1, 3)], "item string, a int, b int, c int")
    assert X.columns_by_total(wide, ["item"], ["a", "b", "c"]).columns == ["item", "b", "c", "a"]


def test_approx_quantiles_close_to_exact(spark):
    df = spark.range(10001).select((F.col("id") * 1.0).alias("v"))
    r = df.agg(*X.approx_quantiles("v", {"med": 0.5}), *X.exact_quantiles("v", {"emed": 0.5})).first()
    assert abs(r.med - r.emed) <= 10


def test_user_tagger_hook(spark):
    import pandas as pd

    docs = spark.createDataFrame([(1, "aspirin and heparin"), (2, "none")], "id long, text string")

    def tagger(pdf):
        rows = [(i, w) for i, t in zip(pdf["id"], pdf["text"]) for w in t.split() if w.endswith("in")]
        return pd.DataFrame(rows, columns=["id", "entity"])

    got = sorted(map(tuple, T.tag_with(docs, tagger, "id long, entity string").collect()))
    assert got == [(1, "aspirin"), (1, "heparin")]


def test_first_per_key_packed_path_is_a_hash_aggregate(spark):
    import datetime as dt

    t0 = dt.datetime(1960, 1, 1)
    rows = [(1, t0 + dt.timedelta(days=d), -5 + d, float(d)) for d in (3, 1, 2)] + \
           [(1, t0 + dt.timedelta(days=1), -9, 99.0), (2, dt.datetime(2030, 5, 5), 2 ** 62, 7.0)]
    df = spark.createDataFrame(rows, "k int, ts timestamp_ntz, id long, v double")
    out = C.first_per_key(df, "k", ["ts", "id"], ["v"])
    got = {r.k: (r.ts, r.id, r.v) for r in out.collect()}
    assert got == {1: (t0 + dt.timedelta(days=1), -9, 99.0), 2: (dt.datetime(2030, 5, 5), 2 ** 62, 7.0)}
    p = plan_of(out)
    assert "HashAggregate" in p and "SortAggregate" not in p


def test_scalar_vector_helpers(spark):
    from cohortkit.functions.scalar import argmax, clip, cosine, euclidean

    df = spark.createDataFrame([([0.2, 0.9, 0.9], [1.0, 0.0, 0.0], 1.7)], "a array<double>, b array<double>, x double")
    r = df.select(argmax("a").alias("am"), clip("x").alias("c"), cosine("b", "b").alias("cs"),
                  euclidean("a", "a").alias("e")).first()
    assert (r.am, r.c, r.cs, r.e) == (1, 1.0, 1.0, 0.0)


def test_first_per_key_independent_of_session_time_zone(spark):
    import datetime as dt

    # 02:30 on 2021-03-14 does not exist in New York (clocks jump 02:00 → 03:00)
    rows = [(1, dt.datetime(2021, 3, 14, 3, 15), 1, "later"), (1, dt.datetime(2021, 3, 14, 2, 30), 2, "earlier")]
    df = spark.createDataFrame(rows, "k int, ts timestamp_ntz, id long, tag string")
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        got = C.first_per_key(df, "k", ["ts", "id"], ["tag"]).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert (got.ts, got.tag) == (dt.datetime(2021, 3, 14, 2, 30), "earlier")


def test_ordered_chunks_split_a_hot_key_and_keep_everything(spark):
    import random

    rnd = random.Random(7)
    rows = [(1, rnd.randint(0, 500), f"v{i}") for i in range(2500)] + [(2, 3, "b"), (2, 1, "a"), (3, 1, None)]
    df = spark.createDataFrame(rows, "k int, o int, v string")
    got = L.ordered_chunks(df, "k", "v", ["o"], 300).collect()
    by_key = {}
    for r in sorted(got, key=lambda r: (r.k, r.chunk)):
        assert len(r["items"]) <= 300
        by_key.setdefault(r.k, []).extend(r["items"])
    want = sorted(((o, v) for k, o, v in rows if k == 1), key=lambda t: (t[0], t[1]))
    assert by_key[1] == [v for _, v in want]
    assert len([r for r in got if r.k == 1]) == 9
    assert by_key[2] == ["a", "b"] and 3 not in by_key
    text = {(r.k, r.chunk): r.text for r in L.chunked_text(df.where("k = 2"), "k", "v", ["o"], 1).collect()}
    assert text == {(2, 0): "a", (2, 1): "b"}


def _quantile_rows(spark):
    rows = [("a", float(v % 7)) for v in range(100)] + [("b", 5.0), ("b", None), ("c", None), (None, 1.0), (None, 4.0)]
    rows += [("hot", float((v * 37) % 1001)) for v in range(3000)] + [("hot", 50000.0)]
    return spark.createDataFrame(rows, "g string, v double").repartition(6)


def test_ranked_quantiles_equal_percentiles(spark):
    df = _quantile_rows(spark)
    probs = {"q1": 0.25, "med": 0.5, "q9": 0.9}
    want = df.groupBy("g").agg(*[F.percentile("v", p).alias(n) for n, p in probs.items()],
                               F.count(F.lit(1)).alias("rows"), F.count("v").alias("n"))
    cells, spans = X.value_ranks(df, ["g"], "v")
    got = X.ranked_quantiles(cells, spans, ["g"], probs, F.sum("rows").alias("rows"), F.sum("n").alias("n"))
    key = lambda r: (r["g"] is None, r["g"] or "")
    a, b = sorted(want.collect(), key=key), sorted(got.select(*want.columns).collect(), key=key)
    assert len(a) == len(b) == 5
    for x, y in zip(a, b):
        assert (x["g"], x["rows"], x["n"]) == (y["g"], y["rows"], y["n"])
        for n in probs:
            assert x[n] == y[n] if x[n] is None else abs(x[n] - y[n]) < 1e-9
    none = X.value_ranks(df.where("false"), ["g"], "v")
    assert X.ranked_quantiles(*none, ["g"], probs).collect() == []


def test_ranked_quantiles_of_a_group_over_many_partitions(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        df = _quantile_rows(spark)
        cells, spans = X.value_ranks(df, ["g"], "v")
        assert spans.where("g = 'hot'").count() > 4
        got = {r["g"]: r["med"] for r in X.ranked_quantiles(cells, spans, ["g"], {"med": 0.5}).collect()}
        want = {r["g"]: r["med"] for r in df.groupBy("g").agg(F.percentile("v", 0.5).alias("med")).collect()}
        assert got == want
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_box_stats_whiskers_of_hot_and_null_groups(spark):
    out = {r["g"]: r for r in X.box_stats(_quantile_rows(spark), ["g"], "v").collect()}
    assert out["hot"]["whisker_high"] == 1000.0 and out["hot"]["whisker_low"] == 0.0
    assert out["c"]["median"] is None and out["c"]["whisker_low"] is None
    assert out[None]["median"] == 2.5 and out["b"]["q1"] == 5.0


def test_quantile_keys_hold_no_percentile(spark):
    from cohortkit.plans import catalogue
    for key in ("value_quartiles", "box_stats", "lab_abnormal_stats"):
        plan = catalogue.queries()[key](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString().lower()
        assert "percentile" not in plan, key


def test_label_decode_and_exact_match(spark):
    df = spark.createDataFrame([(1, "x"), (2, "y"), (3, None), (4, "x")], "id int, c string")
    vocab = FE.label_index(df, "c", "i")
    coded = FE.label_encode(df, "c", "i").select("id", "i")
    back = FE.label_decode(coded, vocab, "i", "c").select("id", "c")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    cells = spark.createDataFrame([(1, 1, 1), (1, 0, 0), (2, 1, 0), (2, 1, 1)], "k int, a int, p int")
    assert tuple(M.subset_accuracy(cells, "k", "a", "p").first()) == (2, 1, 0.5)
    assert tuple(M.subset_accuracy(cells.where("false"), "k", "a", "p").first()) == (0, 0, 0.0)


def test_tfidf_terms_whole_vocabulary(spark):
    df = spark.createDataFrame([(1, "a b b"), (2, "a"), (3, None), (4, "")], "id int, t string")
    got = {(r["id"], r["term"]): (r["tf"], r["df"], r["weight"]) for r in T.tfidf_terms(df, "id", "t").collect()}
    assert got == {(1, "a"): (1, 2, 0.510826), (1, "b"): (2, 1, 1.832581), (2, "a"): (1, 2, 0.510826)}
