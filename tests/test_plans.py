"""Driver contract, plan assertions and the reference's cross-table invariants on the stand-ins."""

import glob
import os

from pyspark.sql import functions as F

import __spark_entry__ as entry
from cohortkit.plans import catalogue, extracts, reports
from cohortkit.plans.standins import StandIns
from cohortkit.sources.io import read_table, stage_path, write_csv
from cohortkit.streaming import append_filtered
from tests.conftest import SMALL, SMOKE


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["age_group", "male_count", "female_count", "is_total"]


def test_every_key_has_sql_or_is_a_model_key():
    qs, sql = catalogue.queries(), catalogue.oracle_sql()
    assert set(sql) <= set(qs)
    rows_only = set(qs) - set(sql)
    assert rows_only == {"clf_logreg", "clf_logreg_balanced", "logreg_loss_curve", "mlp_loss_curve", "clf_notes", "multilabel_loss_curve",
                         "multilabel_learned", "rank_compare_learned", "boost_error_curve", "clf_boosted", "first_words_projection", "words_projection",
                         "embeddings_projection", "clf_forest", "clf_gbt", "clf_mlp", "learning_curve", "score_rows",
                         "word2vec_vectors", "word2vec_similar", "pca_projection"}


def test_prefix_filter_reaches_parquet(spark):
    p = plan_of(StandIns(spark, SMALL).cohort_lines())
    assert "StringStartsWith(p_name,blue)" in p


def test_scan_is_pruned(spark):
    import re

    p = plan_of(extracts.scan_pruned(spark, SMALL))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", p).group(1)
    cols = {c.split(":")[0] for c in schema.split(",")}
    assert cols == {"user_id", "event_type", "value"}


def test_membership_is_semi_join(spark):
    assert "LeftSemi" in plan_of(extracts.semi_notes(spark, SMALL))
    assert "LeftSemi" in plan_of(reports.lab_abnormal_stats(spark, SMALL))


def test_distinct_buckets_plan_no_expand(spark):
    assert "Expand" not in plan_of(reports.infection_by_disease(spark, SMALL))
    assert "Expand" not in plan_of(reports.comorbidity_buckets(spark, SMALL))


def test_rollup_expands_aggregated_rows_only(spark):
    p = plan_of(reports.rollup_age_gender(spark, SMALL))
    # the Expand sits above the first aggregation, not above the scan/join
    assert p.index("Expand") < p.rindex("HashAggregate")


def test_table1_total_row_is_the_sum(spark):
    rows = reports.rollup_age_gender(spark, SMALL).collect()
    total = [r for r in rows if r.is_total == 1][0]
    groups = [r for r in rows if r.is_total == 0]
    assert total.male_count == sum(r.male_count for r in groups)
    assert total.female_count == sum(r.female_count for r in groups)


def test_table7_readmitted_plus_not_equals_admissions(spark):
    for r in reports.insurance_outcomes(spark, SMALL).collect():
        assert r.readmission_count + r.not_readmission_count == r.total_patients_mortality
        assert r.died_count + r.survived_count == r.total_patients_mortality
        assert abs(r.survival_rate - 100.0 * r.survived_count / r.total_patients_mortality) < 1e-6


def test_table10_totals_match_distinct_cohort_admissions(spark):
    t10 = reports.los_mortality(spark, SMALL)
    total = t10.agg(F.sum("total")).first()[0]
    coh = extracts.cohort_prefix(spark, SMALL)
    st = StandIns(spark, SMALL)
    last = st.t("lineitem", "l_orderkey", "l_shipdate").groupBy("l_orderkey").agg(F.max("l_shipdate").alias("d"))
    adm = st.admissions("o_orderkey", "o_orderdate")
    nonneg = coh.join(adm, "o_orderkey").join(last, F.col("o_orderkey") == F.col("l_orderkey")) \
        .where(F.col("d") >= F.col("o_orderdate")).count()
    assert total == nonneg


def test_weight_bands_may_exceed_patient_count(spark):
    rows = reports.comorbidity_buckets(spark, SMALL).collect()
    assert all(sum(getattr(r, f"band_{b}") for b in reports.WEIGHT_BANDS) >= r.patient_count for r in rows)


def test_materialize_cuts_lineage(spark):
    from cohortkit.plans.handoffs import materialize_stage

    df = materialize_stage(spark, SMOKE)
    p = plan_of(df)
    assert "cohortkit-stages" in p and "BroadcastHashJoin" not in p


def test_streaming_chunked_filter_append(spark, scratch):
    events = read_table(spark, SMOKE, "events")
    src = os.path.join(scratch, "incoming")
    events.repartition(4).write.parquet(src)
    sink = os.path.join(scratch, "out")
    ckpt = os.path.join(scratch, "ckpt")
    pred = F.col("event_type").isin("click", "view")
    append_filtered(spark, src, events.schema, pred, ["event_id", "user_id", "value"], sink, ckpt)
    got = spark.read.parquet(sink)
    want = events.where(pred).select("event_id", "user_id", "value")
    assert got.count() == want.count() and got.exceptAll(want).count() == 0
    # re-running with the same checkpoint appends nothing twice
    append_filtered(spark, src, events.schema, pred, ["event_id", "user_id", "value"], sink, ckpt)
    assert spark.read.parquet(sink).count() == want.count()
    assert len(glob.glob(os.path.join(sink, "*.parquet"))) >= 1


def test_csv_sink_keeps_multiline_text(spark):
    notes = spark.createDataFrame([(1, "line one\nline two, with comma"), (2, 'a "quoted" word')], "id int, text string")
    path = write_csv(notes, stage_path(spark, "notes-csv"))
    from cohortkit.sources.io import read_csv

    back = read_csv(spark, path, "id int, text string")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, notes.collect()))


def test_report_sql_text_runs_on_spark_sql(spark):
    """Report table 1 as a SQL text over registered views equals the DataFrame plan."""
    from cohortkit.sources.io import register_tables

    register_tables(spark, SMALL, ["lineitem", "part", "orders", "customer"])
    sql = """
      WITH s AS (SELECT timestampdiff(YEAR, o.o_orderdate, l.l_shipdate) AS age_group, c.c_mktsegment AS seg
                 FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
                 JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey
                 WHERE p.p_name LIKE 'blue%' AND l.l_shipdate >= o.o_orderdate)
      SELECT age_group, count_if(seg = 'BUILDING') AS male_count, count_if(seg = 'MACHINERY') AS female_count,
             CAST(grouping(age_group) AS INT) AS is_total
      FROM s GROUP BY ROLLUP(age_group) ORDER BY age_group NULLS LAST"""
    got = sorted(map(tuple, spark.sql(sql).collect()), key=repr)
    want = sorted(map(tuple, reports.rollup_age_gender(spark, SMALL).collect()), key=repr)
    assert got == want


def test_json_array_source(spark, scratch):
    import json

    path = os.path.join(scratch, "vectors.json")
    with open(path, "w") as f:
        json.dump([{"id": 1, "v": [0.1, 0.2]}, {"id": 2, "v": [0.3, 0.4]}], f)
    from cohortkit.sources.io import read_json_array

    rows = read_json_array(spark, path, "id long, v array<double>").orderBy("id").collect()
    assert [r.v for r in rows] == [[0.1, 0.2], [0.3, 0.4]]


def test_model_keys_are_deterministic(spark):
    """Fixed seeds and md5 splits: the same report twice (survey §5 f)."""
    from cohortkit.plans import learners

    for key in ("clf_logreg", "clf_forest", "pca_projection"):
        a = sorted(map(tuple, learners.QUERIES[key](spark, SMOKE).collect()), key=repr)
        b = sorted(map(tuple, learners.QUERIES[key](spark, SMOKE).collect()), key=repr)
        assert a == b and len(a) > 0, key
    rep = {r.cls: r for r in learners.clf_logreg(spark, SMOKE).collect()}
    assert rep["accuracy"].support > 0 and 0.0 <= rep["accuracy"].f1 <= 1.0


def test_single_file_csv_and_text_sinks(spark):
    from cohortkit.sources.io import read_csv, read_text, write_text

    df = spark.createDataFrame([(i, f"line {i}") for i in range(50)], "id int, text string").repartition(4)
    path = write_csv(df, stage_path(spark, "single"), single_file=True)
    assert len(glob.glob(os.path.join(path.replace("file:", ""), "part-*.csv"))) == 1
    assert read_csv(spark, path, "id int, text string").count() == 50
    tpath = write_text(df, stage_path(spark, "text"), "text")
    lines = read_text(spark, tpath)
    assert sorted(r.value for r in lines.collect()) == sorted(f"line {i}" for i in range(50))
    whole = read_text(spark, tpath, whole_file=True)
    assert sum(len(r.value.splitlines()) for r in whole.collect()) == 50


def test_keys_do_not_depend_on_session_time_zone(spark):
    keys = ["rollup_age_gender", "first_event_time", "parse_dates", "died_during_stay", "monthly_item_usage",
            "first_admission", "los_mortality"]
    qs = catalogue.queries()

    def run():
        return {k: sorted(map(repr, map(tuple, qs[k](spark, SMOKE).collect()))) for k in keys}

    utc = run()
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        other = run()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    for k in keys:
        assert utc[k] == other[k], k
