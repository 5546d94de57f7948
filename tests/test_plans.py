"""Plan-level guards: properties that matter at scale, checked on the physical plans."""

import contextlib
import io

import __spark_entry__ as E

# queries whose construction fits a model (checked elsewhere); planning them here would only repeat the fits
MODEL_QUERIES = {"fit_logistic_scores", "model_evaluation", "cross_validate", "bootstrap_ci", "feature_importance",
                 "score_export", "risk_tier_shares", "feature_screen",
                 "model_classification_report", "model_roc_points", "model_ks_statistic"}


def physical_plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_no_cross_joins_and_sort_merge_only_where_intended(spark):
    offenders, smj = [], []
    for name, fn in E.queries().items():
        if name in MODEL_QUERIES:
            continue
        plan = physical_plan(fn(spark, "/root/testdata/sf0.001"))
        if "BroadcastNestedLoopJoin" in plan or "CartesianProduct" in plan:
            offenders.append(name)
        if "SortMergeJoin" in plan:
            smj.append(name)
    assert offenders == []
    assert smj == ["feature_store_join"]


def test_quality_filter_reaches_the_scan(spark):
    plan = physical_plan(E.queries()["clean_stays"](spark, "/root/testdata/sf0.001"))
    assert "PushedFilters: [IsNotNull(patient_id), IsNotNull(age), GreaterThanOrEqual(age,18)" in plan


def test_measures_read_only_needed_columns(spark):
    plan = physical_plan(E.queries()["measures_global"](spark, "/root/testdata/sf0.001"))
    schema = [ln for ln in plan.splitlines() if ln.startswith("ReadSchema")][0]
    assert "patient_id" not in schema and "hopital_region" not in schema


def test_size_checked_broadcast_falls_back_to_a_shuffle_join(spark):
    from pyspark.sql import functions as F

    from carestay.plans.joins import broadcast_if_small
    big = spark.range(0, 2000).select((F.col("id") % 50).alias("k"), F.col("id").alias("v"))
    small = spark.range(0, 50).select(F.col("id").alias("k"), (F.col("id") * 10).alias("w"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        fast = big.join(broadcast_if_small(small), "k")
        slow = big.join(broadcast_if_small(small, max_rows=0), "k")
        assert "BroadcastHashJoin" in physical_plan(fast)
        assert "BroadcastHashJoin" not in physical_plan(slow) and "SortMergeJoin" in physical_plan(slow)
        assert sorted(fast.collect()) == sorted(slow.collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
