"""KPI mart from merged batch state; uniqueness checks in one shuffle."""

import pytest
from pyspark.sql import functions as F

from carestay.operators import gold, martstate, quality, silver
from carestay.plans.joins import materialize
from carestay.sources.fixture import stays_raw
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def features(spark):
    return materialize(gold.with_features(silver.clean_stays(stays_raw(spark, SF_SMALL))))


def rows(df):
    return sorted((tuple(r[c] for c in sorted(df.columns)) for r in df.collect()), key=str)


def test_state_of_batches_equals_one_run(spark, features, tmp_path):
    want = rows(gold.kpi_mart(features))
    state = martstate.KpiState(spark, str(tmp_path / "state"))
    assert state.mart().count() == 0 and state.mart().columns == gold.kpi_mart(features).columns and state.merge() == 0
    part = F.pmod(F.xxhash64("patient_id"), F.lit(5))
    for k in range(5):
        assert state.absorb(features.where(part == k), f"b{k}")
        assert state.absorb(features.where(part == k), f"b{k}")  # a replay before any merge replaces its own state
        if k in (1, 3):
            assert state.merge() == (k + 1) // 2
            assert not state.absorb(features, f"b{k}")  # a replay after it is passed over
    assert rows(state.mart()) == want and state.generation() == 2
    assert rows(martstate.KpiState(spark, str(tmp_path / "state")).mart()) == want  # opened anew


def test_a_merge_cut_short_changes_nothing(spark, features, tmp_path):
    state = martstate.KpiState(spark, str(tmp_path / "state"))
    state.absorb(features.where("age < 60"), "young")
    state.merge()
    state.absorb(features.where("age >= 60"), "old")
    want = rows(gold.kpi_mart(features))
    # rows of a generation whose ids were never written
    state.state().write.parquet(str(tmp_path / "state" / "merged" / "generation=2"))
    assert rows(state.mart()) == want
    assert state.merge() == 2 and rows(state.mart()) == want


def test_batches_scan_only_themselves_and_null_values_are_groups(spark, features, tmp_path):
    odd = features.withColumn("service", F.when(F.col("age") > 50, F.col("service"))).withColumn("indice_complexite", F.when(F.col("age") > 30, F.col("indice_complexite")))
    plan = martstate.batch_state(odd)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    state = martstate.KpiState(spark, str(tmp_path / "state"))
    for k in range(2):
        state.absorb(odd.where(F.pmod(F.xxhash64("patient_id"), F.lit(2)) == k), str(k))
    assert rows(state.mart()) == rows(gold.kpi_mart(odd))


def test_stream_of_stays_keeps_the_mart(spark, tmp_path):
    raw = stays_raw(spark, SF_SMALL)
    raw.repartition(3).write.parquet(str(tmp_path / "in"))
    to_features = lambda batch: gold.with_features(silver.clean_stays(batch))
    stream = spark.readStream.schema(raw.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    for _ in range(2):  # the second run finds nothing new
        (stream.writeStream.foreachBatch(martstate.batch_sink(str(tmp_path / "state"), to_features))
         .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start().awaitTermination(120))
    got = martstate.KpiState(spark, str(tmp_path / "state")).mart()
    # per-batch feature statistics do not enter the KPIs
    assert rows(got) == rows(gold.kpi_mart(to_features(raw)))


def test_all_uniqueness_checks_take_one_shuffle(spark):
    df = spark.createDataFrame([(1, "a", 5), (1, "b", None), (2, "b", None), (None, "1", 7), (None, "b", 7)], "x int, y string, z int")
    assert quality.duplicate_counts(df, ["x", "y", "z"]).first().asDict() == {"x": 1, "y": 1, "z": 1}
    plan = quality.duplicate_counts(df, ["x", "y", "z"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    suite = [quality.expect_unique(c) for c in "xyz"] + [quality.expect_not_null("x")]
    got = {(r["check"], r["column"]): (r["failing_rows"], r["status"]) for r in quality.run_expectations(df, suite, "m").collect()}
    assert got == {("unique", "x"): (1, "FAIL"), ("unique", "y"): (1, "FAIL"), ("unique", "z"): (1, "FAIL"), ("not_null", "x"): (2, "FAIL")}
    empty = quality.duplicate_counts(df.limit(0), ["x", "y"]).first()
    assert tuple(empty) == (0, 0)
