"""Fits of all folds at once, bootstrap over ties, correlation of shifted columns."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from carestay.operators import explore as X
from carestay.operators import gold, newton, silver, stats
from carestay.operators import model as MD
from carestay.plans.joins import materialize
from carestay.sources.fixture import stays_raw
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def train(spark):
    f = gold.with_features(silver.clean_stays(stays_raw(spark, SF_SMALL)))
    return materialize(MD.stratified_split(f).where(F.col("split") == "train"))


def test_equal_to_one_fit_after_another(spark, train):
    fits = newton.fit_together(train, folds=2)
    for f, rows in zip(fits, [train, train.where("fold <> 0"), train.where("fold <> 1")]):
        ml = MD.fit_logistic(rows, tol=1e-10)
        assert ml.feature_names() == f.feature_names() and f.n == rows.count() and f.steps < 12
        assert np.abs(np.array(ml.coefficients) - f.coefficients).max() < 1e-4
        a = {r["patient_id"]: r[MD.PROB] for r in MD.score(rows, ml).collect()}
        b = {r["patient_id"]: r[MD.PROB] for r in MD.score(rows, f).collect()}
        assert max(abs(a[i] - b[i]) for i in a) < 1e-4
        worst = newton.stationarity(rows, f).agg(F.max(F.abs("gradient"))).first()[0]
        assert worst < 1e-8


def test_levels_that_a_fold_lacks(spark, train):
    rows = train.where("not (service = 'Neurologie' and fold <> 0)")
    fits = newton.fit_together(rows, folds=2)
    assert "service_Neurologie" in fits[0].feature_names() and "service_Neurologie" not in fits[1].feature_names()
    assert newton.stationarity(rows.where("fold <> 0"), fits[1]).agg(F.max(F.abs("gradient"))).first()[0] < 1e-8
    held = newton.fold_scores(rows, fits).where("fold = 0")
    assert held.where(F.col(MD.PROB).isNull()).count() == 0


def test_separable_constant_and_missing_inputs(spark):
    cols = "readmission_30j int, fold int, x double, k double, b boolean, c string"
    rows = [(int(i >= 10), i % 2, 1e9 + i, 7.0, None if i == 3 else i % 3 == 0, None if i % 5 == 0 else "u") for i in range(20)]
    df = spark.createDataFrame(rows, cols)
    kw = {"numeric": ["x", "k"], "binary": ["b"], "categorical": ["c"]}
    fits = newton.fit_together(df, folds=2, **kw)
    assert abs(dict(zip(fits[0].feature_names(), fits[0].coefficients))["k"]) < 1e-9
    assert all(np.isfinite(f.coefficients).all() for f in fits)
    with pytest.raises(ValueError):
        newton.fit_together(df.where("x is null"), folds=2, **kw)
    with pytest.raises(ValueError):
        newton.fit_together(df.withColumn("x", F.when(F.col("fold") == 0, F.col("x"))), folds=2, **kw)


def test_cross_validation_scores_rows_by_the_fit_without_them(spark, train):
    fits = newton.fit_together(train, folds=5)
    got = {r["fold"]: r for r in MD.cross_validate(train, fits=fits).collect()}
    assert set(got) == set(range(5))
    for k in range(5):
        held = MD.score(train.where(F.col("fold") == k), fits[k + 1])
        assert got[k]["auc"] == pytest.approx(MD.exact_auc(held).first()["auc"], abs=1e-12)
        assert got[k]["f1"] == pytest.approx(MD.f1_at(held).first()["f1"], abs=1e-12)
    assert got[0]["auc_mean"] == pytest.approx(np.mean([got[k]["auc"] for k in range(5)]))
    assert got[0]["auc_std"] == pytest.approx(np.std([got[k]["auc"] for k in range(5)]))


def test_bootstrap_with_one_score_held_by_all_rows(spark):
    df = spark.range(4000).select(F.col("id").alias("patient_id"), F.lit(0.25).alias(MD.PROB), F.lit(1).alias("prediction"),
                                  (F.col("id") % 3 == 0).cast("int").alias("readmission_30j"))
    dealt = df.select(F.xxhash64("patient_id", F.lit(42)).alias("h"), F.col(MD.PROB).alias("s")).repartitionByRange(8, "s", "h")
    assert dealt.select(F.spark_partition_id().alias("p")).distinct().count() == 8
    got = [MD.bootstrap_ci(df, n=20, ranges=r).first().asDict() for r in (1, 8, 31)]
    assert got[0] == got[1] == got[2] and got[0]["auc_lo"] == got[0]["auc_hi"] == 0.5


def test_bootstrap_with_heavy_ties_at_any_range_count(spark):
    df = spark.range(3000).select(F.col("id").alias("patient_id"), F.when(F.col("id") % 4 == 0, F.rand(3)).otherwise(F.lit(0.5)).alias(MD.PROB),
                                  (F.rand(5) > 0.4).cast("int").alias("prediction"), (F.rand(7) > 0.7).cast("int").alias("readmission_30j"))
    df = materialize(df)
    got = [MD.bootstrap_ci(df, n=20, ranges=r).first().asDict() for r in (1, 3, 17)]
    assert got[0] == got[1] == got[2] and got[0]["auc_lo"] < got[0]["auc_hi"]


@pytest.mark.parametrize("shift", [0.0, 1e6, 1e9])
def test_correlation_keeps_its_digits_on_shifted_columns(spark, shift):
    rng = np.random.default_rng(4)
    a = rng.standard_normal(5000)
    b = 0.8 * a + 0.6 * rng.standard_normal(5000)
    rows = [(float(x), float(y), 3.0, None if i % 7 == 0 else float(x)) for i, (x, y) in enumerate(zip(a, b))]
    df = spark.createDataFrame(rows, "a double, b double, k double, z double").repartition(5)
    moved = df.select((F.col("a") + shift).alias("a"), (F.col("b") + shift).alias("b"), "k", "z")
    got = {(r["col_a"], r["col_b"]): r["corr"] for r in X.correlation_matrix(moved, ["a", "b", "k", "z"], digits=None).collect()}
    assert got[("b", "a")] == pytest.approx(np.corrcoef(a, b)[0, 1], abs=1e-6)
    assert got[("k", "a")] is None and got[("z", "a")] == pytest.approx(1.0, abs=1e-6)
    vif = {r["feature"]: r["vif"] for r in stats.vif(moved, ["a", "b"]).collect()}
    assert vif["a"] == vif["b"] == pytest.approx(1 / (1 - np.corrcoef(a, b)[0, 1] ** 2), abs=0.01)
