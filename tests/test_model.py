import numpy as np
from pyspark.sql import functions as F

from carestay.operators import gold, model as MD, silver
from carestay.sources.fixture import stays_raw
from tests.conftest import SF_SMALL


def test_split_is_exact_per_class_and_folds_balanced(spark):
    f = gold.with_features(silver.clean_stays(stays_raw(spark, SF_SMALL)))
    s = MD.stratified_split(f.select("patient_id", "readmission_30j"), buckets=4)
    c = {(r.readmission_30j, r.split): r.n for r in s.groupBy("readmission_30j", "split").agg(F.count("*").alias("n")).collect()}
    for y in (0, 1):
        n = c[(y, "test")] + c[(y, "train")]
        assert c[(y, "test")] == int(np.floor(n * 0.2 + 0.5))
    folds = [r.n for r in s.where("split = 'train'").groupBy("fold").agg(F.count("*").alias("n")).collect()]
    assert max(folds) - min(folds) <= 2


def test_logistic_fit_is_stationary_and_scores(spark):
    f = gold.with_features(silver.clean_stays(stays_raw(spark, SF_SMALL)))
    m = MD.fit_logistic(f, tol=1e-10)
    s = MD.score(f, m)
    assert s.count() == f.count()
    auc = MD.exact_auc(s).first().auc
    assert 0.55 < auc < 0.95
    # gradient of the weighted, L2-penalised mean loss is ~0 at the fit
    from pyspark.ml.functions import vector_to_array
    pdf = (m.pipeline.transform(f.select("*", *MD._scaled(m.means, m.stds), MD.balanced_weights(f).alias("_w"))
                                .withColumn("readmission_30j", F.col("readmission_30j").cast("double")))
           .select(vector_to_array("features_vec").alias("x"), "readmission_30j", "_w", MD.PROB if False else
                   vector_to_array("_prob")[1].alias("p")).toPandas())
    x = np.vstack(pdf["x"].to_numpy())
    resid = (pdf["p"] - pdf["readmission_30j"]).to_numpy() * pdf["_w"].to_numpy()
    beta = np.array(m.coefficients)
    n = len(pdf)
    grad = x.T @ resid / pdf["_w"].sum() + (1.0 / n) * beta
    assert np.abs(grad).max() < 1e-3


def test_bootstrap_and_report_shapes(spark):
    f = gold.with_features(silver.clean_stays(stays_raw(spark, SF_SMALL)))
    m = MD.fit_logistic(f)
    s = MD.score(f, m)
    b = MD.bootstrap_ci(s, n=20).first()
    assert b.replicates == 20 and b.auc_lo <= b.auc_hi
    rep = {r["class"]: r for r in MD.classification_report(s).collect()}
    assert set(rep) == {"No readmission", "Readmitted", "accuracy", "macro avg", "weighted avg"}
    imp = MD.feature_importance(m, 15).collect()
    assert len(imp) == 15


def test_train_only_target_mean(spark):
    c = silver.clean_stays(stays_raw(spark, SF_SMALL))
    full = gold.with_features(c)
    split = MD.stratified_split(full.select("patient_id", "readmission_30j"))
    tr = gold.with_features_train_stats(c, split)
    assert tr.count() == full.count()
    a = {r.pathologie: r.taux_readmission_patho for r in full.select("pathologie", "taux_readmission_patho").distinct().collect()}
    b = {r.pathologie: r.taux_readmission_patho for r in tr.select("pathologie", "taux_readmission_patho").distinct().collect()}
    assert a.keys() == b.keys() and a != b


def test_unseen_level_one_hot_is_all_zeros(spark):
    f = gold.with_features(silver.clean_stays(stays_raw(spark, SF_SMALL)))
    m = MD.fit_logistic(f.where(F.col("service") != "Neurologie"))
    assert not any(n == "service_Neurologie" for n in m.feature_names())
    probe = f.where(F.col("service") == "Neurologie").limit(3)
    out = m.pipeline.transform(probe.select("*", *MD._scaled(m.means, m.stds)))
    vecs = [r.service_ohe for r in out.select("service_ohe").collect()]
    assert vecs and all(v.numNonzeros() == 0 for v in vecs)
    known = m.pipeline.transform(f.where(F.col("service") == "Cardiologie").limit(2).select("*", *MD._scaled(m.means, m.stds)))
    assert all(r.service_ohe.numNonzeros() == 1 for r in known.select("service_ohe").collect())
    assert MD.score(probe, m).count() == 3
