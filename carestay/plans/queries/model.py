"""Registered queries: risk model."""

from __future__ import annotations

from pyspark.sql import functions as F

from carestay import schema as S
from carestay.functions.columns import rnd
from carestay.operators import gold
from carestay.operators import model as MD
from carestay.operators import newton
from carestay.plans import oracle_sql as O
from carestay.plans.layers import model_tables
from carestay.plans.registry import register
from carestay.plans.queries.common import clean, features, measure_base, round_doubles


_SPLIT_CTES = O.BASE + ["""rk AS (
  SELECT patient_id, readmission_30j,
    row_number() OVER (PARTITION BY readmission_30j ORDER BY md5(concat(patient_id, '-', '42')), patient_id) AS rn,
    count(*) OVER (PARTITION BY readmission_30j) AS nc FROM features)""", """split AS (
  SELECT patient_id, readmission_30j, CASE WHEN rn <= floor(nc * 0.2 + 0.5) THEN 'test' ELSE 'train' END AS split,
    CASE WHEN rn > floor(nc * 0.2 + 0.5) THEN CAST((rn - floor(nc * 0.2 + 0.5) - 1) % 5 AS INTEGER) END AS fold
  FROM rk)"""]


@register("stratified_split", O.with_ctes(_SPLIT_CTES, "SELECT * FROM split"))
def q_stratified_split(spark, sf):
    return MD.stratified_split(features(spark, sf).select("patient_id", "readmission_30j"))


@register("fold_ids", O.with_ctes(_SPLIT_CTES, "SELECT split, fold, readmission_30j, count(*) AS n FROM split GROUP BY ALL"))
def q_fold_ids(spark, sf):
    s = MD.stratified_split(features(spark, sf).select("patient_id", "readmission_30j"))
    return s.groupBy("split", "fold", "readmission_30j").agg(F.count(F.lit(1)).alias("n"))


_SCORE_COUNTS = """sc AS (SELECT score_risque_modele AS s, count(*) FILTER (WHERE readmission_30j = 0) AS n0,
  count(*) FILTER (WHERE readmission_30j = 1) AS n1 FROM mb GROUP BY 1),
cum AS (SELECT *, sum(n0) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS c0,
  sum(n1) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS c1,
  sum(n0) OVER () AS t0, sum(n1) OVER () AS t1 FROM sc)"""


@register("exact_auc", O.with_ctes(O.BASE + [O.MB, _SCORE_COUNTS], f"""
SELECT {O.R('sum(n1 * (c0 - n0 + 0.5 * n0)) / (sum(n0) * sum(n1))', 8)} AS auc,
  CAST(sum(n0) AS DOUBLE) AS n0, CAST(sum(n1) AS DOUBLE) AS n1 FROM cum"""))
def q_exact_auc(spark, sf):
    return round_doubles(MD.exact_auc(measure_base(spark, sf), "score_risque_modele"), 8)


@register("auc_by_service", O.with_ctes(O.BASE + [O.MB, """sc AS (SELECT service, score_risque_modele AS s,
  count(*) FILTER (WHERE readmission_30j = 0) AS n0, count(*) FILTER (WHERE readmission_30j = 1) AS n1 FROM mb GROUP BY 1, 2),
cum AS (SELECT *, sum(n0) OVER (PARTITION BY service ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS c0 FROM sc)"""], f"""
SELECT service, {O.R('sum(n1 * (c0 - n0 + 0.5 * n0)) / (sum(n0) * sum(n1))', 8)} AS auc,
  CAST(sum(n0) AS DOUBLE) AS n0, CAST(sum(n1) AS DOUBLE) AS n1 FROM cum GROUP BY service"""))
def q_auc_by_service(spark, sf):
    return round_doubles(MD.exact_auc(measure_base(spark, sf), "score_risque_modele", group_by=["service"]), 8)


@register("roc_points", O.with_ctes(O.BASE + [O.MB, _SCORE_COUNTS], f"""
SELECT s AS threshold, {O.R('(t0 - c0 + n0) / t0', 8)} AS fpr, {O.R('(t1 - c1 + n1) / t1', 8)} AS tpr,
  CAST(t1 - c1 + n1 AS BIGINT) AS tp, CAST(t0 - c0 + n0 AS BIGINT) AS fp FROM cum"""))
def q_roc_points(spark, sf):
    r = MD.roc_points(measure_base(spark, sf), "score_risque_modele")
    return round_doubles(r, 8).withColumn("tp", F.col("tp").cast("bigint")).withColumn("fp", F.col("fp").cast("bigint"))


@register("pr_points", O.with_ctes(O.BASE + [O.MB, _SCORE_COUNTS], f"""
SELECT s AS threshold, {O.R('CAST(t1 - c1 + n1 AS DOUBLE) / ((t1 - c1 + n1) + (t0 - c0 + n0))', 8)} AS precision,
  {O.R('(t1 - c1 + n1) / t1', 8)} AS recall FROM cum"""))
def q_pr_points(spark, sf):
    return round_doubles(MD.pr_points(measure_base(spark, sf), "score_risque_modele"), 8)


@register("classification_report", O.with_ctes(O.BASE + [O.MB, """c AS (SELECT
  count(*) FILTER (WHERE readmission_30j = 1 AND score_risque_modele >= 0.5) AS tp,
  count(*) FILTER (WHERE readmission_30j = 0 AND score_risque_modele >= 0.5) AS fp,
  count(*) FILTER (WHERE readmission_30j = 1 AND score_risque_modele < 0.5) AS fn,
  count(*) FILTER (WHERE readmission_30j = 0 AND score_risque_modele < 0.5) AS tn FROM mb),
m AS (SELECT CAST(tn AS DOUBLE) / (tn + fn) AS p0, CAST(tn AS DOUBLE) / (tn + fp) AS r0, tn + fp AS s0,
  CAST(tp AS DOUBLE) / (tp + fp) AS p1, CAST(tp AS DOUBLE) / (tp + fn) AS r1, tp + fn AS s1,
  CAST(tp + tn AS DOUBLE) / (tp + tn + fp + fn) AS acc, tp + tn + fp + fn AS n FROM c),
m2 AS (SELECT *, 2 * p0 * r0 / (p0 + r0) AS f0, 2 * p1 * r1 / (p1 + r1) AS f1 FROM m)"""], f"""
SELECT 'No readmission' AS class, {O.R('p0', 6)} AS precision, {O.R('r0', 6)} AS recall, {O.R('f0', 6)} AS f1_score, s0 AS support FROM m2
UNION ALL SELECT 'Readmitted', {O.R('p1', 6)}, {O.R('r1', 6)}, {O.R('f1', 6)}, s1 FROM m2
UNION ALL SELECT 'accuracy', NULL, NULL, {O.R('acc', 6)}, n FROM m2
UNION ALL SELECT 'macro avg', {O.R('(p0 + p1) / 2', 6)}, {O.R('(r0 + r1) / 2', 6)}, {O.R('(f0 + f1) / 2', 6)}, n FROM m2
UNION ALL SELECT 'weighted avg', {O.R('(p0 * s0 + p1 * s1) / n', 6)}, {O.R('(r0 * s0 + r1 * s1) / n', 6)}, {O.R('(f0 * s0 + f1 * s1) / n', 6)}, n FROM m2"""))
def q_classification_report(spark, sf):
    mb = measure_base(spark, sf).withColumn("prediction", (F.col("score_risque_modele") >= 0.5).cast("int"))
    return round_doubles(MD.classification_report(mb))


def _test_scores(spark, sf):
    return model_tables(spark, sf)[2].where(F.col("split") == "test")


@register("fit_logistic_scores")
def q_fit_logistic_scores(spark, sf):
    return model_tables(spark, sf)[2].select("patient_id", "split", "readmission_30j", "score_risque_modele", "prediction")


@register("model_evaluation")
def q_model_evaluation(spark, sf):
    test = _test_scores(spark, sf)
    return MD.exact_auc(test).select("auc", MD.f1_at(test).scalar().alias("f1"))


@register("cross_validate")
def q_cross_validate(spark, sf):
    fits, split, _ = model_tables(spark, sf)
    return MD.cross_validate(split.where(F.col("split") == "train"), fits=fits)


def _stationary_sql() -> str:
    """Rows and levels of each fit from the data; at a right fit every gradient is zero."""
    fits = "(SELECT 'all' AS model, NULL AS k UNION ALL SELECT 'without fold ' || i, i FROM range(5) t(i))"
    used = f"(SELECT m.model, t.* FROM {fits} m JOIN tr t ON m.k IS NULL OR t.fold <> m.k)"
    fixed = ", ".join(f"'{x}'" for x in ["(intercept)", *S.NUMERICAL_FEATURES, *S.BINARY_FEATURES])
    parts = [f"SELECT DISTINCT model, unnest([{fixed}]) AS feature FROM {used}"]
    parts += [f"SELECT DISTINCT model, '{c}_' || {c} AS feature FROM {used} WHERE {c} IS NOT NULL" for c in S.CATEGORICAL_FEATURES]
    return f"""SELECT model, feature, n, n1, CAST(0 AS DOUBLE) AS gradient
FROM ({' UNION ALL '.join(parts)}) JOIN (SELECT model, count(*) AS n, count(*) FILTER (readmission_30j = 1) AS n1 FROM {used} GROUP BY model) USING (model)"""


@register("fit_stationarity", O.with_ctes(_SPLIT_CTES + ["""tr AS (
  SELECT f.*, s.fold FROM features f JOIN split s USING (patient_id) WHERE s.split = 'train')"""], _stationary_sql()))
def q_fit_stationarity(spark, sf):
    fits, split, _ = model_tables(spark, sf)
    train = split.where(F.col("split") == "train")
    out = None
    for k, fit in enumerate(fits):
        rows = train if k == 0 else train.where(F.col("fold") != k - 1)
        one = newton.stationarity(rows, fit).select(F.lit(f"without fold {k - 1}" if k else "all").alias("model"), "feature", "n", "n1",
                                                    F.abs(rnd("gradient", 6)).alias("gradient"))
        out = one if out is None else out.unionByName(one)
    return out


@register("bootstrap_ci")
def q_bootstrap_ci(spark, sf):
    return MD.bootstrap_ci(_test_scores(spark, sf))


@register("feature_importance")
def q_feature_importance(spark, sf):
    return MD.feature_importance(model_tables(spark, sf)[0][0], 15)


@register("score_export")
def q_score_export(spark, sf):
    return MD.score_export(model_tables(spark, sf)[2])


@register("risk_tier_shares")
def q_risk_tier_shares(spark, sf):
    return MD.tier_shares(MD.score_export(model_tables(spark, sf)[2]))


_TIER = """CASE WHEN score_risque_modele > 0 AND score_risque_modele <= 0.20 THEN 'Tres faible'
  WHEN score_risque_modele > 0.20 AND score_risque_modele <= 0.40 THEN 'Faible'
  WHEN score_risque_modele > 0.40 AND score_risque_modele <= 0.70 THEN 'Modere'
  WHEN score_risque_modele > 0.70 AND score_risque_modele <= 1.0 THEN 'Eleve' END"""
_EXPORT = f"""SELECT patient_id, pathologie, service, age, tranche_age, {O.R('score_risque_modele', 4)} AS score_risque_modele,
  {_TIER} AS categorie_risque, readmission_30j FROM mb"""


@register("scorecard_export", O.with_ctes(O.BASE + [O.MB], _EXPORT))
def q_scorecard_export(spark, sf):
    return MD.score_export(measure_base(spark, sf))


@register("scorecard_tier_shares", O.with_ctes(O.BASE + [O.MB, f"ex AS ({_EXPORT})"], f"""
SELECT categorie_risque, count(*) AS n, {O.R('count(*) / sum(count(*)) OVER ()', 3)} AS share
FROM ex WHERE categorie_risque IS NOT NULL GROUP BY 1"""))
def q_scorecard_tier_shares(spark, sf):
    return MD.tier_shares(MD.score_export(measure_base(spark, sf)))


@register("features_train_stats", O.with_ctes(O.BASE + ["""rk AS (
  SELECT patient_id, row_number() OVER (PARTITION BY readmission_30j ORDER BY md5(concat(patient_id, '-', '42')), patient_id) AS rn,
    count(*) OVER (PARTITION BY readmission_30j) AS nc FROM features)""", """trs AS (SELECT c.pathologie,
    avg(CAST(c.readmission_30j AS DOUBLE)) AS t, avg(c.duree_sejour) AS m, stddev_samp(c.duree_sejour) AS sd
  FROM clean c JOIN rk ON c.patient_id = rk.patient_id WHERE rk.rn > floor(rk.nc * 0.2 + 0.5) GROUP BY c.pathologie)"""], f"""
SELECT f.pathologie, {O.R('trs.t', 4)} AS taux_readmission_patho,
  CASE WHEN trs.sd > 0 THEN {O.R('(f.duree_sejour - trs.m) / trs.sd', 4)} ELSE 0.0 END AS duree_zscore_patho,
  count(*) AS n
FROM features f LEFT JOIN trs ON f.pathologie = trs.pathologie GROUP BY 1, 2, 3"""))
def q_features_train_stats(spark, sf):
    from carestay.operators import model as MD_
    c = clean(spark, sf)
    split = MD_.stratified_split(features(spark, sf).select("patient_id", "readmission_30j"))
    f = gold.with_features_train_stats(c, split)
    return f.groupBy("pathologie", "taux_readmission_patho", "duree_zscore_patho").agg(F.count(F.lit(1)).alias("n"))


@register("model_classification_report")
def q_model_classification_report(spark, sf):
    return MD.classification_report(_test_scores(spark, sf))


@register("model_roc_points")
def q_model_roc_points(spark, sf):
    return MD.roc_points(_test_scores(spark, sf))


@register("ks_statistic", O.with_ctes(O.BASE + [O.MB, _SCORE_COUNTS, """roc AS (
  SELECT s, CAST(t1 - c1 + n1 AS DOUBLE) / t1 - CAST(t0 - c0 + n0 AS DOUBLE) / t0 AS gap FROM cum)"""], f"""
SELECT {O.R('GREATEST(max(gap), 0.0)', 8)} AS ks,
  max(s) FILTER (WHERE gap = (SELECT max(gap) FROM roc)) AS ks_threshold FROM roc"""))
def q_ks_statistic(spark, sf):
    return round_doubles(MD.ks_statistic(measure_base(spark, sf), "score_risque_modele"), 8)


@register("model_ks_statistic")
def q_model_ks_statistic(spark, sf):
    return MD.ks_statistic(_test_scores(spark, sf))
