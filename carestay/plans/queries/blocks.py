"""Registered queries: general building blocks in their general form, and report tables with their order."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from carestay.functions import columns as C
from carestay.operators import dashboards as DB
from carestay.operators import gold, silver
from carestay.operators import measures as M
from carestay.operators import quality as QC
from carestay.operators import timeintel as TI
from carestay.plans import oracle_sql as O
from carestay.plans.joins import fixed_broadcast
from carestay.plans.queries.common import clean, features, round_doubles
from carestay.plans.queries.timeintel import MONTHLY_SQL
from carestay.plans.registry import register
from carestay.session import ensure_checkpoint_dir
from carestay.sources import io as IO
from carestay.sources.reference import calendar_dim


@register("zscore_medications_by_service", O.with_ctes([O.CLEAN, """st AS (
  SELECT service, avg(nb_medicaments) AS m, stddev_samp(nb_medicaments) AS sd FROM clean GROUP BY service)"""], f"""
SELECT patient_id, CASE WHEN sd > 0 THEN {O.R('(nb_medicaments - m) / sd', 4)} ELSE 0.0 END AS z
FROM clean LEFT JOIN st ON clean.service = st.service"""))
def q_zscore_by_group(spark, sf):
    return silver.zscore_by_group(clean(spark, sf), "nb_medicaments", "service", out="z").select("patient_id", "z")


@register("target_mean_by_service", O.with_ctes(O.BASE, f"""
SELECT service, {O.R('avg(CAST(readmission_30j AS DOUBLE))', 4)} AS readmission_30j_mean FROM features GROUP BY service"""))
def q_target_mean(spark, sf):
    return silver.target_mean(features(spark, sf), "service")


@register("service_size_attached", O.with_ctes([O.CLEAN, "st AS (SELECT service, count(*) AS n_service FROM clean GROUP BY service)"], """
SELECT patient_id, n_service FROM clean LEFT JOIN st ON clean.service = st.service"""))
def q_group_stat_attach(spark, sf):
    stays = clean(spark, sf)
    return gold.group_stat_attach(stays, stays.groupBy("service").agg(F.count(F.lit(1)).alias("n_service")), "service").select("patient_id", "n_service")


_UNION = "u AS (" + " UNION ALL ".join(O.kpi_by_sql(d) for d in gold.KPI_DIMENSIONS) + ")"


@register("kpi_report_ranked", O.with_ctes(O.BASE + [_UNION], """
SELECT dimension, valeur, taux_readmission,
  CAST(row_number() OVER (ORDER BY dimension, taux_readmission DESC, valeur NULLS FIRST, sous_groupe NULLS FIRST) AS INTEGER) AS rang FROM u"""))
def q_kpi_report_ranked(spark, sf):
    """The five dimensions' KPIs as one report in its order; ``rang`` makes the order part of the result."""
    f = features(spark, sf)
    kpis = gold.union_kpis([gold.kpi_by(f, d) for d in gold.KPI_DIMENSIONS])
    report = DB.ordered(kpis, ["dimension", F.desc("taux_readmission"), "valeur", "sous_groupe"])
    return DB.numbered(report).select("dimension", "valeur", "taux_readmission", "rang")


@register("top_pathologies_ranked", O.with_ctes(O.BASE + [f"u AS ({O.kpi_by_sql('pathologie')})"], """
SELECT valeur, taux_readmission, CAST(row_number() OVER (ORDER BY taux_readmission DESC, valeur NULLS FIRST) AS INTEGER) AS rang FROM u
QUALIFY rang <= 5"""))
def q_top_pathologies(spark, sf):
    top = DB.top_k(gold.kpi_by(features(spark, sf), "pathologie"), "taux_readmission", 5, ties=["valeur"])
    return DB.numbered(top).select("valeur", "taux_readmission", "rang")


@register("period_deltas", O.with_ctes(O.BASE + [MONTHLY_SQL, """pd AS (
  SELECT p.year, p.month, p.readmissions / CAST(p.sejours AS DOUBLE) AS rate,
    CASE WHEN COALESCE(q.sejours, 0) = 0 THEN 0.0 ELSE CAST(q.readmissions AS DOUBLE) / q.sejours END AS y,
    CASE WHEN COALESCE(m.sejours, 0) = 0 THEN 0.0 ELSE CAST(m.readmissions AS DOUBLE) / m.sejours END AS mo
  FROM monthly p LEFT JOIN monthly q ON p.month_index = q.month_index + 12 LEFT JOIN monthly m ON p.month_index = m.month_index + 1)"""], f"""
SELECT year, month, {O.R('(rate - y) * 100', 6)} AS delta_annee_pp, {O.R('rate - mo', 6)} AS delta_mois FROM pd WHERE year IS NOT NULL"""))
def q_period_deltas(spark, sf):
    f = features(spark, sf)
    months = TI.prior_month(f).select("year", "month", "taux_mois_precedent")  # a row a month: bounded by the calendar
    both = TI.prior_year(f).select("year", "month", "taux_readmission", "taux_annee_precedente").join(fixed_broadcast(months), ["year", "month"])
    return round_doubles(TI.period_deltas(both).select("year", "month", "delta_annee_pp", "delta_mois"))


@register("admissions_per_calendar_day", O.with_ctes([O.CLEAN, """cal AS (
  SELECT CAST(unnest(generate_series(min(date_admission), max(date_admission), INTERVAL 1 DAY)) AS DATE) AS date FROM clean)"""], """
SELECT cal.date, CAST(year(cal.date) * 12 + month(cal.date) AS INTEGER) AS month_index, count(patient_id) AS sejours
FROM cal LEFT JOIN clean ON clean.date_admission = cal.date GROUP BY cal.date"""))
def q_calendar(spark, sf):
    stays = clean(spark, sf)
    lo, hi = stays.agg(F.min("date_admission"), F.max("date_admission")).first()
    per_day = stays.groupBy(F.col("date_admission").alias("date")).agg(F.count("patient_id").alias("sejours"))
    days = calendar_dim(spark, lo, hi) if lo else calendar_dim(spark, "2022-01-01", "2022-01-01").limit(0)
    return days.join(per_day, "date", "left").select("date", "month_index", F.coalesce("sejours", F.lit(0)).cast("bigint").alias("sejours"))


@register("stay_dates", O.with_ctes([O.CLEAN], """
SELECT date_diff('day', date_admission, date_sortie) AS jours, date_sortie = date_admission + CAST(duree_sejour AS INTEGER) AS sortie_attendue, count(*) AS n
FROM clean GROUP BY 1, 2""").replace("SELECT date_diff", "SELECT CAST(date_diff").replace("date_sortie) AS jours", "date_sortie) AS INTEGER) AS jours"))
def q_stay_dates(spark, sf):
    days = C.stay_days("date_admission", "date_sortie")
    expected = F.col("date_sortie") == C.discharge_date("date_admission", "duree_sejour")
    return clean(spark, sf).groupBy(days.alias("jours"), expected.alias("sortie_attendue")).agg(F.count(F.lit(1)).alias("n"))


@register("readmission_odds_by_service", O.with_ctes(O.BASE, f"""
SELECT service, {O.R('sum(readmission_30j) / CAST(sum(1 - readmission_30j) AS DOUBLE)', 6)} AS odds FROM features GROUP BY service"""))
def q_odds(spark, sf):
    y = F.col("readmission_30j")
    logit = F.log(F.sum(y).cast("double") / F.sum(1 - y))
    return features(spark, sf).groupBy("service").agg(C.rnd(C.odds_ratio(logit), 6).alias("odds"))


@register("median_stay_by_service", O.with_ctes(O.BASE, f"""
SELECT service, {O.R('quantile_cont(CAST(duree_sejour AS DOUBLE), 0.5)', 4)} AS mediane FROM features GROUP BY service"""))
def q_median(spark, sf):
    out = M.exact_percentile(features(spark, sf), "duree_sejour", 0.5, ["service"])
    name = next(c for c in out.columns if c != "service")
    return out.select("service", C.rnd(F.col(name).cast("double"), 4).alias("mediane"))


@register("unique_features_suite", O.with_ctes(O.BASE, """
SELECT 'mart_patient_features' AS model, 'unique' AS "check", 'patient_id' AS "column", count(*) AS failing_rows,
  CASE WHEN count(*) = 0 THEN 'PASS' ELSE 'FAIL' END AS status
FROM (SELECT patient_id FROM features WHERE patient_id IS NOT NULL GROUP BY patient_id HAVING count(*) > 1)"""))
def q_unique_features(spark, sf):
    return QC.run_expectations(features(spark, sf), [QC.expect_unique_features()], "mart_patient_features")


@register("gold_and_silver_by_name", O.with_ctes(O.BASE, """
SELECT 'gold' AS couche, service, count(*) AS n FROM features GROUP BY service
UNION ALL SELECT 'silver', service, count(*) FROM clean GROUP BY service"""))
def q_layers_by_name(spark, sf):
    """Gold written in full and read back by path, silver read through its view."""
    path = f"{ensure_checkpoint_dir(spark)}/gold-{uuid.uuid4().hex}"
    IO.write_gold(features(spark, sf), path)
    IO.register_silver(clean(spark, sf), "stg_patients")
    count = lambda df, layer: df.groupBy("service").agg(F.count(F.lit(1)).alias("n")).select(F.lit(layer).alias("couche"), "service", "n")
    return count(IO.read_gold(spark, path), "gold").unionByName(count(spark.table("stg_patients"), "silver"))
