"""Registered queries: data quality and singular tests."""

from __future__ import annotations

from pyspark.sql import functions as F

from carestay.operators import gold
from carestay.operators import measures as M
from carestay.operators import quality as QC
from carestay.operators import silver
from carestay.operators import timeintel as TI
from carestay.plans import oracle_sql as O
from carestay.plans.registry import register
from carestay.sources.fixture import DIRTY_CTE, dirty_stays
from carestay.plans.queries.common import clean, features, raw, round_doubles


_KPI_U = "kpis AS (" + " UNION ALL ".join(O.kpi_by_sql(d) for d in gold.KPI_DIMENSIONS) + ")"
_SEJ = f"""sejours AS (SELECT p.patient_id, {O.SEJOUR_COLS} FROM clean p LEFT JOIN pstats s ON p.pathologie = s.pathologie)"""
_DIAG = f"""diags AS (SELECT p.patient_id, {O.DIAG_COLS} FROM clean p LEFT JOIN icd10 m ON p.diagnostic_principal = m.code_cim10)"""


def _quality_suites():
    return [("source", "stays_raw", QC.source_suite()), ("stg_patients", "clean", QC.clean_suite()),
            ("stg_sejours", "sejours", QC.stay_suite()), ("stg_diagnostics", "diags", QC.diagnostic_suite()),
            ("mart_patient_features", "features", QC.feature_suite()), ("mart_readmission_kpis", "kpis", QC.kpi_suite())]


@register("quality_report", O.with_ctes(O.BASE + [_KPI_U, _SEJ, _DIAG], O.quality_report_sql(_quality_suites())))
def q_quality_report(spark, sf):
    raw_ = raw(spark, sf)
    # the three silver views are 1:1 with the clean rows (left joins on unique keys), so their
    # suites run together over one wide silver frame
    wide = silver.silver_wide(silver.clean_stays(raw_))
    f = features(spark, sf)
    by_table = {}
    for model, table, suite in _quality_suites():
        by_table.setdefault(table, []).append((model, suite))
    silver_suites = by_table["clean"] + by_table["sejours"] + by_table["diags"]
    parts = [QC.run_suites(raw_, by_table["stays_raw"]), QC.run_suites(wide, silver_suites),
             QC.run_suites(f, by_table["features"]), QC.run_suites(gold.kpi_mart(f, ordered=False), by_table["kpis"])]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@register("quality_duplicates", O.with_ctes(O.BASE, """
SELECT patient_id, count(*) AS nb_occurrences FROM features GROUP BY patient_id HAVING count(*) > 1"""))
def q_quality_duplicates(spark, sf):
    return QC.duplicates(features(spark, sf), "patient_id")

@register("assert_date_order", O.with_ctes([O.CLEAN], """
SELECT patient_id, date_admission, date_sortie, CAST(date_diff('day', date_admission, date_sortie) AS INTEGER) AS duree_calculee
FROM clean WHERE date_sortie < date_admission"""))
def q_assert_date_order(spark, sf):
    return QC.date_order_violations(clean(spark, sf))


@register("assert_no_negative_age", O.with_ctes([O.CLEAN], "SELECT patient_id, age FROM clean WHERE age <= 0"))
def q_assert_age(spark, sf):
    return QC.non_positive_ages(clean(spark, sf))


@register("assert_rate_plausible", O.with_ctes(O.BASE, """
SELECT taux_global FROM (SELECT avg(CAST(readmission_30j AS DOUBLE)) AS taux_global FROM features)
WHERE taux_global < 0.05 OR taux_global > 0.40"""))
def q_assert_rate(spark, sf):
    return QC.implausible_rate(features(spark, sf))


@register("assert_rate_band_strict", O.with_ctes(O.BASE, f"""
SELECT {O.R('taux_global', 6)} AS taux_global FROM (SELECT avg(CAST(readmission_30j AS DOUBLE)) AS taux_global FROM features)
WHERE taux_global < 0.05 OR taux_global > 0.30"""))
def q_assert_rate_strict(spark, sf):
    # the same singular test with a tighter band, so a non-empty (failing) result is exercised too
    return round_doubles(QC.implausible_rate(features(spark, sf), hi=0.30))


# ---------------------------------------------------------------- the same checks where they find something

def _dirty(spark, sf):
    return dirty_stays(clean(spark, sf))


@register("dirty_duplicates", O.with_ctes([O.CLEAN, DIRTY_CTE], """
SELECT patient_id, count(*) AS nb_occurrences FROM dirty GROUP BY patient_id HAVING count(*) > 1"""))
def q_dirty_duplicates(spark, sf):
    return QC.duplicates(_dirty(spark, sf), "patient_id")


@register("dirty_date_order", O.with_ctes([O.CLEAN, DIRTY_CTE], """
SELECT patient_id, CAST(date_admission AS DATE) AS date_admission, CAST(date_sortie AS DATE) AS date_sortie,
  CAST(date_diff('day', CAST(date_admission AS DATE), CAST(date_sortie AS DATE)) AS INTEGER) AS duree_calculee
FROM dirty WHERE date_sortie < date_admission"""))
def q_dirty_date_order(spark, sf):
    return QC.date_order_violations(_dirty(spark, sf))


@register("dirty_non_positive_ages", O.with_ctes([O.CLEAN, DIRTY_CTE], "SELECT patient_id, age FROM dirty WHERE age <= 0"))
def q_dirty_ages(spark, sf):
    return QC.non_positive_ages(_dirty(spark, sf))


@register("dirty_dedup_latest", O.with_ctes([O.CLEAN, DIRTY_CTE], """
SELECT patient_id, age, service, date_admission, CAST(date_sortie AS DATE) AS date_sortie, duree_sejour, readmission_30j, ingestion_timestamp
FROM dirty QUALIFY row_number() OVER (PARTITION BY patient_id ORDER BY ingestion_timestamp DESC, age DESC NULLS LAST, service DESC NULLS LAST,
  date_admission DESC NULLS LAST, date_sortie DESC NULLS LAST, duree_sejour DESC NULLS LAST, readmission_30j DESC NULLS LAST) = 1"""))
def q_dirty_dedup_latest(spark, sf):
    return silver.dedup_latest(_dirty(spark, sf))


@register("dirty_prior_year_by_service", O.with_ctes([O.CLEAN, DIRTY_CTE, """m AS (
  SELECT service, CAST(year(date_admission) AS INTEGER) AS year, CAST(month(date_admission) AS INTEGER) AS month, count(*) AS sejours
  FROM dirty GROUP BY ALL)"""], """
SELECT p.service, p.year, p.month, p.sejours, COALESCE(q.sejours, 0) AS sejours_annee_precedente
FROM m p LEFT JOIN m q ON p.service IS NOT DISTINCT FROM q.service AND p.year = q.year + 1 AND p.month = q.month"""))
def q_dirty_prior_year(spark, sf):
    return TI.prior_year(_dirty(spark, sf), ["service"]).select("service", "year", "month", "sejours", "sejours_annee_precedente")


@register("dirty_percentiles", O.with_ctes([O.CLEAN, DIRTY_CTE], f"""
SELECT service, {O.R('quantile_cont(duree_sejour, 0.1)', 6)} AS p10, {O.R('quantile_cont(duree_sejour, 0.9)', 6)} AS p90
FROM dirty GROUP BY service"""))
def q_dirty_percentiles(spark, sf):
    """A null group and forced ranges: the ranked path with offsets, whatever the size."""
    d = _dirty(spark, sf).withColumn("duree_sejour", F.col("duree_sejour").cast("double"))
    return round_doubles(M.exact_percentiles(d, "duree_sejour", [0.1, 0.9], ["service"], buckets=7))
