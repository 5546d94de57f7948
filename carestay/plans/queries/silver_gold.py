"""Registered queries: silver and gold layers, ingestion log."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from carestay.functions.columns import rnd
from carestay.operators import gold
from carestay.operators import silver
from carestay.plans import oracle_sql as O
from carestay.operators.martstate import KpiState
from carestay.plans.layers import silver_by_stay
from carestay.plans.registry import ORACLES, register
from carestay.session import ensure_checkpoint_dir
from carestay.sources.fixture import stays_raw
from carestay.plans.queries.common import FEATURE_COLS_SQL, clean, features, raw


@register("clean_stays", O.with_ctes([O.CLEAN], "SELECT * FROM clean"))
def q_clean_stays(spark, sf):
    return clean(spark, sf)


_UUID_SQL = "regexp_matches(patient_id, '^[0-9a-fA-F]{8}-?[0-9a-fA-F]{4}-?[0-9a-fA-F]{4}-?[0-9a-fA-F]{4}-?[0-9a-fA-F]{12}$')"


@register("quarantine", O.with_ctes([], f"""
SELECT patient_id, age, readmission_30j,
  CASE WHEN patient_id IS NULL THEN 'patient_id null' WHEN NOT {_UUID_SQL} THEN 'patient_id not a uuid'
       WHEN age IS NULL THEN 'age null'
       WHEN NOT (age BETWEEN 18 AND 95) THEN 'age out of range' WHEN readmission_30j IS NULL THEN 'target null'
       ELSE 'target not 0/1' END AS reject_reason
FROM stays_raw
WHERE NOT COALESCE(patient_id IS NOT NULL AND age IS NOT NULL AND age BETWEEN 18 AND 95 AND readmission_30j IN (0, 1)
  AND {_UUID_SQL}, FALSE)"""))
def q_quarantine(spark, sf):
    _, bad = silver.quarantine(raw(spark, sf))
    return bad.select("patient_id", "age", "readmission_30j", "reject_reason")


@register("pathology_stats", O.with_ctes([O.CLEAN], f"""
SELECT pathologie, {O.R('avg(duree_sejour)', 6)} AS duree_moy_patho, {O.R('stddev_samp(duree_sejour)', 6)} AS duree_std_patho,
  {O.R('avg(nb_medicaments)', 6)} AS meds_moy_patho, count(*) AS nb_sejours_patho,
  {O.R('avg(CAST(readmission_30j AS DOUBLE))', 6)} AS taux_readmission_patho
FROM clean GROUP BY pathologie"""))
def q_pathology_stats(spark, sf):
    from carestay.functions.columns import rnd
    st = silver.pathology_stats(clean(spark, sf))
    return st.select("pathologie", *[rnd(c, 6).alias(c) for c in
                                     ["duree_moy_patho", "duree_std_patho", "meds_moy_patho"]],
                     "nb_sejours_patho", rnd("taux_readmission_patho", 6).alias("taux_readmission_patho"))


@register("stay_metrics", O.with_ctes([O.CLEAN, O.PATHO_STATS], f"""
SELECT p.patient_id, p.pathologie, p.service, p.hopital_region, p.duree_sejour, p.nb_hospitalisations_precedentes,
  p.nb_medicaments, p.mode_sortie, p.readmission_30j, {O.SEJOUR_COLS},
  s.nb_sejours_patho, {O.R('s.duree_moy_patho', 6)} AS duree_moyenne_patho
FROM clean p LEFT JOIN pstats s ON p.pathologie = s.pathologie"""))
def q_stay_metrics(spark, sf):
    from carestay.functions.columns import rnd
    return silver.stay_metrics(clean(spark, sf)).withColumn("duree_moyenne_patho", rnd("duree_moyenne_patho", 6))


@register("diagnostics", O.with_ctes([O.CLEAN, O.ICD10], f"""
SELECT p.patient_id, p.diagnostic_principal AS code_cim10, p.pathologie, {O.DIAG_COLS}, p.readmission_30j
FROM clean p LEFT JOIN icd10 m ON p.diagnostic_principal = m.code_cim10"""))
def q_diagnostics(spark, sf):
    return silver.enrich_diagnostics(clean(spark, sf))


@register("dedup_latest", O.with_ctes([O.CLEAN], """
SELECT pathologie, max(ingestion_timestamp) AS ingestion_timestamp, count(*) AS n_source
FROM clean GROUP BY pathologie"""))
def q_dedup_latest(spark, sf):
    # latest stay per pathology, joined with the group size (dedup keyed on pathology)
    c = clean(spark, sf)
    latest = silver.dedup_latest(c.select("pathologie", "ingestion_timestamp", "patient_id"), "pathologie")
    n = c.groupBy("pathologie").agg(F.count(F.lit(1)).alias("n_source"))
    return latest.join(n, "pathologie").select("pathologie", "ingestion_timestamp", "n_source")

@register("with_features", O.with_ctes(O.BASE, f"SELECT {FEATURE_COLS_SQL} FROM features"))
def q_with_features(spark, sf):
    return gold.with_features(clean(spark, sf))


@register("feature_store_join", O.with_ctes(O.BASE, f"SELECT {FEATURE_COLS_SQL} FROM features"))
def q_feature_store_join(spark, sf):
    # silver is stored by stay key: the views join as they lie
    return gold.feature_store_join(silver_by_stay(spark, sf))


for _dim in gold.KPI_DIMENSIONS:
    _key = {"tranche_age": "age", "mois": "month", "pathologie": "pathology"}.get(_dim, _dim)

    def _mk(dim):
        def q(spark, sf):
            return gold.kpi_by(features(spark, sf), dim)
        return q

    register(f"kpi_by_{_key}", O.with_ctes(O.BASE, O.kpi_by_sql(_dim)))(_mk(_dim))


@register("kpi_mart", O.with_ctes(O.BASE + [
    "u AS (" + " UNION ALL ".join(O.kpi_by_sql(d) for d in gold.KPI_DIMENSIONS) + ")"], f"""
SELECT *, {O.R('taux_readmission - avg(taux_readmission) OVER (PARTITION BY dimension)', 4)} AS ecart_vs_moyenne_dimension
FROM u ORDER BY dimension, taux_readmission DESC"""))
def q_kpi_mart(spark, sf):
    return gold.kpi_mart(features(spark, sf))

@register("kpi_mart_incremental", ORACLES["kpi_mart"])
def q_kpi_mart_incremental(spark, sf):
    """The stays in four batches, one of them taken in three times, with a merge in between: the same mart."""
    f = features(spark, sf)
    state = KpiState(spark, f"{ensure_checkpoint_dir(spark)}/kpi-state-{uuid.uuid4().hex}")
    part = F.pmod(F.xxhash64("patient_id"), F.lit(4))
    for step, k in enumerate([0, 1, 1, 2, 1, 3]):
        state.absorb(f.where(part == k), f"b{k}")
        if step == 3:
            state.merge()
    return state.mart()


@register("ingestion_log", O.with_ctes([], """
SELECT CAST(count(*) AS BIGINT) AS nb_lignes, CAST(ROUND(CAST(avg(CAST(readmission_30j AS DOUBLE)) AS DECIMAL(18,8)), 4) AS DOUBLE) AS taux_readmission,
  'SUCCESS' AS statut FROM stays_raw"""))
def q_ingestion_log(spark, sf):
    from carestay.sources.io import ingestion_log
    log = ingestion_log(stays_raw(spark, sf), "SUCCESS", "fixture load")
    return log.select("nb_lignes", F.col("taux_readmission").cast("double").alias("taux_readmission"), "statut")


@register("dedup_latest_stays", O.with_ctes([O.CLEAN], """
SELECT * FROM clean QUALIFY row_number() OVER (PARTITION BY patient_id ORDER BY ingestion_timestamp DESC) = 1"""))
def q_dedup_latest_stays(spark, sf):
    # one row per stay id, the latest ingestion kept (a partially aggregated max over a struct)
    return silver.dedup_latest(clean(spark, sf), "patient_id", "ingestion_timestamp")
