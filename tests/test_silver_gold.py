import datetime as dt

from pyspark.sql import functions as F

from carestay.operators import gold, silver
from tests.conftest import stay_rows

BASE = dict(age=70, sexe="M", pathologie="Sepsis", diagnostic_principal="A41", service="Cardiologie",
            hopital_region="Bretagne", duree_sejour=5, nb_hospitalisations_precedentes=1, nb_medicaments=6,
            date_admission=dt.date(2024, 1, 10), date_sortie=dt.date(2024, 1, 15), mode_sortie="Domicile",
            readmission_30j=0, score_risque_theorique=0.3, ingestion_timestamp=dt.datetime(2024, 1, 16),
            source_fichier="t")


def row(i, **kw):
    d = dict(BASE, patient_id=f"00000000-0000-4000-8000-{i:012d}")
    d.update(kw)
    return d


def test_clean_filters_and_normalises(spark):
    raw = stay_rows(spark, [row(1, sexe=" m", service="néphrologie", mode_sortie="SSR "),
                            row(2, age=None), row(3, age=101), row(4, readmission_30j=None), row(5, readmission_30j=2)])
    bad_id = stay_rows(spark, [dict(row(6), patient_id="not-a-uuid")])
    import pytest
    with pytest.raises(Exception):
        silver.clean_stays(bad_id).collect()           # strict: a malformed id fails the job
    assert silver.quarantine(bad_id)[1].first().reject_reason == "patient_id not a uuid"
    c = silver.clean_stays(raw).collect()
    assert len(c) == 1
    r = c[0]
    assert (r.sexe, r.service, r.mode_sortie, r.flag_sortie_complexe) == ("M", "Néphrologie", "Ssr", True)
    good, bad = silver.quarantine(raw)
    reasons = sorted(r.reject_reason for r in bad.collect())
    assert reasons == ["age null", "age out of range", "target not 0/1", "target null"]
    assert good.count() == 1


def test_zscore_single_row_group_is_zero_and_null_group_gets_no_stats(spark):
    raw = stay_rows(spark, [row(1, pathologie="BPCO", duree_sejour=3), row(2, pathologie=None), row(3, pathologie=None),
                            row(4, pathologie="Sepsis", duree_sejour=2), row(5, pathologie="Sepsis", duree_sejour=4)])
    m = {r.patient_id[-1]: r for r in silver.stay_metrics(silver.clean_stays(raw)).collect()}
    assert m["1"].duree_zscore_patho == 0.0            # one-row group: sample stddev is null
    assert m["2"].nb_sejours_patho is None             # null pathology never matches its stats
    assert m["2"].duree_zscore_patho == 0.0
    assert m["4"].duree_zscore_patho == round((2 - 3) / 2 ** 0.5, 4)


def test_unknown_code_defaults(spark):
    raw = stay_rows(spark, [row(1, diagnostic_principal="z99"), row(2, diagnostic_principal="i50")])
    d = {r.code_cim10: r for r in silver.enrich_diagnostics(silver.clean_stays(raw)).collect()}
    assert (d["Z99"].groupe_clinique, d["Z99"].severite_relative, d["Z99"].risque_readmission_patho) == ("AUTRE", 2, "Faible")
    assert d["Z99"].severite_normalisee == 0.4 and not d["Z99"].flag_pathologie_chronique
    assert (d["I50"].groupe_clinique, d["I50"].flag_pathologie_critique) == ("CARDIO", True)


def test_duplicate_ids_fan_out_in_strict_join_only(spark):
    raw = stay_rows(spark, [row(1), row(1, duree_sejour=9), row(2)])
    c = silver.clean_stays(raw)
    strict = gold.feature_store_join(c)
    assert strict.where(F.col("patient_id").endswith("1")).count() == 8   # 2 × 2 × 2
    assert gold.with_features(c).count() == 3


def test_dedup_latest_keeps_last_ingestion(spark):
    raw = stay_rows(spark, [row(1, ingestion_timestamp=dt.datetime(2024, 1, 1), age=50),
                            row(1, ingestion_timestamp=dt.datetime(2024, 2, 1), age=60), row(2)])
    d = {r.patient_id[-1]: r.age for r in silver.dedup_latest(raw).collect()}
    assert d == {"1": 60, "2": 70}


def test_kpi_mart_labels_real_null_values(spark):
    raw = stay_rows(spark, [row(1, service=None), row(2), row(3, readmission_30j=1)])
    k = gold.kpi_mart(gold.with_features(silver.clean_stays(raw)), ordered=False)
    svc = {r.valeur: r.nb_sejours for r in k.where("dimension = 'service'").collect()}
    assert svc == {None: 1, "Cardiologie": 2}
    assert {r.dimension for r in k.collect()} == {"pathologie", "service", "region", "tranche_age", "mois"}
    assert k.where("dimension = 'mois'").first().valeur == "2024-01"
