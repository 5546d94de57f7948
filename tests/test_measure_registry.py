"""All 51 measures by name: periods, ranks, empty inputs and null groups."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from carestay.operators import measure_registry as R
from carestay.operators import measures as M

COLUMNS = ("patient_id string, service string, pathologie string, date_admission date, readmission_30j int, "
           "score_risque_modele double, sexe string, age int")


def frame(spark, rows):
    """Rows of (service, pathology, date, readmitted); the score is 0.1 a row."""
    df = spark.createDataFrame([(str(i), s, p, dt.date.fromisoformat(d), y, (i % 10) / 10, "M", 50) for i, (s, p, d, y) in enumerate(rows)], COLUMNS)
    for c in ["duree_sejour", "nb_medicaments", "indice_complexite", "flag_polymedication", "flag_sortie_complexe", "flag_antecedents_lourds"]:
        df = df.withColumn(c, F.lit(1))
    return df.withColumn("annee_admission", F.year("date_admission")).withColumn("mois_admission", F.month("date_admission"))


ROWS = [("A", "x", "2023-01-31", 1), ("A", "x", "2023-03-05", 0), ("A", "y", "2024-01-31", 1), ("A", "y", "2024-02-10", 0),
        ("B", "x", "2024-02-29", 1), ("B", "y", "2024-02-29", 1), (None, "z", "2024-01-15", 0)]


def test_there_are_51_measures_and_unknown_names_fail(spark):
    names = R.all_names()
    assert len(names) == len(set(names)) == 51
    assert R.row_names() == [c for c in M.measures(frame(spark, ROWS)).columns]
    with pytest.raises(KeyError):
        M.measures(frame(spark, ROWS), ["service"], ["total_sejours", "nothing"])


def test_whole_calendar_up_to_a_date(spark):
    df = frame(spark, ROWS)
    g = {r.service: r for r in M.measures(df, ["service"], R.all_names()).collect()}
    assert set(g) == {"A", "B", None}
    # the last admission is 2024-02-29: a year earlier is 2023-02-28, a month earlier 2024-01-29
    assert (g["A"].sejours_annee_precedente, g["A"].taux_readmission_annee_precedente) == (1, 1.0)
    assert g["A"].taux_readmission_mois_precedent == 0.5 and g["A"].taux_readmission_ytd == 0.5
    assert (g["A"].readmissions_30j_glissants, g["B"].readmissions_30j_glissants) == (1, 2)
    assert g["B"].sejours_annee_precedente == 0 and g["B"].delta_taux_vs_annee_precedente_pp == 100.0
    assert g[None].total_sejours == 1 and g[None].services_au_dessus_seuil == 0
    early = R.by_name(df, ["service"], ["readmissions_30j_glissants"], as_of="2024-02-01").collect()
    assert {r.service: r.readmissions_30j_glissants for r in early} == {"A": 1, "B": 0, None: 0}


def test_months_and_years_as_periods(spark):
    df = frame(spark, ROWS)
    m = {(r.annee_admission, r.mois_admission): r for r in M.measures(df, ["annee_admission", "mois_admission"], R.all_names()).collect()}
    assert set(m) == {(2023, 1), (2023, 3), (2024, 1), (2024, 2)}
    assert m[2024, 1].taux_readmission_annee_precedente == 1.0 and m[2024, 1].icone_tendance_annee == "down 50.0pp"
    assert m[2024, 2].taux_readmission_mois_precedent == 0.5 and m[2024, 2].taux_readmission_ytd == 3 / 5
    # 2024-01-31 lies within the 30 days that end on 2024-02-29, 2024-01-15 does not
    assert m[2024, 2].readmissions_30j_glissants == 3 and m[2023, 1].sejours_annee_precedente == 0
    y = {r.annee_admission: r for r in M.measures(df, ["annee_admission"], R.all_names()).collect()}
    assert (y[2024].sejours_annee_precedente, y[2024].taux_readmission_annee_precedente, y[2023].readmissions_30j_glissants) == (2, 0.5, 0)
    with pytest.raises(ValueError):
        M.measures(df, ["mois_admission"], ["taux_readmission_ytd"])


def test_pathology_measures(spark):
    df = frame(spark, ROWS)
    p = {r.pathologie: r for r in M.measures(df, ["pathologie"], R.PATHOLOGY).collect()}
    assert {k: r.rang_pathologie for k, r in p.items()} == {"x": 1, "y": 1, "z": 2}
    assert p["x"].taux_readmission_pathologie == 2 / 3 and p["z"].pathologie_plus_risquee == "z"
    assert abs(p["z"].ecart_vs_moyenne_globale_pp + 400 / 7) < 1e-9
    s = {r.service: r for r in M.measures(df, ["service"], R.PATHOLOGY).collect()}
    # x and y are tied over all stays; A's rate 0.5 equals that of both its pathologies
    assert s["A"].pathologie_plus_risquee == "x, y" and s["A"].rang_pathologie == 1 and s[None].pathologie_plus_risquee == "z"
    assert s["A"].taux_readmission_pathologie == 4 / 7


def test_empty_input_and_no_joins(spark):
    df = frame(spark, ROWS)
    none = df.where("service = 'nowhere'")
    assert M.measures(none, ["service"], R.all_names()).count() == 0
    zero = M.measures(none, [], R.all_names()).first()
    assert zero.taux_readmission_ytd == 0 and zero.readmissions_30j_glissants == 0 and zero.icone_tendance_annee == "stable +0.0pp"
    blank = R.by_name(none, [], R.all_names(), null_on_empty=True).first()
    assert blank.taux_readmission_ytd is None and blank.icone_tendance_annee == "N/A"
    plan = M.measures(df, ["service"], [n for n in R.all_names() if n not in R.PERCENTILE])._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Cartesian" not in plan
