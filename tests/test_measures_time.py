import datetime as dt

from pyspark.sql import functions as F

from carestay.operators import measures as M
from carestay.operators import security as SEC
from carestay.operators import timeintel as TI


def frame(spark, rows):
    return spark.createDataFrame(rows, "service string, date_admission date, readmission_30j int, "
                                       "score_risque_modele double, sexe string, age int")


def test_measures_counts_and_ratios(spark):
    d = dt.date(2024, 1, 1)
    df = frame(spark, [("A", d, 1, 0.8, "M", 80), ("A", d, 0, 0.6, "F", 60), ("B", d, 1, 0.3, "M", 40),
                       ("B", d, 0, 0.1, "F", 30)])
    for c in ["duree_sejour", "nb_medicaments", "indice_complexite", "flag_polymedication", "flag_sortie_complexe",
              "flag_antecedents_lourds"]:
        df = df.withColumn(c, F.lit(1))
    m = M.measures(df).first()
    assert (m.total_sejours, m.total_readmissions, m.taux_readmission) == (4, 2, 0.5)
    assert (m.vrais_positifs, m.faux_positifs, m.faux_negatifs, m.vrais_negatifs) == (1, 1, 1, 1)
    assert (m.patients_risque_eleve, m.patients_risque_modere, m.patients_risque_faible) == (1, 1, 2)
    assert m.statut_performance == "CRITIQUE" and m.taux_readmission_label == "50.0%"
    assert m.delta_h_vs_f == 1.0 and m.cout_fausses_alertes == "MEDIUM"
    empty = M.measures(df.where("false"), null_on_empty=False).first()
    assert empty.taux_readmission == 0.0


def test_prior_year_with_missing_period(spark):
    rows = [("A", dt.date(2023, 3, 5), 1, 0.5, "M", 50), ("A", dt.date(2024, 3, 9), 0, 0.5, "M", 50),
            ("A", dt.date(2024, 3, 10), 1, 0.5, "M", 50), ("B", dt.date(2024, 5, 1), 1, 0.5, "F", 50)]
    py = {(r.year, r.month): r for r in TI.prior_year(frame(spark, rows)).collect()}
    assert py[(2024, 3)].taux_annee_precedente == 1.0 and py[(2024, 3)].delta_pp == -50.0
    assert py[(2024, 3)].tendance == "down 50.0pp"
    assert py[(2024, 5)].taux_annee_precedente == 0.0 and py[(2024, 5)].sejours_annee_precedente == 0


def test_rolling_window_and_ytd(spark):
    rows = [("A", dt.date(2024, 1, 1), 1, 0.5, "M", 50), ("A", dt.date(2024, 1, 30), 1, 0.5, "M", 50),
            ("A", dt.date(2024, 1, 31), 1, 0.5, "M", 50), ("A", dt.date(2024, 2, 2), 0, 0.5, "M", 50)]
    df = frame(spark, rows)
    r = {x.date: x.readmissions_30j for x in TI.rolling_readmissions(df).collect()}
    assert r[dt.date(2024, 1, 30)] == 2 and r[dt.date(2024, 1, 31)] == 2 and r[dt.date(2024, 12, 31)] == 0
    assert TI.rolling_as_of(df).first()[0] == 2
    y = {x.month: x.taux_readmission_ytd for x in TI.ytd_rate(df).collect()}
    assert y == {1: 1.0, 2: 0.75}


def test_row_level_filter(spark):
    d = dt.date(2024, 1, 1)
    df = frame(spark, [("A", d, 1, 0.8, "M", 80), ("B", d, 0, 0.2, "F", 60)])
    users = spark.createDataFrame([("u1", "Responsable_Service", "A"), ("boss", "Direction_Hopital", None),
                                   ("an", "Analyste_Risques", None)], "user_name string, role string, service string")
    assert SEC.row_level_filter(df, users, "u1", "Responsable_Service").count() == 1
    assert SEC.row_level_filter(df, users, "boss", "Direction_Hopital").count() == 2
    assert SEC.row_level_filter(df, users, "an", "Analyste_Risques").count() == 1
    # passing a role that one is not mapped to shows nothing
    assert SEC.row_level_filter(df, users, "u1", "Direction_Hopital").count() == 0
    assert SEC.row_level_filter(df, users, "nobody", "Analyste_Risques").count() == 0
    vc = {r.user_name: r.sejours_visibles for r in SEC.visible_counts(df, users).collect()}
    assert vc == {"u1": 1, "boss": 2, "an": 1}
