import datetime as dt

from pyspark.sql import functions as F

from carestay.functions import columns as C


def one(spark, col, value, ddl="v string"):
    return spark.createDataFrame([(value,)], ddl).select(col.alias("o")).first()["o"]


def test_pg_initcap_splits_on_every_non_alnum(spark):
    assert one(spark, C.pg_initcap("v"), "Île-de-france") == "Île-De-France"
    assert one(spark, C.pg_initcap("v"), "provence-alpes-côte d'azur") == "Provence-Alpes-Côte D'Azur"
    assert one(spark, C.pg_initcap("v"), "SSR") == "Ssr"
    assert one(spark, C.pg_initcap("v"), "médecine interne") == "Médecine Interne"


def test_brackets_and_buckets(spark):
    df = spark.createDataFrame([(a,) for a in [None, 17, 18, 44, 45, 64, 65, 74, 75, 84, 85, 95]], "v int")
    got = [r[0] for r in df.select(C.age_bracket("v")).collect()]
    assert got == ["Inconnu", "Inconnu", "18-44", "18-44", "45-64", "45-64", "65-74", "65-74", "75-84", "75-84", "85+", "85+"]
    los = spark.createDataFrame([(a,) for a in [None, 0, 1, 3, 4, 7, 8, 14, 15]], "v int")
    got = [r[0] for r in los.select(C.stay_length_bucket("v")).collect()]
    assert got == ["Inconnu", "Inconnu", "Courte (1-3j)", "Courte (1-3j)", "Moyenne (4-7j)", "Moyenne (4-7j)",
                   "Longue (8-14j)", "Longue (8-14j)", "Tres longue (>14j)"]


def test_season_and_month_key(spark):
    df = spark.createDataFrame([(12, 2024), (3, 2024), (7, 2024), (10, 2024), (None, None)], "m int, y int")
    rows = df.select(C.season("m").alias("s"), C.month_key("y", "m").alias("k")).collect()
    assert [r.s for r in rows] == ["Hiver", "Printemps", "Ete", "Automne", None]
    assert [r.k for r in rows] == ["2024-12", "2024-03", "2024-07", "2024-10", "-"]


def test_complexity_index_caps_and_nulls(spark):
    df = spark.createDataFrame([(7, 3, 1), (45, 20, 10), (None, 0, 0)], "los int, meds int, prior int")
    got = [r[0] for r in df.select(C.complexity_index("los", "meds", "prior")).collect()]
    assert got[0] == round(7 / 30 * 3.5 + 3 / 15 * 3 + 1 / 5 * 3.5, 2)
    assert got[1] == 10.0
    assert got[2] == 3.5  # least() skips the null, so the stay term sits at its cap


def test_tiers_left_vs_right_closed(spark):
    df = spark.createDataFrame([(x,) for x in [0.0, 0.2, 0.4, 0.7, 1.0, None]], "s double")
    rows = df.select(C.classify_risk("s").alias("l"), C.risk_tier_cut("s").alias("r")).collect()
    assert [r.l for r in rows] == ["Tres faible", "Faible", "Modere", "Eleve", "Eleve", "Tres faible"]
    assert [r.r for r in rows] == [None, "Tres faible", "Faible", "Modere", "Eleve", None]


def test_safe_ratio_and_labels(spark):
    df = spark.createDataFrame([(1, 0), (1, None), (1, 4)], "n int, d int")
    assert [r[0] for r in df.select(C.safe_ratio("n", "d")).collect()] == [0.0, 0.0, 0.25]
    assert one(spark, C.pct_label("v"), 0.35349, "v double") == "35.3%"
    assert one(spark, C.trend_label("v"), 1.26, "v double") == "up +1.3pp"
    assert one(spark, C.trend_label("v"), -2.0, "v double") == "down 2.0pp"
    assert one(spark, C.trend_label("v"), -0.04, "v double") == "stable +0.0pp"
    assert one(spark, C.trend_label("v"), None, "v double") == "N/A"


def test_rounding_is_half_away_from_zero(spark):
    assert one(spark, C.rnd("v", 2), 1.005, "v double") == 1.01
    assert one(spark, C.rnd("v", 4), -0.00005, "v double") == -0.0001


def test_scorecard_matches_generator_rules(spark):
    df = spark.createDataFrame(
        [(85, 4, 9, 12, "Ssr", "Sepsis"), (30, 0, 0, 1, "Domicile", "BPCO")],
        "age int, nb_hospitalisations_precedentes int, nb_medicaments int, duree_sejour int, mode_sortie string, pathologie string")
    got = [r[0] for r in df.select(C.additive_scorecard()).collect()]
    assert got == [0.85, 0.10]  # 10+12+8+15+10+8+6+7+12 = 88 → clamped to 85


def test_date_helpers(spark):
    df = spark.createDataFrame([(dt.date(2024, 6, 2), 3)], "d date, n int")
    r = df.select(C.day_of_week_sun0("d").alias("w"), C.discharge_date("d", "n").alias("o"),
                  C.stay_days("d", C.discharge_date("d", "n")).alias("s")).first()
    assert (r.w, r.o, r.s) == (0, dt.date(2024, 6, 5), 3)
