"""Fixed schemas, column lists and accepted value sets of the stay analytics."""

from __future__ import annotations

from pyspark.sql import types as T

# Bronze stay record: 17 business columns in fixed order (the surrogate row id is not kept).
STAY_SCHEMA = T.StructType([
    T.StructField("patient_id", T.StringType(), False),
    T.StructField("age", T.ShortType()),
    T.StructField("sexe", T.StringType()),
    T.StructField("pathologie", T.StringType()),
    T.StructField("diagnostic_principal", T.StringType()),
    T.StructField("service", T.StringType()),
    T.StructField("hopital_region", T.StringType()),
    T.StructField("duree_sejour", T.ShortType()),
    T.StructField("nb_hospitalisations_precedentes", T.ShortType()),
    T.StructField("nb_medicaments", T.ShortType()),
    T.StructField("date_admission", T.DateType()),
    T.StructField("date_sortie", T.DateType()),
    T.StructField("mode_sortie", T.StringType()),
    T.StructField("readmission_30j", T.ShortType()),
    T.StructField("score_risque_theorique", T.DoubleType()),
    T.StructField("ingestion_timestamp", T.TimestampNTZType()),
    T.StructField("source_fichier", T.StringType()),
])

BRONZE_COLUMNS = [f.name for f in STAY_SCHEMA.fields]

INGESTION_LOG_SCHEMA = T.StructType([
    T.StructField("run_timestamp", T.TimestampNTZType(), False),
    T.StructField("nb_lignes", T.LongType()),
    T.StructField("taux_readmission", T.DecimalType(5, 4)),
    T.StructField("duree_secondes", T.DecimalType(8, 2)),
    T.StructField("statut", T.StringType()),
    T.StructField("message", T.StringType()),
])

TARGET = "readmission_30j"
KEY = "patient_id"

# Model feature groups (20 features: 9 numeric, 7 binary, 4 categorical).
NUMERICAL_FEATURES = [
    "age", "nb_hospitalisations_precedentes", "nb_medicaments", "duree_sejour",
    "duree_zscore_patho", "indice_complexite", "ratio_meds_duree",
    "severite_normalisee", "taux_readmission_patho",
]
BINARY_FEATURES = [
    "flag_polymedication", "flag_sortie_complexe", "flag_deja_hospitalise",
    "flag_antecedents_lourds", "flag_long_sejour",
    "flag_pathologie_chronique", "flag_pathologie_critique",
]
CATEGORICAL_FEATURES = ["tranche_age", "mode_sortie", "service", "groupe_clinique"]
FEATURE_COLS = NUMERICAL_FEATURES + BINARY_FEATURES + CATEGORICAL_FEATURES

# Feature lists of the statistical screen.
SCREEN_NUMERICAL = [
    "age", "nb_hospitalisations_precedentes", "nb_medicaments", "duree_sejour",
    "indice_complexite", "ratio_meds_duree", "severite_normalisee", "taux_readmission_patho",
]
SCREEN_CATEGORICAL = ["pathologie", "service", "mode_sortie", "sexe", "tranche_age", "groupe_clinique"]

# Exploration column sets.
EXPLORE_NUMERICAL = [
    "age", "nb_hospitalisations_precedentes", "nb_medicaments",
    "duree_sejour", "indice_complexite", "ratio_meds_duree",
]
# every numeric column of the feature table (what a describe() of the whole table reports)
DESCRIBE_COLS = NUMERICAL_FEATURES + BINARY_FEATURES + ["annee_admission", "mois_admission", TARGET]
CORRELATION_COLS = EXPLORE_NUMERICAL + [
    "flag_polymedication", "flag_sortie_complexe", "flag_antecedents_lourds", "readmission_30j",
]

# Fixed values that must equal the reference's for right results.
AGE_BRACKETS = ["18-44", "45-64", "65-74", "75-84", "85+"]
STAY_BUCKETS = ["Courte (1-3j)", "Moyenne (4-7j)", "Longue (8-14j)", "Tres longue (>14j)"]
UNKNOWN_LABEL = "Inconnu"
COMPLEX_DISCHARGE_MODES = ["SSR", "EHPAD", "Transfert"]
CHRONIC_GROUPS = ["CARDIO", "NEPHRO", "METABOL", "PULMO"]
CLINICAL_GROUPS = ["CARDIO", "PULMO", "METABOL", "NEPHRO", "NEURO", "INFECTIO", "TRAUMA", "AUTRE"]
RISK_LEVELS = ["Faible", "Modere", "Eleve"]
SEXES = ["M", "F"]
# The silver test accepts ASCII names; the data carries "Décès", so both spellings are accepted.
DISCHARGE_MODES_ACCEPTED = ["Domicile", "Ssr", "Ehpad", "Transfert", "Deces", "Décès"]
KPI_DIMENSIONS = ["pathologie", "service", "region", "tranche_age", "mois"]
SEASONS = {"Hiver": [12, 1, 2], "Printemps": [3, 4, 5], "Ete": [6, 7, 8], "Automne": [9, 10, 11]}
