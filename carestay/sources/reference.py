"""Small reference tables: ICD-10 mapping, calendar, label dictionary, user mapping.

Each is tiny and of fixed or calendar-bounded size, so joins against them are
broadcast (the bound is stated next to each table).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ICD10_SCHEMA = T.StructType([
    T.StructField("code_cim10", T.StringType(), False),
    T.StructField("libelle_complet", T.StringType()),
    T.StructField("groupe_clinique", T.StringType()),
    T.StructField("severite_relative", T.IntegerType()),
    T.StructField("risque_readmission", T.StringType()),
])

# The eight ICD-10 codes with label, clinical group, relative severity
# (1-5) and readmission risk level, as in the source reference relation.
ICD10_ROWS = [
    ("I50", "Insuffisance cardiaque", "CARDIO", 4, "Eleve"),
    ("E11", "Diabete de type 2", "METABOL", 3, "Modere"),
    ("J44", "BPCO", "PULMO", 3, "Modere"),
    ("J18", "Pneumonie", "PULMO", 3, "Modere"),
    ("N18", "Insuffisance renale chronique", "NEPHRO", 4, "Eleve"),
    ("I63", "Accident vasculaire cerebral ischemique", "NEURO", 5, "Eleve"),
    ("A41", "Sepsis", "INFECTIO", 5, "Eleve"),
    ("S72", "Fracture du col du femur", "TRAUMA", 3, "Modere"),
]


def icd10_reference(spark: SparkSession) -> DataFrame:
    """8-row ICD-10 relation (fixed size: always safe to broadcast)."""
    return spark.createDataFrame(ICD10_ROWS, ICD10_SCHEMA)


def icd10_values_sql() -> str:
    """The same relation as a SQL VALUES list (used by the DuckDB oracles)."""
    rows = ",\n    ".join(f"('{c}', '{l}', '{g}', {s}, '{r}')" for c, l, g, s, r in ICD10_ROWS)
    return (f"icd10(code_cim10, libelle_complet, groupe_clinique, severite_relative, risque_readmission) "
            f"AS (VALUES\n    {rows})")


def calendar_dim(spark: SparkSession, start: str | dt.date, end: str | dt.date) -> DataFrame:
    """One row per day in [start, end] with year, month, month index and day number.

    Size is bounded by the calendar span (366 rows per year), so it can be broadcast.
    """
    return (spark.range(1)
            .select(F.explode(F.sequence(F.lit(str(start)).cast("date"), F.lit(str(end)).cast("date")))
                    .alias("date"))
            .select("date",
                    F.year("date").alias("year"),
                    F.month("date").alias("month"),
                    (F.year("date") * 12 + F.month("date")).alias("month_index"),
                    F.unix_date("date").alias("day_number")))


def calendar_for(df: DataFrame, date_col: str = "date_admission") -> DataFrame:
    """Calendar covering whole years from the first to the last fact date.

    The bounds come from one global min/max aggregate, evaluated lazily: the calendar
    is a ``sequence`` over that single row, exploded on executors.
    """
    b = df.agg(F.min(date_col).alias("lo"), F.max(date_col).alias("hi"))
    days = b.select(F.explode(F.sequence(F.make_date(F.year("lo"), F.lit(1), F.lit(1)),
                                         F.make_date(F.year("hi"), F.lit(12), F.lit(31)))).alias("date"))
    return days.select("date", F.year("date").alias("year"), F.month("date").alias("month"),
                       (F.year("date") * 12 + F.month("date")).alias("month_index"),
                       F.unix_date("date").alias("day_number"))


# French → English labels of the dashboard glossary (dimension members).
LABELS_FR_EN = [
    ("Fracture col fémur", "Hip fracture"),
    ("Pneumonie", "Pneumonia"),
    ("AVC ischémique", "Ischemic stroke"),
    ("Insuffisance cardiaque", "Heart failure"),
    ("Diabète de type 2", "Type 2 diabetes"),
    ("BPCO", "COPD (Chronic Obstructive Pulmonary Disease)"),
    ("Sepsis", "Sepsis"),
    ("IRC", "CKD (Chronic Kidney Disease)"),
    ("TRAUMA", "Trauma (fractures, orthopedic injuries)"),
    ("NEURO", "Neurology (stroke, neurological conditions)"),
    ("METABOL", "Metabolic (diabetes, endocrine disorders)"),
    ("PULMO", "Pulmonology (respiratory diseases, COPD, pneumonia)"),
    ("CARDIO", "Cardiology (heart failure, cardiac conditions)"),
    ("INFECTIO", "Infectiology (sepsis, infectious diseases)"),
    ("NEPHRO", "Nephrology (chronic kidney disease, renal conditions)"),
    ("Cardiologie", "Cardiology"),
    ("Chirurgie ortho", "Orthopedic surgery"),
    ("Diabétologie", "Diabetology / Endocrinology"),
    ("Gériatrie", "Geriatrics"),
    ("Neurologie", "Neurology"),
    ("Pneumologie", "Pulmonology"),
    ("Réanimation", "Intensive Care Unit (ICU)"),
    ("Domicile", "Home"),
    ("EHPAD", "Nursing home"),
    ("SSR", "Rehabilitation center"),
    ("Transfert", "Transfer"),
    ("Décès", "Death"),
    ("Faible", "Low risk"),
    ("Très faible", "Very low risk"),
    ("Modéré", "Moderate risk"),
    ("Été", "Summer"),
    ("Printemps", "Spring"),
    ("Automne", "Autumn"),
    ("Hiver", "Winter"),
]


# French → English labels of the dashboards' axes and cards.
DASHBOARD_LABELS_FR_EN = [
    ("Réhospitalisation", "Readmission"),
    ("Séjour", "Hospital stay"),
    ("Pathologie", "Pathology / Medical condition"),
    ("Service", "Hospital department / Ward"),
    ("Date d'admission", "Admission date"),
    ("Mode de sortie", "Discharge mode"),
    ("Taux de réhospitalisation", "Readmission rate"),
    ("Durée moyenne de séjour", "Average length of stay"),
    ("Score de risque", "Risk score"),
    ("Indice de complexité", "Complexity index"),
    ("Hospitalisations précédentes", "Prior hospitalizations"),
    ("Médicaments", "Medications"),
    ("Groupe clinique", "Clinical group"),
    ("Catégorie de risque", "Risk category"),
    ("Saison d'admission", "Admission season"),
    ("Patients alerte critique", "Critical alert patients"),
    ("Taux sortie complexe", "Complex discharge rate"),
    ("Patients modérés", "Moderate risk patients"),
    ("Âge moyen", "Average age"),
]


def label_dictionary(spark: SparkSession, rows=None) -> DataFrame:
    return spark.createDataFrame(rows or LABELS_FR_EN + DASHBOARD_LABELS_FR_EN, "label_fr string, label_en string")


def users_by_service(stays: DataFrame, service_col: str = "service") -> DataFrame:
    """User mapping derived from the data: one department manager and one physician per service,
    plus a management user and a risk analyst.

    Its size is bounded by the number of distinct services (a category), not by the stays.
    """
    svc = stays.select(service_col).where(F.col(service_col).isNotNull()).distinct()
    slug = F.regexp_replace(F.lower(F.col(service_col)), r"[^\p{L}\p{N}]+", "_")
    managers = svc.select(F.concat(F.lit("resp."), slug).alias("user_name"),
                          F.lit("Responsable_Service").alias("role"), F.col(service_col).alias("service"))
    doctors = svc.select(F.concat(F.lit("dr."), slug).alias("user_name"),
                         F.lit("Medecin_Traitant").alias("role"), F.col(service_col).alias("service"))
    spark = stays.sparkSession
    fixed = spark.createDataFrame([("direction", "Direction_Hopital", None), ("analyste", "Analyste_Risques", None)],
                                  "user_name string, role string, service string")
    return managers.unionByName(doctors).unionByName(fixed)
