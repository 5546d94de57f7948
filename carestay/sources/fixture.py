"""Projection of the driver's TPC-H-like tables into the bronze stay schema.

The driver's tables hold no hospital stays, so tests, queries and the bench read this
deterministic projection of ``orders``, ``lineitem`` and ``customer``. It uses integer
arithmetic and CASE only, plants the anomalies the operators must handle (null and
out-of-range ages, null targets, padded and mixed-case text, unknown codes, orders
without lines) and runs as one plan: a partial aggregate of ``lineitem`` by order key,
then two equi-joins that Catalyst/AQE plan by size (the customer side is broadcast
only when its measured size is under the threshold).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _cases(expr: Column, bounds: list[tuple[int, str]], last: str) -> Column:
    out = None
    for bound, label in bounds:
        out = F.when(expr < bound, label) if out is None else out.when(expr < bound, label)
    return out.otherwise(last)


def stays_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze-shaped stays derived from ``orders`` ⋈ ``customer`` ⋈ agg(``lineitem``)."""
    from carestay.plans.joins import ensure_parallelism

    # the per-order projection below is the row-heavy part: never leave it to one task
    orders = ensure_parallelism(read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate"))
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    li = (read_table(spark, sf_dir, "lineitem").groupBy("l_orderkey")
          .agg(F.sum("l_quantity").cast("bigint").alias("qty"), F.count(F.lit(1)).alias("n_lines")))

    ok, ck = F.col("o_orderkey"), F.col("o_custkey")
    k = (orders
         .join(customer, orders.o_custkey == customer.c_custkey, "left")
         .join(li, orders.o_orderkey == li.l_orderkey, "left")
         .select(
             ok.alias("ok"), ck.alias("ck"), F.col("c_nationkey").alias("nk"),
             F.coalesce("qty", F.lit(0)).alias("qty"), F.coalesce("n_lines", F.lit(0)).alias("nl"),
             F.col("o_orderdate").cast("date").alias("date_admission"), F.col("o_orderdate").alias("ts"),
             ((ok * 31 + ck * 17) % 100).alias("hp"),
             ((ok * 13 + ck * 7) % 78).alias("ha"),
             ((ok * 43 + ck * 29) % 100).alias("hm"),
             ((ok * 7919 + ck * 104729) % 1000).alias("hy")))

    ok, ck, hp, hm = F.col("ok"), F.col("ck"), F.col("hp"), F.col("hm")
    r = (ok + ck) % 10
    a = k.select(
        "*",
        (F.lit(18) + F.col("ha")).alias("age0"),
        (F.lit(1) + F.col("qty") % 45).alias("los"),
        ((F.col("nl") * 2 + ok) % 21).alias("meds"),
        F.when(r < 4, 0).when(r < 7, 1).when(r < 8, 2).when(r < 9, 3).otherwise(5).alias("prior"),
        _cases(hp, [(22, "I50"), (42, "E11"), (57, "J44"), (70, "J18"), (80, "N18"), (88, "I63"), (95, "A41")],
               "S72").alias("code"))
    m = a.withColumn("mode", F.when(
        F.col("age0") > 75,
        _cases(hm, [(40, "Domicile"), (70, "SSR"), (85, "EHPAD"), (90, "Transfert")], "Décès"),
    ).otherwise(_cases(hm, [(65, "Domicile"), (80, "SSR"), (85, "EHPAD"), (95, "Transfert")], "Décès")))

    def pts_if(cond: Column, p: int) -> Column:
        return F.when(cond, p).otherwise(0)

    age0, prior, meds, los, code = F.col("age0"), F.col("prior"), F.col("meds"), F.col("los"), F.col("code")
    s = m.withColumn("pts", F.least(F.lit(85), F.greatest(F.lit(5),
        F.lit(10) + pts_if(age0 > 70, 12) + pts_if(age0 > 80, 8) + pts_if(prior >= 2, 15)
        + pts_if(prior >= 4, 10) + pts_if(meds >= 8, 8) + pts_if(los >= 10, 6)
        + pts_if(F.col("mode").isin("SSR", "EHPAD"), 7) + pts_if(code == "A41", 12)
        + pts_if(code == "I50", 8))))

    svc = (ok + 3 * ck) % 8
    nk10 = F.col("nk") % 10
    return s.select(
        F.concat(F.lit("00000000-0000-4000-8000-"), F.lpad(ok.cast("string"), 12, "0")).alias("patient_id"),
        F.when(ok % 499 == 0, F.lit(None)).when(ok % 503 == 0, F.lit(101)).otherwise(age0)
         .cast("smallint").alias("age"),
        F.when(ok % 7 == 0, " m").when((ok + ck) % 2 == 0, "M").otherwise("F ").alias("sexe"),
        F.when(code == "I50", "Insuffisance cardiaque").when(code == "E11", "Diabète type 2")
         .when(code == "J44", "BPCO").when(code == "J18", " Pneumonie ")
         .when(code == "N18", "Insuffisance rénale").when(code == "I63", "Accident vasculaire cérébral")
         .when(code == "A41", "Sepsis").otherwise("Fracture du fémur").alias("pathologie"),
        F.when(ok % 251 == 0, "z99").when(ok % 5 == 0, F.lower(code)).otherwise(code).alias("diagnostic_principal"),
        F.when(svc == 0, "Cardiologie").when(svc == 1, "Pneumologie").when(svc == 2, "Endocrinologie")
         .when(svc == 3, "Médecine interne").when(svc == 4, "Neurologie").when(svc == 5, "Gériatrie")
         .when(svc == 6, "Réanimation").otherwise("néphrologie").alias("service"),
        F.when(nk10 == 0, "Île-de-France").when(nk10 == 1, "Auvergne-Rhône-Alpes")
         .when(nk10 == 2, "Provence-Alpes-Côte d'Azur").when(nk10 == 3, "Occitanie")
         .when(nk10 == 4, "Nouvelle-Aquitaine").when(nk10 == 5, "Hauts-de-France")
         .when(nk10 == 6, "Grand Est").when(nk10 == 7, "Bretagne")
         .when(nk10 == 8, "Pays de la Loire").otherwise("Normandie").alias("hopital_region"),
        los.cast("smallint").alias("duree_sejour"),
        prior.cast("smallint").alias("nb_hospitalisations_precedentes"),
        meds.cast("smallint").alias("nb_medicaments"),
        F.col("date_admission"),
        F.date_add("date_admission", los.cast("int")).alias("date_sortie"),
        F.col("mode").alias("mode_sortie"),
        F.when(ok % 509 == 0, F.lit(None)).when(F.col("hy") < F.col("pts") * 10, 1).otherwise(0)
         .cast("smallint").alias("readmission_30j"),
        (F.col("pts") / F.lit(100.0)).alias("score_risque_theorique"),
        F.col("ts").alias("ingestion_timestamp"),
        F.lit("testdata_orders").alias("source_fichier"),
    )


# The same projection as DuckDB SQL CTEs, prepended to every oracle query.
STAYS_RAW_CTES = r"""
li AS (
  SELECT l_orderkey, CAST(SUM(l_quantity) AS BIGINT) AS qty, COUNT(*) AS n_lines
  FROM lineitem GROUP BY l_orderkey),
fk AS (
  SELECT o.o_orderkey AS ok, o.o_custkey AS ck, c.c_nationkey AS nk,
         COALESCE(li.qty, 0) AS qty, COALESCE(li.n_lines, 0) AS nl,
         CAST(o.o_orderdate AS DATE) AS date_admission, o.o_orderdate AS ts,
         (o.o_orderkey * 31 + o.o_custkey * 17) % 100 AS hp,
         (o.o_orderkey * 13 + o.o_custkey * 7)  % 78  AS ha,
         (o.o_orderkey * 43 + o.o_custkey * 29) % 100 AS hm,
         (o.o_orderkey * 7919 + o.o_custkey * 104729) % 1000 AS hy
  FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
                LEFT JOIN li ON o.o_orderkey = li.l_orderkey),
fa AS (
  SELECT *, 18 + ha AS age0, 1 + (qty % 45) AS los, (nl * 2 + ok) % 21 AS meds,
    CASE WHEN (ok + ck) % 10 < 4 THEN 0 WHEN (ok + ck) % 10 < 7 THEN 1
         WHEN (ok + ck) % 10 < 8 THEN 2 WHEN (ok + ck) % 10 < 9 THEN 3 ELSE 5 END AS prior,
    CASE WHEN hp < 22 THEN 'I50' WHEN hp < 42 THEN 'E11' WHEN hp < 57 THEN 'J44' WHEN hp < 70 THEN 'J18'
         WHEN hp < 80 THEN 'N18' WHEN hp < 88 THEN 'I63' WHEN hp < 95 THEN 'A41' ELSE 'S72' END AS code
  FROM fk),
fm AS (
  SELECT *,
    CASE WHEN age0 > 75 THEN CASE WHEN hm < 40 THEN 'Domicile' WHEN hm < 70 THEN 'SSR' WHEN hm < 85 THEN 'EHPAD' WHEN hm < 90 THEN 'Transfert' ELSE 'Décès' END
         ELSE CASE WHEN hm < 65 THEN 'Domicile' WHEN hm < 80 THEN 'SSR' WHEN hm < 85 THEN 'EHPAD' WHEN hm < 95 THEN 'Transfert' ELSE 'Décès' END END AS mode
  FROM fa),
fs AS (
  SELECT *, LEAST(85, GREATEST(5, 10
      + CASE WHEN age0 > 70 THEN 12 ELSE 0 END + CASE WHEN age0 > 80 THEN 8 ELSE 0 END
      + CASE WHEN prior >= 2 THEN 15 ELSE 0 END + CASE WHEN prior >= 4 THEN 10 ELSE 0 END
      + CASE WHEN meds >= 8 THEN 8 ELSE 0 END + CASE WHEN los >= 10 THEN 6 ELSE 0 END
      + CASE WHEN mode IN ('SSR','EHPAD') THEN 7 ELSE 0 END
      + CASE WHEN code = 'A41' THEN 12 ELSE 0 END + CASE WHEN code = 'I50' THEN 8 ELSE 0 END)) AS pts
  FROM fm),
stays_raw AS (
SELECT
  concat('00000000-0000-4000-8000-', lpad(CAST(ok AS STRING), 12, '0')) AS patient_id,
  CAST(CASE WHEN ok % 499 = 0 THEN NULL WHEN ok % 503 = 0 THEN 101 ELSE age0 END AS SMALLINT) AS age,
  CASE WHEN ok % 7 = 0 THEN ' m' WHEN (ok + ck) % 2 = 0 THEN 'M' ELSE 'F ' END AS sexe,
  CASE code WHEN 'I50' THEN 'Insuffisance cardiaque' WHEN 'E11' THEN 'Diabète type 2' WHEN 'J44' THEN 'BPCO'
    WHEN 'J18' THEN ' Pneumonie ' WHEN 'N18' THEN 'Insuffisance rénale' WHEN 'I63' THEN 'Accident vasculaire cérébral'
    WHEN 'A41' THEN 'Sepsis' ELSE 'Fracture du fémur' END AS pathologie,
  CASE WHEN ok % 251 = 0 THEN 'z99' WHEN ok % 5 = 0 THEN lower(code) ELSE code END AS diagnostic_principal,
  CASE (ok + 3 * ck) % 8 WHEN 0 THEN 'Cardiologie' WHEN 1 THEN 'Pneumologie' WHEN 2 THEN 'Endocrinologie'
    WHEN 3 THEN 'Médecine interne' WHEN 4 THEN 'Neurologie' WHEN 5 THEN 'Gériatrie' WHEN 6 THEN 'Réanimation' ELSE 'néphrologie' END AS service,
  CASE nk % 10 WHEN 0 THEN 'Île-de-France' WHEN 1 THEN 'Auvergne-Rhône-Alpes' WHEN 2 THEN 'Provence-Alpes-Côte d''Azur'
    WHEN 3 THEN 'Occitanie' WHEN 4 THEN 'Nouvelle-Aquitaine' WHEN 5 THEN 'Hauts-de-France' WHEN 6 THEN 'Grand Est'
    WHEN 7 THEN 'Bretagne' WHEN 8 THEN 'Pays de la Loire' ELSE 'Normandie' END AS hopital_region,
  CAST(los AS SMALLINT) AS duree_sejour,
  CAST(prior AS SMALLINT) AS nb_hospitalisations_precedentes,
  CAST(meds AS SMALLINT) AS nb_medicaments,
  date_admission,
  date_admission + CAST(los AS INT) AS date_sortie,
  mode AS mode_sortie,
  CAST(CASE WHEN ok % 509 = 0 THEN NULL WHEN hy < pts * 10 THEN 1 ELSE 0 END AS SMALLINT) AS readmission_30j,
  pts / 100.0E0 AS score_risque_theorique,
  ts AS ingestion_timestamp,
  'testdata_orders' AS source_fichier
FROM fs)
"""


# A second projection, of clean stays, with the faults that quality checks and null-safe joins exist for: repeated ids (a later
# ingestion, and ties in time), discharges before admission, ages at or below zero, null services. The same SQL for DuckDB.
DIRTY_CTE = """keyed AS (SELECT patient_id, age, service, date_admission, date_sortie, duree_sejour, readmission_30j, ingestion_timestamp,
    CAST(substring(patient_id, 25) AS BIGINT) AS k FROM clean),
dirty AS (
  SELECT patient_id, CAST(CASE WHEN k % 41 = 0 THEN -age WHEN k % 43 = 0 THEN 0 ELSE age END AS SMALLINT) AS age,
    CASE WHEN k % 13 = 0 THEN NULL ELSE service END AS service, date_admission,
    CASE WHEN k % 37 = 0 THEN date_admission - 2 ELSE date_sortie END AS date_sortie, duree_sejour, readmission_30j, ingestion_timestamp
  FROM keyed
  UNION ALL SELECT patient_id, age, service, date_admission, date_sortie, CAST(duree_sejour + 1 AS SMALLINT), readmission_30j,
    ingestion_timestamp + INTERVAL '1' HOUR FROM keyed WHERE k % 29 = 0
  UNION ALL SELECT patient_id, age, service, date_admission, date_sortie, CAST(duree_sejour + 2 AS SMALLINT), readmission_30j,
    ingestion_timestamp FROM keyed WHERE k % 31 = 0)"""


def dirty_stays(clean: DataFrame) -> DataFrame:
    """``clean`` stays with planted faults (see ``DIRTY_CTE``); about a tenth more rows than ``clean``."""
    return clean.sparkSession.sql(f"WITH {DIRTY_CTE.replace('FROM clean)', 'FROM {clean})')} SELECT * FROM dirty", clean=clean)
