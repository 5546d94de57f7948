import os
import tempfile

from pyspark.sql import functions as F

from carestay.sources import io as IO
from carestay.sources.fixture import stays_raw
from carestay.streaming.ingest import stream_bronze
from tests.conftest import SF_SMALL


SMALLINTS = ["age", "duree_sejour", "nb_hospitalisations_precedentes", "nb_medicaments", "readmission_30j"]


def _csv(pdf, path):
    pdf = pdf.copy()
    for c in SMALLINTS:
        pdf[c] = pdf[c].astype("Int64")
    pdf.to_csv(path, index=False, encoding="utf-8-sig")  # with a BOM, as the source writes it


def test_csv_bronze_roundtrip_and_idempotent_overwrite(spark):
    d = tempfile.mkdtemp(prefix="carestay-io-")
    raw = stays_raw(spark, SF_SMALL)
    pdf = raw.limit(50).toPandas()
    pdf["ingestion_timestamp"] = pdf["ingestion_timestamp"].map(lambda t: t.isoformat())
    _csv(pdf, os.path.join(d, "raw.csv"))
    back = IO.read_stays_csv(spark, os.path.join(d, "raw.csv"))
    assert back.count() == 50
    assert back.where(F.col("patient_id").startswith("00000000")).count() == 50
    bronze = os.path.join(d, "bronze")
    IO.append_bronze(back, bronze, "b1")
    IO.append_bronze(back, bronze, "b1")      # a re-run of the batch replaces its partitions
    assert spark.read.parquet(bronze).count() == 50
    IO.append_bronze(back.limit(2), bronze, "b2")  # another batch of the same day is added
    assert spark.read.parquet(bronze).count() == 52
    assert IO.failure_log(spark, "x" * 5000).first().message == "x" * 5000
    log = IO.ingestion_log(back, "SUCCESS", "test", 1.234).first()
    assert log.nb_lignes == 50 and log.statut == "SUCCESS" and float(log.duree_secondes) == 1.23


def test_stream_ingestion_exactly_once(spark):
    d = tempfile.mkdtemp(prefix="carestay-stream-")
    landing = os.path.join(d, "landing")
    os.makedirs(landing)
    raw = stays_raw(spark, SF_SMALL).toPandas()
    raw["ingestion_timestamp"] = raw["ingestion_timestamp"].map(lambda t: t.isoformat())
    _csv(raw.iloc[:300], os.path.join(landing, "a.csv"))
    _csv(raw.iloc[300:500], os.path.join(landing, "b.csv"))
    bronze, log, ckpt = (os.path.join(d, x) for x in ("bronze", "log", "ckpt"))
    q = stream_bronze(spark, landing, bronze, log, checkpoint=ckpt)
    q.awaitTermination(120)
    assert spark.read.parquet(bronze).count() == 500
    assert spark.read.parquet(log).count() == 2   # one micro-batch per file
    # a restart with nothing new lands nothing twice
    q = stream_bronze(spark, landing, bronze, log, checkpoint=ckpt)
    q.awaitTermination(120)
    assert spark.read.parquet(bronze).count() == 500


def test_run_from_a_csv_of_stays_writes_every_table(spark):
    from carestay.operators import measures as M
    from carestay.operators import silver
    from carestay.plans.layers import run_stays
    out = tempfile.mkdtemp(prefix="carestay-run-")
    pdf = stays_raw(spark, SF_SMALL).toPandas()
    pdf["ingestion_timestamp"] = pdf["ingestion_timestamp"].map(lambda t: t.isoformat())
    _csv(pdf, os.path.join(out, "stays.csv"))
    paths = run_stays(spark, lambda: IO.read_stays(spark, os.path.join(out, "stays.csv")), out, batch_id="b1")
    assert spark.read.parquet(paths["patients_raw"]).count() == len(pdf)
    feats, scored = spark.read.parquet(paths["mart_patient_features"]), IO.read_scores(spark, paths["scores"])
    base = M.stay_measures_base(feats, scored, silver.clean_stays(spark.read.parquet(paths["patients_raw"])))
    assert base.count() == feats.count() and base.where("score_risque_modele is null").count() == 0
    assert M.measures(base, (), ["taux_sexe_m", "vrais_positifs"]).first().vrais_positifs > 0
    assert spark.read.parquet(paths["mart_patient_features"]).count() > 1000
    kpis = spark.read.parquet(paths["mart_readmission_kpis"])
    assert {r.dimension for r in kpis.select("dimension").distinct().collect()} == {"pathologie", "service", "region", "tranche_age", "mois"}
    scores = spark.read.option("header", True).csv(paths["scores"])
    assert scores.columns == ["patient_id", "pathologie", "service", "age", "tranche_age", "score_risque_modele",
                              "categorie_risque", "readmission_30j"]
    fails = {(r.model, r.check, r.column) for r in spark.read.parquet(paths["quality_report"]).where("status = 'FAIL'").collect()}
    # the fixture plants null ages and targets in bronze; silver and gold pass
    assert fails == {("source", "not_null", "age"), ("source", "not_null", "readmission_30j")}
    assert spark.read.parquet(paths["ingestion_logs"]).count() == 1


def test_replayed_micro_batch_is_idempotent(spark):
    from carestay.sources.io import append_bronze
    d = tempfile.mkdtemp(prefix="carestay-replay-")
    batch = stays_raw(spark, SF_SMALL).limit(40)
    for _ in range(2):   # the same batch id written twice, as after a retry
        append_bronze(batch, os.path.join(d, "bronze"), "7")
    back = spark.read.parquet(os.path.join(d, "bronze"))
    assert back.count() == 40 and back.select("batch_id").distinct().first()[0] == 7


def test_run_all_logs_failure(spark):
    import pytest

    from carestay.plans.layers import run_all
    out = tempfile.mkdtemp(prefix="carestay-fail-")
    with pytest.raises(Exception):
        run_all(spark, "/nonexistent/sf", out, fit_model=False)
    log = spark.read.parquet(os.path.join(out, "bronze", "ingestion_logs")).first()
    assert log.statut == "FAILURE" and log.nb_lignes == 0


def test_streaming_rolling_window_equals_batch(spark):
    from carestay import schema as S
    from carestay.operators import silver, timeintel as TI
    from carestay.streaming.rolling import rolling_readmissions_stream
    d = tempfile.mkdtemp(prefix="carestay-roll-")
    raw = stays_raw(spark, SF_SMALL)
    raw.write.parquet(os.path.join(d, "landing"))
    stream = spark.readStream.schema(S.STAY_SCHEMA).parquet(os.path.join(d, "landing"))
    q = (rolling_readmissions_stream(stream).writeStream.outputMode("complete").format("memory")
         .queryName("rolling_test").trigger(availableNow=True).start())
    q.awaitTermination(180)
    got = {r.date: (r.sejours_30j, r.readmissions_30j) for r in spark.sql("SELECT * FROM rolling_test").collect()}
    batch = {r.date: (r.sejours_30j, r.readmissions_30j)
             for r in TI.rolling_readmissions(silver.clean_stays(raw)).collect() if r.sejours_30j > 0}
    assert got and all(got[k] == v for k, v in batch.items() if k in got)
    assert set(batch) <= set(got)


def test_drained_rolling_stream_leaves_no_window_back(spark):
    from carestay.operators import silver
    from carestay.operators import timeintel as TI
    from carestay.streaming.ingest import raw_stream
    from carestay.streaming.rolling import read_rolling, start_rolling
    d = tempfile.mkdtemp(prefix="carestay-rolling-")
    os.makedirs(os.path.join(d, "in"))
    raw = stays_raw(spark, SF_SMALL)
    pdf = raw.toPandas().sort_values("date_admission")
    pdf["ingestion_timestamp"] = pdf["ingestion_timestamp"].map(lambda t: t.isoformat())
    pdf = pdf.iloc[:120]
    _csv(pdf, os.path.join(d, "in", "a.csv"))
    start_rolling(raw_stream(spark, os.path.join(d, "in")), os.path.join(d, "out"), os.path.join(d, "ckpt")).awaitTermination(200)
    got = {r.date: (r.sejours_30j, r.readmissions_30j) for r in read_rolling(spark, os.path.join(d, "out")).collect()}
    clean = silver.clean_stays(IO.read_stays_csv(spark, os.path.join(d, "in", "a.csv")))
    want = {r.date: (r.sejours_30j, r.readmissions_30j) for r in TI.rolling_readmissions(clean).collect() if r.sejours_30j > 0}
    assert want and all(got[k] == v for k, v in want.items())


def test_malformed_line_fails_the_stream(spark):
    d = tempfile.mkdtemp(prefix="carestay-bad-")
    os.makedirs(os.path.join(d, "landing"))
    pdf = stays_raw(spark, SF_SMALL).limit(5).toPandas()
    pdf["ingestion_timestamp"] = pdf["ingestion_timestamp"].map(lambda t: t.isoformat())
    _csv(pdf, os.path.join(d, "landing", "a.csv"))
    path = os.path.join(d, "landing", "a.csv")
    with open(path, encoding="utf-8-sig") as f:
        lines = f.read().splitlines()
    cells = lines[1].split(",")
    cells[lines[0].split(",").index("age")] = "abc"
    with open(path, "w", encoding="utf-8-sig") as f:
        f.write("\n".join([lines[0], ",".join(cells), *lines[2:]]))
    q = stream_bronze(spark, os.path.join(d, "landing"), os.path.join(d, "bronze"), os.path.join(d, "log"), os.path.join(d, "ckpt"))
    import pytest
    with pytest.raises(Exception, match="(?i)malformed"):
        q.awaitTermination(120)
    assert not os.path.exists(os.path.join(d, "log"))
