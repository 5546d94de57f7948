"""The incremental rolling measure: equal to the batch result over several batches, one state row a day, restarts."""

import os
import tempfile

from pyspark.sql import functions as F

from carestay import schema as S
from carestay.operators import silver
from carestay.operators import timeintel as TI
from carestay.sources.fixture import stays_raw
from carestay.streaming.rolling import read_daily, read_rolling, start_rolling
from tests.conftest import SF_SMALL


def rolled(df):
    return {r.date: (r.sejours_30j, r.readmissions_30j) for r in df.collect() if r.sejours_30j > 0}


def test_rolling_over_batches_and_a_restart_equals_batch(spark):
    d = tempfile.mkdtemp(prefix="carestay-roll-days-")
    landing, out, ckpt = (os.path.join(d, x) for x in ("landing", "out", "ckpt"))
    raw = stays_raw(spark, SF_SMALL).where(F.year("date_admission") == stays_raw(spark, SF_SMALL).agg(F.min(F.year("date_admission"))).first()[0])
    parts = [raw.where(F.pmod(F.hash("patient_id"), F.lit(2)) == k) for k in (0, 1)]

    def land_and_drain(part, name):
        part.coalesce(1).write.mode("append").parquet(os.path.join(landing, name))
        stream = spark.readStream.schema(S.STAY_SCHEMA).option("recursiveFileLookup", "true").parquet(landing)
        # all days of the year may still get rows
        q = start_rolling(stream, out, ckpt, lateness_days=400)
        q.awaitTermination(200)
        return q

    land_and_drain(parts[0], "a")
    clean = silver.clean_stays(parts[0])
    assert {k: v for k, v in rolled(read_rolling(spark, out)).items()}.items() >= rolled(TI.rolling_readmissions(clean)).items()
    # a later session goes on from the checkpoint: days already written get new totals
    q = land_and_drain(parts[1], "b")
    clean = silver.clean_stays(raw)
    assert rolled(read_rolling(spark, out)).items() >= rolled(TI.rolling_readmissions(clean)).items()
    days = clean.select("date_admission").distinct().count()
    states = [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]]
    assert states and max(states) <= days == read_daily(spark, out).count()


def test_rows_beyond_the_lateness_are_left_out_and_state_is_dropped(spark):
    d = tempfile.mkdtemp(prefix="carestay-roll-late-")
    landing, out, ckpt = (os.path.join(d, x) for x in ("landing", "out", "ckpt"))
    raw = silver.clean_stays(stays_raw(spark, SF_SMALL)).select("patient_id")
    one = stays_raw(spark, SF_SMALL).join(raw.limit(1), "patient_id").limit(1)
    for i, day in enumerate(["2024-03-01", "2024-06-01", "2024-03-02", "2024-05-20"]):
        (one.withColumn("date_admission", F.lit(day).cast("date")).select(*S.STAY_SCHEMA.names)
         .coalesce(1).write.mode("append").parquet(os.path.join(landing, f"b{i}")))
        stream = spark.readStream.schema(S.STAY_SCHEMA).option("recursiveFileLookup", "true").parquet(landing)
        q = start_rolling(stream, out, ckpt, lateness_days=30)
        q.awaitTermination(200)
    kept = {str(r.date): r.sejours for r in read_daily(spark, out).collect()}
    assert kept == {"2024-03-01": 1, "2024-06-01": 1, "2024-05-20": 1}
    assert q.recentProgress[-1]["stateOperators"][0]["numRowsTotal"] == 2
    got = {str(r.date): r.sejours_30j for r in read_rolling(spark, out).collect()}
    assert (got["2024-03-30"], got["2024-03-31"], got["2024-06-01"], got["2024-06-30"]) == (1, 0, 2, 1)
