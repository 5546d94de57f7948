"""The stream of latest rows equals the batch deduplication, across restarts, ties and late rows."""

import datetime as dt

from carestay.operators.silver import dedup_latest
from carestay.streaming.latest import read_latest, start_latest

SCHEMA = "patient_id string, service string, age int, ingestion_timestamp timestamp_ntz, ok boolean"


def at(day, hour=0):
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=day, hours=hour)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def drain(spark, tmp_path, **how):
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in" / "*"))
    q = start_latest(stream, str(tmp_path / "out"), str(tmp_path / "ck"), **how)
    assert q.awaitTermination(120) and q.exception() is None


def land(spark, tmp_path, n, data):
    spark.createDataFrame(data, SCHEMA).coalesce(1).write.parquet(str(tmp_path / "in" / f"f{n}"))


BATCHES = [
    [("a", "x", 50, at(0), True), ("b", "y", None, at(1), False), ("a", "z", 51, at(2), None)],
    [("a", "w", 40, at(1), True), ("b", "y", 30, at(1), False), ("c", "é", 1, at(3), True), ("c", None, 2, at(3), True)],
    [("b", None, 99, at(5), True), ("d", "y", 7, at(4), False), (None, "y", 1, at(9), True), ("e", "y", 1, None, True)],
    [("a", "x", 50, at(0), True), ("d", "y", 7, at(4), False), ("c", "é", 1, at(3), None)],
]


def test_equals_dedup_latest_also_after_a_restart(spark, tmp_path):
    for n in (0, 1):
        land(spark, tmp_path, n, BATCHES[n])
    drain(spark, tmp_path)
    for n in (2, 3):
        land(spark, tmp_path, n, BATCHES[n])
    drain(spark, tmp_path)  # goes on from the stored state
    everything = spark.createDataFrame([r for b in BATCHES for r in b if r[0] and r[3]], SCHEMA)
    assert rows(read_latest(spark, str(tmp_path / "out"))) == rows(dedup_latest(everything))
    # a row that replaces nothing is not given again
    assert spark.read.parquet(str(tmp_path / "out")).where("patient_id = 'a'").count() == 1


def test_expired_state_and_late_rows(spark, tmp_path):
    land(spark, tmp_path, 0, [("a", "x", 1, at(0), True), ("b", "x", 1, at(0), True)])
    land(spark, tmp_path, 1, [("c", "x", 1, at(100), True)])  # moves the watermark: a and b expire
    drain(spark, tmp_path, lateness_days=1, keep_days=2)
    land(spark, tmp_path, 2, [("d", "x", 1, at(101), True)])
    drain(spark, tmp_path, lateness_days=1, keep_days=2)
    land(spark, tmp_path, 3, [("a", "back", 2, at(102), True), ("b", "late", 1, at(50), True)])
    drain(spark, tmp_path, lateness_days=1, keep_days=2)
    got = {r["patient_id"]: (r["service"], r["ingestion_timestamp"]) for r in read_latest(spark, str(tmp_path / "out")).collect()}
    assert got["a"] == ("back", at(102)) and got["c"] == ("x", at(100)) and got["d"] == ("x", at(101))
    assert got["b"] == ("x", at(0))  # the late row came behind the watermark
