"""Materialised layers, as in the source's medallion layout: silver stays views (lazy
DataFrames), gold is written once as a table and read by every downstream analysis.

The gold feature table is built once per session and input fingerprint and written to the
shared folder named by ``spark.checkpoint.dir`` (a reliable, cluster-visible location), so
executor loss never forces a recomputation from the raw tables.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carestay import schema as S
from carestay.operators import gold, silver
from carestay.session import ensure_checkpoint_dir
from carestay.sources import io
from carestay.sources.fixture import stays_raw

SOURCE_TABLES = ("orders", "lineitem", "customer")
_BUILT: dict[tuple[str, str], str] = {}
_MODELS: dict[tuple, object] = {}
GOLD_EXTRA = ["sexe"]


def _fingerprint(spark: SparkSession, sf_dir: str) -> str:
    """Names, sizes and times of the source tables' files, wherever they are stored."""
    parts = [sf_dir]
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for t in SOURCE_TABLES:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/{t}.parquet")
        parts += [f"{s.getPath().getName()}:{s.getLen()}:{s.getModificationTime()}" for s in path.getFileSystem(conf).listStatus(path)]
    return hashlib.sha1("|".join(parts).encode()).hexdigest()[:16]


def _layer_path(spark: SparkSession, sf_dir: str, layer: str, table: str) -> tuple[tuple, str]:
    key = (spark.sparkContext.applicationId, _fingerprint(spark, sf_dir), layer)
    root = ensure_checkpoint_dir(spark)
    return key, f"{root.rstrip('/')}/{layer}/{key[0]}/{key[1]}/{table}"


def build_bronze(spark: SparkSession, sf_dir: str) -> str:
    """Write the typed bronze stay table (the projection of the source tables) once."""
    key, path = _layer_path(spark, sf_dir, "bronze", "patients_raw")
    if key not in _BUILT:
        stays_raw(spark, sf_dir).write.mode("overwrite").parquet(path)
        _BUILT[key] = path
    return _BUILT[key]


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed bronze stays; filters on it reach the Parquet scan as pushed predicates."""
    return spark.read.parquet(build_bronze(spark, sf_dir))


def build_gold_features(spark: SparkSession, sf_dir: str) -> str:
    """Write the gold feature table (plus ``sexe`` for the measure layer) and return its path."""
    key, path = _layer_path(spark, sf_dir, "gold", "mart_patient_features")
    if key not in _BUILT:
        f = gold.with_features(silver.clean_stays(bronze(spark, sf_dir)), extra=GOLD_EXTRA)
        f.write.mode("overwrite").parquet(path)
        _BUILT[key] = path
    return _BUILT[key]


def gold_features(spark: SparkSession, sf_dir: str, extra=()) -> DataFrame:
    """The gold feature table for ``sf_dir`` (built on first use in this session)."""
    df = spark.read.parquet(build_gold_features(spark, sf_dir))
    return df.select(*gold.FEATURE_TABLE_COLUMNS, *[c for c in extra if c in GOLD_EXTRA])


def gold_by_service(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gold feature table in folders by service, so that a department's rows are read without the others."""
    source = spark.read.parquet(build_gold_features(spark, sf_dir))
    key, path = _layer_path(spark, sf_dir, "gold_by_service", "mart_patient_features")
    if key not in _BUILT:
        io.write_gold(source, path, ["service"])
        _BUILT[key] = path
    return io.read_gold(spark, path, source.schema)


def bucketed(spark: SparkSession, sf_dir: str, layer: str, source: Callable[[], DataFrame]) -> DataFrame:
    """A table of stays stored by stay key (built on first use in this session); all such tables have one bucket count."""
    key, path = _layer_path(spark, sf_dir, "bucketed", layer)
    key = (*key, layer)
    name = f"carestay_{layer}_{key[1]}"
    if key not in _BUILT:
        io.write_bucketed(source(), path, name, S.KEY, io.bucket_count(spark, build_bronze(spark, sf_dir)))
        _BUILT[key] = name
    return spark.table(name)


def silver_by_stay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean stays, bucketed by stay key."""
    return bucketed(spark, sf_dir, "silver", lambda: silver.clean_stays(bronze(spark, sf_dir)))


def features_by_stay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gold feature table, bucketed by stay key."""
    return bucketed(spark, sf_dir, "features", lambda: gold_features(spark, sf_dir))


def model_tables(spark: SparkSession, sf_dir: str) -> tuple:
    """(fits, split, scored): the fitted models, the split of the gold features, and all split rows with their scores.

    ``fits`` holds the model of the training rows, then those without each fold. The split and the scores are
    stored tables and the models are fitted once per session and input, all together, so the model queries share them.
    """
    from carestay.operators import model as MD
    from carestay.operators import newton

    key, path = _layer_path(spark, sf_dir, "model", "scored")
    split_path = path.removesuffix("scored") + "split"
    if key not in _MODELS:
        MD.stratified_split(gold_features(spark, sf_dir)).write.mode("overwrite").parquet(split_path)
        split = spark.read.parquet(split_path)
        fits = newton.fit_together(split.where(F.col("split") == "train"))
        MD.score(split, fits[0]).write.mode("overwrite").parquet(path)
        _MODELS[key] = fits
    return _MODELS[key], spark.read.parquet(split_path), spark.read.parquet(path)


def run_all(spark: SparkSession, sf_dir: str, out_dir: str, fit_model: bool = True) -> dict:
    """``run_stays`` on the stays that the given tables are projected into."""
    return run_stays(spark, lambda: stays_raw(spark, sf_dir), out_dir, fit_model)


def run_stays(spark: SparkSession, read: Callable[[], DataFrame], out_dir: str, fit_model: bool = True,
              batch_id: str = "run") -> dict:
    """The whole flow in one call, writing every table the source produces:

    ``read()`` (raw stays, e.g. ``io.read_stays``) → bronze (typed stays) → silver (views) → gold ``mart_patient_features`` and
    ``mart_readmission_kpis`` → quality report → risk model scores (CSV) and run log.
    Returns the written paths. Every write is a distributed, task-atomic job.
    """
    import time as _time

    from carestay.sources import io as IO

    t0 = _time.time()
    out = out_dir.rstrip("/")
    paths = {"ingestion_logs": f"{out}/bronze/ingestion_logs"}
    try:
        return _run_stays(spark, read, out, fit_model, batch_id, paths, t0)
    except Exception as e:
        # as the source does: a failed run leaves one FAILURE row (0 rows) in the run log
        IO.append_log(IO.failure_log(spark, str(e), _time.time() - t0), paths["ingestion_logs"])
        raise


def _run_stays(spark: SparkSession, read: Callable[[], DataFrame], out: str, fit_model: bool, batch_id: str, paths: dict, t0: float) -> dict:
    import time as _time

    from carestay.operators import model as MD
    from carestay.operators import newton
    from carestay.operators import quality as QC
    from carestay.sources import io as IO

    paths["patients_raw"] = f"{out}/bronze/patients_raw"
    IO.append_bronze(read(), paths["patients_raw"], batch_id)
    raw = spark.read.parquet(paths["patients_raw"]).where(F.col("batch_id") == batch_id).drop("ingestion_date", "batch_id")
    clean = silver.clean_stays(raw)
    IO.register_silver(clean, "stg_patients")
    IO.register_silver(silver.stay_metrics(clean), "stg_sejours")
    IO.register_silver(silver.enrich_diagnostics(clean), "stg_diagnostics")
    paths["mart_patient_features"] = f"{out}/gold/mart_patient_features"
    IO.write_gold(gold.with_features(clean), paths["mart_patient_features"])
    feats = spark.read.parquet(paths["mart_patient_features"])
    paths["mart_readmission_kpis"] = f"{out}/gold/mart_readmission_kpis"
    IO.write_gold(gold.kpi_mart(feats, ordered=False), paths["mart_readmission_kpis"])
    wide = silver.silver_wide(clean)
    report = (QC.run_suites(raw, [("source", QC.source_suite())])
              .unionByName(QC.run_suites(wide, [("stg_patients", QC.clean_suite()), ("stg_sejours", QC.stay_suite()),
                                                ("stg_diagnostics", QC.diagnostic_suite())]))
              .unionByName(QC.run_suites(feats, [("mart_patient_features", QC.feature_suite())])))
    paths["quality_report"] = f"{out}/quality_report"
    report.write.mode("overwrite").parquet(paths["quality_report"])
    if fit_model:
        paths["split"] = f"{out}/model/split"
        MD.stratified_split(feats).write.mode("overwrite").parquet(paths["split"])
        model = newton.fit_together(spark.read.parquet(paths["split"]).where("split = 'train'"), folds=0)[0]
        paths["scores"] = f"{out}/scores_risque_patients"
        IO.export_scores(MD.score_export(MD.score(feats, model)), paths["scores"])
    IO.append_log(IO.ingestion_log(raw, "SUCCESS", f"batch {batch_id}", _time.time() - t0), paths["ingestion_logs"])
    return paths
