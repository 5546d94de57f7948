"""Registered queries against their DuckDB oracles on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as E

TABLES = "orders lineitem customer".split()
FAST = ["clean_stays", "quarantine", "with_features", "feature_store_join", "kpi_mart", "measures_global",
        "measures_confusion", "pathology_rank", "ks_approx", "prior_year", "rolling_30d", "rls_visible_counts",
        "quality_report", "describe", "chi_square_stat", "mann_whitney_u", "kruskal_h", "stratified_split",
        "exact_auc", "roc_points", "classification_report", "normality_test", "measures_multi_sets",
        "prior_year_by_service", "dashboard_stays_by_tier", "features_train_stats", "assert_rate_band_strict",
        "correlation", "group_rates", "histogram_duree_sejour", "labels_en_by_pathology", "ks_statistic"]


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.6g}"
    return "∅" if v is None else str(v)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('/root/testdata/sf0.001/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, "/root/testdata/sf0.001")
    cur = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(dcols)
    types = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "smallint": "SMALLINT", "double": "DOUBLE",
             "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP"}
    duck_types = {r[0]: r[1] for r in duck.execute(f"DESCRIBE {E.oracle_sql()[name]}").fetchall()}
    assert {f.name: types.get(f.dataType.simpleString()) for f in df.schema.fields} == duck_types
    cur = duck.execute(E.oracle_sql()[name])
    order = sorted(df.columns)
    s = sorted("|".join(norm(r[c]) for c in order) for r in df.collect())
    d = sorted("|".join(norm(r[dcols.index(c)]) for c in order) for r in cur.fetchall())
    assert s == d


def test_every_query_has_entry_and_registered(spark):
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 60
    assert E.entry(spark).count() > 0
