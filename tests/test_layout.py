"""Stored layouts: gold in folders by service, stay tables in buckets by stay key; what the plans make of them."""

import os
import re
import tempfile

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from carestay.operators import security as SEC
from carestay.plans import layers
from carestay.sources import io as IO
from tests.conftest import SF_SMALL


@pytest.fixture
def large_joins(spark):
    """Plans as for tables too large to broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def plan_of(df) -> str:
    return df._jdf.queryExecution().sparkPlan().toString() + df._jdf.queryExecution().executedPlan().toString()


def test_row_level_access_reads_only_the_users_folders(spark):
    gold = layers.gold_by_service(spark, SF_SMALL)
    assert gold.schema["service"].dataType.simpleString() == "string"
    assert sorted(gold.collect()) == sorted(spark.read.parquet(layers.build_gold_features(spark, SF_SMALL)).select(*gold.columns).collect())
    users = spark.createDataFrame([("u", "Responsable_Service", "Cardiologie"), ("u", "Responsable_Service", None), ("v", "Responsable_Service", "Urgences")],
                                  "user_name string, role string, service string")
    seen = SEC.row_level_filter(gold, users, "u", "Responsable_Service")
    assert re.search(r"PartitionFilters: \[.*dynamicpruning", plan_of(seen))
    rows = seen.collect()
    assert rows and {r.service for r in rows} == {"Cardiologie"}
    assert len(rows) == gold.where(F.col("service") == "Cardiologie").count()
    assert SEC.row_level_filter(gold, users, "w", "Responsable_Service").count() == 0


def test_partitioned_gold_keeps_null_and_number_like_values(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="carestay-parts-"), "g")
    df = spark.createDataFrame([("007", 1), (None, 2), ("", 3), ("a b/c", 4)], "service string, n int")
    IO.write_gold(df, path, ["service"])
    assert {(r.service, r.n) for r in IO.read_gold(spark, path, df.schema).collect()} == {("007", 1), (None, 2), (None, 3), ("a b/c", 4)}


@pytest.mark.parametrize("name", ["feature_store_join", "measures_attached_scores"])
def test_stay_tables_join_without_a_shuffle(spark, large_joins, name):
    df = E.queries()[name](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan
    # an exchange may stand above the joins (the aggregate by service) and feed broadcasts of small tables, never below a join of stays
    below = plan[plan.index("SortMergeJoin"):]
    assert not re.search(r"Exchange (hashpartitioning|RoundRobin)", below)
    assert df.count() > 0


def test_bucket_counts_follow_the_size(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="carestay-size-"), "t")
    spark.range(1000).write.parquet(path)
    assert IO.bucket_count(spark, path) == 8
    assert IO.bucket_count(spark, path, bytes_per_bucket=100) > 8
