"""Bucketed tables, run-time partition pruning, clustered layouts, published versions and ranks from value counts, by their plans and files."""

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as ent
from merchlens.operators import reports as R
from merchlens.operators.ntile import column_quantiles, dist_rank
from merchlens.plans import entities as E
from merchlens.plans.diagnostics import layout_pruning, scan_metric, scanned_rows
from merchlens.session import scratch_path
from merchlens.sources import sinks
from tests.conftest import SF_MID, SF_SMALL


def final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("key", ["jon1_bucketed", "jon2_bucketed", "jon6_bucketed", "jon8_bucketed"])
def test_bucketed_joins_have_no_exchange(spark, no_broadcast, key):
    plan = final_plan(ent.queries()[key](spark, SF_SMALL))
    assert "SortMergeJoin" in plan and "Exchange" not in plan and "SelectedBucketsCount" in plan


def test_run_time_pruning_reads_fewer_files(spark):
    perf_at, path = scratch_path(spark, "t-dpp-perf"), scratch_path(spark, "t-dpp")
    sinks.write_table(E.performance(spark, SF_SMALL), perf_at)
    perf = spark.read.parquet(perf_at)
    ops = E.delivery_ops(spark, SF_SMALL, perf)
    sinks.write_layout(ops, path, "state", ["order_month"], tiebreak=["business_id"])
    back = sinks.read_back(spark, path, ops.schema)
    files = len(back.inputFiles())
    chosen = perf.filter((F.col("city") == "NATION_1") & F.col("is_elite_merchant"))
    joined = R.operations_of(back, chosen)
    assert "dynamicpruning" in joined._jdf.queryExecution().executedPlan().toString().lower()
    read = scan_metric(joined, "numFiles", "state")
    own = back.filter("state = 'NATION_1'")
    assert 0 < read < files / 4 and read <= len({f for f in back.inputFiles() if "state=NATION_1/" in f})
    assert joined.count() == own.join(chosen, "business_id", "left_semi").count() > 0


def test_cluster_order_and_bloom_filters_skip_rows(spark):
    d = layout_pruning(spark, SF_MID, "NATION_1", "Parts")
    assert d["state_cuisine_rows_returned"] <= d["state_cuisine_rows_scanned_partitioned_clustered"] < d["state_filter_rows_scanned_partitioned"] < d["state_filter_rows_scanned_flat"]
    df = spark.range(40000).select((F.col("id") * 2).cast("string").alias("business_id"), F.lit("PA").alias("state"), (F.col("id") % 3).cast("string").alias("primary_cuisine"))
    path = scratch_path(spark, "t-bloom")
    sinks.write_layout(df, path, "state", ["primary_cuisine"], tiebreak=["business_id"], num_partitions=12)
    back = sinks.read_back(spark, path, df.schema)
    assert back.count() == 40000
    assert scanned_rows(back.filter("business_id = '30001'")) == 0  # between the least and the largest id of each file, in none
    assert 0 < scanned_rows(back.filter("business_id = '30002'")) < 20000


def test_published_tables_are_replaced_without_a_gap(spark):
    path = scratch_path(spark, "t-published")
    assert sinks.current_version(spark, path) is None
    with pytest.raises(FileNotFoundError):
        sinks.read_published(spark, path)
    first, rows = sinks.publish(spark.range(10), path)
    old = sinks.read_published(spark, path)
    failing = spark.range(5).select(F.when(F.col("id") < 4, F.col("id")).otherwise(F.raise_error(F.lit("midway"))).cast("long").alias("id"))
    with pytest.raises(Exception, match="midway"):
        sinks.publish(failing, path)
    assert rows == 10 and sinks.current_version(spark, path) == first and old.count() == 10
    second, _ = sinks.publish(spark.range(3).withColumn("more", F.lit(1)), path)
    assert sinks.read_published(spark, path).columns == ["id", "more"] and old.count() == 10 == sinks.read_published(spark, path, first).count()
    assert sinks.drop_old_versions(spark, path) == 2
    assert sorted(f for f in os.listdir(path.removeprefix("file:")) if not f.startswith(".")) == ["_current", second]
    assert sinks.read_published(spark, path).count() == 3


def test_ranks_come_from_value_counts(spark, no_broadcast):
    """A value with a third of the rows is one entry; rows are shuffled once, for the join."""
    df = spark.range(9000).select("id", F.when(F.col("id") % 3 == 0, 7.5).otherwise((F.col("id") % 50).cast("double")).alias("s"), (F.col("id") % 2).alias("g"))
    ranked = dist_rank(df, "s", ["g"], ranges=6)
    plan = final_plan(ranked)
    got = {(r.g, r.s): r.rank for r in ranked.collect()}
    values = sorted(((r.g, r.s) for r in df.collect()), key=lambda x: -x[1])
    for (g, s), rank in got.items():
        assert rank == 1 + sum(a == g and b > s for a, b in values)
    assert "Window" in plan and ranked.count() == 9000


def test_quantiles_of_two_columns_in_one_pass(spark):
    df = spark.range(1001).select((F.col("id") * 1.0).alias("a"), F.when(F.col("id") < 100, F.col("id") * 2).alias("b"), (F.col("id") % 2).alias("g"))
    got = {r.g: (r.x, r.y, r.z) for r in column_quantiles(df, {"a": {"x": 0.5}, "b": {"y": 0.25, "z": 1.0}}, ["g"]).collect()}
    want = {r.g: (r.x, r.y, r.z) for r in df.groupBy("g").agg(F.percentile("a", 0.5).alias("x"), F.percentile("b", 0.25).alias("y"), F.max("b").cast("double").alias("z")).collect()}
    assert got == want
