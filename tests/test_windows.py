"""Distributed ntile / rank / quantiles equal the built-in window functions,
and their plans never move all rows into a single partition."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from merchlens.operators.ntile import dist_ntile, dist_rank, grouped_quantiles


@pytest.fixture(scope="module")
def data(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(6000):
        r = rnd.random()
        s = None if r < 0.1 else (0.5 if r < 0.45 else round(rnd.random(), 3))
        rows.append((i, s, rnd.choice(["A", "B", "C", None])))
    return spark.createDataFrame(rows, "id long, s double, g string")


@pytest.mark.parametrize("k", [5, 7])
@pytest.mark.parametrize("ranges", [None, 1, 15])
def test_dist_ntile_matches_builtin(spark, data, k, ranges):
    kw = {"ranges": ranges}
    a = dist_ntile(data, k, ["s", "id"], out_col="t", **kw)
    b = data.withColumn("t2", F.ntile(k).over(Window.orderBy(F.col("s").asc_nulls_last(), "id")))
    assert a.join(b, "id").filter("t != t2").count() == 0
    a = dist_ntile(data, k, ["s", "id"], ["g"], out_col="t", **kw)
    b = data.withColumn("t2", F.ntile(k).over(
        Window.partitionBy("g").orderBy(F.col("s").asc_nulls_last(), "id")))
    assert a.join(b, "id").filter("t != t2").count() == 0


@pytest.mark.parametrize("n", [0, 1, 3, 4, 11])
def test_dist_ntile_small_inputs(spark, data, n):
    d = data.filter(F.col("id") < n)
    got = sorted(r.t for r in dist_ntile(d, 5, ["s", "id"], out_col="t").collect())
    want = sorted(r.t for r in d.withColumn("t", F.ntile(5).over(
        Window.orderBy(F.col("s").asc_nulls_last(), "id"))).collect())
    assert got == want


def test_tiers_differ_by_at_most_one(spark, data):
    t = dist_ntile(data, 5, ["s", "id"], out_col="t").groupBy("t").count().collect()
    sizes = [r["count"] for r in t]
    assert max(sizes) - min(sizes) <= 1


def test_dist_rank_matches_builtin(spark, data):
    for kw in ({}, {"ranges": 20}):
        a = dist_rank(data, "s", ["g"], descending=True, tiebreak="id", out_col="r", **kw)
        b = data.withColumn("r2", F.rank().over(Window.partitionBy("g").orderBy(F.col("s").desc_nulls_last())))
        assert a.join(b, "id").filter("r != r2").count() == 0


def test_grouped_quantiles_match_percentile(spark, data):
    probs = [0.0, 0.25, 0.5, 0.9, 1.0]
    a = grouped_quantiles(data, "s", probs, ["g"], ranges=30)
    b = data.groupBy("g").agg(*[F.percentile("s", p).alias(f"b{i}") for i, p in enumerate(probs)])
    got = {r.g: r for r in a.collect()}
    for r in b.collect():
        for i, name in enumerate(["q0", "q25", "q50", "q90", "q100"]):
            assert got[r.g][name] == pytest.approx(r[f"b{i}"])


def test_quantiles_keep_all_null_groups(spark):
    df = spark.createDataFrame([("x", None), ("x", None), ("y", 1.0), ("y", 3.0)], "g string, v double")
    got = {r.g: r.q50 for r in grouped_quantiles(df, "v", [0.5], ["g"]).collect()}
    assert got == {"x": None, "y": 2.0}


@pytest.mark.parametrize("kind", ["date", "string", "decimal(10,3)", "double"])
@pytest.mark.parametrize("descending", [True, False])
def test_dist_rank_of_any_orderable_type(spark, data, kind, descending):
    value = F.date_add(F.lit("2020-01-01").cast("date"), (F.col("s") * 50).cast("int")) if kind == "date" else F.col("s").cast(kind)
    typed = data.withColumn("s", value)
    order = F.col("s").desc_nulls_last() if descending else F.col("s").asc_nulls_last()
    a = dist_rank(typed, "s", ["g"], descending=descending, tiebreak="id", out_col="r", ranges=12)
    b = typed.select("id", F.rank().over(Window.partitionBy("g").orderBy(order)).alias("r2"))
    assert a.join(b, "id").filter("r != r2").count() == 0 and a.count() == typed.count()


def test_empty_input(spark, data):
    none = data.limit(0)
    assert dist_ntile(none, 5, ["s", "id"], ["g"]).count() == 0 and dist_rank(none, "s", tiebreak="id").count() == 0
    assert grouped_quantiles(none, "s", [0.5], ["g"]).count() == 0


def test_no_window_over_all_rows(spark, data):
    for df in (dist_ntile(data, 5, ["s", "id"], ["g"], ranges=12), dist_rank(data, "s", ["g"], tiebreak="id", ranges=12)):
        assert "SinglePartition" not in df._jdf.queryExecution().executedPlan().toString()
    # without groups only the counts per range, one row each, meet in one task
    plan = dist_ntile(data, 5, ["s", "id"], ranges=12)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange SinglePartition") == 1 and "Exchange SinglePartition" in plan.split("HashAggregate")[0]
