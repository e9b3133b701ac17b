"""A third of all rows on one key: results stay exact and whole, and no
operator gathers the hot group into a single-partition exchange."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from merchlens.operators import marts as M
from merchlens.operators import staging as S
from merchlens.operators.ntile import dist_ntile, dist_rank, grouped_quantiles
from merchlens.session import cluster_conf

REV = "review_id long, user_id long, business_id long, stars double, useful long, funny long, cool long, " \
      "text string, date string"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_user_cohorts(spark):
    rnd = random.Random(3)
    rows = []
    for i in range(3000):
        user = 0 if i % 3 == 0 else rnd.randint(1, 400)       # user 0 writes a third of all reviews
        rows.append((i, user, user, 5.0, 0, 0, 0, "t", f"20{rnd.randint(10, 12)}-{rnd.randint(1, 12):02d}-15"))
    rev = S.stage_reviews(spark.createDataFrame(rows, REV), min_date=None)
    got = M.cohort_retention(rev)
    # brute force on the driver-side fixture
    months = {}
    for _, u, _, _, _, _, _, _, d in rows:
        months.setdefault(u, set()).add(d[:7])
    want = {}
    for u, ms in months.items():
        first = min(ms)
        for m in ms:
            off = (int(m[:4]) * 12 + int(m[5:7])) - (int(first[:4]) * 12 + int(first[5:7]))
            if off <= 24:
                want[(first, off)] = want.get((first, off), 0) + 1
    assert {(r.cohort_label, r.months_since_cohort): r.retained_users for r in got.collect()} == want
    assert "SinglePartition" not in _plan(got)


def test_hot_value_ntile_rank_quantiles(spark):
    rnd = random.Random(5)
    rows = [(i, 0.5 if i % 3 == 0 else rnd.random(), "HOT" if i % 3 == 0 else rnd.choice("ABCD"))
            for i in range(9000)]
    df = spark.createDataFrame(rows, "id long, s double, g string")
    t = dist_ntile(df, 5, ["s", "id"], ["g"], out_col="t", ranges=12)
    b = df.withColumn("t2", F.ntile(5).over(Window.partitionBy("g").orderBy("s", "id")))
    assert t.join(b, "id").filter("t != t2").count() == 0
    r = dist_rank(df, "s", ["g"], tiebreak="id", ranges=12)
    b = df.withColumn("r2", F.rank().over(Window.partitionBy("g").orderBy(F.col("s").desc())))
    assert r.join(b, "id").filter("rank != r2").count() == 0
    q = {x.g: x.q50 for x in grouped_quantiles(df, "s", [0.5], ["g"], ranges=12).collect()}
    assert q["HOT"] == 0.5
    for p in (_plan(t), _plan(r)):
        assert "SinglePartition" not in p


def test_cluster_conf_sizes_partitions():
    c = cluster_conf(100 << 40, total_cores=8000)
    assert int(c["spark.sql.shuffle.partitions"]) == 409600
    assert int(cluster_conf(1 << 20, total_cores=8)["spark.sql.shuffle.partitions"]) == 24
