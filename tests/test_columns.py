"""Column helpers against the semantics table."""

import datetime as dt

from pyspark.sql import functions as F

from merchlens.functions import columns as C
from merchlens.functions import rules


def one(spark, expr, schema, row):
    return spark.createDataFrame([row], schema).select(expr.alias("x")).first()["x"]


def test_months_diff_counts_boundaries(spark):
    # Q3: Jan 31 -> Feb 1 crosses one month boundary
    assert one(spark, C.months_diff("a", "b"), "a date, b date",
               (dt.date(2020, 1, 31), dt.date(2020, 2, 1))) == 1
    assert one(spark, C.months_diff("a", "b"), "a date, b date",
               (dt.date(2020, 1, 1), dt.date(2020, 1, 31))) == 0
    assert one(spark, C.months_diff("a", "b"), "a date, b date",
               (dt.date(2019, 11, 15), dt.date(2021, 2, 1))) == 15


def test_round_dp_rounds_binary_value(spark):
    # Q8: 10.075 is stored slightly below, so it rounds down like the SQL engine
    assert one(spark, C.round_dp("x", 2), "x double", (10.075,)) == 10.07
    assert one(spark, C.round_dp("x", 0), "x double", (2.5,)) == 3.0
    assert one(spark, C.round_dp("x", 4), "x double", (0.03125,)) == 0.0313


def test_dow0_sunday_is_zero(spark):
    # Q5: 2024-01-07 is a Sunday
    assert one(spark, C.dow0("t"), "t timestamp", (dt.datetime(2024, 1, 7, 12),)) == 0
    assert one(spark, C.dow0("t"), "t timestamp", (dt.datetime(2024, 1, 6, 12),)) == 6


def test_sentiment_bucket_edges(spark):
    df = spark.createDataFrame([(4.0,), (5.0,), (3.0,), (3.5,), (1.0,), (None,)], "s double")
    got = [r.b for r in df.select(C.sentiment_bucket("s").alias("b")).collect()]
    assert got == ["positive", "positive", "neutral", "negative", "negative", "negative"]


def test_taxonomy_rule_order_and_substrings(spark):
    df = spark.createDataFrame([("Sushi, Pizza",), ("Barbers, Food",), ("Bars",), ("Hardware",), (None,)],
                               "c string")
    got = [r.k for r in df.select(C.taxonomy("c", rules.CUISINE_RULES).alias("k")).collect()]
    # rule order wins over text order; 'bar' matches inside 'Barbers'
    assert got == ["Pizza", "Bars & Grills", "Other", "Other", "Other"]
    dev = [r.k for r in df.select(C.taxonomy("c", rules.DEV_CUISINE_RULES, F.col("c")).alias("k")).collect()]
    assert dev == ["Pizza", "Barbers, Food", "Bars", "Hardware", None]


def test_every_arm_of_the_taxonomies(spark):
    for arms in (rules.CUISINE_RULES, rules.DEV_CUISINE_RULES):
        df = spark.createDataFrame([(i, " ".join(words).upper()) for i, (_, words) in enumerate(arms)], "i int, c string")
        got = {r.i: r.k for r in df.select("i", C.taxonomy("c", arms).alias("k")).collect()}
        assert got == {i: label for i, (label, _) in enumerate(arms)}
    df = spark.createDataFrame([(w,) for w in rules.FOOD_KEYWORDS], "c string")
    assert df.filter(C.keyword_any("c", rules.FOOD_KEYWORDS)).count() == 16 and len(rules.ORDER_FOOD_KEYWORDS) == 15


def test_keyword_any_drops_null_text(spark):
    df = spark.createDataFrame([("Pizza Place",), ("Hardware",), (None,)], "c string")
    assert df.filter(C.keyword_any("c", rules.FOOD_KEYWORDS)).count() == 1
    assert df.filter(C.keyword_any(F.coalesce("c", F.lit("")), rules.FOOD_KEYWORDS)).count() == 1


def test_flag_safe_ratio_clamp(spark):
    df = spark.createDataFrame([(None, 0, 3), (True, 4, 12), (False, 2, 50)], "p boolean, n int, x int")
    rows = df.select(C.flag(F.col("p")).alias("f"), C.safe_ratio(F.lit(1), "n").alias("r"),
                     C.clamp("x", 10, 40).alias("c")).collect()
    assert [r.f for r in rows] == [False, True, False]
    assert rows[0].r is None and rows[1].r == 0.25
    assert [r.c for r in rows] == [10, 12, 40]


def test_exact_mean_is_order_independent(spark):
    vals = [0.27805, 0.1, 0.2, 0.3, 0.45555, 0.00001]
    a = spark.createDataFrame([(v,) for v in vals], "x double").repartition(3)
    b = spark.createDataFrame([(v,) for v in reversed(vals)], "x double").coalesce(1)
    ma = a.agg(C.exact_mean("x").alias("m")).first().m
    mb = b.agg(C.exact_mean("x").alias("m")).first().m
    assert ma == mb


def test_labels_and_ranks(spark):
    df = spark.createDataFrame([(5,), (1,), (3,)], "t int")
    assert [r.l for r in df.select(C.tier_label("t").alias("l")).collect()] == ["Elite", "Low", "Average"]
    d = spark.createDataFrame([("Sunday",), ("Monday",)], "d string")
    assert [r.r for r in d.select(C.weekday_rank("d").alias("r")).collect()] == [7, 1]


def test_rounding_equals_round_without_its_decimals(spark):
    near = [0.5, 1.5, 2.5, 0.49999999999999994, 8419704.000000001, 8419703.5, 2.0 ** 51 + 0.5, 1.0, 0.0, 5e-324]
    df = spark.createDataFrame([(v * s,) for v in near for s in (1, -1)] + [(None,)], "x double")
    for r in df.select(C.round_long(F.col("x")).alias("got"), F.round("x").cast("long").alias("want")).collect():
        assert r.got == r.want
    wide = df.union(spark.createDataFrame([(float(v),) for v in ("1e300", "-1e17", "4503599627370497", "nan", "inf", "-inf")], "x double"))
    rounded = wide.select("x", *[C.round_dp("x", n).alias(f"got{n}") for n in (0, 2, 4)],
                          *[(F.round(F.col("x") * F.lit(float(10 ** n))) / F.lit(float(10 ** n))).alias(f"want{n}") for n in (0, 2, 4)])
    for r in rounded.collect():
        assert all(repr(r[f"got{n}"]) == repr(r[f"want{n}"]) for n in (0, 2, 4)), r
    plan = df.select(C.round_dp("x", 2))._jdf.queryExecution().toString()
    assert "round(" not in plan
