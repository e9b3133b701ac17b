"""Adapter from the driver's test tables to the raw entities the models read.

Each function reads whole Parquet tables and derives the entity with column
rules only, so its work grows with the tables:

* businesses  <- customer x nation x part (the part name is the category text)
* reviews     <- orders (user and business = the ordering customer)
* check-ins   <- events (business = user_id, time = ts)
* orders      <- lineitem x orders (one order per line item)

The same rules are written as SQL in ``merchlens.plans.oracle`` for the
independent check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from merchlens.functions.columns import round_long, weekday_name
from merchlens.operators.orders import actual_minutes, on_time

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def raw_businesses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Business documents (bronze shape, ids as long)."""
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size")
    frac = (F.col("c_custkey") % 100).cast("double") / F.lit(100.0)
    return (
        c.join(n, c.c_nationkey == n.n_nationkey, "left")
        .join(p, c.c_custkey == p.p_partkey, "left")
        .select(
            F.col("c_custkey").alias("business_id"),
            F.col("c_name").alias("name"),
            F.lit(None).cast("string").alias("address"),
            F.col("n_name").alias("city"),
            F.col("n_name").alias("state"),
            F.lpad(F.col("c_nationkey").cast("string"), 5, "0").alias("postal_code"),
            (F.lit(18.0) + F.col("n_nationkey") * 2 + frac).alias("latitude"),
            (F.lit(-70.0) - F.col("n_nationkey") * 4 - frac).alias("longitude"),
            (F.lit(1.0) + (F.col("c_custkey") % 9).cast("double") * F.lit(0.5)).alias("stars"),
            F.col("p_size").cast("long").alias("review_count"),
            F.when(F.col("c_acctbal") > 0, F.lit(1)).otherwise(F.lit(0)).alias("is_open"),
            F.col("p_name").alias("categories"),
        )
    )


def raw_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Review documents; stars = 6 - priority digit, date kept as text."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("review_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_custkey").alias("business_id"),
        (F.lit(6) - F.substring("o_orderpriority", 1, 1).cast("int")).cast("double").alias("stars"),
        F.lit(0).cast("long").alias("useful"),
        F.lit(0).cast("long").alias("funny"),
        F.lit(0).cast("long").alias("cool"),
        F.col("o_orderstatus").alias("text"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("date"),
        # already parsed: staging reads it instead of re-parsing the text
        F.col("o_orderdate").cast("date").alias("review_date"),
    )


def checkin_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per check-in event (the exploded bronze shape)."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("user_id").alias("business_id"),
        F.col("ts").alias("checkin_at"),
    )


def raw_checkin_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Check-in documents in the source's shape: business_id plus a
    comma-separated list of stamps. One document per (business, day): long lists, and bounded by a day
    of one merchant, not by its whole history."""
    e = checkin_events(spark, sf_dir)
    return e.groupBy("business_id", F.col("checkin_at").cast("date").alias("__day")).agg(
        F.array_join(
            F.sort_array(F.collect_list(F.date_format("checkin_at", "yyyy-MM-dd HH:mm:ss"))),
            ", ",
        ).alias("date")
    ).drop("__day")


def order_key():
    """Line-item key: (order, line, part, supplier) plus the price in cents,
    which together are unique in the test tables at every scale."""
    return F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                       round_long(F.col("l_extendedprice") * 100))


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order events: one per line item, cancelled when the return flag is R.

    Delivery: estimate 35 min, delta = quantity - 35, actual = max(10, est +
    delta). Value = extended price / 1000 in cents rounded half up, clamped
    to 8..120 USD; fee = tax x 100 USD. Integer cents keep both engines exact.
    """
    li = table(spark, sf_dir, "lineitem")
    # order-level fields are derived once per order, before the join fans
    # each order out to its line items
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate",
        F.col("o_orderdate").cast("date").alias("__odate"),
        F.hour("o_orderdate").alias("__ohour"),
        weekday_name("o_orderdate").alias("__odow"),
    )
    j = li.join(o, li.l_orderkey == o.o_orderkey, "inner")
    cancelled = F.col("l_returnflag") == "R"
    status = F.when(cancelled, F.lit("cancelled")).otherwise(F.lit("delivered"))
    est = F.lit(35)
    delta = F.col("l_quantity").cast("int") - est
    price_cents = round_long(F.col("l_extendedprice") * 100)
    total_cents = F.least(F.greatest(F.floor((price_cents + 500) / 1000).cast("long"), F.lit(800)),
                          F.lit(12000))
    fee_cents = round_long(F.col("l_tax") * 10000)
    return j.select(
        order_key().alias("order_id"),
        F.col("o_custkey").alias("business_id"),
        F.concat(F.lit("COURIER_"), F.lpad(F.col("l_suppkey").cast("string"), 5, "0")).alias("courier_id"),
        F.col("o_orderdate").alias("order_timestamp"),
        F.col("__odate").alias("order_date"),
        F.col("__ohour").alias("order_hour"),
        F.col("__odow").alias("order_day_of_week"),
        est.alias("estimated_delivery_min"),
        actual_minutes(est, delta, status).alias("actual_delivery_min"),
        F.when(~cancelled, delta).alias("delivery_delta_min"),
        on_time(delta, status).alias("is_on_time"),
        (total_cents.cast("double") / 100).alias("order_total_usd"),
        (fee_cents.cast("double") / 100).alias("delivery_fee_usd"),
        status.alias("order_status"),
        F.lit(True).alias("_is_synthetic"),
    )
