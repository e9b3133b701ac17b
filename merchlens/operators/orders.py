"""Order-event rules (the data part of the order simulator)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchlens.functions import rules
from merchlens.functions.columns import (
    clamp,
    exact_mean,
    keyword_any,
    null_unless,
    round_dp,
    weekday_name,
)


def food_merchant_ids(businesses: DataFrame,
                      keywords: Iterable[str] = rules.ORDER_FOOD_KEYWORDS,
                      text_col: str = "categories") -> DataFrame:
    """ORD1: ids of merchants whose category text (NULL read as empty) holds
    any food keyword."""
    return businesses.filter(keyword_any(F.coalesce(F.col(text_col), F.lit("")), keywords)) \
        .select("business_id")


def calendar(ts: Column | str) -> dict[str, Column]:
    """ORD2: date, hour and weekday name of an order timestamp."""
    t = F.col(ts) if isinstance(ts, str) else ts
    return {
        "order_date": t.cast("date"),
        "order_hour": F.hour(t),
        "order_day_of_week": weekday_name(t),
    }


def actual_minutes(est: Column, delta: Column, status: Column) -> Column:
    """ORD3: max(10, est + delta), NULL when cancelled."""
    return null_unless(status != "cancelled",
                       clamp(est + delta, lo=rules.MIN_ACTUAL_DELIVERY_MIN))


def on_time(delta: Column, status: Column) -> Column:
    """ORD4: on time when the unclamped delta is at most 5; NULL when cancelled."""
    return null_unless(status != "cancelled", delta <= rules.ON_TIME_SLACK_MIN)


def clip_money(x: Column, lo: float = rules.ORDER_MIN_USD, hi: float = rules.ORDER_MAX_USD) -> Column:
    """ORD5: clip to [lo, hi] and round to cents."""
    return round_dp(clamp(x, lo, hi), 2)


def order_qa(orders: DataFrame) -> DataFrame:
    """ORD6: one-row QA summary of an order table (one distributed aggregate)."""
    delivered = F.col("order_status") == "delivered"
    return orders.agg(
        F.min("order_date").alias("min_order_date"),
        F.max("order_date").alias("max_order_date"),
        F.countDistinct("business_id").alias("unique_merchants"),
        F.avg(F.when(F.col("order_status") == "cancelled", 1.0).otherwise(0.0)).alias("cancel_share"),
        round_dp(exact_mean(F.col("order_total_usd").cast("double"), 2), 2).alias("avg_order_total"),
        F.avg(F.when(delivered, F.col("is_on_time").cast("double"))).alias("on_time_share"),
        F.avg(F.when(delivered, F.col("actual_delivery_min").cast("double"))).alias("avg_delivery_min"),
    )


__all__ = ["food_merchant_ids", "calendar", "actual_minutes", "on_time", "clip_money", "order_qa"]
