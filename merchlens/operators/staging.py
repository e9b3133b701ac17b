"""Silver models: clean, typed, filtered entities (MOD1-MOD5)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merchlens.functions import rules
from merchlens.functions.columns import (
    dow0,
    keyword_any,
    month_start,
    sentiment_bucket,
    taxonomy,
)

_LINEAGE = ("_ingested_at", "_batch_date")


def _lineage_cols(df: DataFrame) -> list:
    return [F.col(c) for c in _LINEAGE if c in df.columns]


def stage_businesses(
    df: DataFrame,
    keywords: Sequence[str] | None = rules.FOOD_KEYWORDS,
    rule_list: Sequence[tuple[str, Sequence[str]]] = rules.CUISINE_RULES,
    default: str | None = rules.CUISINE_DEFAULT,
) -> DataFrame:
    """MOD1 (and MOD2 with ``keywords=None``, the dev rules and
    ``default=None`` = pass the category text through).

    Trim/upper/cast, keep rows with coordinates, a 1..5 rating and a positive
    review count, optionally only those whose categories hold a keyword, and
    label the primary cuisine by the ordered rule list.
    """
    cleaned = df.select(
        F.col("business_id"),
        F.trim("name").alias("business_name"),
        F.trim("address").alias("address"),
        F.trim("city").alias("city"),
        F.upper(F.trim("state")).alias("state"),
        F.col("postal_code"),
        F.col("latitude").cast("double").alias("latitude"),
        F.col("longitude").cast("double").alias("longitude"),
        F.col("stars").cast("double").alias("stars"),
        F.col("review_count").cast("int").alias("review_count"),
        F.col("is_open").cast("boolean").alias("is_open"),
        F.trim("categories").alias("categories_raw"),
        *_lineage_cols(df),
    )
    cond = (
        F.col("latitude").isNotNull()
        & F.col("longitude").isNotNull()
        & F.col("stars").between(1.0, 5.0)
        & (F.col("review_count") > 0)
    )
    if keywords:
        cond = cond & keyword_any(F.col("categories_raw"), keywords)
    dflt = F.col("categories_raw") if default is None else default
    return cleaned.filter(cond).withColumn(
        "primary_cuisine", taxonomy(F.col("categories_raw"), rule_list, dflt)
    )


def stage_reviews(df: DataFrame, min_date: str | None = rules.REVIEW_MIN_DATE) -> DataFrame:
    """MOD3: typed reviews with month floor, year, month number and sentiment.

    ``min_date=None`` drops the floor (the development variant). The date
    column may be text with or without a time part, or a date/timestamp; a row whose date can't be read is dropped.
    """
    date_src = "review_date" if "review_date" in df.columns else "date"
    review_date = F.col(date_src).try_cast("date")
    out = df.select(
        F.col("review_id"),
        F.col("user_id"),
        F.col("business_id"),
        F.col("stars").cast("double").alias("review_stars"),
        F.col("useful").cast("int").alias("useful_votes"),
        F.col("funny").cast("int").alias("funny_votes"),
        F.col("cool").cast("int").alias("cool_votes"),
        review_date.alias("review_date"),
        month_start(review_date).alias("review_month"),
        F.year(review_date).alias("review_year"),
        F.month(review_date).alias("review_month_num"),
        sentiment_bucket(F.col("stars").cast("double")).alias("sentiment_bucket"),
        *_lineage_cols(df),
    )
    cond = (
        F.col("review_id").isNotNull()
        & F.col("business_id").isNotNull()
        & F.col("review_stars").between(1.0, 5.0)
        & F.col("review_date").isNotNull()
    )
    if min_date:
        cond = cond & (F.col("review_date") >= F.lit(min_date).cast("date"))
    return out.filter(cond)


def stage_checkins(events: DataFrame) -> DataFrame:
    """MOD4: check-in events counted per (business, date, month, year,
    weekday with Sunday = 0, hour). Partial aggregation runs before the
    shuffle, so a busy merchant is combined map-side."""
    ts = F.col("checkin_at")
    return (
        events.filter(ts.isNotNull())
        .groupBy(
            F.col("business_id"),
            ts.cast("date").alias("checkin_date"),
            month_start(ts).alias("checkin_month"),
            F.year(ts).alias("checkin_year"),
            dow0(ts).alias("day_of_week"),
            F.hour(ts).alias("hour_of_day"),
        )
        .agg(F.count(F.lit(1)).alias("checkin_count"))
    )


def stage_orders(df: DataFrame, money_as_decimal: bool = True) -> DataFrame:
    """MOD5: typed orders with month and year. Money is decimal(10,2) so sums
    are exact and independent of summation order."""
    money = "decimal(10,2)" if money_as_decimal else "double"
    return df.filter(F.col("order_id").isNotNull()).select(
        F.col("order_id"),
        F.col("business_id"),
        F.col("courier_id"),
        F.col("order_timestamp").cast("timestamp_ntz").alias("order_timestamp"),
        F.col("order_date").cast("date").alias("order_date"),
        month_start(F.col("order_date")).alias("order_month"),
        F.year(F.col("order_date").cast("date")).alias("order_year"),
        F.col("order_hour").cast("int").alias("order_hour"),
        F.col("order_day_of_week"),
        F.col("estimated_delivery_min").cast("int").alias("estimated_delivery_min"),
        F.col("actual_delivery_min").try_cast("int").alias("actual_delivery_min"),
        F.col("delivery_delta_min").try_cast("int").alias("delivery_delta_min"),
        F.col("is_on_time").try_cast("boolean").alias("is_on_time"),
        F.col("order_total_usd").cast(money).alias("order_total_usd"),
        F.col("delivery_fee_usd").cast(money).alias("delivery_fee_usd"),
        F.col("order_status"),
        F.col("_is_synthetic"),
    )
