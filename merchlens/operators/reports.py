"""Dashboard chart data (BI1-BI13), documented ad-hoc queries (SRT2-SRT7,
AGG15, FLT9-FLT11) and top-group helpers. Drawing is not built: each
function returns the rows a chart needs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchlens.functions import rules
from merchlens.functions.columns import bin_floor, exact_mean, round_dp, tier_rank, weekday_rank
from merchlens.operators.marts import with_one_row
from merchlens.operators.ntile import column_quantiles, grouped_quantiles

# chart data precision (rates and scores, money and stars, quantiles)
RATE_DP, MONEY_DP, QUANTILE_DP = 4, 2, 6


# ------------------------------------------------------------- top groups

def top_groups(df: DataFrame, key: str | Sequence[str], measure: Column, n: int,
               ascending: bool = False) -> DataFrame:
    """Keep the rows of the ``n`` groups with the largest (or smallest)
    measure; ties broken by the key. The ranking runs on the aggregated
    groups table (one row per group) and is applied with a left-semi join."""
    keys = [key] if isinstance(key, str) else list(key)
    g = df.groupBy(*keys).agg(measure.alias("__m"))
    order = [F.col("__m").asc() if ascending else F.col("__m").desc()] + [F.col(k).asc() for k in keys]
    top = g.orderBy(*order).limit(n).select(*keys)
    return df.join(top, keys, "left_semi")


def last_groups(df: DataFrame, key: str, n: int) -> DataFrame:
    """SRT6: rows of the ``n`` largest key values (e.g. the last 6 months)."""
    top = df.select(key).distinct().orderBy(F.col(key).desc()).limit(n)
    return df.join(top, key, "left_semi")


def order_by_rank(df: DataFrame, rank: Column, *more: Column | str) -> DataFrame:
    """SRT7: custom order given by a mapped rank (e.g. Elite..Low, Mon..Sun)."""
    return df.orderBy(rank, *more)


# ------------------------------------------------------- merchant tab

def tier_distribution(perf: DataFrame) -> DataFrame:
    """BI1: merchants per tier label, Elite first."""
    g = perf.groupBy("tier_label", "performance_tier").agg(F.count(F.lit(1)).alias("merchant_count"))
    return order_by_rank(g, tier_rank(F.col("tier_label")))


def score_box_by_cuisine(perf: DataFrame) -> DataFrame:
    """BI2: five-number summary of the composite score per cuisine, by median
    descending (exact quantiles, distributed)."""
    names = ["score_min", "score_q1", "score_median", "score_q3", "score_max"]
    q = grouped_quantiles(perf, "composite_score", [0.0, 0.25, 0.5, 0.75, 1.0], ["primary_cuisine"],
                          names=names)
    q = q.select("primary_cuisine", *[round_dp(n, QUANTILE_DP).alias(n) for n in names])
    return q.orderBy(F.col("score_median").desc_nulls_last(), "primary_cuisine")


def elite_map(perf: DataFrame) -> DataFrame:
    """BI3: elite merchants with coordinates and tooltip metrics."""
    return perf.filter(F.col("is_elite_merchant")).select(
        "business_id", "business_name", "latitude", "longitude", "primary_cuisine",
        "total_reviews", "avg_review_stars", "reviews_per_month")


def velocity_quadrants(perf: DataFrame) -> DataFrame:
    """BI4: median split of review velocity (x) and stars (y); a value equal to its median counts as high. The medians are
    one row of exact distributed quantiles, found in one pass and joined to every row."""
    both = with_one_row(perf, column_quantiles(perf, {"reviews_per_month": {"__mx": 0.5}, "avg_review_stars": {"__my": 0.5}}))
    hx = F.col("reviews_per_month") >= F.col("__mx")
    hy = F.col("avg_review_stars") >= F.col("__my")
    quad = (F.when(~hx & hy, "Rising Stars").when(hx & hy, "Champions")
            .when(hx & ~hy, "Fading").otherwise("Struggling"))
    return both.select(
        "business_id", "reviews_per_month", "avg_review_stars", "performance_tier", "total_checkins",
        round_dp(F.col("__mx"), QUANTILE_DP).alias("median_reviews_per_month"),
        round_dp(F.col("__my"), QUANTILE_DP).alias("median_avg_review_stars"),
        quad.alias("quadrant"))


# ------------------------------------------------------ market tab

def share_matrix(share: DataFrame, n_states: int = 10) -> DataFrame:
    """BI5: state x cuisine share (long form) for the top states by merchants."""
    top = top_groups(share, "state", F.max("total_merchants_in_state"), n_states)
    return top.select("state", "primary_cuisine", "market_share_pct", "merchant_count")


def share_matrix_wide(share: DataFrame, n_states: int = 10,
                      rule_list: Sequence = rules.CUISINE_RULES,
                      default: str = rules.CUISINE_DEFAULT) -> DataFrame:
    """BI5 as a pivot, one column per cuisine label. The columns come from
    the taxonomy's labels (a fixed, small list), so Spark never has to
    collect the distinct values of the data to plan the pivot."""
    labels = list(dict.fromkeys([lab for lab, _ in rule_list] + [default]))
    return share_matrix(share, n_states).groupBy("state").pivot("primary_cuisine", labels) \
        .agg(F.first("market_share_pct"))


def cuisine_volume_quality(share: DataFrame) -> DataFrame:
    """BI6: merchants, mean score and mean stars per cuisine, by volume."""
    return share.groupBy("primary_cuisine").agg(
        F.sum("merchant_count").cast("long").alias("merchant_count"),
        round_dp(exact_mean("avg_composite_score"), RATE_DP).alias("avg_composite_score"),
        round_dp(exact_mean("avg_stars"), MONEY_DP).alias("avg_stars"),
    ).orderBy(F.col("merchant_count").desc(), "primary_cuisine")


def recent_retention(ret: DataFrame, n_cohorts: int = 6) -> DataFrame:
    """BI7: retention curves of the last ``n_cohorts`` cohort months plus the
    20 % reference line."""
    return last_groups(ret, "cohort_month", n_cohorts).select(
        "cohort_month", "cohort_label", "months_since_cohort", "retention_rate_pct",
        F.lit(rules.RETENTION_REFERENCE_PCT).alias("reference_pct"))


def elite_by_cuisine(share: DataFrame) -> DataFrame:
    """BI8: merchants and mean elite share per cuisine."""
    return share.groupBy("primary_cuisine").agg(
        F.sum("merchant_count").cast("long").alias("merchant_count"),
        round_dp(exact_mean("elite_merchant_share"), RATE_DP).alias("elite_merchant_share"),
    )


# -------------------------------------------------- operations tab

def fulfillment_by_tier(ops: DataFrame) -> DataFrame:
    """BI9: mean fulfillment rate per tier (unweighted over rows) with the
    color band (< 90 % low, >= 96 % high) and the 95 % target."""
    g = ops.groupBy("tier_label").agg(
        round_dp(exact_mean("fulfillment_rate"), RATE_DP).alias("avg_fulfillment_rate"))
    r = F.col("avg_fulfillment_rate")
    return g.select(
        "tier_label", "avg_fulfillment_rate",
        F.when(r < rules.FULFILLMENT_LOW, "low").when(r >= rules.FULFILLMENT_HIGH, "high")
        .otherwise("mid").alias("band"),
        F.lit(rules.FULFILLMENT_TARGET).alias("target"),
    ).orderBy(tier_rank(F.col("tier_label")))


def on_time_by_weekday(ops: DataFrame) -> DataFrame:
    """BI10: mean on-time rate per weekday, Monday first."""
    g = ops.groupBy("order_day_of_week").agg(
        round_dp(exact_mean("on_time_rate"), RATE_DP).alias("avg_on_time_rate"))
    return order_by_rank(g, weekday_rank(F.col("order_day_of_week")))


def gmv_by_cuisine(ops: DataFrame) -> DataFrame:
    """BI11: total GMV (exact cents) and mean order value per cuisine."""
    return ops.groupBy("primary_cuisine").agg(
        round_dp(F.sum(F.col("total_gmv_usd").cast("decimal(38,2)")).cast("double"), MONEY_DP)
        .alias("total_gmv_usd"),
        round_dp(exact_mean("avg_order_value_usd"), MONEY_DP).alias("avg_order_value_usd"),
    )


def delivery_histogram(ops: DataFrame, width: float = rules.DELIVERY_BIN_MIN) -> DataFrame:
    """BI12: rows per 2-minute bin of mean delivery minutes, per tier."""
    return ops.filter(F.col("avg_delivery_min").isNotNull()).groupBy(
        bin_floor("avg_delivery_min", width).alias("bin_start_min"), "performance_tier"
    ).agg(F.count(F.lit(1)).alias("rows"))


def monthly_gmv_top_cuisines(ops: DataFrame, n: int = 5) -> DataFrame:
    """BI13: monthly GMV of the ``n`` cuisines with the largest total GMV."""
    money = F.col("total_gmv_usd").cast("decimal(38,2)")
    top = top_groups(ops, "primary_cuisine", F.sum(money), n)
    return top.groupBy("order_month", "primary_cuisine").agg(
        round_dp(F.sum(money).cast("double"), MONEY_DP).alias("total_gmv_usd"))


# --------------------------------------------- documented ad-hoc queries

def state_top_merchants(perf: DataFrame, state: str, n: int = 100) -> DataFrame:
    """SRT2 / FLT9: merchants of one state by score, top ``n`` (ties by id)."""
    return perf.filter(F.col("state") == state) \
        .orderBy(F.col("composite_score").desc_nulls_last(), "business_id").limit(n) \
        .select("business_id", "business_name", "composite_score")


def state_cuisine_merchants(perf: DataFrame, state: str, cuisine: str) -> DataFrame:
    """SRT3 / FLT9: one state and cuisine, by score (no limit)."""
    return perf.filter((F.col("state") == state) & (F.col("primary_cuisine") == cuisine)) \
        .orderBy(F.col("composite_score").desc_nulls_last(), "business_id") \
        .select("business_id", "business_name", "composite_score", "reviews_per_month")


def operations_of(ops: DataFrame, merchants: DataFrame) -> DataFrame:
    """JON8 + FLT9: operations rows of chosen merchants (a filtered merchant mart). The join goes over (state, business_id), so on operations that are
    laid out by state Spark prunes the states without such a merchant at run time."""
    chosen = merchants.select("state", "business_id", F.col("listing_stars"), F.col("composite_score"))
    return ops.join(chosen, ["state", "business_id"])


def state_recent_operations(ops: DataFrame, state: str, since: str) -> DataFrame:
    """FLT10: operations rows of one state from a month on."""
    return ops.filter((F.col("state") == state) & (F.col("order_month") >= F.lit(since).cast("date")))


def dashboard_filter(perf: DataFrame, state: str | None = None, cuisine: str | None = None,
                     is_open: bool | None = None, elite: bool | None = None) -> DataFrame:
    """FLT11: the dashboard filter bar (each filter optional)."""
    cond = F.lit(True)
    if state is not None:
        cond = cond & (F.col("state") == state)
    if cuisine is not None:
        cond = cond & (F.col("primary_cuisine") == cuisine)
    if is_open is not None:
        cond = cond & (F.col("is_open") == F.lit(is_open))
    if elite is not None:
        cond = cond & (F.col("is_elite_merchant") == F.lit(elite))
    return perf.filter(cond)


def state_cuisine_drill(perf: DataFrame, state: str) -> DataFrame:
    """AGG15: merchants and mean score per cuisine in one state, by count."""
    return perf.filter(F.col("state") == state).groupBy("state", "primary_cuisine").agg(
        F.count(F.lit(1)).alias("merchant_count"),
        round_dp(exact_mean("composite_score"), RATE_DP).alias("avg_composite_score"),
    ).orderBy(F.col("merchant_count").desc(), "primary_cuisine")
