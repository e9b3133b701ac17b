"""Registered dashboard and ad-hoc report queries (BI1-BI13, SRT1-SRT6,
AGG15, FLT9-FLT11) and the order rules (ORD1-ORD6)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from merchlens.functions import rules
from merchlens.operators import orders as O
from merchlens.operators import reports as R
from merchlens.plans import entities as E
from merchlens.plans.catalog import query
from merchlens.plans.oracle import PARTS, any_of, mean, with_ctes
from merchlens.sources import adapters

# Parameters of the documented ad-hoc queries on the test tables.
REPORT_STATE = "NATION_1"
REPORT_CUISINE = "Parts"
REPORT_SINCE = "1998-01-01"

P, S, RT, OPS = "merchant_performance", "cuisine_market_share", "cohort_retention", "delivery_operations"


@query("bi1_tier_distribution", with_ctes(
    f"select tier_label, performance_tier, count(*) as merchant_count from {P} group by 1, 2", P))
def bi1(spark, d):
    return R.tier_distribution(E.performance(spark, d))


@query("bi2_score_box_by_cuisine", with_ctes(
    f"select primary_cuisine, round(quantile_cont(composite_score, 0.0), 6) as score_min, "
    f"round(quantile_cont(composite_score, 0.25), 6) as score_q1, "
    f"round(quantile_cont(composite_score, 0.5), 6) as score_median, "
    f"round(quantile_cont(composite_score, 0.75), 6) as score_q3, "
    f"round(quantile_cont(composite_score, 1.0), 6) as score_max "
    f"from {P} group by 1", P))
def bi2(spark, d):
    return R.score_box_by_cuisine(E.performance(spark, d))


@query("bi3_elite_map", with_ctes(
    f"select business_id, business_name, latitude, longitude, primary_cuisine, total_reviews, "
    f"avg_review_stars, reviews_per_month from {P} where is_elite_merchant", P))
def bi3(spark, d):
    return R.elite_map(E.performance(spark, d))


@query("bi4_velocity_quadrants", with_ctes(
    f"""select p.business_id, p.reviews_per_month, p.avg_review_stars, p.performance_tier, p.total_checkins,
           round(m.mx, 6) as median_reviews_per_month, round(m.my, 6) as median_avg_review_stars,
           case when p.reviews_per_month < m.mx and p.avg_review_stars >= m.my then 'Rising Stars'
                when p.reviews_per_month >= m.mx and p.avg_review_stars >= m.my then 'Champions'
                when p.reviews_per_month >= m.mx and p.avg_review_stars < m.my then 'Fading'
                else 'Struggling' end as quadrant
    from {P} p, (select quantile_cont(reviews_per_month, 0.5) as mx,
                        quantile_cont(avg_review_stars, 0.5) as my from {P}) m""", P))
def bi4(spark, d):
    return R.velocity_quadrants(E.performance(spark, d))


@query("bi5_share_matrix_top_states", with_ctes(
    f"""select state, primary_cuisine, market_share_pct, merchant_count from {S}
    where state in (select state from {S} group by 1
                    order by max(total_merchants_in_state) desc, state limit 10)""", S))
def bi5(spark, d):
    return R.share_matrix(E.market_share(spark, d))


@query("bi6_cuisine_volume_quality", with_ctes(
    f"select primary_cuisine, cast(sum(merchant_count) as bigint) as merchant_count, "
    f"round({mean('avg_composite_score')}, 4) as avg_composite_score, round({mean('avg_stars')}, 2) as avg_stars "
    f"from {S} group by 1", S))
def bi6(spark, d):
    return R.cuisine_volume_quality(E.market_share(spark, d))


@query("bi7_recent_retention", with_ctes(
    f"""select cohort_month, cohort_label, months_since_cohort, retention_rate_pct,
           20.0::double as reference_pct from {RT}
    where cohort_month in (select distinct cohort_month from {RT} order by 1 desc limit 6)""", RT))
def bi7(spark, d):
    return R.recent_retention(E.retention(spark, d))


@query("bi8_elite_by_cuisine", with_ctes(
    f"select primary_cuisine, cast(sum(merchant_count) as bigint) as merchant_count, "
    f"round({mean('elite_merchant_share')}, 4) as elite_merchant_share from {S} group by 1", S))
def bi8(spark, d):
    return R.elite_by_cuisine(E.market_share(spark, d))


@query("bi9_fulfillment_by_tier", with_ctes(
    f"""select tier_label, r as avg_fulfillment_rate,
           case when r < 0.9 then 'low' when r >= 0.96 then 'high' else 'mid' end as band,
           0.95::double as target
    from (select tier_label, round({mean('fulfillment_rate')}, 4) as r from {OPS} group by 1)""", OPS))
def bi9(spark, d):
    return R.fulfillment_by_tier(E.delivery_ops(spark, d))


@query("bi10_on_time_by_weekday", with_ctes(
    f"select order_day_of_week, round({mean('on_time_rate')}, 4) as avg_on_time_rate from {OPS} group by 1", OPS))
def bi10(spark, d):
    return R.on_time_by_weekday(E.delivery_ops(spark, d))


@query("bi11_gmv_by_cuisine", with_ctes(
    f"select primary_cuisine, round(cast(sum(cast(total_gmv_usd as decimal(38,2))) as double), 2) as total_gmv_usd, "
    f"round({mean('avg_order_value_usd')}, 2) as avg_order_value_usd from {OPS} group by 1", OPS))
def bi11(spark, d):
    return R.gmv_by_cuisine(E.delivery_ops(spark, d))


@query("bi12_delivery_histogram", with_ctes(
    f"select floor(avg_delivery_min / 2.0) * 2.0 as bin_start_min, performance_tier, count(*) as rows "
    f"from {OPS} where avg_delivery_min is not null group by 1, 2", OPS))
def bi12(spark, d):
    return R.delivery_histogram(E.delivery_ops(spark, d))


@query("bi13_monthly_gmv_top_cuisines", with_ctes(
    f"""select order_month, primary_cuisine,
           round(cast(sum(cast(total_gmv_usd as decimal(38,2))) as double), 2) as total_gmv_usd
    from {OPS}
    where primary_cuisine in (select primary_cuisine from {OPS} group by 1
                              order by sum(cast(total_gmv_usd as decimal(38,2))) desc, primary_cuisine
                              limit 5)
    group by 1, 2""", OPS))
def bi13(spark, d):
    return R.monthly_gmv_top_cuisines(E.delivery_ops(spark, d))


# ---------------------------------------------------------------- ad hoc

@query("srt1_retention_ordered", with_ctes(f"select * from {RT} order by cohort_month, months_since_cohort", RT))
def srt1(spark, d):
    return E.retention(spark, d).orderBy("cohort_month", "months_since_cohort")


@query("srt2_state_top100", with_ctes(
    f"select business_id, business_name, composite_score from {P} where state = '{REPORT_STATE}' "
    f"order by composite_score desc nulls last, business_id limit 100", P))
def srt2(spark, d):
    return R.state_top_merchants(E.performance(spark, d), REPORT_STATE, 100)


@query("srt3_state_cuisine_ordered", with_ctes(
    f"select business_id, business_name, composite_score, reviews_per_month from {P} "
    f"where state = '{REPORT_STATE}' and primary_cuisine = '{REPORT_CUISINE}' "
    f"order by composite_score desc nulls last, business_id", P))
def srt3(spark, d):
    return R.state_cuisine_merchants(E.performance(spark, d), REPORT_STATE, REPORT_CUISINE)


@query("srt7_weekday_and_tier_order", with_ctes(
    f"""select *, row_number() over (order by list_position(['Monday','Tuesday','Wednesday','Thursday','Friday','Saturday','Sunday'], order_day_of_week),
                                  performance_tier desc) as place
    from (select order_day_of_week, performance_tier, count(*) as n from {OPS} group by all)""", OPS))
def srt7(spark, d):
    """Weekdays from Monday, tiers from the highest; ``place`` numbers the few grouped rows in that order."""
    few = E.delivery_ops(spark, d).groupBy("order_day_of_week", "performance_tier").agg(F.count(F.lit(1)).alias("n"))
    day = F.array_position(F.lit(list(rules.WEEKDAYS)), F.col("order_day_of_week"))
    return few.withColumn("place", F.row_number().over(Window.orderBy(day, F.desc("performance_tier"))).cast("long")).orderBy("place")


@query("srt4_top10_states_merchants", with_ctes(
    f"""select * from {P} where state in (select state from {P} group by 1
                                          order by count(*) desc, state limit 10)""", P))
def srt4(spark, d):
    return R.top_groups(E.performance(spark, d), "state", F.count(F.lit(1)), 10)


@query("srt5_top5_cuisines_operations", with_ctes(
    f"""select * from {OPS} where primary_cuisine in (select primary_cuisine from {OPS} group by 1
                                          order by count(*) desc, primary_cuisine limit 5)""", OPS))
def srt5(spark, d):
    return R.top_groups(E.delivery_ops(spark, d), "primary_cuisine", F.count(F.lit(1)), 5)


@query("srt6_last6_cohorts", with_ctes(
    f"select * from {RT} where cohort_month in "
    f"(select distinct cohort_month from {RT} order by 1 desc limit 6)", RT))
def srt6(spark, d):
    return R.last_groups(E.retention(spark, d), "cohort_month", 6)


@query("agg15_state_cuisine_drill", with_ctes(
    f"select state, primary_cuisine, count(*) as merchant_count, round({mean('composite_score')}, 4) as avg_composite_score "
    f"from {P} where state = '{REPORT_STATE}' group by 1, 2 order by 3 desc, 2", P))
def agg15(spark, d):
    return R.state_cuisine_drill(E.performance(spark, d), REPORT_STATE)


@query("flt10_state_month_operations", with_ctes(
    f"select * from {OPS} where state = '{REPORT_STATE}' and order_month >= date '{REPORT_SINCE}'", OPS))
def flt10(spark, d):
    return R.state_recent_operations(E.delivery_ops(spark, d), REPORT_STATE, REPORT_SINCE)


@query("flt11_dashboard_filters", with_ctes(
    f"select * from {P} where primary_cuisine = '{REPORT_CUISINE}' and is_open = true "
    f"and is_elite_merchant = false", P))
def flt11(spark, d):
    return R.dashboard_filter(E.performance(spark, d), cuisine=REPORT_CUISINE, is_open=True, elite=False)


# ---------------------------------------------------------------- orders

@query("ord1_food_merchant_ids", with_ctes(
    f"select business_id from raw_businesses where "
    f"{any_of('coalesce(categories, \'\')', PARTS)}", "raw_businesses"))
def ord1(spark, d):
    E.prepare(spark)
    return O.food_merchant_ids(adapters.raw_businesses(spark, d), rules.PART_KEYWORDS)


@query("ord2_calendar", """
    select o_orderkey, cast(o_orderdate as date) as order_date, cast(hour(o_orderdate) as integer) as order_hour,
           dayname(o_orderdate) as order_day_of_week
    from orders""")
def ord2(spark, d):
    o = adapters.table(E.prepare(spark), d, "orders")
    return o.select("o_orderkey", *[c.alias(n) for n, c in O.calendar("o_orderdate").items()])


@query("ord3_actual_minutes", """
    select concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey,
                     cast(round(l_extendedprice * 100) as bigint)) as order_id,
           case when l_returnflag <> 'R' then greatest(10, 35 + (cast(l_quantity as integer) - 35) - 20) end
               as actual_delivery_min
    from lineitem""")
def ord3(spark, d):
    li = adapters.table(E.prepare(spark), d, "lineitem")
    status = F.when(F.col("l_returnflag") == "R", "cancelled").otherwise("delivered")
    return li.select(
        adapters.order_key().alias("order_id"),
        O.actual_minutes(F.lit(35), F.col("l_quantity").cast("int") - 35 - 20, status)
        .alias("actual_delivery_min"))


@query("ord4_on_time", """
    select concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey,
                     cast(round(l_extendedprice * 100) as bigint)) as order_id,
           case when l_returnflag <> 'R' then (cast(l_quantity as integer) - 35) <= 5 end as is_on_time
    from lineitem""")
def ord4(spark, d):
    li = adapters.table(E.prepare(spark), d, "lineitem")
    status = F.when(F.col("l_returnflag") == "R", "cancelled").otherwise("delivered")
    return li.select(
        adapters.order_key().alias("order_id"),
        O.on_time(F.col("l_quantity").cast("int") - 35, status).alias("is_on_time"))


@query("ord5_clip_money", """
    select concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey,
                     cast(round(l_extendedprice * 100) as bigint)) as order_id,
           round(least(greatest(l_extendedprice / 1000.0, 8.0), 120.0), 2) as order_total_usd
    from lineitem""")
def ord5(spark, d):
    li = adapters.table(E.prepare(spark), d, "lineitem")
    return li.select(
        adapters.order_key().alias("order_id"),
        O.clip_money(F.col("l_extendedprice") / F.lit(1000.0)).alias("order_total_usd"))


@query("ord6_order_qa", with_ctes(
    f"""select min(order_date) as min_order_date, max(order_date) as max_order_date,
           count(distinct business_id) as unique_merchants,
           avg(case when order_status = 'cancelled' then 1.0::double else 0.0::double end) as cancel_share,
           round({mean('cast(order_total_usd as double)')}, 2) as avg_order_total,
           avg(case when order_status = 'delivered' then cast(is_on_time as double) end) as on_time_share,
           avg(case when order_status = 'delivered' then cast(actual_delivery_min as double) end)
               as avg_delivery_min
    from stg_orders""", "stg_orders"))
def ord6(spark, d):
    return O.order_qa(E.orders(spark, d))
