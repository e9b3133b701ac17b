"""Registered small-operator queries: filters (FLT1-FLT8), conditionals
(CND1-CND10), joins (JON1-JON8), aggregates (AGG1-AGG14, AGG16), windows
(WIN1-WIN4) and scalar functions (FN1-FN26). Each reads whole tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from merchlens.functions import rules
from merchlens.functions import columns as C
from merchlens.operators import marts as M
from merchlens.operators import orders as O
from merchlens.operators.ntile import dist_ntile, dist_rank, grouped_quantiles
from merchlens.plans import entities as E
from merchlens.plans.catalog import query
from merchlens.plans import oracle as SQL
from merchlens.plans.oracle import with_ctes
from merchlens.sources import adapters, sinks

ID = "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, cast(round(l_extendedprice * 100) as bigint))"


def _t(spark, d, name):
    return adapters.table(E.prepare(spark), d, name)


def _oid():
    return adapters.order_key().alias("order_id")


# ------------------------------------------------------------------ filters

@query("flt1_required_not_null", with_ctes(
    "select review_id, business_id, review_date from raw_reviews_src "
    "where review_id is not null and business_id is not null and review_date is not null", "raw_reviews_src"))
def flt1(spark, d):
    r = adapters.raw_reviews(E.prepare(spark), d).withColumn("review_date", F.col("date").cast("date"))
    return r.dropna(subset=["review_id", "business_id", "review_date"]) \
        .select("review_id", "business_id", "review_date")


@query("flt2_rating_between", with_ctes(
    "select business_id, stars from raw_businesses where stars between 2.0 and 4.0", "raw_businesses"))
def flt2(spark, d):
    return adapters.raw_businesses(E.prepare(spark), d).filter(F.col("stars").between(2.0, 4.0)) \
        .select("business_id", "stars")


@query("flt3_positive_count", with_ctes(
    "select business_id, review_count from raw_businesses where review_count > 0", "raw_businesses"))
def flt3(spark, d):
    return adapters.raw_businesses(E.prepare(spark), d).filter(F.col("review_count") > 0) \
        .select("business_id", "review_count")


@query("flt4_min_date", with_ctes(
    "select review_id, review_date from stg_reviews_all where review_date >= date '1998-01-01'",
    "stg_reviews_all"))
def flt4(spark, d):
    return E.reviews_all(spark, d).filter(F.col("review_date") >= F.lit("1998-01-01").cast("date")) \
        .select("review_id", "review_date")


@query("flt5_keyword_any", with_ctes(
    f"select business_id, categories from raw_businesses where {SQL.any_of('categories', SQL.PARTS)}",
    "raw_businesses"))
def flt5(spark, d):
    return adapters.raw_businesses(E.prepare(spark), d) \
        .filter(C.keyword_any("categories", rules.PART_KEYWORDS)).select("business_id", "categories")


_FLT6_WORDS = ("ring", "gear", "anvil")


@query("flt6_keyword_any_null_as_empty", f"""
    select c.c_custkey as business_id from customer c left join part p on c.c_custkey = p.p_partkey
    where {SQL.any_of("coalesce(p.p_name, '')", ("ring", "gear", "anvil"))}""")
def flt6(spark, d):
    c = _t(spark, d, "customer")
    p = _t(spark, d, "part")
    j = c.join(p, c.c_custkey == p.p_partkey, "left").select(
        F.col("c_custkey").alias("business_id"), F.col("p_name").alias("categories"))
    return O.food_merchant_ids(j, _FLT6_WORDS)


@query("flt7_boolean_guard", with_ctes(
    "select order_id from stg_orders where _is_synthetic = true and is_on_time = true", "stg_orders"))
def flt7(spark, d):
    return E.orders(spark, d).filter((F.col("_is_synthetic") == F.lit(True)) &
                                     (F.col("is_on_time") == F.lit(True))).select("order_id")


@query("flt8_offset_range", with_ctes(
    "select * from user_months where months_since_cohort between 0 and 24", "user_months"))
def flt8(spark, d):
    return M.user_month_offsets(E.reviews_all(spark, d)) \
        .filter(F.col("months_since_cohort").between(0, 24))


# The published lists run over the documents' whole texts; arms that no text meets are in a unit test.

@query("flt5_published_keywords", f"select doc_id from documents where {SQL.any_of('text', SQL.FOOD)}")
def flt5_published(spark, d):
    return _t(spark, d, "documents").filter(C.keyword_any("text", rules.FOOD_KEYWORDS)).select("doc_id")


@query("flt6_published_keywords", f"select doc_id as business_id from documents where {SQL.any_of("coalesce(text, '')", SQL.ORDER_FOOD)}")
def flt6_published(spark, d):
    return O.food_merchant_ids(_t(spark, d, "documents").select(F.col("doc_id").alias("business_id"), F.col("text").alias("categories")), rules.ORDER_FOOD_KEYWORDS)


# ------------------------------------------------------------ conditionals

@query("cnd1_published_taxonomy", f"select doc_id, {SQL.first_match('text', SQL.CUISINES, "'Other'")} as cuisine from documents")
def cnd1_published(spark, d):
    return _t(spark, d, "documents").select("doc_id", C.taxonomy("text", rules.CUISINE_RULES, rules.CUISINE_DEFAULT).alias("cuisine"))


@query("cnd2_published_dev_taxonomy", f"select doc_id, {SQL.first_match('text', SQL.DEV_CUISINES, 'text')} as cuisine from documents")
def cnd2_published(spark, d):
    return _t(spark, d, "documents").select("doc_id", C.taxonomy("text", rules.DEV_CUISINE_RULES, F.col("text")).alias("cuisine"))


@query("cnd1_taxonomy_ordered_rules", f"""
    select p_partkey, p_name, {SQL.first_match('p_name', SQL.PART_KINDS, "'Other'")} as category from part""")
def cnd1(spark, d):
    p = _t(spark, d, "part")
    return p.select("p_partkey", "p_name", C.taxonomy("p_name", rules.PART_RULES, "Other").alias("category"))


@query("cnd2_taxonomy_raw_default", f"""
    select p_partkey, {SQL.first_match('p_name', SQL.DEV_PART_KINDS, 'p_name')} as category from part""")
def cnd2(spark, d):
    p = _t(spark, d, "part")
    return p.select("p_partkey", C.taxonomy("p_name", rules.PART_DEV_RULES, F.col("p_name")).alias("category"))


@query("cnd3_sentiment_bucket", """
    select o_orderkey as review_id,
           case when (6 - cast(substr(o_orderpriority, 1, 1) as integer)) / 2.0 + 1.0 >= 4 then 'positive'
                when (6 - cast(substr(o_orderpriority, 1, 1) as integer)) / 2.0 + 1.0 = 3 then 'neutral'
                else 'negative' end as sentiment_bucket
    from orders""")
def cnd3(spark, d):
    o = _t(spark, d, "orders")
    half_stars = (F.lit(6) - F.substring("o_orderpriority", 1, 1).cast("int")) / F.lit(2.0) + F.lit(1.0)
    return o.select(F.col("o_orderkey").alias("review_id"), C.sentiment_bucket(half_stars).alias("sentiment_bucket"))


@query("cnd4_tier_label", with_ctes(
    "select business_id, performance_tier, tier_label from merchant_performance", "merchant_performance"))
def cnd4(spark, d):
    return E.performance(spark, d).select("business_id", "performance_tier",
                                          C.tier_label("performance_tier").alias("tier_label"))


@query("cnd5_never_null_flags", with_ctes(
    "select business_id, case when positive_review_ratio > 0.5 then true else false end as mostly_positive "
    "from merchant_activity", "merchant_activity"))
def cnd5(spark, d):
    return E.activity(spark, d).select(
        "business_id", C.flag(F.col("positive_review_ratio") > 0.5).alias("mostly_positive"))


@query("cnd6_coalesce_defaults", with_ctes(
    "select business_id, total_reviews, avg_review_stars, total_checkins from merchant_activity",
    "merchant_activity"))
def cnd6(spark, d):
    return E.activity(spark, d).select("business_id", "total_reviews", "avg_review_stars", "total_checkins")


@query("cnd7_nullif_denominator", with_ctes(
    "select business_id, cast(sum(case when order_status = 'delivered' then 1 else 0 end) as double) "
    "/ nullif(cast(sum(case when order_status = 'cancelled' then 1 else 0 end) as double), 0) "
    "as delivered_per_cancelled from stg_orders group by 1", "stg_orders"))
def cnd7(spark, d):
    o = E.orders(spark, d)
    return o.groupBy("business_id").agg(
        (F.sum(F.when(F.col("order_status") == "delivered", 1).otherwise(0)).cast("double")
         / F.nullif(F.sum(F.when(F.col("order_status") == "cancelled", 1).otherwise(0)).cast("double"),
                    F.lit(0.0))).alias("delivered_per_cancelled"))


@query("cnd8_safe_ratio", with_ctes(
    "select business_id, positive_review_ratio from merchant_activity", "merchant_activity"))
def cnd8(spark, d):
    return E.activity(spark, d).select("business_id", "positive_review_ratio")


@query("cnd9_null_unless_status", with_ctes(
    "select order_id, actual_delivery_min, is_on_time, delivery_delta_min from stg_orders", "stg_orders"))
def cnd9(spark, d):
    return E.orders(spark, d).select("order_id", "actual_delivery_min", "is_on_time", "delivery_delta_min")


@query("cnd10_clamp", f"""
    select {ID} as order_id, greatest(cast(l_quantity as integer), 10) as clamped_low,
           least(greatest(cast(l_quantity as integer), 10), 40) as clamped_both
    from lineitem""")
def cnd10(spark, d):
    li = _t(spark, d, "lineitem")
    q = F.col("l_quantity").cast("int")
    return li.select(_oid(), C.clamp(q, lo=10).alias("clamped_low"), C.clamp(q, 10, 40).alias("clamped_both"))


# -------------------------------------------------------------------- joins

@query("jon1_left_join_review_agg", with_ctes(
    "select b.business_id, r.total_reviews, r.avg_review_stars "
    "from stg_businesses b left join review_facts_all r using (business_id)", "stg_businesses", "review_facts_all"))
def jon1(spark, d):
    r = M.review_aggregates(E.reviews_all(spark, d)).select("business_id", "total_reviews", "avg_review_stars")
    return E.businesses(spark, d).select("business_id").join(r, "business_id", "left")


@query("jon2_three_way_left_chain", with_ctes(
    "select b.business_id, r.total_reviews, c.total_checkins, c.peak_day_of_week "
    "from stg_businesses b left join review_facts_all r using (business_id) left join checkin_facts c using (business_id)",
    "stg_businesses", "review_facts_all", "checkin_facts"))
def jon2(spark, d):
    r = M.review_aggregates(E.reviews_all(spark, d)).select("business_id", "total_reviews")
    c = M.checkin_aggregates(E.checkins(spark, d)).select("business_id", "total_checkins", "peak_day_of_week")
    return E.businesses(spark, d).select("business_id").join(r, "business_id", "left") \
        .join(c, "business_id", "left")


@query("jon3_group_to_total", with_ctes(
    "select cs.state, cs.primary_cuisine, cs.n, st.total from "
    "(select state, primary_cuisine, count(*) as n from stg_businesses group by 1, 2) cs "
    "join (select state, count(*) as total from stg_businesses group by 1) st using (state)", "stg_businesses"))
def jon3(spark, d):
    b = E.businesses(spark, d)
    cs = b.groupBy("state", "primary_cuisine").agg(F.count(F.lit(1)).alias("n"))
    st = b.groupBy("state").agg(F.count(F.lit(1)).alias("total"))
    return cs.join(st, "state", "inner")


@query("jon4_events_to_first_month", with_ctes(
    "select * from user_months", "user_months"))
def jon4(spark, d):
    return M.user_month_offsets(E.reviews_all(spark, d))


@query("jon5_retention_to_cohort_size", with_ctes(
    "select cohort_month, months_since_cohort, cohort_size, retained_users from cohort_retention",
    "cohort_retention"))
def jon5(spark, d):
    return E.retention(spark, d).select("cohort_month", "months_since_cohort", "cohort_size", "retained_users")


@query("jon6_fact_to_dimension", with_ctes(
    "select o.business_id, b.business_name, count(*) as orders from stg_orders o "
    "join stg_businesses b using (business_id) group by 1, 2", "stg_orders", "stg_businesses"))
def jon6(spark, d):
    per = E.orders(spark, d).groupBy("business_id").agg(F.count(F.lit(1)).alias("orders"))
    return per.join(E.businesses(spark, d).select("business_id", "business_name"), "business_id", "inner")


@query("jon7_correlated_scalar_subquery", with_ctes(
    """select r.cohort_month, r.months_since_cohort, r.retained_users,
              (select count(*) from (select user_id, min(review_month) as cohort_month from stg_reviews
                                     where user_id is not null group by 1) uc2
               where uc2.cohort_month = r.cohort_month) as cohort_size
       from (select cohort_month, months_since_cohort, retained_users from cohort_retention) r""",
    "cohort_retention", "stg_reviews"))
def jon7(spark, d):
    """Correlated scalar subquery as written in SQL; Catalyst rewrites it
    into an aggregate plus a left outer join (no per-row rescans)."""
    tag = uuid.uuid4().hex[:8]
    ret, rev = f"ret_{tag}", f"rev_{tag}"
    E.retention(spark, d).createOrReplaceTempView(ret)
    E.reviews(spark, d).createOrReplaceTempView(rev)
    return spark.sql(f"""
        select r.cohort_month, r.months_since_cohort, r.retained_users,
               (select count(*) from (select user_id, min(review_month) as cohort_month from {rev}
                                      where user_id is not null group by user_id) uc2
                where uc2.cohort_month = r.cohort_month) as cohort_size
        from {ret} r""")


@query("jon8_operations_to_merchants", with_ctes(
    "select o.business_id, m.tier_label, count(*) as rows from delivery_operations o "
    "join merchant_performance m using (business_id) group by 1, 2", "delivery_operations",
    "merchant_performance"))
def jon8(spark, d):
    perf = E.performance(spark, d)
    ops = E.delivery_ops(spark, d, perf).select("business_id")
    return ops.join(perf.select("business_id", "tier_label"), "business_id", "inner") \
        .groupBy("business_id", "tier_label").agg(F.count(F.lit(1)).alias("rows"))


# Tables bucketed by merchant: the joins above without an exchange.

def _bucketed(spark, df, name, keys=("business_id",)):
    return sinks.write_bucketed(df, f"{name}_{uuid.uuid4().hex[:12]}", keys, int(spark.conf.get("spark.sql.shuffle.partitions")))


@query("jon1_bucketed", with_ctes(
    "select b.business_id, r.total_reviews, r.avg_review_stars "
    "from stg_businesses b left join review_facts_all r using (business_id)", "stg_businesses", "review_facts_all"))
def jon1_bucketed(spark, d):
    b = _bucketed(spark, E.businesses(spark, d), "businesses")
    months = _bucketed(spark, M.review_months(E.reviews_all(spark, d)), "review_months")
    r = M.review_aggregates_of_months(months).select("business_id", "total_reviews", "avg_review_stars")
    return b.select("business_id").join(r, "business_id", "left")


@query("jon2_bucketed", with_ctes("select * from merchant_activity", "merchant_activity"))
def jon2_bucketed(spark, d):
    """The three-way chain of MOD6."""
    return M.merchant_activity_colocated(
        _bucketed(spark, E.businesses(spark, d), "businesses"), _bucketed(spark, M.review_months(E.reviews(spark, d)), "review_months"),
        _bucketed(spark, E.checkins(spark, d), "checkins"))


@query("jon6_bucketed", with_ctes(
    "select o.business_id, b.business_name, count(*) as orders from stg_orders o "
    "join stg_businesses b using (business_id) group by 1, 2", "stg_orders", "stg_businesses"))
def jon6_bucketed(spark, d):
    days = E.orders(spark, d).groupBy("business_id", "order_date").agg(F.count(F.lit(1)).alias("n"))
    per = _bucketed(spark, days, "order_days").groupBy("business_id").agg(F.sum("n").alias("orders"))
    return per.join(_bucketed(spark, E.businesses(spark, d), "businesses").select("business_id", "business_name"), "business_id")


@query("jon8_bucketed", with_ctes(
    "select o.business_id, m.tier_label, count(*) as rows from delivery_operations o "
    "join merchant_performance m using (business_id) group by 1, 2", "delivery_operations", "merchant_performance"))
def jon8_bucketed(spark, d):
    perf = _bucketed(spark, E.performance(spark, d), "performance")
    ops = _bucketed(spark, E.delivery_ops(spark, d, perf), "operations").groupBy("business_id").agg(F.count(F.lit(1)).alias("rows"))
    return ops.join(perf.select("business_id", "tier_label"), "business_id")


# --------------------------------------------------------------- aggregates

@query("agg1_count_per_group", with_ctes(
    "select business_id, count(*) as reviews from stg_reviews_all group by 1", "stg_reviews_all"))
def agg1(spark, d):
    return E.reviews_all(spark, d).groupBy("business_id").agg(F.count(F.lit(1)).alias("reviews"))


@query("agg2_count_distinct", with_ctes(
    "select review_month, count(distinct user_id) as reviewers from stg_reviews_all group by 1",
    "stg_reviews_all"))
def agg2(spark, d):
    return E.reviews_all(spark, d).groupBy("review_month").agg(F.countDistinct("user_id").alias("reviewers"))


@query("agg3_avg", with_ctes(
    "select business_id, avg(review_stars) as avg_stars from stg_reviews_all group by 1", "stg_reviews_all"))
def agg3(spark, d):
    return E.reviews_all(spark, d).groupBy("business_id").agg(F.avg("review_stars").alias("avg_stars"))


@query("agg4_sum", with_ctes(
    "select business_id, cast(sum(checkin_count) as bigint) as checkins from stg_checkins group by 1",
    "stg_checkins"))
def agg4(spark, d):
    return E.checkins(spark, d).groupBy("business_id").agg(F.sum("checkin_count").cast("long").alias("checkins"))


@query("agg5_min_max_dates", with_ctes(
    "select business_id, min(review_date) as first_date, max(review_date) as last_date "
    "from stg_reviews_all group by 1", "stg_reviews_all"))
def agg5(spark, d):
    return E.reviews_all(spark, d).groupBy("business_id").agg(
        F.min("review_date").alias("first_date"), F.max("review_date").alias("last_date"))


@query("agg6_conditional_count", with_ctes(
    "select business_id, cast(sum(case when sentiment_bucket = 'positive' then 1 else 0 end) as bigint) "
    "as positive_reviews from stg_reviews_all group by 1", "stg_reviews_all"))
def agg6(spark, d):
    return E.reviews_all(spark, d).groupBy("business_id").agg(
        F.sum(F.when(F.col("sentiment_bucket") == "positive", 1).otherwise(0)).cast("long")
        .alias("positive_reviews"))


@query("agg7_conditional_share", with_ctes(
    "select order_month, avg(case when order_status = 'delivered' then 1.0::double else 0.0::double end) "
    "as fulfillment_rate from stg_orders group by 1", "stg_orders"))
def agg7(spark, d):
    return E.orders(spark, d).groupBy("order_month").agg(
        F.avg(F.when(F.col("order_status") == "delivered", F.lit(1.0)).otherwise(F.lit(0.0)))
        .alias("fulfillment_rate"))


@query("agg8_filtered_average", with_ctes(
    "select order_month, avg(case when order_status = 'delivered' then actual_delivery_min end) as avg_min, "
    "avg(case when order_status = 'delivered' then cast(is_on_time as double) end) as on_time_rate "
    "from stg_orders group by 1", "stg_orders"))
def agg8(spark, d):
    dl = F.col("order_status") == "delivered"
    return E.orders(spark, d).groupBy("order_month").agg(
        F.avg(F.when(dl, F.col("actual_delivery_min"))).alias("avg_min"),
        F.avg(F.when(dl, F.col("is_on_time").cast("double"))).alias("on_time_rate"))


@query("agg9_percentile_cont", with_ctes(
    "select business_id, round(percentile_cont(0.9) within group (order by cast(actual_delivery_min as double)), 4) "
    "as p90_min from stg_orders group by 1", "stg_orders"))
def agg9(spark, d):
    return E.orders(spark, d).groupBy("business_id").agg(
        C.round_dp(F.percentile(F.col("actual_delivery_min").cast("double"), F.lit(0.9)), 4).alias("p90_min"))


@query("agg10_arg_max", with_ctes(
    "select business_id, peak_day_of_week from checkin_facts", "checkin_facts"))
def agg10(spark, d):
    return M.checkin_aggregates(E.checkins(spark, d)).select("business_id", "peak_day_of_week")


@query("agg11_rate_over_span", with_ctes(
    "select business_id, reviews_per_month from review_facts_all", "review_facts_all"))
def agg11(spark, d):
    return M.review_aggregates(E.reviews_all(spark, d)).select("business_id", "reviews_per_month")


@query("agg12_group_by_derived_keys", """
    select cast(year(o_orderdate) as integer) as order_year, cast(quarter(o_orderdate) as integer) as order_quarter,
           o_totalprice >= 100000 as large, count(*) as n
    from orders group by all""")
def agg12(spark, d):
    o = _t(spark, d, "orders")
    return o.groupBy(F.year("o_orderdate").alias("order_year"), F.quarter("o_orderdate").alias("order_quarter"),
                     (F.col("o_totalprice") >= 100000).alias("large")).agg(F.count(F.lit(1)).alias("n"))


@query("agg13_group_by_three_keys", with_ctes(
    "select business_id, order_month, order_day_of_week, count(*) as total_orders from stg_orders "
    "group by 1, 2, 3", "stg_orders"))
def agg13(spark, d):
    return E.orders(spark, d).groupBy("business_id", "order_month", "order_day_of_week") \
        .agg(F.count(F.lit(1)).alias("total_orders"))


@query("agg14_global_aggregates", """
    select count(*) as n, cast(sum(l_quantity) as double) as qty, min(l_shipdate) as first_ship,
           max(l_discount) as max_discount, count(distinct l_suppkey) as suppliers
    from lineitem""")
def agg14(spark, d):
    return _t(spark, d, "lineitem").agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_quantity").cast("double").alias("qty"),
        F.min("l_shipdate").alias("first_ship"), F.max("l_discount").alias("max_discount"),
        F.countDistinct("l_suppkey").alias("suppliers"))


@query("agg16_median_quartiles", with_ctes(
    "select order_month, round(quantile_cont(cast(order_total_usd as double), 0.25), 4) as q1, "
    "round(quantile_cont(cast(order_total_usd as double), 0.5), 4) as median, "
    "round(quantile_cont(cast(order_total_usd as double), 0.75), 4) as q3 from stg_orders group by 1", "stg_orders"))
def agg16(spark, d):
    q = grouped_quantiles(E.orders(spark, d), "order_total_usd", [0.25, 0.5, 0.75], ["order_month"],
                          names=["q1", "median", "q3"])
    return q.select("order_month", *[C.round_dp(n, 4).alias(n) for n in ("q1", "median", "q3")])


# ------------------------------------------------------------------ windows

@query("win1_global_max_normalizer", with_ctes(
    "select business_id, total_checkins / nullif(max(total_checkins) over (), 0) as checkin_share_of_max "
    "from merchant_activity", "merchant_activity"))
def win1(spark, d):
    act = E.activity(spark, d).select("business_id", "total_checkins")
    most = act.agg(F.max("total_checkins").cast("double").alias("__mc"))
    share = F.col("total_checkins") / F.nullif(F.col("__mc"), F.lit(0.0))
    return M.with_one_row(act, most).select("business_id", share.alias("checkin_share_of_max"))


@query("win2_global_ntile", with_ctes(
    "select order_id, cast(ntile(10) over (order by order_total_usd nulls last, order_id) as bigint) as decile "
    "from stg_orders", "stg_orders"))
def win2(spark, d):
    return dist_ntile(E.orders(spark, d).select("order_id", "order_total_usd"), 10,
                      ["order_total_usd", "order_id"], out_col="decile").select("order_id", "decile")


@query("win3_partitioned_ntile", with_ctes(
    "select order_id, order_month, cast(ntile(4) over (partition by order_month "
    "order by order_total_usd nulls last, order_id) as bigint) as quartile from stg_orders", "stg_orders"))
def win3(spark, d):
    o = E.orders(spark, d).select("order_id", "order_month", "order_total_usd")
    return dist_ntile(o, 4, ["order_total_usd", "order_id"], ["order_month"], out_col="quartile") \
        .select("order_id", "order_month", "quartile")


@query("win4_rank_with_gaps", with_ctes(
    "select business_id, state, cast(rank() over (partition by state order by total_reviews desc) as bigint) "
    "as review_rank from merchant_activity", "merchant_activity"))
def win4(spark, d):
    a = E.activity(spark, d).select("business_id", "state", "total_reviews")
    return dist_rank(a, "total_reviews", ["state"], descending=True, tiebreak="business_id",
                     out_col="review_rank").select("business_id", "state", "review_rank")


# ---------------------------------------------------------- scalar functions

@query("fn_string", """
    select c_custkey, trim('  ' || c_name || ' ') as trimmed, upper(c_mktsegment) as upper_seg,
           lower(c_mktsegment) as lower_seg, c_name like '%00%' as has_00,
           contains(lower(c_mktsegment), 'hold') as has_hold
    from customer""")
def fn_string(spark, d):
    c = _t(spark, d, "customer")
    return c.select(
        "c_custkey", F.trim(F.concat(F.lit("  "), F.col("c_name"), F.lit(" "))).alias("trimmed"),
        F.upper("c_mktsegment").alias("upper_seg"), F.lower("c_mktsegment").alias("lower_seg"),
        F.col("c_name").like("%00%").alias("has_00"),
        F.lower("c_mktsegment").contains("hold").alias("has_hold"))


@query("fn_date_parts", """
    select event_id, cast(date_trunc('month', ts) as date) as month_start, cast(year(ts) as integer) as yr,
           cast(month(ts) as integer) as mon, cast(dayofweek(ts) as integer) as dow,
           cast(hour(ts) as integer) as hr, cast(ts as date) as dt, strftime(ts, '%Y-%m') as label,
           dayname(ts) as weekday
    from events""")
def fn_date_parts(spark, d):
    e = _t(spark, d, "events")
    ts = F.col("ts")
    return e.select("event_id", C.month_start(ts).alias("month_start"), F.year(ts).alias("yr"),
                    F.month(ts).alias("mon"), C.dow0(ts).alias("dow"), F.hour(ts).alias("hr"),
                    F.to_date(ts).alias("dt"), C.date_label(ts).alias("label"),
                    C.weekday_name(ts).alias("weekday"))


@query("fn_parse_timestamp", """
    select event_id, cast(strptime(strftime(ts, '%Y-%m-%d %H:%M:%S'), '%Y-%m-%d %H:%M:%S') as date) as dt,
           cast(hour(strptime(strftime(ts, '%Y-%m-%d %H:%M:%S'), '%Y-%m-%d %H:%M:%S')) as integer) as hr,
           cast(minute(strptime(strftime(ts, '%Y-%m-%d %H:%M:%S'), '%Y-%m-%d %H:%M:%S')) as integer) as mi,
           cast(strftime(ts, '%Y-%m-%d') as date) as parsed_date
    from events""")
def fn_parse_timestamp(spark, d):
    e = _t(spark, d, "events")
    text = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    parsed = F.to_timestamp(text, "yyyy-MM-dd HH:mm:ss")
    return e.select("event_id", parsed.cast("date").alias("dt"), F.hour(parsed).alias("hr"),
                    F.minute(parsed).alias("mi"),
                    F.date_format("ts", "yyyy-MM-dd").cast("date").alias("parsed_date"))


@query("fn_cast", f"""
    select {ID} as order_id, cast(l_quantity as integer) as qty_int,
           cast(l_extendedprice as decimal(12,2)) as price_dec, cast(l_linestatus = 'O' as boolean) as is_open,
           try_cast(case when l_linenumber = 7 then 'n/a' else cast(l_linenumber as varchar) end as integer) as ln_int, cast(cast(l_linenumber as varchar) as double) as ln_double
    from lineitem""")
def fn_cast(spark, d):
    li = _t(spark, d, "lineitem")
    return li.select(_oid(), F.col("l_quantity").cast("int").alias("qty_int"),
                     F.col("l_extendedprice").cast("decimal(12,2)").alias("price_dec"),
                     (F.col("l_linestatus") == "O").cast("boolean").alias("is_open"),
                     F.when(F.col("l_linenumber") == 7, F.lit("n/a"))
                     .otherwise(F.col("l_linenumber").cast("string")).try_cast("int").alias("ln_int"),
                     F.col("l_linenumber").cast("string").cast("double").alias("ln_double"))


@query("fn_round", f"""
    select {ID} as order_id, round(l_extendedprice / 7.0, 0) as r0, round(l_extendedprice / 7.0, 1) as r1,
           round(l_extendedprice / 7.0, 2) as r2, round(l_discount * l_tax * 3.0, 4) as r4
    from lineitem""")
def fn_round(spark, d):
    li = _t(spark, d, "lineitem")
    x = F.col("l_extendedprice") / F.lit(7.0)
    return li.select(_oid(), C.round_dp(x, 0).alias("r0"), C.round_dp(x, 1).alias("r1"),
                     C.round_dp(x, 2).alias("r2"),
                     C.round_dp(F.col("l_discount") * F.col("l_tax") * F.lit(3.0), 4).alias("r4"))


@query("fn_months_diff", """
    select l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey,
           cast(datediff('month', o.o_orderdate, l.l_shipdate) as integer) as months
    from lineitem l join orders o on l.l_orderkey = o.o_orderkey""")
def fn_months_diff(spark, d):
    li = _t(spark, d, "lineitem")
    o = _t(spark, d, "orders").select("o_orderkey", "o_orderdate")
    return li.join(o, li.l_orderkey == o.o_orderkey).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        C.months_diff("o_orderdate", "l_shipdate").alias("months"))


@query("fn_weighted_sum", f"""
    select {ID} as order_id,
           0.40 * (l_discount / 0.1) + 0.35 * (l_tax / 0.08) + 0.25 * (l_quantity / 50.0) as score
    from lineitem""")
def fn_weighted_sum(spark, d):
    li = _t(spark, d, "lineitem")
    s = (F.lit(0.40) * (F.col("l_discount") / F.lit(0.1)) + F.lit(0.35) * (F.col("l_tax") / F.lit(0.08))
         + F.lit(0.25) * (F.col("l_quantity") / F.lit(50.0)))
    return li.select(_oid(), s.alias("score"))


@query("fn_coalesce_nullif", f"""
    select {ID} as order_id, nullif(l_tax, 0.0) as tax_or_null, coalesce(nullif(l_tax, 0.0), l_discount) as tax_or_disc
    from lineitem""")
def fn_coalesce_nullif(spark, d):
    li = _t(spark, d, "lineitem")
    t = F.nullif(F.col("l_tax"), F.lit(0.0))
    return li.select(_oid(), t.alias("tax_or_null"), F.coalesce(t, F.col("l_discount")).alias("tax_or_disc"))


@query("fn_interval_add", """
    select o_orderkey, cast(o_orderdate + to_days(cast(o_custkey % 30 as integer))
                                          + to_hours(cast(o_orderkey % 24 as integer))
                                          + to_minutes(cast(o_orderkey % 60 as integer)) as date) as dt,
           cast(hour(o_orderdate + to_days(cast(o_custkey % 30 as integer))
                     + to_hours(cast(o_orderkey % 24 as integer))
                     + to_minutes(cast(o_orderkey % 60 as integer))) as integer) as hr,
           cast(minute(o_orderdate + to_days(cast(o_custkey % 30 as integer))
                     + to_hours(cast(o_orderkey % 24 as integer))
                     + to_minutes(cast(o_orderkey % 60 as integer))) as integer) as mi
    from orders""")
def fn_interval_add(spark, d):
    o = _t(spark, d, "orders")
    ts = F.col("o_orderdate") + F.make_dt_interval(
        (F.col("o_custkey") % 30).cast("int"), (F.col("o_orderkey") % 24).cast("int"),
        (F.col("o_orderkey") % 60).cast("int"))
    return o.select("o_orderkey", ts.cast("date").alias("dt"), F.hour(ts).alias("hr"), F.minute(ts).alias("mi"))


@query("fn_bin", f"""
    select floor(l_quantity / 2.0) * 2.0 as bin_start, count(*) as n from lineitem group by 1""")
def fn_bin(spark, d):
    li = _t(spark, d, "lineitem")
    return li.groupBy(C.bin_floor("l_quantity", 2).alias("bin_start")).agg(F.count(F.lit(1)).alias("n"))
