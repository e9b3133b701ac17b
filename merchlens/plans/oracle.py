"""SQL (DuckDB dialect) of the same results, for the correctness check.

Written from the meaning of each model, with every value spelled out: nothing is taken from the rule tables or the
check lists of the Spark side, and the steps differ where there is a choice (pre-aggregation by month, tiles from row
numbers, ranks by counting, one window over user months). ``with_ctes`` puts the named relations a
query needs, and theirs, before it.
"""

from __future__ import annotations

from collections.abc import Sequence

RELATIONS: dict[str, tuple[str, tuple[str, ...]]] = {}


def relation(name: str, sql: str, *needs: str) -> None:
    RELATIONS[name] = (sql, needs)


def any_of(col: str, words: Sequence[str]) -> str:
    """The lower-cased text holds one of the words."""
    return "(" + " or ".join(f"contains(lower({col}), '{w}')" for w in words) + ")"


def first_match(col: str, arms: Sequence[tuple[str, Sequence[str]]], default: str) -> str:
    """The label of the first arm whose words all occur."""
    out = ["when " + " and ".join(f"contains(lower({col}), '{w}')" for w in words) + f" then '{label}'" for label, words in arms]
    return f"case {' '.join(out)} else {default} end"


# Published keyword lists and taxonomies, and those for the test tables' part names.
FOOD = (
    "restaurant", "food", "pizza", "burger", "cafe", "coffee", "sushi", "bar",
    "bakery", "diner", "grill", "bistro", "thai", "mexican", "italian", "chinese",
)
ORDER_FOOD = (
    "restaurant", "food", "pizza", "burger", "cafe", "sushi", "thai",
    "mexican", "italian", "chinese", "bakery", "diner", "bar", "grill", "bistro",
)
PARTS = ("ring", "bolt", "plate", "gear", "widget", "gizmo", "red")
CUISINES = (
    ("Pizza", ("pizza",)),
    ("Sushi", ("sushi",)),
    ("Thai", ("thai",)),
    ("Mexican", ("mexican",)),
    ("Italian", ("italian",)),
    ("Chinese", ("chinese",)),
    ("Burgers", ("burger",)),
    ("Sandwiches", ("sandwich",)),
    ("Coffee & Tea", ("coffee",)),
    ("Coffee & Tea", ("cafe",)),
    ("Bakery", ("bakery",)),
    ("Bars & Grills", ("bar", "food")),
    ("American (Traditional)", ("diner",)),
    ("American (New)", ("american",)),
    ("Seafood", ("seafood",)),
    ("Indian", ("indian",)),
    ("Korean", ("korean",)),
    ("Vietnamese", ("vietnamese",)),
    ("Mediterranean", ("mediterranean",)),
)
DEV_CUISINES = (
    ("Pizza", ("pizza",)),
    ("Sushi", ("sushi",)),
    ("Thai", ("thai",)),
    ("Mexican", ("mexican",)),
    ("Italian", ("italian",)),
    ("Chinese", ("chinese",)),
    ("Burgers", ("burger",)),
    ("Coffee & Tea", ("coffee",)),
    ("Coffee & Tea", ("cafe",)),
    ("Bakery", ("bakery",)),
    ("American (New)", ("american",)),
    ("Seafood", ("seafood",)),
)
PART_KINDS = (
    ("Red anvil", ("red", "anvil")),
    ("Jewelry", ("ring",)),
    ("Metal", ("bolt",)),
    ("Metal", ("rod",)),
    ("Metal", ("plate",)),
    ("Parts", ("gear",)),
    ("Parts", ("widget",)),
    ("Parts", ("gizmo",)),
)
DEV_PART_KINDS = (
    ("Jewelry", ("ring",)),
    ("Metal", ("bolt",)),
    ("Metal", ("plate",)),
    ("Parts", ("gear",)),
    ("Parts", ("widget",)),
)


def mean(col: str) -> str:
    """Mean of the decimal values that the floats stand for: averages of two scores of four digits often end in 5, and the
    float sum's last bit would decide how they round."""
    return f"sum(({col})::decimal(38,12))::double / nullif(count({col}), 0)"


def month_number(col: str) -> str:
    return f"(year({col}) * 12 + month({col}))"


relation("raw_businesses", """
    select c.c_custkey as business_id, c.c_name as name, cast(null as varchar) as address,
           n.n_name as city, n.n_name as state,
           lpad(cast(c.c_nationkey as varchar), 5, '0') as postal_code,
           18.0 + n.n_nationkey * 2 + cast(c.c_custkey % 100 as double) / 100.0 as latitude,
           -70.0 - n.n_nationkey * 4 - cast(c.c_custkey % 100 as double) / 100.0 as longitude,
           1.0 + cast(c.c_custkey % 9 as double) * 0.5 as stars,
           cast(p.p_size as bigint) as review_count,
           case when c.c_acctbal > 0 then 1 else 0 end as is_open,
           p.p_name as categories
    from customer c
    left join nation n on c.c_nationkey = n.n_nationkey
    left join part p on c.c_custkey = p.p_partkey""")

relation("raw_reviews_src", """
    select o_orderkey as review_id, o_custkey as user_id, o_custkey as business_id,
           cast(6 - cast(substr(o_orderpriority, 1, 1) as integer) as double) as stars,
           cast(o_orderdate as date) as review_date
    from orders""")

relation("checkin_events", """
    select user_id as business_id, ts as checkin_at from events""")

relation("raw_orders", """
    select concat_ws('-', l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey,
                     cast(round(l.l_extendedprice * 100) as bigint)) as order_id,
           o.o_custkey as business_id,
           'COURIER_' || lpad(cast(l.l_suppkey as varchar), 5, '0') as courier_id,
           o.o_orderdate as order_timestamp,
           cast(o.o_orderdate as date) as order_date,
           cast(hour(o.o_orderdate) as integer) as order_hour,
           dayname(o.o_orderdate) as order_day_of_week,
           35 as estimated_delivery_min,
           case when l.l_returnflag <> 'R' then greatest(10, 35 + (cast(l.l_quantity as integer) - 35)) end
               as actual_delivery_min,
           case when l.l_returnflag <> 'R' then cast(l.l_quantity as integer) - 35 end as delivery_delta_min,
           case when l.l_returnflag <> 'R' then (cast(l.l_quantity as integer) - 35) <= 5 end as is_on_time,
           cast(least(greatest((cast(round(l.l_extendedprice * 100) as bigint) + 500) // 1000, 800), 12000)
                as double) / 100 as order_total_usd,
           cast(cast(round(l.l_tax * 10000) as bigint) as double) / 100 as delivery_fee_usd,
           case when l.l_returnflag = 'R' then 'cancelled' else 'delivered' end as order_status,
           true as _is_synthetic
    from lineitem l join orders o on l.l_orderkey = o.o_orderkey""")

def _listing(category: str, extra: str = "") -> str:
    return f"""
    select business_id, trim(name) as business_name, trim(address) as address, trim(city) as city, upper(trim(state)) as state,
           postal_code, latitude, longitude, stars, review_count::integer as review_count, is_open = 1 as is_open,
           trim(categories) as categories_raw, {category} as primary_cuisine
    from raw_businesses
    where coalesce(latitude, longitude) is not null and latitude + longitude is not null
      and stars >= 1 and stars <= 5 and review_count >= 1 {extra}"""


relation("stg_businesses", _listing(first_match("categories", PART_KINDS, "'Other'"), f"and {any_of('categories', PARTS)}"), "raw_businesses")
relation("stg_businesses_dev", _listing(first_match("categories", DEV_PART_KINDS, "trim(categories)")), "raw_businesses")

relation("stg_reviews_all", """
    select review_id, user_id, business_id, stars as review_stars, 0 as useful_votes, 0 as funny_votes, 0 as cool_votes, review_date,
           make_date(year(review_date), month(review_date), 1) as review_month,
           year(review_date)::integer as review_year, month(review_date)::integer as review_month_num,
           if(stars >= 4, 'positive', if(stars = 3, 'neutral', 'negative')) as sentiment_bucket
    from raw_reviews_src
    where review_id + business_id is not null and stars >= 1 and stars <= 5 and review_date is not null""", "raw_reviews_src")
relation("stg_reviews", "select * from stg_reviews_all where review_year >= 2000", "stg_reviews_all")

relation("stg_checkins", """
    select business_id, d as checkin_date, make_date(year(d), month(d), 1) as checkin_month, year(d)::integer as checkin_year,
           dayofweek(d)::integer as day_of_week, h::integer as hour_of_day, n as checkin_count
    from (select business_id, checkin_at::date as d, hour(checkin_at) as h, count(*) as n
          from checkin_events where checkin_at is not null group by all)""", "checkin_events")

relation("stg_orders", """
    select order_id, business_id, courier_id, order_timestamp::timestamp as order_timestamp, order_date,
           make_date(year(order_date), month(order_date), 1) as order_month, year(order_date)::integer as order_year, order_hour,
           order_day_of_week, estimated_delivery_min::integer as estimated_delivery_min,
           actual_delivery_min::integer as actual_delivery_min, delivery_delta_min::integer as delivery_delta_min, is_on_time,
           order_total_usd::decimal(10,2) as order_total_usd, delivery_fee_usd::decimal(10,2) as delivery_fee_usd, order_status, _is_synthetic
    from raw_orders where order_id is not null""", "raw_orders")


def _review_facts(reviews: str) -> str:
    return f"""
    select business_id, sum(n)::bigint as total_reviews, sum(stars) / sum(n) as avg_review_stars,
           min(first_day) as first_review_date, max(last_day) as last_review_date,
           sum(n) / nullif(max(m) - min(m), 0) as reviews_per_month,
           sum(good)::bigint as positive_reviews, sum(bad)::bigint as negative_reviews, count(distinct review_year) as active_years
    from (select business_id, review_year, {month_number('review_month')} as m, count(*) as n, sum(review_stars) as stars,
                 min(review_date) as first_day, max(review_date) as last_day,
                 count_if(review_stars >= 4) as good, count_if(review_stars < 4 and review_stars <> 3) as bad
          from {reviews} group by all)
    group by business_id"""


relation("review_facts", _review_facts("stg_reviews"), "stg_reviews")
relation("review_facts_all", _review_facts("stg_reviews_all"), "stg_reviews_all")

relation("checkin_facts", """
    select business_id, sum(checkin_count)::bigint as total_checkins, count(distinct checkin_date) as active_checkin_days,
           max(day_of_week) filter (where best = 1) as peak_day_of_week
    from (select *, row_number() over (partition by business_id order by checkin_count desc, day_of_week) as best from stg_checkins)
    group by business_id""", "stg_checkins")

relation("merchant_activity", """
    select b.business_id, business_name, city, state, primary_cuisine, stars as listing_stars, review_count as listing_review_count, is_open,
           latitude, longitude, ifnull(f.total_reviews, 0) as total_reviews, ifnull(f.avg_review_stars, stars) as avg_review_stars,
           f.first_review_date, f.last_review_date, ifnull(f.reviews_per_month, 0) as reviews_per_month,
           ifnull(f.positive_reviews, 0) as positive_reviews, ifnull(f.negative_reviews, 0) as negative_reviews,
           ifnull(f.active_years, 0) as active_years, f.positive_reviews / nullif(f.total_reviews, 0) as positive_review_ratio,
           ifnull(f.total_checkins, 0) as total_checkins, ifnull(f.active_checkin_days, 0) as active_checkin_days, f.peak_day_of_week
    from stg_businesses b
    left join (select coalesce(r.business_id, c.business_id) as business_id, r.* exclude (business_id), c.* exclude (business_id)
               from review_facts r full join checkin_facts c on r.business_id = c.business_id) f on f.business_id = b.business_id""",
    "stg_businesses", "review_facts", "checkin_facts")


def _tile(place: str, size: str, k: int = 5) -> str:
    """The tile of a place (from 0) among ``size`` rows: the larger tiles come first."""
    q, r = f"({size} // {k})", f"({size} % {k})"
    return f"(case when {place} < {r} * ({q} + 1) then {place} // ({q} + 1) else {r} + ({place} - {r} * ({q} + 1)) // nullif({q}, 0) end + 1)::bigint"


relation("merchant_performance", f"""
    select business_id, business_name, city, state, primary_cuisine, latitude, longitude, is_open, listing_stars, avg_review_stars,
           total_reviews, reviews_per_month, total_checkins, active_checkin_days, positive_review_ratio, active_years,
           round(score, 4) as composite_score, tier as performance_tier, state_tier as state_performance_tier,
           ['Low', 'Below Average', 'Average', 'Strong', 'Elite'][tier] as tier_label, tier = 5 as is_elite_merchant, ifnull(not is_open, false) as is_closed
    from (select *, {_tile('place', 'everyone')} as tier, {_tile('state_place', 'in_state')} as state_tier
          from (select *, row_number() over (order by score nulls last, business_id) - 1 as place, count(*) over () as everyone,
                       row_number() over (partition by state order by score nulls last, business_id) - 1 as state_place,
                       count(*) over (partition by state) as in_state
                from (select a.*, 0.4::double * (avg_review_stars / 5.0) + 0.35::double * (reviews_per_month / nullif(top.v, 0))
                                        + 0.25::double * (total_checkins / nullif(top.c, 0)) as score
                            from merchant_activity a, (select max(reviews_per_month) as v, max(total_checkins) as c from merchant_activity) top)))""",
    "merchant_activity")

relation("cuisine_market_share", f"""
    with segment as (
        select state, primary_cuisine, count(*) as n, {mean('avg_review_stars')} as stars, {mean('reviews_per_month')} as pace,
               avg(total_checkins) as checkins, {mean('composite_score')} as score, sum(total_reviews)::bigint as reviews,
               count_if(is_open) as open_now, count_if(performance_tier = 5) / count(*) as elite
        from merchant_performance group by all)
    select s.state, s.primary_cuisine, s.n as merchant_count, t.n::bigint as total_merchants_in_state,
           round(100.0::double * s.n / t.n, 2) as market_share_pct, round(s.stars, 2) as avg_stars, round(s.pace, 2) as avg_reviews_per_month,
           round(s.checkins, 0) as avg_checkins, round(s.score, 4) as avg_composite_score, s.reviews as total_reviews_in_segment,
           s.open_now::bigint as open_merchant_count, round(s.elite, 4) as elite_merchant_share,
           (1 + (select count(*) from segment o where o.state is not distinct from s.state and o.n > s.n))::bigint as cuisine_rank_in_state
    from segment s join (select state, sum(n) as n from segment group by state) t on t.state is not distinct from s.state""", "merchant_performance")


def _retention(reviews: str) -> str:
    return f"""
    with months as (
        select *, m - min(m) over (partition by user_id) as age
        from (select distinct user_id, {month_number('review_month')} as m from {reviews} where user_id is not null)
    ), counted as (
        select m - age as born, age, count(*) as users from months where age <= 24 group by all)
    select make_date(((born - 1) // 12)::integer, ((born - 1) % 12 + 1)::integer, 1) as cohort_month,
           printf('%04d-%02d', (born - 1) // 12, (born - 1) % 12 + 1) as cohort_label, age::bigint as months_since_cohort,
           size as cohort_size, users as retained_users, round(100.0::double * users / size, 2) as retention_rate_pct
    from (select *, max(users) filter (where age = 0) over (partition by born) as size from counted)"""


relation("cohort_retention", _retention("stg_reviews"), "stg_reviews")
relation("cohort_retention_dev", _retention("stg_reviews_all"), "stg_reviews_all")
relation("user_months", f"""
    select user_id, review_month as activity_month, min(review_month) over (partition by user_id) as cohort_month,
           ({month_number('review_month')} - min({month_number('review_month')}) over (partition by user_id))::bigint as months_since_cohort
    from (select distinct user_id, review_month from stg_reviews_all where user_id is not null)""", "stg_reviews_all")

relation("delivery_operations", """
    select business_id, business_name, city, state, primary_cuisine, performance_tier, tier_label, order_month, order_day_of_week,
           n as total_orders, done as delivered_orders, void as cancelled_orders, round(done / n, 4) as fulfillment_rate,
           round(in_time / nullif(judged, 0), 4) as on_time_rate, round(minutes / nullif(timed, 0), 1) as avg_delivery_min, round(p90, 1) as p90_delivery_min,
           round(gmv::double, 2) as total_gmv_usd, round(gmv::double / nullif(valued, 0), 2) as avg_order_value_usd,
           round(fees::double, 2) as total_delivery_fees_usd, true as _is_synthetic_data
    from (select business_id, business_name, city, state, primary_cuisine, performance_tier, tier_label, order_month, order_day_of_week, count(*) as n,
                 count_if(order_status = 'delivered') as done, count_if(order_status = 'cancelled') as void,
                 count_if(is_on_time) filter (where order_status = 'delivered') as in_time, count(is_on_time) filter (where order_status = 'delivered') as judged,
                 sum(actual_delivery_min) filter (where order_status = 'delivered') as minutes, count(actual_delivery_min) filter (where order_status = 'delivered') as timed,
                 quantile_cont(actual_delivery_min::double, 0.9) as p90, sum(order_total_usd) as gmv, count(order_total_usd) as valued, sum(delivery_fee_usd) as fees
          from stg_orders join merchant_performance using (business_id) where _is_synthetic group by all)""", "stg_orders", "merchant_performance")


def _needed(names: Sequence[str]) -> list[str]:
    out: list[str] = []
    for name in names:
        out += [n for n in (*_needed(RELATIONS[name][1]), name) if n not in out]
    return out


def with_ctes(body: str, *names: str) -> str:
    """``body`` after the named relations and what they need."""
    parts = [f"{n} as ({RELATIONS[n][0]}\n)" for n in _needed(names)]
    return f"with {', '.join(parts)}\n{body}" if parts else body


# ------------------------------------------------------------ quality checks

# The published check lists: check, column, bounds or values in SQL.
CHECKS = {
    "businesses": (
        ("not_null", "business_id"),
        ("not_null", "business_name"),
        ("not_null", "state"),
        ("not_null", "stars"),
        ("not_null", "primary_cuisine"),
        ("unique", "business_id"),
        ("between", "stars", 1.0, 5.0),
        ("between", "review_count", 1, None),
        ("between", "latitude", 18.0, 72.0),
        ("between", "longitude", -180.0, -65.0),
        ("row_count", 100, 500000),
    ),
    "reviews": (
        ("not_null", "review_id"),
        ("not_null", "business_id"),
        ("not_null", "review_date"),
        ("unique", "review_id"),
        ("between", "review_stars", 1.0, 5.0),
        ("between", "review_year", 2015, 2026),
        ("in_set", "sentiment_bucket", "'positive','neutral','negative'"),
        ("row_count", 100, 10000000),
    ),
    "orders": (
        ("not_null", "order_id"),
        ("not_null", "business_id"),
        ("unique", "order_id"),
        ("in_set", "order_status", "'delivered','cancelled'"),
        ("between", "order_total_usd", 0.01, 500.0),
        ("row_count", 1000, 600000),
    ),
    "source businesses": (
        ("not_null", "business_id"),
        ("unique", "business_id"),
        ("not_null", "name"),
        ("not_null", "state"),
        ("not_null", "stars"),
        ("in_set", "stars", "1.0,1.5,2.0,2.5,3.0,3.5,4.0,4.5,5.0"),
        ("not_null", "review_count"),
    ),
    "source reviews": (
        ("not_null", "review_id"),
        ("unique", "review_id"),
        ("not_null", "business_id"),
        ("not_null", "stars"),
        ("not_null", "review_date"),
    ),
    "source checkins": (
        ("not_null", "business_id"),
        ("not_null", "checkin_at"),
    ),
    "source orders": (
        ("not_null", "order_id"),
        ("unique", "order_id"),
        ("not_null", "business_id"),
        ("in_set", "order_status", "'delivered','cancelled'"),
    ),
    "mart performance": (
        ("not_null", "business_id"),
        ("unique", "business_id"),
        ("not_null", "state"),
        ("not_null", "primary_cuisine"),
        ("not_null", "performance_tier"),
        ("in_set", "performance_tier", "1,2,3,4,5"),
        ("in_set", "tier_label", "'Elite','Strong','Average','Below Average','Low'"),
    ),
    "mart share": (
        ("not_null", "state"),
        ("not_null", "primary_cuisine"),
        ("not_null", "merchant_count"),
        ("not_null", "market_share_pct"),
    ),
    "mart retention": (
        ("not_null", "cohort_month"),
        ("not_null", "months_since_cohort"),
        ("not_null", "retained_users"),
        ("not_null", "retention_rate_pct"),
    ),
    "mart delivery": (
        ("not_null", "business_id"),
        ("not_null", "order_month"),
        ("in_set", "_is_synthetic_data", "true"),
    ),
}


def check_rows(table: str, checks: Sequence[tuple]) -> str:
    """A result row per check of a list: observed failures (rows for row_count) over all rows."""
    out = []
    for kind, *args in checks:
        col = None if kind == "row_count" else args[0]
        name = "null::varchar" if kind == "row_count" else f"'{col}'"
        head = f"select '{table}' as table_name, '{kind}' as check_name, {name} as column_name, "
        if kind == "unique":
            out.append(head + f"(count(*) filter (where copies > 1))::bigint as observed, count(*) as total_rows, count(*) filter (where copies > 1) = 0 as success "
                       f"from (select count({col}) over (partition by {col}) as copies from {table})")
            continue
        if kind == "row_count":
            out.append(head + f"count(*) as observed, count(*) as total_rows, count(*) between {args[0]} and {args[1]} as success from {table}")
            continue
        if kind == "not_null":
            fails = f"{col} is null"
        elif kind == "between":
            fails = " or ".join(f"{col} {sign} {bound}" for sign, bound in zip("<>", args[1:], strict=True) if bound is not None)
        else:
            fails = f"{col} not in ({args[1]})"
        out.append(head + f"count_if({fails}) as observed, count(*) as total_rows, count_if({fails}) = 0 as success from {table}")
    return "\nunion all\n".join(out)
