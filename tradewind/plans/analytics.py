"""Analytics queries over a data folder, each with DuckDB SQL that gives the same rows independently."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.operators import customers, marketing, products, revenue
from tradewind.sources.conform import dim_customers, dim_products, fact_events, fact_orders, inventory, newest_event, newest_order, order_heads, with_tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def r(x: str, digits: int = 0) -> str:
    return f"floor(cast({x} as double) * {float(10**digits)} + 0.5) / {float(10**digits)}"


def m(cents: str) -> str:
    return r(f"cast({cents} as double) / 100.0", 2)


def p(num: str, den: str, digits: int, factor: float = 100.0) -> str:
    return r(f"cast({num} as double) * {factor} / nullif(cast({den} as double), 0.0)", digits)


def add(name: str, sql: str | None, tables: str = "") -> Callable:
    """Registers a query under its key, with its SQL over the named conformed tables."""

    def keep(f: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[name] = f
        if sql is not None:
            SQL[name] = with_tables(sql, *tables.split()) if tables else sql
        return f

    return keep


LIVE = "order_status <> 'cancelled'"
SOLD = "order_status not in ('cancelled', 'refunded')"
NOW = "(select max(cast(o_orderdate as date)) from orders)"
EVENT_NOW = "(select max(cast(ts as date)) from events)"
BACK = "order_status in ('refunded', 'partially_refunded')"


def n(what: str, when: str = "") -> str:
    return f"cast(count({what})" + (f" filter (where {when})" if when else "") + " as bigint)"


def s(what: str, when: str = "") -> str:
    return f"cast(sum({what})" + (f" filter (where {when})" if when else "") + " as bigint)"


# --- customers ---------------------------------------------------------------------------------------------------

add("customer_ltv", f"""
select customer_key, any_value(email) as email, any_value(loyalty_tier) as loyalty_tier, any_value(acquisition_source) as
  acquisition_source, any_value(o) as order_count,
 any_value({m("c")}) as lifetime_revenue, any_value({m("a")}) as avg_order_value, any_value({m("sd")}) as stddev_order_value, any_value(d1)
   as first_order_date, any_value(d2) as last_order_date, any_value(cast(d2 - d1 as bigint)) as tenure_days,
 any_value(t10) as revenue_decile, any_value(t4) as revenue_quartile, any_value({r("pr * 100.0", 1)}) as revenue_percentile_rank,
 any_value(case when t10 = 10 then 'Top 10%' when t10 > 7 then 'Top 30%' when t10 > 5 then 'Mid Tier'
   else 'Low Tier' end) as customer_value_segment
from (select x.*, email, loyalty_tier, acquisition_source, ntile(10) over w as t10, ntile(4) over w as t4, percent_rank()
  over (order by c) as pr
  from (select customer_key, {n("distinct order_id")} as o, {s("total_cents")} as c, avg(total_cents) as a, stddev_samp(total_cents) as sd,
    min(order_date) as d1, max(order_date) as d2 from fo where {LIVE} group by 1) x join dc using (customer_key)
  window w as (order by c, customer_key)) group by 1""", "fo dc")(
    lambda s_, d: customers.customer_ltv(fact_orders(s_, d), dim_customers(s_, d)),
)

_BASE = (
    f"base as (select customer_key, cast({NOW} - max(order_date) as bigint) as recency, {n('distinct order_id')} as frequency, "
    f"{s('total_cents')} as cents from fo where {LIVE} and order_date >= {NOW} - interval 12 month group by 1)"
)
_SCORED = f"""with {_BASE},
scored as (select *, 6 - ntile(5) over (order by recency, customer_key) as r_score, ntile(5)
  over (order by frequency desc, customer_key) as f_score, ntile(5) over (order by cents desc, customer_key) as m_score from base),
named as (select *, r_score + f_score + m_score as rfm_total, case when r_score >= 4 then case when f_score >= 4 then 'Champions'
  when f_score >= 2 then 'Loyal Customers' when r_score = 5 then 'New Customers' else 'Promising' end
 when r_score = 3 then case when f_score >= 3 then 'Potential Loyalists' else 'Others' end
 else case when f_score >= 4 then 'At Risk' when f_score >= 2 then 'About to Sleep' when r_score = 1 then 'Lost'
   else 'Others' end end as rfm_segment from scored)"""
add("rfm_segments", f"""{_SCORED} select rfm_segment, {n("*")} as customer_count, {r("avg(recency)")} as avg_recency_days,
  {r("avg(frequency)", 1)} as avg_frequency, {m("avg(cents)")} as avg_monetary, {m("sum(cents)")} as total_revenue,
 {p("count(*)", "(select count(*) from named)", 1)} as pct_of_customers from named group by 1""", "fo")(
    lambda s_, d: customers.rfm_segments(fact_orders(s_, d), as_of=newest_order(s_, d)),
)
add(
    "mart_customer_rfm",
    f"{_SCORED} select customer_key, recency as recency_days, frequency, cents as monetary_cents, r_score, f_score, m_score, "
    f"rfm_total, rfm_segment from named",
    "fo",
)(lambda s_, d: customers.rfm_mart(fact_orders(s_, d), as_of=newest_order(s_, d)))

add("rfm_report", f"""with base as (select customer_key, {NOW} - max(order_date) as recency, count(distinct order_id) as f, sum(total_cents)
  as c from fo where {SOLD} group by 1),
t as (select *, ntile(5) over (order by recency desc, customer_key) as rs, ntile(5) over (order by f, customer_key) as fs, ntile(5)
  over (order by c, customer_key) as ms from base)
select case when least(rs, fs, ms) >= 4 then 'Champions' when least(rs, fs) >= 3 then 'Loyal Customers' when rs >= 4 and fs <= 2
  then 'Recent Customers' when rs <= 2 and least(fs, ms) >= 3 then 'At Risk' when rs = 1 and fs <= 2 then 'Lost'
  else 'Potential Loyalists' end as segment,
 {n("*")} as customer_count, {r("avg(recency)", 1)} as avg_recency_days, {r("avg(f)", 2)} as avg_orders, {m("avg(c)")} as avg_ltv from t
   group by 1""", "fo")(lambda s_, d: customers.rfm_report(fact_orders(s_, d), as_of=newest_order(s_, d)))

_ACTIVE = (
    "seen as (select distinct customer_key, date_trunc('month', order_date)::date as mo from fo "
    "where {}), born as (select customer_key, min(mo) as cohort from seen "
    "group by 1), aged as (select cohort, customer_key, cast(date_diff('month', cohort, mo) as bigint) as age from seen "
    "join born using (customer_key))"
)
add("cohort_retention", f"""with {_ACTIVE.format(LIVE)}, sizes as (select cohort, {n("*")} as size from born group by 1)
select cohort as cohort_month, size as cohort_customers, age as months_since_cohort, {n("*")} as retained_customers,
  {p("count(*)", "size", 1)} as retention_rate_pct
from aged join sizes using (cohort) where age <= 6 and cohort >= date_trunc('month', {NOW}) - interval 12 month group by 1, 2, 3""", "fo")(
    lambda s_, d: customers.cohort_retention(fact_orders(s_, d), as_of=newest_order(s_, d)),
)
add("customer_cohorts", f"""with {_ACTIVE.format("payment_status = 'captured' and " + LIVE)}, c as (select cohort, age, {n("*")} as k
  from aged group by 1, 2)
select cohort as cohort_month, age as period_number, k as active_customers, arg_min(k, age)
  over (partition by cohort) as cohort_size, {p("k", "arg_min(k, age) over (partition by cohort)", 2)} as retention_rate_pct from c""", "fo")(
    lambda s_, d: customers.customer_cohorts(fact_orders(s_, d)),
)
add("cohort_pivot", f"""with {_ACTIVE.format(SOLD)}, c as (select cohort, {n("*", "age = 0")} as size,
  {", ".join(f"nullif(count(*) filter (where age = {k}), 0) as a{k}" for k in (1, 2, 3, 6))} from aged group by 1)
select cast(year(cohort) * 100 + month(cohort) as bigint) as cohort_ym, size as cohort_size,
  {", ".join(f"{p(f'a{k}', 'size', 1)} as m{k}_pct" for k in (1, 2, 3, 6))} from c order by 1 desc limit 12""", "fo")(
    lambda s_, d: customers.cohort_pivot(fact_orders(s_, d)),
)

add("churn_features", f"""with o as (select customer_key, {n("distinct order_id")} as n, {s("total_cents")} as c, avg(total_cents) as a,
  min(order_date) as d1, max(order_date) as d2, count(distinct order_id) filter (where order_status = 'refunded') as b, count(distinct
  order_id) filter (where discount_code is not null) as u from fo where {LIVE} group by 1),
f as (select dc.customer_key, loyalty_tier, acquisition_source, country_code, cast({NOW} - customer_since_date as bigint) as
  account_age_days, coalesce(n, 0) as total_orders, coalesce(c, 0) as total_revenue_cents, coalesce({r("a", 2)}, 0.0) as
  avg_order_value_cents, coalesce(d2, customer_since_date) as last_order_date,
 cast({NOW} - d2 as bigint) as recency_days, coalesce({r("(d2 - d1) / nullif(cast(n - 1 as double), 0.0)", 2)}, 0.0) as
   avg_days_between_orders, {p("b", "n", 2)} as return_rate_pct, {p("u", "n", 2)} as discount_usage_rate_pct, cast(coalesce({NOW} - d2 > 90,
   false) as bigint) as is_churned from dc left join o using (customer_key))
select *, {r("case when recency_days > 60 then 30.0 else recency_days / 2.0 end + if(total_orders <= 1, 20, 0) + if(return_rate_pct > 20, 10, 0) + if(avg_order_value_cents < 2000, 10, 0)")}
  as churn_risk_score from f""", "fo dc")(
    lambda s_, d: customers.churn_features(dim_customers(s_, d), fact_orders(s_, d), as_of=newest_order(s_, d)),
)

add("ltv_deciles", f"""with c as (select sum(total_cents) as v, customer_key as k from fo where {LIVE}
  group by 2), t as (select v, ntile(10) over (order by v, k) as decile
  from c), g as (select decile, count(*) as n, min(v) as lo, max(v) as hi, avg(v) as a, sum(v) as t from t group by 1)
select decile, cast(n as bigint) as customer_count, {m("lo")} as min_ltv, {m("hi")} as max_ltv, {m("a")} as avg_ltv, {m("t")} as
  total_revenue, {p("t", "(select sum(v) from c)", 1)} as pct_of_total_revenue,
 {p("(select sum(h.t) from g h where h.decile >= g.decile)", "(select sum(v) from c)", 1)} as cumulative_revenue_from_top from g""", "fo")(
    lambda s_, d: customers.ltv_deciles(fact_orders(s_, d)),
)

add("new_vs_returning", f"""with f as (select customer_key, min(ordered_at) as t0 from fo where {LIVE}
  group by 1), x as (select fo.*, ordered_at = t0 as is_new from fo join f using (customer_key) where {LIVE})
select strftime(order_date, '%Y-%m') as year_month, {m("sum(total_cents) filter (where is_new)")} as new_customer_revenue,
  {m("sum(total_cents) filter (where not is_new)")} as returning_customer_revenue, {m("sum(total_cents)")} as total_revenue,
  {n("distinct order_id", "is_new")} as new_orders,
 {n("distinct order_id", "not is_new")} as returning_orders, {n("distinct customer_key", "is_new")} as new_customers,
   {p("sum(total_cents) filter (where not is_new)", "sum(total_cents)", 1)} as returning_revenue_pct from x group by 1""", "fo")(
    lambda s_, d: customers.new_vs_returning(fact_orders(s_, d)),
)

add("cross_sell", f"""with had as (select distinct customer_key, product_key from fo
  where {LIVE}), pop as (select loyalty_tier, product_key, {n("*")} as buyers from had join dc using (customer_key) group by 1, 2),
cats as (select distinct fo.customer_key, loyalty_tier, category_name from fo join dp using (product_key) join dc using (customer_key)
  where fo.customer_key in (select customer_key from had)),
cand as (select c.customer_key, p.product_key, p.category_name, buyers from cats c join dp p using (category_name)
  join pop on pop.product_key = p.product_key and pop.loyalty_tier = c.loyalty_tier anti join had h on h.customer_key = c.customer_key
  and h.product_key = p.product_key)
select customer_key, product_key, category_name, buyers as similar_customers_bought, row_number() over w as recommendation_rank from cand
  window w as (partition by customer_key order by buyers desc, product_key) qualify recommendation_rank <= 5""", "fo dc dp")(
    lambda s_, d: customers.cross_sell(fact_orders(s_, d), dim_products(s_, d), dim_customers(s_, d)),
)

_STATES = {f"{k}_orders": f"count(*) filter (where status = '{k}')" for k in ("cancelled", "refunded")}
_SEEN = {"page_views_90d": "page_view", "product_views_90d": "product_view", "cart_adds_90d": "add_to_cart", "searches_90d": "search"}


@add("customer_360", f"""with o as (select customer_key, count(*) as n, sum(total_cents) as c, avg(total_cents) as a, min(created_at) as t1,
  max(created_at) as t2,
   {", ".join(f"{x} as {k}" for k, x in _STATES.items())}, count(distinct date_trunc('month', created_at)) as k from oh
     where payment_status = 'captured' group by 1),
e as (select customer_key, {", ".join(f"count(*) filter (where event_type = '{t}') as {k}" for k, t in _SEEN.items())}, max(occurred_at) as
  last from fe where {EVENT_NOW} - event_date < 90 group by 1),
v as (select user_id as customer_key, count(*) as reviews, avg(event_id % 5 + 1) as rating from events where event_type = 'purchase'
  group by 1),
x as (select *, {NOW} - t2::date as age from dc left join o using (customer_key) left join e using (customer_key) left
  join v using (customer_key) where customer_key % 9 <> 0)
select customer_key, customer_name, email, country_code, city, loyalty_tier, cast(coalesce(n, 0) as bigint) as total_orders,
  cast(coalesce(c, 0) as bigint) as lifetime_revenue_cents,
 {r("coalesce(a, 0)")} as avg_order_value_cents, t1 as first_order_at, t2 as last_order_at, cast(coalesce(k, 0) as bigint) as active_months,
   cast(age as bigint) as days_since_last_order,
 {", ".join(f"cast(coalesce({k}, 0) as bigint) as {k}" for k in [*_STATES, *_SEEN])}, last as last_event_at, cast(coalesce(reviews, 0) as
   bigint) as total_reviews, {r("rating", 2)} as avg_rating_given,
 case when age is null then 'never_purchased' when age < 30 then 'active' when age < 90 then 'at_risk' when age < 180 then 'lapsing'
   else 'churned' end as engagement_segment,
 case when coalesce(c, 0) <= 0 then 'no_purchases' when c < 50000 then 'low_value' when c < 100000 then 'mid_value'
   else 'high_value' end as value_segment from x""", "oh fe dc")
def _profile(s_: SparkSession, d: str) -> DataFrame:
    dc = dim_customers(s_, d).withColumn("deleted_at", F.when(F.col("customer_key") % 9 == 0, F.lit("2001-01-01")))
    return customers.customer_360(
        dc,
        order_heads(s_, d),
        fact_events(s_, d),
        _reviews(s_, d),
        as_of=newest_order(s_, d),
        as_of_events=newest_event(s_, d),
    )


add("customer_value", f"""select customer_key, email, customer_name, {n("order_id")} as total_orders, cast(coalesce(sum(total_cents), 0) as
  bigint) as lifetime_value_cents, min(created_at) as first_order_at, max(created_at) as last_order_at
from dc left join (select * from oh where status not in ('cancelled', 'refunded')) using (customer_key) group by all""", "oh dc")(
    lambda s_, d: customers.customer_value(dim_customers(s_, d), order_heads(s_, d)),
)

add("ltv_projection", f"""with o as (select customer_key, count(*) as k, min(created_at)::date as d1, max(created_at)::date as d2,
  {s("total_cents")} as c from oh where payment_status = 'captured' group by 1),
x as (select *, greatest(1, datesub('month', d1, (select max(created_at)::date from oh))) as tm
  from o), y as (select *, cast(floor(cast(c as double) / tm * 12 + 0.5) as bigint) as ahead from x)
select customer_key, email, d1 as first_order_date, d2 as last_order_date, cast(k as bigint) as order_count, c as total_revenue_cents,
  {r("c / k", 2)} as avg_order_value_cents, {r("k / tm", 4)} as orders_per_month, cast(tm as bigint) as tenure_months, ahead as
  predicted_ltv_12m_cents,
 case when ahead < 20000 then 'bronze' when ahead < 50000 then 'silver' when ahead < 100000 then 'gold' else 'platinum' end as ltv_tier
   from y join dc using (customer_key)""", "oh dc")(
    lambda s_, d: customers.ltv_projection(order_heads(s_, d), dim_customers(s_, d), as_of=newest_order(s_, d)),
)

_FLAGS = {k: v.replace("'", "''") for k, v in customers.FLAGS.items()}
add("fraud_flags", f"""with o as (select *, (select max(created_at) from oh) as now, shipping_country as ip_address from oh
  where status <> 'cancelled'), h as (select customer_key, avg(total_cents) as a, stddev_samp(total_cents) as sd, count(*) as k from o
  where created_at < now - interval 24 hour group by 1),
q as (select *, count(*) over (partition by customer_key order by created_at range between interval 24 hour preceding
  and current row) as v, count(*) over (partition by ip_address order by created_at range between interval 1 hour preceding
  and current row) as ip from o where created_at > now - interval 720 hour),
f as (select q.*, v > 5 as f1, ip > 3 as f2, total_cents > 50000 as f3, coalesce(sd > 0
  and total_cents > a + 3 * sd, false) as f4, k is null as f5, shipping_country not in ('US', 'CA', 'GB', 'AU') as f6 from q left
  join h using (customer_key))
select order_id, customer_key, total_cents, cast(least(100, f1::int * 25 + f2::int * 30 + f3::int * 15 + f4::int * 25 + f5::int * 10 +
  f6::int * 15) as bigint) as risk_score,
 concat_ws('; ', {", ".join(f"case when f{i} then '{t}' end" for i, t in enumerate(_FLAGS.values(), 1))}) as risk_flags,
 case when f1::int * 25 + f2::int * 30 + f3::int * 15 + f5::int * 10 >= 70 then 'BLOCK'
   when f1::int * 25 + f2::int * 30 + f3::int * 15 >= 40 then 'REVIEW' else 'ALLOW' end as recommendation from f
   where f1 or f2 or f3 or f4 or f5 or f6""", "oh")(
    lambda s_, d: customers.fraud_flags(order_heads(s_, d).withColumn("ip_address", F.col("shipping_country")), hours=720),
)

# --- marketing ---------------------------------------------------------------------------------------------------

add("attribution", f"""with t as (select *, row_number() over (partition by customer_key order by occurred_at, event_id) as i, count(*)
  over (partition by customer_key) as k from fe where utm_source is not null and event_type in ('page_view', 'product_view')),
v as (select customer_key, sum(total_cents) as c from fo where {LIVE}
  group by 1), x as (select *, if(i = 1, c, 0) as f, if(i = k, c, 0) as l, floor(c / cast(k as double) + 0.5) as e from t
  join v using (customer_key))
select utm_source, utm_medium, {n("distinct customer_key")} as attributed_customers, {m("sum(f)")} as first_touch_revenue, {m("sum(l)")} as
  last_touch_revenue, {m("sum(e)")} as linear_revenue, {p("sum(f) - sum(l)", "sum(l)", 1)} as first_vs_last_pct_diff from x group by 1, 2""", "fo fe")(
    lambda s_, d: marketing.attribution(fact_events(s_, d), fact_orders(s_, d)),
)

_STEP = {"page_view": "a", "product_view": "b", "add_to_cart": "c", "checkout_start": "d", "purchase": "e"}
_DAY = f"day as (select event_date, {', '.join(f'''count(distinct if(event_type = '{k}', session_id, null)) as {v}''' for k, v in _STEP.items())} from fe group by 1)"
add("funnel_monthly", f"""with {_DAY}, t as (select strftime(event_date, '%Y-%m') as year_month,
  {", ".join(f"sum({v}) as {v}" for v in _STEP.values())} from day where event_date >= {EVENT_NOW} - 30 group by 1)
select year_month, {", ".join(f"cast({v} as bigint) as {x}" for v, x in zip("abcde", ("total_sessions", "total_product_views", "total_cart_adds", "total_checkouts", "total_purchases"), strict=True))},
 {p("b", "a", 2)} as session_to_pv_rate, {p("c", "b", 2)} as pv_to_atc_rate, {p("d", "c", 2)} as atc_to_checkout_rate, {p("e", "d", 2)} as
   checkout_to_purchase_rate, {p("e", "a", 3)} as overall_conversion_rate, {p("c - e", "c", 2)} as cart_abandonment_rate from t""", "fe")(
    lambda s_, d: marketing.funnel_monthly(fact_events(s_, d), as_of=newest_event(s_, d)),
)
add("funnel_daily", f"""with {_DAY} select event_date, {", ".join(f"cast({v} as bigint) as {x}" for v, x in zip("abcde", ("sessions", "product_views", "cart_adds", "checkout_starts", "purchases"), strict=True))},
 {p("b", "a", 2)} as pv_session_rate, {p("c", "b", 2)} as atc_pv_rate, {p("d", "c", 2)} as checkout_atc_rate, {p("e", "d", 2)} as
   purchase_checkout_rate, {p("e", "a", 2)} as overall_conversion_rate from day""", "fe")(
    lambda s_, d: marketing.funnel_daily(fact_events(s_, d)),
)
add("funnel_steps", f"""with c as (select event_type, list_position(['page_view', 'product_view', 'add_to_cart', 'checkout_start',
  'purchase'], event_type) as i, {n("distinct session_id")} as k from fe where event_date >= {EVENT_NOW} - 30 group by 1)
select c.event_type, c.k as sessions, b.k as prev_step_sessions, {r("c.k * 100.0 / (select k from c where i = 1)", 1)} as pct_of_top from c
  left join c b on b.i = c.i - 1 where c.i is not null""", "fe")(
    lambda s_, d: marketing.funnel_steps(fact_events(s_, d), as_of=newest_event(s_, d)),
)

_SESSIONS = (
    "select concat('a', cast(user_id % 97 as varchar)) as anonymous_id, case when event_id % 3 > 0 "
    "then user_id end as customer_key, ts as started_at, event_id from events"
)


def _stitched(spark: SparkSession, d: str) -> DataFrame:
    events = fact_events(spark, d).withColumn("anonymous_id", F.concat(F.lit("a"), (F.col("customer_key") % 97).cast("string")))
    sessions = events.select(
        "anonymous_id",
        F.when(F.col("event_id") % 3 > 0, F.col("customer_key")).alias("customer_key"),
        F.col("occurred_at").alias("started_at"),
    )
    open_events = events.withColumn("customer_key", F.when(F.col("event_id") % 2 > 0, F.col("customer_key"))).select(
        "event_id",
        "anonymous_id",
        "customer_key",
    )
    return marketing.stitch_identity(open_events, sessions)


add("identity_stitch", f"""with s as ({_SESSIONS}), k as (select anonymous_id, customer_key as known from s where customer_key is not null
  qualify row_number() over (partition by anonymous_id order by started_at desc, customer_key desc) = 1)
select event_id, s.anonymous_id, coalesce(case when event_id % 2 > 0 then user_id end, known) as customer_key
  from (select *, concat('a', cast(user_id % 97 as varchar)) as anonymous_id from events) s left join k using (anonymous_id)""")(_stitched)

# --- products ----------------------------------------------------------------------------------------------------

DAYS = ("2001-07-01", "2001-08-01")


def snapshots(spark: SparkSession, d: str) -> DataFrame:
    inv, dp = inventory(spark, d), dim_products(spark, d)
    return products.snapshot_inventory(inv, dp, DAYS[0]).unionByName(products.snapshot_inventory(inv, dp, DAYS[1]))


_SNAP = (
    "snap as (select cast(d as date) as snapshot_date, product_key, warehouse_id, category_name, quantity_on_hand, quantity_reserved, "
    "quantity_on_hand - quantity_reserved as quantity_available, reorder_point, unit_cost_cents, quantity_on_hand * unit_cost_cents as "
    "inventory_value_cents from inv join dp using (product_key) cross join (values ('2001-07-01'), ('2001-08-01')) t(d))"
)
add("inventory_snapshot", f"with {_SNAP} select * from snap", "inv dp")(snapshots)
add("inventory_turnover", f"""with {_SNAP}, v as (select category_name, avg(inventory_value_cents) as v from snap
  group by 1), c as (select category_name, cast(sum(quantity * base_price_cents) as double) * 0.6 as c from fo join dp using (product_key)
  where {LIVE} and order_date >= {NOW} - interval 12 month group by 1)
select category_name, {m("c")} as annual_cogs, {m("v")} as avg_inventory_value, {r("c / nullif(v, 0)", 2)} as inventory_turnover_ratio,
  {r("365.0 / nullif(c / nullif(v, 0), 0)", 1)} as days_sales_of_inventory from c join v using (category_name)""", "fo inv dp")(
    lambda s_, d: products.inventory_turnover(fact_orders(s_, d), snapshots(s_, d), dim_products(s_, d), as_of=newest_order(s_, d)),
)
add("inventory_health", f"""with {_SNAP} select category_name, {n("*")} as sku_count, {n("*", "quantity_on_hand = 0")} as out_of_stock,
  {n("*", "quantity_on_hand between 1 and reorder_point")} as low_stock, {n("*", "quantity_on_hand > 10 * reorder_point")} as overstocked,
  {r("avg(quantity_on_hand)")} as avg_qty_on_hand
from snap where snapshot_date = date '2001-08-01' group by 1""", "inv dp")(lambda s_, d: products.inventory_health(snapshots(s_, d)))
add("inventory_status", f"""with s as (select product_key, {r("sum(quantity) / 30.0", 2)} as pace from fo where {LIVE}
  and {NOW} - order_date < 30 group by 1), x as (select *, quantity_on_hand - quantity_reserved as have from inv join dp using (product_key)
  left join s using (product_key))
select product_key, sku, product_name, category_name, base_price_cents, warehouse_id, quantity_on_hand, quantity_reserved, have as
  quantity_available, reorder_point, case when have <= 0 then 'out_of_stock' when have > reorder_point then 'in_stock'
  else 'low_stock' end as stock_status, cast(case when pace > 0 then {r("have / pace")} end as bigint) as days_of_stock from x""", "fo inv dp")(
    lambda s_, d: products.inventory_status(inventory(s_, d), dim_products(s_, d), fact_orders(s_, d), as_of=newest_order(s_, d)),
)

_ITEMS = f"items as (select distinct order_id, product_key as item from fo where {LIVE})"
_BRANDS = f"items as (select distinct order_id, brand as item from fo join dp using (product_key) where {LIVE})"
add("basket_pairs", f"""with {_ITEMS}, k as (select item, count(*) as k from items
  group by 1), q as (select a.item as a, b.item as b, count(*) as ab from items a join items b on a.order_id = b.order_id
  and a.item < b.item group by all having count(*) >= 10), t as (select count(distinct order_id) as t from items)
select a as item_a, b as item_b, cast(ab as bigint) as co_purchase_count, cast(x.k as bigint) as orders_a, cast(y.k as bigint) as orders_b,
  {p("ab", "t", 3)} as support_pct, {p("ab", "x.k", 1)} as confidence_a_to_b_pct,
  {r("cast(ab as double) * cast(t as double) / (cast(x.k as double) * cast(y.k as double))", 2)} as lift
from q join k x on x.item = a join k y on y.item = b cross join t order by lift desc, co_purchase_count desc, item_a, item_b limit 100""", "fo dp")(
    lambda s_, d: products.basket_pairs(fact_orders(s_, d), dim_products(s_, d)),
)
add("item_similarity", f"""with w as (select customer_key, product_key as item, sum(quantity) as q from fo where {LIVE}
  group by all), v as (select customer_key, item, cast(floor(cast(q as double) * 1000000 / sum(q)
  over (partition by customer_key)) as bigint) as v from w),
g as (select a.item as a, b.item as b, {n("*")} as k, sum(a.v * b.v) as ab, sum(a.v * a.v) as aa, sum(b.v * b.v) as bb from v a
  join v b on a.customer_key = b.customer_key and a.item < b.item where a.v > 0 and b.v > 0
  group by all), h as (select a, b, k, {r("cast(ab as double) / (sqrt(cast(aa as double)) * sqrt(cast(bb as double)))", 4)} as c from g
  where k >= 5)
select a as item_a, b as item_b, k as common_customers, c as cosine_similarity, rank() over (partition by a
  order by c desc) as similarity_rank from h where c > 0.1 order by c desc, a, b limit 200""", "fo dp")(
    lambda s_, d: products.item_similarity(fact_orders(s_, d), dim_products(s_, d)),
)
add(
    "item_similarity_full",
    SQL["item_similarity"]
    .replace("h as (select a, b, k,", "l as (select item, sum(v * v) as vv from v where v > 0 group by 1), h as (select a, b, k,")
    .replace("sqrt(cast(aa as double)) * sqrt(cast(bb as double))", "sqrt(cast(x.vv as double)) * sqrt(cast(y.vv as double))")
    .replace("as c from g\n", "as c from g join l x on x.item = a join l y on y.item = b\n"),
)(lambda s_, d: products.item_similarity(fact_orders(s_, d), dim_products(s_, d), norms="all"))
add("basket_pairs_brand", SQL["basket_pairs"].replace(_ITEMS, _BRANDS))(
    lambda s_, d: products.basket_pairs(fact_orders(s_, d), dim_products(s_, d), level="brand"),
)
add(
    "item_similarity_brand",
    SQL["item_similarity"].replace(
        "product_key as item, sum(quantity) as q from fo where",
        "brand as item, sum(quantity) as q from fo join dp using (product_key) where",
    ),
)(lambda s_, d: products.item_similarity(fact_orders(s_, d), dim_products(s_, d), level="brand"))
add("return_rates", f"""with t as (select product_key, count(distinct order_id) as k, count(distinct if({BACK}, order_id, null)) as b,
  sum(total_cents) as c, sum(if({BACK}, total_cents, 0)) as bc from fo where {LIVE} group by 1)
select product_key, product_name, category_name, brand, cast(k as bigint) as total_orders, cast(b as bigint) as returned_orders,
  {p("b", "k", 2)} as return_rate_pct, {m("c")} as total_revenue, {m("bc")} as total_refunded, {p("bc", "c", 2)} as refund_rate_pct from t
  join dp using (product_key) where k >= 10 order by return_rate_pct desc, total_orders desc, product_key limit 50""", "fo dp")(
    lambda s_, d: products.return_rates(fact_orders(s_, d), dim_products(s_, d)),
)
add("top_products", f"""with t as (select product_key, sum(quantity) as q, sum(total_cents) as c, count(distinct customer_key) as u from fo
  where {SOLD} group by 1)
select sku, product_name, category_name, cast(q as bigint) as units_sold, {m("c")} as total_revenue, {m("q * unit_cost_cents")} as
  total_cost, {p("c - q * unit_cost_cents", "c", 1)} as gross_margin_pct, cast(u as bigint) as unique_customers from t
  join dp using (product_key) join inv using (product_key) order by c desc, product_key limit 10""", "fo dp inv")(
    lambda s_, d: products.top_products(fact_orders(s_, d), dim_products(s_, d), inventory(s_, d)),
)
add("product_performance", f"""with sl as (select product_key, {s("quantity")} as u, {n("distinct order_id")} as k, {s("total_cents")} as c,
  {n("distinct customer_key")} as cu, min(order_date) as d1, max(order_date) as d2, {n(f"distinct if({BACK}, order_id, null)")} as b from fo
  where {LIVE} and payment_status = 'captured' group by 1),
ev as (select product_key, {n("*", "event_type = 'product_view'")} as v, {n("*", "event_type = 'add_to_cart'")} as a from fe
  where {EVENT_NOW} - event_date < 90 group by 1)
select product_key, sku, product_name, category_name, base_price_cents, coalesce(u, 0) as units_sold, coalesce(k, 0) as order_count,
  coalesce(c, 0) as revenue_cents, coalesce(cu, 0) as unique_customers, d1 as first_sale_date, d2 as last_sale_date, {p("b", "k", 2)} as
  return_rate_pct, {p("coalesce(k, 0)", "a", 2)} as cart_conversion_rate_pct, coalesce(v, 0) as views_90d, coalesce(a, 0) as cart_adds_90d
from dp left join sl using (product_key) left join ev using (product_key)""", "fo fe dp")(
    lambda s_, d: products.product_performance(dim_products(s_, d), fact_orders(s_, d), fact_events(s_, d), as_of=newest_event(s_, d)),
)
add(
    "low_stock",
    "select product_key, sku, product_name, category_name, quantity_on_hand as stock_qty, base_price_cents from inv "
    "join dp using (product_key) where quantity_on_hand <= 10",
    "inv dp",
)(lambda s_, d: products.low_stock(inventory(s_, d), dim_products(s_, d)))


def _reviews(spark: SparkSession, d: str) -> DataFrame:
    """Events as stand-in for reviews: purchases are published, the value's size is the rating."""
    return fact_events(spark, d).select(
        "product_key",
        "customer_key",
        F.when(F.col("event_type") == "purchase", "published").otherwise("draft").alias("status"),
        (F.col("event_id") % 5 + 1).alias("rating"),
    )


add("product_rating", f"""with v as (select event_id % 200 as product_key, event_id % 5 + 1 as rating from events
  where event_type = 'purchase') select product_key, {n("rating")} as review_count, {r("avg(rating)", 2)} as avg_rating from dp left
  join v using (product_key) group by 1""", "dp")(lambda s_, d: products.product_rating(_reviews(s_, d), dim_products(s_, d)))
add("price_history", """with v as (select l_partkey as product_key, cast(o_orderdate as date) as effective_from,
  cast(floor(max(l_extendedprice / l_quantity) * 100 + 0.5) as bigint) as price from lineitem join orders on l_orderkey = o_orderkey
  group by 1, 2),
w as (select *, lag(price) over (partition by product_key order by effective_from) as old from v)
  select product_key, old as old_price_cents, price as new_price_cents, effective_from from w where old <> price""")(
    lambda s_, d: products.price_history(
        fact_orders(s_, d).groupBy("product_key", F.col("order_date").alias("effective_from")).agg(
            F.max("unit_price_cents").alias("price_cents"),
        ),
    ),
)

# --- revenue -----------------------------------------------------------------------------------------------------

add("revenue_growth", f"""with t as (select order_date as d, sum(total_cents) as c, {n("distinct order_id")} as o,
  {n("distinct customer_key")} as u from fo where {LIVE} and order_date >= {NOW} - 90 group by 1), x as (select *, lag(c)
  over w as c1, lag(c, 7) over w as c7, avg(c) over (order by d rows 6 preceding) as m7, avg(c)
  over (order by d rows 29 preceding) as m30, sum(c) over (partition by year(d) order by d) as y from t window w as (order by d))
select d as full_date, dayname(d) as day_name, isodow(d) > 5 as is_weekend, cast(c as bigint) as revenue_cents, o as order_count, u as
  unique_customers, cast(c1 as bigint) as prev_day_revenue, {p("c - c1", "c1", 1)} as dod_growth_pct, cast(c7 as bigint) as
  same_day_last_week, {p("c - c7", "c7", 1)} as wow_growth_pct, {r("m7")} as ma7_revenue, {r("m30")} as ma30_revenue, cast(y as bigint) as
  ytd_revenue from x""", "fo")(lambda s_, d: revenue.revenue_growth(fact_orders(s_, d), as_of=newest_order(s_, d)))
add(
    "revenue_growth_filled",
    SQL["revenue_growth"]
    .replace("t as (select order_date as d", "t0 as (select order_date as d")
    .replace(
        "group by 1), x as (",
        "group by 1), t as (select cast(g as date) as d, coalesce(c, 0) as c, coalesce(o, 0) as o, coalesce(u, 0) as u "
        "from generate_series((select min(d)::timestamp from t0), (select max(d)::timestamp from t0), interval 1 day) s(g) left join t0 on t0.d = cast(g as date)), x as (",
    ),
)(lambda s_, d: revenue.revenue_growth(fact_orders(s_, d), as_of=newest_order(s_, d), fill=True))
add("geo_heatmap", f"""with x as (select shipping_country, state_province, city, customer_key, order_id, total_cents, year({NOW}) -
  year(order_date) as ago from fo join dc using (customer_key) where {LIVE}),
g as (select shipping_country, state_province, city, sum(total_cents) filter (where ago = 0) as c, sum(total_cents) filter (where ago = 1)
  as q, {n("distinct order_id", "ago = 0")} as o, {n("distinct customer_key", "ago = 0")} as u from x where ago in (0, 1) group by 1, 2, 3)
select shipping_country, state_province, city, {m("c")} as current_year_revenue, {m("q")} as prior_year_revenue, o as current_orders, u as
  current_customers, {p("c - q", "q", 1)} as yoy_growth_pct, rank() over (partition by shipping_country order by c desc) as rank_in_country
  from g where c is not null""", "fo dc")(
    lambda s_, d: revenue.geo_heatmap(fact_orders(s_, d), dim_customers(s_, d), as_of=newest_order(s_, d)),
)
add("seasonality", f"""with t as (select date_trunc('week', order_date)::date as w, sum(total_cents) as c from fo where {LIVE}
  and order_date >= {NOW} - interval 24 month group by 1), x as (select *, avg(c) over (order by w rows between 2 preceding
  and 2 following) as a, avg(c) over (order by w rows between 6 preceding and 6 following) as b
  from t), y as (select *, {p("c", "b", 1)} as i from x)
select w as week_start, cast(c as bigint) as weekly_revenue, {r("a")} as trend_4_week, {r("b")} as trend_12_week, i as seasonality_index,
  case when i < 85 then 'Low Season' when i < 95 then 'Below Average' when i <= 105 then 'Normal' when i <= 115 then 'Above Average'
  else 'High Season' end as season_classification from y""", "fo")(
    lambda s_, d: revenue.seasonality(fact_orders(s_, d), as_of=newest_order(s_, d)),
)
add("peak_hours", f"""with t as (select hour(ordered_at) as h, isodow(order_date) as d, count(distinct order_id) as k, sum(total_cents) as
  c, avg(total_cents) as a from fo where {LIVE} and order_date >= {NOW} - 90
  group by 1, 2), g as (select h, {s("k")} as k, sum(c) as c, avg(a) as a, {s("k", "d < 6")} as wd, {s("k", "d > 5")} as we from t
  group by 1)
select h as hour_of_day, k as total_orders, {m("c")} as total_revenue, {r("a / 100.0", 1)} as avg_order_value, wd as weekday_orders, we as
  weekend_orders, {p("k", "(select sum(k) from g)", 2)} as pct_of_daily_orders, rank() over (order by k desc) as volume_rank from g""", "fo")(
    lambda s_, d: revenue.peak_hours(fact_orders(s_, d), as_of=newest_order(s_, d)),
)
add("discount_effect", f"""with t as (select coalesce(discount_code, 'NO_DISCOUNT') as k, {n("distinct order_id")} as o,
  {n("distinct customer_key")} as u, sum(total_cents) as g, sum(discount_cents) as d, avg(total_cents) as a from fo where {LIVE}
  group by 1),
f as (select x.discount_code as k, {n("distinct y.order_id")} as f from (select distinct customer_key, discount_code, ordered_at from fo
  where discount_code is not null) x join (select distinct customer_key, order_id, ordered_at from fo
  where {LIVE}) y on y.customer_key = x.customer_key and y.ordered_at > x.ordered_at group by 1)
select k as discount_code, o as order_count, u as unique_customers, {m("g")} as gross_revenue, {m("d")} as total_discounts_given,
  {m("g - d")} as net_revenue, {m("a")} as avg_order_value, {p("d", "g", 2)} as discount_pct_of_gross, coalesce(f, 0) as follow_on_orders,
  {p("coalesce(f, 0)", "o", 1)} as follow_on_conversion_rate_pct from t left join f using (k)""", "fo")(
    lambda s_, d: revenue.discount_effect(fact_orders(s_, d)),
)
add("revenue_forecast", f"""with t as (select date_trunc('month', order_date)::date as mo, sum(total_cents) as c from fo where {LIVE}
  and order_date >= date_trunc('month', {NOW}) - interval 12 month group by 1), x as (select *, row_number() over (order by mo) as i
  from t), l as (select regr_slope(c, i) as sl, regr_intercept(c, i) as ic, max(i) as last from x)
select mo as month, {m("c")} as actual_revenue, {r("(sl * i + ic) / 100.0", 1)} as trend_revenue, cast(null as double) as forecast_revenue,
  'actual' as data_type from x, l
union all select cast(date_trunc('month', {NOW}) + to_months(cast(k as int)) as date), null, null, {r("(sl * (last + k) + ic) / 100.0", 1)},
  'forecast' from l, range(1, 4) g(k)""", "fo")(lambda s_, d: revenue.revenue_forecast(fact_orders(s_, d), as_of=newest_order(s_, d)))
add("kpi_dashboard", f"""with x as (select *, date_diff('month', order_date, {NOW}) as ago from fo where {LIVE})
select {NOW} as report_date, {m("sum(total_cents) filter (where ago = 0)")} as mtd_revenue, {m("sum(total_cents) filter (where ago = 1)")}
  as prior_month_revenue, {p("sum(total_cents) filter (where ago = 0) - sum(total_cents) filter (where ago = 1)", "sum(total_cents) filter (where ago = 1)", 1)}
  as mom_growth_pct, {n("distinct order_id", "ago = 0")} as mtd_orders,
 {n("distinct customer_key", "ago = 0")} as mtd_customers, {m("avg(total_cents) filter (where ago = 0)")} as mtd_aov,
   {m(f"sum(total_cents) filter (where year(order_date) = year({NOW}))")} as ytd_revenue,
   {n("distinct order_id", f"year(order_date) = year({NOW})")} as ytd_orders from x""", "fo")(
    lambda s_, d: revenue.kpi_dashboard(fact_orders(s_, d), as_of=newest_order(s_, d)),
)
add("monthly_revenue", f"""with t as (select date_trunc('month', order_date) as mo, count(distinct order_id) as k, sum(total_cents) as c
  from fo where {SOLD} and order_date >= {NOW} - interval 12 month group by 1), x as (select *, lag(c) over (order by mo) as b from t)
select year(mo) as year, monthname(mo) as month_name, cast(k as bigint) as total_orders, {m("c")} as total_revenue, {r("c / 100.0 / k", 2)}
  as avg_order_value, {m("b")} as prev_month_revenue, {p("c - b", "b", 2)} as mom_growth_pct from x""", "fo")(
    lambda s_, d: revenue.monthly_revenue(fact_orders(s_, d), as_of=newest_order(s_, d)),
)
add("geo_top15", f"""select shipping_country as country_name, r_name as region, {n("distinct order_id")} as orders, {m("sum(total_cents)")}
  as revenue, {r("sum(total_cents) / 100.0 / count(distinct order_id)", 2)} as aov from fo join nation on n_name = shipping_country
  join region on r_regionkey = n_regionkey where {SOLD} group by 1, 2 order by sum(total_cents) desc, 1 limit 15""", "fo")(
    lambda s_, d: revenue.geo_top(fact_orders(s_, d), dim_customers(s_, d)),
)
add("daily_sales", f"""with f as (select customer_key, min(created_at) as t0 from oh where status <> 'cancelled' group by 1)
  select created_at::date as sale_date, {n("distinct order_id")} as order_count, {n("distinct customer_key")} as unique_customers,
  {s("total_cents")} as gross_revenue_cents, {s("discount_cents")} as total_discounts_cents, {s("shipping_cents")} as total_shipping_cents,
  {s("tax_cents")} as total_tax_cents,
 {s("total_cents - shipping_cents - tax_cents")} as net_revenue_cents, cast({r("avg(total_cents)")} as bigint) as avg_order_value_cents,
   {n("*", "status = 'cancelled'")} as cancelled_orders, {n("*", "status = 'refunded'")} as refunded_orders,
   {n("distinct customer_key", "t0 is null or t0 >= date_trunc('day', created_at)")} as new_customer_count,
   {n("*", "payment_method = 'credit_card'")} as credit_card_orders, {n("*", "payment_method = 'paypal'")} as paypal_orders
from oh left join f using (customer_key) where payment_status = 'captured' group by 1""", "oh")(
    lambda s_, d: revenue.daily_sales(order_heads(s_, d)),
)
add("revenue_by_category", f"""select category_name, {n("distinct order_id")} as order_count, {s("quantity")} as units_sold,
  {s("total_cents")} as revenue_cents, {r("avg(unit_price_cents)", 2)} as avg_unit_price_cents from fo join dp using (product_key)
  where {SOLD} and {NOW} - order_date <= 90 group by 1""", "fo dp")(
    lambda s_, d: revenue.revenue_by_category(fact_orders(s_, d), dim_products(s_, d), as_of=newest_order(s_, d)),
)
