"""Registry of the business reports with their oracle SQL."""

from __future__ import annotations

from functools import partial

from salesprism.plans import reports as r
from salesprism.plans.registry import (
    NamedQuery,
    big,
    sql_mean2,
    sql_percent2,
    sql_signed_percent2,
    sql_units,
)

ORDERS = "count(distinct order_id)"
REVENUE = sql_units("sum(amount_cents)")
AOV = sql_mean2()
QTY = big("sum(qty)")
SHARE = sql_percent2("sum(amount_cents)", "sum(sum(amount_cents)) over ()")
LINES = "with sales as ({sales}) "
CANCELLED = big("sum(case when status='Cancelled' then 1 else 0 end)")
DELIVERED = big("sum(case when status='Delivered' then 1 else 0 end)")
SHIPPED = big("sum(case when status='Shipped' then 1 else 0 end)")
RETURNED = big("sum(case when status='Returned' then 1 else 0 end)")
PROMO = "case when promotion_ids='No Promotion' then 'No Promotion' else 'With Promotion' end"
MONTHLY = (
    LINES + ", m as (select year, month, month_name, count(distinct order_id) as o, "
    "sum(qty) as q, sum(amount_cents) as s, count(*) as n from sales group by all) "
)
MONTH_HEAD = (
    f"year, month, month_name, o as total_orders, {big('q')} as total_qty, "
    f"{sql_units('s')} as total_revenue, {sql_mean2('s', 'n')} as avg_order_value"
)


def _trend(previous: str) -> str:
    return (
        MONTHLY + f", t as (select *, {previous} as p from m) select {MONTH_HEAD}, "
        f"{sql_units('(s-p)')} as mom_revenue_change, {sql_signed_percent2('s-p', 'p')} as mom_growth_pct from t"
    )


def _money_text(cents: str) -> str:
    return (
        f"'₹ ' || format('{{:,}}', cast({cents} as bigint)//100) || '.' || "
        f"lpad(cast(cast({cents} as bigint)%100 as varchar), 2, '0')"
    )


_CITY = "ship_city != 'Unknown'"
_STATE = "ship_state != 'Unknown'"
_C = NamedQuery

# fixed values: the titles and the result column names
NAMED = [
    _C(
        "q01_overall_kpis", "Overall Business KPIs", r.overall_kpis,
        ("order_id", "qty", "amount_cents"),
        LINES + f"select {ORDERS} as total_orders, {QTY} as total_quantity_sold, "
        f"{REVENUE} as total_revenue_inr, {AOV} as avg_order_value, "
        f"{sql_mean2('sum(amount_cents)', ORDERS)} as revenue_per_order, "
        f"{sql_units('min(amount_cents)')} as min_order_value, "
        f"{sql_units('max(amount_cents)')} as max_order_value from sales",
    ),
    _C(
        "q02_status_distribution", "Order Status Distribution", r.status_distribution,
        ("order_id", "status", "amount_cents", "qty"),
        LINES + f"select status, count(*) as order_count, "
        f"{sql_percent2('count(*)', 'sum(count(*)) over ()')} as pct_of_total, "
        f"{REVENUE} as total_revenue, {AOV} as avg_order_value from sales group by status",
    ),
    _C(
        "q03_b2b_split", "B2B vs B2C Revenue Split", r.b2b_split,
        ("order_id", "b2b", "qty", "amount_cents"),
        LINES + f"select b2b as customer_type, {ORDERS} as orders, {QTY} as qty_sold, "
        f"{REVENUE} as total_revenue, {AOV} as avg_order_value, {SHARE} as revenue_pct "
        "from sales group by b2b",
    ),
    _C(
        "q04_monthly_trend", "Monthly Revenue Trend", r.monthly_trend,
        ("order_id", "qty", "amount_cents", "year", "month", "month_name"),
        _trend("lag(s, 1, s) over (order by year, month)"),
    ),
    _C(
        "q04_monthly_trend_blank_first", "Monthly Revenue Trend, first change blank",
        partial(r.monthly_trend, first_change_is_zero=False),
        ("order_id", "qty", "amount_cents", "year", "month", "month_name"),
        _trend("lag(s) over (order by year, month)").replace(
            "case when (s-p) < 0 then", "case when p is null then null when (s-p) < 0 then"
        ),
    ),
    _C(
        "q05_quarterly_performance", "Quarterly Performance", r.quarterly_performance,
        ("order_id", "qty", "amount_cents", "year", "quarter"),
        LINES + f"select year, quarter, {ORDERS} as total_orders, {QTY} as total_qty, "
        f"{REVENUE} as total_revenue, {AOV} as avg_order_value from sales group by year, quarter",
    ),
    _C(
        "q06_weekday_pattern", "Day-of-Week Revenue Pattern", r.weekday_pattern,
        ("order_id", "qty", "amount_cents", "day_name"),
        LINES + f"select day_name, {ORDERS} as total_orders, {QTY} as total_qty, "
        f"{REVENUE} as total_revenue, {AOV} as avg_order_value from sales group by day_name",
    ),
    _C(
        "q07_weekly_revenue", "Weekly Revenue Trend", r.weekly_revenue,
        ("order_id", "qty", "amount_cents", "year", "week_number"),
        LINES + f"select year, week_number, {ORDERS} as total_orders, "
        f"{REVENUE} as weekly_revenue, {AOV} as avg_order_value from sales group by year, week_number",
    ),
    _C(
        "q07_weekly_revenue_in_year", "Weekly Revenue, weeks inside the year", r.weekly_revenue_in_year,
        ("order_id", "amount_cents", "order_date"),
        LINES + "select year(order_date) as year, "
        "(dayofyear(order_date) - isodow(order_date) + 10)//7 as week_number, "
        f"cast(min(order_date) as varchar) as week_start, {ORDERS} as total_orders, "
        f"{REVENUE} as weekly_revenue from sales group by 1, 2",
    ),
    _C(
        "q07_weekly_revenue_iso_year", "Weekly Revenue by ISO year", r.iso_weekly_revenue,
        ("order_id", "qty", "amount_cents", "order_date"),
        LINES + "select isoyear(order_date) as iso_year, week(order_date) as week_number, "
        f"{ORDERS} as total_orders, {REVENUE} as weekly_revenue, {AOV} as avg_order_value "
        "from sales group by 1, 2",
    ),
    _C(
        "q08_category_revenue", "Revenue by Category", r.category_revenue,
        ("order_id", "category", "qty", "amount_cents"),
        LINES + f"select category, {ORDERS} as total_orders, {QTY} as total_qty, "
        f"{REVENUE} as total_revenue, {AOV} as avg_order_value, {SHARE} as revenue_pct "
        "from sales group by category",
    ),
    _C(
        "q09_top_products_by_revenue", "Top 10 Products by Revenue", r.top_products_by_revenue,
        ("order_id", "sku", "style", "category", "qty", "amount_cents"),
        LINES + ", priced as (select *, case when qty = 0 then amount_cents "
        "else (2*amount_cents+qty)//(2*qty) end as price from sales) "
        f"select sku, style, category, {ORDERS} as total_orders, {QTY} as qty_sold, "
        f"{REVENUE} as total_revenue, {sql_mean2('sum(price)')} as avg_unit_price "
        "from priced group by sku, style, category "
        "order by sum(amount_cents) desc, sku, style, category limit 10",
    ),
    _C(
        "q10_top_products_by_quantity", "Top 10 Products by Quantity", r.top_products_by_quantity,
        ("order_id", "sku", "style", "category", "qty", "amount_cents"),
        LINES + f"select sku, style, category, {QTY} as qty_sold, {REVENUE} as total_revenue, "
        f"{AOV} as avg_order_value from sales group by sku, style, category "
        "order by sum(qty) desc, sku, style, category limit 10",
    ),
    _C(
        "q11_category_by_month", "Category Monthly Breakdown", r.category_by_month,
        ("order_id", "category", "qty", "amount_cents", "month", "month_name"),
        LINES + f"select category, month_name, month, {ORDERS} as orders, {REVENUE} as revenue, "
        f"{QTY} as qty_sold from sales group by category, month_name, month",
    ),
    _C(
        "q12_size_distribution", "Size Distribution by Category", r.size_distribution,
        ("order_id", "category", "size", "qty", "amount_cents"),
        LINES + f"select category, size, {ORDERS} as orders, {QTY} as qty_sold, "
        f"{REVENUE} as revenue from sales group by category, size",
    ),
    _C(
        "q13_top_states", "Top States by Revenue", r.top_states,
        ("order_id", "ship_state", "qty", "amount_cents"),
        LINES + f"select ship_state, {ORDERS} as total_orders, {QTY} as total_qty, "
        f"{REVENUE} as total_revenue, {AOV} as avg_order_value, "
        f"{sql_percent2('sum(amount_cents)', '(select sum(amount_cents) from sales)')} as revenue_pct "
        f"from sales where {_STATE} group by ship_state "
        "order by sum(amount_cents) desc, ship_state limit 15",
    ),
    _C(
        "q13_top_states_known_share", "Top States, share of known states", r.top_state_kpis,
        ("order_id", "ship_state", "qty", "amount_cents"),
        LINES + f"select ship_state, {ORDERS} as total_orders, {QTY} as total_qty, "
        f"{REVENUE} as total_revenue, {AOV} as avg_order_value, {SHARE} as revenue_pct "
        f"from sales where {_STATE} group by ship_state "
        "order by sum(amount_cents) desc, ship_state limit 10",
    ),
    _C(
        "q14_top_cities", "Top 15 Cities by Orders", r.top_cities,
        ("order_id", "ship_city", "ship_state", "qty", "amount_cents"),
        LINES + f"select ship_city, ship_state, {ORDERS} as total_orders, {QTY} as qty_sold, "
        f"{REVENUE} as total_revenue, {AOV} as avg_order_value from sales where {_CITY} "
        "group by ship_city, ship_state order by total_orders desc, ship_city, ship_state limit 15",
    ),
    _C(
        "q15_state_cancellation", "State-Level Cancellation Rates", r.state_cancellation,
        ("order_id", "ship_state", "status"),
        LINES + f"select ship_state, count(*) as total_orders, {DELIVERED} as delivered, "
        f"{SHIPPED} as shipped, {CANCELLED} as cancelled, {RETURNED} as returned, "
        f"{sql_percent2(CANCELLED, 'count(*)')} as cancel_rate_pct from sales where {_STATE} "
        "group by ship_state order by cancel_rate_pct desc, ship_state limit 15",
    ),
    _C(
        "q16_channel_revenue", "Sales Channel Revenue", r.channel_revenue,
        ("order_id", "sales_channel", "qty", "amount_cents"),
        LINES + f"select sales_channel, {ORDERS} as total_orders, {QTY} as qty_sold, "
        f"{REVENUE} as total_revenue, {AOV} as avg_order_value, {SHARE} as revenue_pct "
        "from sales group by sales_channel",
    ),
    _C(
        "q17_fulfilment_analysis", "Fulfilment Method Analysis", r.fulfilment_analysis,
        ("order_id", "fulfilment", "status", "amount_cents"),
        LINES + f"select fulfilment, {ORDERS} as total_orders, {REVENUE} as total_revenue, "
        f"{AOV} as avg_order_value, {DELIVERED} as delivered, {CANCELLED} as cancelled, "
        f"{sql_percent2(CANCELLED, 'count(*)')} as cancel_rate_pct from sales group by fulfilment",
    ),
    _C(
        "q18_service_levels", "Shipping Service Level Analysis", r.service_levels,
        ("order_id", "ship_service_level", "qty", "amount_cents"),
        LINES + f"select ship_service_level, {ORDERS} as total_orders, {REVENUE} as total_revenue, "
        f"{AOV} as avg_order_value, {sql_mean2('100*sum(qty)')} as avg_qty_per_order "
        "from sales group by ship_service_level",
    ),
    _C(
        "q19_promotion_impact", "Promotion Impact Analysis", r.promotion_impact,
        ("order_id", "promotion_ids", "qty", "amount_cents"),
        LINES + f"select {PROMO} as promo_segment, {ORDERS} as total_orders, "
        f"{REVENUE} as total_revenue, {AOV} as avg_order_value, {QTY} as total_qty "
        "from sales group by 1",
    ),
    _C(
        "q20_value_tiers", "High Value Order Segments", r.value_tiers,
        ("order_id", "amount_cents"),
        LINES + ", o as (select order_id, sum(amount_cents) as v from sales group by order_id), "
        "t as (select v, ntile(4) over (order by v, order_id) as tier from o) "
        f"select tier as value_tier, count(*) as orders, {sql_units('min(v)')} as min_value, "
        f"{sql_units('max(v)')} as max_value, {sql_mean2('sum(v)')} as avg_value, "
        f"{sql_units('sum(v)')} as total_revenue, "
        f"{sql_percent2('sum(v)', '(select sum(amount_cents) from sales)')} as revenue_pct "
        "from t group by tier",
    ),
    _C(
        "q21_top_state_category_matrix", "Category x Top-5 State Revenue Matrix",
        r.top_state_category_matrix,
        ("order_id", "ship_state", "category", "qty", "amount_cents"),
        LINES + f"select ship_state, category, {REVENUE} as revenue, {ORDERS} as orders from sales "
        f"where ship_state in (select ship_state from sales where {_STATE} group by ship_state "
        "order by sum(amount_cents) desc, ship_state limit 5) group by ship_state, category",
    ),
    _C(
        "q22_cumulative_revenue", "Cumulative Revenue (YTD)", r.cumulative_revenue,
        ("order_id", "qty", "amount_cents", "year", "month", "month_name"),
        MONTHLY + f"select year, month, month_name, {sql_units('s')} as total_revenue, "
        f"{sql_units('sum(s) over (partition by year order by month)')} as cumulative_ytd from m",
    ),
    _C(
        "q23_return_rates", "Return Rate by Category", r.return_rates,
        ("category", "status", "amount_cents"),
        LINES + f"select category, count(*) as total_orders, {RETURNED} as returned_orders, "
        f"{sql_percent2(RETURNED, 'count(*)')} as return_rate_pct, "
        f"""{sql_units("sum(case when status='Returned' then amount_cents else 0 end)")} as returned_revenue """
        "from sales group by category",
    ),
    _C(
        "q23_mean_return_rate", "Mean Return Rate over Categories", r.mean_return_rate,
        ("category", "status", "amount_cents"),
        LINES + f", c as (select (2*{RETURNED}*10000+count(*))//(2*count(*)) as h from sales group by category) "
        f"select count(*) as categories, {sql_mean2('sum(h)')} as avg_return_rate_pct from c",
    ),
    _C(
        "q24_courier_revenue", "Revenue & Orders by Courier", r.courier_revenue,
        ("order_id", "courier_status", "qty", "amount_cents"),
        LINES + f"select courier_status as courier, {ORDERS} as total_orders, "
        f"{REVENUE} as total_revenue, {AOV} as avg_order_value, {QTY} as total_qty "
        "from sales where courier_status != 'Unknown' group by courier_status",
    ),
    _C(
        "q25_executive_summary", "Executive Summary Dashboard", r.executive_summary,
        ("order_id", "qty", "amount_cents", "status", "b2b", "sku", "ship_state", "ship_city"),
        LINES
        + " union all ".join(
            f"select '{name}' as metric, cast({value} as double) as value from sales {where}"
            for name, value, where in (
                ("Total Revenue (INR)", REVENUE, ""),
                ("Total Orders", ORDERS, ""),
                ("Total Qty Sold", QTY, ""),
                ("Avg Order Value (INR)", AOV, ""),
                (
                    "Delivered Orders",
                    "sum(case when lower(status) like '%deliver%' then 1 else 0 end)",
                    "",
                ),
                ("Cancelled Orders", CANCELLED, ""),
                ("Cancellation Rate (%)", sql_percent2(CANCELLED, "count(*)"), ""),
                ("Return Rate (%)", sql_percent2(RETURNED, "count(*)"), ""),
                (
                    "B2B Revenue Share (%)",
                    sql_percent2(
                        "sum(case when b2b='Yes' then amount_cents else 0 end)", "sum(amount_cents)"
                    ),
                    "",
                ),
                ("Unique SKUs", "count(distinct sku)", ""),
                ("Active States", "count(distinct ship_state)", f"where {_STATE}"),
                ("Active Cities", "count(distinct ship_city)", f"where {_CITY}"),
            )
        ),
    ),
    _C(
        "q25_executive_report", "Executive Summary, formatted", r.executive_report,
        ("order_id", "qty", "amount_cents", "status", "category", "ship_state"),
        LINES
        + " union all ".join(
            f"select '{name}' as metric, {value} as value from sales"
            for name, value in (
                ("Total Revenue (INR)", _money_text("sum(amount_cents)")),
                ("Total Orders", f"format('{{:,}}', {ORDERS})"),
                ("Total Qty Sold", f"format('{{:,}}', {QTY})"),
                ("Avg Order Value (INR)", _money_text("(2*sum(amount_cents)+count(*))//(2*count(*))")),
                ("Delivered Orders", f"format('{{:,}}', {DELIVERED})"),
                ("Cancellation Rate (%)", f"format('{{:.2f}}', {sql_percent2(CANCELLED, 'count(*)')}) || '%'"),
            )
        )
        + " union all select 'Top Category', (select category from sales group by category "
        "order by sum(amount_cents) desc, category limit 1)"
        " union all select 'Top State', (select ship_state from sales where ship_state != 'Unknown' "
        "group by ship_state order by sum(amount_cents) desc, ship_state limit 1)",
    ),
    _C(
        "q26_revenue_per_order_by_state", "Revenue per Order by State", r.revenue_per_order_by_state,
        ("order_id", "ship_state", "qty", "amount_cents"),
        LINES + f"select ship_state, {ORDERS} as total_orders, {REVENUE} as total_revenue, "
        f"{sql_mean2('sum(amount_cents)', ORDERS)} as revenue_per_order from sales where {_STATE} "
        "group by ship_state order by revenue_per_order desc, ship_state limit 15",
    ),
    _C(
        "insights", "Headline Findings", r.insights,
        ("order_id", "qty", "amount_cents", "status", "category", "ship_state"),
        LINES + f", c as (select category, {REVENUE} as rev, {sql_percent2(RETURNED, 'count(*)')} as pct "
        "from sales group by category), "
        f"s as (select ship_state, {REVENUE} as rev from sales where {_STATE} group by ship_state) "
        f"select {REVENUE} as total_revenue_inr, {ORDERS} as total_orders, {AOV} as avg_order_value, "
        "(select category from c order by rev desc, category limit 1) as top_category, "
        "(select rev from c order by rev desc, category limit 1) as top_category_revenue, "
        "(select ship_state from s order by rev desc, ship_state limit 1) as top_state, "
        "(select rev from s order by rev desc, ship_state limit 1) as top_state_revenue, "
        "(select category from c order by pct desc, category limit 1) as highest_return_category, "
        "(select pct from c order by pct desc, category limit 1) as highest_return_rate_pct from sales",
    ),
]
