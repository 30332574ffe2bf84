"""Registered measure queries."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame

from salesprism.operators import measures as m
from salesprism.plans.registry import NamedQuery, sql_units

_COLUMNS = (
    "order_id", "order_date", "status", "qty", "amount_cents", "category", "ship_state",
    "sales_channel", "promotion_ids", "b2b",
)
_ALL = tuple(m.MEASURES)

SLICED = m.FilterContext(
    date_from=date(1996, 1, 15),
    date_to=date(1999, 6, 30),
    category=("SMALL", "LARGE", "PROMO"),
    status=("Delivered", "Shipped", "Pending"),
    sales_channel=("Online",),
    b2b=("No",),
)
#: Two values of the state slicer.
STATES = ("NATION_3", "NATION_7")
_DATES = "order_date between date '1996-01-15' and date '1999-06-30'"
_CATS = "category in ('SMALL', 'LARGE', 'PROMO')"
_STATUS = "status in ('Delivered', 'Shipped', 'Pending')"
_CHANNEL = "sales_channel = 'Online'"
_B2B = "b2b = 'No'"

_LIVE = "status <> 'Cancelled'"
_DELIVERED = "status in ('Delivered', 'Shipped - Delivered To Buyer')"
_PROMO = "promotion_ids <> 'No Promotion'"
_PLAIN = "promotion_ids = 'No Promotion'"


def _div(a: str, b: str) -> str:
    return f"coalesce(cast({a} as double)/nullif(cast({b} as double), 0), 0)"


def _components_sql(conditions: dict[str, str]) -> str:
    """Component columns; ``conditions`` maps each to the rows it may see."""
    def rev(name, own):
        return f"sum(amount_cents) filter (where {conditions[name]} and {_LIVE} and {own}) as {name}"

    def orders(name, own):
        return f"count(distinct order_id) filter (where {conditions[name]} and {own}) as {name}"

    return ", ".join(
        [
            rev("revenue", "true"),
            orders("orders", "true"),
            f"sum(qty) filter (where {conditions['quantity']}) as quantity",
            orders("delivered", _DELIVERED),
            orders("cancelled", "status = 'Cancelled'"),
            rev("b2b_revenue", "b2b = 'Yes'"),
            rev("b2c_revenue", "b2b = 'No'"),
            rev("promo_revenue", _PROMO),
            rev("plain_revenue", _PLAIN),
            orders("promo_orders", _PROMO),
            orders("plain_orders", _PLAIN),
        ]
    )


_AOV_PROMO = _div(f"({sql_units('promo_revenue')})", "promo_orders")
_AOV_PLAIN = _div(f"({sql_units('plain_revenue')})", "plain_orders")
_MEASURE_SQL = ", ".join(
    [
        f"{sql_units('coalesce(revenue, 0)')} as total_revenue",
        "orders as total_orders",
        "cast(coalesce(quantity, 0) as bigint) as total_quantity_sold",
        f"{_div('(' + sql_units('revenue') + ')', 'orders')} as avg_order_value",
        "delivered as delivered_orders",
        "cancelled as cancelled_orders",
        f"{_div('cancelled', 'orders')}*100 as cancellation_rate_pct",
        f"{_div('delivered', 'orders')}*100 as delivery_rate_pct",
        f"{_div('revenue', 'all_categories')}*100 as category_share_pct",
        f"{sql_units('coalesce(b2b_revenue, 0)')} as b2b_revenue",
        f"{sql_units('coalesce(b2c_revenue, 0)')} as b2c_revenue",
        f"{_div('b2b_revenue', 'revenue')}*100 as b2b_revenue_pct",
        f"{sql_units('coalesce(promo_revenue, 0)')} as promo_revenue",
        f"{sql_units('coalesce(plain_revenue, 0)')} as non_promo_revenue",
        f"{_div(f'({_AOV_PROMO}-{_AOV_PLAIN})', _AOV_PLAIN)}*100 as promo_lift_pct",
    ]
)
_FREE = {n: "true" for n in m.COMPONENTS}
_FULL = " and ".join((_DATES, _CATS, _STATUS, _CHANNEL, _B2B))
_SLICED_CONDITIONS = {
    **{n: _FULL for n in m.COMPONENTS},
    "cancelled": " and ".join((_DATES, _CATS, _CHANNEL, _B2B)),
    "b2b_revenue": " and ".join((_DATES, _CATS, _STATUS, _CHANNEL)),
    "b2c_revenue": " and ".join((_DATES, _CATS, _STATUS, _CHANNEL)),
}
_LINES = "with sales as ({sales})"


def _time_sql(by: str, where: str, shown: str) -> str:
    keys = f"{by}, " if by else ""
    part = f"partition by {by} " if by else ""
    year_part = f"partition by {keys}year(month_start) "
    spine = (
        "(select cast(unnest(generate_series((select min(ms) from f), (select max(ms) from f), "
        "interval 1 month)) as date) as month_start)"
    )
    base = f"(select distinct {by} from f) cross join {spine}" if by else spine
    match = f"f.ms = g.month_start{f' and f.{by} = g.{by}' if by else ''}"
    return (
        f"{_LINES}, f as (select {keys}cast(date_trunc('month', order_date) as date) as ms, "
        f"sum(amount_cents) as c from sales where {_LIVE} and {where} group by all), "
        f"g as (select * from {base}), "
        f"d as (select g.*, coalesce(c, 0) as c from g left join f on {match}), "
        f"y as (select *, coalesce(lag(c) over ({part}order by month_start), 0) as p, "
        f"sum(c) over ({year_part}order by month_start) as ytd from d), "
        f"z as (select *, coalesce(lag(ytd, 12) over ({part}order by month_start), 0) as pytd from y) "
        f"select {keys}cast(month_start as varchar) as month_start, {sql_units('c')} as total_revenue, "
        f"{sql_units('(c-p)')} as revenue_mom_change, {_div('(c-p)', 'p')}*100 as revenue_mom_growth_pct, "
        f"{sql_units('ytd')} as revenue_ytd, {sql_units('pytd')} as revenue_pytd, "
        f"{_div('(ytd-pytd)', 'pytd')}*100 as revenue_yoy_pct from z where {shown}"
    )


def _all_measures(lines: DataFrame) -> DataFrame:
    return m.measure(lines, _ALL)


def _by_category(lines: DataFrame) -> DataFrame:
    return m.measure(lines, _ALL, ["category"])


def _sliced_by_state(lines: DataFrame) -> DataFrame:
    return m.measure(lines, _ALL, ["ship_state"], SLICED)


def _by_status(lines: DataFrame) -> DataFrame:
    names = ["total_orders", "delivered_orders", "cancelled_orders", "total_revenue"]
    return m.measure(lines, names, ["status"])


def _by_category_and_b2b(lines: DataFrame) -> DataFrame:
    return m.measure(lines, ["total_revenue", "b2b_revenue", "category_share_pct"], ["category", "b2b"])


MEASURE_QUERIES = [
    NamedQuery(
        "measures_overall", "All measures", _all_measures, _COLUMNS,
        f"{_LINES}, c as (select {_components_sql(_FREE)}, "
        f"sum(amount_cents) filter (where {_LIVE}) as all_categories from sales) select {_MEASURE_SQL} from c",
    ),
    NamedQuery(
        "measures_by_category", "All measures by category", _by_category, _COLUMNS,
        f"{_LINES}, c as (select category, {_components_sql(_FREE)}, "
        f"(select sum(amount_cents) from sales where {_LIVE}) as all_categories from sales group by category) "
        f"select category, {_MEASURE_SQL} from c",
    ),
    NamedQuery(
        "measures_sliced_by_state", "All measures by state under slicers", _sliced_by_state, _COLUMNS,
        f"{_LINES}, c as (select ship_state, {_components_sql(_SLICED_CONDITIONS)}, "
        f"sum(amount_cents) filter (where {_DATES} and {_STATUS} and {_CHANNEL} and {_B2B} and {_LIVE}) "
        f"as all_categories from sales group by ship_state) select ship_state, {_MEASURE_SQL} from c "
        "where orders > 0 or cancelled > 0 or b2b_revenue is not null or all_categories is not null",
    ),
    NamedQuery(
        "measures_by_status", "Replaced and narrowed status filters", _by_status, _COLUMNS,
        f"{_LINES} select status, count(distinct order_id) as total_orders, "
        f"count(distinct order_id) filter (where {_DELIVERED}) as delivered_orders, "
        "(select count(distinct order_id) from sales where status = 'Cancelled') as cancelled_orders, "
        f"{sql_units(f'coalesce(sum(amount_cents) filter (where {_LIVE}), 0)')} as total_revenue "
        "from sales group by status",
    ),
    NamedQuery(
        "measures_by_category_and_b2b", "Measures with detached groups", _by_category_and_b2b, _COLUMNS,
        f"{_LINES}, v as (select * from sales where {_LIVE}), "
        "a as (select category, b2b, sum(amount_cents) as r from v group by category, b2b) "
        f"select g.category, g.b2b, {sql_units('coalesce(a.r, 0)')} as total_revenue, "
        f"{sql_units('coalesce((select sum(amount_cents) from v where v.category = g.category and b2b = ' + chr(39) + 'Yes' + chr(39) + '), 0)')} as b2b_revenue, "
        f"{_div('a.r', '(select sum(amount_cents) from v where v.b2b = g.b2b)')}*100 as category_share_pct "
        "from (select distinct category, b2b from v) g left join a on a.category = g.category and a.b2b = g.b2b",
    ),
    NamedQuery(
        "time_intelligence", "Monthly change, year to date, year over year",
        m.time_intelligence, _COLUMNS, _time_sql("", "true", "true"),
    ),
    NamedQuery(
        "time_intelligence_by_category", "Time intelligence by category under slicers",
        lambda lines: m.time_intelligence(lines, ["category"], SLICED), _COLUMNS,
        _time_sql(
            "category", " and ".join((_CATS, _STATUS, _CHANNEL, _B2B)),
            "last_day(month_start) >= date '1996-01-15' and month_start <= date '1999-06-30'",
        ),
    ),
    NamedQuery(
        "top_category", "Category with the highest revenue", m.top_category, _COLUMNS,
        f"{_LINES} select category as top_category, {sql_units('sum(amount_cents)')} as total_revenue "
        f"from sales where {_LIVE} group by category order by sum(amount_cents) desc, category limit 1",
    ),
    NamedQuery(
        "top_10_categories", "Top 10 categories by revenue",
        lambda lines: m.top_n(lines, "total_revenue", ["category"], 10), _COLUMNS,
        f"{_LINES} select category, {sql_units('sum(amount_cents)')} as total_revenue "
        f"from sales where {_LIVE} group by category order by sum(amount_cents) desc, category limit 10",
    ),
    NamedQuery(
        "top_15_cities_by_orders", "Top 15 cities by orders",
        lambda lines: m.top_n(lines, "total_orders", ["ship_city"], 15),
        ("order_id", "order_date", "status", "qty", "amount_cents", "ship_city"),
        f"{_LINES} select ship_city, count(distinct order_id) as total_orders from sales "
        "group by ship_city order by total_orders desc, ship_city limit 15",
    ),
    NamedQuery(
        "sku_table", "Revenue and quantity of every SKU",
        lambda lines: m.measure(
            lines, ["total_revenue", "total_quantity_sold"], ["sku", "style", "category"]
        ),
        ("order_id", "status", "qty", "amount_cents", "sku", "style", "category"),
        f"{_LINES} select sku, style, category, "
        f"{sql_units(f'coalesce(sum(amount_cents) filter (where {_LIVE}), 0)')} as total_revenue, "
        "cast(sum(qty) as bigint) as total_quantity_sold from sales group by sku, style, category",
    ),
    NamedQuery(
        "service_level_aov", "Average order value by service level",
        lambda lines: m.measure(lines, ["avg_order_value"], ["ship_service_level"]),
        ("order_id", "status", "amount_cents", "qty", "ship_service_level"),
        f"{_LINES}, c as (select ship_service_level, sum(amount_cents) filter (where {_LIVE}) as r, "
        "count(distinct order_id) as o from sales group by 1) "
        f"select ship_service_level, {_div('(' + sql_units('r') + ')', 'o')} as avg_order_value from c",
    ),
    NamedQuery(
        "fulfilment_orders", "Orders by fulfilment",
        lambda lines: m.measure(lines, ["total_orders"], ["fulfilment"]),
        ("order_id", "status", "amount_cents", "qty", "fulfilment"),
        f"{_LINES} select fulfilment, count(distinct order_id) as total_orders from sales group by 1",
    ),
    NamedQuery(
        "channel_measures", "Revenue by channel without cancelled lines",
        lambda lines: m.measure(lines, ["total_revenue"], ["sales_channel"]),
        ("order_id", "status", "amount_cents", "qty", "sales_channel"),
        f"{_LINES} select sales_channel, {sql_units('sum(amount_cents)')} as total_revenue "
        f"from sales where {_LIVE} group by 1",
    ),
    NamedQuery(
        "month_name_trend", "Revenue and orders by month name without cancelled lines",
        lambda lines: m.measure(lines, ["total_revenue", "total_orders"], ["month_name"]),
        ("order_id", "status", "amount_cents", "qty", "month_name"),
        f"{_LINES} select month_name, {sql_units(f'coalesce(sum(amount_cents) filter (where {_LIVE}), 0)')} as total_revenue, "
        "count(distinct order_id) as total_orders from sales group by 1",
    ),
    NamedQuery(
        "b2b_trend", "Business and consumer revenue by date",
        lambda lines: m.measure(lines, ["b2b_revenue", "b2c_revenue"], ["order_date"]),
        ("order_id", "order_date", "status", "amount_cents", "qty", "b2b"),
        f"{_LINES}, c as (select order_date, "
        f"sum(amount_cents) filter (where {_LIVE} and b2b = 'Yes') as x, sum(amount_cents) filter (where {_LIVE} and b2b = 'No') as y "
        "from sales group by 1) select cast(order_date as varchar) as order_date, "
        f"{sql_units('coalesce(x, 0)')} as b2b_revenue, {sql_units('coalesce(y, 0)')} as b2c_revenue from c "
        "where x is not null or y is not null",
    ),
    NamedQuery(
        "size_quantities", "Quantity of every size",
        lambda lines: m.measure(lines, ["total_quantity_sold"], ["size"]),
        ("order_id", "status", "amount_cents", "qty", "size"),
        f"{_LINES} select size, cast(sum(qty) as bigint) as total_quantity_sold from sales group by 1",
    ),
    NamedQuery(
        "measures_of_two_states", "All measures by category under the state slicer",
        lambda lines: m.measure(lines, _ALL, ["category"], m.FilterContext(ship_state=STATES)), _COLUMNS,
        f"{_LINES}, here as (select * from sales where ship_state in {STATES}), "
        f"c as (select category, {_components_sql(_FREE)}, "
        f"(select sum(amount_cents) from here where {_LIVE}) as all_categories from here group by category) "
        f"select category, {_MEASURE_SQL} from c",
    ),
]
