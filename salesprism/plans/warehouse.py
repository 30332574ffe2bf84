"""Registered queries over the star schema, built from the given tables."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from salesprism.functions.exact import money_sum, units
from salesprism.operators import incremental as inc, warehouse as w
from salesprism.operators.aggregates import totals
from salesprism.plans.registry import NamedQuery, sql_mean2, sql_percent2, sql_units
from salesprism.session import table_folder
from salesprism.sources.sales import delivered_view, sales, sales_sql, stored_sales

# fixed values: the days that the calendar covers at least
START, END = date(1992, 1, 1), date(2001, 12, 31)

_COLUMNS = (
    "order_id", "order_date", "status", "qty", "amount_cents", "currency", "promotion_ids", "b2b",
    *w.PRODUCT, *w.LOCATION, *w.CHANNEL,
)


def _staged(spark: SparkSession, folder: str) -> DataFrame:
    return w.staging(sales(spark, folder, *_COLUMNS))


def _staging_table(spark: SparkSession, folder: str) -> DataFrame:
    """The staged lines, their joins written once, for loads that read them several times."""
    return w.staging(stored_sales(spark, folder, *_COLUMNS))


def _span(spark: SparkSession, folder: str) -> tuple[date, date]:
    """Whole years that hold every order date, and the least span."""
    found = spark.read.parquet(f"{folder}/orders.parquet").agg(F.min("o_orderdate").alias("a"), F.max("o_orderdate").alias("b")).first()
    years = [found[k].year if found[k] else START.year for k in "ab"]
    return min(START, date(years[0], 1, 1)), max(END, date(years[1], 12, 31))


def _dates(spark: SparkSession, folder: str) -> DataFrame:
    return w.calendar(spark, *_span(spark, folder))


def _fact(spark: SparkSession, folder: str) -> DataFrame:
    return w.fact_orders(_staged(spark, folder))


def _calendar(spark: SparkSession, folder: str) -> DataFrame:
    """The calendar with the order lines of each day."""
    lines = _fact(spark, folder).groupBy("date_key").agg(F.count(F.lit(1)).alias("lines"))
    return _dates(spark, folder).join(lines, "date_key", "left").fillna({"lines": 0})


def _report_calendar(spark: SparkSession, folder: str) -> DataFrame:
    """Revenue per week of the report calendar, joined one to many."""
    dates = w.report_calendar(spark, *_span(spark, folder))
    lines = sales(spark, folder, "order_id", "order_date", "qty", "amount_cents")
    joined = lines.join(F.broadcast(dates), F.col("order_date") == F.col("full_date"))
    return totals(joined, "year", "week_number").select(
        "year", "week_number", "orders", units("cents").alias("revenue")
    )


def _orders_flat(spark: SparkSession, folder: str) -> DataFrame:
    staged = _staging_table(spark, folder)
    return w.orders_flat(
        w.fact_orders(staged), _dates(spark, folder), w.dim_product(staged), w.dim_location(staged),
        w.dim_channel(staged),
    )


def _checks(spark: SparkSession, folder: str) -> DataFrame:
    staged = _staging_table(spark, folder)
    found = w.checks(
        w.fact_orders(staged),
        {
            "dim_date": (_dates(spark, folder), "date_key"),
            "dim_product": (w.dim_product(staged), "product_key"),
            "dim_location": (w.dim_location(staged), "location_key"),
            "dim_channel": (w.dim_channel(staged), "channel_key"),
        },
    )
    lines = inc.repeated_keys(inc.with_line_keys(w.fact_orders(staged)))
    return found.unionByName(lines.select(F.lit("fact_orders: repeated order_line_key").alias("check"), "violations"))


def _fact_lines(spark: SparkSession, folder: str) -> DataFrame:
    return inc.with_line_keys(_fact(spark, folder))


def _store(spark: SparkSession) -> inc.StarStore:
    return inc.StarStore(spark, f"{table_folder(spark)}/star-{uuid.uuid4().hex}")


def _loaded_in_parts(spark: SparkSession, folder: str) -> inc.StarStore:
    """The star after a first load of all but the last year and a second load of that year, done twice."""
    rows = w.staging(stored_sales(spark, folder, *_COLUMNS, by_year=True))
    # null where no line has a date; the files of other years are not read
    last = rows.agg(F.max("order_year")).first()[0]
    late = F.col("order_year").eqNullSafe(F.lit(last)) & F.col("order_year").isNotNull()
    store = _store(spark)
    store.load(rows.filter(~late).drop("order_year"))
    for _ in range(2):
        store.load(rows.filter(late).drop("order_year"))
    return store


def _incremental(spark: SparkSession, folder: str) -> DataFrame:
    return _loaded_in_parts(spark, folder).summary()


def _sliced(spark: SparkSession, folder: str) -> DataFrame:
    """Revenue by category of the weekends in the first quarter of the last full year, from the stored star."""
    staged = _staging_table(spark, folder)
    store = _store(spark)
    store.load(staged)
    year = staged.agg(F.max(F.year("order_date")) - 1).first()[0] or START.year
    days = w.calendar(spark, date(year, 1, 1), date(year, 12, 31)).filter("quarter = 1 and is_weekend")
    joined = store.fact_in(days).join(store.table("dim_product"), "product_key")
    return totals(joined, "category").select("category", "lines", "orders", "qty", units("cents").alias("revenue"))


def _row_counts(spark: SparkSession, folder: str) -> DataFrame:
    staged = _staging_table(spark, folder)
    return w.row_counts(
        {
            "dim_date": _dates(spark, folder),
            "dim_product": w.dim_product(staged),
            "dim_location": w.dim_location(staged),
            "dim_channel": w.dim_channel(staged),
            "fact_orders": w.fact_orders(staged),
            "staging": staged,
        }
    )


def _fact_totals(spark: SparkSession, folder: str) -> DataFrame:
    """Rows and revenue of the star join beside those of the staged lines."""
    flat = _orders_flat(spark, folder).agg(
        F.count(F.lit(1)).alias("star_rows"),
        F.count_distinct("order_id").alias("star_orders"),
        units(F.sum(F.round(F.col("amount") * 100).cast("bigint"))).alias("star_revenue"),
    )
    lines = sales(spark, folder, "order_id", "amount_cents", "qty")
    plain = lines.agg(
        F.struct(
            F.count(F.lit(1)).alias("rows"), units(money_sum("amount_cents")).alias("revenue")
        )
    ).scalar()
    return flat.withColumn("p", plain).select(
        "star_rows",
        "star_orders",
        "star_revenue",
        F.col("p.rows").alias("staged_rows"),
        F.col("p.revenue").alias("staged_revenue"),
    )


def _delivered(lines: DataFrame) -> DataFrame:
    return totals(delivered_view(lines), "status").select(
        "status", "lines", "orders", "qty", units("cents").alias("revenue")
    )


_SALES = f"with sales as ({sales_sql(*_COLUMNS)})"


def _key_sql(parts: tuple[str, ...]) -> str:
    marked = ", ".join(f"coalesce('=' || cast({p} as varchar), '!')" for p in parts)
    return f"md5(concat_ws(chr(31), {marked}))"


def _dim_sql(parts: tuple[str, ...], key: str) -> str:
    return f"select distinct {_key_sql(parts)} as {key}, {', '.join(parts)} from sales"


_PRICE = "case when qty = 0 then amount_cents else (2*amount_cents+qty)//(2*qty) end"
_DAYS = (
    f"(select cast(unnest(generate_series(date '{START}', date '{END}', interval 1 day)) as date) as d)"
)
_DATE_COLUMNS = (
    "cast(strftime(d, '%Y%m%d') as bigint) as date_key, cast(d as varchar) as full_date, "
    "day(d) as day_of_month, strftime(d, '%A') as day_name, "
    "(dayofyear(d) - isodow(d) + 10)//7 as week_number, month(d) as month_number, "
    "strftime(d, '%B') as month_name, quarter(d) as quarter, year(d) as year, isodow(d) >= 6 as is_weekend"
)
_LOOKED_UP = (
    f"dp as ({_dim_sql(w.PRODUCT, 'product_key')}), dl as ({_dim_sql(w.LOCATION, 'location_key')}), "
    f"dc as ({_dim_sql(w.CHANNEL, 'channel_key')}), "
    "f as (select s.order_id, cast(strftime(s.order_date, '%Y%m%d') as bigint) as date_key, "
    "dp.product_key, dl.location_key, dc.channel_key, cast(s.qty as bigint) as qty, "
    f"cast({_PRICE} as bigint) as unit_price_cents, s.amount_cents, s.status, s.currency, "
    "s.promotion_ids, s.b2b from sales s "
    + "".join(
        f"join {t} on " + " and ".join(f"{t}.{p} is not distinct from s.{p}" for p in parts) + " "
        for t, parts in (("dp", w.PRODUCT), ("dl", w.LOCATION), ("dc", w.CHANNEL))
    )
    + ")"
)
_FACT = (
    "order_id", "date_key", "product_key", "location_key", "channel_key", "qty", "unit_price_cents", "amount_cents",
    "status", "currency", "promotion_ids", "b2b",
)
_KPI = (
    "count(distinct order_id) as total_orders, cast(sum(qty) as bigint) as total_qty, "
    f"{sql_units('sum(amount_cents)')} as total_revenue, {sql_mean2()} as avg_order_value"
)
_SHARE = sql_percent2("sum(amount_cents)", "sum(sum(amount_cents)) over ()")


WAREHOUSE = [
    NamedQuery(
        "dim_date", "Calendar dimension with lines per day", _calendar, None,
        f"{_SALES}, n as (select order_date, count(*) as c from sales group by order_date) "
        f"select {_DATE_COLUMNS}, coalesce(c, 0) as lines from {_DAYS} left join n on order_date = d",
    ),
    NamedQuery(
        "report_calendar_weeks", "Revenue per Sunday week", _report_calendar, None,
        f"{_SALES} select year(order_date) as year, "
        "cast(floor((dayofyear(order_date) + dayofweek(date_trunc('year', order_date)) - 1) / 7) as bigint) + 1 "
        "as week_number, count(distinct order_id) as orders, "
        f"{sql_units('sum(amount_cents)')} as revenue from sales group by 1, 2",
    ),
    NamedQuery(
        "dim_product", "Product dimension", lambda s, f: w.dim_product(_staged(s, f)), None,
        f"{_SALES} {_dim_sql(w.PRODUCT, 'product_key')}",
    ),
    NamedQuery(
        "dim_location", "Location dimension", lambda s, f: w.dim_location(_staged(s, f)), None,
        f"{_SALES} {_dim_sql(w.LOCATION, 'location_key')}",
    ),
    NamedQuery(
        "dim_channel", "Channel dimension", lambda s, f: w.dim_channel(_staged(s, f)), None,
        f"{_SALES} {_dim_sql(w.CHANNEL, 'channel_key')}",
    ),
    NamedQuery(
        "fact_orders", "Fact table with resolved keys", _fact, None,
        f"{_SALES}, {_LOOKED_UP} select * from f",
    ),
    NamedQuery(
        "orders_flat", "Fact joined with all dimensions", _orders_flat, None,
        f"{_SALES} select order_id, cast(order_date as varchar) as order_date, year(order_date) as year, "
        "month(order_date) as month, strftime(order_date, '%B') as month_name, "
        "quarter(order_date) as quarter, strftime(order_date, '%A') as day_name, sku, asin, style, "
        "category, size, ship_city, ship_state, ship_country, sales_channel, fulfilment, "
        f"ship_service_level, cast(qty as bigint) as qty, {sql_units(_PRICE)} as unit_price, "
        f"{sql_units('amount_cents')} as amount, status, b2b, promotion_ids from sales",
    ),
    NamedQuery(
        "monthly_kpi", "Monthly KPI view", lambda s, f: w.monthly_kpi(_fact(s, f), _dates(s, f)), None,
        f"{_SALES} select year(order_date) as year, month(order_date) as month_number, "
        f"strftime(order_date, '%B') as month_name, {_KPI}, "
        "count(case when status='Delivered' then 1 end) as delivered_orders, "
        "count(case when status='Cancelled' then 1 end) as cancelled_orders from sales group by 1, 2, 3",
    ),
    NamedQuery(
        "category_kpi", "Category KPI view",
        lambda s, f: w.category_kpi(_fact(s, f), w.dim_product(_staged(s, f))), None,
        f"{_SALES} select category, {_KPI}, {_SHARE} as revenue_pct from sales group by category",
    ),
    NamedQuery(
        "state_kpi", "State KPI view",
        lambda s, f: w.state_kpi(_fact(s, f), w.dim_location(_staged(s, f))), None,
        f"{_SALES} select ship_state, {_KPI}, {_SHARE} as revenue_pct from sales "
        "where ship_state != 'Unknown' group by ship_state",
    ),
    NamedQuery(
        "channel_kpi", "Channel KPI over the star schema",
        lambda s, f: w.channel_kpi(_fact(s, f), w.dim_channel(_staged(s, f))), None,
        f"{_SALES} select sales_channel, fulfilment, count(distinct order_id) as total_orders, "
        f"{sql_units('sum(amount_cents)')} as total_revenue, {sql_mean2()} as avg_order_value "
        "from sales group by all",
    ),
    NamedQuery(
        "constraint_checks", "Key and reference checks", _checks, None,
        f"{_SALES}, dd as (select {_DATE_COLUMNS} from {_DAYS}), {_LOOKED_UP} "
        + " union all ".join(
            f"select '{n}: repeated {k}' as \"check\", (select count(*) from "
            f"(select {k} from {t} group by {k} having count(*) > 1)) as violations "
            f"union all select 'fact_orders: {k} without {n}', (select count(*) from f "
            f"where {k} not in (select {k} from {t}))"
            for n, k, t in (
                ("dim_date", "date_key", "dd"), ("dim_product", "product_key", "dp"),
                ("dim_location", "location_key", "dl"), ("dim_channel", "channel_key", "dc"),
            )
        )
        + " union all select 'dim_product: repeated sku', (select count(*) from "
        "(select sku from dp group by sku having count(*) > 1)) "
        "union all select 'fact_orders: repeated order_line_key', cast(0 as bigint)",
    ),
    NamedQuery(
        "fact_order_lines", "Fact table with a key for every line", _fact_lines, None,
        f"{_SALES}, {_LOOKED_UP}, n as (select *, row_number() over (partition by {', '.join(_FACT)}) as copy from f) "
        f"select {_key_sql((*_FACT, 'copy'))} as order_line_key, {', '.join(_FACT)} from n",
    ),
    NamedQuery(
        "incremental_load", "Star loaded in parts, the last one twice", _incremental, None,
        f"{_SALES}, {_LOOKED_UP} select 'fact_orders' as part, date_key//100 as month_key, count(*) as rows, "
        "cast(sum(amount_cents) as bigint) as cents from f group by 2 "
        + "".join(f"union all select '{n}', null, (select count(*) from {t}), null " for n, t in
                  (("dim_product", "dp"), ("dim_location", "dl"), ("dim_channel", "dc"))),
    ),
    NamedQuery(
        "sliced_star", "Weekend revenue of a quarter from the stored star", _sliced, None,
        f"{_SALES} select category, count(*) as lines, count(distinct order_id) as orders, "
        f"cast(sum(qty) as bigint) as qty, {sql_units('sum(amount_cents)')} as revenue from sales "
        "where year(order_date) = (select max(year(order_date)) - 1 from sales) and quarter(order_date) = 1 "
        "and isodow(order_date) >= 6 group by category",
    ),
    NamedQuery(
        "load_row_counts", "Rows per loaded table", _row_counts, None,
        f"{_SALES}, {_LOOKED_UP} select 'dim_date' as \"table\", (select count(*) from {_DAYS}) as rows "
        + "".join(
            f"union all select '{n}', (select count(*) from {t}) "
            for n, t in (("dim_product", "dp"), ("dim_location", "dl"), ("dim_channel", "dc"),
                         ("fact_orders", "f"), ("staging", "sales"))
        ),
    ),
    NamedQuery(
        "star_totals", "Star join beside the staged lines", _fact_totals, None,
        f"{_SALES} select count(*) as star_rows, count(distinct order_id) as star_orders, "
        f"{sql_units('sum(amount_cents)')} as star_revenue, count(*) as staged_rows, "
        f"{sql_units('sum(amount_cents)')} as staged_revenue from sales",
    ),
    NamedQuery(
        "delivered_view", "Completed orders by status", _delivered,
        ("order_id", "status", "qty", "amount_cents"),
        "with sales as ({sales}) select status, count(*) as lines, count(distinct order_id) as orders, "
        f"cast(sum(qty) as bigint) as qty, {sql_units('sum(amount_cents)')} as revenue from sales "
        "where lower(status) in ('delivered', 'shipped', 'shipped - delivered to buyer') group by status",
    ),
]
