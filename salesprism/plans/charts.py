"""Registered chart datasets, daily panels and customer scores."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from salesprism.functions.dates import MONTHS, WEEKDAYS
from salesprism.functions.exact import percent2, units
from salesprism.operators import reshape as rs, rfm as cust, series as ts
from salesprism.operators.aggregates import value_counts
from salesprism.operators.quantiles import box_stats, ntile
from salesprism.operators.windows import global_row_number
from salesprism.plans.registry import NamedQuery, sql_mean2, sql_percent2, sql_units
from salesprism.plans.reports import promotion_flag

# fixed values: the categories of the given tables, for the oracle's columns only
CATEGORIES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")

L = "with sales as ({sales})"
REV = sql_units("sum(amount_cents)")
DONE = "status in ('Delivered', 'Shipped', 'Shipped - Delivered To Buyer')"


def _pivot_sql(column: str, values, inner: str) -> str:
    return ", ".join(f"coalesce({inner.format(c=f'{column} = ' + chr(39) + v + chr(39))}, 0) as \"{v}\"" for v in values)


_SUM_CELL = "cast(sum(amount_cents) filter (where {c}) as double)/100"
_MEAN_CELL = (
    "cast((2*sum(amount_cents) filter (where {c})+count(*) filter (where {c}))"
    "//(2*nullif(count(*) filter (where {c}), 0)) as double)/100"
)


#: The name of the column for lines without a category, and the most columns of a matrix.
BLANK = "(blank)"
MOST_COLUMNS = 1000


def _by_category(lines: DataFrame, matrix) -> DataFrame:
    """The matrix with one column for each category in the data, and one for lines without a category where there are any."""
    named = lines.fillna({"category": BLANK})
    found = [r[0] for r in named.select("category").distinct().orderBy("category").limit(MOST_COLUMNS + 1).collect()]
    if len(found) > MOST_COLUMNS:
        raise ValueError(f"a matrix of more than {MOST_COLUMNS} categories is out of bounds")
    return matrix(named, found)


def _order_tiles(lines: DataFrame) -> DataFrame:
    orders = lines.groupBy("order_id").agg(F.sum("amount_cents").alias("order_cents"))
    return ntile(orders, "order_cents", "order_id", 4, "quartile")


def _order_ranks(lines: DataFrame) -> DataFrame:
    orders = lines.groupBy("order_id").agg(F.sum("amount_cents").alias("order_cents"))
    return global_row_number(orders, ["order_cents", "order_id"])


def _daily_panel(lines: DataFrame) -> DataFrame:
    return ts.densified(ts.daily(lines, "category")).withColumn("revenue", units("cents")).drop("cents")


def _features(lines: DataFrame, series: str | None) -> DataFrame:
    return ts.split_by_time(ts.with_features(ts.densified(ts.daily(lines, series))))


def _last_days(lines: DataFrame, n: int = 30) -> DataFrame:
    days = ts.densified(ts.daily(lines))
    return days.select("date", units("cents").alias("revenue")).orderBy(F.desc("date")).limit(n)


def _rfm(lines: DataFrame) -> DataFrame:
    return cust.with_units(cust.rfm(lines))


def _scored(lines: DataFrame) -> DataFrame:
    return cust.with_units(cust.scored(cust.rfm(lines)))


def _describe(lines: DataFrame) -> DataFrame:
    return cust.described(cust.rfm(lines))


def _heatmap(column: str):
    return lambda lines: rs.score_heatmap(cust.scored(cust.rfm(lines)), column)


def _recency_box(lines: DataFrame) -> DataFrame:
    return box_stats(cust.scored(cust.rfm(lines)), "recency", "m_score")


def _segment_codes(lines: DataFrame) -> DataFrame:
    """Customers and revenue per score code, with their revenue share."""
    coded = cust.scored(cust.rfm(lines)).groupBy("rfm_segment").agg(
        F.count(F.lit(1)).alias("customers"), F.sum("monetary_cents").alias("cents")
    )
    whole = F.sum("cents").over(Window.partitionBy())
    return coded.select(
        "rfm_segment", "customers", units("cents").alias("revenue"),
        percent2(F.col("cents"), whole).alias("revenue_share_pct"),
    )


# oracle text of the customer scores: integer quantile edges, written out independently
def _edge(column: str, i: int) -> str:
    at = f"((select count(*) from r)-1)*{i}"
    low = f"(select v from o_{column} where rn = {at}//5 + 1)"
    high = f"(select v from o_{column} where rn = least({at}//5 + 2, (select count(*) from r)))"
    return f"(5*{low} + ({at} % 5)*({high}-{low}))"


def _bin(column: str) -> str:
    return "1 + " + " + ".join(
        f"(case when {column}*5 > (select e{i} from e_{column}) then 1 else 0 end)" for i in range(1, 5)
    )


_RFM = (
    f"{L}, c as (select customer_id, max(order_date) as last_date, count(*) as frequency, "
    f"cast(sum(amount_cents) as bigint) as monetary_cents from sales where {DONE} group by customer_id), "
    "r as (select customer_id, cast((select max(last_date) from c) - last_date + 1 as bigint) as recency, "
    "frequency, monetary_cents from c)"
)
_SCORED = (
    _RFM
    + "".join(
        f", o_{c} as (select {c} as v, row_number() over (order by {c}) as rn from r), "
        f"e_{c} as (select {', '.join(f'{_edge(c, i)} as e{i}' for i in range(1, 5))})"
        for c in ("recency", "monetary_cents")
    )
    + ", p as (select *, row_number() over (order by frequency, customer_id) as rn from r), "
    f"q as (select customer_id, recency, frequency, monetary_cents, cast(6-({_bin('recency')}) as bigint) as r_score, "
    "cast(greatest(1, ((rn-1)*5 + (select count(*) from r)-2) // ((select count(*) from r)-1)) as bigint) as f_score, "
    f"cast({_bin('monetary_cents')} as bigint) as m_score from p)"
)


def _feature_sql(series: str) -> str:
    lags = ", ".join(
        f"cast(lag(c, {k}) over w as double)/100 as revenue_lag_{k}, lag(o, {k}) over w as orders_lag_{k}"
        for k in ts.LAGS
    )
    rolls = ", ".join(
        f"cast(sum(c) over (partition by series order by date rows between {k} preceding and 1 preceding) "
        f"as double)/({k}.0::double*100) as revenue_roll_{k}"
        for k in ts.ROLLS
    )
    return (
        f"{L}, d as (select {series} as series, order_date as date, count(*) as o, sum(amount_cents) as c, "
        f"sum(qty) as q from sales where {DONE} group by 1, 2), "
        "b as (select series, min(date) as a, max(date) as z from d group by series), "
        "s as (select series, cast(unnest(generate_series(a, z, interval 1 day)) as date) as date from b), "
        "x as (select s.series, s.date, coalesce(o, 0) as o, coalesce(c, 0) as c, coalesce(q, 0) as q "
        "from s left join d on d.series = s.series and d.date = s.date), "
        f"f as (select series, date, cast(c as double)/100 as daily_revenue, o as daily_orders, "
        "cast(q as bigint) as daily_qty, isodow(date)-1 as day_of_week, day(date) as day_of_month, "
        "week(date) as week_number, month(date) as month, quarter(date) as quarter, "
        f"cast(isodow(date) >= 6 as bigint) as is_weekend, {lags}, {rolls}, row_number() over w - 1 as t "
        "from x window w as (partition by series order by date)), "
        "k as (select * from f where t >= 14) "
        "select * replace (cast(date as varchar) as date), row_number() over (partition by series order by date) "
        "<= (count(*) over (partition by series))*8//10 as is_train from k"
    )


_DAILY_COLUMNS = ("order_id", "order_date", "status", "qty", "amount_cents")
_RFM_COLUMNS = ("order_id", "customer_id", "order_date", "status", "amount_cents")

CHARTS = [
    NamedQuery(
        "category_month_matrix", "Category by month name", rs.category_month_matrix,
        ("category", "month_name", "amount_cents"),
        f"{L} select category, {_pivot_sql('month_name', MONTHS, _SUM_CELL)} from sales group by category",
    ),
    NamedQuery(
        "month_category_matrix", "Month by category",
        lambda lines: _by_category(lines, rs.month_category_matrix),
        ("category", "order_date", "amount_cents"),
        f"{L} select strftime(order_date, '%Y-%m') as month, {_pivot_sql('category', CATEGORIES, _SUM_CELL)} "
        "from sales group by 1",
    ),
    NamedQuery(
        "state_category_matrix", "State by category",
        lambda lines: _by_category(lines, rs.state_category_matrix),
        ("category", "ship_state", "amount_cents"),
        f"{L} select ship_state, {_pivot_sql('category', CATEGORIES, _SUM_CELL)} from sales group by 1",
    ),
    NamedQuery(
        "month_weekday_means", "Mean amount by month and weekday", rs.month_weekday_means,
        ("month_name", "day_name", "amount_cents"),
        f"{L} select month_name, {_pivot_sql('day_name', WEEKDAYS, _MEAN_CELL)} from sales group by 1",
    ),
    NamedQuery(
        "unit_price_histogram", "Unit price in bins of 200", rs.unit_price_histogram,
        ("qty", "amount_cents"),
        f"{L}, p as (select case when qty = 0 then amount_cents else (2*amount_cents+qty)//(2*qty) end as p from sales) "
        "select p//20000*200 as bin_start, count(*) as lines from p group by 1",
    ),
    *[
        NamedQuery(
            f"share_by_{key}", f"Share of lines by {key}", (lambda k: lambda lines: rs.shares(lines, k))(key),
            (key,) if key != "status" else ("status",),
            f"{L} select {key}, count(*) as lines, {sql_percent2('count(*)', 'sum(count(*)) over ()')} as share_pct "
            f"from sales group by {key}",
        )
        for key in ("status", "fulfilment")
    ],
    NamedQuery(
        "status_counts", "Lines per status", lambda lines: value_counts(lines, "status"), ("status",),
        f"{L} select status, count(*) as rows from sales group by status",
    ),
    NamedQuery(
        "revenue_by_month", "Monthly revenue and lines", rs.monthly_trend,
        ("order_id", "order_date", "qty", "amount_cents"),
        f"{L} select strftime(order_date, '%Y-%m') as month, {REV} as revenue, count(*) as orders from sales group by 1",
    ),
    NamedQuery(
        "b2b_by_month", "B2B and B2C by month", lambda lines: rs.monthly_trend(lines, "b2b"),
        ("order_id", "order_date", "qty", "amount_cents", "b2b"),
        f"{L} select strftime(order_date, '%Y-%m') as month, b2b, {REV} as revenue, count(*) as orders "
        "from sales group by 1, 2",
    ),
    NamedQuery(
        "revenue_by_week", "Revenue by Monday-to-Sunday week", rs.weekly_trend,
        ("order_id", "order_date", "qty", "amount_cents"),
        f"{L} select cast(cast(date_trunc('week', order_date) as date) as varchar) || '/' || "
        "cast(cast(date_trunc('week', order_date) as date) + 6 as varchar) as week, "
        f"{REV} as revenue from sales group by 1",
    ),
    NamedQuery(
        "rolling_daily_revenue", "Daily revenue with rolling means", rs.rolling_daily,
        ("order_date", "amount_cents"),
        f"{L}, d as (select order_date as date, sum(amount_cents) as c, count(*) as orders from sales group by 1) "
        f"select cast(date as varchar) as date, {sql_units('c')} as revenue, orders, "
        + ", ".join(
            f"case when row_number() over (order by date) >= {k} then cast(sum(c) over (order by date rows between "
            f"{k - 1} preceding and current row) as double)/({k}.0::double*100) end as rolling_{k}"
            for k in (7, 14)
        )
        + ", cast(sum(c) over (order by date rows between 6 preceding and current row) as double)/"
        "(cast(count(*) over (order by date rows between 6 preceding and current row) as double)*100) "
        "as rolling_7_from_start from d",
    ),
    NamedQuery(
        "top_sizes", "Top 8 sizes by quantity", rs.top_sizes, ("size", "qty"),
        f"{L} select size, cast(sum(qty) as bigint) as qty from sales group by size order by sum(qty) desc, size limit 8",
    ),
    NamedQuery(
        "top_8_categories", "Top 8 categories by revenue",
        lambda lines: rs.top_by_revenue(lines, "category", 8), ("category", "amount_cents"),
        f"{L} select category, {REV} as revenue from sales group by category "
        "order by sum(amount_cents) desc, category limit 8",
    ),
    NamedQuery(
        "top_10_states", "Top 10 states by revenue, unknown included",
        lambda lines: rs.top_by_revenue(lines, "ship_state", 10), ("ship_state", "amount_cents"),
        f"{L} select ship_state, {REV} as revenue from sales group by ship_state "
        "order by sum(amount_cents) desc, ship_state limit 10",
    ),
    *[
        NamedQuery(
            f"revenue_by_{key}", f"Revenue and lines by {key}",
            (lambda k: lambda lines: rs.revenue_and_lines(lines, k, k))(key),
            ("order_id", "qty", "amount_cents", key),
            f"{L} select {key}, {REV} as revenue, count(*) as orders from sales group by {key}",
        )
        for key in ("ship_service_level", "sales_channel")
    ],
    NamedQuery(
        "revenue_by_promotion", "Revenue and lines by promotion flag",
        lambda lines: rs.revenue_and_lines(lines, promotion_flag(), "promo_segment"),
        ("order_id", "qty", "amount_cents", "promotion_ids"),
        f"{L} select case when promotion_ids = 'No Promotion' then 'No Promotion' else 'With Promotion' end "
        f"as promo_segment, {REV} as revenue, count(*) as orders from sales group by 1",
    ),
    NamedQuery(
        "dashboard_headline", "Dashboard totals and rates", rs.headline,
        ("order_id", "qty", "amount_cents", "status", "category"),
        f"{L} select {REV} as total_revenue, count(distinct order_id) as total_orders, "
        f"cast(sum(qty) as bigint) as total_qty, {sql_mean2()} as avg_order_value, "
        "count(distinct category) as total_categories, "
        + ", ".join(
            f"{sql_percent2(f'count(*) filter (where {condition})', 'count(*)')} as {name}"
            for name, condition in (
                ("delivered_pct", "contains(lower(status), 'deliver')"),
                ("cancel_pct", "contains(lower(status), 'cancel')"),
                ("exact_cancel_pct", "status = 'Cancelled'"),
            )
        )
        + " from sales",
    ),
    NamedQuery(
        "order_quartiles", "Every order with its quartile", _order_tiles, ("order_id", "amount_cents"),
        f"{L}, o as (select order_id, cast(sum(amount_cents) as bigint) as order_cents from sales group by 1) "
        "select *, ntile(4) over (order by order_cents, order_id) as quartile from o",
    ),
    NamedQuery(
        "order_ranks", "Every order with its rank by total", _order_ranks, ("order_id", "amount_cents"),
        f"{L}, o as (select order_id, cast(sum(amount_cents) as bigint) as order_cents from sales group by 1) "
        "select *, row_number() over (order by order_cents, order_id) as row_number from o",
    ),
    NamedQuery(
        "daily_panel", "Daily totals per category without gaps", _daily_panel, (*_DAILY_COLUMNS, "category"),
        f"{L}, d as (select category as series, order_date as date, count(*) as o, sum(amount_cents) as c, sum(qty) as q "
        f"from sales where {DONE} group by 1, 2), "
        "b as (select series, min(date) as a, max(date) as z from d group by series), "
        "s as (select series, cast(unnest(generate_series(a, z, interval 1 day)) as date) as date from b) "
        "select s.series, cast(s.date as varchar) as date, coalesce(o, 0) as orders, "
        "cast(coalesce(q, 0) as bigint) as qty, cast(coalesce(c, 0) as double)/100 as revenue "
        "from s left join d on d.series = s.series and d.date = s.date",
    ),
    NamedQuery(
        "forecast_features", "Forecast features of the whole table", lambda lines: _features(lines, None),
        _DAILY_COLUMNS, _feature_sql("'all'"),
    ),
    NamedQuery(
        "forecast_features_by_category", "Forecast features per category",
        lambda lines: _features(lines, "category"), (*_DAILY_COLUMNS, "category"), _feature_sql("category"),
    ),
    NamedQuery(
        "last_30_days", "Revenue of the last 30 days", _last_days, _DAILY_COLUMNS,
        f"{L}, d as (select order_date as date, sum(amount_cents) as c from sales where {DONE} group by 1), "
        "s as (select cast(unnest(generate_series((select min(date) from d), (select max(date) from d), "
        "interval 1 day)) as date) as date) select cast(s.date as varchar) as date, "
        "cast(coalesce(c, 0) as double)/100 as revenue from s left join d on d.date = s.date "
        "order by s.date desc limit 30",
    ),
    NamedQuery(
        "customer_rfm", "Recency, frequency and spend", _rfm, _RFM_COLUMNS,
        f"{_RFM} select customer_id, recency, frequency, {sql_units('monetary_cents')} as monetary from r",
    ),
    NamedQuery(
        "customer_scores", "Customer scores", _scored, _RFM_COLUMNS,
        f"{_SCORED} select customer_id, recency, frequency, {sql_units('monetary_cents')} as monetary, r_score, "
        "f_score, m_score, r_score+f_score+m_score as rfm_score, "
        "concat(r_score, f_score, m_score) as rfm_segment from q",
    ),
    NamedQuery(
        "customer_segment_codes", "Revenue share per score code", _segment_codes, _RFM_COLUMNS,
        f"{_SCORED} select concat(r_score, f_score, m_score) as rfm_segment, count(*) as customers, "
        f"{sql_units('sum(monetary_cents)')} as revenue, "
        f"{sql_percent2('sum(monetary_cents)', 'sum(sum(monetary_cents)) over ()')} as revenue_share_pct "
        "from q group by 1",
    ),
    NamedQuery(
        "rfm_describe", "Distribution of the customer measures", _describe, _RFM_COLUMNS,
        f"{_RFM} "
        + " union all ".join(
            f"select '{n}' as measure, count({c}) as count, round(avg({c}/{s}::double), 2) as mean, "
            f"round(stddev_samp({c}/{s}::double), 2) as std, min({c}/{s}::double) as min, "
            + ", ".join(
                f"quantile_cont({c}, {p})/{s}::double as p{int(p * 100)}" for p in (0.25, 0.5, 0.75)
            )
            + f", max({c}/{s}::double) as max from r"
            for n, c, s in (
                ("recency", "recency", 1), ("frequency", "frequency", 1), ("monetary", "monetary_cents", 100),
            )
        ),
    ),
    *[
        NamedQuery(
            f"rfm_heatmap_{column}", f"Mean spend by f_score and {column}", _heatmap(column), _RFM_COLUMNS,
            f"{_SCORED} select f_score, "
            + ", ".join(
                f"cast((2*sum(monetary_cents) filter (where {column} = {i})+count(*) filter (where {column} = {i}))"
                f"//(2*nullif(count(*) filter (where {column} = {i}), 0)) as double)/100 as s{i}"
                for i in range(1, 6)
            )
            + " from q group by f_score",
        )
        for column in ("r_score", "m_score")
    ],
    NamedQuery(
        "recency_box_by_spend_score", "Box-plot numbers of recency by spend score", _recency_box, _RFM_COLUMNS,
        f"{_SCORED}, b as (select m_score, quantile_cont(recency, 0.25) as q1, quantile_cont(recency, 0.5) as median, "
        "quantile_cont(recency, 0.75) as q3 from q group by m_score), "
        "j as (select q.m_score, recency, q1, median, q3, recency >= q1-1.5*(q3-q1) and recency <= q3+1.5*(q3-q1) as inside "
        "from q join b on q.m_score = b.m_score) "
        "select m_score, q1, median, q3, count(*) as rows, min(recency) filter (where inside) as whisker_low, "
        "max(recency) filter (where inside) as whisker_high, count(*) filter (where not inside) as fliers "
        "from j group by m_score, q1, median, q3",
    ),
]
