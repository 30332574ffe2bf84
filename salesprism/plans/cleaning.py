"""Registered queries of the cleaning stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from salesprism.functions.exact import units
from salesprism.operators import cleaning as c, quality as q
from salesprism.plans.registry import NamedQuery, sql_mean2, sql_percent2, sql_units
from salesprism.sources.raw import raw_sales, raw_sales_sql

_TEXT = (
    "index", "order_id", "status", "fulfilment", "sales_channel", "ship_service_level", "style",
    "sku", "category", "size", "asin", "courier_status", "currency", "ship_city", "ship_state",
    "ship_postal_code", "ship_country", "promotion_ids", "b2b", "fulfilled_by",
)


def _title(column: str) -> str:
    return (
        f"array_to_string(list_transform(regexp_extract_all(lower(trim({column})), "
        "'(\\p{L}+|\\P{L}+)'), lambda w: upper(w[1]) || w[2:]), '')"
    )


def _quantile_x4(top: int, rows: str, column: str) -> str:
    """Quantile top/4 times 4 from ranked rows, all in integers."""
    low = f"(select {column} from {rows} where rn = ((select count(*) from {rows})-1)*{top}//4 + 1)"
    high = (
        f"(select {column} from {rows} where rn = least(((select count(*) from {rows})-1)*{top}//4 + 2, "
        f"(select count(*) from {rows})))"
    )
    rest = f"(((select count(*) from {rows})-1)*{top} % 4)"
    return f"(4*{low} + {rest}*({high}-{low}))"


def _cleaning_ctes() -> str:
    cased = {
        k: f"coalesce({k}, 'Unknown')" if k in ("ship_city", "ship_state") else k
        for k in c.TITLE_CASED
        if k != "sales_channel_"
    }
    cased["status"] = "coalesce(status, (select m from md))"
    plain = {
        "index": '"index"',
        "courier_status": "coalesce(courier_status, 'Unknown')",
        "promotion_ids": "coalesce(promotion_ids, 'No Promotion')",
        "fulfilled_by": "coalesce(fulfilled_by, 'Unknown')",
        "b2b": "case when upper(trim(b2b)) in ('TRUE','YES') then 'Yes' else 'No' end",
    }
    columns = []
    for name in _TEXT:
        rule = _title(cased[name]) if name in cased else plain.get(name, name)
        columns.append(f'{rule} as "{name}"')
    return (
        f"with raw as ({raw_sales_sql()}), dd as (select distinct * from raw), "
        "typed as (select *, cast(try_strptime(date, '%m-%d-%Y') as date) as d, "
        "cast(round(try_cast(amount as decimal(20,4))*100) as bigint) as cents, "
        "cast(trunc(try_cast(qty as double)) as int) as quantity from dd), "
        "dated as (select * from typed where d is not null), "
        "ra as (select cents, row_number() over (order by cents) as rn from dated where cents is not null), "
        f"med as (select (2*{_quantile_x4(2, 'ra', 'cents')}+4)//8 as m), "
        "md as (select status as m from dated where status is not null group by status "
        "order by count(*) desc, status limit 1), "
        f"filled as (select {', '.join(columns)}, d as date, coalesce(quantity, 1) as qty, "
        "coalesce(cents, (select m from med)) as cents from dated), "
        "rf as (select cents, row_number() over (order by cents) as rn from filled), "
        f"qq as (select {_quantile_x4(1, 'rf', 'cents')} as q1, {_quantile_x4(3, 'rf', 'cents')} as q3), "
        "fence as (select q1, q3, q1-3*(q3-q1) as lo, q3+3*(q3-q1) as hi from qq), "
        "cleaned as (select * exclude (cents, date, qty), cast(date as varchar) as date, "
        "cast(qty as bigint) as qty, year(date) as year, month(date) as month, "
        "strftime(date, '%b') as month_name, quarter(date) as quarter, week(date) as week, "
        "strftime(date, '%A') as day_of_week, "
        "cast(case when qty = 0 then null else (2*cents+qty)//(2*qty) end as bigint) as unit_price_cents, "
        "cast(least(greatest(cents, greatest(0, (select (lo+2)//4 from fence))), "
        "(select (hi+2)//4 from fence)) as bigint) as amount_cents from filled) "
    )


CTES = _cleaning_ctes()


def _raw(build):
    return lambda spark, folder: build(raw_sales(spark, folder))


def _cleaned_profile(raw: DataFrame) -> DataFrame:
    return q.profile(c.clean(raw)).drop("position")


def _raw_profile(raw: DataFrame) -> DataFrame:
    return q.profile(c.standardise_names(raw)).drop("position")


def _missing(raw: DataFrame) -> DataFrame:
    return q.null_counts(c.standardise_names(raw))


def _duplicates(raw: DataFrame) -> DataFrame:
    return q.duplicate_count(raw)


def _raw_summary(raw: DataFrame) -> DataFrame:
    return q.raw_summary(raw)


def _cleaned_summary(raw: DataFrame) -> DataFrame:
    return q.cleaned_summary(c.clean(raw))


def _counts(raw: DataFrame) -> DataFrame:
    return (
        q.cleaning_counts(c.start_cleaning(raw))
        .withColumn("median_amount", units("median_cents"))
        .withColumn("q1_amount", F.col("q1_x4") / F.lit(400.0))
        .withColumn("q3_amount", F.col("q3_x4") / F.lit(400.0))
        .drop("median_cents", "q1_x4", "q3_x4")
    )


def _report_text(spark: SparkSession, folder: str) -> DataFrame:
    run = c.start_cleaning(raw_sales(spark, folder))
    return q.report_lines(q.quality_report(run))


_ALL = (*_TEXT, "date", "qty", "year", "month", "month_name", "quarter", "week", "day_of_week",
        "unit_price_cents", "amount_cents")
_RAW_NAMES = (
    "index", "order_id", "date", "status", "fulfilment", "sales_channel", "ship_service_level",
    "style", "sku", "category", "size", "asin", "courier_status", "qty", "currency", "amount",
    "ship_city", "ship_state", "ship_postal_code", "ship_country", "promotion_ids", "b2b",
    "fulfilled_by",
)


def _dtype(name: str) -> str:
    """What the cleaned column is in Spark."""
    kinds = dict.fromkeys(("qty", "year", "month", "quarter", "week"), "int")
    kinds |= {"unit_price_cents": "bigint", "amount_cents": "bigint", "date": "date"}
    return f"'{kinds.get(name, 'string')}'"


def _profile_sql(table: str, names: tuple[str, ...], dtype: str) -> str:
    return " union all ".join(
        f"select '{n}' as name, {dtype.format(dtype=_dtype(n))} count(\"{n}\") as non_null, "
        f'count(*)-count("{n}") as null_count, '
        f"""{sql_percent2(f'count(*)-count("{n}")', 'count(*)')} as null_pct, """
        f'count(distinct "{n}") as unique_values, '
        f"""coalesce(min(cast("{n}" as varchar)), 'N/A') as sample from {table}"""
        for n in names
    )


_NULLS = "+".join(f'(case when "{n}" is null then 1 else 0 end)' for n in _RAW_NAMES)
_CLEAN_NULLS = "+".join(f'(case when "{n}" is null then 1 else 0 end)' for n in _ALL)
_OUT = "(select count(*) from filled, fence where 4*cents < lo or 4*cents > hi)"

CLEANING = [
    NamedQuery("clean_orders", "Cleaned order lines", _raw(c.clean), None, CTES + "select * from cleaned"),
    NamedQuery(
        "raw_profile", "Column profile before cleaning", _raw(_raw_profile), None,
        CTES + _profile_sql("raw", _RAW_NAMES, "'string' as dtype,"),
    ),
    NamedQuery(
        "cleaned_profile", "Column profile after cleaning", _raw(_cleaned_profile), None,
        CTES + _profile_sql("cleaned", _ALL, "{dtype} as dtype,"),
    ),
    NamedQuery(
        "missing_ranking", "Columns with gaps", _raw(_missing), None,
        CTES + "select name, null_count, null_pct from ("
        + _profile_sql("raw", _RAW_NAMES, "") + ") where null_count > 0",
    ),
    NamedQuery(
        "duplicate_rows", "Repeated raw rows", _raw(_duplicates), None,
        CTES + "select (select count(*) from raw) - (select count(*) from dd) as duplicates",
    ),
    NamedQuery(
        "raw_summary", "Raw table summary", _raw(_raw_summary), None,
        CTES + f"select count(*) as rows, cast({len(_RAW_NAMES)} as bigint) as columns, "
        f"count(*) - (select count(*) from dd) as duplicates, cast(sum({_NULLS}) as bigint) as total_nulls from raw",
    ),
    NamedQuery(
        "cleaned_summary", "Cleaned table summary", _raw(_cleaned_summary), None,
        CTES + f"select count(*) as rows, cast({len(_ALL)} as bigint) as columns, "
        f"cast(sum({_CLEAN_NULLS}) as bigint) as total_nulls, "
        "min(date) || ' to ' || max(date) as date_range, "
        f"{sql_units('sum(amount_cents)')} as total_revenue, count(distinct order_id) as total_orders, "
        f"cast(sum(qty) as bigint) as total_qty, {sql_mean2()} as avg_order_value, "
        "count(distinct category) as categories, count(distinct ship_state) as states, "
        "count(*) - (select count(*) from (select distinct * from cleaned)) as duplicates from cleaned",
    ),
    NamedQuery(
        "cleaning_counts", "Counts of the cleaning actions", _raw(_counts), None,
        CTES + "select count(*) as dated_rows, count(*)-count(cents) as amount_filled, "
        "count(*)-count(ship_city) as city_filled, count(*)-count(ship_state) as state_filled, "
        "count(*)-count(status) as status_filled, count(*)-count(quantity) as qty_defaulted, "
        "(select count(*) from raw)-(select count(*) from dd) as duplicates_removed, "
        "(select count(*) from typed where d is null) as bad_dates_dropped, "
        f"{_OUT} as outliers_capped, (select cast(m as double)/100 from med) as median_amount, "
        "(select trim(m) from md) as status_mode, (select cast(q1 as double)/400 from qq) as q1_amount, "
        "(select cast(q3 as double)/400 from qq) as q3_amount from dated",
    ),
    NamedQuery("quality_report_text", "Quality report as text", _report_text, None),
]
