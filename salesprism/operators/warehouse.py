"""Star schema: four dimensions, the fact table, reporting views and checks.

A surrogate key is the MD5 of the full natural key. The fact load therefore needs no
lookup join at all: it computes the same key from its own columns, and no fact row
can multiply or get lost. ``checks`` proves that keys are unique and resolve.

Joins carry no broadcast hint except on the calendar, whose row count is fixed by
its two end dates; the planner sizes the other dimensions from their files.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from salesprism.functions.dates import date_key, is_weekend, monday_week, sunday_week
from salesprism.functions.exact import mean2, mean_cents, money_sum, units
from salesprism.operators.aggregates import aov, revenue, share_of_total
from salesprism.sources.sinks import write_counted

PRODUCT = ("sku", "asin", "style", "category", "size")
LOCATION = ("ship_city", "ship_state", "ship_postal", "ship_country")
CHANNEL = ("sales_channel", "fulfilment", "ship_service_level", "courier_status", "fulfilled_by")

# fixed values: what a missing natural-key part is stored as
DEFAULTS = {
    "ship_city": "Unknown",
    "ship_state": "Unknown",
    "ship_country": "IN",
    "sales_channel": "Unknown",
    "fulfilment": "Unknown",
    "ship_service_level": "Unknown",
}
MAX_CALENDAR_DAYS = 200 * 366


def surrogate_key(*parts: str) -> Column:
    """MD5 of all parts; a null part differs from every text."""
    marked = [
        F.coalesce(F.concat(F.lit("="), F.col(p).cast("string")), F.lit("!")) for p in parts
    ]
    return F.md5(F.concat_ws("\u001f", *marked))


def calendar(spark: SparkSession, start: date, end: date) -> DataFrame:
    """One row per day with its date attributes."""
    return calendar_columns(_days(spark, start, end))


def report_calendar(spark: SparkSession, start: date, end: date) -> DataFrame:
    """The shorter date table of the report model; its weeks start on Sunday."""
    day = F.col("full_date")
    return _days(spark, start, end).select(
        "full_date",
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.date_format(day, "MMM").alias("month_name"),
        F.quarter(day).alias("quarter"),
        sunday_week(day).alias("week_number"),
        F.date_format(day, "EEEE").alias("day_name"),
    )


def _days(spark: SparkSession, start: date, end: date) -> DataFrame:
    days = (end - start).days + 1
    if not 0 < days <= MAX_CALENDAR_DAYS:
        raise ValueError(f"a calendar of {days} days is out of bounds")
    return spark.range(1).select(
        F.explode(F.sequence(F.lit(start), F.lit(end), F.expr("interval 1 day"))).alias("full_date")
    )


def calendar_columns(spine: DataFrame) -> DataFrame:
    day = F.col("full_date")
    return spine.select(
        date_key(day).alias("date_key"),
        "full_date",
        F.dayofmonth(day).alias("day_of_month"),
        F.date_format(day, "EEEE").alias("day_name"),
        monday_week(day).alias("week_number"),
        F.month(day).alias("month_number"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.quarter(day).alias("quarter"),
        F.year(day).alias("year"),
        is_weekend(day).alias("is_weekend"),
    )


def staging(sales: DataFrame) -> DataFrame:
    """Order lines as they arrive for loading: date as text, unit price added."""
    price = F.coalesce(mean_cents(F.col("amount_cents"), F.col("qty")), F.col("amount_cents"))
    return sales.withColumns(
        {"order_date": F.col("order_date").cast("string"), "unit_price_cents": price}
    )


def _with_defaults(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    filled = {c: F.coalesce(F.col(c), F.lit(DEFAULTS[c])) for c in columns if c in DEFAULTS}
    return df.withColumns(filled) if filled else df


def dimension(staged: DataFrame, columns: tuple[str, ...], key: str) -> DataFrame:
    """Distinct natural keys with their surrogate key."""
    members = _with_defaults(staged.select(*columns), columns).distinct()
    return members.select(surrogate_key(*columns).alias(key), *columns)


def dim_product(staged: DataFrame) -> DataFrame:
    return dimension(staged.filter(F.col("sku").isNotNull()), PRODUCT, "product_key")


def dim_location(staged: DataFrame) -> DataFrame:
    return dimension(staged, LOCATION, "location_key")


def dim_channel(staged: DataFrame) -> DataFrame:
    return dimension(staged, CHANNEL, "channel_key")


def new_members(loaded: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """Rows of a repeated dimension load whose key is not stored yet."""
    return incoming.join(loaded.select(key), key, "left_anti")


def fact_orders(staged: DataFrame) -> DataFrame:
    """One fact row per staged line, foreign keys computed in place."""
    lines = _with_defaults(staged, (*LOCATION, *CHANNEL))
    return lines.select(
        "order_id",
        date_key(F.try_to_date("order_date", "yyyy-MM-dd")).alias("date_key"),
        surrogate_key(*PRODUCT).alias("product_key"),
        surrogate_key(*LOCATION).alias("location_key"),
        surrogate_key(*CHANNEL).alias("channel_key"),
        "qty",
        "unit_price_cents",
        "amount_cents",
        F.coalesce("status", F.lit("Unknown")).alias("status"),
        F.coalesce("currency", F.lit("INR")).alias("currency"),
        "promotion_ids",
        F.coalesce("b2b", F.lit("No")).alias("b2b"),
    )


def with_dates(fact: DataFrame, dates: DataFrame) -> DataFrame:
    return fact.join(F.broadcast(dates), "date_key")


def orders_flat(
    fact: DataFrame, dates: DataFrame, product: DataFrame, location: DataFrame, channel: DataFrame
) -> DataFrame:
    """The denormalised table: fact with all four dimensions."""
    joined = (
        with_dates(fact, dates)
        .join(product, "product_key")
        .join(location, "location_key")
        .join(channel, "channel_key")
    )
    return joined.select(
        "order_id",
        F.col("full_date").alias("order_date"),
        "year",
        F.col("month_number").alias("month"),
        "month_name",
        "quarter",
        "day_name",
        *PRODUCT,
        "ship_city",
        "ship_state",
        "ship_country",
        "sales_channel",
        "fulfilment",
        "ship_service_level",
        "qty",
        units("unit_price_cents").alias("unit_price"),
        units("amount_cents").alias("amount"),
        "status",
        "b2b",
        "promotion_ids",
    )


def _kpis(joined: DataFrame, *keys: str) -> DataFrame:
    return joined.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("lines"),
        F.count_distinct("order_id").alias("total_orders"),
        F.sum("qty").alias("total_qty"),
        money_sum("amount_cents").alias("cents"),
        F.count_if(F.col("status") == "Delivered").alias("delivered_orders"),
        F.count_if(F.col("status") == "Cancelled").alias("cancelled_orders"),
    )


def monthly_kpi(fact: DataFrame, dates: DataFrame) -> DataFrame:
    return _kpis(with_dates(fact, dates), "year", "month_number", "month_name").select(
        "year",
        "month_number",
        "month_name",
        "total_orders",
        "total_qty",
        revenue().alias("total_revenue"),
        aov().alias("avg_order_value"),
        "delivered_orders",
        "cancelled_orders",
    )


def _share_view(joined: DataFrame, key: str) -> DataFrame:
    return _kpis(joined, key).select(
        key,
        "total_orders",
        "total_qty",
        revenue().alias("total_revenue"),
        aov().alias("avg_order_value"),
        share_of_total("cents").alias("revenue_pct"),
    )


def category_kpi(fact: DataFrame, product: DataFrame) -> DataFrame:
    return _share_view(fact.join(product, "product_key"), "category")


def state_kpi(fact: DataFrame, location: DataFrame) -> DataFrame:
    known = location.filter(F.col("ship_state") != "Unknown")
    return _share_view(fact.join(known, "location_key"), "ship_state")


def channel_kpi(fact: DataFrame, channel: DataFrame) -> DataFrame:
    return _kpis(fact.join(channel, "channel_key"), "sales_channel", "fulfilment").select(
        "sales_channel",
        "fulfilment",
        "total_orders",
        revenue().alias("total_revenue"),
        mean2(F.col("cents"), F.col("lines")).alias("avg_order_value"),
    )


def _check(name: str, found: DataFrame) -> DataFrame:
    return found.groupBy().agg(F.count(F.lit(1)).alias("violations")).select(
        F.lit(name).alias("check"), "violations"
    )


def _repeated(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def checks(fact: DataFrame, dims: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Violations per constraint: repeated primary keys, repeated SKUs, fact rows whose
    foreign key does not resolve. Keys are counted per value before they are looked up,
    so a hot key is one row."""
    found = []
    for name, (dim, key) in dims.items():
        found.append(_check(f"{name}: repeated {key}", _repeated(dim, key)))
        used = fact.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
        orphans = used.join(dim.select(key), key, "left_anti")
        found.append(
            orphans.groupBy().agg(F.coalesce(F.sum("n"), F.lit(0)).alias("violations")).select(
                F.lit(f"fact_orders: {key} without {name}").alias("check"), "violations"
            )
        )
    product = dims["dim_product"][0]
    found.append(_check("dim_product: repeated sku", _repeated(product, "sku")))
    result = found[0]
    for more in found[1:]:
        result = result.unionByName(more)
    return result


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per loaded table."""
    result = None
    for name, df in tables.items():
        counted = df.groupBy().agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("table"), "rows"
        )
        result = counted if result is None else result.unionByName(counted)
    return result


def load_star(staged: DataFrame, start: date, end: date, out: str) -> DataFrame:
    """Write the five tables under ``out``; returns the rows of each, observed while
    writing. Readers then plan their joins from the file sizes."""
    spark = staged.sparkSession
    tables = {
        "dim_date": calendar(spark, start, end),
        "dim_product": dim_product(staged),
        "dim_location": dim_location(staged),
        "dim_channel": dim_channel(staged),
        "fact_orders": fact_orders(staged),
    }
    counts = [(name, write_counted(df, f"{out}/{name}")) for name, df in tables.items()]
    return spark.createDataFrame(counts, "table string, rows bigint")
