"""The order-line table the whole library works on, derived from the given tables.

One row per line item. ``sales(spark, folder, *columns)`` joins only the tables
that the asked columns come from, so a report on channels never touches ``part``
or ``customer``; ``tests/test_sales.py`` checks that this equals the full join.
The join keys are the foreign keys of the tables.

``order_id`` stays the BIGINT join key: after the join with ``orders`` the data is
already partitioned by it, and a distinct count of orders needs no new shuffle.

The column rules are plain SQL text that Spark and the SQL oracle both accept.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, functions as F

from salesprism.functions.dates import with_calendar
from salesprism.session import materialised

# column -> (rule, tables it needs next to lineitem); {str} is the text type
RULES: dict[str, tuple[str, tuple[str, ...]]] = {
    "order_id": ("l_orderkey", ()),
    "line_no": ("l_linenumber", ()),
    "customer_id": ("o_custkey", ("orders",)),
    "order_date": ("cast(o_orderdate as date)", ("orders",)),
    "status": (
        "case when l_returnflag='R' then 'Returned' "
        "when l_returnflag='A' and l_linestatus='F' then 'Delivered' "
        "when l_returnflag='A' then 'Shipped' "
        "when l_linestatus='F' then 'Shipped - Delivered To Buyer' "
        "when o_orderstatus='P' then 'Pending' else 'Cancelled' end",
        ("orders",),
    ),
    "fulfilment": ("case when l_suppkey % 4 = 0 then 'Merchant' else 'Marketplace' end", ()),
    "sales_channel": ("case when l_partkey % 10 = 0 then 'Direct' else 'Online' end", ()),
    "ship_service_level": (
        "case when o_orderpriority in ('1-URGENT','2-HIGH') then 'Expedited' else 'Standard' end",
        ("orders",),
    ),
    "style": ("p_name", ("part",)),
    "sku": ("concat('SKU-', cast(l_partkey as {str}))", ()),
    "asin": ("concat('ASIN-', cast(l_partkey as {str}))", ()),
    "category": ("p_type", ("part",)),
    "size": ("concat('S', cast(p_size % 11 as {str}))", ("part",)),
    "courier_status": (
        "case when l_suppkey % 7 = 0 then 'Unknown' "
        "else concat('Courier ', cast(l_suppkey % 5 as {str})) end",
        (),
    ),
    "qty": ("cast(l_quantity as int)", ()),
    "amount_cents": ("cast(round(l_extendedprice*100) as bigint)", ()),
    "ship_city": (
        "case when c_custkey % 33 = 0 then 'Unknown' "
        "else concat(n_name, '-', cast(c_custkey % 4 as {str})) end",
        ("orders", "customer", "nation"),
    ),
    "ship_state": (
        "case when c_custkey % 50 = 0 then 'Unknown' else n_name end",
        ("orders", "customer", "nation"),
    ),
    "ship_postal": ("cast(10000 + c_custkey % 90 as {str})", ("orders", "customer")),
    "ship_country": ("r_name", ("orders", "customer", "nation", "region")),
    "fulfilled_by": ("case when l_suppkey % 4 = 0 then 'Easy Ship' else 'Unknown' end", ()),
    "currency": ("'INR'", ()),
    "promotion_ids": (
        "case when l_discount < 0.04 then 'No Promotion' "
        "else concat('PROMO-', cast(cast(round(l_discount*100) as int) as {str})) end",
        (),
    ),
    "b2b": ("case when c_mktsegment='MACHINERY' then 'Yes' else 'No' end", ("orders", "customer")),
}

# calendar column -> oracle text over order_date
CALENDAR_SQL = {
    "year": "year(order_date)",
    "month": "month(order_date)",
    "month_name": "strftime(order_date, '%b')",
    "quarter": "quarter(order_date)",
    "week_number": "week(order_date)",
    "day_name": "strftime(order_date, '%A')",
}

ALL_COLUMNS = tuple(RULES)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _base_columns(columns: tuple[str, ...]) -> list[str]:
    base = [c for c in columns if c not in CALENDAR_SQL]
    if len(base) < len(columns) and "order_date" not in base:
        base.append("order_date")
    return base


def _needed_tables(columns: list[str]) -> set[str]:
    return {name for c in columns for name in RULES[c][1]}


def _joined(spark: SparkSession, folder: str, base: list[str]) -> DataFrame:
    """The lines with the tables that the rules of these columns need."""
    needed = _needed_tables(base)
    lines = table(spark, folder, "lineitem")
    if "orders" in needed:
        orders = table(spark, folder, "orders")
        if "customer" in needed:
            customer = table(spark, folder, "customer")
            if "nation" in needed:
                nation = table(spark, folder, "nation")
                if "region" in needed:
                    region = table(spark, folder, "region")
                    nation = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
                customer = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
            # joined on the order level, which has fewer rows than the lines
            orders = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        lines = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    if "part" in needed:
        part = table(spark, folder, "part")
        lines = lines.join(part, F.col("l_partkey") == F.col("p_partkey"))
    return lines


def _ruled(lines: DataFrame, base: list[str], columns: tuple[str, ...], *kept: str) -> DataFrame:
    """The asked columns by their rules, calendar columns added, and the kept ones as they are."""
    rows = lines.select(*[F.expr(RULES[c][0].format(str="string")).alias(c) for c in base], *kept)
    if len(base) == len(columns) and set(base) == set(columns):
        return rows
    return with_calendar(rows).select(*dict.fromkeys([*base, *columns]), *kept)


def sales(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    """Order lines with the given columns (all of them by default)."""
    columns = columns or ALL_COLUMNS
    base = _base_columns(columns)
    return _ruled(_joined(spark, folder, base), base, columns)


def stored_sales(spark: SparkSession, folder: str, *columns: str, by_year: bool = False) -> DataFrame:
    """``sales``, its joins done and written once, for several passes over the lines.

    What is written are the tables' own columns, which are fewer and narrower than the texts made of them; a pass
    reads those that its columns come from and applies the rules of these. ``by_year`` adds ``order_year`` and a folder for
    each, so that passes over some years read no others.
    """
    columns = columns or ALL_COLUMNS
    base = _base_columns(columns)
    if by_year and "order_date" not in base:
        raise ValueError("lines without their order_date have no year")
    lines = _joined(spark, folder, base)
    words = {word for c in base for word in re.findall(r"\w+", RULES[c][0])}
    own = [c for c in lines.columns if c in words]
    if not by_year:
        return _ruled(materialised(lines.select(*own)), base, columns)
    year = F.year(F.expr(RULES["order_date"][0])).alias("order_year")
    return _ruled(materialised(lines.select(*own, year), "order_year"), base, columns, "order_year")


def sales_sql(*columns: str) -> str:
    """The same rows as SQL text for the oracle."""
    columns = columns or ALL_COLUMNS
    base = _base_columns(columns)
    needed = _needed_tables(base)
    text = "from lineitem"
    for name, condition in (
        ("orders", "l_orderkey = o_orderkey"),
        ("part", "l_partkey = p_partkey"),
        ("customer", "o_custkey = c_custkey"),
        ("nation", "c_nationkey = n_nationkey"),
        ("region", "n_regionkey = r_regionkey"),
    ):
        if name in needed:
            text += f" join {name} on {condition}"
    picked = ", ".join(f"{RULES[c][0].format(str='varchar')} as {c}" for c in base)
    rows = f"select {picked} {text}"
    calendar = [c for c in columns if c in CALENDAR_SQL]
    if not calendar:
        return rows
    extra = ", ".join(f"{CALENDAR_SQL[c]} as {c}" for c in calendar)
    return f"select *, {extra} from ({rows})"


def completed(df: DataFrame) -> DataFrame:
    """Lines of completed orders, by exact status text."""
    return df.filter(F.col("status").isin(*COMPLETED))


def delivered_view(df: DataFrame) -> DataFrame:
    """Lines of completed orders, by status text in any letter case."""
    return df.filter(F.lower("status").isin(*[s.lower() for s in COMPLETED]))


# fixed values: statuses that count as completed
COMPLETED = ("Delivered", "Shipped", "Shipped - Delivered To Buyer")
