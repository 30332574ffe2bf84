"""Reusable measures under a filter context, and time intelligence.

A measure is built from components: revenue, distinct orders or quantity over the
lines that pass the slicers and the component's own condition. A component may
*override* a column: its condition then replaces the slicer and the grouping on that
column (cancelled orders by status show the same number in every row). Without an
override it narrows them further (delivered orders).

Components share one pass: lines fold to one row per group and order, then to one row
per group, so several distinct counts cost one shuffle and no row is copied per count.
Sums that override a grouping column add up from those groups; only a distinct count
that overrides one needs a pass of its own.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from salesprism.functions.exact import money_sum, safe_divide, units
from salesprism.session import materialised

CANCELLED = "Cancelled"
# fixed values: the two statuses that count as delivered in the measures
DELIVERED = ("Delivered", "Shipped - Delivered To Buyer")
NO_PROMOTION = "No Promotion"


@dataclass(frozen=True)
class FilterContext:
    """Slicer selections; an empty one lets everything through."""

    date_from: date | None = None
    date_to: date | None = None
    category: tuple[str, ...] = ()
    ship_state: tuple[str, ...] = ()
    status: tuple[str, ...] = ()
    sales_channel: tuple[str, ...] = ()
    b2b: tuple[str, ...] = ()

    def condition(self, without: frozenset[str] = frozenset()) -> Column:
        parts = []
        if "order_date" not in without:
            if self.date_from is not None and self.date_to is not None:
                parts.append(F.col("order_date").between(self.date_from, self.date_to))
            elif self.date_from is not None:
                parts.append(F.col("order_date") >= F.lit(self.date_from))
            elif self.date_to is not None:
                parts.append(F.col("order_date") <= F.lit(self.date_to))
        for column in ("category", "ship_state", "status", "sales_channel", "b2b"):
            chosen = getattr(self, column)
            if chosen and column not in without:
                parts.append(F.col(column).isin(*chosen))
        result = F.lit(True)
        for part in parts:
            result = result & part
        return result

    def apply(self, df: DataFrame) -> DataFrame:
        return df.filter(self.condition())


EVERYTHING = FilterContext()


@dataclass(frozen=True)
class Component:
    kind: str  # "revenue", "orders" or "quantity"
    column: str | None = None
    values: tuple[str, ...] = ()
    negate: bool = False
    overrides: frozenset[str] = field(default_factory=frozenset)

    def condition(self, context: FilterContext) -> Column:
        passed = context.condition(self.overrides)
        if self.column is not None:
            own = F.col(self.column).isin(*self.values)
            passed = passed & (~own if self.negate else own)
        if self.kind == "revenue":
            passed = passed & (F.col("status") != CANCELLED)
        return passed


def _replacing(kind: str, column: str, value: str, negate: bool = False) -> Component:
    return Component(kind, column, (value,), negate, frozenset({column}))


COMPONENTS = {
    "revenue": Component("revenue"),
    "orders": Component("orders"),
    "quantity": Component("quantity"),
    "delivered": Component("orders", "status", DELIVERED),
    "cancelled": _replacing("orders", "status", CANCELLED),
    "b2b_revenue": _replacing("revenue", "b2b", "Yes"),
    "b2c_revenue": _replacing("revenue", "b2b", "No"),
    "promo_revenue": _replacing("revenue", "promotion_ids", NO_PROMOTION, negate=True),
    "plain_revenue": _replacing("revenue", "promotion_ids", NO_PROMOTION),
    "promo_orders": _replacing("orders", "promotion_ids", NO_PROMOTION, negate=True),
    "plain_orders": _replacing("orders", "promotion_ids", NO_PROMOTION),
    "all_categories_revenue": Component("revenue", overrides=frozenset({"category"})),
}


def _percent(a: Column, b: Column) -> Column:
    return safe_divide(a, b) * F.lit(100.0)


def _zero(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0))


def _lift() -> Column:
    with_promo = safe_divide(units("promo_revenue"), F.col("promo_orders"))
    without = safe_divide(units("plain_revenue"), F.col("plain_orders"))
    return safe_divide(with_promo - without, without) * F.lit(100.0)


# measure -> (components, expression over them)
MEASURES = {
    "total_revenue": (("revenue",), lambda: units(_zero("revenue"))),
    "total_orders": (("orders",), lambda: _zero("orders")),
    "total_quantity_sold": (("quantity",), lambda: _zero("quantity")),
    "avg_order_value": (("revenue", "orders"), lambda: safe_divide(units("revenue"), F.col("orders"))),
    "delivered_orders": (("delivered",), lambda: _zero("delivered")),
    "cancelled_orders": (("cancelled",), lambda: _zero("cancelled")),
    "cancellation_rate_pct": (("cancelled", "orders"), lambda: _percent(F.col("cancelled"), F.col("orders"))),
    "delivery_rate_pct": (("delivered", "orders"), lambda: _percent(F.col("delivered"), F.col("orders"))),
    "category_share_pct": (
        ("revenue", "all_categories_revenue"),
        lambda: _percent(F.col("revenue"), F.col("all_categories_revenue")),
    ),
    "b2b_revenue": (("b2b_revenue",), lambda: units(_zero("b2b_revenue"))),
    "b2c_revenue": (("b2c_revenue",), lambda: units(_zero("b2c_revenue"))),
    "b2b_revenue_pct": (("b2b_revenue", "revenue"), lambda: _percent(F.col("b2b_revenue"), F.col("revenue"))),
    "promo_revenue": (("promo_revenue",), lambda: units(_zero("promo_revenue"))),
    "non_promo_revenue": (("plain_revenue",), lambda: units(_zero("plain_revenue"))),
    "promo_lift_pct": (
        ("promo_revenue", "promo_orders", "plain_revenue", "plain_orders"), _lift,
    ),
}


def _components(
    df: DataFrame, names: Sequence[str], keys: Sequence[str], context: FilterContext
) -> DataFrame:
    """One row per key with the named components, null where no line counts."""
    per_order, per_key = [], []
    for name in names:
        part = COMPONENTS[name]
        counts = part.condition(context)
        source = {"revenue": "amount_cents", "quantity": "qty"}.get(part.kind)
        if source:
            per_order.append(F.sum(F.when(counts, F.col(source).cast("bigint"))).alias(name))
            per_key.append((money_sum(name) if part.kind == "revenue" else F.sum(name)).alias(name))
        else:
            # a line without an order id counts for no order
            seen = F.when(counts & F.col("order_id").isNotNull(), F.lit(1))
            per_order.append(F.max(seen).alias(name))
            per_key.append(F.sum(name).alias(name))
    relaxed = frozenset().union(*[COMPONENTS[n].overrides for n in names])
    lines = df.filter(context.condition(relaxed))
    if all(COMPONENTS[n].kind != "orders" for n in names):
        # sums need no row per order
        sums = {n: F.when(COMPONENTS[n].condition(context), F.col("qty" if COMPONENTS[n].kind == "quantity" else "amount_cents")) for n in names}
        return lines.groupBy(*keys).agg(
            *[(F.sum(v.cast("bigint")) if COMPONENTS[n].kind == "quantity" else money_sum(v)).alias(n) for n, v in sums.items()]
        )
    return lines.groupBy(*keys, "order_id").agg(*per_order).groupBy(*keys).agg(*per_key)


def measure(
    df: DataFrame,
    names: Sequence[str],
    by: Sequence[str] = (),
    context: FilterContext = EVERYTHING,
) -> DataFrame:
    """The named measures per group under the slicers."""
    wanted = list(dict.fromkeys(c for n in names for c in MEASURES[n][0]))
    direct = [c for c in wanted if not COMPONENTS[c].overrides & set(by)]
    detached = [c for c in wanted if c not in direct]
    # sums over a replaced grouping add up from the groups of the same pass
    summed = [c for c in detached if COMPONENTS[c].kind != "orders"]
    detached = [c for c in detached if c not in summed]
    if not direct:
        direct = ["orders"]
    rows = _components(df, direct + summed, by, context)
    for name in summed:
        kept = [k for k in by if k not in COMPONENTS[name].overrides]
        rows = rows.withColumn(name, F.sum(name).over(Window.partitionBy(*kept)))
    if by:
        counted = F.lit(False)
        for name in direct:
            counted = counted | F.col(name).isNotNull()
        rows = rows.filter(counted)
    by_keys: dict[tuple[str, ...], list[str]] = {}
    for name in detached:
        keys = tuple(k for k in by if k not in COMPONENTS[name].overrides)
        by_keys.setdefault(keys, []).append(name)
    for keys, parts in by_keys.items():
        other = _components(df, parts, keys, context)
        if keys:
            other = other.withColumnsRenamed({k: f"_{k}" for k in keys})
            same = F.lit(True)
            for k in keys:
                same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
            rows = rows.join(other, same, "left").drop(*[f"_{k}" for k in keys])
        else:
            packed = other.select(F.struct(*parts)).scalar()
            rows = rows.withColumn("_whole", packed)
            rows = rows.withColumns({p: F.col(f"_whole.{p}") for p in parts}).drop("_whole")
    return rows.select(*by, *[MEASURES[n][1]().alias(n) for n in names])


def top_n(
    df: DataFrame, name: str, by: Sequence[str], n: int, context: FilterContext = EVERYTHING
) -> DataFrame:
    """The n groups with the highest measure."""
    return measure(df, [name], by, context).orderBy(F.desc(name), *by).limit(n)


def top_category(df: DataFrame, context: FilterContext = EVERYTHING) -> DataFrame:
    """The category with the highest revenue; ties give the first name."""
    return top_n(df, "total_revenue", ["category"], 1, context).select(
        F.col("category").alias("top_category"), "total_revenue"
    )


def time_intelligence(
    df: DataFrame, by: Sequence[str] = (), context: FilterContext = EVERYTHING
) -> DataFrame:
    """Revenue per calendar month with change to the month before, year to date, year
    to date a year earlier and its change.

    Months without orders count as 0, so "before" is always the calendar month before.
    Earlier periods look past the date slicer, which only picks the months shown; a
    month counts whole if the slicer touches it.
    """
    by = list(by)
    no_dates = context.condition(frozenset({"order_date"}))
    month = F.trunc("order_date", "month").alias("month_start")
    found = (
        df.filter(no_dates & (F.col("status") != CANCELLED))
        .groupBy(*by, month)
        .agg(money_sum("amount_cents").alias("cents"))
    )
    # the months are few; written once, so that their ends and cells come from one scan of the lines
    found = materialised(found)
    ends = found.agg(
        F.sequence(F.min("month_start"), F.max("month_start"), F.expr("interval 1 month"))
    ).scalar()
    # a key's cells meet in one map, as large as the calendar, and are stretched over the common span
    known = found.groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct("month_start", "cents"))).alias("_cells"))
    spine = known.withColumn("_months", ends).select(*by, "_cells", F.explode("_months").alias("month_start"))
    filled = spine.select(
        *by,
        "month_start",
        F.year("month_start").alias("year"),
        F.coalesce(F.try_element_at("_cells", F.col("month_start")), F.lit(0).cast("decimal(29,0)")).alias("cents"),
    )
    by_month = Window.partitionBy(*by).orderBy("month_start")
    to_date = (
        Window.partitionBy(*by, "year").orderBy("month_start").rowsBetween(Window.unboundedPreceding, 0)
    )
    zero = F.lit(0).cast("decimal(38,0)")
    years = (
        filled.withColumn("before", F.coalesce(F.lag("cents").over(by_month), zero))
        .withColumn("ytd", F.sum("cents").over(to_date))
        .withColumn("pytd", F.coalesce(F.lag("ytd", 12).over(by_month), zero))
    )
    shown = F.lit(True)
    if context.date_from is not None:
        shown = shown & (F.last_day("month_start") >= F.lit(context.date_from))
    if context.date_to is not None:
        shown = shown & (F.col("month_start") <= F.lit(context.date_to))
    change, growth = F.col("cents") - F.col("before"), F.col("ytd") - F.col("pytd")
    return (
        years.filter(shown)
        .select(
            *by,
            "month_start",
            units("cents").alias("total_revenue"),
            units(change).alias("revenue_mom_change"),
            _percent(change, F.col("before")).alias("revenue_mom_growth_pct"),
            units("ytd").alias("revenue_ytd"),
            units("pytd").alias("revenue_pytd"),
            _percent(growth, F.col("pytd")).alias("revenue_yoy_pct"),
        )
        .orderBy(*by, "month_start")
    )
