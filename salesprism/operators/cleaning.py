"""Cleaning of raw order lines.

The steps and their order: standard names, whole-row dedup, date parsing (rows
without a date go), date parts, gap filling, number coercion, unit price, text
case, flags, outlier capping.

The raw lines are written once as Parquet in the shared folder, with a hash; only the hashes and
the lines that share one are shuffled for the dedup. The distinct lines are written, too. The statistics passes (median and mode, then
quartiles) scan one column of that table each and bring back one row; the cleaned
table is then a plain scan and projection.

Money is BIGINT cents. Fills and caps that fall between two cents round half up.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, functions as F

from salesprism.functions.exact import mean_cents
from salesprism.functions.text import standard_name, stripped, title_case, yes_no
from salesprism.operators.quantiles import mode, scaled_quantiles
from salesprism.operators.repeats import HASH, distinct_rows, hashed
from salesprism.session import materialised

# fixed values: what stands in for a gap
FILLS = {
    "ship_city": "Unknown",
    "ship_state": "Unknown",
    "courier_status": "Unknown",
    "promotion_ids": "No Promotion",
    "fulfilled_by": "Unknown",
}
# fixed values: the columns that get trimmed and title-cased, where present
TITLE_CASED = (
    "status", "fulfilment", "sales_channel_", "ship_service_level", "style", "category", "size",
    "ship_city", "ship_state", "ship_country", "currency",
)
DATE_FORMAT = "MM-dd-yyyy"
IQR_FACTOR = 3


def standardise_names(df: DataFrame) -> DataFrame:
    """Rename all columns to snake case; two columns must not end up the same."""
    names = [standard_name(c) for c in df.columns]
    clashes = sorted({n for n in names if names.count(n) > 1})
    if clashes:
        raise ValueError(f"column names clash after standardising: {clashes}")
    return df.toDF(*names)


def rename_if_present(df: DataFrame, old: str, new: str) -> DataFrame:
    return df.withColumnRenamed(old, new) if old in df.columns else df


def with_date(df: DataFrame) -> DataFrame:
    """Parse the date text; text that is no date becomes null."""
    return df.withColumn("date", F.try_to_date("date", DATE_FORMAT))


def date_parts(df: DataFrame) -> DataFrame:
    day = F.col("date")
    return df.withColumns(
        {
            "year": F.year(day),
            "month": F.month(day),
            "month_name": F.date_format(day, "MMM"),
            "quarter": F.quarter(day),
            "week": F.weekofyear(day),
            "day_of_week": F.date_format(day, "EEEE"),
        }
    )


def cents_of(amount: Column) -> Column:
    """Amount text to cents, null where it is no number."""
    return F.round(amount.try_cast("decimal(20,4)") * 100).cast("bigint")


def distinct_lines(stored: DataFrame) -> DataFrame:
    """Distinct lines of the stored raw ones with parsed date (null where bad) and cents (null where bad)."""
    dated = with_date(distinct_rows(stored))
    return dated.withColumn("amount_cents", cents_of(F.col("amount"))).drop("amount")


def median_cents(lines: DataFrame) -> DataFrame:
    """One row: the median of the known amounts."""
    doubled = scaled_quantiles(lines, "amount_cents", {"m": (1, 2)})
    return doubled.select(mean_cents(F.col("m"), F.lit(2)).alias("median_cents"))


def amount_fences(lines: DataFrame) -> DataFrame:
    """One row: quartiles and 3 x IQR fences of the amounts, all times 4."""
    quartiles = scaled_quantiles(lines, "amount_cents", {"q1_x4": (1, 4), "q3_x4": (3, 4)})
    spread = (F.col("q3_x4") - F.col("q1_x4")) * IQR_FACTOR
    return quartiles.select(
        "q1_x4",
        "q3_x4",
        (F.col("q1_x4") - spread).alias("low_x4"),
        (F.col("q3_x4") + spread).alias("high_x4"),
    )


@dataclass(frozen=True)
class Statistics:
    """What the fills and the cap need to know about all lines."""

    median_cents: int | None
    status_mode: str | None
    q1_x4: int | None = None
    q3_x4: int | None = None
    low_x4: int | None = None
    high_x4: int | None = None


def is_outlier(known: Statistics) -> Column:
    four = F.col("amount_cents") * 4
    return (four < F.lit(known.low_x4)) | (four > F.lit(known.high_x4))


def whole_number(text: Column) -> Column:
    """A number in a text, cut to an integer; null for anything else."""
    return F.coalesce(text.try_cast("int"), text.try_cast("double").try_cast("int"))


def filled_lines(lines: DataFrame, known: Statistics) -> DataFrame:
    """All gaps filled, numbers coerced, text and flags made uniform; nothing capped yet."""
    filled = date_parts(lines).withColumns(
        {
            "amount_cents": F.coalesce("amount_cents", F.lit(known.median_cents).cast("bigint")),
            "status": F.coalesce("status", F.lit(known.status_mode).cast("string")),
            "qty": F.coalesce(whole_number(F.col("qty")), F.lit(1)),
            **{c: F.coalesce(F.col(c), F.lit(text)) for c, text in FILLS.items()},
        }
    )
    # in a step of its own, so that a text is stripped once and not for each use of it
    filled = filled.withColumns({c: stripped(F.col(c)) for c in TITLE_CASED if c in filled.columns})
    cased = {c: title_case(F.col(c)) for c in TITLE_CASED if c in filled.columns}
    priced = filled.withColumns(
        {"unit_price_cents": mean_cents(F.col("amount_cents"), F.col("qty")), **cased}
    )
    flagged = priced.withColumn("b2b", yes_no(F.col("b2b")))
    return rename_if_present(flagged, "sales_channel_", "sales_channel")


def capped(filled: DataFrame, known: Statistics) -> DataFrame:
    """Amounts brought inside the fences, never below 0. The unit price keeps the
    value from before capping."""
    if known.low_x4 is None:
        return filled
    amount = F.col("amount_cents")
    low, high = max(0, (known.low_x4 + 2) // 4), (known.high_x4 + 2) // 4
    inside = F.least(F.greatest(amount, F.lit(low)), F.lit(high)).cast("bigint")
    return filled.withColumn("amount_cents", F.when(amount.isNotNull(), inside))


@dataclass(frozen=True)
class CleaningRun:
    """A raw table, under standard names, on its way to the cleaned one.

    ``distinct`` also holds the lines without a date, which ``lines`` leaves out.
    """

    raw: DataFrame
    distinct: DataFrame
    known: Statistics

    @property
    def lines(self) -> DataFrame:
        return self.distinct.filter(F.col("date").isNotNull())

    @property
    def filled(self) -> DataFrame:
        return filled_lines(self.lines, self.known)

    @property
    def cleaned(self) -> DataFrame:
        return capped(self.filled, self.known)


def start_cleaning(raw: DataFrame) -> CleaningRun:
    """Write the raw and the distinct lines once and gather the statistics over them."""
    stored = hashed(standardise_names(raw))
    distinct = materialised(distinct_lines(stored))
    lines = distinct.filter(F.col("date").isNotNull())
    first = lines.groupBy().agg(F.count(F.lit(1))).select(
        median_cents(lines).scalar().alias("median_cents"),
        mode(lines, "status").scalar().alias("status_mode"),
    ).first()
    known = Statistics(first["median_cents"], first["status_mode"])
    fences = amount_fences(
        lines.select(
            F.coalesce("amount_cents", F.lit(known.median_cents).cast("bigint")).alias("amount_cents")
        )
    ).first()
    if fences is not None:
        known = replace(known, **fences.asDict())
    return CleaningRun(stored.drop(HASH), distinct, known)


def clean(raw: DataFrame) -> DataFrame:
    """Cleaned order lines from a raw table."""
    return start_cleaning(raw).cleaned


def as_sales(cleaned: DataFrame) -> DataFrame:
    """Cleaned lines under the names the reports use. Files without a customer column
    get the order as the customer."""
    renamed = cleaned.withColumnRenamed("date", "order_date").withColumnsRenamed(
        {"week": "week_number", "day_of_week": "day_name", "ship_postal_code": "ship_postal"}
    )
    if "customer_id" not in renamed.columns:
        renamed = renamed.withColumn("customer_id", F.col("order_id"))
    return renamed
