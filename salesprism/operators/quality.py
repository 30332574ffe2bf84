"""Column profiles, the quality summary and the log of cleaning actions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from salesprism.functions.exact import mean2, percent2, units
from salesprism.operators.cells import cells
from salesprism.operators.cleaning import CleaningRun, is_outlier, whole_number
from salesprism.operators.repeats import row_digest
from salesprism.operators.values import column_values


def profile(df: DataFrame, approximate: bool = False) -> DataFrame:
    """One row per column: type, filled and missing rows, distinct values, a sample.

    The rows are read once, when this is called: each task folds them to its different values, and only these are
    stored and shuffled, numbers as runs of neighbours. With ``approximate`` the distinct counts come from sketches,
    nothing is stored and nothing is shuffled but one row per task.
    """
    columns = df.sparkSession.createDataFrame(
        [(i, c, t) for i, (c, t) in enumerate(df.dtypes)], "position int, name string, dtype string"
    )
    if approximate:
        found = _sketched(df)
    else:
        found = _counted(df)
    return (
        columns.join(found, F.col("name") == F.col("column"), "left")
        .select(
            "position",
            "name",
            "dtype",
            F.coalesce("non_null", F.lit(0)).alias("non_null"),
            F.coalesce(F.col("rows") - F.col("non_null"), F.lit(0)).alias("null_count"),
            F.coalesce(
                percent2(F.col("rows") - F.col("non_null"), F.col("rows")), F.lit(0.0)
            ).alias("null_pct"),
            F.coalesce("unique_values", F.lit(0)).alias("unique_values"),
            F.coalesce("sample", F.lit("N/A")).alias("sample"),
        )
        .orderBy("position")
    )


def _counted(df: DataFrame) -> DataFrame:
    return column_values(df)


def null_counts(df: DataFrame) -> DataFrame:
    """Columns with gaps from one plain aggregate, emptiest first (name, null_count, null_pct)."""
    whole = df.agg(F.count(F.lit(1)).alias("rows"), *[F.count(f"`{c}`").alias(f"c{i}") for i, c in enumerate(df.columns)])
    found = whole.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("name"), "rows", (F.col("rows") - F.col(f"c{i}")).alias("null_count"))
        for i, c in enumerate(df.columns)
    ])))
    return missing_ranking(found.withColumn("null_pct", percent2(F.col("null_count"), F.col("rows"))))


def _sketched(df: DataFrame) -> DataFrame:
    packed = df.agg(
        F.array(
            *[
                F.struct(
                    F.lit(c).alias("column"),
                    F.count(F.lit(1)).alias("rows"),
                    F.count(f"`{c}`").alias("non_null"),
                    F.approx_count_distinct(f"`{c}`").alias("unique_values"),
                    F.min(F.col(f"`{c}`").cast("string")).alias("sample"),
                )
                for c in df.columns
            ]
        ).alias("p")
    )
    return packed.select(F.inline("p"))


def missing_ranking(profiled: DataFrame) -> DataFrame:
    """Columns with gaps, emptiest first."""
    return (
        profiled.filter(F.col("null_count") > 0)
        .select("name", "null_count", "null_pct")
        .orderBy(F.desc("null_pct"), "name")
    )


def duplicate_count(df: DataFrame) -> DataFrame:
    """One row: the rows that repeat an earlier row."""
    copies = df.groupBy(row_digest(df.columns).alias("_row")).agg(F.count(F.lit(1)).alias("_n"))
    return copies.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicates"))


def _null_cells(df: DataFrame):
    return sum((F.col(f"`{c}`").isNull().cast("int") for c in df.columns), F.lit(0))


def raw_summary(raw: DataFrame, distinct: DataFrame | None = None) -> DataFrame:
    """One row: size, repeated rows and empty cells of the raw table.

    With the distinct lines of a cleaning run at hand the raw rows are only scanned;
    otherwise their digests are shuffled once to find the repeats.
    """
    nulls = _null_cells(raw).cast("bigint")
    size = F.lit(len(raw.columns)).cast("bigint").alias("columns")
    if distinct is not None:
        kept = distinct.agg(F.count(F.lit(1))).scalar()
        return raw.agg(
            F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(nulls), F.lit(0)).alias("total_nulls")
        ).select("rows", size, (F.col("rows") - kept).alias("duplicates"), "total_nulls")
    copies = raw.groupBy(row_digest(raw.columns).alias("_row")).agg(F.count(F.lit(1)).alias("_n"), F.sum(nulls).alias("_nulls"))
    return copies.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"),
        size,
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicates"),
        F.coalesce(F.sum("_nulls"), F.lit(0)).alias("total_nulls"),
    )


def cleaned_summary(cleaned: DataFrame) -> DataFrame:
    """One row: size, date range and headline numbers of the cleaned table.

    Equal rows are found by 128 bits of each, a cell like those of the other distinct counts; so one scan is enough
    and whole rows are not shuffled.
    """
    found = cells(
        cleaned,
        distinct={
            "orders": F.col("order_id"), "categories": F.col("category"), "states": F.col("ship_state"),
            "different": row_digest(cleaned.columns),
        },
        counts={"lines": F.lit(True)},
        sums={"nulls": _null_cells(cleaned), "qty": F.col("qty")},
        money={"cents": F.col("amount_cents")},
        least={"first": F.col("date")},
        most={"last": F.col("date")},
    ).totals()

    def number(name: str) -> Column:
        return F.coalesce(name, F.lit(0).cast("bigint"))

    return found.select(
        number("lines").alias("rows"),
        F.lit(len(cleaned.columns)).cast("bigint").alias("columns"),
        number("nulls").alias("total_nulls"),
        F.concat(F.col("first").cast("string"), F.lit(" to "), F.col("last").cast("string")).alias("date_range"),
        units("cents").alias("total_revenue"),
        F.col("orders").alias("total_orders"),
        F.col("qty").alias("total_qty"),
        mean2(F.col("cents"), F.col("lines")).alias("avg_order_value"),
        "categories",
        "states",
        (number("lines") - number("different")).alias("duplicates"),
    )


def cleaning_counts(run: CleaningRun) -> DataFrame:
    """One row: what the cleaning stage found and filled."""
    known = run.known
    dated = F.col("date").isNotNull()

    def gaps(column: str):
        return F.count_if(dated & F.col(column).isNull())

    outliers = run.filled.agg(F.count_if(is_outlier(known)))
    return run.distinct.agg(
        F.count_if(dated).alias("dated_rows"),
        F.count_if(~dated).alias("bad_dates_dropped"),
        gaps("amount_cents").alias("amount_filled"),
        gaps("ship_city").alias("city_filled"),
        gaps("ship_state").alias("state_filled"),
        gaps("status").alias("status_filled"),
        F.count_if(dated & whole_number(F.col("qty")).isNull()).alias("qty_defaulted"),
        F.count(F.lit(1)).alias("distinct_rows"),
    ).select(
        "*",
        (run.raw.agg(F.count(F.lit(1))).scalar() - F.col("distinct_rows")).alias("duplicates_removed"),
        outliers.scalar().alias("outliers_capped"),
        F.lit(known.median_cents).cast("bigint").alias("median_cents"),
        F.trim(F.lit(known.status_mode).cast("string")).alias("status_mode"),
        F.lit(known.q1_x4).cast("bigint").alias("q1_x4"),
        F.lit(known.q3_x4).cast("bigint").alias("q3_x4"),
    ).drop("distinct_rows")


def cleaning_log(run: CleaningRun) -> DataFrame:
    """The numbered cleaning actions as text, with their counts."""
    c = F.col
    # fixed values: the wording of the actions
    actions = [
        F.format_string("Removed %d duplicate rows", c("duplicates_removed")),
        F.lit("Standardised all column names (lowercase, underscores)"),
        F.lit("Converted 'date' to datetime, extracted year/month/quarter/week features"),
        F.format_string(
            "Filled %d missing 'amount' values with median (₹%s)",
            c("amount_filled"),
            F.format_number((c("median_cents") / F.lit(100)).cast("decimal(20,2)"), 2),
        ),
        F.format_string("Filled %d missing 'ship_city' with 'Unknown'", c("city_filled")),
        F.format_string("Filled %d missing 'ship_state' with 'Unknown'", c("state_filled")),
        F.format_string(
            "Filled %d missing 'status' with mode ('%s')", c("status_filled"), c("status_mode")
        ),
        F.lit("Filled missing courier_status, promotion_ids, fulfilled_by"),
        F.lit("Computed unit_price = amount / qty"),
        F.format_string(
            "Capped %d amount outliers via IQR Winsorisation (3×IQR)", c("outliers_capped")
        ),
        F.lit("Normalised B2B column to Yes/No"),
        F.lit("Title-cased all categorical string columns"),
    ]
    counted = cleaning_counts(run)
    return counted.select(F.posexplode(F.array(*actions)).alias("step", "action")).withColumn(
        "step", c("step") + 1
    )


def quality_report(run: CleaningRun) -> DataFrame:
    """One nested row: time of the report (in the session's zone), raw table, cleaned table, cleaning actions; ready for JSON."""
    log = cleaning_log(run).groupBy().agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("step", "action"))), lambda a: a["action"]
        ).alias("cleaning_actions")
    )
    return log.select(
        F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss").alias("report_generated_at"),
        raw_summary(run.raw, run.distinct).select(F.struct("*")).scalar().alias("raw_dataset"),
        cleaned_summary(run.cleaned).select(F.struct("*")).scalar().alias("cleaned_dataset"),
        "cleaning_actions",
    )


def report_lines(report: DataFrame) -> DataFrame:
    """The quality report as text lines."""
    rule = "-" * 40

    def section(title: str, column: str):
        def text(field):
            value = F.col(f"{column}.{field.name}")
            if field.dataType.typeName() == "double":
                value = value.cast("decimal(38,2)")
            return F.coalesce(value.cast("string"), F.lit("None"))

        return [F.lit(title), F.lit(rule)] + [
            F.concat(F.lit(f"  {field.name:<25}: "), text(field))
            for field in report.schema[column].dataType.fields
        ]

    head = F.array(
        *section("RAW DATASET", "raw_dataset"),
        F.lit(""),
        *section("CLEANED DATASET", "cleaned_dataset"),
        F.lit(""),
        F.lit("CLEANING ACTIONS PERFORMED"),
        F.lit(rule),
    )
    actions = F.transform(
        "cleaning_actions",
        lambda a, i: F.concat(F.lit("  "), F.lpad((i + 1).cast("string"), 2, "0"), F.lit(". "), a),
    )
    return report.select(F.explode(F.concat(head, actions)).alias("value"))
