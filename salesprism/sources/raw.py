"""Raw order files: the text schema, CSV readers, and a raw table with faults.

``raw_sales`` derives a raw table with duplicates, gaps, bad dates, bad numbers and
uneven spelling from the given tables, to run the cleaning stage on them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from salesprism.sources.sales import sales, sales_sql

# fixed values: header of the raw order file, in file order
RAW_HEADER = (
    "index", "Order ID", "Date", "Status", "Fulfilment", "Sales Channel ", "ship-service-level",
    "Style", "SKU", "Category", "Size", "ASIN", "Courier Status", "Qty", "currency", "Amount",
    "ship-city", "ship-state", "ship-postal-code", "ship-country", "promotion-ids", "B2B",
    "fulfilled-by",
)
RAW_SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in RAW_HEADER])

CORRUPT = "_corrupt_record"


def read_raw_csv(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """Raw CSV with header, all text, in one pass (no schema inference).

    A line that does not fit the header is kept with its text in ``_corrupt_record``.
    """
    schema = T.StructType([*RAW_SCHEMA.fields, T.StructField(CORRUPT, T.StringType())])
    reader = spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE")
    return reader.option("columnNameOfCorruptRecord", CORRUPT).options(**options).csv(path)


def read_mapped_csv(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    """Load a CSV by column position under new names, as a bulk load into staging."""
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    return spark.read.schema(schema).option("header", True).option("enforceSchema", True).csv(path)


def read_cleaned_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Cleaned table from CSV with typed columns and ISO dates."""
    return (
        spark.read.schema(schema).option("header", True).option("dateFormat", "yyyy-MM-dd").csv(path)
    )


def with_types(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Select the named columns with the given types; bad values become null."""
    return df.select(*[F.col(c).try_cast(t).alias(c) for c, t in types.items()])


# fixed values: types of the columns a BI import keeps
IMPORT_TYPES = {
    "order_id": "string", "date": "date", "status": "string", "fulfilment": "string",
    "sales_channel": "string", "category": "string", "size": "string", "qty": "bigint",
    "amount": "decimal(12,2)", "ship_state": "string", "ship_postal_code": "string", "b2b": "string",
}

_BASE = (
    "order_id", "line_no", "customer_id", "order_date", "status", "fulfilment", "sales_channel",
    "ship_service_level", "style", "sku", "asin", "category", "size", "courier_status", "qty",
    "amount_cents", "ship_city", "ship_state", "ship_postal", "ship_country", "promotion_ids",
    "b2b", "fulfilled_by", "currency",
)
_PART = "cast(substring(sku, 5) as bigint)"
_MONEY = (
    "concat(cast({cents} {div} 100 as {str}), '.', lpad(cast({cents} % 100 as {str}), 2, '0'))"
)
_RULES = {
    "index": "cast(order_id * 10 + line_no as {str})",
    "Order ID": "cast(order_id as {str})",
    "Date": "case when order_id % 200 = 7 then 'not a date' else {mdy} end",
    "Status": "case when qty % 37 = 5 then null else concat(' ', status, ' ') end",
    "Fulfilment": "fulfilment",
    "Sales Channel ": "sales_channel",
    "ship-service-level": "lower(ship_service_level)",
    "Style": "style",
    "SKU": "sku",
    "Category": "upper(category)",
    "Size": "case when size = 'S3' then '3XL' when size = 'S4' then 'o''neil st' else size end",
    "ASIN": "asin",
    "Courier Status": "case when courier_status = 'Unknown' then null else courier_status end",
    "Qty": f"case when {_PART} % 90 = 3 then 'x' when {_PART} % 90 = 5 "
    "then concat(cast(qty as {str}), '.7') when " + f"{_PART} % 90 = 7 then concat(cast(qty as {{str}}), '.0') "
    "else cast(qty as {str}) end",
    "currency": "currency",
    "Amount": f"case when {_PART} % 25 = 0 then null when order_id % 400 = 11 then "
    + _MONEY.replace("{cents}", "(amount_cents * 40)")
    + " else " + _MONEY.replace("{cents}", "amount_cents") + " end",
    "ship-city": "case when ship_city = 'Unknown' then null else ship_city end",
    "ship-state": "case when ship_state = 'Unknown' then null else ship_state end",
    "ship-postal-code": "ship_postal",
    "ship-country": "ship_country",
    "promotion-ids": "case when promotion_ids = 'No Promotion' then null else promotion_ids end",
    "B2B": "case customer_id % 4 when 0 then 'TRUE' when 1 then 'FALSE' when 2 then 'yes' else 'no' end",
    "fulfilled-by": "case when fulfilled_by = 'Unknown' then null else fulfilled_by end",
}


def raw_sales(spark: SparkSession, folder: str) -> DataFrame:
    """Raw order lines with faults; every order with ``order_id % 250 = 0`` occurs twice."""
    words = {"str": "string", "div": "div", "mdy": "date_format(order_date, 'MM-dd-yyyy')"}
    copies = F.when(F.col("order_id") % 250 == 0, F.array(F.lit(1), F.lit(2))).otherwise(
        F.array(F.lit(1))
    )
    lines = sales(spark, folder, *_BASE).withColumn("_copy", F.explode(copies))
    return lines.select(*[F.expr(rule.format(**words)).alias(n) for n, rule in _RULES.items()])


def raw_sales_sql() -> str:
    """The same rows for the oracle, already under standard column names."""
    words = {"str": "varchar", "div": "//", "mdy": "strftime(order_date, '%m-%d-%Y')"}
    picked = ", ".join(
        f'{rule.format(**words)} as "{name.strip().lower().replace(" ", "_").replace("-", "_")}"'
        for name, rule in _RULES.items()
    )
    lines = f"select {picked} from s"
    return (
        f"with s as ({sales_sql(*_BASE)}) "
        f"{lines} union all {lines} where order_id % 250 = 0"
    )
