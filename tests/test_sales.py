"""The pruned join equals the full one."""

from pyspark.sql import functions as F

from salesprism.sources.sales import ALL_COLUMNS, sales, stored_sales


def test_pruned_join_equals_full_join(spark, folder):
    full = sales(spark, folder)
    assert tuple(full.columns) == ALL_COLUMNS
    for columns in (("order_id", "qty", "amount_cents"), ("order_id", "status"), ("sku", "category")):
        pruned = sales(spark, folder, *columns)
        assert pruned.columns == list(columns)
        whole = full.select(*columns)
        assert pruned.exceptAll(whole).count() == 0 and whole.exceptAll(pruned).count() == 0


def test_only_needed_tables_and_columns_are_read(spark, folder):
    plan = sales(spark, folder, "order_id", "sales_channel")._jdf.queryExecution().executedPlan().toString()
    assert "orders.parquet" not in plan and "part.parquet" not in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint>" in plan


def test_filters_reach_the_scan(spark, folder):
    lines = sales(spark, folder, "order_id", "order_date", "category").filter(F.col("category") == "SMALL")
    plan = lines._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(p_type,SMALL)" in plan


def test_stored_joins_give_the_same_lines(spark, folder):
    for columns in (ALL_COLUMNS, ("order_id", "order_date", "ship_city", "year"), ("sku", "amount_cents")):
        stored, plain = stored_sales(spark, folder, *columns), sales(spark, folder, *columns)
        assert stored.schema == plain.schema
        assert stored.exceptAll(plain).count() == 0 and plain.exceptAll(stored).count() == 0


def test_lines_of_a_year_are_read_from_its_files_alone(spark, folder):
    lines = stored_sales(spark, folder, "order_id", "order_date", by_year=True)
    last = lines.agg(F.max("order_year")).first()[0]
    late = lines.where(F.col("order_year") == last)
    plain = sales(spark, folder, "order_id", "order_date").where(F.year("order_date") == last)
    assert sorted(r[0] for r in late.select("order_id").collect()) == sorted(r[0] for r in plain.select("order_id").collect())
    assert "PartitionFilters: [isnotnull(order_year" in late._jdf.queryExecution().executedPlan().toString()
