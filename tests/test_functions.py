"""Scalar helpers on hand-made values."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from salesprism.functions import dates, exact
from salesprism.functions.text import standard_name, title_case, yes_no


@pytest.mark.parametrize(
    "raw,expected",
    [(" Sales Channel ", "sales_channel"), ("ship-service-level", "ship_service_level"),
     ("Order ID", "order_id"), ("B2B", "b2b"), ("a - b", "a_b"), ("price (₹)", "price_")],
)
def test_standard_name(raw, expected):
    assert standard_name(raw) == expected


@pytest.mark.parametrize(
    "text", ["3XL", "Non-Amazon", "o'neil st", "shipped - delivered to buyer", "", "ÉCOLE d'été", "a1b2"]
)
def test_title_case_is_per_letter_run(spark, text):
    row = spark.createDataFrame([(text,)], "t string").select(title_case(F.col("t"))).first()
    assert row[0] == text.title()


def test_title_case_keeps_null(spark):
    assert spark.sql("select cast(null as string) t").select(title_case(F.col("t"))).first()[0] is None


def test_yes_no(spark):
    df = spark.createDataFrame([(t,) for t in (" true ", "YES", "no", "x", None)], "t string")
    assert [r[0] for r in df.select(yes_no(F.col("t"))).collect()] == ["Yes", "Yes", "No", "No", "No"]


@pytest.mark.parametrize(
    "day,week", [(date(2022, 1, 1), 0), (date(2024, 12, 31), 53), (date(2022, 1, 3), 1), (date(2024, 1, 1), 1)]
)
def test_monday_week(spark, day, week):
    df = spark.createDataFrame([(day,)], "d date").select(
        dates.monday_week(F.col("d")), dates.date_key(F.col("d")), dates.week_label(F.col("d"))
    )
    row = df.first()
    assert row[0] == week and row[1] == int(day.strftime("%Y%m%d"))


def test_money_sum_passes_the_bigint_range(spark):
    df = spark.createDataFrame([(9_000_000_000_000_000_000,)] * 5 + [(-7,), (None,)], "c long")
    assert int(df.agg(exact.money_sum("c")).first()[0]) == 45_000_000_000_000_000_000 - 7


def test_rounding_is_half_up_and_exact(spark):
    df = spark.createDataFrame([(5, 2, -5, 8)], "s long, n long, d long, b long")
    row = df.select(
        exact.mean2(F.col("s"), F.col("n")),
        exact.percent2(F.lit(1), F.col("b")),
        exact.signed_percent2(F.lit(-1), F.lit(3)),
        exact.mean2(F.col("s"), F.lit(0)),
        exact.safe_divide(F.col("s"), F.lit(0)),
    ).first()
    assert tuple(row) == (0.03, 12.5, -33.33, None, 0.0)


@pytest.mark.parametrize("total,count,mean", [(7, 3, 2), (-7, 3, -2), (-8, 3, -3), (8, 3, 3), (-3, 2, -1), (3, 2, 2), (0, 5, 0)])
def test_mean_is_half_up_on_both_sides_of_zero(spark, total, count, mean):
    row = spark.createDataFrame([(total, count)], "t bigint, c bigint").select(exact.mean_cents(F.col("t"), F.col("c"))).first()
    assert row[0] == mean


def test_floor_division_of_negative_decimals(spark):
    row = spark.sql("select cast(-250 as decimal(38,0)) as a, 200L as b").select(exact.floor_div(F.col("a"), F.col("b"))).first()
    assert row[0] == -2


def test_strip_takes_all_white_space(spark):
    from salesprism.functions.text import stripped

    texts = ["\t a b\n", "\xa0x\u3000", "", " \r\n"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(stripped(F.col("t"))).collect()] == [t.strip() for t in texts]


def test_quantity_texts(spark):
    from salesprism.operators.cleaning import whole_number

    texts = ["2", "2.0", "2.7", "-1.5", "x", "NaN", "1e30", None, "1e1"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(whole_number(F.col("t"))).collect()] == [2, 2, 2, -1, None, None, None, None, 10]
