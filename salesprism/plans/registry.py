"""Named queries: a builder, the columns it reads and its oracle text."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from salesprism.sources.sales import sales, sales_sql


@dataclass(frozen=True)
class NamedQuery:
    """``build`` gets the order lines reduced to ``columns``.

    With ``columns=None`` it gets the session and the folder instead. ``oracle`` is
    SQL in which ``{sales}`` stands for the order lines.
    """

    key: str
    title: str
    build: Callable
    columns: tuple[str, ...] | None
    oracle: str | None = None

    def __call__(self, spark: SparkSession, folder: str) -> DataFrame:
        if self.columns is None:
            return portable(self.build(spark, folder))
        return portable(self.build(sales(spark, folder, *self.columns)))

    def sql(self) -> str | None:
        if self.oracle is None or self.columns is None:
            return self.oracle
        return self.oracle.replace("{sales}", sales_sql(*self.columns))


def portable(df: DataFrame) -> DataFrame:
    """Plain output types: integers as BIGINT, dates as text, decimals as DOUBLE."""
    casts = {}
    for field in df.schema.fields:
        if isinstance(field.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            casts[field.name] = F.col(field.name).cast("bigint")
        elif isinstance(field.dataType, T.DateType):
            casts[field.name] = F.col(field.name).cast("string")
        elif isinstance(field.dataType, T.DecimalType):
            casts[field.name] = F.col(field.name).cast("double")
    return df.withColumns(casts) if casts else df


# Oracle text fragments: the rounding rules of functions/exact.py in plain SQL.
def sql_units(cents: str) -> str:
    return f"cast({cents} as double)/100"


def sql_mean2(total: str = "sum(amount_cents)", count: str = "count(*)") -> str:
    return f"cast((2*({total})+({count}))//(2*({count})) as double)/100"


def sql_percent2(part: str, whole: str) -> str:
    return f"cast((2*({part})*10000+({whole}))//(2*({whole})) as double)/100"


def sql_signed_percent2(delta: str, base: str) -> str:
    return (
        f"case when ({delta}) < 0 then -1 else 1 end * "
        f"cast((2*abs({delta})*10000+({base}))//(2*({base})) as double)/100"
    )


def big(expression: str) -> str:
    return f"cast({expression} as bigint)"
