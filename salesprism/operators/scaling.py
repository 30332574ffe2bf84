"""Standardising columns with the population deviation."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F


@dataclass(frozen=True)
class Standardiser:
    """Means and deviations of some columns; a column that never varies becomes 0."""

    columns: tuple[str, ...]
    means: tuple[float, ...]
    deviations: tuple[float, ...]

    @classmethod
    def fit(cls, df: DataFrame, columns: Sequence[str]) -> Standardiser:
        row = df.agg(
            *[F.avg(c).alias(f"m{i}") for i, c in enumerate(columns)],
            *[F.stddev_pop(c).alias(f"d{i}") for i, c in enumerate(columns)],
        ).first()
        n = len(columns)
        return cls(
            tuple(columns),
            tuple(float(row[f"m{i}"] or 0.0) for i in range(n)),
            tuple(float(row[f"d{i}"] or 0.0) for i in range(n)),
        )

    def texts(self, prefix: str = "z_") -> list[str]:
        """The scaled columns as SQL text, which is quick to plan again and again."""
        return [
            f"(cast({c} as double) - ({m!r}D)) / {(d or 1.0)!r}D as {prefix}{c}"
            for c, m, d in zip(self.columns, self.means, self.deviations)
        ]

    def transform(self, df: DataFrame, prefix: str = "z_") -> DataFrame:
        return df.selectExpr("*", *self.texts(prefix))

    def outputs(self, prefix: str = "z_") -> list[str]:
        return [prefix + c for c in self.columns]
