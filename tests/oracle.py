"""Exact comparison of a Spark result with its oracle SQL."""

from __future__ import annotations

from collections import Counter

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()
SPARK_TYPES = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def compare(df, duck, sql: str) -> int:
    """Same column names, types and rows (as a multiset); returns the row count."""
    ours = dict(df.dtypes)
    described = {row[0]: row[1] for row in duck.execute(f"describe {sql}").fetchall()}
    theirs = {name: str(kind) for name, kind in described.items()}
    assert {n: SPARK_TYPES.get(t, t) for n, t in ours.items()} == theirs
    names = sorted(ours)
    picked = ", ".join(f'"{n}"' for n in names)
    expected = Counter(duck.execute(f"select {picked} from ({sql})").fetchall())
    actual = Counter(tuple(row) for row in df.select(*names).collect())
    assert sum(actual.values()) == sum(expected.values())
    missing, extra = expected - actual, actual - expected
    assert not missing and not extra, (
        f"{sum(missing.values())} rows differ\nexpected {list(missing)[:3]}\nactual   {list(extra)[:3]}"
    )
    return sum(actual.values())
