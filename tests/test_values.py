"""Values of all columns: equal to counting, from one reading of the rows, whatever a task holds."""

import random

import pyarrow as pa
import pytest

from salesprism.operators import quality as q, values as v

TEXTS = ["1", "01", "1.0", "1.00", "-0", "-0.00", "0", "0.00", "-1.50", "-0.05", "0.05", "100", "1e3", "", " 1", "12", "12\n", "9" * 18, "9" * 19, "é", "\U0001f600", None]


def test_profile_reads_its_rows_once(spark):
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    rows = q.profile(spark.range(1000).mapInArrow(counted, "id long")).collect()
    assert [(x["non_null"], x["unique_values"], x["sample"]) for x in rows] == [(1000, 1000, "0")]
    assert read.value == 1000


def test_texts_stay_different_values(spark):
    df = spark.createDataFrame([(t, i, None) for i, t in enumerate(TEXTS * 3)], "t string, i int, nothing string")
    rows = {x["column"]: x for x in v.column_values(df).collect()}
    assert list(rows) == ["t", "i", "nothing"]
    assert tuple(rows["t"]) == ("t", 3 * len(TEXTS), 3 * (len(TEXTS) - 1), len(TEXTS) - 1, "")
    assert (rows["i"]["unique_values"], rows["i"]["sample"]) == (3 * len(TEXTS), "0")
    assert tuple(rows["nothing"])[1:] == (3 * len(TEXTS), 0, 0, None)
    assert tuple(v.column_values(df.limit(0)).collect()[0]) == ("t", 0, 0, 0, None)


@pytest.mark.parametrize("most, gathered", [(v.MOST_HELD, v._GATHERED), (4000, 50), (0, 1)])
def test_values_that_are_handed_on_early(monkeypatch, most, gathered):
    monkeypatch.setattr(v, "MOST_HELD", most)
    monkeypatch.setattr(v, "_GATHERED", gathered)
    monkeypatch.setattr(v, "_IN_ROW", 7)
    monkeypatch.setattr(v, "_IN_BATCH", 5)
    monkeypatch.setattr(v, "_AT_ONCE", 3)
    random.seed(5)
    columns = [
        [random.choice([None, -(2**63), 2**63 - 1, -1, *range(200_000, 200_300)]) for _ in range(1500)],
        [random.choice(TEXTS) for _ in range(1500)],
        [f"{random.choice(['', 'k', '-'])}{random.randrange(1, 10**random.randrange(1, 18))}" for _ in range(1500)],
        [None] * 1500,
    ]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.string()]
    batches = [
        pa.RecordBatch.from_arrays([pa.array(c[i : i + 100], k) for c, k in zip(columns, kinds)], names=list("abcd")) for i in range(0, 1500, 100)
    ]
    seen = pa.Table.from_batches(v._folded(batches))
    sums = {x["column"]: x for x in seen.to_pylist() if x["form"] == v._SUMS}
    texts = {(x["column"], x["value"]) for x in seen.to_pylist() if x["form"] == v._TEXT}
    numbers = [x for x in seen.to_pylist() if x["form"] > v._TEXT]
    runs = pa.RecordBatch.from_arrays(
        [pa.array([x["column"] * 4 + x["form"] for x in numbers], pa.int32()), pa.array([x["bucket"] for x in numbers]), pa.array([x["value"] for x in numbers], pa.binary())],
        names=["kind", "bucket", "value"],
    )
    counted = pa.Table.from_batches(v._counted([runs.slice(0, 20), runs.slice(20)])).to_pylist()
    for i, column in enumerate(columns):
        known = [str(x) for x in column if x is not None]
        assert (sums[i]["rows"], sums[i]["filled"]) == (1500, len(known))
        assert sums[i]["value"] == (min(known).encode() if known else None)
        assert len([1 for c, _ in texts if c == i]) + sum(x["different"] for x in counted if x["kind"] >> 2 == i) == len(set(known))
