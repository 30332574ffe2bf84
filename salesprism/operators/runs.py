"""Outputs of a run that are read together or not at all.

Every run writes its tables into a folder of its own. A manifest, one small table with the name, path and schema of
each, is written last; a reader takes the newest manifest, so it never sees a half-written run or tables of
two runs.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from salesprism.sources.sinks import write_counted

_MANIFESTS = "manifests"
_SCHEMA = "run string, at double, name string, path string, schema string, rows long"


class Run:
    """A run's tables under ``folder``, which all executors share."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.name = uuid.uuid4().hex
        self._written: list[tuple] = []

    def write(self, name: str, df: DataFrame) -> None:
        path = f"{self.folder}/{self.name}/{name}"
        rows = write_counted(df, path)
        self._written.append((name, path, df.schema.json(), rows))

    def commit(self) -> None:
        """Makes the run's tables known, all at once."""
        at = time.time()
        rows = [(self.name, at, *own) for own in self._written]
        one = self.spark.createDataFrame(rows, _SCHEMA).coalesce(1)
        one.write.parquet(f"{self.folder}/{_MANIFESTS}/{self.name}")


def committed(spark: SparkSession, folder: str) -> DataFrame:
    """The manifest rows of all committed runs."""
    root = f"{folder.rstrip('/')}/{_MANIFESTS}"
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    system = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    # a manifest counts once its job has ended, which its marker says
    done = [
        f"{root}/{s.getPath().getName()}"
        for s in (system.listStatus(place) if system.exists(place) else [])
        if system.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS"))
    ]
    return spark.read.schema(_SCHEMA).parquet(*done) if done else spark.createDataFrame([], _SCHEMA)


def latest(spark: SparkSession, folder: str, names: Iterable[str]) -> dict[str, DataFrame]:
    """The named tables of the newest committed run that has them all."""
    names = list(names)
    runs = committed(spark, folder).groupBy("run", "at").agg(F.collect_list(F.struct("name", "path", "schema")).alias("own"))
    whole = runs.filter(F.size(F.array_intersect(F.array(*[F.lit(n) for n in names]), F.transform("own", lambda o: o["name"]))) == len(set(names)))
    newest = whole.orderBy(F.desc("at"), "run").first()
    if newest is None:
        raise LookupError(f"no committed run under {folder} has {', '.join(names)}")
    by_name = {o["name"]: o for o in newest["own"]}
    return {n: spark.read.schema(StructType.fromJson(json.loads(by_name[n]["schema"]))).parquet(by_name[n]["path"]) for n in names}
