"""Tables that later passes read, written to the folder all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from salesprism.session import table_folder


def stored(df: DataFrame, compression: str = "zstd") -> DataFrame:
    """Write the rows as a Parquet table in the shared folder and read it back, so that a
    lost executor loses no rows and each pass reads the columns it needs."""
    spark = df.sparkSession
    path = f"{table_folder(spark)}/corpus-{uuid.uuid4().hex}"
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
