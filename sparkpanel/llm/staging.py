"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from sparkpanel.session import shared_folder


def new_path(spark, name: str) -> str:
    """Unused path below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def small_batches(spark) -> None:
    """Hand tasks' Python some megabytes of rows at a time; the default of 64 MB is held several times over."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "8m")


def staged(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` as Parquet and read it again: lineage is cut, and lost executors cost no recomputation."""
    path = new_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
