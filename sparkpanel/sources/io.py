"""Readers and writers for tables, folders of tables and grouped output."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkpanel.operators.reshape import union_by_name

BOM = "﻿"


def read_table(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None, fmt: str = "parquet",
    line_sep: str | None = None, null_value: str = "NA",
) -> DataFrame:
    """Parquet or headed CSV. A byte-order mark on the first header is dropped.

    Without a schema CSV columns are strings, so that ids keep leading zeros.
    """
    if fmt == "parquet":
        reader = spark.read.schema(schema) if schema is not None else spark.read
        return reader.parquet(path)
    reader = spark.read.option("header", True).option("nullValue", null_value)
    if line_sep:
        reader = reader.option("lineSep", line_sep)
    if schema is not None:
        return reader.schema(schema).csv(path)
    df = reader.csv(path)
    first = df.columns[0]
    return df.withColumnRenamed(first, first.lstrip(BOM)) if first.startswith(BOM) else df


def read_dir(spark: SparkSession, glob: str, name_regex: str, names: list[str], schema: T.StructType | str, **kw) -> DataFrame:
    """Same-shaped CSV files as one frame, groups of the file name as columns."""
    df = read_table(spark, glob, schema, fmt="csv", **kw)
    if re.compile(name_regex).groups != len(names):
        raise ValueError("one column name per group of the file name pattern")
    named = df.select("*", F.col("_metadata.file_name").alias("_file"))
    return named.withColumns({n: F.regexp_extract("_file", name_regex, i + 1) for i, n in enumerate(names)}).drop("_file")


def read_sheet(spark: SparkSession, path: str, header_prefix: str, names: list[str]) -> DataFrame:
    """CSV exports of sheets with title rows above the header.

    The header is a file's first row whose first cell is ``header_prefix``; all rows after
    it are data, whatever cells they leave empty. A row without any value is skipped.
    """
    schema = ", ".join(f"`{n}` string" for n in names)
    raw = spark.read.schema(schema).csv(path).select(
        "*", F.col("_metadata.file_path").alias("_file"),
        F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row")).alias("_at"),
    )
    # Rows of a block are read in order by one task.
    header = raw.filter(F.col(names[0]) == header_prefix).groupBy("_file").agg(F.min("_at").alias("_header"))
    some = F.coalesce(*names).isNotNull()
    return raw.join(header, "_file").filter((F.col("_at") > F.col("_header")) & some).select(*names)


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def write_groups(df: DataFrame, path: str, by: list[str], fmt: str = "csv", mode: str = "overwrite", rows_per_file: int = 5_000_000) -> None:
    """One folder per group in one job.

    Tasks write straight into the folders, without a shuffle that would gather a
    large group in one task.
    """
    writer = df.write.mode(mode).partitionBy(*by).option("maxRecordsPerFile", rows_per_file)
    writer.option("header", True).csv(path) if fmt == "csv" else writer.parquet(path)


def append_years(frames: list[DataFrame]) -> DataFrame:
    """Stack yearly inputs whose columns differ."""
    return union_by_name(*frames)


def merge_monthly(frames: list[DataFrame], keys: list[str], value: str) -> DataFrame:
    """Monthly price files as one long table: all rows stacked, empty cells out, one per key.

    When several files give a key, the smallest known value is kept, so the result
    does not depend on the order of files.
    """
    stacked = union_by_name(*frames).filter(F.col(value).isNotNull())
    return stacked.groupBy(*keys).agg(F.min(value).alias(value))
