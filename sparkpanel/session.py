"""Session construction and lineage cutting."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_folder: str | None = None


def get_session(app: str = "sparkpanel", master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """Session with UTC times and adaptive execution.

    ``master`` and ``shuffle_partitions`` are for local runs only; a cluster
    supplies its own through spark-submit.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder that the driver and all executors share, from ``spark.checkpoint.dir``.

    Where the setting is absent a temporary folder serves, but only if the session runs
    inside one machine's process; on a cluster that would be a folder per executor.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if configured:
        return configured
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    global _local_folder
    if _local_folder is None:
        _local_folder = tempfile.mkdtemp(prefix="sparkpanel-")
    return _local_folder


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and continue from there.

    What follows reads only the columns it needs, and joins know the size.
    """
    path = f"{shared_folder(df.sparkSession).rstrip('/')}/stage-{uuid.uuid4().hex}"
    df.write.option("compression", "lz4").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
