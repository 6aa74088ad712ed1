"""Exact duplicates by a two-pass Bloom filter, in SQL functions throughout."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkpanel.llm import bloom
from sparkpanel.llm.staging import staged


def exact_dedup(df: DataFrame, id_col: str, text_col: str, keep: str = "max") -> DataFrame:
    """Mark rows whose text is identical. All rows and columns stay; these columns are added.

    ``keep_id`` (largest or smallest id of the group, by ``keep``), ``group_size``,
    ``kept`` (the row's id is ``keep_id``), ``text_sha256`` (lowercase hex).

    Pass one counts the hits of each bit of a Bloom filter. Pass two tests every row:
    a row whose bits were not both hit twice has a text of its own and goes straight
    to the result. Only the rest is shuffled, as (hash, id) to be counted and once
    more to receive its group. Groups are summed in each task first; the join against
    the written groups is one that adaptive execution can split.

    Null text counts as empty. A null id is below all others and keeps its row only in
    a group of null ids. Rows that share an id and a text are the same document and get
    the same marks. Input columns named like an added one are replaced; names that start
    with an underscore and a lower-case letter are reserved. An empty table gives an empty one.
    """
    pick = F.max if keep == "max" else F.min
    source = df.drop("keep_id", "group_size", "kept", "text_sha256").withColumn(
        "text_sha256", F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256)
    ).withColumn("_h", F.xxhash64("text_sha256"))
    blocks = bloom.block_count(df.count())
    repeated = staged(bloom.repeated_filter(source.select("_h"), "_h", blocks), "repeated")
    tested = bloom.might_hold(source, "_h", repeated, blocks, "_maybe").drop("_h")

    alone = tested.filter(~F.col("_maybe")).drop("_maybe").withColumns(
        {"keep_id": F.col(id_col), "group_size": F.lit(1).cast("long"), "kept": F.lit(True)}
    )
    maybe = tested.filter("_maybe").drop("_maybe")
    groups = staged(
        maybe.groupBy("text_sha256").agg(pick(id_col).alias("_keep"), F.count(F.lit(1)).alias("_size")).filter("_size > 1"), "groups"
    )
    found = maybe.join(groups, "text_sha256", "left").withColumns({
        "keep_id": F.when(F.col("_size").isNull(), F.col(id_col)).otherwise(F.col("_keep")),
        "group_size": F.coalesce("_size", F.lit(1).cast("long")),
    }).withColumn("kept", F.col(id_col).eqNullSafe(F.col("keep_id"))).drop("_keep", "_size")
    return alone.unionByName(found)
