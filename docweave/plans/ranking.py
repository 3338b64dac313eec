"""Top-k per group that holds up when one group is most of the data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from docweave.plans.sizing import GROUP_LIMIT_THRESHOLD


def top_k(df: DataFrame, group: str, order: list[Column], k: int, rank: str = "rank") -> DataFrame:
    """First `k` rows of each group with their 1-based rank.

    `row_number() <= k` lets Spark keep only k rows per group and input partition
    before the shuffle. For k past Spark's threshold for that, a first pass does the
    same cut over the group's share of each input partition, so no task sorts a whole
    group.
    """
    if k > GROUP_LIMIT_THRESHOLD:
        shares = Window.partitionBy(group, "_share").orderBy(*order)
        df = (df.withColumn("_share", F.spark_partition_id())
              .withColumn("_n", F.row_number().over(shares))
              .where(F.col("_n") <= k).drop("_share", "_n"))
    ranked = F.row_number().over(Window.partitionBy(group).orderBy(*order))
    return df.withColumn(rank, ranked.cast("bigint")).where(F.col(rank) <= k)
