"""Pairs within groups, with hot groups salted."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stemma.sources.tables import broadcast_checked


def pairs_within(rows: DataFrame, group: str, key: str, hot_rows: int = 2_000) -> DataFrame:
    """(left, right): every two rows of a group, left < right.

    Where a result is defined as all pairs of a group, it is as large as that; what is kept
    small is the work of a task: the left side of a group of more than ``hot_rows`` rows is
    spread over salts and its right side copied to each. Null groups give no pairs.
    """
    rows = rows.where(F.col(group).isNotNull()).select(F.col(group).alias("_g"), F.col(key).alias("_k"))
    hot = broadcast_checked(rows.groupBy("_g").count().where(F.col("count") > hot_rows).select("_g", F.ceil(F.col("count") / hot_rows).cast("int").alias("_n")))
    with_salts = rows.join(hot, "_g", "left").withColumn("_n", F.coalesce("_n", F.lit(1)))
    left = with_salts.select("_g", F.pmod(F.xxhash64("_k"), F.col("_n")).cast("int").alias("_s"), F.col("_k").alias("left"))
    right = with_salts.select("_g", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)).alias("_s"), F.col("_k").alias("right"))
    return left.join(right, ["_g", "_s"]).where("left < right").select("left", "right")
