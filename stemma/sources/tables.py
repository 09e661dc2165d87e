"""Reading tables, small-side checks and lineage cuts."""

from __future__ import annotations

import os
import re
import tempfile
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows and bytes up to which a side may be broadcast after it has been measured.
BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 64 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One parquet table of a data directory."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _bytes(df: DataFrame) -> Column:
    """The bytes that a row holds: 8 for each column of fixed width, else those of its text."""
    fixed, plain = ("tinyint", "smallint", "int", "bigint", "float", "double", "boolean", "date", "timestamp", "timestamp_ntz"), ("string", "binary")
    size = lambda c, kind: F.lit(8) if kind in fixed else F.coalesce(F.octet_length(F.col(f"`{c}`") if kind in plain else F.to_json(F.struct(F.col(f"`{c}`")))), F.lit(0))
    return reduce(lambda a, b: a + b, [size(c, kind) for c, kind in df.dtypes], F.lit(8))


def broadcast_checked(df: DataFrame, limit: int = BROADCAST_ROWS, most_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """df with a broadcast hint if it has at most ``limit`` rows and ``most_bytes`` bytes; beyond
    that it is returned as it is and the join shuffles. At most ``limit + 1`` rows are measured;
    give what is dear to compute after ``cut``, so that it is not computed for the answer alone."""
    n, size = df.select(_bytes(df).cast("long").alias("b")).limit(limit + 1).agg(F.count(F.lit(1)), F.coalesce(F.sum("b"), F.lit(0))).first()
    return F.broadcast(df) if n <= limit and size <= most_bytes else df


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder, spark.checkpoint.dir of the session. Only a session on one
    machine (master local) may leave it unset and gets a local one; on a cluster that is an error."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where and not re.fullmatch(r"local(\[[^\]]*\])?", spark.conf.get("spark.master", "")):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return (where or os.path.join(tempfile.gettempdir(), "stemma-checkpoints")).rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """df written to the cluster's shared checkpoint folder and read back (``shared_dir``)."""
    sc = df.sparkSession.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)
