"""Change feeds as streams, with an upserted state table."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from stemma.operators.status import apply_changes
from stemma.sources.tables import shared_dir


def shared_folder(spark: SparkSession) -> str:
    """A new folder below the cluster's shared folder."""
    return f"{shared_dir(spark)}/{uuid.uuid4().hex}"


def upsert_batch(state: str):
    """A foreachBatch writer: the last change of each path over the state of the batch before.

    Each batch writes a new version of the state beside the last one and never over what it
    reads. A batch that is run again writes the same version again, so replays do no harm.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        rows = batch.select("doc_path", "change_op", "seq")
        if number > 0:
            rows = rows.unionByName(spark.read.parquet(f"{state}/v{number - 1}"))
        apply_changes(rows).write.mode("overwrite").parquet(f"{state}/v{number}")

    return write


def stream_changes(spark: SparkSession, path: str, folder: str | None = None) -> DataFrame:
    """(doc_path, change_op, seq): the state after all that lies in the feed now.

    The feed is a stream of files, read to its present end (availableNow); offsets and state
    are in ``folder`` (a new one in the shared folder if none is given), so that a later call with the
    same folder takes only what is new. Files rewritten in place are not read again:
    changes come as new rows of the feed.
    """
    folder = folder or shared_folder(spark)
    reader = spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", 4)
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(at).isDirectory():
        feed = reader.parquet(path)
    else:  # a stream is of a folder: that of the file, and of this file in it
        feed = reader.option("pathGlobFilter", at.getName()).parquet(at.getParent().toString())
    q = feed.writeStream.foreachBatch(upsert_batch(f"{folder}/state")).option("checkpointLocation", f"{folder}/offsets").trigger(availableNow=True).start()
    q.awaitTermination()
    last = q.lastProgress or (q.recentProgress[-1] if q.recentProgress else None)
    number = _last_version(spark, f"{folder}/state", int(last["batchId"]) if last else 0)
    return spark.read.parquet(f"{folder}/state/v{number}")


def _last_version(spark: SparkSession, state: str, guess: int) -> int:
    """The newest version that was written whole."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(state)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = [int(s.getPath().getName()[1:]) for s in fs.listStatus(at) if fs.exists(jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS"))]
    return max(found, default=guess)
