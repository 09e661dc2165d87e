"""Change sets from documents to published files."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stemma.functions.text import DEFAULT_HOST
from stemma.operators import tree
from stemma.operators.graph import TEXT_TAGS, comments, diagnostic_rows, events, statements
from stemma.operators.status import apply_changes, upsert
from stemma.operators.turtle import documents_turtle
from stemma.sinks.files import read_status, remove_outputs, write_status, write_turtle
from stemma.sources.files import read_documents
from stemma.sources.tables import cut


@dataclass
class Job:
    """What is to be done: lists of files, or a range of a change feed. ``files`` has 'modified'
    and maybe 'added' and 'removed'; a list without 'added' removes nothing."""

    name: str
    files: dict | None = None
    start: int | None = None
    till: int | None = None
    log: list = field(default_factory=list)


def changed_paths(spark: SparkSession, job: Job, feed: DataFrame | None = None) -> DataFrame:
    """(doc_path, removed): the paths of a job. Of a range, the last change of each path counts, and
    the job's ends become those of the changes found."""
    if job.files is not None:
        rows = [(p, False) for p in job.files.get("modified", ())]
        if "added" in job.files:
            rows += [(p, False) for p in job.files["added"]] + [(p, True) for p in job.files.get("removed", ())]
        return spark.createDataFrame(rows, "doc_path string, removed boolean").distinct()
    if job.start is None or feed is None:
        raise ValueError("a job needs a list of files, or a start and a change feed")
    within = feed.where(F.col("seq") >= job.start)
    within = within if job.till is None else within.where(F.col("seq") <= job.till)
    first, last = within.agg(F.min("seq"), F.max("seq")).first()
    job.start, job.till = (job.start, job.till) if first is None else (first, last)
    return apply_changes(within).select("doc_path", (F.col("change_op") == "removed").alias("removed"))


def message(job: Job, source: str) -> str:
    """The line under which a job's output is published."""
    return f"stemma {source}@{job.till}" if job.till is not None else f"stemma {job.name} ({source})"


def transform(spark: SparkSession, documents: DataFrame, host: str = DEFAULT_HOST) -> tuple[DataFrame, DataFrame]:
    """((doc_path, turtle), (doc_path, status)) of (doc_path, content)."""
    nodes = cut(tree.nodes(documents, form="any", texts=TEXT_TAGS))
    taxa = cut(events(nodes, host))
    text = documents_turtle(cut(statements(nodes, host, taxa=taxa)), documents, host, comments(nodes, documents, taxa))
    worst = diagnostic_rows(nodes, documents, taxa, host).groupBy("doc_path").agg(F.max("level").alias("level"))
    status = documents.select("doc_path").distinct().join(worst, "doc_path", "left").select("doc_path", F.coalesce("level", F.lit(0)).alias("status"))
    return text, status


def run(spark: SparkSession, job: Job, source: str, target: str, feed: DataFrame | None = None, host: str = DEFAULT_HOST) -> dict:
    """Transform the changed documents of ``source`` and publish them in ``target``; counts and the message.

    Paths that are no XML files of the source are passed over. Outputs are written before those
    of removed documents go; the status table takes the new rows and keeps those of removed
    documents. Every step can run again.
    """
    paths = cut(changed_paths(spark, job, feed))
    xml = paths.where(F.endswith("doc_path", F.lit(".xml")))
    documents = cut(read_documents(spark, source, xml.where("not removed")))
    text, status = transform(spark, documents, host)
    status = cut(status)
    written = write_turtle(text, target)
    removed = remove_outputs(xml.where("removed"), target)
    write_status(upsert(read_status(spark, target), status, "doc_path"), target)
    return {"files": paths.count(), "written": written, "removed": removed, "message": message(job, source)}
