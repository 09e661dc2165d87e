"""Turtle files and status tables in a folder that all executors share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pandas as pd
from pyarrow import fs as afs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stemma.functions.text import target_path
from stemma.operators.status import parse_status, status_lines
from stemma.sources.files import address

STAGING, STATUS = "_staging", "_status"


def _open(folder: str) -> tuple[afs.FileSystem, str]:
    return afs.FileSystem.from_uri(address(folder))


def write_turtle(turtle: DataFrame, folder: str) -> int:
    """Write (doc_path, turtle) to one file each, the path's last four signs replaced by '.ttl'; the
    number of files.

    Each text is written whole to a name of its own in a staging folder and then moved to its
    place, so readers never see half a file, and a task that runs again does no harm.
    """
    job = uuid.uuid4().hex

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, root = _open(folder)
        for b in batches:
            for path, text in zip(b["_path"], b["_text"]):
                own = f"{root}/{STAGING}/{job}/{uuid.uuid4().hex}"
                system.create_dir(own.rsplit("/", 1)[0], recursive=True)
                with system.open_output_stream(own) as out:
                    out.write((text or "").encode("utf-8", "replace"))
                system.create_dir(f"{root}/{path}".rsplit("/", 1)[0], recursive=True)
                system.move(own, f"{root}/{path}")
            yield pd.DataFrame({"n": [len(b)]})

    at = F.regexp_replace(target_path("doc_path"), "^/", "")
    n = turtle.where("length(doc_path) > 4").select(at.alias("_path"), F.col("turtle").alias("_text")).mapInPandas(work, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    system, root = _open(folder)
    if system.get_file_info(f"{root}/{STAGING}/{job}").type == afs.FileType.Directory:
        system.delete_dir(f"{root}/{STAGING}/{job}")
    return n


def remove_outputs(paths: DataFrame, folder: str) -> int:
    """Remove the files that were made of (doc_path); the number that were there. A document
    removed before it was ever written is no error."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, root = _open(folder)
        for b in batches:
            there = [f"{root}/{p}" for p in b["_path"] if system.get_file_info(f"{root}/{p}").type == afs.FileType.File]
            for p in there:
                system.delete_file(p)
            yield pd.DataFrame({"n": [len(there)]})

    at = F.regexp_replace(target_path("doc_path"), "^/", "")
    return paths.where("length(doc_path) > 4").select(at.alias("_path")).distinct().mapInPandas(work, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def _versions(folder: str) -> list[int]:
    """The versions of the status table that were written whole."""
    system, root = _open(folder)
    if system.get_file_info(f"{root}/{STATUS}").type != afs.FileType.Directory:
        return []
    found = system.get_file_info(afs.FileSelector(f"{root}/{STATUS}"))
    return sorted(int(x.base_name[1:]) for x in found if x.base_name[1:].isdigit() and system.get_file_info(f"{x.path}/_SUCCESS").type == afs.FileType.File)


def write_status(status: DataFrame, folder: str) -> None:
    """Write (doc_path, status) as lines of text in order, the counts last, as a new version; the
    two versions before are kept."""
    known = _versions(folder)
    lines = status_lines(status).orderBy("part", "line").select("line")
    lines.write.mode("overwrite").text(f"{address(folder)}/{STATUS}/v{known[-1] + 1 if known else 0}")
    system, root = _open(folder)
    for v in known[:-2]:
        system.delete_dir(f"{root}/{STATUS}/v{v}")


def read_status(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_path, status) of the newest version; empty if there is none."""
    known = _versions(folder)
    if not known:
        return spark.createDataFrame([], "doc_path string, status int")
    return parse_status(spark.read.text(f"{address(folder)}/{STATUS}/v{known[-1]}").withColumnRenamed("value", "line"))
