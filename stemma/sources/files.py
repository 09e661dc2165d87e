"""Documents as files of a folder that all executors share."""

from __future__ import annotations

import os
from collections.abc import Iterator
from fnmatch import fnmatch

import pandas as pd
from pyarrow import fs as afs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def address(path: str) -> str:
    """A folder or file as an address with a scheme; what has none is a local path."""
    return path if "://" in path else "file://" + os.path.abspath(path)


def read_documents(spark: SparkSession, source: str, paths: DataFrame | None = None, pattern: str = "*.xml") -> DataFrame:
    """(doc_path, content): the files below a folder (or one file) whose name has the pattern, by
    their path within the folder.

    paths: (doc_path); if given, only these are read, and those that are no files are left
    out, and empty files have empty content; without, empty files are left out. A damaged character is replaced; nothing is gathered.
    """
    root = address(source).rstrip("/")
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(root)
    base = F.lit(root.split("://", 1)[1])
    local = F.regexp_replace(F.col("path"), "^[a-z0-9]+:/*", "/")
    inside = F.substring(local, F.length(base) + 2, F.length(local))
    rows = files.select(F.when(inside == "", F.element_at(F.split(local, "/"), -1)).otherwise(inside).alias("doc_path"), F.make_valid_utf8(F.col("content").cast("string")).alias("content"))
    if paths is None:
        return rows

    def empty(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, at = afs.FileSystem.from_uri(root)
        for b in batches:
            there = [p for p in b["doc_path"] if fnmatch(p.rsplit("/", 1)[-1], pattern) and (x := system.get_file_info(f"{at}/{p}")).type == afs.FileType.File and not x.size]
            yield pd.DataFrame({"doc_path": there, "content": [""] * len(there)})

    wanted = paths.where("doc_path is not null").select(F.regexp_replace("doc_path", "^/", "").alias("doc_path")).distinct()
    read = rows.join(wanted, "doc_path", "left_semi")
    # the reader passes over files without content
    return read.unionByName(wanted.join(rows.select("doc_path"), "doc_path", "left_anti").mapInPandas(empty, "doc_path string, content string"))
