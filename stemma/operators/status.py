"""Status of documents, its text form, and change sets."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stemma.functions.text import rooted

# --- fixed values: status codes in order of severity --------------------------------
STATUSES = ("successful", "has warnings", "has errors", "failed")
# -----------------------------------------------------------------------------------


def latest(rows: DataFrame, key: list[str], order: list) -> DataFrame:
    """The last row of each key; ``order`` must be total for one answer. Only a struct per
    key is kept while aggregating, so a key of a third of all rows is no hot window."""
    other = [c for c in rows.columns if c not in key]
    best = rows.groupBy(*key).agg(F.max_by(F.struct(*other), F.struct(*order)).alias("_b"))
    return best.select(*key, "_b.*")


def status_lines(status: DataFrame, path: str = "doc_path", code: str = "status") -> DataFrame:
    """(line): the status table as text, one line a path, sorted; then the counts."""
    lines = status.select(F.lit(1).alias("part"), F.concat(rooted(path), F.lit(": "), F.col(code).cast("string")).alias("line"))
    counts = status.groupBy(code).count().select(F.lit(2).alias("part"), F.concat(F.lit(":"), F.element_at(F.array(*map(F.lit, STATUSES)), F.col(code) + 1), F.lit(": "), F.col("count").cast("string")).alias("line"))
    return lines.unionByName(counts)


def parse_status(lines: DataFrame) -> DataFrame:
    """(doc_path, status) of status lines; lines that begin with ':' or hold no code are left
    out; of a path that comes twice the greater line number wins if there is one, else the greater code."""
    parts = F.split("line", ": ")
    rows = lines.where(~F.startswith("line", F.lit(":"))).select(F.regexp_replace(parts[0], "^/", "").alias("doc_path"), F.get(parts, F.lit(1)).try_cast("int").alias("status"))
    return rows.where("doc_path <> '' and status is not null").groupBy("doc_path").agg(F.max("status").alias("status"))


def upsert(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """The rows of new, and those of old whose key new lacks. Null keys are left out."""
    o = old.where(F.col(key).isNotNull()).withColumn("_v", F.lit(0))
    n = new.where(F.col(key).isNotNull()).withColumn("_v", F.lit(1))
    return latest(o.unionByName(n), [key], ["_v", *(c for c in old.columns if c != key)]).drop("_v")


def apply_changes(feed: DataFrame, path: str = "doc_path", op: str = "change_op", seq: str = "seq") -> DataFrame:
    """(path, op, seq): the last change of each path, removed paths included. Repeated and late
    rows do no harm: order is by seq, ties by the operation's name."""
    rows = feed.select(path, op, seq).where(F.col(path).isNotNull())
    return latest(rows, [path], [seq, op])


def first_occurrence(rows: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """Adds is_first: is a row the first of its key in order?"""
    return rows.withColumn("is_first", F.row_number().over(Window.partitionBy(*key).orderBy(*order)) == 1)
