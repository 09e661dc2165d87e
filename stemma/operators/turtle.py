"""Statements to Turtle, and Turtle's ordering rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stemma.functions.text import DEFAULT_HOST

# --- fixed values: prefixes and the order of the subject kinds ----------------------
PREFIXES = (("rdf", "http://www.w3.org/1999/02/22-rdf-syntax-ns#"), ("rdfs", "http://www.w3.org/2000/01/rdf-schema#"), ("bibo", "http://purl.org/ontology/bibo/"), ("cito", "http://purl.org/spar/cito/"), ("dc", "http://purl.org/dc/elements/1.1/"), ("dwc", "http://rs.tdwg.org/dwc/terms/"), ("dwcFP", "http://filteredpush.org/ontologies/oa/dwcFP#"), ("fabio", "http://purl.org/spar/fabio/"))
KINDS = ("comment", "treatment", "publication", "concept", "name", "figure", "material")
# -----------------------------------------------------------------------------------


def header(host: str = DEFAULT_HOST) -> str:
    return "\n".join(f"@prefix {p}: <{u}> ." for p, u in (*PREFIXES, ("trt", f"http://{host}/vocab/treatment#")))


def predicate_key(p: Column) -> Column:
    """Comments first, then by name, the type last."""
    return F.concat(F.when(F.startswith(p, F.lit("#")), F.lit("0")).when(p == "a", F.lit("2")).otherwise(F.lit("1")), F.when(F.startswith(p, F.lit("#")), F.substring(p, F.lit(2), F.length(p))).otherwise(p))


def subject_blocks(statements: DataFrame, by: list[str], subject: str = "subject") -> DataFrame:
    """(by, subject, block): each subject's statements as one block of Turtle.

    Objects are a sorted set, predicates in the order of predicate_key, comments on lines of
    their own. A subject of comments alone has no end mark. Repeated statements count once; nulls are left out.
    """
    s = statements.where(F.col("predicate").isNotNull() & F.col("object").isNotNull())
    one = s.groupBy(*by, subject, "predicate").agg(F.array_sort(F.collect_set("object")).alias("o"))
    note = F.startswith("predicate", F.lit("#"))
    line = F.when(note, F.array_join(F.transform("o", lambda o: F.concat(F.lit("    "), F.col("predicate"), F.lit(" "), F.replace(o, F.lit("\n"), F.lit("\n    # ")))), "\n")).otherwise(F.concat(F.lit("    "), F.col("predicate"), F.lit(" "), F.array_join("o", ", ")))
    two = one.groupBy(*by, subject).agg(F.array_sort(F.collect_list(F.struct(predicate_key(F.col("predicate")).alias("k"), note.alias("note"), line.alias("line")))).alias("p"))
    notes = F.array_join(F.transform(F.filter("p", lambda x: x["note"]), lambda x: x["line"]), "\n")
    facts = F.array_join(F.transform(F.filter("p", lambda x: ~x["note"]), lambda x: x["line"]), " ;\n")
    body = F.when(facts == "", F.concat(F.lit("\n# No properties for "), F.col(subject), F.lit("\n"), notes)).otherwise(F.concat(F.lit("\n"), F.col(subject), F.lit("\n"), F.when(notes != "", F.concat(notes, F.lit("\n"))).otherwise(F.lit("")), facts, F.lit(" .")))
    return two.select(*by, subject, body.alias("block"))


def documents_turtle(statements: DataFrame, paths: DataFrame, host: str = DEFAULT_HOST, comments: DataFrame | None = None) -> DataFrame:
    """(doc_path, turtle): one text per path, its comments (doc_path, ord, line) first, then its
    blocks in the order of kinds, then of first mention."""
    order = statements.groupBy("doc_path", "subject").agg(F.min(F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))).alias("k"), F.min("ord").alias("ord"))
    blocks = subject_blocks(statements, ["doc_path"]).join(order, ["doc_path", "subject"]).select("doc_path", "k", "ord", "subject", "block")
    if comments is not None:
        blocks = blocks.unionByName(comments.select("doc_path", F.lit(0).cast("long").alias("k"), F.col("ord").cast("long").alias("ord"), F.col("line").alias("subject"), F.col("line").alias("block")))
    texts = blocks.groupBy("doc_path").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "ord", "subject", "block"))), lambda b: b["block"]), "\n").alias("body"))
    failed = F.lit("# Error: Could not create RDF due to missing <document>")
    return paths.select("doc_path").distinct().join(texts, "doc_path", "left").select("doc_path", F.concat(F.lit(header(host) + "\n"), F.coalesce("body", failed)).alias("turtle"))
