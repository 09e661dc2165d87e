"""Queries of the training-data operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from stemma.llm.canonical import canonicalise
from stemma.llm.leaks import leaked
from stemma.llm.names import link_names
from stemma.llm.quality import quality_stats
from stemma.llm.tokens import encode_texts
from stemma.operators.pairs import pairs_within
from stemma.sources.tables import broadcast_checked, cut, table


def _references(spark: SparkSession, d: str) -> DataFrame:
    countries = table(spark, d, "country_ref").select(F.lit("collectingcountry").alias("field_name"), F.col("country_id").alias("ref_id"), F.col("country_name").alias("name"), F.col("also_called").alias("others"), F.array("code_two", "code_three").alias("codes"))
    ranks = table(spark, d, "rank_ref").select(F.lit("taxon_rank").alias("field_name"), F.col("rank_id").alias("ref_id"), F.col("rank_name").alias("name"), F.col("also_written").alias("others"), F.array().cast("array<string>").alias("codes"))
    return countries.unionByName(ranks)


def p1_entities(spark: SparkSession, d: str) -> DataFrame:
    """The entity of every spelling of a collector."""
    return link_names(table(spark, d, "collector_names")).select(F.col("id").alias("name_id"), F.col("entity").alias("entity_id"))


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """Every pair of spellings of one collector."""
    found = pairs_within(cut(p1_entities(spark, d)), "entity_id", "name_id")
    return found.select(F.col("left").alias("name_id_a"), F.col("right").alias("name_id_b"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """The entry that each freely typed country and rank means, or -1."""
    countries = table(spark, d, "materials").select(F.lit("collectingcountry").alias("field_name"), F.col("row_id").alias("row_key"), F.col("collectingcountry").alias("value"))
    ranks = table(spark, d, "taxon_names").select(F.lit("taxon_rank").alias("field_name"), F.col("name_row_id").alias("row_key"), F.col("taxon_rank").alias("value"))
    refs = _references(spark, d)
    found = canonicalise(countries.unionByName(ranks), refs)
    exact = refs.select("field_name", F.col("name").alias("value"))
    return found.join(broadcast_checked(exact), ["field_name", "value"], "left_anti").select("field_name", "row_key", "ref_id")


def p6_ids(spark: SparkSession, d: str) -> DataFrame:
    """The token ids of every document."""
    return encode_texts(table(spark, d, "documents"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    """The documents that hold evaluation passages, with the items they reveal."""
    return leaked(table(spark, d, "documents"), table(spark, d, "eval_items")).select("doc_id", "item_id")


def p8_stats(spark: SparkSession, d: str) -> DataFrame:
    """The text quality statistics of every document."""
    return quality_stats(table(spark, d, "documents"))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    """The documents that are mostly no running speech, with their kind."""
    return p8_stats(spark, d).where("doc_kind <> 'prose'").select("doc_id", "doc_kind")


QUERIES = {"p1_found": p1_found, "p1_entities": p1_entities, "p4_found": p4_found, "p6_ids": p6_ids, "p7_found": p7_found, "p8_found": p8_found, "p8_stats": p8_stats}
SQL: dict[str, str] = {}
