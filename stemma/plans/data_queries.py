"""Queries of the core data-processing operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stemma.operators.flatten import flatten_records
from stemma.operators.spatial import near_pairs, pivot_points, points_in_regions
from stemma.operators.units import measures, rounded_measures
from stemma.sources.tables import cut, table

NEAR_M = 500.0


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """Every readable latitude, longitude and elevation in common units."""
    return rounded_measures(measures(table(spark, d, "materials"), table(spark, d, "providers"), "row_id"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """Each specimen code with its document and the name it was cited under."""
    m = flatten_records(table(spark, d, "raw_records"), "materials").where("docid <> '' and specimencode <> ''")
    return m.select(F.col("key").alias("raw_id"), "docid", "taxon_pos", "taxon_rank", "mc_pos", "specimencode")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """Materials rows near each other, and the areas that contain them."""
    values = measures(table(spark, d, "materials"), table(spark, d, "providers"), "row_id", ("latitude", "longitude"))
    points = cut(pivot_points(values, "row_id"))
    near = near_pairs(points, NEAR_M).select(F.lit("near").alias("relation"), "left_id", "right_id")
    inside = points_in_regions(points, table(spark, d, "country_areas")).select(F.lit("inside").alias("relation"), F.col("point_id").alias("left_id"), F.col("area_id").alias("right_id"))
    return near.unionByName(inside)


QUERIES = {"p2_found": p2_found, "p3_found": p3_found, "p5_found": p5_found}
SQL: dict[str, str] = {}
