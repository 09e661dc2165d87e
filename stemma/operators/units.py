"""Measures of many sources in common units (degrees and metres)."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stemma.functions.units import read_measure
from stemma.sources.tables import broadcast_checked


@F.pandas_udf(T.DoubleType())
def _measure(field: pd.Series, text: pd.Series, unit: pd.Series, mark: pd.Series) -> pd.Series:
    return pd.Series([read_measure(t, f, u, m) for f, t, u, m in zip(field, text, unit, mark)], dtype="float64")


def plain_measure(field: str, text: Column, unit: Column) -> tuple[Column, Column]:
    """(is the text a plain signed decimal, its value): half of all measures are bare
    numbers without thousands groups, which need no segmentation and stay in the JVM."""
    raw = F.trim(text)
    is_plain = raw.rlike(r"^-?[0-9]{1,12}$" if field == "elevation" else r"^-?[0-9]{1,12}([.,][0-9]{1,12})?$")
    factor = F.when(unit == "microdegree", 1e-6).when(unit == "gon", 0.9).when(unit == "foot", 0.3048).otherwise(1.0)
    value = F.regexp_replace(raw, ",", ".").try_cast("double") * factor
    low, high = {"latitude": (-90.0, 90.0), "longitude": (-180.0, 180.0), "elevation": (-500.0, 9000.0)}[field]
    return is_plain, F.when(value.between(low, high), value)


def measures(df: DataFrame, providers: DataFrame, key: str, fields: tuple[str, ...] = ("latitude", "longitude", "elevation")) -> DataFrame:
    """(key, quantity, value): one row for each readable value of ``fields``.

    value is in degrees (north and east positive) or metres, not rounded. Null, empty,
    blank or unreadable texts give no row; an unknown or missing provider means degrees or
    metres with a decimal point. Repeated rows of df each give their own row; repeated
    providers count once. Columns of df other than key, provider_code and fields are not
    read. No shuffle: providers is broadcast if its counted size allows it.
    """
    p = providers.select(F.col("provider_code").alias("_p"), F.col("coord_unit").alias("_c"), F.col("elevation_unit").alias("_e"), F.col("decimal_mark").alias("_m")).where(F.col("_p").isNotNull()).dropDuplicates(["_p"])
    rows = df.select(F.col(key).alias("_k"), F.col("provider_code").alias("_code"), *(F.col(f).alias(f"_{f}") for f in fields))
    rows = rows.join(broadcast_checked(p), rows["_code"] == p["_p"], "left")
    items = F.array(*(F.struct(F.lit(f).alias("quantity"), F.col(f"_{f}").alias("text"), (F.col("_e") if f == "elevation" else F.col("_c")).alias("unit")) for f in fields))
    long = rows.select("_k", "_m", F.explode(F.filter(items, lambda x: x["text"].rlike("[0-9]"))).alias("i")).select("_k", "_m", "i.*")
    is_plain = value = None
    for f in fields:
        a, b = plain_measure(f, F.col("text"), F.col("unit"))
        is_plain = F.when(F.col("quantity") == f, a) if is_plain is None else is_plain.when(F.col("quantity") == f, a)
        value = F.when(F.col("quantity") == f, b) if value is None else value.when(F.col("quantity") == f, b)
    long = long.withColumn("plain", is_plain).withColumn("value0", value)
    # a null text costs the Python side next to nothing
    read = _measure("quantity", F.when(~F.col("plain"), F.col("text")), "unit", "_m")
    out = long.select(F.col("_k").alias(key), "quantity", F.when(F.col("plain"), F.col("value0")).otherwise(read).alias("value"))
    return out.where(F.col("value").isNotNull() & ~F.isnan("value"))


def rounded_measures(values: DataFrame) -> DataFrame:
    """value as unit_value: the nearest whole ten-thousandth of a degree, or metre."""
    scale = F.when(F.col("quantity") == "elevation", 1.0).otherwise(10000.0)
    return values.withColumn("unit_value", F.floor(F.col("value") * scale + 0.5).cast("long")).drop("value")
