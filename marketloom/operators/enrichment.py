"""Filling blank attributes from the library, and the reference filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.functions import text
from marketloom.operators.cleaning import first_by


def is_blank(name: str) -> Column:
    c = F.col(name)
    return c.isNull() | ((c == 0) if name == "year_introduced" else (c == ""))


def fill_from(df: DataFrame, library: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Blank ``columns`` taken from the library row of the brand and ``key``; null where there is none."""
    looked = library.select(F.col("brand").alias("__b"), F.col(key).alias("__k"), *[F.col(c).alias(f"__{c}") for c in columns])
    joined = df.join(looked, (F.col("brand") == F.col("__b")) & (F.col(key) == F.col("__k")), "left")
    filled = {c: F.when(is_blank(c), F.col(f"__{c}")).otherwise(F.col(c)) for c in columns}
    return joined.withColumns(filled).select(*df.columns)


def fill_from_library(df: DataFrame, library: DataFrame) -> DataFrame:
    """Two passes: by reference number, then by group reference, which the first may have filled."""
    by_reference = first_by(library.where("reference_number IS NOT NULL"), ["brand", "reference_number"], [F.col(c).asc_nulls_last() for c in library.columns])
    df = fill_from(df, by_reference, "reference_number", ["group_reference", "parent_model", "specific_model", "year_introduced"])
    columns = ["parent_model", "specific_model", "year_introduced"]
    firsts = [F.min_by(c, F.when(F.col(c).isNotNull(), F.col("reference_number"))).alias(c) for c in columns]
    by_group = by_reference.where("group_reference IS NOT NULL").groupBy("brand", "group_reference").agg(*firsts)
    return fill_from(df, by_group, "group_reference", columns)


def plausible_references(df: DataFrame) -> DataFrame:
    """References that are there, hold a digit and have at most 25 characters besides spaces."""
    ref = F.col("reference_number")
    return df.where(~text.is_nullish(ref) & ref.rlike(r"\d") & (F.length(F.replace(ref, F.lit(" "), F.lit(""))) <= 25))
