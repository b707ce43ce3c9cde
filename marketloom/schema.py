"""Schemas and the configuration of the grain levels."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

_TEXT = [
    "between_lugs", "bezel_color", "bezel_material", "bracelet_color", "bracelet_material", "brand_slug", "caliber",
    "case_finish", "case_material", "case_shape", "case_thickness", "caseback", "clasp_type", "country", "crystal",
    "dial_color", "diameter", "features", "frequency", "jewels", "listing_type", "lug_to_lug", "made_in", "movement",
    "numerals", "power_reserve", "seller_type", "serial_number", "specific_location", "style", "type",
    "water_resistance", "weight", "time_updated", "auction_end_time", "authenticity_guarantee",
]
_NAMES = [
    "brand", "reference_number", "group_reference", "parent_model", "specific_model", "currency", "condition",
    "status", "source", "listing_title", "watch_url", "price",
]

RAW = T.StructType(
    [T.StructField("date", T.DateType())]
    + [T.StructField(c, T.StringType()) for c in _NAMES]
    + [T.StructField(c, T.IntegerType()) for c in ("year_introduced", "year_of_production")]
    + [T.StructField(c, T.StringType()) for c in _TEXT]
)

ENRICHED = [
    "date", "brand", "reference_number", "group_reference", "parent_model", "specific_model", "currency", "price",
    "condition", "year_introduced", "source", "listing_title", "watch_url", "hash_id",
]

LIBRARY = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("brand", "reference_number", "group_reference", "parent_model", "specific_model")]
    + [T.StructField("year_introduced", T.IntegerType())]
)
RATES = T.StructType(
    [T.StructField("currency", T.StringType()), T.StructField("rate", T.DoubleType()), T.StructField("as_of", T.DateType())]
)

PRE_OWNED = ["Pre-Owned", "Pre-Owned, Seller Refurbished", "Pre-Owned, Vintage"]


@dataclass(frozen=True)
class Level:
    """A grain: its key, what its weekly rows carry beside prices, and what gap filling carries forward."""

    name: str
    keys: tuple[str, ...]
    firsts: tuple[str, ...] = ()
    carried: tuple[str, ...] = ()


_PRICES = ("currency", "median_price", "mean_price", "high", "low", "brand_slug")
LEVELS = {
    "reference": Level(
        "reference", ("brand", "reference_number"), ("group_reference", "parent_model", "specific_model", "year_introduced"),
        (*_PRICES, "group_reference", "parent_model", "specific_model", "year_introduced", "identifier"),
    ),
    "specific_model": Level("specific_model", ("brand", "specific_model"), ("parent_model",), (*_PRICES, "parent_model")),
    "parent_model": Level("parent_model", ("brand", "parent_model"), (), (*_PRICES, "condition")),
    "brand": Level("brand", ("brand",), (), _PRICES),
}
