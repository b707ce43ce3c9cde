"""All attribute standardisers on a frame of scraped listings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.functions import attributes as A
from marketloom.functions import text

#: Columns with a vocabulary or rule of their own; functions of the column.
SIMPLE = {
    "case_material": A.case_material, "bezel_material": A.case_material, "dial_color": A.dial_color, "bezel_color": A.dial_color,
    "style": A.style, "numerals": A.numerals, "bracelet_material": A.bracelet_material, "bracelet_color": A.bracelet_color,
    "features": A.features, "crystal": A.crystal, "case_shape": A.case_shape, "caseback": A.caseback, "price": A.whole_price,
    "power_reserve": A.power_reserve, "weight": A.weight, "water_resistance": A.water_resistance, "seller_type": A.seller_type,
    "listing_type": A.listing_type, "type": A.watch_type, "seller_rating": A.seller_rating, "diameter": A.diameter,
    "year_of_production": A.production_year,
}
BY_STORE = {"between_lugs": A.millimetres, "lug_to_lug": A.millimetres, "case_thickness": A.millimetres, "jewels": A.jewels}
NUMBERS = {"price": "double", "jewels": "double", "year_of_production": "int", "year_introduced": "int"}


def store_of(file_name: Column) -> Column:
    """A file's name up to its first underscore."""
    return F.split_part(file_name, F.lit("_"), F.lit(1))


def standardise(df: DataFrame, store: Column, currencies: list[str], by_store: dict[str, str] | None = None) -> DataFrame:
    """Every known column in its standard form; empty texts are null, long ones capped, ``description`` goes.

    ``store``: the source's short name. Condition and movement fall back to the title, the
    clasp to the bracelet's material, decades to the year. Columns that aren't there are left out.
    """
    have = set(df.columns)
    texts = {c: F.coalesce(F.replace(F.col(c).cast("string"), F.lit("\\u0026"), F.lit("&")), F.lit("")) for c in df.columns if c != "date"}
    df = df.withColumns(texts)
    title = F.col("listing_title") if "listing_title" in have else F.lit("")
    new = {c: f(F.col(c)) for c, f in SIMPLE.items() if c in have} | {c: f(F.col(c), store) for c, f in BY_STORE.items() if c in have}
    for c, f in (("condition", A.condition), ("movement", A.movement)):
        if c in have:
            new[c] = f(F.col(c), title)
    if "clasp_type" in have:
        new["clasp_type"] = F.coalesce(A.clasp_type(F.col("clasp_type")), *([A.clasp_type(F.col("bracelet_material"))] if "bracelet_material" in have else []))
    if "currency" in have:
        new["currency"] = A.currency_code(F.col("currency"), currencies)
    if {"decade_of_production", "year_of_production"} <= have:
        new["decade_of_production"] = A.production_decades(F.col("decade_of_production"), F.col("year_of_production"))
    if by_store is not None and "listing_title" in have:
        new["authenticity_guarantee"] = A.authenticity(title, store, by_store)
    out = df.withColumns(new).drop("description")
    capped = {c: F.nullif(text.cap(F.col(c)), F.lit("")) for c in out.columns if c != "date"}
    out = out.withColumns(capped)
    return out.withColumns({c: F.col(c).try_cast(t) for c, t in NUMBERS.items() if c in out.columns})
