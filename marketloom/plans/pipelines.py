"""The jobs: ingest, price history at each level, market make-up, volatility and liquidity."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.functions.identifiers import group_reference, reference_of
from marketloom.operators import cleaning, enrichment, liquidity, outliers, series, volatility, weekly
from marketloom.schema import ENRICHED, LEVELS


def ingest(raw: DataFrame, rates: DataFrame, ingest_order: str = "ingest_id") -> DataFrame:
    """Raw listings cleaned, keyed and in US dollars."""
    if ingest_order not in raw.columns:
        raw = raw.withColumn(ingest_order, F.monotonically_increasing_id())
    cleaned = cleaning.with_hash_id(cleaning.clean_listings(cleaning.with_source(raw), ingest_order))
    return cleaning.to_usd(cleaned, cleaning.latest_rates(rates)).drop(ingest_order)


def enrich(listings: DataFrame, library: DataFrame) -> DataFrame:
    """References in the brands' forms, group references, and blanks filled from the library."""
    ref = reference_of(F.col("brand"), F.col("reference_number"), F.col("listing_title"))
    named = listings.withColumn("reference_number", ref).withColumn("group_reference", group_reference(F.col("brand"), F.col("reference_number")))
    kept = enrichment.plausible_references(named).select(*[c for c in ENRICHED if c in named.columns])
    return enrichment.fill_from_library(kept, library)


def reference_prices(listings: DataFrame, library: DataFrame, pre_owned: DataFrame, new: DataFrame, history: DataFrame) -> dict[str, DataFrame]:
    """All outputs of the reference level for one week, each a lazy plan: enriched, without outliers, weekly, prices."""
    enriched = enrich(listings, library)
    kept = outliers.filter_outliers(enriched, outliers.latest_boundaries(pre_owned), outliers.latest_boundaries(new))
    week = weekly.weekly(kept, "reference")
    prices = cleaning.finalize_types(series.price_history(history, week, "reference"))
    return {"enriched": enriched, "without_outliers": kept, "weekly": week, "prices": prices}


def level_prices(listings: DataFrame, history: DataFrame, level: str) -> DataFrame:
    return cleaning.finalize_types(series.price_history(history, weekly.weekly(listings, level), level))


def market_makeup(listings: DataFrame) -> dict[str, DataFrame]:
    return {name: weekly.market_makeup(listings, list(level.keys)) for name, level in LEVELS.items()}


def price_volatility(history: DataFrame) -> DataFrame:
    return volatility.volatility(history)


def market_liquidity(listings: DataFrame) -> DataFrame:
    return liquidity.listing_durations(listings)
