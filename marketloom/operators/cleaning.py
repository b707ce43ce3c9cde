"""Cleaning and de-duplicating raw listings, keys and currencies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketloom.functions import text

# References that say nothing.
PLACEHOLDERS = [
    "UNAVAILABLE", "DOES NOT APPLY", "NOT", "NO", "WATCH", "NOT APPLICABLE", "UNKNOWN", "NA", "NONE", "REFERENCE NUMMBER:",
    "NON APPLICABLE", "DOSE NOT APPLY", "NOT APPLY", "N A", "N/A", "ASK", "SHOW ALL", "NO REFERENCE",
]
SOLD, LISTED = "eBay Sold", "eBay"


def first_by(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of every key in the given order; null keys are equal."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__place", place).where("__place = 1").drop("__place")


def dedupe_listings(df: DataFrame, ingest_order: str) -> DataFrame:
    """One row for each (date, watch_url): sold listings before live ones of the same market, then the first ingested.

    Where a key has one row there is nothing to choose. Live rows come before other sources only in keys with more rows.
    """
    rank = F.when(F.col("source") == SOLD, 1).when(F.col("source") == LISTED, 2).otherwise(3)
    return first_by(df, ["date", "watch_url"], [rank, F.col(ingest_order)])


def clean_listings(df: DataFrame, ingest_order: str = "ingest_id") -> DataFrame:
    """The cleaning chain; de-duplication comes before the exclusions."""
    ref = F.col("reference_number")
    df = df.where(F.coalesce(F.col("status"), F.lit("")) != "Deleted").where(ref.isNotNull() & (ref != ""))
    df = dedupe_listings(df.withColumn("reference_number", text.upper_ascii(ref)), ingest_order)
    df = df.where(~ref.isin(PLACEHOLDERS)).withColumn("price", text.price_number(F.col("price")))
    df = df.withColumn("reference_number", text.drop_invisible(ref)).where(~ref.rlike(r"^[\s*0\-–—._]*$"))
    df = df.dropna(subset=["brand", "price", "currency"])
    cleaned = F.regexp_replace(F.regexp_replace(text.clean_reference(ref), r"^REF\.", ""), ", DOES NOT APPLY$", "")
    return df.withColumns(
        {
            "reference_number": cleaned,
            "source": F.regexp_replace("source", "(?i)ebay", "eBay"),
            "year_introduced": text.year_number(F.col("year_introduced")),
            "year_of_production": text.year_number(F.col("year_of_production")),
        }
    )


def with_source(df: DataFrame) -> DataFrame:
    """Rows that name their source."""
    return df.dropna(subset=["source"])


def nulls_as_text(df: DataFrame, columns: tuple[str, ...] = ("caliber", "reference_number", "group_reference")) -> DataFrame:
    """Null references and calibers as the text ``<NA>``, for consumers that can't hold nulls."""
    return df.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit("<NA>")) for c in columns if c in df.columns})


def with_hash_id(df: DataFrame, columns: tuple[str, ...] = ("date", "watch_url", "source")) -> DataFrame:
    return df.withColumn("hash_id", text.hash_id(*[F.col(c) for c in columns]))


def latest_rates(rates: DataFrame) -> DataFrame:
    """One rate for each currency, the latest."""
    return rates.groupBy("currency").agg(F.max_by("rate", "as_of").alias("rate"))


#: Rates are one row for each currency of the world; more rows are joined by a shuffle.
MAX_BROADCAST_RATES = 10_000


def to_usd(df: DataFrame, rates: DataFrame, decimals: int | None = 2) -> DataFrame:
    """Prices of other currencies divided by their rate and rounded; without a rate the price is null."""
    rates = rates.select(F.col("currency").alias("__code"), F.col("rate").alias("__rate"))
    if rates.count() <= MAX_BROADCAST_RATES:  # of the small table of rates only
        rates = F.broadcast(rates)
    joined = df.join(rates, F.col("currency") == F.col("__code"), "left")
    other = F.try_divide(F.col("price"), F.col("__rate"))
    price = F.when(F.col("currency") == "USD", F.col("price")).otherwise(other if decimals is None else F.round(other, decimals))
    return joined.withColumns({"price": price, "currency": F.lit("USD")}).drop("__code", "__rate")


def finalize_types(df: DataFrame, quantize_rolling: bool = False) -> DataFrame:
    """Years and counts as int, null as 0; the trailing average too if asked."""
    names = ["year_introduced", "year_of_production", "count"]
    names += ["rolling_avg_of_median_price"] if quantize_rolling else []
    return df.withColumns({c: text.floor_int(F.col(c)) for c in names if c in df.columns})


def one_per_key(changes: DataFrame, key: str, order: list[Column] | None = None) -> DataFrame:
    """The first row by ``order`` of every key (by default that of the greatest values); rows without a key stay as they are."""
    order = order or [F.col(c).desc_nulls_last() for c in changes.columns if c != key]
    own = first_by(changes.where(F.col(key).isNotNull()), [key], order)
    return own.unionByName(changes.where(F.col(key).isNull()))


def upsert(target: DataFrame, changes: DataFrame, key: str, updated: list[str], order: list[Column] | None = None) -> DataFrame:
    """``target`` with the rows of ``changes``: known keys get its ``updated`` columns, unknown ones are added.

    Of several changes of one key the first by ``order`` counts (see ``one_per_key``), so no row
    of ``target`` is doubled and a key is added once. A change without a key is added.
    """
    changes = one_per_key(changes, key, order).select(*target.columns)
    new = changes.join(target.select(key), key, "left_anti").select(*target.columns)
    return updated_rows(target, changes, key, updated).unionByName(new)


def updated_rows(target: DataFrame, changes: DataFrame, key: str, updated: list[str]) -> DataFrame:
    """All rows of ``target``, with the ``updated`` columns of the row of ``changes`` of their key, which has one at most."""
    renamed = changes.select(F.col(key), *[F.col(c).alias(f"__{c}") for c in updated], F.lit(True).alias("__hit"))
    joined = target.join(renamed, key, "left")
    return joined.select(
        *[F.when(F.col("__hit"), F.col(f"__{c}")).otherwise(F.col(c)).alias(c) if c in updated else F.col(c) for c in target.columns]
    )


def coerce(df: DataFrame, schema) -> DataFrame:
    """Columns of ``schema`` only; values that don't fit and missing columns are null."""
    return df.select(
        *[(F.col(f.name).try_cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema]
    )
