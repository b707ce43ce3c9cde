"""Texts that hold phrases of a dictionary: an inverted index of grams, joined by hash and verified.

Every phrase is filed under one of its grams, that which the fewest phrases have. A gram is as
long as the largest power of two that fits into the phrase (``GRAM`` at most), so it is at least
half of a shorter phrase and long lists don't crowd on few grams. A text meets the index with
its own grams of these few lengths, so it is compared with the phrases that share a rare gram
with it, not with the whole list, and whatever the list's size Spark chooses how to join the index.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

GRAM = 16
#: Texts of more rows are broadcast with what was found in them, their rows are dealt by the whole row.
HOT_ROWS = 50_000
_DEALT = 4096


def _gram_length(phrase: Column) -> Column:
    size, length = F.length(phrase), F.lit(1)
    for n in (2**k for k in range(1, GRAM.bit_length())):
        length = F.when(size >= n, n).otherwise(length)
    return length


def _grams(text: Column, lengths: Column) -> Column:
    """The distinct substrings of the given lengths."""
    starts = lambda n: F.when(F.length(text) >= n, F.sequence(F.lit(1), F.length(text) - n + 1)).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.flatten(F.transform(lengths, lambda n: F.transform(starts(n), lambda k: F.substring(text, k, n)))))


def _index(phrases: DataFrame, by: list[str]) -> DataFrame:
    """``phrases`` with ``__gram``, the gram that each is filed under."""
    own = F.array(_gram_length(F.col("phrase")))
    distinct = phrases.where(F.length("phrase") > 0).select(*by, "phrase").distinct()
    grams = distinct.select(*by, "phrase", F.explode(_grams(F.col("phrase"), own)).alias("__gram"))
    shared = grams.groupBy(*by, "__gram").agg(F.count(F.lit(1)).alias("__n"))
    rarest = grams.join(shared, [*by, "__gram"]).groupBy(*by, "phrase").agg(F.min(F.struct("__n", "__gram"))["__gram"].alias("__gram"))
    return phrases.join(rarest, [*by, "phrase"])


def phrase_hits(texts: DataFrame, phrases: DataFrame, by: list[str]) -> DataFrame:
    """Each distinct (*by, text) with every row of ``phrases`` of the same ``by`` whose phrase the text holds.

    ``texts`` has the columns of ``by`` and text, ``phrases`` those, phrase and more. Nulls
    in any of them match nothing, neither does an empty phrase.
    """
    index = _index(phrases, by)
    lengths = phrases.where(F.length("phrase") > 0).agg(F.collect_set(_gram_length(F.col("phrase")))).scalar()  # five numbers at most
    own = texts.select(*by, "text").dropna().distinct().withColumn("__lengths", lengths)
    met = own.select(*by, "text", F.explode(_grams(F.col("text"), F.col("__lengths"))).alias("__gram")).join(index, [*by, "__gram"])
    return met.where(F.contains("text", F.col("phrase"))).drop("__gram")


def with_best_phrase(df: DataFrame, text: Column, phrases: DataFrame, by: list[str], order: list[Column], found: dict[str, Column], last: bool = False, hot: int = HOT_ROWS) -> DataFrame:
    """``df`` with the columns ``found`` of that phrase in ``text`` which is first (or ``last``) by ``order``; null without one.

    ``order`` and ``found`` are in terms of ``phrases``; among rows alike in ``order`` what is found decides.
    """
    joined = with_best_phrases(df, {"__best": text}, phrases, by, order, F.struct(*[c.alias(n) for n, c in found.items()]), last, hot)
    kept = [c for c in df.columns if c not in found]
    return joined.select(*kept, *[F.col("__best")[n].alias(n) for n in found])


def with_best_phrases(df: DataFrame, texts: dict[str, Column], phrases: DataFrame, by: list[str], order: list[Column], found: Column, last: bool = False, hot: int = HOT_ROWS) -> DataFrame:
    """The same for several texts of a row, which are looked up together: ``df`` and a column with ``found`` for each of ``texts``.

    Of rows of ``phrases`` with one phrase only the best is looked for. Rows are met again by
    their own text, not by a number given to them, so they are paired right whatever the order of
    ``df`` is. Rows without a text, and those of a text of more than ``hot`` rows, aren't gathered in one task.
    """
    pick = F.max if last else F.min
    own = df.withColumns({f"__text_{n}": t for n, t in texts.items()})
    each = own.select(*by, F.explode(F.array(*[f"__text_{n}" for n in texts])).alias("text")).dropna()
    counted = each.groupBy(*by, "text").agg(F.count(F.lit(1)).alias("__rows"))
    whole = F.struct(*[c.alias(f"o{k}") for k, c in enumerate(order)], found.alias("found"))
    firsts = phrases.groupBy(*by, "phrase").agg(pick(whole).alias("__whole"))
    best = lambda some: phrase_hits(some, firsts, by).groupBy(*by, "text").agg(pick("__whole")["found"].alias("__found"))
    many, few = counted.where(F.col("__rows") > hot).select(*by, "text"), counted.where(F.col("__rows") <= hot)
    many = many.join(best(many), [*by, "text"], "left").withColumn("__hot", F.lit(True))  # of all rows one in ``hot`` at most
    few = best(few).withColumn("__deal", F.pmod(F.xxhash64("text"), F.lit(_DEALT)))
    plain = [f.name for f in df.schema if not isinstance(f.dataType, ArrayType | MapType | StructType)]
    for name in texts:
        key = f"__text_{name}"
        own = own.join(F.broadcast(many.withColumnsRenamed({"text": key, "__found": "__of_many"})), [*by, key], "left")
        alone = F.col(key).isNull() | F.col("__hot").isNotNull()
        deal = F.when(alone, -1 - F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in plain]), F.lit(_DEALT))).otherwise(F.pmod(F.xxhash64(key), F.lit(_DEALT)))
        own = own.withColumn("__deal", deal).join(few.withColumnsRenamed({"text": key, "__found": "__of_few"}), [*by, key, "__deal"], "left")
        own = own.withColumn(name, F.coalesce("__of_many", "__of_few")).drop("__of_many", "__of_few", "__hot", "__deal")
    return own.select(*df.columns, *texts)
