"""Standard values of free-text listing attributes, as Column functions over vocabularies."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.functions import vocabularies as V
from marketloom.functions.text import ACCENTED, PLAIN
from marketloom.operators import dictionary


def _quoted(word: str) -> str:
    return rf"\Q{word.lower()}\E"


def _holds(low: Column, synonyms: list[str], words: bool) -> Column:
    """Whether a lower-case text holds one of the synonyms; as words, only texts that hold one at all are searched by a pattern."""
    found = reduce(Column.__or__, [low.contains(s.lower()) for s in synonyms], F.lit(False))
    return found & low.rlike(rf"\b(?:{'|'.join(map(_quoted, synonyms))})\b") if words and synonyms else found


def one_of(text: Column, vocabulary: dict[str, list[str]]) -> Column:
    """The first canonical value of which a synonym is in the text; else null."""
    found = F.lit(None).cast("string")
    for key, synonyms in reversed(vocabulary.items()):
        found = F.when(_holds(F.lower(text), synonyms, False), key).otherwise(found)
    return found


def many_of(text: Column, vocabulary: dict[str, list[str]], words: bool = False, unless: dict | None = None, narrowed: dict | None = None) -> Column:
    """All canonical values of which a synonym is in the text, in the vocabulary's order, joined; null if none.

    ``unless``: a value is left out if one of these values is found. ``narrowed``: (value,
    synonym) pairs of which the synonym doesn't count if another value is found.
    """
    own, unless, narrowed = vocabulary, unless or {}, narrowed or {}

    def found(low: Column, key: str) -> Column:
        hit = _holds(low, own[key], words)
        for (value, synonym), other in narrowed.items():
            if value == key:
                rest = [s for s in own[key] if s != synonym]
                hit = F.when(found(low, other), _holds(low, rest, words)).otherwise(hit)
        for other in unless.get(key, ()):
            hit = hit & ~found(low, other)
        return hit

    # The lower-cased text is the element of an array, so it and the rules are in the expression once.
    values = F.transform(F.array(F.lower(text)), lambda low: F.array_join(F.array(*[F.when(found(low, k), k) for k in own]), ", "))
    return F.get(F.filter(values, lambda v: v != ""), F.lit(0))


GOLDS = {"Gold": ["Rose Gold", "White Gold"]}


def case_material(c: Column) -> Column:
    return many_of(c, V.CASE_MATERIAL, words=True, unless={**GOLDS, "DLC": ["ADLC"]})


def dial_color(c: Column) -> Column:
    return many_of(c, V.DIAL_COLOR, unless={"Gold": ["Rose Gold", "White"], "Pearl": ["Mother of Pearl"]})


def bracelet_material(c: Column) -> Column:
    return many_of(c, V.BRACELET_MATERIAL, words=True, unless=GOLDS)


def bracelet_color(c: Column) -> Column:
    return many_of(c, V.BRACELET_COLOR, unless=GOLDS, narrowed={("White", "White"): "White Gold", ("Yellow", "Yellow"): "Gold"})


def clasp_type(c: Column) -> Column:
    folding = [f"{k}, Folding Clasp" for k in ("Hidden Clasp", "Butterfly Clasp", "Triple Folding Clasp")]
    return many_of(c, V.CLASP_TYPE, unless={"Buckle": ["Pin Buckle, Buckle", "Sliding Buckle, Buckle"], "Folding Clasp": folding})


def style(c: Column) -> Column:
    """Dive, pilot and racing styles are sport too."""
    found = many_of(c, V.STYLE)
    parts = F.split(found, ", ")
    sporty = F.arrays_overlap(parts, F.array(*map(F.lit, ["Dive", "Pilot", "Racing / Driving"])))
    return F.when(sporty & ~F.array_contains(parts, "Sport"), F.concat(found, F.lit(", Sport"))).otherwise(found)


def numerals(c: Column) -> Column:
    return many_of(c, V.NUMERALS)


def features(c: Column) -> Column:
    return many_of(c, V.FEATURES)


def crystal(c: Column) -> Column:
    return many_of(c, V.CRYSTAL)


def case_shape(c: Column) -> Column:
    return many_of(c, V.CASE_SHAPE)


def caseback(c: Column) -> Column:
    return many_of(c, V.CASEBACK)


def condition(c: Column, title: Column | None = None) -> Column:
    found = one_of(c, V.CONDITION)
    return found if title is None else F.coalesce(found, one_of(title, V.CONDITION))


def movement(c: Column, title: Column | None = None) -> Column:
    found = one_of(c, V.MOVEMENT)
    return found if title is None else F.coalesce(found, one_of(title, V.MOVEMENT))


def contents(c: Column, vocabulary: dict[str, list[str]]) -> Column:
    """What comes with a listing by a vocabulary of the caller; texts without a match stay."""
    return F.coalesce(one_of(c, vocabulary), c)


def watch_type(c: Column) -> Column:
    """The type whose name or synonym the text is; empty for others."""
    found = F.lit("")
    for key, synonyms in reversed(V.WATCH_TYPE.items()):
        found = F.when(F.lower(F.trim(c)).isin(*[s.lower() for s in [key, *synonyms]]), key).otherwise(found)
    return found


def listing_type(c: Column) -> Column:
    """Each part between commas by its name or synonym; unknown parts are left out."""

    def of(part: Column) -> Column:
        found = F.lit(None).cast("string")
        for key, synonyms in V.LISTING_TYPE.items():
            found = F.when(F.lower(F.trim(part)).isin(*[s.lower() for s in [key, *synonyms]]), key).otherwise(found)
        return found

    return F.array_join(F.filter(F.transform(F.split(c, r",\s?"), of), lambda v: v.isNotNull()), ", ")


def seller_type(c: Column) -> Column:
    # Kinds of sellers.
    kinds = ["Dealer", "Private Seller", "Retailer", "Auction House"]
    named = F.initcap(F.trim(c))
    return F.when(F.lower(F.trim(c)) == "professional dealer", "Dealer").when(named.isin(kinds), named).otherwise("")


def currency_code(c: Column, codes: list[str]) -> Column:
    """The first of ``codes`` in the text, else the code of a symbol; empty if unknown."""
    # Symbols of currencies.
    symbols = {"$": "USD", "£": "GBP", "€": "EUR", "¥": "JPY", "₹": "INR", "₽": "RUB", "₩": "KRW"}
    by_symbol = F.lit("")
    sign = F.trim(F.regexp_replace(c, "[A-Za-z0-9]", ""))
    for symbol, code in symbols.items():
        by_symbol = F.when(sign == symbol, code).otherwise(by_symbol)
    found = by_symbol
    for code in reversed(codes):
        found = F.when(F.contains(F.upper(c), F.lit(code)), code).otherwise(found)
    return found


def whole_price(c: Column) -> Column:
    """Digits and dot as a whole number in text; empty if there is none."""
    number = F.regexp_replace(c, r"[^\d.]", "").try_cast("double")
    return F.coalesce(F.floor(number).cast("bigint").cast("string"), F.lit(""))


_NUMBER = r"\d{1,3}(?:,?\d{3})*(?:\.\d+)?"


def _number(hit: Column) -> Column:
    return F.regexp_replace(hit, r"[^\d.]", "").try_cast("double")


def _hit(c: Column, pattern: str) -> Column:
    return F.nullif(F.regexp_extract(F.lower(F.trim(c)), pattern, 0), F.lit(""))


def _with_unit(number: Column, unit: str) -> Column:
    return F.concat(number.cast("string"), F.lit(f" {unit}"))


def water_resistance(c: Column) -> Column:
    """In ATM: bar and ATM as they are, metres by 10, feet by 32.81; texts that say no or zero are not resistant."""
    none = F.lit("Not water resistant")
    letters = F.regexp_replace(F.lower(c), "[^a-z]", " ")
    digits = F.regexp_replace(c, r"\D", "")
    atm, metres, feet = (_number(_hit(c, _NUMBER + rf"\s*(?:{u})")) for u in ("atm|bar", "m|meter|metre", "ft|feet"))
    value = F.when(atm.isNotNull(), atm).when(metres.isNotNull(), metres / 10).when(feet.isNotNull(), F.round(feet / 32.81, 2))
    out = F.when(value == 0, none).otherwise(_with_unit(value, "ATM"))
    return F.when(F.coalesce(c, F.lit("")) == "", "").when(
        letters.rlike(r"\b(?:none|not water resistant|no)\b") | digits.rlike("^0+$"), none
    ).otherwise(F.coalesce(out, F.lit("")))


def weight(c: Column) -> Column:
    grams, ounces = _number(_hit(c, _NUMBER + r"\s*g")), _number(_hit(c, _NUMBER + r"\s*(?:ounce|oz)"))
    return F.coalesce(_with_unit(F.coalesce(grams, ounces * 28.3495), "g"), F.lit(""))


def millimetres(c: Column, store: Column) -> Column:
    """Lengths as ``x mm``; strict about units for the store whose texts are free."""
    low = F.replace(F.lower(F.trim(c)), F.lit(","), F.lit("."))
    short = r"\d{1,3}(?:\.\d+)?\)?\s*"
    mm, cm, inch = (_number(_hit(low, short + u)) for u in ("(?:mm|milli)", "cm", "(?:in|\"|')"))
    strict = F.coalesce(_with_unit(F.coalesce(mm, cm * 10, F.round(inch * 25.4, 2)), "mm"), F.lit(""))
    plain = F.regexp_replace(F.when(store == "chrono24", c).otherwise(F.replace(c, F.lit(","), F.lit("."))), r"[^\d.]", "")
    return F.when(store == "ebay", strict).otherwise(F.when(plain == "", "").otherwise(F.concat(plain, F.lit(" mm"))))


def diameter(c: Column) -> Column:
    """Numbers of the parts between multiplication signs, in mm; empty where a part holds two numbers."""
    parts = F.split(F.replace(c, F.lit(","), F.lit(".")), r"[_&x×хX*:|]")
    numbers = F.transform(parts, lambda p: F.regexp_extract_all(p, F.lit(r"\d+(?:\.\s?\d+)?"), F.lit(0)))
    low = F.lower(c)
    scale = F.when(low.rlike(r"\d\s*cm"), 10.0).when(low.rlike("\\d\\s*(?:in|['”\"])"), 25.4).otherwise(1.0)
    each = F.transform(F.filter(numbers, lambda n: F.size(n) > 0), lambda n: (_number(F.get(n, F.lit(0))) * scale).cast("string"))
    bad = F.exists(numbers, lambda n: F.size(n) > 1) | (F.size(each) == 0)
    return F.when(bad, "").otherwise(F.concat(F.array_join(each, " x "), F.lit(" mm")))


def power_reserve(c: Column) -> Column:
    number = F.regexp_replace(c, r"[^\d.]", "")
    days = F.coalesce(_with_unit(F.round(number.try_cast("double") * 24, 2), "hours"), F.lit(""))
    return F.when(F.contains(F.lower(c), F.lit("day")), days).otherwise(F.when(number == "", "").otherwise(F.concat(number, F.lit(" hours"))))


def jewels(c: Column, store: Column) -> Column:
    clean = F.regexp_replace(F.regexp_extract(F.lower(c), _NUMBER, 0), r"[^\d.]", "")
    strict = F.regexp_replace(F.regexp_extract(F.lower(c), r"\d{1,3}\)?\s{0,3}(?:diamond|jewel|rub|stone)", 0), r"\D", "")
    found = F.when(store.isin("chrono24", "hodinkee"), clean).otherwise(strict)
    return F.when(found.try_cast("double") > 500, "").otherwise(F.coalesce(found, F.lit("")))


def production_year(c: Column) -> Column:
    year = F.regexp_extract(c, r"\d{4}", 0)
    return F.when(F.substring(year, 1, 2).isin("18", "19", "20"), year).otherwise("")


def production_decades(decade: Column, year: Column) -> Column:
    """Decades of the years of a range, sorted and joined; a two-digit year takes the first one's century."""
    text = F.regexp_replace(F.replace(F.lower(F.when(decade == "", year).otherwise(decade)), F.lit(" to "), F.lit("-")), r"[^0-9\-.]", "")
    years = F.filter(F.transform(F.split(text, "-"), lambda p: F.regexp_extract(p, r"\d{4}|\d{2}", 0)), lambda y: y != "")
    century = F.substring(F.get(years, F.lit(0)), 1, 2)
    tens = lambda y: F.concat(F.substring(y, 1, 3), F.lit("0s"))
    short = lambda y: F.when(F.length(F.get(years, F.lit(0))) == 4, F.concat(century, F.substring(y, 1, 1), F.lit("0s")))
    named = F.transform(years, lambda y: F.when(F.length(y) == 2, short(y)).when(F.substring(y, 1, 2).isin("18", "19", "20"), tens(y)))
    return F.array_join(F.array_sort(F.array_distinct(F.filter(named, lambda v: v.isNotNull()))), ", ")


def authenticity(title: Column, store: Column, by_store: dict[str, str]) -> Column:
    """By the title for one store, by a table for the others; empty if unknown."""
    said = F.lower(title).rlike(r"authentic(?:ity)? guarantee|guaranteed? authentic")
    found = F.lit("")
    for name, value in by_store.items():
        found = F.when(store == name, value).otherwise(found)
    return F.when(store == "ebay", F.when(said, "Yes").otherwise("No")).otherwise(found)


def seller_rating(c: Column) -> Column:
    """A known label as it is; a percentage or a score out of five by thresholds; else empty."""
    # Labels and the scores below which they end, out of a hundred and of five.
    steps = [("Very Poor", 50, 2.5), ("Poor", 60, 3), ("Average", 70, 3.5), ("Good", 80, 4), ("Great", 90, 4.5)]
    label, number = F.initcap(F.trim(c)), _number(c)

    def graded(place: int, most: float) -> Column:
        out = F.when(number <= 0, "Unavailable")
        for step in steps:
            out = out.when(number < step[place], step[0])
        return out.when(number <= most, "Excellent").otherwise("")

    known = [s[0] for s in steps] + ["Excellent", "Unavailable"]
    return F.when(label.isin(known), label).when(number.isNull(), "").when(F.contains(c, F.lit("%")), graded(1, 100)).otherwise(graded(2, 5))


def country_key(c: Column) -> Column:
    plain = F.translate(c, ACCENTED, PLAIN)
    return F.trim(F.replace(F.replace(F.lower(plain), F.lit("-"), F.lit(" ")), F.lit(" and "), F.lit(" & ")))


def country_of(df: DataFrame, countries: DataFrame, column: str = "country") -> DataFrame:
    """``df`` with the standard country of ``countries`` (name, alias), by name first, then by alias; empty if unknown."""
    names = countries.select(country_key(F.col("name")).alias("__k"), "name", F.lit(0).alias("__rank"))
    aliases = countries.select(country_key(F.col("alias")).alias("__k"), "name", F.lit(1).alias("__rank"))
    table = names.union(aliases).where("__k IS NOT NULL").groupBy("__k").agg(F.min(F.struct("__rank", "name")).alias("__found"))
    joined = df.join(table, country_key(F.col(column)) == F.col("__k"), "left")
    return joined.withColumn(column, F.coalesce(F.col("__found.name"), F.lit(""))).drop("__k", "__found")


def models_of(df: DataFrame, rules: DataFrame, brand: str = "brand", text: str = "text") -> DataFrame:
    """``df`` with specific_model and parent_model of the brand's first rule (by priority) whose ``alternate`` is in the text."""
    phrases = rules.select(F.col(brand), F.lower("alternate").alias("phrase"), "priority", "specific_model", "parent_model")
    found = {c: F.col(c) for c in ("specific_model", "parent_model")}
    return dictionary.with_best_phrase(df, F.lower(F.col(text)), phrases, [brand], [F.col("priority")], found)


def brand_of(df: DataFrame, brands: DataFrame, title: str = "title") -> DataFrame:
    """``df`` and ``brand_found``: that of the brands (name, alias) whose alias is the longest that stands as whole words in the title.

    Of aliases of one length the last by name is taken; null if there is none.
    """
    words = lambda c: F.regexp_replace(F.concat(F.lit(" "), F.lower(c), F.lit(" ")), r"[^\p{L}\p{N}]+", " ")
    phrases = brands.select("name", F.length("alias").alias("size"), words(F.col("alias")).alias("phrase")).where("phrase <> ' '")
    order = [F.col("size"), F.col("name")]
    return dictionary.with_best_phrase(df, words(F.col(title)), phrases, [], order, {"brand_found": F.col("name")}, last=True)
