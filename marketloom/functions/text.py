"""Text, key and cast functions on columns."""

from __future__ import annotations

import string
import sys
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# Marks that are taken out of identifiers.
INVISIBLE = "‏‮–﻿"
#: Letters with a mark and what they are without it; enough for the names of brands.
ACCENTED = "àáâãäåçèéêëìíîïñòóôõöùúûüýÿšžÀÁÂÃÄÅÇÈÉÊËÌÍÎÏÑÒÓÔÕÖÙÚÛÜÝŠŽ"
PLAIN = "aaaaaaceeeeiiiinooooouuuuyyszAAAAAACEEEEIIIINOOOOOUUUUYSZ"


def upper_ascii(c: Column) -> Column:
    return F.translate(c, string.ascii_lowercase, string.ascii_uppercase)


def is_nullish(c: Column) -> Column:
    """Null, empty, or the text that stands for null."""
    return c.isNull() | c.isin("", "<NA>")


def non_ascii(c: Column) -> Column:
    return c.rlike(r"[^\x00-\x7F]")


def drop_invisible(c: Column) -> Column:
    return F.translate(c, INVISIBLE, "")


def clean_reference(c: Column) -> Column:
    """Without leading non-word characters, and without quotes and brackets."""
    return F.regexp_replace(F.regexp_replace(c, r"(?U)^\W+", ""), r"""['"()\[\]]""", "")


def price_number(c: Column) -> Column:
    """Text with thousands separators as a number; null if it is none."""
    return F.replace(c.cast("string"), F.lit(","), F.lit("")).try_cast("double")


def year_number(c: Column) -> Column:
    """A year as int: a number as it is, else the first four digits before an ``s``; null and others 0."""
    text = c.cast("string")
    found = F.regexp_extract(F.split_part(text, F.lit("s"), F.lit(1)), r"\d{4}", 0)
    return F.coalesce(F.floor(text.try_cast("double")).cast("int"), found.try_cast("int"), F.lit(0))


def floor_int(c: Column) -> Column:
    """Null as 0, else the floor, as int."""
    return F.coalesce(F.floor(c), F.lit(0)).cast("int")


def hash_id(*columns: Column, prefix: str | None = None) -> Column:
    """Hex SHA-256 of the columns joined by hyphens; a null counts as ``<NA>``."""
    parts = [F.coalesce(c.cast("string"), F.lit("<NA>")) for c in columns]
    return F.sha2(F.concat_ws("-", *([F.lit(prefix)] if prefix else []), *parts), 256)


def _decompositions() -> list[tuple[str, str]]:
    """For the first, second ... letter of what characters are in ASCII by their compatibility decomposition: characters and letters.

    Characters that are ASCII letters no longer stand last, so that ``translate`` takes them out.
    """
    found = ((chr(c), unicodedata.normalize("NFKD", chr(c)).encode("ascii", "ignore").decode()) for c in range(0x80, sys.maxunicode + 1) if not 0xD800 <= c <= 0xDFFF)
    plain = sorted(((c, p) for c, p in found if p), key=lambda x: -len(x[1]))
    longest = len(plain[0][1])
    return [("".join(c for c, _ in plain), "".join(p[k] for _, p in plain if len(p) > k)) for k in range(longest)]


DECOMPOSITIONS = _decompositions()


def ascii_of(c: Column) -> Column:
    """Characters by their compatibility decomposition (NFKD), what is not ASCII then left out."""
    expanded = lambda ch: F.concat(*[F.translate(ch, chars, letters) for chars, letters in DECOMPOSITIONS])
    letters = F.transform(F.split(c, ""), lambda ch: F.when(non_ascii(ch), F.regexp_replace(expanded(ch), r"[^\x00-\x7F]", "")).otherwise(ch))
    return F.when(non_ascii(c), F.array_join(letters, "")).otherwise(c)


def slug(c: Column) -> Column:
    """Lower-case words joined by hyphens, accents and other signs left out."""
    words = F.lower(F.regexp_replace(F.regexp_replace(ascii_of(c), r"[^\w\s-]", ""), r"^\s+|\s+$", ""))
    return F.regexp_replace(words, r"[-\s]+", "-")


def identifier(brand_slug: Column, key: Column) -> Column:
    """Slug and key; null if one is null."""
    return F.concat(brand_slug, F.lit("-"), key)


def group_name(c: Column) -> Column:
    return F.lower(F.regexp_replace(c, "[^A-Za-z0-9_-]", "_"))


def cap(c: Column, most: int = 255) -> Column:
    return F.when(F.length(c) > most, F.concat(F.substring(c, 1, most - 3), F.lit("..."))).otherwise(c)
