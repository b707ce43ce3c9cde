"""Personal data (operator 6): patterns propose spans, checksums confirm them, context words adjust the score.

All work is DataFrame expressions on one row at a time: ``split`` gives the text between
the matches of a pattern and ``regexp_extract_all`` the matches, so running sums of their
lengths are the positions in code points.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import hidden, quoted, text_of

# Letters after the check digits of an IBAN by country (public registry).
IBAN_LENGTHS = {
    "AT": 16, "BE": 12, "CH": 17, "DE": 18, "DK": 14, "ES": 20, "FI": 14, "FR": 23, "GB": 18,
    "IE": 18, "IT": 23, "LU": 16, "NL": 14, "NO": 11, "PL": 24, "PT": 21, "SE": 20,
}
#: Characters before and after a match in which context words count.
BEFORE, AFTER = 48, 24
#: Spans that the method adds to the base kinds need this score.
MIN_SCORE = 0.6
BLOCK = 512


@dataclass(frozen=True)
class Kind:
    """``guard``: a cheap pattern without which ``pattern`` can't match. ``valid``: of a match.
    ``score``: of a valid match, to which ``boost`` is added where a word of ``context`` is near."""

    name: str
    pattern: str
    guard: str
    valid: Callable[[Column], Column]
    score: float
    context: str
    boost: float = 0.2
    base: bool = True


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn checksum."""
    n = F.length(digits)

    def step(total: Column, i: Column) -> Column:
        d = F.ascii(F.substring(digits, i, F.lit(1))) - 48
        twice = d * 2 - F.when(d > 4, 9).otherwise(0)
        return total + F.when((n - i) % 2 == 1, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), step) % 10 == 0


def mod97(match: Column) -> Column:
    """Whether an IBAN passes the mod-97 checksum."""
    plain = F.replace(match, F.lit(" "), F.lit(""))
    turned = F.concat(F.substr(plain, F.lit(5)), F.substr(plain, F.lit(1), F.lit(4)))

    def step(rest: Column, i: Column) -> Column:
        code = F.ascii(F.substring(turned, i, F.lit(1)))
        return F.when(code >= 65, (rest * 100 + code - 55) % 97).otherwise((rest * 10 + code - 48) % 97)

    return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), step) == 1


def _count_between(low: int, high: int) -> Callable[[Column], Column]:
    return lambda m: F.length(_digits(m)).between(low, high)


def _card(match: Column) -> Column:
    return F.when(_count_between(12, 19)(match), luhn(_digits(match))).otherwise(F.lit(False))


# A match starts where the run of its first characters starts, or where the match before ended:
# starting later in the same run can't succeed where starting at its head failed.
_LOCAL = "[A-Za-z0-9._%+-]"
KINDS = (
    Kind(
        "email", rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@",
        lambda m: F.lit(True), 0.8, r"mail|contact|write|kontakt|correo|courriel",
    ),
    Kind(
        "ip", r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}", r"[0-9]\.[0-9]",
        lambda m: m.rlike(r"^(?:0*+(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2}|)(?:\.|$)){4}$"), 0.6, r"\bip\b|host|server|address|adresse",
    ),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", r"[0-9][\x20-]?[0-9]", _card, 0.8, r"card|visa|karte|carte|tarjeta|credit"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]", _count_between(9, 15), 0.6, r"phone|tel|call|mobil|ruf"),
    Kind(
        "iban", r"(?<![A-Za-z0-9])(?:" + "|".join(f"{c}[0-9]{{2}}(?:\\x20?[A-Z0-9]){{{n}}}" for c, n in IBAN_LENGTHS.items()) + ")(?![A-Za-z0-9])",
        r"[A-Z]{2}[0-9]{2}", mod97, 0.8, r"iban|account|konto|compte|cuenta|bank", base=False,
    ),
    Kind(
        "ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", r"[0-9]-[0-9]{2}-[0-9]",
        lambda m: ~m.rlike("^(?:000|666|9)|-00-|-0000$"), 0.3, r"ssn|social.security", boost=0.4, base=False,
    ),
    Kind(
        "local_phone", r"(?<![0-9+(-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9-])", r"[0-9]{3}[\x20.-][0-9]{4}",
        lambda m: F.lit(True), 0.3, r"phone|telefon|t[eé]l[eé]|call|mobil", boost=0.4, base=False,
    ),
)


def _running(lengths: Column) -> Column:
    """Sums of all elements before each; in blocks, so that long arrays take no quadratic time."""
    kind = "array<int>"

    def fold(values: Column, first: Column) -> Column:
        zero = F.struct(first.alias("s"), F.array().cast(kind).alias("out"))
        return F.aggregate(
            values, zero, lambda a, v: F.struct((a["s"] + v).alias("s"), F.concat(a["out"], F.array(a["s"])).alias("out"))
        )["out"]

    count = F.ceil(F.size(lengths) / BLOCK).cast("int")
    blocks = F.transform(F.sequence(F.lit(0), count - 1), lambda b: F.slice(lengths, b * BLOCK + 1, F.lit(BLOCK)))
    totals = F.transform(blocks, lambda x: F.aggregate(x, F.lit(0), lambda s, v: s + v))
    return F.flatten(F.zip_with(blocks, fold(totals, F.lit(0)), fold))


def _lengths(gaps: Column, matches: Column) -> Column:
    return F.zip_with(F.slice(gaps, F.lit(1), F.size(matches)), matches, lambda g, m: F.length(g) + F.length(m))


def _spans(gaps: Column, matches: Column, lengths: Column, kind: Kind, order: int) -> Column:
    """The valid matches as structs. ``gaps`` is read more than once, so Spark computes it once, in a step of its own."""

    def span(x: Column, i: Column) -> Column:
        m, end = x["m"], x["end"]
        around = F.concat(F.right(F.get(gaps, i), F.lit(BEFORE)), F.lit(" "), F.left(F.get(gaps, i + 1), F.lit(AFTER)))
        boost = F.when(F.lower(around).rlike(kind.context), kind.boost).otherwise(0.0)
        return F.struct(
            (end - F.length(m)).alias("start"), F.lit(order).alias("order"), end.alias("end"), F.lit(kind.name).alias("kind"),
            (F.lit(kind.score) + boost).alias("score"), kind.valid(m).alias("valid"),
        )

    ends = F.zip_with(_running(lengths), lengths, lambda s, n: s + n)
    found = F.transform(F.zip_with(matches, ends, lambda m, e: F.struct(m.alias("m"), e.alias("end"))), span)
    found = F.filter(found, lambda s: s["valid"])
    return found if kind.base else F.filter(found, lambda s: s["score"] >= MIN_SCORE)


SPANS = "array<struct<start:int,order:int,end:int,kind:string,score:double,valid:boolean>>"


def with_spans(docs: DataFrame, column: str) -> DataFrame:
    """``docs`` and ``column``: array<struct<start, order, end, kind, score, valid>>, sorted.

    Positions are code points, end exclusive. Spans of one kind don't overlap, those of two
    kinds may. The kinds email, ip, card and phone keep every match that passes their check;
    iban, ssn and local_phone need MIN_SCORE. A null or empty text has no spans; all columns
    of ``docs`` stay as they are, repeated rows each get their own result.
    """
    text = text_of(docs)
    own = hidden(docs, *[f"{part}{i}" for part in "mgn" for i in range(len(KINDS))])
    m, g, n = ([own[f"{part}{i}"] for i in range(len(KINDS))] for part in "mgn")
    none = F.array().cast("array<string>")
    matches = [F.when(text.rlike(k.guard), F.regexp_extract_all(text, F.lit(k.pattern), F.lit(0))).otherwise(none) for k in KINDS]
    gaps = [F.when(F.size(c) > 0, F.split(F.coalesce(F.col("text"), F.lit("")), k.pattern, -1)).otherwise(none) for c, k in zip(m, KINDS, strict=True)]
    lengths = [_lengths(F.col(a), F.col(b)) for a, b in zip(g, m, strict=True)]
    out = docs.withColumns(dict(zip(m, matches, strict=True)))
    out = out.withColumns(dict(zip(g, gaps, strict=True)))
    out = out.withColumns(dict(zip(n, lengths, strict=True)))
    each = [
        F.when(F.size(m[i]) > 0, _spans(F.col(g[i]), F.col(m[i]), F.col(n[i]), k, i)).otherwise(F.array().cast(SPANS))
        for i, k in enumerate(KINDS)
    ]
    return out.withColumn(column, F.array_sort(F.concat(*each))).drop(*own.values())


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with each span replaced by its kind in brackets; ``n_chars``, if there, is counted anew.

    Overlapping spans become one, named after the first. Rows without spans stay as they are.
    """
    name = hidden(docs, "spans")["spans"]
    found = with_spans(docs, name)
    step_kind = "struct<parts:array<string>,at:int>"
    text = F.col("text")

    def step(acc: Column, s: Column) -> Column:
        before = F.substring(text, acc["at"] + 1, s["start"] - acc["at"])
        parts = F.concat(acc["parts"], F.array(before, F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]"))))
        added = F.struct(parts.alias("parts"), s["end"].alias("at"))
        inside = F.struct(acc["parts"].alias("parts"), F.greatest(acc["at"], s["end"]).alias("at"))
        return F.when(s["start"] < acc["at"], inside).otherwise(added).cast(step_kind)

    zero = F.struct(F.array().cast("array<string>").alias("parts"), F.lit(0).alias("at")).cast(step_kind)
    clean = F.aggregate(
        name, zero, step, lambda a: F.concat(F.array_join(a["parts"], ""), F.substr(text, a["at"] + 1))
    )
    out = found.withColumn("text", F.when(F.size(name) > 0, clean).otherwise(text))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.size(name) > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars")))
    return out.select(*quoted(docs.columns))
