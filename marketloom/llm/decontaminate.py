"""Benchmark decontamination (operator 1): n-gram windows of benchmark items found in documents.

All work is DataFrame expressions. Every item gives windows of ``width`` consecutive
words (one shorter window if it has fewer). The windows' hashes are the build side of a
hash join; a document's words are hashed once, its windows are hashes of ``width`` word
hashes, and each hash hit is verified by comparing the words themselves.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ALNUM_WORD, checkpointed, hidden, quoted, text_of, words_of

WIDTH = 10
#: The same words before lower-casing.
CASED_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: At most so many windows (some 400 bytes each) are broadcast; more are joined by a shuffle.
MAX_BROADCAST_WINDOWS = 200_000
#: Rows without hits are kept by so many keys where windows are joined by a shuffle.
MARKERS = 4096
#: At most so many 64-character keys of contaminated texts are broadcast.
MAX_BROADCAST_KEYS = 200_000


def benchmark_windows(benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """Distinct windows: w_words array<string>, w_len int, w_items array<string> (ids, nulls left out)."""
    words = benchmark.select(
        F.col("item_id").cast("string").alias("item"), words_of(text_of(benchmark), ALNUM_WORD).alias("words")
    ).where(F.size("words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - (width - 1), F.lit(1)))
    return (
        words.select("item", "words", F.explode(starts).alias("at"))
        .select("item", F.slice("words", F.col("at"), F.lit(width)).alias("w_words"))
        .groupBy("w_words")
        .agg(F.collect_set("item").alias("w_items"))
        .withColumn("w_len", F.size("w_words"))
    )


def _window_hash(hashes: Column, at: Column, length: int) -> Column:
    return F.xxhash64(F.lit(length), *[F.get(hashes, at + k if k else at) for k in range(length)])


def _hashes(hashes: Column, length: int) -> Column:
    n = F.size(hashes)
    each = F.transform(F.sequence(F.lit(0), n - length), lambda at: _window_hash(hashes, at, length))
    return F.when(n >= length, each).otherwise(F.array().cast("array<bigint>"))


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    width: int = WIDTH,
    max_broadcast_windows: int = MAX_BROADCAST_WINDOWS,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, spans, n_hit, items, text_key.

    ``spans`` are merged word ranges [start, end) inside any benchmark window, ``n_hit`` the
    words in them, ``items`` the sorted ids (as strings) of the items that occur. A null or
    empty text has no words; repeated rows give one row each; an empty benchmark hits
    nothing; other columns of ``docs`` are not used. ``text_key`` is the SHA-256 of the text.
    """
    windows = checkpointed(benchmark_windows(benchmark, width))
    lengths = sorted(r[0] for r in windows.select("w_len").distinct().collect())  # width values at most
    small = windows.count() <= max_broadcast_windows

    w_hashes = F.transform("w_words", lambda w: F.xxhash64(w))
    hashed = reduce(
        lambda other, n: F.when(F.col("w_len") == n, _window_hash(F.col("w_hashes"), F.lit(0), n)).otherwise(other),
        lengths,
        F.lit(None).cast("bigint"),
    )
    # Each document also carries one leading entry that meets a marker row, so it is kept without hits.
    markers = 1 if small else MARKERS
    marker = docs.sparkSession.range(markers).select(
        F.col("id").alias("w_hash"), F.lit(0).alias("w_len"),
        F.array().cast("array<string>").alias("w_words"), F.array().cast("array<string>").alias("w_items"),
    )
    build = windows.withColumn("w_hashes", w_hashes).select(hashed.alias("w_hash"), "w_len", "w_words", "w_items")
    build = build.unionByName(marker)

    words = docs.select(
        F.monotonically_increasing_id().alias("row"),
        docs["doc_id"],
        F.sha2(text_of(docs), 256).alias("text_key"),
        words_of(text_of(docs), ALNUM_WORD).alias("words"),
    )
    words = words.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))
    parts = [F.array(F.lit(0).cast("bigint") if small else F.pmod("row", F.lit(markers))), *[_hashes(F.col("hashes"), n) for n in lengths]]
    scanned = words.select(
        "row", "doc_id", "text_key", "words", F.size("words").alias("n_words"), F.concat(*parts).alias("scan")
    )
    # The outer form: for the other, Spark would test the array's size below, where it is computed anew for each element.
    entries = scanned.select("row", "doc_id", "text_key", "words", "n_words", F.posexplode_outer("scan").alias("i", "w_hash"))
    # Entry 0 is the marker; then come the windows of each length in turn.
    length, at, before = F.lit(0), F.lit(0), F.lit(1)
    for n in lengths:
        inside = F.col("i") >= before
        length, at = F.when(inside, n).otherwise(length), F.when(inside, F.col("i") - before).otherwise(at)
        before = before + F.greatest(F.col("n_words") - (n - 1), F.lit(0))
    same = F.col("w_len") == length
    if small:
        same = same & ((F.col("i") == 0) | (F.slice("words", at + 1, F.greatest(length, F.lit(1))) == F.col("w_words")))
        joined = entries.join(F.broadcast(build), [entries["w_hash"] == build["w_hash"], same])
    else:
        entries = entries.select(
            "row", "doc_id", "text_key", "n_words", "i", "w_hash",
            F.slice("words", at + 1, length).alias("own"),
        )
        joined = entries.join(build.hint("merge"), [entries["w_hash"] == build["w_hash"], F.col("own") == F.col("w_words")])
    hits = joined.select("row", "doc_id", "text_key", "n_words", "w_len", at.alias("at"), "w_items")
    ranges = F.collect_set(F.when(F.col("w_len") > 0, F.struct("at", (F.col("at") + F.col("w_len")).alias("end"))))
    per_row = hits.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"),
        F.first("text_key").alias("text_key"),
        F.first("n_words").alias("n_words"),
        F.array_sort(ranges).alias("ranges"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("w_items")))).alias("items"),
    )
    return per_row.withColumn("spans", _merged(F.col("ranges"))).select(
        "doc_id", F.col("n_words").cast("bigint").alias("n_words"), "spans",
        F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["at"]).alias("n_hit"),
        "items", "text_key",
    )


def _merged(ranges: Column) -> Column:
    """Sorted ranges as disjoint ones."""
    kind = "array<struct<at:int,end:int>>"

    def step(done: Column, r: Column) -> Column:
        last = F.element_at(done, -1)
        wider = F.struct(last["at"].alias("at"), F.greatest(last["end"], r["end"]).alias("end"))
        joined = F.concat(F.slice(done, 1, F.size(done) - 1), F.array(wider))
        return F.when((F.size(done) > 0) & (r["at"] <= F.try_element_at(done, F.lit(-1))["end"]), joined).otherwise(
            F.concat(done, F.array(r))
        )

    return F.aggregate(ranges, F.array().cast(kind), step)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """``docs`` without the rows whose text holds a benchmark window; columns and other rows stay as they are."""
    hit = contamination(docs, benchmark, width).where("n_hit > 0").select("text_key").distinct()
    hit = checkpointed(hit)
    if hit.count() <= MAX_BROADCAST_KEYS:
        hit = F.broadcast(hit)
    return docs.join(hit, F.sha2(text_of(docs), 256) == hit["text_key"], "left_anti")


def cut_spans(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """``docs`` with the hit words, and what stands before each, cut out of ``text``; nothing else changes."""
    own_names = hidden(docs, "key", "cuts")
    found = (
        contamination(docs, benchmark, width)
        .where("n_hit > 0")
        .select(F.col("text_key").alias(own_names["key"]), F.col("spans").alias(own_names["cuts"]))
        .dropDuplicates([own_names["key"]])
    )
    joined = docs.join(found, F.sha2(text_of(docs), 256) == found[own_names["key"]], "left")
    text, cuts = F.coalesce(F.col("text"), F.lit("")), F.col(own_names["cuts"])
    own, gaps = F.regexp_extract_all(text, F.lit(CASED_WORD), F.lit(0)), F.split(text, CASED_WORD, -1)
    kept = F.transform(
        own,
        lambda w, i: F.when(F.exists(cuts, lambda s: (s["at"] <= i) & (i < s["end"])), F.lit("")).otherwise(
            F.concat(F.get(gaps, i), w)
        ),
    )
    cut = F.concat(F.array_join(kept, ""), F.element_at(gaps, -1))
    return joined.withColumn("text", F.when(cuts.isNotNull(), cut).otherwise(F.col("text"))).select(*quoted(docs.columns))
