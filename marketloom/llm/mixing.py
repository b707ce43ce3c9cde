"""Mixing sources to target weights (operator 10) by systematic sampling, as DataFrame expressions only.

Within a source every document expects the same number of copies, target / source size.
Documents are laid out by size class and then by a hash of their id; the running sum of
expected copies, shifted by one random offset for the source, gives a copy for each whole
number that it passes. The order by size class makes the taken words follow the target
closely. The running sum is a count: buckets (source, size class, hash prefix) are counted
first, so a hot source is spread over many tasks.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE_WORD, checkpointed, hidden, quoted, text_of

#: No source is taken, and no document repeated, more often than this.
MAX_REPEATS = 3
SEED = "mix"


def size_class(size: Column) -> Column:
    """Sortable text: the number of binary digits, then the three that follow the first."""
    digits = F.bin(size)
    return F.concat(
        F.lpad(F.length(digits).cast("string"), 2, "0"), F.rpad(F.substring(digits, 2, 3), 3, "0")
    )


def source_targets(sources: DataFrame) -> DataFrame:
    """Targets of ``sources`` (source, source_size): every source gets its weight's share of all
    words, at most MAX_REPEATS times its own; what is above is shared again by weight.

    The number of sources is that of names, not of documents; they are ranked in one task.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sources.withColumn("weight", (F.row_number().over(by_name) - 1) % 3 + 1).withColumn(
        "cap", F.col("source_size") * MAX_REPEATS
    )
    # Sources reach their caps in the order of cap / weight: the level is that of the first which doesn't.
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before, all_rows = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    left = F.sum("source_size").over(all_rows) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    weights = F.sum("weight").over(all_rows) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    levels = ranked.withColumns({"place": F.row_number().over(order), "level": left.cast("double") / weights})
    open_place = F.when(F.col("cap") >= F.col("weight") * F.col("level"), F.col("place"))
    chosen = levels.withColumn("first_open", F.min(open_place).over(all_rows))
    chosen = chosen.withColumn("level", F.max(F.when(F.col("place") == F.col("first_open"), F.col("level"))).over(all_rows))
    target = F.when(F.col("place") >= F.col("first_open"), F.col("weight") * F.col("level")).otherwise(F.col("cap"))
    return chosen.select("source", "source_size", target.cast("double").alias("target"))


def mix(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """``docs`` with size, source_size, target and copies (0 to MAX_REPEATS) for every row.

    size counts the words of the text between white space, null as empty. A null source is
    a source of its own, the last one. Rows without words expect copies like the others of
    their source; a source without words has target 0 and no copies. Rows with equal ids
    are laid out by id, size and text hash, rows without one by text; equal rows are alike. An empty table stays
    empty. Own columns named like the new ones are replaced.
    """
    n = hidden(docs, "src", "cls", "ord", "hb", "first", "rate", "offset", "text_hash")
    new = ("size", "source_size", "target", "copies")
    kept = [c for c in docs.columns if c.lower() not in new]
    digits = max(1, math.ceil(math.log(max(math.sqrt(docs.count()) / 16, 1), 16)))
    sized = docs.select(
        *quoted(kept),
        F.regexp_count(text_of(docs), F.lit(SPACE_WORD)).cast("bigint").alias("size"),
        F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n")).alias(n["src"]),
        F.md5(F.coalesce(F.col("doc_id").cast("string"), text_of(docs))).alias(n["ord"]),
        F.xxhash64(text_of(docs)).alias(n["text_hash"]),
    ).withColumns({n["cls"]: size_class(F.col("size")), n["hb"]: F.substring(n["ord"], 1, digits)})
    keys = [n["src"], n["cls"], n["hb"]]
    buckets = sized.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"), F.sum("size").alias("words"), F.first("source").alias("source")
    )
    buckets = checkpointed(buckets)
    sources = buckets.groupBy(n["src"]).agg(F.sum("words").alias("source_size"), F.first("source").alias("source"))
    targets = source_targets(sources).withColumn(n["src"], F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n")))
    offset = F.conv(F.substring(F.md5(F.concat(F.lit(seed), n["src"])), 1, 8), 16, 10).cast("double") / float(2**32)
    targets = targets.select(
        n["src"], "source_size", "target", offset.alias(n["offset"]),
        F.coalesce(F.try_divide(F.col("target"), F.col("source_size")), F.lit(0.0)).alias(n["rate"]),
    )
    earlier = Window.partitionBy(n["src"]).orderBy(n["cls"], n["hb"]).rowsBetween(Window.unboundedPreceding, -1)
    starts = buckets.select(*keys, F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias(n["first"]))
    starts = starts.join(targets, n["src"])
    inside = Window.partitionBy(*keys).orderBy(n["ord"], "doc_id", "size", n["text_hash"])
    place = F.row_number().over(inside) + F.col(n["first"])
    passed = lambda k: F.floor(k * F.col(n["rate"]) + F.col(n["offset"]))
    # Buckets are many and small, so a large side can't be skewed by a source; the join keeps their layout.
    laid = sized.join(starts.hint("merge"), keys).withColumn(n["first"], place)
    copies = (passed(F.col(n["first"])) - passed(F.col(n["first"]) - 1)).cast("int").alias("copies")
    return laid.select(*quoted(kept), "size", "source_size", "target", copies)


def mixture(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """The mixed corpus itself: the columns of ``docs`` and copy_no (from 1), a row for every copy.

    An own column copy_no is replaced; others keep their values, whatever their names.
    """
    kept = [c for c in docs.columns if c.lower() != "copy_no"]
    clashing = [c for c in kept if c.lower() in ("size", "source_size", "target", "copies")]
    aside = hidden(docs, *clashing)
    mixed = mix(docs.select(*[F.col(q).alias(aside.get(c, c)) for c, q in zip(kept, quoted(kept), strict=True)]), seed)
    own = [F.col(q).alias(c) for c, q in zip(kept, quoted([aside.get(c, c) for c in kept]), strict=True)]
    return mixed.where("copies > 0").select(*own, F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy_no"))
