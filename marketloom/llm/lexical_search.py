"""Ranked lexical search (operator 11): Fagin's threshold algorithm on shards of the documents.

1. A pass over the documents builds the forward index, restricted to the items' terms: a
   shard is a row with the ids, lengths, terms and frequencies of some thousand documents.
   Document frequencies and lengths are summed from the shards; no document is shuffled.
2. In a shard the postings of every term are sorted by impact, highest first. For an item
   the lists of its terms are read round robin; documents that turn up get their whole score
   by a lookup in the forward index. The threshold is the score that the lists' next
   postings add up to, which no unseen document exceeds; reading stops when it falls
   strictly below the k-th score, so that ties are seen whole. The k best so far are carried
   from shard to shard of a task, and stop most shards early or before they begin.
3. The tasks' best are ranked once more.

Items are asked in blocks whose terms fit in memory, each block against all documents.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ALNUM_WORD, checkpointed, words_of

#: Terms (with repeats) of the items that are asked at a time; they are broadcast.
MAX_ITEM_TERMS = 1_000_000
#: A shard is closed when it has so many postings or documents.
SHARD_POSTINGS, SHARD_DOCS = 250_000, 65_536
#: Postings that are read from each list at first; every round reads twice as many.
FIRST_DEPTH = 8
#: Parts in which an item's results are ranked first.
PARTS = 32

_FORWARD = "docs bigint, words bigint, ids binary, no_id binary, lengths binary, starts binary, terms binary, counts binary, df_terms array<int>, df_counts array<bigint>"
#: Bytes of UTF-8 by what they are in a term: A-Z lower-cased, all that separates terms a space.
_TERM_BYTES = bytes(b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))


def terms_in(text: bytes) -> list[bytes]:
    """Terms of a text in UTF-8: runs of ASCII letters, digits and all that isn't ASCII, only A-Z lower-cased."""
    return text.translate(_TERM_BYTES).split()


class Shard:
    """A part of the forward index; ``impacts`` follow from the corpus' size and length."""

    def __init__(self, row: dict, size: int, length: int):
        self.ids, self.no_id = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["no_id"], np.bool_)
        self.starts, self.terms = np.frombuffer(row["starts"], np.int64), np.frombuffer(row["terms"], np.int32)
        counts, n = np.frombuffer(row["counts"], np.int64), np.frombuffer(row["lengths"], np.int64)
        self.lengths = np.diff(self.starts)
        doc = np.repeat(np.arange(len(n)), self.lengths)
        m = 100 - 75 + (75 * n * size) // length
        self.impacts = (1_000_000_000 * counts) // (1000 * counts + 8 * m[doc])
        order = np.lexsort((-self.impacts, self.terms))
        self.list_docs, self.list_impacts = doc[order], self.impacts[order]
        present, first = np.unique(self.terms[order], return_index=True)
        self.lists = dict(zip(present.tolist(), zip(first.tolist(), [*first[1:].tolist(), len(order)], strict=True), strict=True))

    def scores(self, docs: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Whole scores of documents, from their rows of the forward index."""
        n = self.lengths[docs]
        ends = np.cumsum(n)
        at = np.arange(ends[-1]) + np.repeat(self.starts[docs] - (ends - n), n)
        return np.add.reduceat(weights[self.terms[at]] * self.impacts[at], ends - n)


class Best:
    """The k best documents of an item so far: by score, then by id, those without id last."""

    def __init__(self, k: int):
        self.k, self.scores, self.ids, self.no_id = k, np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.bool_)

    @property
    def last(self) -> int:
        return int(self.scores[-1]) if len(self.scores) == self.k else 0

    def add(self, scores: np.ndarray, ids: np.ndarray, no_id: np.ndarray) -> None:
        good = scores >= max(self.last, 1)
        scores, ids, no_id = (np.concatenate([a, b[good]]) for a, b in ((self.scores, scores), (self.ids, ids), (self.no_id, no_id)))
        order = np.lexsort((ids, no_id, -scores))[: self.k]
        self.scores, self.ids, self.no_id = scores[order], ids[order], no_id[order]


def threshold_search(shard: Shard, terms: np.ndarray, own: np.ndarray, best: Best, weights: np.ndarray) -> int:
    """Put a shard's documents that belong among an item's best into ``best``; postings read.

    ``terms`` have the weights ``own`` in the item; ``weights`` is a table of zeros for all
    terms, that is given back as it was.
    """
    lists = [(*shard.lists[t], w) for t, w in zip(terms.tolist(), own.tolist(), strict=True) if w and t in shard.lists]
    if not lists:
        return 0
    weights[terms] = own
    seen, depth, step, read = np.zeros(len(shard.ids), np.bool_), 0, FIRST_DEPTH, 0
    while True:
        # The most that a document can score which none of the lists has shown yet.
        threshold = sum(w * int(shard.list_impacts[a + depth]) for a, z, w in lists if a + depth < z)
        if not threshold or threshold < best.last:
            break
        shown = np.concatenate([shard.list_docs[a + depth : min(a + depth + step, z)] for a, z, _ in lists if a + depth < z])
        read += len(shown)
        new = np.unique(shown[~seen[shown]])
        if len(new):
            seen[new] = True
            best.add(shard.scores(new, weights), shard.ids[new], shard.no_id[new])
        depth, step = depth + step, 2 * step
    weights[terms] = 0
    return read


def _forward_index(docs: DataFrame, vocabulary) -> DataFrame:
    """Shards of the documents that have a term; ``vocabulary`` is a broadcast dict from an item's term to its number."""

    def shard(rows: list[tuple]) -> dict:
        ids, lengths, terms, counts = zip(*rows, strict=True)
        sizes, all_terms = [len(t) for t in terms], np.concatenate(terms).astype(np.int32)
        df_terms, df_counts = np.unique(all_terms, return_counts=True)
        return {
            "docs": len(rows), "words": sum(lengths), "ids": np.array([i or 0 for i in ids], np.int64).tobytes(),
            "no_id": np.array([i is None for i in ids], np.bool_).tobytes(), "lengths": np.array(lengths, np.int64).tobytes(),
            "starts": np.cumsum([0, *sizes], dtype=np.int64).tobytes(), "terms": all_terms.tobytes(),
            "counts": np.concatenate(counts).astype(np.int64).tobytes(), "df_terms": df_terms, "df_counts": df_counts,
        }

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("docs", pa.int64()), ("words", pa.int64()), *[(c, pa.binary()) for c in ("ids", "no_id", "lengths", "starts", "terms", "counts")],
                            ("df_terms", pa.list_(pa.int32())), ("df_counts", pa.list_(pa.int64()))])
        numbers, held, postings = vocabulary.value, [], 0
        for batch in batches:
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                words = terms_in(text.as_py())
                if not words:
                    continue
                terms, counts = np.unique(np.array([numbers[w] for w in words if w in numbers], np.int32), return_counts=True)
                held.append((i, len(words), terms, counts))
                postings += len(terms)
                if postings >= SHARD_POSTINGS or len(held) >= SHARD_DOCS:
                    yield pa.RecordBatch.from_pylist([shard(held)], schema)
                    held, postings = [], 0
        if held:
            yield pa.RecordBatch.from_pylist([shard(held)], schema)

    rows = docs.where(docs["text"].isNotNull()).select(docs["doc_id"].cast("bigint").alias("doc_id"), docs["text"].cast("string").cast("binary").alias("text"))
    return checkpointed(rows.mapInArrow(shards, _FORWARD))


def _ranked_block(docs: DataFrame, asked: DataFrame, k: int) -> DataFrame | None:
    """(q, score, doc_id): more than enough of the best documents for a block of items (q, terms); None if no document has a term."""
    spark = docs.sparkSession
    items = [(r["q"], r["terms"]) for r in asked.collect()]  # MAX_ITEM_TERMS terms, or one item's
    numbers = {t.encode(): n for n, t in enumerate(sorted({t for _, terms in items for t in terms}))}
    vocabulary, n_terms = spark.sparkContext.broadcast(numbers), len(numbers)
    shards = _forward_index(docs, vocabulary)
    size, length = shards.agg(F.sum("docs"), F.sum("words")).first()
    if not size:
        return None
    found = shards.select(F.explode(F.arrays_zip("df_terms", "df_counts")).alias("t")).groupBy("t.df_terms").agg(F.sum("t.df_counts").alias("df"))
    df = dict(found.collect())  # a row for each of the block's terms
    weight = {n: math.floor(1000 * math.log((2 * size + 2) / (2 * f + 1))) for n, f in df.items()}
    coded = []
    for q, terms in items:
        own, times = np.unique([numbers[t.encode()] for t in terms], return_counts=True)
        coded.append((q, own, times * np.array([weight.get(t, 0) for t in own.tolist()], np.int64)))
    queries = spark.sparkContext.broadcast(coded)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, weights = [Best(k) for _ in queries.value], np.zeros(n_terms, np.int64)
        for batch in batches:
            for at in range(batch.num_rows):
                shard = Shard({c: batch.column(c)[at].as_py() for c in batch.schema.names}, size, length)
                for (_, terms, own), b in zip(queries.value, best, strict=True):
                    threshold_search(shard, terms, own, b, weights)
        for (q, _, _), b in zip(queries.value, best, strict=True):
            if len(b.scores):
                yield pa.RecordBatch.from_arrays([pa.array([q] * len(b.scores), pa.int64()), pa.array(b.scores), pa.array(b.ids, mask=b.no_id)], ["q", "score", "doc_id"])

    return shards.select("ids", "no_id", "lengths", "starts", "terms", "counts").mapInArrow(search, "q bigint, score bigint, doc_id bigint")


def rank(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` best documents of every item, scores above 0 only.

    ``docs`` has doc_id and text, ``items`` item_id and text; other columns are not used. A
    null text has no terms. Equal scores rank by ascending doc_id, rows without doc_id after
    them. Repeated rows of ``docs`` are documents of their own; rows of ``items`` with the
    same item_id and terms are one item, unlike texts of one item_id are ranked each by
    itself. Items without terms and empty tables give no rows.
    """
    terms = words_of(items["text"].cast("string"), ALNUM_WORD)
    asked = items.select("item_id", terms.alias("terms")).where(F.size("terms") > 0).distinct()
    asked = checkpointed(checkpointed(asked).withColumn("q", F.monotonically_increasing_id()))
    total = asked.agg(F.sum(F.size("terms"))).first()[0] or 0
    blocks = max(1, math.ceil(2 * total / MAX_ITEM_TERMS)) if total > MAX_ITEM_TERMS else 1
    parts = []
    for k_block in range(blocks if total else 0):
        block = asked.where(F.pmod(F.xxhash64("q"), F.lit(blocks)) == k_block)
        parts.append(None if block.isEmpty() else _ranked_block(docs, block, k))
    parts = [p for p in parts if p is not None]
    if not parts:
        return asked.selectExpr("item_id", "1 AS rank", "0L AS doc_id", "0L AS score").where(F.lit(False))
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    best = reduce(DataFrame.union, parts).withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(PARTS)))
    for keys in (["q", "part"], ["q"]):
        best = best.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= k)
    return best.join(asked.select("q", "item_id"), "q").select("item_id", "rank", "doc_id", "score")
