"""Document fingerprints (operator 12): MinHash signatures, their likeness, and near duplicates by bands.

A fingerprint is the signature of a text's set of five-word shingles under 128 universal hash
permutations x -> a x + b, taken in numpy over all shingles at once: of the least value under
each, 16 bits are kept. The share of places at which two fingerprints agree estimates the
Jaccard similarity of the sets.

``neighbours`` compares every document with the one after it and with its own text edited by
that one. Documents are dealt by ranges of doc_id, sorted and read as a stream in which
each waits for the next; only the last one of a range meets the first one of the next range
in a join.

``near_duplicates_by_bands`` joins documents that agree on a whole band of their signatures
and verifies the Jaccard similarity on the sets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import near_duplicates
from .common import checkpointed, text_of
from .near_duplicates import _mix, shingle_set

#: Words of a shingle, permutations, and bands that are joined: 32 of 4 rows miss a pair of similarity 0.8 once in 10^7.
SIZE, PERMUTATIONS, BANDS = 5, 128, 32
#: Shingles whose hashes are taken at a time, and bytes of texts that a task gives back at a time.
STEP, OUT_BYTES = 512, 4 << 20

_K = np.arange(1, 2 * PERMUTATIONS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
_A, _B = _mix(_K[:PERMUTATIONS]) | np.uint64(1), _mix(_K[PERMUTATIONS:])


def word_hashes(text: str) -> np.ndarray:
    """64-bit hashes of the words (anything but ASCII white space, A-Z lower-cased), the same that Spark's xxhash64 gives."""
    return np.array([xxhash.xxh64_intdigest(w, 42) for w in text.encode().lower().split()], np.uint64)


def signature(shingles: np.ndarray) -> bytes:
    """The fingerprint of a set of 64-bit shingle hashes; nothing for an empty set."""
    if not len(shingles):
        return b""
    x, least = shingles >> np.uint64(32), np.full(PERMUTATIONS, np.iinfo(np.uint64).max, np.uint64)
    for k in range(0, len(x), STEP):
        # Products wrap at 2^64: the upper half of a x + b is strongly universal for x of 32 bits.
        np.minimum(least, (np.multiply.outer(x[k : k + STEP], _A) + _B).min(axis=0), out=least)
    return (_mix(least) >> np.uint64(48)).astype(">u2").tobytes()


def fingerprint(text: str) -> bytes:
    return signature(shingle_set(word_hashes(text), SIZE))


def likeness(one: bytes, other: bytes) -> float:
    """The share of places at which two fingerprints agree; of sets without shingles, 1 for two and 0 for one."""
    if not one or not other:
        return float(one == other)
    return float(np.mean(np.frombuffer(one, np.uint16) == np.frombuffer(other, np.uint16)))


def edited(text: str, following: str) -> str:
    """The text with its second half (rounded down) replaced by as much of the beginning of the following one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


_FIELDS = "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double"
_SCHEMA = pa.schema([
    ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.binary()),
    ("edited_fingerprint", pa.binary()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
])
_EDGES = [("range", pa.int32()), ("edge", pa.int32()), ("text", pa.string())]
#: What a row of a range is: done, its last one (which waits for the next range's first), or its first.
DONE, LAST, FIRST = 0, 1, 2


def _compared(doc_id: int | None, text: str, own: bytes, following: str, next_own: bytes) -> dict:
    new = edited(text, following)
    new_print = own if new == text else fingerprint(new)
    return {
        "doc_id": doc_id, "n_chars": len(text), "edited_sha256": hashlib.sha256(new.encode()).hexdigest(), "fingerprint": own,
        "edited_fingerprint": new_print, "near_edited": likeness(own, new_print), "near_next": likeness(own, next_own),
    }


def _in_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A sorted range: every row compared with the next; the first and the last with their texts."""
    schema, place = pa.schema([*_SCHEMA, *_EDGES]), TaskContext.get().partitionId()
    held, out, n = None, [], 0
    for batch in batches:
        for doc_id, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            text = value.as_py()
            own = held[2] if held and held[1] == text else fingerprint(text)
            if held is None:
                out.append({"fingerprint": own, "range": place, "edge": FIRST, "text": text})
            else:
                out.append(_compared(*held, text, own) | {"range": place, "edge": DONE})
            held = (doc_id, text, own)
            n += len(text) if len(out) == 1 else 1000
            if n >= OUT_BYTES:
                yield pa.RecordBatch.from_pylist(out, schema)
                out, n = [], 0
    if held is not None:
        out.append({"doc_id": held[0], "fingerprint": held[2], "range": place, "edge": LAST, "text": held[1]})
        yield pa.RecordBatch.from_pylist(out, schema)


def _across_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [_compared(*(batch.column(c)[k].as_py() for c in range(5))) for k in range(batch.num_rows)]
        yield pa.RecordBatch.from_pylist(rows, _SCHEMA)


def neighbours(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and near_next of every row of ``docs``.

    The next document is that of the next doc_id, after the last one comes the first; rows of
    one doc_id are ordered by a hash of their texts, rows without doc_id come last. Of one row
    the next is itself. A null text is empty. Fingerprints are bytes, empty for a text
    without words; ``near_*`` are the likeness of the own fingerprint to that of the edited
    text and to the next document's. Other columns are not used; an empty table gives no rows.
    """
    text = text_of(docs)
    rows = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("hash"))
    # Equal rows differ by their place only, so that many of them are not one range.
    order = [F.asc_nulls_last("doc_id"), F.col("hash"), F.col("place")]
    rows = rows.withColumn("place", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)
    fields = f"{_FIELDS}, range int, edge int, text string"
    found = checkpointed(rows.select("doc_id", "text").mapInArrow(_in_ranges, fields))
    done = found.where(F.col("edge") == DONE).drop("range", "edge", "text")
    ranges = sorted(r["range"] for r in found.where(F.col("edge") == FIRST).select("range").collect())  # a number for each range
    if not ranges:
        return done
    after = docs.sparkSession.createDataFrame(list(zip(ranges, [*ranges[1:], ranges[0]], strict=True)), "range int, next_range int")
    last = found.where(F.col("edge") == LAST).join(F.broadcast(after), "range").select("next_range", "doc_id", "text", "fingerprint")
    first = found.where(F.col("edge") == FIRST).select(F.col("range").alias("next_range"), F.col("text").alias("following"), F.col("fingerprint").alias("next_own"))
    met = last.join(first, "next_range").select("doc_id", "text", "fingerprint", "following", "next_own")
    return done.union(met.mapInArrow(_across_ranges, _FIELDS))


def band_keys(shingles: np.ndarray, bands: near_duplicates.Bands | None = None) -> np.ndarray:
    """A number for each band of a set's signature; two sets of one in any band are compared."""
    rows = np.frombuffer(signature(shingles), ">u2").astype(np.uint64).reshape(BANDS, -1) if len(shingles) else np.empty((0, 1), np.uint64)
    value = np.arange(len(rows), dtype=np.uint64)
    for k in range(rows.shape[1]):
        value = _mix(value * np.uint64(0x9E3779B97F4A7C15) + rows[:, k])
    return value


def near_duplicates_by_bands(docs: DataFrame, num: int = 8, den: int = 10) -> DataFrame:
    """doc_id, n_shingles, component_id of every row: documents that share a band and whose Jaccard similarity, taken on
    the sets of five-word shingles, is num / den at least are linked; component_id is the smallest doc_id that links reach.

    Rows and nulls count as in ``near_duplicates.near_duplicates``, which finds its candidates without a miss instead.
    """
    return near_duplicates.near_duplicates(docs, SIZE, num, den, keys=band_keys)
