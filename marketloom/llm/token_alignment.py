"""Cross-tokenizer alignment (operator 13) with segments tokenised once.

Every text, with a space before it, is cut before white space into segments over which
neither vocabulary can merge (``Aligner`` verifies that on the vocabularies it reads), so the
tokens of a text are those of its segments.

1. Tasks gather their documents in chunks. The distinct segments of a chunk are tokenised by
   both and aligned once, each document is a row of their numbers. What is kept of a chunk is
   compressed; texts are not needed after that, and segments are in no shuffle.
2. A chunk counts for each pair of linked ids its documents that hold it; the counts are
   summed over the corpus and joined back to the chunks that hold the pair.
3. With them the chunks' documents are composed from their segments.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, text_of

#: Code points and documents of a chunk.
CHUNK_CHARS, CHUNK_DOCS = 8_000_000, 50_000
#: Segments that a worker remembers from chunk to chunk, about.
TABLE = 200_000
#: Segments that are tokenised at a time, pairs and bytes of text that a task gives back at a time.
ENCODED, OUT_ROWS, OUT_BYTES = 2000, 50_000, 4 << 20
#: A link is a number: its A id, its B id, and two bits that tell whether A's or B's token ends there.
ID_BITS = 30

#: Before a space that stands after anything but white space.
_CUT = re.compile(r"(?<=\S)(?= )")


def segments_of(text: str) -> list[str]:
    """The text with a space before it, cut before white space. Every segment begins with a space and holds more than that."""
    found = _CUT.split(f" {text}")
    if len(found) > 1 and found[-1] == " ":
        found[-2:] = [f"{found[-2]} "]
    return found


class Aligner:
    """A byte-level tokenizer file (A) and a piece model (B), and the groups of their tokens.

    It raises ValueError for vocabularies that can merge over the cuts: A must cut texts
    before white space by its own pre-tokenizer and change nothing else, and B must have no
    piece with its space mark behind another character.
    """

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        with open(path_a, encoding="utf-8") as file:
            parts = json.load(file)
        before = parts["pre_tokenizer"] or {}
        if before.get("type") != "ByteLevel" or not before.get("use_regex") or before.get("add_prefix_space") or parts["normalizer"]:
            raise ValueError(f"{path_a} does not cut texts before white space as they are")
        self.a, self.b = Tokenizer.from_file(path_a), sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.a.encode_special_tokens = True
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any("▁" in p.lstrip("▁") for p in pieces):
            raise ValueError(f"{path_b} has pieces that go on over a space")
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        # The letters that stand for bytes: printable ones of Latin-1 for themselves, the others from U+0100 on.
        plain = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b]
        letters = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in set(plain))}
        by_id = {i: bytes(letters[c] for c in t) for t, i in parts["model"]["vocab"].items() if all(c in letters for c in t)}
        self.bytes_a = [by_id.get(i, b"") for i in range(max(by_id) + 1)]
        #: Links of segments that a chunk of this worker held several times.
        self.known: dict[str, list[int]] = {}

    def tokens(self, segments: list[str]) -> list[tuple[list[int], list[int]]]:
        """Ids of A and B for each segment; B puts the first space there itself."""
        a = self.a.encode_batch_fast(segments, add_special_tokens=False)
        return list(zip([e.ids for e in a], self.b.encode([s[1:] for s in segments], num_threads=1), strict=True))

    def links(self, segment: str, a: list[int], b: list[int]) -> list[int]:
        """A link for every pair of tokens that overlap, in order; none where a tokenizer doesn't give the segment back."""
        own, texts_a, texts_b = segment.encode(), [self.bytes_a[i] for i in a], [self.bytes_b[i] for i in b]
        if b"".join(texts_a) != own or b"".join(texts_b) != own:
            return []
        if len(a) == len(b) == 1:
            return [(a[0] << ID_BITS | b[0]) << 2 | 3]
        out, i, j, end_a, end_b = [], 0, 0, len(texts_a[0]), len(texts_b[0])
        while True:
            pair = a[i] << ID_BITS | b[j]
            if end_a == end_b:
                out.append(pair << 2 | 3)
                i, j = i + 1, j + 1
                if i == len(a):
                    return out
                end_a, end_b = end_a + len(texts_a[i]), end_b + len(texts_b[j])
            elif end_a < end_b:
                out.append(pair << 2 | 1)
                i += 1
                end_a += len(texts_a[i])
            else:
                out.append(pair << 2 | 2)
                j += 1
                end_b += len(texts_b[j])


def groups_text(links: list[int]) -> str:
    """A segment's groups of ids, ``a1,a2|b1;a3|b2,b3``."""
    groups, a, b, mask = [], [], [], (1 << ID_BITS) - 1
    for link in links:
        if link & 1:
            a.append(str(link >> ID_BITS + 2))
        if link & 2:
            b.append(str(link >> 2 & mask))
        if link & 3 == 3:
            groups.append(f"{','.join(a)}|{','.join(b)}")
            a, b = [], []
    return ";".join(groups)


def squeezed(numbers: np.ndarray) -> bytes:
    """Numbers as compressed bytes, equal places of all of them side by side."""
    return zstandard.compress(numbers.view(np.uint8).reshape(len(numbers), -1).T.tobytes()) if len(numbers) else b""


def restored(data: bytes, kind: type) -> np.ndarray:
    if not data:
        return np.empty(0, kind)
    flat = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(flat.T).view(kind)[:, 0]


def _sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of runs of ``values``, which have the given sizes."""
    total = np.concatenate([[0], np.cumsum(values)])
    ends = np.cumsum(sizes)
    return total[ends] - total[ends - sizes]


def _members(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places start, start + 1, ... of runs, one run after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


#: What is kept of a chunk: documents' ids, whether they have one, and their segments' numbers, by document; links by segment;
#: distinct pairs of ids, and the chunk's documents that hold them.
_KEPT = {"ids": np.int64, "named": np.bool_, "lengths": np.int64, "numbers": np.uint32, "n_links": np.uint32, "links": np.int64, "pairs": np.int64, "docs": np.int64}

_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def _chunk(aligner: Aligner, segments: list[str], held: list[tuple]) -> dict:
    """A chunk of documents (id, numbers of segments)."""
    numbers = [np.array(x, np.uint32) for _, x in held]
    links = [aligner.known.get(s) for s in segments]
    new = [k for k, v in enumerate(links) if v is None]
    for at in range(0, len(new), ENCODED):
        part = [segments[k] for k in new[at : at + ENCODED]]
        for k, s, ids in zip(new[at : at + ENCODED], part, aligner.tokens(part), strict=True):
            links[k] = aligner.links(s, *ids)
    if len(aligner.known) > TABLE:
        aligner.known.clear()
    often = np.bincount(np.concatenate(numbers), minlength=len(segments)) > 2
    aligner.known.update((segments[k], links[k]) for k in new if often[k])
    n_links = np.array([len(x) for x in links], np.int64)
    all_links, starts = np.array([v for x in links for v in x], np.int64), np.cumsum(n_links) - n_links
    found, pairs, docs, n = [], np.empty(0, np.int64), np.empty(0, np.int64), 0
    for k in range(len(held)):
        own = np.unique(numbers[k])
        if len(own) and n_links[own].all():
            found.append(np.unique(all_links[_members(starts[own], n_links[own])] >> 2))
            n += len(found[-1])
        if found and (n >= OUT_ROWS * 40 or k + 1 == len(held)):
            pairs, at = np.unique(np.concatenate([pairs, *found]), return_inverse=True)
            docs = np.bincount(at, np.concatenate([docs, np.ones(n, np.int64)]), len(pairs)).astype(np.int64)
            found, n = [], 0
    kept = {
        "ids": np.array([i or 0 for i, _ in held], np.int64), "named": np.array([i is not None for i, _ in held], np.bool_),
        "lengths": np.array([len(x) for x in numbers], np.int64), "numbers": np.concatenate(numbers), "n_links": n_links.astype(np.uint32),
        "links": all_links, "pairs": pairs, "docs": docs,
    }
    return {name: squeezed(v) for name, v in kept.items()}


def _chunks(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """A row for each chunk, with what is kept of it."""
    schema = pa.schema([("chunk", pa.int64()), *[(name, pa.binary()) for name in _KEPT]])

    def chunked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if (path_a, path_b) not in _ALIGNERS:
            _ALIGNERS[path_a, path_b] = Aligner(path_a, path_b)
        aligner, at, known, held, n = _ALIGNERS[path_a, path_b], TaskContext.get().partitionId() << 33, {}, [], 0
        for batch in batches:
            for doc_id, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                text = value.as_py()
                held.append((doc_id, [known.setdefault(s, len(known)) for s in segments_of(text)] if text else []))
                n += len(text)
                if n >= CHUNK_CHARS or len(held) >= CHUNK_DOCS:
                    yield pa.RecordBatch.from_pylist([{"chunk": at} | _chunk(aligner, list(known), held)], schema)
                    at, known, held, n = at + 1, {}, [], 0
        if held:
            yield pa.RecordBatch.from_pylist([{"chunk": at} | _chunk(aligner, list(known), held)], schema)

    rows = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), text_of(docs).alias("text"))
    return checkpointed(rows.mapInArrow(chunked, "chunk bigint, " + ", ".join(f"{name} binary" for name in _KEPT)))


def _pairs(chunks: DataFrame) -> DataFrame:
    """chunk, pair, docs."""

    def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                pairs, docs = (restored(batch.column(c)[k].as_py(), np.int64) for c in (1, 2))
                for m in range(0, len(pairs), OUT_ROWS):
                    own = pairs[m : m + OUT_ROWS]
                    columns = [pa.array([batch.column(0)[k].as_py()] * len(own), pa.int64()), pa.array(own), pa.array(docs[m : m + OUT_ROWS])]
                    yield pa.RecordBatch.from_arrays(columns, ["chunk", "pair", "docs"])

    return chunks.select("chunk", "pairs", "docs").mapInArrow(unpacked, "chunk bigint, pair bigint, docs bigint")


SUMS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
_OUT = pa.schema([("doc_id", pa.int64()), *[(c, pa.int64()) for c in SUMS], ("groups", pa.string())])


def _documents(kept: dict[str, np.ndarray], counts: np.ndarray, best: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The documents of a chunk; counts and marks of its pairs are in the pairs' order."""
    n_links, links, lengths, numbers = kept["n_links"].astype(np.int64), kept["links"], kept["lengths"], kept["numbers"]
    at, ends = np.searchsorted(kept["pairs"], links >> 2), links & 3
    # Segments that a tokenizer changes have no links and are in no counted pair.
    at = np.minimum(at, max(len(counts) - 1, 0))
    known = [ends & 1, ends >> 1, ends == 3, np.ones(len(links), np.int64), best[at] if len(best) else ends, counts[at] if len(counts) else ends]
    whole = _sums((n_links == 0)[numbers].astype(np.int64), lengths) == 0
    columns = [np.where(whole, _sums(_sums(v.astype(np.int64), n_links)[numbers], lengths), 0) for v in known]
    flat, last = links.tolist(), np.cumsum(n_links).tolist()
    texts = [groups_text(flat[a:b]) for a, b in zip([0, *last], last, strict=False)]
    out, first, n, until = [], 0, 0, np.cumsum(lengths)
    for k in range(len(lengths)):
        out.append(";".join([texts[i] for i in numbers[until[k] - lengths[k] : until[k]].tolist()]) if whole[k] else "")
        n += 100 + len(out[-1])
        if n >= OUT_BYTES or k + 1 == len(lengths):
            rows = slice(first, k + 1)
            arrays = [pa.array(kept["ids"][rows], mask=~kept["named"][rows]), *[pa.array(c[rows]) for c in columns], pa.array(out, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, schema=_OUT)
            out, first, n = [], k + 1, 0


def _composed(chunks: DataFrame, counted: DataFrame) -> DataFrame:
    """The documents of all chunks; ``counted`` has chunk, pair, count and best of every pair of a chunk."""

    def compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, kept, counts, best = None, None, [], []

        def done() -> Iterator[pa.RecordBatch]:
            if kept is not None:
                none = np.empty(0, np.int64)
                yield from _documents(kept, np.concatenate([none, *counts]), np.concatenate([none, *best]))

        for batch in batches:
            own = batch.column(0).to_numpy()
            for k in np.flatnonzero(np.r_[True, own[1:] != own[:-1]]).tolist():
                n = int(np.searchsorted(own[k:] != own[k], True)) if (own[k:] != own[k]).any() else len(own) - k
                part = batch.slice(k, n)
                if own[k] != chunk:
                    yield from done()
                    chunk, counts, best = own[k], [], []
                    kept = {name: restored(part.column(3 + c)[0].as_py(), kind) for c, (name, kind) in enumerate(_KEPT.items())}
                    part = part.slice(1)
                counts.append(part.column(1).to_numpy(zero_copy_only=False))
                best.append(part.column(2).to_numpy(zero_copy_only=False))
        yield from done()

    # A chunk's own row comes first, then its pairs in order.
    rows = chunks.withColumns({"pair": F.lit(-1).cast("bigint")}).unionByName(counted, allowMissingColumns=True)
    rows = rows.repartition("chunk").sortWithinPartitions("chunk", "pair").select("chunk", "count", "best", *_KEPT)
    return rows.mapInArrow(compose, "doc_id bigint, " + ", ".join(f"{c} bigint" for c in SUMS) + ", groups string")


def align_documents(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups of every row of ``docs``.

    ``path_a`` names a byte-level tokenizer file and ``path_b`` a piece model, on every node.
    Tokens are those of the text with a space before it (which B puts there itself), without
    special ones; strings like them are plain text. ``groups`` is ``a1,a2|b1;a3|b2,b3``: the
    ids between places where tokens of both end. Links are all pairs of tokens whose bytes
    overlap; the count of a pair of ids is that of the documents (rows) that hold it
    linked, ``count_sum`` adds them over the links, ``n_best`` are links of the highest count
    of their A id. A null or empty text, and one that a tokenizer doesn't give back as it
    is, has no tokens: zeros and an empty ``groups``. Repeated rows give a row each and count
    each; other columns are not used; an empty table gives no rows.
    """
    chunks = _chunks(docs, path_a, path_b)
    pairs = _pairs(chunks)
    counts = checkpointed(pairs.groupBy("pair").agg(F.sum("docs").alias("count")).withColumn("a", F.shiftright("pair", ID_BITS)))
    most = counts.groupBy("a").agg(F.max("count").alias("most"))
    counts = counts.join(most, "a").select("pair", "count", (F.col("count") == F.col("most")).cast("bigint").alias("best"))
    return _composed(chunks, pairs.select("chunk", "pair").join(counts, "pair"))
