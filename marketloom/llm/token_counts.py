"""Token counts of whole texts (operator 3) with overlap resynchronisation of huge documents.

A text is encoded in chunks that overlap. The encoding of a chunk is kept as offsets: the
ends of its pieces and the tokens before each end. A piece ends before a space that stands
between two other characters than white space. The pre-tokeniser cuts there whatever stands
around: its tokens hold a space in front of other characters at most, or white space only,
and the added token has no space in it. So such an end is a stable boundary for every
context, and two chunks that overlap are spliced at one that both have. Where an overlap
holds none, it is widened.

Pieces don't depend on their surroundings, so the library encodes each distinct one once
for a worker's table of bounded size.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from itertools import accumulate

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Characters in a chunk, and in the first overlap.
CHUNK, OVERLAP = 1 << 16, 256
#: Pieces that a worker remembers, and the longest that it does.
TABLE, LONGEST = 500_000, 64


class Counter:
    """Counts tokens with the library for a tokenizer file that uses byte-level pre-tokenisation."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[str, int] = {}

    def learn(self, parts: set[str]) -> bool:
        """Remember the tokens of each part with a space before it; False if a part can't follow a stable boundary."""
        if any(not p or p[0].isspace() or p[-1].isspace() or len(p) > LONGEST for p in parts):
            return False
        if len(self.known) + len(parts) > TABLE:
            self.known.clear()
        parts = list(parts)
        encoded = self.tokenizer.encode_batch_fast([f" {p}" for p in parts], add_special_tokens=False)
        self.known.update(zip(parts, map(len, encoded), strict=True))
        return True

    def alone(self, piece: str) -> int:
        return len(self.tokenizer.encode(piece, add_special_tokens=False))

    def pieces(self, text: str) -> tuple[list[str], list[int]]:
        """The text cut at its stable boundaries, and the tokens of each piece."""
        head, *parts = text.split(" ")
        if not head or head[-1].isspace() or not self.learn(set(parts).difference(self.known)) or not self.known.keys() >= set(parts):
            return self.odd_pieces(head, parts)
        return [head, *[f" {p}" for p in parts]], [self.alone(head), *map(self.known.__getitem__, parts)]

    def odd_pieces(self, head: str, parts: list[str]) -> tuple[list[str], list[int]]:
        """The same where white space stands beside a space, or where a part is too long to remember."""
        out = [head]
        for p in parts:
            if p and out[-1] and not p[0].isspace() and not out[-1][-1].isspace():
                out.append(f" {p}")
            else:
                out[-1] += f" {p}"
        encoded = self.tokenizer.encode_batch_fast(out, add_special_tokens=False)
        return out, list(map(len, encoded))

    def encode(self, text: str) -> tuple[list[int], list[int]]:
        """Offsets of the stable boundaries of a chunk, its end included, and the tokens before each."""
        pieces, counts = self.pieces(text)
        return list(accumulate(map(len, pieces))), list(accumulate(counts))

    def count(self, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
        """Tokens of a text of any length, by chunks."""
        start, total, wide = 0, 0, overlap
        while len(text) - start > chunk + wide:
            left_end, right_start = start + chunk + wide, start + chunk
            left = self.encode(text[start:left_end])
            right = self.encode(text[right_start : right_start + 2 * wide])
            # Boundaries inside the overlap that both encodings have: not at the chunks' own ends.
            own = {right_start + e for e in right[0][:-1]}
            at = next((i for i, e in enumerate(left[0][:-1]) if e + start > right_start and e + start in own), None)
            if at is None:
                wide *= 2
                continue
            total += left[1][at]
            start, wide = start + left[0][at], overlap
        return total + sum(self.pieces(text[start:])[1])


_COUNTERS: dict[str, Counter] = {}


def token_counts(docs: DataFrame, path: str, limit: int = 512) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens and over_limit (n_tokens > limit) for every row of ``docs``.

    ``path`` names a byte-level tokenizer file that is on every node. A null text is empty
    and has no tokens; nothing is truncated; special strings in a text count as the library
    counts them by default. Repeated rows give a row each, other columns are not used.
    """

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counter = _COUNTERS.setdefault(path, None) or Counter(path)
        _COUNTERS[path] = counter
        for batch in batches:
            n = [counter.count(t) for t in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "n_bytes": batch["n_bytes"], "n_tokens": n})

    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    rows = docs.select(docs["doc_id"], text.alias("text"), F.octet_length(text).cast("bigint").alias("n_bytes"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    out = rows.mapInPandas(counted, f"doc_id {kind}, n_bytes bigint, n_tokens bigint")
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
