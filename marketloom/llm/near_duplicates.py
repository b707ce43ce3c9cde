"""N-gram Jaccard join (operator 7): parity sketches, a pigeonhole join per size band, exact checks.

1. Every text becomes its set of shingles (64-bit hashes). A set is named by 64 bits of a
   digest of 256, so rows with one set are one class from the start, and has a narrow parity
   sketch. Where unlike sets share a name, other bits of their digests name them.
2. If two sets are similar enough, their symmetric difference is at most ``d`` for the size
   band of the smaller one. A sketch has somewhat more than d + 1 blocks of parity bits; a
   shingle flips one bit, so what sets share cancels and a block must be equal. Equal blocks are
   found by a shuffle on (band, block, value), where members of a bucket link to its first;
   each task links its own members before, so that a bucket gets few rows from each.
3. Of these links, one for each set (that of most common blocks whose narrow sketches allow it) is
   checked on the sets themselves. Most of what belongs together is joined by that.
4. Buckets that still hold several components (one for each set of members) are compared, across
   components only: the Hamming distance of the narrow sketches, a lower bound of the symmetric
   difference, drops nearly all pairs. What is left is passed on by the first bucket it stands
   in and checked on the sets.
5. The components of the checked links are the groups.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE_WORD, ascii_lower, checkpointed, hidden, quoted, small_batches, text_of
from .components import component_roots

#: Members of a bucket that are compared in one task at most, and partners of a set that are checked in one.
TILE_MEMBERS, HUB_PAIRS = 4096, 256
#: At most so many rows (some 60 bytes each) that name documents are broadcast; more are joined by a shuffle.
MAX_BROADCAST_IDS = 200_000
#: Arrow batches that our functions give hold about so many shingles; block keys of so many are linked within a task.
OUT_SHINGLES, HELD_KEYS = 1_000_000, 1_000_000
#: Rows and bytes that go to Python at a time, block keys that come back at a time, and bytes of sketches compared at a time.
BATCH_ROWS, BATCH_BYTES, BATCH_KEYS, HELD_BYTES = 2000, 8 << 20, 50_000, 1 << 20
#: Pairs whose sketches are compared at a time, and how many of its buckets a set knows, to leave a pair to an earlier one.
HELD_PAIRS, FIRST_KEYS = 500_000, 6


def _mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of SplitMix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``size`` words; of the whole sequence if there are fewer."""
    words = words.view(np.uint64)
    n = len(words)
    if not n:
        return words
    run, count = min(size, n), max(n - size + 1, 1)
    h = np.full(count, run, np.uint64)
    for k in range(run):
        h = _mix(h * np.uint64(0x9E3779B97F4A7C15) + words[k : k + count])
    return np.unique(h)


class Bands:
    """Size bands for a threshold num / den: partners lie in the same band or in the next."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den
        self.starts = [1]
        while self.starts[-1] < 2**40:
            self.starts.append(self.starts[-1] * den // num + 1)
        #: The largest symmetric difference of linked sets, the smaller of which is in the band.
        self.limits = [self.limit(e - 1, (e - 1) * den // num) for e in self.starts[1:]]

    def limit(self, a: int, b: int) -> int:
        return (a + b) * (self.den - self.num) // (self.den + self.num)

    def of(self, n: int) -> list[int]:
        """Bands in which a set of n shingles has partners with another set."""
        if not n:
            return []
        own = int(np.searchsorted(self.starts, n, "right")) - 1
        below = own and n * self.num <= self.den * (self.starts[own] - 1)
        return [k for k in ([own - 1, own] if below else [own]) if self.limits[k]]


def sketch(shingles: np.ndarray, bands: Bands) -> bytes:
    """Parity sketch of one set, of at least four bits for each shingle that may differ.

    Its length is a power of two, so that a longer one is folded to a shorter one by XOR.
    """
    n = len(shingles)
    bits = 1 << max(6, (4 * bands.limit(n, n * bands.den // bands.num)).bit_length())
    at = (_mix(shingles) & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=bits) & 1).astype(np.uint8)).tobytes()


def _sparse_blocks(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A fingerprint for each block of a sketch whose blocks have 2^40 bits, few of them set.

    A hash flips the bit of its lower 40 bits, in the block of its upper ones. The
    fingerprint is the XOR of the mixed positions, in which two flips of a bit cancel too.
    So few shingles are enough to tell blocks apart, which 64 bits would not be.
    """
    order = np.argsort((hashes >> np.uint64(24)) % np.uint64(len(counts)), kind="stable")
    bits = _mix(hashes[order] & np.uint64(2**40 - 1))
    value, full = np.zeros(len(counts), np.uint64), counts > 0
    value[full] = np.bitwise_xor.reduceat(bits, (np.cumsum(counts) - counts)[full])
    return value


def block_keys(shingles: np.ndarray, bands: Bands) -> np.ndarray:
    """A number for each (band, block, value) of one set that another set may meet.

    There are a quarter more blocks than d + 1, and a set uses those that hold most of its
    shingles, all of at least some count, d + 1 at least. One of these is untouched by a
    difference of d; the other set has the same shingles in it, and uses it too, since a
    set with a lower count uses more. So nearly empty blocks, which unlike sets share, are
    left out and no link is lost. Numbers have 48 bits: two unlike blocks that get one cost a
    comparison, no more.
    """
    found = [np.empty(0, np.uint64)]
    for k in bands.of(len(shingles)):
        need = bands.limits[k] + 1
        blocks = need + need // 4 + 1
        counts = np.bincount(((shingles >> np.uint64(24)) % np.uint64(blocks)).astype(np.int64), minlength=blocks)
        used = np.flatnonzero(counts >= np.partition(counts, blocks - need)[blocks - need])
        value = _sparse_blocks(shingles, counts)[used]
        place = used.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(k + 1)
        found.append(_mix(_mix(value) + place) >> np.uint64(16))
    return np.concatenate(found)


def _lists(column: pa.Array) -> Iterator[np.ndarray]:
    ends, values = column.offsets.to_numpy(), column.values.to_numpy()
    return (values[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True))


def _as_lists(arrays: list[np.ndarray]) -> pa.ListArray:
    ends = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    return pa.ListArray.from_arrays(ends, np.concatenate([np.empty(0, np.uint64), *arrays]).view(np.int64))


class Sketches:
    """A column of narrow sketches, and the sizes of their sets."""

    def __init__(self, sizes: pa.Array, column: pa.Array):
        ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
        self.starts, self.widths = ends[:-1], np.diff(ends)
        self.data, self.sizes = np.frombuffer(column.buffers()[2] or b"", np.uint8), sizes.to_numpy()

    def rows(self, at: np.ndarray, width: int, to: int) -> np.ndarray:
        """Sketches of ``width`` bytes, folded to ``to`` bytes, as 64-bit numbers."""
        x = self.data[self.starts[at][:, None] + np.arange(width)].view(np.uint64)
        return np.bitwise_xor.reduce(x.reshape(len(at), width // to, to // 8), axis=1)


def may_link(one: Sketches, i: np.ndarray, other: Sketches, j: np.ndarray, bands: Bands) -> np.ndarray:
    """Whether the rows i of ``one`` and j of ``other`` can be similar enough, by their sizes and sketches."""
    n, m = one.sizes[i], other.sizes[j]
    good = np.minimum(n, m) * bands.den >= np.maximum(n, m) * bands.num
    most = (n + m) * (bands.den - bands.num) // (bands.den + bands.num)
    widths = one.widths[i] * 2**32 + other.widths[j]
    for both in np.unique(widths[good]).tolist():
        w, v = divmod(both, 2**32)
        chosen, step = np.flatnonzero(good & (widths == both)), max(1, HELD_BYTES // max(w, v))
        for k in range(0, len(chosen), step):
            c = chosen[k : k + step]
            x, y = one.rows(i[c], w, min(w, v)), other.rows(j[c], v, min(w, v))
            good[c] = np.bitwise_count(x ^ y).sum(axis=1, dtype=np.int64) <= most[c]
    return good


def similar(a: np.ndarray, b: np.ndarray, bands: Bands) -> bool:
    """Whether the Jaccard similarity of two sorted sets is num / den at least."""
    both = int(np.count_nonzero(a[np.minimum(np.searchsorted(a, b), len(a) - 1)] == b))
    return both * bands.den >= (len(a) + len(b) - both) * bands.num


def _word_hashes(docs: DataFrame) -> Column:
    words = F.regexp_extract_all(ascii_lower(text_of(docs)), F.lit(SPACE_WORD), F.lit(0))
    return F.transform(words, lambda w: F.xxhash64(w))


#: 256 bits that tell a set.
Digest = Callable[[np.ndarray], bytes]


def set_digest(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=32).digest()


class Names:
    """Names of sets: the first 64 bits of the digest that are not ``taken``, which are those that unlike sets share."""

    def __init__(self, digest: Digest, taken: frozenset[int] = frozenset()):
        self.digest, self.taken = digest, taken

    def of(self, shingles: np.ndarray) -> tuple[int, int]:
        """The name, and 64 other bits to tell the set by."""
        parts = np.frombuffer(self.digest(shingles), np.int64).tolist()
        return next((x for x in parts[:3] if x not in self.taken), parts[2]), parts[3]


def _named(docs: DataFrame, size: int, bands: Bands, digest: Digest) -> tuple[DataFrame, Names]:
    """Of every row: doc_id, text (its hash), n, node (the name of its set) and sketch, these null for an empty set; and the names.

    Of 10^10 sets some three pairs share a name at first; those names are fetched, and the sets named anew.
    """
    rows = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), F.xxhash64(text_of(docs)).alias("text"), _word_hashes(docs).alias("words"))
    names = Names(digest)
    while True:
        out = checkpointed(rows.mapInArrow(_namer(size, bands, names), "doc_id bigint, text bigint, n bigint, node bigint, mark bigint, sketch binary"))
        shared = out.where("n > 0").groupBy("node").agg(F.min("mark").alias("a"), F.max("mark").alias("b")).where("a <> b")
        found = {r["node"] for r in shared.select("node").collect()}
        if found <= names.taken:
            return out.drop("mark"), names
        names = Names(digest, names.taken | found)


def _namer(size: int, bands: Bands, names: Names) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(words, size) for words in _lists(batch.column(2))]
            both = [names.of(s) if len(s) else (None, None) for s in sets]
            found = [[len(s) for s in sets], [b[0] for b in both], [b[1] for b in both]]
            sketches = pa.array([sketch(s, bands) if len(s) else None for s in sets], pa.binary())
            columns = [*batch.columns[:2], *[pa.array(x, pa.int64()) for x in found], sketches]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text", "n", "node", "mark", "sketch"])

    return named


#: A set's numbers of the buckets where it meets others.
Keys = Callable[[np.ndarray, Bands], np.ndarray]


def _members(docs: DataFrame, size: int, bands: Bands, keys_of: Keys, names: Names) -> DataFrame:
    """(key, node): the sets of each bucket of two or more."""

    def linked(keys: np.ndarray, nodes: np.ndarray) -> pa.RecordBatch:
        """The first member of each key (b is null), and the others with that one."""
        order = np.lexsort((nodes, keys))
        keys, nodes = keys[order], nodes[order]
        new = np.r_[True, (keys[1:] != keys[:-1]) | (nodes[1:] != nodes[:-1])]
        keys, nodes = keys[new], nodes[new]
        first = np.r_[True, keys[1:] != keys[:-1]]
        before = nodes[np.maximum.accumulate(np.where(first, np.arange(len(keys)), 0))]
        back = np.argsort(order[new])  # rows of one set beside each other are compressed better
        arrays = [pa.array(nodes[back]), pa.array(keys[back]), pa.array(before[back], mask=first[back])]
        return pa.RecordBatch.from_arrays(arrays, ["a", "key", "b"])

    def parts(keys: list[np.ndarray], nodes: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        batch = linked(np.concatenate(keys), np.concatenate(nodes))
        yield from (batch.slice(k, BATCH_KEYS) for k in range(0, batch.num_rows, BATCH_KEYS))

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, nodes, n = [], [], 0
        for batch in batches:
            for words in _lists(batch.column(0)):
                s = shingle_set(words, size)
                own = keys_of(s, bands).view(np.int64)
                keys.append(own)
                nodes.append(np.full(len(own), names.of(s)[0] if len(own) else 0, np.int64))
                n += len(own)
                if n >= HELD_KEYS:
                    yield from parts(keys, nodes)
                    keys, nodes, n = [], [], 0
        if n:
            yield from parts(keys, nodes)

    own = docs.where(docs["doc_id"].isNotNull()).select(_word_hashes(docs).alias("words"))
    # What a task has linked goes anywhere; its first members meet those of other tasks.
    found = own.mapInArrow(blocks, "a bigint, key bigint, b bigint")
    found = found.withColumn("place", F.when(F.col("b").isNull(), F.lit(0)).otherwise(F.xxhash64("a")))
    first = F.min("a").over(Window.partitionBy("key", "place"))
    found = found.select("key", "a", F.coalesce("b", first).alias("b")).where("a <> b")
    return checkpointed(found.select("key", F.explode(F.array("a", "b")).alias("node")).distinct())


def _likely(members: DataFrame, classes: DataFrame, bands: Bands) -> DataFrame:
    """(a, b): for each set that first member of its buckets with most of them among those that the sketches allow."""

    def allowed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            all_rows = np.arange(batch.num_rows)
            one, other = Sketches(batch.column(3), batch.column(4)), Sketches(batch.column(5), batch.column(6))
            yield batch.select([0, 1, 2]).filter(pa.array(may_link(one, all_rows, other, all_rows, bands)))

    first = checkpointed(members.groupBy("key").agg(F.min("node").alias("b")))
    pairs = members.join(first, "key").where("node <> b").groupBy(F.col("node").alias("a"), "b").agg(F.count(F.lit(1)).alias("blocks"))
    ends = [classes.select(F.col("node").alias(e), F.col("n").alias(f"n_{e}"), F.col("sketch").alias(f"sketch_{e}")) for e in "ab"]
    pairs = pairs.join(ends[0], "a").join(ends[1], "b").select("a", "b", "blocks", "n_a", "sketch_a", "n_b", "sketch_b")
    pairs = pairs.mapInArrow(allowed, "a bigint, b bigint, blocks bigint")
    best = pairs.groupBy("a").agg(F.max(F.struct("blocks", "b")).alias("best"))
    return checkpointed(best.select("a", F.col("best")["b"].alias("b")))


def _across(members: DataFrame, groups: DataFrame, classes: DataFrame, bands: Bands) -> DataFrame:
    """(a, b): pairs of a bucket that lie in different components so far and that the sketches allow."""
    members = members.join(groups.withColumnRenamed("root", "label"), "node", "left")
    members = checkpointed(members.select("key", "node", F.coalesce("label", "node").alias("label")))
    name = [F.bit_xor(F.xxhash64(F.lit(k), "node")).alias(f"name_{k}") for k in (1, 2)]
    counted = members.groupBy("key", "label").agg(F.count(F.lit(1)).alias("rows"), *name).groupBy("key")
    mixed = counted.agg(
        F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("labels"), F.max(F.struct("rows", "label")).alias("most"),
        F.bit_xor("name_1").alias("name_1"), F.bit_xor("name_2").alias("name_2"),
    ).where("labels > 1")
    # Buckets of the same members are compared once.
    mixed = mixed.groupBy("rows", "name_1", "name_2").agg(F.min(F.struct("key", "most")).alias("one")).select("rows", "one.key", "one.most")
    # A bucket of more members than a tile has is cut: its largest component into chunks that meet
    # chunks of the other members, which meet each other as well.
    cut = lambda n: F.when(F.col("rows") <= TILE_MEMBERS, 1).otherwise(F.ceil(2 * n / TILE_MEMBERS)).cast("int")
    mixed = mixed.select("key", F.col("rows") <= TILE_MEMBERS, F.col("most")["label"], cut(F.col("most")["rows"]), cut(F.col("rows") - F.col("most")["rows"]))
    mixed = checkpointed(mixed.toDF("key", "whole", "main", "mains", "others"))
    members = checkpointed(members.join(mixed, "key"))
    firsts = members.groupBy("node").agg(F.slice(F.array_sort(F.collect_list("key")), 1, FIRST_KEYS).alias("firsts"))
    rows = members.join(classes.select("node", "n", "sketch").join(firsts, "node"), "node")
    is_main, chunk = F.col("label") == F.col("main"), lambda parts: F.pmod(F.xxhash64("node"), F.col(parts)).cast("int")
    upto = lambda parts: F.sequence(F.lit(0), F.col(parts) - 1)
    pair = lambda i, j: F.struct(i.cast("int").alias("i"), j.cast("int").alias("j"))
    with_others = F.transform(upto("others"), lambda o: pair(F.least(o, chunk("others")), F.greatest(o, chunk("others"))))
    with_mains = F.transform(upto("mains"), lambda m: pair(chunk("others"), F.col("others") + m))
    of_main = F.transform(upto("others"), lambda o: pair(o, F.col("others") + chunk("mains")))
    tiles = F.when(F.col("whole"), F.array(pair(F.lit(0), F.lit(0)))).when(is_main, of_main).otherwise(F.concat(with_others, with_mains))
    tiled = rows.select("key", F.explode(tiles).alias("tile"), "node", "label", "n", "sketch", "firsts")
    tiled = tiled.select("key", "tile.i", "tile.j", "node", "label", "n", "sketch", "firsts")
    tiled = tiled.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([batch])])
            tile = _tile_numbers(table)
            done = int(np.searchsorted(tile, tile[-1]))
            rest = table.slice(done)
            yield from pairs_across(table.slice(0, done), tile[:done], bands)
        if rest is not None:
            yield from pairs_across(rest, _tile_numbers(rest), bands)

    return checkpointed(tiled.mapInArrow(compared, "a bigint, b bigint").distinct())


def _tile_numbers(table: pa.Table) -> np.ndarray:
    """A number for each row, which rises by one where another tile begins."""
    names = [table.column(c).to_numpy() for c in ("key", "i", "j")]
    return np.cumsum(np.r_[0, np.logical_or.reduce([x[1:] != x[:-1] for x in names])])


def pairs_across(table: pa.Table, tile: np.ndarray, bands: Bands) -> Iterator[pa.RecordBatch]:
    """Pairs of rows of one tile and of different labels that the sketches allow, but those that surely share an earlier bucket."""
    if not table.num_rows:
        return
    key, node, label = (table.column(c).to_numpy() for c in ("key", "node", "label"))
    one = Sketches(table.column("n").combine_chunks(), table.column("sketch").combine_chunks())
    firsts = np.full((len(node), FIRST_KEYS), np.iinfo(np.int64).max)
    for k, own in enumerate(_lists(table.column("firsts").combine_chunks())):
        firsts[k, : len(own)] = own
    held, n = [], 0

    def allowed() -> pa.RecordBatch:
        i, j = np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held])
        good = may_link(one, i, one, j, bands)
        i, j = i[good], j[good]
        shared = (firsts[i][:, :, None] == firsts[j][:, None, :]).any(axis=2) & (firsts[i] < key[i][:, None])
        late = shared.any(axis=1)
        i, j = node[i[~late]], node[j[~late]]
        both = np.unique(np.stack([np.maximum(i, j), np.minimum(i, j)]), axis=1)
        return pa.RecordBatch.from_arrays([pa.array(both[0]), pa.array(both[1])], ["a", "b"])

    for far in range(1, table.num_rows):
        same = tile[far:] == tile[:-far]
        if not same.any():
            break
        i = np.flatnonzero(same & (label[far:] != label[:-far]))
        held.append((i, i + far))
        n += len(i)
        if n >= HELD_PAIRS:
            yield allowed()
            held, n = [], 0
    if n:
        yield allowed()


def _checked(docs: DataFrame, pairs: DataFrame, classes: DataFrame, size: int, bands: Bands) -> DataFrame:
    """Those of ``pairs`` (a, b) whose sets are similar enough; b's set goes to its partners, in parts if these are many."""
    many = pairs.groupBy("b").agg(F.ceil(F.count(F.lit(1)) / HUB_PAIRS).cast("int").alias("parts")).where("parts > 1")
    dealt = pairs.join(many, "b", "left").select("a", "b", F.pmod(F.xxhash64("a"), F.coalesce("parts", F.lit(1))).cast("int").alias("part"))
    wanted = dealt.select("b", "part", F.lit(1).alias("place"), F.col("a").alias("node"))
    wanted = wanted.union(dealt.select("b", "part", F.lit(0), "b").distinct()).join(classes.select("node", "doc_id", "text"), "node")
    wanted = checkpointed(wanted.select(F.col("doc_id").alias("at_id"), F.col("text").alias("at_text"), "b", "part", "place", "node"))
    if wanted.count() <= MAX_BROADCAST_IDS:
        wanted = F.broadcast(wanted)
    texts = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), text_of(docs).alias("text"))
    texts = texts.join(wanted, (F.col("doc_id") == F.col("at_id")) & (F.xxhash64("text") == F.col("at_text")))
    texts = texts.select("b", "part", "place", "node", _word_hashes(texts).alias("words"))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, at, n = [], 0, 0
            for k, words in enumerate(_lists(batch.column(4))):
                held.append(shingle_set(words, size))
                n += len(held[-1])
                if k + 1 == batch.num_rows or n >= OUT_SHINGLES:
                    plain = batch.select([0, 1, 2, 3]).slice(at, k + 1 - at)
                    yield pa.RecordBatch.from_arrays([*plain.columns, _as_lists(held)], ["b", "part", "place", "node", "shingles"])
                    held, at, n = [], k + 1, 0

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub, own = None, np.empty(0, np.uint64)
        for batch in batches:
            found = []
            hubs, places, nodes = (batch.column(c).to_numpy() for c in (0, 2, 3))
            for k, s in enumerate(_lists(batch.column(4))):
                if not places[k]:
                    hub, own = hubs[k], s.view(np.uint64).copy()
                elif hub == hubs[k] and similar(own, s.view(np.uint64), bands):
                    found.append((nodes[k], hub))
            yield pa.RecordBatch.from_arrays([pa.array([f[e] for f in found], pa.int64()) for e in (0, 1)], ["a", "b"])

    kept = texts.mapInArrow(sets, "b bigint, part int, place int, node bigint, shingles array<bigint>")
    kept = kept.repartition("b", "part").sortWithinPartitions("b", "part", "place")
    return kept.mapInArrow(check, "a bigint, b bigint")


def _grouped(docs: DataFrame, named: DataFrame, names: Names, size: int, bands: Bands, by_id: bool, keys: Keys = block_keys) -> DataFrame:
    """node, doc_id, text, root of every set: where its first document is, and the group's name.

    ``by_id``: unlike sets of one doc_id are linked, too.
    """
    at = F.min(F.struct("doc_id", "text", "n", "sketch")).alias("at")
    classes = named.where("n > 0 AND doc_id IS NOT NULL").groupBy("node").agg(at)
    classes = checkpointed(classes.select("node", "at.*"))
    members = _members(docs, size, bands, keys, names)
    links = checkpointed(_checked(docs, _likely(members, classes, bands), classes, size, bands))
    groups = component_roots(links)
    links = links.union(_checked(docs, _across(members, groups, classes, bands), classes, size, bands))
    if by_id:
        ids = named.where("n > 0 AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("node").alias("b"), F.max("node").alias("last"))
        ids = checkpointed(ids.where("b <> last").select("doc_id", "b"))
        links = links.union(named.where("n > 0").join(ids, "doc_id").select(F.col("node").alias("a"), "b"))
    roots = component_roots(links)
    return classes.join(roots, "node", "left").select("node", "doc_id", "text", F.coalesce("root", "node").alias("root"))


def near_duplicates(docs: DataFrame, size: int = 5, num: int = 8, den: int = 10, keys: Keys = block_keys, digest: Digest = set_digest) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of ``docs``.

    Words are runs of anything but ASCII white space, A-Z lower-cased; the set of a text is
    that of its ``size``-word shingles (one shorter, if it has fewer words). Documents link
    when their sets' Jaccard similarity is num / den at least; component_id is the smallest
    doc_id that links reach. A null, empty or blank text has no shingles and no links, its
    component is itself. Rows with one doc_id are one document; a row without doc_id links
    with nothing and has a null component. Other columns are not used. ``keys`` names the
    buckets of a set; the usual ones lose no link. ``digest`` tells sets apart.
    """
    bands = Bands(num, den)
    with small_batches(docs.sparkSession, BATCH_ROWS, BATCH_BYTES):
        named, names = _named(docs, size, bands, digest)
        groups = checkpointed(_grouped(docs, named, names, size, bands, by_id=True, keys=keys))
    first = checkpointed(groups.groupBy("root").agg(F.min("doc_id").alias("component_id")))
    groups = checkpointed(groups.join(first, "root").select("node", "component_id"))
    found = named.select("doc_id", "n", "node").join(groups, "node", "left")
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return found.select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"))


def drop_near_duplicate_texts(docs: DataFrame, size: int = 5, num: int = 8, den: int = 10, digest: Digest = set_digest) -> DataFrame:
    """``docs`` with one row for each group of near duplicates, decided by texts: no group goes because of its ids.

    Where ids repeat with unlike texts, each such text is a document of its own. The row
    that stays is that of the smallest doc_id; rows without doc_id or without words stay; of
    rows with equal doc_id and text one stays, the same in every run.
    """
    bands = Bands(num, den)
    with small_batches(docs.sparkSession, BATCH_ROWS, BATCH_BYTES):
        named, names = _named(docs, size, bands, digest)
        groups = checkpointed(_grouped(docs, named, names, size, bands, by_id=False))
    first = groups.groupBy("root").agg(F.min(F.struct("doc_id", "text")).alias("first"))
    first = checkpointed(first.select("root", F.col("first.doc_id").alias("first_id"), F.col("first.text").alias("first_text")))
    groups = checkpointed(groups.join(first, "root").select("node", "first_id", "first_text"))
    # A document is a doc_id and a text; of some there are several rows.
    own = named.where("doc_id IS NOT NULL").groupBy("doc_id", "text", "node").agg(F.count(F.lit(1)).alias("rows"))
    own = own.join(groups, "node", "left").withColumn("stays", F.expr("node IS NULL OR doc_id = first_id AND text = first_text"))
    names = hidden(docs, "id", "hash", "stays")
    own = own.where("NOT stays OR rows > 1").select(*[F.col(c).alias(names[k]) for c, k in (("doc_id", "id"), ("text", "hash"), ("stays", "stays"))])
    own = checkpointed(own)
    few = F.broadcast(own) if own.count() <= MAX_BROADCAST_IDS else own
    rows = docs.join(few, (docs["doc_id"].cast("bigint") == few[names["id"]]) & (F.xxhash64(text_of(docs)) == few[names["hash"]]), "left")
    once = rows.where(F.col(names["stays"]).isNull()).select(*quoted(docs.columns))
    twice = rows.where(F.col(names["stays"]))
    if own.where(names["stays"]).isEmpty():
        return once
    return once.union(_one_each(twice, [names["id"], names["hash"]], docs.columns).select(*quoted(docs.columns)))


def _one_each(rows: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """One row for each key, chosen by the contents of ``columns``."""
    place = hidden(rows, "place")["place"]
    order = Window.partitionBy(*keys).orderBy(F.to_json(F.struct(*quoted(columns))))
    return rows.withColumn(place, F.row_number().over(order)).where(F.col(place) == 1)
