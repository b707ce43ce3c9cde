"""Exact top-k search (operator 4) with multi-resolution segment statistics.

A vector is cut into segments; with the means m and deviations s of a segment of length n,
x . q <= sum n (m_x m_q + s_x s_q), which is the lower bound of the distance said for the
inner product. Few segments come first, then more; the survivors are scored exactly.

Queries are dealt into blocks and vectors into slices, both of bounded size; each block
meets each slice in a task of its own. The scores in a first slice, a sample of some hundred
vectors, give every query a threshold, and the bounds prune all other vectors by it, however
many or few these are; the sample decides nothing else.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpointed

BLOCK, SLICE = 8192, 4096
#: The first slice has about so many vectors.
SAMPLE = 256
MAX_TASKS = 10_000
SEGMENTS = (4, 16)
#: Pairs compared at a time, and the share of survivors from which a matrix product is cheaper than to pick them.
CELLS, DENSE = 1_000_000, 0.02
SCHEMA = "query_id bigint, key bigint, vec_id bigint, score bigint"


def integer_vectors(table: DataFrame, scale: int = 64) -> DataFrame:
    """vec_id and ints, floor(scale * x) of each component as doubles; rows with nulls or non-finite values left out."""
    doubles = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("double"))
    odd = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    good = table.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & ~F.coalesce(odd, F.lit(False)))
    return good.select(F.col("vec_id").cast("bigint").alias("vec_id"), doubles.alias("ints"))


def statistics(x: np.ndarray, segments: int) -> np.ndarray:
    """Rows whose inner products bound those of ``x``: means and deviations, both times the root of the length."""
    out = []
    for part in np.array_split(x, min(segments, x.shape[1]), axis=1):
        root = np.sqrt(part.shape[1])
        out += [part.mean(axis=1) * root, part.std(axis=1) * root]
    return np.stack(out, axis=1)


def _exact(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of rows as exact 64-bit integers, at the type's ends beyond them."""
    if len(q) == 0 or np.abs(q).max(initial=0) * np.abs(x).max(initial=0) * q.shape[1] < 2.0**53:
        return np.einsum("ij,ij->i", q, x).astype(np.int64)
    ends = np.iinfo(np.int64)
    exact = [sum(int(a) * int(b) for a, b in zip(u, v, strict=True)) for u, v in zip(q, x, strict=True)]
    return np.array([min(max(e, ends.min), ends.max) for e in exact], np.int64)


def search_slice(queries: pd.DataFrame, vectors: pd.DataFrame, k: int) -> pd.DataFrame:
    """The best k vectors of a slice for each query of a block, none that its threshold excludes."""
    found = []
    for length, part in vectors.groupby(vectors["own_ints"].map(len), sort=False):
        asked = queries[queries["ints"].map(len) == length]
        if not len(asked) or not length:
            continue
        q, x = np.stack(asked["ints"].to_numpy()), np.stack(part["own_ints"].to_numpy())
        q_ids, keys, x_ids = asked["vec_id"].to_numpy(), asked["key"].to_numpy(), part["own_id"].to_numpy()
        floor = asked["threshold"].to_numpy(dtype=np.float64, na_value=-np.inf)
        levels = [(statistics(q, s), statistics(x, s)) for s in SEGMENTS] if np.isfinite(floor).any() else []
        slack = 1e-9 * (1 + np.linalg.norm(q, axis=1) * np.linalg.norm(x, axis=1).max())
        whole = np.abs(q).max() * np.abs(x).max() * length < 2.0**53  # sums of doubles are exact
        step = max(1, CELLS // len(x))
        for a in range(0, len(q), step):
            rows = slice(a, a + step)
            alive = q_ids[rows][:, None] != x_ids[None]
            least = (floor[rows] - slack[rows])[:, None]
            for own, other in levels:
                alive &= own[rows] @ other.T >= least
            if whole and alive.mean() > DENSE:
                scores = np.where(alive, q[rows] @ x.T, -np.inf)
                if len(x) > k:
                    alive &= scores >= np.partition(scores, len(x) - k, axis=1)[:, len(x) - k, None]
                i, j = np.nonzero(alive & (scores >= floor[rows][:, None]))
                score = scores[i, j].astype(np.int64)
            else:
                i, j = np.nonzero(alive)
                parts = [slice(b, b + CELLS // 8) for b in range(0, len(i), CELLS // 8)]
                score = np.concatenate([_exact(q[rows][i[b]], x[j[b]]) for b in parts] or [np.empty(0, np.int64)])
                good = score >= floor[rows][i]
                i, j, score = i[good], j[good], score[good]
            order = np.lexsort((x_ids[j], ~score, i))  # ~ falls as the score rises, and can't overflow
            i, j, score = i[order], j[order], score[order]
            rank = np.arange(len(i)) - np.searchsorted(i, i)
            top = rank < k
            asking = i[top]
            found.append(pd.DataFrame({"query_id": q_ids[rows][asking], "key": keys[rows][asking], "vec_id": x_ids[j[top]], "score": score[top]}))
    return pd.concat(found) if found else pd.DataFrame({c: pd.Series(dtype="int64") for c in ("query_id", "key", "vec_id", "score")})


def _best(scored: DataFrame, k: int) -> DataFrame:
    rank = F.expr("row_number() OVER (PARTITION BY query_id, key ORDER BY score DESC, vec_id)")
    return scored.withColumn("rank", rank.cast("int")).where(F.col("rank") <= k)


def top_k(vectors: DataFrame, is_query: Column, k: int = 20) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k largest inner products of every query.

    ``vectors`` has vec_id and ints (see ``integer_vectors``); ``is_query`` chooses the queries
    among its rows, whose own id is no candidate. Ties go to the smaller id, equal ids of
    other vectors are candidates each; vectors of another length than the query's are none.
    Equal rows (id and vector) ask once, unlike vectors of one id are queries of their own.
    Queries without candidates give no rows. Scores beyond 64 bits stop at the type's ends.
    """
    vectors = checkpointed(vectors)
    n, asked = vectors.count(), vectors.where(is_query).select("vec_id", "ints").dropDuplicates()
    asked = asked.withColumn("key", F.xxhash64("vec_id", "ints"))
    slices, blocks = max(1, -(-n // SLICE)), max(1, -(-asked.count() // BLOCK))
    dealt = lambda seed, parts: F.pmod(F.xxhash64(F.lit(seed), "vec_id"), F.lit(parts)).cast("int")
    begins = F.pmod(F.xxhash64(F.lit(3), "vec_id"), F.lit(n or 1)) < SAMPLE
    sliced, blocked = vectors.withColumn("slice", F.when(begins, 0).otherwise(1 + dealt(1, slices))), asked.withColumn("block", dealt(2, blocks))

    def search(queries: DataFrame, candidates: DataFrame, first: int, last: int) -> DataFrame:
        # Pairs take long for their bytes, so their number and not their size says how many tasks there are.
        tasks = min(2 * blocks * (last - first + 1), MAX_TASKS)
        meets = queries.withColumn("slice", F.explode(F.sequence(F.lit(first), F.lit(last))))
        meets = meets.repartition(tasks, "block", "slice").groupBy("block", "slice")
        # Other names than the queries': both come from one table, and Spark tells columns of a pair apart by name.
        spread = candidates.select(
            F.col("vec_id").alias("own_id"), F.col("ints").alias("own_ints"), F.col("slice").alias("own_slice"),
            F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("own_block"),
        )
        spread = spread.repartition(tasks, "own_block", "own_slice").groupBy("own_block", "own_slice")
        return meets.cogroup(spread).applyInPandas(lambda a, b: search_slice(a, b, k), SCHEMA)

    none = blocked.withColumn("threshold", F.lit(None).cast("bigint"))
    begun = _best(search(none, sliced.where("slice = 0"), 0, 0), k)
    if n > SAMPLE:
        begun = checkpointed(begun)
        floors = begun.where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), "key", F.col("score").alias("threshold"))
        floored = blocked.join(floors, ["vec_id", "key"], "left")
        rest = search(floored, sliced.where("slice > 0"), 1, slices)
        begun = _best(begun.select("query_id", "key", "vec_id", "score").union(rest), k)
    return begun.select("query_id", "rank", "vec_id", "score")
