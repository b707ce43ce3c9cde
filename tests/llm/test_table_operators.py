"""Jaccard join, top-k, mixing, components and the pipeline against brute force and edge cases."""

import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from marketloom.llm import common, components, decontaminate, mixing, near_duplicates, oracles, queries, topk

SF = "/root/testdata/sf0.001"


def duck():
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings", "conversations"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(oracles.ORACLES))
def test_query_against_sql(spark, name):
    got, want = queries.queries()[name](spark, SF), duck().sql(oracles.ORACLES[name])
    names = sorted(want.columns)
    assert sorted(got.columns) == names
    flat = lambda r: tuple(f"{v:.9g}" if isinstance(v, float) else str(v) for v in r)
    at = [want.columns.index(c) for c in names]
    assert sorted(flat(r[c] for c in names) for r in got.collect()) == sorted(flat(r[i] for i in at) for r in want.fetchall())


# ---- near duplicates ----


def sets_of(texts, size):
    found = {}
    for i, t in texts:
        w = re.findall(common.SPACE_WORD, (t or "").translate({c: c + 32 for c in range(65, 91)}))
        found[i] = {tuple(w[k : k + size]) for k in range(max(len(w) - size + 1, 1))} if w else set()
    return found


def brute_components(texts, size, num, den):
    sets, top = sets_of(texts, size), {i: i for i, _ in texts}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if sets[a] and sets[b] and len(sets[a] & sets[b]) * den >= num * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                top[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


def near_texts(rng, groups, copies, length):
    out = []
    for _ in range(groups):
        base = [f"w{rng.randrange(3000)}" for _ in range(rng.randrange(*length))]
        for _ in range(rng.randrange(1, copies)):
            words = list(base)
            for _ in range(rng.randrange(0, max(2, len(words) // 12))):
                words[rng.randrange(len(words))] = f"v{rng.randrange(3000)}"
            out.append(" ".join(words).upper() if rng.random() < 0.3 else "\t".join(words))
    return out


@pytest.mark.parametrize("size,num,den", [(3, 90, 100), (5, 8, 10), (1, 1, 2)])
def test_components_of_near_duplicates(spark, size, num, den, monkeypatch):
    monkeypatch.setattr(near_duplicates, "TILE_MEMBERS", 6)  # so that buckets are cut into tiles
    monkeypatch.setattr(near_duplicates, "HUB_PAIRS", 2)
    monkeypatch.setattr(near_duplicates, "HELD_KEYS", 500)
    rng = random.Random(size)
    texts = near_texts(rng, 25, 12, (1, 9)) + near_texts(rng, 12, 25, (20, 160)) + near_texts(rng, 2, 6, (1500, 2500)) + [None, "", " \t ", "x", "X", "x"]
    table = list(enumerate(texts))
    rng.shuffle(table)
    df = spark.createDataFrame([(i, t, "k", 1) for i, t in table], "doc_id bigint, text string, key string, rep int").repartition(3)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_duplicates.near_duplicates(df, size, num, den).collect()}
    assert got == brute_components(table, size, num, den)


def test_repeated_and_null_ids(spark):
    rows = [(5, "a b c d e f"), (3, "a b c d e f"), (5, "q r s t u v"), (9, "q r s t u v"), (None, "a b c d e f"), (None, None), (1, "")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = near_duplicates.near_duplicates(df).collect()
    assert Counter((r["doc_id"], r["component_id"]) for r in got) == Counter([(5, 3), (3, 3), (5, 3), (9, 3), (None, None), (None, None), (1, 1)])
    twice = spark.createDataFrame([(1, "a b c", 1), (1, "a b c", 1)], "doc_id bigint, text string, label int")
    assert near_duplicates.drop_near_duplicate_texts(twice).count() == 1
    assert near_duplicates.near_duplicates(df.limit(0)).count() == 0 and near_duplicates.drop_near_duplicate_texts(df.limit(0)).count() == 0


def test_unlike_sets_on_one_name_stay_apart(spark):
    """Digests whose first 64 bits, and for some the next 64, are the same for unlike sets."""

    def digest(shingles):
        own = near_duplicates.set_digest(shingles)
        return bytes(8) + (bytes(8) if own[0] % 2 else own[8:16]) + own[16:]

    texts = [f"{k} " + " ".join(f"w{(7 * k + j) % 90}" for j in range(12)) for k in range(40)]
    rows = [(k, t) for k, t in enumerate([*texts, *texts[:9]])]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = near_duplicates.near_duplicates(df, digest=digest)
    want = near_duplicates.near_duplicates(df)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    kept = near_duplicates.drop_near_duplicate_texts(df, digest=digest)
    assert sorted(r["doc_id"] for r in kept.collect()) == list(range(40))


def test_unlike_texts_of_one_id_stay(spark):
    rows = [(5, "a b c d e f", 1), (3, "a b c d e f", 2), (5, "q r s t u v", 3), (9, "q r s t u v", 4), (None, "a b c d e f", 5), (None, None, 6), (1, "", 7)]
    rows += [(1, "least id, first text", 8), (1, "least id, other text", 9), (2, "Least ID, other text", 10), (7, "same row here", 12), (7, "same row here", 11)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, label int")
    unique = dict(corpus_pipeline.STAGES)["near_duplicates"]
    want = [("1", "", 7), ("1", "least id, first text", 8), ("1", "least id, other text", 9), ("3", "a b c d e f", 2), ("5", "q r s t u v", 3)]
    want += [("7", "same row here", 11), ("None", "", 6), ("None", "a b c d e f", 5)]
    for parts in (1, 5):
        kept = unique(spark, df.repartition(parts), SF)
        assert kept.columns == df.columns
        assert sorted((str(r["doc_id"]), r["text"] or "", r["label"]) for r in kept.collect()) == want


def test_pigeonhole_finds_every_link():
    """Sets at the threshold share a block key, whatever differs."""
    rng = np.random.default_rng(7)
    for num, den in ((90, 100), (8, 10)):
        bands = near_duplicates.Bands(num, den)
        for _ in range(300):
            n = int(rng.integers(2, 400))
            a = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
            drop = int(rng.integers(0, len(a) // 3 + 1))
            b = np.unique(np.concatenate([a[drop:], rng.integers(0, 2**63, int(rng.integers(0, n // 3 + 1)), dtype=np.uint64)]))
            both = len(np.intersect1d(a, b))
            if not np.array_equal(a, b) and both * den >= num * (len(a) + len(b) - both):
                assert set(near_duplicates.block_keys(a, bands).tolist()) & set(near_duplicates.block_keys(b, bands).tolist())


def test_connected_components(spark):
    rng = random.Random(8)
    pairs = [(i, i + 1) for i in range(200)] + [(500 + rng.randrange(40), 500 + rng.randrange(40)) for _ in range(30)] + [(900, 900)]
    df = spark.createDataFrame([*pairs, (None, 3)], "a bigint, b bigint")
    top = {}

    def find(x):
        while top.setdefault(x, x) != x:
            x = top[x]
        return x

    for a, b in pairs:
        x, y = sorted((find(a), find(b)))
        top[y] = x
    got = {r["node"]: r["label"] for r in components.connected_components(df).collect()}
    assert got == {x: find(x) for p in pairs if p[0] != p[1] for x in p}
    assert components.connected_components(df.limit(0)).count() == 0


# ---- top-k ----


def test_top_k(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 4)
    monkeypatch.setattr(topk, "SLICE", 64)
    monkeypatch.setattr(topk, "SAMPLE", 40)
    rng = random.Random(9)
    rows = [(i, [rng.gauss(0, 1) for _ in range(10)]) for i in range(300)] + [(300 + i, [0.5] * 10) for i in range(60)]
    rows += [(400, None), (401, [None] * 10), (402, [float("nan")] * 10), (403, [float("inf")] * 10), (404, []), (None, [1.0] * 10), (420, [1.0, 2.0]), (440, [3e38] * 10), (460, [-3e38] * 10)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id bigint, embedding array<float>, rank int")
    got = topk.top_k(topk.integer_vectors(df), F.col("vec_id") % 20 == 0, 20).collect()
    ints = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            ints[i] = [max(-(2**63), min(2**63 - 1, int(np.floor(np.float64(np.float32(x)) * 64)))) for x in v]
    ends, want = (-(2**63), 2**63 - 1), set()
    clip = lambda x: int(min(max(x, ends[0]), ends[1]))
    for q, v in ints.items():
        if q % 20 == 0:
            scored = sorted((-clip(sum(int(float(a)) * int(float(b)) for a, b in zip(v, w))), i) for i, w in ints.items() if i != q and len(w) == len(v) > 0)
            want |= {(q, k + 1, i, -s) for k, (s, i) in enumerate(scored[:20])}
    assert {tuple(r) for r in got} == want
    assert topk.top_k(topk.integer_vectors(df.limit(0)), F.col("vec_id") % 20 == 0).count() == 0


def test_bounds_leave_few_exact_products(spark, monkeypatch):
    """Vectors around a few smooth curves: segment statistics alone leave out most pairs, at the size of the small tables as well."""
    rng, products = np.random.default_rng(4), []
    curves = [np.sin(np.arange(64) / 8 + k) * 200 for k in range(8)]
    rows = [(i, np.floor(curves[i % 8] + rng.normal(0, 5, 64)).tolist()) for i in range(500)]
    exact = topk._exact
    monkeypatch.setattr(topk, "_exact", lambda q, x: products.append(len(q)) or exact(q, x))
    monkeypatch.setattr(topk, "DENSE", 1.0)
    frame = lambda rows, **names: pd.DataFrame([dict(zip(names.values(), r, strict=True)) for r in rows])
    asked = frame([(i, v, i, None) for i, v in rows[::20]], a="vec_id", b="ints", c="key", d="threshold")
    first = topk.search_slice(asked, frame(rows[:256], a="own_id", b="own_ints"), 20)
    asked["threshold"] = asked["vec_id"].map(first.groupby("query_id")["score"].min()).astype("Int64")
    products.clear()
    rest = topk.search_slice(asked, frame(rows[256:], a="own_id", b="own_ints"), 20)
    assert 0 < sum(products) < 0.3 * len(asked) * 244
    best = pd.concat([first, rest]).sort_values(["query_id", "score", "vec_id"], ascending=[True, False, True]).groupby("query_id").head(20)
    x = np.array([v for _, v in rows])
    for i, own in best.groupby("query_id"):
        scores = sorted(((-int(s), j) for j, s in enumerate(x @ x[i]) if j != i))[:20]
        assert [(-s, j) for s, j in scores] == list(zip(own["score"], own["vec_id"], strict=True))
    bounds = []
    monkeypatch.setattr(topk, "statistics", lambda x, s, f=topk.statistics: bounds.append(s) or f(x, s))
    topk.search_slice(asked, frame(rows[256:], a="own_id", b="own_ints"), 20)
    assert set(bounds) == set(topk.SEGMENTS)


def test_repeated_queries_ask_once(spark, monkeypatch):
    monkeypatch.setattr(topk, "SLICE", 16)
    monkeypatch.setattr(topk, "SAMPLE", 16)
    rows = [(i, [float(i), 1.0]) for i in range(1, 60)] + [(100, [1.0, 0.0])] * 3 + [(200, [-1.0, 0.0]), (200, [1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, ints array<double>")
    got = topk.top_k(df, F.col("vec_id") >= 100, 4).collect()
    best = [(k, 60 - k, 60 - k) for k in (1, 2, 3, 4)]
    assert sorted((r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == 100) == best
    other = [(1, 1, -1), (1, 59, 59), (2, 58, 58), (2, 100, -1), (3, 57, 57), (3, 100, -1), (4, 56, 56), (4, 100, -1)]
    assert sorted((r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == 200) == other


# ---- mixing ----


def brute_targets(sizes):
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    left, open_, target = float(sum(sizes.values())), set(names), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if weight[s] * level > 3 * sizes[s]}
        if not full:
            return target | {s: weight[s] * level for s in open_}
        target |= {s: 3.0 * sizes[s] for s in full}
        left -= sum(target[s] for s in full)
        open_ -= full
    return target


def test_mixing(spark):
    rng = random.Random(10)
    rows = [(i, " ".join(["w"] * int(rng.paretovariate(0.8) * 3 % 4000)), rng.choice(["é", "z", "a", "", None, "hot", "hot", "hot"])) for i in range(3000)]
    rows += [(None, None, "hot"), (None, "x y", "a"), (5, "x y", "a"), (5, "x y", "a"), (6000, "", "empty")]
    df = spark.createDataFrame([(*r, 7.0, "old") for r in rows], "doc_id bigint, text string, source string, rate double, target string").repartition(5)
    got = mixing.mix(df).collect()
    assert len(got) == len(rows)
    sizes, taken, most = defaultdict(int), defaultdict(int), defaultdict(int)
    for i, t, s in rows:
        sizes[s] += len((t or "").split())
        most[s] = max(most[s], len((t or "").split()))
    want = brute_targets(sizes)
    for r in got:
        assert r["target"] == pytest.approx(want[r["source"]]) and r["source_size"] == sizes[r["source"]] and 0 <= r["copies"] <= 3
        taken[r["source"]] += r["copies"] * r["size"]
    for s, target in want.items():
        assert abs(taken[s] - target) <= most[s] + 0.02 * target
    key = lambda rs: sorted(map(str, ((r["doc_id"], r["source"], r["size"], r["copies"]) for r in rs)))
    assert key(got) == key(mixing.mix(df.repartition(2)).collect())
    copies = mixing.mixture(df)
    assert copies.count() == sum(r["copies"] for r in got) and "copy_no" in copies.columns
    assert mixing.mix(df.limit(0)).count() == 0
    plan = mixing.mix(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan


def test_names_in_a_mixture(spark):
    rows = [(1, "a b c", "s", 7, "old", 0.5, "x", 9), (2, "d e", "s", 8, None, None, None, 9)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string, size int, target string, `a.b` double, Copies string, copy_no int")
    got = mixing.mixture(df)
    assert got.columns == [*df.columns[:-1], "copy_no"]
    kept = {tuple(r)[:-1] for r in got.collect()}
    assert kept and kept <= {r[:-1] for r in rows} and {r["copy_no"] for r in got.collect()} <= {1, 2, 3}


# ---- pipeline ----


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    identified = stages["language_id"](spark, docs, SF)
    rows = {r["doc_id"]: r for r in docs.collect()}
    assert {r["doc_id"] for r in identified.collect()} == {i for i, r in rows.items() if any(map(str.isalpha, r["text"] or ""))}
    unique = stages["near_duplicates"](spark, docs, SF)
    groups = brute_components([(i, r["text"]) for i, r in rows.items()], 5, 8, 10)
    assert {r["doc_id"] for r in unique.collect()} == {i for i, (_, c) in groups.items() if i == c}
    found = decontaminate.contamination(docs, common.read_table(spark, SF, "benchmark")).where("n_hit > 0")
    assert {r["doc_id"] for r in stages["decontamination"](spark, docs, SF).collect()} == set(rows) - {r["doc_id"] for r in found.collect()}
    clean = stages["personal_data"](spark, docs, SF)
    assert clean.where(F.col("text").rlike(r"[a-z0-9]@[a-z]+\.")).count() == 0 and clean.count() == len(rows)
    for name in ("language_id", "near_duplicates", "decontamination", "personal_data"):
        assert stages[name](spark, docs, SF).columns == docs.columns
    out = corpus_pipeline.run(spark, SF)
    assert 0 < out.count() and out.columns == [*docs.columns, "copy_no"]


def test_pipeline_on_odd_rows(spark, tmp_path):
    rows = [(None, None, None, None, None), (1, "", "en", "a", 0), (1, "", "en", "a", 0), (2, "mail a@b.co now", "en", None, None), (3, "the cat sat on the mat", "en", "a", 5)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, None)], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r["text"] for r in got} <= {"mail [EMAIL] now", "the cat sat on the mat"}
    wide = spark.createDataFrame([(*r, 1, 2, 3.0) for r in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint, copy_no int, size int, `a.b` double")
    for _, stage in corpus_pipeline.STAGES:
        wide = stage(spark, wide, str(tmp_path))
        assert {(r["size"], r["a.b"]) for r in wide.collect()} == {(2, 3.0)}
    empty = spark.read.parquet(str(tmp_path / "documents.parquet")).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, str(tmp_path)).count() == 0
