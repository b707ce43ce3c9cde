"""Lexical search, fingerprints and token alignment against brute force and edge cases."""

import hashlib
import json
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketloom.llm import common, fingerprints, lexical_search, near_duplicates, queries, token_alignment

SF = "/root/testdata/sf0.001"
DOC = "doc_id bigint, text string, rank string, score string, terms string, q string, groups string, pair string, place string, hash string"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, *"abcdefgh") for i, t in rows], DOC)


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


# ---- lexical search ----


def brute_rank(docs, items, k=10):
    terms = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower(t or ""))
    counts = [(i, Counter(terms(t))) for i, t in docs]
    counts = [(i, c, sum(c.values())) for i, c in counts if c]
    size, length = len(counts), sum(n for _, _, n in counts)
    df = Counter(t for _, c, _ in counts for t in c)
    out = []
    for item, words in sorted({(i, tuple(terms(t))) for i, t in items}, key=str):
        scored = []
        for i, c, n in counts:
            m = 100 - 75 + ((75 * n * size) // length)
            score = sum(math.floor(1000 * math.log((2 * size + 2) / (2 * df[w] + 1))) * ((10**9 * c[w]) // (1000 * c[w] + 8 * m)) for w in words if c[w])
            scored.append((-score, i is None, i or 0, i))
        out += [(item, r + 1, i, -s) for r, (s, _, _, i) in enumerate(sorted(x for x in scored if x[0])[:k])]
    return sorted(out, key=str)


def search_rows(rng, n):
    words = [f"w{k}" for k in range(60)] + ["É", "ß9", "Über"]
    return [(i, " ".join(rng.choice(words[: rng.choice((5, 20, 63))]) + rng.choice(("", ",", "!")) for _ in range(rng.randrange(0, 40)))) for i in range(n)]


@pytest.mark.parametrize("postings,block", [(50, 1_000_000), (250_000, 60)])
def test_rank_against_brute_force(spark, monkeypatch, postings, block):
    rng = random.Random(postings)
    docs = search_rows(rng, 150)
    docs += [(7, "w1 w2"), (7, docs[7][1]), (None, "w1 w2 É"), (None, None), (900, None), (901, ""), (902, "..."), (903, "w3 " * 30_000 + "W4")]
    docs += [(1000 + k, "w1 w2 w1") for k in range(30)]  # a group of copies: ties
    items = [(1, "W1, w2 w1!"), (2, "unknown words"), (3, None), (4, ""), (5, "É über Über w3"), (1, "W1, w2 w1!"), (6, "w4 w4 w4 w59")]
    items += [(20 + k, " ".join(f"w{rng.randrange(63)}" for _ in range(12))) for k in range(8)]
    monkeypatch.setattr(lexical_search, "SHARD_POSTINGS", postings)
    monkeypatch.setattr(lexical_search, "MAX_ITEM_TERMS", block)
    table = spark.createDataFrame([(i, t, "x", 1) for i, t in items], "item_id bigint, text string, doc_id string, score int")
    got = lexical_search.rank(docs_of(spark, docs).repartition(3), table).collect()
    assert sorted(map(tuple, got), key=str) == brute_rank(docs, items)


def test_rank_of_nothing(spark):
    none = docs_of(spark, [(1, None), (2, "...")])
    items = spark.createDataFrame([(1, "a b")], "item_id bigint, text string")
    assert lexical_search.rank(none, items).collect() == []
    assert lexical_search.rank(none.limit(0), items).collect() == []
    assert lexical_search.rank(docs_of(spark, [(1, "a b")]), items.limit(0)).collect() == []
    assert lexical_search.rank(none, items).columns == ["item_id", "rank", "doc_id", "score"]


def test_threshold_stops_early_and_loses_nothing():
    rng = np.random.default_rng(3)
    n, terms = 20_000, 4
    counts = (rng.pareto(1.2, (n, terms)) * 3).astype(np.int64) + 1
    lengths = counts.sum(axis=1) + rng.integers(1, 60, n)
    row = {
        "ids": np.arange(n).tobytes(), "no_id": np.zeros(n, np.bool_).tobytes(), "lengths": lengths.astype(np.int64).tobytes(),
        "starts": (np.arange(n + 1) * terms).tobytes(), "terms": np.tile(np.arange(terms, dtype=np.int32), n).tobytes(), "counts": counts.reshape(-1).tobytes(),
    }
    shard = lexical_search.Shard(row, n, int(lengths.sum()))
    own, weights, best = np.array([900, 500, 0, 300]), np.zeros(terms, np.int64), lexical_search.Best(10)
    read = lexical_search.threshold_search(shard, np.arange(terms), own, best, weights)
    scores = (shard.impacts.reshape(n, terms) * own).sum(axis=1)
    order = np.lexsort((np.arange(n), -scores))[:10]
    assert best.ids.tolist() == order.tolist() and best.scores.tolist() == scores[order].tolist() and not weights.any()
    assert read < 3 * n / 4
    assert lexical_search.threshold_search(shard, np.arange(terms), own // 100, best, weights) == 0  # nothing reaches the k-th score


# ---- fingerprints ----


def plain_fingerprint(text):
    words = [w.encode() for w in re.findall(common.SPACE_WORD, lower(text))]
    mask, golden = 2**64 - 1, 0x9E3779B97F4A7C15

    def mix(x):
        x = ((x ^ x >> 30) * 0xBF58476D1CE4E5B9) & mask
        x = ((x ^ x >> 27) * 0x94D049BB133111EB) & mask
        return x ^ x >> 31

    import xxhash

    shingles = set()
    for k in range(max(len(words) - 4, 1) if words else 0):
        run = words[k : k + 5]
        h = len(run)
        for w in run:
            h = mix((h * golden + xxhash.xxh64_intdigest(w, 42)) & mask)
        shingles.add(h >> 32)
    keys = [mix(k * golden & mask) for k in range(1, 257)]
    least = [min(((a | 1) * x + b) & mask for x in shingles) for a, b in zip(keys[:128], keys[128:])] if shingles else []
    return "".join(f"{mix(v) >> 48:04x}" for v in least)


def plain_likeness(a, b):
    if not a or not b:
        return float(a == b)
    return sum(a[k : k + 4] == b[k : k + 4] for k in range(0, 512, 4)) / 128


def plain_neighbours(rows):
    out = []
    for (i, t), (_, nxt) in zip(rows, [*rows[1:], rows[0]], strict=True):
        t, nxt = t or "", nxt or ""
        new = t[: len(t) - len(t) // 2] + nxt[: len(t) // 2]
        f, g = plain_fingerprint(t), plain_fingerprint(new)
        out.append((i, len(t), hashlib.sha256(new.encode()).hexdigest(), f, g, plain_likeness(f, g), plain_likeness(f, plain_fingerprint(nxt))))
    return out


def neighbours_of(docs):
    found = fingerprints.neighbours(docs)
    return found.withColumns({c: F.lower(F.hex(c)) for c in ("fingerprint", "edited_fingerprint")})


def fingerprint_rows():
    rng = random.Random(5)
    word = lambda: rng.choice(("été", "Word", "日本", "a", "b2", "𝄞x"))
    rows = [(3 * k - 20, " ".join(f"{word()}{rng.randrange(40)}" for _ in range(rng.randrange(0, 60)))) for k in range(60)]
    rows += [(500, None), (501, ""), (502, " \t\n"), (503, "one"), (504, rows[3][1]), (505, rows[3][1]), (506, "x y z " * 20_000), (507, "w")]
    return rows


def test_neighbours_against_brute_force(spark):
    rows = fingerprint_rows()
    shuffled = random.Random(1).sample(rows, len(rows))
    got = neighbours_of(docs_of(spark, shuffled).repartition(5)).collect()
    assert sorted(map(tuple, got)) == sorted(plain_neighbours(sorted(rows)))


def test_neighbours_of_few_repeated_and_no_rows(spark):
    assert neighbours_of(docs_of(spark, []).limit(0)).collect() == []
    one = [(1, "a b c d e f g h")]
    assert [tuple(r) for r in neighbours_of(docs_of(spark, one)).collect()] == plain_neighbours(one)
    twice = neighbours_of(docs_of(spark, [(1, "a b c d e f"), (None, "z"), (1, "a b c d e f"), (2, "q")])).collect()
    assert sorted(map(tuple, twice), key=str) == sorted(plain_neighbours([(1, "a b c d e f"), (1, "a b c d e f"), (2, "q"), (None, "z")]), key=str)


def test_fingerprint_query_and_likeness_of_copies(spark):
    rows = [(r["doc_id"], r["text"]) for r in common.read_table(spark, SF, "documents").collect()]
    got = queries.op12_fingerprints(spark, SF).collect()
    assert sorted(map(tuple, got)) == sorted(plain_neighbours(sorted(rows)))
    by_text = defaultdict(set)
    texts = dict(rows)
    for r in got:
        by_text[texts[r["doc_id"]]].add(r["fingerprint"])
    assert all(len(v) == 1 for v in by_text.values())


def test_likeness_estimates_jaccard():
    rng = np.random.default_rng(1)
    for share in (0.2, 0.5, 0.9):
        n = 3000
        both = rng.integers(0, 2**63, n).astype(np.uint64)
        cut = int(n * 2 * share / (1 + share))
        a, b = both.copy(), both.copy()
        b[cut:] = rng.integers(0, 2**63, n - cut)
        got = fingerprints.likeness(fingerprints.signature(np.unique(a)), fingerprints.signature(np.unique(b)))
        assert abs(got - cut / (2 * n - cut)) < 0.15
    assert fingerprints.likeness(b"", b"") == 1 and fingerprints.likeness(b"", b"ab") == 0


def test_near_duplicates_by_bands(spark):
    rng = random.Random(9)
    rows = []
    for g in range(25):
        words = [f"w{rng.randrange(5000)}" for _ in range(rng.randrange(60, 200))]
        for _ in range(rng.randrange(1, 6)):
            own = list(words)
            for _ in range(rng.randrange(0, 3)):
                own[rng.randrange(len(own))] = f"v{rng.randrange(5000)}"
            rows.append((len(rows), " ".join(own)))
    rows += [(900, None), (901, ""), (902, "one two"), (903, "ONE two"), (None, "one two")]
    docs = docs_of(spark, rows).repartition(3)
    got, want = fingerprints.near_duplicates_by_bands(docs), near_duplicates.near_duplicates(docs, 5, 8, 10)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    assert fingerprints.near_duplicates_by_bands(docs.limit(0)).collect() == []


# ---- token alignment ----


@pytest.fixture(scope="module")
def paths():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def plain_alignments(rows, paths):
    """Whole texts encoded by the libraries; tokens as byte ranges."""
    import sentencepiece
    from tokenizers import Tokenizer

    a, b = Tokenizer.from_file(paths[0]), sentencepiece.SentencePieceProcessor(model_file=paths[1])
    a.encode_special_tokens = True
    plain = [c for c in range(256) if 33 <= c <= 126 or 161 <= c <= 172 or 174 <= c <= 255]
    letter = {chr(c): c for c in plain} | {chr(256 + k): c for k, c in enumerate([c for c in range(256) if c not in plain])}
    docs, held = [], Counter()
    for i, text in rows:
        ids_a = a.encode(f" {text}", add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        parts_a = [bytes(letter[c] for c in a.id_to_token(t)) for t in ids_a]
        parts_b = [bytes([int(p[3:5], 16)]) if re.fullmatch(r"<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode() for p in map(b.id_to_piece, ids_b)]
        if not text or not b"".join(parts_a) == b"".join(parts_b) == f" {text}".encode():
            docs.append((i, [], [], []))
            continue
        ends_a, ends_b = np.cumsum([len(p) for p in parts_a]).tolist(), np.cumsum([len(p) for p in parts_b]).tolist()
        links, k = [], 0
        for x, end in enumerate(ends_a):
            start = end - len(parts_a[x])
            while ends_b[k] <= start:
                k += 1
            y = k
            while y < len(ends_b) and ends_b[y] - len(parts_b[y]) < end:
                links.append((ids_a[x], ids_b[y]))
                y += 1
        both = sorted(set(ends_a) & set(ends_b))
        groups, x, y = [], 0, 0
        for end in both:
            u, v = ends_a.index(end, x) + 1, ends_b.index(end, y) + 1
            groups.append(f"{','.join(map(str, ids_a[x:u]))}|{','.join(map(str, ids_b[y:v]))}")
            x, y = u, v
        held.update(set(links))
        docs.append((i, (ids_a, ids_b), groups, links))
    most = defaultdict(int)
    for (x, _), n in held.items():
        most[x] = max(most[x], n)
    out = []
    for i, ids, groups, links in docs:
        n_a, n_b = (len(ids[0]), len(ids[1])) if ids else (0, 0)
        out.append((i, n_a, n_b, len(groups), len(links), sum(held[p] == most[p[0]] for p in links), sum(held[p] for p in links), ";".join(groups)))
    return out


ODD = [
    "plain words here", " leading", "trailing ", "two  spaces   three", "x \n y\r\n\tz  ", " ", "  ", "\n", "a b c　 d", "<s> </s> <|endoftext|> <unk>",
    "don't we'll  I'M", "▁mark", "a ▁ b", "ends with mark ▁", "日本語 テキスト 文", "été naïve ﬁ ① Å", "𝄞 🙂🙂 z", "\x00\x01 \x7f", "\x1c a\x1f b", "12 345 6789", "(x) [y], {z};\r }\r", "<0x41> <0xZZ>",
    "  a  b", "é ́ x",
]


def test_alignments_against_whole_texts(spark, paths, monkeypatch):
    rng = random.Random(4)
    marks = [" ", "  ", "\n", "\t ", "a", "Zw", "'s", "é", "日", "1", "..", "\r", " ", "the", " of", "<s>"]
    rows = [(k, t) for k, t in enumerate(ODD)] + [(100 + k, "".join(rng.choice(marks) for _ in range(rng.randrange(1, 60)))) for k in range(300)]
    rows += [(900, None), (901, ""), (5, "plain words here"), (5, "plain words here"), (None, "plain words"), (902, "word " * 40_000), (903, "x" * 30_000)]
    monkeypatch.setattr(token_alignment, "CHUNK_CHARS", 2000)
    got = token_alignment.align_documents(docs_of(spark, rows).repartition(3), *paths).collect()
    assert sorted(map(tuple, got), key=str) == sorted(plain_alignments(rows, paths), key=str)
    assert token_alignment.align_documents(docs_of(spark, rows).limit(0), *paths).collect() == []
    assert token_alignment.align_documents(docs_of(spark, [(1, None)]), *paths).collect() == [(1, 0, 0, 0, 0, 0, 0, "")]


def test_alignment_query(spark, paths):
    rows = [(r["doc_id"], r["text"]) for r in common.read_table(spark, SF, "documents").collect()]
    got = queries.op13_token_alignment(spark, SF).collect()
    want = [(*r[:-1], hashlib.sha256(r[-1].encode()).hexdigest() if r[-1] else "") for r in plain_alignments(rows, paths)]
    assert sorted(map(tuple, got)) == sorted(want)


def test_vocabularies_that_merge_over_spaces_are_refused(paths, tmp_path):
    with open(paths[0], encoding="utf-8") as file:
        parts = json.load(file)
    parts["pre_tokenizer"] = None
    (tmp_path / "merging.json").write_text(json.dumps(parts))
    with pytest.raises(ValueError, match="white space"):
        token_alignment.Aligner(str(tmp_path / "merging.json"), paths[1])


def test_segments_hold_the_text():
    for text in ODD:
        found = token_alignment.segments_of(text)
        assert "".join(found) == f" {text}" and all(s[0] == " " and len(s) > 1 for s in found)
