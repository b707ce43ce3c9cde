"""Decontamination, personal data, licences, HTML, chat, tokens and language against brute force and edge cases."""

import hashlib
import html as html_lib
import json
import random
import re
import time

import duckdb
import pytest
import xxhash
from pyspark.sql import functions as F

from marketloom.llm import chat, common, decontaminate, html_text, language_id, license_scan, oracles, pii, queries, token_counts

SF = "/root/testdata/sf0.001"
DOC = "doc_id bigint, text string, lang string, source string, n_chars bigint, spans string, size string, row string, words string"


def docs_of(spark, *texts, ids=None):
    ids = ids or range(len(texts))
    return spark.createDataFrame([(i, t, "en", None, None, "s", "z", "r", "w") for i, t in zip(ids, texts)], DOC)


def plain_words(text):
    return re.findall(common.ALNUM_WORD, license_scan._lower(text or ""))


# ---- decontamination ----


def brute_hits(text, items, width=10):
    words, hit, found = plain_words(text), set(), set()
    for item, t in items:
        w = plain_words(t)
        if not w:
            continue
        n = min(width, len(w))
        wins = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}
        for i in range(len(words) - n + 1):
            if tuple(words[i : i + n]) in wins:
                hit |= set(range(i, i + n))
                found.add(str(item))
    return len(words), len(hit), sorted(found)


ITEMS = [(10, "a b c d e f g h i j k l"), (9, "Short ÉCLAT item"), (8, None), (7, ""), (6, "x"), (10, "a b c d e f g h i j k l")]


@pytest.mark.parametrize("most", [0, 1000])
def test_contamination(spark, most):
    rng = random.Random(1)
    texts = [None, "", "...", "x", "X x!", "A B c d e f g h i j k l m", "short Éclat item", "short ÉCLAT, item. short ÉCLAT item", "b c d e f g h i j k"]
    texts += [" ".join(rng.choice("abcdefghijkl") for _ in range(40)) + " a b c d e f g h i j k l" for _ in range(5)] + ["z " * 30_000 + "a b c d e f g h i j"]
    docs = docs_of(spark, *texts, texts[5], ids=[*range(len(texts)), 5])
    bench = spark.createDataFrame([(*i, "extra") for i in ITEMS], "item_id bigint, text string, words string")
    got = decontaminate.contamination(docs, bench, max_broadcast_windows=most).collect()
    want = sorted((i, *brute_hits(t, ITEMS)) for i, t in [*enumerate(texts), (5, texts[5])])
    assert sorted((r["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in got) == want
    assert decontaminate.contamination(docs, bench.limit(0)).where("n_hit > 0").count() == 0
    assert decontaminate.contamination(docs.limit(0), bench).count() == 0


def test_contaminated_rows_go(spark):
    docs = docs_of(spark, None, "x", "clean words", "the short ÉCLAT item stays", ids=[None, 1, 2, 3])
    bench = spark.createDataFrame([(1, "short ÉCLAT item")], "item_id bigint, text string")
    kept = decontaminate.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns and {r["text"] for r in kept.collect()} == {None, "x", "clean words"}
    cut = {r["doc_id"]: r["text"] for r in decontaminate.cut_spans(docs, bench).collect()}
    assert cut == {None: None, 1: "x", 2: "clean words", 3: "the stays"}


# ---- personal data ----


def luhn(d):
    return sum(x if i % 2 == 0 else x * 2 - 9 * (x > 4) for i, x in enumerate(map(int, d[::-1]))) % 10 == 0


def brute_pii(text):
    text, out = text or "", []
    digits = lambda m: re.sub("[^0-9]", "", m)
    kinds = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 12 <= len(digits(m)) <= 19 and luhn(digits(m))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(digits(m)) <= 15),
    ]
    for k, (name, pattern, valid) in enumerate(kinds):
        out += [(m.start(), k, f"{name}:{m.start()}:{m.end()}") for m in re.finditer(pattern, text) if valid(m[0])]
    return [x[2] for x in sorted(out)]


def test_base_spans(spark):
    rng = random.Random(2)
    parts = ["a@b.co", "_x@y.com", "x@y", "1.2.3.4", "256.1.1.1", "001.2.3.4.5", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (988) 555-2485", "+12", "é", " ", "\U0001f600", "@", ".", "-", "+", "7"]
    texts = [None, "", "@", "a@b.co_x@y.com", "x" * 100_000 + "@", "9" * 100_000, "1." * 20_000, ("a@b.co " * 3000)]
    texts += ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 25))) for _ in range(300)]
    got = {r["doc_id"]: r["s"] for r in pii.with_spans(docs_of(spark, *texts), "s").collect()}
    base = {k.name for k in pii.KINDS if k.base}
    for i, t in enumerate(texts):
        assert [f"{s['kind']}:{s['start']}:{s['end']}" for s in got[i] if s["kind"] in base] == brute_pii(t), t and t[:200]


def test_added_spans_and_redaction(spark):
    texts = ["IBAN DE89 3704 0044 0532 0130 00 ok", "DE89370400440532013001", "social security 078-05-1120", "no 078-05-1120", "call 555-123-4567 now", None]
    got = {r["doc_id"]: [s["kind"] for s in r["s"]] for r in pii.with_spans(docs_of(spark, *texts), "s").collect()}
    assert "iban" in got[0] and "iban" not in got[1] and got[2] == ["ssn"] and got[3] == [] and got[4] == ["local_phone"] and got[5] == []
    clean = pii.redact(docs_of(spark, "é a@b.co, 1.2.3.4!", "nothing", None))
    assert clean.columns == DOC.replace(",", "").split()[::2]
    assert {r["doc_id"]: (r["text"], r["n_chars"]) for r in clean.collect()} == {0: ("é [EMAIL], [IP]!", 16), 1: ("nothing", None), 2: (None, None)}
    plan = clean._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_base_columns_against_sql(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = con.sql(oracles.OP6_BASE)
    got = queries.op6_pii(spark, SF).select(*want.columns)
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())


# ---- licences ----


def test_licences(spark):
    mit = license_scan.TEMPLATES["mit"]
    broken = mit.replace("without restriction", "w/o any restriction").replace("merge, ", "")
    texts = [None, "", "x", "So: ALL rights, reserved. é", f"é one two. {broken} more", "released under the mit license; Released under the MIT License", "of the software and the", "w " * 50_000 + "All rights reserved"]
    got = license_scan.scan_licenses(docs_of(spark, *texts, texts[3], ids=[*range(8), 3])).collect()
    found = sorted((r["doc_id"], r["template"], texts[r["doc_id"]][r["start"] : r["end"]]) for r in got)
    assert [f[:2] for f in found] == [(3, "all-rights-reserved")] * 2 + [(4, "mit"), (5, "mit-notice"), (5, "mit-notice"), (7, "all-rights-reserved")]
    assert found[0][2] == "ALL rights, reserved" and found[2][2].startswith("Permission is") and found[2][2].endswith("Software")
    assert all(r["coverage"] >= 0.8 for r in got)
    assert license_scan.scan_licenses(docs_of(spark, "All rights reserved"), {}).count() == 0


def test_whole_licences_and_versions():
    index = license_scan.Index(license_scan.TEMPLATES)
    words = license_scan.word_hashes
    of = lambda text: [m[0] for m in index.scan(words(text), 0.8)]
    for name, text in license_scan.TEMPLATES.items():
        assert of(f"before it, {text} and after") == [name]
        assert index.scan(words(text), 0.8)[0][1] == len(words(text))
    assert {"apache-2.0-text", "gpl-3.0-text", "lgpl-2.1-text", "mpl-2.0-text", "bsd-3-clause-text", "unlicense-text", "mit-text"} <= set(license_scan.TEMPLATES)
    assert of("This work is licensed under the GNU General Public License, version 7.") == []
    assert of("Licensed under CC BY-NC-SA 4.0.") == ["cc-by-nc-sa-4.0-short"] and of("Licensed under CC BY-NC-SA 1.0.") == []
    assert of("This work is licensed under the GNU Affero General Public License, version 3.") == ["agpl-3.0-notice"]
    assert of("Released under the Apache License.") == []
    affero = license_scan.TEMPLATES["gpl-3.0-text"].replace("GNU General", "GNU Affero General").replace("GNU GENERAL", "GNU AFFERO GENERAL")
    assert "gpl-3.0-text" not in of(affero)


def test_banded_match_is_a_longest_common_subsequence():
    rng = random.Random(3)
    for _ in range(200):
        a, b = ([rng.randrange(4) for _ in range(rng.randrange(1, 12))] for _ in range(2))
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        pairs = license_scan.banded_match(a, b, 0, 12)
        assert len(pairs) == best[-1][-1] and all(a[i] == b[j] for i, j in pairs) and pairs == sorted(pairs)


def test_many_notices_take_linear_time():
    index, notice = license_scan.Index(license_scan.TEMPLATES), "Licensed under the GPL version 2. Then something else, unlike it. "
    for n in (3, 20_000):
        began = time.perf_counter()
        found = index.scan(license_scan.word_hashes(notice * n), license_scan.MIN_COVERAGE)
        assert [f[0] for f in found] == ["gpl-2.0-short"] * n
        assert time.perf_counter() - began < 30


def test_met_spans():
    rng, kept, plain = random.Random(8), license_scan.Spans(), []
    for _ in range(2000):
        a = rng.randrange(3000)
        b = a + int(rng.paretovariate(0.7)) % 500
        assert sorted(kept.met(a, b)) == sorted(s for s in plain if s[0] <= b and a <= s[1])
        if rng.random() < 0.3:
            kept.add(a, b)
            plain.append((a, b))


@pytest.mark.parametrize("text", ["SPDX-License-Identifier: EPL-2.0", "This work is licensed under the Eclipse Public License, version 1.0."])
def test_notices_of_epl(text):
    (found,) = license_scan.Index(license_scan.TEMPLATES).scan(license_scan.word_hashes(text), license_scan.MIN_COVERAGE)
    assert found[0].startswith("epl-" + ("2.0" if "2.0" in text else "1.0"))


# ---- pages ----


def test_main_text(spark):
    weight = html_text.weights({})
    of = lambda h: html_text.main_text(h, weight)
    page = (
        "<html><head><title>t</title><style>p{}</style></head><body><nav><a href='/'>Home</a></nav><div class='ad'>Buy now</div>"
        "<article><h1>A &amp; B</h1><p>One <b>t</b>wo\n three<br>four<script>x('</p>')</script><aside>not this</aside><p>Last."
        "<div class='comments'><article class='comment'>nope</article></div></article><footer>&copy; x</footer></body></html>"
    )
    assert of(page) == "A & B One two three four Last."
    assert of("") == "" and of("<p></p>") == "" and of("<!-- x") == ""
    assert of("<div id=menu>a b</div><p>Some plain words here</p><p>and more</p><form>no</form>") == "Some plain words here and more"
    assert of("<nav>never closed<article>text &lt;3</article>") == "text <3"
    assert of("<" * 1000 + "a") is not None
    pages = spark.createDataFrame([(1, None, None, 1), (2, "u", "", 1), (2, "u", page, 1), (2, "u", page, 1)], "page_id bigint, url string, html string, text int")
    got = html_text.extract(pages, html_text.learn_weights(pages)).collect()
    assert sorted((r["page_id"], r["text"], r["n_chars"]) for r in got) == [(1, "", 0), (2, "", 0), (2, of(page), 30), (2, of(page), 30)]


def test_boxes_are_named_by_whole_classes():
    of = lambda h: html_text.main_text(h, html_text.weights({}))
    few, long = "a few words", " ".join(f"word{i}" for i in range(30))
    for opening in ("article class='post category-social'", "div class='content no-sidebar'", "div class='main has-comments'", "section class='article-body header-fixed'"):
        tag = opening.split()[0]
        assert of(f"<{opening}><p>{few}</p></{tag}><div class=x><p>{long}</p></div>") == f"{few} {long}"
    for name in ("sidebar", "comments", "ad-slot", "site-footer", "cookie-banner", "x related-posts"):
        assert of(f"<p>{long}</p><div class='{name}'><p>{few}</p></div>") == long
    assert of(f"<div class=widget><div class='banner'><p>{long}</p></div><div class=ad>{few}</div></div>") == long
    assert of(f"<form><p>{long}</p></form>") == long
    assert of(f"<p>{few}</p><div class=comments><p>{long}</p></div>") == few
    for tag in ("object", "canvas", "svg", "math"):
        assert of(f"<p>{few}</p><{tag}><p>{long}</p>").endswith(long)
        assert of(f"<p>{few}</p><{tag}>x</{tag}><p>{long}</p>") == f"{few} {long}"


OUTSIDE = (
    "<section id='discussion'><p>{}</p><p>{}</p></section>", "<div class='gdpr-bar-x'><p>{}</p></div>", "<ins class='adsbygoogle'>{}</ins>",
    "<div class='ad-wrapper-300x250'>{}</div>", "<div class='inline-newsletter-cta'><h3>{}</h3><p>{}</p></div>", "<div hidden>{}</div>",
    "<p style='color: red; display : none'>{}</p>", "<section class='related'><article class='teaser'><p>{}</p></article><article><p>{}</p></article></section>",
)


@pytest.mark.parametrize("block", OUTSIDE)
def test_boxes_inside_and_after_the_text(block):
    long, said = " ".join(f"word{i}" for i in range(60)), "some plain words that a reader or an advert says"
    block = block.format(said, said)
    for weight in (html_text.weights({}), {"word": 3.0, "word:link": -0.5, "word:box": -4.0}):
        of = lambda h: html_text.main_text(h, weight)  # noqa: B023, E731
        for page in ("<article><p>{0}</p>{1}<p>{0}</p></article>{1}", "<div class=content><p>{0}</p>{1}<p>{0}</p>{1}</div>"):
            assert of(page.format(long, block)) == f"{long} {long}"
    shown = "<div data-hidden=1 class='hidden-x' title='a hidden thing'><p>{0}</p></div>"
    assert of(f"<p>{long}</p>" + shown.format("tail of it")) == f"{long} tail of it"


@pytest.mark.parametrize("page", ["{0}{2}{1}", "{0}{2}", "{0}{2}{0}", "{0}<article>{2}</article>{0}{1}"])
@pytest.mark.parametrize("tag", ["div class=sidebar", "nav", "article", "p class=ad", "span class=ad"])
def test_deep_pages_take_linear_time(tag, page):
    began = time.perf_counter()
    html_text.count_classes(page.format(f"<{tag}>" * 8000, f"</{tag.split()[0]}>" * 8000, "plain words here " * 20))
    text = html_text.main_text(page.format(f"<{tag}>" * 8000, f"</{tag.split()[0]}>" * 8000, "plain words here " * 20), html_text.weights({}))
    assert time.perf_counter() - began < 5 and text in ("", ("plain words here " * 20).strip())


def test_the_run_decides_and_not_the_tag():
    of = lambda h: html_text.main_text(h, html_text.weights({}))
    long = " ".join(f"word{i}" for i in range(60))
    beside = of(f"<nav><a>Home</a></nav><div class=content><p>{long}</p><p>end of it</p></div><article><p>See also this</p></article>")
    assert beside.startswith(f"{long} end of it")
    within = of(f"<div class=content><p>{long}</p><article class=embed><p>card</p></article><p>{long}</p></div>")
    assert within == f"{long} card {long}"
    assert of(f"<article><p>{long}</p></article><article><p>second part {long}</p></article>") == f"{long} second part {long}"
    split = of(f"<article><p>{long}</p><nav>{long}</nav><p>short tail</p></article><footer>x</footer>")
    assert split == f"{long} short tail"


def test_pages_against_their_articles(spark):
    rows = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = {r["page_id"]: r["text"] for r in queries.op2_html_text(spark, SF).collect()}
    for page_id, h in rows.items():
        article = re.search("<article>(.*?)</article>", h, re.S)[1]
        text = re.sub(r"<[^>]+>", "", re.sub(r"<(/?)(p|h1|br)\b[^>]*>", " ", article))
        assert got[page_id] == " ".join(html_lib.unescape(text).split())


def test_best_run_is_the_best():
    rng = random.Random(4)
    for _ in range(200):
        s = [rng.randrange(-5, 6) for _ in range(rng.randrange(0, 12))]
        a, b = html_text.best_run(s)
        assert sum(s[a:b]) == max([0, *(sum(s[i:j]) for i in range(len(s)) for j in range(i + 1, len(s) + 1))])


# ---- chat ----


def test_chat_round_trip(spark):
    rng = random.Random(5)
    words = ["hi", "<turn:user>", "</turn>\n", "\\", "<", ">", "é", "", None]
    data = [(c, t, rng.choice(["user", "assistant", "system", "<x>", None]), rng.choice(words)) for c in range(60) for t in range(rng.randrange(1, 6))]
    data += [(100 + c, t, r, x) for c in range(40) for t, (r, x) in enumerate([("user", "same start"), ("assistant", "ok"), ("user", str(c % 3))])]
    data += [(None, 1, "user", "a"), (None, None, "assistant", "b"), (7, 0, "user", "x"), (7, 0, "user", "x")]
    table = spark.createDataFrame([(*d, 1) for d in data], "conv_id bigint, turn bigint, role string, text string, path int")
    for size in (1, 200, chat.PACK_CHARS):
        packs = chat.format_conversations(table, size)
        rows = chat.read_packs(packs).collect()
        assert sorted(tuple(t) for r in rows if r["conv_id"] is None for t in r["turns"]) == [("assistant", "b"), ("user", "a")]
        assert sum(r["conv_id"] is None for r in rows) == 2  # a row without an id is a conversation by itself
        read = {r["conv_id"]: r for r in rows if r["conv_id"] is not None}
        own = {}
        for c, t, r, x in data:
            if c is not None:
                own.setdefault(c, []).append(((t is not None, t or 0), r or "", x or ""))
        assert set(read) == set(own)
        for c, turns in own.items():
            turns = [(r, x) for _, r, x in sorted(turns)]
            assert [(t["role"], t["text"]) for t in read[c]["turns"]] == turns
            assert read[c]["learned"] == [x for r, x in turns if r == "assistant"]
            assert read[c]["formatted_chars"] == sum(len(chat.render(r, x)[0]) for r, x in turns)
        for p in packs.collect():
            for n in p["nodes"]:
                assert sum(a["end"] - a["start"] for a in n["attends"]) == n["position"]
                assert all(a["end"] <= n["start"] for a in n["attends"])
    many = chat.format_conversations(table.limit(0).union(table.sparkSession.sql("SELECT cast(null AS bigint), 0L, 'user', 'x', 1 FROM range(5000)")))
    assert chat.read_packs(many).where("conv_id IS NULL AND size(turns) = 1").count() == 5000
    whole = chat.format_conversations(table.where("conv_id >= 100")).coalesce(1).collect()
    assert sum(len(p["nodes"]) for p in whole) <= 5 * len(whole)
    assert chat.format_conversations(table.limit(0)).count() == 0


def test_long_conversations_take_linear_time():
    turns = [(role, f"turn {i}") for i in range(50_000) for role in ("user", "assistant")]
    pack, began = chat.Pack(), time.perf_counter()
    pack.add(1, turns)
    pack.add(2, [*turns[:70_000], ("user", "other"), ("assistant", "end")])
    assert time.perf_counter() - began < 5
    last, fork = pack.nodes[99_999], pack.nodes[-1]
    assert last["attends"] == [{"start": 0, "end": last["start"]}] and last["position"] == last["start"]
    assert [a["end"] for a in fork["attends"]] == [pack.nodes[69_999]["end"], fork["start"]]


def test_long_conversations_in_a_table(spark):
    table = spark.range(20_000).selectExpr("cast(1 AS bigint) conv_id", "id turn", "if(id % 2 = 0, 'user', 'assistant') role", "string(id) text")
    row = chat.read_packs(chat.format_conversations(table)).collect()
    assert len(row) == 1 and [t["text"] for t in row[0]["turns"]] == [str(i) for i in range(20_000)]


# ---- tokens ----


def test_token_counts(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    library, counter, rng = Tokenizer.from_file(path), token_counts.Counter(path), random.Random(6)
    signs = ["a", "Z", " ", "  ", "\n", "\t", "é", "12", "'s", "<|endoftext|>", "!?", " ", "日本", "\U0001f600", " .", "\r\n", "\x0b", "word"]
    for _ in range(600):
        text = "".join(rng.choice(signs) for _ in range(rng.randrange(0, 100)))
        want = len(library.encode(text, add_special_tokens=False).ids)
        assert counter.count(text) == counter.count(text, 16, 2) == want, text
    assert counter.count("ab" * 300, 16, 2) == len(library.encode("ab" * 300).ids)
    texts = [None, "", "<|endoftext|>", "hello world, " * 20_000, " "]
    got = token_counts.token_counts(docs_of(spark, *texts, "x", ids=[None, 1, 2, 3, 4, 4]), path).collect()
    want = [(len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for t in [*texts, "x"]]
    assert sorted((r["n_bytes"], r["n_tokens"]) for r in got) == sorted(want)
    assert all(r["over_limit"] == (r["n_tokens"] > 512) for r in got)


# ---- language ----


def test_language(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = queries.op9_language_id(spark, SF).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in got) >= 0.95 * len(got)
    assert all(0 <= r["score"] <= 1 for r in got)


def test_language_edges(spark):
    docs = docs_of(spark, None, "", "12 !?", "a", "the cat and the dog " * 20_000, "the cat", "the cat")
    model = language_id.fit(docs)
    got = language_id.identify(docs, model).collect()
    assert [r["lang_pred"] for r in sorted(got, key=lambda r: r["doc_id"])] == ["und", "und", "und", "en", "en", "en", "en"]
    assert language_id.fit(docs.withColumn("lang", F.lit(None).cast("string"))) is None
    assert {r["lang_pred"] for r in language_id.identify(docs, None).collect()} == {"und"}
    assert language_id.drop_unidentified(docs).count() == 4 and language_id.drop_unidentified(docs).columns == docs.columns
    assert language_id.identify(docs.limit(0), model).count() == 0


def test_copies_count_once_in_the_sample(spark):
    low = lambda t: (xxhash.xxh64_intdigest(t.encode(), seed=42) & (1 << 30) - 1) / (1 << 30)
    texts = sorted((f"talo ja koira {i}" for i in range(200)), key=low)
    rows = [("fi", t) for t in texts[-2:]] * 100 + [("de", "der Hund und das Haus")] * 3 + [("en", texts[0])] * 150
    rows += [("en", f"the dog {i}") for i in range(60)] + [(None, "x"), ("sv", "12"), ("sv", None)]
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    found = [tuple(r) for r in language_id.sample(docs, 12).collect()]
    want = sorted({t for c, t in rows if c == "en"}, key=low)[:4]
    assert sorted(found) == sorted([("fi", t) for t in texts[-2:]] + [("de", "der Hund und das Haus")] + [("en", t) for t in want])
    assert "uralic" in language_id.fit(docs, 12).families


def test_hidden_names_do_not_clash(spark):
    assert common.hidden(spark.range(1).withColumnRenamed("id", "__x"), "x") == {"x": "__x_"}
    assert json.dumps(hashlib.sha256(b"").hexdigest())
