"""Phrases in texts, accepted references, model rules, brands, merges, parallel database reads and slugs."""

import datetime as dt
import random
import unicodedata

from pyspark.sql import functions as F

from marketloom.functions import attributes, identifiers, text
from marketloom.operators import cleaning, dictionary
from marketloom.sources import listings as sources


def test_phrase_hits_against_brute_force(spark):
    rng = random.Random(2)
    word = lambda n: "".join(rng.choice("abé .") for _ in range(n))
    texts = [(rng.choice("xy"), word(rng.randrange(0, 30))) for _ in range(150)] + [(None, "ab"), ("x", None)]
    phrases = [(rng.choice("xy"), word(rng.randrange(0, 7)), k) for k in range(120)] + [(None, "a", 900), ("x", None, 901)]
    got = dictionary.phrase_hits(spark.createDataFrame(texts, "g string, text string"), spark.createDataFrame(phrases, "g string, phrase string, n int"), ["g"])
    want = {(g, t, p, n) for g, t in texts for h, p, n in phrases if g and g == h and t is not None and p and p in t}
    rows = [(r["g"], r["text"], r["phrase"], r["n"]) for r in got.collect()]
    assert sorted(rows) == sorted(want) and len(rows) > 100
    nothing = spark.createDataFrame([], "g string, phrase string, n int")
    assert dictionary.phrase_hits(spark.createDataFrame(texts, "g string, text string"), nothing, ["g"]).count() == 0


def test_references_by_lists_and_by_rules(spark):
    rows = [
        (1, "REC Watches", "p-51 04!", None), (2, "REC Watches", "none", "the 901-01 model"), (3, "REC Watches", None, "nothing"), (4, "REC Watches", "", "P51-04"),
        (5, "Hamilton", "x H70455133", "t"), (6, "Nobody", "abc", "P5104"), (7, None, "P5104", None), (8, "Hamilton", "none", "REC P5104"),
    ]
    accepted = spark.createDataFrame([("REC Watches", "P-51-04"), ("REC Watches", "901.01"), ("REC Watches", "Z 901.01"), ("REC Watches", "--"), ("REC Watches", None)], "brand string, reference_number string")
    df = spark.createDataFrame(rows, "id int, brand string, reference_number string, listing_title string")
    got = {r["id"]: r["reference_number"] for r in identifiers.with_references(df, accepted).collect()}
    assert got == {1: "P-51-04", 2: "901.01", 3: "", 4: "P-51-04", 5: "H70455133", 6: "abc", 7: "P5104", 8: "none"}


def test_references_cleaned_again(spark):
    rows = [
        (1, "Hamilton", "x h70455133", None), (2, "Hamilton", "H70455133", "H11111111"), (3, "Hamilton", "none", "h22222222"), (4, "Hamilton", "NONE", "h22222222"),
        (5, "Hamilton", None, "h22222222"), (6, "Hamilton", None, "no"), (7, "Nobody", "abc", "h22222222"), (8, None, None, "h22222222"),
    ]
    df = spark.createDataFrame(rows, "id int, brand string, reference_number string, listing_title string")
    got = {r["id"]: r["reference_number"] for r in identifiers.with_recleaned(df, title="listing_title").collect()}
    assert got == {1: "H70455133", 2: "H11111111", 3: "NONE", 4: "H22222222", 5: "H22222222", 6: None, 7: "abc", 8: None}
    plain = {r["id"]: r["reference_number"] for r in identifiers.with_recleaned(df).collect()}
    assert plain == {1: "H70455133", 2: "H70455133", 3: "NONE", 4: "NONE", 5: None, 6: None, 7: "abc", 8: None}


def test_models_and_brands_after_a_shuffle(spark):
    rules = spark.createDataFrame([("A", "Diver", "deep", "sea", -1), ("A", "dive", "flat", "sea", -2), ("B", "dive", "other", "x", 0)], "brand string, alternate string, specific_model string, parent_model string, priority int")
    df = spark.createDataFrame([(1, "A", "DIVER 300"), (2, "A", "a dive"), (3, "B", "diver"), (4, "C", "diver"), (5, "A", None), (1, "A", "DIVER 300")], "id int, brand string, text string")
    got = attributes.models_of(df.repartition(7), rules)
    assert sorted((r["id"], r["specific_model"]) for r in got.collect() if r["specific_model"]) == [(1, "flat"), (1, "flat"), (2, "flat"), (3, "other")]
    assert got.count() == 6 and got.columns == ["id", "brand", "text", "specific_model", "parent_model"]
    brands = spark.createDataFrame([("Seiko", "seiko"), ("Grand Seiko", "Grand-Seiko"), ("Ébel", "ébel"), ("X", "!"), ("Y", None), ("Rado", "seika"), ("Zodiac", "seike")], "name string, alias string")
    titles = [(1, "new GRAND seiko!"), (2, "seikos"), (3, "by ÉBEL"), (4, ""), (5, None), (6, "seika seike"), (7, "grand, Seiko (seiko)")]
    found = attributes.brand_of(spark.createDataFrame(titles, "id int, title string").repartition(5, F.rand(1)), brands)
    assert {r["id"]: r["brand_found"] for r in found.collect()} == {1: "Grand Seiko", 2: None, 3: "Ébel", 4: None, 5: None, 6: "Zodiac", 7: "Grand Seiko"}


def test_upsert_of_repeated_keys(spark):
    target = spark.createDataFrame([(1, "a", 1), (2, "b", 2), (None, "n", 0)], "k int, s string, v int")
    changes = spark.createDataFrame([(2, "x", 5), (2, "y", 4), (3, "p", 1), (3, "q", 2), (None, "m", 1), (None, "m", 1)], "k int, s string, v int")
    got = cleaning.upsert(target, changes, "k", ["s"], order=[F.col("v")])
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, [(1, "a", 1), (2, "y", 2), (None, "n", 0), (3, "p", 1), (None, "m", 1), (None, "m", 1)]))


def test_merge_rewrites_only_weeks_that_it_touches(spark, tmp_path):
    path = str(tmp_path / "lake")
    a, b, c, d = (dt.date(2024, 1, k) for k in (7, 14, 21, 28))
    schema = "hash_id string, date date, price double, brand string"
    sources.write_weeks(spark.createDataFrame([("1", a, 1.0, "A"), ("2", b, 2.0, "B"), ("3", b, 3.0, "B"), ("4", c, 4.0, "C")], schema), path)
    files = lambda: {(p.name, p.stat().st_mtime_ns) for p in (tmp_path / "lake").rglob("*.parquet")}
    before = files()
    changes = spark.createDataFrame([("2", b, 9.0, "Z"), ("2", b, 8.0, "Z"), ("5", d, 5.0, "D"), ("5", d, 6.0, "D")], schema)
    for _ in range(2):  # a rerun changes nothing
        sources.merge_weeks(path, changes, "hash_id", ["price"], order=[F.desc("price")])
        got = spark.read.parquet(path).select("hash_id", "date", "price", "brand").collect()
        assert sorted(map(tuple, got)) == [("1", a, 1.0, "A"), ("2", b, 9.0, "B"), ("3", b, 3.0, "B"), ("4", c, 4.0, "C"), ("5", d, 6.0, "D")]
    kept = {f for f in before if f in files()}
    assert len(kept) == 2 and len(before) == 3


def test_merge_takes_changes_once_and_does_not_sort_the_table(spark, tmp_path, monkeypatch):
    """Few changes and many, which aren't broadcast: the same rows; changes are computed once, no task sorts or gathers the table by key."""
    week = lambda k: dt.date(2024, 1, 7) + dt.timedelta(days=7 * (k % 4))
    schema, one, write = "hash_id string, date date, price double, brand string", dt.date(2024, 1, 7), sources.write_weeks
    # Keys that stand on several dates, one that is in very many rows, rows without a key or a date.
    table = [(str(k % 40), week(k // 3), float(k), "A") for k in range(120)] + [("hot", one, float(k), "B") for k in range(60)]
    table += [(None, week(k), 7.0, "N") for k in range(3)] + [("dateless", None, 1.0, "D")]
    fresh = [(str(k), one, 1000.0 + k, "C") for k in range(30, 50)] + [("hot", one, 5.0, "C"), ("30", one, 1.0, "C"), ("dateless", one, 2.0, "C"), (None, week(1), 8.0, "C")]
    best = {k: (k, d, max(p for j, _, p, _ in fresh if j == k), b) for k, d, _, b in fresh if k is not None}
    known = {k for k, *_ in table}
    want = [(k, d, best[k][2] if k in best else p, b) for k, d, p, b in table] + [r for k, r in best.items() if k not in known] + [fresh[-1]]
    plans, times = [], spark.sparkContext.accumulator(0)

    def counted(parts):
        for rows in parts:
            times.add(len(rows))
            yield rows

    def planned(df, path):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        write(df, path)

    monkeypatch.setattr(sources, "write_weeks", planned)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for most, rows_a_task in ((100, 1_000_000), (3, 1_000_000), (3, 30)):
            monkeypatch.setattr(sources, "MAX_BROADCAST_CHANGES", most)
            monkeypatch.setattr(sources, "ROWS_A_TASK", rows_a_task)
            path = str(tmp_path / f"lake-{most}-{rows_a_task}")
            write(spark.createDataFrame(table, schema), path)
            times.value = 0
            changes = spark.createDataFrame(fresh, schema).mapInPandas(counted, schema)
            sources.merge_weeks(path, changes, "hash_id", ["price"], order=[F.desc("price")])
            assert times.value == len(fresh)
            got = spark.read.parquet(path).select("hash_id", "date", "price", "brand").collect()
            assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    few, many, dealt = plans
    assert not any("SortMergeJoin" in p for p in plans) and "ShuffledHashJoin" not in few and "BroadcastHashJoin" in few
    assert "ShuffledHashJoin" in many and ", 4), REPARTITION_BY_NUM" in many
    assert "ShuffledHashJoin" in dealt and ", 7), REPARTITION_BY_NUM" in dealt  # 184 rows and 23 changes


def test_a_database_is_read_by_ranges(spark, tmp_path):
    url = f"jdbc:derby:{tmp_path}/db;create=true"
    rows = [(k, dt.date(2024, 1, 1) + dt.timedelta(days=k)) for k in range(40)] + [(99, None)]
    sources.write_jdbc(spark.createDataFrame(rows, "N int, DAY date"), url, "PRICES")
    for column in ("N", "DAY"):
        got = sources.read_jdbc(spark, url, "PRICES", by=column, partitions=4)
        assert got.rdd.getNumPartitions() == 4 and sorted(r["N"] for r in got.collect()) == [*range(40), 99]
        sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
        assert len(sizes) == 4 and max(sizes) <= 12 if column == "DAY" else len(sizes) >= 2
        assert "PushedFilters: [*IsNotNull(N), *GreaterThan(N,35)]" in got.where("N > 35")._jdf.queryExecution().executedPlan().toString()
    empty = sources.read_jdbc(spark, url, "PRICES", by="N").where("N > 1000")
    assert empty.count() == 0
    sources.write_jdbc(spark.createDataFrame([], "N int, DAY date"), url, "NOTHING")
    assert sources.read_jdbc(spark, url, "NOTHING", by="DAY").count() == 0


def test_history_prunes_by_a_subquery(spark, tmp_path):
    path = str(tmp_path / "lake")
    rows = [("A", dt.date(2020, 1, 5), 1), ("A", dt.date(2024, 1, 7), 2), ("B", dt.date(2024, 6, 2), 3)]
    sources.write_weeks(spark.createDataFrame(rows, "brand string, date date, n int"), path)
    got = sources.history(spark.read.parquet(path), ["A"], 1.5)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "Subquery" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert [r["n"] for r in got.collect()] == [2]
    assert sources.history(spark.read.parquet(path), ["Q"], 1.5).collect() == []


def test_slug_is_the_compatibility_decomposition(spark):
    chars = [chr(c) for c in [*range(1, 0xD800), *range(0xE000, 0x10000), *range(0x1D400, 0x1D800), *range(0x1F100, 0x1F200)]]
    df = spark.createDataFrame([(k, f"a{c}b") for k, c in enumerate(chars)], "k int, s string").repartition(8)
    got = {r["k"]: r["a"] for r in df.select("k", text.ascii_of(F.col("s")).alias("a")).collect()}
    want = {k: unicodedata.normalize("NFKD", f"a{c}b").encode("ascii", "ignore").decode() for k, c in enumerate(chars)}
    assert got == want
    names = ["A. Lange & Söhne", " Ångström—Œuvre ", "ﬁne ½ №9 ㎏", "Łódź ", "日本", None, "a_b -- c"]
    slugs = [r["s"] for r in spark.createDataFrame([(n,) for n in names], "n string").select(text.slug(F.col("n")).alias("s")).collect()]
    assert slugs == ["a-lange-sohne", "angstromuvre", "fine-12-no9-kg", "odz", "", None, "a_b-c"]


def test_rows_of_hot_texts_are_dealt_and_equal_phrases_are_looked_for_once(spark):
    rng = random.Random(5)
    texts = [None, "a title", "no number", *[f"watch {k}" for k in range(40)]]
    rows = [(k, rng.choice("xy"), rng.choice(texts[:3] if k % 2 else texts)) for k in range(600)] + [(600, None, "watch 1")]
    phrases = [(g, f"{k}", n) for g in "xy" for k in range(12) for n in range(5)] + [("x", "title", 7)]
    df = spark.createDataFrame(rows, "id int, g string, text string").repartition(3)
    listed = spark.createDataFrame(phrases, "g string, phrase string, n int")
    want = {k: min(((p, n) for h, p, n in phrases if g == h and t is not None and p in t), default=None, key=lambda v: (v[1], v[0])) for k, g, t in rows}
    for hot in (0, 50, 10_000):
        out = dictionary.with_best_phrase(df, F.col("text"), listed, ["g"], [F.col("n")], {"p": F.col("phrase"), "n": F.col("n")}, hot=hot)
        assert {r["id"]: r["p"] and (r["p"], r["n"]) for r in out.collect()} == want and out.count() == len(rows)
    twice = dictionary.with_best_phrases(df, {"a": F.col("text"), "b": F.lit("my title")}, listed, ["g"], [F.col("n")], F.col("n"), hot=50).collect()
    assert {r["id"]: r["a"] for r in twice} == {k: v and v[1] for k, v in want.items()} and {r["b"] for r in twice if r["g"] == "x"} == {7}
    many = spark.createDataFrame([(f"RW{k}",) for k in range(3000)], "phrase string")
    filed = dictionary._index(many, []).groupBy("__gram").count().agg(F.max("count")).first()[0]
    assert filed <= 12, filed
