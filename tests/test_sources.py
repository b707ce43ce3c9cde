import datetime as dt

from pyspark.sql import functions as F

from marketloom.schema import RAW
from marketloom.sources import listings as sources
from marketloom.streaming.weekly import run_by_batch, weekly_stream


def test_weekly_csv(spark, tmp_path):
    (tmp_path / "shop_WEEKLY_2024_02_22.csv").write_text("brand,price,extra\nA,\"1,000\",x\n,,\n")
    (tmp_path / "ebay_completed_sold_weekly_2024_02_19.csv").write_text("price,brand,source\n5,B,other\n")
    (tmp_path / "shop_daily_2024_02_22.csv").write_text("brand,price\nC,1\n")
    got = [sources.read_weekly_csv(spark, [str(p)]).collect() for p in sorted(tmp_path.iterdir())]
    flat = sorted((r["brand"], r["source"], str(r["date"]), r["price"]) for g in got for r in g)
    assert flat == [("A", None, "2024-02-25", "1,000"), ("B", "eBay Sold", "2024-02-18", "5")]
    assert sources.read_weekly_csv(spark, [str(tmp_path / "shop_WEEKLY_2024_02_22.csv")]).columns == RAW.names
    (tmp_path / "empty_weekly_2024_02_22.csv").write_text("")
    (tmp_path / "other_weekly_2024_02_22.csv").write_text("brand,price,extra\nD,7,y\n")
    whole = sources.read_weekly_csv(spark, [str(tmp_path)]).collect()
    assert sorted((r["brand"], r["source"], str(r["date"]), r["price"]) for r in whole) == sorted([*flat, ("D", None, "2024-02-25", "7")])
    assert sources.read_weekly_csv(spark, [str(tmp_path / "shop_daily_2024_02_22.csv")]).count() == 0


def test_model_rules_come_in_the_order_of_lines(spark, tmp_path):
    (tmp_path / "rules.csv").write_text("".join(f"A,model {i},parent,\n" for i in range(400)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    try:
        got = sources.read_model_rules(spark, str(tmp_path / "rules.csv")).orderBy("priority").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [r["specific_model"] for r in got] == [f"model {i}" for i in reversed(range(400))]


def test_a_database_week_is_replaced(spark, tmp_path):
    url = f"jdbc:derby:{tmp_path}/db;create=true"
    week = lambda d, rows: spark.createDataFrame([(d, *r) for r in rows], "date date, brand string, price double")
    a, b = dt.date(2024, 1, 7), dt.date(2024, 1, 14)
    for df in (week(a, [("x", 1.0)]), week(b, [("x", 2.0), ("y", 3.0)]), week(b, [("x", 4.0)]), week(b, [("x", 4.0)])):
        sources.replace_weeks_jdbc(df, url, "prices")
    got = sources.read_jdbc(spark, url, "prices").collect()
    assert sorted((r["DATE"], r["BRAND"], r["PRICE"]) for r in ({k.upper(): v for k, v in r.asDict().items()} for r in got)) == [(a, "x", 1.0), (b, "x", 4.0)]


def test_rerun_replaces_a_week(spark, tmp_path):
    path = str(tmp_path / "lake")
    week = lambda d, brands: spark.createDataFrame([(d, b) for b in brands], "date date, brand string")
    a, b = dt.date(2024, 1, 7), dt.date(2024, 1, 14)
    sources.write_weeks(week(a, ["x", "y"]), path)
    sources.write_weeks(week(b, ["x"]), path)
    sources.write_weeks(week(b, ["z"]), path)
    got = sources.read_lake(spark, path)
    assert sorted((r["date"], r["brand"]) for r in got.collect()) == [(a, "x"), (a, "y"), (b, "z")]
    plan = sources.read_lake(spark, path, first=b, last=b)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan


def test_scans(spark):
    d = dt.date
    df = spark.createDataFrame([("A", d(2024, 1, 7), 1.0, "m"), ("A", d(2024, 1, 7), 0.0, "m"), ("A", d(2024, 1, 7), None, ""), ("A", d(2020, 1, 5), 3.0, "m")], "brand string, date date, price double, m string")
    day = F.lit("2024-01-10").cast("date")
    assert sources.new_listings(df, ["A"], day).count() == 2
    assert sources.latest_week(df, ["A"], "m", day).count() == 1
    assert sources.history(df, ["A"], 1.5).count() == 3 and sources.history(df, ["Q"], 1.5).count() == 0
    assert sources.before(df, ["A"], "2021-01-01").count() == 1
    assert sources.read_template(spark, "SELECT * FROM {t} WHERE price > :p", {"t": df}, p=2).count() == 1


def test_stream(spark, tmp_path):
    schema = "ts timestamp, brand string, price double, id string"
    ts = lambda s: dt.datetime.fromisoformat(s)
    data = [(ts("2024-01-07 12:00:00"), "A", 1.0, "1"), (ts("2024-01-07 12:00:00"), "A", 1.0, "1"), (ts("2024-01-09 12:00:00"), "A", 4.0, "2"), (ts("2024-03-09 12:00:00"), "A", 9.0, "3")]
    spark.createDataFrame(data, schema).coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    query = weekly_stream(stream, "brand", "price", unique="id").writeStream.format("memory").queryName("weeks").outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    got = sorted((str(r["date"]), r["count"], r["mean"]) for r in spark.table("weeks").collect())
    assert got == [("2024-01-07", 1, 1.0), ("2024-01-14", 1, 4.0)]
    seen = []
    run_by_batch(stream, lambda df: seen.append(df.count()), str(tmp_path / "c")).awaitTermination()
    run_by_batch(stream, lambda df: seen.append(df.count()), str(tmp_path / "c")).awaitTermination()
    assert sum(seen) == 4
