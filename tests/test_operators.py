import datetime as dt

import pytest
from pyspark.sql import functions as F

from marketloom.operators import cleaning, enrichment, liquidity, outliers, profile, series, standardise, volatility, weekly
from marketloom.plans import pipelines

SUNDAY = dt.date(2024, 1, 7)


def week(n):
    return SUNDAY + dt.timedelta(7 * n)


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_weekly_aggregate(spark):
    df = spark.createDataFrame(
        [("1", SUNDAY, "B", "R", None, 100.0, "b"), ("2", SUNDAY, "B", "R", "P", 200.0, "a"), ("3", SUNDAY, "B", "R", "Q", 400.0, None), ("4", SUNDAY, None, "R", "Q", 1.0, None)],
        "hash_id string, date date, brand string, reference_number string, parent_model string, price double, source string",
    ).withColumns({c: F.lit(None).cast("string") for c in ("group_reference", "specific_model", "currency")} | {"year_introduced": F.lit(1)})
    got = weekly.weekly(df, "reference").collect()
    assert len(got) == 1
    r = got[0]
    assert (r["median_price"], round(r["mean_price"], 2), r["high"], r["low"], r["count"], r["source"], r["parent_model"]) == (200, 233.33, 400, 100, 3, "a, b", "P")
    assert r["identifier"] == "b-R"


def test_gap_fill(spark):
    df = spark.createDataFrame([("A", week(0), 5.0, "x"), ("B", week(3), None, "y"), ("B", week(0), 7.0, None)], "brand string, date date, median_price double, condition string")
    end = series.last_sunday(df)
    got = rows(series.extend_and_fill(df, ["brand"], ["median_price"], end).where("brand = 'A'"), "date", "median_price", "condition")
    assert got == [(week(0), 5.0, "x"), (week(1), 5.0, None), (week(2), 5.0, None), (week(3), 5.0, None)]
    assert rows(series.extend_and_fill(df, ["brand"], ["median_price"], end).where("brand = 'B'"), "date") == [(week(0),), (week(3),)]
    again = series.extend_and_fill(series.extend_and_fill(df, ["brand"], ["median_price"], end), ["brand"], ["median_price"], end)
    assert again.count() == 6


@pytest.mark.parametrize(
    "values,want",
    [([100, 110, 120, 130, 140, 150, 160], [100, 105, 110, 115, 120, 130, 140]), ([100, None, 120, 130, 140, 150], [100, 100, 110, 116.67, 122.5, 135])],
)
def test_rolling_average(spark, values, want):
    df = spark.createDataFrame([("A", week(i), None if v is None else float(v), None) for i, v in enumerate(values)], f"brand string, date date, median_price double, {series.ROLLING} double")
    got = series.rolling_average(df, ["brand"], decimals=2).orderBy("date").collect()
    assert [r[series.ROLLING] for r in got] == want


def test_rolling_average_keeps_what_is_there(spark):
    df = spark.createDataFrame([("A", week(i), 10.0 * i, 1.0 if i == 1 else None) for i in range(4)], f"brand string, date date, median_price double, {series.ROLLING} double")
    got = series.rolling_average(df, ["brand"]).orderBy("date").collect()
    assert [r[series.ROLLING] for r in got] == [None, 1.0, 10.0, 15.0]


def test_changes(spark):
    data = [100, 105, 110, 120, 120, 125, 150]
    df = spark.createDataFrame([("A", week(i), float(v)) for i, v in enumerate(data)], f"brand string, date date, {series.ROLLING} double")
    r = series.changes(df, ["brand"], F.lit(week(6)), decimals=2).where(F.col("date") == week(6)).first()
    assert (r["pct_change_1w"], r["dol_change_1w"], r["pct_change_1m"], r["dol_change_1m"], r["pct_change_3m"]) == (20.0, 25.0, 42.86, 45.0, None)
    zero = df.withColumn(series.ROLLING, F.when(F.col("date") == week(5), 0.0).otherwise(F.col(series.ROLLING)))
    r = series.changes(zero, ["brand"], F.lit(week(6))).where(F.col("date") == week(6)).first()
    assert (r["pct_change_1w"], r["dol_change_1w"]) == (None, 150.0)


def test_one_shuffle_for_the_series(spark):
    df = spark.createDataFrame([("A", week(0), 1.0, None)], f"brand string, date date, median_price double, {series.ROLLING} double")
    end = F.lit(week(2)).cast("date")
    out = series.changes(series.rolling_average(series.extend_and_fill(df, ["brand"], ["median_price"], end), ["brand"]), ["brand"], end)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Python" not in plan


def test_volatility_of_months(spark):
    closes = [(dt.date(2024, 1, 28), 100.0), (dt.date(2024, 2, 25), 110.0), (dt.date(2024, 3, 31), 105.0), (dt.date(2024, 4, 28), 120.0)]
    df = spark.createDataFrame([("A", "R", d, v) for d, v in closes], "brand string, reference_number string, date date, p double")
    got = volatility.volatility(df, price="p", min_weeks={"1M": 0}).first()
    assert round(got["volatility_1m"], 2) == 32.86 and got["identifier"] == "a-R"


def test_no_return_beside_a_gap(spark):
    df = spark.createDataFrame([("A", dt.date(2024, 1, 7), 1.0), ("A", dt.date(2024, 3, 3), 2.0)], "brand string, date date, p double")
    assert [r["log_return"] for r in volatility.resample(df, ["brand"], "1M", "p").collect()] == [None, None]


def test_durations(spark):
    seen = [("u1", 0), ("u2", 0), ("u2", 2), ("u3", 0), ("u3", 4), ("u4", 6)]
    df = spark.createDataFrame([(u, week(n), "B", "R", u) for u, n in seen], "watch_url string, date date, brand string, reference_number string, hash_id string")
    r = liquidity.listing_durations(df).first()
    assert (r["count"], round(r["mean_days"], 2), r["median_days"], round(r["std_days"], 2), round(r["std_weeks"], 2)) == (3, 16.33, 14, 10.69, 1.53)
    assert liquidity.duration_report(df, liquidity.listing_durations(df)).first()["active"] == 1


def test_thresholds(spark):
    twelve = spark.createDataFrame([("X", 100.0 + 10 * i) for i in range(12)] + [("Z", 100.0 + 10 * i) for i in range(21)] + [("Y", 1.0)] * 10, "brand string, price double")
    stats = outliers.with_category(outliers.group_statistics(twelve, ["brand"]))
    at = {r["brand"]: r for r in outliers.thresholds(stats, True, {"X": (10, 4)}).collect()}
    assert (at["X"]["q1"], at["X"]["iqr"], at["X"]["upper_boundary"]) == (127.5, 55.0, 732.5)
    assert round(at["X"]["lower_boundary"], 3) == 19.375
    assert (at["Z"]["category"], at["Z"]["upper_boundary"], at["Z"]["lower_boundary"]) == ("confidence", 650.0, 25.0)
    assert at["Y"]["upper_boundary"] is None and at["Y"]["lower_boundary"] is None
    model = {r["brand"]: r for r in outliers.thresholds(stats, False, {"X": (10, 4)}).collect()}
    assert model["X"]["lower_boundary"] == pytest.approx(23.25)


def test_outlier_filter(spark):
    bounds = spark.createDataFrame([("B", "R", 100.0, 200.0), ("B", "S", None, None), ("B", "T", 1.0, None)], "brand string, reference_number string, lower_boundary double, upper_boundary double")
    data = [("R", 100.0, "New"), ("R", 200.0, "Pre-Owned"), ("R", 99.99, "New"), ("S", 5.0, "New"), ("T", 5.0, "New"), ("R", 1.0, None), ("R", 2.0, "<NA>"), ("R", 150.0, "Modified")]
    df = spark.createDataFrame([("B", *d) for d in data], "brand string, reference_number string, price double, condition string")
    assert rows(outliers.filter_outliers(df, bounds, bounds), "price") == [(1.0,), (2.0,), (5.0,), (100.0,), (200.0,)]


def test_makeup(spark):
    df = spark.createDataFrame([("A", SUNDAY, c) for c in ["New"] * 3 + ["Pre-Owned"]] + [("B", SUNDAY, "New")] * 8 + [("C", SUNDAY, "Modified")], "brand string, date date, condition string")
    got = {r["brand"]: r for r in weekly.market_makeup(df, ["brand"]).collect()}
    assert (got["A"]["numb_of_total_listings"], got["A"]["pct_new"], got["A"]["pct_pre_owned"], got["A"]["listings_popularity_score"]) == (4, 75, 25, 50)
    assert got["C"]["numb_of_total_listings"] == 0 and got["C"]["pct_new"] is None
    assert weekly.market_makeup(df, ["brand"], ["brand"]).where("brand = 'A'").first()["listings_popularity_score"] == 100


def test_dedupe(spark):
    data = [(1, "a", "eBay"), (2, "a", "eBay Sold"), (3, "b", "x"), (4, "b", "eBay"), (5, "c", "x"), (6, "c", "y"), (7, None, "x"), (8, None, "y")]
    df = spark.createDataFrame([(i, SUNDAY, u, s) for i, u, s in data], "ingest_id int, date date, watch_url string, source string")
    assert rows(cleaning.dedupe_listings(df, "ingest_id"), "ingest_id") == [(2,), (4,), (5,), (7,)]


def _raw(spark, *changes):
    base = dict(ingest_id=0, date=SUNDAY, status=None, reference_number="ab1", watch_url="u", source="ebay", price="1,000", brand="B", currency="EUR", year_introduced=None, year_of_production="1980s")
    data = [base | {"ingest_id": i, "watch_url": f"u{i}"} | c for i, c in enumerate(changes)]
    kinds = "ingest_id int, date date, status string, reference_number string, watch_url string, source string, price string, brand string, currency string, year_introduced string, year_of_production string"
    return spark.createDataFrame([tuple(d.values()) for d in data], kinds)


def test_cleaning_chain(spark):
    raw = _raw(
        spark, {}, {"status": "Deleted"}, {"reference_number": None}, {"reference_number": "n/a"}, {"reference_number": " 0-. "},
        {"price": "ask"}, {"brand": None}, {"reference_number": "ref.x1, does not apply"}, {"reference_number": "'(x2)"},
    )
    got = cleaning.clean_listings(raw).orderBy("ingest_id").collect()
    assert [(r["ingest_id"], r["reference_number"], r["price"], r["source"], r["year_of_production"]) for r in got] == [
        (0, "AB1", 1000.0, "eBay", 1980), (7, "X1", 1000.0, "eBay", 1980), (8, "X2", 1000.0, "eBay", 1980),
    ]
    assert cleaning.clean_listings(raw.limit(0)).count() == 0


def test_exchange(spark):
    rates = spark.createDataFrame([("EUR", 0.92)], "currency string, rate double")
    df = spark.createDataFrame([("EUR", 100.0), ("USD", 1.005), ("XYZ", 5.0)], "currency string, price double")
    assert sorted(map(str, (r["price"] for r in cleaning.to_usd(df, rates).collect()))) == ["1.005", "108.7", "None"]


def test_library_fill(spark):
    library = spark.createDataFrame(
        [("B", "R1", "G1", None, "S1", 1950), ("B", "R2", "G1", "P2", "S2", 1960)],
        "brand string, reference_number string, group_reference string, parent_model string, specific_model string, year_introduced int",
    )
    df = spark.createDataFrame([("B", "R1", "", "", "own", 0), ("B", "zz", "G1", None, "", None), ("C", "R1", "", "", "", 0)], library.schema)
    got = enrichment.fill_from_library(df, library).orderBy("brand", "reference_number").collect()
    assert tuple(got[0]) == ("B", "R1", "G1", "P2", "own", 1950)
    assert tuple(got[1]) == ("B", "zz", "G1", "P2", "S1", 1950)
    assert tuple(got[2]) == ("C", "R1", None, None, None, None)


def test_upsert_is_idempotent(spark):
    target = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "k int, s string, v int")
    fresh = spark.createDataFrame([(2, "new", 9), (3, "c", 3)], "k int, s string, v int")
    once = cleaning.upsert(target, fresh, "k", ["s"])
    assert rows(once, "k", "s", "v") == [(1, "a", 1), (2, "new", 2), (3, "c", 3)] == rows(cleaning.upsert(once, fresh, "k", ["s"]), "k", "s", "v")


def test_profile(spark):
    df = spark.createDataFrame([("A", SUNDAY, "x"), ("A", week(1), "y"), ("A", week(1), None), ("B", SUNDAY, "x")], "brand string, date date, v string")
    assert rows(profile.null_counts(df, ["brand"], "v"), "brand", "null_count") == [("A", 1), ("B", 0)]
    assert rows(profile.latest_dates(df, ["brand"]), "latest") == [(SUNDAY,), (week(1),)]
    assert rows(profile.modes(df, ["brand"], "v"), "mode") == [("x",), ("x",)]
    assert profile.column_census(df).where("column = 'v'").first()["nulls"] == 1
    assert rows(series.recent_dates(df, 1), "date") == [(week(1),), (week(1),)]


def test_ingest_to_prices(spark):
    raw = _raw(spark, {"brand": "Hamilton", "reference_number": "H70455133"}, {"brand": "Hamilton", "reference_number": "H70455133", "price": "2,000"})
    raw = raw.withColumns({c: F.lit(None).cast("string") for c in ("group_reference", "parent_model", "specific_model", "condition")} | {"listing_title": F.lit("t")})
    rates = spark.createDataFrame([("EUR", 0.5, SUNDAY)], "currency string, rate double, as_of date")
    clean = pipelines.ingest(raw, rates)
    library = spark.createDataFrame([("Hamilton", "H70455133", "G", "Khaki", "Field", 2010)], "brand string, reference_number string, group_reference string, parent_model string, specific_model string, year_introduced int")
    bounds = spark.createDataFrame([], "date date, brand string, reference_number string, lower_boundary double, upper_boundary double")
    history = spark.createDataFrame([("Hamilton", "H70455133", week(-1), 1000.0, 1000.0)], f"brand string, reference_number string, date date, median_price double, {series.ROLLING} double")
    r = pipelines.reference_prices(clean, library, bounds, bounds, history)["prices"].first()
    assert (r["median_price"], r[series.ROLLING], r["dol_change_1w"], r["parent_model"], r["count"]) == (3000.0, 2000, 1000, "Khaki", 2)


def test_standardise(spark):
    names = ["date", "listing_title", "condition", "movement", "clasp_type", "bracelet_material", "currency", "price", "year_of_production", "decade_of_production", "between_lugs", "description", "features", "brand"]
    row = (SUNDAY, "Unworn automatic \\u0026 box", None, "", "", "pin buckle leather", "usd", "$3,000.50", "c. 1988", "", "20,5 mm", "x" * 300, "Date", "y" * 300)
    df = spark.createDataFrame([row], ", ".join(f"{n} {'date' if n == 'date' else 'string'}" for n in names))
    r = standardise.standardise(df, F.lit("ebay"), ["EUR", "USD"], {"chrono24": "Yes"}).first()
    assert (r["condition"], r["movement"], r["clasp_type"], r["currency"], r["price"], r["year_of_production"]) == ("New", "Automatic", "Pin Buckle, Buckle", "USD", 3000.0, 1988)
    assert (r["decade_of_production"], r["between_lugs"], r["authenticity_guarantee"], len(r["brand"]), r["listing_title"]) == ("1980s", "20.5 mm", "No", 255, "Unworn automatic & box")
    assert "description" not in r.asDict()


def test_firsts_that_tie_are_the_smallest(spark):
    rows = [(1, "b", "JPY"), (1, "b", "GBP"), (1, "b", "USD"), (0, "b", None), (None, "b", "AUD")]
    for k in range(3):
        df = spark.createDataFrame(rows[k:] + rows[:k], "n int, brand string, currency string").coalesce(1)
        assert df.groupBy("brand").agg(weekly.first_non_null("currency", "n").alias("c")).first()["c"] == "GBP"


def test_the_report_from_models_is_that_from_listings(spark):
    day = lambda k: dt.date(2024, 1, 7) + dt.timedelta(days=k)
    rows = [(f"{k % 9}", day(7 * (k % 4)), "A" if k % 9 < 6 else None, f"r{k % 9 % 2}", f"{k}") for k in range(20)] + [("9", day(28), "A", "r0", "99"), (None, day(28), "A", "r1", "98")]
    df = spark.createDataFrame(rows, "watch_url string, date date, brand string, reference_number string, hash_id string")
    models = liquidity.durations_by_model(df)
    stats = liquidity.listing_durations(df)
    assert [tuple(r) for r in liquidity.full_report_of_models(models).collect()] == [tuple(r) for r in liquidity.full_report(df, stats).collect()]
    nothing = liquidity.full_report_of_models(liquidity.durations_by_model(df.where("date IS NULL"))).first()
    assert (nothing["urls"], nothing["active"], nothing["models"]) == (0, 0, 0)
    one = models.agg(F.sum("urls"), F.sum("count")).first()
    assert tuple(one) == (10, 9)
