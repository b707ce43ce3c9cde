import datetime as dt

import pytest
from pyspark.sql import functions as F

from marketloom.functions import attributes, calendar, identifiers, text
from marketloom.functions import vocabularies as V


def one(spark, column, **values):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return row.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "day,nearest,prior,folder",
    [("2024-02-18", 18, 11, 18), ("2024-02-19", 18, 18, 18), ("2024-02-21", 18, 18, 18), ("2024-02-22", 25, 18, 18), ("2024-02-24", 25, 18, 18)],
)
def test_sundays(spark, day, nearest, prior, folder):
    d = F.lit(day).cast("date")
    row = spark.range(1).select(calendar.nearest_sunday(d), calendar.prior_sunday(d), calendar.folder_sunday(d)).first()
    assert [x.day for x in row] == [nearest, prior, folder]


def test_two_quarter_bins(spark):
    first = F.lit("2022-03-31").cast("date")
    days = ["2022-03-31", "2022-04-01", "2022-07-01", "2022-10-02"]
    got = [one(spark, calendar.two_quarter_end(F.col("d").cast("date"), first), d=d) for d in days]
    assert [str(g) for g in got] == ["2022-03-31", "2022-09-30", "2022-09-30", "2023-03-31"]


def test_sundays_between_and_ingest_days(spark):
    a, b = F.lit("2024-01-07").cast("date"), F.lit("2024-01-28").cast("date")
    assert [d.day for d in one(spark, calendar.sundays_between(a, b))] == [14, 21, 28]
    assert one(spark, calendar.sundays_between(b, a)) == []
    assert [d.day for d in one(spark, calendar.ingest_days(F.lit("2024-02-18").cast("date")))] == [15, 16, 17, 18]
    assert one(spark, calendar.ingest_days(F.lit("2024-02-22").cast("date"))) is None


@pytest.mark.parametrize(
    "brand,ref,want",
    [
        ("Rolex", "M126610LN-0001", "126610LN-0001"), ("Rolex", "126610LN 0001", "126610LN-0001"), ("Rolex", "116500LN", "116500LN"),
        ("Rolex", "1987", "1987"), ("Omega", "31030425001001", "310.30.42.50.01.001"), ("A. Lange & Söhne", "191-032", "191.032"),
        ("Panerai", "PAM 111", "PAM00111"), ("Panerai", "00111", "PAM00111"), ("Seiko", "SKX007", "SKX007"), ("Seiko", "6105-8110", "6105-8110"),
        ("Breitling", "AB01-3824/1C1P1", "AB0138241C1P1"), ("Hamilton", "REF H70455133 NEW", "H70455133"), ("IWC", "3714", "IW3714"),
        ("Tissot", "T006.407.11.053.00", "T006.407.11.053.00"), ("Montblanc", "MB 118500", "118500"), ("Longines", "L38124536", "L3.812.4.53.6"),
        ("TAG Heuer", "ABCDEF", "ABCDEF"), ("Oris", "0173377204054", "01 733 7720 4054"), ("Vacheron Constantin", "4600E000AB487", "4600E/000A-B487"),
        ("Nobody", "x1", "x1"), ("Citizen", "nothing", "nothing"), ("Omega", "ST 145.022", "ST 145.0022"), ("Tudor", "M79230N-0009", "M79230N-0009"),
        ("Patek Philippe", "5711/1A 010", "5711/1A-010"), ("Frederique Constant", "FC 303MC5B6", "FC-303MC5B6"), ("Omega", "2254 50", "2254.50.00"),
    ],
)
def test_references(spark, brand, ref, want):
    assert one(spark, identifiers.reference_of(F.lit(brand), F.lit(ref), F.lit("no title"))) == want


def test_reference_from_title(spark):
    of = lambda ref, title: one(spark, identifiers.reference_of(F.lit("Hamilton"), F.lit(ref), F.lit(title)))
    assert of(None, "Khaki H70455133") == of("x", "khaki h70455133") == "H70455133"
    assert of(None, "nothing") == ""


def test_group_reference(spark):
    of = lambda b, r, w=False: one(spark, identifiers.group_reference(F.lit(b), F.lit(r), w))
    assert of("Rolex", "M126610LN-0001") == "126610"
    assert of("Maurice Lacroix", "PT6008-SS001-332") == "PT6008"
    assert of("Patek Philippe", "5711/1A") == "5711"
    assert of("Omega", "310.3042") == "" and of("Omega", "145.0022", True) == "145.0022"


def test_text(spark):
    assert one(spark, text.slug(F.lit("A. Lange & Söhne"))) == "a-lange-sohne"
    assert one(spark, text.slug(F.lit("TAG Heuer"))) == "tag-heuer"
    assert one(spark, text.clean_reference(F.lit(" -é'X(1)"))) == "éX1"
    assert one(spark, text.price_number(F.lit("1,234.5"))) == 1234.5 and one(spark, text.price_number(F.lit("ask"))) is None
    assert [one(spark, text.year_number(F.lit(y))) for y in ("1999", "1980s", "about 1975", None)] == [1999, 1980, 1975, 0]
    hashed = one(spark, text.hash_id(F.lit("2024-01-07").cast("date"), F.lit("http://x/1"), F.lit("eBay")))
    assert hashed == "59472440510a6c9da0097e8591b9fabe53dc62cb27ccbe075c38e9d7a67173f2"
    assert one(spark, F.length(text.cap(F.lit("a" * 300)))) == 255


def test_attributes(spark):
    of = lambda f, *a: one(spark, f(*map(F.lit, a)))
    assert of(attributes.case_material, "Rose gold, steel") == "Rose Gold, Steel"
    assert of(attributes.case_material, "18k yellow gold") == "Gold"
    assert of(attributes.dial_color, "mother of pearl") == "Mother of Pearl"
    assert of(attributes.style, "Diver") == "Dive, Sport"
    assert of(attributes.clasp_type, "pin buckle") == "Pin Buckle, Buckle"
    assert of(attributes.bracelet_color, "white gold") == "White Gold"
    assert of(attributes.condition, "Unworn") == "New" and of(attributes.condition, "?") is None
    assert of(attributes.water_resistance, "100m") == "10.0 ATM" and of(attributes.water_resistance, "0.0") == "Not water resistant"
    assert of(attributes.weight, "120 g") == "120.0 g"
    assert of(attributes.diameter, "45x22mm") == "45.0 x 22.0 mm" and of(attributes.diameter, "4cm") == "40.0 mm"
    assert of(attributes.power_reserve, "3 days") == "72.0 hours" and of(attributes.power_reserve, "42") == "42 hours"
    assert of(attributes.production_decades, "1988-96", "") == "1980s, 1990s"
    assert of(attributes.seller_rating, "95%") == "Excellent" and of(attributes.seller_rating, "3.2") == "Average"
    assert of(attributes.listing_type, "Buy Now, inquire") == "Buy it Now, Contact Seller"
    assert of(attributes.watch_type, "gents") == "Men's Watches"
    assert of(attributes.seller_type, "professional dealer") == "Dealer"
    assert one(spark, attributes.currency_code(F.lit("$"), ["USD", "EUR"])) == "USD"
    assert len(V.FEATURES) == 86


def test_dimension_lookups(spark):
    countries = spark.createDataFrame([("United Kingdom", "uk"), ("Burma", "myanmar")], "name string, alias string")
    df = spark.createDataFrame([("UK",), ("united-kingdom",), ("Mars",)], "country string")
    assert sorted(r[0] for r in attributes.country_of(df, countries).collect()) == ["", "United Kingdom", "United Kingdom"]
    brands = spark.createDataFrame([("Seiko", "seiko"), ("Grand Seiko", "grand seiko")], "name string, alias string")
    titles = spark.createDataFrame([(1, "A Grand Seiko watch"), (2, "seikon"), (3, None)], "id int, title string")
    assert {r["id"]: r["brand_found"] for r in attributes.brand_of(titles, brands).collect()} == {1: "Grand Seiko", 2: None, 3: None}
    rules = spark.createDataFrame([(2, "Rolex", "Sea Dweller", "sub", "Sub"), (1, "Rolex", "deep sea", "deep", "Deep")], "priority int, brand string, alternate string, specific_model string, parent_model string")
    df = spark.createDataFrame([("Rolex", "a Deep Sea dweller")], "brand string, text string")
    assert attributes.models_of(df, rules).first()["specific_model"] == "deep"


def test_years_ago(spark):
    assert one(spark, calendar.years_ago(F.lit("2024-01-01").cast("date"), 1.5)) == dt.date(2024, 1, 1) - dt.timedelta(547)


def test_accepted_references(spark):
    df = spark.createDataFrame([("the 901-2 cockpit",), ("none",)], "title string")
    accepted = spark.createDataFrame([("9012",), ("44",)], "reference_number string")
    got = identifiers.accepted_reference(df, accepted, "title").collect()
    assert sorted(str(r["accepted_reference"]) for r in got) == ["9012", "None"]
    omega = spark.createDataFrame([("Omega", "ST 145.022", None), ("Omega", "166.000", "g"), ("Rolex", "145.022", "g")], "brand string, reference_number string, group_reference string")
    library = spark.createDataFrame([("Omega", "145.0022")], "brand string, group_reference string")
    got = sorted(tuple(r) for r in identifiers.pad_omega(omega, library).collect())
    assert got == [("Omega", "166.000", "g"), ("Omega", "ST 145.0022", "ST 145.0022"), ("Rolex", "145.022", "g")]
