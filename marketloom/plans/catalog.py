"""Registered queries over the star-schema tables, seen as market listings, and the same in DuckDB SQL.

Prices are whole numbers, so sums don't depend on their order and both engines agree.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from marketloom.functions import attributes, calendar, identifiers, text
from marketloom.functions import vocabularies as V
from marketloom.operators import cleaning, enrichment, liquidity, outliers, profile, series, volatility, weekly
from marketloom.schema import LEVELS, PRE_OWNED
from marketloom.schema import RATES as RATE_SCHEMA
from marketloom.sources import listings as sources
from marketloom.sources.shared import run_folder
from marketloom.streaming import history as batches
from marketloom.streaming import weekly as streaming

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

RATES = [("EUR", 0.92), ("GBP", 0.79), ("JPY", 150.0)]


def register(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql.strip()
        return f

    return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Dimension sides of more rows are hashed over tasks, each of which gets about so many rows of the side and the line items together.
MAX_LEFT_TO_SPARK, ROWS_A_TASK = 2_000_000, 1_000_000


def _side(line: DataFrame, side: DataFrame, key: str) -> DataFrame:
    """A side as line items meet it: one of many rows is held by tasks in parts, so that line items are not sorted for it."""
    count = side.count()
    if count <= MAX_LEFT_TO_SPARK:
        return side
    tasks = max(int(side.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-(line.count() + count) // ROWS_A_TASK))
    return side.repartition(tasks, key).hint("shuffle_hash")


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as listings. The small dimension sides are left to Spark to broadcast by their size."""
    line, part, supplier, nation, orders = (table(spark, sf_dir, t) for t in ("lineitem", "part", "supplier", "nation", "orders"))
    part, supplier, orders = _side(line, part, "p_partkey"), _side(line, supplier, "s_suppkey"), _side(line, orders, "o_orderkey")
    joined = (
        line.join(part, line.l_partkey == part.p_partkey).join(supplier, line.l_suppkey == supplier.s_suppkey)
        .join(nation, supplier.s_nationkey == nation.n_nationkey).join(orders, line.l_orderkey == orders.o_orderkey)
    )
    day = F.to_date("l_shipdate")
    currency = F.when(F.col("n_regionkey") == 0, "USD").when(F.col("n_regionkey") == 1, "EUR").when(F.col("n_regionkey") == 2, "GBP").when(F.col("n_regionkey") == 3, "JPY").otherwise("CHF")
    condition = F.when(F.col("l_returnflag") == "N", "New").when(F.col("l_returnflag") == "R", "Pre-Owned").when(F.col("l_partkey") % 2 == 0, "Modified")
    source = F.when(F.col("o_orderpriority") == "1-URGENT", "eBay Sold").when(F.col("o_orderpriority") == "2-HIGH", "eBay").otherwise(F.col("o_orderpriority"))
    return joined.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ingest_id"), day.alias("day"), calendar.nearest_sunday(day).alias("date"),
        F.col("p_brand").alias("brand"), F.concat_ws("-", "p_brand", F.col("p_size").cast("string")).alias("reference_number"),
        F.concat(F.lit("G"), (F.col("p_size") % 7).cast("string")).alias("group_reference"),
        F.col("p_type").alias("parent_model"), F.col("p_name").alias("specific_model"), (F.col("p_size") + 1950).alias("year_introduced"),
        F.floor("l_extendedprice").cast("double").alias("price"), currency.alias("currency"), condition.alias("condition"), source.alias("source"),
        F.concat_ws("/", F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string")).alias("watch_url"),
        F.when(F.col("o_orderstatus") == "P", "Deleted").otherwise(F.col("o_orderstatus")).alias("status"),
    )


_SUNDAY = "CASE WHEN isodow({d}) = 7 THEN {d} WHEN isodow({d}) <= 3 THEN {d} - isodow({d}) ELSE {d} + (7 - isodow({d})) END"
LISTINGS = f"""
L AS (SELECT l_orderkey * 10 + l_linenumber AS ingest_id, cast(l_shipdate AS DATE) AS day,
  cast({_SUNDAY.format(d="cast(l_shipdate AS DATE)").replace("isodow(cast(l_shipdate AS DATE))", "cast(isodow(cast(l_shipdate AS DATE)) AS INT)")} AS DATE) AS date,
  p_brand AS brand, p_brand || '-' || p_size AS reference_number, 'G' || (p_size % 7) AS group_reference,
  p_type AS parent_model, p_name AS specific_model, p_size + 1950 AS year_introduced,
  floor(l_extendedprice) AS price, CASE n_regionkey WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' WHEN 2 THEN 'GBP' WHEN 3 THEN 'JPY' ELSE 'CHF' END AS currency,
  CASE WHEN l_returnflag = 'N' THEN 'New' WHEN l_returnflag = 'R' THEN 'Pre-Owned' WHEN l_partkey % 2 = 0 THEN 'Modified' END AS condition,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'eBay Sold' WHEN '2-HIGH' THEN 'eBay' ELSE o_orderpriority END AS source,
  l_partkey || '/' || l_suppkey AS watch_url, CASE WHEN o_orderstatus = 'P' THEN 'Deleted' ELSE o_orderstatus END AS status
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey JOIN orders ON l_orderkey = o_orderkey)
"""


@register(f"WITH {LISTINGS} SELECT day, date, count(*) AS n FROM L GROUP BY day, date")
def nearest_sunday(spark, sf_dir):
    return listings(spark, sf_dir).groupBy("day", "date").agg(F.count(F.lit(1)).alias("n"))


@register(f"""WITH {LISTINGS} SELECT DISTINCT day, cast(day - cast(isodow(day) AS INT) AS DATE) AS prior,
  cast(day - cast(isodow(day) % 7 AS INT) AS DATE) AS folder, cast(day + cast((7 - isodow(day)) % 7 AS INT) AS DATE) AS week_end FROM L""")
def prior_sunday(spark, sf_dir):
    d = F.col("day")
    return listings(spark, sf_dir).select("day", calendar.prior_sunday(d).alias("prior"), calendar.folder_sunday(d).alias("folder"), calendar.week_end(d).alias("week_end")).distinct()


@register(f"""WITH {LISTINGS} SELECT DISTINCT day, last_day(day) AS month_end,
  last_day(cast(date_trunc('quarter', day) + INTERVAL 2 MONTH AS DATE)) AS quarter_end, make_date(year(day), 12, 31) AS year_end FROM L""")
def calendar_bins(spark, sf_dir):
    d = F.col("day")
    return listings(spark, sf_dir).select("day", calendar.month_end(d).alias("month_end"), calendar.quarter_end(d).alias("quarter_end"), calendar.year_end(d).alias("year_end")).distinct()


@register(f"""WITH {LISTINGS}, F AS (SELECT brand, min(day) AS first FROM L GROUP BY brand),
Q AS (SELECT DISTINCT L.brand, day, year(first) * 4 + quarter(first) - 1 AS q0, year(day) * 4 + quarter(day) - 1 AS q FROM L JOIN F USING (brand)),
K AS (SELECT brand, day, q0 + 2 * cast(ceil((q - q0) / 2) AS INT) AS k FROM Q)
SELECT brand, day, last_day(make_date(k // 4, k % 4 * 3 + 3, 1)) AS label FROM K""")
def two_quarter_bins(spark, sf_dir):
    rows = listings(spark, sf_dir).select("brand", "day").distinct()
    first = rows.groupBy("brand").agg(F.min("day").alias("first"))
    return rows.join(first, "brand").select("brand", "day", calendar.two_quarter_end(F.col("day"), F.col("first")).alias("label"))


@register(f"""WITH {LISTINGS}, C AS (SELECT * FROM L WHERE coalesce(status, '') <> 'Deleted'),
D AS (SELECT *, row_number() OVER (PARTITION BY date, watch_url ORDER BY CASE source WHEN 'eBay Sold' THEN 1 WHEN 'eBay' THEN 2 ELSE 3 END, ingest_id) AS r FROM C)
SELECT ingest_id, upper(reference_number) AS reference_number, price, source, year_introduced FROM D WHERE r = 1""")
def clean_chain(spark, sf_dir):
    raw = listings(spark, sf_dir).withColumn("price", F.format_number("price", 2)).withColumn("year_production", F.lit(None).cast("int"))
    raw = raw.withColumnRenamed("year_production", "year_of_production")
    return cleaning.clean_listings(raw).select("ingest_id", "reference_number", "price", "source", "year_introduced")


@register(f"""WITH {LISTINGS}, D AS (SELECT *, row_number() OVER (PARTITION BY date, watch_url ORDER BY CASE source WHEN 'eBay Sold' THEN 1 WHEN 'eBay' THEN 2 ELSE 3 END, ingest_id) AS r FROM L)
SELECT ingest_id, date, watch_url, source FROM D WHERE r = 1""")
def dedupe_priority(spark, sf_dir):
    return cleaning.dedupe_listings(listings(spark, sf_dir), "ingest_id").select("ingest_id", "date", "watch_url", "source")


@register(f"WITH {LISTINGS} SELECT ingest_id, sha256(strftime(date, '%Y-%m-%d') || '-' || coalesce(watch_url, '<NA>') || '-' || coalesce(source, '<NA>')) AS hash_id FROM L")
def hash_id(spark, sf_dir):
    return cleaning.with_hash_id(listings(spark, sf_dir)).select("ingest_id", "hash_id")


@register(f"""WITH {LISTINGS}, R AS (SELECT * FROM (VALUES ('EUR', 0.92::DOUBLE), ('GBP', 0.79::DOUBLE), ('JPY', 150.0::DOUBLE)) AS t(code, rate))
SELECT ingest_id, 'USD' AS currency, CASE WHEN currency = 'USD' THEN price ELSE price / rate END AS price
FROM L LEFT JOIN R ON currency = code""")
def fx_convert(spark, sf_dir):
    rates = spark.createDataFrame(RATES, "currency string, rate double")
    return cleaning.to_usd(listings(spark, sf_dir), rates, decimals=None).select("ingest_id", "currency", "price")


@register(f"WITH {LISTINGS} SELECT ingest_id FROM L WHERE condition IS NULL OR condition IN ('', '<NA>')")
def null_like_filter(spark, sf_dir):
    return listings(spark, sf_dir).where(text.is_nullish(F.col("condition"))).select("ingest_id")


_LIBRARY = """LIB AS (SELECT DISTINCT p_brand AS brand, p_brand || '-' || p_size AS reference_number,
  CASE WHEN p_size % 5 = 0 THEN NULL ELSE 'G' || (p_size % 7) END AS group_reference,
  CASE WHEN p_size % 3 = 0 THEN NULL ELSE 'P' || p_size END AS parent_model,
  CASE WHEN p_size % 4 = 0 THEN NULL ELSE 'S' || p_size END AS specific_model, 1950 + p_size AS year_introduced FROM part)"""


@register(f"""WITH {LISTINGS}, {_LIBRARY},
B AS (SELECT ingest_id, brand, reference_number, CASE WHEN ingest_id % 2 = 0 THEN group_reference ELSE '' END AS g, CASE WHEN ingest_id % 3 = 0 THEN parent_model END AS pm,
  CASE WHEN ingest_id % 5 = 0 THEN specific_model ELSE '' END AS sm, CASE WHEN ingest_id % 7 = 0 THEN year_introduced ELSE 0 END AS y FROM L),
O AS (SELECT B.ingest_id, B.brand, CASE WHEN coalesce(g, '') = '' THEN l.group_reference ELSE g END AS g, CASE WHEN coalesce(pm, '') = '' THEN l.parent_model ELSE pm END AS pm,
  CASE WHEN coalesce(sm, '') = '' THEN l.specific_model ELSE sm END AS sm, CASE WHEN coalesce(y, 0) = 0 THEN l.year_introduced ELSE y END AS y
  FROM B LEFT JOIN LIB l ON l.brand = B.brand AND l.reference_number = B.reference_number),
G AS (SELECT brand, group_reference, arg_min(parent_model, reference_number) FILTER (parent_model IS NOT NULL) AS pm,
  arg_min(specific_model, reference_number) FILTER (specific_model IS NOT NULL) AS sm, arg_min(year_introduced, reference_number) AS y
  FROM LIB WHERE group_reference IS NOT NULL GROUP BY brand, group_reference)
SELECT ingest_id, O.g AS group_reference, CASE WHEN coalesce(O.pm, '') = '' THEN G.pm ELSE O.pm END AS parent_model,
  CASE WHEN coalesce(O.sm, '') = '' THEN G.sm ELSE O.sm END AS specific_model, CASE WHEN coalesce(O.y, 0) = 0 THEN G.y ELSE O.y END AS year_introduced
FROM O LEFT JOIN G ON G.brand = O.brand AND G.group_reference = O.g""")
def library_fill_two_pass(spark, sf_dir):
    size = F.col("p_size")
    name = lambda p: F.concat(F.lit(p), size.cast("string"))
    library = table(spark, sf_dir, "part").select(
        F.col("p_brand").alias("brand"), F.concat_ws("-", "p_brand", size.cast("string")).alias("reference_number"),
        F.when(size % 5 != 0, F.concat(F.lit("G"), (size % 7).cast("string"))).alias("group_reference"),
        F.when(size % 3 != 0, name("P")).alias("parent_model"), F.when(size % 4 != 0, name("S")).alias("specific_model"), (size + 1950).alias("year_introduced"),
    ).distinct()
    n = F.col("ingest_id")
    blanked = listings(spark, sf_dir).select(
        "ingest_id", "brand", "reference_number", F.when(n % 2 == 0, F.col("group_reference")).otherwise("").alias("group_reference"),
        F.when(n % 3 == 0, F.col("parent_model")).alias("parent_model"), F.when(n % 5 == 0, F.col("specific_model")).otherwise("").alias("specific_model"),
        F.when(n % 7 == 0, F.col("year_introduced")).otherwise(0).alias("year_introduced"),
    )
    return enrichment.fill_from_library(blanked, library).select("ingest_id", "group_reference", "parent_model", "specific_model", "year_introduced")


_STATS = """S AS (SELECT brand, reference_number, count(*) AS n, quantile_cont(price, 0.25) AS q1, quantile_cont(price, 0.5) AS q2, quantile_cont(price, 0.75) AS q3,
  min(price) AS min, max(price) AS max FROM L GROUP BY ALL)"""


def _bounds(spark, sf_dir) -> DataFrame:
    stats = outliers.with_category(outliers.group_statistics(listings(spark, sf_dir), ["brand", "reference_number"]))
    return outliers.thresholds(stats, by_reference=True, multipliers={"Brand#11": (10, 4.5)})


_BOUNDS = f"""{_STATS}, T AS (SELECT brand, reference_number, n AS count, q1, q2, q3, min, max, q3 - q1 AS iqr,
  CASE WHEN n <= 10 THEN 'insufficient' WHEN n <= 20 THEN 'caution' ELSE 'confidence' END AS category,
  CASE WHEN n > 10 THEN greatest(q1 - (CASE WHEN n <= 20 THEN 2 WHEN brand = 'Brand#11' THEN 4.5 ELSE 2.5 END)::DOUBLE * (q3 - q1), q2 * 0.125::DOUBLE) END AS lower_boundary,
  CASE WHEN n > 10 THEN q3 + (CASE WHEN brand = 'Brand#11' THEN 10 ELSE 4 END)::DOUBLE * (q3 - q1) END AS upper_boundary FROM S)"""


@register(f"WITH {LISTINGS}, {_BOUNDS} SELECT * FROM T")
def outlier_thresholds(spark, sf_dir):
    return _bounds(spark, sf_dir)


@register(f"""WITH {LISTINGS}, {_BOUNDS}
SELECT ingest_id FROM L LEFT JOIN T USING (brand, reference_number) WHERE condition IS NULL
  OR condition = 'New' AND (price BETWEEN lower_boundary AND upper_boundary OR lower_boundary IS NULL AND upper_boundary IS NULL)
  OR condition = 'Pre-Owned' AND (price BETWEEN lower_boundary * 2 AND upper_boundary / 2 OR lower_boundary IS NULL AND upper_boundary IS NULL)""")
def outlier_filter(spark, sf_dir):
    new = _bounds(spark, sf_dir).select("brand", "reference_number", "lower_boundary", "upper_boundary")
    pre_owned = new.withColumns({"lower_boundary": F.col("lower_boundary") * 2, "upper_boundary": F.col("upper_boundary") / 2})
    return outliers.filter_outliers(listings(spark, sf_dir), pre_owned, new).select("ingest_id")


@register(f"""WITH {LISTINGS}, B AS (SELECT brand, reference_number, date, max(price) AS upper_boundary FROM L GROUP BY ALL)
SELECT * FROM B QUALIFY rank() OVER (PARTITION BY brand, reference_number ORDER BY date DESC) = 1""")
def latest_boundary_per_key(spark, sf_dir):
    bounds = listings(spark, sf_dir).groupBy("brand", "reference_number", "date").agg(F.max("price").alias("upper_boundary"))
    return outliers.latest_boundaries(bounds)


def _weekly_sql(name: str) -> str:
    level = LEVELS[name]
    keys = ", ".join(level.keys)
    firsts = ", ".join(f"arg_min({c}, ingest_id) FILTER ({c} IS NOT NULL) AS {c}" for c in (*level.firsts, "currency"))
    slug = "regexp_replace(lower(regexp_replace(brand, '[^A-Za-z0-9_ -]', '', 'g')), '[- ]+', '-', 'g')"
    own = f", {slug} || '-' || {level.keys[-1]} AS identifier" if len(level.keys) > 1 else ""
    return f"""SELECT {keys}, date, {firsts}, median(price) AS median_price, avg(price) AS mean_price, max(price) AS high, min(price) AS low,
  count(*) AS count, array_to_string(list_sort(list(DISTINCT source)), ', ') AS source, 'Mixed' AS condition, {slug} AS brand_slug{own}
  FROM L WHERE {" AND ".join(f"{k} IS NOT NULL" for k in level.keys)} GROUP BY {keys}, date"""


def _weekly(name: str) -> Callable:
    def query(spark, sf_dir):
        return weekly.weekly(listings(spark, sf_dir), name, order="ingest_id")

    return query


for _name, _label in (("reference", "ref"), ("specific_model", "specific"), ("parent_model", "parent"), ("brand", "brand")):
    QUERIES[f"weekly_{_label}"], ORACLES[f"weekly_{_label}"] = _weekly(_name), f"WITH {LISTINGS} {_weekly_sql(_name)}"


def _makeup(keys: tuple[str, ...]) -> Callable:
    def query(spark, sf_dir):
        return weekly.market_makeup(listings(spark, sf_dir), list(keys))

    return query


for _name, _label in (("reference", "ref"), ("specific_model", "specific"), ("parent_model", "parent"), ("brand", "brand")):
    _keys = LEVELS[_name].keys
    QUERIES[f"makeup_{_label}"] = _makeup(_keys)
    ORACLES[f"makeup_{_label}"] = f"""WITH {LISTINGS}, M AS (SELECT {", ".join(_keys)}, date, count(*) FILTER (condition = 'New') AS numb_of_new_listings,
  count(*) FILTER (condition IN ({", ".join(f"'{c}'" for c in PRE_OWNED)})) AS numb_of_pre_owned_listings FROM L GROUP BY ALL),
  T AS (SELECT *, numb_of_new_listings + numb_of_pre_owned_listings AS numb_of_total_listings FROM M)
  SELECT *, CASE WHEN numb_of_total_listings > 0 THEN numb_of_new_listings / numb_of_total_listings * 100 END AS pct_new,
  CASE WHEN numb_of_total_listings > 0 THEN numb_of_pre_owned_listings / numb_of_total_listings * 100 END AS pct_pre_owned,
  numb_of_total_listings / (SELECT max(numb_of_total_listings) FROM T) * 100 AS listings_popularity_score FROM T"""


@register(f"""WITH {LISTINGS}, X AS (
  SELECT 'brand' AS level, brand, NULL AS reference_number, NULL AS specific_model, NULL AS parent_model, date, condition FROM L
  UNION ALL SELECT 'reference', brand, reference_number, NULL, NULL, date, condition FROM L
  UNION ALL SELECT 'specific_model', brand, NULL, specific_model, NULL, date, condition FROM L
  UNION ALL SELECT 'parent_model', brand, NULL, NULL, parent_model, date, condition FROM L)
SELECT level, brand, reference_number, specific_model, parent_model, date, count(*) FILTER (condition = 'New') AS numb_of_new_listings,
  count(*) FILTER (condition IN ({", ".join(f"'{c}'" for c in PRE_OWNED)})) AS numb_of_pre_owned_listings FROM X GROUP BY 1, 2, 3, 4, 5, 6""")
def makeup_all_levels(spark, sf_dir):
    return weekly.makeup_at_all_levels(listings(spark, sf_dir))


def _series(spark, sf_dir) -> DataFrame:
    """Weekly rows of (brand, parent model); a history column of averages is there before 1998."""
    week = weekly.weekly(listings(spark, sf_dir), "parent_model", order="ingest_id")
    old = F.when(F.col("date") < F.lit("1998-01-01").cast("date"), F.col("median_price"))
    return week.select("brand", "parent_model", "date", "median_price", "condition", "count", old.alias(series.ROLLING))


_SERIES = f"""W AS ({_weekly_sql("parent_model")}),
H AS (SELECT brand, parent_model, date, median_price, condition, count, CASE WHEN date < DATE '1998-01-01' THEN median_price END AS rolling_avg_of_median_price FROM W)"""
_END = "(SELECT CASE WHEN isodow(m) = 7 THEN m WHEN isodow(m) <= 3 THEN m - cast(isodow(m) AS INT) ELSE m + cast(7 - isodow(m) AS INT) END FROM (SELECT max(date) AS m FROM H))"
_EXTENDED = f"""{_SERIES}, E AS (SELECT {_END} AS e), K AS (SELECT brand, parent_model, max(date) AS last FROM H GROUP BY ALL),
N AS (SELECT brand, parent_model, cast(unnest(generate_series(last + 7, e, INTERVAL 7 DAY)) AS DATE) AS date FROM K, E WHERE last < e),
U AS (SELECT * FROM H UNION ALL BY NAME SELECT brand, parent_model, date FROM N),
X AS (SELECT U.brand, U.parent_model, U.date, CASE WHEN last < e THEN last_value(median_price IGNORE NULLS) OVER o ELSE median_price END AS median_price,
  CASE WHEN last < e THEN last_value(condition IGNORE NULLS) OVER o ELSE condition END AS condition, count, rolling_avg_of_median_price
  FROM U JOIN K ON K.brand = U.brand AND K.parent_model = U.parent_model, E
  WINDOW o AS (PARTITION BY U.brand, U.parent_model ORDER BY U.date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""
_LIVES = """U AS (SELECT watch_url, min(date) AS first_seen, max(date) AS last_seen, arg_min(brand, ingest_id) AS brand, arg_min(reference_number, ingest_id) AS reference_number FROM L GROUP BY watch_url),
D AS (SELECT *, CASE WHEN last_seen = first_seen THEN 7 ELSE last_seen - first_seen END AS days, last_seen = (SELECT max(date) FROM L) AS active FROM U)"""
_KEYS = ("brand", "parent_model")


def _extended(spark, sf_dir) -> DataFrame:
    df = _series(spark, sf_dir)
    return series.extend_and_fill(df, _KEYS, ["median_price", "condition"], series.last_sunday(df))


@register(f"WITH {LISTINGS}, {_EXTENDED} SELECT * FROM X")
def extend_ffill(spark, sf_dir):
    return _extended(spark, sf_dir)


_ROLLED = f"""{_EXTENDED}, P AS (SELECT *, row_number() OVER w AS r, avg(median_price) OVER (PARTITION BY brand, parent_model ORDER BY date ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS a
  FROM X WINDOW w AS (PARTITION BY brand, parent_model ORDER BY date)),
Z AS (SELECT *, coalesce(max(CASE WHEN rolling_avg_of_median_price IS NOT NULL THEN r END) OVER (PARTITION BY brand, parent_model), 0) AS f FROM P),
Y AS (SELECT brand, parent_model, date, median_price, condition, count, CASE WHEN r > f THEN a ELSE rolling_avg_of_median_price END AS rolling_avg_of_median_price FROM Z)"""


@register(f"WITH {LISTINGS}, {_ROLLED} SELECT * FROM Y")
def rolling5_incremental(spark, sf_dir):
    return series.rolling_average(_extended(spark, sf_dir), _KEYS)


_CHANGE = ", ".join(
    f"CASE WHEN date = e AND l{k} <> 0 THEN (v - l{k}) / l{k} * 100 END AS pct_change_{n}, CASE WHEN date = e THEN v - l{k} END AS dol_change_{n}"
    for k, n in series.LAGS.values()
)
_LAGS = ", ".join(f"lag(v, {k}) OVER w AS l{k}" for k, _ in series.LAGS.values())


@register(f"""WITH {LISTINGS}, {_ROLLED}, V AS (SELECT brand, parent_model, date, floor(coalesce(rolling_avg_of_median_price, 0)) AS v FROM Y),
G AS (SELECT *, {_LAGS} FROM V WINDOW w AS (PARTITION BY brand, parent_model ORDER BY date))
SELECT brand, parent_model, date, cast(v AS INT) AS rolling_avg_of_median_price, {_CHANGE} FROM G, E WHERE date = e""")
def changes_multi_offset(spark, sf_dir):
    df = _series(spark, sf_dir)
    end = series.last_sunday(df)
    rolled = series.rolling_average(series.extend_and_fill(df, _KEYS, ["median_price", "condition"], end), _KEYS, quantize=True)
    out = series.current_week(series.changes(rolled, _KEYS, end), end)
    return out.drop("median_price", "condition", "count")


@register(f"""WITH {LISTINGS}, W AS ({_weekly_sql("brand")})
SELECT brand, date, median_price - lag(median_price) OVER w AS "median_price_$_change",
  (median_price - lag(median_price) OVER w) / lag(median_price) OVER w * 100 AS "median_price_%_change" FROM W WINDOW w AS (PARTITION BY brand ORDER BY date)""")
def wow_change(spark, sf_dir):
    out = series.week_on_week(weekly.weekly(listings(spark, sf_dir), "brand", order="ingest_id"), ["brand"], ["median_price"])
    return out.select("brand", "date", "median_price_$_change", "median_price_%_change")


@register(f"""WITH {LISTINGS}, W AS (SELECT brand, parent_model, cast(day + cast((7 - isodow(day)) % 7 AS INT) AS DATE) AS date, arg_min(currency, ingest_id) AS currency,
median(price) AS median_price, avg(price) AS mean_price, max(price) AS high, min(price) AS low, count(price) AS count FROM L WHERE condition = 'New' GROUP BY 1, 2, 3),
C AS (SELECT *, median_price - lag(median_price) OVER w AS "median_price_$_change", (median_price - lag(median_price) OVER w) / lag(median_price) OVER w * 100 AS "median_price_%_change"
FROM W WINDOW w AS (PARTITION BY brand, parent_model ORDER BY date)) SELECT * FROM C WHERE date = (SELECT max(date) FROM C)""")
def active_listings(spark, sf_dir):
    rows = listings(spark, sf_dir).withColumn("date", F.col("day"))
    out = weekly.active_listings(rows, ["brand", "parent_model"], "New", order="ingest_id")
    return out.drop("mean_price_$_change", "mean_price_%_change", "count_$_change", "count_%_change")


@register(f"WITH {LISTINGS} SELECT DISTINCT day, weekofyear(day) % 2 = 0 AS runs, day - 547 AS since FROM L")
def biweekly_gate(spark, sf_dir):
    d = F.col("day")
    return listings(spark, sf_dir).select("day", calendar.even_iso_week(d).alias("runs"), calendar.years_ago(d, 1.5).alias("since")).distinct()


@register(f"""WITH {LISTINGS}, {_LIVES} SELECT watch_url, first_seen, last_seen, brand, reference_number, days, active FROM D""")
def lifetimes(spark, sf_dir):
    return liquidity.lifetimes(listings(spark, sf_dir), "ingest_id")


@register(f"WITH {LISTINGS} SELECT ingest_id FROM L WHERE reference_number IS NOT NULL AND regexp_matches(reference_number, '[0-9]') AND len(replace(reference_number, ' ', '')) <= 25")
def plausible_references(spark, sf_dir):
    return enrichment.plausible_references(listings(spark, sf_dir)).select("ingest_id")


@register(f"WITH {LISTINGS} SELECT count(*) AS rows, count(DISTINCT reference_number) AS distinct, min(date) AS first, max(date) AS last FROM L")
def frame_stats(spark, sf_dir):
    return profile.frame_stats(listings(spark, sf_dir), "reference_number")


@register(f"WITH {LISTINGS}, D AS (SELECT DISTINCT date FROM L ORDER BY date DESC LIMIT 3) SELECT ingest_id, date FROM L WHERE date IN (SELECT date FROM D)")
def recent_dates(spark, sf_dir):
    return series.recent_dates(listings(spark, sf_dir), 3).select("ingest_id", "date")


@register(f"""WITH {LISTINGS}, W AS ({_weekly_sql("brand")}), T AS (SELECT brand, date, median_price FROM W WHERE date < DATE '1998-01-01'),
N AS (SELECT brand, date, median_price, high FROM W WHERE date >= DATE '1998-01-01') SELECT * FROM T UNION ALL BY NAME SELECT * FROM N""")
def combine_history(spark, sf_dir):
    week = weekly.weekly(listings(spark, sf_dir), "brand", order="ingest_id").select("brand", "date", "median_price", "high")
    cut = F.lit("1998-01-01").cast("date")
    return series.combine(week.where(F.col("date") < cut).drop("high"), week.where(F.col("date") >= cut))


@register(f"""WITH {LISTINGS}, K AS (SELECT brand, reference_number FROM L GROUP BY ALL HAVING (max(date) - min(date)) // 7 >= 156)
SELECT ingest_id FROM L JOIN K USING (brand, reference_number)""")
def history_qualifies(spark, sf_dir):
    return volatility.qualifying(listings(spark, sf_dir), ["brand", "reference_number"], 156).select("ingest_id")


_BIN = {
    "1M": ("year(date) * 12 + month(date)", "last_day(date)"),
    "3M": ("year(date) * 4 + quarter(date) - 1", "last_day(cast(date_trunc('quarter', date) + INTERVAL 2 MONTH AS DATE))"),
    "6M": ("cast(ceil((year(date) * 4 + quarter(date) - 1 - q0) / 2) AS INT)", "last_day(make_date((q0 + 2 * cast(ceil((year(date) * 4 + quarter(date) - 1 - q0) / 2) AS INT)) // 4, (q0 + 2 * cast(ceil((year(date) * 4 + quarter(date) - 1 - q0) / 2) AS INT)) % 4 * 3 + 3, 1))"),
    "1Y": ("year(date)", "make_date(year(date), 12, 31)"),
}


def _resample_sql(interval: str) -> str:
    number, label = _BIN[interval]
    return f"""SELECT *, lag(close) OVER w AS pc, lag(bin) OVER w AS pb FROM (SELECT brand, cast({number} AS INT) AS bin, {label} AS period_end,
  arg_min(median_price, date) AS open, arg_max(median_price, date) AS close, max(median_price) AS high, min(median_price) AS low, median(median_price) AS median_price
  FROM W, (SELECT brand AS b0, year(min(date)) * 4 + quarter(min(date)) - 1 AS q0 FROM W GROUP BY brand) WHERE brand = b0 GROUP BY ALL) WINDOW w AS (PARTITION BY brand ORDER BY bin)"""


def _resample(interval: str) -> Callable:
    def query(spark, sf_dir):
        week = weekly.weekly(listings(spark, sf_dir), "brand", order="ingest_id")
        out = volatility.resample(week, ["brand"], interval, "median_price")
        return out.select("brand", "period_end", "open", "close", "high", "low", "median_price", F.round("log_return", 8).alias("log_return"))

    return query


for _i in _BIN:
    QUERIES[f"resample_{_i.lower()}"] = _resample(_i)
    ORACLES[f"resample_{_i.lower()}"] = f"""WITH {LISTINGS}, W AS ({_weekly_sql("brand")}), R AS ({_resample_sql(_i)})
SELECT brand, period_end, open, close, high, low, median_price, round(CASE WHEN pb = bin - 1 THEN ln(close / pc) END, 8) AS log_return FROM R"""


@register("WITH " + LISTINGS + ", W AS (" + _weekly_sql("brand") + "), " + ", ".join(
    f"V{i} AS (SELECT brand, round(stddev_samp(CASE WHEN pb = bin - 1 THEN ln(close / pc) END) * sqrt({n}) * 100, 6) AS v FROM ({_resample_sql(i)}) GROUP BY brand)"
    for i, n in volatility.PERIODS.items()
) + """ SELECT V1M.brand AS brand, V1M.v AS volatility_1m, V3M.v AS volatility_3m, V6M.v AS volatility_6m, V1Y.v AS volatility_1y
FROM V1M JOIN V3M USING (brand) JOIN V6M USING (brand) JOIN V1Y USING (brand)""")  # fmt: skip
def volatility_by_brand(spark, sf_dir):
    week = weekly.weekly(listings(spark, sf_dir), "brand", order="ingest_id")
    out = volatility.volatility(week, ("brand",), "median_price", min_weeks={"1M": 52, "3M": 104, "6M": 104, "1Y": 156})
    return out.select("brand", *[F.round(f"volatility_{i.lower()}", 6).alias(f"volatility_{i.lower()}") for i in volatility.PERIODS])


_DURATION = f"""{_LIVES}, A AS (SELECT brand, reference_number, count(*) AS count, avg(days) AS mean_days, median(days) AS median_days, round(stddev_samp(days), 6) AS std_days,
  min(days) AS min_days, max(days) AS max_days, max(last_seen) AS date FROM D WHERE NOT active GROUP BY brand, reference_number)"""


@register(f"WITH {LISTINGS}, {_DURATION} SELECT * FROM A")
def listing_durations(spark, sf_dir):
    out = liquidity.listing_durations(listings(spark, sf_dir), "ingest_id")
    names = ["brand", "reference_number", "count", "mean_days", "median_days", "min_days", "max_days", "date"]
    return out.select(*names, F.round("std_days", 6).alias("std_days"))


@register(f"""WITH {LISTINGS}, {_DURATION} SELECT (SELECT count(*) FROM D) AS urls, (SELECT count(*) FROM D WHERE NOT active) AS inactive,
(SELECT count(*) FROM D WHERE active) AS active, count(*) AS models, round(avg(mean_days), 6) AS mean_of_means, round(avg(median_days), 6) AS mean_of_medians FROM A""")
def duration_report(spark, sf_dir):
    rows = listings(spark, sf_dir).withColumnRenamed("ingest_id", "hash_id")
    out = liquidity.duration_report(rows, liquidity.listing_durations(rows))
    return out.withColumns({c: F.round(c, 6) for c in ("mean_of_means", "mean_of_medians")})


@register(f"WITH {LISTINGS}, {_DURATION} SELECT brand, reference_number, count FROM A ORDER BY count DESC, brand, reference_number LIMIT 5")
def topk_models(spark, sf_dir):
    return liquidity.top_models(liquidity.listing_durations(listings(spark, sf_dir), "ingest_id"), "count").select("brand", "reference_number", "count")


@register(f"""WITH {LISTINGS}, S AS (SELECT brand, count(*) AS n, quantile_cont(price, 0.25) AS q1, quantile_cont(price, 0.5) AS q2, quantile_cont(price, 0.75) AS q3 FROM L GROUP BY brand),
T AS (SELECT *, q2 * 0.15::DOUBLE AS lower_boundary, q3 + 4::DOUBLE * (q3 - q1) AS upper_boundary FROM S ORDER BY n DESC, brand LIMIT 5)
SELECT brand, q1, q2, q3, lower_boundary, upper_boundary, count(*) FILTER (price < lower_boundary) AS below_lower, count(*) FILTER (price >= lower_boundary AND price < q1) AS lower_to_q1,
count(*) FILTER (price >= q1 AND price < q2) AS q1_to_q2, count(*) FILTER (price >= q2 AND price < q3) AS q2_to_q3, count(*) FILTER (price >= q3 AND price <= upper_boundary) AS q3_to_upper,
count(*) FILTER (price > upper_boundary) AS above_upper, count(*) AS total FROM L JOIN T USING (brand) GROUP BY 1, 2, 3, 4, 5, 6""")
def boxplot_stats(spark, sf_dir):
    return outliers.boxplot_statistics(listings(spark, sf_dir), ["brand"], 5)


@register(f"WITH {LISTINGS} SELECT brand, count(*) FILTER (condition IS NULL) AS null_count FROM L GROUP BY brand")
def null_counts(spark, sf_dir):
    return profile.null_counts(listings(spark, sf_dir), ["brand"], "condition")


@register(f"WITH {LISTINGS} SELECT condition, count(*) AS count FROM L GROUP BY condition")
def value_counts(spark, sf_dir):
    return profile.value_counts(listings(spark, sf_dir), "condition")


@register(f"WITH {LISTINGS} SELECT DISTINCT max(date) AS latest FROM L GROUP BY brand, reference_number")
def latest_dates(spark, sf_dir):
    return profile.latest_dates(listings(spark, sf_dir), ["brand", "reference_number"])


@register(f"""WITH {LISTINGS}, C AS (SELECT brand, source, count(*) AS n FROM L GROUP BY ALL)
SELECT brand, source AS mode FROM C QUALIFY row_number() OVER (PARTITION BY brand ORDER BY n DESC, source) = 1""")
def mode_per_group(spark, sf_dir):
    return profile.modes(listings(spark, sf_dir), ["brand"], "source")


@register(f"""WITH {LISTINGS}, {_BOUNDS}, K AS (SELECT DISTINCT brand, reference_number FROM L), H AS (SELECT brand, reference_number FROM T WHERE lower_boundary IS NOT NULL)
SELECT count(*) AS distinct_keys, count(H.brand) AS matched, count(H.brand) * 100 / count(*) AS match_rate FROM K LEFT JOIN H USING (brand, reference_number)""")
def match_rate(spark, sf_dir):
    bounds = _bounds(spark, sf_dir).where("lower_boundary IS NOT NULL")
    return profile.match_rate(listings(spark, sf_dir), bounds, ["brand", "reference_number"])


@register("""WITH T AS (SELECT o_orderkey AS k, o_orderstatus AS s, o_totalprice AS p FROM orders WHERE o_orderkey % 3 <> 0),
C AS (SELECT o_orderkey AS k, 'new' AS s, o_totalprice + 1 AS p FROM orders WHERE o_orderkey % 2 = 0)
SELECT T.k, coalesce(C.s, T.s) AS s, T.p FROM T LEFT JOIN C USING (k) UNION ALL SELECT * FROM C WHERE k NOT IN (SELECT k FROM T)""")
def upsert(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("s"), F.col("o_totalprice").alias("p"))
    target, fresh = orders.where("k % 3 <> 0"), orders.where("k % 2 = 0").select("k", F.lit("new").alias("s"), (F.col("p") + 1).alias("p"))
    return cleaning.upsert(target, fresh, "k", ["s"])


@register(f"""WITH {LISTINGS}, M AS (SELECT max(date) AS m FROM L WHERE brand IN ('Brand#11', 'Brand#12')), F AS (SELECT m, m - 547 AS b FROM M)
SELECT ingest_id FROM L, F WHERE brand IN ('Brand#11', 'Brand#12')
  AND date BETWEEN (CASE WHEN isodow(b) = 7 THEN b WHEN isodow(b) <= 3 THEN b - cast(isodow(b) AS INT) ELSE b + cast(7 - isodow(b) AS INT) END) AND m""")
def history_scan(spark, sf_dir):
    return sources.history(listings(spark, sf_dir), ["Brand#11", "Brand#12"], 1.5).select("ingest_id")


@register(f"WITH {LISTINGS} SELECT ingest_id FROM L WHERE brand = 'Brand#11' AND date = DATE '1998-06-07' AND price <> 0")
def latest_week_scan(spark, sf_dir):
    return sources.new_listings(listings(spark, sf_dir), ["Brand#11"], F.lit("1998-06-10").cast("date")).select("ingest_id")


_SLUG = "regexp_replace(trim(lower(regexp_replace(p_name, '[^A-Za-z0-9_ -]', '', 'g'))), '[- ]+', '-', 'g')"


@register(f"SELECT p_partkey, {_SLUG} AS slug, {_SLUG} || '-' || p_size AS identifier FROM part")
def slug_identifier(spark, sf_dir):
    slug = text.slug(F.col("p_name"))
    return table(spark, sf_dir, "part").select("p_partkey", slug.alias("slug"), text.identifier(slug, F.col("p_size").cast("string")).alias("identifier"))


#: A task makes many rows of each part: so many parts go to one.
PARTS_A_TASK = 5_000


def _parts(spark, sf_dir) -> DataFrame:
    """The parts dealt over tasks by their number: a file of a few MB is one task otherwise, however many rows its parts become."""
    part = table(spark, sf_dir, "part")
    return part.repartition(max(1, -(-part.count() // PARTS_A_TASK)), "p_partkey")  # the count is in the file's footers


def _digits() -> Column:
    """The last six digits of a part's key, after ones where it has fewer."""
    return F.right(F.concat(F.lit("1" * 6), F.col("p_partkey").cast("string")), F.lit(6))


def _titles(spark, sf_dir) -> DataFrame:
    """References made of part keys in the forms of some brands, with noise around."""
    key = _digits()
    n = F.col("p_partkey") % 4
    brand = F.when(n == 0, "Rolex").when(n == 1, "Hamilton").when(n == 2, "Citizen").otherwise("Nobody")
    ref = (
        F.when(n == 0, F.concat(F.lit("ref m"), key, F.lit("LN-0001"))).when(n == 1, F.concat(F.lit("H70"), key))
        .when(n == 2, F.concat(F.lit("AB"), F.substring(key, 1, 4), F.lit("-50E x"))).otherwise(key)
    )
    return table(spark, sf_dir, "part").select("p_partkey", brand.alias("brand"), ref.alias("ref"), F.col("p_name").alias("title"))


_KEY = "right(repeat('1', 6) || p_partkey, 6)"


@register(f"""SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN {_KEY} || 'LN-0001' WHEN 1 THEN 'H70' || {_KEY} WHEN 2 THEN 'AB' || left({_KEY}, 4) || '-50E' ELSE {_KEY} END AS reference_number FROM part""")
def identifier_extract(spark, sf_dir):
    return _titles(spark, sf_dir).select("p_partkey", identifiers.reference_of(F.col("brand"), F.col("ref"), F.col("title")).alias("reference_number"))


@register(f"SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN {_KEY} ELSE '' END AS group_reference FROM part")
def group_reference(spark, sf_dir):
    return _titles(spark, sf_dir).select("p_partkey", identifiers.group_reference(F.col("brand"), F.col("ref")).alias("group_reference"))


def _vocabulary_sql(values: dict[str, list[str]], column: str, one: bool) -> str:
    cases = [
        (k, " OR ".join(f"contains(lower({column}), '{s.lower().replace(chr(39), chr(39) * 2)}')" for s in v)) for k, v in values.items()
    ]
    if one:
        return "CASE " + " ".join(f"WHEN {c} THEN '{k}'" for k, c in cases) + " END"
    each = ", ".join(f"CASE WHEN {c} THEN '{k}' END" for k, c in cases)
    return f"nullif(array_to_string(list_filter([{each}], lambda x: x IS NOT NULL), ', '), '')"


@register(f"SELECT doc_id, {_vocabulary_sql(V.CONDITION, 'text', True)} AS condition, {_vocabulary_sql(V.MOVEMENT, 'text', True)} AS movement FROM documents")
def vocab_one(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", attributes.condition(F.col("text")).alias("condition"), attributes.movement(F.col("text")).alias("movement"))


@register(f"SELECT doc_id, {_vocabulary_sql(V.NUMERALS, 'text', False)} AS numerals, {_vocabulary_sql(V.CASEBACK, 'text', False)} AS caseback FROM documents")
def vocab_multi(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", attributes.numerals(F.col("text")).alias("numerals"), attributes.caseback(F.col("text")).alias("caseback"))


@register("""SELECT p_partkey, CASE p_size % 3 WHEN 0 THEN CAST(p_size AS DOUBLE) || ' ATM' WHEN 1 THEN (p_size / 10) || ' ATM' ELSE 'Not water resistant' END AS water,
CASE p_size % 2 WHEN 0 THEN CAST(p_size AS DOUBLE) || ' mm' ELSE CAST(p_size * 10 AS DOUBLE) || ' mm' END AS lugs FROM part""")
def unit_normalise(spark, sf_dir):
    size, as_text = F.col("p_size"), F.col("p_size").cast("string")
    water = F.when(size % 3 == 0, F.concat(as_text, F.lit(" bar"))).when(size % 3 == 1, F.concat(as_text, F.lit("m"))).otherwise("none")
    lugs = F.when(size % 2 == 0, F.concat(as_text, F.lit(" MM"))).otherwise(F.concat(as_text, F.lit(" cm")))
    return table(spark, sf_dir, "part").select("p_partkey", attributes.water_resistance(water).alias("water"), attributes.millimetres(lugs, F.lit("ebay")).alias("lugs"))


@register("""SELECT CAST(date_trunc('week', ts) AS DATE) + 6 AS date, event_type, count(*) AS count, round(avg(value), 6) AS mean, max(value) AS high, min(value) AS low FROM events GROUP BY ALL""")
def weekly_stream(spark, sf_dir):
    return streaming.weekly_stream(table(spark, sf_dir, "events"), "event_type", "value").withColumn("mean", F.round("mean", 6))


@register(f"WITH {LISTINGS} SELECT ingest_id FROM L WHERE brand = 'Brand#11' AND date = DATE '1998-06-07' AND price <> 0 AND parent_model <> ''")
def latest_week_of_level(spark, sf_dir):
    return sources.latest_week(listings(spark, sf_dir), ["Brand#11"], "parent_model", F.lit("1998-06-10").cast("date")).select("ingest_id")


@register(f"WITH {LISTINGS} SELECT ingest_id FROM L WHERE brand IN ('Brand#11', 'Brand#12') AND date < DATE '1995-01-01'")
def before_scan(spark, sf_dir):
    return sources.before(listings(spark, sf_dir), ["Brand#11", "Brand#12"], "1995-01-01").select("ingest_id")


@register(f"WITH {LISTINGS} SELECT price, brand FROM L WHERE price > 50000")
def template_scan(spark, sf_dir):
    return sources.read_template(spark, "SELECT price, brand FROM {t} WHERE price > :least", {"t": listings(spark, sf_dir)}, least=50000)


@register(f"""WITH {LISTINGS}, {_DURATION}, W AS (SELECT brand, reference_number, round(days / 7.0, 1) AS weeks FROM D WHERE NOT active)
SELECT brand, reference_number, round(avg(weeks), 6) AS mean_weeks, round(median(weeks), 6) AS median_weeks, round(stddev_samp(weeks), 6) AS std_weeks, min(weeks) AS min_weeks, max(weeks) AS max_weeks
FROM W GROUP BY brand, reference_number""")
def listing_duration_weeks(spark, sf_dir):
    out = liquidity.listing_durations(listings(spark, sf_dir), "ingest_id")
    return out.select("brand", "reference_number", "min_weeks", "max_weeks", *[F.round(f"{n}_weeks", 6).alias(f"{n}_weeks") for n in ("mean", "median", "std")])


@register(f"WITH {LISTINGS} SELECT ingest_id, coalesce(condition, '<NA>') AS caliber, reference_number FROM L WHERE source IS NOT NULL")
def nulls_as_text(spark, sf_dir):
    rows = cleaning.with_source(listings(spark, sf_dir)).withColumnRenamed("condition", "caliber")
    return cleaning.nulls_as_text(rows).select("ingest_id", "caliber", "reference_number")


@register(f"""WITH {LISTINGS}, B AS (SELECT CASE year_introduced % 4 WHEN 0 THEN 'Rolex' WHEN 1 THEN 'Omega' WHEN 2 THEN 'Hamilton' ELSE 'Nobody' END AS brand, price FROM L),
S AS (SELECT brand, count(*) AS n, quantile_cont(price, 0.25) AS q1, quantile_cont(price, 0.5) AS q2, quantile_cont(price, 0.75) AS q3 FROM B GROUP BY brand)
SELECT brand, CASE WHEN n > 10 THEN q2 * 0.15::DOUBLE END AS lower_boundary,
CASE WHEN n > 10 THEN q3 + CASE brand WHEN 'Rolex' THEN 10 WHEN 'Omega' THEN 3.5 WHEN 'Hamilton' THEN 5 ELSE 4 END::DOUBLE * (q3 - q1) END AS upper_boundary FROM S""")
def brand_multipliers(spark, sf_dir):
    n = F.col("year_introduced") % 4
    named = listings(spark, sf_dir).withColumn("brand", F.when(n == 0, "Rolex").when(n == 1, "Omega").when(n == 2, "Hamilton").otherwise("Nobody"))
    bounds = outliers.thresholds(outliers.with_category(outliers.group_statistics(named, ["brand"])), by_reference=False)
    return bounds.select("brand", "lower_boundary", "upper_boundary")


_REC = """A AS (SELECT 'rw-' || p_partkey || '.' AS ref, 'RW' || p_partkey AS key FROM part),
R AS (SELECT l_orderkey * 10 + l_linenumber AS ingest_id, CASE WHEN l_linenumber = 7 THEN 'Nobody' ELSE 'REC Watches' END AS brand,
  CASE l_linenumber % 3 WHEN 0 THEN 'new RW ' || l_partkey WHEN 2 THEN 'no number' END AS reference_number,
  CASE WHEN l_linenumber % 3 = 1 THEN 'watch (rw/' || l_partkey || ')' ELSE 'a title' END AS listing_title FROM lineitem),
X AS (SELECT *, regexp_replace(upper(reference_number), '[^0-9A-Z]', '', 'g') AS a, regexp_replace(upper(listing_title), '[^0-9A-Z]', '', 'g') AS b FROM R),
T AS (SELECT a AS t FROM X UNION SELECT b FROM X), H AS (SELECT t, min(ref) AS ref FROM T JOIN A ON contains(t, key) GROUP BY t)"""


def _rec_rows(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Listings of a brand without rules, and its accepted references: all part keys."""
    line, key = F.col("l_linenumber"), F.col("l_partkey").cast("string")
    rows = table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") * 10 + line).alias("ingest_id"), F.when(line == 7, "Nobody").otherwise("REC Watches").alias("brand"),
        F.when(line % 3 == 0, F.concat(F.lit("new RW "), key)).when(line % 3 == 2, "no number").alias("reference_number"),
        F.when(line % 3 == 1, F.concat(F.lit("watch (rw/"), key, F.lit(")"))).otherwise("a title").alias("listing_title"),
    )
    accepted = table(spark, sf_dir, "part").select(F.lit("REC Watches").alias("brand"), F.concat(F.lit("rw-"), F.col("p_partkey").cast("string"), F.lit(".")).alias("reference_number"))
    return rows, accepted


@register(f"""WITH {_REC} SELECT ingest_id, CASE WHEN brand = 'Nobody' THEN coalesce(reference_number, '') ELSE coalesce(x.ref, y.ref, reference_number, '') END AS reference_number
FROM X LEFT JOIN H x ON x.t = a LEFT JOIN H y ON y.t = b""")
def listed_references(spark, sf_dir):
    rows, accepted = _rec_rows(spark, sf_dir)
    return identifiers.with_references(rows, accepted).select("ingest_id", "reference_number")


@register(f"WITH {_REC} SELECT ingest_id, ref AS accepted_reference FROM X LEFT JOIN H ON t = b")
def accepted_reference(spark, sf_dir):
    rows, accepted = _rec_rows(spark, sf_dir)
    return identifiers.accepted_reference(rows, accepted, "listing_title").select("ingest_id", "accepted_reference")


@register(f"""WITH {LISTINGS}, X AS (SELECT ingest_id, brand, 'the ' || lower(specific_model) || ' ' || lower(parent_model) || ', ' || year_introduced AS t FROM L),
R AS (SELECT p_brand AS brand, CASE p_partkey % 3 WHEN 0 THEN p_name WHEN 1 THEN p_type ELSE split_part(p_name, ' ', 2) || ' ' || p_type END AS alternate, p_partkey AS priority, p_name AS specific_model, p_type || '/' || p_size AS parent_model FROM part),
D AS (SELECT DISTINCT brand, t FROM X), H AS (SELECT D.brand, t, arg_min(specific_model, priority) AS specific_model, arg_min(parent_model, priority) AS parent_model
  FROM D JOIN R ON R.brand = D.brand AND contains(t, lower(alternate)) GROUP BY ALL)
SELECT ingest_id, specific_model, parent_model FROM X LEFT JOIN H USING (brand, t)""")
def models_by_rules(spark, sf_dir):
    rows = listings(spark, sf_dir)
    rows = rows.select("ingest_id", "brand", F.concat(F.lit("The "), F.upper("specific_model"), F.lit(" "), F.col("parent_model"), F.lit(", "), F.col("year_introduced").cast("string")).alias("text"))
    n = F.col("p_partkey") % 3
    alternate = F.when(n == 0, F.col("p_name")).when(n == 1, F.col("p_type")).otherwise(F.concat_ws(" ", F.split_part("p_name", F.lit(" "), F.lit(2)), "p_type"))
    rules = table(spark, sf_dir, "part").select(
        F.col("p_brand").alias("brand"), alternate.alias("alternate"), F.col("p_partkey").alias("priority"), F.col("p_name").alias("specific_model"),
        F.concat_ws("/", "p_type", F.col("p_size").cast("string")).alias("parent_model"),
    )
    return attributes.models_of(rows, rules).select("ingest_id", "specific_model", "parent_model")


_WORDS = r"regexp_replace(' ' || lower({c}) || ' ', '[^\p{{L}}\p{{N}}]+', ' ', 'g')"


@register(f"""WITH B AS (SELECT DISTINCT p_brand AS name, p_brand AS alias FROM part UNION SELECT upper(p_name), p_name FROM part UNION SELECT 'one ' || split_part(p_name, ' ', 2), split_part(p_name, ' ', 2) FROM part
  UNION SELECT p_type || ' of ' || p_brand, p_brand || ' ' || p_type FROM part),
T AS (SELECT p_partkey, p_name || '-' || p_type || ' (' || p_brand || ' & ' || p_type || ')' AS title FROM part WHERE p_partkey % 5 <> 0 UNION ALL SELECT p_partkey, left(p_name, 4) || p_type FROM part WHERE p_partkey % 5 = 0),
H AS (SELECT p_partkey, name, row_number() OVER (PARTITION BY p_partkey ORDER BY len(alias) DESC, name DESC) AS r FROM T JOIN B ON contains({_WORDS.format(c="title")}, {_WORDS.format(c="alias")}))
SELECT p_partkey, name AS brand_found FROM T LEFT JOIN (SELECT * FROM H WHERE r = 1) USING (p_partkey)""")
def brands_in_titles(spark, sf_dir):
    part, kind, name, brand = table(spark, sf_dir, "part"), F.col("p_type"), F.col("p_name"), F.col("p_brand")
    noun = F.split_part(name, F.lit(" "), F.lit(2))
    pairs = [(brand, brand), (F.upper(name), name), (F.concat(F.lit("one "), noun), noun), (F.concat(kind, F.lit(" of "), brand), F.concat_ws(" ", brand, kind))]
    brands = part.select(F.explode(F.array(*[F.struct(n.alias("name"), a.alias("alias")) for n, a in pairs])).alias("b")).select("b.*").distinct()
    title = F.when(F.col("p_partkey") % 5 != 0, F.concat(name, F.lit("-"), kind, F.lit(" ("), brand, F.lit(" & "), kind, F.lit(")"))).otherwise(F.concat(F.substring(name, 1, 4), kind))
    titles = part.select("p_partkey", title.alias("title")).repartition("title")
    return attributes.brand_of(titles, brands).select("p_partkey", "brand_found")


@register("""WITH T AS (SELECT o_custkey AS k, max(o_orderdate) AS d, count(*) AS n FROM orders WHERE o_custkey % 3 <> 0 GROUP BY o_custkey),
C AS (SELECT o_custkey AS k, o_orderdate AS d, -o_orderkey AS n FROM orders WHERE o_custkey % 2 = 0 QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) = 1)
SELECT T.k, cast(coalesce(C.d, T.d) AS DATE) AS d, n FROM (SELECT T.k, T.d, T.n FROM T) T LEFT JOIN (SELECT k, d FROM C) C USING (k) UNION ALL SELECT k, cast(d AS DATE), n FROM C WHERE k NOT IN (SELECT k FROM T)""")
def upsert_repeated_keys(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    key, day = F.col("o_custkey").alias("k"), F.to_date("o_orderdate")
    target = orders.where("o_custkey % 3 <> 0").groupBy(key).agg(F.max(day).alias("d"), F.count(F.lit(1)).alias("n"))
    changes = orders.where("o_custkey % 2 = 0").select(key, day.alias("d"), (-F.col("o_orderkey")).alias("n"))
    return cleaning.upsert(target, changes, "k", ["d"], order=[F.desc("d"), F.desc("n")])


_SHAPE = "CASE WHEN v = '' THEN 'empties' WHEN regexp_full_match(v, '[+-]?[0-9]+') THEN 'integers' WHEN regexp_full_match(v, '[+-]?[0-9]*\\.[0-9]+') THEN 'decimals' WHEN regexp_full_match(v, '[0-9]{4}-[0-9]{2}-[0-9]{2}') THEN 'days' WHEN v IS NOT NULL THEN 'texts' END"
_CELLS = [("key", "bigint", "o_orderkey"), ("status", "string", "nullif(o_orderstatus, 'F')"), ("price", "decimal(20,2)", "CAST(o_totalprice AS DECIMAL(20, 2))"), ("day", "date", "CAST(o_orderdate AS DATE)"), ("priority", "string", "o_orderpriority")]


@register("WITH C AS (" + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", '{t}' AS type, CAST({e} AS VARCHAR) AS v FROM orders" for c, t, e in _CELLS) + f"""),
S AS (SELECT *, {_SHAPE} AS shape, md5(v) AS digest FROM C), M AS (SELECT "column", min(digest || v) AS m FROM S WHERE v IS NOT NULL GROUP BY "column", left(digest, 1)),
J AS (SELECT "column", string_agg(substr(m, 33), '|' ORDER BY m) AS samples FROM M GROUP BY "column")
SELECT "column", type, count(*) AS rows, count(*) - count(v) AS nulls, {", ".join(f"count(*) FILTER (shape = '{n}') AS {n}" for n in (*profile.SHAPES, "texts"))}, samples
FROM S LEFT JOIN J USING ("column") GROUP BY "column", type, samples""")
def value_census(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("bigint").alias("key"), F.nullif("o_orderstatus", F.lit("F")).alias("status"), F.col("o_totalprice").cast("decimal(20,2)").alias("price"),
        F.to_date("o_orderdate").alias("day"), F.col("o_orderpriority").alias("priority"),
    )
    return profile.value_census(orders).withColumn("samples", F.array_join("samples", "|"))


@register(f"""WITH {LISTINGS} SELECT brand, parent_model, date, median(price) AS median_price, avg(price) AS mean_price, max(price) AS high, min(price) AS low, count(*) AS count
FROM L WHERE brand IS NOT NULL AND parent_model IS NOT NULL AND date IS NOT NULL GROUP BY ALL""")
def weeks_from_batches(spark, sf_dir):
    rows, keys = listings(spark, sf_dir), ["brand", "parent_model"]
    dealt = [batches.price_counts(rows.where(F.pmod("ingest_id", F.lit(3)) == k), keys) for k in range(3)]
    return batches.weeks_from_counts(dealt[0].union(dealt[1]).union(dealt[2]), keys)


#: A text in each brand's form and the reference in it; ①②③④⑤⑥ stand for the digits of a part's key.
_BRAND_FORMS = [
    ("Nomos Glashütte", "model ①②③④.ab", "①②③④.AB"), ("Meistersinger", "new s-bm①②③", "S-BM①②③"), ("Meistersinger", "model dm①②③bk", "DM①②③BK"),
    ("Rolex", "m①②③④⑤⑥ln-0001 x", "①②③④⑤⑥LN-0001"), ("Rolex", "①②③④⑤⑥ln 0001", "①②③④⑤⑥LN-0001"),
    ("Omega", "①②③.④⑤.⑥①.②③.④⑤.⑥①②", "①②③.④⑤.⑥①.②③.④⑤.⑥①②"), ("Omega", "no ①②③ ④⑤ ⑥① ②③ ④⑤ ⑥①②!", "①②③.④⑤.⑥①.②③.④⑤.⑥①②"),
    ("A. Lange & Söhne", "①②③ ④⑤⑥ F", "①②③.④⑤⑥F"), ("Breitling", "ab①②③④⑤⑥ 1c-2d3", "AB①②③④⑤⑥1C2D3"),
    ("Seiko", "seiko srp①②③k1", "SRP①②③K1"), ("Seiko", "text ①②③④-⑤⑥a1", "①②③④-⑤⑥A1"),
    ("Longines", "l①.②③④.⑤.⑥①.②", "L①.②③④.⑤.⑥①.②"), ("Longines", "L① ②③④ ⑤ ⑥① ②", "L①.②③④.⑤.⑥①.②"), ("Longines", "l①.②③④.⑤ only", "L①.②③④.⑤"),
    ("TAG Heuer", "wa①②③④.ba⑤⑥①②", "WA①②③④.BA⑤⑥①②"), ("TAG Heuer", "wa①②③④-ba⑤⑥①②", "WA①②③④.BA⑤⑥①②"),
    ("Patek Philippe", "①②③④/1a ⑤⑥①", "①②③④/1A-⑤⑥①"), ("Audemars Piguet", "①②③④⑤st.oo.①②②⑤st.0⑥", "①②③④⑤ST.OO.①②②⑤ST.0⑥"),
    ("Hublot", "①②③.nx.④⑤⑥①.lr", "①②③.NX.④⑤⑥①.LR"), ("Tissot", "t①②③.④⑤⑥.①②.③④⑤.⑥①", "T①②③.④⑤⑥.①②.③④⑤.⑥①"), ("Tudor", "m79①②③b-0001", "M79①②③B-0001"),
    ("Citizen", "ab①②③④-50e x", "AB①②③④-50E"), ("IWC", "iw①②③④⑤⑥", "IW①②③④⑤⑥"), ("IWC", "iw-①②③④-⑤⑥", "IW①②③④⑤⑥"), ("Cartier", "ref wsbb①②③④", "WSBB①②③④"),
    ("Chopard", "①②a③④⑤-⑥①②③", "①②A③④⑤-⑥①②③"), ("Zenith", "①②.a③④⑤.⑥①②-1/②③.m④⑤⑥①", "①②.A③④⑤.⑥①②-1/②③.M④⑤⑥①"), ("Zenith", "①②.a③④⑤.⑥①②/②③.m④⑤⑥①", "①②.A③④⑤.⑥①②/②③.M④⑤⑥①"),
    ("Hamilton", "h70①②③④⑤⑥", "H70①②③④⑤⑥"), ("Jaeger-LeCoultre", "q ①②③④⑤⑥1a", "①②③④⑤⑥1A"), ("Baume & Mercier", "m0a①②③④⑤", "M0A①②③④⑤"), ("Bvlgari", "ref 10①②③④", "10①②③④"),
    ("Rado", "r①②③④⑤⑥①②", "R①②③④⑤⑥①②"), ("Grand Seiko", "the sbga①②③g", "SBGA①②③G"), ("Vacheron Constantin", "①②③④v/②②0a-b③④⑤", "①②③④V/②②0A-B③④⑤"),
    ("Vacheron Constantin", "①②③④v ②②0a b③④⑤", "①②③④V/②②0A-B③④⑤"), ("Blancpain", "①②③④ ⑤⑥①② b52a", "①②③④ ⑤⑥①② B52A"), ("Maurice Lacroix", "ai①②③④ ss⑤⑥1/②③0-1", "AI①②③④-SS⑤⑥1-②③0-1"),
    ("Breguet", "①②③④bb⑤⑥1x/②③4aa", "①②③④BB⑤⑥1X/②③4AA"), ("Mido", "m①②③.④⑤⑥.1a.②③④.00", "M①②③.④⑤⑥.1A.②③④.00"), ("Bulova", "no ①②a③④⑤", "①②A③④⑤"),
    ("Oris", "01 ①②③ ④⑤⑥① ②③④⑤", "01 ①②③ ④⑤⑥① ②③④⑤"), ("Oris", "01①②③④⑤⑥①②③④⑤", "01 ①②③ ④⑤⑥① ②③④⑤"), ("Montblanc", "mb①②③④⑤⑥", "①②③④⑤⑥"),
    ("Frederique Constant", "fc-①②③ab④⑤", "FC-①②③AB④⑤"), ("Frederique Constant", "fc ①②③ab④⑤", "FC-①②③AB④⑤"), ("Panerai", "pam①②③", "PAM00①②③"), ("Nobody", "keep ①②③", None),
]
_QUOTED = ", ".join(f"({n}, '{b}', '{t}', {'NULL' if r is None else repr(r)})" for n, (b, t, r) in enumerate(_BRAND_FORMS))


def _brand_forms(spark, sf_dir) -> DataFrame:
    """Every form with the digits of every part's key."""
    forms = F.array(*[F.struct(F.lit(n).alias("form"), F.lit(b).alias("brand"), F.lit(t).alias("text")) for n, (b, t, _) in enumerate(_BRAND_FORMS)])
    rows = _parts(spark, sf_dir).select("p_partkey", _digits().alias("digits"), F.explode(forms).alias("f"))
    return rows.select("p_partkey", "f.form", "f.brand", F.expr("translate(f.text, '①②③④⑤⑥', digits)").alias("text"))


@register(f"""WITH V(form, brand, t, r) AS (VALUES {_QUOTED}), X AS (SELECT p_partkey, form, brand, translate(t, '①②③④⑤⑥', {_KEY}) AS t, translate(r, '①②③④⑤⑥', {_KEY}) AS r FROM part, V)
SELECT p_partkey, form, CASE WHEN brand = 'Nobody' THEN CASE WHEN p_partkey % 2 = 0 THEN t ELSE '-' END ELSE r END AS reference_number FROM X""")
def brand_rules(spark, sf_dir):
    rows, even = _brand_forms(spark, sf_dir), F.col("p_partkey") % 2 == 0
    reference, title = F.when(even, F.col("text")).otherwise("-"), F.when(~even, F.col("text")).otherwise("a title")
    return rows.select("p_partkey", "form", identifiers.reference_of(F.col("brand"), reference, title).alias("reference_number"))


@register(f"""WITH V(form, brand, t, r) AS (VALUES {_QUOTED}), X AS (SELECT p_partkey, form, brand, translate(t, '①②③④⑤⑥', {_KEY}) AS t, translate(r, '①②③④⑤⑥', {_KEY}) AS r FROM part, V)
SELECT p_partkey, form, CASE WHEN p_partkey % 3 = 0 THEN coalesce(r, t) WHEN p_partkey % 3 = 1 THEN r WHEN brand = 'Nobody' THEN upper(t) ELSE r END AS reference_number FROM X""")
def references_cleaned_again(spark, sf_dir):
    """From the reference in small letters, from the title of a row without one, from the reference as the rule writes it."""
    n = F.col("p_partkey") % 3
    rows = _brand_forms(spark, sf_dir).withColumn("reference_number", F.when(n == 0, F.col("text")).when(n == 2, F.upper("text")))
    rows = rows.withColumn("listing_title", F.when(n == 1, F.col("text")))
    return identifiers.with_recleaned(rows, title="listing_title").select("p_partkey", "form", "reference_number")


#: The same for the older rules: a reference (or none), a title, what is found and its group.
_EARLIER_FORMS = [
    ("Rolex", "m①②③④⑤⑥ln-0001 new", "x", "m①②③④⑤⑥ln-0001", "①②③④⑤⑥ln"), ("Rolex", "①②③④⑤", "①②③④⑤⑥", "①②③④⑤", "①②③④⑤"), ("Rolex", None, "it is ①②③④⑤⑥LN", "①②③④⑤⑥LN", "①②③④⑤⑥LN"),
    ("Omega", "no ①②③.④⑤.⑥①.②③.④⑤.⑥①②", "x", "①②③.④⑤.⑥①.②③.④⑤.⑥①②", ""), ("Omega", "①②③ ④⑤ ⑥①-②③ ④⑤ ⑥①②", "x", "①②③.④⑤.⑥①.②③.④⑤.⑥①②", ""), ("Omega", "①②③④.⑤⑥ x", "x", "①②③④.⑤⑥.00", ""),
    ("Omega", "", "①②③④.⑤⑥.①②", "①②③④.⑤⑥.①②", ""), ("Omega", "①②③.④⑤⑥-①②", "x", "①②③.④⑤⑥-①②", ""), ("Omega", "BA ①②③.④⑤⑥①", "x", "BA ①②③.④⑤⑥①", ""), ("Omega", "①②.③④⑤.⑥①②③", "x", "①②.③④⑤.⑥①②③", ""),
    ("Breitling", "AB①②③④⑤⑥1C-2D3", "x", "AB①②③④⑤⑥1C-2D3", ""), ("Breitling", None, "in AB①②③④⑤⑥1C2D3.", "AB①②③④⑤⑥1C2D3", ""), ("Seiko", "SRP①②③K1", "x", "SRP①②③K1", ""), ("Seiko", "srp①②③k1", "SRP①②③K1", "srp①②③k1", ""),
    ("Longines", "L①.②③④.⑤.⑥①.② x", "x", "L①.②③④.⑤.⑥①.②", ""), ("Longines", None, "L① ②③④ ⑤", "", ""), ("TAG Heuer", "the WAY①②③④.BA⑤⑥①②", "x", "WAY①②③④.BA⑤⑥①②", ""),
    ("Patek Philippe", "x①②③④/1A-⑤⑥①", "x", "①②③④/1A-⑤⑥①", ""), ("Patek Philippe", None, "a ①②③④g-⑤⑥①", "①②③④g-⑤⑥①", ""), ("Audemars Piguet", "x ①②③④⑤ST.OO.①②②⑤ST.0⑥-A", "x", "①②③④⑤ST.OO.①②②⑤ST.0⑥-A", ""),
    ("Tudor", "M79①②③B-0001 x", "x", "M79①②③B-0001", "79①②③B"), ("Tudor", None, "①②③④", "", ""), ("IWC", "IW①②③④⑤⑥", "x", "IW①②③④⑤⑥", ""), ("IWC", "IW-①②③④-⑤⑥", "x", "IW①②③④⑤⑥", ""), ("IWC", "IW-①②③④", "x", "IW①②③④", ""),
    ("IWC", "Ref ①②③", "x", "Reference ①②③", ""), ("IWC", None, "reference ①②③", "Reference ①②③", ""), ("Jaeger-LeCoultre", "no Q①②③④⑤⑥1", "x", "Q①②③④⑤⑥1", ""), ("Jaeger-LeCoultre", None, "①②③④⑤⑥1", "", ""),
    ("Vacheron Constantin", "①②③④v/②②0a b③④⑤", "x", "①②③④v/②②0a b③④⑤", ""), ("Maurice Lacroix", "x AI①②③④-SS⑤⑥1-②③0-1", "x", "AI①②③④-SS⑤⑥1-②③0-1", ""), ("Hamilton", None, "new H70①②③④⑤⑥", "H70①②③④⑤⑥", ""),
    ("Oris", "01①②③④⑤⑥", "x", "01①②③④⑤⑥", ""), ("Oris", None, "01 ①②③ ④⑤⑥① ②③④⑤", "", ""), ("Nobody", "keep ①②③", "x", "keep ①②③", ""), (None, None, None, "", ""),
]

@register(f"""WITH V(form, r, g) AS (VALUES {", ".join(f"({n}, '{f[3]}', '{f[4]}')" for n, f in enumerate(_EARLIER_FORMS))})
SELECT p_partkey, form, translate(r, '①②③④⑤⑥', {_KEY}) AS reference_number, translate(g, '①②③④⑤⑥', {_KEY}) AS group_reference FROM part, V""")
def earlier_brand_rules(spark, sf_dir):
    kind = "array<struct<form:int,brand:string,reference:string,title:string>>"
    forms = F.array(*[F.struct(F.lit(n), *map(F.lit, f[:3])) for n, f in enumerate(_EARLIER_FORMS)]).cast(kind)
    rows = _parts(spark, sf_dir).select("p_partkey", _digits().alias("digits"), F.explode(forms).alias("f"))
    reference, title = (F.expr(f"translate(f.{c}, '①②③④⑤⑥', digits)") for c in ("reference", "title"))
    rows = rows.select("p_partkey", "f.form", "f.brand", identifiers.earlier_reference_of(F.col("f.brand"), reference, title).alias("reference_number"))
    return rows.select("p_partkey", "form", "reference_number", identifiers.earlier_group_reference(F.col("brand"), F.col("reference_number")).alias("group_reference"))


#: A text of each attribute and its standard value; ①② stand for the first digits of a part's key.
_ATTRIBUTE_FORMS = [
    ("whole_price", "US $①,②00.56", "①②00"), ("whole_price", "on request", ""), ("weight", "①②5 g", "①②5.0 g"), ("weight", "2 oz", "56.699 g"), ("weight", "heavy", ""),
    ("water_resistance", "5 ATM / ①②0 m", "5.0 ATM"), ("water_resistance", "100 feet", "3.05 ATM"), ("water_resistance", "not water resistant", "Not water resistant"), ("water_resistance", "0 bar", "Not water resistant"), ("water_resistance", "", ""),
    ("diameter", "①②,5 x 3① mm", "①②.5 x 3①.0 mm"), ("diameter", "4 cm", "40.0 mm"), ("diameter", "round", ""), ("power_reserve", "①② h", "①② hours"), ("power_reserve", "2 days", "48.0 hours"), ("power_reserve", "long", ""),
    ("jewels", "①② Jewels", "①②"), ("jewels", "many", ""), ("production_year", "made in 19①②!", "19①②"), ("production_year", "no 3①②1", ""), ("millimetres", "①② mm (about)", "①②.0 mm"), ("millimetres", "2 in", "50.8 mm"),
    ("seller_rating", "98%", "Excellent"), ("seller_rating", "3.2 of 5", "Average"), ("seller_rating", "great", "Great"), ("seller_rating", "0", "Unavailable"), ("seller_rating", "none", ""),
    ("seller_type", "professional dealer", "Dealer"), ("seller_type", " AUCTION house", "Auction House"), ("seller_type", "shop ①", ""), ("currency_code", "①② eur", "EUR"), ("currency_code", "£①②", "GBP"), ("currency_code", "①②", ""),
    ("production_decades", "1985 to 93", "1980s, 1990s"), ("production_decades", "2004", "2000s"), ("production_decades", "old", ""), ("authenticity", "Authenticity Guarantee ①", "Yes"), ("authenticity", "watch ①②", "No"),
    ("case_material", "white gold & DLC case ①", "DLC, White Gold"), ("case_material", "ADLC over bronze", "ADLC, Bronze"), ("case_material", "ceramical", None), ("case_material", "yellow gold", "Gold"),
    ("dial_color", "ROSE GOLD ①", "Rose Gold"), ("dial_color", "Green/Black", "Green, Black"), ("dial_color", "none ②", None), ("bracelet_material", "alligator", "Alligator, Leather"), ("bracelet_material", "calf and carbon", "Calfskin, Leather, Carbon"),
    ("bracelet_color", "blue-brown ①", "Blue, Brown"), ("bracelet_color", "grey", "Gray"), ("clasp_type", "pin buckle", "Pin Buckle, Buckle"), ("clasp_type", "a buckle ①", "Buckle"), ("clasp_type", "hidden folding clasp", "Hidden Clasp, Folding Clasp"), ("clasp_type", "Velcro", "Velcro"),
    ("style", "diver", "Dive, Sport"), ("style", "dress ①②", "Dress"), ("style", "sport, racing", "Sport, Racing / Driving"), ("crystal", "saphire / plexi", "Sapphire, Plexiglass"), ("case_shape", "barrel ①", "Tonneau"), ("case_shape", "octagonal", "Octagon"),
    ("features", "alarm, 24 hour ②", "24-Hour Indication, Alarm, Hours"), ("features", "nothing", None), ("watch_type", " Ladies", "Women's Watches"), ("watch_type", "clocks", "Other / Clock"), ("watch_type", "ladies ①", ""),
    ("listing_type", "place bid, buy now, other", "Auction, Buy it Now"), ("listing_type", "inquire", "Contact Seller"), ("listing_type", "①", ""),
]
_ATTRIBUTES = {
    "jewels": lambda c: attributes.jewels(c, F.lit("ebay")), "millimetres": lambda c: attributes.millimetres(c, F.lit("ebay")),
    "currency_code": lambda c: attributes.currency_code(c, ["USD", "EUR"]), "production_decades": lambda c: attributes.production_decades(F.lit(""), c),
    "authenticity": lambda c: attributes.authenticity(c, F.lit("ebay"), {}),
}
_literal = lambda v: "NULL" if v is None else "'" + v.replace("'", "''") + "'"


@register(f"""WITH V(form, t, r) AS (VALUES {", ".join(f"({n}, {_literal(t)}, {_literal(r)})" for n, (_, t, r) in enumerate(_ATTRIBUTE_FORMS))})
SELECT p_partkey, form, translate(r, '①②', {_KEY}) AS value FROM part, V""")
def attribute_forms(spark, sf_dir):
    forms = F.array(*[F.struct(F.lit(n).alias("form"), F.lit(a).alias("attribute"), F.lit(t).alias("text")) for n, (a, t, _) in enumerate(_ATTRIBUTE_FORMS)])
    rows = _parts(spark, sf_dir).select("p_partkey", _digits().alias("digits"), F.explode(forms).alias("f"))
    rows = rows.select("p_partkey", "f.form", "f.attribute", F.expr("translate(f.text, '①②', digits)").alias("text"))
    value = F.lit(None).cast("string")
    for name in dict.fromkeys(a for a, _, _ in _ATTRIBUTE_FORMS):
        rule = _ATTRIBUTES.get(name) or getattr(attributes, name)
        value = F.when(F.col("attribute") == name, rule(F.col("text"))).otherwise(value)
    return rows.select("p_partkey", "form", value.alias("value"))


#: Attributes that list every value of which a synonym is in the text.
_PLAIN = {"features": V.FEATURES, "crystal": V.CRYSTAL, "case_shape": V.CASE_SHAPE}
_SYNONYMS = [s for v in _PLAIN.values() for words in v.values() for s in words]


@register(f"""WITH W AS (SELECT [{", ".join(map(_literal, _SYNONYMS))}] AS w), N AS (SELECT p_partkey, unnest(range(0, len(w), 7)) AS k, w FROM part, W),
X AS (SELECT p_partkey, k, upper(w[(k + p_partkey) % len(w) + 1]) || ' and ' || w[(k * 3 + p_partkey * 5) % len(w) + 1] AS t FROM N)
SELECT p_partkey, k, {", ".join(f"{_vocabulary_sql(v, 't', False)} AS {n}" for n, v in _PLAIN.items())} FROM X""")
def attribute_vocabularies(spark, sf_dir):
    words, n, key = F.array(*map(F.lit, _SYNONYMS)), len(_SYNONYMS), F.col("p_partkey")
    rows = _parts(spark, sf_dir).select("p_partkey", F.explode(F.sequence(F.lit(0), F.lit(n - 1), F.lit(7))).alias("k"), words.alias("w"))
    at = lambda place: F.get("w", (place % n).cast("int"))
    rows = rows.select("p_partkey", "k", F.concat(F.upper(at(F.col("k") + key)), F.lit(" and "), at(F.col("k") * 3 + key * 5)).alias("text"))
    return rows.select("p_partkey", F.col("k").cast("bigint").alias("k"), *[getattr(attributes, name)(F.col("text")).alias(name) for name in _PLAIN])


@register(f"""WITH {LISTINGS}, W AS (SELECT brand, parent_model, cast(day + cast((7 - isodow(day)) % 7 AS INT) AS DATE) AS date, avg(price) AS mean_price, count(price) AS count FROM L WHERE condition = 'New' GROUP BY 1, 2, 3),
C AS (SELECT brand, parent_model, date, mean_price - lag(mean_price) OVER w AS "mean_price_$_change", (mean_price - lag(mean_price) OVER w) / lag(mean_price) OVER w * 100 AS "mean_price_%_change",
  count - lag(count) OVER w AS "count_$_change", (count - lag(count) OVER w) / lag(count) OVER w * 100 AS "count_%_change" FROM W WINDOW w AS (PARTITION BY brand, parent_model ORDER BY date))
SELECT brand, parent_model, date, "count_$_change", {", ".join(f'round("{c}", 6) AS "{c}"' for c in ("mean_price_$_change", "mean_price_%_change", "count_%_change"))} FROM C WHERE date = (SELECT max(date) FROM C)""")
def active_listing_changes(spark, sf_dir):
    out = weekly.active_listings(listings(spark, sf_dir).withColumn("date", F.col("day")), ["brand", "parent_model"], "New", order="ingest_id")
    rounded = [F.round(c, 6).alias(c) for c in ("mean_price_$_change", "mean_price_%_change", "count_%_change")]
    return out.select("brand", "parent_model", "date", "count_$_change", *rounded)


@register(f"""WITH {LISTINGS}, W AS ({_weekly_sql("brand")}), M AS (SELECT brand, last_day(date) AS period_end, avg(median_price) AS mean_price FROM W GROUP BY ALL)
SELECT brand, period_end, round(mean_price, 6) AS mean_price, round((mean_price - lag(mean_price) OVER w) / lag(mean_price) OVER w * 100, 6) AS pct_change FROM M WINDOW w AS (PARTITION BY brand ORDER BY period_end)""")
def resample_means(spark, sf_dir):
    out = volatility.resample(weekly.weekly(listings(spark, sf_dir), "brand", order="ingest_id"), ["brand"], "1M", "median_price")
    return out.select("brand", "period_end", F.round("mean_price", 6).alias("mean_price"), F.round("pct_change", 6).alias("pct_change"))


@register(f"WITH {LISTINGS} SELECT ingest_id, source FROM L WHERE ingest_id % 4 <> 0")
def rows_that_name_their_source(spark, sf_dir):
    rows = listings(spark, sf_dir).withColumn("source", F.when(F.col("ingest_id") % 4 != 0, F.col("source")))
    return cleaning.with_source(rows).select("ingest_id", "source")


#: Raw reference, price, year of production, currency, status; cleaned reference (none: the row goes), price, year. ①②③④ are digits of a part's key.
_RAW_FORMS = [
    ("ref.①②③", "1,234.5", "1990s", "USD", None, "①②③", 1234.5, 1990), ("(ab①②)", "5", "2001", "EUR", "", "AB①②", 5.0, 2001), ("x①, does not apply", "7", None, "USD", "Live", "X①", 7.0, 0),
    ("k\u202e④", "1,000,000", "about", "USD", None, "K④", 1e6, 0), ("'a\"①[②]", "3", "1985.0", "USD", None, "A①②", 3.0, 1985), ("#-z③", "2", "2010", "USD", None, "Z③", 2.0, 2010),
    ("does not apply", "1", "2000", "USD", None, None, None, None), ("n/a", "1", "2000", "USD", None, None, None, None), ("--", "1", "2000", "USD", None, None, None, None), ("0 - 0", "1", "2000", "USD", None, None, None, None),
    ("", "1", "2000", "USD", None, None, None, None), (None, "1", "2000", "USD", None, None, None, None), ("a①", "abc", "2000", "USD", None, None, None, None), ("a②", None, "2000", "USD", None, None, None, None),
    ("a③", "9", "2000", None, None, None, None, None), ("a④", "9", "2000", "USD", "Deleted", None, None, None),
]


@register(f"""WITH V(form, ref, price, year) AS (VALUES {", ".join(f"({n}, {_literal(r)}, {p}::DOUBLE, {y})" for n, (_, _, _, _, _, r, p, y) in enumerate(_RAW_FORMS) if r is not None)})
SELECT p_partkey, form, translate(ref, '①②③④', {_KEY}) AS reference_number, price, year AS year_of_production, 'eBay Sold' AS source FROM part, V""")
def clean_raw_forms(spark, sf_dir):
    names = ("ref", "price", "year", "currency", "status")
    forms = F.array(*[F.struct(F.lit(n).alias("form"), *[F.lit(v).cast("string").alias(c) for c, v in zip(names, row[:5], strict=True)]) for n, row in enumerate(_RAW_FORMS)])
    rows = table(spark, sf_dir, "part").select("p_partkey", _digits().alias("digits"), F.explode(forms).alias("f"))
    raw = rows.select(
        "p_partkey", "f.form", F.expr("translate(f.ref, '①②③④', digits)").alias("reference_number"), "f.price", F.col("f.year").alias("year_of_production"), "f.currency", "f.status",
        F.lit("2024-01-07").cast("date").alias("date"), F.concat_ws("/", "p_partkey", "f.form").alias("watch_url"), F.lit("EBAY Sold").alias("source"), F.lit("A").alias("brand"),
        F.lit(None).cast("string").alias("year_introduced"), F.col("p_partkey").alias("ingest_id"),
    )
    return cleaning.clean_listings(raw).select("p_partkey", "form", "reference_number", "price", "year_of_production", "source")


@register(f"""WITH X AS (SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 THEN 'Rolex' ELSE 'Omega' END AS brand, left({_KEY}, 3) || '.' || right({_KEY}, 3) AS r, left({_KEY}, 3) || '.0' || right({_KEY}, 3) AS padded FROM part),
Y AS (SELECT *, brand = 'Omega' AND right(r, 3) <> '000' AS matched FROM X), Z AS (SELECT *, CASE WHEN matched AND padded IN (SELECT padded FROM X WHERE p_partkey % 2 = 0) THEN padded ELSE r END AS own FROM Y)
SELECT p_partkey, brand, own AS reference_number, CASE WHEN matched THEN own ELSE 'old' END AS group_reference FROM Z""")
def omega_padding(spark, sf_dir):
    digits, key = _digits(), F.col("p_partkey")
    part = table(spark, sf_dir, "part")
    number = lambda join: F.concat(F.substring(digits, 1, 3), F.lit(join), F.substring(digits, 4, 3))
    library = part.where(key % 2 == 0).select(F.lit("Omega").alias("brand"), number(".0").alias("group_reference"))
    rows = part.select("p_partkey", F.when(key % 5 == 0, "Rolex").otherwise("Omega").alias("brand"), number(".").alias("reference_number"), F.lit("old").alias("group_reference"))
    return identifiers.pad_omega(rows, library)


@register(f"""WITH {LISTINGS}, D AS (SELECT DISTINCT day, cast(isodow(day) AS INT) AS w FROM L)
SELECT day, CASE WHEN w IN (7, 1, 2, 3) THEN array_to_string(list_transform(range(0, (w % 7) + 4), lambda i: strftime(cast(day - ((w % 7) + 3) + cast(i AS INT) AS DATE), '%Y-%m-%d')), ',') END AS days FROM D""")
def ingest_windows(spark, sf_dir):
    days = F.array_join(F.transform(calendar.ingest_days(F.col("day")), lambda d: d.cast("string")), ",")
    return listings(spark, sf_dir).select("day").distinct().select("day", days.alias("days"))


@register("""SELECT try_cast(CASE WHEN o_orderkey % 7 = 0 THEN 'no ' || o_orderkey ELSE cast(o_orderkey AS VARCHAR) END AS BIGINT) AS k, try_cast(o_orderstatus AS INT) AS s,
cast(CASE WHEN o_custkey % 3 = 0 THEN NULL ELSE cast(o_orderdate AS DATE) END AS DATE) AS d, CAST(NULL AS DOUBLE) AS missing FROM orders""")
def coerced_columns(spark, sf_dir):
    key = F.col("o_orderkey").cast("string")
    rows = table(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderkey") % 7 == 0, F.concat(F.lit("no "), key)).otherwise(key).alias("k"), F.col("o_orderstatus").alias("s"),
        F.when(F.col("o_custkey") % 3 == 0, "some day").otherwise(F.to_date("o_orderdate").cast("string")).alias("d"), F.lit("x").alias("other"),
    )
    return cleaning.coerce(rows, StructType.fromDDL("k bigint, s int, d date, missing double"))


@register("""SELECT p_partkey, cast(CASE WHEN p_size % 3 = 0 THEN 0 ELSE floor(p_retailprice) END AS INT) AS year_introduced, cast(floor(p_size / 2) AS INT) AS count,
cast(floor(p_retailprice / 3) AS INT) AS rolling_avg_of_median_price FROM part""")
def final_types(spark, sf_dir):
    price, size = F.col("p_retailprice"), F.col("p_size")
    rows = table(spark, sf_dir, "part").select(
        "p_partkey", F.when(size % 3 != 0, price).alias("year_introduced"), (size / 2).alias("count"), (price / 3).alias("rolling_avg_of_median_price")
    )
    return cleaning.finalize_types(rows, quantize_rolling=True)


@register("""WITH X AS (SELECT p_partkey, CASE WHEN p_partkey % 6 = 0 THEN 'é ' ELSE '' END || p_name || ' & ' || p_brand AS t, p_size FROM part)
SELECT p_partkey, CASE WHEN len(repeat(t, p_size)) > 255 THEN left(repeat(t, p_size), 252) || '...' ELSE repeat(t, p_size) END AS capped,
lower(regexp_replace(t, '[^A-Za-z0-9_-]', '_', 'g')) AS group_name, translate(t, 'abcdefghijklmnopqrstuvwxyz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ') AS upper_text, p_partkey % 6 = 0 AS non_ascii,
sha256('part-' || p_partkey || '-' || CASE WHEN p_size % 2 = 0 THEN '<NA>' ELSE t END) AS hash_id, CASE WHEN p_size % 4 = 0 THEN NULL ELSE p_size * 1000.5::DOUBLE END AS price,
CASE p_size % 4 WHEN 0 THEN 1990 WHEN 1 THEN 0 WHEN 2 THEN 1900 + p_size ELSE 0 END AS year FROM X""")
def text_functions(spark, sf_dir):
    size, key = F.col("p_size"), F.col("p_partkey").cast("string")
    rows = table(spark, sf_dir, "part").withColumn("t", F.concat(F.when(F.col("p_partkey") % 6 == 0, "é ").otherwise(""), "p_name", F.lit(" & "), "p_brand"))
    price = F.when(size % 4 == 0, "on request").otherwise(F.format_number(size * 1000.5, 1))
    year = F.when(size % 4 == 0, "1990s").when(size % 4 == 1, "unknown").when(size % 4 == 2, (size + 1900).cast("string"))
    return rows.select(
        "p_partkey", text.cap(F.expr("repeat(t, p_size)")).alias("capped"), text.group_name(F.col("t")).alias("group_name"), text.upper_ascii(F.col("t")).alias("upper_text"),
        text.non_ascii(F.col("t")).alias("non_ascii"), text.hash_id(key, F.when(size % 2 != 0, F.col("t")), prefix="part").alias("hash_id"),
        text.price_number(price).alias("price"), text.year_number(year).alias("year"),
    )


_TOP = "(SELECT string_agg(brand || ' ' || reference_number || ' ' || cast(round({c}, 3) AS DECIMAL(20, 3)), '; ' ORDER BY {c} DESC, brand, reference_number) FROM (SELECT * FROM A ORDER BY {c} DESC, brand, reference_number LIMIT 5))"


@register(f"""WITH {LISTINGS}, {_DURATION} SELECT (SELECT count(*) FROM D) AS urls, (SELECT count(*) FROM D WHERE active) AS active, count(*) AS models,
{_TOP.format(c="mean_days")} AS longest, {_TOP.format(c="count")} AS most_urls FROM A""")
def full_duration_report(spark, sf_dir):
    """All urls are gone through once: a row for each model is written and read again."""
    path = run_folder(spark, "durations")
    liquidity.durations_by_model(listings(spark, sf_dir).withColumnRenamed("ingest_id", "hash_id")).write.parquet(path)
    out = liquidity.full_report_of_models(spark.read.parquet(path))
    as_text = lambda c: F.array_join(F.transform(c, lambda r: F.concat_ws(" ", r["brand"], r["reference_number"], F.round(r["value"], 3).cast("decimal(20,3)").cast("string"))), "; ")
    return out.select("urls", "active", "models", as_text("longest").alias("longest"), as_text("most_urls").alias("most_urls"))


_SPRING = "date BETWEEN DATE '1996-01-31' AND DATE '1996-03-31'"


@register(f"""WITH {LISTINGS}, M AS (SELECT last_day(date) AS date, ingest_id, brand, price FROM L WHERE date IS NOT NULL),
C AS (SELECT ingest_id, max(price) * 3 AS new FROM M WHERE {_SPRING} AND ingest_id % 7 = 0 GROUP BY ingest_id)
SELECT * FROM (SELECT date, ingest_id, brand, CASE WHEN new IS NOT NULL THEN new WHEN date BETWEEN DATE '1995-01-31' AND DATE '1995-12-31' THEN price * 2 ELSE price END AS price FROM M LEFT JOIN C USING (ingest_id)
UNION ALL (SELECT date, -ingest_id, brand, price FROM M WHERE {_SPRING} AND ingest_id % 11 = 0 QUALIFY row_number() OVER (PARTITION BY ingest_id ORDER BY price DESC, date DESC, brand DESC) = 1))
WHERE date BETWEEN DATE '1994-06-30' AND DATE '1997-05-31'""")
def weeks_merged(spark, sf_dir):
    """All dates (here months) written, a year of them once more, changes merged by date, a range of dates read back."""
    path = run_folder(spark, "weeks")
    rows = listings(spark, sf_dir).where("date IS NOT NULL").select(F.last_day("date").alias("date"), "ingest_id", "brand", "price")
    sources.write_weeks(rows, path)
    sources.write_weeks(rows.where("date BETWEEN DATE '1995-01-31' AND DATE '1995-12-31'").withColumn("price", F.col("price") * 2), path)
    spring = rows.where(_SPRING)
    tripled = spring.where("ingest_id % 7 = 0").withColumn("price", F.col("price") * 3)
    new = spring.where("ingest_id % 11 = 0").withColumn("ingest_id", -F.col("ingest_id"))
    changes = tripled.union(tripled.withColumn("price", F.lit(0.0))).union(new)
    sources.merge_weeks(path, changes, "ingest_id", ["price"], order=[F.desc("price"), F.desc("date"), F.desc("brand")])
    return sources.read_lake(spark, path, rows.schema, first="1994-06-30", last="1997-05-31")


@register("""WITH R AS (SELECT left(o_orderpriority, 3) AS currency, CAST(o_orderdate AS DATE) AS as_of, floor(max(o_totalprice)) AS rate FROM orders GROUP BY ALL)
SELECT currency, arg_max(rate, as_of) AS rate FROM R WHERE as_of <= DATE '1996-06-30' GROUP BY currency""")
def rates_from_csv(spark, sf_dir):
    """Rates of every day written as CSV and read back up to a day; the last one of each currency."""
    path = run_folder(spark, "rates")
    orders = table(spark, sf_dir, "orders")
    days = orders.groupBy(F.substring("o_orderpriority", 1, 3).alias("currency"), F.to_date("o_orderdate").alias("as_of"))
    rates = days.agg(F.floor(F.max("o_totalprice")).cast("double").alias("rate"))
    rates.select(*RATE_SCHEMA.names).write.option("header", True).csv(path)
    return cleaning.latest_rates(sources.read_rates(spark, path, "1996-06-30"))
