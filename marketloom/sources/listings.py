"""Reading and writing listings, histories, dimensions and rates."""

from __future__ import annotations

import re
import uuid
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketloom.functions import calendar
from marketloom.functions.text import is_nullish
from marketloom.operators import cleaning
from marketloom.schema import LIBRARY, RATES, RAW
from marketloom.sources.shared import remove, run_folder

# The file names that mark weekly files and sold listings.
WEEKLY, SOLD_FILE = "(?i)weekly", "ebay_completed_sold"


def conform(df: DataFrame, schema: T.StructType = RAW) -> DataFrame:
    """The columns of ``schema`` in its order: others dropped, missing ones null, misfits null."""
    return df.select(
        *[(F.col(f.name).try_cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema]
    )


def read_weekly_csv(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Weekly CSV files: the date is the Sunday nearest to the day in a file's name, sold files name the source.

    Columns are matched by name, file by file: files of one header are read together. Rows
    without any value are left out; files that hold nothing, or no weekly name, give no rows.
    """
    headers: dict[tuple[str, ...], list[str]] = {}
    for file in spark.read.text(paths).inputFiles():
        file = unquote(file)
        if re.search(WEEKLY, file.rsplit("/", 1)[-1]):
            headers.setdefault(tuple(spark.read.option("header", True).csv(file).columns), []).append(file)
    parts = [_read_alike(spark, files, columns) for columns, files in headers.items() if set(columns) & set(RAW.names)]
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], RAW)


def _read_alike(spark: SparkSession, files: list[str], columns: tuple[str, ...]) -> DataFrame:
    """Weekly files that all have the header ``columns``."""
    raw = spark.read.schema(T.StructType([T.StructField(c, T.StringType()) for c in columns])).option("header", True).csv(files)
    name = F.col("_metadata.file_name")
    day = F.try_to_timestamp(F.regexp_extract(name, r"\d{4}_\d{2}_\d{2}", 0), F.lit("yyyy_MM_dd")).cast("date")
    present = [c for c in raw.columns if c in RAW.names]
    some = F.coalesce(*[F.col(c).cast("string") for c in present]).isNotNull()
    named = raw.where(some).withColumn("date", calendar.nearest_sunday(day))
    source = F.col("source") if "source" in present else F.lit(None).cast("string")
    return conform(named.withColumn("source", F.when(F.contains(F.lower(name), F.lit(SOLD_FILE)), "eBay Sold").otherwise(source)))


def read_lake(spark: SparkSession, path: str, schema: T.StructType = RAW, first=None, last=None) -> DataFrame:
    """Parquet partitioned by date, limited to a range of dates, which prunes partitions."""
    df = conform(spark.read.option("mergeSchema", True).parquet(path), schema)
    return df if first is None else df.where(F.col("date").between(first, last))


def write_weeks(df: DataFrame, path: str) -> None:
    """Write by date; the dates in ``df`` replace what was there, so a rerun changes nothing.

    Rows are gathered by date for few files; a date with many rows is split by its size.
    """
    df.hint("rebalance", "date").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date").parquet(path)


#: Changes of more rows aren't broadcast; then a task gets about so many rows of the table and the changes together.
MAX_BROADCAST_CHANGES, ROWS_A_TASK = 100_000, 1_000_000


def merge_weeks(path: str, changes: DataFrame, key: str, updated: list[str], order: list[Column] | None = None) -> None:
    """MERGE into parquet partitioned by date: known keys get the ``updated`` columns of ``changes``, unknown ones are added.

    Only dates that hold a changed key or get a new row are read whole and written again; the
    files of other dates stay. Several changes of a key count as in ``upsert``; a rerun changes
    nothing, and a job that fails before its commit leaves the table as it was.

    The changes, then one for each key, and the keys and dates they meet are written to a folder of the run and
    read again. To join them tasks hold changes only; the table's rows go past them and are not sorted by key.
    """
    spark = changes.sparkSession
    target, folder = spark.read.parquet(path), run_folder(spark, "merge")
    try:
        conform(changes, target.schema).write.parquet(f"{folder}/given")
        cleaning.one_per_key(spark.read.parquet(f"{folder}/given"), key, order).write.parquet(f"{folder}/changes")
        changes = spark.read.parquet(f"{folder}/changes")
        count, keyed = changes.count(), F.col(key).isNotNull()
        tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-(target.count() + count) // ROWS_A_TASK))

        def held(df: DataFrame) -> DataFrame:
            return F.broadcast(df) if count <= MAX_BROADCAST_CHANGES else df.repartition(tasks, F.col(key)).hint("shuffle_hash")

        known = changes.where(keyed)
        target.where(keyed).select(key, "date").join(held(known.select(key)), key, "left_semi").write.parquet(f"{folder}/found")
        found = spark.read.parquet(f"{folder}/found")
        new = changes.join(held(found.select(key).distinct()), key, "left_anti").select(*target.columns)
        touched = F.broadcast(found.select("date").union(new.select("date")).distinct())
        rows = target.join(touched, target["date"].eqNullSafe(touched["date"]), "left_semi")
        # Rows without a key meet nothing; they would all be one task's.
        merged = cleaning.updated_rows(rows.where(keyed), held(known), key, updated).unionByName(rows.where(~keyed))
        write_weeks(merged.unionByName(new), path)
    finally:
        remove(spark, folder)


def write_jdbc(df: DataFrame, url: str, table: str, batch: int = 25_000, **options: str) -> None:
    df.write.format("jdbc").options(url=url, dbtable=table, batchsize=str(batch), **options).mode("append").save()


def replace_weeks_jdbc(df: DataFrame, url: str, table: str, batch: int = 25_000, **options: str) -> None:
    """The weeks of ``df`` in a database table, in place of what it held of them, so a rerun changes nothing.

    Executors write a staging table of this run's own name; the database then moves it in one transaction.
    """
    staging = f"{table}_staging_{uuid.uuid4().hex[:12]}"
    write_jdbc(df.limit(0), url, table, batch, **options)
    df.write.format("jdbc").options(url=url, dbtable=staging, batchsize=str(batch), **options).mode("overwrite").save()
    jvm = df.sparkSession._jvm
    properties = jvm.java.util.Properties()
    for k, v in options.items():
        properties.setProperty(k, v)
    connection = jvm.java.sql.DriverManager.getConnection(url, properties)
    try:
        connection.setAutoCommit(False)
        mark = connection.getMetaData().getIdentifierQuoteString().strip()
        names = ", ".join(f"{mark}{c}{mark}" for c in df.columns)
        run, day = connection.createStatement(), f"{mark}date{mark}"
        run.executeUpdate(f"DELETE FROM {table} WHERE {day} IN (SELECT {day} FROM {staging})")
        run.executeUpdate(f"INSERT INTO {table} ({names}) SELECT {names} FROM {staging}")
        connection.commit()
    finally:
        connection.rollback()
        # Some databases end a transaction with such a statement, so it comes after.
        connection.createStatement().executeUpdate(f"DROP TABLE {staging}")
        connection.commit()
        connection.close()


def read_jdbc(spark: SparkSession, url: str, table: str, by: str | None = None, partitions: int = 16, **options: str) -> DataFrame:
    """A table of a database; filters and columns are pushed down to it.

    With ``by``, a column of numbers, dates or times, the table is read in ``partitions``
    ranges of it at a time, the bounds of which the database is asked for; rows below, above
    or without a value are in the first or last range. Without it one task reads all.
    """
    reader = spark.read.format("jdbc").options(url=url, **options)
    if by is None:
        return reader.option("dbtable", table).load()
    low, high = reader.option("dbtable", f"(SELECT MIN({by}) AS low, MAX({by}) AS high FROM {table}) bounds").load().first()
    ranged = spark.read.format("jdbc").options(url=url, dbtable=table, **options)
    if low is None:
        return ranged.load()
    return ranged.options(partitionColumn=by, lowerBound=str(low), upperBound=str(high), numPartitions=str(partitions)).load()


def read_template(spark: SparkSession, sql: str, tables: dict[str, DataFrame], **parameters) -> DataFrame:
    """A query with ``{name}`` for tables and ``:name`` for values."""
    return spark.sql(sql, args=parameters, **tables)


def new_listings(table: DataFrame, brands: list[str], run_date: Column) -> DataFrame:
    """The brands' listings of the Sunday before the run; prices of 0 are left out, null prices stay."""
    return table.where(F.col("brand").isin(brands) & (F.col("date") == calendar.prior_sunday(run_date))).where(~F.col("price").eqNullSafe(0))


def latest_week(table: DataFrame, brands: list[str], key: str, run_date: Column) -> DataFrame:
    """The same for a coarser level: rows without its key are left out."""
    return new_listings(table, brands, run_date).where(~is_nullish(F.col(key)))


def history(table: DataFrame, brands: list[str], years: float) -> DataFrame:
    """The brands' rows from the Sunday nearest to ``years`` before their last date on.

    The last date is a subquery of this one's own run, whose result prunes partitions of dates.
    """
    own = table.where(F.col("brand").isin(brands))
    last = own.agg(F.max("date").cast("date")).scalar()
    return own.where(F.col("date").between(calendar.nearest_sunday(calendar.years_ago(last, years)), last))


def before(table: DataFrame, brands: list[str], day: str) -> DataFrame:
    return table.where(F.col("brand").isin(brands) & (F.col("date") < F.lit(day).cast("date")))


def read_library(spark: SparkSession, path: str, brands: list[str] | None = None) -> DataFrame:
    df = conform(spark.read.parquet(path), LIBRARY)
    return df if brands is None else df.where(F.col("brand").isin(brands))


def read_rates(spark: SparkSession, path: str, day: str | None = None) -> DataFrame:
    """Rates (units for one US dollar), as of a day at the latest."""
    df = spark.read.schema(RATES).option("header", True).csv(path)
    return df if day is None else df.where(F.col("as_of") <= F.lit(day).cast("date"))


def read_model_rules(spark: SparkSession, path: str) -> DataFrame:
    """Rules of models (brand, specific_model, parent_model, alternate) with a priority; later lines come first."""
    names = ["brand", "specific_model", "parent_model", "alternate"]
    schema = T.StructType([T.StructField(c, T.StringType()) for c in names])
    lines = spark.read.schema(schema).option("encoding", "ISO-8859-1").csv(path).withColumns(
        {"__file": F.col("_metadata.file_name"), "__block": F.col("_metadata.file_block_start"), "__line": F.monotonically_increasing_id()}
    )
    place = F.row_number().over(Window.orderBy("__file", "__block", "__line"))  # a row for each rule, not for each listing
    return lines.dropna("all", subset=names).withColumn("priority", (-place).cast("bigint")).select(*names, "priority")
