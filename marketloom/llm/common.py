"""Helpers that several training-data operators share."""

from __future__ import annotations

import re
import string
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words as runs of anything but ASCII white space.
SPACE_WORD = r"[^\x20\x09-\x0D]+"
#: Words as runs of lower-case ASCII letters, digits and all non-ASCII characters.
ALNUM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only. Pure ASCII texts take the fast built-in, which is the same there."""
    slow = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(slow)


def text_of(docs: DataFrame, column: str = "text") -> Column:
    """The text, null as empty."""
    return F.coalesce(docs[column].cast("string"), F.lit(""))


def words_of(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(ascii_lower(text), F.lit(pattern), F.lit(0))


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; one of our own is set only in local mode where the session names none (tests)."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None and not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="checkpoint-"))
    return context.getCheckpointDir()


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


@contextmanager
def small_batches(spark: SparkSession, rows: int, size: int) -> Iterator[None]:
    """Jobs inside pass at most ``rows`` rows and about ``size`` bytes at a time to Python: Spark's own numbers are too many for long texts."""
    names = {"spark.sql.execution.arrow.maxRecordsPerBatch": rows, "spark.sql.execution.arrow.maxBytesPerBatch": size}
    before = {name: spark.conf.get(name) for name in names}
    for name, value in names.items():
        spark.conf.set(name, str(value))
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever store it is."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quoted(names: list[str]) -> list[str]:
    """Names of columns as ``select`` takes them; one may hold a dot."""
    return ["`" + name.replace("`", "``") + "`" for name in names]


def hidden(df: DataFrame, *names: str) -> dict[str, str]:
    """Names for working columns that clash with none of the table's own."""
    taken = {c.lower() for c in df.columns}
    found = {}
    for name in names:
        new = f"__{name}"
        while new.lower() in taken:
            new += "_"
        found[name] = new
    return found
