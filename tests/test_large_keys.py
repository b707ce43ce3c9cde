"""Queries over part keys of more than six digits against their SQL, and how their rows are dealt over tasks."""

import duckdb
import pytest
from pyspark.sql import functions as F
from test_catalog import SF, plain, pytestmark  # noqa: F401

from marketloom.plans import catalog

KEYS = [7, 123, 99_999, 120_034, 999_999, 1_000_000, 1_000_001, 1_034_500, 1_199_999, 1_203_045, 7_200_008, 7_654_321]


@pytest.fixture(scope="module")
def parts(spark, tmp_path_factory):
    """A table of parts with such keys."""
    folder = str(tmp_path_factory.mktemp("parts"))
    rows = spark.read.parquet(f"{SF}/part.parquet").limit(1)
    rows.withColumn("p_partkey", F.explode(F.array(*map(F.lit, KEYS)).cast("array<bigint>"))).coalesce(1).write.parquet(f"{folder}/part.parquet")
    return folder


@pytest.mark.parametrize("name", ["clean_raw_forms", "identifier_extract", "group_reference", "brand_rules", "references_cleaned_again", "earlier_brand_rules", "omega_padding"])
def test_keys_of_seven_digits(spark, parts, name):
    got = catalog.QUERIES[name](spark, parts)
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW part AS SELECT * FROM '{parts}/part.parquet/*.parquet'")
    want = duck.sql(f"SELECT {', '.join(got.columns)} FROM ({catalog.ORACLES[name]})").fetchall()
    assert sorted(tuple(map(plain, r)) for r in got.collect()) == sorted(tuple(map(plain, r)) for r in want)


def test_parts_of_one_file_are_dealt_over_tasks(spark, parts, monkeypatch):
    monkeypatch.setattr(catalog, "PARTS_A_TASK", 3)
    for name in ("brand_rules", "references_cleaned_again", "earlier_brand_rules", "attribute_forms", "attribute_vocabularies"):
        assert catalog.QUERIES[name](spark, parts).rdd.getNumPartitions() == 4
