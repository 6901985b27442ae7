from pathlib import Path

import pytest
from pyspark.sql import functions as F

from histrail.plans import ingest, quality

from .conftest import SMALL


@pytest.fixture(scope="session")
def empty_dir(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("empty")
    for p in Path(SMALL).glob("*.parquet"):
        spark.read.parquet(str(p)).limit(0).write.parquet(f"{root}/{p.name}")
    return str(root)


@pytest.fixture(scope="session")
def null_dir(spark, tmp_path_factory):
    """A few rows of each table, twice, and one row of nothing but nulls; and a column that clashes with an inner name."""
    root = tmp_path_factory.mktemp("nulls")
    for p in Path(SMALL).glob("*.parquet"):
        df = spark.read.parquet(str(p)).limit(40)
        blank = spark.range(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema.fields])
        df.unionByName(df).unionByName(blank).withColumn("node", F.lit(1)).withColumn("bucket", F.lit("x")).write.parquet(f"{root}/{p.name}")
    return str(root)


@pytest.mark.parametrize("name", [*quality.QUERIES, "a1_merge", "d1_append", "f1_routes"])
def test_empty_tables(spark, empty_dir, name):
    assert (quality.QUERIES | ingest.QUERIES)[name](spark, empty_dir).count() == 0


@pytest.mark.parametrize("name", ["p1_found", "p2_found", "p3_found", "p3_periods", "p5_found", "p6_found", "p7_found"])
def test_nulls_repeats_and_extra_columns(spark, null_dir, name):
    df = quality.QUERIES[name](spark, null_dir)
    rows = df.collect()
    assert df.columns == quality.QUERIES[name](spark, null_dir).columns and len(rows) >= 0
