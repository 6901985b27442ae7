"""Reading the tables, and the three rules that hold for all of them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BLANKS = " \t\r\n"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def same_id(c: str | Column) -> Column:
    """Two id values are the same id when they agree after trimming blanks and lower-casing."""
    c = F.col(c) if isinstance(c, str) else c
    return F.lower(F.trim(c, F.lit(BLANKS)))


def millis(c: str | Column) -> Column:
    """Epoch milliseconds, the rest cut off."""
    return F.unix_millis(F.col(c) if isinstance(c, str) else c)


def latest(df: DataFrame, key: Sequence[str], order: str, columns: Sequence[str]) -> DataFrame:
    """The row of each key with the highest ``order``, by one aggregate with a map-side part.

    A hot key costs one partial row per input task, and no task sees its whole group. A struct that holds strings can't live
    in a hash aggregate, so each side of the one exchange sorts its own rows by key. A null order counts as the lowest. Rows
    of equal order are resolved by the greatest ``columns`` struct, which makes exact copies one row and any other tie
    deterministic.
    """
    best = F.max(F.struct(F.col(order).alias("__o"), *[F.col(c) for c in columns]))
    got = df.groupBy(*key).agg(best.alias("__best"))
    return got.select(*key, *[F.col("__best")[c].alias(c) for c in columns])
