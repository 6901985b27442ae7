"""Positions and running values in the order of a key's rows, however many rows the key has."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise

#: With more rows than this, a key is worked through in parts.
HOT_ROWS = 1_000_000


def _has_hot(df: DataFrame, keys: Sequence[str]) -> bool:
    """One aggregate with a map-side part; no row comes to the driver but one of them."""
    return not df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > HOT_ROWS).limit(1).isEmpty()


def _in_parts(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The rows spread by ranges of key and order, with ``__part``, which rises with the order. Written once, so that all that
    follows sees the same parts."""
    return materialise(df.repartitionByRange(*keys, *order).withColumn("__part", F.spark_partition_id()), "in-order")


def _carried(parts: DataFrame, keys: Sequence[str], summary: Column, combine) -> DataFrame:
    """For each key and part, ``__carry``: what the earlier parts of the key come to. A key has as many rows here as parts."""
    each = parts.groupBy(*keys, "__part").agg(summary.alias("__one"))
    earlier = Window.partitionBy(*keys).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    return each.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], F.col("__part").alias("__p"), combine("__one").over(earlier).alias("__carry"))


def _join(parts: DataFrame, carried: DataFrame, keys: Sequence[str]) -> DataFrame:
    same = F.col("__part") == F.col("__p")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"__k{i}"))
    return parts.join(carried, same, "left").drop("__p", *[f"__k{i}" for i in range(len(keys))])


def numbered(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """Adds ``name``, the position (from 1) of each row among those of its key. Nulls of an order come first; a null key is a key;
    rows that agree in key and order have different positions, in no certain order."""
    if not _has_hot(df, keys):
        return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).cast("long"))
    parts = _in_parts(df, keys, order)
    joined = _join(parts, _carried(parts, keys, F.count(F.lit(1)), F.sum), keys)
    local = F.row_number().over(Window.partitionBy(*keys, "__part").orderBy(*order))
    return joined.withColumn(name, (local + F.coalesce("__carry", F.lit(0))).cast("long")).drop("__part", "__carry")


def max_before(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, name: str) -> DataFrame:
    """Adds ``name``, the greatest ``value`` of the rows before each row among those of its key; null if there is none."""
    if not _has_hot(df, keys):
        w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        return df.withColumn(name, F.max(value).over(w))
    parts = _in_parts(df, keys, order)
    joined = _join(parts, _carried(parts, keys, F.max(value), F.max), keys)
    w = Window.partitionBy(*keys, "__part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return joined.withColumn(name, F.greatest(F.max(value).over(w), F.col("__carry"))).drop("__part", "__carry")
