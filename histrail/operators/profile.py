"""Classifying statement statistics, and counters by tag."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The table of external tasks, and the columns of its fetch predicate; a statement that names at least two of
# them polls (a select) or fetches and locks (an update).
TASK_TABLE = "act_ru_ext_task"
LOCK_COLUMNS = ("lock_exp_time_", "suspension_state_", "retries_", "topic_name_")


def statements_like(stats: DataFrame, pattern: str) -> DataFrame:
    """Statements that match a pattern in any case, the most called first."""
    return stats.filter(F.col("query").ilike(pattern)).orderBy(F.desc_nulls_last("calls"), "query_id")


def statement_kind(query: Column) -> Column:
    """INSERT, DELETE, POLL or FETCH_LOCK for statements on the task table; anything else is OTHER."""
    q = F.lower(F.trim(query))
    locks = sum((F.when(q.contains(c), 1).otherwise(0) for c in LOCK_COLUMNS), F.lit(0))
    return F.when(F.coalesce(~q.contains(TASK_TABLE), F.lit(True)), "OTHER").when(q.startswith("insert"), "INSERT").when(q.startswith("delete"), "DELETE").when(q.startswith("select") & (locks >= 2), "POLL").when(q.startswith("update") & (locks >= 2), "FETCH_LOCK").otherwise("OTHER")


def profile(stats: DataFrame) -> DataFrame:
    """Calls of each kind: one row."""
    kind = statement_kind(F.col("query"))
    return stats.agg(*[F.coalesce(F.sum(F.when(kind == k, F.col("calls"))), F.lit(0)).alias(k.lower()) for k in ("INSERT", "DELETE", "POLL", "FETCH_LOCK", "OTHER")])


def writes_to(stats: DataFrame, table_part: str) -> DataFrame:
    """Calls of inserts and updates of tables whose name contains a text: one row."""
    q = F.lower("query")
    hit = (q.startswith("insert") | q.startswith("update")) & q.contains(table_part)
    return stats.agg(F.coalesce(F.sum(F.when(hit, F.col("calls"))), F.lit(0)).alias("write_ops"))


def stored_share(variables: DataFrame, blobs: DataFrame) -> DataFrame:
    """Bytes stored once per content against bytes stored once per reference: one row with the share."""
    b = blobs.select(F.col("id").alias("__id"), "content_hash", F.octet_length("payload_bytes").cast("long").alias("n"))
    used = variables.select(F.col("payload_id").alias("__id")).join(b.dropDuplicates(["__id"]), "__id")
    by_content = used.groupBy("content_hash").agg(F.sum("n").alias("every"), F.max("n").alias("once"))
    total = by_content.agg(F.coalesce(F.sum("every"), F.lit(0)).alias("naive_bytes"), F.coalesce(F.sum("once"), F.lit(0)).alias("stored_bytes"))
    return total.withColumn("below_half", F.col("stored_bytes") < 0.5 * F.col("naive_bytes"))


def counters(rows: DataFrame, tags: Sequence[str]) -> DataFrame:
    """A count for each combination of tags."""
    return rows.groupBy(*tags).agg(F.count(F.lit(1)).alias("n"))


def tripped(calls: DataFrame, key: Sequence[str], order: str, window: int = 5) -> DataFrame:
    """Adds ``tripped``: the last ``window`` calls, this one included, all failed."""
    from pyspark.sql import Window

    w = Window.partitionBy(*key).orderBy(order).rowsBetween(-(window - 1), 0)
    return calls.withColumn("tripped", (F.count(F.lit(1)).over(w) == window) & (F.sum(F.col("failed").cast("int")).over(w) == window))
