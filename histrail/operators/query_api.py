"""The read operations: one instance, a filtered page with its total, child lists; with masking and an authorisation hook."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalar import masked

#: Asked before every operation with its name and the caller's context; False denies.
Authorise = Callable[[str, dict[str, Any]], bool]


class Denied(PermissionError):
    """The caller may not use this operation."""


@dataclass(frozen=True)
class Page:
    number: int = 0
    size: int = 20

    @property
    def clamped(self) -> Page:
        """No negative page; sizes below 1 become 20, above 200 become 200."""
        return Page(max(0, self.number), 20 if self.size < 1 else min(200, self.size))

    @property
    def offset(self) -> int:
        p = self.clamped
        return p.number * p.size


@dataclass
class Paged:
    rows: DataFrame
    page: int
    size: int
    total: DataFrame

    def envelope(self) -> dict[str, Any]:
        """A response: at most a page of rows comes to the driver."""
        return {"data": [r.asDict() for r in self.rows.collect()], "page": self.page, "size": self.size, "total": self.total.first()["total"]}


def alive(df: DataFrame) -> DataFrame:
    return df.filter(F.col("deleted_at").isNull())


def page_of(df: DataFrame, page: Page) -> DataFrame:
    """One page of a sorted frame; planned as a top-k of offset + size rows."""
    p = page.clamped
    return df.offset(p.offset).limit(p.size) if p.offset else df.limit(p.size)


class Clustered:
    """Current rows stored for reads of one process instance: in folders by a hash of the instance, and sorted by it.

    A read of one instance opens one folder, and in it the row groups whose statistics allow the instance; a read of all
    instances pushes its filters down to the scan as well. Rows are spread by range, so an instance of any number of rows
    is written by several tasks.
    """

    KEY = "process_instance_id"

    def __init__(self, spark: SparkSession, root: str, buckets: int, schema: T.StructType):
        """``schema`` is that of the rows; an empty table has no file to take it from."""
        self.buckets, names = buckets, schema.fieldNames()
        self._stored = spark.read.schema(T.StructType([*schema.fields, T.StructField("bucket", T.IntegerType())])).parquet(root)
        self.rows = self._stored.select(*names)

    @classmethod
    def store(cls, rows: DataFrame, root: str, buckets: int, order: str) -> Clustered:
        """``order``: a column that tells the rows of one instance apart, to cut it by."""
        spread = rows.withColumn("bucket", cls._bucket(F.col(cls.KEY), buckets)).repartitionByRange("bucket", cls.KEY, order)
        spread.sortWithinPartitions("bucket", cls.KEY, order).write.partitionBy("bucket").parquet(root)
        return cls(rows.sparkSession, root, buckets, rows.schema)

    @staticmethod
    def _bucket(key: Column, buckets: int) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")

    def of(self, instance_id: str) -> DataFrame:
        here = F.col("bucket") == self._bucket(F.lit(instance_id), self.buckets)
        return self._stored.filter(here & (F.col(self.KEY) == instance_id)).drop("bucket")


Table = DataFrame | Clustered


def _all(table: Table) -> DataFrame:
    return table.rows if isinstance(table, Clustered) else table


def _of(table: Table, instance_id: str) -> DataFrame:
    return table.of(instance_id) if isinstance(table, Clustered) else table.filter(F.col("process_instance_id") == instance_id)


class HistoryReads:
    """``instances``, ``activities``, ``tasks`` and ``variables`` hold current rows, as frames or stored (:class:`Clustered`);
    soft-deleted rows are never shown.

    Nulls of a descending sort come first, of an ascending one last; equal times are ordered by id, so that pages never
    overlap. Reads span all engines unless ``engine_id`` is given.
    """

    def __init__(self, instances: Table, activities: Table, tasks: Table, variables: Table, cutover: DataFrame, authorise: Authorise = lambda operation, context: True):
        self.instances, self.activities, self.tasks, self.variables, self.cutover, self.authorise = instances, activities, tasks, variables, cutover, authorise

    def _enter(self, operation: str, context: dict[str, Any]) -> bool:
        if not self.authorise(operation, context):
            raise Denied(operation)
        return bool(context.get("may_see_pii"))

    def instance(self, instance_id: str, **context: Any) -> DataFrame:
        """The summary of one instance with the state of its engine's cut-over; no row if it isn't there or is deleted."""
        pii = self._enter("GET_INSTANCE", context)
        states = self.cutover.filter(F.upper("history_class") == "PROCINST").groupBy("engine_id").agg(F.min("state").alias("cutover_state"))
        one = alive(_of(self.instances, instance_id))
        return one.join(F.broadcast(states), "engine_id", "left").select("process_instance_id", "process_definition_key", "business_key", masked(F.col("start_user_id"), pii).alias("start_user_id"), "start_time", "end_time", "state", "cutover_state")

    def list_instances(self, page: Page = Page(), *, business_key: str | None = None, definition_key: str | None = None, started_after=None, started_before=None, **context: Any) -> Paged:
        """Instances by at least one filter, newest first; both time bounds are inclusive."""
        pii = self._enter("LIST_INSTANCES", context)
        tests = [F.col(c) == v for c, v in (("business_key", business_key), ("process_definition_key", definition_key)) if v is not None]
        tests += [F.col("start_time") >= F.lit(started_after).cast("timestamp")] if started_after is not None else []
        tests += [F.col("start_time") <= F.lit(started_before).cast("timestamp")] if started_before is not None else []
        if not tests:
            raise ValueError("at least one filter is needed")
        found = alive(_all(self.instances))
        for t in tests:
            found = found.filter(t)
        shown = found.select("process_instance_id", "process_definition_key", "business_key", masked(F.col("start_user_id"), pii).alias("start_user_id"), "start_time", "end_time", "state", F.lit(None).cast("string").alias("cutover_state"))
        rows = page_of(shown.orderBy(F.desc_nulls_first("start_time"), "process_instance_id"), page)
        return Paged(rows, page.clamped.number, page.clamped.size, found.agg(F.count(F.lit(1)).alias("total")))

    def _children(self, operation: str, table: Table, instance_id: str, page: Page, time: str, key: str, columns: Callable[[bool], list], context: dict[str, Any]) -> Paged | None:
        pii = self._enter(operation, context)
        # an instance that isn't there is another answer than one without children
        if alive(_of(self.instances, instance_id)).limit(1).isEmpty():
            return None
        found = alive(_of(table, instance_id))
        rows = page_of(found.orderBy(F.asc_nulls_last(time), key).select(*columns(pii)), page)
        return Paged(rows, page.clamped.number, page.clamped.size, found.agg(F.count(F.lit(1)).alias("total")))

    def list_activities(self, instance_id: str, page: Page = Page(), **context: Any) -> Paged | None:
        columns = lambda pii: ["activity_id", "activity_type", masked(F.col("task_assignee"), pii).alias("task_assignee"), "start_time", "end_time"]
        return self._children("LIST_ACTIVITIES", self.activities, instance_id, page, "start_time", "activity_instance_id", columns, context)

    def list_tasks(self, instance_id: str, page: Page = Page(), **context: Any) -> Paged | None:
        columns = lambda pii: ["task_id", "task_name", masked(F.col("assignee"), pii).alias("assignee"), masked(F.col("owner"), pii).alias("owner"), "start_time", "end_time"]
        return self._children("LIST_TASKS", self.tasks, instance_id, page, "start_time", "task_id", columns, context)

    def list_variables(self, instance_id: str, page: Page = Page(), **context: Any) -> Paged | None:
        columns = lambda pii: ["variable_name", "variable_type", masked(F.col("variable_value_text"), pii).alias("value"), F.lit(not pii).alias("masked"), "event_time"]
        return self._children("LIST_VARIABLES", self.variables, instance_id, page, "event_time", "id", columns, context)
