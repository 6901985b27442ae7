"""The write path as a stream: wire messages in, history tables and dead letters out."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import envelope
from ..operators.changes import BucketedTable
from ..operators.materialise import append_log, entity_kind, entity_rows, log_rows, month_of
from ..schemas import CLASSES, ENTITY_CLASSES, LOG_CLASSES
from ..session import hadoop_path, remove

MESSAGES = "subject string, headers map<string,string>, data binary, stream_sequence bigint, delivery_count int, arrival_no bigint"


class HistoryPipeline:
    """Materialises the classes it is given under ``root``.

    Entities are merged into stored current rows (``current/class``), a bucketed table that commits the batch's number with its
    files, so a batch that is repeated after a failure does nothing; what came is kept as a log by class and batch as well
    (``entities/class=X/batch=N``), in which a repeated batch overwrites its own folder. Log rows are
    appended once a key: within a batch by arrival, against earlier batches by an anti join with the months concerned. Dead
    letters go to ``dlq/batch=N``. Messages that can't be written now (an unknown class, or one that isn't given here) go to
    ``retry/batch=N``. All four are written before the stream's own commit of the batch.

    What waits at the end of a run is delivered again, with one delivery more, at the start of the next, until its deliveries
    are used up and it is a dead letter. Such a round k is a batch of number -k. ``rounds/k.json``, written once the stream has
    committed, lists the folders that it takes; a round that failed is repeated over the same folders into the same batch, and
    renaming the list to ``k.done`` ends it, after which its folders are deleted.
    """

    def __init__(self, spark: SparkSession, root: str, classes: list[str], entity_buckets: int = 16):
        """``entity_buckets`` is taken when an entity table is made; see :meth:`~histrail.operators.changes.BucketedTable.rebucket`."""
        self.spark, self.root, self.classes, self.entity_buckets = spark, root.rstrip("/"), classes, entity_buckets

    def current(self, name: str) -> BucketedTable:
        """The stored current rows of an entity class."""
        return BucketedTable(self.spark, f"{self.root}/current/{name}", self.entity_buckets, entity_kind(name))

    def _exists(self, folder: str) -> bool:
        path, fs = hadoop_path(self.spark, f"{self.root}/{folder}")
        return fs.exists(path) and len(fs.listStatus(path)) > 0

    def __call__(self, batch: DataFrame, number: int) -> None:
        routed = envelope.route(envelope.parse(batch), failed=~F.col("history_class").isin(*self.classes)).persist()
        try:
            envelope.dead_letters(routed).write.mode("overwrite").parquet(f"{self.root}/dlq/batch={number}")
            routed.filter(F.col("route") == "retry").select(*batch.columns, "retry_after_s").write.mode("overwrite").parquet(f"{self.root}/retry/batch={number}")
            entity = routed.filter(F.col("route") == "entity")
            keep = ["history_class", "engine_id", "process_instance_id", "history_event_id", "event_type", "event_time", "fields", F.col("seq").alias("stream_sequence"), "arrival_no"]
            entity.select(*keep).withColumn("class", F.col("history_class")).write.mode("overwrite").partitionBy("class").parquet(f"{self.root}/entities/batch={number}")
            for folder in self._names(f"entities/batch={number}"):
                if folder.startswith("class="):
                    mark = ("stream", number) if number >= 0 else ("round", -number)
                    rows = self.spark.read.parquet(f"{self.root}/entities/batch={number}/{folder}")
                    self.current(folder.removeprefix("class=")).apply(rows, mark)
            for name in [c for c in self.classes if c in LOG_CLASSES]:
                self._append(routed.filter((F.col("route") == "log") & (F.col("history_class") == name)), name, number)
        finally:
            routed.unpersist()

    def _append(self, rows: DataFrame, name: str, number: int) -> None:
        key = ["engine_id", "history_event_id", "event_type", "event_time"]
        first = append_log(rows, key).filter(F.col("outcome") == "APPLIED")
        out = log_rows(first, name).withColumn("month", month_of(F.col("event_time")))
        table = f"logs/{CLASSES[name].table}"
        if self._exists(table):
            # earlier batches may hold no row of the class, and so no file to take the columns from
            old = self.spark.read.schema(out.withColumn("batch", F.lit(number)).schema).parquet(f"{self.root}/{table}").filter(F.col("batch") != number)
            months = [r[0] for r in out.select("month").distinct().collect()]  # the months of one batch
            out = out.join(old.filter(F.col("month").isin(months)).select(*key), key, "left_anti")
        out.write.mode("overwrite").partitionBy("month").parquet(f"{self.root}/{table}/batch={number}")

    def run(self, messages: DataFrame) -> None:
        """Deliver what waits from earlier runs, take in all that is there now, then stop; the next call goes on from there."""
        self._redeliver()
        query = messages.writeStream.foreachBatch(self).option("checkpointLocation", f"{self.root}/checkpoint").trigger(availableNow=True).start()
        query.awaitTermination()
        self._schedule()

    def _names(self, folder: str) -> list[str]:
        path, fs = hadoop_path(self.spark, f"{self.root}/{folder}")
        return [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []

    def _rounds(self, ending: str) -> list[int]:
        return sorted(int(n.removesuffix(ending)) for n in self._names("rounds") if n.endswith(ending) and not n.startswith("."))

    def _taken(self, file: str) -> list[str]:
        """The folders that a round's list names."""
        path, fs = hadoop_path(self.spark, f"{self.root}/rounds/{file}")
        stream = fs.open(path)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _redeliver(self) -> None:
        for k in self._rounds(".json"):
            waiting = self.spark.read.parquet(*[f"{self.root}/retry/{n}" for n in self._taken(f"{k}.json")])
            self(waiting.drop("retry_after_s").withColumn("delivery_count", F.coalesce("delivery_count", F.lit(1)) + 1), -k)
            old, fs = hadoop_path(self.spark, f"{self.root}/rounds/{k}.json")
            if not fs.rename(old, hadoop_path(self.spark, f"{self.root}/rounds/{k}.done")[0]):
                raise RuntimeError(f"round {k} can't be ended")
        for k in self._rounds(".done")[-1:]:  # earlier ones were cleared before this one was listed
            for n in self._taken(f"{k}.done"):
                remove(self.spark, f"{self.root}/retry/{n}")

    def _schedule(self) -> None:
        """List what waits for the next round; the stream has committed all its batches."""
        names = sorted(n for n in self._names("retry") if n.startswith("batch="))
        if not names or self.waiting().isEmpty():
            return
        k = max([0, *self._rounds(".done")]) + 1
        draft, fs = hadoop_path(self.spark, f"{self.root}/rounds/.draft-{uuid.uuid4().hex}")
        out = fs.create(draft, False)
        try:
            out.write(bytearray(json.dumps(names), "utf-8"))
        finally:
            out.close()
        if not fs.rename(draft, hadoop_path(self.spark, f"{self.root}/rounds/{k}.json")[0]):
            raise RuntimeError(f"round {k} can't be listed")

    def entity_table(self, name: str) -> DataFrame:
        """The current rows of an entity class."""
        return entity_rows(self.current(name).read(), name)

    def log_table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/logs/{CLASSES[name].table}").drop("batch", "month")

    def dead(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/dlq").drop("batch")

    def waiting(self) -> DataFrame:
        """The messages that the next run delivers again, with the deliveries they have had."""
        return self.spark.read.parquet(f"{self.root}/retry").drop("batch")


def pipeline_classes() -> list[str]:
    return [*ENTITY_CLASSES, *LOG_CLASSES]


def message_dedup(messages: DataFrame, message_id: str, time: str, window: str = "2 minutes") -> DataFrame:
    """Drop messages of an id that came within the window before, as a broker does. ``time`` is a timestamp."""
    return messages.withWatermark(time, window).dropDuplicatesWithinWatermark([message_id])
