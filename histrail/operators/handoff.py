"""Handing messages on: outboxes, routing by class, replies, dead letters as incidents."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalar as S
from ..schemas import AUDIT_CRITICAL

BATCH = 500
#: An outbox is stuck when its oldest row is older than so many periods of its relay (in seconds).
RELAY_PERIOD_S, STUCK_PERIODS = 30, 5


def oldest_batch(outbox: DataFrame, engine_id: str | None, tie: str, size: int = BATCH) -> DataFrame:
    """The next rows to relay, oldest first: a top-k, not a full sort."""
    rows = outbox if engine_id is None else outbox.filter(F.col("engine_id") == engine_id)
    return rows.orderBy(F.asc_nulls_last("created_at"), tie).limit(size)


def age(outbox: DataFrame, as_of: datetime | Column, keys: Sequence[str] = ("engine_id",)) -> DataFrame:
    """Seconds since the oldest row of each key was written, and whether the relay looks stuck."""
    now = as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp")
    got = outbox.groupBy(*keys).agg(F.min("created_at").alias("__oldest"), F.count(F.lit(1)).alias("n_rows"))
    seconds = F.coalesce((F.unix_micros(now) - F.unix_micros("__oldest")) / 1e6, F.lit(0.0))
    return got.select(*keys, "n_rows", seconds.alias("age_s"), (seconds > RELAY_PERIOD_S * STUCK_PERIODS).alias("stuck"))


def relayed(outbox: DataFrame, acknowledged: DataFrame, key: str) -> DataFrame:
    """What stays in the outbox: rows whose publication wasn't acknowledged."""
    return outbox.join(acknowledged.select(key).distinct(), key, "left_anti")


def with_payload(outbox: DataFrame, payloads: DataFrame) -> DataFrame:
    """Outbox rows with their large payload, null where there is none. ``payloads``: id, payload_bytes."""
    p = payloads.select(F.col("id").alias("__pid"), "payload_bytes").dropDuplicates(["__pid"])
    return outbox.join(p, F.col("payload_large_ref") == F.col("__pid"), "left").drop("__pid")


def surviving_payloads(payloads: DataFrame, outbox: DataFrame) -> DataFrame:
    """Payloads that an outbox row still needs: a deleted row takes its payload with it."""
    return payloads.join(outbox.select(F.col("payload_large_ref").alias("id")).distinct(), "id", "left_semi")


# Days that the messages of a stream are kept; those of other streams until they are taken.
STREAM_DAYS = {"history": 7, "dlq": 14}


def within_age(messages: DataFrame, stream: str, time: str, as_of: Column) -> DataFrame:
    """The messages that their stream still holds. A message without a time stays."""
    days = F.coalesce(*[F.when(F.col(stream) == n, F.lit(d)) for n, d in STREAM_DAYS.items()])
    old = F.unix_micros(as_of) - F.unix_micros(F.col(time)) > days.cast("long") * 86_400_000_000
    return messages.filter(~F.coalesce(old, F.lit(False)))


def outbox_gate(outbox: DataFrame, critical: str, keys: Sequence[str], instance: Column) -> DataFrame:
    """By key: rows of best-effort and of critical types, instances, and whether the first are none and the second no more than
    the instances. A null ``critical`` is best effort."""
    c = F.coalesce(F.col(critical), F.lit(False))
    got = outbox.groupBy(*keys).agg(F.count_if(~c).alias("n_best_effort"), F.count_if(c).alias("n_critical"), F.count_distinct(instance).alias("n_instances"))
    return got.withColumn("passes", (F.col("n_best_effort") == 0) & (F.col("n_critical") <= F.col("n_instances")))


def history_path(events: DataFrame, cut_over: Sequence[str] = (), critical: Sequence[str] = AUDIT_CRITICAL) -> DataFrame:
    """Adds ``path`` (outbox in the transaction, or published after it) and ``also_engine`` (written to the engine's table
    too, until the class is cut over; an unclassified event always is)."""
    known = F.coalesce(F.col("history_class"), F.lit("UNCLASSIFIED"))
    return events.withColumns({"path": F.when(known.isin(*critical), "OUTBOX").otherwise("POST_COMMIT"), "also_engine": ~known.isin(*cut_over) if cut_over else F.lit(True)})


def outbound_path(messages: DataFrame, critical: Sequence[str], has_writer: bool = True) -> DataFrame:
    """Adds ``path``: SKIP for a type that no subject can carry, OUTBOX or POST_COMMIT, ERROR for a critical one without a writer."""
    fine = F.coalesce(F.col("message_type").rlike(S.MESSAGE_TYPE), F.lit(False))
    is_critical = F.col("message_type").isin(*critical) if critical else F.lit(False)
    return messages.withColumn("path", F.when(~fine, "SKIP").when(is_critical, F.lit("OUTBOX" if has_writer else "ERROR")).otherwise("POST_COMMIT"))


def job_messages(tasks: DataFrame, allowed: Sequence[str]) -> DataFrame:
    """Job messages of external tasks (task_id, topic, business_key, variables): the subject, the id and the JSON body; the
    business key is an empty text where there is none."""
    body = F.to_json(F.struct(F.col("task_id").alias("taskId"), F.coalesce("business_key", F.lit("")).alias("businessKey"), S.captured(F.col("variables"), allowed).alias("variables")))
    return tasks.select(F.concat(F.lit("jobs."), "topic").alias("subject"), F.col("task_id").alias("message_id"), body.alias("body"))


def outbound_messages(messages: DataFrame) -> DataFrame:
    """Outbound messages: the subject, the id and the JSON body; a blank business key is left out."""
    key = F.when(~S.blank(F.col("business_key")), F.col("business_key"))
    body = F.to_json(F.struct(F.col("message_type").alias("type"), F.col("trace_id").alias("traceId"), key.alias("businessKey")))
    return messages.select(S.outbound_subject(F.col("engine_id"), F.col("message_type"), F.col("process_instance_id")).alias("subject"), F.col("id").alias("message_id"), body.alias("body"))


def expired_locks(tasks: DataFrame, topics: Sequence[str], as_of: Column) -> DataFrame:
    """Tasks of the topics that anyone may take again: never locked, or the lock ran out; with retries left and not suspended."""
    free = F.col("lock_expires_at").isNull() | (F.col("lock_expires_at") < as_of)
    return tasks.filter(F.col("topic").isin(*topics) & free & (F.coalesce("retries", F.lit(1)) > 0) & ~F.coalesce("suspended", F.lit(False)))


def reply_actions(replies: DataFrame, body: str) -> DataFrame:
    """Adds ``reply_type``, ``retries`` and ``action`` to replies; a reply without a known type is a dead letter."""
    kind = S.reply_type(F.col(body))
    action = F.when(kind == "SUCCESS", "COMPLETE").when(kind == "BPMN_ERROR", "RAISE_ERROR").when(kind == "TRANSIENT", "REPORT_FAILURE").otherwise("DEAD_LETTER")
    return replies.withColumns({"reply_type": kind, "retries": S.reply_retries(F.col(body)), "action": action})


def incidents(dead: DataFrame) -> DataFrame:
    """Dead letters of jobs as failures without retries: the task's id is the message id without its suffix."""
    jobs = dead.filter(F.col("original_subject").startswith("jobs."))
    return jobs.select(S.without_dlq_suffix(F.col("message_id")).alias("task_id"), "reason", F.lit(0).alias("retries"))


def failure_events(dead: DataFrame, channels: DataFrame) -> DataFrame:
    """The other dead letters with the channel they came through; those of no known channel are to be delivered again.

    ``channels`` (subject, channel) is a configuration, so it goes with the plan.
    """
    rest = dead.filter(~F.col("original_subject").startswith("jobs."))
    found = rest.join(F.broadcast(channels.withColumnRenamed("subject", "__s")), F.col("original_subject") == F.col("__s"), "left").drop("__s")
    return found.withColumn("action", F.when(F.col("channel").isNull(), "NAK").otherwise("EMIT"))
