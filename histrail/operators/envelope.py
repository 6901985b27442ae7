"""Wire messages of history events: parsing, routing, dead letters, encoding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalar as S
from ..schemas import CLASSES, ENTITY_CLASSES

PREFIX = "X-History-"
REQUIRED = ("Engine-Id", "Class", "Event-Type", "Event-Id", "Process-Instance-Id", "Event-Time")
# Fixed values.
SCHEMA_DRIFT = "SYS_PROJECTION_SCHEMA_DRIFT"
BUDGET_EXCEEDED = "BUS_HISTORY_DELIVERY_BUDGET_EXCEEDED"
LARGE_PAYLOAD = "_largePayloadBase64"
#: Deliveries before a message that can't be written is a dead letter.
MAX_DELIVERIES = 4


def parse(messages: DataFrame, prefix: str = PREFIX) -> DataFrame:
    """``messages`` (subject, headers, data, stream_sequence, delivery_count) with the envelope's fields and ``drift``.

    ``drift`` names the first thing that is wrong: a required header missing or blank, a time that is no number, a body that
    is no JSON object; it is null for a sound message. A missing sequence is 0, a missing delivery count 1. Null headers or a
    null body are drift.
    """
    h = lambda n: F.try_element_at(F.col("headers"), F.lit(prefix + n))
    text = F.decode("data", "UTF-8")
    # a duplicate key in a body must not fail the query, so the object is read leniently and checked by its outer shape
    body = F.from_json(text, "map<string,string>", {"mode": "PERMISSIVE"})
    millis = h("Event-Time").try_cast("bigint")
    missing = F.coalesce(*[F.when(S.blank(h(n)), F.lit(f"header {n}")) for n in REQUIRED])
    drift = F.when(F.col("headers").isNull(), F.lit("headers")).otherwise(F.coalesce(missing, F.when(millis.isNull(), F.lit("time")), F.when(body.isNull(), F.lit("body"))))
    return messages.select(
        "*",
        h("Engine-Id").alias("engine_id"), h("Class").alias("history_class"), h("Event-Type").alias("event_type"), h("Event-Id").alias("history_event_id"),
        h("Process-Instance-Id").alias("process_instance_id"), F.timestamp_millis(millis).alias("event_time"), h("Business-Key").alias("business_key"), body.alias("fields"),
        F.coalesce("stream_sequence", F.lit(0)).cast("long").alias("seq"), F.coalesce("delivery_count", F.lit(1)).cast("int").alias("delivery"), drift.alias("drift"),
    )


def route(parsed: DataFrame, failed: Column | None = None, max_deliveries: int = MAX_DELIVERIES) -> DataFrame:
    """Adds ``route`` (entity, log, retry or dlq), ``reason`` and ``retry_after_s``; one pass, no message is in two routes.

    ``failed`` says which messages can't be written just now; a class without a table never can. A failed message is tried
    again after its backoff until its deliveries are used up.
    """
    broken = F.coalesce(failed, F.lit(False)) if failed is not None else F.lit(False)
    unknown = ~F.col("history_class").isin(*CLASSES)
    fails = F.col("drift").isNull() & (broken | F.coalesce(unknown, F.lit(True)))
    spent = F.col("delivery") > max_deliveries
    where = F.when(F.col("drift").isNotNull() | (fails & spent), "dlq").when(fails, "retry").when(F.col("history_class").isin(*ENTITY_CLASSES), "entity").otherwise("log")
    reason = F.when(F.col("drift").isNotNull(), SCHEMA_DRIFT).when(fails & spent, BUDGET_EXCEEDED)
    return parsed.withColumns({"route": where, "reason": reason, "retry_after_s": F.when(fails & ~spent & F.col("drift").isNull(), S.backoff_seconds(F.col("delivery")))})


def dead_letters(routed: DataFrame) -> DataFrame:
    """What goes to the dead-letter dataset: the message, where from and why, under an id of its own."""
    return routed.filter(F.col("route") == "dlq").select(
        S.dlq_subject(F.col("subject")).alias("dlq_subject"), F.col("subject").alias("original_subject"), S.class_of_subject(F.col("subject")).alias("class_tag"), "reason",
        F.concat(F.coalesce(S.header(F.col("headers"), "Msg-Id"), F.lit("")), F.lit(".dlq")).alias("message_id"), F.col("delivery").alias("delivery_count"), "headers", "data",
    )


def encode(events: DataFrame, prefix: str = PREFIX) -> DataFrame:
    """Wire messages from events: the envelope's columns, ``body`` (JSON text of the fields) and optional ``large`` bytes."""
    extra = F.concat(F.regexp_replace("body", r"\}\s*$", ""), F.when(F.trim("body").rlike(r"^\{\s*\}$"), F.lit("")).otherwise(F.lit(",")), F.lit(f'"{LARGE_PAYLOAD}":"'), F.translate(F.base64("large"), "\r\n", ""), F.lit('"}'))
    data = F.when(F.col("large").isNull() | (F.octet_length("large") == 0), F.col("body")).otherwise(extra) if "large" in events.columns else F.col("body")
    pairs = {"Engine-Id": "engine_id", "Class": "history_class", "Event-Type": "event_type", "Event-Id": "history_event_id", "Process-Instance-Id": "process_instance_id"}
    items = [x for k, c in pairs.items() for x in (F.lit(prefix + k), F.col(c))]
    items += [F.lit(prefix + "Event-Time"), F.unix_millis("event_time").cast("string"), F.lit(prefix + "Business-Key"), F.col("business_key"), F.lit("Msg-Id"), S.message_id(F.col("history_event_id"), F.col("event_type"))]
    return events.select(
        S.history_subject(F.col("engine_id"), F.col("history_class"), F.col("process_instance_id")).alias("subject"), S.clean_headers(F.create_map(*items)).alias("headers"),
        F.encode(data, "UTF-8").alias("data"), F.col("stream_sequence").cast("long").alias("stream_sequence"), F.col("delivery_count").cast("int").alias("delivery_count"),
    )


def large_payloads(parsed: DataFrame) -> DataFrame:
    """Adds ``payload`` and ``payload_hash``: only external-task events keep a large payload, the other classes drop theirs."""
    raw = F.try_element_at("fields", F.lit(LARGE_PAYLOAD))
    payload = F.when((F.col("history_class") == "EXT_TASK_LOG") & ~S.blank(raw), F.unbase64(raw))
    return parsed.withColumn("payload", payload).withColumn("payload_hash", F.sha2("payload", 256))


def partition_of(key: Column, partitions: int = 8) -> Column:
    """A partition by an explicit hash of the key, the same in any engine that has SHA-256."""
    return F.pmod(F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("long"), F.lit(partitions)).cast("int")
