"""Queries of the extraction of history events from engine events, and their SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import extract
from ..tables import load, same_id
from .quality import _id

NOW = "2026-07-01 00:00:00"


def _now():
    return F.to_timestamp(F.lit(NOW))


def _engine_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the tables as engine events of five kinds, one of them without a class."""
    p = load(spark, sf_dir, "act_hi_procinst")
    a = load(spark, sf_dir, "activity_instance_history")
    v = load(spark, sf_dir, "variable_detail_history")
    o = load(spark, sf_dir, "outbound_message_outbox")
    n = F.col("revision")
    parts = [
        p.select(F.lit("process_instance").alias("kind"), F.concat(F.lit("p/"), same_id("process_instance_id")).alias("history_event_id"), F.lit("end").alias("event_type"), "engine_id", same_id("process_instance_id").alias("process_instance_id"), "process_definition_key", "business_key", "start_user_id", "super_process_instance_id", "start_time", "end_time", "delete_reason", "state"),
        a.select(F.lit("activity_instance").alias("kind"), F.concat(F.lit("a/"), same_id("activity_instance_id")).alias("history_event_id"), F.lit("end").alias("event_type"), "engine_id", same_id("process_instance_id").alias("process_instance_id"), "activity_id", "activity_name", "activity_type", "task_assignee", "start_time", "end_time"),
        v.select(F.when(n % 9 == 4, "form_property").otherwise("variable_update").alias("kind"), F.concat(F.lit("v/"), same_id("history_event_id")).alias("history_event_id"), "event_type", "engine_id", same_id("process_instance_id").alias("process_instance_id"), "variable_instance_id", "variable_name", "variable_type", "revision", F.col("variable_value_text").alias("text_value"), F.when(n % 3 == 0, F.encode(F.coalesce("variable_value_text", F.lit("")), "UTF-8")).alias("byte_value"), F.col("event_time").alias("time")),
        o.select(F.lit("external_task_log").alias("kind"), F.concat(F.lit("o/"), same_id("id")).alias("history_event_id"), F.lit("create").alias("event_type"), "engine_id", same_id("process_instance_id").alias("process_instance_id"), same_id("id").alias("external_task_id"), F.col("message_type").alias("topic_name"), "business_key", F.when(F.col("arrival_no") % 3 == 0, F.coalesce("trace_id", F.lit(""))).alias("error_details"), F.when(F.col("arrival_no") % 5 > 0, F.col("created_at")).alias("time")),
    ]
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), parts)


def _extracted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.extracted(_engine_events(spark, sf_dir), _now())


def f5_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.classify(_engine_events(spark, sf_dir)).groupBy("kind", "history_class").agg(F.count(F.lit(1)).alias("n"))


def f6_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _extracted(spark, sf_dir).select("history_event_id", "body")


def f7_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _extracted(spark, sf_dir).select("history_event_id", F.unix_millis("event_time").alias("event_ms"))


def f8_business_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _extracted(spark, sf_dir).groupBy("history_class", "business_key").agg(F.count(F.lit(1)).alias("n"))


def f9_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _extracted(spark, sf_dir).filter(F.col("large").isNotNull()).select("history_event_id", F.sha2("large", 256).alias("content_hash"))


def k5_outbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows that are written, each with the size of its companion."""
    rows, companions = extract.outbox_rows(_extracted(spark, sf_dir).dropDuplicates(), _now())
    sizes = companions.select(F.col("outbox_row_id").alias("id"), F.octet_length("payload_bytes").cast("long").alias("n_bytes")).dropDuplicates(["id"])
    return rows.dropDuplicates(["id"]).join(sizes, "id", "left").select("history_event_id", "event_type", "history_class", "engine_id", "business_key", "n_bytes", F.unix_millis("event_time").alias("event_ms"))


QUERIES = {f.__name__: f for f in (f5_classes, f6_bodies, f7_times, f8_business_keys, f9_payloads, k5_outbox)}


def _json(**keys: str) -> str:
    return f"json_object({', '.join(f'{chr(39)}{k}{chr(39)}, {c}' for k, c in keys.items())})"


_LATE = f"epoch_ms(TIMESTAMPTZ '{NOW}+00')"
_EVENTS = f"""WITH e AS (
SELECT 'process_instance' AS kind, 'PROCINST' AS history_class, 'p/' || {_id("process_instance_id")} AS id, 'end' AS event_type, engine_id, business_key,
 CAST({_json(processDefinitionKey="process_definition_key", processDefinitionId="CAST(NULL AS VARCHAR)", businessKey="business_key", startUserId="start_user_id", superProcessInstanceId="super_process_instance_id", deleteReason="delete_reason", state="state")} AS VARCHAR) AS body,
 coalesce(epoch_us(end_time) // 1000, epoch_us(start_time) // 1000, {_LATE}) AS ms, CAST(NULL AS BLOB) AS large FROM act_hi_procinst
UNION ALL SELECT 'activity_instance', 'ACTINST', 'a/' || {_id("activity_instance_id")}, 'end', engine_id, NULL,
 CAST({_json(activityId="activity_id", activityName="activity_name", activityType="activity_type", taskAssignee="task_assignee")} AS VARCHAR), coalesce(epoch_us(end_time) // 1000, epoch_us(start_time) // 1000, {_LATE}), NULL FROM activity_instance_history
UNION ALL SELECT CASE WHEN revision % 9 = 4 THEN 'form_property' ELSE 'variable_update' END, CASE WHEN coalesce(revision % 9, 0) <> 4 THEN 'DETAIL' END, 'v/' || {_id("history_event_id")}, event_type, engine_id, NULL,
 CASE WHEN revision % 9 = 4 THEN '{{}}' ELSE CAST({_json(variableInstanceId="variable_instance_id", variableName="variable_name", variableType="variable_type", revision="revision", textValue="variable_value_text")} AS VARCHAR) END,
 CASE WHEN revision % 9 = 4 THEN {_LATE} ELSE coalesce(epoch_us(event_time) // 1000, {_LATE}) END, CASE WHEN revision % 9 <> 4 AND revision % 3 = 0 AND coalesce(variable_value_text, '') <> '' THEN encode(variable_value_text) END FROM variable_detail_history
UNION ALL SELECT 'external_task_log', 'EXT_TASK_LOG', 'o/' || {_id("id")}, 'create', engine_id, NULL,
 CAST({_json(externalTaskId=_id("id"), workerId="CAST(NULL AS VARCHAR)", topicName="message_type", activityId="CAST(NULL AS VARCHAR)", errorMessage="CAST(NULL AS VARCHAR)")} AS VARCHAR),
 coalesce(CASE WHEN arrival_no % 5 > 0 THEN epoch_us(created_at) // 1000 END, {_LATE}), CASE WHEN arrival_no % 3 = 0 AND coalesce(trace_id, '') <> '' THEN encode(trace_id) END FROM outbound_message_outbox)"""

ORACLE = {
    "f5_classes": _EVENTS + " SELECT kind, history_class, count(*) AS n FROM e GROUP BY 1, 2",
    "f6_bodies": _EVENTS + " SELECT id AS history_event_id, body FROM e",
    "f7_times": _EVENTS + " SELECT id AS history_event_id, ms AS event_ms FROM e",
    "f8_business_keys": _EVENTS + " SELECT history_class, business_key, count(*) AS n FROM e GROUP BY 1, 2",
    "f9_payloads": _EVENTS + " SELECT id AS history_event_id, sha256(large) AS content_hash FROM e WHERE large IS NOT NULL",
    "k5_outbox": _EVENTS + """ SELECT id AS history_event_id, event_type, history_class, engine_id, any_value(business_key) AS business_key, CAST(max(octet_length(large)) AS BIGINT) AS n_bytes, ms AS event_ms
FROM e WHERE history_class IS NOT NULL GROUP BY id, event_type, history_class, engine_id, ms""",
}
