"""From engine events to history events: class, body, time, business key, large payload, and the rows of the outbox."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The class of each kind of engine event. Other kinds are unclassified, which is a null class here.
CLASS_OF_KIND = {
    "process_instance": "PROCINST", "activity_instance": "ACTINST", "task_instance": "TASKINST", "variable_update": "DETAIL", "incident": "INCIDENT", "case_instance": "CASEINST",
    "identity_link": "IDENTITYLINK", "operation_log": "OP_LOG", "external_task_log": "EXT_TASK_LOG", "job_log": "JOB_LOG", "decision_evaluation": "DECINST", "batch": "BATCH",
}
# The keys of a class's body, and the event's column that each comes from.
BODY = {
    "PROCINST": {"processDefinitionKey": "process_definition_key", "processDefinitionId": "process_definition_id", "businessKey": "business_key", "startUserId": "start_user_id", "superProcessInstanceId": "super_process_instance_id", "deleteReason": "delete_reason", "state": "state"},
    "ACTINST": {"activityId": "activity_id", "activityName": "activity_name", "activityType": "activity_type", "taskAssignee": "task_assignee"},
    "TASKINST": {"taskId": "task_id", "name": "name", "assignee": "assignee", "owner": "owner", "deleteReason": "delete_reason", "priority": "priority"},
    "DETAIL": {"variableInstanceId": "variable_instance_id", "variableName": "variable_name", "variableType": "variable_type", "revision": "revision", "textValue": "text_value"},
    "INCIDENT": {"incidentType": "incident_type", "incidentMessage": "incident_message", "configuration": "configuration", "activityId": "activity_id"},
    "CASEINST": {"businessKey": "business_key", "createUserId": "create_user_id", "state": "state"},
    "IDENTITYLINK": {"type": "link_type", "userId": "user_id", "groupId": "group_id", "taskId": "task_id", "operationType": "operation_type"},
    "OP_LOG": {"operationId": "operation_id", "userId": "user_id", "operationType": "operation_type", "entityType": "entity_type", "property": "property", "orgValue": "org_value", "newValue": "new_value"},
    "EXT_TASK_LOG": {"externalTaskId": "external_task_id", "workerId": "worker_id", "topicName": "topic_name", "activityId": "activity_id", "errorMessage": "error_message"},
    "JOB_LOG": {"jobId": "job_id", "jobDefinitionType": "job_definition_type", "jobExceptionMessage": "job_exception_message", "retries": "retries"},
    "DECINST": {"decisionDefinitionId": "decision_definition_id", "decisionDefinitionKey": "decision_definition_key"},
    "BATCH": {"batchId": "batch_id", "type": "batch_type", "totalJobs": "total_jobs"},
}
# The columns that say when an event happened, the first that is not null; of the classes not named, ``time``.
TIMES = {"PROCINST": ("end_time", "start_time"), "ACTINST": ("end_time", "start_time"), "TASKINST": ("end_time", "start_time"), "CASEINST": ("end_time", "start_time"), "INCIDENT": ("end_time", "create_time"), "BATCH": ("end_time", "start_time")}


def _column(events: DataFrame, name: str) -> Column:
    """A column of the events; null if they don't have it, for few kinds have all."""
    return F.col(name) if name in events.columns else F.lit(None).cast("string")


def _by_class(values: dict[str, Column]) -> Column:
    return F.coalesce(*[F.when(F.col("history_class") == c, v) for c, v in values.items()])


def classify(events: DataFrame, kind: str = "kind") -> DataFrame:
    """Adds ``history_class``; null for kinds that have none."""
    return events.withColumn("history_class", F.coalesce(*[F.when(F.col(kind) == k, F.lit(c)) for k, c in CLASS_OF_KIND.items()]))


def bodies(events: DataFrame) -> DataFrame:
    """Adds ``body``, the JSON text of the class's fields, nulls included; an empty object for events without a class."""
    body = {c: F.to_json(F.struct(*[_column(events, x).alias(k) for k, x in keys.items()]), {"ignoreNullFields": "false"}) for c, keys in BODY.items()}
    return events.withColumn("body", F.coalesce(_by_class(body), F.lit("{}")))


def event_times(events: DataFrame, now: Column) -> DataFrame:
    """Adds ``event_time``; ``now`` where the event says nothing."""
    at = {c: F.coalesce(*[_column(events, x).cast("timestamp") for x in TIMES.get(c, ("time",))]) for c in BODY}
    return events.withColumn("event_time", F.coalesce(_by_class(at), now))


def business_keys(events: DataFrame) -> DataFrame:
    """``business_key`` of process and case instances; null for all others."""
    return events.withColumn("business_key", F.when(F.col("history_class").isin("PROCINST", "CASEINST"), _column(events, "business_key")))


def payloads(events: DataFrame) -> DataFrame:
    """Adds ``large``: the error details of external tasks and the bytes of variables; null where there are none or they are empty."""
    raw = _by_class({"EXT_TASK_LOG": F.encode(_column(events, "error_details"), "UTF-8"), "DETAIL": _column(events, "byte_value").cast("binary")})
    return events.withColumn("large", F.when(F.octet_length(raw) > 0, raw))


def extracted(events: DataFrame, now: Column) -> DataFrame:
    """All of the above, in one pass over the events: ``kind`` and the columns that the kinds have, missing ones being null.
    Null kinds and kinds of no class stay, with a null class and an empty body."""
    return business_keys(event_times(payloads(bodies(classify(events))), now))


def outbox_rows(events: DataFrame, now: Column) -> tuple[DataFrame, DataFrame]:
    """The outbox's rows and their companions with large payloads, from extracted events with ``history_event_id``,
    ``event_type``, ``engine_id`` and ``process_instance_id``.

    A row's id comes from what it says, so a repeated write gives the same row; a companion's from its row. Events without a
    class are not written.
    """
    identity = F.concat_ws("\0", "engine_id", "history_class", "history_event_id", "event_type", F.unix_micros("event_time").cast("string"))
    row = events.filter(F.col("history_class").isNotNull()).withColumn("id", F.sha2(identity, 256))
    ref = F.when(F.col("large").isNotNull(), F.sha2(F.concat(F.col("id"), F.lit("/payload")), 256))
    row = row.withColumn("payload_large_ref", ref)
    rows = row.select("id", "history_event_id", "event_type", "history_class", "engine_id", "process_instance_id", "business_key", F.col("body").alias("payload_scalar"), "payload_large_ref", "event_time", now.alias("created_at"))
    companions = row.filter(F.col("large").isNotNull()).select(F.col("payload_large_ref").alias("id"), F.col("id").alias("outbox_row_id"), F.col("large").alias("payload_bytes"), now.alias("created_at"))
    return rows, companions
