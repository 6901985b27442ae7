"""The fifteen history classes: their tables, columns and wire names."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql import types as T

# Class names, tables, columns and wire names must be these for equal results.
ENTITY, LOG = "entity", "log"
UNCLASSIFIED = "UNCLASSIFIED"
AUDIT_CRITICAL = ("OP_LOG", "INCIDENT", "EXT_TASK_LOG")
_ENTITY_TAIL = "stream_sequence bigint, event_time timestamp, partition_anchor_at timestamp, created_at timestamp, updated_at timestamp, created_by string, updated_by string, deleted_at timestamp, anonymized_at timestamp, legal_hold boolean"
_LOG_HEAD = "id string, engine_id string, process_instance_id string, history_event_id string, event_type string"
_LOG_TAIL = "stream_sequence bigint, event_time timestamp, created_at timestamp, created_by string, deleted_at timestamp, anonymized_at timestamp, legal_hold boolean"


@dataclass(frozen=True)
class HistoryClass:
    name: str
    kind: str
    table: str
    key: str | None
    fields: str
    own_instance: bool = True

    @property
    def columns(self) -> list[tuple[str, str]]:
        """The class's own columns and their types, as they may come in a message body."""
        return [tuple(c.split(" ")) for c in self.fields.split(", ")]

    @property
    def schema(self) -> T.StructType:
        if self.kind == LOG:
            return T._parse_datatype_string(f"{_LOG_HEAD}, {self.fields}, {_LOG_TAIL}")
        instance = "process_instance_id string, " if self.own_instance and self.key != "process_instance_id" else ""
        return T._parse_datatype_string(f"id string, engine_id string, {self.key} string, {instance}{self.fields}, {_ENTITY_TAIL}")

    @property
    def stored_schema(self) -> T.StructType:
        """With the month that the dataset is partitioned by."""
        return T.StructType([*self.schema.fields, T.StructField("month", T.StringType())])

    @property
    def critical(self) -> bool:
        return self.name in AUDIT_CRITICAL


CLASSES = {
    c.name: c
    for c in (
        HistoryClass("PROCINST", ENTITY, "process_instance_history", "process_instance_id", "process_definition_key string, process_definition_id string, business_key string, start_user_id string, super_process_instance_id string, start_time timestamp, end_time timestamp, duration_millis bigint, delete_reason string, state string"),
        HistoryClass("ACTINST", ENTITY, "activity_instance_history", "activity_instance_id", "activity_id string, activity_type string, activity_name string, task_assignee string, start_time timestamp, end_time timestamp, duration_millis bigint, canceled boolean"),
        HistoryClass("VARINST", ENTITY, "variable_instance_history", "variable_instance_id", "variable_name string, variable_type string, variable_value_text string, variable_value_ref string, is_byte_array boolean"),
        HistoryClass("TASKINST", ENTITY, "task_instance_history", "task_id", "task_name string, task_description string, assignee string, owner string, start_time timestamp, end_time timestamp, duration_millis bigint, delete_reason string, priority int"),
        HistoryClass("INCIDENT", ENTITY, "incident_history", "incident_id", "incident_type string, incident_message string, configuration string, activity_id string, create_time timestamp, end_time timestamp, resolved boolean"),
        HistoryClass("CASEINST", ENTITY, "case_instance_history", "case_instance_id", "case_definition_id string, business_key string, create_time timestamp, close_time timestamp, state string", own_instance=False),
        HistoryClass("DETAIL", LOG, "variable_detail_history", None, "variable_instance_id string, variable_name string, variable_type string, revision int, variable_value_text string"),
        HistoryClass("IDENTITYLINK", LOG, "identity_link_history", None, "task_id string, link_type string, user_id string, group_id string, operation_type string"),
        HistoryClass("OP_LOG", LOG, "operation_log_history", None, "operation_id string, user_id string, user_id_pseudonymized boolean, pseudonym_token string, operation_type string, entity_type string, property string, org_value string, new_value string"),
        HistoryClass("EXT_TASK_LOG", LOG, "ext_task_log_history", None, "external_task_id string, worker_id string, topic_name string, activity_id string, error_message string, error_details_ref string, state string"),
        HistoryClass("JOB_LOG", LOG, "job_log_history", None, "job_id string, job_def_type string, exception_message string, retries int, state string"),
        HistoryClass("COMMENT", LOG, "comment_history", None, "task_id string, user_id string, message string"),
        HistoryClass("ATTACHMENT", LOG, "attachment_history", None, "task_id string, user_id string, attachment_name string, attachment_type string, url string, content_ref string"),
        HistoryClass("DECINST", LOG, "decision_evaluation_history", None, "decision_definition_id string, decision_definition_key string, root_decision_instance_id string, inputs string, outputs string"),
        HistoryClass("BATCH", LOG, "batch_history", None, "batch_id string, batch_type string, total_jobs int, jobs_per_seed int, start_time timestamp, end_time timestamp"),
    )
}
#: Wire keys whose column isn't their snake case, by class.
RENAMED = {
    "TASKINST": {"name": "task_name"},
    "DETAIL": {"textValue": "variable_value_text"},
    "IDENTITYLINK": {"type": "link_type"},
    "JOB_LOG": {"jobDefinitionType": "job_def_type", "jobExceptionMessage": "exception_message"},
    "BATCH": {"type": "batch_type"},
}
#: Columns that are nulled when a subject is erased, by class.
ERASED_COLUMNS = {
    "PROCINST": ("business_key", "start_user_id"),
    "ACTINST": ("task_assignee",),
    "VARINST": ("variable_value_text", "variable_value_ref"),
    "TASKINST": ("assignee", "owner", "task_name", "task_description"),
    "DETAIL": ("variable_value_text",),
    "COMMENT": ("message",),
}
COLUMN_DEFAULTS = {"state": "ACTIVE", "canceled": False, "is_byte_array": False, "resolved": False, "user_id_pseudonymized": False}

ENTITY_CLASSES = tuple(c.name for c in CLASSES.values() if c.kind == ENTITY)
LOG_CLASSES = tuple(c.name for c in CLASSES.values() if c.kind == LOG)
_NAME = re.compile(r"[a-z][a-z0-9_]*")


def camel_to_snake(key: str) -> str:
    """An underscore before every upper-case letter, then lower case."""
    return re.sub(r"([A-Z])", r"_\1", key).lower()


def column_for(history_class: str, wire_key: str) -> str | None:
    """The column that a wire key fills, or None when the class has none: such keys are left out of the row."""
    c = CLASSES[history_class]
    name = RENAMED.get(history_class, {}).get(wire_key) or camel_to_snake(wire_key)
    return name if _NAME.fullmatch(name) and name in dict(c.columns) else None


def wire_keys_for(history_class: str, column: str) -> list[str]:
    """The wire keys that fill a column, the renamed one first: it wins where a body has both."""
    renamed = [k for k, v in RENAMED.get(history_class, {}).items() if v == column]
    head, *rest = column.split("_")
    return [*renamed, head + "".join(p[:1].upper() + p[1:] for p in rest)]


def check_class_names(names: list[str]) -> None:
    """Class names in a configuration must exist; an unknown one would silently take the default path."""
    unknown = [n for n in names if n not in CLASSES]
    if unknown:
        raise ValueError(f"unknown history classes: {unknown}")


def create_empty(spark: SparkSession, root: str) -> list[str]:
    """Make the datasets of all classes, partitioned by month; those that exist stay as they are. Returns the new ones."""
    from .session import hadoop_path

    made = []
    for c in CLASSES.values():
        path, fs = hadoop_path(spark, f"{root}/{c.table}")
        if not fs.exists(path):
            spark.createDataFrame([], c.stored_schema).write.partitionBy("month").parquet(f"{root}/{c.table}")
            made.append(c.table)
    return made


def open_table(spark: SparkSession, root: str, history_class: str):
    """The dataset of a class; its schema is given, so an empty one can be read too."""
    c = CLASSES[history_class]
    return spark.read.schema(c.stored_schema).parquet(f"{root}/{c.table}")
