"""Queries of erasure and retention as a whole: requests, scopes, releases, verification; and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import governance as G
from ..operators import handoff as H
from ..operators import reconcile as R
from ..tables import load, same_id
from .controls import _ACT, _GROUPS, _HIT, _NOW, _PI, _SCOPE, _SUB, AS_OF, _id, _now, _scope, _subjects
from .quality import current_activities, current_instances


def _groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.case_groups(_subjects(spark, sf_dir), "subject", "start_time", "process_instance_id")


def _requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A request of every subject; by the length of its name it asks for critical classes only, for some, or for nothing."""
    s = _subjects(spark, sf_dir).select("subject").distinct()
    n = F.length("subject") % 4
    classes = F.when(n == 0, F.array(F.lit("OP_LOG"), F.lit("INCIDENT"))).when(n == 1, F.array(F.lit("OP_LOG"), F.lit("PROCINST"), F.lit("ACTINST"))).when(n == 2, F.array(F.lit("PROCINST")))
    return s.select("subject", F.concat(F.lit("req/"), "subject").alias("request_id"), classes.alias("classes"))


def g3_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The outcome of every request and how many classes it may erase."""
    got = G.request_outcomes(_requests(spark, sf_dir), G.scope_outcome(_groups(spark, sf_dir), "subject"), "subject")
    return got.select("subject", F.size("erasable").cast("long").alias("n_classes"), "outcome")


def g5_scopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates after the answers: every second request names its first case, and an instance that was no candidate."""
    groups = _groups(spark, sf_dir)
    asked = G.request_outcomes(_requests(spark, sf_dir), G.scope_outcome(groups, "subject"), "subject").filter(F.col("outcome") == "CONFIRMATION_REQUIRED")
    pending = G.pending_scopes(groups, "subject", asked)
    answers = pending.filter(F.length("subject") % 2 == 1).join(groups.filter("case_group = 0").select("process_instance_id"), "process_instance_id", "left_semi").select("request_id", "process_instance_id")
    stray = answers.select("request_id", F.lit("nobody's").alias("process_instance_id")).distinct()
    return G.confirm_scopes(pending, answers.unionByName(stray)).select("request_id", "process_instance_id", "status")


def g7_released(spark: SparkSession, sf_dir: str) -> DataFrame:
    """References that an erasure gives back: those of the scope's outbox rows, by payload."""
    o = load(spark, sf_dir, "compact_history_outbox").select(same_id("process_instance_id").alias("process_instance_id"), same_id("payload_large_ref").alias("ref"))
    return G.release_deltas(o, "ref", _scope(spark, sf_dir), ["process_instance_id"])


def _due_refs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    refs = load(spark, sf_dir, "runtime_large_variable_ref").withColumn("month", F.date_format("created_at", "yyyy-MM"))
    return refs, G.due(G.partitions(refs, "created_at", "VARINST"), _now(), G.RetentionRules({"VARINST": 365}))


def g1_released(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The payload store after retention has dropped months of references: counts, and which payloads went with them."""
    refs, due = _due_refs(spark, sf_dir)
    deltas = G.release_deltas(refs.withColumn("payload_id", same_id("payload_id")), "payload_id", due, ["month"])
    payloads = load(spark, sf_dir, "projection_large_payload").groupBy(same_id("id").alias("id")).agg(F.max("ref_count").alias("ref_count"))
    return G.after_release(payloads, deltas)


def g9_verified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit of an erasure with what its verification found; the activities still hold what was deleted before."""
    scope = _scope(spark, sf_dir)
    a = G.anonymise(current_activities(spark, sf_dir, "process_instance_id", "task_assignee", "anonymized_at"), "ACTINST", scope, _now())
    p = G.anonymise(current_instances(spark, sf_dir, "start_user_id", "business_key", "anonymized_at"), "PROCINST", scope, _now())
    audit = G.erasure_audit({"ACTINST": a, "PROCINST": p}, "req-1", "subject-1")
    live = p.filter("affected")
    return G.verified_audit(audit, {"ACTINST": G.leftovers(a, "ACTINST", scope), "PROCINST": G.leftovers(live, "PROCINST", scope)}).select("target_table", "affected_row_count", "verification_status")


def a11_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether an engine's outbox keeps its bounds: nothing of best-effort types, and of critical ones no more than instances."""
    o = load(spark, sf_dir, "outbound_message_outbox").withColumn("critical", F.col("message_type").isin("payment.requested", "limit.changed"))
    return H.outbox_gate(o, "critical", ["engine_id"], same_id("process_instance_id"))


def l3_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The classes of every engine in the order in which they are cut over."""
    return R.cutover_order(load(spark, sf_dir, "class_cutover_state").select("engine_id", F.upper("history_class").alias("history_class")).distinct(), ["engine_id"])


def t7_expired(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of the outbox beyond the age of their stream."""
    o = load(spark, sf_dir, "compact_history_outbox").withColumn("stream", F.when(F.col("arrival_no") % 4 == 0, "dlq").otherwise("history"))
    return H.within_age(o, "stream", "created_at", F.to_timestamp(F.lit("2025-10-01 00:00:00"))).groupBy("stream").agg(F.count(F.lit(1)).alias("n"))


QUERIES = {f.__name__: f for f in (g3_outcomes, g5_scopes, g7_released, g1_released, g9_verified, a11_gate, l3_order, t7_expired)}

_REQ = f"WITH {_SUB}, {_GROUPS.format(90)}, sc90 AS (SELECT subject, max(case_group) > 0 AS many FROM g GROUP BY 1), q AS (SELECT subject, CASE length(subject) % 4 WHEN 1 THEN 2 WHEN 2 THEN 1 ELSE 0 END AS n, many FROM sc90)"
ORACLE = {
    "g3_outcomes": _REQ + " SELECT subject, CAST(n AS BIGINT) AS n_classes, CASE WHEN n = 0 THEN 'LEGAL_HOLD_BLOCKED' WHEN many THEN 'CONFIRMATION_REQUIRED' ELSE 'ACCEPTED' END AS outcome FROM q",
    "g5_scopes": _REQ + " SELECT 'req/' || subject AS request_id, pid AS process_instance_id, CASE WHEN length(subject) % 2 = 0 THEN 'PENDING' WHEN case_group = 0 THEN 'CONFIRMED' ELSE 'REJECTED' END AS status FROM g JOIN q USING (subject) WHERE n > 0 AND many",
    "g7_released": f"WITH {_SCOPE} SELECT {_id('payload_large_ref')} AS payload_id, -count(*) AS delta FROM compact_history_outbox WHERE payload_large_ref IS NOT NULL AND {_id('process_instance_id')} IN (SELECT pid FROM sc) GROUP BY 1",
    "g1_released": f"""WITH p AS (SELECT {_id('id')} AS id, max(ref_count) AS n FROM projection_large_payload GROUP BY 1),
 d AS (SELECT {_id('payload_id')} AS id, count(*) AS k FROM runtime_large_variable_ref WHERE payload_id IS NOT NULL AND date_trunc('month', created_at AT TIME ZONE 'UTC') + INTERVAL 1 MONTH < TIMESTAMP '{AS_OF}' - INTERVAL 365 DAY GROUP BY 1)
 SELECT id, CAST(CASE WHEN k IS NULL THEN n ELSE greatest(0, coalesce(n, 0) - k) END AS BIGINT) AS ref_count FROM p LEFT JOIN d USING (id) WHERE k IS NULL OR coalesce(n, 0) > k""",
    "g9_verified": f"""WITH {_ACT}, {_SCOPE}, {_HIT} SELECT 'activity_instance_history' AS target_table, count(*) FILTER (WHERE hit) AS affected_row_count, CASE WHEN count(*) FILTER (WHERE r.d IS NOT NULL AND r.u IS NOT NULL AND r.pid IN (SELECT pid FROM sc)) > 0 THEN 'FAILED' ELSE 'PASSED' END AS verification_status FROM h
 UNION ALL SELECT 'process_instance_history', (SELECT count(*) FROM {_PI} WHERE r.deleted_at IS NULL AND pid IN (SELECT pid FROM sc)), 'PASSED'""",
    "a11_gate": f"""SELECT engine_id, count(*) FILTER (WHERE NOT c) AS n_best_effort, count(*) FILTER (WHERE c) AS n_critical, count(DISTINCT {_id('process_instance_id')}) AS n_instances,
 count(*) FILTER (WHERE NOT c) = 0 AND count(*) FILTER (WHERE c) <= count(DISTINCT {_id('process_instance_id')}) AS passes FROM (SELECT *, coalesce(message_type IN ('payment.requested', 'limit.changed'), FALSE) AS c FROM outbound_message_outbox) GROUP BY 1""",
    "l3_order": f"""WITH s AS (SELECT DISTINCT engine_id, upper(history_class) AS history_class FROM class_cutover_state), o AS (SELECT *, list_position([{", ".join(f"'{c}'" for c in R.CUTOVER_ORDER)}], history_class) AS rank FROM s)
 SELECT engine_id, history_class, CAST(row_number() OVER (PARTITION BY engine_id ORDER BY rank NULLS LAST, history_class) AS INTEGER) AS place FROM o""",
    "t7_expired": "SELECT stream, count(*) AS n FROM (SELECT CASE WHEN arrival_no % 4 = 0 THEN 'dlq' ELSE 'history' END AS stream, created_at FROM compact_history_outbox) WHERE created_at >= TIMESTAMPTZ '2025-10-01 00:00:00+00' - CASE stream WHEN 'dlq' THEN INTERVAL 14 DAY ELSE INTERVAL 7 DAY END GROUP BY 1",
}
