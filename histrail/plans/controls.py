"""Queries of governance, reconciliation, hand-off and profiling, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalar as S
from ..operators import governance as G
from ..operators import handoff as H
from ..operators import profile as P
from ..operators import reconcile as R
from ..tables import latest, load, same_id
from .quality import _PI, _id, current_activities, current_instances

AS_OF = "2026-07-01 00:00:00"
TENANT, VERSION, SECRET = "tenant-a", 2, "0123456789abcdef"
#: Outbox messages of these types are critical here.
CRITICAL_TYPES = ("payment.requested", "limit.changed")


def _now():
    return F.to_timestamp(F.lit(AS_OF))


# --- governance --------------------------------------------------------------------------------------------------------


def _partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = (("PROCINST", "process_instance_history", "partition_anchor_at"), ("ACTINST", "activity_instance_history", "partition_anchor_at"), ("DETAIL", "variable_detail_history", "event_time"))
    parts = [G.partitions(load(spark, sf_dir, t), c, n) for n, t, c in tables]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def s14_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _partitions(spark, sf_dir).select("history_class", "month", F.unix_millis("upper_bound").alias("upper_ms"), "n_rows")


def g1_due(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = G.due(_partitions(spark, sf_dir), _now(), G.RetentionRules({"PROCINST": 365}))
    return d.select("history_class", "month", "n_rows", "window_days", "action", "legal_basis")


def g1_surviving(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = load(spark, sf_dir, "activity_instance_history")
    gone = G.due(G.partitions(a, "partition_anchor_at", "ACTINST"), _now(), G.RetentionRules({"ACTINST": 365}))
    return G.surviving(a, "partition_anchor_at", gone).groupBy("engine_id").agg(F.count(F.lit(1)).alias("n"))


def _subjects(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = current_instances(spark, sf_dir, "engine_id", "business_key", "start_time", "start_user_id").filter("deleted_at is null and business_key <> ''")
    # a subject here is an engine's user, so that subjects have many instances
    return i.filter(F.coalesce("start_user_id", F.lit("")) != "").withColumn("subject", F.concat_ws("/", "engine_id", "start_user_id"))


def g4_case_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.case_groups(_subjects(spark, sf_dir), "subject", "start_time", "process_instance_id", 30).select("subject", "process_instance_id", "case_group")


def g4_scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.scope_outcome(G.case_groups(_subjects(spark, sf_dir), "subject", "start_time", "process_instance_id"), "subject")


def _scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return current_instances(spark, sf_dir, "process_definition_key").filter(F.col("process_definition_key") == "dunning-run").select("process_instance_id")


def g6_anonymised(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = current_activities(spark, sf_dir, "process_instance_id", "task_assignee", "anonymized_at")
    r = G.anonymise(a, "ACTINST", _scope(spark, sf_dir), _now())
    return r.select("activity_instance_id", "task_assignee", F.unix_millis("deleted_at").alias("deleted_ms"), F.unix_millis("anonymized_at").alias("anonymized_ms"), "affected")


def g8_leftovers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows in scope that still hold a personal column after the erasure: those that were deleted before."""
    a = current_activities(spark, sf_dir, "process_instance_id", "task_assignee", "anonymized_at")
    r = G.anonymise(a, "ACTINST", _scope(spark, sf_dir), _now())
    return G.leftovers(r, "ACTINST", _scope(spark, sf_dir)).select("activity_instance_id", "task_assignee")


def g9_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    scope = _scope(spark, sf_dir)
    a = G.anonymise(current_activities(spark, sf_dir, "process_instance_id", "task_assignee", "anonymized_at"), "ACTINST", scope, _now())
    p = G.anonymise(current_instances(spark, sf_dir, "start_user_id", "business_key", "anonymized_at"), "PROCINST", scope, _now())
    return G.erasure_audit({"ACTINST": a, "PROCINST": p}, "req-1", "subject-1")


def f22_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = load(spark, sf_dir, "process_instance_history").filter(F.coalesce("start_user_id", F.lit("")) != "").select("start_user_id").distinct()
    return u.select("start_user_id", S.pseudonym_token(F.col("start_user_id"), TENANT, VERSION).alias("token"))


def f23_pseudonymised(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = load(spark, sf_dir, "compact_history_outbox").select("arrival_no", "history_class", F.from_json("payload_scalar", "map<string,string>").alias("fields"))
    r = G.pseudonymise(o, F.col("history_class"), "fields", TENANT, VERSION)
    g = lambda k: F.try_element_at("fields", F.lit(k))
    return r.select("arrival_no", g("userId").alias("user_id"), g("userIdPseudonymized").alias("flag"), g("pseudonymToken").alias("token"))


#: When the users that the vault knew before were first seen there.
SEEN_BEFORE = "2020-01-01 00:00:00"


def _vault(spark: SparkSession, sf_dir: str) -> tuple[G.Vault, DataFrame]:
    """A vault that knows every third user; all users are stored into it."""
    vault = G.Vault(SECRET)
    users = load(spark, sf_dir, "process_instance_history")
    entries = vault.entries(users, "start_user_id", TENANT, VERSION, "created_at")
    known = entries.filter(_two_digits(3) == 0).withColumn("first_seen_at", F.to_timestamp(F.lit(SEEN_BEFORE)))
    return vault, vault.store(known, entries)


def _two_digits(modulus: int):
    return F.conv(F.substring("pseudonym_token", 1, 2), 16, 10).cast("int") % modulus


def _requests(entries: DataFrame, granted) -> DataFrame:
    return entries.select("pseudonym_token", F.lit("auditor").alias("accessor_identity"), F.lit("complaint").alias("access_reason"), granted.alias("granted"))


def v1_vault(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users stored under tokens and found again; known ones keep their entry. Every second request is denied but audited."""
    vault, known = _vault(spark, sf_dir)
    answers, audit = vault.reidentify(known, _requests(known, _two_digits(2) == 0))
    return audit.join(answers, "pseudonym_token", "left").join(known.select("pseudonym_token", F.unix_millis("first_seen_at").alias("first_seen_ms")), "pseudonym_token").select("pseudonym_token", "granted", "user_id", "first_seen_ms")


def v1_deleted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deletions from the vault: what was asked, what was granted, what is left."""
    vault, known = _vault(spark, sf_dir)
    left, audit = vault.delete(known, _requests(known, _two_digits(5) == 1).filter(_two_digits(5) < 2))
    held = left.select("pseudonym_token", F.lit(True).alias("held"))
    return known.select("pseudonym_token").join(audit.select("pseudonym_token", "operation", "granted"), "pseudonym_token", "left").join(held, "pseudonym_token", "left").select("pseudonym_token", "operation", "granted", F.coalesce("held", F.lit(False)).alias("held"))


# --- reconciliation ----------------------------------------------------------------------------------------------------


def r1_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    here = current_instances(spark, sf_dir, "engine_id", "process_definition_key").filter("deleted_at is null")
    there = load(spark, sf_dir, "act_hi_procinst").select("engine_id", same_id("process_instance_id").alias("id"), "process_definition_key").groupBy("engine_id", "id").agg(F.min("process_definition_key").alias("process_definition_key"))
    return R.count_differences(here, there, ["engine_id"])


def _cycles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily comparisons from the event stream: the errors of a user's day are what differed."""
    e = load(spark, sf_dir, "events")
    day = F.datediff(F.col("ts"), F.lit("2024-01-01").cast("date"))
    c = e.groupBy((F.col("user_id") % 50).alias("unit"), day.alias("day")).agg(F.sum(F.when(F.col("event_type") == "error", 1).otherwise(0)).alias("diff"))
    return c.withColumn("critical", F.col("unit") % 3 == 0)


def r2_streaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.clean_streaks(_cycles(spark, sf_dir), ["unit"], "day", target=3, epsilon=1)


def _commands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log with every command and failed requests among the comparisons."""
    c = R.clean_streaks(_cycles(spark, sf_dir), ["unit"], "day", target=3, epsilon=1)
    d, n = F.col("day"), F.col("day") + F.col("unit")
    command = F.when(n % 5 == 4, "REQUEST").when(n % 23 == 7, "CONFIRM").when(n % 11 == 3, "REVERT").when(n % 29 == 5, "ROLLBACK").when(F.col("clean") | (n % 3 > 0), "CLEAN").otherwise("UNCLEAN")
    return c.select("unit", "day", command.alias("command"), (d % 2 == 0).alias("failed"))


def r3_commands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The final state of each unit under a log of comparisons and commands."""
    return R.fold_commands(_commands(spark, sf_dir), ["unit"], "day", target=2)


def r3_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every command with its outcome and the state after it."""
    return R.command_outcomes(_commands(spark, sf_dir), ["unit"], "day", target=2)


def r4_renamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = load(spark, sf_dir, "class_cutover_state").distinct()
    old = {v: k for k, v in R.OLD_STATE_NAMES.items()}
    spoiled = s.withColumn("state", F.coalesce(*[F.when((F.col("state") == n) & (F.length("id") > 0), F.lit(o)) for n, o in old.items()], F.col("state")))
    return R.renamed_states(spoiled).groupBy("state").agg(F.count(F.lit(1)).alias("n"))


# --- hand-off ----------------------------------------------------------------------------------------------------------


def s10_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return H.oldest_batch(load(spark, sf_dir, "compact_history_outbox"), "eng-alder", "arrival_no").select("arrival_no", "history_event_id", F.unix_millis("created_at").alias("created_ms"))


def a4_age(spark: SparkSession, sf_dir: str) -> DataFrame:
    return H.age(load(spark, sf_dir, "outbound_message_outbox"), _now())


def k7_relayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stays after two of three rows of every engine but one were acknowledged."""
    o = load(spark, sf_dir, "outbound_message_outbox")
    acked = o.filter((F.col("engine_id") != "eng-elm") & (F.col("arrival_no") % 3 > 0))
    return H.relayed(o, acked, "arrival_no").groupBy("engine_id").agg(F.count(F.lit(1)).alias("n"))


def jn10_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outbox rows with their large payload."""
    p = load(spark, sf_dir, "projection_large_payload").select(same_id("id").alias("id"), "payload_bytes")
    o = load(spark, sf_dir, "compact_history_outbox").withColumn("payload_large_ref", same_id("payload_large_ref"))
    return H.with_payload(o, p).select("arrival_no", F.octet_length("payload_bytes").cast("long").alias("n_bytes"))


def jn13_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads that the rows of an outbox still need; the ledger's references stand for the outbox's, which name other ids."""
    p = load(spark, sf_dir, "projection_large_payload").select(same_id("id").alias("id")).distinct()
    o = load(spark, sf_dir, "runtime_large_variable_ref").filter(F.col("engine_id") != "eng-elm").select(same_id("payload_id").alias("payload_large_ref"))
    return H.surviving_payloads(p, o)


def h1_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = load(spark, sf_dir, "compact_history_outbox").select("history_class").unionByName(load(spark, sf_dir, "variable_detail_history").select(F.when(F.col("revision") % 2 == 0, "DETAIL").alias("history_class")))
    return H.history_path(e, cut_over=("DETAIL", "INCIDENT")).groupBy("history_class", "path", "also_engine").agg(F.count(F.lit(1)).alias("n"))


def h2_outbound(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outbound types with their dots as underscores in every second message: only those make a subject."""
    o = load(spark, sf_dir, "outbound_message_outbox").withColumn("message_type", F.when(F.col("arrival_no") % 2 == 0, F.translate("message_type", ".", "_")).otherwise(F.col("message_type")))
    critical = [t.replace(".", "_") for t in CRITICAL_TYPES]
    return H.outbound_path(o, critical).groupBy("message_type", "path").agg(F.count(F.lit(1)).alias("n"))


def k6_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = load(spark, sf_dir, "outbound_message_outbox").select(same_id("id").alias("id"), "engine_id", F.translate("message_type", ".", "_").alias("message_type"), same_id("process_instance_id").alias("process_instance_id"), "business_key", "trace_id").distinct()
    return H.outbound_messages(o)


def _tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = current_activities(spark, sf_dir, "process_instance_id", "activity_id", "activity_type", "start_time", "end_time", "stream_sequence").filter((F.col("activity_type") == "externalTask") & F.col("deleted_at").isNull())
    locked = F.when(F.col("stream_sequence") % 3 != 0, F.col("end_time"))
    return a.select(F.col("activity_instance_id").alias("task_id"), F.col("activity_id").alias("topic"), F.when(F.col("stream_sequence") % 4 != 0, F.col("process_instance_id")).alias("business_key"), F.create_map(F.lit("b"), F.col("activity_id"), F.lit("a"), F.lit("1"), F.lit("c"), F.lit(None).cast("string")).alias("variables"), locked.alias("lock_expires_at"), (F.col("stream_sequence") % 5).cast("int").alias("retries"), (F.col("stream_sequence") % 7 == 0).alias("suspended"))


def h3_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return H.job_messages(_tasks(spark, sf_dir), ["a", "b", "missing"])


def h4_expired(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = F.to_timestamp(F.lit("2025-10-01 00:00:00"))
    return H.expired_locks(_tasks(spark, sf_dir), ["extPost"], cut).select("task_id", "retries")


def _replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = load(spark, sf_dir, "events")
    kind = F.when(F.col("event_type") == "error", '"BPMN_ERROR"').when(F.col("event_type") == "view", '" SUCCESS "').when(F.col("event_type") == "click", '"TRANSIENT"').otherwise('"success"')
    body = F.concat(F.lit('{"x":{"type":"SUCCESS"},"type":'), kind, F.when(F.col("event_id") % 2 == 0, F.concat(F.lit(',"retries":'), F.col("event_id") % 5)).otherwise(F.lit("")), F.when(F.col("event_id") % 41 == 0, F.lit("")).otherwise(F.lit("}")))
    return e.select("event_id", body.alias("body"))


def j1_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return H.reply_actions(_replies(spark, sf_dir), "body").groupBy("action", "reply_type", "retries").agg(F.count(F.lit(1)).alias("n"))


def f13_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first text after a field's name, beside what a parser says: the scan finds the nested one."""
    r = _replies(spark, sf_dir).select(S.first_text_after(F.col("body"), "type").alias("scanned"), S.json_text(F.col("body"), "type").alias("parsed"))
    return r.groupBy("scanned", "parsed").agg(F.count(F.lit(1)).alias("n"))


def _dead(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = load(spark, sf_dir, "outbound_message_outbox")
    subject = F.when(F.col("arrival_no") % 3 == 0, F.concat(F.lit("jobs."), F.col("message_type"))).when(F.col("arrival_no") % 3 == 1, F.concat(F.lit("in."), F.col("message_type"))).otherwise(F.concat(F.lit("else."), F.col("message_type")))
    return o.select(subject.alias("original_subject"), F.concat(same_id("id"), F.lit(".dlq")).alias("message_id"), F.lit("BUDGET").alias("reason"))


def h5_incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return H.incidents(_dead(spark, sf_dir)).groupBy("task_id", "reason", "retries").agg(F.count(F.lit(1)).alias("n"))


def h6_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    channels = spark.createDataFrame([(f"in.{t}", f"channel-{t}") for t in ("payment.requested", "notice.sent", "claim.accepted")], "subject string, channel string")
    return H.failure_events(_dead(spark, sf_dir), channels).groupBy("original_subject", "channel", "action").agg(F.count(F.lit(1)).alias("n"))


# --- profiling and small functions -------------------------------------------------------------------------------------


def _statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = load(spark, sf_dir, "events")
    n = F.col("event_id") % 6
    text = F.when(n == 0, "INSERT INTO ACT_HI_ACTINST VALUES ($1)").when(n == 1, "insert into ACT_RU_EXT_TASK values ($1)").when(n == 2, "DELETE FROM act_ru_ext_task WHERE id_ = $1").when(n == 3, "select * from act_ru_ext_task where TOPIC_NAME_ = $1 and LOCK_EXP_TIME_ < $2").when(n == 4, "update act_ru_ext_task set retries_ = $1, lock_exp_time_ = $2").otherwise("UPDATE act_hi_procinst SET state_ = $1")
    return e.select(F.col("event_id").alias("query_id"), text.alias("query"), (F.col("event_id") % 10).alias("calls"))


def a8_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.profile(_statements(spark, sf_dir))


def a9_engine_writes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.writes_to(_statements(spark, sf_dir), " act_hi_")


def s13_statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.statements_like(_statements(spark, sf_dir), "%ACT_HI%")


def a10_stored_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger = latest(load(spark, sf_dir, "runtime_large_variable_ref").select("engine_id", same_id("variable_id").alias("variable_id"), same_id("payload_id").alias("payload_id"), "updated_at"), ["engine_id", "variable_id"], "updated_at", ["payload_id"])
    return P.stored_share(ledger, load(spark, sf_dir, "projection_large_payload").withColumn("id", same_id("id")))


def a12_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.counters(load(spark, sf_dir, "variable_detail_history"), ["engine_id", "event_type", "variable_type"])


def t9_tripped(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = load(spark, sf_dir, "events").select("user_id", "event_id", F.col("event_type").isin("error", "view", "click").alias("failed"))
    return P.tripped(e, ["user_id"], "event_id").filter("tripped").select("user_id", "event_id")


def f26_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = load(spark, sf_dir, "procinst_change_feed")
    return f.groupBy("delivery_count").agg(F.count(F.lit(1)).alias("n")).withColumn("wait_s", S.backoff_seconds(F.col("delivery_count")))


def f27_lock(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lock floors for several numbers of attempts; attempts and waits are taken from the parts' sizes."""
    p = load(spark, sf_dir, "part").select((F.col("p_size") % 9).alias("attempts"), (F.col("p_size") % 4 * 10).alias("wait")).distinct()
    return p.select("attempts", "wait", S.lock_floor(F.col("attempts"), F.col("wait"), F.lit(120), F.lit(60)).cast("long").alias("floor_s"))


def f17_subjects(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = load(spark, sf_dir, "outbound_message_outbox")
    t = F.when(F.col("arrival_no") % 2 == 0, F.translate("message_type", ".", "_")).otherwise(F.col("message_type"))
    s = o.select("arrival_no", S.outbound_subject(F.col("engine_id"), t, same_id("process_instance_id")).alias("built"), F.col("subject"))
    return s.select("arrival_no", "built", S.reserved_namespace(F.col("subject")).alias("reserved"), S.class_of_subject(F.col("subject")).alias("third_part"), S.dlq_subject(F.col("subject")).alias("dlq"))


def f32_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = load(spark, sf_dir, "part")
    text = F.when(F.col("p_partkey") % 5 == 0, F.concat(F.lit("P"), F.col("p_size"), F.lit("Y2M3D"))).when(F.col("p_partkey") % 5 == 1, F.concat(F.lit("P"), F.col("p_size"), F.lit("D"))).when(F.col("p_partkey") % 5 == 2, F.concat(F.lit("P"), F.col("p_size"), F.lit("W"))).when(F.col("p_partkey") % 5 == 3, F.lit("P7Y")).otherwise(F.lit("seven years"))
    return p.select("p_partkey", S.period_days(text).alias("days"))


def f33_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = load(spark, sf_dir, "part").select("p_partkey", F.format_string("FOR VALUES FROM ('2025-01-01 00:00:00+00') TO ('2025-%02d-01 00:00:00+00')", 1 + F.col("p_partkey") % 14).alias("text"))
    p = p.withColumn("text", F.when(F.col("p_partkey") % 9 == 0, F.lit("DEFAULT")).otherwise(F.col("text")))
    return p.select("p_partkey", F.unix_millis(S.bound_in(F.col("text"))).alias("upper_ms"))


QUERIES = {
    f.__name__: f
    for f in (
        s14_partitions, g1_due, g1_surviving, g4_case_groups, g4_scope, g6_anonymised, g8_leftovers, g9_audit, f22_tokens, f23_pseudonymised, v1_vault, v1_deleted, r1_differences, r2_streaks, r3_commands, r3_outcomes, r4_renamed, s10_batch, a4_age,
        k7_relayed, jn10_payloads, jn13_payloads, h1_paths, h2_outbound, k6_messages, h3_jobs, h4_expired, j1_replies, f13_scan, h5_incidents, h6_failures, a8_profile, a9_engine_writes, s13_statements, a10_stored_share, a12_counters,
        t9_tripped, f26_backoff, f27_lock, f17_subjects, f32_periods, f33_bounds,
    )
}

_NOW = f"TIMESTAMPTZ '{AS_OF}+00'"
_MONTHS = """m AS (SELECT 'PROCINST' AS history_class, date_trunc('month', partition_anchor_at AT TIME ZONE 'UTC') AS m, count(*) AS n_rows FROM process_instance_history WHERE partition_anchor_at IS NOT NULL GROUP BY 1, 2
 UNION ALL SELECT 'ACTINST', date_trunc('month', partition_anchor_at AT TIME ZONE 'UTC'), count(*) FROM activity_instance_history WHERE partition_anchor_at IS NOT NULL GROUP BY 1, 2
 UNION ALL SELECT 'DETAIL', date_trunc('month', event_time AT TIME ZONE 'UTC'), count(*) FROM variable_detail_history WHERE event_time IS NOT NULL GROUP BY 1, 2)"""
_SUB = f"""i AS (SELECT pid, r.engine_id || '/' || u AS subject, r.start_time AS s FROM {_PI} p JOIN (SELECT {_id("process_instance_id")} AS pid, arg_max_null(start_user_id, stream_sequence) AS u FROM process_instance_history GROUP BY 1) USING (pid)
 WHERE r.deleted_at IS NULL AND r.business_key <> '' AND coalesce(u, '') <> ''),
l AS (SELECT *, last_value(s IGNORE NULLS) OVER (PARTITION BY subject ORDER BY s ASC NULLS LAST, pid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS b FROM i)"""
_GROUPS = "g AS (SELECT subject, pid, CAST(sum(CASE WHEN epoch_us(s) - epoch_us(b) > {0} * 86400000000 THEN 1 ELSE 0 END) OVER (PARTITION BY subject ORDER BY s ASC NULLS LAST, pid ROWS UNBOUNDED PRECEDING) AS BIGINT) AS case_group FROM l)"
_ACT = f"a AS (SELECT {_id('activity_instance_id')} AS aid, arg_max(struct_pack(pid := {_id('process_instance_id')}, u := task_assignee, an := anonymized_at, d := deleted_at, t := activity_type, k := activity_id, e := end_time, q := stream_sequence), stream_sequence) AS r FROM activity_instance_history GROUP BY 1)"
_SCOPE = f"sc AS (SELECT pid FROM {_PI} WHERE r.process_definition_key = 'dunning-run')"
_HIT = "h AS (SELECT aid, r, r.d IS NULL AND r.pid IN (SELECT pid FROM sc) AS hit FROM a)"
_INNER, _OUTER = S._pads(f"{TENANT}:{VERSION}".encode())
_HMAC = f"sha256(unhex('{_OUTER}') || unhex(sha256(unhex('{_INNER}') || encode({{0}}))))"
_VAULT = f"""u AS (SELECT start_user_id AS u, epoch_us(min(created_at)) // 1000 AS ms FROM process_instance_history WHERE coalesce(trim(start_user_id), '') <> '' GROUP BY 1),
 t AS (SELECT *, CAST('0x' || substr(k, 1, 2) AS INTEGER) AS x FROM (SELECT u, ms, {_HMAC.format('u')} AS k FROM u))"""
_CYC = """c AS (SELECT user_id % 50 AS unit, CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS INTEGER) AS day, sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS diff, (user_id % 50) % 3 = 0 AS critical FROM events GROUP BY ALL),
x AS (SELECT *, coalesce(lag(diff) OVER (PARTITION BY unit ORDER BY day), 0) AS p FROM c), y AS (SELECT *, CASE WHEN critical THEN diff = 0 ELSE diff <= 1 AND (diff <= p OR p = 0) END AS clean FROM x),
z AS (SELECT *, sum(CASE WHEN clean THEN 0 ELSE 1 END) OVER (PARTITION BY unit ORDER BY day) AS isl FROM y), s AS (SELECT *, sum(CASE WHEN clean THEN 1 ELSE 0 END) OVER (PARTITION BY unit, isl ORDER BY day) AS streak FROM z)"""
_FOLD = f"""WITH RECURSIVE {_CYC}, cmd AS (SELECT unit, day, day % 2 = 0 AS failed, CASE WHEN (day + unit) % 5 = 4 THEN 'REQUEST' WHEN (day + unit) % 23 = 7 THEN 'CONFIRM' WHEN (day + unit) % 11 = 3 THEN 'REVERT' WHEN (day + unit) % 29 = 5 THEN 'ROLLBACK'
  WHEN clean OR (day + unit) % 3 > 0 THEN 'CLEAN' ELSE 'UNCLEAN' END AS command, row_number() OVER (PARTITION BY unit ORDER BY day) AS n FROM s),
f AS (SELECT unit, CAST(NULL AS INTEGER) AS day, CAST(NULL AS VARCHAR) AS command, CAST(NULL AS VARCHAR) AS outcome, 'DUAL_RUN' AS state, 0 AS streak, 0 AS rollbacks, CAST(0 AS BIGINT) AS n FROM (SELECT DISTINCT unit FROM cmd)
 UNION ALL SELECT f.unit, c.day, c.command, CASE WHEN c.command = 'REQUEST' THEN CASE WHEN f.state <> 'CLEAN_STREAK' THEN 'GATE_NOT_MET' WHEN c.failed THEN 'APPLY_FAILED' ELSE 'REQUESTED' END END,
  CASE WHEN c.command = 'CLEAN' THEN CASE WHEN f.state = 'CUTOVER_APPLIED' THEN f.state WHEN f.streak + 1 >= 2 THEN 'CLEAN_STREAK' ELSE 'RECONCILING' END WHEN c.command = 'UNCLEAN' THEN CASE WHEN f.state = 'CUTOVER_APPLIED' THEN f.state ELSE 'DUAL_RUN' END
   WHEN c.command = 'REQUEST' THEN CASE WHEN f.state = 'CLEAN_STREAK' AND NOT c.failed THEN 'CUTOVER_REQUESTED' ELSE f.state END WHEN c.command = 'CONFIRM' THEN 'CUTOVER_APPLIED' WHEN c.command = 'REVERT' THEN 'CLEAN_STREAK' ELSE 'DUAL_RUN' END,
  CASE WHEN c.command = 'ROLLBACK' THEN 0 WHEN f.state = 'CUTOVER_APPLIED' THEN f.streak WHEN c.command = 'CLEAN' THEN f.streak + 1 WHEN c.command = 'UNCLEAN' THEN 0 ELSE f.streak END,
  f.rollbacks + CASE WHEN c.command = 'ROLLBACK' THEN 1 ELSE 0 END, c.n FROM f JOIN cmd c ON f.unit = c.unit AND c.n = f.n + 1)"""
_PAY = f"p AS (SELECT {_id('id')} AS id, any_value(payload_bytes) AS bytes, any_value(content_hash) AS h FROM projection_large_payload GROUP BY 1)"
_TASKS = f"{_ACT}, t AS (SELECT aid, r.k AS topic, CASE WHEN r.q % 4 <> 0 THEN r.pid END AS bk, CASE WHEN r.q % 3 <> 0 THEN r.e END AS lock, CAST(r.q % 5 AS INTEGER) AS retries, r.q % 7 = 0 AS susp FROM a WHERE r.t = 'externalTask' AND r.d IS NULL)"
_REPLY = """r AS (SELECT event_id, CASE event_type WHEN 'error' THEN 'BPMN_ERROR' WHEN 'view' THEN ' SUCCESS ' WHEN 'click' THEN 'TRANSIENT' ELSE 'success' END AS t, event_id % 41 = 0 AS broken, CASE WHEN event_id % 2 = 0 THEN event_id % 5 END AS n FROM events)"""
_STAT = """st AS (SELECT event_id AS query_id, event_id % 10 AS calls, CASE event_id % 6 WHEN 0 THEN 'INSERT INTO ACT_HI_ACTINST VALUES ($1)' WHEN 1 THEN 'insert into ACT_RU_EXT_TASK values ($1)' WHEN 2 THEN 'DELETE FROM act_ru_ext_task WHERE id_ = $1'
 WHEN 3 THEN 'select * from act_ru_ext_task where TOPIC_NAME_ = $1 and LOCK_EXP_TIME_ < $2' WHEN 4 THEN 'update act_ru_ext_task set retries_ = $1, lock_exp_time_ = $2' ELSE 'UPDATE act_hi_procinst SET state_ = $1' END AS query, event_id % 6 AS k FROM events)"""
_DEAD = f"d AS (SELECT CASE arrival_no % 3 WHEN 0 THEN 'jobs.' WHEN 1 THEN 'in.' ELSE 'else.' END || message_type AS original_subject, {_id('id')} AS id FROM outbound_message_outbox)"

ORACLE = {
    "s14_partitions": f"WITH {_MONTHS} SELECT history_class, strftime(m, '%Y-%m') AS month, epoch_us(m + INTERVAL 1 MONTH) // 1000 AS upper_ms, n_rows FROM m",
    "g1_due": f"WITH {_MONTHS}, w AS (SELECT *, CASE WHEN history_class = 'PROCINST' THEN 365 ELSE 90 END AS window_days FROM m) SELECT history_class, strftime(m, '%Y-%m') AS month, n_rows, window_days, 'DROP_PARTITION' AS action, CAST(NULL AS VARCHAR) AS legal_basis FROM w WHERE m + INTERVAL 1 MONTH < TIMESTAMP '{AS_OF}' - to_days(window_days)",
    "g1_surviving": f"SELECT engine_id, count(*) AS n FROM activity_instance_history WHERE NOT coalesce(date_trunc('month', partition_anchor_at AT TIME ZONE 'UTC') + INTERVAL 1 MONTH < TIMESTAMP '{AS_OF}' - INTERVAL 365 DAY, FALSE) GROUP BY 1",
    "g4_case_groups": f"WITH {_SUB}, {_GROUPS.format(30)} SELECT subject, pid AS process_instance_id, case_group FROM g",
    "g4_scope": f"WITH {_SUB}, {_GROUPS.format(90)} SELECT subject, count(*) AS n_instances, max(case_group) + 1 AS n_groups, CASE WHEN max(case_group) > 0 THEN 'CONFIRMATION_REQUIRED' ELSE 'RESOLVED' END AS outcome FROM g GROUP BY 1",
    "g6_anonymised": f"WITH {_ACT}, {_SCOPE}, {_HIT} SELECT aid AS activity_instance_id, CASE WHEN NOT hit THEN r.u END AS task_assignee, CASE WHEN hit THEN epoch_ms({_NOW}) ELSE epoch_us(r.d) // 1000 END AS deleted_ms, CASE WHEN hit THEN epoch_ms({_NOW}) ELSE epoch_us(r.an) // 1000 END AS anonymized_ms, hit AS affected FROM h",
    "g8_leftovers": f"WITH {_ACT}, {_SCOPE} SELECT aid AS activity_instance_id, r.u AS task_assignee FROM a WHERE r.pid IN (SELECT pid FROM sc) AND r.d IS NOT NULL AND r.u IS NOT NULL",
    "g9_audit": f"""WITH {_ACT}, {_SCOPE}, {_HIT} SELECT 'req-1' AS request_id, 'subject-1' AS subject_key, 'activity_instance_history' AS target_table, 'ANONYMIZE' AS action, count(*) FILTER (WHERE hit) AS affected_row_count FROM h
 UNION ALL SELECT 'req-1', 'subject-1', 'process_instance_history', 'ANONYMIZE', (SELECT count(*) FROM {_PI} WHERE r.deleted_at IS NULL AND pid IN (SELECT pid FROM sc))""",
    "f22_tokens": f"SELECT DISTINCT start_user_id, {_HMAC.format('start_user_id')} AS token FROM process_instance_history WHERE coalesce(start_user_id, '') <> ''",
    "f23_pseudonymised": f"""WITH o AS (SELECT arrival_no, payload_scalar->>'$.userId' AS u, history_class = 'OP_LOG' AND coalesce(trim(payload_scalar->>'$.userId'), '') <> '' AS h FROM compact_history_outbox)
 SELECT arrival_no, CASE WHEN NOT h THEN u END AS user_id, CASE WHEN h THEN 'true' END AS flag, CASE WHEN h THEN {_HMAC.format('u')} END AS token FROM o""",
    "v1_vault": f"""WITH {_VAULT} SELECT k AS pseudonym_token, x % 2 = 0 AS granted, CASE WHEN x % 2 = 0 THEN u END AS user_id, CASE WHEN x % 3 = 0 THEN epoch_ms(TIMESTAMPTZ '{SEEN_BEFORE}+00') ELSE ms END AS first_seen_ms FROM t""",
    "v1_deleted": f"""WITH {_VAULT} SELECT k AS pseudonym_token, CASE WHEN x % 5 < 2 THEN 'DELETE' END AS operation, CASE WHEN x % 5 < 2 THEN x % 5 = 1 END AS granted, x % 5 <> 1 AS held FROM t""",
    "r1_differences": f"""WITH a AS (SELECT r.engine_id AS engine_id, count(*) AS n FROM {_PI} WHERE r.deleted_at IS NULL GROUP BY 1), b AS (SELECT engine_id, count(DISTINCT {_id("process_instance_id")}) AS n FROM act_hi_procinst GROUP BY 1)
 SELECT engine_id, coalesce(a.n, 0) AS n_here, coalesce(b.n, 0) AS n_there, abs(coalesce(a.n, 0) - coalesce(b.n, 0)) AS diff FROM a FULL JOIN b USING (engine_id)""",
    "r2_streaks": f"WITH {_CYC} SELECT unit, day, CAST(diff AS BIGINT) AS diff, critical, clean, CAST(streak AS BIGINT) AS streak, CASE WHEN NOT clean THEN 'DUAL_RUN' WHEN streak >= 3 THEN 'CLEAN_STREAK' ELSE 'RECONCILING' END AS state FROM s",
    "r3_commands": _FOLD + " SELECT unit, arg_max(state, n) AS state, arg_max(streak, n) AS streak, arg_max(rollbacks, n) AS rollbacks FROM f GROUP BY 1",
    "r3_outcomes": _FOLD + " SELECT unit, day, command, outcome, state, streak, rollbacks FROM f WHERE n > 0",
    "r4_renamed": "SELECT state, count(*) AS n FROM (SELECT DISTINCT * FROM class_cutover_state) GROUP BY 1",
    "s10_batch": "SELECT arrival_no, history_event_id, epoch_us(created_at) // 1000 AS created_ms FROM compact_history_outbox WHERE engine_id = 'eng-alder' ORDER BY created_at ASC NULLS LAST, arrival_no LIMIT 500",
    "a4_age": f"SELECT engine_id, count(*) AS n_rows, coalesce((epoch_us({_NOW}) - epoch_us(min(created_at))) / 1e6, 0.0) AS age_s, coalesce((epoch_us({_NOW}) - epoch_us(min(created_at))) / 1e6, 0.0) > 150 AS stuck FROM outbound_message_outbox GROUP BY 1",
    "k7_relayed": "SELECT engine_id, count(*) AS n FROM outbound_message_outbox WHERE NOT (engine_id <> 'eng-elm' AND arrival_no % 3 > 0) GROUP BY 1",
    "jn10_payloads": f"WITH {_PAY} SELECT arrival_no, CAST(octet_length(bytes) AS BIGINT) AS n_bytes FROM compact_history_outbox LEFT JOIN p ON {_id('payload_large_ref')} = p.id",
    "jn13_payloads": f"SELECT DISTINCT {_id('id')} AS id FROM projection_large_payload WHERE {_id('id')} IN (SELECT {_id('payload_id')} FROM runtime_large_variable_ref WHERE engine_id <> 'eng-elm' AND payload_id IS NOT NULL)",
    "h1_paths": """WITH e AS (SELECT history_class FROM compact_history_outbox UNION ALL SELECT CASE WHEN revision % 2 = 0 THEN 'DETAIL' END FROM variable_detail_history)
 SELECT history_class, CASE WHEN history_class IN ('OP_LOG', 'INCIDENT', 'EXT_TASK_LOG') THEN 'OUTBOX' ELSE 'POST_COMMIT' END AS path, coalesce(history_class, '') NOT IN ('DETAIL', 'INCIDENT') AS also_engine, count(*) AS n FROM e GROUP BY 1, 2, 3""",
    "h2_outbound": """WITH o AS (SELECT CASE WHEN arrival_no % 2 = 0 THEN replace(message_type, '.', '_') ELSE message_type END AS message_type FROM outbound_message_outbox)
 SELECT message_type, CASE WHEN contains(message_type, '.') THEN 'SKIP' WHEN message_type IN ('payment_requested', 'limit_changed') THEN 'OUTBOX' ELSE 'POST_COMMIT' END AS path, count(*) AS n FROM o GROUP BY 1, 2""",
    "k6_messages": f"""WITH o AS (SELECT DISTINCT {_id("id")} AS id, engine_id, replace(message_type, '.', '_') AS t, {_id("process_instance_id")} AS pid, business_key AS b, trace_id AS tr FROM outbound_message_outbox)
 SELECT 'events.' || engine_id || '.' || t || '.' || pid AS subject, id AS message_id, '{{"type":"' || t || '"' || coalesce(',"traceId":"' || tr || '"', '') || CASE WHEN coalesce(trim(b), '') = '' THEN '' ELSE ',"businessKey":"' || b || '"' END || '}}' AS body FROM o""",
    "h3_jobs": f"""WITH {_TASKS} SELECT 'jobs.' || topic AS subject, aid AS message_id, '{{"taskId":"' || aid || '","businessKey":"' || coalesce(bk, '') || '","variables":{{"a":"1","b":"' || topic || '"}}}}' AS body FROM t""",
    "h4_expired": f"WITH {_TASKS} SELECT aid AS task_id, retries FROM t WHERE topic = 'extPost' AND (lock IS NULL OR lock < TIMESTAMPTZ '2025-10-01 00:00:00+00') AND retries > 0 AND NOT susp",
    "j1_replies": f"""WITH {_REPLY}, k AS (SELECT CASE WHEN NOT broken AND trim(t) IN ('SUCCESS', 'BPMN_ERROR', 'TRANSIENT') THEN trim(t) END AS reply_type, CASE WHEN broken THEN 0 ELSE coalesce(n, 0) END AS retries FROM r)
 SELECT CASE reply_type WHEN 'SUCCESS' THEN 'COMPLETE' WHEN 'BPMN_ERROR' THEN 'RAISE_ERROR' WHEN 'TRANSIENT' THEN 'REPORT_FAILURE' ELSE 'DEAD_LETTER' END AS action, reply_type, CAST(retries AS INTEGER) AS retries, count(*) AS n FROM k GROUP BY 1, 2, 3""",
    "f13_scan": f"WITH {_REPLY} SELECT 'SUCCESS' AS scanned, CASE WHEN NOT broken THEN t END AS parsed, count(*) AS n FROM r GROUP BY 1, 2",
    "h5_incidents": f"WITH {_DEAD} SELECT id AS task_id, 'BUDGET' AS reason, 0 AS retries, count(*) AS n FROM d WHERE starts_with(original_subject, 'jobs.') GROUP BY 1",
    "h6_failures": f"""WITH {_DEAD}, c AS (SELECT original_subject, CASE WHEN original_subject IN ('in.payment.requested', 'in.notice.sent', 'in.claim.accepted') THEN 'channel-' || substr(original_subject, 4) END AS channel FROM d WHERE NOT starts_with(original_subject, 'jobs.'))
 SELECT original_subject, channel, CASE WHEN channel IS NULL THEN 'NAK' ELSE 'EMIT' END AS action, count(*) AS n FROM c GROUP BY 1, 2, 3""",
    "a8_profile": f"WITH {_STAT} SELECT CAST(sum(CASE WHEN k = 1 THEN calls ELSE 0 END) AS BIGINT) AS insert, CAST(sum(CASE WHEN k = 2 THEN calls ELSE 0 END) AS BIGINT) AS delete, CAST(sum(CASE WHEN k = 3 THEN calls ELSE 0 END) AS BIGINT) AS poll, CAST(sum(CASE WHEN k = 4 THEN calls ELSE 0 END) AS BIGINT) AS fetch_lock, CAST(sum(CASE WHEN k IN (0, 5) THEN calls ELSE 0 END) AS BIGINT) AS other FROM st",
    "a9_engine_writes": f"WITH {_STAT} SELECT CAST(sum(calls) AS BIGINT) AS write_ops FROM st WHERE k IN (0, 5)",
    "s13_statements": f"WITH {_STAT} SELECT query_id, query, calls FROM st WHERE query ILIKE '%ACT_HI%'",
    "a10_stored_share": f"""WITH {_PAY}, l AS (SELECT engine_id, {_id("variable_id")} AS v, arg_max({_id("payload_id")}, updated_at) AS pid FROM runtime_large_variable_ref GROUP BY 1, 2), u AS (SELECT h, octet_length(bytes) AS n FROM l JOIN p ON l.pid = p.id),
 o AS (SELECT sum(n) AS e, max(n) AS c FROM u GROUP BY h) SELECT CAST(sum(e) AS BIGINT) AS naive_bytes, CAST(sum(c) AS BIGINT) AS stored_bytes, sum(c) < 0.5 * sum(e) AS below_half FROM o""",
    "a12_counters": "SELECT engine_id, event_type, variable_type, count(*) AS n FROM variable_detail_history GROUP BY 1, 2, 3",
    "t9_tripped": "SELECT user_id, event_id FROM (SELECT user_id, event_id, count(*) OVER w AS n, sum(CASE WHEN event_type IN ('error', 'view', 'click') THEN 1 ELSE 0 END) OVER w AS f FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)) WHERE n = 5 AND f = 5",
    "f26_backoff": "SELECT delivery_count, count(*) AS n, CAST(least(30, pow(2, greatest(0, delivery_count - 1))) AS BIGINT) AS wait_s FROM procinst_change_feed GROUP BY 1",
    "f27_lock": "WITH p AS (SELECT DISTINCT p_size % 9 AS attempts, p_size % 4 * 10 AS wait FROM part) SELECT attempts, wait, CAST(attempts * wait + coalesce((SELECT sum(least(30, pow(2, n - 1))) FROM range(1, 9) t(n) WHERE n < attempts), 0) + 180 AS BIGINT) AS floor_s FROM p",
    "f17_subjects": f"""SELECT arrival_no, CASE WHEN arrival_no % 2 = 0 THEN 'events.' || engine_id || '.' || replace(message_type, '.', '_') || '.' || {_id("process_instance_id")} END AS built, CASE WHEN starts_with(subject, 'events.') THEN 'events.' END AS reserved,
 coalesce(split_part(subject, '.', 3), 'UNKNOWN') AS third_part, 'dlq.' || subject AS dlq FROM outbound_message_outbox""",
    "f32_periods": "SELECT p_partkey, CAST(CASE p_partkey % 5 WHEN 0 THEN p_size * 365 + 63 WHEN 1 THEN p_size WHEN 2 THEN p_size * 7 WHEN 3 THEN 2555 END AS BIGINT) AS days FROM part",
    "f33_bounds": "SELECT p_partkey, CASE WHEN p_partkey % 9 <> 0 AND p_partkey % 14 < 12 THEN epoch_ms(make_timestamp(2025, CAST(1 + p_partkey % 14 AS INTEGER), 1, 0, 0, 0)) END AS upper_ms FROM part",
}
