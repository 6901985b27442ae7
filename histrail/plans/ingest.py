"""Queries of ingest and materialisation, and their SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import scalar as S
from ..operators import envelope, materialise
from ..operators.changes import KEYS_PER_BUCKET, BucketedTable
from ..schemas import CLASSES, ENTITY_CLASSES
from ..session import materialise as store
from ..session import scratch, shuffle_width
from ..sources import messages as sources
from ..streaming.pipeline import HistoryPipeline
from ..tables import latest, load, same_id
from .quality import _id


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The history outbox as events; some are spoiled by their arrival number, so that every fault occurs at every size."""
    o = load(spark, sf_dir, "compact_history_outbox")
    n = F.col("arrival_no")
    return o.select(
        F.when(n % 97 == 0, F.lit(" ")).otherwise(F.col("engine_id")).alias("engine_id"),
        F.when(n % 53 == 0, F.lit("NO_SUCH_CLASS")).otherwise(F.col("history_class")).alias("history_class"),
        "event_type", same_id("history_event_id").alias("history_event_id"), same_id("process_instance_id").alias("process_instance_id"), "business_key", "event_time",
        F.when(n % 83 == 0, F.lit("{broken")).otherwise(F.col("payload_scalar")).alias("body"),
        n.alias("stream_sequence"), (1 + n % 7).cast("int").alias("delivery_count"), n.alias("arrival_no"),
    )


def _routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    wire = envelope.encode(_events(spark, sf_dir))
    return envelope.route(envelope.parse(wire), failed=F.col("stream_sequence") % 11 == 0)


def f1_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _routed(spark, sf_dir)
    return r.groupBy("route", "reason").agg(F.count(F.lit(1)).alias("n"), F.sum("retry_after_s").alias("wait_s"))


def f2_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    return envelope.parse(envelope.encode(_events(spark, sf_dir))).groupBy("drift").agg(F.count(F.lit(1)).alias("n"))


def f4_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The operation-log rows of sound messages, by column."""
    r = _routed(spark, sf_dir).filter((F.col("route") == "log") & (F.col("history_class") == "OP_LOG"))
    return materialise.log_rows(r, "OP_LOG").select("engine_id", "history_event_id", "event_type", "stream_sequence", "user_id", "operation_type", "property", "org_value", "new_value", "user_id_pseudonymized", "legal_hold")


def f10_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What an encoded message says after parsing."""
    p = envelope.parse(envelope.encode(_events(spark, sf_dir))).filter("drift is null")
    return p.select("subject", "history_event_id", "event_type", F.unix_millis("event_time").alias("event_ms"), "business_key", F.size("fields").cast("long").alias("n_fields"), "seq")


def f11_large_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Large payloads on the wire: kept by one class, dropped by the others."""
    e = _events(spark, sf_dir).withColumn("large", F.when(F.col("arrival_no") % 5 == 0, F.encode(F.repeat("history_event_id", 3), "UTF-8")))
    p = envelope.large_payloads(envelope.parse(envelope.encode(e)).filter("drift is null"))
    return p.groupBy("history_class").agg(F.count(F.lit(1)).alias("n"), F.count("payload").alias("n_kept"), F.coalesce(F.sum(F.octet_length("payload")), F.lit(0)).cast("long").alias("n_bytes"), F.min("payload_hash").alias("least_hash"))


def k3_dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return envelope.dead_letters(_routed(spark, sf_dir)).select("dlq_subject", "class_tag", "reason", "message_id", "delivery_count")


def s7_dead_letter_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return envelope.dead_letters(_routed(spark, sf_dir)).groupBy("class_tag", "reason").agg(F.count(F.lit(1)).alias("n"), F.max("delivery_count").alias("most_deliveries"))


def t1_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = load(spark, sf_dir, "activity_instance_history").select(envelope.partition_of(same_id("process_instance_id"), 8).alias("part"))
    return p.groupBy("part").agg(F.count(F.lit(1)).alias("n"))


def _feed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The change feed with bodies: a key is in the body when its value isn't null, and in an end or migration in any case."""
    f = load(spark, sf_dir, "procinst_change_feed")
    always = F.col("event_type") == "migrate"
    pairs = [F.when(F.col(c).isNotNull() | (always if c == "business_key" else F.lit(False)), F.struct(F.lit(w).alias("key"), v.alias("value"))) for w, c, v in (("state", "state", F.col("state")), ("businessKey", "business_key", F.col("business_key")), ("endTime", "end_time", F.unix_millis("end_time").cast("string")))]
    body = F.map_from_entries(F.filter(F.array(*pairs), lambda x: x.isNotNull()))
    return f.select("engine_id", same_id("process_instance_id").alias("process_instance_id"), "event_type", F.coalesce("stream_sequence", F.lit(0)).alias("stream_sequence"), "event_time", "arrival_no", body.alias("fields"))


def a1_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = materialise.merge_class(_feed_events(spark, sf_dir), "PROCINST")
    return m.select("engine_id", "process_instance_id", "state", "business_key", F.unix_millis("end_time").alias("end_ms"), "stream_sequence", F.unix_millis("partition_anchor_at").alias("anchor_ms"), "n_applied")


def k1_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows from a stored table into which the feed is merged in three sets, as it arrives; the second comes twice."""
    events = _feed_events(spark, sf_dir)
    # as many rows as events at most; the number comes from the file footers
    table = BucketedTable(spark, scratch(spark, "current"), max(shuffle_width(spark), -(-events.count() // KEYS_PER_BUCKET)), materialise.entity_kind("PROCINST"))
    a, b = (x or 0 for x in events.agg(F.expr("percentile_approx(arrival_no, array(0.5, 0.8))")).first()[0] or (0, 0))
    n = F.col("arrival_no")
    for k, part in ((1, n <= a), (2, (n > a) & (n <= b)), (2, (n > a) & (n <= b)), (3, (n > b) | n.isNull())):
        table.apply(events.filter(part), ("feed", k))
    m = materialise.entity_rows(table.read(), "PROCINST")
    return m.select("engine_id", "process_instance_id", "state", "business_key", F.unix_millis("end_time").alias("end_ms"), "stream_sequence", F.unix_millis("partition_anchor_at").alias("anchor_ms"), "n_applied")


def a1_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = materialise.outcomes(_feed_events(spark, sf_dir), ["engine_id", "process_instance_id"], "stream_sequence", "arrival_no")
    return o.groupBy("event_type", "outcome").agg(F.count(F.lit(1)).alias("n"))


def d1_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _events(spark, sf_dir)
    return materialise.append_log(e).groupBy("history_class", "outcome").agg(F.count(F.lit(1)).alias("n"), F.sum("arrival_no").alias("arrivals"))


def d1_first_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The surviving row of each key by an aggregate instead of a window."""
    e = load(spark, sf_dir, "compact_history_outbox").select("engine_id", same_id("history_event_id").alias("history_event_id"), "event_type", "arrival_no", "batch_no", "history_class")
    return materialise.first_of(e, ["engine_id", "history_event_id", "event_type"], "arrival_no")


def d5_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = load(spark, sf_dir, "runtime_large_variable_ref").select("engine_id", same_id("variable_id").alias("variable_id"), same_id("payload_id").alias("payload_id"), "content_hash", "updated_at")
    return latest(r, ["engine_id", "variable_id"], "updated_at", ["updated_at", "payload_id", "content_hash"]).select("engine_id", "variable_id", "payload_id", "content_hash", F.unix_millis("updated_at").alias("updated_ms"))


def d3_outbox_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of the outbox that occur more than once."""
    o = load(spark, sf_dir, "compact_history_outbox").groupBy(same_id("history_event_id").alias("history_event_id"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.min("arrival_no").alias("first_arrival"))
    return o.filter("n > 1")


def s8_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the activity table by the month of their anchor."""
    return load(spark, sf_dir, "activity_instance_history").groupBy(materialise.month_of(F.col("partition_anchor_at")).alias("month")).agg(F.count(F.lit(1)).alias("n"))


def u1_all_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {n: load(spark, sf_dir, CLASSES[n].table) for n in ("PROCINST", "ACTINST", "DETAIL")}
    return materialise.all_classes(tables, ["engine_id", "created_by"]).groupBy("history_class", "engine_id").agg(F.count(F.lit(1)).alias("n"))


def s4_correlations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outbound messages read as correlations by business key."""
    o = load(spark, sf_dir, "outbound_message_outbox")
    wire = o.select("subject", S.clean_headers(F.create_map(F.lit("Business-Key"), F.col("business_key"), F.lit("Trace-Id"), F.col("trace_id"))).alias("headers"), F.col("payload").alias("data"))
    c = sources.correlation(wire, header_name="Business-Key")
    return c.select("subject", "business_key", "trace_id", F.length("payload").cast("long").alias("n_chars"))


def s1_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole write path as a stream: rows of the log tables and dead letters, by class."""
    root = scratch(spark, "pipeline")
    envelope.encode(_events(spark, sf_dir)).withColumn("arrival_no", F.col("stream_sequence")).write.parquet(f"{root}/in")
    classes = ["OP_LOG", "EXT_TASK_LOG", "INCIDENT"]
    pipe = HistoryPipeline(spark, f"{root}/out", classes)
    pipe.run(sources.message_stream(spark, f"{root}/in"))
    logs = [pipe.log_table(c).groupBy(F.lit(c).alias("what")).agg(F.count(F.lit(1)).alias("n")) for c in classes[:2]]
    dead = pipe.dead().groupBy(F.concat(F.lit("DLQ "), F.col("class_tag")).alias("what")).agg(F.count(F.lit(1)).alias("n"))
    return logs[0].unionByName(logs[1]).unionByName(dead)


def _accounts(pipe: HistoryPipeline, wire: DataFrame, run: str) -> DataFrame:
    """Where every message of ``wire`` is: in a log table, a copy of a row there, applied to an entity, dead or waiting."""
    key = ["engine_id", "history_event_id", "event_type", "event_time"]
    sound = envelope.parse(wire).filter("drift is null")
    none = F.lit(None).cast("string")
    parts = [pipe.dead().select(F.lit("DLQ").alias("place"), F.col("class_tag").alias("history_class"), "reason"), envelope.parse(pipe.waiting()).select(F.lit("RETRY").alias("place"), "history_class", none.alias("reason"))]
    for c in pipe.classes:
        if c in ENTITY_CLASSES:
            parts.append(pipe.spark.read.parquet(f"{pipe.root}/entities").filter(F.col("class") == c).select(F.lit("ENTITY").alias("place"), F.lit(c).alias("history_class"), none.alias("reason")))
            continue
        table = pipe.log_table(c)
        there = sound.filter(F.col("history_class") == c).join(table.select(*key), key, "left_semi")
        parts.append(table.select(F.lit("LOG").alias("place"), F.lit(c).alias("history_class"), none.alias("reason")))
        nth = F.row_number().over(Window.partitionBy(*key).orderBy("arrival_no"))
        parts.append(there.withColumn("k", nth).filter("k > 1").select(F.lit("COPY").alias("place"), F.lit(c).alias("history_class"), none.alias("reason")))
    return reduce(DataFrame.unionByName, parts).groupBy(F.lit(run).alias("run"), "place", "history_class", "reason").agg(F.count(F.lit(1)).alias("n"))


def s1_accounted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What became of every message after the first run of the write path, and after the run that leaves none waiting. Some
    bodies are empty or null."""
    root = scratch(spark, "pipeline")
    n = F.col("stream_sequence")
    wire = envelope.encode(_events(spark, sf_dir)).withColumn("arrival_no", n).withColumn("data", F.when(n % 61 == 0, F.lit(b"")).when(n % 67 != 0, F.col("data")))
    wire.write.parquet(f"{root}/in")
    wire = sources.message_batch(spark, f"{root}/in")
    pipe = HistoryPipeline(spark, f"{root}/out", ["OP_LOG", "EXT_TASK_LOG", "INCIDENT"])
    pipe.run(sources.message_stream(spark, f"{root}/in"))
    first = store(_accounts(pipe, wire, "first"), "first")
    for _ in range(envelope.MAX_DELIVERIES):  # a message without deliveries has so many more before it is dead
        pipe.run(sources.message_stream(spark, f"{root}/in"))
    return first.unionByName(_accounts(pipe, wire, "last"))


QUERIES = {f.__name__: f for f in (f1_routes, f2_drift, f4_columns, f10_round_trip, f11_large_payload, k3_dead_letters, s7_dead_letter_report, t1_partitions, a1_merge, k1_stored, a1_outcomes, d1_append, d1_first_rows, d5_ledger, d3_outbox_duplicates, s8_months, u1_all_classes, s4_correlations, s1_stream, s1_accounted)}

_E = f"""e AS (SELECT arrival_no AS n, CASE WHEN arrival_no % 97 = 0 THEN ' ' ELSE engine_id END AS engine_id, CASE WHEN arrival_no % 53 = 0 THEN 'NO_SUCH_CLASS' ELSE history_class END AS history_class,
 event_type, {_id("history_event_id")} AS history_event_id, {_id("process_instance_id")} AS process_instance_id, business_key, event_time, payload_scalar, 1 + arrival_no % 7 AS delivery FROM compact_history_outbox)"""
_R = f"""WITH {_E}, r AS (SELECT *, CASE WHEN n % 97 = 0 THEN 'header Engine-Id' WHEN n % 83 = 0 THEN 'body' END AS drift, n % 11 = 0 OR n % 53 = 0 AS fails FROM e),
w AS (SELECT *, CASE WHEN drift IS NOT NULL OR (fails AND delivery > 4) THEN 'dlq' WHEN fails THEN 'retry' WHEN history_class = 'INCIDENT' THEN 'entity' ELSE 'log' END AS route,
 CASE WHEN drift IS NOT NULL THEN '{envelope.SCHEMA_DRIFT}' WHEN fails AND delivery > 4 THEN '{envelope.BUDGET_EXCEEDED}' END AS reason FROM r)"""
_F = f"""f AS (SELECT engine_id, {_id("process_instance_id")} AS pid, event_type, coalesce(stream_sequence, 0) AS s, event_time, arrival_no AS a, state, business_key, epoch_us(end_time) // 1000 AS end_ms FROM procinst_change_feed),
o AS (SELECT *, max(s) OVER (PARTITION BY engine_id, pid ORDER BY a ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m FROM f)"""
_SUBJECT = "concat_ws('.', 'history', engine_id, history_class, process_instance_id)"

ORACLE = {
    "f1_routes": _R + " SELECT route, reason, count(*) AS n, sum(CASE WHEN route = 'retry' THEN CAST(least(30, pow(2, delivery - 1)) AS BIGINT) END) AS wait_s FROM w GROUP BY 1, 2",
    "f2_drift": _R + " SELECT drift, count(*) AS n FROM w GROUP BY 1",
    "f4_columns": _R + """ SELECT engine_id, history_event_id, event_type, n AS stream_sequence, payload_scalar->>'$.userId' AS user_id, payload_scalar->>'$.operationType' AS operation_type, payload_scalar->>'$.property' AS property,
 payload_scalar->>'$.orgValue' AS org_value, payload_scalar->>'$.newValue' AS new_value, FALSE AS user_id_pseudonymized, TRUE AS legal_hold FROM w WHERE route = 'log' AND history_class = 'OP_LOG'""",
    "f10_round_trip": _R + f" SELECT {_SUBJECT} AS subject, history_event_id, event_type, epoch_us(event_time) // 1000 AS event_ms, business_key, CAST(len(json_keys(payload_scalar)) AS BIGINT) AS n_fields, n AS seq FROM w WHERE drift IS NULL",
    "f11_large_payload": _R + """, p AS (SELECT history_class, CASE WHEN n % 5 = 0 AND history_class = 'EXT_TASK_LOG' THEN repeat(history_event_id, 3) END AS payload FROM w WHERE drift IS NULL)
 SELECT history_class, count(*) AS n, count(payload) AS n_kept, CAST(coalesce(sum(strlen(payload)), 0) AS BIGINT) AS n_bytes, min(sha256(payload)) AS least_hash FROM p GROUP BY 1""",
    "k3_dead_letters": _R + f" SELECT 'dlq.' || {_SUBJECT} AS dlq_subject, history_class AS class_tag, reason, history_event_id || ':' || event_type || '.dlq' AS message_id, CAST(delivery AS INTEGER) AS delivery_count FROM w WHERE route = 'dlq'",
    "s7_dead_letter_report": _R + " SELECT history_class AS class_tag, reason, count(*) AS n, CAST(max(delivery) AS INTEGER) AS most_deliveries FROM w WHERE route = 'dlq' GROUP BY 1, 2",
    "t1_partitions": f"SELECT CAST(CAST('0x' || substr(sha256({_id('process_instance_id')}), 1, 8) AS BIGINT) % 8 AS INTEGER) AS part, count(*) AS n FROM activity_instance_history GROUP BY 1",
    "a1_merge": f"""WITH {_F}, k AS (SELECT * FROM o WHERE m IS NULL OR s > m)
 SELECT engine_id, pid AS process_instance_id, coalesce(arg_max(state, s) FILTER (WHERE state IS NOT NULL), 'ACTIVE') AS state, arg_max_null(business_key, s) FILTER (WHERE business_key IS NOT NULL OR event_type = 'migrate') AS business_key,
 arg_max(end_ms, s) FILTER (WHERE end_ms IS NOT NULL) AS end_ms, max(s) AS stream_sequence, epoch_us(arg_min(event_time, a)) // 1000 AS anchor_ms, count(*) AS n_applied FROM k GROUP BY 1, 2""",
    "a1_outcomes": f"WITH {_F} SELECT event_type, CASE WHEN m IS NULL OR s > m THEN 'APPLIED' ELSE 'STALE_DISCARDED' END AS outcome, count(*) AS n FROM o GROUP BY 1, 2",
    "d1_append": f"""WITH {_E}, w AS (SELECT *, row_number() OVER (PARTITION BY engine_id, history_event_id, event_type, event_time ORDER BY n) AS k FROM e)
 SELECT history_class, CASE WHEN k = 1 THEN 'APPLIED' ELSE 'DEDUP_SKIPPED' END AS outcome, count(*) AS n, CAST(sum(n) AS BIGINT) AS arrivals FROM w GROUP BY 1, 2""",
    "d1_first_rows": f"""SELECT engine_id, history_event_id, event_type, arrival_no, batch_no, history_class FROM (SELECT engine_id, {_id("history_event_id")} AS history_event_id, event_type, arrival_no, batch_no, history_class FROM compact_history_outbox)
 QUALIFY row_number() OVER (PARTITION BY engine_id, history_event_id, event_type ORDER BY arrival_no) = 1""",
    "d5_ledger": f"""SELECT engine_id, variable_id, r.p AS payload_id, r.h AS content_hash, epoch_us(r.u) // 1000 AS updated_ms FROM (SELECT engine_id, {_id("variable_id")} AS variable_id,
 arg_max(struct_pack(p := {_id("payload_id")}, h := content_hash, u := updated_at), updated_at) AS r FROM runtime_large_variable_ref GROUP BY 1, 2)""",
    "d3_outbox_duplicates": f"SELECT {_id('history_event_id')} AS history_event_id, event_type, count(*) AS n, min(arrival_no) AS first_arrival FROM compact_history_outbox GROUP BY 1, 2 HAVING count(*) > 1",
    "s8_months": "SELECT strftime(partition_anchor_at AT TIME ZONE 'UTC', '%Y-%m') AS month, count(*) AS n FROM activity_instance_history GROUP BY 1",
    "u1_all_classes": "SELECT history_class, engine_id, count(*) AS n FROM (SELECT 'PROCINST' AS history_class, engine_id FROM process_instance_history UNION ALL SELECT 'ACTINST', engine_id FROM activity_instance_history UNION ALL SELECT 'DETAIL', engine_id FROM variable_detail_history) GROUP BY 1, 2",
    "s4_correlations": "SELECT subject, business_key, trace_id, CAST(length(decode(payload)) AS BIGINT) AS n_chars FROM outbound_message_outbox WHERE octet_length(payload) > 0",
    "s1_stream": _R.replace("n % 11 = 0 OR n % 53 = 0 AS fails", "n % 53 = 0 AS fails") + """, l AS (SELECT history_class, count(DISTINCT (engine_id, history_event_id, event_type, event_time)) AS n FROM w WHERE route = 'log' GROUP BY 1)
 SELECT history_class AS what, n FROM l UNION ALL SELECT 'DLQ ' || history_class, count(*) FROM w WHERE route = 'dlq' GROUP BY 1""",
    "s1_accounted": f"""WITH {_E}, s AS (SELECT *, n % 97 = 0 OR n % 83 = 0 OR n % 61 = 0 OR n % 67 = 0 AS bad, n % 53 = 0 AS fails FROM e),
 x AS (SELECT 'first' AS run, 4 AS most, * FROM s UNION ALL SELECT 'last', 0, * FROM s),
 y AS (SELECT *, CASE WHEN bad OR (fails AND delivery > most) THEN 'DLQ' WHEN fails THEN 'RETRY' WHEN history_class = 'INCIDENT' THEN 'ENTITY' ELSE 'LOG' END AS route,
 CASE WHEN bad THEN '{envelope.SCHEMA_DRIFT}' WHEN fails AND delivery > most THEN '{envelope.BUDGET_EXCEEDED}' END AS reason FROM x),
 z AS (SELECT *, CASE WHEN route = 'LOG' AND row_number() OVER (PARTITION BY run, route, history_class, engine_id, history_event_id, event_type, event_time ORDER BY n) > 1 THEN 'COPY' ELSE route END AS place FROM y)
 SELECT run, place, history_class, reason, count(*) AS n FROM z GROUP BY 1, 2, 3, 4""",
}
ORACLE["k1_stored"] = ORACLE["a1_merge"]
