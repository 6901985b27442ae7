"""Queries of the read operations and of the blob store, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalar as S
from ..operators import blobs
from ..operators.query_api import Clustered, HistoryReads, Page
from ..session import hadoop_path, scratch
from ..tables import latest, load, same_id
from .quality import _PI, _id, current_activities, current_instances

#: The queries' own bounds: a definition key that occurs at every size, and a start.
DEFINITION, AFTER, BEFORE = "payment-settlement", "2025-03-01 00:00:00", "2025-12-01 00:00:00"
#: Values above so many bytes count as large in these data.
LARGE = 300
#: Values that one sweep moves.
SWEEP = 100


def _tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The current rows of the four tables that are read."""
    instances = current_instances(spark, sf_dir, "engine_id", "process_definition_key", "business_key", "start_user_id", "start_time", "end_time", "state")
    activities = current_activities(spark, sf_dir, "process_instance_id", "activity_id", "activity_type", "activity_name", "task_assignee", "start_time", "end_time")
    tasks = activities.filter(F.col("activity_type") == "userTask").select(F.col("activity_instance_id").alias("task_id"), "process_instance_id", F.col("activity_name").alias("task_name"), F.col("task_assignee").alias("assignee"), F.lit(None).cast("string").alias("owner"), "start_time", "end_time", "deleted_at")
    v = load(spark, sf_dir, "variable_detail_history")
    v = v.select(same_id("id").alias("id"), same_id("process_instance_id").alias("process_instance_id"), "variable_name", "variable_type", "variable_value_text", "event_time", "deleted_at").distinct()
    return {"instances": instances, "activities": activities, "tasks": tasks, "variables": v}


#: What each table is cut by within an instance, and rows a folder.
_ORDER, ROWS_PER_BUCKET = {"instances": "start_time", "activities": "activity_instance_id", "tasks": "task_id", "variables": "id"}, 200_000
_stored: dict[tuple[str, ...], HistoryReads] = {}


def _reads(spark: SparkSession, sf_dir: str) -> HistoryReads:
    """The reads over the current rows, which are stored once an application and state of the tables."""
    sources = ("process_instance_history", "activity_instance_history", "variable_detail_history")
    state = [(p.toString(), str(fs.getFileStatus(p).getModificationTime())) for p, fs in (hadoop_path(spark, f"{sf_dir}/{t}.parquet") for t in sources)]
    key = (spark.sparkContext.applicationId, *[x for s in state for x in s])
    if key not in _stored:
        rows = load(spark, sf_dir, "activity_instance_history").count()  # the largest; from the file footers
        buckets = max(4, -(-rows // ROWS_PER_BUCKET))
        tables = {n: Clustered.store(t, scratch(spark, f"current-{n}"), buckets, _ORDER[n]) for n, t in _tables(spark, sf_dir).items()}
        _stored[key] = HistoryReads(tables["instances"], tables["activities"], tables["tasks"], tables["variables"], load(spark, sf_dir, "class_cutover_state").distinct())
    return _stored[key]




def _times(df: DataFrame) -> DataFrame:
    """Times as epoch milliseconds."""
    for c, t in df.dtypes:
        if t == "timestamp":
            df = df.withColumn(c, F.unix_millis(c))
    return df


def _busiest(reads: HistoryReads) -> str:
    """The instance with the most activities; of equals the least id."""
    a = reads.activities.rows.join(reads.instances.rows.filter("deleted_at is null").select("process_instance_id"), "process_instance_id", "left_semi")
    row = a.groupBy("process_instance_id").count().orderBy(F.desc("count"), "process_instance_id").first()
    return row[0] if row else ""


def _least(reads: HistoryReads) -> str:
    return reads.instances.rows.filter("deleted_at is null").agg(F.min("process_instance_id")).first()[0] or ""


def q1_instance(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _reads(spark, sf_dir)
    return _times(r.instance(_least(r)))


def q1_all_with_cutover(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The summary of every instance: the point lookup's join over the whole table."""
    r = _reads(spark, sf_dir)
    states = r.cutover.filter(F.upper("history_class") == "PROCINST").groupBy("engine_id").agg(F.min("state").alias("cutover_state"))
    return r.instances.rows.filter("deleted_at is null").join(F.broadcast(states), "engine_id", "left").select("process_instance_id", "state", "cutover_state")


def q2_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _times(_reads(spark, sf_dir).list_instances(Page(1, 50), definition_key=DEFINITION, started_after=AFTER, started_before=BEFORE, may_see_pii=True).rows)


def q2_page_masked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _times(_reads(spark, sf_dir).list_instances(Page(0, 0), definition_key=DEFINITION).rows)


def q2_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _reads(spark, sf_dir).list_instances(definition_key=DEFINITION, started_after=AFTER, started_before=BEFORE).total


def _child(spark: SparkSession, sf_dir: str, name: str, **context) -> DataFrame:
    r = _reads(spark, sf_dir)
    paged = getattr(r, name)(_busiest(r), Page(0, 100), **context)
    return _times(paged.rows)


def q3_activities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _child(spark, sf_dir, "list_activities", may_see_pii=True)


def q4_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _child(spark, sf_dir, "list_tasks")


def q5_variables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _child(spark, sf_dir, "list_variables", may_see_pii=True)


def q_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The totals of all child lists of every instance."""
    r = _reads(spark, sf_dir)
    parts = [t.filter("deleted_at is null").groupBy("process_instance_id").agg(F.count(F.lit(1)).alias("n")).withColumn("list", F.lit(n)) for n, t in (("activities", r.activities.rows), ("tasks", r.tasks.rows), ("variables", r.variables.rows))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# --- blobs -------------------------------------------------------------------------------------------------------------


def _payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "projection_large_payload").withColumn("id", same_id("id")).dropDuplicates(["id"])


def _ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = load(spark, sf_dir, "runtime_large_variable_ref").select("engine_id", same_id("variable_id").alias("variable_id"), same_id("payload_id").alias("payload_id"), "content_hash", "updated_at")
    return latest(r, ["engine_id", "variable_id"], "updated_at", ["payload_id", "content_hash"])


def b1_acquire(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blobs.acquire(load(spark, sf_dir, "documents").filter("text is not null").select("doc_id", "text"), "text", "doc_id").select("doc_id", "content_hash", "ref_count_after", "newly_stored")


def b1_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blobs.stored(load(spark, sf_dir, "documents").filter("text is not null"), "text", "doc_id")


def b3_net_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """References left after every third document gave its own back."""
    d = load(spark, sf_dir, "documents").filter("text is not null").select(F.sha2("text", 256).alias("content_hash"), F.explode(F.when(F.col("doc_id") % 3 == 0, F.array(F.lit(1), F.lit(-1))).otherwise(F.array(F.lit(1)))).alias("delta"))
    return blobs.net_counts(d)


def b3_floored_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same kind of log with releases that may come first: the count after the last step."""
    e = load(spark, sf_dir, "events").select("user_id", "event_id", F.when(F.col("event_type").isin("error", "view"), -1).otherwise(1).alias("delta"))
    return blobs.fold_counts(e, "user_id", "event_id").groupBy("user_id").agg(F.max_by("ref_count_after", "event_id").alias("ref_count"))


def b5_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = _ledger(spark, sf_dir).select(F.concat_ws("/", "engine_id", "variable_id").alias("variable_id"), F.col("payload_id").alias("blob_id"), F.lit("bytes").alias("type"))
    return blobs.candidates(v, _payloads(spark, sf_dir), LARGE, ("bytes",))


def b5_next_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first of them, the batch of one sweep; of a size that leaves some for the next."""
    v = _ledger(spark, sf_dir).select(F.concat_ws("/", "engine_id", "variable_id").alias("variable_id"), F.col("payload_id").alias("blob_id"), F.lit("bytes").alias("type"))
    return blobs.candidates(v, _payloads(spark, sf_dir), LARGE, ("bytes",), SWEEP).select("variable_id", "blob_id", "n_bytes")


def b6_dereference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger entries as markers, read back."""
    values = _ledger(spark, sf_dir).select("engine_id", "variable_id", S.marker_of(F.col("content_hash")).alias("value"))
    d = blobs.dereference(values, _payloads(spark, sf_dir), "value")
    return d.select("engine_id", "variable_id", F.octet_length("payload").cast("long").alias("n_bytes"), "broken")


def b7_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger rows whose payload is gone or has other content now."""
    led = _ledger(spark, sf_dir)
    p = _payloads(spark, sf_dir).select(F.col("id").alias("payload_id"), F.sha2("payload_bytes", 256).alias("current_hash"))
    now = led.select("engine_id", "variable_id", "payload_id").join(p, "payload_id").select("engine_id", "variable_id", "current_hash")
    return blobs.ledger_drift(led, now).select("engine_id", "variable_id", "reason")


def b8_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blobs.canonical(_payloads(spark, sf_dir)).filter(F.col("old_id") != F.col("canonical_id"))


def b8_rewritten(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = blobs.canonical(_payloads(spark, sf_dir))
    return blobs.rewrite(_ledger(spark, sf_dir), m, "payload_id").select("engine_id", "variable_id", "payload_id")


def b8_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads that stay: the canonical ones."""
    p = _payloads(spark, sf_dir)
    gone = blobs.canonical(p).filter(F.col("old_id") != F.col("canonical_id")).select(F.col("old_id").alias("id"))
    return p.select("id", "content_hash").join(gone, "id", "left_anti")


def b8_recount(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every payload's references, counted anew, beside the count it holds."""
    p = _payloads(spark, sf_dir)
    n = blobs.recount(p, [_ledger(spark, sf_dir).select("payload_id")])
    return p.select("id", F.col("ref_count").alias("held")).join(n, "id")


def f20_markers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hashes as markers and back, with spoiled ones among them."""
    p = _payloads(spark, sf_dir)
    text = F.when(F.col("ref_count") % 4 == 1, F.upper(S.marker_of(F.col("content_hash")))).when(F.col("ref_count") % 4 == 2, F.substring(S.marker_of(F.col("content_hash")), 1, 70)).otherwise(S.marker_of(F.col("content_hash")))
    return p.select("id", S.hash_in_marker(text).alias("content_hash"), S.too_large(F.col("payload_bytes"), LARGE).alias("large"), S.is_sha256_hex(F.col("content_hash")).alias("well_formed"))


QUERIES = {f.__name__: f for f in (q1_instance, q1_all_with_cutover, q2_page, q2_page_masked, q2_total, q3_activities, q4_tasks, q5_variables, q_totals, b1_acquire, b1_stored, b3_net_counts, b3_floored_counts, b5_candidates, b5_next_batch, b6_dereference, b7_drift, b8_canonical, b8_rewritten, b8_kept, b8_recount, f20_markers)}

_MS = "epoch_us({0}) // 1000"
_I = f"""i AS (SELECT pid, r.engine_id AS engine_id, r.process_definition_key AS k, r.business_key AS b, u.u AS u, r.start_time AS s, r.end_time AS e, r.state AS state FROM {_PI} p
 JOIN (SELECT {_id("process_instance_id")} AS pid, arg_max_null(start_user_id, stream_sequence) AS u FROM process_instance_history GROUP BY 1) u USING (pid) WHERE r.deleted_at IS NULL),
c AS (SELECT engine_id, min(state) AS cutover_state FROM class_cutover_state WHERE upper(history_class) = 'PROCINST' GROUP BY 1)"""
_A = f"""a AS (SELECT {_id("activity_instance_id")} AS aid, arg_max(struct_pack(pid := {_id("process_instance_id")}, activity_id := activity_id, t := activity_type, n := activity_name, u := task_assignee, s := start_time, e := end_time, d := deleted_at), stream_sequence) AS r FROM activity_instance_history GROUP BY 1)"""
_V = f"v AS (SELECT DISTINCT {_id('id')} AS id, {_id('process_instance_id')} AS pid, variable_name, variable_type, variable_value_text, event_time, deleted_at FROM variable_detail_history)"
_BUSY = "busy AS (SELECT a.r.pid AS pid FROM a JOIN i ON a.r.pid = i.pid GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)"
_P = f"p AS (SELECT {_id('id')} AS id, any_value(payload_bytes) AS bytes, any_value(content_hash) AS h, any_value(ref_count) AS n FROM projection_large_payload GROUP BY 1)"
_L = f"l AS (SELECT engine_id, {_id('variable_id')} AS v, arg_max(struct_pack(p := {_id('payload_id')}, h := content_hash), updated_at) AS r FROM runtime_large_variable_ref GROUP BY 1, 2)"
_RANGE = f"k = '{DEFINITION}' AND s >= TIMESTAMPTZ '{AFTER}+00' AND s <= TIMESTAMPTZ '{BEFORE}+00'"
_SHOW = "pid AS process_instance_id, k AS process_definition_key, b AS business_key, {0} AS start_user_id, " + _MS.format("s") + " AS start_time, " + _MS.format("e") + " AS end_time, state, {1} AS cutover_state"

ORACLE = {
    "q1_instance": f"WITH {_I} SELECT {_SHOW.format(chr(39) + '***' + chr(39), 'cutover_state')} FROM i LEFT JOIN c USING (engine_id) WHERE pid = (SELECT min(pid) FROM i)",
    "q1_all_with_cutover": f"WITH {_I} SELECT pid AS process_instance_id, state, cutover_state FROM i LEFT JOIN c USING (engine_id)",
    "q2_page": f"WITH {_I} SELECT {_SHOW.format('u', 'CAST(NULL AS VARCHAR)')} FROM i WHERE {_RANGE} ORDER BY s DESC NULLS FIRST, pid LIMIT 50 OFFSET 50",
    "q2_page_masked": f"WITH {_I} SELECT {_SHOW.format(chr(39) + '***' + chr(39), 'CAST(NULL AS VARCHAR)')} FROM i WHERE k = '{DEFINITION}' ORDER BY s DESC NULLS FIRST, pid LIMIT 20",
    "q2_total": f"WITH {_I} SELECT count(*) AS total FROM i WHERE {_RANGE}",
    "q3_activities": f"WITH {_I}, {_A}, {_BUSY} SELECT r.activity_id, r.t AS activity_type, r.u AS task_assignee, {_MS.format('r.s')} AS start_time, {_MS.format('r.e')} AS end_time FROM a WHERE r.d IS NULL AND r.pid = (SELECT pid FROM busy) ORDER BY r.s ASC NULLS LAST, aid LIMIT 100",
    "q4_tasks": f"WITH {_I}, {_A}, {_BUSY} SELECT aid AS task_id, r.n AS task_name, '***' AS assignee, '***' AS owner, {_MS.format('r.s')} AS start_time, {_MS.format('r.e')} AS end_time FROM a WHERE r.t = 'userTask' AND r.d IS NULL AND r.pid = (SELECT pid FROM busy) ORDER BY r.s ASC NULLS LAST, aid LIMIT 100",
    "q5_variables": f"WITH {_I}, {_A}, {_BUSY}, {_V} SELECT variable_name, variable_type, variable_value_text AS value, FALSE AS masked, {_MS.format('event_time')} AS event_time FROM v WHERE deleted_at IS NULL AND pid = (SELECT pid FROM busy) ORDER BY v.event_time ASC NULLS LAST, id LIMIT 100",
    "q_totals": f"""WITH {_A}, {_V} SELECT r.pid AS process_instance_id, count(*) AS n, 'activities' AS list FROM a WHERE r.d IS NULL GROUP BY 1 UNION ALL SELECT r.pid, count(*), 'tasks' FROM a WHERE r.d IS NULL AND r.t = 'userTask' GROUP BY 1
 UNION ALL SELECT pid, count(*), 'variables' FROM v WHERE deleted_at IS NULL GROUP BY 1""",
    "b1_acquire": "SELECT doc_id, sha256(text) AS content_hash, CAST(row_number() OVER w AS INTEGER) AS ref_count_after, row_number() OVER w = 1 AS newly_stored FROM documents WHERE text IS NOT NULL WINDOW w AS (PARTITION BY sha256(text) ORDER BY doc_id)",
    "b1_stored": "SELECT sha256(text) AS content_hash, min(doc_id) AS id, CAST(count(*) AS INTEGER) AS ref_count, CAST(max(strlen(text)) AS BIGINT) AS n_bytes FROM documents WHERE text IS NOT NULL GROUP BY 1",
    "b3_net_counts": "SELECT sha256(text) AS content_hash, CAST(sum(CASE WHEN doc_id % 3 = 0 THEN 0 ELSE 1 END) AS BIGINT) AS ref_count FROM documents WHERE text IS NOT NULL GROUP BY 1 HAVING sum(CASE WHEN doc_id % 3 = 0 THEN 0 ELSE 1 END) > 0",
    "b3_floored_counts": """WITH d AS (SELECT user_id, event_id, CASE WHEN event_type IN ('error', 'view') THEN -1 ELSE 1 END AS d FROM events),
 r AS (SELECT *, sum(d) OVER (PARTITION BY user_id ORDER BY event_id) AS s FROM d), m AS (SELECT *, s - least(0, min(s) OVER (PARTITION BY user_id ORDER BY event_id)) AS c FROM r) SELECT user_id, CAST(arg_max(c, event_id) AS BIGINT) AS ref_count FROM m GROUP BY 1""",
    "b5_candidates": f"WITH {_P}, {_L} SELECT l.engine_id || '/' || v AS variable_id, p.id AS blob_id, CAST(octet_length(bytes) AS BIGINT) AS n_bytes, sha256(bytes) AS content_hash, '{S.MARKER_PREFIX}' || sha256(bytes) AS marker FROM l JOIN p ON l.r.p = p.id WHERE octet_length(bytes) > {LARGE}",
    "b5_next_batch": f"WITH {_P}, {_L} SELECT l.engine_id || '/' || v AS variable_id, p.id AS blob_id, CAST(octet_length(bytes) AS BIGINT) AS n_bytes FROM l JOIN p ON l.r.p = p.id WHERE octet_length(bytes) > {LARGE} ORDER BY 1 LIMIT {SWEEP}",
    "b6_dereference": f"WITH {_P}, h AS (SELECT h, any_value(octet_length(bytes)) AS n FROM p GROUP BY 1), {_L} SELECT engine_id, v AS variable_id, CAST(h.n AS BIGINT) AS n_bytes, h.h IS NULL AS broken FROM l LEFT JOIN h ON l.r.h = h.h",
    "b7_drift": f"WITH {_P}, {_L} SELECT engine_id, v AS variable_id, CASE WHEN p.id IS NULL THEN 'variable_deleted' ELSE 'content_changed' END AS reason FROM l LEFT JOIN p ON l.r.p = p.id WHERE p.id IS NULL OR sha256(bytes) IS DISTINCT FROM l.r.h",
    "b8_canonical": f"WITH {_P}, c AS (SELECT h, min(id) AS canonical_id FROM p GROUP BY 1) SELECT id AS old_id, canonical_id FROM p JOIN c USING (h) WHERE id <> canonical_id",
    "b8_rewritten": f"WITH {_P}, c AS (SELECT h, min(id) AS canonical_id FROM p GROUP BY 1), m AS (SELECT id, canonical_id FROM p JOIN c USING (h)), {_L} SELECT engine_id, v AS variable_id, coalesce(canonical_id, l.r.p) AS payload_id FROM l LEFT JOIN m ON l.r.p = m.id",
    "b8_kept": f"WITH {_P} SELECT min(id) AS id, h AS content_hash FROM p GROUP BY h",
    "b8_recount": f"WITH {_P}, {_L}, n AS (SELECT l.r.p AS id, count(*) AS n FROM l GROUP BY 1) SELECT p.id, p.n AS held, coalesce(n.n, 0) AS ref_count FROM p LEFT JOIN n USING (id)",
    "f20_markers": f"WITH {_P} SELECT id, CASE WHEN n % 4 IN (1, 2) THEN NULL ELSE h END AS content_hash, octet_length(bytes) > {LARGE} AS large, regexp_full_match(h, '[0-9a-f]{{64}}') AS well_formed FROM p",
}
