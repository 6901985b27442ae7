"""The queries p1, p2, p3, p5, p6 and p7 over the history tables, and the SQL that checks them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import changes as ch
from ..operators import differences, exactly_once, hierarchy, intervals, orphans
from ..session import scratch, shuffle_width
from ..tables import latest, load, millis, same_id

PROCINST_FIELDS = ("process_definition_key", "business_key", "start_user_id", "super_process_instance_id", "start_time", "end_time", "duration_millis", "delete_reason", "state")


def current_instances(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The current row of each process instance, deleted ones included: the id, ``deleted_at`` and ``columns``."""
    p = load(spark, sf_dir, "process_instance_history")
    p = p.withColumn("process_instance_id", same_id("process_instance_id"))
    return latest(p, ["process_instance_id"], "stream_sequence", ["deleted_at", *columns])


def current_activities(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The current row of each activity instance, deleted ones included."""
    a = load(spark, sf_dir, "activity_instance_history")
    a = a.withColumn("activity_instance_id", same_id("activity_instance_id")).withColumn("process_instance_id", same_id("process_instance_id"))
    return latest(a, ["activity_instance_id"], "stream_sequence", ["deleted_at", *columns])


# --- 1: differences between two copies ---------------------------------------------------------------------------------


def _comparable(df: DataFrame) -> DataFrame:
    """Empty equals null; times by their millisecond; the parent by the rule for ids."""
    blank = lambda c: F.when(F.col(c) != "", F.col(c)).alias(c)
    parent = same_id("super_process_instance_id")
    columns = {"super_process_instance_id": F.when(parent != "", parent), "start_time": millis("start_time"), "end_time": millis("end_time"), "duration_millis": F.col("duration_millis").cast("long")}
    return df.select("engine_id", same_id("process_instance_id").alias("process_instance_id"), *[columns[f].alias(f) if f in columns else blank(f) for f in PROCINST_FIELDS])


def procinst_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    ours = current_instances(spark, sf_dir, "engine_id", *PROCINST_FIELDS).filter(F.col("deleted_at").isNull())
    theirs = load(spark, sf_dir, "act_hi_procinst")
    # the raw row count bounds the number of keys on either side and comes from the file footers
    rows = max(load(spark, sf_dir, "process_instance_history").count(), theirs.count())
    return differences.diff_copies(
        _comparable(ours), _comparable(theirs), ["engine_id", "process_instance_id"], PROCINST_FIELDS,
        missing_left="missing_in_projection", missing_right="missing_in_engine", split_right="rows_disagree_in_engine", rows=rows, unique_left=True,
    )


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = procinst_differences(spark, sf_dir).filter(~F.col("difference").startswith("rows_disagree"))
    return found.select("engine_id", "process_instance_id", "difference")


def p1_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The differing cells with both values, and the instances whose rows disagree within the engine's copy."""
    return procinst_differences(spark, sf_dir)


def p1_net_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per engine: the count difference of an earlier comparison beside what really differs."""
    found = procinst_differences(spark, sf_dir)
    here = found.groupBy("engine_id").agg(
        F.count_if(F.col("difference") == "missing_in_engine").alias("missing_in_engine"),
        F.count_if(F.col("difference") == "missing_in_projection").alias("missing_in_projection"),
        F.count_if(~F.col("difference").rlike("^(missing|rows)_")).alias("differing_fields"),
    )
    state = load(spark, sf_dir, "class_cutover_state").filter(F.upper("history_class") == "PROCINST").groupBy("engine_id").agg(F.max("last_diff_count").alias("last_diff_count"))
    return state.join(here, "engine_id", "full")


# --- 2: messages delivered more than once ------------------------------------------------------------------------------

OUTBOXES = {
    "compact_history_outbox": (("history_event_id", "event_type"), "event_time"),
    "outbound_message_outbox": (("id",), "created_at"),
}


def _messages(spark: SparkSession, sf_dir: str, table: str, files_per_batch: int) -> DataFrame:
    (ids, time) = OUTBOXES[table]
    path = f"{sf_dir}/{table}.parquet"
    schema = spark.read.parquet(path).schema
    # as a pattern, for a stream takes a single file only so; the pattern fits this name only
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(f"{path[:-1]}[{path[-1]}]")
    message = same_id(ids[0]) if len(ids) == 1 else F.concat(same_id(ids[0]), F.lit(":"), F.col(ids[1]))
    seen = F.coalesce(F.col(time), F.timestamp_micros(F.lit(0)))
    number = F.coalesce(F.col("arrival_no"), F.lit(2**63 - 1))
    return stream.select(F.lit(table).alias("source"), message.alias("message_id"), number.alias("arrival_no"), seen.alias("seen_at")).filter(F.col("message_id").isNotNull())


def p2_found(spark: SparkSession, sf_dir: str, files_per_batch: int = 8) -> DataFrame:
    root = scratch(spark, "exactly-once")
    streams = [_messages(spark, sf_dir, t, files_per_batch) for t in OUTBOXES]
    rows = sum(load(spark, sf_dir, t).count() for t in OUTBOXES)
    buckets = max(shuffle_width(spark), -(-rows // exactly_once.IDS_PER_BUCKET))
    exactly_once.run_dedup(streams[0].unionByName(streams[1]), root, buckets)
    return exactly_once.surplus(spark, root).select(F.col("source").alias("outbox_table"), "message_id", "arrival_no")


# --- 3: intervals ------------------------------------------------------------------------------------------------------


def _activity_intervals(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    a = current_activities(spark, sf_dir, "process_instance_id", "start_time", "end_time").filter(F.col("deleted_at").isNull())
    rows = a.select("process_instance_id", millis("start_time").alias("s"), millis("end_time").alias("t"))
    raw = load(spark, sf_dir, "activity_instance_history").select(same_id("process_instance_id").alias("process_instance_id"), millis("start_time").alias("s"))
    return rows, raw


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, raw = _activity_intervals(spark, sf_dir)
    found = intervals.gaps(rows, "process_instance_id", "s", "t", candidates=raw)
    return found.select("process_instance_id", F.col("gap_start").alias("gap_start_ms"), F.col("gap_end").alias("gap_end_ms"))


def p3_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, raw = _activity_intervals(spark, sf_dir)
    found = intervals.periods(rows, "process_instance_id", "s", "t", candidates=raw)
    return found.select("process_instance_id", F.col("period_start").alias("period_start_ms"), F.col("period_end").alias("period_end_ms"))


# --- 5: change feed ----------------------------------------------------------------------------------------------------


def _feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "procinst_change_feed").select("engine_id", same_id("process_instance_id").alias("process_instance_id"), "stream_sequence", "event_type", "state", "batch_no")


def _feed_table(spark: SparkSession, feed: DataFrame) -> ch.BucketedTable:
    # at most as many keys as records, whose number comes from the file footers
    return ch.BucketedTable(spark, scratch(spark, "procinst-state"), max(shuffle_width(spark), -(-feed.count() // ch.KEYS_PER_BUCKET)))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed as it comes: the first half of the batches makes the table, two later change sets are merged into it."""
    feed = _feed(spark, sf_dir)
    half, most = (x or 0 for x in feed.agg(F.expr("percentile_approx(batch_no, array(0.5, 0.8))")).first()[0] or (0, 0))
    table = _feed_table(spark, feed)
    table.apply(feed.filter(F.col("batch_no") <= half))
    table.apply(feed.filter((F.col("batch_no") > half) & (F.col("batch_no") <= most)))
    table.apply(feed.filter((F.col("batch_no") > most) | F.col("batch_no").isNull()))
    return ch.present(table.read())


def p5_in_two_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same state from two change sets, the later batches first: order and repetition must not matter."""
    feed = _feed(spark, sf_dir)
    middle = feed.agg(F.expr("percentile_approx(batch_no, 0.5)")).first()[0] or 0
    table = _feed_table(spark, feed)
    table.apply(feed.filter(F.col("batch_no") >= middle))
    table.apply(feed.filter((F.col("batch_no") <= middle) | F.col("batch_no").isNull()))
    return ch.present(table.read())


# --- 6: orphan references ----------------------------------------------------------------------------------------------


def _activity_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    refs = current_activities(spark, sf_dir, "process_instance_id", "event_time", "created_at").filter(F.col("deleted_at").isNull())
    refs = refs.select(
        F.lit("activity_instance_history").alias("ref_table"), F.col("activity_instance_id").alias("ref_id"), F.date_format("event_time", "yyyy-MM").alias("ref_month"),
        F.col("process_instance_id").alias("target"), F.col("created_at").alias("seen_at"),
    )
    parents = current_instances(spark, sf_dir, "created_at").select(F.col("process_instance_id").alias("key"), F.col("deleted_at").isNotNull().alias("gone"), "created_at")
    raw = load(spark, sf_dir, "activity_instance_history").select(same_id("process_instance_id").alias("target"))
    return orphans.find_orphans(refs, parents, parents_rows=load(spark, sf_dir, "process_instance_history").count(), refs_rows=raw.count(), ref_counts=raw)


def _payload_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger = load(spark, sf_dir, "runtime_large_variable_ref").select("engine_id", same_id("variable_id").alias("variable_id"), same_id("payload_id").alias("payload_id"), "created_at", "updated_at")
    now = latest(ledger, ["engine_id", "variable_id"], "updated_at", ["updated_at", "created_at", "payload_id"])
    refs = now.select(
        F.lit("runtime_large_variable_ref").alias("ref_table"), F.concat(F.col("engine_id"), F.lit("/"), F.col("variable_id")).alias("ref_id"), F.date_format("created_at", "yyyy-MM").alias("ref_month"),
        F.col("payload_id").alias("target"), F.col("updated_at").alias("seen_at"),
    )
    payloads = load(spark, sf_dir, "projection_large_payload").groupBy(same_id("id").alias("key")).agg((F.max("ref_count") == 0).alias("gone"), F.min("created_at").alias("created_at"))
    return orphans.find_orphans(refs, payloads, parents_rows=load(spark, sf_dir, "projection_large_payload").count(), refs_rows=ledger.count(), ref_counts=ledger.select(F.col("payload_id").alias("target")))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = _activity_orphans(spark, sf_dir).unionByName(_payload_orphans(spark, sf_dir))
    return both.select("ref_table", "ref_id", "ref_month", "orphan_kind")


def p6_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orphans per table, month and kind."""
    return orphans.orphan_report(_activity_orphans(spark, sf_dir).unionByName(_payload_orphans(spark, sf_dir)))


# --- 7: hierarchies ----------------------------------------------------------------------------------------------------


def _calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = current_instances(spark, sf_dir, "super_process_instance_id").filter(F.col("deleted_at").isNull())
    return nodes.select("process_instance_id", same_id("super_process_instance_id").alias("parent"))


def _tree(spark: SparkSession, sf_dir: str, paths: bool) -> DataFrame:
    return hierarchy.hierarchy(_calls(spark, sf_dir), "process_instance_id", "parent", paths=paths)


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _tree(spark, sf_dir, paths=False).filter(F.col("parent").isNotNull())
    return t.select(F.col("node").alias("process_instance_id"), F.col("root").alias("root_process_instance_id"), F.col("depth").alias("tree_depth"))


def p7_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The full path of every called instance, root first; null in and below cycles."""
    t = _tree(spark, sf_dir, paths=True).filter(F.col("parent").isNotNull())
    return t.select(F.col("node").alias("process_instance_id"), F.array_join("path", "/").alias("path"))


def p7_descendants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many instances each instance called, directly or through others, and how deep; without those in and below cycles,
    as its SQL has it. All are in :func:`p7_descendant_ids`."""
    d = hierarchy.descendants(_tree(spark, sf_dir, paths=False))
    return d.select(F.col("node").alias("process_instance_id"), "n_descendants", "deepest")


def p7_descendant_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every instance with each instance that it called, directly or through others, in and below cycles too."""
    d = hierarchy.all_descendants(_calls(spark, sf_dir), "process_instance_id", "parent")
    return d.select(F.col("ancestor").alias("process_instance_id"), F.col("descendant").alias("called_process_instance_id"), "distance")


QUERIES = {
    "p1_found": p1_found, "p1_cells": p1_cells, "p1_net_counts": p1_net_counts, "p2_found": p2_found, "p3_found": p3_found, "p3_periods": p3_periods, "p5_found": p5_found,
    "p5_in_two_sets": p5_in_two_sets, "p6_found": p6_found, "p6_report": p6_report, "p7_found": p7_found, "p7_paths": p7_paths, "p7_descendants": p7_descendants,
    "p7_descendant_ids": p7_descendant_ids,
}

# --- the same in SQL ---------------------------------------------------------------------------------------------------


def _id(c: str) -> str:
    return f"lower(trim({c}, ' ' || chr(9) || chr(13) || chr(10)))"


_PI = f"""(SELECT {_id("process_instance_id")} AS pid, arg_max(struct_pack(engine_id := engine_id, process_definition_key := process_definition_key,
  business_key := business_key, start_user_id := start_user_id, super_process_instance_id := super_process_instance_id, start_time := start_time,
  end_time := end_time, duration_millis := duration_millis, delete_reason := delete_reason, state := state, created_at := created_at, deleted_at := deleted_at), stream_sequence) AS r
  FROM process_instance_history GROUP BY 1)"""
_AI = f"""(SELECT {_id("activity_instance_id")} AS aid, arg_max(struct_pack(pid := {_id("process_instance_id")}, start_time := start_time, end_time := end_time,
  event_time := event_time, created_at := created_at, deleted_at := deleted_at), stream_sequence) AS r FROM activity_instance_history GROUP BY 1)"""


def _norm(prefix: str) -> str:
    out = []
    for f in PROCINST_FIELDS:
        c = prefix + f
        if f == "super_process_instance_id":
            out.append(f"nullif({_id(c)}, '') AS {f}")
        elif f in ("start_time", "end_time"):
            out.append(f"epoch_us({c}) // 1000 AS {f}")
        elif f == "duration_millis":
            out.append(f"CAST({c} AS BIGINT) AS {f}")
        else:
            out.append(f"nullif({c}, '') AS {f}")
    return ", ".join(out)


_CELLS = f"""WITH l AS (SELECT r.engine_id AS engine_id, pid AS process_instance_id, {_norm("r.")} FROM {_PI} WHERE r.deleted_at IS NULL),
every AS (SELECT DISTINCT engine_id, {_id("process_instance_id")} AS process_instance_id, {_norm("")} FROM act_hi_procinst),
r AS (SELECT * FROM every QUALIFY row_number() OVER (PARTITION BY engine_id, process_instance_id ORDER BY {", ".join(f"{f} NULLS FIRST" for f in PROCINST_FIELDS)}) = 1),
j AS (SELECT l.engine_id AS le, l.process_instance_id AS lp, r.engine_id AS re, r.process_instance_id AS rp, {", ".join(f"l.{f} AS l_{f}, r.{f} AS r_{f}" for f in PROCINST_FIELDS)}
  FROM l FULL JOIN r ON l.engine_id = r.engine_id AND l.process_instance_id = r.process_instance_id),
cells AS (SELECT le AS engine_id, lp AS process_instance_id, 'missing_in_engine' AS difference, CAST(NULL AS VARCHAR) AS left_value, CAST(NULL AS VARCHAR) AS right_value FROM j WHERE rp IS NULL
  UNION ALL SELECT re, rp, 'missing_in_projection', NULL, NULL FROM j WHERE lp IS NULL
  {" ".join(f"UNION ALL SELECT le, lp, '{f}', CAST(l_{f} AS VARCHAR), CAST(r_{f} AS VARCHAR) FROM j WHERE lp IS NOT NULL AND rp IS NOT NULL AND l_{f} IS DISTINCT FROM r_{f}" for f in PROCINST_FIELDS)}
  UNION ALL SELECT engine_id, process_instance_id, 'rows_disagree_in_engine', NULL, NULL FROM every GROUP BY 1, 2 HAVING count(*) > 1)"""

_INTERVALS = f"""WITH iv AS (SELECT r.pid AS pid, epoch_us(r.start_time) // 1000 AS s, coalesce(epoch_us(r.end_time) // 1000, 9223372036854775807) AS t FROM {_AI} WHERE r.deleted_at IS NULL),
ok AS (SELECT * FROM iv WHERE s IS NOT NULL AND t > s),
o AS (SELECT pid, s, t, max(t) OVER (PARTITION BY pid ORDER BY s, t ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS b FROM ok)"""

_ORPHANS = f"""WITH parents AS (SELECT pid AS k, r.deleted_at IS NOT NULL AS gone, r.created_at AS c FROM {_PI}),
payloads AS (SELECT {_id("id")} AS k, max(ref_count) = 0 AS gone, min(created_at) AS c FROM projection_large_payload GROUP BY 1),
led AS (SELECT engine_id, {_id("variable_id")} AS v, arg_max(struct_pack(p := {_id("payload_id")}, c := created_at, u := updated_at), updated_at) AS r FROM runtime_large_variable_ref GROUP BY 1, 2),
found AS (SELECT 'activity_instance_history' AS ref_table, aid AS ref_id, strftime(r.event_time AT TIME ZONE 'UTC', '%Y-%m') AS ref_month, r.pid AS target,
    CASE WHEN parents.k IS NULL THEN 'missing' WHEN gone THEN 'deleted' WHEN c > r.created_at THEN 'late' END AS orphan_kind
  FROM {_AI} a LEFT JOIN parents ON a.r.pid = parents.k WHERE r.deleted_at IS NULL
  UNION ALL SELECT 'runtime_large_variable_ref', engine_id || '/' || v, strftime(r.c AT TIME ZONE 'UTC', '%Y-%m'), r.p,
    CASE WHEN payloads.k IS NULL THEN 'missing' WHEN gone THEN 'deleted' WHEN payloads.c > r.u THEN 'late' END
  FROM led LEFT JOIN payloads ON led.r.p = payloads.k)"""

_TREE = f"""WITH RECURSIVE n AS (SELECT pid AS id, {_id("r.super_process_instance_id")} AS parent FROM {_PI} WHERE r.deleted_at IS NULL),
link AS (SELECT n.id, n.parent, p.id AS up FROM n LEFT JOIN n p ON n.parent = p.id),
t AS (SELECT id, id AS root, CAST(0 AS BIGINT) AS depth, [id] AS path FROM link WHERE up IS NULL
  UNION ALL SELECT link.id, t.root, t.depth + 1, list_append(t.path, link.id) FROM link JOIN t ON link.up = t.id)"""

_FEED = f"""WITH f AS (SELECT engine_id, {_id("process_instance_id")} AS pid, coalesce(stream_sequence, 0) AS s, event_type, state FROM procinst_change_feed),
d AS (SELECT engine_id, pid, max(s) FILTER (WHERE event_type = 'delete') AS gone FROM f GROUP BY 1, 2),
k AS (SELECT f.* FROM f JOIN d USING (engine_id, pid) WHERE event_type IS DISTINCT FROM 'delete' AND (gone IS NULL OR s > gone))
SELECT engine_id, pid AS process_instance_id, max(s) AS stream_sequence, coalesce(arg_max(state, s) FILTER (WHERE state IS NOT NULL), 'ACTIVE') AS state FROM k GROUP BY 1, 2"""

ORACLE = {
    "p1_found": _CELLS + " SELECT engine_id, process_instance_id, difference FROM cells WHERE NOT starts_with(difference, 'rows_')",
    "p1_cells": _CELLS + " SELECT * FROM cells",
    "p1_net_counts": _CELLS + """, h AS (SELECT engine_id, count(*) FILTER (WHERE difference = 'missing_in_engine') AS missing_in_engine,
 count(*) FILTER (WHERE difference = 'missing_in_projection') AS missing_in_projection, count(*) FILTER (WHERE NOT starts_with(difference, 'missing_') AND NOT starts_with(difference, 'rows_')) AS differing_fields FROM cells GROUP BY 1),
s AS (SELECT engine_id, max(last_diff_count) AS last_diff_count FROM class_cutover_state WHERE upper(history_class) = 'PROCINST' GROUP BY 1)
SELECT engine_id, last_diff_count, missing_in_engine, missing_in_projection, differing_fields FROM s FULL JOIN h USING (engine_id)""",
    "p2_found": f"""WITH m AS (SELECT 'compact_history_outbox' AS outbox_table, {_id("history_event_id")} || ':' || event_type AS message_id, arrival_no FROM compact_history_outbox
UNION ALL SELECT 'outbound_message_outbox', {_id("id")}, arrival_no FROM outbound_message_outbox)
SELECT outbox_table, message_id, arrival_no FROM m WHERE message_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY outbox_table, message_id ORDER BY arrival_no) > 1""",
    "p3_found": _INTERVALS + " SELECT pid AS process_instance_id, b AS gap_start_ms, s AS gap_end_ms FROM o WHERE s > b",
    "p3_periods": _INTERVALS + """, st AS (SELECT pid, s, b FROM o WHERE b IS NULL OR s > b), top AS (SELECT pid, max(t) AS top FROM ok GROUP BY 1)
SELECT st.pid AS process_instance_id, s AS period_start_ms, nullif(coalesce(lead(b) OVER (PARTITION BY st.pid ORDER BY s), top), 9223372036854775807) AS period_end_ms FROM st JOIN top ON st.pid = top.pid""",
    "p5_found": _FEED,
    "p5_in_two_sets": _FEED,
    "p6_found": _ORPHANS + " SELECT ref_table, ref_id, ref_month, orphan_kind FROM found WHERE orphan_kind IS NOT NULL",
    "p6_report": _ORPHANS + " SELECT ref_table, ref_month, orphan_kind, count(*) AS n_refs, count(DISTINCT target) AS n_targets FROM found WHERE orphan_kind IS NOT NULL GROUP BY 1, 2, 3",
    "p7_found": _TREE + " SELECT n.id AS process_instance_id, coalesce(t.root, '') AS root_process_instance_id, coalesce(t.depth, -1) AS tree_depth FROM n LEFT JOIN t ON n.id = t.id WHERE n.parent IS NOT NULL",
    "p7_paths": _TREE + " SELECT n.id AS process_instance_id, array_to_string(t.path, '/') AS path FROM n LEFT JOIN t ON n.id = t.id WHERE n.parent IS NOT NULL",
    "p7_descendants": _TREE + """ SELECT a.id AS process_instance_id, count(*) AS n_descendants, max(distance) AS deepest
FROM (SELECT unnest(path[:-2]) AS id, depth, generate_subscripts(path[:-2], 1) AS i, depth - generate_subscripts(path[:-2], 1) + 1 AS distance FROM t WHERE depth > 0) a GROUP BY 1""",
    "p7_descendant_ids": f"""WITH RECURSIVE n AS (SELECT pid AS id, {_id("r.super_process_instance_id")} AS parent FROM {_PI} WHERE r.deleted_at IS NULL),
link AS (SELECT n.id, p.id AS up FROM n JOIN n p ON n.parent = p.id),
a AS (SELECT id, up AS above, CAST(1 AS BIGINT) AS distance, [id] AS seen FROM link WHERE up <> id
  UNION ALL SELECT a.id, link.up, a.distance + 1, list_append(a.seen, a.above) FROM a JOIN link ON a.above = link.id WHERE link.up <> a.above AND NOT list_contains(a.seen, link.up))
SELECT above AS process_instance_id, id AS called_process_instance_id, distance FROM a""",
}
