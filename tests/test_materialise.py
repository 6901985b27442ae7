import hmac
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from histrail import schemas
from histrail.functions import scalar as S
from histrail.operators import blobs, envelope, extract, governance, handoff, materialise, reconcile
from histrail.operators.changes import BucketedTable
from histrail.session import scratch
from histrail.sources import messages as sources
from histrail.streaming.pipeline import HistoryPipeline, message_dedup

T0 = datetime(2025, 1, 1)


def test_merge_against_a_fold(spark):
    r = random.Random(4)
    events = []
    for n in range(600):
        body = {k: r.choice([None, "x", "y"]) for k in ("state", "businessKey", "startTime") if r.random() < 0.5}
        body = {k: ("86400000" if k == "startTime" and v else v) for k, v in body.items()}
        events.append(("e", f"p{r.randrange(15)}", r.randrange(60), T0 + timedelta(minutes=n), n, body))
    r.shuffle(events)
    df = spark.createDataFrame(events, "engine_id string, process_instance_id string, stream_sequence long, event_time timestamp, arrival_no long, fields map<string,string>")
    want = {}
    for e, p, s, t, n, body in sorted(events, key=lambda x: x[4]):
        row = want.get(p)
        if row is None:
            row = want[p] = {"state": "ACTIVE", "businessKey": None, "startTime": None, "seq": -1, "anchor": t, "n": 0}
        if s > row["seq"]:
            row |= body | {"seq": s}
            row["n"] += 1
    got = {g.process_instance_id: g for g in materialise.merge_class(df, "PROCINST").collect()}
    for p, row in want.items():
        g = got[p]
        assert (g.state, g.business_key, g.stream_sequence, g.partition_anchor_at, g.n_applied) == (row["state"], row["businessKey"], row["seq"], row["anchor"], row["n"])
        assert (g.start_time is not None) == (row["startTime"] is not None)


def test_append_and_first_agree(spark):
    rows = [("e", f"h{k % 5}", "t", k) for k in (7, 3, 9, 1, 12, 4)]
    df = spark.createDataFrame(rows, "engine_id string, history_event_id string, event_type string, arrival_no long").withColumn("event_time", F.lit(T0))
    applied = {g.arrival_no for g in materialise.append_log(df).filter("outcome = 'APPLIED'").collect()}
    assert applied == {g.arrival_no for g in materialise.first_of(df, ["engine_id", "history_event_id", "event_type"], "arrival_no").collect()} == {7, 3, 4, 1}


def test_column_mapping():
    assert schemas.column_for("TASKINST", "name") == "task_name"
    assert schemas.column_for("DETAIL", "textValue") == "variable_value_text"
    assert schemas.column_for("PROCINST", "businessKey") == "business_key"
    assert schemas.column_for("PROCINST", "noSuchThing") is None
    assert schemas.column_for("PROCINST", "state; DROP TABLE x") is None
    assert schemas.camel_to_snake("ABc") == "_a_bc"
    with pytest.raises(ValueError, match="unknown"):
        schemas.check_class_names(["PROCESS_INSTANCE"])
    assert len(schemas.CLASSES) == 15 and len(schemas.ENTITY_CLASSES) == 6


def _wire(spark, **changes):
    h = {envelope.PREFIX + k: v for k, v in {"Engine-Id": "e", "Class": "OP_LOG", "Event-Type": "create", "Event-Id": "h1", "Process-Instance-Id": "p", "Event-Time": "1577872800000"}.items()}
    h.update({envelope.PREFIX + k: v for k, v in changes.pop("headers", {}).items()})
    h = {k: v for k, v in h.items() if v is not ...}
    row = {"subject": "history.e.OP_LOG.p", "headers": h, "data": b'{"userId":"u"}', "stream_sequence": 3, "delivery_count": 1} | changes
    return spark.createDataFrame([tuple(row.values())], "subject string, headers map<string,string>, data binary, stream_sequence long, delivery_count int")


@pytest.mark.parametrize(
    ("changes", "route", "reason"),
    [
        ({}, "log", None),
        ({"headers": {"Class": "PROCINST"}}, "entity", None),
        ({"headers": {"Event-Id": "  "}}, "dlq", envelope.SCHEMA_DRIFT),
        ({"headers": {"Event-Time": "soon"}}, "dlq", envelope.SCHEMA_DRIFT),
        ({"data": b"{broken"}, "dlq", envelope.SCHEMA_DRIFT),
        ({"data": None}, "dlq", envelope.SCHEMA_DRIFT),
        ({"headers": {"Class": "UNCLASSIFIED"}}, "retry", None),
        ({"headers": {"Class": "UNCLASSIFIED"}, "delivery_count": 5}, "dlq", envelope.BUDGET_EXCEEDED),
        ({"stream_sequence": None, "delivery_count": None}, "log", None),
    ],
)
def test_routes(spark, changes, route, reason):
    got = envelope.route(envelope.parse(_wire(spark, **changes))).first()
    assert (got.route, got.reason) == (route, reason)
    if changes.get("stream_sequence", 1) is None:
        assert (got.seq, got.delivery) == (0, 1)


def test_small_functions(spark):
    one = spark.range(1)
    ask = lambda c: one.select(c.alias("x")).first().x
    for key, user in (("k", "u-1"), ("k" * 100, "ü"), ("t:2", "x" * 500)):
        assert ask(S.hmac_sha256_hex(F.lit(user), key)) == hmac.new(key.encode(), user.encode(), "sha256").hexdigest()
    assert [ask(S.backoff_seconds(F.lit(n))) for n in (0, 1, 2, 5, 6, 40)] == [1, 1, 2, 16, 30, 30]
    assert S.lock_floor_seconds(4, 30, 120, 60) == 307 == ask(S.lock_floor(F.lit(4), F.lit(30), F.lit(120), F.lit(60)))
    assert S.lock_floor_seconds(8, 0, 0, 0) == 91 and S.lock_floor_seconds(1, 5, 0, 0) == 5 == ask(S.lock_floor(F.lit(1), F.lit(5), F.lit(0), F.lit(0)))
    h = "a" * 64
    assert ask(S.hash_in_marker(S.marker_of(F.lit(h)))) == h and ask(S.hash_in_marker(F.lit(S.MARKER_PREFIX + h + "a"))) is None and ask(S.hash_in_marker(F.lit(h))) is None
    assert ask(S.period_days(F.lit("P1Y2M3D"))) == 428 and ask(S.period_days(F.lit("P"))) is None and ask(S.period_days(F.lit("7 years"))) is None
    replies = {'{"type":"SUCCESS"}': "SUCCESS", '{"type":" BPMN_ERROR "}': "BPMN_ERROR", '{"type":"success"}': None, '{"x":{"type":"SUCCESS"}}': None, '{"type":"SUCCESS"': None, "": None}
    assert {k: ask(S.reply_type(F.lit(k))) for k in replies} == replies
    assert ask(S.first_text_after(F.lit('{"a":{"key":"inner"},"key":"outer"}'), "key")) == "inner" and ask(S.json_text(F.lit('{"a":{"key":"inner"},"key":"outer"}'), "key")) == "outer"
    m = F.create_map(F.lit("b"), F.lit("2"), F.lit("a"), F.lit("1"))
    assert list(ask(S.captured(m, ["a", "z", "b"])).items()) == [("a", "1"), ("b", "2")]
    assert ask(S.header(m, "new", "b")) == "2" and ask(S.without_dlq_suffix(F.lit("x.dlq"))) == "x"
    assert ask(S.outbound_subject(F.lit("e"), F.lit("a.b"), F.lit("p"))) is None and ask(S.outbound_subject(F.lit(" "), F.lit("a"), F.lit("p"))) is None
    with pytest.raises(Exception, match="user id"):
        ask(S.pseudonym_token(F.lit(""), "t", 1))
    with pytest.raises(ValueError, match="tenant"):
        S.pseudonym_token(F.lit("u"), "", 1)


def test_floored_counts_against_steps(spark):
    r = random.Random(8)
    rows = [(f"h{r.randrange(6)}", n, r.choice([1, -1, -1])) for n in range(400)]
    df = spark.createDataFrame(rows, "h string, n long, delta int")
    a = {(g.h, g.n): g.ref_count_after for g in blobs.fold_counts(df, "h", "n").collect()}
    b, count = {}, {}
    for h, n, d in rows:  # step by step, never below zero
        count[h] = max(0, count.get(h, 0) + d)
        b[h, n] = count[h]
    assert a == b and min(a.values()) == 0


def test_streaks_against_a_fold(spark):
    r = random.Random(3)
    rows = [(k, n, r.choice([0, 0, 1, 2, 5]), k == "c") for k in "abc" for n in range(150)]
    got = {(g.k, g.n): (g.streak, g.state) for g in reconcile.clean_streaks(spark.createDataFrame(rows, "k string, n long, diff long, critical boolean"), ["k"], "n", target=3, epsilon=2).collect()}
    for k in "abc":
        last, streak = 0, 0
        for _, n, diff, critical in [x for x in rows if x[0] == k]:
            clean = diff == 0 if critical else diff <= 2 and (diff <= last or last == 0)
            streak = streak + 1 if clean else 0
            assert got[k, n] == (streak, "DUAL_RUN" if not clean else "CLEAN_STREAK" if streak >= 3 else "RECONCILING")
            last = diff


def test_commands(spark):
    log = ["CLEAN", "REQUEST", "CLEAN", "CLEAN", "REQUEST", "CONFIRM", "UNCLEAN", "ROLLBACK", "CLEAN"]
    df = spark.createDataFrame([("a", i, c) for i, c in enumerate(log)], "k string, n long, command string")
    got = {tuple(g) for n in range(1, len(log) + 1) for g in reconcile.fold_commands(df.filter(F.col("n") < n), ["k"], "n", target=2).collect()[:1]}
    assert ("a", "CUTOVER_APPLIED", 3, 0) in got and ("a", "RECONCILING", 1, 1) in got and ("a", "CUTOVER_REQUESTED", 3, 0) in got


def test_every_outcome_of_commands(spark):
    """The gate, a failed write, revert and rollback; against a fold in Python."""
    r = random.Random(4)
    rows = [(k, n, r.choice(["CLEAN", "CLEAN", "CLEAN", "UNCLEAN", "REQUEST", "REQUEST", "CONFIRM", "REVERT", "ROLLBACK", None]), r.random() < 0.4) for k in "ab" for n in range(200)]
    got = {(g.k, g.n): (g.outcome, g.state, g.streak, g.rollbacks) for g in reconcile.command_outcomes(spark.createDataFrame(rows, "k string, n long, command string, failed boolean"), ["k"], "n", target=2).collect()}
    for k in "ab":
        state, streak, rollbacks = "DUAL_RUN", 0, 0
        for _, n, c, failed in [x for x in rows if x[0] == k]:
            outcome = None
            if c == "REQUEST":
                outcome = "GATE_NOT_MET" if state != "CLEAN_STREAK" else "APPLY_FAILED" if failed else "REQUESTED"
                state = "CUTOVER_REQUESTED" if outcome == "REQUESTED" else state
            elif c == "CONFIRM":
                state = "CUTOVER_APPLIED"
            elif c == "REVERT":
                state = "CLEAN_STREAK"
            elif c == "ROLLBACK":
                state, streak, rollbacks = "DUAL_RUN", 0, rollbacks + 1
            elif c in ("CLEAN", "UNCLEAN") and state != "CUTOVER_APPLIED":
                streak = streak + 1 if c == "CLEAN" else 0
                state = "DUAL_RUN" if c == "UNCLEAN" else "CLEAN_STREAK" if streak >= 2 else "RECONCILING"
            assert got[k, n] == (outcome, state, streak, rollbacks)
    assert {x[0] for x in got.values()} == {None, "GATE_NOT_MET", "APPLY_FAILED", "REQUESTED"}


def test_requests_and_scopes(spark):
    requests = spark.createDataFrame([("s1", "r1", ["OP_LOG"]), ("s2", "r2", ["OP_LOG", "DETAIL"]), ("s3", "r3", ["DETAIL"]), ("s4", "r4", None), ("s5", "r5", ["DETAIL"])], "s string, request_id string, classes array<string>")
    groups = spark.createDataFrame([("s2", "p1", 0), ("s3", "p2", 0), ("s3", "p3", 1), ("s5", "p4", 0), ("s5", "p5", 1)], "s string, process_instance_id string, case_group long")
    got = governance.request_outcomes(requests, governance.scope_outcome(groups, "s"), "s")
    assert {r.s: r.outcome for r in got.collect()} == {"s1": "LEGAL_HOLD_BLOCKED", "s2": "ACCEPTED", "s3": "CONFIRMATION_REQUIRED", "s4": "LEGAL_HOLD_BLOCKED", "s5": "CONFIRMATION_REQUIRED"}
    pending = governance.pending_scopes(groups, "s", got.filter("outcome = 'CONFIRMATION_REQUIRED'"))
    answers = spark.createDataFrame([("r3", "p2"), ("r3", "p2"), ("r3", "stranger")], "request_id string, process_instance_id string")
    after = {r.process_instance_id: r.status for r in governance.confirm_scopes(pending, answers).collect()}
    assert after == {"p2": "CONFIRMED", "p3": "REJECTED", "p4": "PENDING", "p5": "PENDING"}


def test_releases(spark):
    rows = spark.createDataFrame([("p1", "x"), ("p1", "x"), ("p1", None), ("p2", "y"), ("p3", "z"), (None, "z")], "process_instance_id string, ref string")
    scope = spark.createDataFrame([("p1",), ("p1",), ("p2",), (None,)], "process_instance_id string")
    deltas = governance.release_deltas(rows, "ref", scope, ["process_instance_id"])
    assert {(d.payload_id, d.delta) for d in deltas.collect()} == {("x", -2), ("y", -1)}
    payloads = spark.createDataFrame([("x", 3), ("y", 1), ("z", 0), ("w", None)], "id string, ref_count int")
    assert {(p.id, p.ref_count) for p in governance.after_release(payloads, deltas).collect()} == {("x", 1), ("z", 0), ("w", None)}
    assert governance.after_release(payloads, deltas.limit(0)).count() == 4


def test_verified_audit(spark):
    audit = spark.createDataFrame([("activity_instance_history", 2), ("process_instance_history", 1), ("job_log_history", 0)], "target_table string, affected_row_count long")
    some, none = spark.range(3), spark.range(0)
    got = {r.target_table: r.verification_status for r in governance.verified_audit(audit, {"ACTINST": some, "PROCINST": none}).collect()}
    assert got == {"activity_instance_history": "FAILED", "process_instance_history": "PASSED", "job_log_history": "PENDING"}
    assert {r.verification_status for r in governance.verified_audit(audit, {}).collect()} == {"PENDING"}


def test_extraction(spark):
    rows = [("process_instance", "e1", "key", "big", T0, None, None), ("external_task_log", "e2", "key", "big", None, None, T0), ("external_task_log", "e3", None, "", None, None, None), ("no_such_kind", "e4", None, None, None, None, None), (None, "e5", None, None, None, None, None)]
    events = spark.createDataFrame(rows, "kind string, history_event_id string, business_key string, error_details string, start_time timestamp, end_time timestamp, time timestamp").withColumns({"engine_id": F.lit("e"), "event_type": F.lit("t"), "process_instance_id": F.lit("p")})
    got = {r.history_event_id: r for r in extract.extracted(events, F.lit(datetime(2030, 1, 1))).collect()}
    assert [got[f"e{k}"].history_class for k in range(1, 6)] == ["PROCINST", "EXT_TASK_LOG", "EXT_TASK_LOG", None, None]
    assert got["e1"].body.startswith('{"processDefinitionKey":null') and got["e4"].body == "{}" and got["e1"].large is None
    assert got["e2"].large == b"big" and got["e3"].large is None and got["e2"].business_key is None and got["e1"].business_key == "key"
    assert (got["e1"].event_time, got["e2"].event_time, got["e3"].event_time.year) == (T0, T0, 2030)
    outbox, companions = extract.outbox_rows(extract.extracted(events.unionByName(events), F.lit(datetime(2030, 1, 1))), F.lit(T0))
    assert outbox.count() == 6 and outbox.select("id").distinct().count() == 3
    assert {(c.id, c.outbox_row_id) for c in companions.collect()} == {(o.payload_large_ref, o.id) for o in outbox.filter("payload_large_ref is not null").collect()}


def test_outbox_bounds_and_ages(spark):
    o = spark.createDataFrame([("a", True, "p1"), ("a", True, "p1"), ("b", True, "p1"), ("c", None, "p1")], "engine_id string, critical boolean, pid string")
    assert {r.engine_id: r.passes for r in handoff.outbox_gate(o, "critical", ["engine_id"], F.col("pid")).collect()} == {"a": False, "b": True, "c": False}
    m = spark.createDataFrame([("history", T0), ("dlq", T0), ("jobs", T0), ("history", None)], "stream string, t timestamp")
    left = handoff.within_age(m, "stream", "t", F.lit(T0 + timedelta(days=8)))
    assert sorted(r.stream for r in left.collect()) == ["dlq", "history", "jobs"]
    order = reconcile.cutover_order(spark.createDataFrame([("e", "OP_LOG"), ("e", None), ("e", "DETAIL"), ("e", "OTHER")], "engine_id string, history_class string"), ["engine_id"])
    assert [r.history_class for r in order.orderBy("place").collect()][:2] == ["DETAIL", "OP_LOG"]


def test_vault_deletion_and_conflict(spark):
    v = governance.Vault("0123456789abcdef")
    users = spark.createDataFrame([("u1", T0), ("u2", T0)], "u string, t timestamp")
    entries = v.entries(users, "u", "t", 1, "t")
    old = entries.filter("pseudonym_token is not null").limit(1).withColumn("first_seen_at", F.lit(datetime(2000, 1, 1)))
    known = v.store(old, entries)
    assert known.count() == 2 and known.filter("first_seen_at < '2001-01-01'").count() == 1
    tokens = [r.pseudonym_token for r in known.collect()]
    requests = spark.createDataFrame([(tokens[0], "x", "why", True), (tokens[1], "x", "why", False), ("nobody", "x", "why", True)], "pseudonym_token string, accessor_identity string, access_reason string, granted boolean")
    left, audit = v.delete(known, requests)
    assert [r.pseudonym_token for r in left.collect()] == [tokens[1]] and audit.count() == 3 and {r.operation for r in audit.collect()} == {"DELETE"}


def test_case_groups(spark):
    days = [0, 10, None, 101, 200, None, 500]
    rows = [("s", f"p{i}", T0 + timedelta(days=d) if d is not None else None) for i, d in enumerate(days)]
    got = {g.id: g.case_group for g in governance.case_groups(spark.createDataFrame(rows, "s string, id string, t timestamp"), "s", "t", "id").collect()}
    assert got == {"p0": 0, "p1": 0, "p3": 1, "p4": 2, "p6": 3, "p2": 3, "p5": 3}


def test_retention_is_strict(spark):
    rules = governance.RetentionRules()
    parts = governance.partitions(spark.createDataFrame([(T0,), (None,)], "t timestamp"), "t", "ACTINST")
    bound = datetime(2025, 2, 1)
    assert governance.due(parts, bound + timedelta(days=90), rules).count() == 0
    assert governance.due(parts, bound + timedelta(days=90, seconds=1), rules).count() == 1
    with pytest.raises(ValueError, match="minimum"):
        governance.RetentionRules({"OP_LOG": 30}).check()
    assert governance.erasable(["OP_LOG"]) == ([], "LEGAL_HOLD_BLOCKED") and governance.erasable(["OP_LOG", "DETAIL"])[0] == ["DETAIL"]


def test_vault(spark):
    users = spark.createDataFrame([("u1", T0), ("u1", T0), (None, T0), (" ", T0)], "u string, t timestamp")
    v = governance.Vault("0123456789abcdef")
    known = v.entries(users, "u", "t", 1, "t")
    assert v.store(known, known).count() == known.count() == 1
    token = known.first().pseudonym_token
    requests = spark.createDataFrame([(token, "x", "why", True), (token, "y", "why", False)], "pseudonym_token string, accessor_identity string, access_reason string, granted boolean")
    answers, audit = v.reidentify(known, requests)
    assert [a.user_id for a in answers.collect()] == ["u1"] and audit.count() == 2


def test_pipeline_replays(spark):
    root = scratch(spark, "p")
    wire = _wire(spark).unionByName(_wire(spark)).unionByName(_wire(spark, headers={"Class": "PROCINST"}, data=b'{"state":"DONE"}')).unionByName(_wire(spark, data=b"{"))
    wire.withColumn("arrival_no", F.monotonically_increasing_id()).write.parquet(f"{root}/in")
    pipe = HistoryPipeline(spark, f"{root}/out", ["PROCINST", "OP_LOG"])
    pipe.run(sources.message_stream(spark, f"{root}/in"))
    wire.withColumn("arrival_no", F.monotonically_increasing_id() + 1000).write.mode("append").parquet(f"{root}/in")
    pipe.run(sources.message_stream(spark, f"{root}/in"))
    pipe.run(sources.message_stream(spark, f"{root}/in"))
    assert pipe.log_table("OP_LOG").count() == 1 and pipe.dead().count() == 2
    row = pipe.entity_table("PROCINST").first()
    assert (row.state, row.stream_sequence, row.n_applied) == ("DONE", 3, 1)
    log = spark.read.parquet(f"{root}/out/logs/operation_log_history")
    assert {r.month for r in log.select("month").collect()} == {"2020-01"}


@pytest.mark.parametrize("seed", [1, 2])
def test_stored_rows_are_the_merge_of_all_events(spark, seed):
    """Sets merged one after another, some delivered again, give what one merge of all events gives."""
    r = random.Random(seed)
    rows = []
    for n in range(200):
        fields = {w: r.choice([None, "A", "B", "7"]) for w in r.sample(["state", "businessKey", "deleteReason", "other"], r.randrange(4))}
        rows.append((r.choice(["e", None]), f"p{r.randrange(9)}", r.randrange(40), T0 + timedelta(minutes=r.randrange(900)), fields, n))
    schema = "engine_id string, process_instance_id string, stream_sequence long, event_time timestamp, fields map<string,string>, arrival_no long"
    table = BucketedTable(spark, scratch(spark, "t"), 3, materialise.entity_kind("PROCINST"))
    for k in range(4):
        part = spark.createDataFrame(rows[k * 50 : k * 50 + 50], schema)
        version = table.apply(part, ("stream", k))
        assert table.apply(part, ("stream", k)) == version
    got = materialise.entity_rows(table.read(), "PROCINST")
    want = materialise.merge_class(spark.createDataFrame(rows, schema), "PROCINST")
    assert sorted(got.columns) == sorted(want.columns)
    assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))


def test_pipeline_keeps_what_it_cannot_write(spark):
    """Unknown classes, classes not handled and empty bodies: written somewhere after every run, and dead in the end."""
    root = scratch(spark, "p")
    wire = _wire(spark, headers={"Class": "NO_SUCH_CLASS"}).unionByName(_wire(spark, headers={"Class": "EXT_TASK_LOG"})).unionByName(_wire(spark)).unionByName(_wire(spark, data=b"")).unionByName(_wire(spark, data=None))
    wire.withColumn("delivery_count", F.lit(3)).withColumn("arrival_no", F.monotonically_increasing_id()).write.parquet(f"{root}/in")
    pipe = HistoryPipeline(spark, f"{root}/out", ["OP_LOG"])
    seen = []
    for _ in range(4):
        pipe.run(sources.message_stream(spark, f"{root}/in"))
        seen.append((pipe.waiting().count(), pipe.dead().filter(F.col("reason") == envelope.SCHEMA_DRIFT).count(), pipe.dead().filter(F.col("reason") == envelope.BUDGET_EXCEEDED).count(), pipe.log_table("OP_LOG").count()))
    assert seen == [(2, 2, 0, 1), (2, 2, 0, 1), (0, 2, 2, 1), (0, 2, 2, 1)]
    assert {r.delivery_count for r in pipe.dead().filter(F.col("reason") == envelope.BUDGET_EXCEEDED).collect()} == {5}


def test_pipeline_repeats_a_failed_round(spark):
    root = scratch(spark, "p")
    _wire(spark, headers={"Class": "EXT_TASK_LOG"}).withColumn("delivery_count", F.lit(4)).withColumn("arrival_no", F.lit(1).cast("long")).write.parquet(f"{root}/in")
    pipe = HistoryPipeline(spark, f"{root}/out", ["OP_LOG"])
    pipe.run(sources.message_stream(spark, f"{root}/in"))
    # the round has written everything, then fails before it is ended
    pipe(pipe.waiting().drop("retry_after_s").withColumn("delivery_count", F.lit(5)), -1)
    assert pipe.dead().count() == 1
    late = HistoryPipeline(spark, f"{root}/out", ["OP_LOG"])
    late.run(sources.message_stream(spark, f"{root}/in"))
    late.run(sources.message_stream(spark, f"{root}/in"))
    assert late.dead().count() == 1 and late.waiting().count() == 0


def test_message_window(spark):
    root = scratch(spark, "w")
    spark.createDataFrame([("a", T0), ("a", T0 + timedelta(seconds=30)), ("b", T0)], "id string, t timestamp").write.parquet(root)
    q = message_dedup(spark.readStream.schema("id string, t timestamp").parquet(root), "id", "t").writeStream.format("memory").queryName("window_dedup").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted(r.id for r in spark.table("window_dedup").collect()) == ["a", "b"]


def test_channels(spark):
    c = sources.channel('{"key":"k","channelType":"inbound","subject":"in.x","jetstream":true}')
    assert c.durable and sources.channel_table(spark, [c]).count() == 1
    with pytest.raises(ValueError, match="channel"):
        sources.channel({"key": "k", "channelType": "sideways", "subject": "s"})


def test_empty_tables(spark):
    assert schemas.create_empty(spark, root := scratch(spark, "h")) and not schemas.create_empty(spark, root)
    empty = schemas.open_table(spark, root, "ACTINST")
    assert empty.count() == 0 and "canceled" in empty.columns
    assert handoff.age(spark.createDataFrame([], "engine_id string, created_at timestamp"), F.lit(T0)).count() == 0
