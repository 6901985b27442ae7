from datetime import datetime, timedelta

import pytest

from histrail.operators.query_api import Denied, HistoryReads, Page

T0 = datetime(2025, 1, 1)


@pytest.fixture(scope="module")
def tables(spark):
    i = [("e", f"p{n}", "d", "b1" if n % 2 else "b2", "u", T0 + timedelta(days=n) if n else None, None, "ACTIVE", T0 if n == 5 else None) for n in range(30)]
    instances = spark.createDataFrame(i, "engine_id string, process_instance_id string, process_definition_key string, business_key string, start_user_id string, start_time timestamp, end_time timestamp, state string, deleted_at timestamp")
    activities = spark.createDataFrame([(f"a{n}", "p1", "x", "userTask", "joe", T0 if n else None, None, None) for n in range(4)], "activity_instance_id string, process_instance_id string, activity_id string, activity_type string, task_assignee string, start_time timestamp, end_time timestamp, deleted_at timestamp")
    tasks = spark.createDataFrame([], "task_id string, process_instance_id string, task_name string, assignee string, owner string, start_time timestamp, end_time timestamp, deleted_at timestamp")
    variables = spark.createDataFrame([("v", "p1", "n", "string", None, T0, None)], "id string, process_instance_id string, variable_name string, variable_type string, variable_value_text string, event_time timestamp, deleted_at timestamp")
    states = spark.createDataFrame([("e", "ProcInst", "DUAL_RUN"), ("f", "PROCINST", "X")], "engine_id string, history_class string, state string")
    return instances, activities, tasks, variables, states


def test_reads(tables):
    r = HistoryReads(*tables)
    one = r.instance("p1").collect()
    assert len(one) == 1 and one[0].cutover_state == "DUAL_RUN" and one[0].start_user_id == "***"
    assert r.instance("p5").count() == 0 and r.instance("nope").count() == 0
    with pytest.raises(ValueError, match="filter"):
        r.list_instances()
    page = r.list_instances(Page(0, 5), definition_key="d", may_see_pii=True).envelope()
    assert page["total"] == 29 and [x["process_instance_id"] for x in page["data"]] == ["p0", "p29", "p28", "p27", "p26"]
    both = r.list_instances(business_key="b1", started_after=T0 + timedelta(days=1), started_before=T0 + timedelta(days=7)).envelope()
    assert [x["process_instance_id"] for x in both["data"]] == ["p7", "p3", "p1"]
    assert [x.start_time is None for x in r.list_activities("p1").rows.collect()] == [False, False, False, True]
    assert r.list_tasks("p1").rows.count() == 0 and r.list_tasks("p5") is None and r.list_tasks("nope") is None
    v = r.list_variables("p1").rows.first()
    assert v.value == "***" and v.masked and r.list_variables("p1", may_see_pii=True).rows.first().value is None


def test_pages_and_denial(tables):
    assert [Page(n, s).clamped for n, s in ((-1, 0), (3, 500), (3, -5))] == [Page(0, 20), Page(3, 200), Page(3, 20)] and Page(3, 20).offset == 60
    asked = []
    r = HistoryReads(*tables, authorise=lambda operation, context: asked.append((operation, context)) or False)
    for call in (lambda: r.instance("p1"), lambda: r.list_instances(business_key="b"), lambda: r.list_activities("p1"), lambda: r.list_tasks("p1"), lambda: r.list_variables("p1", user="x")):
        with pytest.raises(Denied):
            call()
    assert len(asked) == 5 and asked[-1] == ("LIST_VARIABLES", {"user": "x"})


def test_a_read_of_one_instance_opens_one_folder(spark, tables):
    from histrail.operators.query_api import Clustered
    from histrail.session import scratch

    stored = [Clustered.store(t, scratch(spark, "c"), 3, c) for t, c in zip(tables[:4], ("start_time", "activity_instance_id", "task_id", "id"), strict=True)]
    plain, r = HistoryReads(*tables), HistoryReads(*stored, tables[4])
    for call in (lambda x: x.instance("p1"), lambda x: x.list_activities("p1").rows, lambda x: x.list_variables("p1").rows, lambda x: x.list_instances(business_key="b1").rows):
        assert sorted(map(str, call(r).collect())) == sorted(map(str, call(plain).collect()))
    assert r.list_tasks("p1").rows.count() == 0 and r.list_tasks("nope") is None
    plan = stored[1].of("p1")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(process_instance_id), EqualTo(process_instance_id,p1)]" in plan and "PartitionFilters: [isnotnull(bucket" in plan
    assert len({f.split("bucket=")[1].split("/")[0] for f in stored[0].rows.inputFiles()}) == 3
