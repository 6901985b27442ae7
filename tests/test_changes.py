import random

import pytest

from histrail.operators import changes as C
from histrail.session import hadoop_path, scratch

from .conftest import SMALL

SCHEMA = "engine_id string, process_instance_id string, stream_sequence long, event_type string, state string"


def brute(rows):
    out = {}
    for k in {r[:2] for r in rows}:
        by_seq = {(r[2] or 0): r for r in rows if r[:2] == k}
        live, last, state = False, None, None
        for s in sorted(by_seq):
            kind, new = by_seq[s][3], by_seq[s][4]
            if kind == "delete":
                live, state = False, None
            else:
                live, last, state = True, s, new if new is not None else state
        if live:
            out[k] = (last, state or "ACTIVE")
    return out


def feed(seed, n=300):
    r = random.Random(seed)
    made = {}
    for _ in range(n):
        k = (r.choice(["e1", None]), f"p{r.randrange(25)}")
        s = r.choice([None, *range(1, 12)])
        made.setdefault((*k, s or 0), (*k, s, r.choice(["start", "update", "end", "delete", "migrate"]), r.choice([None, "A", "B"])))
    rows = list(made.values())
    rows += r.choices(rows, k=60)
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_sets_in_any_order(spark, seed):
    rows = feed(seed)
    table = C.BucketedTable(spark, scratch(spark, "t"), 3)
    for lo in range(0, len(rows), 100):
        table.apply(spark.createDataFrame(rows[lo : lo + 100], SCHEMA))
    table.apply(spark.createDataFrame(rows[:40], SCHEMA))  # delivered again
    got = {(g.engine_id, g.process_instance_id): (g.stream_sequence, g.state) for g in C.present(table.read()).collect()}
    assert got == brute(rows)
    again = C.BucketedTable(spark, table.root)
    assert again.buckets == 3 and again.read().count() == table.read().count()
    before = sorted(map(str, table.read().collect()))
    assert table.vacuum() > 0
    assert sorted(map(str, table.read().collect())) == before


def test_only_touched_buckets_are_written(spark):
    table = C.BucketedTable(spark, scratch(spark, "t"), 16)
    table.apply(spark.createDataFrame([("e", f"p{i}", 1, "start", "A") for i in range(200)], SCHEMA))
    old = table.folders()
    table.apply(spark.createDataFrame([("e", "p0", 2, "end", "B")], SCHEMA))
    new = table.folders()
    assert sum(old[b] != new[b] for b in old) == 1
    assert table.read().count() == 200


def test_empty_and_conflict(spark):
    table = C.BucketedTable(spark, scratch(spark, "t"), 2)
    assert table.apply(spark.createDataFrame([], SCHEMA)) == 0 and table.read().count() == 0
    table.apply(spark.createDataFrame([("e", "p", 1, "start", None)], SCHEMA))
    with pytest.raises(RuntimeError, match="another writer"):
        table._commit(1, {"buckets": 2, "parts": {}})
    assert [g.state for g in C.present(table.read()).collect()] == ["ACTIVE"]
    with pytest.raises(ValueError, match="buckets"):
        C.BucketedTable(spark, scratch(spark, "t"))


def test_manifest_in_parts(spark, monkeypatch):
    """Only the parts that name touched buckets are written anew."""
    monkeypatch.setattr(C, "BUCKETS_PER_PART", 4)
    table = C.BucketedTable(spark, scratch(spark, "t"), 16)
    table.apply(spark.createDataFrame([("e", f"p{i}", 1, "start", "A") for i in range(200)], SCHEMA))
    old = table._current()[1]["parts"]
    table.apply(spark.createDataFrame([("e", "p0", 2, "end", "B")], SCHEMA))
    new = table._current()[1]["parts"]
    assert len(old) == 4 and sum(old[p] != new[p] for p in old) == 1
    table.vacuum()
    assert table.read().count() == 200


def test_rebucket(spark):
    rows = feed(3)
    table = C.BucketedTable(spark, scratch(spark, "t"), 2)
    table.apply(spark.createDataFrame(rows[:200], SCHEMA))
    table.rebucket(7)
    table.apply(spark.createDataFrame(rows[200:], SCHEMA))
    got = {(g.engine_id, g.process_instance_id): (g.stream_sequence, g.state) for g in C.present(table.read()).collect()}
    assert got == brute(rows) and C.BucketedTable(spark, table.root).buckets == 7
    assert {b for (b,) in table._read(sorted(table.folders().values())).select("__bucket").distinct().collect()} <= set(range(7))


def test_half_written_manifest_is_none(spark):
    table = C.BucketedTable(spark, scratch(spark, "t"), 2)
    table.apply(spark.createDataFrame([("e", "p", 1, "start", "A")], SCHEMA))
    path, fs = hadoop_path(spark, f"{table.root}/manifest-2.json")
    out = fs.create(path, False)
    out.write(bytearray(b'{"buckets": 2, "pa'))
    out.close()
    assert C.present(C.BucketedTable(spark, table.root).read()).count() == 1
    assert table.apply(spark.createDataFrame([("e", "p", 2, "end", "B")], SCHEMA)) == 3
    assert [g.state for g in C.present(table.read()).collect()] == ["B"]


def test_p5_found_merges_into_what_is_there(spark, monkeypatch):
    """The query's later change sets go through the merge, and replace files of the first."""
    from histrail.plans import quality

    versions, merges = [], []
    real_apply, real_merge = C.BucketedTable.apply, C.merge

    def apply(self, changes):
        version = real_apply(self, changes)
        versions.append((version, self.folders()))
        return version

    monkeypatch.setattr(C.BucketedTable, "apply", apply)
    monkeypatch.setattr(C, "merge", lambda a, b: merges.append(1) or real_merge(a, b))
    quality.p5_found(spark, SMALL).count()
    assert [v for v, _ in versions] == [1, 2, 3] and len(merges) == 2
    first, last = versions[0][1], versions[-1][1]
    assert any(first[b] != last[b] for b in first)
