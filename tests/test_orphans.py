import random
from datetime import datetime, timedelta

import pytest

from histrail.operators import orphans as O

T0 = datetime(2025, 1, 1)
REFS = "ref_table string, ref_id string, ref_month string, target string, seen_at timestamp, extra string"
PARENTS = "key string, gone boolean, created_at timestamp, ref_id string"


def brute(refs, parents):
    by = {p[0]: p for p in parents}
    out = []
    for t, i, m, target, seen, _ in refs:
        p = by.get(target)
        kind = "missing" if p is None or target is None else "deleted" if p[1] else "late" if p[2] and seen and p[2] > seen else None
        if kind:
            out.append((t, i, m, target, kind))
    return sorted(out, key=str)


@pytest.mark.parametrize(("seed", "per_task", "per_range"), [(1, 500_000, 20_000), (2, 20, 3), (3, 50, 1)])
def test_against_brute_force(spark, monkeypatch, seed, per_task, per_range):
    monkeypatch.setattr(O, "REFS_PER_TASK", per_task)
    monkeypatch.setattr(O, "PARENTS_PER_RANGE", per_range)
    r = random.Random(seed)
    time = lambda: r.choice([None, *(T0 + timedelta(days=d) for d in range(9))])
    parents = [(f"k{i}", r.choice([None, True, False]), time(), "x") for i in range(30)]
    refs = [("t", f"r{i}", "2025-01", r.choice(["k1", "k1", None, "", f"k{r.randrange(40)}"]), time(), "x") for i in range(300)]
    refs += refs[:20]
    got = O.find_orphans(spark.createDataFrame(refs, REFS), spark.createDataFrame(parents, PARENTS))
    assert sorted((tuple(g) for g in got.collect()), key=str) == brute(refs, parents)


def test_empty(spark):
    refs, none = spark.createDataFrame([("t", "a", None, "k", T0, "")], REFS), spark.createDataFrame([], PARENTS)
    assert [g.orphan_kind for g in O.find_orphans(refs, none).collect()] == ["missing"]
    assert O.find_orphans(refs.limit(0), none).count() == 0
    report = O.orphan_report(O.find_orphans(refs, none)).collect()
    assert [(x.ref_month, x.orphan_kind, x.n_refs, x.n_targets) for x in report] == [(None, "missing", 1, 1)]


def test_very_long_keys(spark):
    long = "x" * 100_000
    refs = spark.createDataFrame([("t", "a", "m", long, T0, ""), ("t", "b", "m", long + "y", T0, "")], REFS)
    parents = spark.createDataFrame([(long, False, T0, "")], PARENTS)
    assert [(g.ref_id, g.orphan_kind) for g in O.find_orphans(refs, parents).collect()] == [("b", "missing")]
