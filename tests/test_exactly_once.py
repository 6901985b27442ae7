import random
from datetime import datetime, timedelta

import pytest

from histrail.operators import exactly_once as X
from histrail.session import scratch

from .conftest import SMALL

T0 = datetime(2025, 1, 1)


def stream(spark, folder, files_per_batch=1):
    return spark.readStream.schema(X.MESSAGE).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def write(spark, rows, folder):
    spark.createDataFrame(rows, X.MESSAGE).coalesce(1).write.mode("append").parquet(folder)


def want(rows):
    by = {}
    for s, m, n, _ in rows:
        by.setdefault((s, m), []).append(n)
    return sorted((*k, n) for k, v in by.items() for n in sorted(v)[1:])


def found(spark, root):
    return sorted(tuple(r) for r in X.surplus(spark, root).collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_any_order_over_batches(spark, seed):
    r = random.Random(seed)
    rows = [(r.choice(["a", "b"]), r.choice(["hot", "hot", f"m{r.randrange(60)}"]), n, T0 + timedelta(minutes=r.randrange(300))) for n in range(300)]
    r.shuffle(rows)
    root = scratch(spark, "x")
    for lo in range(0, 300, 75):
        write(spark, rows[lo : lo + 75], f"{root}/in")
    X.run_dedup(stream(spark, f"{root}/in"), root, 5)
    assert found(spark, root) == want(rows)
    firsts = {(r.source, r.message_id): r.arrival_no for r in X.current_first(spark, root).collect()}
    assert firsts == {(s, m): min(x[2] for x in rows if x[:2] == (s, m)) for s, m in {x[:2] for x in rows}}
    # a second run has nothing to do, and new files are taken in against the state
    X.run_dedup(stream(spark, f"{root}/in"), root, 5)
    more = [("a", "hot", 1000, T0), ("a", "new", 1001, T0), ("a", "hot", -5, T0)]
    write(spark, more, f"{root}/in")
    X.run_dedup(stream(spark, f"{root}/in"), root, 5)
    assert found(spark, root) == want(rows + more)


def test_late_copies_after_expiry(spark):
    """State expires by the watermark; a copy that comes after that is found in what was kept."""
    root = scratch(spark, "x")
    day = 86_400_000
    batches = [
        [("a", "old", 1, T0), ("a", "other", 2, T0)],
        [("a", "much later", 3, T0 + timedelta(days=90))],
        [("a", "later still", 4, T0 + timedelta(days=91)), ("a", "next", 5, T0 + timedelta(days=91))],
        [("a", "old", 6, T0), ("a", "never seen", 7, T0), ("a", "other", 0, T0)],
        [("a", "old", 8, T0), ("a", "never seen", 9, T0)],
    ]
    for b in batches:
        write(spark, b, f"{root}/in")
        X.run_dedup(stream(spark, f"{root}/in"), root, 1, keep_ms=10 * day)
    rows = [x for b in batches for x in b]
    assert found(spark, root) == want(rows)
    assert "late" in {r.verdict for r in X._verdicts(spark, root).select("verdict").distinct().collect()}
    assert {(r.message_id, r.arrival_no) for r in X.current_first(spark, root).collect()} == {(m, min(x[2] for x in rows if x[1] == m)) for m in {x[1] for x in rows}}


@pytest.mark.parametrize("seed", [1])
def test_copies_far_apart_in_time(spark, seed):
    """Copies of one message are stamped months apart, before and after its state has expired, over many batches."""
    r = random.Random(seed)
    root, rows = scratch(spark, "x"), []
    for b in range(5):
        batch = [("a", f"m{r.randrange(12)}", r.randrange(10_000), T0 + timedelta(days=30 * b + r.choice([0, 0, 1, -400, 20]))) for _ in range(15)]
        batch = [x for k, x in enumerate(batch) if x[2] not in {y[2] for y in batch[:k] + rows}]
        rows += batch
        write(spark, batch, f"{root}/in")
        X.run_dedup(stream(spark, f"{root}/in"), root, 2, keep_ms=5 * 86_400_000)
    assert found(spark, root) == want(rows)
    assert {(g.message_id, g.arrival_no) for g in X.current_first(spark, root).collect()} == {(m, min(x[2] for x in rows if x[1] == m)) for m in {x[1] for x in rows}}
    assert "late" in {g.verdict for g in X._verdicts(spark, root).select("verdict").distinct().collect()}


def test_sibling_files_are_not_taken(spark, tmp_path):
    """The stream takes the table itself and nothing whose name begins like it."""
    import shutil

    from histrail.plans import quality

    for t in quality.OUTBOXES:
        shutil.copy(f"{SMALL}/{t}.parquet", tmp_path)
        shutil.copy(f"{SMALL}/{t}.parquet", tmp_path / f"{t}.parquet.old")
    here = {tuple(g) for g in quality.p2_found(spark, str(tmp_path)).collect()}
    assert here == {tuple(g) for g in quality.p2_found(spark, SMALL).collect()}


def test_a_repeated_batch_overwrites_itself(spark):
    root = scratch(spark, "x")
    batch = spark.createDataFrame([("a", "m", 2, "surplus", 0), ("a", "m", 1, "kept", 0)], X._OUT)
    sink = X._Sink(root)
    sink(batch, 0)
    sink(batch, 0)
    assert found(spark, root) == [("a", "m", 2)]


def test_ties_nulls_and_empty(spark):
    root = scratch(spark, "x")
    write(spark, [("a", "m", 1, T0), ("a", "m", 1, T0), ("a", "", 2, None), ("a", "", 3, T0), ("a", "x" * 50_000, 4, T0), ("a", "x" * 50_000, 5, T0)], f"{root}/in")
    X.run_dedup(stream(spark, f"{root}/in").selectExpr("source", "message_id", "arrival_no", "coalesce(seen_at, timestamp_micros(0)) seen_at"), root, 2)
    assert found(spark, root) == [("a", "", 3), ("a", "m", 1), ("a", "x" * 50_000, 5)]
    empty = scratch(spark, "x")
    spark.createDataFrame([], X.MESSAGE).write.parquet(f"{empty}/in")
    X.run_dedup(stream(spark, f"{empty}/in"), empty, 2)
    assert found(spark, empty) == [] and X.current_first(spark, empty).count() == 0
