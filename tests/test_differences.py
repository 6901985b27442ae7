import random

import pyarrow as pa
import pytest

from pyspark.sql import functions as F

from histrail.operators import differences as D


def brute(left, right, fields):
    """Rows are (key1, key2, *fields); the least row of a key stands for it."""
    pick = lambda rows: {k: min((r for r in rows if r[:2] == k), key=lambda r: [(x is not None, x) for x in r[2:]]) for k in {r[:2] for r in rows}}
    a, b = pick(left), pick(right)
    out = {(*k, "missing_right") for k in a.keys() - b.keys()} | {(*k, "missing_left") for k in b.keys() - a.keys()}
    for k in a.keys() & b.keys():
        out |= {(*k, f) for f, x, y in zip(fields, a[k][2:], b[k][2:], strict=True) if x != y}
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_brute_force(spark, seed):
    r = random.Random(seed)
    value = lambda: r.choice([None, "", "a", "b"])
    row = lambda: (r.choice([None, "e1", "e2"]), r.choice([None, "", *(f"k{i}" for i in range(20))]), value(), r.choice([None, 1, 2]))
    left, right = [row() for _ in range(40)], [row() for _ in range(40)]
    left += left[:10]
    schema = "e string, k string, x string, n long"
    got = D.diff_copies(spark.createDataFrame(left, schema), spark.createDataFrame(right, schema), ["e", "k"], ["x", "n"], buckets=3).collect()
    assert {(g.e, g.k, g.difference) for g in got} == brute(left, right, ["x", "n"])
    assert len(got) == len({(g.e, g.k, g.difference) for g in got})


def test_values_and_conflicts(spark):
    schema = "k string, x string, extra string"
    left = spark.createDataFrame([("a", "1", "z"), ("b", "2", "z"), ("b", "3", "z")], schema)
    right = spark.createDataFrame([("a", None, "q"), ("b", "2", "q")], schema)
    got = {(g.k, g.difference, g.left_value, g.right_value) for g in D.diff_copies(left, right, ["k"], ["x"], split_left="conflict").collect()}
    assert got == {("a", "x", "1", None), ("b", "conflict", None, None)}


def test_empty_sides(spark):
    schema = "k string, x string"
    none, one = spark.createDataFrame([], schema), spark.createDataFrame([("a", "1")], schema)
    assert D.diff_copies(none, none, ["k"], ["x"]).count() == 0
    assert [g.difference for g in D.diff_copies(one, none, ["k"], ["x"]).collect()] == ["missing_right"]
    assert [g.difference for g in D.diff_copies(none, one, ["k"], ["x"]).collect()] == ["missing_left"]


def test_very_long_values(spark):
    schema = "k string, x string"
    long = "é" * 200_000
    got = D.diff_copies(spark.createDataFrame([(long, long)], schema), spark.createDataFrame([(long, long + "!")], schema), ["k"], ["x"]).collect()
    assert [g.difference for g in got] == ["x"]


def test_keys_of_one_hash():
    """Keys that share a hash are told apart by the keys themselves."""
    left = pa.table({"__hash": [5, 5, 7], "__key": ["a", "b", "c"]})
    right = pa.table({"__hash": [5, 5, 9], "__key": ["b", "a", "c"]})
    a, b = D._align(left, right)
    assert {(left["__key"][int(i)].as_py(), right["__key"][int(j)].as_py()) for i, j in zip(a, b, strict=True)} == {("a", "a"), ("b", "b")}
    assert len(D._align(left, right.slice(0, 0))[0]) == 0


def test_reserved_names(spark):
    df = spark.createDataFrame([("a", "1")], "__hash string, x string")
    with pytest.raises(ValueError, match="underscores"):
        D.diff_copies(df, df, ["__hash"], ["x"])


def test_rows_that_disagree_are_reported(spark, tmp_path):
    """p1_cells tells of keys whose rows differ on one side; p1_found compares the least of them and has no row for that."""
    import shutil

    from histrail.plans import quality

    from .conftest import SMALL

    for t in ("process_instance_history", "class_cutover_state"):
        shutil.copy(f"{SMALL}/{t}.parquet", tmp_path)
    theirs = spark.read.parquet(f"{SMALL}/act_hi_procinst.parquet")
    one = theirs.filter("process_instance_id IS NOT NULL").limit(1).withColumn("business_key", F.lit("zzz another"))
    theirs.unionByName(one).write.parquet(f"{tmp_path}/act_hi_procinst.parquet")
    kinds = [r.difference for r in quality.p1_cells(spark, str(tmp_path)).collect()]
    assert kinds.count("rows_disagree_in_engine") == 1
    assert not any(r.difference.startswith("rows_") for r in quality.p1_found(spark, str(tmp_path)).collect())


def test_unique_sides_need_no_aggregate(spark):
    left = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, v long")
    right = spark.createDataFrame([("a", 1), ("b", 5), ("c", 3)], "k string, v long")
    plain = sorted(map(str, D.diff_copies(left, right, ["k"], ["v"]).collect()))
    assert sorted(map(str, D.diff_copies(left, right, ["k"], ["v"], unique_left=True, unique_right=True).collect())) == plain and len(plain) == 3
