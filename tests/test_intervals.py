import random

import pytest
from pyspark.sql import functions as F

from histrail.operators import intervals as I

SCHEMA = "e string, s long, t long, extra string"


def brute(rows):
    """Periods and gaps of each entity, by a sweep."""
    periods, gaps = set(), set()
    for e in {r[0] for r in rows}:
        iv = sorted((s, t if t is not None else float("inf")) for x, s, t, _ in rows if x == e and s is not None and (t is None or t > s))
        if not iv:
            continue
        start, end = iv[0]
        for s, t in iv[1:]:
            if s > end:
                periods.add((e, start, end))
                gaps.add((e, end, s))
                start, end = s, t
            end = max(end, t)
        periods.add((e, start, None if end == float("inf") else end))
    return periods, gaps


@pytest.mark.parametrize(("seed", "per_shard"), [(1, 10**6), (2, 5), (3, 20), (4, 1)])
def test_against_brute_force(spark, seed, per_shard):
    r = random.Random(seed)
    rows = []
    for _ in range(400):
        s = r.choice([None, *range(300)]) if r.random() < 0.1 else r.randrange(5000)
        t = None if r.random() < 0.01 else (s or 0) + r.choice([-3, 0, 1, 2, 5, 30, 400 if r.random() < 0.1 else 4])
        rows.append((r.choice(["hot", "hot", "hot", "a", "b", None, ""]), s, t, "x"))
    rows += rows[:50]
    df = spark.createDataFrame(rows, SCHEMA)
    periods, gaps = brute(rows)
    got = I.gaps(df, "e", "s", "t", per_shard=per_shard).collect()
    assert sorted(map(str, got)) == sorted(str(type(got[0])) and f"Row(e={g[0]!r}, gap_start={g[1]}, gap_end={g[2]})" for g in gaps)
    assert {tuple(p) for p in I.periods(df, "e", "s", "t", per_shard=per_shard).collect()} == periods


def test_many_huge_entities(spark, monkeypatch):
    """With more shards than there may be, they are larger."""
    rows = [(f"e{k % 5}", k * 10, k * 10 + k % 17, None) for k in range(200)]
    df = spark.createDataFrame(rows, SCHEMA)
    for most in (100_000, 10):
        monkeypatch.setattr(I, "MOST_SHARDS", most)
        assert {tuple(g) for g in I.gaps(df, "e", "s", "t", per_shard=7).collect()} == brute(rows)[1]


def shard_sizes(df, per_shard):
    clean = I._clean(df, "e", "s", "t")
    return [r[0] for r in I._sharded(clean, I.shard_cuts(clean.select("__e", "__s"), per_shard)).groupBy("__e", "__k").count().select("count").collect()]


@pytest.mark.parametrize("kind", ["outlier", "burst", "equal starts"])
def test_shards_are_equal_by_rank(spark, kind):
    """100,000 intervals in shards of about 2,000: one far-off start, most of them within a moment, or all at one start."""
    n, bound = 100_000, 2_000
    start = {"outlier": F.when(F.col("id") == 0, -(10**12)).otherwise(F.col("id") * 10), "burst": F.when(F.col("id") % 10 > 0, F.col("id") % 50 + 10**9).otherwise(F.col("id") * 10**6), "equal starts": F.lit(5)}[kind]
    df = spark.range(n).select(F.lit("a").alias("e"), start.cast("long").alias("s"), F.col("id")).select("e", "s", (F.col("s") + 3 + F.col("id") % 50_000).alias("t"))
    sizes = shard_sizes(df, bound)
    assert max(sizes) <= 2 * bound and len(sizes) > 10


def test_copies_of_one_interval_are_one(spark):
    df = spark.createDataFrame([("a", 1, 5, "")] * 50 + [("a", 9, 12, "")] * 50, SCHEMA)
    assert [tuple(g) for g in I.gaps(df, "e", "s", "t", per_shard=3).collect()] == [("a", 5, 9)]


def test_edges(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert I.gaps(none, "e", "s", "t").count() == 0 and I.periods(none, "e", "s", "t").count() == 0
    touching = spark.createDataFrame([("a", 0, 5, ""), ("a", 5, 9, ""), ("a", 3, 3, ""), ("a", 20, 10, "")], SCHEMA)
    assert I.gaps(touching, "e", "s", "t").count() == 0
    assert [tuple(p) for p in I.periods(touching, "e", "s", "t").collect()] == [("a", 0, 9)]


def test_interval_over_all_shards(spark):
    rows = [("a", 0, 10_000, "")] + [("a", k, k + 1, "") for k in range(0, 9_000, 30)] + [("a", 10_005, 10_006, "")]
    df = spark.createDataFrame(rows, SCHEMA)
    assert [tuple(g) for g in I.gaps(df, "e", "s", "t", per_shard=3).collect()] == [("a", 10_000, 10_005)]
