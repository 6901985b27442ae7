import random

import pytest
from pyspark.sql import functions as F

from histrail.operators import blobs, materialise, ordered


@pytest.mark.parametrize("hot", [10, 1_000_000])
def test_parts_give_what_one_window_gives(spark, monkeypatch, hot):
    """A key with two thirds of all rows, null keys and orders, repeated rows."""
    monkeypatch.setattr(ordered, "HOT_ROWS", hot)
    r = random.Random(1)
    rows = [(r.choice(["hot", "hot", "hot", "hot", "a", None]), n if n % 7 else None, r.choice([None, *range(50)])) for n in range(500)]
    df = spark.createDataFrame(rows, "k string, n long, v long").repartition(4)
    got = ordered.numbered(df, ["k"], ["n"], "at").collect()
    for key in ("hot", "a", None):
        mine = sorted((g for g in got if g.k == key), key=lambda g: g.at)
        assert [g.at for g in mine] == list(range(1, sum(x[0] == key for x in rows) + 1))
        assert [g.n for g in mine] == sorted((x[1] for x in rows if x[0] == key), key=lambda n: (n is not None, n or 0))
    unique = [(k, n, v) for k, n, v in rows if n is not None]
    before = {(g.k, g.n): g.b for g in ordered.max_before(spark.createDataFrame(unique, df.schema), ["k"], ["n"], "v", "b").collect()}
    assert before == {(k, n): max((v2 for k2, n2, v2 in unique if k2 == k and n2 < n and v2 is not None), default=None) for k, n, _ in unique}
    assert ordered.numbered(df.limit(0), ["k"], ["n"], "at").count() == 0 and ordered.max_before(df.limit(0), ["k"], ["n"], "v", "b").count() == 0


def test_hot_keys_in_the_operators(spark, monkeypatch):
    events = spark.range(300).select(F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), (F.col("id") * 7 % 101).alias("s"), F.col("id").alias("arrival_no"))
    cold = [sorted(map(str, d.collect())) for d in (materialise.outcomes(events, ["k"], "s", "arrival_no"), materialise.append_log(events, ["k"]), blobs.acquire(events, "k", "arrival_no"))]
    monkeypatch.setattr(ordered, "HOT_ROWS", 10)
    assert [sorted(map(str, d.collect())) for d in (materialise.outcomes(events, ["k"], "s", "arrival_no"), materialise.append_log(events, ["k"]), blobs.acquire(events, "k", "arrival_no"))] == cold
