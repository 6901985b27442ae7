import random
from collections import Counter

import pytest

from histrail.llm import packing as P


def check(rows, sizes, capacities):
    top = max(capacities)
    bins = {}
    pieces = Counter()
    for r in rows:
        pieces[r.k, r.piece] += 1
        bins.setdefault(r.bin_id, []).append(r)
    for k, n in Counter(sizes).items():
        assert pieces[k, 0] == n if isinstance(k, tuple) else True
    total = sum(r.n_tokens for r in rows)
    assert total == sum(max(0, s or 0) for s in sizes.values())
    for b in bins.values():
        assert len({r.bin_capacity for r in b}) == 1 and b[0].bin_capacity in capacities
        at = 0
        for r in sorted((r for r in b if r.n_tokens), key=lambda r: r.bin_offset):
            assert r.bin_offset == at
            at += r.n_tokens
        assert at <= b[0].bin_capacity and (b[0].bin_capacity == min(c for c in capacities if c >= at))
    for k, s in sizes.items():
        mine = sorted((r.piece, r.n_tokens) for r in rows if r.k == k)
        s = max(0, s or 0)
        assert [p for p, _ in mine] == list(range(max(1, -(-s // top)))) and all(n == top for _, n in mine[:-1]) and sum(n for _, n in mine) == s
    return len(bins), sum(b[0].bin_capacity for b in bins.values()), total


def first_fit(sizes, capacity):
    rooms = []
    for s in sorted(sizes, reverse=True):
        for i, r in enumerate(rooms):
            if r >= s:
                rooms[i] -= s
                break
        else:
            rooms.append(capacity - s)
    return len(rooms)


@pytest.mark.parametrize(("seed", "capacities"), [(1, [64]), (2, [16, 32, 64]), (3, [7])])
def test_packing(spark, monkeypatch, seed, capacities):
    monkeypatch.setattr(P, "ITEMS_PER_PART", 50)  # several parts of one size
    r = random.Random(seed)
    sizes = {i: r.choice([None, 0, 5, 5, 5, r.randrange(1, 40), r.randrange(1, 300)]) for i in range(400)}
    df = spark.createDataFrame([(i, s, "x") for i, s in sizes.items()], "k long, n long, piece string")
    n, capacity, total = check(P.pack(df, "k", "n", capacities).collect(), sizes, capacities)
    top = max(capacities)
    parts = [x for s in sizes.values() if s for x in [top] * (s // top) + [s % top] * (s % top > 0)]
    if len(capacities) == 1:
        assert n <= first_fit(parts, top)
    else:
        assert capacity <= first_fit(parts, top) * top


def test_repeated_keys_and_empty(spark):
    df = spark.createDataFrame([(1, 3), (1, 3), (1, 0)], "k long, n long")
    rows = P.pack(df, "k", "n", [4]).collect()
    assert sorted((r.n_tokens, r.bin_offset) for r in rows) == [(0, 0), (3, 0), (3, 0)] and len({r.bin_id for r in rows if r.n_tokens}) == 2
    assert P.pack(df.limit(0), "k", "n", [4]).count() == 0
    assert P.fill_report(P.pack(df, "k", "n", [4])).first().n_tokens == 6
    with pytest.raises(ValueError, match="positive"):
        P.Plan({1: 1}, [0])


def test_plan_depends_on_sizes_not_on_items():
    plan = P.Plan({s: 10**9 for s in range(1, 2049, 3)}, [2048])
    assert len(plan.counts) < 10_000
    used = sum(n * sum(s * k for s, k in f) for n, f in zip(plan.counts, plan.fills, strict=True))
    assert used == sum(s * 10**9 for s in range(1, 2049, 3)) and used > 0.995 * sum(n * c for n, c in zip(plan.counts, plan.sizes, strict=True))


def test_fillers_of_any_size_count():
    """What fits the rest of a new bin is looked for among all sizes to come, however many lie between."""
    sizes = {600: 1, **{k: 1 for k in range(200, 400)}, 24: 1}
    assert P.Plan(sizes, [620, 624])._open(600, dict(sizes)) == 624
