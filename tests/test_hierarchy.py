import random

import pytest

from histrail.operators import hierarchy as H


def brute(parents):
    out = {}
    for x in parents:
        seen, path, y = set(), [x], x
        while True:
            if y in seen:
                out[x] = ("", -1, None)
                break
            seen.add(y)
            p = parents[y]
            if p is None or p not in parents:
                out[x] = (y, len(path) - 1, path[::-1])
                break
            path.append(p)
            y = p
    return out


def run(spark, parents, paths=True):
    nodes = spark.createDataFrame([(k, v, "z") for k, v in parents.items()], "id string, up string, root string")
    return {g.node: (g.root, g.depth, g.path if paths else None) for g in H.hierarchy(nodes, "id", "up", paths=paths).collect()}


@pytest.mark.parametrize(("seed", "busy"), [(1, 100_000), (2, 5)])
def test_against_brute_force(spark, monkeypatch, seed, busy):
    """With no busy parents, many, and a few."""
    monkeypatch.setattr(H, "BUSY_ROWS", busy)
    r = random.Random(seed)
    parents = {f"n{i}": r.choice([None, f"n{r.randrange(150)}", f"n{max(0, i - 1)}", "gone", "n3"]) for i in range(150)}
    assert run(spark, parents) == brute(parents)


@pytest.mark.parametrize("busy", [100_000, 50])
def test_deep_chain_ring_and_busy_parent(spark, monkeypatch, busy):
    monkeypatch.setattr(H, "BUSY_ROWS", busy)
    parents = {f"c{i}": f"c{i - 1}" if i else None for i in range(200)}
    parents |= {f"r{i}": f"r{(i + 1) % 40}" for i in range(40)} | {f"u{i}": "r7" for i in range(5)} | {"self": "self"}
    parents |= {f"b{i}": "hub" for i in range(100)} | {"hub": "c5"}
    want = {k: (a, b, None) for k, (a, b, _) in brute(parents).items()}
    assert run(spark, parents, paths=False) == want


def test_busy_parents_are_sent_to_all_tasks(spark, monkeypatch):
    monkeypatch.setattr(H, "BUSY_ROWS", 50)
    left = spark.createDataFrame([("hub" if i < 80 else f"k{i}", i) for i in range(100)], "k string, v long")
    right = spark.createDataFrame([("hub", 1), ("k85", 2), ("other", 3)], "k string, w long")
    joined = H._join_busy(left, right, "k", 100)
    assert sorted(map(str, joined.collect())) == sorted(map(str, left.join(right, "k", "left").select(*joined.columns).collect()))
    assert H._join_busy(left, right, "k", 100, "inner").count() == 81
    # no more keys are sent than the bound allows, whatever the number of rows
    monkeypatch.setattr(H, "MOST_BUSY", 1)
    assert H._join_busy(left, right, "k", 100).count() == 100


def test_ring_without_splitter(spark, monkeypatch):
    monkeypatch.setattr(H, "SPLIT_EVERY", 1 << 40)
    monkeypatch.setattr(H, "BUSY_PARENT", 1 << 40)
    parents = {f"r{i}": f"r{(i + 1) % 9}" for i in range(9)} | {f"c{i}": f"c{i - 1}" if i else None for i in range(150)} | {"u": "r0"}
    want = brute(parents)
    assert run(spark, parents) == want


def test_empty_and_roots_only(spark):
    assert run(spark, {"a": None, "b": "nowhere", "c": ""}) == {"a": ("a", 0, ["a"]), "b": ("b", 0, ["b"]), "c": ("c", 0, ["c"])}
    nodes = spark.createDataFrame([], "id string, up string")
    assert H.hierarchy(nodes, "id", "up").count() == 0


def test_descendants(spark):
    parents = {"a": None, "b": "a", "c": "b", "d": "b", "x": "x"}
    nodes = spark.createDataFrame(list(parents.items()), "id string, up string")
    tree = H.hierarchy(nodes, "id", "up", paths=True).cache()
    assert {tuple(g) for g in H.descendants(tree).collect()} == {("a", 3, 2), ("b", 2, 1)}
    got = H.descendants_of(tree, spark.createDataFrame([("b",)], "node string")).collect()
    assert {tuple(g) for g in got} == {("b", "c", 1), ("b", "d", 1)}


def test_descendants_are_counted_without_pairs(spark):
    r = random.Random(9)
    parents = {f"n{i}": f"n{r.randrange(max(1, i - 9), i + 1) - 1}" if i > 3 else None for i in range(120)} | {"p": "q", "q": "p", "s": "p"}
    nodes = spark.createDataFrame(list(parents.items()), "id string, up string")
    want: dict[str, list[int]] = {}
    for path in (x[2] for x in brute(parents).values() if x[2]):
        for at, a in enumerate(path[:-1]):
            n = want.setdefault(a, [0, 0])
            n[0], n[1] = n[0] + 1, max(n[1], len(path) - 1 - at)
    got = {g.node: [g.n_descendants, g.deepest] for g in H.descendants(H.hierarchy(nodes, "id", "up")).collect()}
    assert got == want


def test_all_descendants_with_cycles(spark):
    r = random.Random(5)
    parents = {f"n{i}": r.choice([None, f"n{r.randrange(60)}", f"n{r.randrange(60)}", "gone"]) for i in range(60)}
    parents |= {f"r{i}": f"r{(i + 1) % 7}" for i in range(7)} | {"u0": "r3", "u1": "u0", "u2": "u1", "self": "self", "below": "self", "lower": "below", "a": "b", "b": "a"}
    want = set()
    for x in parents:
        seen, y = [x], parents[x]
        while y in parents and y not in seen:
            want.add((y, x, len(seen)))
            seen.append(y)
            y = parents[y]
    nodes = spark.createDataFrame(list(parents.items()), "id string, up string")
    got = [tuple(g) for g in H.all_descendants(nodes, "id", "up").collect()]
    assert len(got) == len(want) and set(got) == want and ("u0", "u2", 2) in want and ("self", "lower", 2) in want
