"""Root, depth and path of every node of parent-child trees of unknown depth, with cycles shown."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialise

#: One node in so many is a splitter by its hash.
SPLIT_EVERY = 16
#: A node with so many children is a splitter as well, so that no walk piles up on it.
BUSY_PARENT = 64
#: A right-hand row that so many left-hand rows join is sent to all tasks instead; with more than ``MOST_BUSY`` times as many
#: rows in all, the bound rises, so that no more than ``MOST_BUSY`` such rows are sent.
BUSY_ROWS, MOST_BUSY = 100_000, 10_000


def _join_busy(left: DataFrame, right: DataFrame, key: str, n_left: int, how: str = "left") -> DataFrame:
    """Join by ``key``, unique on the right and not null: rows of keys that many left-hand rows have don't meet in one task."""
    bound = max(BUSY_ROWS, -(-n_left // MOST_BUSY))
    if n_left <= bound:
        return left.join(right, key, how)
    counts = left.groupBy(key).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > bound)
    busy = [r[0] for r in counts.select(key).collect()]  # at most MOST_BUSY
    if not busy:
        return left.join(right, key, how)
    names = F.broadcast(left.sparkSession.createDataFrame([(b,) for b in busy], f"{key} string"))
    few = right.join(names, key, "left_semi")
    return left.join(names, key, "left_anti").join(right, key, how).unionByName(left.join(names, key, "left_semi").join(F.broadcast(few), key, how))


def _step(open_: DataFrame, targets: DataFrame) -> DataFrame:
    """One doubling step: every open pointer takes over its target's pointer. The target of an open pointer has a row."""
    t = targets.select(F.col("node").alias("__n"), F.col("ptr").alias("__p"), F.col("dist").alias("__d"), F.col("done").alias("__f"), F.col("path").alias("__w"))
    joined = open_.join(t, F.col("ptr") == F.col("__n"), "inner")
    return joined.select("node", F.col("__p").alias("ptr"), (F.col("dist") + F.col("__d")).alias("dist"), F.col("__f").alias("done"), F.concat("path", "__w").alias("path"))


def _resolve(rows: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """Follow every pointer (``node, ptr, dist, done, path``) until it is done. Returns the resolved rows and the nodes
    that never get there.

    Only open rows move, and an inner join lets the adaptive planner broadcast them once they are few. After r rounds a row is
    open when its way is longer than 2**r. The nodes on a way of length d that are still open are d - 2**r of the u open ones, so a way that ends is no longer than u + 2**r:
    once 2**r reaches that, what is open runs in circles.
    """
    resolved, open_, table = rows.filter("done"), rows.filter(~F.col("done")), rows
    left, rounds = open_.count(), 0
    longest = left + 1
    while left and 2**rounds < longest:
        moved = materialise(_step(open_, table), f"{name}-{rounds}")
        resolved, open_ = resolved.unionByName(moved.filter("done")), moved.filter(~F.col("done"))
        table, rounds, left = resolved.unionByName(open_), rounds + 1, open_.count()
        longest = min(longest, left + 2**rounds)
    return resolved, open_.select("node")


def _resolve_paths(rows: DataFrame, name: str, paths: bool) -> tuple[DataFrame, DataFrame]:
    """:func:`_resolve`; for paths the endless walks are found first, without them, for theirs would double every round."""
    if not paths:
        return _resolve(rows, name)
    _, endless = _resolve(rows.withColumn("path", F.lit(None).cast("array<string>")), f"{name}-look")
    resolved, _ = _resolve(rows.join(endless, "node", "left_anti"), name)
    return resolved, endless


def hierarchy(nodes: DataFrame, node: str, parent: str, *, paths: bool = False) -> DataFrame:
    """``node, parent, root, depth`` and, with ``paths``, ``path`` (from the root down to the node itself) of every row.

    ``nodes`` has unique, non-null ids in ``node``; other columns are ignored. A parent that is no node ends the chain: the
    row below it is a root of depth 0, as is a row with a null parent. Where the chain never ends, in a cycle or below
    one, the root is an empty string, the depth -1 and the path null. A node that is its own parent is a cycle.

    Deterministic splitters (by hash, and parents of many children) cut the chains; every node walks to its next splitter
    by pointer doubling, which takes the logarithm of the longest stretch without one; the graph of splitters alone is
    solved the same way, and its answers are added to the walks. Each round is written to the shared folder, and only the
    rows still walking take part in the next. Cycles without a splitter are the walks that provably never end, see
    :func:`_resolve`. With ``paths`` the result is as large as the sum of all depths; without, it is one short row a node.
    """
    # read several times below, so what it comes from is worked out once
    base = materialise(nodes.select(F.col(node).alias("node"), F.col(parent).alias("parent")).filter(F.col("node").isNotNull()), "tree-nodes")
    no_path = F.lit(None).cast("array<string>")
    # rows without a parent, often most, are roots and take no part in any join
    below_some = base.filter(F.col("parent").isNotNull())
    n_below = below_some.count()
    # in-degree per parent: one hash aggregate, then one join of distinct parents with the nodes
    parents = below_some.groupBy("parent").agg(F.count(F.lit(1)).alias("__k"))
    known = parents.join(base.select(F.col("node").alias("parent"), F.col("parent").alias("__up")), "parent", "inner")
    # whether the parent is itself a root needs its own parent to exist: ask for the parents of parents in the same way
    exists = base.select(F.col("node").alias("__up"), F.lit(True).alias("__has"))
    of_roots = known.filter(F.col("__up").isNull()).withColumn("__has", F.lit(None).cast("boolean"))
    known = _join_busy(known.filter(F.col("__up").isNotNull()), exists, "__up", n_below).unionByName(of_roots)
    hashed = F.pmod(F.xxhash64("parent"), F.lit(SPLIT_EVERY)) == 0
    known = known.select("parent", F.col("__has").isNull().alias("__root"), (hashed | (F.col("__k") >= BUSY_PARENT)).alias("__split"))
    linked = _join_busy(below_some, known, "parent", n_below).select("node", "parent", F.col("__root").isNotNull().alias("__linked"), "__root", "__split")
    linked = materialise(linked, "tree-links")

    walk = linked.filter("__linked").select(
        "node", F.col("parent").alias("ptr"), F.lit(1).cast("long").alias("dist"), (F.col("__root") | F.col("__split")).alias("done"),
        (F.array("parent") if paths else no_path).alias("path"),
    )
    walked, endless = _resolve_paths(walk, "tree-walk", paths)
    walked = materialise(walked, "tree-walked")

    # the reduced graph: a splitter that is no root, with the walk to its own next splitter
    ends = walked.select(F.col("ptr").alias("node")).distinct()
    reduced = walked.join(ends, "node", "left_semi")
    is_end = reduced.select(F.col("node").alias("ptr"), F.lit(False).alias("__last"))
    lost = endless.select(F.col("node").alias("ptr"), F.lit(False).alias("__lost"))
    # done means that the pointer is a root: neither a splitter with a way up nor a node of an endless walk
    open_ends = is_end.unionByName(lost.join(ends.withColumnRenamed("node", "ptr"), "ptr", "left_semi").withColumnRenamed("__lost", "__last"))
    stepped = reduced.join(open_ends, "ptr", "left").select("node", "ptr", "dist", F.col("__last").isNull().alias("done"), "path")
    # a splitter whose walk is endless has no row of its own; it points at itself and so never ends either
    selves = open_ends.join(is_end, "ptr", "left_anti").select(F.col("ptr").alias("node"), "ptr", F.lit(0).cast("long").alias("dist"), F.lit(False).alias("done"), no_path.alias("path"))
    solved, circular = _resolve_paths(materialise(stepped.unionByName(selves), "tree-reduced"), "tree-solve", paths)

    tops = solved.select(F.col("node").alias("__n"), F.col("ptr").alias("__root"), F.col("dist").alias("__d"), F.col("path").alias("__w"))
    rings = circular.select(F.col("node").alias("__n"), F.lit("").alias("__root"), F.lit(-1).cast("long").alias("__d"), no_path.alias("__w"))
    answers = tops.unionByName(rings)
    bad: Column = F.col("__root").eqNullSafe("")
    answers = answers.withColumnRenamed("__n", "ptr")
    ended = _join_busy(walked, answers, "ptr", n_below).select(
        "node",
        F.coalesce("__root", "ptr").alias("root"),
        F.when(bad, F.lit(-1)).otherwise(F.col("dist") + F.coalesce("__d", F.lit(0))).cast("long").alias("depth"),
        F.when(bad, None).otherwise(F.concat("path", F.coalesce("__w", F.array().cast("array<string>")))).alias("path"),
    )
    never = endless.select("node", F.lit("").alias("root"), F.lit(-1).cast("long").alias("depth"), no_path.alias("path"))
    below = ended.unionByName(never)
    roots = linked.filter(~F.col("__linked")).select("node").unionByName(base.filter(F.col("parent").isNull()).select("node"))
    top = roots.select("node", F.col("node").alias("root"), F.lit(0).cast("long").alias("depth"), (F.array().cast("array<string>") if paths else no_path).alias("path"))
    answer = below.unionByName(top)
    if paths:  # walks are kept from the node upwards; the path reads from the root down
        answer = answer.withColumn("path", F.when(F.col("path").isNotNull(), F.concat(F.reverse("path"), F.array("node"))))
    return base.join(answer, "node", "left").select("node", "parent", "root", "depth", *(["path"] if paths else []))


def _rings(endless: DataFrame) -> DataFrame:
    """``node, least`` of the nodes on cycles, ``least`` being the least node of the cycle. ``endless`` (``node, parent``) holds
    the nodes whose walks never end, so every parent is among them.

    After 2**r >= n steps every walk is on its cycle, and the nodes reached are all the nodes of the cycles; the least of the
    nodes passed from there, at least once around, is that of the cycle.
    """
    walks = endless.select("node", F.col("parent").alias("ptr"), F.col("node").alias("least"))
    left, rounds = walks.count(), 0
    while 2**rounds < left:
        to = walks.select(F.col("node").alias("ptr"), F.col("ptr").alias("__p"), F.col("least").alias("__l"))
        walks = materialise(walks.join(to, "ptr", "inner").select("node", F.col("__p").alias("ptr"), F.least("least", "__l").alias("least")), f"ring-{rounds}")
        rounds += 1
    return walks.join(walks.select(F.col("ptr").alias("node")).distinct(), "node", "left_semi").select("node", "least")


def lineage(nodes: DataFrame, node: str, parent: str) -> DataFrame:
    """``node, above``: for every row of ``nodes`` (as for :func:`hierarchy`) all its ancestors, the nearest first, each once.

    Where the chain runs into a cycle it stops before it would come to a node again: a node below a cycle has all nodes of the
    cycle above it, a node on one all the others. Such components are cut open above the least node of the cycle, which makes
    them trees with that node as root; what the cut takes away from a path is the part of the cycle beyond the place where the
    chain enters it, and that is the end of the path of the node that was the root's parent.
    """
    base = materialise(nodes.select(F.col(node).alias("node"), F.col(parent).alias("parent")).filter(F.col("node").isNotNull()), "lineage-nodes")
    tree = materialise(hierarchy(base, "node", "parent", paths=True), "lineage-tree")
    up = lambda path: F.reverse(F.slice(path, 1, F.size(path) - 1))
    ended = tree.filter(F.col("path").isNotNull()).select("node", up(F.col("path")).alias("above"))
    endless = materialise(tree.filter(F.col("path").isNull()).select("node", "parent"), "lineage-endless")
    if endless.isEmpty():
        return ended
    tops = materialise(_rings(endless).filter(F.col("node") == F.col("least")).select("node"), "lineage-tops")
    cut = endless.join(tops.withColumn("__top", F.lit(True)), "node", "left").select("node", F.when(F.col("__top").isNull(), F.col("parent")).alias("parent"))
    opened = materialise(hierarchy(cut, "node", "parent", paths=True), "lineage-opened")
    last = endless.join(tops, "node", "left_semi").select(F.col("node").alias("root"), F.col("parent").alias("node"))
    rings = opened.select("node", F.col("path").alias("ring")).join(last, "node", "inner").select("root", "ring")
    entered = F.size(F.array_intersect("path", "ring"))  # the path and the cycle have their beginning in common
    beyond = F.reverse(F.slice(F.col("ring"), entered + 1, F.size("ring")))
    return ended.unionByName(opened.join(rings, "root", "inner").select("node", F.concat(up(F.col("path")), beyond).alias("above")))


def all_descendants(nodes: DataFrame, node: str, parent: str) -> DataFrame:
    """``ancestor, descendant, distance`` of every node and each node below it, in and below cycles too; no node is its own
    descendant. The result is as large as the sum of all depths, a node on a cycle counting as below all the others."""
    return lineage(nodes, node, parent).select(F.posexplode("above").alias("at", "ancestor"), F.col("node").alias("descendant")).select("ancestor", "descendant", (F.col("at") + 1).cast("long").alias("distance"))


def descendants(tree: DataFrame) -> DataFrame:
    """``node, n_descendants, deepest``: how many nodes lie below each node that has any, and how far down.

    ``tree`` is the result of :func:`hierarchy`. No pair of ancestor and descendant is made: in round r every node knows how
    many nodes lie fewer than 2**r steps below it, and adds what those exactly 2**r steps below know; the number of rounds
    is the logarithm of the greatest depth. Nodes in and below cycles have no row here; :func:`all_descendants` has theirs.
    """
    ended = tree.filter(F.col("depth") >= 0)
    rows = materialise(ended.select("node", F.when(F.col("depth") > 0, F.col("parent")).alias("up"), F.lit(1).cast("long").alias("n"), F.lit(0).cast("long").alias("deepest")), "below-0")
    rounds = 0
    left = rows.filter(F.col("up").isNotNull()).count()
    while left:
        more = rows.filter(F.col("up").isNotNull()).groupBy(F.col("up").alias("node")).agg(F.sum("n").alias("__n"), F.max("deepest").alias("__d"))
        grown = rows.join(more, "node", "left").select("node", "up", (F.col("n") + F.coalesce("__n", F.lit(0))).alias("n"), F.coalesce(F.col("__d") + 2**rounds, "deepest").alias("deepest"))
        rounds += 1
        # who has nobody so far up is done with asking
        further = rows.filter(F.col("up").isNotNull()).select(F.col("node").alias("up"), F.col("up").alias("__up"))
        asking = _join_busy(grown.filter(F.col("up").isNotNull()), further, "up", left)
        rows = materialise(asking.select("node", F.col("__up").alias("up"), "n", "deepest").unionByName(grown.filter(F.col("up").isNull())), f"below-{rounds}")
        left = rows.filter(F.col("up").isNotNull()).count()
    return rows.filter(F.col("n") > 1).select("node", (F.col("n") - 1).alias("n_descendants"), "deepest")


def descendants_of(tree: DataFrame, ancestors: DataFrame) -> DataFrame:
    """``ancestor, descendant, distance`` for the ids in ``ancestors.node``: an explode of the paths and a semi join."""
    pairs = tree.filter(F.size("path") > 1).select(F.posexplode("path").alias("at", "ancestor"), F.col("node").alias("descendant"), "depth").filter(F.col("ancestor") != F.col("descendant"))
    wanted = ancestors.select(F.col("node").alias("ancestor")).distinct()
    return pairs.join(wanted, "ancestor", "left_semi").select("ancestor", "descendant", (F.col("depth") - F.col("at")).alias("distance"))
