"""Filling containers of fixed capacities with items of varying length."""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections import defaultdict
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise

#: Items of one size are numbered in independent parts of about so many rows of the whole table, so that a size that a third
#: of all items share is not numbered by one task.
ITEMS_PER_PART = 200_000


class Plan:
    """Best-fit decreasing over a histogram of sizes: bins that hold the same sizes are one entry with a count.

    The work and the size of the plan depend on the number of different sizes, not on the number of items.
    """

    def __init__(self, histogram: dict[int, int], capacities: Sequence[int]):
        self.capacities = sorted(set(capacities))
        if not self.capacities or self.capacities[0] < 1:
            raise ValueError("capacities must be positive")
        self.counts: list[int] = []  # bins of each pattern
        self.fills: list[list[tuple[int, int]]] = []  # (size, items of it in each bin)
        self.sizes: list[int] = []  # the capacity of the pattern's bins, downsized at the end
        self._pack({s: n for s, n in histogram.items() if s > 0 and n > 0})

    def _new(self, fill: list[tuple[int, int]], count: int, capacity: int) -> int:
        self.counts.append(count)
        self.fills.append(fill)
        self.sizes.append(capacity)
        return len(self.counts) - 1

    def _open(self, size: int, left: dict[int, int]) -> int:
        """The least-cost capacity for a new bin: the least room left for each unit of capacity, after as many items of this
        size as fit and then the largest that fit the rest, of all sizes still to come; of equals the largest."""
        best, best_cost = 0, 2.0
        for c in self.capacities:
            if c < size:
                continue
            room = c - size * min(c // size, max(1, left[size]))
            # smaller sizes are all still to come, in rising order up to this one
            at = bisect_right(self._rising, min(room, size - 1)) - 1
            while room and at >= 0:
                s = self._rising[at]
                room -= s * min(room // s, left[s])
                at = bisect_right(self._rising, min(room, s - 1)) - 1
            cost = room / c
            if cost <= best_cost:
                best, best_cost = c, cost
        return best

    def _pack(self, left: dict[int, int]) -> None:
        room: list[int] = []  # the different amounts of room in open bins, sorted
        by_room: dict[int, list[int]] = defaultdict(list)

        def shelve(pattern: int, r: int) -> None:
            if r:
                if not by_room[r]:
                    insort(room, r)
                by_room[r].append(pattern)

        self._rising = sorted(left)
        for size in reversed(self._rising):
            while left[size]:
                at = bisect_left(room, size)
                if at == len(room):
                    capacity = self._open(size, left)
                    k = min(capacity // size, left[size])
                    bins = left[size] // k
                    left[size] -= bins * k
                    shelve(self._new([(size, k)], bins, capacity), capacity - size * k)
                    continue
                r = room[at]
                pattern = by_room[r].pop()
                if not by_room[r]:
                    room.pop(at)
                k = min(r // size, left[size])
                bins = min(self.counts[pattern], left[size] // k)
                if bins < self.counts[pattern]:  # the others keep their room
                    rest = self._new(list(self.fills[pattern]), self.counts[pattern] - bins, self.sizes[pattern])
                    self.counts[pattern] = bins
                    shelve(rest, r)
                self.fills[pattern].append((size, k))
                left[size] -= bins * k
                shelve(pattern, r - size * k)
        for p, fill in enumerate(self.fills):
            used = sum(s * k for s, k in fill)
            self.sizes[p] = next(c for c in self.capacities if c >= used)

    def slots(self) -> dict[int, np.ndarray]:
        """For each size, rows of (first rank, pattern's first bin, items a bin, place in the bin, capacity), by first rank.

        The item of this size with rank r (from 0) belongs to the last row that does not begin after r.
        """
        first_bin = np.concatenate([[0], np.cumsum(self.counts)])[:-1] if self.counts else np.zeros(0, np.int64)
        rank: dict[int, int] = defaultdict(int)
        out: dict[int, list[tuple[int, int, int, int, int]]] = defaultdict(list)
        for p, fill in enumerate(self.fills):
            place = 0
            for size, k in fill:
                out[size].append((rank[size], int(first_bin[p]), k, place, self.sizes[p]))
                rank[size] += k * self.counts[p]
                place += size * k
        return {s: np.array(rows, dtype=np.int64) for s, rows in out.items()}


def pack(items: DataFrame, key: str, size: str, capacities: Sequence[int]) -> DataFrame:
    """Put every item into a bin: ``key, piece, n_tokens, bin_id, bin_offset, bin_capacity``.

    ``capacities`` are the permitted bin sizes. An item larger than the largest is split into pieces of that size and a rest
    (``piece`` from 0); nothing else is split. The histogram of piece sizes (at most one number for each size up to the
    capacity) is packed best fit, largest first, on the driver, opening the least-cost capacity where no open bin has room,
    and downsizing every bin to its contents at the end. Pieces of one size are then numbered over the cluster, in salted
    parts, and their number alone gives bin and place. So the packing is that of one machine at any number of items, and no
    task sees more than one part of a size.

    Cases: items of size 0 or null take no room and stand at the start of bin 0, so that every item comes out once. Repeated
    keys are items of their own. An empty table gives no rows. Other columns are ignored.
    """
    spark = items.sparkSession
    largest = max(capacities)
    base = items.select(F.col(key).alias("__key"), F.greatest(F.lit(0), F.coalesce(F.col(size), F.lit(0))).cast("long").alias("__n"))
    last = F.greatest(F.lit(0), F.ceil(F.col("__n") / largest) - 1).cast("int")
    pieces = base.withColumn("__piece", F.explode(F.sequence(F.lit(0), last)))
    pieces = pieces.select("__key", "__piece", F.least(F.lit(largest), F.col("__n") - F.col("__piece").cast("long") * largest).cast("int").alias("__s"), F.monotonically_increasing_id().alias("__row"))
    pieces = materialise(pieces, "pieces")
    parts = max(1, -(-pieces.count() // ITEMS_PER_PART))
    pieces = pieces.withColumn("__part", F.pmod(F.xxhash64("__row"), F.lit(parts)).cast("int"))
    counts = materialise(pieces.groupBy("__s", "__part").agg(F.count(F.lit(1)).alias("__m")), "piece-counts")
    # one row a size comes to the driver; what lies before each part of a size is worked out over the cluster
    histogram = {s: n for s, n in counts.groupBy("__s").agg(F.sum("__m")).collect()}
    plan = Plan(histogram, capacities)
    shared = spark.sparkContext.broadcast(plan.slots())
    first = plan.sizes[0] if plan.sizes else min(capacities)
    earlier = Window.partitionBy("__s").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("__s", "__part", F.coalesce(F.sum("__m").over(earlier), F.lit(0)).alias("__before"))

    numbered = pieces.withColumn("__r", F.row_number().over(Window.partitionBy("__s", "__part").orderBy("__row")).cast("long"))
    ranked = numbered.join(before, ["__s", "__part"]).select("__key", "__piece", "__s", (F.col("__r") - 1 + F.col("__before")).alias("__rank"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots = shared.value
        for batch in batches:
            s, rank = batch.column(2).to_numpy(), batch.column(3).to_numpy()
            bin_id, offset, capacity = np.zeros(len(s), np.int64), np.zeros(len(s), np.int64), np.full(len(s), first, np.int64)
            for one in np.unique(s):
                if one == 0:
                    continue
                at, rows = np.flatnonzero(s == one), slots[int(one)]
                row = rows[np.searchsorted(rows[:, 0], rank[at], "right") - 1]
                nth = rank[at] - row[:, 0]
                bin_id[at] = row[:, 1] + nth // row[:, 2]
                offset[at] = row[:, 3] + nth % row[:, 2] * one
                capacity[at] = row[:, 4]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(s.astype(np.int64)), pa.array(bin_id), pa.array(offset), pa.array(capacity)], names=[key, "piece", "n_tokens", "bin_id", "bin_offset", "bin_capacity"])

    kind = items.schema[key].dataType.simpleString()
    return ranked.mapInArrow(place, f"`{key}` {kind}, piece int, n_tokens long, bin_id long, bin_offset long, bin_capacity long")


def fill_report(packed: DataFrame) -> DataFrame:
    """One row: bins, tokens, capacity and the share of room left."""
    bins = packed.groupBy("bin_id").agg(F.sum("n_tokens").alias("used"), F.max("bin_capacity").alias("capacity"))
    total = bins.agg(F.count(F.lit(1)).alias("n_bins"), F.sum("used").alias("n_tokens"), F.sum("capacity").alias("capacity"))
    return total.withColumn("room_left", F.when(F.col("capacity") > 0, 1 - F.col("n_tokens") / F.col("capacity")).otherwise(F.lit(0.0)))
