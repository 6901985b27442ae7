"""References to records that are missing, deleted or came later."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import shuffle_width

#: Parents in one range; a range's sorted arrays are one row of that many entries.
PARENTS_PER_RANGE = 20_000
#: References that one task probes against one copy of a range.
REFS_PER_TASK = 500_000


def _slot(key: Column, ranges: int) -> Column:
    """The range of a key in the order of its 64-bit hash: equal slices of the hash space, so ranges need no sample and stay even."""
    return F.floor((F.shiftrightunsigned(F.xxhash64(key), 1) / F.lit(float(2**63))) * ranges).cast("int")


def find_orphans(
    refs: DataFrame,
    parents: DataFrame,
    *,
    parents_rows: int | None = None,
    refs_rows: int | None = None,
    ref_counts: DataFrame | None = None,
) -> DataFrame:
    """References whose target is ``missing``, ``deleted`` or ``late`` (the first that holds).

    ``refs``: ``ref_table, ref_id, ref_month, target, seen_at``; ``parents``: ``key`` (unique), ``gone`` boolean,
    ``created_at``; both times are timestamps. Returns ``ref_table, ref_id, ref_month, target, orphan_kind``.

    The keys are partitioned into ranges of their hash order. A range with more references than one task should probe is cut
    into salted slices, each with its own copy of the range's parents, so a popular target is spread; the number of slices
    comes from a count of the references by range (bounded by the number of ranges). In a task the rows arrive sorted by
    range, the parents first and in the order of their hashes: they become the range's sorted arrays, and the Arrow batches
    of references that follow are probed by binary search. Nothing but one range's arrays and one batch is held. (Parents
    travel as rows, for Arrow takes time quadratic in the batch to write columns of lists.)

    Cases: a null or empty target names no record, so it is ``missing``. A null ``gone`` counts as not deleted; a null
    time on either side is never late. Duplicate references stay duplicate rows. Without parents everything is missing;
    without references the result is empty.
    """
    spark = refs.sparkSession
    n_parents = parents_rows if parents_rows is not None else parents.count()
    ranges = max(shuffle_width(spark), -(-n_parents // PARENTS_PER_RANGE))
    slot = _slot(F.coalesce(F.col("target"), F.lit("")), ranges)
    counted = ref_counts if ref_counts is not None else refs.select("target")
    # one row a range: bounded by ``ranges``, not by the references
    counts = counted.select(slot.alias("__slot")).groupBy("__slot").count()
    slices = counts.filter(F.col("count") > REFS_PER_TASK).select("__slot", F.ceil(F.col("count") / REFS_PER_TASK).cast("int").alias("__n"))

    none_s, none_l, none_b = F.lit(None).cast("string"), F.lit(None).cast("long"), F.lit(None).cast("boolean")
    keyed = parents.filter(F.col("key").isNotNull()).select(_slot(F.col("key"), ranges).alias("__slot"), "key", "gone", "created_at")
    copies = keyed.join(F.broadcast(slices) if ranges <= 100_000 else slices, "__slot", "left").withColumn("__salt", F.explode(F.sequence(F.lit(0), F.coalesce("__n", F.lit(1)) - 1)))
    stored = copies.select(
        "__slot", "__salt", F.lit(0).alias("__kind"), F.xxhash64("key").alias("__hash"), F.col("key").alias("target"), F.unix_micros("created_at").alias("__time"),
        F.coalesce(F.col("gone"), F.lit(False)).alias("__gone"), none_s.alias("ref_table"), none_s.alias("ref_id"), none_s.alias("ref_month"),
    )
    spread = F.pmod(F.xxhash64("ref_table", "ref_id", "__time"), F.coalesce("__n", F.lit(1))).cast("int")
    probes = refs.select("ref_table", "ref_id", "ref_month", "target", slot.alias("__slot"), F.xxhash64("target").alias("__hash"), F.unix_micros("seen_at").alias("__time"))
    probes = probes.join(F.broadcast(slices) if ranges <= 100_000 else slices, "__slot", "left")
    probes = probes.select("__slot", spread.alias("__salt"), F.lit(1).alias("__kind"), "__hash", "target", "__time", none_b.alias("__gone"), "ref_table", "ref_id", "ref_month")
    width = max(shuffle_width(spark), -(-ranges // 4), -(-(refs_rows or 0) // (2 * REFS_PER_TASK)))
    order = F.when(F.col("__kind") == 0, F.col("__hash")).otherwise(none_l)
    both = stored.unionByName(probes).repartition(width, "__slot", "__salt").sortWithinPartitions("__slot", "__salt", "__kind", order)
    out = T.StructType([T.StructField(c, T.StringType()) for c in ("ref_table", "ref_id", "ref_month", "target", "orphan_kind")])
    return both.mapInArrow(_probe, out)


class _Range:
    """The parents of one range as arrays sorted by hash; they may come in several batches."""

    def __init__(self) -> None:
        self.parts: list[pa.RecordBatch] = []
        self.ready = False

    def add(self, batch: pa.RecordBatch) -> None:
        self.parts.append(batch)

    def close(self) -> None:
        if self.ready:
            return
        t = pa.Table.from_batches(self.parts).combine_chunks() if self.parts else None
        column = lambda n: t.column(n).combine_chunks() if t is not None else None
        self.hashes = column("__hash").to_numpy() if t is not None else np.zeros(0, np.int64)
        self.keys = column("target")
        self.gone = column("__gone").to_numpy(zero_copy_only=False).astype(bool) if t is not None else np.zeros(0, bool)
        times = column("__time")
        self.undated = times.is_null().to_numpy(zero_copy_only=False) if t is not None else np.zeros(0, bool)
        self.times = pc.fill_null(times, 0).to_numpy() if t is not None else np.zeros(0, np.int64)
        self.parts, self.ready = [], True


def _probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["ref_table", "ref_id", "ref_month", "target"]
    at: tuple[int, int] | None = None
    here = _Range()
    for batch in batches:
        if not batch.num_rows:
            continue
        slot, salt, kind = (batch.column(x).to_numpy() for x in ("__slot", "__salt", "__kind"))
        cuts = np.flatnonzero((np.diff(slot) != 0) | (np.diff(salt) != 0) | (np.diff(kind) != 0)) + 1
        for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows], strict=True):
            if at != (now := (int(slot[lo]), int(salt[lo]))):
                at, here = now, _Range()
            part = batch.slice(lo, hi - lo)
            if kind[lo] == 0:
                here.add(part)
                continue
            here.close()
            n = hi - lo
            found, place = np.zeros(n, dtype=bool), np.zeros(n, dtype=np.int64)
            target, hashes = part.column("target"), part.column("__hash").to_numpy()
            first, past = np.searchsorted(here.hashes, hashes, "left"), np.searchsorted(here.hashes, hashes, "right")
            for step in range(int((past - first).max(initial=0))):  # more than one step only where two keys share a hash
                open_ = np.flatnonzero(~found & (first + step < past))
                if not len(open_):
                    break
                spot = first[open_] + step
                same = pc.fill_null(pc.equal(target.take(pa.array(open_)), here.keys.take(pa.array(spot))), False).to_numpy(zero_copy_only=False)
                found[open_[same]], place[open_[same]] = True, spot[same]
            what = np.full(n, "", dtype=object)
            hit = np.flatnonzero(found)
            if len(hit):
                seen = part.column("__time")
                dated = ~seen.is_null().to_numpy(zero_copy_only=False)[hit] & ~here.undated[place[hit]]
                late = dated & (here.times[place[hit]] > pc.fill_null(seen, 0).to_numpy()[hit])
                what[hit[late]] = "late"
                what[hit[here.gone[place[hit]]]] = "deleted"
            what[~found] = "missing"
            orphan = what != ""
            kept = part.filter(pa.array(orphan))
            yield pa.RecordBatch.from_arrays([kept.column(x) for x in names] + [pa.array(what[orphan], pa.string())], names=[*names, "orphan_kind"])


def orphan_report(orphans: DataFrame) -> DataFrame:
    """Orphans per table, month and kind."""
    return orphans.groupBy("ref_table", "ref_month", "orphan_kind").agg(F.count(F.lit(1)).alias("n_refs"), F.count_distinct("target").alias("n_targets"))
