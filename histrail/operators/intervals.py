"""Continuous periods and gaps of overlapping intervals per entity."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: An entity with more intervals than this is cut into time shards of about so many.
ROWS_PER_SHARD = 20_000
#: Shards of all entities together; with more intervals than they hold at the above size, they are larger. So what goes to the
#: driver and back (a cut a shard) has a bound.
MOST_SHARDS = 100_000
#: The cuts come from a sample with about so many rows a shard.
SAMPLES_PER_SHARD = 50

Cuts = dict[Any, tuple[np.ndarray, np.ndarray]]


def _clean(intervals: DataFrame, entity: str, start: str, end: str) -> DataFrame:
    """``__e, __s, __t``: end null (still running) becomes the greatest long; empty and reversed intervals are left out."""
    forever = F.lit(2**63 - 1)
    s, t = F.col(start).cast("long"), F.coalesce(F.col(end).cast("long"), forever)
    return intervals.select(F.col(entity).alias("__e"), s.alias("__s"), t.alias("__t")).filter(F.col("__s").isNotNull() & (F.col("__t") > F.col("__s")))


def shard_cuts(seen: DataFrame, per_shard: int) -> Cuts:
    """For each entity of more than ``per_shard`` rows (``__e, __s``), the places that cut it into shards of about so many.

    Shards are equal by rank and not by time, so that neither outliers nor bursts make one large. A place is a start and a
    number: the rows of one start are ordered by a hash, so that a start that many rows share is cut as well.
    """
    per_shard = max(per_shard, -(-seen.count() // MOST_SHARDS))
    counts = seen.groupBy("__e").agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > per_shard)
    giants = [r[0] for r in counts.select("__e").collect()]  # at most MOST_SHARDS
    if not giants:
        return {}
    known = seen.sparkSession.createDataFrame([(g,) for g in giants], f"__ge {seen.schema['__e'].dataType.simpleString()}")
    share = min(1.0, SAMPLES_PER_SHARD / per_shard)
    sample = seen.filter(F.rand(7) < share) if share < 1 else seen
    sample = sample.join(F.broadcast(known), F.col("__e").eqNullSafe(F.col("__ge")), "left_semi").withColumn("__h", F.xxhash64(F.monotonically_increasing_id()))
    nth = F.row_number().over(Window.partitionBy("__e").orderBy("__s", "__h"))
    cuts: dict[Any, list[tuple[int, int]]] = {g: [] for g in giants}
    for e, s, h in sample.withColumn("__r", nth).filter(F.col("__r") % max(1, round(per_shard * share)) == 0).select("__e", "__s", "__h").collect():
        cuts[e].append((s, h))
    return {e: tuple(np.array(sorted(c), dtype=np.int64).reshape(-1, 2).T.copy()) for e, c in cuts.items()}


def shard_of(cuts: tuple[np.ndarray, np.ndarray], s: np.ndarray, h: np.ndarray) -> np.ndarray:
    """How many cuts do not lie after each (start, hash)."""
    starts, hashes = cuts
    lo, hi = np.searchsorted(starts, s, "left"), np.searchsorted(starts, s, "right")
    k = lo.copy()
    on = np.flatnonzero(lo < hi)
    for at in np.unique(lo[on]) if len(on) else ():
        rows = on[lo[on] == at]
        k[rows] = at + np.searchsorted(hashes[at : hi[rows[0]]], h[rows], "right")
    return k


def _sharded(giants: DataFrame, cuts: Cuts) -> DataFrame:
    """``__e, __k, __s, __t``: copies of an interval once, with the shard of its start, spread by entity and shard."""
    shared = giants.sparkSession.sparkContext.broadcast(cuts)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            coded = batch.column(0).dictionary_encode()
            code = pc.fill_null(coded.indices, -1).to_numpy(zero_copy_only=False)
            values = coded.dictionary.to_pylist()
            s, h = batch.column(1).to_numpy(), batch.column(3).to_numpy()
            k = np.zeros(len(s), dtype=np.int64)
            for c in np.unique(code).tolist():
                rows = np.flatnonzero(code == c)
                k[rows] = shard_of(shared.value[values[c] if c >= 0 else None], s[rows], h[rows])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(k), batch.column(1), batch.column(2)], names=["__e", "__k", "__s", "__t"])

    once = giants.dropDuplicates().withColumn("__h", F.xxhash64("__t"))
    return once.mapInArrow(place, f"__e {giants.schema['__e'].dataType.simpleString()}, __k long, __s long, __t long").repartition("__e", "__k")


def merged(intervals: DataFrame, entity: str, start: str, end: str, *, per_shard: int = ROWS_PER_SHARD, candidates: DataFrame | None = None) -> DataFrame:
    """Local periods with what their neighbours need: ``__e, __k, __s`` (start), ``__before`` (the latest end of all
    earlier intervals of the entity, null for the first), ``__fresh`` (a period starts here).

    Level one puts each interval of a huge entity into the time shard of its start and merges there: a window over (entity,
    shard) keeps the intervals that begin a local period. Level two sees one row for each (entity, shard): how far the
    shard's intervals reach beyond its boundary. The running maximum of that reach is the coverage that enters the later
    shards; joined back, it coalesces what touches a boundary. An interval over many shards is thus one number, instead of
    a clipped piece for each shard. Entities of ordinary size are merged by one window.
    """
    clean = _clean(intervals, entity, start, end)
    seen = clean.select("__e", "__s") if candidates is None else candidates.select(F.col(entity).alias("__e"), F.col(start).cast("long").alias("__s"))
    cuts = shard_cuts(seen.filter(F.col("__s").isNotNull()), per_shard)
    running = lambda *by: F.max("__t").over(Window.partitionBy(*by).orderBy("__s", "__t").rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.col("__before").isNull() | (F.col("__s") > F.col("__before"))
    if not cuts:
        whole = clean.withColumn("__before", running("__e"))
        return whole.select("__e", F.lit(0).cast("long").alias("__k"), "__s", "__before", fresh.alias("__fresh"))
    known = clean.sparkSession.createDataFrame([(e,) for e in cuts], f"__ge {clean.schema['__e'].dataType.simpleString()}")
    is_giant = F.col("__e").eqNullSafe(F.col("__ge"))
    whole = clean.join(F.broadcast(known), is_giant, "left_anti").withColumn("__before", running("__e"))
    whole = whole.select("__e", F.lit(0).cast("long").alias("__k"), "__s", "__before")

    rows = _sharded(clean.join(F.broadcast(known), is_giant, "left_semi"), cuts)
    local = rows.withColumn("__local", running("__e", "__k"))
    starts = local.filter(F.col("__local").isNull() | (F.col("__s") > F.col("__local")))
    reach = rows.groupBy("__e", "__k").agg(F.max("__t").alias("__reach"))  # one row a shard
    entering = Window.partitionBy("__e").orderBy("__k").rowsBetween(Window.unboundedPreceding, -1)
    carry = reach.select(F.col("__e").alias("__ce"), F.col("__k").alias("__ck"), F.max("__reach").over(entering).alias("__carry"))
    stitched = starts.join(F.broadcast(carry), F.col("__e").eqNullSafe(F.col("__ce")) & (F.col("__k") == F.col("__ck")), "left")
    stitched = stitched.select("__e", "__k", "__s", F.greatest("__local", "__carry").alias("__before"))
    return whole.unionByName(stitched).withColumn("__fresh", fresh)


def gaps(intervals: DataFrame, entity: str, start: str, end: str, *, per_shard: int = ROWS_PER_SHARD, candidates: DataFrame | None = None) -> DataFrame:
    """``entity, gap_start, gap_end``: the gaps of positive length between the continuous periods of each entity.

    ``start`` and ``end`` are numbers (epoch milliseconds); intervals are half open, so those that touch leave no gap.
    A null end is still running. Left out: a null start, an end not after its start. A null entity is an entity.
    Repeated rows change nothing. Empty input gives no rows. Other columns are ignored. ``candidates`` may hold a cheaper
    superset of the same intervals (``entity``, ``start``) in which to look for huge entities; the result is the same.
    """
    m = merged(intervals, entity, start, end, per_shard=per_shard, candidates=candidates)
    return m.filter(F.col("__before").isNotNull() & F.col("__fresh")).select(F.col("__e").alias(entity), F.col("__before").alias("gap_start"), F.col("__s").alias("gap_end"))


def periods(intervals: DataFrame, entity: str, start: str, end: str, *, per_shard: int = ROWS_PER_SHARD, candidates: DataFrame | None = None) -> DataFrame:
    """``entity, period_start, period_end``: the continuous periods; a null end is still running. Rules as in :func:`gaps`.

    A period ends where the next gap begins. Within a shard the next gap is the next row's; across shards it comes from
    one row a shard, so no task sees a whole huge entity in order. Only the last period of an entity looks up its end among
    the entities; the others are spread by a number of their own in that join.
    """
    forever = 2**63 - 1
    m = merged(intervals, entity, start, end, per_shard=per_shard, candidates=candidates).filter("__fresh")
    within = Window.partitionBy("__e", "__k").orderBy("__s")
    m = m.withColumn("__next", F.lead("__before").over(within))
    firsts = m.groupBy("__e", "__k").agg(F.min_by("__before", "__s").alias("__first"))
    after = Window.partitionBy("__e").orderBy("__k").rowsBetween(1, Window.unboundedFollowing)
    later = firsts.withColumn("__later", F.min("__first").over(after)).select(F.col("__e").alias("__le"), F.col("__k").alias("__lk"), "__later")
    ended = m.join(later, F.col("__e").eqNullSafe(F.col("__le")) & (F.col("__k") == F.col("__lk")), "left").withColumn("__end", F.coalesce("__next", "__later"))
    ended = ended.withColumn("__spread", F.when(F.col("__end").isNull(), F.lit(-1)).otherwise(F.pmod(F.xxhash64("__s"), F.lit(1 << 20))).cast("long"))
    top = _clean(intervals, entity, start, end).groupBy(F.col("__e").alias("__te")).agg(F.max("__t").alias("__top")).withColumn("__last", F.lit(-1).cast("long"))
    joined = ended.join(top, F.col("__e").eqNullSafe(F.col("__te")) & (F.col("__spread") == F.col("__last")), "left")
    finish: Column = F.coalesce("__end", "__top")
    return joined.select(F.col("__e").alias(entity), F.col("__s").alias("period_start"), F.when(finish < forever, finish).alias("period_end"))
