"""Keep exactly one copy of messages that were delivered at least once."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..session import hadoop_path, shuffle_width

#: An identifier's state expires once the event-time watermark is this far past its last copy: 30 days.
KEEP_STATE_MS = 30 * 86_400_000
#: Salted groups that carry surplus copies found before the shuffle past the state.
PASS_SALTS = 64
#: Identifiers in one bucket of the state, about: the unit that is read and written as a whole.
IDS_PER_BUCKET = 2_000

#: Buckets in one state store, about.
BUCKETS_PER_STORE = 32

MESSAGE = "source string, message_id string, arrival_no long, seen_at timestamp"
_HASHED = "bucket int, h1 long, h2 long"
_LOCAL = f"{_HASHED}, {MESSAGE}, surplus array<long>"
_OUT = "source string, message_id string, arrival_no long, verdict string, seen_ms long"
_STATE = "h1 binary, h2 binary, first_arrival binary, last_seen_ms binary, gone binary"
_STATE_COLUMNS = ("h1", "h2", "first", "seen")


def _thin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Before the shuffle: of each identifier in an Arrow batch only the earliest copy goes to the state; the arrival numbers
    of the others travel in lists, spread over salted groups, so that a hot identifier costs its task one row a batch."""
    for batch in batches:
        if not batch.num_rows:
            continue
        t = pa.Table.from_batches([batch])
        names = ["bucket", "h1", "h2", "source", "message_id"]
        g = t.group_by(names, use_threads=False).aggregate([("arrival_no", "min"), ("seen_at", "max"), ("arrival_no", "list")])
        first, every = g.column("arrival_no_min"), g.column("arrival_no_list")
        none = pa.array([[]] * g.num_rows, pa.list_(pa.int64()))
        schema = pa.schema([("bucket", pa.int32()), ("h1", pa.int64()), ("h2", pa.int64()), ("source", pa.string()), ("message_id", pa.string()), ("arrival_no", pa.int64()), ("seen_at", batch.schema.field("seen_at").type), ("surplus", pa.list_(pa.int64()))])
        keep = pa.table([*[g.column(n) for n in names], first, g.column("seen_at_max"), none], schema=schema)
        more = pc.greater(pc.list_value_length(every), 1)
        some = g.filter(more)
        parts = [keep]
        if some.num_rows:
            lists = some.column("arrival_no_list").combine_chunks()
            numbers, parent = lists.flatten().to_numpy(), pc.list_parent_indices(lists).to_numpy()
            # all but the first of each list that is its least
            lowest = np.flatnonzero(numbers == some.column("arrival_no_min").to_numpy()[parent])
            rest = np.delete(numbers, lowest[np.unique(parent[lowest], return_index=True)[1]])
            ends = np.cumsum(pc.list_value_length(lists).to_numpy() - 1)
            salted = pa.array((-1 - rest[np.concatenate([[0], ends[:-1]])] % PASS_SALTS).astype(np.int32))
            shorter = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(rest))
            parts.append(pa.table([salted, *[some.column(n) for n in names[1:]], pa.nulls(some.num_rows, pa.int64()), some.column("seen_at_max"), shorter], schema=schema))
        yield from pa.concat_tables(parts).combine_chunks().to_batches()


def _judge(key: tuple[Any, ...], frames: Iterator[pd.DataFrame], state: GroupState, keep_ms: int) -> Iterator[pd.DataFrame]:
    """A bucket's state holds, for each identifier seen, its 128-bit hash and the lowest arrival number so far, as arrays.

    Whatever the order of arrival, every copy but the lowest is put out as surplus exactly once: a copy that is not lower at
    once, a displaced lowest when a lower one comes. One sort of state and batch settles the whole bucket. Of an identifier
    that has expired 32 bits remain in ``gone``, an eighth of what it took. A copy that has these bits, whatever its own
    time, is put out as late, to be settled by a lookup in the output; its identifier doesn't come back into the state.
    """
    watermark = max(0, state.getCurrentWatermarkMs())
    old = {c: np.zeros(0, np.int64) for c in _STATE_COLUMNS}
    gone = np.zeros(0, np.uint32)
    if state.exists:
        *columns, bits = state.get
        old, gone = dict(zip(_STATE_COLUMNS, (np.frombuffer(b, dtype=np.int64) for b in columns), strict=True)), np.frombuffer(bits, dtype=np.uint32)

    def store(h1: np.ndarray, h2: np.ndarray, first: np.ndarray, seen: np.ndarray) -> None:
        live = seen + keep_ms >= watermark
        left = np.union1d(gone, h2[~live].astype(np.uint32)) if not live.all() else gone
        if live.any() or len(left):
            state.update((*(np.ascontiguousarray(x[live]).tobytes() for x in (h1, h2, first, seen)), left.tobytes()))
            if live.any():
                state.setTimeoutDuration(3_600_000)

    if state.hasTimedOut:
        store(*(old[c] for c in _STATE_COLUMNS))
        return
    if key[0] < 0:  # surplus copies pass by
        for f in frames:
            flat = f[["source", "message_id", "surplus"]].explode("surplus")
            yield pd.DataFrame({"source": flat["source"], "message_id": flat["message_id"], "arrival_no": flat["surplus"].astype("int64"), "verdict": "surplus", "seen_ms": 0})
        return
    new = pd.concat(list(frames), ignore_index=True)
    n_old = len(old["h1"])
    seen_ms = new["seen_at"].dt.as_unit("ms").astype("int64").to_numpy()
    h1, h2, arrival, seen = (np.concatenate([old[c], x]) for c, x in zip(_STATE_COLUMNS, (new["h1"].to_numpy(), new["h2"].to_numpy(), new["arrival_no"].to_numpy(), seen_ms), strict=True))
    fresh = np.arange(len(h1)) >= n_old
    order = np.lexsort((fresh, arrival, h2, h1))
    h1, h2, arrival, seen, fresh = h1[order], h2[order], arrival[order], seen[order], fresh[order]
    head = np.ones(len(h1), dtype=bool)
    head[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
    starts = np.flatnonzero(head)
    group = np.cumsum(head) - 1
    known = np.zeros(len(starts), dtype=bool)
    known[group[~fresh]] = True
    newest = np.maximum.reduceat(seen, starts)
    verdict = np.full(len(h1), "", dtype=object)
    verdict[~head] = "surplus"
    lead = head & fresh
    verdict[lead] = np.where(known[group[lead]], "lowered", "kept")
    # nothing known, or known no more: all its copies go to the lookup
    late = ~known & np.isin(h2[starts].astype(np.uint32), gone)
    verdict[late[group]] = "late"
    out = np.flatnonzero(verdict != "")
    # a displaced row of the state has its names from the row that leads its group, which is new
    source_row = np.where(fresh[out], order[out], order[starts[group[out]]]) - n_old
    store(h1[starts[~late]], h2[starts[~late]], arrival[starts[~late]], newest[~late])
    yield pd.DataFrame({"source": new["source"].to_numpy()[source_row], "message_id": new["message_id"].to_numpy()[source_row], "arrival_no": arrival[out], "verdict": verdict[out], "seen_ms": newest[group[out]]})


def judged(messages: DataFrame, buckets: int, keep_ms: int = KEEP_STATE_MS) -> DataFrame:
    """The stateful part of a streaming ``messages`` (columns of ``MESSAGE``): one row a verdict.

    Expiry goes by the event-time watermark, but is looked at when a bucket is touched or on a timer: rows behind the
    watermark must reach the state (Spark drops them before an operator with event-time timeouts), for a copy may come
    arbitrarily late.
    """
    names = [F.col(c.split()[0]) for c in MESSAGE.split(", ")]
    h1, h2 = F.xxhash64("source", "message_id"), F.xxhash64("message_id", F.lit(1), "source")
    hashed = messages.select(F.pmod(h1, F.lit(buckets)).cast("int").alias("bucket"), h1.alias("h1"), h2.alias("h2"), *names)
    thin = hashed.mapInArrow(_thin, _LOCAL).withWatermark("seen_at", "1 hour")

    def judge(key: tuple[Any, ...], frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        yield from _judge(key, frames, state, keep_ms)

    return thin.groupBy("bucket").applyInPandasWithState(judge, _OUT, _STATE, "append", GroupStateTimeout.ProcessingTimeTimeout)


class _Sink:
    """Writes a batch's verdicts under its batch number, so that a repeated batch overwrites itself and the checkpoint and
    the output agree. Late rows are settled against everything kept so far."""

    def __init__(self, root: str):
        self.root = root

    def __call__(self, batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        batch.write.mode("overwrite").partitionBy("verdict").parquet(f"{self.root}/raw/batch={number}")
        raw = spark.read.schema(f"{_OUT}").parquet(f"{self.root}/raw/batch={number}")
        late = raw.filter(F.col("verdict") == "late").drop("verdict")
        settled = f"{self.root}/settled/batch={number}"
        path, fs = hadoop_path(spark, f"{self.root}/raw/batch={number}/verdict=late")
        if not fs.exists(path):
            return
        # what was kept before this batch, of the late identifiers only: the semi join comes before anything is shuffled by
        # identifier, as a broadcast or behind a Bloom filter while they are few
        old = current_first(spark, self.root, before=number, among=late.select("source", "message_id").distinct())
        every = late.withColumn("old", F.lit(False)).unionByName(old.select("source", "message_id", "arrival_no", F.lit(0).cast("long").alias("seen_ms"), F.lit(True).alias("old")))
        one = Window.partitionBy("source", "message_id")
        # one copy of each, the one kept before if there are equals; equal copies of one batch are told apart by their place
        ranked = every.withColumn("first", F.row_number().over(one.orderBy("arrival_no", F.desc("old"))) == 1)
        verdict = F.when(F.col("first"), F.when(F.max("old").over(one), "lowered").otherwise("kept")).otherwise("surplus")
        out = ranked.withColumn("verdict", verdict).filter(~(F.col("first") & F.col("old"))).drop("first", "old")
        out.write.mode("overwrite").partitionBy("verdict").parquet(settled)


def _verdicts(spark: SparkSession, root: str) -> DataFrame:
    schema = f"{_OUT}, batch int"
    folders = []
    for part in ("raw", "settled"):
        path, fs = hadoop_path(spark, f"{root}/{part}")
        if fs.exists(path) and len(fs.listStatus(path)):
            folders.append(f"{root}/{part}")
    frames = [spark.read.schema(schema).option("basePath", f).parquet(f) for f in folders]
    if not frames:
        return spark.createDataFrame([], schema)
    return frames[0] if len(frames) == 1 else frames[0].unionByName(frames[1])


def current_first(spark: SparkSession, root: str, before: int | None = None, among: DataFrame | None = None) -> DataFrame:
    """The kept copy of each identifier: ``source, message_id, arrival_no``; of all, or of those in ``among``."""
    v = _verdicts(spark, root).filter(F.col("verdict").isin("kept", "lowered"))
    if before is not None:
        v = v.filter(F.col("batch") < before)
    if among is not None:
        v = v.join(among, ["source", "message_id"], "left_semi")
    return v.groupBy("source", "message_id").agg(F.min("arrival_no").alias("arrival_no"))


def surplus(spark: SparkSession, root: str) -> DataFrame:
    """Every surplus copy so far: ``source, message_id, arrival_no``."""
    return _verdicts(spark, root).filter(F.col("verdict") == "surplus").select("source", "message_id", "arrival_no")


@contextmanager
def _settings(spark: SparkSession, wanted: dict[str, str]):
    old = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def run_dedup(messages: DataFrame, root: str, buckets: int, keep_ms: int = KEEP_STATE_MS) -> None:
    """Run the stream ``messages`` (columns of ``MESSAGE``) to its present end, with state, checkpoint and output under ``root``.

    A second call with the same root goes on where the first ended, and takes in only new files; ``buckets`` must stay as
    it was. The state lives in RocksDB, so its size is bounded by the executors' disks, not by their memory. Identifiers are
    told apart by 128 bits of hash.

    Cases: equal arrival numbers of one identifier leave one copy and make the others surplus. A null identifier is an
    identifier like any other, so callers filter it out if it isn't. A null time counts as the oldest. An empty stream
    writes nothing and both readers return no rows.
    """
    spark = messages.sparkSession
    wanted = {
        "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        # all stores of an executor share one bound of native memory, and only changes are uploaded
        "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
        "spark.sql.streaming.noDataMicroBatches.enabled": "false",
        # a store for every few buckets; the number is fixed by the first run of a checkpoint
        "spark.sql.shuffle.partitions": str(max(1, min(shuffle_width(spark), max(spark.sparkContext.defaultParallelism, -(-buckets // BUCKETS_PER_STORE))))),
    }
    with _settings(spark, wanted):
        query = judged(messages, buckets, keep_ms).writeStream.foreachBatch(_Sink(root)).option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start()
        query.awaitTermination()
