"""Applying a feed of inserts, updates and deletes to a bucketed copy-on-write table."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import hadoop_path, materialise, shuffle_width

#: Keys in one bucket, about.
KEYS_PER_BUCKET = 100_000

STATE = "engine_id string, process_instance_id string, deleted_seq long, last_seq long, state_seq long, state string"
KEY = ("engine_id", "process_instance_id")


def fold(changes: DataFrame) -> DataFrame:
    """What the records of each key amount to, in a form that merges in any order and any number of times.

    ``deleted_seq`` is the highest sequence of a delete, ``last_seq`` that of any other record, ``state`` the one carried
    with the highest sequence ``state_seq``. All are maxima, so late and repeated records need no ordering pass, and the
    map side reduces a hot key to one row a task. ``changes``: the key, ``stream_sequence``, ``event_type``, ``state``.
    Records of equal sequence are one record; should they disagree, a delete counts first and the greatest state wins.
    """
    seq = F.coalesce(F.col("stream_sequence"), F.lit(0).cast("long"))
    gone = F.col("event_type").eqNullSafe("delete")
    carried = F.max(F.when(~gone & F.col("state").isNotNull(), F.struct(seq.alias("s"), F.col("state").alias("v"))))
    return (
        changes.groupBy(*KEY)
        .agg(F.max(F.when(gone, seq)).alias("deleted_seq"), F.max(F.when(~gone, seq)).alias("last_seq"), carried.alias("__c"))
        .select(*KEY, "deleted_seq", "last_seq", F.col("__c.s").alias("state_seq"), F.col("__c.v").alias("state"))
    )


def merge(a: DataFrame, b: DataFrame) -> DataFrame:
    """Two folded states of the same keys as one."""
    held = F.max(F.when(F.col("state_seq").isNotNull(), F.struct("state_seq", "state")))
    return (
        a.unionByName(b)
        .groupBy("__bucket", *KEY)
        .agg(F.max("deleted_seq").alias("deleted_seq"), F.max("last_seq").alias("last_seq"), held.alias("__h"))
        .select("__bucket", *KEY, "deleted_seq", "last_seq", F.col("__h.state_seq").alias("state_seq"), F.col("__h.state").alias("state"))
    )


def bucket_of(buckets: int, key: Sequence[str] = KEY) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")


def present(folded: DataFrame) -> DataFrame:
    """The instances that exist: ``engine_id, process_instance_id, stream_sequence, state``."""
    alive = F.col("last_seq").isNotNull() & (F.col("deleted_seq").isNull() | (F.col("last_seq") > F.col("deleted_seq")))
    kept = F.col("state_seq").isNotNull() & (F.col("deleted_seq").isNull() | (F.col("state_seq") > F.col("deleted_seq")))
    return folded.filter(alive).select(*KEY, F.col("last_seq").alias("stream_sequence"), F.when(kept, F.col("state")).otherwise(F.lit("ACTIVE")).alias("state"))


#: Buckets whose folders one part of the manifest names.
BUCKETS_PER_PART = 1_024


@dataclass(frozen=True)
class Kind:
    """What a bucketed table holds: its key and schema; how a change set becomes rows of it; how such rows (with ``__bucket``)
    are merged with those that are there, which are None in an empty table."""

    key: tuple[str, ...]
    schema: str
    rows: Callable[[DataFrame], DataFrame]
    merge: Callable[[DataFrame | None, DataFrame], DataFrame]

    @property
    def columns(self) -> list[str]:
        return T.StructType.fromDDL(self.schema).fieldNames()


FEED = Kind(KEY, STATE, lambda changes: fold(changes), lambda base, rows: rows if base is None else merge(base, rows))


class BucketedTable:
    """A table of folded states (or of another :class:`Kind`): hash buckets of immutable files, and a manifest that says which
    file set is current.

    ``root/manifest-N.json`` names the parts of version N; a part maps buckets to folders. A change set is folded once and
    routed to its buckets; only those are read, merged with their changes and written anew under ``root/data/<token>``. The
    parts that name them are written anew, then the manifest, which is the commit: it is created exclusively (a store where
    two writers can create one file twice needs a lock beside it), and a manifest that isn't whole counts as none. So a
    reader sees all of a change set or none of it, and a failed or repeated apply does no harm.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int | None = None, kind: Kind = FEED):
        """``buckets`` is taken when the table is made; an existing table keeps its own, see :meth:`rebucket`."""
        self.spark, self.root, self.kind = spark, root.rstrip("/"), kind
        version, manifest = self._current()
        if version < 0:
            if not buckets:
                raise ValueError("a new table needs its number of buckets")
            manifest = {"buckets": int(buckets), "parts": {}}
            self._commit(0, manifest)
        self.buckets = manifest["buckets"]

    def _load(self, name: str) -> dict:
        path, fs = hadoop_path(self.spark, f"{self.root}/{name}")
        stream = fs.open(path)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _store(self, name: str, content: dict) -> None:
        path, fs = hadoop_path(self.spark, f"{self.root}/{name}")
        out = fs.create(path, False)
        try:
            out.write(bytearray(json.dumps(content), "utf-8"))
        finally:
            out.close()

    def _versions(self) -> list[int]:
        path, fs = hadoop_path(self.spark, self.root)
        names = [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []
        return sorted((int(n[9:-5]) for n in names if n.startswith("manifest-") and n.endswith(".json")), reverse=True)

    def _current(self) -> tuple[int, dict]:
        for v in self._versions():
            try:
                return v, self._load(f"manifest-{v}.json")
            except json.JSONDecodeError:  # its writer didn't get to the end
                continue
        return -1, {}

    def _commit(self, version: int, manifest: dict) -> None:
        try:
            self._store(f"manifest-{version}.json", manifest)
        except Py4JJavaError as e:
            raise RuntimeError(f"another writer committed version {version}") from e

    def _files(self, manifest: dict, parts: Iterable[int] | None = None) -> dict[int, str]:
        """Bucket to folder, of all parts or of some."""
        names = manifest["parts"].items() if parts is None else [(str(p), manifest["parts"][str(p)]) for p in parts if str(p) in manifest["parts"]]
        return {int(b): f for _, name in names for b, f in self._load(name).items()}

    def _read(self, folders: list[str]) -> DataFrame:
        schema = f"__bucket int, {self.kind.schema}"
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)

    def _write(self, rows: DataFrame, version: int, manifest: dict, buckets: int, marks: dict[str, int]) -> int:
        """Write rows as new files of their buckets and commit them with the marks."""
        token = f"v{version + 1}-{uuid.uuid4().hex[:8]}"
        target = f"{self.root}/data/{token}"
        # the sort keeps one writer open at a time; the spare column puts the bucket into the file as well
        tasks = [buckets // 8] if buckets // 8 > shuffle_width(self.spark) else []  # a table of many buckets needs more than the session's
        rows.repartition(*tasks, "__bucket").sortWithinPartitions("__bucket", *self.kind.key).withColumn("folder", F.col("__bucket")).write.partitionBy("folder").parquet(target)
        path, fs = hadoop_path(self.spark, target)
        written = [s.getPath().getName() for s in fs.listStatus(path) if s.isDirectory()]
        if not written:
            return version
        fresh: dict[int, dict[int, str]] = {}
        for n in written:
            bucket = int(n.split("=")[1])
            fresh.setdefault(bucket // BUCKETS_PER_PART, {})[bucket] = f"{target}/{n}"
        parts = dict(manifest["parts"])
        for part, files in fresh.items():
            name = f"part-{part}-{token}.json"
            self._store(name, self._files(manifest, [part]) | files)
            parts[str(part)] = name
        self._commit(max([version, *self._versions()]) + 1, {"buckets": buckets, "parts": parts, "marks": marks})
        self.buckets = buckets
        return self._current()[0]

    def apply(self, changes: DataFrame, mark: tuple[str, int] | None = None) -> int:
        """Apply one change set (for the feed: columns of :func:`fold`); returns the version it made. An empty set changes nothing.

        ``mark``, a source and a number that rises in it, makes a set that is delivered again do nothing: the number is
        committed together with the files.
        """
        version, manifest = self._current()
        marks = dict(manifest.get("marks", {}))
        if mark:
            if marks.get(mark[0], mark[1] - 1) >= mark[1]:
                return version
            marks[mark[0]] = mark[1]
        routed = self.kind.rows(changes).withColumn("__bucket", bucket_of(self.buckets, self.kind.key)).select("__bucket", *self.kind.columns)
        if not manifest["parts"]:
            return self._write(self.kind.merge(None, routed), version, manifest, self.buckets, marks)
        routed = materialise(routed, "change-set")  # folded once: its buckets are asked for, then it is merged
        touched = [r[0] for r in routed.select("__bucket").distinct().collect()]  # at most ``buckets`` numbers
        files = self._files(manifest, sorted({b // BUCKETS_PER_PART for b in touched}))
        base = self._read([files[b] for b in touched if b in files])
        return self._write(self.kind.merge(base, routed), version, manifest, self.buckets, marks)

    def rebucket(self, buckets: int) -> int:
        """Spread the table over another number of buckets, as one version of its own."""
        version, manifest = self._current()
        rows = self.read().withColumn("__bucket", bucket_of(buckets, self.kind.key)).select("__bucket", *self.kind.columns)
        return self._write(rows, version, {"parts": {}}, buckets, manifest.get("marks", {}))

    def folders(self) -> dict[int, str]:
        """The current folder of each bucket that has one."""
        return self._files(self._current()[1])

    def read(self) -> DataFrame:
        """All folded states of the current version, deleted keys included (a late record must still find its delete)."""
        return self._read(sorted(self.folders().values())).select(*self.kind.columns)

    def vacuum(self) -> int:
        """Delete files that the current manifest no longer names, older manifests and parts; returns how many folders went.
        Only while nobody writes."""
        version, manifest = self._current()
        keep = set(self._files(manifest).values())
        base, fs = hadoop_path(self.spark, f"{self.root}/data")
        gone = 0
        if fs.exists(base):
            for batch in fs.listStatus(base):
                inner = [s.getPath() for s in fs.listStatus(batch.getPath()) if s.isDirectory()]
                stale = [p for p in inner if f"{self.root}/data/{batch.getPath().getName()}/{p.getName()}" not in keep]
                for p in stale:
                    fs.delete(p, True)
                    gone += 1
                if len(stale) == len(inner):
                    fs.delete(batch.getPath(), True)
        named = {f"manifest-{version}.json", *manifest["parts"].values()}
        for s in fs.listStatus(hadoop_path(self.spark, self.root)[0]):
            name = s.getPath().getName()
            if name.startswith(("manifest-", "part-")) and name not in named:
                fs.delete(s.getPath(), False)
        return gone
